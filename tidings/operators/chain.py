"""Page chains: from a base URL along next-page links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.session import written


def latest_fetch(pages: DataFrame, keys: list[str], tie: str | None = None) -> DataFrame:
    """Newest row per key by ``fetched_at``.

    ``max_by`` combines on the map side, so many copies of one page meet as one
    row per task. ``tie`` orders rows fetched at the same time.
    """
    rest = [c for c in pages.columns if c not in keys]
    order = F.struct("fetched_at", *([tie] if tie else []))
    best = F.max_by(F.struct(*rest), order)
    return pages.groupBy(*keys).agg(best.alias("__r")).select(*keys, "__r.*")


def page_chain(links: DataFrame, languages: DataFrame, stop_at_loops: bool = False) -> DataFrame:
    """``lang, page_num, url, next_link, fetched`` for every page a run visits.

    ``links`` has one row per (lang, url): ``lang, url, next_link``. It should
    be a written table, as it is read twice. Chains are followed by pointer
    doubling: round k knows where ``2**k`` links lead from each page that has
    so many successors, and appends that many pages to every chain. So the
    number of joins grows with the logarithm of the longest chain, and nothing
    goes through the driver. A chain may loop; ``max_pages`` of its language
    ends it. The last row of a chain may be a page that is linked but missing
    (``fetched`` is false).

    With ``stop_at_loops`` every page is visited once: a round keeps the first visit
    of a page, so a loop is met as soon as the rounds have gone round it, whatever
    the limit, and at most twice its pages are looked at. The result has a column
    ``loops``, true for the page whose link leads back to a visited one.
    """
    languages = languages.where("max_pages > 0")
    table = links.select("lang", "url", "next_link")
    jump = (table.where("next_link <> ''").join(languages.select("lang"), "lang", "left_semi")
            .withColumnRenamed("next_link", "to"))
    seen = languages.select("lang", F.lit(1).alias("page_num"), F.col("base_url").alias("url"), "max_pages")
    span = 1
    while True:
        room = seen.where(F.col("page_num") <= F.col("max_pages") - span)
        fresh = room.join(jump, ["lang", "url"]).select(
            "lang", (F.col("page_num") + span).alias("page_num"), F.col("to").alias("url"), "max_pages")
        grown = seen.unionByName(fresh)
        if stop_at_loops:
            grown = grown.groupBy("lang", "url", "max_pages").agg(F.min("page_num").alias("page_num"))
        grown = written(grown.select(*seen.columns), "chain")
        if grown.where(F.col("page_num") > span).isEmpty():
            break
        seen = grown
        further = jump.select("lang", F.col("url").alias("to"), F.col("to").alias("end"))
        jump = written(jump.join(further, ["lang", "to"]).select("lang", "url", F.col("end").alias("to")), "jumps")
        span *= 2
    chain = seen.drop("max_pages").join(table.withColumn("fetched", F.lit(True)), ["lang", "url"], "left").select(
        "lang", "page_num", "url", F.coalesce("next_link", F.lit("")).alias("next_link"),
        F.coalesce("fetched", F.lit(False)).alias("fetched"))
    if not stop_at_loops:
        return chain
    visited = seen.select("lang", F.col("url").alias("next_link"), F.col("page_num").alias("__to"))
    return chain.join(visited, ["lang", "next_link"], "left").select(
        "lang", "page_num", "url", "next_link", "fetched",
        F.coalesce(F.col("__to") <= F.col("page_num"), F.lit(False)).alias("loops"))
