"""URL rules, carried over to aliases.

A rule (host, path, verdict) fits its host and all subdomains if the url's path
starts with the rule's path; the longest rule wins. Rules are met by equality
joins: the suffixes of each distinct host with the rules' hosts, then the
prefixes of the path, of the lengths those rules have, with the rules' paths;
the size of the rule list does not multiply the urls.

Redirects and canonical links make urls equivalent. Over those edges connected
components are found; a url that no rule fits takes the verdict of its
component: allow where a member is explicitly allowed, else block where one is
blocked, else allow. A url's own rule always stands.

Defined cases: a null url, or one without ``://``, has empty host and path,
fits no rule and has no aliases; a null html has no links; repeated rows each
get their verdict; of rules of equal length the one with the longer host, then
allow, wins; empty tables give no rows; other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.components import components
from tidings.session import local_table, written

Rule = tuple[str, str, str]
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VALUE = r"""\s*+=\s*+(?:"([^"<>]*+)"|'([^'<>]*+)'|([^\s"'<>]++))"""


def parts(url: str) -> dict[str, Column]:
    """host, path and the rest before a fragment."""
    text = F.coalesce(F.col(url), F.lit(""))
    return {"host": F.translate(F.regexp_extract(text, _URL, 1), _UPPER, _LOWER),
            "path": F.regexp_extract(text, _URL, 2), "rest": F.regexp_extract(text, _URL, 3)}


def rule_of(text: str, verdict: str) -> Rule:
    """A rule written as host and path, like ``example.org/es/``."""
    host, slash, path = text.partition("/")
    return host, slash + path, verdict


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("rule_host", "rule_path", "rule_verdict")])
    return local_table(spark, rules, schema)


def match(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, rule_verdict) for the distinct places some rule fits."""
    rank = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), F.col("rule_verdict") == "allow")
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)),
                         lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = places.select("host").where("host <> ''").distinct().select("host", F.explode(suffix).alias("rule_host"))
    known = hosts.join(lengths, "rule_host").select("host", "rule_host", F.explode("lengths").alias("n"))
    tried = (places.distinct().join(known, "host").where(F.length("path") >= F.col("n"))
             .select("host", "path", "rule_host", F.expr("substring(path, 1, n)").alias("rule_path")))
    fits = tried.join(rules, ["rule_host", "rule_path"])
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        rank.alias("rank"), F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict")).alias("b"))
    return best.select("host", "path", "b.rule", "b.rule_verdict")


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(source, target) urls: canonical links and immediate refreshes."""
    html, url = F.col(html_col), F.col(url_col)
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<(?:link|meta)\b[^<>]*+>"), F.lit(0))
    value = lambda tag, name: F.concat(*[F.regexp_extract(tag, rf"(?i)\b{name}{_VALUE}", i) for i in (1, 2, 3)])
    found = (pages.where(url.contains("://") & html.rlike("(?i)canonical|http-equiv"))
             .select(url.alias("source"), F.explode(tags).alias("tag")))
    refresh = F.regexp_extract(value(F.col("tag"), "content"), r"(?i)^[\s\d.]*+[;,]\s*+(?:url\s*+=\s*+)?['\"]?([^'\"]*+)", 1)
    target = (F.when(F.col("tag").rlike(r"(?i)^<link") & value(F.col("tag"), "rel").rlike(r"(?i)(^|\s)canonical(\s|$)"),
                     value(F.col("tag"), "href"))
              .when(F.col("tag").rlike(r"(?i)^<meta") & (F.lower(value(F.col("tag"), "http-equiv")) == "refresh"), refresh))
    raw = F.replace(F.trim(target), F.lit("&amp;"), F.lit("&"))
    scheme, site = F.regexp_extract("source", r"(?s)^(.*?:)//", 1), F.regexp_extract("source", r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract("source", r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    absolute = (F.when(raw.contains("://"), raw).when(raw.startswith("//"), F.concat(scheme, raw))
                .when(raw.startswith("/"), F.concat(site, raw))
                .when(raw.rlike("^[?#]") | (raw == ""), None)
                .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), raw)))
    return found.select("source", absolute.alias("target")).where("target is not null")


def _node() -> Column:
    return F.when(F.col("host") != "", F.concat("host", F.when(F.col("path") == "", "/").otherwise(F.col("path")), "rest"))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict for every page. ``redirects``
    (source, target) adds redirects known from elsewhere."""
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumns(parts("url"))
    named = written(named.select("page_id", "host", "path", _node().alias("node")), "urls")
    edges = links(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target"))
    ends = edges.withColumns(parts("source")).withColumn("a", F.struct("host", "path", _node().alias("node"))).withColumns(
        parts("target")).withColumn("b", F.struct("host", "path", _node().alias("node"))).select("a", "b")
    ends = written(ends.where("a.node is not null and b.node is not null"), "aliases")
    nodes = ends.select("a.*").unionByName(ends.select("b.*")).distinct()
    # A redirect's source need not be one of the pages.
    fits = written(match(named.select("host", "path").unionByName(nodes.select("host", "path")), rules), "rules")

    label = components(ends.select(F.col("a.node").alias("x"), F.col("b.node").alias("y")), "x", "y")
    ruled = nodes.join(label, "node").join(fits, ["host", "path"]).groupBy("label").agg(
        F.max(F.col("rule_verdict") == "allow").alias("allowed"))
    inherited = label.join(ruled, "label").select("node", F.when(F.col("allowed"), "allow").otherwise("block").alias("inherited"))
    return (named.join(fits, ["host", "path"], "left").join(inherited, "node", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("rule_verdict", "inherited", F.lit("allow")).alias("verdict")))
