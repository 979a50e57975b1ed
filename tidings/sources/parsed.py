"""An incremental source: pages are parsed once, and kept as listings.

The folder holds, per run, the listings of the pages it parsed and a ledger of
their fetches. A run compares the fetches in the source with the ledger by
narrow columns, without reading any markup, and reads markup of those days
only on which something is new. A later run over the same pages parses none.
The ledger is written last: a run that died parses its pages again, which
changes nothing, as the newest fetch of a page counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings import schema
from tidings.operators import chain, extract
from tidings.session import SMALL_ROWS, folder, local_table, sized, small_rows, written

KEYS = ["url", "lang", "fetched_at"]
LEDGER = T.StructType([
    *(f for f in schema.PAGES if f.name in KEYS),
    T.StructField("rules", T.LongType()),
    T.StructField("n", T.LongType()),
])
LISTINGS = T.StructType([
    *(f for f in schema.PAGES if f.name in KEYS),
    T.StructField("tie", T.LongType()),
    T.StructField("rules", T.LongType()),
    *schema.LISTING,
])


def rules_state(rules: DataFrame) -> DataFrame:
    """``lang, rules``: a number that changes with the rules of a language."""
    each = F.xxhash64("field", "priority", "css", "attr").cast("decimal(38,0)")
    return rules.groupBy("lang").agg(F.xxhash64(F.sum(each), F.count(F.lit(1))).alias("rules"))


def _same(a: str, b: str, names: list[str]) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & F.col(f"{a}.{name}").eqNullSafe(F.col(f"{b}.{name}"))
    return out


class ParsedPages:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, part: str, layout: T.StructType) -> DataFrame:
        fs = folder(self.spark, f"{self.root}/{part}")
        runs = [f"{self.root}/{part}/{name}" for name in fs.names() if name.startswith("run=") and fs.has(f"{name}/_SUCCESS")]
        return self.spark.read.schema(layout).parquet(*runs) if runs else local_table(self.spark, [], layout)

    def ledger(self) -> DataFrame:
        """``lang, url, fetched_at, rules, n``: parsed fetches."""
        return self._read("ledger", LEDGER)

    def new_fetches(self, pages: DataFrame, rules: DataFrame) -> DataFrame:
        """Fetches in ``pages`` that the ledger lacks: key, day, rules and
        number of rows. A fetch is parsed again when more rows of it arrived or the rules of
        its language changed. Reads no markup."""
        state = sized(rules_state(rules))
        found = pages.groupBy(*KEYS, "fetch_date").agg(F.count(F.lit(1)).alias("n")).join(state, "lang", "left")
        seen = self.ledger().groupBy(*KEYS, "rules").agg(F.max("n").alias("n"))
        return found.alias("f").join(seen.alias("s"), _same("f", "s", [*KEYS, "rules"]) & (F.col("s.n") >= F.col("f.n")), "left_anti")

    def parse_new(self, pages: DataFrame, rules: DataFrame, run: str) -> int:
        """Parse what is new in ``pages`` (with ``fetch_date``, where the folder
        has it); the number of fetches. Repeating a run replaces its rows."""
        if "fetch_date" not in pages.columns:
            pages = pages.withColumn("fetch_date", F.to_date("fetched_at"))
        todo = written(self.new_fetches(pages, rules), "fetches")
        many = todo.count()
        if not many:
            return 0
        wanted = self.markup(pages, todo, many)
        fetched = wanted.select(*KEYS, "html", F.xxhash64("html").alias("tie")).join(sized(rules_state(rules)), "lang", "left")
        extract.extract_listing(fetched, rules).select(*LISTINGS.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/listing/run={run}")
        todo.select(*LEDGER.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/ledger/run={run}")
        return many

    def markup(self, pages: DataFrame, todo: DataFrame, many: int, limit: int = SMALL_ROWS) -> DataFrame:
        """The pages to parse: of the days of ``todo``, and of these the fetches in it. If
        they are too many to be broadcast the days are parsed whole, as then
        most of them is new and moving the markup would cost more."""
        days = [r[0] for r in todo.select("fetch_date").distinct().collect()]
        day = F.col("fetch_date")
        of_day = pages.where(day.isin([d for d in days if d is not None]) | (day.isNull() if None in days else F.lit(False)))
        rows = small_rows(todo.select(*KEYS), limit) if many <= limit else None
        if rows is None:
            return of_day
        keys = local_table(self.spark, rows, T.StructType([f for f in LEDGER if f.name in KEYS]))
        return of_day.alias("p").join(F.broadcast(keys).alias("k"), _same("p", "k", KEYS), "left_semi")

    def listing(self, rules: DataFrame) -> DataFrame:
        """``lang, url, next_link, cards`` of the newest fetch of every page,
        parsed by the rules as they are now."""
        rows = self._read("listing", LISTINGS)
        now = rows.alias("l").join(sized(rules_state(rules)).alias("r"), _same("l", "r", ["lang", "rules"]), "left_semi")
        return chain.latest_fetch(now.drop("rules"), ["lang", "url"], "tie").drop("fetched_at", "tie")
