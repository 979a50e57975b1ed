"""Session helpers: shared work folder, checkpoints and size-checked small tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings the jobs are written for. Parallelism is left to AQE: it starts from
# many shuffle partitions and merges the small ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Pages are large rows: keep the Arrow batches sent to Python small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}

# Bytes of an Arrow batch of pages or documents.
PAGE_BATCH = 2 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# A table counts as small when it holds at most this many rows of keys and
# numbers (some MB); larger ones are joined by shuffle.
SMALL_ROWS = 100_000


def builder(app: str = "tidings") -> SparkSession.Builder:
    """A session builder carrying the settings the jobs expect."""
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def page_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches to ``PAGE_BATCH`` bytes.

    A worker that reads markup or texts holds a batch several times over, as markup, as values
    and packed again. Up to 10,000 rows, Spark's bound, are small batches of numbers, but
    hundreds of MB of pages, and of documents tens. Spark looks the bound up when a plan runs, so it is set
    for the session; a lower one stays.
    """
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(BATCH_BYTES).strip().lower()).groups()
    if int(number) << 10 * " kmgtp".index(unit or " ") > PAGE_BATCH:
        spark.conf.set(BATCH_BYTES, str(PAGE_BATCH))


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidings-"))
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{work_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with a reliable checkpoint."""
    sc, root = df.sparkSession.sparkContext, work_root(df.sparkSession)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return df.checkpoint()


def local_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A small table that is part of the plan: the optimizer sees its size, and
    reading it starts no Python task (a list of rows would)."""
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [[] for _ in schema]
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def small_rows(df: DataFrame, limit: int = SMALL_ROWS) -> list | None:
    """The rows of ``df`` if there are at most ``limit``, else None."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def sized(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Evaluate ``df`` once; broadcast it only when it proves to be small.

    Up to ``limit`` rows the result becomes a local table with a broadcast
    hint. Beyond that nothing is dropped: the table is checkpointed and joined
    by an ordinary shuffle, where AQE splits hot keys.
    """
    rows = small_rows(df, limit)
    return cut(df) if rows is None else F.broadcast(local_table(df.sparkSession, rows, df.schema))


def written(df: DataFrame, name: str) -> DataFrame:
    """Compute once into a Parquet table in the shared folder. Unlike after a
    checkpoint, later reads touch only the columns and row groups they need."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class folder:
    """Names below a folder on any storage Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._path = lambda name="": jvm.org.apache.hadoop.fs.Path(f"{root}/{name}" if name else root)
        self._fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        if not self._fs.exists(self._path()):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path())]

    def has(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
