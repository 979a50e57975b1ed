"""Approximate nearest neighbours: NN-descent and greedy search of its graph.

The graph holds for every vector its ``K`` most similar ones found so far. It
starts from blocks: vectors are sorted by their nearest pivot (of a bounded
sample) and a projection, and compared within consecutive blocks, a few times
over. Then it is refined: around every vector its neighbours, and those that
have it as neighbour, are joined and compared with each other, and each keeps
what is better than its worst neighbour, until few change. Queries walk the
graph: the best vectors found so far are expanded until all of them have been.
Graph, walk and results all use the double-precision cosine of the original
vectors: a node's code is its vector unrounded (four bytes a component where
the column holds floats, else eight), so that near copies, whose cosines differ
by little, are ranked as in the result.

All vectors are in the index. Equal vectors are one node and come back as
each of their ids, so a vector that a third of the rows hold costs no more
than another. A vector is joined with at most ``K`` of those that have it as
neighbour (the most similar), as is usual: this bounds the work at hubs and
decides only which candidates are met, as the whole method is approximate.

Defined cases: vectors that are null, zero, hold null or non-finite
components, or have another length than most, take no part; equal scores go
to the smaller id; rows that repeat id and vector count once; fewer candidates
than asked for are all returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.session import written

K = 32
BLOCK = 256
PIVOTS = 256
ROUNDS = 4
ITERATIONS = 6
# Share of neighbours that must change for another iteration.
LEAST_CHANGE = 0.01
BEAM = 128
# New neighbours that one neighbourhood offers to each of its members; what it
# holds back is offered by another one or in the next iteration.
LOCAL = 16
# Neighbourhoods that one numpy step reads.
STEP = 256
PART = "u long, v long, s double"


def valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part, each once."""
    v = F.col(vec_col).cast("array<double>")
    fine = (F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    rows = df.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("vec") == (sizes[0] if sizes else 0)).distinct()


def _unit(column) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in column])
    # Scaled first, so that the norm of very large or small vectors is finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def kind_of(df: DataFrame, vec_col: str) -> str:
    """The number type of codes that hold the column's vectors unrounded."""
    return "f4" if isinstance(df.schema[vec_col].dataType.elementType, T.FloatType) else "f8"


def _unpacked(rows: Iterable[bytes], kind: str) -> np.ndarray:
    """Unit vectors of the codes, one row each."""
    rows = list(rows)
    return _unit(np.frombuffer(b"".join(rows), dtype=kind).reshape(len(rows), -1))


def _code(kind: str):
    @F.pandas_udf(T.BinaryType())
    def run(vec: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(v, dtype=kind).tobytes() for v in vec], dtype=object)
    return run("vec")


def _top(s: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None = None) -> pa.RecordBatch:
    """(u, v, s) of every row's ``k`` most similar others that are above its
    floor."""
    s = s.copy()
    np.fill_diagonal(s, -2)
    k = min(k, len(ids) - 1)
    best = np.argpartition(-s, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(ids), 0), dtype=np.int64)
    value = np.take_along_axis(s, best, axis=1)
    # One vector may stand twice in a block, in two rounds.
    keep = ids[best] != ids[:, None]
    if floor is not None:
        keep &= value > floor[:, None]
    row, col = np.nonzero(keep)
    return pa.RecordBatch.from_arrays([pa.array(ids[row], pa.int64()), pa.array(ids[best[row, col]], pa.int64()),
                                       pa.array(value[row, col].astype(np.float64))], names=["u", "v", "s"])


def _placed(pivots: np.ndarray, directions: np.ndarray, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unpacked(batch.column("code").to_pylist(), kind) if batch.num_rows else np.zeros((0, pivots.shape[2]))
            for t in range(len(pivots)):
                near = (x @ pivots[t].T).argmax(axis=1)
                along = x @ directions[t]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), batch.column("code"), pa.array(np.full(len(x), t, dtype=np.int32)),
                     pa.array(near.astype(np.int32)), pa.array(along.astype(np.float64))],
                    names=["node", "code", "t", "pivot", "along"])
    return run


def _blocks(k: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column("node").to_numpy(), None
            if len(ids):
                x = _unpacked(batch.column("code").to_pylist(), kind)
            for lo in range(0, len(ids), BLOCK):
                # A short rest is compared together with the block before it.
                lo = max(0, min(lo, len(ids) - BLOCK))
                part = slice(lo, lo + BLOCK)
                yield _top(x[part] @ x[part].T, ids[part], k)
    return run


def _around(local: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, STEP):
                found = []
                for row in batch.column("m").slice(lo, STEP).to_pylist():
                    ids = np.array([r["a"] for r in row], dtype=np.int64)
                    x = _unpacked((r["code"] for r in row), kind)
                    found.append(_top(x @ x.T, ids, local, np.array([r["floor"] for r in row])))
                yield from pa.Table.from_batches(found).combine_chunks().to_batches()
    return run


def _merged(parts: DataFrame, k: int) -> DataFrame:
    """The ``k`` best distinct candidates of every vector."""
    flat = parts.groupBy("u", "v").agg(F.max("s").alias("s"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))
    return flat.withColumn("rank", rank).where(F.col("rank") <= k).select("u", "v", "s")


def build(nodes: DataFrame, kind: str, k: int = K, iterations: int = ITERATIONS, seed: int = 1) -> DataFrame:
    """Edges (u, v, s) of the graph over ``nodes`` (node, code); ``kind`` is
    the codes' number type."""
    sample = nodes.orderBy(F.xxhash64("node")).limit(PIVOTS * ROUNDS).select("code").collect()
    if len(sample) < 2:
        return nodes.sparkSession.createDataFrame([], "u long, v long, s double")
    x = _unpacked((r[0] for r in sample), kind)
    draw = np.random.default_rng(seed)
    pivots = np.array([x[draw.choice(len(x), min(PIVOTS, len(x)), replace=False)] for _ in range(ROUNDS)])
    directions = draw.normal(size=(ROUNDS, x.shape[1]))
    placed = nodes.mapInArrow(_placed(pivots, directions, kind), "node long, code binary, t int, pivot int, along double")
    order = ["t", "pivot", "along", "node"]
    start = placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks(k, kind), PART)
    edges = written(_merged(start, k), "graph")
    for _ in range(iterations):
        back = edges.select(F.col("v").alias("c"), F.col("u").alias("a"), "s")
        rank = F.row_number().over(Window.partitionBy("c").orderBy(F.desc("s"), "a"))
        back = back.withColumn("rank", rank).where(F.col("rank") <= k).select("c", "a")
        floor = edges.groupBy("u").agg(F.min("s").alias("floor"), F.count("*").alias("n")).select(
            F.col("u").alias("a"), F.when(F.col("n") >= k, F.col("floor")).otherwise(F.lit(-2.0)).alias("floor"))
        known = nodes.select(F.col("node").alias("a"), "code").join(floor, "a", "left").fillna(-2.0, ["floor"])
        pairs = edges.select(F.col("u").alias("c"), F.col("v").alias("a")).union(back).distinct()
        # At most 2k members around a vector.
        around = pairs.join(known, "a").groupBy("c").agg(F.collect_list(F.struct("a", "code", "floor")).alias("m"))
        found = around.select("m").mapInArrow(_around(LOCAL, kind), PART)
        nxt = written(_merged(found.unionByName(edges), k), "graph")
        total = edges.count()
        same = nxt.join(edges.select("u", "v"), ["u", "v"], "left_semi").count()
        edges, done = nxt, total - same < LEAST_CHANGE * total
        if done:
            break
    return edges


def _near(a: str, b: str, kind: str):
    @F.pandas_udf(T.DoubleType())
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(np.einsum("ij,ij->i", _unpacked(x, kind), _unpacked(y, kind)) if len(x) else [], dtype=float)
    return run(a, b)


@F.pandas_udf(T.DoubleType())
def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(np.einsum("ij,ij->i", _unit(a), _unit(b)) if len(a) else [], dtype=float)


def walk(queries: DataFrame, starts: DataFrame, nodes: DataFrame, edges: DataFrame, kind: str,
         beam: int = BEAM) -> DataFrame:
    """(q, node) for the nodes found near each query (q, code) from its
    starting nodes (q, node): the ``beam`` best so far are expanded until all
    of them have been."""
    code = nodes.select("node", F.col("code").alias("other"))

    def scored(pairs: DataFrame) -> DataFrame:
        return pairs.join(code, "node").join(queries, "q").select("q", "node", _near("code", "other", kind).alias("s"))

    best = Window.partitionBy("q").orderBy(F.desc("s"), "node")
    seen = written(scored(starts.distinct()).withColumn("fresh", F.lit(True)), "beam")
    while True:
        open_ = seen.where("fresh")
        if open_.isEmpty():
            return seen.select("q", "node")
        reached = open_.select("q", F.col("node").alias("u")).join(edges.select("u", F.col("v").alias("node")), "u").select("q", "node").distinct()
        new = reached.join(seen.select("q", "node"), ["q", "node"], "left_anti")
        both = seen.withColumn("fresh", F.lit(False)).unionByName(scored(new).withColumn("fresh", F.lit(True)))
        seen = written(both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= beam).drop("rank"), "beam")


def search(vectors: DataFrame, wanted, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest to each row that
    meets ``wanted`` (a condition on ``id``), itself excluded."""
    rows = written(valid(vectors, id_col, vec_col), "vectors")
    groups = rows.groupBy("vec").agg(F.min("id").alias("node"))
    kind = kind_of(vectors, vec_col)
    nodes = written(groups.select("node", "vec", _code(kind).alias("code")), "nodes")
    # Of equal vectors the k + 1 smallest ids can be among the results.
    place = F.row_number().over(Window.partitionBy("node").orderBy("id"))
    owned = rows.join(nodes.select("node", "vec"), "vec").select("id", "node")
    members = written(owned, "members")
    few = members.withColumn("place", place).where(F.col("place") <= k + 1).select("node", F.col("id").alias("vec_id"))
    edges = build(nodes.select("node", "code"), kind)
    # Equal query vectors walk once, from their own node.
    asked = members.where(wanted)
    queries = asked.select(F.col("node").alias("q")).distinct()
    found = walk(queries.join(nodes.select(F.col("node").alias("q"), "code"), "q"),
                 queries.select("q", F.col("q").alias("node")), nodes.select("node", "code"), edges, kind)
    vec = nodes.select("node", "vec")
    exact = (found.join(vec, "node").join(vec.select(F.col("node").alias("q"), F.col("vec").alias("own")), "q")
             .select("q", "node", cosine("own", "vec").alias("score")))
    top = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    named = exact.join(few, "node").withColumn("place", F.row_number().over(top)).where(F.col("place") <= k + 1)
    by_query = named.join(asked.select(F.col("node").alias("q"), F.col("id").alias("query_id")), "q").where("vec_id <> query_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (by_query.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
