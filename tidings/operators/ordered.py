"""Running values along an order inside keys of any size.

A plain window puts one key into one task. Here a key is cut into blocks of the
order column: each block is worked on by itself, and what it needs from the
blocks before it comes from one small row per block. No task ever holds more
than one block of rows, however hot the key is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 16_384


def _blocks(order: str, block: int) -> Column:
    return F.floor(F.col(order) / block).cast("long")


def running(df: DataFrame, keys: list[str], order: str, block: int,
            per_block, over_blocks, within, combine, out: str) -> DataFrame:
    """Running value of one expression.

    ``per_block`` aggregates a block, ``over_blocks`` combines earlier blocks
    over a window, ``within`` is the running value inside the block and
    ``combine(carry, within)`` joins the two. ``order`` must be integral and,
    together with the keys, spread: a block holds the rows of ``block`` values.
    """
    before = (Window.partitionBy(*keys).orderBy("__block")
              .rowsBetween(Window.unboundedPreceding, -1))
    inside = (Window.partitionBy(*keys, "__block").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    blocked = df.withColumn("__block", _blocks(order, block))
    carry = (blocked.groupBy(*keys, "__block").agg(per_block.alias("__part"))
             .select(*keys, "__block", over_blocks(F.col("__part")).over(before).alias("__carry")))
    return (blocked.join(carry, [*keys, "__block"])
            .withColumn(out, combine(F.col("__carry"), within.over(inside)))
            .drop("__block", "__carry"))


def row_number(df: DataFrame, keys: list[str], order: str, out: str, block: int = BLOCK) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` for hot keys."""
    return running(df, keys, order, block, F.count(F.lit(1)), F.sum, F.count(F.lit(1)),
                   lambda carry, n: F.coalesce(carry, F.lit(0)) + n, out)


def running_max(df: DataFrame, keys: list[str], order: str, value: Column, out: str,
                block: int = BLOCK) -> DataFrame:
    """``max(value) over (partition by keys order by order)``, NULLs skipped."""
    return running(df, keys, order, block, F.max(value), F.max, F.max(value),
                   lambda carry, m: F.greatest(carry, m), out)
