"""Batches of similar width, and even sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ratio_batches(items: DataFrame, group: list[str], ratio: str, idx: str, step: float = 0.4, most: int = 32) -> DataFrame:
    """``group``, ``idx``, ``batch``: a new batch begins if the last is full or the ratio exceeds its first by ``step``.

    The fold runs over the sorted rows of one group, which must be of bounded
    size (lines of a page); the width of a batch is that of its last member.
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col(ratio).cast("double").alias("r"), F.col(idx).alias("i"))))
    kind = "struct<batch:int,n:int,pivot:double,out:array<struct<i:{0},batch:int,r:double>>>".format(items.schema[idx].dataType.simpleString())
    zero = F.struct(F.lit(-1).alias("batch"), F.lit(0).alias("n"), F.lit(None).cast("double").alias("pivot"), F.array().alias("out")).cast(kind)

    def step_(acc, x):
        new = acc["pivot"].isNull() | (acc["n"] >= most) | (x["r"] - acc["pivot"] >= step)
        b = F.when(new, acc["batch"] + 1).otherwise(acc["batch"])
        return F.struct(b.alias("batch"), F.when(new, F.lit(1)).otherwise(acc["n"] + 1).alias("n"), F.when(new, x["r"]).otherwise(acc["pivot"]).alias("pivot"), F.concat(acc["out"], F.array(F.struct(x["i"].alias("i"), b.alias("batch"), x["r"].alias("r")))).alias("out")).cast(kind)

    # a group is the lines of one page; a larger one has no place in one row
    folded = items.groupBy(*group).agg(F.aggregate(rows, zero, step_)["out"].alias("o"))
    return folded.select(*group, F.explode("o").alias("o")).select(*group, F.col("o.i").alias(idx), F.col("o.batch").alias("batch"))


def batch_widths(batches: DataFrame, group: list[str], width: str, idx: str) -> DataFrame:
    """``group``, ``idx``, ``batch``, ``padded``: each batch is as wide as its widest member; rows in the order of ``idx`` again."""
    w = Window.partitionBy(*group, "batch")
    return batches.select(*group, idx, "batch", F.max(width).over(w).alias("padded"))


def one_of(rows: DataFrame, seed: int = 0) -> DataFrame:
    """One row drawn evenly, the same for a seed."""
    return rows.orderBy(F.rand(seed)).limit(1)


def even_sample(rows: DataFrame, group: str, order: list[str], k: int = 10) -> DataFrame:
    """``k`` evenly spaced rows of each group, with their place ``slot``; short groups repeat rows."""
    n = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    slots = n.select(group, F.explode(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.struct(i.alias("slot"), F.bround(i * (F.col("n") - 1) / (k - 1), 0).cast("int").alias("at")))).alias("s"))
    numbered = rows.withColumn("at", F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1)
    return slots.select(group, "s.slot", "s.at").join(numbered, [group, "at"])
