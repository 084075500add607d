"""Measures of recognition quality, and the page angle."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _matched(a: str, b: str) -> int:
    return sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks())


def accuracy(expected: str | None, predicted: str | None) -> float:
    """Mean share of matched characters of both texts; 1 for two empty texts, 0 for one.

    Blocks are those of the standard matcher with its rule for popular
    characters in texts of 200 characters and more, in either direction.
    """
    e, p = expected or "", predicted or ""
    if not e or not p:
        return float(e == p)
    return (_matched(e, p) / len(e) + _matched(p, e) / len(p)) / 2


def explain(expected: str | None, predicted: str | None) -> str:
    """What differs, a line for each: mistakes, excess and lost characters, with places in the predicted or the expected text."""
    e, p = expected or "", predicted or ""
    if not e and p:
        return "OCR no value field"
    named = {" ": "SPACE", "\n": "ENTER"}
    out = ""
    for op, a, b, c, d in SequenceMatcher(None, p, e).get_opcodes():
        had, want = (named.get(x, x) for x in (p[a:b], e[c:d]))
        if op == "replace":
            out += f"Mistake {want} -> {had}\n"
        elif op == "delete":
            out += f"Excess {had}(position {a})\n"
        elif op == "insert":
            out += f"Lost {want}(position {c})\n" if p else "Can not OCR"
    return out


@F.pandas_udf(T.DoubleType())
def char_accuracy(expected: pd.Series, predicted: pd.Series) -> pd.Series:
    """``accuracy`` in Arrow batches."""
    return pd.Series([accuracy(e, p) for e, p in zip(expected, predicted, strict=True)])


@F.pandas_udf(T.StringType())
def difference(expected: pd.Series, predicted: pd.Series) -> pd.Series:
    """``explain`` in Arrow batches."""
    return pd.Series([explain(e, p) for e, p in zip(expected, predicted, strict=True)])


def summary(rows: DataFrame, accuracy: Column, least: float = 0.7) -> DataFrame:
    """Mean accuracy, share of exact rows among all labels, and whether the mean passes the gate."""
    return rows.agg(F.count(F.lit(1)).alias("labels"), F.avg(accuracy).alias("mean_accuracy"), (F.count_if(accuracy == 1) / F.count(F.lit(1))).alias("exact_share")).withColumn("passed", F.coalesce(F.col("mean_accuracy") >= least, F.lit(False)))


def modal_angle(votes: DataFrame, group: str, angle: Column) -> DataFrame:
    """Minus the mean of the fullest 10-degree bin of each group; the first bin wins ties; angles from 80 on don't vote."""
    v = votes.select(group, angle.alias("a")).where("a >= -90 and a < 80").withColumn("bin", F.floor(F.col("a") / 10))
    bins = v.groupBy(group, "bin").agg(F.count(F.lit(1)).alias("n"), F.avg("a").alias("mean"))
    best = bins.withColumn("r", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), "bin"))).where("r = 1")
    return votes.select(group).distinct().join(best, group, "left").select(group, F.coalesce(-F.col("mean"), F.lit(0.0)).alias("angle"))
