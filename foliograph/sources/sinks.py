"""Sinks: JSON lines, parallel corpora, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import space_out


def as_json(*columns: str) -> Column:
    """One JSON object of the columns; nulls are kept as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_records(df: DataFrame, path: str, mode: str = "append", legacy_comma: bool = False) -> None:
    """JSON lines of all columns; ``legacy_comma`` puts the comma of the old format after each."""
    line = as_json(*df.columns)
    df.select((F.concat(line, F.lit(",")) if legacy_comma else line).alias("value")).write.mode(mode).text(path)


def write_corpus(df: DataFrame, path: str, parts: int = 1) -> None:
    """image and target of regions as two text folders, aligned file by file and line by line.

    The rows are ordered and numbered once, in a table of their own; both
    folders are written from it with the same files.
    """
    spark = df.sparkSession
    rows = df.select("image", space_out(F.col("text")).alias("target")).repartitionByRange(parts, "image").sortWithinPartitions("image", "target")
    rows.write.parquet(f"{path}/rows")
    files = sorted(r[0] for r in spark.read.parquet(f"{path}/rows").select(F.input_file_name()).distinct().collect())
    for k, f in enumerate(files):
        part = spark.read.parquet(f).coalesce(1)
        part.select("image").write.text(f"{path}/src/{k:05d}")
        part.select(F.coalesce("target", F.lit(""))).write.text(f"{path}/tgt/{k:05d}")


def accuracy_report(df: DataFrame, file: str, expected: str, predicted: str) -> tuple[DataFrame, DataFrame]:
    """The report of a recognition run: one row for each label with accuracy and explanation, and the summary."""
    from ..operators import quality

    detail = df.select(F.col(file).alias("file"), F.col(predicted).alias("predicted"), F.col(expected).alias("ground_truth"), quality.char_accuracy(expected, predicted).alias("acc_by_char"), quality.difference(expected, predicted).alias("explanation"))
    return detail, quality.summary(detail, F.col("acc_by_char"))


def write_results(df: DataFrame, path: str, failed: Column, result: list[str]) -> None:
    """JSON lines of results in the order of their rows; a failed one stays as a null result."""
    df.select(F.when(failed, F.lit("null")).otherwise(as_json(*result)).alias("value")).write.text(path)


def column_widths(df: DataFrame) -> DataFrame:
    """column, width: the longest value of each column of a report."""
    wide = df.agg(*[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in df.columns])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("width")) for c in df.columns])).alias("x")).select("x.*")
