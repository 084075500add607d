"""Recognised lines arriving as files: markers as they come, counts per minute of event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_marker


def stream_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stream of Parquet files of recognised lines."""
    return spark.readStream.schema(schema).parquet(path)


def marker_stream(lines: DataFrame) -> DataFrame:
    """Lines that begin an exercise; rows delivered twice within an hour of event time come once."""
    t = lines.withColumn("at", F.col("recognized_at").cast("timestamp"))
    return t.withWatermark("at", "1 hour").dropDuplicatesWithinWatermark(["ocr_id"]).where(is_marker(F.col("prediction"))).select("ocr_id", "doc", "page_idx", "idx", "at")


def marker_counts(lines: DataFrame, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Markers per window of event time; later rows than ``late`` are dropped by the watermark."""
    t = lines.withColumn("at", F.col("recognized_at").cast("timestamp")).withWatermark("at", late)
    return t.where(is_marker(F.col("prediction"))).groupBy(F.window("at", window)).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("begin"), "n")
