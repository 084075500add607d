"""Scans: binary documents, aligned text files, annotation projects, page ranges."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import raster
from ..functions.text import base_name, strip
from ..operators.annotations import PROJECT


def read_documents(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """doc, path, length, content; the content column is only read by plans that use it."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return df.select(base_name(F.col("path")).alias("doc"), "path", "length", "content")


@F.pandas_udf(T.StringType())
def _unaccented(s: pd.Series) -> pd.Series:
    plain = lambda v: "".join(c for c in unicodedata.normalize("NFKD", v.replace("đ", "d").replace("Đ", "D")) if not unicodedata.combining(c))
    return s.map({None: None} | {v: plain(v) for v in s.dropna().unique()})


def media_kind(path: Column) -> Column:
    """Lower-case extension of a path without accents; only names with other letters than ASCII leave the JVM."""
    end = F.lower(F.element_at(F.split(path, r"\."), -1))
    return F.when(end.rlike(r"[^\x00-\x7F]"), _unaccented(end)).otherwise(end)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no, value of one text file of any size, numbered in file order.

    Splits of the file are read in parallel; a line's place is that of its
    split (``_metadata.file_block_start``) and its order in it.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"))
    n = lines.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = n.select("at", "first", (F.sum("n").over(Window.orderBy("at")) - F.col("n")).alias("before"))
    # one row for each split of the file, which is all that one task sums up
    return lines.join(F.broadcast(before), "at").select((F.col("id") - F.col("first") + F.col("before")).cast("long").alias("line_no"), "value")


def zip_lines(left: DataFrame, right: DataFrame, number: str = "line_no") -> DataFrame:
    """Rows with the same number on both sides (cut to the shorter), blank left ones dropped afterwards."""
    return left.join(right, number).where(strip(F.col("src")) != "")


def read_corpus(spark: SparkSession, directory: str) -> DataFrame:
    """line_no, src, tgt of a parallel corpus."""
    src = read_lines(spark, f"{directory}/src.txt").withColumnRenamed("value", "src")
    tgt = read_lines(spark, f"{directory}/tgt.txt").withColumnRenamed("value", "tgt")
    return zip_lines(src, tgt)


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    """Annotation projects, with a fixed schema."""
    return spark.read.option("multiLine", True).schema(PROJECT).json(path)


def number_rows(df: DataFrame, key: list[str], order: list[str], name: str = "line_no", span: int = 1 << 16) -> DataFrame:
    """Positions within groups, for positional alignment.

    A group of any size is numbered in parts, if one whole-number column orders
    it: rows are counted for each ``span`` of that column, the counts summed
    up, and rows numbered within their span.  Nulls of that column come first.
    """
    if len(order) != 1 or not isinstance(df.schema[order[0]].dataType, T.IntegralType):
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1)
    parts = df.withColumn("__p", F.coalesce(F.floor(F.col(order[0]) / span), F.lit(-(1 << 62))))
    n = parts.groupBy(*key, "__p").agg(F.count(F.lit(1)).alias("__n"))
    before = n.withColumn("__b", F.sum("__n").over(Window.partitionBy(*key).orderBy("__p")) - F.col("__n")).drop("__n")
    own = parts.withColumn("__r", F.row_number().over(Window.partitionBy(*key, "__p").orderBy(*order)) - 1)
    same = [own[k].eqNullSafe(before[k]) for k in [*key, "__p"]]
    both = own.join(before, same).select(*[own[c] for c in df.columns], (F.col("__r") + F.col("__b")).alias(name))
    return both


def read_images(paths: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Rows of readable pictures: portable pixmaps are decoded to height, width, channels and pixels; what can't be read is left out, as unreadable files are."""
    fields = paths.select(path, content)

    def run(frames):
        for f in frames:
            rows = [(p, *img.shape, img.tobytes()) for p, c in zip(f.iloc[:, 0], f.iloc[:, 1], strict=True) if (img := raster.decode_pixmap(c)) is not None]
            yield pd.DataFrame(rows, columns=["path", "height", "width", "channels", "pixels"])

    return fields.mapInPandas(run, "path string, height int, width int, channels int, pixels binary")


#: Errors of video input: no such kind of input, and content that can't be decoded.
E_KIND, E_DECODE = "E812", "E814"


def with_media_error(df: DataFrame, path: str, decoded: Column, kinds: tuple[str, ...] = ("mp4", "avi", "mov", "mkv")) -> DataFrame:
    """``kind``, ``err_code`` and ``err_msg`` of media rows; rows with an error stay."""
    kind = media_kind(F.col(path))
    code = F.when(F.col(path).isNull() | ~kind.isin(*kinds), F.lit(E_KIND)).when(~decoded, F.lit(E_DECODE))
    message = F.when(code == E_KIND, F.lit("Input video can not be None")).when(code == E_DECODE, F.concat(F.lit("The input video is not in true format of "), kind))
    return df.withColumns({"kind": kind, "err_code": code, "err_msg": message})
