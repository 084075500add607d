"""Helpers shared by the text operators."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table, as a lazy Parquet scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; in local mode, where one machine is all there is, a folder of its own if that is unset."""
    have = spark.conf.get("spark.checkpoint.dir", None)
    if not have:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        have = os.path.join(tempfile.gettempdir(), f"foliograph-checkpoint-{os.getuid()}")
    return have


def spread(df: DataFrame) -> DataFrame:
    """``df`` on all cores: a scan of fewer partitions than cores (small or single files) is dealt out, others stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def distinct_values(values: list[str | None], fn: Callable[[str], object]) -> list:
    """``fn`` of each value, called once per distinct non-null value of the batch."""
    memo: dict[str | None, object] = {None: None}
    out = []
    for v in values:
        if v not in memo:
            memo[v] = fn(v)
        out.append(memo[v])
    return out


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Arrow batch in, Arrow batch out; a batch may give nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (r := fn(b)) is not None:
                yield r

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, fn: Callable[[str], bool], text: str, ids: list[str]) -> DataFrame:
    """Rows whose ``text`` satisfies ``fn`` (decided once per distinct value of a batch); only ``ids`` remain."""
    src = df.select(*ids, text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != text)

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        hit = distinct_values(b.column(len(ids)).to_pylist(), fn)
        return b.select(ids).filter(pa.array([bool(x) for x in hit]))

    return map_batches(src, one, schema)


def java_class(keep: Callable[[int], bool], low: int = 0, high: int = 0xFFFF) -> str:
    """The body of a regex character class with all code points of [low, high] that ``keep`` accepts."""
    out, start = [], None
    for cp in range(low, high + 2):
        ok = cp <= high and not 0xD800 <= cp <= 0xDFFF and keep(cp)
        if ok and start is None:
            start = cp
        elif not ok and start is not None:
            out.append(f"\\x{{{start:X}}}" if start == cp - 1 else f"\\x{{{start:X}}}-\\x{{{cp - 1:X}}}")
            start = None
    return "".join(out)


_written: list[tuple[SparkSession, str]] = []


def shared_table(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder and read back; removed when the application ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/foliograph-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _written:
        atexit.register(_remove)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _remove() -> None:
    for spark, path in _written:
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session may be gone already
            pass
