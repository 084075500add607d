"""Session helpers: reading the input tables and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_foliograph_shipped", False):
        return
    root = Path(__file__).resolve().parent
    fd, name = tempfile.mkstemp(prefix="foliograph-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path(root.name) / p.relative_to(root))
    sc.addPyFile(name)
    sc._foliograph_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, as a lazy Parquet scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
