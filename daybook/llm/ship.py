"""Python workers import this package by name; its source goes with the job, as --py-files would send it."""

from __future__ import annotations

import tempfile
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import SparkSession


@lru_cache(maxsize=None)
def _ship(application: str, spark: SparkSession) -> None:
    top = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="daybook-")) / "daybook.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(target))


def ship(spark: SparkSession) -> None:
    """Once for each application."""
    _ship(spark.sparkContext.applicationId, spark)
