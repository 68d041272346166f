"""Hand the package to the executors' Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, once per application, by Spark's own file distribution."""
    context = spark.sparkContext
    if context.applicationId not in SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        SHIPPED.add(context.applicationId)
