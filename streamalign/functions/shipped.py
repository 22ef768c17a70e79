"""The package itself, for executors that run its Python functions."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once per application, in case it isn't installed there."""
    context = spark.sparkContext
    package = Path(__file__).resolve().parent.parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    file = os.path.join(tempfile.mkdtemp(prefix="spark-"), f"{package.name}.zip")
    with zipfile.ZipFile(file, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(file)
    _shipped.add(context.applicationId)
