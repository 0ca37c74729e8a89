"""This package's code on the executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path
from threading import Lock

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_one = Lock()


def ship(spark: SparkSession) -> None:
    """Hand this package's code to the Python workers of all executors, once an application."""
    context = spark.sparkContext
    with _one:
        if context.applicationId not in _shipped:
            package = Path(__file__).resolve().parents[1]
            name = f"{tempfile.mkdtemp()}/{package.name}"
            context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
            _shipped.add(context.applicationId)
