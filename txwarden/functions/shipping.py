"""Make this package importable in the Python workers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once per application, so that it
    need not be installed on the workers."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    if root.is_dir():  # already a zip otherwise: the job was submitted with it
        folder = tempfile.mkdtemp(prefix="txwarden-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = shutil.make_archive(
            f"{folder}/{root.name}", "zip", root_dir=root.parent, base_dir=root.name
        )
        context.addPyFile(archive)
    _shipped.add(context.applicationId)
