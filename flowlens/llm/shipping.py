"""The package's own modules for Python workers that cannot import it from where they run."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Hand the package to the session's workers through Spark, once per application."""
    context = spark.sparkContext
    if getattr(context, "_flowlens_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="flowlens-package-")
    context.addPyFile(shutil.make_archive(f"{folder}/flowlens", "zip", _PACKAGE.parent, _PACKAGE.name))
    context._flowlens_shipped = True
