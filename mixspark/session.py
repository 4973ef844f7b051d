"""Getting the package to the executors."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package along with the job, unless Python workers find it on their path."""
    root, app = str(PACKAGE.parent), spark.sparkContext.applicationId
    paths = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in paths or os.getcwd() == root or app in _shipped:
        return
    packed = shutil.make_archive(f"{tempfile.mkdtemp(prefix='package-')}/{PACKAGE.name}", "zip", root, PACKAGE.name)
    spark.sparkContext.addPyFile(packed)
    _shipped.add(app)
