"""Sends this package to the executors of a session, so that their Python finds it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package's sources to the session's files, once for each application."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    _SHIPPED.add(spark.sparkContext.applicationId)
    top = Path(__file__).resolve().parent.parent
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="sievework-")), "sievework.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(top.rglob("*.py")):
            archive.write(source, str(source.relative_to(top.parent)))
    spark.sparkContext.addPyFile(path)
