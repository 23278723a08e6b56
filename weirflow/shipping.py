"""Sends this package to the executors, so that they need not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Once for each application: adds the package's archive to what Spark gives every Python worker."""
    spark = spark or SparkSession.getActiveSession()
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="weirflow-")) / f"{top.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
