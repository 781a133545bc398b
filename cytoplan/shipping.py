"""Sends this package to executors that cannot import it from their own path."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once an application."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="cytoplan-ship-")) / "cytoplan.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    sc.addPyFile(str(target))
    _sent.add(sc.applicationId)
