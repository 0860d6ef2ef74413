"""Make this package importable on executors, wherever it isn't installed there."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _DONE:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="millrace-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    _DONE.add(sc.applicationId)
