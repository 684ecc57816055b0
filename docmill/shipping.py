"""The package's own code on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of an application, once; they need no path to the repository then."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    _sent.add(app)
    root = Path(__file__).resolve().parent
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="docmill-code-")), "docmill_code.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(target)
