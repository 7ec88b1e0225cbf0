"""Making this package importable in the Python workers of every executor."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(of: SparkSession | DataFrame) -> None:
    """Send the package to the workers, once an application."""
    spark = of.sparkSession if isinstance(of, DataFrame) else of
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tributary-"), "tributary_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, Path(_PACKAGE.name) / p.relative_to(_PACKAGE))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
