"""Python workers need this package: ship it with the session, as ``spark-submit --py-files`` would."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's modules to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).parent
    at = os.path.join(tempfile.mkdtemp(prefix="loomchain-"), "loomchain.zip")
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    context.addPyFile(at)
    _SHIPPED.add(context.applicationId)
