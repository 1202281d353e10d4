"""Evidence tables on Spark: record audit, context joins, summaries, contracts and releases."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once, so that operators work from any folder and on any cluster."""
    name = spark.sparkContext.applicationId
    if name in _SHIPPED:
        return
    _SHIPPED.add(name)
    here, made = Path(__file__).resolve().parent, Path(tempfile.mkdtemp(prefix="spark-")) / "rillstone.zip"
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as out:
        for f in sorted(here.rglob("*.py")):
            out.write(f, f.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(made))
