"""Session defaults, and shipping of this package to executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(app: str = "quire", **conf: str) -> SparkSession:
    """A session with UTC, adaptive execution and Arrow; whatever the cluster or the caller sets wins."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Make the package importable on executors, wherever the driver found it. Once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_quire_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="quire-ship-")) / "quire_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, str(Path(root.name) / path.relative_to(root)))
    sc.addPyFile(str(target))
    sc._quire_shipped = True
