"""Sessions, and the way the package reaches the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Gives the executors' Python workers this package, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        fd, path = tempfile.mkstemp(suffix="-lectern.zip")
        with os.fdopen(fd, "wb") as out, zipfile.ZipFile(out, "w") as pack:
            for p in sorted(root.rglob("*.py")):
                pack.write(p, str(p.relative_to(root.parent)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, name: str = "lectern", **conf: str) -> SparkSession:
    """A session for one machine: UTC, adaptive execution, as many shuffle partitions as asked for."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)
