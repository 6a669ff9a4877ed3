"""Session helpers: shipping the package to workers and local sessions for tests."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent


def ship_package(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers of this application (once per content)."""
    files = sorted(p for p in PACKAGE.rglob("*.py"))
    digest = hashlib.sha256()
    for p in files:
        digest.update(p.read_bytes())
    name = f"geoloom_{digest.hexdigest()[:12]}.zip"
    sc = spark.sparkContext
    if any(entry.endswith(name) for entry in getattr(sc, "_python_includes", [])):
        return spark
    archive = Path(tempfile.mkdtemp(prefix="geoloom-")) / name
    with zipfile.ZipFile(archive, "w") as out:
        for p in files:
            out.write(p, p.relative_to(PACKAGE.parent).as_posix())
    sc.addPyFile(str(archive))
    return spark


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own configuration."""
    os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("geoloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Small local inputs: keep all cores busy although partitions are tiny.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "localhost")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return ship_package(spark)
