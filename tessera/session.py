"""Session helpers: a local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tessera") -> SparkSession:
    """Local session with AQE on, UI off, UTC clock (tests and bench only)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make `tessera` importable on executors (Python UDF / mapInPandas workers).

    The package is zipped once per driver process and added with `addPyFile`,
    which Spark distributes to every executor.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-pyfiles-"), "tessera.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, names in os.walk(pkg):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(root, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, reading the cluster setting first.

    On a cluster `spark.checkpoint.dir` names a shared folder and is used as is.
    Only when nothing is configured (local tests) a private folder is created.
    """
    ship_package(spark)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
