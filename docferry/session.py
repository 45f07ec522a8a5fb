"""Spark session settings shared by tests, the bench and the driver entry.

On a cluster the session is created by the platform; ``tune`` only fills in
settings this library relies on and never overrides one that is already set.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()

# Settings results depend on: JSON documents with a repeated key keep the
# last value (as a JSON reader does) instead of failing to parse. Always set.
REQUIRED = {
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings the plans assume for speed, applied only where the session has not
# set them explicitly. AQE coalesces small shuffles, splits skewed join
# partitions and turns a join into a broadcast only when the runtime size of
# a side is below the broadcast threshold.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Ranks up to this one are limited before the shuffle (``items[5000]``).
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "docferry") -> SparkSession:
    """Local session for tests and the bench (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("DOCFERRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**DEFAULTS, **REQUIRED}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply REQUIRED, then DEFAULTS where the session's own configuration
    leaves them unset, and make sure a checkpoint directory exists (only set
    one when the cluster names none)."""
    for k, v in REQUIRED.items():
        spark.conf.set(k, v)
    explicit = dict(spark.sparkContext.getConf().getAll())
    for k, v in DEFAULTS.items():
        if k not in explicit and spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python workers, once for each
    application, as ``--py-files`` does; for sessions started without it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.join(tempfile.mkdtemp(prefix="docferry-"), "docferry.zip")
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared folder there; a private temp folder is only
    created for local runs (tests, bench) where the setting is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="docferry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local
