"""Session helpers.

The library never creates a session for a caller that already has one; the
builders here are for tests, the bench and the command line.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app_name: str = "tabulary") -> SparkSession:
    """A local session tuned for the test tables (UI off, AQE on, UTC)."""
    if shuffle_partitions is None:
        shuffle_partitions = 8 if str(cpus) == "*" else int(cpus)
    parts = shuffle_partitions
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.ansi.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    On a cluster the directory must be a shared folder named by
    ``spark.checkpoint.dir``; we read it from the session and never invent a
    machine-local one there.  Only a local-mode session (tests, bench) gets a
    fresh temporary folder when nothing is configured.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Connect session: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(dense keys cut lineage with reliable checkpoints)")
    path = tempfile.mkdtemp(prefix="tabulary-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
