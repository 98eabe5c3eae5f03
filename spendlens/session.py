"""Session helpers.

Library code never creates a session; it takes one. ``local_session`` is for
tests and the bench script only.  ``checkpoint_dir`` reads the cluster's
``spark.checkpoint.dir`` and only falls back to a scratch folder when the
setting is absent (local runs).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "spendlens") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPENDLENS_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints / lineage cuts.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system) and must be
    set.  Only a local master (tests, bench) gets a scratch folder where it is unset.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not re.match(r"local(\[[^-]*\])?$", master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder (master {master})")
        current = tempfile.mkdtemp(prefix="spendlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current
