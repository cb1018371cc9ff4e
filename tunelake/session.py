"""Session defaults for tests/bench and the shared scratch location.

Library code never builds or stops a session (a long-lived session is shared by
many jobs). ``local_session`` exists only for tests, the bench and the examples.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tunelake") -> SparkSession:
    """A local session with the settings the tests and the bench rely on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # runtime join choice, both size-checked by AQE from shuffle statistics:
        # broadcast a side only below 4 MB; turn a sort-merge join into a
        # shuffled hash join only when every partition's build side is < 64 MB
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "4MB")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by whoever launches the job (a folder every
    executor can reach); if it is unset there, this fails instead of falling
    back to a folder on the driver's disk. Only in local mode (tests) an unset
    root gets a private folder, so lineage cuts and stream checkpoints still
    have a home.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if root:                      # the cluster's setting; no SparkContext needed
        return root.rstrip("/")
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"{_CHECKPOINT_KEY} is not set: point it at a folder every "
                               "executor can reach (scratch tables, lineage cuts and stream "
                               "checkpoints live there)")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tunelake-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession, default: int = 200) -> int:
    """``spark.sql.shuffle.partitions`` as a number (``default`` when it is not
    a plain number, e.g. ``auto`` on some platforms)."""
    value = spark.conf.get("spark.sql.shuffle.partitions", str(default))
    return int(value) if value.isdigit() else default
