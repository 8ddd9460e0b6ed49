"""Session helpers: the configuration every job and test shares."""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "tramflow",
    driver_memory: str = "16g",
) -> SparkSession:
    """Local/test session with AQE, skew-join splitting, UTC and no UI.

    On a cluster the master and resources come from spark-submit; only the
    SQL settings below matter there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` (or one already set on the
    context) is used as is.  Only when neither exists and the master is local
    -- tests -- a fresh scratch folder is created and set; on a cluster that
    is an error, since executors do not share local folders.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions manage checkpoints server-side
        return configured or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not fallback and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = fallback or tempfile.mkdtemp(prefix="tramflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


@contextlib.contextmanager
def session_option(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set one session option for the duration of a block."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def shuffles_removed(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """A block whose actions remove their shuffle files when they end, not when the driver next collects garbage.

    For jobs of many actions, each of whose results is written or checkpointed.
    """
    return session_option(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
