"""Session construction and shared scratch locations."""

from __future__ import annotations


import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every strata job relies on.  AQE re-plans joins from measured
# shuffle sizes (broadcast only when the runtime size is below the threshold,
# split skewed partitions of sort-merge joins) and coalesces small partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go when what was read from them is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the strata defaults.

    ``master`` is only set when given, so ``spark-submit`` keeps control of
    it on a cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The value comes from ``spark.checkpoint.dir`` (or a directory already set
    on the context).  Only when neither is set -- local runs and tests -- a
    fresh local folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared checkpoint directory.

    Used for data a job writes and reads back (landing areas, stream
    checkpoints, table versions) so that every executor sees it.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    name = "/".join(p.strip("/") for p in parts) if parts else "scratch"
    return f"{base}/strata/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold within the block only."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


__all__ = ["settings", "build_session", "ensure_checkpoint_dir", "scratch_path", "BASE_CONF"]

