"""Session construction and lineage helpers.

The builder only fills in settings that are still unset, so a cluster's own
``spark-defaults`` (executor sizing, ``spark.checkpoint.dir``, shuffle
partitions) always win.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; applied only when the session lacks them.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Sizing for ~100 TB inputs on ~1000 executors (``scale="large"``), again only
# where the cluster has not decided: 256 MB scan splits (~400k scan tasks),
# an upper bound of shuffle partitions that AQE coalesces towards 256 MB,
# and a skew threshold at which AQE splits a hot join partition.
_LARGE = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "32768",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    scale: str = "default",
) -> SparkSession:
    """Get or create a session; fill in the library's defaults where unset.

    ``master`` is only set when given (on a cluster the launcher sets it).
    ``shuffle_partitions`` and ``extra`` are explicit wishes and always
    applied; the defaults (and ``scale="large"`` sizing) never override a
    value the cluster or the caller already set.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    already = spark.conf.getAll
    wanted = dict(_DEFAULTS)
    if scale == "large":
        wanted.update(_LARGE)
    for key, value in wanted.items():
        if key not in already:
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared filesystem path and is used as
    is; if it is missing there, this raises rather than guess a
    machine-local folder. Only in local mode (tests) a private scratch
    folder is made when the setting is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        configured = fallback or tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and read it back.

    The data is written under ``spark.checkpoint.dir`` (shared storage on a
    cluster), so it survives executor loss, and the returned DataFrame is a
    plain file scan: its plan, statistics and constraints start afresh. (A
    ``Dataset.checkpoint()`` keeps the original plan's constraint set, which
    in a loop of window-heavy plans keeps growing.)
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tidemark-{uuid.uuid4().hex}"
    df.write.format(fmt).mode("errorifexists").save(path)
    return spark.read.format(fmt).load(path)
