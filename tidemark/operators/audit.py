"""Write, audit, publish: gates whose counters ride on the write itself.

The payloads are read and parsed once. Counters are observed on the parsed
payloads while their rows are written to the shared folder; the rows are
handed on only when the audit passes, and deleted when it raises.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from tidemark.session import ensure_checkpoint_dir


def drop_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_audited(
    parsed: DataFrame,
    counters: dict[str, Column],
    rows: Callable[[DataFrame], DataFrame],
    audit: Callable[[dict], None],
) -> DataFrame:
    """``rows(parsed)`` as a stored table, once ``audit`` has accepted the counters.

    ``counters`` are aggregates over ``parsed``; ``audit`` gets their values and
    raises to refuse. A task that Spark repeats may count its rows again, so
    counters say whether there is a violation, and how many at least roughly.
    """
    spark = parsed.sparkSession
    seen = Observation()
    out = rows(parsed.observe(seen, *[c.alias(name) for name, c in counters.items()]))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/audited-{uuid.uuid4().hex}"
    out.write.parquet(path)
    try:
        audit(seen.get)
    except Exception:
        drop_folder(spark, path)
        raise
    return spark.read.schema(out.schema).parquet(path)
