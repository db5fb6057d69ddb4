"""Sources and sinks: bronze reads, catalog DDL, partitioned and keyed writes.

S1/S2 parquet scans, S3 missing-source guard, S4 catalog scan, S5 namespace
DDL, S6 idempotent table DDL, S7 partition layout, S8 idempotent append
(dynamic partition overwrite), S12-S14 views, S15 bronze writer.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.errors import SourceMissingError


def read_source(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """Read a bronze feed or a governance mapping (S1, S2) behind the S3 guard.

    Any failure to resolve the path (absent file, unreadable footer) becomes
    :class:`SourceMissingError`, which is also a ``FileNotFoundError``.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as exc:
        raise SourceMissingError(f"Cannot read {path}: {exc}") from exc


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan (S4), guarded like :func:`read_source`."""
    try:
        return spark.table(name)
    except AnalysisException as exc:
        raise SourceMissingError(f"Missing table {name}: {exc}") from exc


def create_namespace(spark: SparkSession, namespace: str) -> None:
    """``CREATE NAMESPACE IF NOT EXISTS`` (S5); safe to repeat."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    partition_by: Iterable[str] = (),
    bucket_by: tuple[int, str] | None = None,
    fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """Idempotent ``CREATE TABLE IF NOT EXISTS`` from a registered schema.

    Identity partitioning goes in ``partition_by`` (season, snapshot date,
    is_current); high-cardinality keys such as a match id belong in
    ``bucket_by`` instead, which avoids one directory per key.
    """
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}"
    parts = list(partition_by)
    if parts:
        ddl += " PARTITIONED BY (" + ", ".join(parts) + ")"
    if bucket_by is not None:
        n, col = bucket_by
        ddl += f" CLUSTERED BY ({col}) INTO {int(n)} BUCKETS"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Iterable[str] = (),
    fmt: str = "parquet",
) -> None:
    """Idempotent partitioned write.

    With ``partitionOverwriteMode=dynamic`` only the partitions present in
    ``df`` are replaced, so re-running a day's load rewrites that day instead
    of appending a second copy; partitions without rows in ``df`` stay (see
    :func:`write_partition`). Without partitions this is a full overwrite.
    """
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    parts = list(partition_by)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(path)


def write_partition(df: DataFrame, path: str, column: str, value: str, fmt: str = "parquet") -> None:
    """Replace the one partition ``column=value`` by ``df``, with an empty ``df`` too.

    For loads that know their partition: a rerun that finds nothing clears
    what an earlier run has left there.
    """
    df.write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/{column}={value}")


def save_table(
    df: DataFrame,
    name: str,
    partition_by: Iterable[str] = (),
    bucket_by: tuple[int, str] | None = None,
    fmt: str = "parquet",
) -> None:
    """Write ``df`` as a catalog table, replacing it (bucketed layout optional)."""
    writer = df.write.format(fmt).mode("overwrite")
    parts = list(partition_by)
    if parts:
        writer = writer.partitionBy(*parts)
    if bucket_by is not None:
        n, col = bucket_by
        writer = writer.bucketBy(int(n), col).sortBy(col)
    writer.saveAsTable(name)


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def _versions(spark: SparkSession, base: str) -> list[tuple[int, bool]]:
    """``(n, complete)`` for every ``v=<n>`` folder under ``base``."""
    fs, hbase = _fs_and_path(spark, base)
    if not fs.exists(hbase):
        return []
    out = []
    for status in fs.listStatus(hbase):
        name = status.getPath().getName()
        if not name.startswith("v="):
            continue
        try:
            n = int(name[2:])
        except ValueError:
            continue
        marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        out.append((n, bool(fs.exists(marker))))
    return out


def latest_version(spark: SparkSession, base: str) -> int | None:
    """Highest ``v=<n>`` folder under ``base`` holding a ``_SUCCESS`` marker."""
    done = [n for n, complete in _versions(spark, base) if complete]
    return max(done) if done else None


def read_latest(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame | None:
    """Read the newest complete version written by :func:`publish_version`."""
    v = latest_version(spark, base)
    if v is None:
        return None
    return spark.read.format(fmt).load(f"{base.rstrip('/')}/v={v}")


def publish_version(
    df: DataFrame, base: str, partition_by: Iterable[str] = (), fmt: str = "parquet"
) -> str:
    """Write a merged table state as a new immutable version folder.

    A merge reads the current version and writes the next one, so a job never
    reads and overwrites the same files; readers see the new state only once
    its ``_SUCCESS`` marker exists. A failed job leaves the old version live.
    """
    spark = df.sparkSession
    taken = [n for n, _ in _versions(spark, base)]  # incomplete folders too
    target = f"{base.rstrip('/')}/v={max(taken) + 1 if taken else 0}"
    writer = df.write.format(fmt).mode("errorifexists")
    parts = list(partition_by)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(target)
    return target


def register_views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
    """Expose DataFrames to SQL."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def run_view_script(spark: SparkSession, statements: Iterable[str]) -> None:
    """Run view definitions one statement at a time."""
    for stmt in statements:
        text = stmt.strip().rstrip(";").strip()
        if text:
            spark.sql(text)
