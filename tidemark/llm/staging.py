"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, which every executor shares."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows sent to a Python worker together by stages that read whole texts: some
#: megabytes at a usual length, where Spark's default of 10,000 is a hundred.
TEXT_BATCH_ROWS = 1000

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str = "stage", batch_rows: int | None = None, once: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage so that a lost executor costs only the reading of files, and
    gives the next join a plain scan on that side, which adaptive execution
    can split when one key holds many rows. ``batch_rows`` bounds the rows of
    an Arrow batch while this table is written; ``once`` says that nothing
    else reads ``df``, so the shuffle files of the write go with its end and
    not with the driver's next garbage collection. The session's settings are
    put back afterwards.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    wanted = ({} if batch_rows is None else {_BATCH_ROWS: str(batch_rows)}) | ({_DROP_SHUFFLES: "true"} if once else {})
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        return stage_at(df, path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def stage_at(df: DataFrame, path: str) -> DataFrame:
    if (open_scope := _scope.get()) is not None:
        open_scope.paths.add(path)
    df.write.mode("errorifexists").parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made._staged_path = path
    return made


class Scope:
    """Staged tables of a stretch of work."""

    def __init__(self) -> None:
        self.paths: set[str] = set()
        self.kept: set[str] = set()

    def keep(self, *tables: DataFrame) -> None:
        """Tables that the result still reads."""
        self.kept |= {t._staged_path for t in tables}


_scope: ContextVar[Scope | None] = ContextVar("staging_scope", default=None)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Scope]:
    """Tables staged inside are deleted at the end, but for those that are kept.

    Kept ones belong to the surrounding scope, if any. After an error all stay
    for a look.
    """
    outer, scope = _scope.get(), Scope()
    token = _scope.set(scope)
    try:
        yield scope
    finally:
        _scope.reset(token)
    for path in scope.paths - scope.kept:
        discard(spark, path)
    if outer is not None:
        outer.paths |= scope.kept & scope.paths


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that no later step reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
