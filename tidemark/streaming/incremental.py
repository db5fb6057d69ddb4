"""Incremental SCD2 loading with Structured Streaming.

An append-only event log (files landing in a folder) drives the history:

1. ``readStream`` the raw events;
2. a watermarked, windowed streaming aggregation keeps the last state per
   key and day (``max_by`` over ``(ts, tiebreak)``) in the state store, so a
   late event inside the watermark still corrects its day;
3. ``foreachBatch`` applies the updated (key, day) rows to the current
   history and its witnesses with :func:`scd2_apply_late` and publishes both as
   the next immutable versions, so days may arrive in any order.

Replays are safe: re-applying a batch to a history that already contains it
is a no-op, so an epoch retried after a failure, also one that has published
the history but not yet its witnesses, ends in the same state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.exprs import OPEN_END
from tidemark.operators.scd2 import scd2_apply_late
from tidemark.session import cut_lineage
from tidemark.sources.io import publish_version, read_latest


def daily_states(events: DataFrame, keys: Sequence[str], ts_col: str, state_cols: Sequence[str],
                 tiebreak: Sequence[str] = (), watermark: str = "7 days") -> DataFrame:
    """Streaming last-state-per-(key, day) with a watermark on ``ts_col``."""
    order = F.struct(F.col(ts_col), *[F.col(t) for t in tiebreak])
    state = F.struct(*[F.col(c) for c in state_cols])
    # Event-time operators need TIMESTAMP (with session time zone); a
    # TIMESTAMP_NTZ column is read as wall-clock time in that zone.
    timed = events.withColumn("_ets", F.col(ts_col).cast("timestamp"))
    agg = (
        timed.withWatermark("_ets", watermark)
        .groupBy(*keys, F.window("_ets", "1 day").alias("_day"))
        .agg(F.max_by(state, order).alias("_s"))
    )
    return agg.select(
        *keys,
        *[F.col(f"_s.{c}").alias(c) for c in state_cols],
        F.to_date(F.col("_day.start")).alias("effective_date"),
    )


def start_scd2_stream(
    spark: SparkSession,
    source_path: str,
    source_schema: StructType,
    history_base: str,
    checkpoint_location: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts_col: str,
    tiebreak: Sequence[str] = (),
    watermark: str = "7 days",
    available_now: bool = True,
    source_format: str = "parquet",
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what exists and stops.

    The witnesses, days that repeated the running state, lie beside the history
    under ``<history_base>_witnesses``. Limit: events later than ``watermark``
    are dropped by the stream. Dates are DATE columns.
    """
    raw = spark.readStream.format(source_format).schema(source_schema).load(source_path)
    per_day = daily_states(raw, keys, ts_col, tracked, tiebreak, watermark)
    witness_base = f"{history_base.rstrip('/')}_witnesses"

    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        # The micro-batch is read several times below: written once to the shared
        # folder, it is a plain table, free of the streaming plan's state operators.
        states = cut_lineage(batch)
        if states.isEmpty():
            return
        current, seen = read_latest(spark, history_base), read_latest(spark, witness_base)
        if current is not None:
            current = current.drop("is_current")
        history, witnesses = scd2_apply_late(current, seen, states, list(keys), list(tracked))
        publish_version(history.withColumn("is_current", F.col("valid_to") == F.lit(OPEN_END)), history_base)
        publish_version(witnesses, witness_base)

    writer = (
        per_day.writeStream.outputMode("update")
        .foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
