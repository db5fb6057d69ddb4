"""Slowly-changing type 2 histories.

:func:`scd2_apply` is the one canonical operator; the four loaders of
SURVEY D1-D4 are thin presets over it.

Semantics (half-open slices ``[valid_from, valid_to)``, at most one event
per key and effective date):

* an event inside an existing slice splits it: the slice ends at the event,
  the event's slice ends where the old one ended;
* an event whose state equals the state of the slice (or event) it lands in
  is a no-op — so re-applying a batch changes nothing;
* an event before a key's history (late arrival / backfill) closes where the
  next slice begins; an event after the last slice opens a new current one;
* several events for one key chain into consecutive slices;
* gaps between closed slices stay gaps, adjacent equal slices are not merged.

Plan: history rows of keys the batch touches, from the slice containing the
key's earliest event onward, are unioned with the batch and passed through
one window sort per key; all other history rows bypass the sort untouched.
Per key the window holds one row per distinct effective date (the slices
have distinct starts and the batch is gated to one event per key and date),
so its size is bounded by the calendar, not by the data volume. Event
streams are reduced to that grain first by :func:`latest_per_period`, a
partially-aggregated ``max_by`` that collapses even a hot key map-side.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from tidemark.errors import SCD2TimelineException
from tidemark.functions.exprs import OPEN_END
from tidemark.operators.asof import inside_closed
from tidemark.operators.gates import future_date_gate, scd2_batch_overlap_gate
from tidemark.operators.sizing import BROADCAST_MAX_ROWS, KEY_COLUMN_BYTES, broadcast_if_bounded, rows_within
from tidemark.session import cut_lineage

_OPEN_TS = _dt.datetime(9999, 12, 31)


def latest_per_period(
    events: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    state_cols: Sequence[str],
    tiebreak: Sequence[str] = (),
    period: str = "day",
    eff_col: str = "effective_date",
) -> DataFrame:
    """Reduce an event log to the last state per key and period (day by default).

    ``max_by`` over ``(ts, tiebreak...)`` is a declarative aggregate: the map
    side keeps one row per (key, day) before the shuffle.
    """
    if period == "day":
        eff = F.to_date(F.col(ts_col))
    else:
        eff = F.date_trunc(period, F.col(ts_col))
    order = F.struct(F.col(ts_col), *[F.col(t) for t in tiebreak])
    state = F.struct(*[F.col(c) for c in state_cols])
    out = (
        events.withColumn(eff_col, eff)
        .groupBy(*keys, eff_col)
        .agg(F.max_by(state, order).alias("_s"))
    )
    return out.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in state_cols], eff_col)


def _kind(df: DataFrame, name: str):
    return df.schema[name].dataType


def _open_literal(dtype) -> Column:
    if isinstance(dtype, (TimestampType,)):
        return F.lit(_OPEN_TS).cast("timestamp")
    if isinstance(dtype, TimestampNTZType):
        return F.lit(_OPEN_TS).cast("timestamp_ntz")
    return F.lit(OPEN_END)


def scd2_apply(
    history: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    eff_col: str = "effective_date",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    open_end=OPEN_END,
    current_col: str | None = None,
    carried: Sequence[str] = (),
    check_batch: bool = True,
    bypass: bool = True,
) -> DataFrame:
    """Apply a batch of state events to a history; returns the new history.

    ``tracked``: columns whose (null-safe) change opens a new slice.
    ``carried``: extra attributes stored with each slice but not compared.
    ``open_end``: sentinel for an open slice, or ``None`` for NULL ends.
    ``current_col``: also emit ``is_current``-style flag under that name.
    Date columns may be DATE, TIMESTAMP or ISO strings; strings come back as
    strings.
    ``check_batch``: run gate G4 (one event per key and effective date), which
    also bounds each key's window by its number of distinct dates; pass False
    when the batch comes from :func:`latest_per_period` (unique by construction).
    ``bypass``: history rows the batch cannot affect skip the window sort
    (the history is then read twice); ``False`` reads it once and sorts it
    all — better when most keys change, or inside loops.
    """
    attrs = [*tracked, *[c for c in carried if c not in tracked]]
    eff_type = _kind(batch, eff_col)
    as_string = isinstance(eff_type, StringType)
    if history is not None and isinstance(_kind(history, valid_from), StringType):
        as_string = True
    work_type = DateType() if as_string else eff_type
    if history is not None and not as_string:
        work_type = _kind(history, valid_from)
    OPEN = _open_literal(work_type)

    def norm(c: Column) -> Column:
        if as_string:
            return F.to_date(c)
        return c.cast(work_type)

    b = batch.select(
        *keys,
        *attrs,
        norm(F.col(eff_col)).alias("_vf"),
        F.lit(None).cast(work_type).alias("_vt"),
        F.lit(1).alias("_src"),
    )
    # One pass over the batch serves both the G4 gate (one event per key and
    # date) and the size check of the batch keys (one row per key, broadcast
    # when provably small so the history is not shuffled to find its
    # untouched rows).
    first_event = None
    if check_batch or (history is not None and bypass):
        per_key = (
            b.groupBy(*keys, "_vf")
            .agg(F.count(F.lit(1)).alias("_n"))
            .groupBy(*keys)
            .agg(F.max("_n").alias("_most"), F.min("_vf").alias("_first"))
        )
        stats = per_key.agg(F.max("_most").alias("most"), F.count(F.lit(1)).alias("nkeys")).first()
        if check_batch and stats["most"] is not None and stats["most"] > 1:
            raise SCD2TimelineException(
                f"Two events for one key on the same {eff_col} in the batch"
            )
        first_event = per_key.select(*keys, "_first")
        small = stats["nkeys"] <= min(BROADCAST_MAX_ROWS, rows_within(KEY_COLUMN_BYTES * (len(keys) + 1)))
    if history is None:
        h_aff = None
        h_keep = None
    else:
        h = history.select(
            *keys,
            *attrs,
            norm(F.col(valid_from)).alias("_vf"),
            F.coalesce(norm(F.col(valid_to)), OPEN).alias("_vt"),
            F.lit(0).alias("_src"),
        )
        if bypass:
            named = first_event.select(*[F.col(k).alias(f"_b_{k}") for k in keys], "_first")
            same = F.lit(True)
            for k in keys:  # null-safe, as the window's grouping is
                same = same & h[k].eqNullSafe(F.col(f"_b_{k}"))
            hj = h.join(F.broadcast(named) if small else named, same, "left").drop(*[f"_b_{k}" for k in keys])
            untouched = F.col("_first").isNull() | (F.col("_vt") <= F.col("_first"))
            h_keep = hj.filter(untouched).drop("_first")
            h_aff = hj.filter(~untouched).drop("_first")
        else:
            h_keep, h_aff = None, h

    u = b if h_aff is None else h_aff.unionByName(b)
    o = Window.partitionBy(*keys).orderBy("_vf", "_src")
    state = F.struct(*[F.col(c) for c in tracked])
    u = u.withColumn("_enc", F.last("_vt", ignorenulls=True).over(o.rowsBetween(Window.unboundedPreceding, -1)))
    u = u.withColumn(
        "_own",
        F.when(F.col("_src") == 0, F.col("_vt"))
        .when(F.col("_enc") > F.col("_vf"), F.col("_enc"))
        .otherwise(OPEN),
    ).withColumn("_state", state)
    noop = (
        (F.col("_src") == 1)
        & (F.lag("_own").over(o) > F.col("_vf"))
        & F.lag("_state").over(o).eqNullSafe(F.col("_state"))
    )
    u = u.withColumn("_noop", F.coalesce(noop, F.lit(False))).filter(~F.col("_noop"))
    u = u.withColumn("_end", F.least(F.col("_own"), F.coalesce(F.lead("_vf").over(o), OPEN)))
    u = u.filter(F.col("_vf") < F.col("_end")).select(*keys, *attrs, "_vf", F.col("_end").alias("_vt"))
    if h_keep is not None:
        u = h_keep.select(*keys, *attrs, "_vf", "_vt").unionByName(u)

    is_open = F.col("_vt") == OPEN
    if as_string:
        vf_out = F.date_format("_vf", "yyyy-MM-dd")
        vt_out = F.date_format("_vt", "yyyy-MM-dd")
    else:
        vf_out, vt_out = F.col("_vf"), F.col("_vt")
    if open_end is None:
        vt_out = F.when(~is_open, vt_out)
    elif not as_string and open_end != OPEN_END and open_end != _OPEN_TS:
        vt_out = F.when(is_open, F.lit(open_end).cast(work_type)).otherwise(vt_out)
    cols = [*[F.col(k) for k in keys], *[F.col(a) for a in attrs], vf_out.alias(valid_from), vt_out.alias(valid_to)]
    if current_col:
        cols.append(is_open.alias(current_col))
    return u.select(*cols)


def scd2_apply_many(
    history: DataFrame | None,
    batches,
    checkpoint_every: int = 4,
    **kwargs,
) -> DataFrame:
    """Apply a sequence of batches in order (e.g. a multi-day backfill).

    Each step reads the previous history once (``bypass=False``), so the
    plan grows by one step per batch; every ``checkpoint_every`` batches the
    history is materialised in the shared checkpoint folder
    (:func:`tidemark.session.cut_lineage`), which keeps plans short and
    bounds the recomputation after a lost executor.
    """
    if checkpoint_every < 1 or checkpoint_every > 8:
        raise ValueError("checkpoint_every must be between 1 and 8")
    kwargs.setdefault("bypass", False)
    state = history
    for i, batch in enumerate(batches, start=1):
        if state is not None and kwargs.get("current_col") and kwargs["current_col"] in state.columns:
            state = state.drop(kwargs["current_col"])
        state = scd2_apply(state, batch, **kwargs)
        if checkpoint_every and i % checkpoint_every == 0:
            state = cut_lineage(state)
    return state


def scd2_apply_late(
    history: DataFrame | None,
    witnesses: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    eff_col: str = "effective_date",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> tuple[DataFrame, DataFrame]:
    """D5 whatever the order of the batches: ``(history, witnesses)`` after ``batch``.

    An event that repeats the running state opens no slice, but it proves the
    state for its day: when an earlier day arrives later with another state,
    the history must change back there. Such events are kept as witness rows
    (keys, tracked, ``eff_col``). Loads in any order give the history of one
    load of all events.

    Only keys of the batch are rebuilt, from their first day in it: slices
    that ended before it and earlier witnesses pass by. Of two events for one
    key and day, the later load's counts; within a batch that is gate G4. The
    history must come from this function (or be empty): its slices follow one
    another without gaps, open ones end at ``OPEN_END``. Dates are DATE columns.
    """
    scd2_batch_overlap_gate(batch, keys, eff_col)
    first = batch.groupBy(*[F.col(k).alias(f"_b_{k}") for k in keys]).agg(F.min(eff_col).alias("_first"))
    first = broadcast_if_bounded(first)

    def with_first(df: DataFrame) -> DataFrame:
        same = F.lit(True)
        for k in keys:
            same = same & df[k].eqNullSafe(F.col(f"_b_{k}"))
        return df.join(first, same, "left").drop(*[f"_b_{k}" for k in keys])

    points = batch.select(*keys, *tracked, F.col(eff_col).alias("_at"), F.lit(1).alias("_src"))
    kept_slices = kept_witnesses = None
    if history is not None:
        h = with_first(history.select(*keys, *tracked, valid_from, valid_to))
        # A slice that ends on the first day may go on, if that day is corrected.
        passed = F.col("_first").isNull() | (F.col(valid_to) < F.col("_first"))
        kept_slices = h.filter(passed).drop("_first")
        points = points.unionByName(h.filter(~passed).select(*keys, *tracked, F.col(valid_from).alias("_at"), F.lit(0).alias("_src")))
    if witnesses is not None:
        w = with_first(witnesses.select(*keys, *tracked, eff_col))
        passed = F.col("_first").isNull() | (F.col(eff_col) < F.col("_first"))
        kept_witnesses = w.filter(passed).drop("_first")
        points = points.unionByName(w.filter(~passed).select(*keys, *tracked, F.col(eff_col).alias("_at"), F.lit(0).alias("_src")))

    # One row per key and day: at most the calendar's number of rows in a window.
    days = Window.partitionBy(*keys).orderBy("_at", "_src")
    points = points.withColumn("_next", F.lead("_at").over(days)).filter(~F.col("_next").eqNullSafe(F.col("_at")))
    points = points.withColumn("_state", F.struct(*tracked))
    marked = points.withColumn("_starts", ~F.coalesce(F.lag("_state").over(days).eqNullSafe(F.col("_state")), F.lit(False)) | (F.lag("_at").over(days).isNull()))
    marked = cut_lineage(marked.select(*keys, *tracked, "_at", "_starts"))
    later = Window.partitionBy(*keys).orderBy("_at")
    slices = marked.filter("_starts").select(
        *keys, *tracked, F.col("_at").alias(valid_from), F.coalesce(F.lead("_at").over(later), F.lit(OPEN_END)).alias(valid_to)
    )
    seen = marked.filter("not _starts").select(*keys, *tracked, F.col("_at").alias(eff_col))
    return (
        slices if kept_slices is None else kept_slices.unionByName(slices),
        seen if kept_witnesses is None else kept_witnesses.unionByName(seen),
    )


def scd2_rebuild(events: DataFrame, **kwargs) -> DataFrame:
    """Order-independent rebuild: the whole event log applied to an empty history."""
    return scd2_apply(None, events, **kwargs)


def conflict_gate(
    history: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    status_col: str = "status",
    eff_col: str = "effective_date",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    conflict_statuses: Sequence[str] = ("Unknown",),
    open_end=OPEN_END,
) -> None:
    """A conflict-status event inside a *closed* slice contradicts recorded history."""
    flagged = batch.filter(F.col(status_col).isin(list(conflict_statuses)))
    string_dates = isinstance(_kind(history, valid_from), StringType)
    if string_dates:
        history = history.withColumn(valid_from, F.to_date(valid_from)).withColumn(
            valid_to, F.to_date(valid_to)
        )
        flagged = flagged.withColumn(eff_col, F.to_date(eff_col))
    hits = inside_closed(flagged, history, keys, eff_col, valid_from, valid_to, open_end)
    if not hits.isEmpty():
        raise SCD2TimelineException("Conflicting event inside a closed history slice")


# ---------------------------------------------------------------- presets


def load_silver_injuries(initial_df: DataFrame | None, batch_df: DataFrame) -> DataFrame:
    """Player status history with string dates and a 9999-12-31 open end.

    Closed history of affected players is kept (trap T1); several events of
    one player chain (T4); a rerun is a no-op.
    """
    return scd2_apply(initial_df, batch_df, ["player_id"], ["status"])


def update_injury_history(
    history_df: DataFrame,
    batch_df: DataFrame,
    future_bound=None,
    conflict_statuses: Sequence[str] = ("Unknown",),
) -> DataFrame:
    """Future-date gate, closed-slice conflict gate, then the split.

    ``future_bound``: latest allowed effective date; by default the query's
    ``current_date()`` (trap T5: never a hard-coded year).
    """
    eff = F.to_date("effective_date") if isinstance(_kind(batch_df, "effective_date"), StringType) else F.col("effective_date")
    future_date_gate(batch_df, eff, F.current_date() if future_bound is None else future_bound)
    conflict_gate(history_df, batch_df, ["player_id"], conflict_statuses=conflict_statuses)
    return scd2_apply(history_df, batch_df, ["player_id"], ["status"])


def process_injury_scd2(target_df: DataFrame | None, batch_df: DataFrame, logical_date) -> DataFrame:
    """D3: keyed by (player_id, category), emits ``is_current``; gates G1 then G4.

    ``target_df=None`` is a cold start."""
    future_date_gate(batch_df, "effective_date", logical_date)
    scd2_batch_overlap_gate(batch_df, ["player_id", "category"], "effective_date")
    tgt = target_df
    if tgt is not None and "is_current" in tgt.columns:
        tgt = tgt.drop("is_current")
    return scd2_apply(
        tgt, batch_df, ["player_id", "category"], ["status"], current_col="is_current", check_batch=False
    ).select("player_id", "category", "status", "valid_from", "valid_to", "is_current")


def upsert_dim_players_scd2(
    target: DataFrame | None,
    incoming: DataFrame,
    processing_ts,
    tracked: Sequence[str] = ("team_name", "injury_status"),
    carried: Sequence[str] = ("player_name",),
) -> DataFrame:
    """Snapshot feed; a change of team or status (null-safe, T6) closes the
    current version at one ``processing_ts`` (T7) and opens a new one; the
    open end is NULL."""
    batch = incoming.withColumn("effective_from", F.lit(processing_ts).cast("timestamp"))
    tgt = None
    if target is not None:
        tgt = target.drop("is_current") if "is_current" in target.columns else target
    return scd2_apply(
        tgt,
        batch,
        ["player_id"],
        list(tracked),
        eff_col="effective_from",
        valid_from="effective_from",
        valid_to="effective_to",
        open_end=None,
        current_col="is_current",
        carried=list(carried),
    )
