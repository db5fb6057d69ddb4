"""Data-quality metrics, gate and schema contracts (Q1, Q2, Q4).

Every table is measured in one aggregation pass (completeness, uniqueness,
validity); orphan shares use one left-semi-style join against the distinct
parent keys. Metric rows follow the ``dq_metrics`` layout: table_name,
dimension, metric_name, metric_value, unit, check_timestamp, snapshot_date.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from tidemark.errors import ContractViolationError, DataQualityError
from tidemark.operators.sizing import broadcast_if_bounded

PROPORTION = "proportion"
# Failing metrics named in the gate's message, at most.
GATE_SHOWN = 100


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def measure_table(
    df: DataFrame,
    table_name: str,
    snapshot_date: _dt.date,
    check_timestamp: _dt.datetime,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    valid: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Q1 for one table: one ``agg`` pass, then one row per metric.

    ``valid`` maps a metric name to a boolean Column (e.g. a regex or range
    check); NULL counts as invalid.
    """
    n = F.count(F.lit(1))
    metrics: list[tuple[str, str, Column]] = []
    for c in not_null:
        metrics.append(("completeness", f"{c}_not_null", _ratio(F.count(c), n)))
    for c in unique:
        metrics.append(("uniqueness", f"{c}_unique", _ratio(F.count_distinct(c), n)))
    for name, cond in (valid or {}).items():
        metrics.append(
            ("validity", name, _ratio(F.sum(F.when(F.coalesce(cond, F.lit(False)), 1).otherwise(0)), n))
        )
    return _to_rows(df.agg(*[m[2].alias(f"m{i}") for i, m in enumerate(metrics)]), table_name, metrics, snapshot_date, check_timestamp)


def orphan_share(
    child: DataFrame,
    child_key: str,
    parent: DataFrame,
    parent_key: str,
    table_name: str,
    snapshot_date: _dt.date,
    check_timestamp: _dt.datetime,
) -> DataFrame:
    """Share of child rows whose key exists in the parent (consistency)."""
    parents = parent.select(F.col(parent_key).alias("_pk")).distinct().withColumn("_hit", F.lit(1))
    # A dimension's distinct keys are usually small: broadcast them (after a
    # bounded count) so the fact's key column is not shuffled.
    parents = broadcast_if_bounded(parents)
    j = child.select(F.col(child_key).alias("_ck")).join(parents, F.col("_ck") == F.col("_pk"), "left")
    metrics = [("consistency", f"{child_key}_has_parent", _ratio(F.count("_hit"), F.count(F.lit(1))))]
    return _to_rows(j.agg(metrics[0][2].alias("m0")), table_name, metrics, snapshot_date, check_timestamp)


def _to_rows(agg_row: DataFrame, table_name, metrics, snapshot_date, check_timestamp) -> DataFrame:
    entries = [
        F.struct(
            F.lit(dim).alias("dimension"),
            F.lit(name).alias("metric_name"),
            F.col(f"m{i}").alias("metric_value"),
        )
        for i, (dim, name, _) in enumerate(metrics)
    ]
    return agg_row.select(F.explode(F.array(*entries)).alias("_m")).select(
        F.lit(table_name).alias("table_name"),
        "_m.dimension",
        "_m.metric_name",
        "_m.metric_value",
        F.lit(PROPORTION).alias("unit"),
        F.lit(check_timestamp).cast("timestamp").alias("check_timestamp"),
        F.lit(snapshot_date).alias("snapshot_date"),
    )


# ------------------------------------------------------------------ mergeable states

def _count_state(df: DataFrame, metrics: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """One pass: (dimension, metric, hits, total) per metric of which hits is a count."""
    seen = df.agg(F.count(F.lit(1)).alias("_n"), *[m[2].cast("long").alias(f"m{i}") for i, m in enumerate(metrics)])
    entries = [
        F.struct(
            F.lit(dim).alias("dimension"),
            F.lit(name).alias("metric_name"),
            F.lit(None).cast("long").alias("bucket"),
            F.coalesce(F.col(f"m{i}"), F.lit(0)).cast("long").alias("hits"),
            F.col("_n").cast("long").alias("total"),
            F.lit(None).cast("binary").alias("bitmap"),
        )
        for i, (dim, name, _) in enumerate(metrics)
    ]
    return seen.select(F.inline(F.array(*entries)))


def measure_state(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    valid: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Q1 as a state that merges: what one load adds to the metrics of a table.

    Completeness and validity are counts. Uniqueness keeps which values have
    been seen, as bitmaps of 32,768 neighbouring integers each, so that the
    distinct count of several loads together is exact without rescanning any.
    ``unique`` columns are integers.
    """
    counts: list[tuple[str, str, Column]] = [("completeness", f"{c}_not_null", F.count(c)) for c in not_null]
    for name, cond in (valid or {}).items():
        counts.append(("validity", name, F.count_if(F.coalesce(cond, F.lit(False)))))
    counts += [("uniqueness", f"{c}_unique", F.lit(0)) for c in unique]
    state = _count_state(df, counts)
    for c in unique:
        if not isinstance(df.schema[c].dataType, IntegralType):
            raise ValueError(f"a mergeable distinct count needs an integer column, not {c}")
        number = F.col(c).cast("long")
        held = df.filter(F.col(c).isNotNull()).groupBy(F.bitmap_bucket_number(number).alias("bucket"))
        maps = held.agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))
        state = state.unionByName(
            maps.select(
                F.lit("uniqueness").alias("dimension"),
                F.lit(f"{c}_unique").alias("metric_name"),
                "bucket",
                F.lit(0).cast("long").alias("hits"),
                F.lit(0).cast("long").alias("total"),
                "bitmap",
            )
        )
    return state


def orphan_state(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``orphan_share`` as a state that merges."""
    parents = broadcast_if_bounded(parent.select(F.col(parent_key).alias("_pk")).distinct().withColumn("_hit", F.lit(1)))
    j = child.select(F.col(child_key).alias("_ck")).join(parents, F.col("_ck") == F.col("_pk"), "left")
    return _count_state(j, [("consistency", f"{child_key}_has_parent", F.count("_hit"))])


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all loads together: counts added, bitmaps united. Order does not matter."""
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    merged = every.groupBy("dimension", "metric_name", "bucket").agg(
        F.sum("hits").alias("hits"),
        F.sum("total").alias("total"),
        F.bitmap_or_agg("bitmap").alias("bitmap"),
    )
    return merged.withColumn("bitmap", F.when(F.col("bucket").isNotNull(), F.col("bitmap")))


def state_metrics(state: DataFrame, table_name: str, snapshot_date: _dt.date, check_timestamp: _dt.datetime) -> DataFrame:
    """The metric rows of a state, as ``measure_table`` gives them for all its rows at once."""
    seen = F.sum("hits") + F.sum(F.coalesce(F.bitmap_count("bitmap"), F.lit(0)))
    per = state.groupBy("dimension", "metric_name").agg(_ratio(seen, F.sum("total")).alias("metric_value"))
    return per.select(
        F.lit(table_name).alias("table_name"),
        "dimension",
        "metric_name",
        "metric_value",
        F.lit(PROPORTION).alias("unit"),
        F.lit(check_timestamp).cast("timestamp").alias("check_timestamp"),
        F.lit(snapshot_date).alias("snapshot_date"),
    )


def dq_gate(metrics: DataFrame, threshold: float = 0.95) -> None:
    """Q2: fail when any proportion metric is below ``threshold`` or has no value.

    A metric without value comes from an empty table, or from one that could
    not be measured. The message names at most ``GATE_SHOWN`` failures.
    """
    failed = (
        metrics.filter((F.col("unit") == PROPORTION) & (F.col("metric_value").isNull() | (F.col("metric_value") < threshold)))
        .select("table_name", "metric_name", "metric_value")
        .limit(GATE_SHOWN)
        .collect()
    )
    if failed:
        names = ", ".join(
            f"{r.table_name}.{r.metric_name}=" + ("none" if r.metric_value is None else f"{r.metric_value:.4f}") for r in failed
        )
        raise DataQualityError(f"Data quality gate failed: {names}")


def check_contract(df: DataFrame, contract: StructType, not_null: Sequence[str] = ()) -> None:
    """Q4: columns, types and NOT NULL columns match the registered schema."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in contract.fields:
        if f.name not in have:
            problems.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    required = list(not_null) or [f.name for f in contract.fields if not f.nullable and f.name in have]
    if required and not problems:
        row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
        problems += [f"{c}: {row[c]} NULL values" for c in required if row[c]]
    if problems:
        raise ContractViolationError("; ".join(problems))
