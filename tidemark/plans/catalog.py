"""Registered queries over the driver tables and their DuckDB oracle SQL.

Each query is the library's operator applied to the TPC-H-like tables in
their warehouse roles (SURVEY §7.5):

* player = ``lineitem.l_suppkey`` / ``events.user_id`` / supplier,
  team = nation, match = order, shot = lineitem row (xG := ``l_discount``);
* status events = ``events(user_id, event_type, ts)`` reduced to the last
  event per user and day, loaded into an SCD2 history in two batches
  (before / from ``SPLIT_DATE``), which exercises the incremental path.

Every query reads whole tables. Money-like columns (two decimals) are summed
as DECIMAL so Spark and the oracle agree bit for bit and reruns are stable.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.errors import WarehouseError
from tidemark.functions.exprs import OPEN_END, hash_key
from tidemark.functions.text import WHITESPACE_CLASS_RE2, clean_whitespace
from tidemark.operators import dq as dqm
from tidemark.operators.asof import asof_join, inside_closed
from tidemark.operators.dedup import keep_first, union_keep_existing
from tidemark.operators.extract import (
    active_matches,
    extract_id_title,
    extract_injury_grid,
    extract_injury_status,
    extract_json_fields,
    extract_league_players,
    extract_match_info,
    extract_page_links,
    extract_rosters,
    extract_shots,
)
from tidemark.operators.gates import (
    dedupe_batch,
    duplicate_keys,
    future_date_gate,
    pk_collisions,
    scd2_batch_overlap_gate,
    validate_composite_keys,
)
from tidemark.operators.loads import (
    load_silver_matches,
    load_silver_rosters,
    load_silver_teams,
    upsert_dim_teams,
    write_fact_match_stats,
)
from tidemark.operators.merge import merge_update, upsert
from tidemark.operators.metrics import compute_player_injury_summary, player_baselines, shooters_squad_health_deficit
from tidemark.operators.resolve import (
    resolve_entities,
    resolve_player_entities,
    resolve_player_identities,
    resolve_published,
)
from tidemark.operators.scd2 import (
    latest_per_period,
    load_silver_injuries,
    process_injury_scd2,
    scd2_apply,
    scd2_apply_late,
    update_injury_history,
    upsert_dim_players_scd2,
)
from tidemark.operators.setops import set_difference, state_diff, state_fingerprint, union_by_name
from tidemark.operators.windows import rolling_avg, running_sum
from tidemark.plans import gold
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.tables import Tables

# Fixed parameters of the registered queries.
SPLIT_DATE = _dt.date(2024, 1, 16)
PROCESSING_DATE = _dt.date(2024, 2, 1)
SNAPSHOT_DATE = _dt.date(2024, 2, 1)
# Timestamps as text: cast in the session time zone and shown back as
# wall-clock TIMESTAMP_NTZ, the result does not depend on the zone.
CHECK_TS = "2024-02-01 06:00:00"
PROCESSING_TS = _dt.datetime(2024, 2, 1, 6, 0, 0)
EARLIER_TS = _dt.datetime(2024, 1, 1, 6, 0, 0)
INJURED = "error"
MONEY = 2  # decimals of prices / discounts


# ----------------------------------------------------------------- shared parts


def status_events(t: Tables) -> DataFrame:
    ev = t.events.select(
        F.col("user_id").alias("player_id"), F.col("event_type").alias("status"), "ts", "event_id"
    )
    return latest_per_period(ev, ["player_id"], "ts", ["status"], tiebreak=["event_id"])


def status_history(t: Tables) -> DataFrame:
    """SCD2 history built in two batches (incremental apply)."""
    ev = status_events(t)
    first = ev.filter(F.col("effective_date") < F.lit(SPLIT_DATE))
    second = ev.filter(F.col("effective_date") >= F.lit(SPLIT_DATE))
    h1 = scd2_apply(None, first, ["player_id"], ["status"], check_batch=False)
    # The first load is not stored here, so it is read once and sorted whole
    # rather than computed twice for its affected and its untouched rows.
    return scd2_apply(
        h1, second, ["player_id"], ["status"], current_col="is_current", check_batch=False, bypass=False
    )


def shots(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").alias("player_id"),
        F.col("l_orderkey").alias("match_id"),
        F.col("l_discount").alias("xg"),
    )


def squad_deficit_frame(t: Tables) -> DataFrame:
    injured = status_history(t).filter(F.col("is_current") & (F.col("status") == INJURED)).select("player_id")
    teams = t.customer.select(F.col("c_custkey").alias("player_id"), F.col("c_nationkey").alias("team_id"))
    d = shooters_squad_health_deficit(shots(t), injured, teams, scale=MONEY)
    return d.select(
        "match_id",
        "team_id",
        "active_injured_count",
        F.round("total_squad_xg_drag", 9).alias("total_squad_xg_drag"),
        F.round("total_squad_xga_drag", 9).alias("total_squad_xga_drag"),
    )


def fact_match(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("match_id"),
        F.col("c_nationkey").alias("team_h"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("pts"),
        (F.col("o_totalprice") / F.lit(100000)).alias("xpts"),
    )


def dim_team(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("title"))


# ----------------------------------------------------------------- queries


def q_player_stats(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    s = t.lineitem.select(
        F.col("l_suppkey").alias("player_id"), F.col("l_orderkey").alias("shot_id"), F.col("l_discount").alias("xg")
    )
    return gold.build_player_stats(s, scale=MONEY)


def q_injury_summary(spark, d):
    t = Tables(spark, d)
    h = status_history(t).join(t.customer, F.col("player_id") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("team_id"), "player_id", "status", "is_current"
    )
    return gold.build_injury_summary(h, status=INJURED)


def _matches(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("team_id"),
        F.col("o_orderkey").alias("match_id"),
        F.col("o_totalprice").alias("xg"),
        F.to_date("o_orderdate").alias("date"),
    )


def q_team_form(spark, d):
    t = Tables(spark, d)
    return gold.build_team_form(_matches(t), scale=MONEY)


def q_team_form_split(spark, d):
    """Same result through the prefix scan: some 40 ranges over all orders."""
    t = Tables(spark, d)
    return gold.build_team_form(_matches(t), scale=MONEY, range_rows=t.orders.count() // 40 + 1)


def _lookback(spark, d, **kw):
    t = Tables(spark, d)
    li = t.lineitem.select(
        F.col("l_suppkey").alias("player_id"),
        F.col("l_orderkey").alias("match_id"),
        "l_linenumber",
        "l_partkey",
        F.col("l_discount").alias("xg"),
    )
    out = rolling_avg(
        li,
        "player_id",
        ["match_id", "l_linenumber", "l_partkey", "xg"],
        "xg",
        -5,
        -1,
        "rolling_player_xg_5match",
        scale=MONEY,
        **kw,
    )
    return out.withColumn("rolling_player_xga_5match", F.col("rolling_player_xg_5match") * F.lit(1.1))


def q_lookback_baseline(spark, d):
    return _lookback(spark, d)


def q_lookback_split(spark, d):
    """Same result through the prefix scan: some 40 ranges over all line items."""
    return _lookback(spark, d, range_rows=Tables(spark, d).lineitem.count() // 40 + 1)


def q_squad_deficit(spark, d):
    return squad_deficit_frame(Tables(spark, d))


def q_injury_metrics(spark, d):
    t = Tables(spark, d)
    return compute_player_injury_summary(status_history(t), PROCESSING_DATE)


def q_scd2_apply(spark, d):
    return status_history(Tables(spark, d))


def q_scd2_backfill(spark, d):
    """Late arrival of a whole earlier block: the events from SPLIT_DATE on are
    loaded first, the earlier ones afterwards. Earlier slices chain and close
    where the recorded history begins; recorded slices are kept as they are."""
    ev = status_events(Tables(spark, d))
    later = ev.filter(F.col("effective_date") >= F.lit(SPLIT_DATE))
    earlier = ev.filter(F.col("effective_date") < F.lit(SPLIT_DATE))
    h = scd2_apply(None, later, ["player_id"], ["status"], check_batch=False)
    return scd2_apply(h, earlier, ["player_id"], ["status"], current_col="is_current", check_batch=False)


def q_injuries_string_dates(spark, d):
    """D1 preset: ISO-string dates in and out, 9999-12-31 open end, two loads."""
    ev = status_events(Tables(spark, d)).withColumn("effective_date", F.date_format("effective_date", "yyyy-MM-dd"))
    first = ev.filter(F.col("effective_date") < F.lit(SPLIT_DATE.isoformat()))
    second = ev.filter(F.col("effective_date") >= F.lit(SPLIT_DATE.isoformat()))
    return load_silver_injuries(load_silver_injuries(None, first), second)


def q_timeline_conflicts(spark, d):
    """G5's containment test as a report: events dated inside a *closed*
    status slice of their user (a (key, month) semi join)."""
    t = Tables(spark, d)
    events = t.events.select(
        "event_id", F.col("user_id").alias("player_id"), F.to_date("ts").alias("event_date")
    )
    return inside_closed(events, status_history(t), ["player_id"], "event_date", open_end=OPEN_END)


# Fixed parameters: value bands used as the status of the category history.
BAND_LOW, BAND_HIGH = 100, 300


def q_injury_categories(spark, d):
    """D3 preset keyed by (player, category): per user and event type, the
    value band of the day's last event; two loads with the logical-date gate
    (G1) and the one-event-per-key-and-date gate (G4)."""
    t = Tables(spark, d)
    band = (
        F.when(F.col("value") < BAND_LOW, "low").when(F.col("value") < BAND_HIGH, "mid").otherwise("high")
    )
    ev = t.events.select(
        F.col("user_id").alias("player_id"),
        F.col("event_type").alias("category"),
        band.alias("status"),
        "ts",
        "event_id",
    )
    daily = latest_per_period(ev, ["player_id", "category"], "ts", ["status"], tiebreak=["event_id"])
    first = daily.filter(F.col("effective_date") < F.lit(SPLIT_DATE))
    second = daily.filter(F.col("effective_date") >= F.lit(SPLIT_DATE))
    h = process_injury_scd2(None, first, SPLIT_DATE)
    return process_injury_scd2(h, second, PROCESSING_DATE)


def q_point_in_time(spark, d):
    t = Tables(spark, d)
    dim = status_history(t).select(
        "player_id",
        "status",
        "valid_from",
        F.when(~F.col("is_current"), F.col("valid_to")).alias("valid_to"),
    )
    facts = t.events.select(
        "event_id",
        F.col("user_id").alias("player_id"),
        F.to_date("ts").alias("snapshot_date"),
        F.col("value").alias("xg"),
    )
    j = asof_join(facts, dim, ["player_id"], "snapshot_date", open_end=None)
    return j.select(
        "event_id",
        "player_id",
        "snapshot_date",
        "xg",
        "status",
        F.when(F.col("status") == INJURED, "Unavailable").otherwise("Available").alias("availability_status"),
    )


def _name_feed(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_totalprice", F.col("c_name").alias("player_name")
    )


def q_resolve_ok(spark, d):
    t = Tables(spark, d)
    mapping = t.customer.select(F.col("c_name").alias("raw_player_name"), F.col("c_custkey").alias("player_id"))
    return resolve_player_entities(_name_feed(t), mapping)


def q_resolve_unmatched(spark, d):
    t = Tables(spark, d)
    mapping = t.customer.filter(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_name").alias("raw_player_name"), F.col("c_custkey").alias("player_id")
    )
    _, unresolved = resolve_player_entities(_name_feed(t), mapping, policy="quarantine")
    return unresolved


def q_merge_scd1(spark, d):
    t = Tables(spark, d)
    open_total = (
        t.orders.groupBy("o_custkey")
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("_open"))
    )
    source = t.customer.join(open_total, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey",
        "c_name",
        (F.col("c_acctbal").cast("decimal(18,2)") - F.col("_open")).cast("double").alias("c_acctbal"),
        "c_mktsegment",
    )
    target = t.customer.filter(F.col("c_mktsegment") != "BUILDING").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )
    return upsert(target, source, ["c_custkey"])


def _stats_for(t: Tables, status: str) -> DataFrame:
    s = t.lineitem.filter(F.col("l_linestatus") == status).select(
        F.col("l_orderkey").alias("player_id"), F.col("l_linenumber").alias("shot_id"), F.col("l_discount").alias("xg")
    )
    return gold.build_player_stats(s, scale=MONEY)


def q_gold_upsert(spark, d):
    """S11 run twice: statistics per order of the finished lines, replaced by
    those of the open lines. Orders with finished lines only stay, orders with
    both kinds are replaced, orders with open lines only are inserted."""
    t = Tables(spark, d)
    target, source = _stats_for(t, "F"), _stats_for(t, "O")
    once = gold.upsert_gold(target, source, ["player_id"])
    return gold.upsert_gold(once, source, ["player_id"])


def q_load_dedup(spark, d):
    t = Tables(spark, d)
    li = t.lineitem
    return union_keep_existing(
        li.filter(F.col("l_linestatus") == "F"), li.filter(F.col("l_linestatus") == "O"), ["l_orderkey", "l_linenumber"]
    )


def q_load_incremental(spark, d):
    """Same state as ``load_dedup`` built as two loads: the first batch
    deduplicated into a (unique) state, the second appended through the
    fast path that never re-aggregates the existing rows."""
    t = Tables(spark, d)
    li = t.lineitem
    keys = ["l_orderkey", "l_linenumber"]
    state = keep_first(li.filter(F.col("l_linestatus") == "F"), keys)
    return union_keep_existing(state, li.filter(F.col("l_linestatus") == "O"), keys, existing_unique=True)


def q_load_matches(spark, d):
    """L1 + F15: finished orders are the stored matches; a batch of all orders
    carries customer *names*, aligned to ids through the name dimension;
    stored matches win."""
    t = Tables(spark, d)
    initial = t.orders.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_custkey").alias("home_id"),
        F.col("o_custkey").alias("away_id"),
        F.col("o_orderstatus").alias("score"),
    )
    batch = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("match_id"),
        F.col("c_name").alias("home_team"),
        F.col("c_name").alias("away_team"),
        F.col("o_orderpriority").alias("score"),
    )
    teams = t.customer.select(F.col("c_name").alias("raw_name"), F.col("c_custkey").alias("team_id"))
    return load_silver_matches(initial, batch, teams)


def q_pk_violations(spark, d):
    return duplicate_keys(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


def q_batch_collisions(spark, d):
    return pk_collisions(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


def q_dim_hash(spark, d):
    """L5 + S10: the stored teams are all nations and regions, stamped a month
    earlier. The feed names the suppliers' nations, which match and are
    stamped anew, and the part brands, which are inserted; the regions stay."""
    t = Tables(spark, d)
    names = t.nation.select(F.col("n_name").alias("name")).unionByName(t.region.select(F.col("r_name").alias("name")))
    stored = upsert_dim_teams(None, names, "name", EARLIER_TS)
    named = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("title"))
    feed = named.unionByName(t.part.select(F.col("p_brand").alias("title")))
    merged = upsert_dim_teams(stored, feed, "title", PROCESSING_TS)
    return merged.select("team_id", "team_name", F.date_format("updated_at", "yyyy-MM-dd").alias("updated_on"))


def q_merge_if_changed(spark, d):
    """S10 with change detection: customers of whom the highest order status is P
    (pending) take that segment and their orders' total as balance; other
    customers with orders match without a change, those without are not matched."""
    t = Tables(spark, d)
    source = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.when(F.max("o_orderstatus") == "P", "PENDING").alias("_moved"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("c_acctbal"),
    )
    source = source.join(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey").select(
        "c_custkey", F.coalesce("_moved", "c_mktsegment").alias("c_mktsegment"), "c_acctbal"
    )
    target = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return merge_update(
        target, source, ["c_custkey"], ["c_mktsegment", "c_acctbal"], insert=False, only_if_changed=["c_mktsegment"]
    )


def q_injuries_gated(spark, d):
    """The future-date and the conflict gate, then the split, over two loads of ISO dates."""
    ev = status_events(Tables(spark, d)).withColumn("effective_date", F.date_format("effective_date", "yyyy-MM-dd"))
    first = ev.filter(F.col("effective_date") < F.lit(SPLIT_DATE.isoformat()))
    second = ev.filter(F.col("effective_date") >= F.lit(SPLIT_DATE.isoformat()))
    return update_injury_history(load_silver_injuries(None, first), second, future_bound=PROCESSING_DATE)


def q_resolve_identities(spark, d):
    """R2: every ordering customer's raw name must map to an id."""
    t = Tables(spark, d)
    mapping = t.customer.select(F.col("c_name").alias("raw_name"), F.col("c_custkey").alias("player_id"))
    return resolve_player_identities(_name_feed(t).select(F.col("player_name").alias("raw_name")), mapping)


def q_load_rosters(spark, d):
    """L4: rosters keyed by (team, player, season). Finished lines are stored, all
    lines arrive; a triple that is stored or repeated is loaded once."""
    t = Tables(spark, d)
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("team_id"),
        F.col("l_suppkey").alias("player_id"),
        F.year("l_shipdate").cast("string").alias("season"),
        "l_linestatus",
    )
    stored = load_silver_rosters(lines.limit(0).drop("l_linestatus"), lines.filter("l_linestatus = 'F'").drop("l_linestatus"))
    return load_silver_rosters(stored, lines.drop("l_linestatus"), initial_unique=True)


def q_load_matches_quarantine(spark, d):
    """F15 under the quarantine policy: matches of customers in segment BUILDING
    have no team in the dimension; they are set aside, the others are loaded."""
    t = Tables(spark, d)
    batch = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("match_id"),
        F.col("c_name").alias("home_team"),
        F.col("c_name").alias("away_team"),
        F.col("o_orderpriority").alias("score"),
    )
    teams = t.customer.filter(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_name").alias("raw_name"), F.col("c_custkey").alias("team_id")
    )
    initial = spark.createDataFrame([], "match_id long, home_id long, away_id long, score string")
    loaded, aside = load_silver_matches(initial, batch, teams, policy="quarantine")
    return loaded.select("match_id", "home_id", "score", F.lit("loaded").alias("state")).unionByName(
        aside.select("match_id", F.lit(None).cast("long").alias("home_id"), "score", F.lit("quarantined").alias("state"))
    )


def q_historical_impact(spark, d):
    """V8 through its builder: every event's value at the version of its user valid then."""
    t = Tables(spark, d)
    dim = status_history(t).select(
        "player_id",
        F.concat(F.lit("user-"), F.col("player_id").cast("string")).alias("player_name"),
        F.col("status").alias("team_name"),
        F.when(F.col("status") == INJURED, F.col("status")).alias("injury_status"),
        F.col("valid_from").cast("timestamp").alias("effective_from"),
        F.when(~F.col("is_current"), F.col("valid_to").cast("timestamp")).alias("effective_to"),
    )
    facts = t.events.select(F.col("user_id").alias("player_id"), F.to_date("ts").alias("snapshot_date"), F.col("value").alias("xg"))
    return gold.build_historical_player_impact(facts, dim)


def q_active_matches(spark, d):
    """The finished orders of the last date that has any, as the day's matches."""
    t = Tables(spark, d)
    feed = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        (F.col("o_orderstatus") == "F").alias("isResult"),
    )
    last = t.orders.filter("o_orderstatus = 'F'").select(F.max(F.to_date("o_orderdate")))
    return active_matches(feed, last.scalar())


def q_running_sum_split(spark, d):
    """W1 through the prefix scan, some 40 ranges: running revenue of every supplier."""
    t = Tables(spark, d)
    li = t.lineitem.select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), "l_quantity"
    )
    out = running_sum(
        li,
        "l_suppkey",
        ["l_orderkey", "l_linenumber", "l_partkey", "price", "l_quantity"],
        "price",
        "revenue",
        range_rows=t.lineitem.count() // 40 + 1,
    )
    return out.select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.col("price").cast("double"), "l_quantity", F.col("revenue").cast("double")
    )


def q_load_ids(spark, d):
    t = Tables(spark, d)
    initial = (
        t.part.filter(F.col("p_size") <= 25)
        .groupBy(F.col("p_name").alias("raw_name"))
        .agg(F.min("p_partkey").alias("team_id"))
    )
    batch = t.part.select(F.col("p_name").alias("raw_name"))
    return load_silver_teams(initial, batch).select("raw_name", "team_id")


def q_star_health(spark, d):
    t = Tables(spark, d)
    # Players and their nation are customers, who include every event user and
    # every supplier number. Line items are summed per (player, month) before
    # that join, so it sees one row per player and month; the exact decimal
    # partial sums are summed again per team by the gold builder.
    per_player = (
        t.lineitem.groupBy(
            F.col("l_suppkey").alias("player_id"),
            F.to_date(F.date_trunc("month", "l_shipdate")).alias("snapshot_date"),
        ).agg(
            F.sum(F.col("l_discount").cast(f"decimal(18,{MONEY})")).alias("xg"),
            F.sum(F.col("l_quantity").cast("int")).alias("actual_goals"),
        )
    )
    facts = per_player.join(t.customer, F.col("player_id") == F.col("c_custkey")).select(
        "player_id", F.col("c_nationkey").alias("team_id"), "xg", "actual_goals", "snapshot_date"
    )
    teams = t.nation.select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team_name"))
    players = status_history(t).join(t.customer, F.col("player_id") == F.col("c_custkey")).select(
        "player_id",
        F.col("c_nationkey").alias("team_id"),
        F.when(F.col("status") == INJURED, F.col("status")).alias("injury_status"),
        "is_current",
    )
    return gold.build_team_health_performance(facts, teams, players, scale=MONEY)


def q_home_drag(spark, d):
    t = Tables(spark, d)
    return gold.build_squad_health_drag(fact_match(t), dim_team(t), squad_deficit_frame(t))


def q_efficiency(spark, d):
    t = Tables(spark, d)
    return gold.build_efficiency_anomalies(fact_match(t), dim_team(t), squad_deficit_frame(t))


def q_resilience(spark, d):
    t = Tables(spark, d)
    summary = compute_player_injury_summary(status_history(t), PROCESSING_DATE)
    players = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("player_name"))
    return gold.build_resilience_index(players, summary)


def dq_metrics_frame(t: Tables) -> DataFrame:
    kw = dict(snapshot_date=SNAPSHOT_DATE, check_timestamp=CHECK_TS)
    parts = [
        dqm.measure_table(
            t.customer,
            "customer",
            not_null=["c_name", "c_acctbal", "c_mktsegment"],
            unique=["c_custkey"],
            valid={
                "acctbal_non_negative": F.col("c_acctbal") >= 0,
                "name_format": F.col("c_name").rlike("^Customer#[0-9]+$"),
            },
            **kw,
        ),
        dqm.measure_table(
            t.orders,
            "orders",
            not_null=["o_custkey", "o_orderdate"],
            unique=["o_orderkey"],
            valid={"status_domain": F.col("o_orderstatus").isin("O", "F", "P")},
            **kw,
        ),
        dqm.orphan_share(t.orders, "o_custkey", t.customer, "c_custkey", "orders", **kw),
        dqm.measure_table(
            t.labels,
            "labels",
            not_null=["quality", "toxic"],
            unique=["doc_id"],
            valid={"quality_binary": F.col("quality").isin(0, 1)},
            **kw,
        ),
        dqm.orphan_share(t.labels, "doc_id", t.documents, "doc_id", "labels", **kw),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("check_timestamp", F.col("check_timestamp").cast("timestamp_ntz"))


def q_dq_metrics(spark, d):
    return dq_metrics_frame(Tables(spark, d))


def q_dq_report(spark, d):
    return gold.build_data_governance_report(dq_metrics_frame(Tables(spark, d)))


def q_clean_text(spark, d):
    t = Tables(spark, d)
    return t.documents.select("doc_id", clean_whitespace("text").alias("text_clean"))


def q_extract_json(spark, d):
    t = Tables(spark, d)
    return extract_json_fields(t.events, "props", "k INT", keep=["event_id"])


def q_extract_grid(spark, d):
    return extract_page_links(Tables(spark, d).pages)


def q_set_diff(spark, d):
    """O3: customers without an order, whatever its status."""
    t = Tables(spark, d)
    ordering = t.orders.select(F.col("o_custkey").alias("custkey"))
    return set_difference(t.customer.select(F.col("c_custkey").alias("custkey")), ordering)


def q_union_missing(spark, d):
    t = Tables(spark, d)
    c = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return union_by_name(c, s)


def q_baselines_match(spark, d):
    """W2 at match grain (trap T14): per (player, match) xG summed first."""
    t = Tables(spark, d)
    b = player_baselines(shots(t), grain="match", scale=MONEY)
    return b


def q_resolve_warn(spark, d):
    """R3 policy: keep resolved rows only; the dropped count is observed, not raised."""
    t = Tables(spark, d)
    mapping = t.customer.filter(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_name").alias("raw_player_name"), F.col("c_custkey").alias("player_id")
    )
    out, _report = resolve_entities(_name_feed(t), mapping, "player_name", "raw_player_name", policy="warn")
    return out


def q_dedupe_events(spark, d):
    """G3 on a batch delivered twice in part: every event, and again those of
    signed-up users; the copies collapse to one row per event id."""
    t = Tables(spark, d)
    users = t.events.filter(F.col("event_type") == "signup").select("user_id").distinct()
    again = t.events.join(users, "user_id", "left_semi").select(*t.events.columns)
    return dedupe_batch(t.events.unionByName(again), "event_id")


SNAPSHOT_1 = "2024-01-01 06:00:00"
SNAPSHOT_2 = "2024-02-01 06:00:00"


def q_dim_players_scd2(spark, d):
    """Two snapshot feeds of the customer dimension (status = segment, then the
    priority of the customer's latest order, NULL without orders)."""
    t = Tables(spark, d)
    base = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("player_id"),
        F.col("c_name").alias("player_name"),
        F.col("n_name").alias("team_name"),
        F.col("c_mktsegment").alias("injury_status"),
    )
    latest = t.orders.groupBy(F.col("o_custkey").alias("player_id")).agg(
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("_latest")
    )
    snap2 = base.join(latest, "player_id", "left").select(
        "player_id", "player_name", "team_name", F.col("_latest").alias("injury_status")
    )
    v1 = upsert_dim_players_scd2(None, base, SNAPSHOT_1)
    v2 = upsert_dim_players_scd2(v1, snap2, SNAPSHOT_2)
    return v2.select(
        "player_id",
        "player_name",
        "team_name",
        "injury_status",
        F.col("effective_from").cast("timestamp_ntz").alias("effective_from"),
        F.col("effective_to").cast("timestamp_ntz").alias("effective_to"),
        "is_current",
    )


def q_extract_players_json(spark, d):
    """X1 over bronze payloads Spark derives per supplier: one league JSON
    document each (string-typed values, several fields absent)."""
    t = Tables(spark, d)
    player = F.struct(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("player_name"),
        F.col("n_name").alias("team_title"),
        F.col("s_acctbal").cast("string").alias("xG"),
        F.col("s_nationkey").cast("string").alias("games"),
    )
    payloads = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("payload_id"),
        F.to_json(F.struct(F.array(player).alias("players"))).alias("body"),
    )
    return extract_league_players(payloads)


def match_payloads(t: Tables) -> DataFrame:
    """One match JSON document per order, built by Spark from its line items.

    Lines are numbered within their order (a window over one order's lines)
    to give each entry an id; odd line numbers form the home side. Rosters
    are maps keyed by that id, shots are lists. Each group is one order.
    """
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
    li = t.lineitem.withColumn(
        "_pos", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order)).cast("string")
    ).withColumn("_side", F.when(F.col("l_linenumber") % 2 == 1, "h").otherwise("a"))
    position = F.when(F.col("l_returnflag") == "R", "Sub").when(F.col("l_returnflag") == "A", "DF")
    roster_entry = F.struct(
        F.col("l_suppkey").cast("string").alias("player_id"),
        F.concat(F.lit("Supplier#"), F.col("l_suppkey").cast("string")).alias("player"),
        position.alias("position"),
        F.col("l_quantity").cast("int").cast("string").alias("time"),
    )
    shot_entry = F.struct(
        F.col("_pos").alias("id"),
        F.col("l_suppkey").cast("string").alias("player_id"),
        F.col("l_orderkey").cast("string").alias("match_id"),
        F.concat(F.lit("Supplier#"), F.col("l_suppkey").cast("string")).alias("player"),
        F.col("l_discount").cast("string").alias("xG"),
        F.col("l_linenumber").cast("string").alias("minute"),
        F.col("l_returnflag").alias("result"),
    )
    per_side = li.groupBy("l_orderkey", "_side").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("_pos"), roster_entry))).alias("roster"),
        F.collect_list(shot_entry).alias("shots"),
    )
    doc = per_side.groupBy("l_orderkey").agg(
        F.map_from_entries(F.collect_list(F.struct("_side", "roster"))).alias("rosters"),
        F.map_from_entries(F.collect_list(F.struct("_side", "shots"))).alias("shots"),
    )
    return doc.select(F.col("l_orderkey").alias("payload_id"), F.to_json(F.struct("rosters", "shots")).alias("body"))


def q_extract_rosters_json(spark, d):
    """X2 over per-order match documents derived from the line items."""
    return extract_rosters(match_payloads(Tables(spark, d)))


def q_extract_shots_json(spark, d):
    """X3 over per-order match documents derived from the line items."""
    return extract_shots(match_payloads(Tables(spark, d)))


# Characters a match page escapes as \xNN inside JSON.parse('...').
PAGE_ESCAPES = (("{", "\\x7B"), ("}", "\\x7D"), ('"', "\\x22"), (":", "\\x3A"), (",", "\\x2C"))


def q_extract_match_info(spark, d):
    """X4 over match pages Spark renders per order: JSON in a script, escaped on
    the pages of finished orders, plain on the others."""
    t = Tables(spark, d)
    info = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("c_name").alias("team_h"),
            F.col("n_name").alias("team_a"),
            F.substring("o_orderpriority", 1, 1).alias("h_goals"),
            F.col("o_totalprice").cast("string").alias("h_xg"),
            F.to_date("o_orderdate").cast("string").alias("date"),
        )
    )
    escaped = info
    for ch, esc in PAGE_ESCAPES:
        escaped = F.replace(escaped, F.lit(ch), F.lit(esc))
    info = F.when(F.col("o_orderstatus") == "F", escaped).otherwise(info)
    page = F.concat(F.lit("<html><script>var match_info = JSON.parse('"), info, F.lit("');</script></html>"))
    pages = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("o_orderkey").alias("payload_id"), page.alias("html"))
    )
    return extract_match_info(pages)


def injury_pages(t: Tables) -> DataFrame:
    """One injury-grid page per order, rendered by Spark: a heading row per
    side (home = customer, away = nation) followed by one player row per line
    item of that side, rows in line-position order. Each group is one order
    (its lines number a few, in these tables at most 13).

    Around the grid stand tables of other classes with rows like the grid's,
    within it a heading without a team and, after second lines, a row holding
    a table of its own; names hold numeric and named entities. Finished
    orders' pages quote attributes singly and write tags in capitals, open
    orders' pages leave cells unclosed."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
    # One pass over the sorted lines: an order's lines are gathered as they are, and rendered beside its names.
    by_order = Window.partitionBy("l_orderkey").orderBy("_line")
    whole = by_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    li = t.lineitem.select("l_orderkey", F.struct(*order).alias("_line")).select(
        "l_orderkey", F.row_number().over(by_order).alias("_pos"), F.collect_list("_line").over(whole).alias("_lines")
    )

    tags = [f"<{end}{tag}" for tag in ("table", "tr", "td") for end in ("", "/")]
    # Replacements in the pages of one style, made in the page's own texts here and in every value on the way.
    loud, loose, plain = [('"', "'"), *[(tag, tag.upper()) for tag in tags]], [("</td>", "")], []

    def page(style):
        def markup(text):
            for old, new in style:
                text = text.replace(old, new)
            return F.lit(text)

        def value(c):
            for old, new in style:
                c = F.replace(c, F.lit(old), F.lit(new))
            return c

        def cell(label, c):
            return F.concat(markup(f'<td><div class="mob-title">{label}</div> '), c, markup(" </td>"))

        def row(x, i):
            return F.concat(
                markup('<tr class="player-row team_1">'),
                cell("Player", F.concat(F.lit("Supplier&num;"), x["l_suppkey"].cast("string"), F.lit("-"), (i + 1).cast("string"))),
                cell("Reason", value(x["l_returnflag"])),
                cell("Further Detail", F.concat(F.lit("Apr 09: 'Line "), x["l_linenumber"].cast("string"), F.lit(".'"))),
                cell("Potential Return", F.to_date(x["l_shipdate"]).cast("string")),
                cell("Condition", F.concat(value(x["l_linestatus"]), F.lit("&nbsp;"))),
                cell("Status", value(F.concat_ws("/", x["l_linestatus"], x["l_returnflag"]))),
                markup('<td><a class="track" data-id="'), x["l_suppkey"].cast("string"), markup('">x</a></td></tr>'),
                F.when(
                    x["l_linenumber"] == 2,
                    markup('<tr class="details"><td colspan="7"><table class="more"><tr><td>Notes</td><td>1 &lt; 2</td></tr></table></td></tr>'),
                ).otherwise(""),
            )

        def side(x):
            return F.when(x["l_linenumber"] % 2 == 1, 0).otherwise(1)

        def side_html(k):
            return F.array_join(F.transform(F.filter("_rows", lambda x: x["s"] == k), lambda x: x["r"]), "")

        def heading(name):
            return F.concat(markup('<tr class="heading"><td><div class="injury-team">'), value(name), markup("</div></td></tr>"))

        foreign = markup('<table class="standings"><tr class="heading"><td><div class="injury-team">Foreign</div></td></tr>'
                         '<tr class="player-row">' + "<td>1</td>" * 7 + "</tr></table>")
        html = F.concat(
            F.lit("<html>"), foreign, markup('<table id="grid" class="wide injury-table">'),
            heading(F.replace(F.col("c_name"), F.lit("#"), F.lit("&#35;"))),
            markup('<tr class="heading"><td>no team</td></tr>'), side_html(0),
            heading(F.col("n_name")), side_html(1),
            markup("</table>"), foreign, F.lit("</html>"),
        )
        return F.transform("_lines", lambda x, i: F.struct(side(x).alias("s"), row(x, i).alias("r"))), html

    def styled(part):
        status = F.col("o_orderstatus")
        return F.when(status == "F", page(loud)[part]).when(status == "O", page(loose)[part]).otherwise(page(plain)[part])

    names = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_orderstatus", "c_name", "n_name")
    )
    pages = li.filter(F.col("_pos") == 1).join(names, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("_rows", styled(0))
    return pages.select(F.col("l_orderkey").alias("payload_id"), styled(1).alias("html"))


def q_extract_injury_grid(spark, d):
    """X7 over injury-grid pages rendered per order."""
    return extract_injury_grid(injury_pages(Tables(spark, d)))


def q_extract_injury_status(spark, d):
    """X8 over the same pages: tracking id and status per player row."""
    return extract_injury_status(injury_pages(Tables(spark, d)))


def q_extract_id_title_json(spark, d):
    """X5 over map-shaped payloads Spark derives per customer."""
    t = Tables(spark, d)
    entry = F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("title"))
    payloads = t.customer.select(
        F.col("c_custkey").alias("payload_id"),
        F.to_json(F.struct(F.create_map(F.col("c_custkey").cast("string"), entry).alias("teams"))).alias("body"),
    )
    return extract_id_title(payloads, "teams")


def q_extract_id_title_list(spark, d):
    """X5 over list-shaped payloads: the players of each nation, ids as numbers."""
    t = Tables(spark, d)
    player = F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("player_name"), F.col("s_acctbal").alias("xG"))
    per_nation = t.supplier.groupBy("s_nationkey").agg(F.collect_list(player).alias("players"))
    payloads = per_nation.select(F.col("s_nationkey").alias("payload_id"), F.to_json(F.struct("players")).alias("body"))
    return extract_id_title(payloads, "players")


def q_extract_id_title_rosters(spark, d):
    """X5 over match documents: both sides' roster maps, flattened."""
    t = Tables(spark, d)
    named = t.lineitem.withColumn("_id", F.monotonically_increasing_id())
    entry = F.struct(F.col("l_suppkey").alias("id"), F.concat(F.lit("Line "), F.col("l_linenumber").cast("string")).alias("player"))
    side = F.when(F.col("l_linenumber") % 2 == 1, "h").otherwise("a")
    per_side = named.groupBy("l_orderkey", side.alias("_side")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("_id").cast("string"), entry))).alias("_roster")
    )
    doc = per_side.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("_side", "_roster"))).alias("rosters"))
    payloads = doc.select(F.col("l_orderkey").alias("payload_id"), F.to_json(F.struct("rosters")).alias("body"))
    return extract_id_title(payloads, "rosters")


def q_scd2_odd_even(spark, d):
    """D5 in any order: the odd days first, then the even ones, as witnesses keep
    the days that changed nothing when they came."""
    ev = status_events(Tables(spark, d))
    odd = F.day("effective_date") % 2 == 1
    history, witnesses = scd2_apply_late(None, None, ev.filter(odd), ["player_id"], ["status"])
    history, _ = scd2_apply_late(history, witnesses, ev.filter(~odd), ["player_id"], ["status"])
    return history.withColumn("is_current", F.col("valid_to") == F.lit(OPEN_END))


def _customer_state(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", F.col("c_acctbal").cast("decimal(18,2)"))


def q_state_fingerprint(spark, d):
    """O7, first level: the customers' fingerprint in 64 buckets."""
    out = state_fingerprint(_customer_state(Tables(spark, d)), 64)
    return out.select("bucket", "n_rows", F.col("sum_low").cast("string").alias("sum_low"), F.col("sum_high").cast("string").alias("sum_high"))


def q_state_diff(spark, d):
    """O7 between the customers and a later state of them: balances of one
    nation are raised, one segment is listed twice."""
    before = _customer_state(Tables(spark, d))
    raised = F.when(F.col("c_nationkey") == 7, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).cast("decimal(18,2)")
    after = before.withColumn("c_acctbal", raised).unionByName(before.filter("c_mktsegment = 'BUILDING' and c_nationkey <> 7"))
    gone, added = state_diff(before, after)
    return gone.withColumn("side", F.lit("gone")).unionByName(added.withColumn("side", F.lit("added"))).withColumn(
        "c_acctbal", F.col("c_acctbal").cast("double")
    )


def q_dq_metrics_daily(spark, d):
    """Q1 from three daily loads of each table, measured once each and merged."""
    t = Tables(spark, d)

    def merged(df, key, name, child=None, **kw):
        days = [df.filter(F.col(key) % 3 == day) for day in range(3)]
        states = [dqm.measure_state(day, **kw) for day in days]
        if child is not None:
            states += [dqm.orphan_state(day, *child) for day in days]
        return dqm.state_metrics(dqm.merge_states(*states), name, SNAPSHOT_DATE, CHECK_TS)

    customer = merged(
        t.customer,
        "c_custkey",
        "customer",
        not_null=["c_name", "c_acctbal", "c_mktsegment"],
        unique=["c_custkey"],
        valid={"acctbal_non_negative": F.col("c_acctbal") >= 0, "name_format": F.col("c_name").rlike("^Customer#[0-9]+$")},
    )
    orders = merged(
        t.orders,
        "o_orderkey",
        "orders",
        child=("o_custkey", t.customer, "c_custkey"),
        not_null=["o_custkey", "o_orderdate"],
        unique=["o_orderkey"],
        valid={"status_domain": F.col("o_orderstatus").isin("O", "F", "P")},
    )
    labels = merged(
        t.labels,
        "doc_id",
        "labels",
        child=("doc_id", t.documents, "doc_id"),
        not_null=["quality", "toxic"],
        unique=["doc_id"],
        valid={"quality_binary": F.col("quality").isin(0, 1)},
    )
    out = customer.unionByName(orders).unionByName(labels)
    return out.withColumn("check_timestamp", F.col("check_timestamp").cast("timestamp_ntz"))


def _put(df: DataFrame, name: str) -> str:
    """A path below the shared folder with ``df`` in it, as a feed or a mapping lies there."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def q_resolve_report(spark, d):
    """R3 and A9 by path: the name feed of all orders against a mapping that lacks
    one segment's customers; the counts observed on the write."""
    t = Tables(spark, d)
    feed = _put(_name_feed(t).withColumn("team_name", F.lit("all")), "feed")
    known = t.customer.filter(F.col("c_mktsegment") != "BUILDING").select(F.col("c_name").alias("source_name"))
    _, counts = resolve_published(spark, feed, _put(known, "mapping"), "player_name")
    return counts


def q_fact_snapshot(spark, d):
    """L6 run twice for one day: shots cast, stamped and written, the second run in the first one's place."""
    t = Tables(spark, d)
    shots_ = t.lineitem.select(
        F.col("l_orderkey").alias("player_id"),
        F.col("l_linenumber").alias("team_id"),
        F.col("l_extendedprice").cast("string").alias("xg"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.when(F.col("l_returnflag") == "R", " goals").otherwise("")).alias("goals"),
    )
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fact-{uuid.uuid4().hex}"
    for _ in range(2):
        write_fact_match_stats(shots_, path, SNAPSHOT_DATE)
    return spark.read.parquet(path).select("player_id", "team_id", "xg", "actual_goals", F.col("snapshot_date").cast("date").alias("snapshot_date"))


def q_gate_outcomes(spark, d):
    """G1-G4, Q2, Q4 as a report: what each gate raises over whole tables, on a batch that breaks its rule and on one that keeps it."""
    t = Tables(spark, d)
    dates = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    first, last = dates.agg(F.min("day"), F.max("day")).first()
    status = status_events(t)
    logins = t.events.select("user_id", F.to_date("ts").alias("day"))
    metrics = dq_metrics_frame(t)
    contract = t.customer.schema
    runs = {
        "G1 future, bound the first day": lambda: future_date_gate(dates, "day", first),
        "G1 future, bound the last day": lambda: future_date_gate(dates, "day", last),
        "G2 line keys": lambda: validate_composite_keys(t.lineitem, ["l_orderkey", "l_linenumber"]),
        "G2 order keys": lambda: validate_composite_keys(t.orders, ["o_orderkey"]),
        "G3 customers by nation": lambda: dedupe_batch(t.customer, "c_nationkey"),
        "G3 customers twice": lambda: dedupe_batch(t.customer.unionByName(t.customer), "c_custkey"),
        "G4 raw events": lambda: scd2_batch_overlap_gate(logins, ["user_id"], "day"),
        "G4 last event a day": lambda: scd2_batch_overlap_gate(status, ["player_id"], "effective_date"),
        "Q2 above one": lambda: dqm.dq_gate(metrics, 1.01),
        "Q2 at zero": lambda: dqm.dq_gate(metrics, 0.0),
        "Q4 suppliers as customers": lambda: dqm.check_contract(t.supplier, contract),
        "Q4 customers": lambda: dqm.check_contract(t.customer, contract, ["c_custkey"]),
    }
    seen = []
    for name, run in runs.items():
        try:
            run()
            seen.append((name, "passed"))
        except WarehouseError as refused:
            seen.append((name, type(refused).__name__))
    return spark.createDataFrame(seen, "gate string, outcome string")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scd2_odd_even": q_scd2_odd_even,
    "state_fingerprint": q_state_fingerprint,
    "state_diff": q_state_diff,
    "dq_metrics_daily": q_dq_metrics_daily,
    "resolve_report": q_resolve_report,
    "fact_snapshot": q_fact_snapshot,
    "gate_outcomes": q_gate_outcomes,
    "extract_id_title_list": q_extract_id_title_list,
    "extract_id_title_rosters": q_extract_id_title_rosters,
    "player_stats": q_player_stats,
    "injury_summary": q_injury_summary,
    "team_form": q_team_form,
    "team_form_split": q_team_form_split,
    "lookback_baseline": q_lookback_baseline,
    "lookback_split": q_lookback_split,
    "baselines_match": q_baselines_match,
    "squad_deficit": q_squad_deficit,
    "injury_metrics": q_injury_metrics,
    "scd2_apply": q_scd2_apply,
    "scd2_backfill": q_scd2_backfill,
    "injuries_string_dates": q_injuries_string_dates,
    "injury_categories": q_injury_categories,
    "point_in_time": q_point_in_time,
    "timeline_conflicts": q_timeline_conflicts,
    "resolve_ok": q_resolve_ok,
    "resolve_unmatched": q_resolve_unmatched,
    "resolve_warn": q_resolve_warn,
    "dedupe_events": q_dedupe_events,
    "dim_players_scd2": q_dim_players_scd2,
    "merge_scd1": q_merge_scd1,
    "gold_upsert": q_gold_upsert,
    "load_dedup": q_load_dedup,
    "load_incremental": q_load_incremental,
    "load_matches": q_load_matches,
    "load_ids": q_load_ids,
    "pk_violations": q_pk_violations,
    "batch_collisions": q_batch_collisions,
    "dim_hash": q_dim_hash,
    "merge_if_changed": q_merge_if_changed,
    "injuries_gated": q_injuries_gated,
    "resolve_identities": q_resolve_identities,
    "load_rosters": q_load_rosters,
    "load_matches_quarantine": q_load_matches_quarantine,
    "historical_impact": q_historical_impact,
    "active_matches": q_active_matches,
    "running_sum_split": q_running_sum_split,
    "star_health": q_star_health,
    "home_drag": q_home_drag,
    "efficiency": q_efficiency,
    "resilience": q_resilience,
    "dq_metrics": q_dq_metrics,
    "dq_report": q_dq_report,
    "clean_text": q_clean_text,
    "extract_json": q_extract_json,
    "extract_players_json": q_extract_players_json,
    "extract_id_title_json": q_extract_id_title_json,
    "extract_rosters_json": q_extract_rosters_json,
    "extract_shots_json": q_extract_shots_json,
    "extract_match_info": q_extract_match_info,
    "extract_injury_grid": q_extract_injury_grid,
    "extract_injury_status": q_extract_injury_status,
    "extract_grid": q_extract_grid,
    "set_diff": q_set_diff,
    "union_missing": q_union_missing,
}


# ----------------------------------------------------------------- oracle SQL

_TIMELINE = """
ev AS (
  SELECT user_id AS player_id, event_type AS status, CAST(ts AS DATE) AS eff,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events),
dd AS (SELECT player_id, status, eff FROM ev WHERE rn = 1),
ch AS (SELECT *, lag(status) OVER (PARTITION BY player_id ORDER BY eff) AS prev FROM dd),
tl0 AS (
  SELECT player_id, status, eff AS valid_from,
         COALESCE(lead(eff) OVER (PARTITION BY player_id ORDER BY eff), DATE '9999-12-31') AS valid_to
  FROM ch WHERE prev IS NULL OR prev <> status),
tl AS (SELECT player_id, status, valid_from, valid_to, valid_to = DATE '9999-12-31' AS is_current FROM tl0)
"""

_AVG_DEC = (
    "CASE WHEN COUNT({v}) OVER w > 0 THEN CAST(SUM(CAST({v} AS DECIMAL(18,2))) OVER w AS DOUBLE)"
    " / COUNT({v}) OVER w END"
)

_DEFICIT = (
    _TIMELINE
    + """,
inj AS (SELECT player_id FROM tl WHERE status = 'error' AND is_current),
pm AS (SELECT l_suppkey AS player_id, l_orderkey AS match_id, SUM(CAST(l_discount AS DECIMAL(18,2))) AS xg
       FROM lineitem GROUP BY l_suppkey, l_orderkey),
base AS (SELECT player_id, match_id,
           CASE WHEN COUNT(xg) OVER w > 0 THEN CAST(SUM(xg) OVER w AS DOUBLE) / COUNT(xg) OVER w END AS b
         FROM pm WINDOW w AS (PARTITION BY player_id ORDER BY match_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
roster AS (SELECT DISTINCT l_suppkey AS player_id, l_orderkey AS match_id FROM lineitem),
injury AS (SELECT r.player_id, r.match_id, c.c_nationkey AS team_id
           FROM roster r JOIN inj i ON r.player_id = i.player_id JOIN customer c ON c.c_custkey = r.player_id),
deficit AS (
  SELECT i.match_id, i.team_id, COUNT(i.player_id) AS active_injured_count,
         ROUND(SUM(b.b), 9) AS total_squad_xg_drag,
         ROUND(SUM(b.b * CAST(1.1 AS DOUBLE)), 9) AS total_squad_xga_drag
  FROM injury i JOIN roster r ON i.player_id = r.player_id AND i.match_id = r.match_id
  JOIN base b ON i.player_id = b.player_id AND i.match_id = b.match_id
  GROUP BY i.match_id, i.team_id),
fm AS (SELECT o.o_orderkey AS match_id, c.c_nationkey AS team_h,
              CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS pts, o.o_totalprice / 100000 AS xpts
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
"""
)

_METRICS = (
    _TIMELINE
    + """,
m1 AS (SELECT *, CAST(CASE WHEN valid_to = DATE '9999-12-31' THEN date_diff('day', valid_from, DATE '2024-02-01')
                      ELSE date_diff('day', valid_from, valid_to) END AS INTEGER) AS injury_duration_days FROM tl),
m2 AS (SELECT *, CAST(SUM(injury_duration_days) OVER (PARTITION BY player_id ORDER BY valid_from
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_days_lost FROM m1),
m3 AS (SELECT *, CAST(300 - cumulative_days_lost AS DOUBLE) / CAST(300 AS DOUBLE) AS availability_coefficient FROM m2)
"""
)

_LINE_COLS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
_LINE_ORDER = ", ".join(f"{c} NULLS FIRST" for c in _LINE_COLS.split(", ")[2:] if c != "l_linenumber")
_LINE_ORDER = "l_partkey NULLS FIRST, " + _LINE_ORDER

_PLAYER_STATS = """
SELECT l_suppkey AS player_id, COUNT(l_orderkey) AS total_shots,
       CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS total_expected_goals,
       CASE WHEN COUNT(l_discount) > 0 THEN CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_discount) END
         AS avg_shot_quality
FROM lineitem GROUP BY l_suppkey
"""

_ORDER_STATS_FOR = """
SELECT l_orderkey AS player_id, COUNT(l_linenumber) AS total_shots,
       CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS total_expected_goals,
       CASE WHEN COUNT(l_discount) > 0 THEN CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_discount) END
         AS avg_shot_quality
FROM lineitem WHERE l_linestatus = '{flag}' GROUP BY l_orderkey
"""

_TEAM_FORM = f"""
SELECT o_custkey AS team_id, o_orderkey AS match_id, o_totalprice AS xg, CAST(o_orderdate AS DATE) AS "date",
       {_AVG_DEC.format(v="o_totalprice")} AS rolling_avg_xg
FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
"""

_LOOKBACK = f"""
SELECT l_suppkey AS player_id, l_orderkey AS match_id, l_linenumber, l_partkey, l_discount AS xg,
       {_AVG_DEC.format(v="l_discount")} AS rolling_player_xg_5match,
       ({_AVG_DEC.format(v="l_discount")}) * CAST(1.1 AS DOUBLE) AS rolling_player_xga_5match
FROM lineitem
WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_discount
             ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
"""

_DQ = """
WITH cu AS (
  SELECT COUNT(*) AS n, COUNT(c_name) AS nn_name, COUNT(c_acctbal) AS nn_bal, COUNT(c_mktsegment) AS nn_seg,
         COUNT(DISTINCT c_custkey) AS u_key,
         SUM(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END) AS v_bal,
         SUM(CASE WHEN regexp_matches(c_name, '^Customer#[0-9]+$') THEN 1 ELSE 0 END) AS v_name
  FROM customer),
od AS (
  SELECT COUNT(*) AS n, COUNT(o_custkey) AS nn_cust, COUNT(o_orderdate) AS nn_date,
         COUNT(DISTINCT o_orderkey) AS u_key,
         SUM(CASE WHEN o_orderstatus IN ('O', 'F', 'P') THEN 1 ELSE 0 END) AS v_status
  FROM orders),
oo AS (
  SELECT COUNT(*) AS n, COUNT(p.k) AS hit
  FROM orders o LEFT JOIN (SELECT DISTINCT c_custkey AS k FROM customer) p ON o.o_custkey = p.k),
lb AS (
  SELECT COUNT(*) AS n, COUNT(quality) AS nn_q, COUNT(toxic) AS nn_t, COUNT(DISTINCT doc_id) AS u_key,
         SUM(CASE WHEN quality IN (0, 1) THEN 1 ELSE 0 END) AS v_q
  FROM labels),
lo AS (
  SELECT COUNT(*) AS n, COUNT(p.k) AS hit
  FROM labels l LEFT JOIN (SELECT DISTINCT doc_id AS k FROM documents) p ON l.doc_id = p.k),
m AS (
  SELECT 'customer' AS table_name, 'completeness' AS dimension, 'c_name_not_null' AS metric_name, CAST(nn_name AS DOUBLE) / CAST(n AS DOUBLE) AS metric_value FROM cu
  UNION ALL SELECT 'customer', 'completeness', 'c_acctbal_not_null', CAST(nn_bal AS DOUBLE) / CAST(n AS DOUBLE) FROM cu
  UNION ALL SELECT 'customer', 'completeness', 'c_mktsegment_not_null', CAST(nn_seg AS DOUBLE) / CAST(n AS DOUBLE) FROM cu
  UNION ALL SELECT 'customer', 'uniqueness', 'c_custkey_unique', CAST(u_key AS DOUBLE) / CAST(n AS DOUBLE) FROM cu
  UNION ALL SELECT 'customer', 'validity', 'acctbal_non_negative', CAST(v_bal AS DOUBLE) / CAST(n AS DOUBLE) FROM cu
  UNION ALL SELECT 'customer', 'validity', 'name_format', CAST(v_name AS DOUBLE) / CAST(n AS DOUBLE) FROM cu
  UNION ALL SELECT 'orders', 'completeness', 'o_custkey_not_null', CAST(nn_cust AS DOUBLE) / CAST(n AS DOUBLE) FROM od
  UNION ALL SELECT 'orders', 'completeness', 'o_orderdate_not_null', CAST(nn_date AS DOUBLE) / CAST(n AS DOUBLE) FROM od
  UNION ALL SELECT 'orders', 'uniqueness', 'o_orderkey_unique', CAST(u_key AS DOUBLE) / CAST(n AS DOUBLE) FROM od
  UNION ALL SELECT 'orders', 'validity', 'status_domain', CAST(v_status AS DOUBLE) / CAST(n AS DOUBLE) FROM od
  UNION ALL SELECT 'orders', 'consistency', 'o_custkey_has_parent', CAST(hit AS DOUBLE) / CAST(n AS DOUBLE) FROM oo
  UNION ALL SELECT 'labels', 'completeness', 'quality_not_null', CAST(nn_q AS DOUBLE) / CAST(n AS DOUBLE) FROM lb
  UNION ALL SELECT 'labels', 'completeness', 'toxic_not_null', CAST(nn_t AS DOUBLE) / CAST(n AS DOUBLE) FROM lb
  UNION ALL SELECT 'labels', 'uniqueness', 'doc_id_unique', CAST(u_key AS DOUBLE) / CAST(n AS DOUBLE) FROM lb
  UNION ALL SELECT 'labels', 'validity', 'quality_binary', CAST(v_q AS DOUBLE) / CAST(n AS DOUBLE) FROM lb
  UNION ALL SELECT 'labels', 'consistency', 'doc_id_has_parent', CAST(hit AS DOUBLE) / CAST(n AS DOUBLE) FROM lo),
dq AS (SELECT *, 'proportion' AS unit, TIMESTAMP '2024-02-01 06:00:00' AS check_timestamp, DATE '2024-02-01' AS snapshot_date FROM m)
"""

_PAGE_LINKS = r"""
WITH segs AS (
  SELECT page_id, s.seg, CAST(s.pos - 1 AS INTEGER) AS section_pos
  FROM pages, UNNEST(list_zip(string_split_regex(html, '<(?:title|h1)>'),
                              range(1, len(string_split_regex(html, '<(?:title|h1)>')) + 1))) AS u(z),
       LATERAL (SELECT z[1] AS seg, z[2] AS pos) s),
rows AS (
  SELECT page_id, section_pos,
         CASE WHEN section_pos > 0 THEN regexp_extract(seg, '^([^<]*)</(?:title|h1)>', 1) END AS section,
         regexp_extract_all(seg, '<li><a href="([^"]*)">([^<]*)</a></li>', 0) AS items
  FROM segs),
items AS (
  SELECT page_id, section_pos, section, it.z[1] AS row, CAST(it.z[2] - 1 AS INTEGER) AS row_pos
  FROM rows, UNNEST(list_zip(items, range(1, len(items) + 1))) AS it(z))
SELECT page_id, section_pos, row_pos,
       CASE WHEN section IS NOT NULL THEN {clean_section} END AS section,
       regexp_extract(row, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS href,
       {clean_link} AS link_text
FROM items
"""


_MATCH_LINES = """
WITH lines AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                 l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS VARCHAR) AS pos,
         CASE WHEN l_linenumber % 2 = 1 THEN 'h' ELSE 'a' END AS side
  FROM lineitem)
"""


def _html_text_sql(expr: str) -> str:
    out = f"regexp_replace({expr}, '<[^>]*>', '', 'g')"
    for ent, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{ent}', '{ch}')"
    return f"trim(regexp_replace(COALESCE({out}, ''), '{WHITESPACE_CLASS_RE2}+', ' ', 'g'))"


# Two 15-digit numbers of the md5 of each row's texts with their lengths.
_STATE_DIGESTS = """
WITH digests AS (
  SELECT ('0x' || substr(d, 1, 15))::BIGINT AS lo, ('0x' || substr(d, 17, 15))::BIGINT AS hi FROM (
    SELECT md5(""" + " || ".join(
    f"COALESCE(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "CAST(c_acctbal AS DECIMAL(18,2))")
) + """) AS d FROM customer))"""

ORACLE_SQL: dict[str, str] = {
    "player_stats": _PLAYER_STATS,
    "injury_summary": "WITH " + _TIMELINE + """
SELECT c.c_nationkey AS team_id, COUNT(tl.player_id) AS total_injured_players
FROM tl JOIN customer c ON tl.player_id = c.c_custkey
WHERE tl.status = 'error' AND tl.is_current
GROUP BY c.c_nationkey""",
    "team_form": _TEAM_FORM,
    "team_form_split": _TEAM_FORM,
    "lookback_baseline": _LOOKBACK,
    "lookback_split": _LOOKBACK,
    "baselines_match": """
WITH pm AS (SELECT l_suppkey AS player_id, l_orderkey AS match_id, SUM(CAST(l_discount AS DECIMAL(18,2))) AS xg
            FROM lineitem GROUP BY l_suppkey, l_orderkey)
SELECT player_id, match_id,
       CASE WHEN COUNT(xg) OVER w > 0 THEN CAST(SUM(xg) OVER w AS DOUBLE) / COUNT(xg) OVER w END AS rolling_player_xg_5match,
       (CASE WHEN COUNT(xg) OVER w > 0 THEN CAST(SUM(xg) OVER w AS DOUBLE) / COUNT(xg) OVER w END) * CAST(1.1 AS DOUBLE)
         AS rolling_player_xga_5match
FROM pm WINDOW w AS (PARTITION BY player_id ORDER BY match_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""",
    "squad_deficit": "WITH " + _DEFICIT + " SELECT * FROM deficit",
    "injury_metrics": "WITH " + _METRICS + """
SELECT player_id, status, valid_from, valid_to, is_current, injury_duration_days, cumulative_days_lost,
       availability_coefficient FROM m3""",
    "scd2_apply": "WITH " + _TIMELINE + " SELECT * FROM tl",
    "scd2_backfill": """
WITH ev AS (
  SELECT user_id AS player_id, event_type AS status, CAST(ts AS DATE) AS eff,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events),
dd AS (SELECT player_id, status, eff, eff >= DATE '2024-01-16' AS late FROM ev WHERE rn = 1),
ch AS (SELECT *, lag(status) OVER (PARTITION BY player_id, late ORDER BY eff) AS prev FROM dd),
kept AS (SELECT player_id, status, eff, late FROM ch WHERE prev IS NULL OR prev <> status),
first_late AS (SELECT player_id, MIN(eff) AS first_eff FROM kept WHERE late GROUP BY player_id),
tl AS (
  SELECT k.player_id, k.status, k.eff AS valid_from,
         COALESCE(lead(k.eff) OVER (PARTITION BY k.player_id, k.late ORDER BY k.eff),
                  CASE WHEN NOT k.late THEN f.first_eff END, DATE '9999-12-31') AS valid_to
  FROM kept k LEFT JOIN first_late f ON k.player_id = f.player_id)
SELECT player_id, status, valid_from, valid_to, valid_to = DATE '9999-12-31' AS is_current FROM tl""",
    "injuries_string_dates": "WITH " + _TIMELINE + """
SELECT player_id, status, strftime(valid_from, '%Y-%m-%d') AS valid_from, strftime(valid_to, '%Y-%m-%d') AS valid_to
FROM tl""",
    "timeline_conflicts": "WITH " + _TIMELINE + """
SELECT e.event_id, e.user_id AS player_id, CAST(e.ts AS DATE) AS event_date
FROM events e
WHERE EXISTS (
  SELECT 1 FROM tl WHERE tl.player_id = e.user_id AND NOT tl.is_current
     AND CAST(e.ts AS DATE) >= tl.valid_from AND CAST(e.ts AS DATE) < tl.valid_to)""",
    "injury_categories": """
WITH ev AS (
  SELECT user_id AS player_id, event_type AS category,
         CASE WHEN value < 100 THEN 'low' WHEN value < 300 THEN 'mid' ELSE 'high' END AS status,
         CAST(ts AS DATE) AS eff,
         row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events),
dd AS (SELECT player_id, category, status, eff FROM ev WHERE rn = 1),
ch AS (SELECT *, lag(status) OVER (PARTITION BY player_id, category ORDER BY eff) AS prev FROM dd),
tl AS (
  SELECT player_id, category, status, eff AS valid_from,
         COALESCE(lead(eff) OVER (PARTITION BY player_id, category ORDER BY eff), DATE '9999-12-31') AS valid_to
  FROM ch WHERE prev IS NULL OR prev <> status)
SELECT player_id, category, status, valid_from, valid_to, valid_to = DATE '9999-12-31' AS is_current FROM tl""",
    "point_in_time": "WITH " + _TIMELINE + """,
p AS (SELECT player_id, status, valid_from, CASE WHEN is_current THEN NULL ELSE valid_to END AS valid_to FROM tl)
SELECT e.event_id, e.user_id AS player_id, CAST(e.ts AS DATE) AS snapshot_date, e.value AS xg, p.status,
       CASE WHEN p.status = 'error' THEN 'Unavailable' ELSE 'Available' END AS availability_status
FROM events e JOIN p ON e.user_id = p.player_id
 AND CAST(e.ts AS DATE) >= p.valid_from AND (CAST(e.ts AS DATE) < p.valid_to OR p.valid_to IS NULL)""",
    "resolve_ok": """
SELECT o.o_orderkey, o.o_totalprice, m.c_name AS raw_player_name, m.c_custkey AS player_id
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN customer m ON c.c_name = m.c_name""",
    "resolve_unmatched": """
SELECT o.o_orderkey, o.o_totalprice, c.c_name AS player_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE NOT EXISTS (SELECT 1 FROM customer m WHERE m.c_mktsegment <> 'BUILDING' AND m.c_name = c.c_name)""",
    "resolve_warn": """
SELECT o.o_orderkey, o.o_totalprice, m.c_name AS raw_player_name, m.c_custkey AS player_id
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN customer m ON m.c_name = c.c_name AND m.c_mktsegment <> 'BUILDING'""",
    "dedupe_events": "SELECT DISTINCT * FROM events",
    "merge_if_changed": """
WITH s AS (SELECT o_custkey AS k, max(o_orderstatus) = 'P' AS moved,
                  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY o_custkey)
SELECT c_custkey, CASE WHEN moved AND c_mktsegment <> 'PENDING' THEN 'PENDING' ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN moved AND c_mktsegment <> 'PENDING' THEN total ELSE c_acctbal END AS c_acctbal
FROM customer LEFT JOIN s ON c_custkey = k""",
    "injuries_gated": "WITH " + _TIMELINE + """
SELECT player_id, status, strftime(valid_from, '%Y-%m-%d') AS valid_from, strftime(valid_to, '%Y-%m-%d') AS valid_to
FROM tl""",
    "resolve_identities": """
SELECT m.c_custkey AS player_id, m.c_name AS raw_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN customer m ON c.c_name = m.c_name""",
    "load_rosters": """
SELECT DISTINCT l_orderkey AS team_id, l_suppkey AS player_id, CAST(year(l_shipdate) AS VARCHAR) AS season FROM lineitem""",
    "load_matches_quarantine": """
SELECT o_orderkey AS match_id, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS home_id, o_orderpriority AS score,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN 'loaded' ELSE 'quarantined' END AS state
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "historical_impact": "WITH " + _TIMELINE + """
SELECT 'user-' || CAST(e.user_id AS VARCHAR) AS player_name, tl.status AS team_name, CAST(e.ts AS DATE) AS snapshot_date,
       e.value AS xg, CASE WHEN tl.status = 'error' THEN tl.status END AS injury_status,
       CASE WHEN tl.status = 'error' THEN 'Unavailable' ELSE 'Available' END AS availability_status
FROM events e JOIN tl ON e.user_id = tl.player_id
 AND CAST(e.ts AS DATE) >= tl.valid_from AND (CAST(e.ts AS DATE) < tl.valid_to OR tl.is_current)""",
    "active_matches": """
SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "datetime", o_orderstatus = 'F' AS "isResult"
FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderstatus = 'F')
  AND o_orderstatus = 'F'""",
    "running_sum_split": """
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price, l_quantity,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (
         PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS revenue
FROM lineitem""",
    "dim_players_scd2": """
WITH b AS (SELECT c.c_custkey AS player_id, c.c_name AS player_name, n.n_name AS team_name, c.c_mktsegment AS s1
           FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
lt AS (SELECT o_custkey, o_orderpriority AS s2 FROM (
         SELECT o_custkey, o_orderpriority,
                row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders) WHERE rn = 1),
j AS (SELECT b.*, lt.s2, (b.s1 IS DISTINCT FROM lt.s2) AS changed FROM b LEFT JOIN lt ON b.player_id = lt.o_custkey)
SELECT player_id, player_name, team_name, s1 AS injury_status, TIMESTAMP '2024-01-01 06:00:00' AS effective_from,
       CASE WHEN changed THEN TIMESTAMP '2024-02-01 06:00:00' END AS effective_to, NOT changed AS is_current
FROM j
UNION ALL
SELECT player_id, player_name, team_name, s2, TIMESTAMP '2024-02-01 06:00:00', CAST(NULL AS TIMESTAMP), true
FROM j WHERE changed""",
    "merge_scd1": """
WITH src AS (
  SELECT c.c_custkey, c.c_name, CAST(CAST(c.c_acctbal AS DECIMAL(18,2)) - o.open_total AS DOUBLE) AS c_acctbal, c.c_mktsegment
  FROM customer c JOIN (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS open_total
                        FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey),
tgt AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT * FROM tgt WHERE c_custkey NOT IN (SELECT c_custkey FROM src)
UNION ALL SELECT * FROM src""",
    "gold_upsert": "WITH tgt AS (" + _ORDER_STATS_FOR.format(flag="F") + "), src AS (" + _ORDER_STATS_FOR.format(flag="O") + """)
SELECT * FROM tgt WHERE player_id NOT IN (SELECT player_id FROM src) UNION ALL SELECT * FROM src""",
    "load_dedup": f"""
SELECT {_LINE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY src, {_LINE_ORDER}) AS rn
  FROM (SELECT *, CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS src FROM lineitem WHERE l_linestatus IN ('F', 'O')))
WHERE rn = 1""",
    "load_matches": """
SELECT o_orderkey AS match_id, o_custkey AS home_id, o_custkey AS away_id,
       CASE WHEN o_orderstatus = 'F' THEN o_orderstatus ELSE o_orderpriority END AS score
FROM orders""",
    "load_ids": """
WITH init AS (SELECT p_name AS raw_name, MIN(p_partkey) AS team_id FROM part WHERE p_size <= 25 GROUP BY p_name),
nw AS (SELECT DISTINCT p_name AS raw_name FROM part WHERE p_name NOT IN (SELECT raw_name FROM init))
SELECT raw_name, team_id FROM init
UNION ALL
SELECT raw_name, (SELECT MAX(team_id) FROM init) + row_number() OVER (ORDER BY md5(raw_name), raw_name) AS team_id FROM nw""",
    "pk_violations": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "batch_collisions": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_variants FROM (SELECT DISTINCT * FROM lineitem)
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "dim_hash": """
WITH stored AS (SELECT trim(n_name) AS name FROM nation UNION SELECT trim(r_name) FROM region),
feed AS (SELECT trim(n_name) AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION SELECT trim(p_brand) FROM part)
SELECT md5(name) AS team_id, name AS team_name,
       CASE WHEN name IN (SELECT name FROM feed) THEN '2024-02-01' ELSE '2024-01-01' END AS updated_on
FROM (SELECT name FROM stored UNION SELECT name FROM feed)""",
    "star_health": "WITH " + _TIMELINE + """,
ci AS (SELECT c.c_nationkey AS team_id, COUNT(tl.player_id) AS active_injuries
       FROM tl JOIN customer c ON tl.player_id = c.c_custkey
       WHERE tl.is_current AND tl.status = 'error' GROUP BY c.c_nationkey),
f AS (SELECT c.c_nationkey AS team_id, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS snapshot_date,
             CAST(l.l_discount AS DECIMAL(18,2)) AS xg, CAST(l.l_quantity AS INTEGER) AS goals
      FROM lineitem l JOIN customer c ON l.l_suppkey = c.c_custkey)
SELECT n.n_name AS team_name, f.snapshot_date, CAST(SUM(f.xg) AS DOUBLE) AS total_xg,
       CAST(SUM(f.goals) AS BIGINT) AS total_goals, COALESCE(ci.active_injuries, 0) AS injured_player_count,
       CAST(ROUND(CAST(SUM(f.goals) AS DECIMAL(38,2)) - SUM(f.xg), 2) AS DOUBLE) AS finishing_efficiency
FROM f JOIN nation n ON f.team_id = n.n_nationkey LEFT JOIN ci ON f.team_id = ci.team_id
GROUP BY n.n_name, f.snapshot_date, COALESCE(ci.active_injuries, 0)""",
    "home_drag": "WITH " + _DEFICIT + """
SELECT m.match_id, t.n_name AS home_team_title, d.active_injured_count, d.total_squad_xg_drag
FROM fm m JOIN nation t ON m.team_h = t.n_nationkey
JOIN deficit d ON m.match_id = d.match_id AND m.team_h = d.team_id""",
    "efficiency": "WITH " + _DEFICIT + """
SELECT m.match_id, t.n_name AS home_team_title, CAST(m.pts AS DOUBLE) - CAST(m.xpts AS DOUBLE) AS points_mismatch_differential,
       d.total_squad_xg_drag
FROM fm m JOIN nation t ON m.team_h = t.n_nationkey
JOIN deficit d ON m.match_id = d.match_id AND m.team_h = d.team_id""",
    "resilience": "WITH " + _METRICS + """
SELECT s.c_custkey AS player_id, s.c_name AS player_name, m3.availability_coefficient
FROM customer s JOIN m3 ON s.c_custkey = m3.player_id WHERE m3.is_current""",
    "dq_metrics": _DQ + "SELECT table_name, dimension, metric_name, metric_value, unit, check_timestamp, snapshot_date FROM dq",
    "dq_report": _DQ + """
SELECT table_name, dimension, metric_name, metric_value,
       CASE WHEN unit = 'proportion' AND metric_value < 0.95 THEN '🔴 CRITICAL'
            WHEN unit = 'proportion' AND metric_value < 0.99 THEN '🟡 WARNING'
            ELSE '🟢 HEALTHY' END AS status,
       check_timestamp
FROM dq WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM dq)""",
    "clean_text": f"""
SELECT doc_id, trim(regexp_replace(COALESCE(text, ''), '{WHITESPACE_CLASS_RE2}+', ' ', 'g')) AS text_clean FROM documents""",
    "extract_players_json": """
SELECT s.s_suppkey AS payload_id, CAST(s.s_suppkey AS VARCHAR) AS player_id, s.s_name AS name, n.n_name AS team,
       CAST(NULL AS VARCHAR) AS position, s.s_nationkey AS matches, 0 AS minutes, 0 AS goals, 0 AS assists,
       s.s_acctbal AS xg, CAST(0 AS DOUBLE) AS xa, 0 AS shots, 0 AS key_passes, CAST(0 AS DOUBLE) AS npxg,
       CAST(0 AS DOUBLE) AS xg_chain, CAST(0 AS DOUBLE) AS xg_buildup
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "scd2_odd_even": "WITH " + _TIMELINE + " SELECT * FROM tl",
    "state_fingerprint": _STATE_DIGESTS + """
SELECT lo % 64 AS bucket, COUNT(*) AS n_rows, CAST(SUM(lo) AS VARCHAR) AS sum_low, CAST(SUM(hi) AS VARCHAR) AS sum_high
FROM digests GROUP BY lo % 64""",
    "state_diff": """
WITH c AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS c_acctbal,
                  CAST(CAST(c_acctbal AS DECIMAL(18,2)) + 1 AS DOUBLE) AS raised FROM customer)
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal, 'gone' AS side FROM c WHERE c_nationkey = 7
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment, raised, 'added' FROM c WHERE c_nationkey = 7
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal, 'added' FROM c
WHERE c_mktsegment = 'BUILDING' AND c_nationkey <> 7""",
    "dq_metrics_daily": _DQ + "SELECT table_name, dimension, metric_name, metric_value, unit, check_timestamp, snapshot_date FROM dq",
    "resolve_report": """
SELECT COUNT(*) AS raw_rows, COUNT(*) FILTER (WHERE c_mktsegment <> 'BUILDING') AS resolved_rows,
       COUNT(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS left_out
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "fact_snapshot": """
SELECT l_orderkey AS player_id, l_linenumber AS team_id, l_extendedprice AS xg,
       CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) END AS actual_goals, DATE '2024-02-01' AS snapshot_date
FROM lineitem""",
    "gate_outcomes": """
WITH days AS (SELECT CAST(o_orderdate AS DATE) AS day FROM orders),
seen AS (
  SELECT 'G1 future, bound the first day' AS gate, (SELECT COUNT(*) FROM days WHERE day > (SELECT MIN(day) FROM days)) AS n, 'FutureDateError' AS error
  UNION ALL SELECT 'G1 future, bound the last day', (SELECT COUNT(*) FROM days WHERE day > (SELECT MAX(day) FROM days)), 'FutureDateError'
  UNION ALL SELECT 'G2 line keys', (SELECT COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem), 'IntraBatchDuplicateError'
  UNION ALL SELECT 'G2 order keys', (SELECT COUNT(*) - COUNT(DISTINCT o_orderkey) FROM orders), 'IntraBatchDuplicateError'
  UNION ALL SELECT 'G3 customers by nation', (SELECT COUNT(*) - COUNT(DISTINCT c_nationkey) FROM customer), 'IntraBatchDuplicateError'
  UNION ALL SELECT 'G3 customers twice', (SELECT COUNT(*) - COUNT(DISTINCT c_custkey) FROM customer), 'IntraBatchDuplicateError'
  UNION ALL SELECT 'G4 raw events', (SELECT COUNT(*) - COUNT(DISTINCT (user_id, CAST(ts AS DATE))) FROM events), 'SCD2TimelineException'
  UNION ALL SELECT 'G4 last event a day', 0, ''
  UNION ALL SELECT 'Q2 above one', 1, 'DataQualityError'
  UNION ALL SELECT 'Q2 at zero', 0, ''
  UNION ALL SELECT 'Q4 suppliers as customers', 1, 'ContractViolationError'
  UNION ALL SELECT 'Q4 customers', (SELECT COUNT(*) FROM customer WHERE c_custkey IS NULL), 'ContractViolationError')
SELECT gate, CASE WHEN n > 0 THEN error ELSE 'passed' END AS outcome FROM seen""",
    "extract_id_title_list": "SELECT s_nationkey AS payload_id, CAST(s_suppkey AS INTEGER) AS id, s_name AS title FROM supplier",
    "extract_id_title_rosters": """
SELECT l_orderkey AS payload_id, CAST(l_suppkey AS INTEGER) AS id, 'Line ' || CAST(l_linenumber AS VARCHAR) AS title FROM lineitem""",
    "extract_id_title_json": "SELECT c_custkey AS payload_id, CAST(c_custkey AS INTEGER) AS id, c_name AS title FROM customer",
    "extract_rosters_json": _MATCH_LINES + """
SELECT l_orderkey AS payload_id, pos AS roster_id, CAST(l_suppkey AS VARCHAR) AS player_id,
       'Supplier#' || CAST(l_suppkey AS VARCHAR) AS player_name,
       (CASE WHEN l_returnflag = 'R' THEN 'Sub' WHEN l_returnflag = 'A' THEN 'DF' END) IS DISTINCT FROM 'Sub' AS is_start,
       CASE WHEN l_returnflag = 'R' THEN 'Sub' WHEN l_returnflag = 'A' THEN 'DF' END AS position,
       CAST(l_quantity AS INTEGER) AS minutes, side AS team_side
FROM lines""",
    "extract_shots_json": _MATCH_LINES + """
SELECT l_orderkey AS payload_id, pos AS id, 'Supplier#' || CAST(l_suppkey AS VARCHAR) AS player,
       CAST(l_suppkey AS VARCHAR) AS player_id, CAST(l_orderkey AS VARCHAR) AS match_id, l_discount AS xg,
       l_linenumber AS minute, l_returnflag AS result, side AS team_side
FROM lines""",
    "extract_match_info": """
SELECT o.o_orderkey AS payload_id, CAST(o.o_orderkey AS VARCHAR) AS match_id, c.c_name AS home_team,
       n.n_name AS away_team, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS home_goals, 0 AS away_goals,
       o.o_totalprice AS home_xg, CAST(0 AS DOUBLE) AS away_xg, CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS match_date
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "extract_injury_grid": _MATCH_LINES + """,
ranked AS (
  SELECT l.*, c.c_name, n.n_name,
         CAST(row_number() OVER (PARTITION BY l.l_orderkey, l.side ORDER BY CAST(l.pos AS INTEGER)) - 1 AS INTEGER) AS row_pos
  FROM lines l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT l_orderkey AS payload_id, CASE WHEN side = 'h' THEN 1 ELSE 2 END AS section_pos, row_pos,
       CASE WHEN side = 'h' THEN c_name ELSE n_name END AS team,
       'Supplier#' || CAST(l_suppkey AS VARCHAR) || '-' || pos AS player_name,
       l_returnflag AS reason, 'Apr 09: Line ' || CAST(l_linenumber AS VARCHAR) || '.' AS further_detail,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS potential_return, l_linestatus AS condition,
       l_linestatus || '/' || l_returnflag AS status
FROM ranked""",
    "extract_injury_status": """
SELECT l_orderkey AS payload_id, CAST(l_suppkey AS INTEGER) AS id, l_linestatus || '/' || l_returnflag AS title
FROM lineitem""",
    "extract_json": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "extract_grid": _PAGE_LINKS.replace("{clean_section}", _html_text_sql("section")).replace(
        "{clean_link}", _html_text_sql("regexp_extract(row, '<li><a href=\"([^\"]*)\">([^<]*)</a></li>', 2)")
    ),
    "set_diff": "SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey AS custkey FROM orders",
    "union_missing": """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier""",
}

# The incremental load must reach the same state as the one-shot dedup.
ORACLE_SQL["load_incremental"] = ORACLE_SQL["load_dedup"]
