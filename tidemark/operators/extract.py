"""Bronze extraction as Spark jobs over payload tables.

Every extractor takes a DataFrame with one raw payload per row (JSON text or
an HTML page) and returns flat rows. JSON is read as VARIANT: the container
kinds of every payload and the aggregated schema of all entries are held
against the registered ones before any row is handed on. HTML is read by a
one-pass tokenizer with an element stack (``functions.markup``), mapped over
the pages.

A payload is parsed once: its rows are written to the shared folder while the
gates' counters are observed on the same pass, and the table is handed on only
when they are clean (``operators.audit``); otherwise the typed error is raised.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, NullType, StructField, StructType

from tidemark.errors import (
    MSG_DUP_PLAYER,
    MSG_DUP_ROSTER,
    MSG_DUP_SHOT,
    MSG_GRID_MISSING,
    MSG_MATCH_INFO_MISSING,
    IntraBatchDuplicateError,
    MalformedPayloadError,
    PayloadDriftError,
    SelectorNotFoundError,
    SourceDataMissingError,
)
from tidemark.functions.grids import read_grids
from tidemark.functions.markup import COLUMNS
from tidemark.functions.text import INJURY_TEXT_STEPS, WHITESPACE_CLASS, even_space, html_text
from tidemark.operators.audit import write_audited

# League player fields -> output name and type, in output order.
PLAYER_FIELDS = (
    ("id", "player_id", "string"),
    ("player_name", "name", "string"),
    ("team_title", "team", "string"),
    ("position", "position", "string"),
    ("games", "matches", "int"),
    ("time", "minutes", "int"),
    ("goals", "goals", "int"),
    ("assists", "assists", "int"),
    ("xG", "xg", "double"),
    ("xA", "xa", "double"),
    ("shots", "shots", "int"),
    ("key_passes", "key_passes", "int"),
    ("npxG", "npxg", "double"),
    ("xGChain", "xg_chain", "double"),
    ("xGBuildup", "xg_buildup", "double"),
)

# Dataset -> (id field, label field) for the uniform id/title extract.
ID_TITLE_FIELDS = {
    "teams": ("id", "title"),
    "players": ("id", "player_name"),
    "dates": ("id", "datetime"),
    "rosters": ("id", "player"),
    "shots": ("id", "player"),
}

# Injury grid cell labels, in cell order.
GRID_LABELS = ("Player", "Reason", "Further Detail", "Potential Return", "Condition", "Status")
GRID_COLUMNS = ("player_name", "reason", "further_detail", "potential_return", "condition", "status")

SIDES = ("h", "a")


def _num(raw: Column, dtype: str, default) -> Column:
    """An absent number is the default; gates see to it that a present one casts."""
    return F.coalesce(raw.try_cast(dtype), F.lit(default).cast(dtype))


def _uncastable(raw: Column, dtype: str) -> Column:
    return raw.isNotNull() & raw.try_cast(dtype).isNull()


def _refuse(broken: int | None, bad: int | None, what: str) -> None:
    if broken:
        raise MalformedPayloadError(f"{broken} {what} payloads are not JSON")
    if bad:
        raise TypeError(f"{bad} {what} rows hold a number that does not cast")


# ------------------------------------------------------------------ JSON


def _kind(variant: Column | str) -> Column:
    """OBJECT, ARRAY, STRING, ... of a variant (VOID of a JSON null); NULL where there is none."""
    return F.regexp_extract(F.schema_of_variant(variant), "^[A-Z]+", 0)


def _part(variant: str, path: str) -> Column:
    return F.try_variant_get(variant, path, "variant")


def _read_json(payloads: DataFrame, body: str, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """``key``, ``_v`` (the body as VARIANT) and ``_broken``: a body is there but is no JSON (blank text included)."""
    parsed = payloads.select(key, *keep, F.col(body).isNotNull().alias("_given"), F.try_parse_json(F.col(body)).alias("_v"))
    return parsed.select(key, *keep, "_v", (F.col("_given") & F.col("_v").isNull()).alias("_broken"))


def _other_than(kind: str, *parts: Column | str) -> Column:
    """Whether one of the parts that are there is of another kind."""
    out = F.lit(False)
    for part in parts:
        out = out | F.coalesce(_kind(part) != kind, F.lit(False))
    return out


def _no(kind: str, *parts: str) -> Column:
    """Like :func:`_other_than` for OBJECT or ARRAY, without the schema of all that a part holds."""
    whole = {"OBJECT": "map<string, variant>", "ARRAY": "array<variant>"}[kind]
    out = F.lit(False)
    for part in parts:
        out = out | (F.col(part).isNotNull() & F.try_variant_get(part, "$", whole).isNull())
    return out


def _entry_schema(entries: str) -> Column:
    """Aggregate: the merged schema of all entries, as text."""
    return F.schema_of_variant_agg(entries)


def hold_schema(found: str | None, fields: Sequence[str], what: str) -> None:
    """The drift gate: entries must be objects whose registered fields hold plain values.

    ``found`` is the merged schema of all entries, a list. A field that is new
    or absent is no drift; a registered one that has become a list or an
    object is, and so are entries that are no objects.
    """
    if found is None:
        return
    merged = DataType.fromDDL(found.replace("OBJECT<", "STRUCT<"))
    if isinstance(merged.elementType if isinstance(merged, ArrayType) else merged, NullType):
        return  # no entries at all
    if not isinstance(merged, ArrayType) or not isinstance(merged.elementType, StructType):
        raise PayloadDriftError(f"{what} entries are not objects: {found}")
    for field in merged.elementType:
        if field.name in fields and isinstance(field.dataType, (StructType, ArrayType, MapType)):
            raise PayloadDriftError(f"{what} field {field.name!r} is no plain value: {field.dataType.simpleString()}")


def _json_audit(seen: dict, fields: Sequence[str], what: str, message: str | None = None) -> None:
    """The gates in order: no JSON, another shape, an uncastable number, an id twice in one payload."""
    _refuse(seen["broken"], None, what)
    if seen["drift"]:
        raise PayloadDriftError(f"{seen['drift']} {what} payloads are of another shape than registered")
    hold_schema(seen["entries"], fields, what)
    if seen["holes"]:
        raise PayloadDriftError(f"{seen['holes']} {what} payloads hold a null instead of an entry")
    _refuse(None, seen["bad"], what)
    if message is not None and seen["dup"] is not None:
        raise IntraBatchDuplicateError(f"{message}: {seen['dup']}")


def _struct_of(fields: Sequence[str]) -> str:
    return "struct<" + ", ".join(f"`{f}`: string" for f in fields) + ">"


def _any(entries: str, test) -> Column:
    return F.coalesce(F.exists(entries, test), F.lit(False))


def _bad_numbers(entry: Column, numbers: Sequence[tuple[str, str]]) -> Column:
    bad = F.lit(False)
    for name, dtype in numbers:
        bad = bad | _uncastable(entry[name], dtype)
    return bad


def _first_repeated(ids: str) -> Column:
    """The first of an array's values that stands there before already; NULL when none does."""
    found = F.get(F.filter(ids, lambda x, i: x.isNotNull() & (F.array_position(ids, x) <= i)), 0)
    return F.when(F.size(F.array_distinct(ids)) < F.size(ids), found)


def extract_league_players(payloads: DataFrame, body: str = "body", key: str = "payload_id") -> DataFrame:
    """The league ``players`` list, renamed and typed; absent numbers are 0.

    A payload without ``players`` yields no rows. One that is not JSON raises
    ``MalformedPayloadError``; a body that is no object, ``players`` that is no
    list, entries that are no objects or whose registered fields hold lists or
    objects, ``PayloadDriftError``; a present but uncastable number ``TypeError``.
    """
    fields = [src for src, _, _ in PLAYER_FIELDS]
    numbers = [(src, dtype) for src, _, dtype in PLAYER_FIELDS if dtype != "string"]
    parsed = _read_json(payloads, body, key).select(key, "_v", "_broken", _part("_v", "$.players").alias("_list"))
    parsed = parsed.select(
        "*",
        (_other_than("OBJECT", "_v") | _other_than("ARRAY", "_list")).alias("_drift"),
        F.try_variant_get("_list", "$", f"array<{_struct_of(fields)}>").alias("_entries"),
    )
    counters = {
        "broken": F.count_if("_broken"),
        "drift": F.count_if("_drift"),
        "entries": _entry_schema("_list"),
        "holes": F.count_if(_any("_entries", lambda e: e.isNull())),
        "bad": F.count_if(_any("_entries", lambda e: _bad_numbers(e, numbers))),
    }

    def rows(seen: DataFrame) -> DataFrame:
        out = [F.col(key)]
        for src, dst, dtype in PLAYER_FIELDS:
            raw = F.col(f"p.`{src}`")
            out.append((raw if dtype == "string" else _num(raw, dtype, 0)).alias(dst))
        return seen.select(key, F.explode("_entries").alias("p")).select(*out)

    return write_audited(parsed, counters, rows, lambda seen: _json_audit(seen, fields, "league player"))


# Fields of a roster entry and of a shot.
ROSTER_FIELDS = ("id", "player_id", "team_id", "player", "position", "time")
SHOT_FIELDS = ("id", "player_id", "match_id", "player", "xG", "minute", "result")


def _sides(
    payloads: DataFrame, body: str, key: str, root: str, fields: Sequence[str], numbers: Sequence[tuple[str, str]], as_map: bool
) -> tuple[DataFrame, dict[str, Column]]:
    """Both sides' entries in one array ``_all`` of (side, id, e), and the gates' counters.

    A side is a map of entries (``as_map``, its keys are the ids) or a list.
    """
    parsed = _read_json(payloads, body, key).select(key, "_v", "_broken", _part("_v", f"$.{root}").alias("_root"))
    parsed = parsed.select("*", *[_part("_root", f"$.{s}").alias(f"_{s}") for s in SIDES])
    sides = [f"_{s}" for s in SIDES]
    drift = _no("OBJECT", "_v", "_root") | _no("OBJECT" if as_map else "ARRAY", *sides)
    entry = _struct_of(fields)
    kind = f"map<string, {entry}>" if as_map else f"array<{entry}>"
    parsed = parsed.select(
        key,
        "_broken",
        drift.alias("_drift"),
        *[F.try_variant_get(c, "$", kind).alias(f"{c}_typed") for c in sides],
        *[F.try_variant_get(c, "$", "map<string, variant>" if as_map else "array<variant>").alias(f"{c}_raw") for c in sides],
    )

    def side(c: str) -> Column:
        name = F.lit(c[1:]).alias("side")
        if as_map:
            made = F.transform(F.map_entries(f"{c}_typed"), lambda e: F.struct(name, e["key"].alias("id"), e["value"].alias("e")))
        else:
            made = F.transform(f"{c}_typed", lambda e: F.struct(name, e["id"].alias("id"), e.alias("e")))
        return F.coalesce(made, F.array().cast(f"array<struct<side: string, id: string, e: {entry}>>"))

    def raw(c: str) -> Column:
        values = F.map_values(f"{c}_raw") if as_map else F.col(f"{c}_raw")
        return F.coalesce(values, F.array().cast("array<variant>"))

    parsed = parsed.select(
        key,
        "_broken",
        "_drift",
        F.concat(*[side(c) for c in sides]).alias("_all"),
        F.to_variant_object(F.concat(*[raw(c) for c in sides])).alias("_list"),
    )
    # The ids are a column of their own: an expression would be computed again for every id it is held against.
    parsed = parsed.select("*", F.transform("_all", lambda x: x["id"]).alias("_ids")).withColumn("_dup", _first_repeated("_ids"))
    counters = {
        "broken": F.count_if("_broken"),
        "drift": F.count_if("_drift"),
        "entries": _entry_schema("_list"),
        "holes": F.count_if(_any("_all", lambda x: x["e"].isNull())),
        "bad": F.count_if(_any("_all", lambda x: _bad_numbers(x["e"], numbers))),
        "dup": F.max("_dup"),
    }
    return parsed, counters


def extract_rosters(payloads: DataFrame, body: str = "body", key: str = "payload_id") -> DataFrame:
    """Both sides' roster maps, home first.

    ``roster_id`` is the map key (emitted as player_id by the original
    parser, trap T22) and ``player_id`` the id inside the entry. ``is_start`` is true
    unless the position is 'Sub' (an absent position counts as a start). A
    roster id on both sides of one match raises ``IntraBatchDuplicateError``,
    a payload that is not JSON ``MalformedPayloadError``, one whose sides are
    no maps of objects with plain fields ``PayloadDriftError``, uncastable
    minutes ``TypeError``.
    """
    parsed, counters = _sides(payloads, body, key, "rosters", ROSTER_FIELDS, [("time", "int")], as_map=True)

    def rows(seen: DataFrame) -> DataFrame:
        return seen.select(key, F.explode("_all").alias("x")).select(
            key,
            F.col("x.id").alias("roster_id"),
            F.col("x.e.player_id").alias("player_id"),
            F.col("x.e.player").alias("player_name"),
            (~F.col("x.e.position").eqNullSafe(F.lit("Sub"))).alias("is_start"),
            F.col("x.e.position").alias("position"),
            _num(F.col("x.e.time"), "int", 0).alias("minutes"),
            F.col("x.side").alias("team_side"),
        )

    return write_audited(parsed, counters, rows, lambda seen: _json_audit(seen, ROSTER_FIELDS, "roster", MSG_DUP_ROSTER))


def extract_shots(payloads: DataFrame, body: str = "body", key: str = "payload_id") -> DataFrame:
    """Both sides' shot lists; keeps player_id/match_id for the fact.

    A shot id twice in one match raises ``IntraBatchDuplicateError``, a
    payload that is not JSON ``MalformedPayloadError``, one whose sides are no
    lists of objects with plain fields ``PayloadDriftError``, an uncastable xG
    or minute ``TypeError``.
    """
    numbers = [("xG", "double"), ("minute", "int")]
    parsed, counters = _sides(payloads, body, key, "shots", SHOT_FIELDS, numbers, as_map=False)

    def rows(seen: DataFrame) -> DataFrame:
        return seen.select(key, F.explode("_all").alias("x")).select(
            key,
            F.col("x.id").alias("id"),
            F.col("x.e.player").alias("player"),
            F.col("x.e.player_id").alias("player_id"),
            F.col("x.e.match_id").alias("match_id"),
            _num(F.col("x.e.xG"), "double", 0.0).alias("xg"),
            _num(F.col("x.e.minute"), "int", 0).alias("minute"),
            F.col("x.e.result").alias("result"),
            F.col("x.side").alias("team_side"),
        )

    return write_audited(parsed, counters, rows, lambda seen: _json_audit(seen, SHOT_FIELDS, "shot", MSG_DUP_SHOT))


# The assignment, its opening quote, and the text up to the same quote before the closing bracket.
MATCH_INFO = r"""(?s)\bmatch_info\s*=\s*JSON\s*\.\s*parse\s*\(\s*(["'])(.+?)\1\s*\)"""


def _js_text(literal: Column) -> Column:
    r"""The text that a quoted script literal stands for; NULL when it stands for none.

    The literal is made the inside of a JSON string: ``\xNN`` becomes
    ``\u00NN``, an escaped apostrophe a bare one, a bare quote an escaped one.
    """
    text = F.regexp_replace(literal, r"\\x([0-9A-Fa-f]{2})", r"\\u00$1")
    text = F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\'", "$1'")
    text = F.regexp_replace(text, r'(?<!\\)((?:\\\\)*)"', r'$1\\"')
    return F.get_json_object(F.concat(F.lit('{"v":"'), text, F.lit('"}')), "$.v")


def extract_match_info(pages: DataFrame, html: str = "html", key: str = "payload_id") -> DataFrame:
    """The ``match_info = JSON.parse('...')`` block of a match page.

    The literal may be escaped or plain. Absent fields: id "0", teams
    "Unknown", goals 0, xG 0.0. A page without the block raises
    ``SourceDataMissingError``, a block that is not JSON
    ``MalformedPayloadError``, an uncastable number ``TypeError``; one
    aggregation counts all three.
    """
    raw = F.regexp_extract(F.coalesce(F.col(html), F.lit("")), MATCH_INFO, 2)
    x = pages.select(key, raw.alias("_raw"))
    x = x.select(key, "_raw", _js_text(F.col("_raw")).alias("_json"))
    numbers = (("h_goals", "int", 0), ("a_goals", "int", 0), ("h_xg", "double", 0.0), ("a_xg", "double", 0.0))
    info = F.from_json(
        F.col("_json"),
        "struct<id: string, team_h: string, team_a: string, h_goals: string, a_goals: string, "
        "h_xg: string, a_xg: string, date: string>",
    )
    y = x.select(key, "_raw", F.get_json_object("_json", "$").isNull().alias("_broken"), info.alias("i"))
    bad = F.lit(False)
    for field, dtype, _ in numbers:
        bad = bad | _uncastable(F.col(f"i.{field}"), dtype)
    counters = {
        "absent": F.count_if(F.col("_raw") == ""),
        "broken": F.count_if((F.col("_raw") != "") & F.col("_broken")),
        "bad": F.count_if(bad),
    }

    def audit(seen: dict) -> None:
        if seen["absent"]:
            raise SourceDataMissingError(f"{MSG_MATCH_INFO_MISSING} in page")
        _refuse(seen["broken"], seen["bad"], "match info")

    def rows(seen: DataFrame) -> DataFrame:
        value = {field: _num(F.col(f"i.{field}"), dtype, default) for field, dtype, default in numbers}
        return seen.select(
            key,
            F.coalesce(F.col("i.id"), F.lit("0")).alias("match_id"),
            F.coalesce(F.col("i.team_h"), F.lit("Unknown")).alias("home_team"),
            F.coalesce(F.col("i.team_a"), F.lit("Unknown")).alias("away_team"),
            value["h_goals"].alias("home_goals"),
            value["a_goals"].alias("away_goals"),
            value["h_xg"].alias("home_xg"),
            value["a_xg"].alias("away_xg"),
            F.col("i.date").alias("match_date"),
        )

    return write_audited(y, counters, rows, audit)


def extract_id_title(
    payloads: DataFrame, dataset: str, body: str = "body", key: str = "payload_id"
) -> DataFrame:
    """X5 + X6: uniform ``(id INT, title STRING)`` rows of one dataset.

    Accepts the dataset as a map or a list; of rosters and shots given as a
    map, the h then a sides are flattened, each a map or a list. Gates, raised
    in this order: body not JSON -> MalformedPayloadError; body no object, or
    dataset neither map nor list -> PayloadDriftError; root key absent ->
    SourceDataMissingError; empty dataset -> ValueError; id or label missing ->
    ValueError; id or label no plain value -> PayloadDriftError; id not an
    integer -> TypeError.
    """
    if dataset not in ID_TITLE_FIELDS:
        raise ValueError(f"unknown dataset {dataset!r}")
    id_f, label_f = ID_TITLE_FIELDS[dataset]
    none = F.array().cast("array<variant>")

    def elements(part: str) -> Column:
        """The entries of a list, or the values of a map; none of anything else."""
        listed = F.when(_kind(part) == "ARRAY", F.try_variant_get(part, "$", "array<variant>"))
        mapped = F.when(_kind(part) == "OBJECT", F.map_values(F.try_variant_get(part, "$", "map<string, variant>")))
        return F.coalesce(listed, mapped, none)

    parsed = _read_json(payloads, body, key).select(key, "_v", "_broken", _part("_v", f"$.{dataset}").alias("_root"))
    parsed = parsed.select("*", *[_part("_root", f"$.{s}").alias(f"_{s}") for s in SIDES])
    entries = elements("_root")
    if dataset in ("rosters", "shots"):
        both = F.concat(*[elements(f"_{s}") for s in SIDES])
        entries = F.when(_kind("_root") == "OBJECT", both).otherwise(entries)
    scalar = F.coalesce(~_kind("_root").isin("OBJECT", "ARRAY", "VOID"), F.lit(False))
    parsed = parsed.select(
        key,
        "_broken",
        (_other_than("OBJECT", "_v") | scalar).alias("_drift"),
        (F.col("_v").isNotNull() & F.col("_root").isNull()).alias("_no_root"),
        (F.col("_root").isNotNull() & (F.size(entries) == 0)).alias("_empty"),
        entries.alias("_entries"),
    )
    typed = F.transform(
        "_entries", lambda e: F.struct(F.try_variant_get(e, f"$.{id_f}", "string").alias("id"), F.try_variant_get(e, f"$.{label_f}", "string").alias("title"))
    )
    parsed = parsed.select("*", typed.alias("_typed"), F.to_variant_object("_entries").alias("_list"))
    counters = {
        "broken": F.count_if("_broken"),
        "drift": F.count_if("_drift"),
        "no_root": F.count_if("_no_root"),
        "empty": F.count_if("_empty"),
        "missing": F.count_if(_any("_typed", lambda x: x["id"].isNull() | x["title"].isNull())),
        "badtype": F.count_if(_any("_typed", lambda x: _uncastable(x["id"], "int"))),
        "entries": _entry_schema("_list"),
    }

    def audit(seen: dict) -> None:
        _refuse(seen["broken"], None, dataset)
        if seen["drift"]:
            raise PayloadDriftError(f"{seen['drift']} payloads hold '{dataset}' in another shape than a map or a list")
        if seen["no_root"]:
            raise SourceDataMissingError(f"Payload has no '{dataset}' key")
        if seen["empty"]:
            raise ValueError(f"Dataset '{dataset}' is empty")
        if seen["missing"]:
            raise ValueError(f"A '{dataset}' record lacks its id or label field")
        hold_schema(seen["entries"], (id_f, label_f), dataset)
        if seen["badtype"]:
            raise TypeError(f"A '{dataset}' id is not an integer")

    def rows(seen: DataFrame) -> DataFrame:
        return seen.select(key, F.explode("_typed").alias("x")).select(key, F.col("x.id").try_cast("int").alias("id"), F.col("x.title").alias("title"))

    return write_audited(parsed, counters, rows, audit)


def active_matches(dates: DataFrame, run_date, datetime_col: str = "datetime", result_col: str = "isResult") -> DataFrame:
    """Matches of the dates feed played on ``run_date``; one whose time is no date is on none."""
    return dates.filter((F.try_to_date(F.col(datetime_col).cast("string")) == F.lit(run_date)) & F.col(result_col))


# ------------------------------------------------------------------ HTML


def carry_down_rows(
    pages: DataFrame,
    key: str,
    html: str,
    heading_split: str,
    heading_text: str,
    row_pattern: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of a document, each tagged with the nearest heading above it.

    The page is split at every heading marker (``heading_split``); segment
    0 precedes the first heading. ``heading_text`` captures the heading from
    the start of its segment; ``row_pattern`` matches the rows of a segment.
    The carry-down needs no window and no shuffle: a row's heading is the one
    that starts its segment. Output: key, ``keep`` columns, section_pos,
    row_pos, section, row.
    """
    segs = pages.select(key, *keep, F.posexplode(F.split(F.col(html), heading_split)).alias("section_pos", "_seg"))
    segs = segs.withColumn(
        "section",
        F.when(F.col("section_pos") > 0, F.regexp_extract("_seg", heading_text, 1)),
    )
    rows = segs.select(
        key,
        *keep,
        "section_pos",
        "section",
        F.posexplode(F.regexp_extract_all("_seg", F.lit(row_pattern), 0)).alias("row_pos", "row"),
    )
    return rows


GRID_ROWS = "array<struct<section_pos: int, row_pos: int, team: string, cells: array<string>, n_cells: int, link: boolean, data_id: string, status: string>>"


def _grid_reader(links: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, found, rows in read_grids(batch.column(1), links):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), found, rows], ["key", "found", "rows"])

    return read


def _grids(pages: DataFrame, key: str, html: str, links: bool) -> DataFrame:
    """Every page with ``_has_table`` and ``_rows``, the player rows of its first injury grid, parsed once.

    ``links``: with the rows' tracking link and status.
    """
    plain = pages.select(F.col(key).alias("key"), F.col(html).alias("html"))
    schema = StructType([StructField("key", plain.schema["key"].dataType)])
    schema = schema.add("found", "boolean").add("rows", DataType.fromDDL(GRID_ROWS))
    read = plain.mapInArrow(_grid_reader(links), schema)
    return read.select(F.col("key").alias(key), F.col("found").alias("_has_table"), F.col("rows").alias("_rows"))


def extract_injury_grid(pages: DataFrame, key: str = "payload_id", html: str = "html") -> DataFrame:
    """Team-tagged injury rows (rows with at least six cells).

    Only the page's injury table is read, tables nested in it included. The
    team comes from the nearest heading row above that names one; all HTML
    entities are decoded and each cell is cleaned by :func:`clean_injury_text`
    with its mobile label. A page without the grid raises
    ``SelectorNotFoundError``, a player twice on one page
    ``IntraBatchDuplicateError``.
    """
    grids = _grids(pages, key, html, links=False)
    full = grids.select(key, "_has_table", F.filter("_rows", lambda r: r["n_cells"] >= COLUMNS).alias("_full"))
    # A page's cells in one array, cleaned step by step; a full row has as many as there are labels.
    cells = F.flatten(F.transform("_full", lambda r: r["cells"]))
    labels = F.array(*[F.lit(label) for label in GRID_LABELS])
    for step in INJURY_TEXT_STEPS:
        cells = F.transform(cells, lambda x, i: step(x, F.get(labels, i % COLUMNS)))  # noqa: B023 (called at once)
    cleaned = full.select("*", cells.alias("_cells"))
    names = cleaned.select("*", F.transform("_full", lambda r, i: F.get("_cells", i * COLUMNS)).alias("_names"))
    named = names.withColumn("_dup", _first_repeated("_names"))
    counters = {"no_table": F.count_if(~F.col("_has_table")), "dup": F.max("_dup")}

    def audit(seen: dict) -> None:
        if seen["no_table"]:
            raise SelectorNotFoundError(f"{MSG_GRID_MISSING} in page")
        if seen["dup"] is not None:
            raise IntraBatchDuplicateError(f"{MSG_DUP_PLAYER}: {seen['dup']}")

    def rows(seen: DataFrame) -> DataFrame:
        each = seen.select(key, "_cells", F.posexplode("_full").alias("_row", "x"))
        team = F.when(F.col("x.team").isNotNull(), even_space(F.col("x.team"))).alias("team")
        cells = [F.get("_cells", F.col("_row") * COLUMNS + i).alias(c) for i, c in enumerate(GRID_COLUMNS)]
        return each.select(key, "x.section_pos", "x.row_pos", team, *cells)

    return write_audited(named, counters, rows, audit)


def extract_injury_status(pages: DataFrame, key: str = "payload_id", html: str = "html") -> DataFrame:
    """``(id INT, title STRING)`` from player rows: id from the tracking link
    in the seventh cell, status from the sixth cell without its mobile title.

    Rows with fewer than seven cells or no tracking link are skipped. Gates,
    raised in this order: no grid -> SelectorNotFoundError; no player rows, or
    no usable row -> ValueError; a tracking link without an id, or an empty
    status -> ValueError; a non-integer id -> TypeError.
    """
    # Outer white space of a status goes, inner white space stays.
    usable = F.transform(
        F.filter("_rows", lambda r: r["link"]),
        lambda r: F.struct(
            F.trim(F.coalesce(r["data_id"], F.lit(""))).alias("id"),
            F.regexp_replace(r["status"], f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$", "").alias("title"),
        ),
    )
    parsed = _grids(pages, key, html, links=True).select(key, "_has_table", usable.alias("_usable"))
    counters = {
        "no_table": F.count_if(~F.col("_has_table")),
        "unusable": F.count_if(F.col("_has_table") & (F.size("_usable") == 0)),
        "no_id": F.count_if(_any("_usable", lambda x: x["id"] == "")),
        "no_status": F.count_if(_any("_usable", lambda x: x["title"] == "")),
        "bad_id": F.count_if(_any("_usable", lambda x: _uncastable(x["id"], "int"))),
    }

    def audit(seen: dict) -> None:
        if seen["no_table"]:
            raise SelectorNotFoundError(f"{MSG_GRID_MISSING} in page")
        if seen["unusable"]:
            raise ValueError("Page has no usable injury rows")
        if seen["no_id"]:
            raise ValueError("Injury row whose tracking link has no id")
        if seen["no_status"]:
            raise ValueError("Injury row without a status")
        if seen["bad_id"]:
            raise TypeError("Injury row id is not an integer")

    def rows(seen: DataFrame) -> DataFrame:
        return seen.select(key, F.explode("_usable").alias("x")).select(key, F.col("x.id").try_cast("int").alias("id"), F.col("x.title").alias("title"))

    return write_audited(parsed, counters, rows, audit)


# Page-analogue patterns — headings are <title> and <h1>, rows are
# navigation links.
PAGE_HEADING_SPLIT = "<(?:title|h1)>"
PAGE_HEADING_TEXT = "^([^<]*)</(?:title|h1)>"
PAGE_LINK = "<li><a href=\"([^\"]*)\">([^<]*)</a></li>"


def extract_page_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """The grid extractor's shape on web pages: each nav link with the heading above it."""
    rows = carry_down_rows(pages, key, html, PAGE_HEADING_SPLIT, PAGE_HEADING_TEXT, PAGE_LINK)
    return rows.select(
        key,
        "section_pos",
        "row_pos",
        F.when(F.col("section").isNotNull(), html_text(F.col("section"))).alias("section"),
        F.regexp_extract("row", PAGE_LINK, 1).alias("href"),
        html_text(F.regexp_extract("row", PAGE_LINK, 2)).alias("link_text"),
    )


def extract_json_fields(df: DataFrame, col: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """Typed fields of a JSON column (``from_json`` with an explicit schema)."""
    parsed = F.from_json(F.col(col), schema)
    return df.select(*keep, parsed.alias("_j")).select(*keep, "_j.*")
