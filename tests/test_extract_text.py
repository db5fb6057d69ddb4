import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.errors import IntraBatchDuplicateError, SelectorNotFoundError, SourceDataMissingError
from tidemark.functions.text import clean_injury_text, clean_whitespace
from tidemark.operators.extract import (
    active_matches,
    extract_id_title,
    extract_injury_grid,
    extract_injury_status,
    extract_league_players,
    extract_match_info,
    extract_rosters,
    extract_shots,
)


def payloads(spark, *bodies):
    return spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "payload_id INT, body STRING")


def test_clean_whitespace(spark):
    df = spark.createDataFrame([("  a \t b\r\n",), ("x  y",), ("",), (None,), ("p q　",)], "s STRING")
    assert [r[0] for r in df.select(clean_whitespace("s")).collect()] == ["a b", "x y", "", "", "p q"]


def test_clean_injury_text(spark):
    df = spark.createDataFrame(
        [("Further Detail  Apr 09: 'He is out.' See player page",), ("Status'50%'",)], "s STRING"
    )
    out = [r[0] for r in df.select(clean_injury_text("s", "Further Detail")).collect()]
    assert out[0] == "Apr 09: He is out."
    assert [r[0] for r in df.select(clean_injury_text("s", "Status")).collect()][1] == "50%"


def test_league_players(spark):
    p = {"players": [{"id": "1", "player_name": "Saka", "team_title": "Arsenal", "games": "10", "xG": "3.5"},
                     {"id": "2", "player_name": "Son", "time": "900"}]}
    out = rows(extract_league_players(payloads(spark, p, {"teams": {}})), "player_id", "name", "matches", "minutes", "xg")
    assert out == [("1", "Saka", 10, 0, 3.5), ("2", "Son", 0, 900, 0.0)]
    with pytest.raises(TypeError):
        extract_league_players(payloads(spark, {"players": [{"id": "1", "games": "ten"}]}))


def test_rosters_and_shots(spark):
    m = {
        "rosters": {"h": {"11": {"player_id": "7", "player": "Saka", "position": "FW", "time": "90"}},
                    "a": {"12": {"player_id": "8", "player": "Son", "position": "Sub"}, "13": {"player_id": "9", "player": "Kane"}}},
        "shots": {"h": [{"id": "1", "player": "Saka", "xG": "0.25", "minute": "10", "player_id": "7", "match_id": "5"}],
                  "a": [{"id": "2", "player": "Son", "xG": "0.5"}]},
    }
    r = rows(extract_rosters(payloads(spark, m)), "roster_id", "player_id", "is_start", "minutes", "team_side")
    assert r == [("11", "7", True, 90, "h"), ("12", "8", False, 0, "a"), ("13", "9", True, 0, "a")]
    s = rows(extract_shots(payloads(spark, m)), "id", "xg", "minute", "match_id")
    assert s == [("1", 0.25, 10, "5"), ("2", 0.5, 0, None)]
    dup = {"rosters": {"h": {"11": {"player": "A"}}, "a": {"11": {"player": "B"}}}}
    with pytest.raises(IntraBatchDuplicateError):
        extract_rosters(payloads(spark, dup))
    dshots = {"shots": {"h": [{"id": "1"}], "a": [{"id": "1"}]}}
    with pytest.raises(IntraBatchDuplicateError):
        extract_shots(payloads(spark, dshots))


def test_id_title_map_or_list_and_gates(spark):
    teams_map = {"teams": {"83": {"id": "83", "title": "Arsenal"}, "82": {"id": "82", "title": "Spurs"}}}
    players_list = {"players": [{"id": "1", "player_name": "Saka"}]}
    assert rows(extract_id_title(payloads(spark, teams_map), "teams"), "id", "title") == [(82, "Spurs"), (83, "Arsenal")]
    assert rows(extract_id_title(payloads(spark, players_list), "players"), "id", "title") == [(1, "Saka")]
    shots = {"shots": {"h": [{"id": "5", "player": "A"}], "a": [{"id": "6", "player": "B"}]}}
    assert rows(extract_id_title(payloads(spark, shots), "shots"), "id", "title") == [(5, "A"), (6, "B")]
    with pytest.raises(SourceDataMissingError):
        extract_id_title(payloads(spark, {"teams": {}}), "players")
    with pytest.raises(ValueError, match="empty"):
        extract_id_title(payloads(spark, {"players": []}), "players")
    with pytest.raises(ValueError, match="lacks"):
        extract_id_title(payloads(spark, {"players": [{"id": "1"}]}), "players")
    with pytest.raises(TypeError):
        extract_id_title(payloads(spark, {"players": [{"id": "x", "player_name": "A"}]}), "players")


def test_match_info(spark):
    info = json.dumps({"id": "29088", "team_h": "Arsenal", "team_a": "Spurs", "h_goals": "2", "h_xg": "1.5"})
    escaped = "".join(f"\\x{ord(c):02X}" if c in '{}":,' else c for c in info)
    html = f"<script>var match_info = JSON.parse('{escaped}');</script>"
    df = spark.createDataFrame([(1, html)], "payload_id INT, html STRING")
    out = extract_match_info(df).first()
    assert (out.match_id, out.home_team, out.away_team, out.home_goals, out.away_goals, out.home_xg) == (
        "29088", "Arsenal", "Spurs", 2, 0, 1.5)
    with pytest.raises(SourceDataMissingError):
        extract_match_info(spark.createDataFrame([(1, "<html></html>")], "payload_id INT, html STRING"))


def _grid(rows_html):
    return f'<html><table class="injury-table">{rows_html}</table></html>'


def _player_row(name, status, pid=None):
    cells = [("Player", name), ("Reason", "Knee"), ("Further Detail", "Apr 09: 'Out.'"),
             ("Potential Return", "May"), ("Condition", "Bad"), ("Status", status)]
    tds = "".join(f'<td><div class="mob-title">{lab}</div> {val} </td>' for lab, val in cells)
    if pid is not None:
        tds += f'<td><a data-id="{pid}" class="btn track">x</a></td>'
    return f'<tr class="player-row team_1">{tds}</tr>'


def test_injury_grid_and_status(spark):
    html = _grid(
        '<tr class="heading"><td><div class="injury-team">Arsenal</div></td></tr>'
        + _player_row("Saka", "50%", 7)
        + '<tr class="heading"><td><div class="injury-team">Spurs &amp; Co</div></td></tr>'
        + _player_row("Son", "Out", 8)
        + _player_row("Kane", "Doubt")
    )
    df = spark.createDataFrame([(1, html)], "payload_id INT, html STRING")
    g = rows(extract_injury_grid(df), "team", "player_name", "further_detail", "status")
    assert g == [("Arsenal", "Saka", "Apr 09: Out.", "50%"), ("Spurs & Co", "Kane", "Apr 09: Out.", "Doubt"),
                 ("Spurs & Co", "Son", "Apr 09: Out.", "Out")]
    assert rows(extract_injury_status(df), "id", "title") == [(7, "50%"), (8, "Out")]
    with pytest.raises(SelectorNotFoundError):
        extract_injury_grid(spark.createDataFrame([(1, "<table></table>")], "payload_id INT, html STRING"))
    dup = spark.createDataFrame([(1, _grid(_player_row("Saka", "a") + _player_row("Saka", "b")))], "payload_id INT, html STRING")
    with pytest.raises(IntraBatchDuplicateError):
        extract_injury_grid(dup)
    bad = spark.createDataFrame([(1, _grid(_player_row("Saka", "a", "x7")))], "payload_id INT, html STRING")
    with pytest.raises(TypeError):
        extract_injury_status(bad)


def test_active_matches(spark):
    dates = spark.createDataFrame(
        [("1", "2024-01-05 15:00:00", True), ("2", "2024-01-05 20:00:00", False), ("3", "2024-01-06 15:00:00", True)],
        "id STRING, datetime STRING, isResult BOOLEAN",
    )
    import datetime as dt

    assert rows(active_matches(dates, dt.date(2024, 1, 5)), "id") == [("1",)]


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "payload_id INT, html STRING")


def test_bad_payloads_raise(spark):
    from tidemark.errors import MalformedPayloadError

    broken = spark.createDataFrame([(1, "{not json")], "payload_id INT, body STRING")
    for extractor in (extract_league_players, extract_rosters, extract_shots):
        with pytest.raises(MalformedPayloadError):
            extractor(broken)
        none = spark.createDataFrame([(1, None)], "payload_id INT, body STRING")
        assert extractor(none).count() == 0
    with pytest.raises(TypeError):
        extract_rosters(payloads(spark, {"rosters": {"h": {"1": {"time": "ninety"}}, "a": {}}}))
    for shot in ({"id": "1", "xG": "much"}, {"id": "1", "minute": "1.5x"}):
        with pytest.raises(TypeError):
            extract_shots(payloads(spark, {"shots": {"h": [shot], "a": []}}))


def test_match_info_plain_escaped_and_bad(spark):
    from tidemark.errors import MalformedPayloadError

    plain = """match_info = JSON.parse('{"id":"7","team_h":"O\\'Neill","h_goals":3}')"""
    double = r"""match_info=JSON.parse("{\"id\":\"8\",\"team_a\":\"D'or\"}");"""
    got = rows(extract_match_info(pages(spark, plain, double)), "match_id", "home_team", "away_team", "home_goals")
    assert got == [("7", "O'Neill", "Unknown", 3), ("8", "Unknown", "D'or", 0)]
    with pytest.raises(MalformedPayloadError):
        extract_match_info(pages(spark, "match_info = JSON.parse('{broken')"))
    with pytest.raises(TypeError):
        extract_match_info(pages(spark, """match_info = JSON.parse('{"h_goals":"x"}')"""))
    with pytest.raises(SourceDataMissingError):
        extract_match_info(pages(spark, None))


def test_grid_on_other_html(spark):
    foreign = "<table class='standings'><tr class='player-row'>" + "<td>no</td>" * 7 + "</tr></table>"
    html = (
        foreign
        + "<table id=x class='wide injury-table'>"
        + "<tr class='heading'><td><div class='injury-team'>K&Oslash;benhavn</div></td></tr>"
        + _player_row("&#216;st &amp; V&#xe9;r&eacute;", "Out", 7).replace('"', "'")
        + "<tr class='heading'><td>no team here</td></tr>"
        + "<tr class='subheading'><td><div class='injury-team'>Wrong</div></td></tr>"
        + _player_row("Second", "50%", 8)
        + "</table>"
        + foreign
    )
    got = rows(extract_injury_grid(pages(spark, html)), "team", "player_name", "status")
    assert got == [("K\u00d8benhavn", "Second", "50%"), ("K\u00d8benhavn", "\u00d8st & V\u00e9r\u00e9", "Out")]
    assert rows(extract_injury_status(pages(spark, html)), "id", "title") == [(7, "Out"), (8, "50%")]
    with pytest.raises(SelectorNotFoundError):
        extract_injury_grid(pages(spark, foreign))


def test_injury_status_gates(spark):
    html = _grid(_player_row("Saka", "50%", 7) + _player_row("Kane", "Doubt"))
    assert rows(extract_injury_status(pages(spark, html))) == [(0, 7, "50%")]
    with pytest.raises(ValueError):
        extract_injury_status(pages(spark, _grid("")))
    with pytest.raises(ValueError, match="no id"):
        extract_injury_status(pages(spark, _grid(_player_row("Saka", "50%", ""))))


def test_wrong_payload_shapes_raise(spark):
    from tidemark.errors import PayloadDriftError

    entry = {"id": "1", "player": "A"}
    wrong = {
        extract_league_players: [
            [entry],  # a list as body
            {"players": {"1": entry}},  # a map instead of the list
            {"players": "none"},
            {"players": [["1", "A"]]},  # entries that are no objects
            {"players": [entry, None]},
            {"players": [{"id": {"n": 1}}]},  # an object where a plain value was
        ],
        extract_rosters: [
            [entry],
            {"rosters": [entry]},
            {"rosters": {"h": [entry], "a": {}}},  # a list instead of the map
            {"rosters": {"h": {"1": "A"}, "a": {}}},
            {"rosters": {"h": {"1": {"time": [90]}}}},
        ],
        extract_shots: [
            "text",
            {"shots": {"h": {"1": entry}, "a": []}},  # a map instead of the list
            {"shots": {"h": [1, 2], "a": []}},
            {"shots": {"h": [], "a": [{"id": "1", "xG": {"v": 1}}]}},
        ],
    }
    good = {"players": [], "rosters": {"h": {}, "a": {}}, "shots": {"h": [], "a": []}, "more": [1]}
    for extractor, bodies in wrong.items():
        for body in bodies:
            with pytest.raises(PayloadDriftError):
                extractor(payloads(spark, good, body))
        assert extractor(payloads(spark, good, {})).count() == 0
        assert extractor(spark.createDataFrame([], "payload_id INT, body STRING")).count() == 0
    for body in ([1], {"teams": "x"}, {"teams": [{"id": [1], "title": "A"}]}):
        with pytest.raises(PayloadDriftError):
            extract_id_title(payloads(spark, body), "teams")


def test_id_title_of_every_dataset_shape(spark):
    one = {"id": 5, "title": "T", "player": "P", "player_name": "N", "datetime": "2024-01-01"}
    two = {**one, "id": "6"}
    for dataset, title in (("teams", "T"), ("players", "N"), ("dates", "2024-01-01"), ("rosters", "P"), ("shots", "P")):
        for shape in ([one, two], {"x": one, "y": two}):
            if dataset in ("rosters", "shots") and isinstance(shape, dict):
                with pytest.raises(ValueError, match="empty"):
                    extract_id_title(payloads(spark, {dataset: shape}), dataset)  # no sides
            else:
                assert rows(extract_id_title(payloads(spark, {dataset: shape}), dataset), "id", "title") == [(5, title), (6, title)]
    for sides in ({"h": {"1": one}, "a": {"2": two}}, {"h": [one], "a": [two]}, {"h": {"1": one}, "a": [two]}):
        assert rows(extract_id_title(payloads(spark, {"rosters": sides}), "rosters"), "id", "title") == [(5, "P"), (6, "P")]


def test_audited_tables_are_published_or_deleted(spark):
    import os

    from tidemark.session import ensure_checkpoint_dir

    def stored():
        base = ensure_checkpoint_dir(spark).removeprefix("file:")
        return {f for f in os.listdir(base) if f.startswith("audited-")}

    before = stored()
    with pytest.raises(TypeError):
        extract_league_players(payloads(spark, {"players": [{"id": "1", "games": "ten"}]}))
    assert stored() == before
    out = extract_league_players(payloads(spark, {"players": [{"id": "1", "games": "10"}]}))
    assert len(stored()) == len(before) + 1
    assert out.count() == 1  # read from the published table: nothing is parsed again
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        out.explain()
    assert "parse_json" not in text.getvalue() and text.getvalue().count("FileScan") == 1


def test_grid_with_nested_tables_upper_case_and_unclosed_cells(spark):
    def loose(name, pid):
        cells = "".join(f"<TD><DIV CLASS='mob-title'>{lab}</DIV> {v}" for lab, v in zip(GRID_LABELS, (name, "Knee", "x", "May", "Bad", "Out")))
        return f"<TR CLASS='team_1 player-row'>{cells}<TD><A CLASS='btn track' DATA-ID={pid}>x</A>"

    from tidemark.operators.extract import GRID_LABELS

    nested = "<tr class='details'><td colspan=7><table><tr><td>Saka: &lt;3</td></tr><tr class=heading><td>none</table></td></tr>"
    html = (
        "<!-- <table class='injury-table'> --><script>var t = '<table class=\"injury-table\">';</script>"
        "<TABLE CLASS='injury-table'><TR CLASS=heading><TH><DIV CLASS=injury-team>A<b>FC</b> &Aacute;</DIV>"
        + loose("Saka", 7)
        + nested
        + loose("a > b &notin; c", 8)
        + "<tr class='player-row'><td>short</td></tr>"
        + loose("Kane <table><tr><td>(on loan)</td></tr></table>", 9)
        + "</TABLE><table class='injury-table'><tr class='player-row'>" + "<td>x</td>" * 7 + "</table>"
    )
    got = rows(extract_injury_grid(pages(spark, html)), "row_pos", "team", "player_name", "status")
    assert got == [(0, "AFC Á", "Saka", "Out"), (1, "AFC Á", "a > b ∉ c", "Out"), (3, "AFC Á", "Kane (on loan)", "Out")]
    assert rows(extract_injury_status(pages(spark, html)), "id", "title") == [(7, "Out"), (8, "Out"), (9, "Out")]
    # a page that breaks off in the middle of a row keeps what there is
    cut = "<table class=injury-table>" + _player_row("Saka", "50%", 7) + '<tr class="player-row"><td>half'
    assert rows(extract_injury_grid(pages(spark, cut)), "player_name") == [("Saka",)]
    assert extract_injury_grid(spark.createDataFrame([], "payload_id INT, html STRING")).count() == 0


def test_active_matches_with_a_broken_time(spark):
    import datetime as dt

    dates = spark.createDataFrame([("1", "2024-01-05 15:00:00", True), ("2", "soon", True)], "id STRING, datetime STRING, isResult BOOLEAN")
    assert rows(active_matches(dates, dt.date(2024, 1, 5)), "id") == [("1",)]


def test_grid_cells_take_the_short_way_and_read_alike(monkeypatch):
    from tidemark.functions import markup

    bits = ["<td>", "</td>", "<TD class=x>", '<div class="mob-title">', "<div class='injury-team'>", "</div>", '<tr class="player-row">',
            "<tr class=heading>", "</tr>", "<table>", "</table>", '<a class="track" data-id="7">', "</a>", "&amp;", "x", "<!-- <td> -->",
            "<script>'<td>'</script>", '<b title="a>b">', "< 5", '<td a"b>', "<td a= 'q>", "<th>", "<br/>", '<div class="injury-team mob-title">']
    rng = random.Random(3)
    made = ['<p><table class="injury-table"><tr class=player-row>' + "".join(rng.choices(bits, k=40)) for _ in range(2000)]

    def read(page):
        grid = markup.GridReader().read(page)
        return grid.found, grid.rows

    short = [read(page) for page in made]
    searched = []

    class Counted:
        def search(self, page, at):
            searched.append(at)
            return tag.search(page, at)

    tag = markup._TAG
    monkeypatch.setattr(markup, "_TAG", Counted())
    read(_grid('<tr class="player-row">' + '<td><div class="mob-title">Status</div> Out </td>' * 200 + "</tr>"))
    assert len(searched) < 10
    monkeypatch.setattr(markup, "_TAG", tag)
    monkeypatch.setattr(markup.GridReader, "_cells", lambda self, page, at: at)
    assert short == [read(page) for page in made]


def test_ids_are_not_gathered_again_for_every_entry(spark, monkeypatch):
    from tidemark.operators import extract

    plans = []

    def look(parsed, counters, rows, audit):
        plans.append(parsed.agg(*counters.values())._jdf.queryExecution().optimizedPlan().toString())
        return parsed

    monkeypatch.setattr(extract, "write_audited", look)
    payloads = spark.createDataFrame([(1, "{}")], "payload_id INT, body STRING")
    extract.extract_shots(payloads)
    extract.extract_rosters(payloads)
    assert all("array_position(" in p and "array_position(transform" not in p for p in plans)


def _told(pages, links=True):
    import pyarrow as pa

    from tidemark.functions.grids import read_grids

    out = []
    for _, _, found, lists in read_grids(pa.array(pages, pa.string()), links):
        out += [(f, [tuple(r.values()) for r in rows]) for f, rows in zip(found.to_pylist(), lists.to_pylist())]
    return out


def test_runs_of_pages_read_as_one_by_one(monkeypatch):
    from tidemark.functions import grids, markup

    bits = ["<td>", "</td>", "<TD class=x>", '<div class="mob-title">', "<div class='injury-team'>", "</div>", '<tr class="player-row">',
            "<tr class=heading>", "</tr>", '<a class="track" data-id="7">', "<a class=x>", "</a>", "&amp;", "x", "&am", "p;q", "&nGt;", "\u00e9&\u00e9&gt\u00e9",
            "&notit; &#65; &#x1F600", ">", "<th>", "<br/>", '<div class="injury-team mob-title">', "<td\u00a0>", '<tr class="&#104;eading">']
    odd = ["<table>", "</TABLE>", "<!-- <td> -->", "<script>'<td>'</script>", '<b title="a>b">', "< 5", '<td a"b>', "<td a= 'q>"]
    starts = ['<p><table class="injury-table">', "<!DOCTYPE html><!-- <table class=injury-table> --><table><tr></table><table class='a injury-table'>",
              "\u00e9\u00a0<b \u3000 x><table class=injury-table>", "<table class=other><tr class=player-row><td>"]
    rng = random.Random(5)
    made = ["", "x"]
    for use in (bits, bits + odd):
        for _ in range(1500):
            row = rng.choice(["<tr class=player-row>", "<tr class=heading>", ""])
            made.append(rng.choice(starts) + row + "".join(rng.choices(use, k=rng.randrange(60))) + rng.choice(["", "</table>", "</table></table><!--"]))
    want = [(g.found, [(*r[:3], list(r[3]), *r[4:]) for r in g.rows]) for g in (markup.GridReader().read(page) for page in made)]
    for size in (1, 5000, grids.RUN_BYTES):
        monkeypatch.setattr(grids, "RUN_BYTES", size)
        assert _told(made) == want
        assert _told(made, links=False) == [(found, [(*r[:5], None, None, None) for r in lines]) for found, lines in want]


def test_plain_grids_are_read_together(monkeypatch):
    """Pages as the registered query has them, and one of everyday markup, need no reading tag by tag."""
    from tidemark.functions import markup

    nested = "<tr class='details'><td colspan=7><table><tr><td>1 &lt; 2</td></tr></table></td></tr>"
    html = "<!DOCTYPE html><script>'<td>'</script>" + _grid("<tr class=heading><td><div class='injury-team'>A<b>FC</b></div>" + _player_row("S\u00f8n &amp; Co", "Out", 7) + nested)
    loud = html.replace("<td", "<TD").replace("</td", "</TD").replace("<tr", "<TR")

    def no_reading(self, page):
        raise AssertionError("read tag by tag")

    monkeypatch.setattr(markup.GridReader, "read", no_reading)
    cells = ["Player S\u00f8n & Co ", "Reason Knee ", "Further Detail Apr 09: 'Out.' ", "Potential Return May ", "Condition Bad ", "Status Out "]
    assert _told([html, loud, html.replace("</td>", "")]) == [(True, [(1, 0, "AFC", cells, 7, True, "7", " Out ")])] * 3


def test_injury_text_step_by_step_is_one_text(spark):
    """Every step gets a text that is computed once: texts of a page's array and of a plain column are cleaned alike."""
    from tidemark.functions.text import INJURY_TEXT_STEPS

    texts = [" Status  a\u00a0\tb\u2028 ", "Status Status x", None, "", "''\"'q'\"''", "see PLAYER page: 'x.'", "a?'", "\x1f", "\"See Player Page\"", "K\u00f8b  y", "'", "\u00e9", "a See Player Pagesee player page b"]
    df = spark.createDataFrame([(texts,)], "t ARRAY<STRING>")
    stepped = F.col("t")
    for step in INJURY_TEXT_STEPS:
        stepped = F.transform(stepped, lambda x: step(x, F.lit("Status")))  # noqa: B023
    want = ["a b", "Status x", "", "", "'q'", ": x.", "a?", "", "", "K\u00f8b y", "", "\u00e9", "a  b"]
    assert df.select(stepped).first()[0] == want
    flat = df.select(F.posexplode("t").alias("i", "s")).select("i", clean_injury_text("s", "Status").alias("c"))
    assert [r.c for r in flat.orderBy("i").collect()] == want
