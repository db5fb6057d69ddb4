import json
import math
import zlib
from types import SimpleNamespace

import duckdb
import numpy as np
import pandas as pd
import pytest

from tests.llm.conftest import collected
from tidemark.llm import link_graph, perm_index, tool_links, toxicity
from tidemark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_toxicity_is_learnt_from_other_folds(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.toxicity(docs, labels).toPandas()
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    both = got[got["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert (both["predicted"] == both["toxic"]).mean() > 0.95
    assert both[both["toxic"] == 0]["predicted"].mean() < 0.01
    assert both[both["toxic"] == 1]["predicted"].mean() > 0.6


def test_interactions_are_learnt():
    """An insult with a group's name is toxic, either alone is not: no additive weights can tell."""
    rng = np.random.default_rng(0)
    places_of, rows = toxicity.TermPlaces(), []
    for _ in range(1500):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.integers(40)}" for _ in range(20)] + ["insult"] * insult + ["group"] * group
        rows.append((*toxicity.term_vector(" ".join(words), places_of), int(insult and group)))
    machine = toxicity.fit(rows[:1200], epochs=30)
    right = [(machine.score(p, x) >= 0.5) == bool(y) for p, x, y in rows[1200:]]
    assert np.mean(right) > 0.95


def test_scores_equal_the_plain_sum_over_all_pairs():
    rng = np.random.default_rng(6)
    places = np.array([2, 5, 9, 11, 30], np.int32)
    machine = toxicity.FactorizationMachine(0.3, places, rng.normal(size=5), rng.normal(size=(5, toxicity.FACTORS)))
    for held in ([2, 5, 9, 11, 30], [5, 7, 30], [3], []):
        x = rng.random(len(held)).astype(np.float32)
        raw = machine.bias
        terms = [(int(np.flatnonzero(places == p)[0]), float(w)) for p, w in zip(held, x) if p in places]
        for n, (i, a) in enumerate(terms):
            raw += machine.linear[i] * a
            for j, b in terms[n + 1 :]:
                raw += float(machine.factors[i] @ machine.factors[j]) * a * b
        assert machine.score(np.array(held, np.int32), x) == pytest.approx(1 / (1 + np.exp(-raw)), rel=1e-6)


def test_the_sample_holds_one_row_per_labelled_id_present(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda rows, **kw: seen.update(rows=rows))
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(ids[0], f"copy {i % 3}") for i in range(300)] + [(i, f"text {i}") for i in ids[1:40]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")  # most have no document
    toxicity.train(docs, labels)
    assert len(seen["rows"]) == 40
    toxicity.train(docs, labels, sample_rows=25)
    assert len(seen["rows"]) == 25


def test_toxicity_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(10, 1), (20, 0), (20, 1), (None, 1), (30, None)], "doc_id long, toxic int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxicity(odd_docs, none).collect()} == {0.5}
    got = toxicity.toxicity(odd_docs, labels)
    assert got.count() == odd_docs.count() and got.filter("score is null or held_out is null").count() == 0
    assert toxicity.toxicity(no_docs, labels).count() == 0
    clean = toxicity.drop_toxic(odd_docs.drop("id"), labels)
    assert clean.columns == ["doc_id", "text", "grp", "n"]


PAGES = [
    (1, "https://a.example.net/en/x?u=/de/", '<a href="https://b.example.net/en/">x</a> <a HREF=\'//C.Example.com/p\'>'),
    (2, "http://B.Example.NET/de/y#z", "<a href=http://c.example.com/de/> <img src='https://a.example.net/i.png'>"),
    (3, "https://c.example.com/de/1", '<a href="/rel">r</a>'),
    (4, "https://c.example.com/de/2", None),
    (5, "https://c.example.com/en/3", ""),
    (6, "x://fr.org/fr/a", '<a href="https://c.example.com/">'),
    (6, "x://fr.org/fr/a", '<a href="https://c.example.com/">'),
    (7, "https://links.org/", '<a href="https://c.example.com/"><a href="https://d.net/x">'),
    (8, "https://d.net", ""),
    (9, "no scheme", "<a href=https://d.net/>"),
    (10, None, "<a href=https://d.net/>"),
    (11, "a://b://c", ""),
    (12, "https://net/", ""),
    (13, "https://xnet/", "x" * 300_000),
    (None, "https://sub.example.net/en", ""),
    (14, "https://alone.example.com/de/1", ""),
    (15, "https://alone.example.com/de/2", ""),
    (16, "https://alone.example.com/en/3", ""),
]


def test_link_graph_equals_sql_and_rules(spark):
    pages = spark.createDataFrame([(*p, "k") for p in PAGES], "page_id long, url string, html string, trust string")
    got = collected(link_graph.judge(pages), "page_id", "host", "path", "rule", "verdict")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    want = con.execute("SELECT page_id, host, path, rule, verdict FROM (" + link_graph.judge_sql() + ")").fetchall()
    assert got == sorted(want, key=lambda t: tuple((v is not None, v) for v in t))
    by = {r[0]: r[1:] for r in got if r[0]}
    assert by[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert by[2][2:] == ("net/", "block") and by[3][2:] == ("example.com/de/", "block")
    assert by[6][2:] == ("org/fr/", "allow") and by[8][2] is None  # an empty path fits no rule
    assert by[9] == ("", "", None, "allow") and by[10] == ("", "", None, "allow") and by[11][0] == "b:"
    assert by[16][2:] == (None, "block")  # two thirds of its host's pages are blocked
    assert by[5][2:] == (None, "allow")  # so are this one's, but trusted hosts link there


def test_trust_flows_along_and_distrust_against_the_edges(spark):
    seeds = spark.createDataFrame([("good", 1.0, 0.0), ("bad", 0.0, 1.0)], "host string, trusted double, blocked double")
    edges = spark.createDataFrame([("good", "friend"), ("spam", "bad"), ("good", "other")], "src string, dst string")
    got = {r["host"]: r for r in link_graph.propagate(seeds, edges).collect()}
    d = link_graph.DAMPING
    assert got["friend"]["trust"] == pytest.approx((1 - d) * d / 2) and got["friend"]["distrust"] == 0
    assert got["spam"]["distrust"] == pytest.approx((1 - d) * d) and got["spam"]["trust"] == 0
    assert link_graph.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def brute_nearest(rows, queries, k):
    out = {}
    for q, v in queries:
        found = sorted((-math.fsum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q)
        out[q] = [(i, -s) for s, i in found[:k]]
    return out


def test_search_finds_neighbours_of_unequal_lengths_and_copies(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 16)) * rng.uniform(0.5, 1.5, size=(1200, 1))
    x[300:700] = x[5]  # a third are copies of one vector
    x = x.astype(np.float32).astype(np.float64)
    rows = [(i, [float(f) for f in v]) for i, v in enumerate(x)]
    bad = [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [None] + [1.0] * 15), (2080, [1.0]), (2100, [])]
    df = spark.createDataFrame([(i, v, i) for i, v in rows + bad + [(None, rows[0][1])]], "vec_id long, embedding array<float>, pos long")
    got = {}
    for r in sorted(perm_index.search(df, df.filter("vec_id % 20 = 0")).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    want = brute_nearest(rows, rows[::20], 20)
    assert set(got) == set(want)
    recall = []
    score = dict(rows)
    for q, found in got.items():
        assert [k for *_, k in found] == list(range(1, 21))
        assert [(-s, i) for i, s, _ in found] == sorted((-s, i) for i, s, _ in found)
        for i, s, _ in found:
            assert i != q and s == pytest.approx(float(np.dot(score[q], score[i])), abs=1e-12)
        recall.append(len({i for i, *_ in found} & {i for i, _ in want[q]}) / 20)
    assert np.mean(recall) >= 0.9
    # A query among the copies finds the smallest ids of its equals, when nothing is nearer.
    few = spark.createDataFrame([(1, [1.0, 0.0]), (0, [2.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert collected(perm_index.search(few, few.filter("vec_id % 20 = 0")), "query_id", "rank", "vec_id") == [
        (0, 1, 1),
        (0, 2, 20),
        (20, 1, 0),
        (20, 2, 1),
    ]
    assert perm_index.search(few.limit(0), few.limit(0)).count() == 0


def test_recall_on_the_given_vectors(spark):
    sf = "/root/testdata/sf0.1"
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    got = QUERIES["op1_permutation_index"](spark, sf).toPandas()
    x, ids = np.array(vectors["embedding"].tolist(), dtype=np.float64), vectors["vec_id"].to_numpy()
    recall = []
    for q, found in got.groupby("query_id"):
        own = int(np.flatnonzero(ids == q)[0])
        score = x @ x[own]
        score[own] = -np.inf
        recall.append(len(set(found["vec_id"]) & set(ids[np.lexsort((ids, -score))[:20]])) / 20)
    assert len(recall) == (ids % 20 == 0).sum() and np.mean(recall) >= 0.9


def vectors_of(kind, n, d=64):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(n, d))
    centre = rng.normal(size=(10, d))
    if kind in ("clusters", "few clusters"):
        k, spread = (10, 0.3) if kind == "clusters" else (3, 1.0)
        return centre[rng.integers(0, k, n)] + spread * x
    if kind == "hot":
        x[: n // 3] = centre[0] + 0.1 * x[: n // 3]
    if kind == "copies":
        x[: n // 3] = centre[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind.startswith("lengths"):
        x *= rng.lognormal(0, float(kind.split()[1]), n)[:, None]
    return x


KINDS = ["random", "clusters", "few clusters", "hot", "copies", "lengths 0.5", "lengths 1"]


@pytest.mark.parametrize("kind", ["clusters", "hot"])
def test_recall_on_vectors_in_few_large_groups(spark, kind):
    """Rows of nearly the same order are all compared, however alike the rows of a block are."""
    rng = np.random.default_rng(8)
    n, d = 3000, 64
    centre = rng.normal(size=(10, d))
    x = centre[rng.integers(0, 10, n)] if kind == "clusters" else rng.normal(size=(n, d))
    if kind == "hot":
        x[: n // 3] = centre[0]
    x = x / np.linalg.norm(x, axis=1, keepdims=True) + 0.3 * rng.normal(size=(n, d)) / math.sqrt(d)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(f) for f in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in perm_index.search(df, df.filter("vec_id % 20 = 0 and vec_id < 1000")).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for q in range(0, 1000, 20):
        score = x @ x[q]
        score[q] = -np.inf
        recall.append(len(got[q] & set(np.argsort(-score)[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.99


@pytest.mark.parametrize("kind", KINDS)
def test_recall_and_reranked_share_at_twenty_thousand(spark, kind):
    """Mean recall at 20 of 0.9 or more with inner products for less than a quarter of the rows, block by block."""
    n = 20_000
    x = vectors_of(kind, n)
    sample = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:: n // 4000])], "vec_id long, vec array<double>")
    index = perm_index.fit(sample)
    unit, lengths = perm_index.directions(x)
    orders = perm_index.pivot_order(unit, index.pivots, index.posted)
    rng = np.random.default_rng(1)
    blocks = np.array_split(rng.permutation(n), -(-n // perm_index.BLOCK_ROWS))
    files = [perm_index.Files(orders[b], index) for b in blocks]
    recall, share = [], []
    for q in rng.choice(n, 60, replace=False):
        near = np.concatenate([b[perm_index.candidates(f, orders[q], lengths[b])] for b, f in zip(blocks, files)])
        score = x @ x[q]
        score[q] = -np.inf
        least = np.sort(score)[-20]
        recall.append(min(20, (score[near] >= least).sum()) / 20)
        share.append(len(near) / n)
    assert np.mean(recall) >= 0.9 and np.mean(share) < 0.25


def test_footrule_from_files_equals_the_plain_one():
    rng = np.random.default_rng(2)
    pivots = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    index = perm_index.Index(pivots, np.array([0.0, 1.0, 0.0]))
    unit = perm_index.directions(rng.normal(size=(30, 40)))[0]
    orders = perm_index.pivot_order(unit, pivots, index.posted)
    files = perm_index.Files(orders, index)
    for q in range(5):
        for r in range(30):
            place = {p: i for i, p in enumerate(orders[r].tolist())}
            plain = sum(index.posted - max(j, place.get(p, index.posted)) for j, p in enumerate(orders[q].tolist()[: index.probed]))
            assert files.similar(orders[q])[r] == pytest.approx(plain / index.full)


def test_a_block_counts_repeats_once():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 8))
    ids = np.r_[np.arange(150), np.full(40, 7), 0]
    x = np.vstack([x, np.repeat(x[7:8], 40, axis=0), x[1:2]])  # a row 41 times; id 0 with two vectors
    index = perm_index.Index(perm_index.directions(x[:20])[0], np.array([0.0, 1.0, 0.0]))
    orders = perm_index.pivot_order(perm_index.directions(x)[0], index.pivots, index.posted)
    rows = pd.DataFrame({"vec_id": ids, "vec": [v.tobytes() for v in x], "pivots": [o.tobytes() for o in orders]})
    got = perm_index.rank_block(rows, rows.iloc[:30], index, 20)
    for q, found in zip(got["query_id"], got["found"], strict=True):
        score = {(-float(np.multiply(v, x[q]).sum()), int(i)) for i, v in zip(ids, x, strict=True) if i != q}
        assert [(f["neg"], f["vec_id"]) for f in found] == sorted(score)[:20]


CALLS = "conv_id long, call_id string, turn long, name string, arguments string, after string"
RESULTS = "conv_id long, call_id string, turn long, content string"
SCHEMAS = {
    "add": {
        "type": "object",
        "required": ["a"],
        "properties": {"a": {"type": "integer"}, "b": {"type": "array", "items": {"type": "number"}}},
        "additionalProperties": False,
    }
}


def test_calls_are_linked_ordered_checked_and_serialised(spark):
    calls = [
        (1, "c", 4, "add", '{"b":[1.5,2], "a":1}', "b"),
        (1, "b", 2, "add", '{"a":"x"}', "a"),
        (1, "a", 0, "add", '{"a":1,"é":2}', None),
        (1, "a", 6, "add", '{"a":1}', None),
        (1, "p", 1, "nope", "{}", "q"),
        (1, "q", 1, "add", "{broken", "p"),
        (2, "a", 0, "add", '{"a":NaN}', "zzz"),
        (None, "a", 0, "add", '{"a":3}', None),
        (3, None, 0, "add", None, None),
    ]
    results = [(1, "a", 1, "one"), (1, "a", 3, "again"), (1, "x", 5, "lost"), (2, "a", 1, ""), (2, "c", 1, None)]
    out = tool_links.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS)
    by = {(r["conv_id"], r["call_id"], r["turn"]): r for r in out.collect()}
    assert len(by) == 9 + 3
    assert [by[1, k, t]["depth"] for k, t in (("a", 0), ("b", 2), ("c", 4), ("p", 1), ("q", 1))] == [0, 1, 2, -1, -1]
    assert by[2, "a", 0]["depth"] == 0
    status = {k: r["status"] for k, r in by.items()}
    assert status[1, "a", 0] == status[2, "a", 0] == "linked"
    assert status[1, "a", 6] == status[1, "a", 3] == "repeated"
    assert status[1, "x", 5] == status[2, "c", 1] == "orphan"
    assert status[1, "b", 2] == status[None, "a", 0] == status[3, None, 0] == "unanswered"
    assert by[1, "c", 4]["valid"] and by[None, "a", 0]["valid"] and by[1, "x", 5]["valid"] is None
    errors = {k: r["error"] for k, r in by.items() if r["error"]}
    assert errors[1, "b", 2] == "$.a: not integer" and errors[1, "a", 0] == "$.é: not allowed"
    assert errors[1, "p", 1] == "unknown tool" and errors[1, "q", 1] == errors[2, "a", 0] == "arguments are not JSON"
    assert by[1, "c", 4]["json"] == '{"arguments":{"a":1,"b":[1.5,2]},"id":"c","name":"add","status":"unanswered"}'
    assert json.loads(by[1, "a", 0]["json"])["result"] == "one" and "é" in by[1, "a", 0]["json"]
    empty = tool_links.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), SCHEMAS)
    assert empty.count() == 0


def test_long_chains_take_logarithmic_rounds(spark):
    calls = spark.createDataFrame([(1, str(i), str(i - 1)) for i in range(70)], "conv_id long, call_id string, after string")
    assert {r["call_id"]: r["depth"] for r in tool_links.depths(calls).collect()} == {str(i): i for i in range(70)}


def test_schema_rules():
    error = tool_links.schema_error
    assert error(True, {"type": "integer"}) and error(1, {"type": "integer"}) is None and error(1.5, {"type": "integer"})
    assert error("x", {"enum": ["y"]}) and error(3, {"minimum": 4}) and error(5, {"maximum": 4})
    assert error("", {"minLength": 1}) and error("ab", {"maxLength": 1})
    assert error([1, "x"], {"items": {"type": "number"}}) == "$[1]: not number"


def test_conversations_are_linked_as_by_hand(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    turns = {(r["conv_id"], r["turn"]): r for r in rows}

    def depth(c, t):
        before = turns.get((c, t - 2))
        return 1 + depth(c, t - 2) if before and before["role"] == "user" else 0

    want = []
    for (c, t), r in turns.items():
        after = turns.get((c, t + 1), SimpleNamespace)
        if r["role"] == "user":
            answered = after is not SimpleNamespace and after["role"] == "assistant"
            want.append((c, f"call-{t}", t, depth(c, t), "linked" if answered else "unanswered"))
        elif r["role"] == "assistant" and (turns.get((c, t - 1)) or {"role": None})["role"] != "user":
            want.append((c, f"call-{t - 1}", t, None, "orphan"))
    got = QUERIES["op8_tool_call_links"](spark, SF)
    assert collected(got, "conv_id", "call_id", "turn", "depth", "status") == sorted(
        want, key=lambda t: tuple((v is not None, v) for v in t)
    )
    for r in got.collect():
        if r["status"] != "orphan":
            record = json.loads(r["json"])
            text = turns[r["conv_id"], r["turn"]]["text"]
            assert record["arguments"] == {"prompt": text, "turn": r["turn"], "words": len(text.split())}
            assert r["valid"] == (1 <= len(text.split()) <= 250)


def test_registered_queries_and_oracles(spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(n.split("_")[0] for n in names if n != "pipeline") == sorted(f"op{i}" for i in range(1, 14))
    assert "pipeline" in names and set(ORACLE_SQL) <= set(QUERIES)
    from tests.oracle_compare import compare

    assert all(ok for ok, _ in compare(spark, SF, sorted(ORACLE_SQL), verbose=False).values())


def test_toxic_rows_are_dropped_in_small_batches(spark, monkeypatch):
    seen = []

    def look(df, name, batch_rows=None):
        seen.append((name, batch_rows))
        return df

    monkeypatch.setattr(toxicity, "stage", look)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    toxicity.drop_toxic(docs, labels)
    assert seen == [("not-toxic", 1000)]
    assert toxicity.CACHE_CHUNKS <= 100_000
