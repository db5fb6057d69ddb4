import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import collected
from tidemark.llm import minhash, radix_dedup
from tidemark.llm.components import connected_components

SPACE = re.compile(r"[\x20\x09-\x0d]+")


def plain_exact(rows):
    """(id, text) -> {(id, keep_id, size, sha)} by a dictionary of whole texts."""
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACE.sub(" ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=lambda t: (t[0] is not None, *t[:1], t[2:]))


def check_exact(docs, **widths):
    got = radix_dedup.radix_dedup(docs, **widths).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    facts = sorted(
        ((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=lambda t: (t[0] is not None, *t[:1], t[2:])
    )
    assert facts == plain_exact(rows)
    kept = {}
    for r in got:
        kept[r["text_sha256"]] = kept.get(r["text_sha256"], 0) + r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) <= {1}


def test_exact_dedup_on_odd_rows(odd_docs, no_docs):
    check_exact(odd_docs)
    check_exact(odd_docs, first_bytes=1, growth=2)
    assert radix_dedup.radix_dedup(no_docs).count() == 0
    kept = radix_dedup.drop_exact_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({SPACE.sub(" ", r["text"] or "") for r in odd_docs.collect()})
    assert radix_dedup.drop_exact_copies(no_docs).columns == no_docs.columns


def test_exact_dedup_random_copies_and_prefixes(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.choice([0, 1, 5, 40, 41, 700]))) for _ in range(150)]
    rows = [(i, rng.choice(texts)) for i in range(600)]
    check_exact(spark.createDataFrame(rows, "doc_id long, text string"), first_bytes=4, growth=3)


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in SPACE.split(low) if w]


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def plain_near(rows, k):
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())


def near_rows(rng, n_base, n_copies):
    """Base texts and copies that change a few words, so that their similarities lie about 0.8."""
    rows = []
    for _ in range(n_base):
        base = [rng.choice("abcdefghijklmnop") * rng.randint(1, 6) for _ in range(rng.choice([6, 40, 120]))]
        for _ in range(n_copies):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 999)}"
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return [(i, t) for i, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    rows = near_rows(random.Random(k), 12, 14) + [(900, None), (901, ""), (902, " \t"), (903, "one"), (904, "ONE"), (905, "two")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, bands string")
    got = collected(minhash.near_duplicates(docs, k), "doc_id", "n_shingles", "component_id", "kept")
    assert got == plain_near(rows, k)


def test_buckets_that_span_components_are_tried_whole(spark, monkeypatch):
    """With tiny blocks, by members or by shingles, no link is lost."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 4)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 100)
    rows = near_rows(random.Random(9), 1, 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(minhash.near_duplicates(docs, 2), "doc_id", "n_shingles", "component_id", "kept") == plain_near(rows, 2)


def test_links_behind_likelier_partners_are_confirmed(spark, monkeypatch):
    """Blocks that exceed BLOCK_ROWS, where many likelier partners rank before the only linked one."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 1)
    half = 12

    class Linked:
        def __init__(self, *_):
            self.sets = spark.createDataFrame([(i, [i % half, 100 + i % half]) for i in range(2 * half)], "node long, shingles array<long>")

        def links(self, pairs):
            return pairs.selectExpr("greatest(u, v) as u", "least(u, v) as v").filter(f"u - v = {half}").distinct()

        def _add_sets(self, near):
            pass

    monkeypatch.setattr(minhash, "_Verifier", Linked)
    low, high = bytes(400), bytes(300) + b"x" * 100  # alike in 0.75 of the places
    nodes = spark.createDataFrame([(i, 9, [0], low if i < half else high) for i in range(2 * half)], "node long, n_shingles long, bands array<long>, sketch binary")
    got = collected(minhash._components(None, nodes, 1), "node", "component")
    assert got == [(i, i % half) for i in range(2 * half)]


def test_half_alike_groups_make_no_rows_per_pair(spark):
    """A group of texts just below the threshold, of which a few are linked: units, not pairs, are rows."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        copy = list(base)
        for at in rng.sample(range(200), 16):
            copy[at] = f"x{i}-{at}"
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, rows[i][1] + " end") for i in range(0, 60, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(minhash.near_duplicates(docs, 2), "doc_id", "n_shingles", "component_id", "kept") == plain_near(rows, 2)


def test_repeated_rows_are_one_node(spark):
    rows = near_rows(random.Random(3), 3, 10)
    docs = spark.createDataFrame(rows + [rows[4]] * 40, "doc_id long, text string").repartition(4)
    sketches = minhash.stage(minhash.sketch(docs, 2).withColumn("row", F.monotonically_increasing_id()), "test")
    classes = sketches.groupBy(F.col("digest").alias("class")).agg(F.min("doc_id").alias("rep"), F.min_by("row", "doc_id").alias("first_row"))
    assert minhash._nodes(sketches, classes).count() == len({frozenset(shingles(t, 2)) for _, t in rows})
    got = minhash.near_duplicates(docs, 2)
    assert got.count() == len(rows) + 40
    assert collected(got.distinct(), "doc_id", "n_shingles", "component_id", "kept") == plain_near(rows, 2)


def test_staged_tables_are_deleted(spark, odd_docs):
    import os

    from tidemark.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    kept = radix_dedup.drop_exact_copies(odd_docs)
    names = {f.rsplit("-", 1)[0] for f in set(os.listdir(base)) - before}
    assert names == {"radix-first", "radix-dropped"} and kept.count() > 0
    before = set(os.listdir(base))
    kept = minhash.drop_near_duplicates(odd_docs)
    names = {f.rsplit("-", 1)[0] for f in set(os.listdir(base)) - before}
    assert names == {"near-dropped"} and kept.count() > 0


def test_whole_rows_pass_exact_dedup_under_any_names(spark):
    rows = [(i % 40 if i % 9 else None, f"t {i % 13}  x" if i % 4 else None, i, "k") for i in range(90)] + [(1, "t 1 x", 1, "k")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long, open string").withColumn("grp", F.col("row")).withColumn("doc", F.col("row"))
    out = radix_dedup.drop_exact_copies(docs.repartition(5), first_bytes=2, growth=2)
    assert out.columns == docs.columns
    best = {}
    for i, t, *_ in rows:
        key = SPACE.sub(" ", t or "")
        best[key] = min(best.get(key, float("inf")), float("inf") if i is None else i)
    assert sorted((SPACE.sub(" ", r["text"] or ""), r["doc_id"]) for r in out.collect()) == sorted(best.items())


def test_near_duplicates_on_odd_rows(odd_docs, no_docs):
    got = minhash.near_duplicates(odd_docs, 2).collect()
    assert len(got) == odd_docs.count()
    unnamed = [r for r in got if r["doc_id"] is None]
    assert [(r["component_id"], r["kept"]) for r in unnamed] == [(None, True)]
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[90]["n_shingles"] == 0 and by_id[90]["component_id"] == 90
    assert by_id[120]["component_id"] == by_id[110]["component_id"] == by_id[100]["component_id"] == 10
    assert minhash.near_duplicates(no_docs, 2).count() == 0
    assert minhash.drop_near_duplicates(odd_docs).columns == odd_docs.columns
    assert minhash.drop_near_duplicates(no_docs).columns == no_docs.columns


def test_signatures_estimate_similarity():
    a, b = minhash.hash_functions(2000)
    x = np.random.default_rng(1).integers(0, 2**64, 120, dtype=np.uint64)  # shingle hashes are well mixed
    s = minhash.signatures([x[:100], x[20:]], a, b)
    assert abs((s[0] == s[1]).mean() - 80 / 120) < 0.06


def test_connected_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for u, v in edges:
        if u != v:
            x, y = sorted((find(u), find(v)))
            root[y] = x
    got = collected(connected_components(spark.createDataFrame(edges, "u long, v long")), "node", "component")
    assert got == sorted((n, find(n)) for n in root)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_pipeline_stages_hand_on_the_columns_of_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "packing"]
    held = docs
    for name, function in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in held.collect()]
        after = function(spark, held, sf)
        if name == "packing":
            assert {r["doc_id"] for r in after.collect()} == {i for i, _ in before}
            break
        assert after.schema.names == docs.schema.names
        held = corpus_pipeline.stage(after, "test-pipeline")
        left = {r["doc_id"] for r in held.collect()}
        if name == "exact_dedup":
            assert left == {keep for _, keep, _, _ in plain_exact(before)}
        if name == "near_dedup":
            assert left == {i for i, _, _, kept in plain_near(before, 5) if kept}
    assert corpus_pipeline.run(spark, sf).count() >= len(left)


def test_a_node_is_joined_once_for_all_its_buckets(spark):
    from tidemark.llm.minhash import _each

    buckets = spark.range(400).select((F.col("id") % 10).alias("node"), (F.col("id") % 40).alias("bucket"))
    facts = spark.createDataFrame([(n, f"s{n}") for n in range(10)], "node long, sketch string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = _each(buckets, ["bucket"], facts)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate explode") < plan.index("Join Inner") < plan.index("collect_set")
        assert {tuple(r) for r in out.select("bucket", "node", "sketch").collect()} == {(b, b % 10, f"s{b % 10}") for b in range(40)}
        assert out.count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
