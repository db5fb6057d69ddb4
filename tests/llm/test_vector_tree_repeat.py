"""Whitening, Merkle manifest and repeated passages against plain versions."""

import hashlib
import os
import random
import time

import numpy as np
import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from tests.llm.conftest import collected
from tidemark.llm import merkle, suffix_repeats, whitening

# ------------------------------------------------------------------ whitening


def plain_whitening(vectors, components=8):
    """numpy on the whole table: per vector (deviation, |whitened|), and explained."""
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    c = x - sums / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    trace = np.trace(c.T @ c / n)
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    return deviation, np.abs(c @ axes / np.sqrt(values)), values / trace


def check_whitening(out, ids, vectors, components=8):
    deviation, whitened, explained = plain_whitening(vectors, components)
    rows = out.collect()
    assert len(rows) == len(ids) * whitened.shape[1]
    assert {r["n"] for r in rows} == {len(ids)}
    want = sorted((i, k + 1, d, round(float(w), 6)) for i, d, ws in zip(ids, deviation, whitened) for k, w in enumerate(ws))
    assert sorted((r["vec_id"], r["component"], int(r["deviation"]), round(abs(r["whitened"]), 6)) for r in rows) == want
    assert all(abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 for r in rows)
    assert max(r["identity_error"] for r in rows) < 1e-9


def test_whitening_with_hot_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(400, 12)).astype(np.float32) * np.arange(1, 13, dtype=np.float32)
    vectors[:130] = vectors[0]  # a third of the rows share one vector
    rows = [(i, v.tolist(), "x", float(i)) for i, v in enumerate(vectors)]
    odd = [(1000, None), (1001, []), (1002, [float("nan")] * 12), (1003, [float("inf")] + [0.0] * 11), (1004, [None] + [0.0] * 11), (1005, [1.0, 2.0])]
    rows += [(i, v, "y", 0.0) for i, v in odd] + [rows[5], rows[5]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, component double").repartition(5)
    every = [*range(400), 5, 5]
    check_whitening(whitening.whiten(df), every, vectors[every])
    # each distinct vector once in the fit, and every row in the result
    distinct = whitening.classes(whitening.grid(df))
    model = whitening.fit(distinct, weighted=False)
    assert model.n == 271 and distinct.agg(F.sum("w")).first()[0] == 402
    assert whitening.grid(df).count() == 403  # the short one is a vector, but of another size


def test_whitening_of_flat_empty_and_extreme_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)).count() == 0
    # two directions with variance out of three: two components
    flat = [[float(i % 3), float(i % 5), 7.0] for i in range(60)]
    out = whitening.whiten(spark.createDataFrame(list(enumerate(flat)), schema))
    assert {r["component"] for r in out.collect()} == {1, 2}
    check_whitening(whitening.whiten(spark.createDataFrame(list(enumerate(flat)), schema), components=2), range(60), flat, 2)
    # far from zero: centring first loses nothing; null ids stay
    far = [[1e6 + i * 0.5, -1e6 + (i * i % 17)] for i in range(50)]
    out = whitening.whiten(spark.createDataFrame([(None if i == 3 else i, v) for i, v in enumerate(far)], schema))
    deviation, _, _ = plain_whitening(far)
    assert sorted(int(r["deviation"]) for r in out.filter("component = 1").collect()) == sorted(deviation)
    assert out.filter("vec_id is null").count() == 2
    # beyond 64 bits the deviation is still exact
    wide = [[float((i % 2) * 2**29)] for i in range(40)]
    big = whitening.whiten(spark.createDataFrame(list(enumerate(wide)), schema))
    assert {int(r["deviation"]) for r in big.collect()} == {(20 * 2**39) ** 2}
    with pytest.raises(Exception, match="beyond the grid"):
        whitening.whiten(spark.createDataFrame([(1, [2.0**31])], schema)).collect()


# ------------------------------------------------------------------ Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def part(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(nodes):
    """(root, per node its (left, right) sibling lists)."""
    paths, cur, own = [[] for _ in nodes], nodes, list(range(len(nodes)))
    while len(cur) > 1:
        for i in range(len(nodes)):
            run, slot = cur[own[i] // 8 * 8 : own[i] // 8 * 8 + 8], own[i] % 8
            paths[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            own[i] //= 8
        cur = [H(*cur[i : i + 8]) for i in range(0, len(cur), 8)]
    return cur[0], paths


def plain_manifest(rows, tampered):
    """Rows (doc_id, text, lang, source, n_chars) -> sorted (doc_id, leaf, subroot, root, path, folded root)."""
    groups = {}
    for r in rows:
        i, text, lang, source, n = r
        own = H(*map(part, (i, source, lang, n, text)))
        other = H(*map(part, (i, source, lang, n, tampered(i, text))))
        groups.setdefault(lang, []).append(((i is not None, i or 0, own, other), i, own, other))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in langs:
        groups[g].sort(key=lambda t: t[0])
        trees.append(plain_tree([own for _, _, own, _ in groups[g]]))
    root, above = plain_tree([t[0] for t in trees])
    out = []
    for g, (subroot, paths), up in zip(langs, trees, above):
        for (_, i, own, other), path in zip(groups[g], paths):
            acc = other
            for left, right in path + up:
                acc = H(left, acc, right)
            out.append((i, own, subroot, root, tuple(path + up), acc))
    return sorted(out, key=lambda t: (t[0] is not None, *t[:1], t[1:]))


DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, g int"


def check_manifest(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOCS).repartition(4)
    lower = F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    got = merkle.verify(merkle.manifest(docs, claims={"text": lower}, **kw)).collect()
    want = plain_manifest(rows, lambda i, t: t.lower() if i is not None and t is not None and i % 3 == 0 else t)
    facts = [
        (r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((e["left"], e["right"]) for e in r["path"]), r["folded_root"]) for r in got
    ]
    assert sorted(facts, key=lambda t: (t[0] is not None, *t[:1], t[1:])) == want
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in got)
    return got


def test_manifest_of_odd_rows(spark):
    rng = random.Random(3)
    langs = [None, "", "de", "en", "fr", "日本", "=x"]
    ids = [None, *range(-70, 200), 2**62, -(2**63), 2**63 - 1, 2**40, 5, 5, 5]
    rows = [(i, rng.choice(["Some Text", "", None, "été À", "x" * 50_000 + "Y"]), rng.choice(langs), rng.choice([None, "s"]), rng.choice([None, 4])) for i in ids]
    rows += [rows[30]] * 20 + [(None, f"N{k}", "en", None, None) for k in range(30)]
    got = check_manifest(spark, rows)
    assert not all(r["verified"] for r in got) and any(r["verified"] for r in got)


def test_manifest_small_and_hot_tables(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).count() == 0
    check_manifest(spark, [(7, "A", "en", None, 1)])  # a lone leaf is subroot and root
    check_manifest(spark, [(7, "A", "en", None, 1), (8, "B", None, None, 1)])
    # runs of 8 and one node alone on the last run; nine groups
    check_manifest(spark, [(i, f"T{i}", f"g{i % 9}", "s", i) for i in range(9 * 65)])
    # a third of the rows are one row, a sixth share an id: numbered by counts and by the prefix scan
    rows = [(i, f"T{i}", "en", "s", i) for i in range(300)] + [(9, "same", "en", "s", 1)] * 200 + [(11, f"U{k}", "en", "s", 1) for k in range(100)]
    check_manifest(spark, rows, range_rows=10)


def test_numbered_copies_are_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 16)
    check_manifest(spark, [(9, "same", "en", "s", 1)] * 100 + [(3, "x", "en", None, None)])


# ------------------------------------------------------------------ repeated passages


def plain_cut(rows, n):
    """(id, text) -> sorted (id, n_bytes, removed, spans, kept digest) from every string of n bytes."""
    last = float("inf")
    data = [(last if i is None else i, i, (t or "").encode()) for i, t in rows]
    least = {}
    for order, _, t in data:
        for p in range(len(t) - n + 1):
            s = t[p : p + n]
            least[s] = min(least.get(s, order), order)
    out = []
    for order, i, t in data:
        gone = bytearray(len(t))
        for p in range(len(t) - n + 1):
            if least[t[p : p + n]] < order:
                gone[p : p + n] = b"\1" * n
        spans = sum(1 for p in range(len(t)) if gone[p] and not (p and gone[p - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda t: (t[0] is not None, *t[:1], t[1:]))


def check_cut(docs, n=50, **kw):
    cut = suffix_repeats.remove_repeats(docs, min_len=n, **kw)
    got = [tuple(r) for r in cut.select("doc_id", *suffix_repeats.digests(cut)).collect()]
    assert sorted(got, key=lambda t: (t[0] is not None, *t[:1], t[1:])) == plain_cut([(r["doc_id"], r["text"]) for r in docs.collect()], n)


def test_cut_of_odd_rows(odd_docs, no_docs):
    check_cut(odd_docs)
    check_cut(odd_docs, n=10, gram=4, chunk_bytes=100)
    assert suffix_repeats.remove_repeats(no_docs).count() == 0


def _mixed_docs(spark, seed, count=120, alphabet="abcdé "):
    rng = random.Random(seed)
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(60)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 60))) for _ in range(12)]
    rows = []
    for i in range(count):
        body = [rng.choice([rng.choice(passages), " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))]) for _ in range(rng.randint(0, 6))]
        rows.append((rng.choice([i, i, i, i // 2, None]) if i % 7 == 0 else i, " ".join(body)))
    rows += [(i + 500, rows[3][1]) for i in range(40)] + [(600, "a" * 400), (601, "b" + "a" * 300 + "c"), (602, "\0" * 90), (603, "x" + "\0" * 80)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(6)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cut_of_passages_copies_and_periodic_texts(spark, seed):
    docs = _mixed_docs(spark, seed)
    check_cut(docs, chunk_bytes=3000)
    check_cut(docs, n=12, gram=5, chunk_bytes=3000)


def test_cut_with_very_common_keys_and_long_documents(spark, monkeypatch):
    docs = _mixed_docs(spark, 4)
    check_cut(docs, chunk_bytes=3000, hot_contexts=3)  # windows of common keys counted one by one
    check_cut(docs, chunk_bytes=3000, hot_contexts=0, n=20, gram=8)
    monkeypatch.setattr(suffix_repeats, "PIECE_BYTES", 100)  # parts of one document
    monkeypatch.setattr(suffix_repeats, "SLICE_SUFFIXES", 50)
    check_cut(docs, chunk_bytes=3000)


def _shuffle_bytes():
    files = SparkContext._active_spark_context._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f: os.path.getsize(f) for f in files if os.path.basename(f).startswith("shuffle_") and os.path.exists(f)}


def test_staged_rounds_leave_no_shuffle_files(spark):
    docs = _mixed_docs(spark, 5)
    before, settings = _shuffle_bytes(), dict(spark.sparkContext.getConf().getAll())
    cut = suffix_repeats.remove_repeats(docs, chunk_bytes=3000)
    packing = 60_000  # the table's own repartition and the sum over the chunks
    for _ in range(40):
        left = sum(size for f, size in _shuffle_bytes().items() if f not in before)
        if left < packing:
            break
        time.sleep(0.25)
    assert left < packing
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == settings.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    assert cut.count() == docs.count()


def test_key_sheets_and_context_payloads_are_small():
    rng = np.random.default_rng(1)
    n, width = 3000, 63
    keys, least = rng.integers(0, 2**64, n, dtype=np.uint64), np.sort(rng.integers(10**9, 10**9 + 500, n))
    largest, windows = least + (rng.random(n) < 0.1), np.full(n, width - 49)
    text = rng.integers(0, 256, n * width, dtype=np.uint8)
    assert len(suffix_repeats._key_sheet(keys, np.ones(n, np.int64))) == 5 * n
    payload = suffix_repeats._context_payload(keys, least, largest, windows, text.tobytes())
    assert len(payload) < (width + 4) * n
    for want, got in zip((keys.astype(np.uint16), least, largest, windows, text), suffix_repeats._read_contexts(payload)):
        assert (want == got).all()


def test_context_payloads_and_spans_come_back_with_extreme_numbers():
    ends = np.array([-(2**63), 2**63 - 1, 0, -1, 2**63 - 1, -(2**63)], np.int64)
    n = len(ends)
    payload = suffix_repeats._context_payload(np.arange(n, dtype=np.uint64), ends, ends[::-1], np.arange(1, n + 1), b"text" * n)
    _, least, largest, windows, text = suffix_repeats._read_contexts(payload)
    assert (least == ends).all() and (largest == ends[::-1]).all() and (windows == np.arange(1, n + 1)).all() and text.tobytes() == b"text" * n
    spans = np.zeros(n, suffix_repeats._SPAN)
    spans["context"], spans["at"], spans["length"], spans["below"], spans["group"] = [0, 0, 7, 9, 2**31 - 1, 2**31 - 1], [3, 31, 0, 5, 1, 2], 81, [1, 0, 1, 0, 1, 0], ends
    assert (suffix_repeats._read_spans(suffix_repeats._span_payload(spans)) == spans).all()


def test_repeat_groups_are_maximal_and_list_every_occurrence(spark):
    passage = "the same passage of more than fifty bytes stands here"
    rows = [(1, f"alpha {passage} one"), (2, f"betas {passage} two"), (3, f"{passage}"), (4, "something else that nobody shares with anybody at all, here")]
    found = suffix_repeats.maximal_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = dict(rows)
    groups = {}
    for r in found.collect():
        groups.setdefault(r["group_id"], []).append((texts[r["doc_id"]][r["start"] : r["start"] + r["length"]], r["doc_id"]))
    assert all(len({t for t, _ in g}) == 1 and len({d for _, d in g}) > 1 for g in groups.values())
    assert any({d for _, d in g} == {1, 2, 3} for g in groups.values())
    # the groups of a long repeat cover it: alone in 1 and 2, it ends one byte earlier in 3
    covered = {d: set() for d in texts}
    for r in found.collect():
        covered[r["doc_id"]].update(range(r["start"], r["start"] + r["length"]))
    assert "".join(texts[1][p] for p in sorted(covered[1])).strip() == passage
    assert not covered[4]


def test_suffix_array_intervals_of_one_text():
    text = np.frombuffer(b"xabcdefgabcdefyabcdefg", np.uint8)
    n, size = 4, len(text)
    start = np.arange(size - n + 1)
    left = np.concatenate(([-1], text[:-1].astype(np.int64)))[: len(start)]
    key = suffix_repeats._Hashes(text, 0).every(n)
    r = suffix_repeats.repeat_groups(text, start, size - start, left, key, np.zeros(len(start), bool), n)
    found = {(length, tuple(sorted(start[r.suffixes[b:e]].tolist()))) for b, e, length in zip(r.begin, r.end, r.length)}
    assert found == {(7, (1, 15)), (6, (1, 8, 15))}


@pytest.mark.parametrize("seed", range(5))
def test_intervals_against_every_pair(seed):
    rng = random.Random(seed)
    lcp = np.array([rng.choice([0, 4, 5, 5, 6, 9]) for _ in range(40)])
    length, first, last = suffix_repeats._intervals(lcp, 4)
    want = set()
    for a in range(40):
        for b in range(a + 1, 41):
            depth = min(lcp[a:b])
            if depth >= 4 and (a == 0 or lcp[a - 1] < depth) and (b == 40 or lcp[b] < depth):
                want.add((depth, a, b))
    assert set(zip(length.tolist(), first.tolist(), last.tolist())) == {tuple(map(int, w)) for w in want}


def test_digest_queries_have_the_asked_columns(spark):
    from tidemark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    whitened = QUERIES["op11_weighted_whitening"](spark, sf)
    assert dict(whitened.dtypes)["deviation"] == "bigint" and dict(whitened.dtypes)["component"] == "int"
    made = QUERIES["op12_bitmap_merkle"](spark, sf)
    assert made.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert len(collected(made.select("root").distinct(), "root")) == 1
