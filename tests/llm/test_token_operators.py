import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from tests.llm.conftest import TEXTS, collected
from tidemark.llm import bpe, packing, pfor, wordpiece
from tidemark.llm.staging import shared_folder
from tidemark.llm.tokens import ChunkEncoder, encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def fuzz(n=400):
    rng = random.Random(3)
    letters = [chr(c) for c in [*range(1, 0x250), *range(0x300, 0x310), 0x3A3, 0x1E9E, 0x2028, 0x85, 0x3000, 0x1F44D]]
    letters += list("''''  ,.!stremvld") * 12
    return ["".join(rng.choice(letters) for _ in range(40)) for _ in range(n)]


def test_chunk_encoder_equals_library(library):
    encoder = ChunkEncoder(PATH, limit=300)  # small, so that it is emptied on the way
    for text in TEXTS + fuzz():
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(library, text)


def test_whole_text_encoding_where_white_space_counts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = ChunkEncoder(path)
    assert not encoder.by_chunk
    text = "a  b\nc"
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_batched_bpe_equals_library_both_ways(library):
    coder = bpe.BatchEncoder(bpe.MergeTable(PATH), limit=300)
    texts = TEXTS + fuzz() + ["a" * 999, "ababababa" * 50]
    for _ in range(2):
        for text, ids in zip(texts, coder.encode(texts), strict=True):
            want = ids_of(library, text)
            assert np.frombuffer(ids, "<u4").tolist() == want
            assert coder.decode(ids) == library.decode(want, skip_special_tokens=False)
    assert coder.decode(np.array([514, 2**31], "<u4").tobytes()) == "an"


def test_bpe_rows(spark, library, odd_docs, no_docs):
    got = collected(bpe.encode_and_decode(odd_docs, PATH), "doc_id", "ids", "decoded")
    want = [
        (r["doc_id"], np.array(ids_of(library, r["text"]), "<u4").tobytes(), library.decode(ids_of(library, r["text"]), False))
        for r in odd_docs.collect()
    ]
    assert [(i, bytes(b), t) for i, b, t in got] == sorted(want, key=lambda t: (t[0] is not None, *t))
    again = bpe.decode(bpe.encode_and_decode(odd_docs, PATH), PATH)
    assert collected(again, "doc_id", "decoded") == [(i, t) for i, _, t in got]
    assert bpe.encode_and_decode(no_docs, PATH).count() == 0


def check_packing(library, docs, packed, capacity):
    rows = packed.collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(ids_of(library, r["text"]) + [2])
    pieces = sum(len(ids) for many in texts.values() for ids in many)
    assert sum(r["length"] for r in rows) == pieces
    sequences = {}
    for r in rows:
        cut = [ids[r["start"] : r["start"] + r["length"]] for ids in texts[r["doc_id"]] if len(ids) == r["doc_tokens"]]
        assert r["ids_crc32"] in [zlib.crc32(np.array(c, "<u4").tobytes()) for c in cut]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= capacity
    return sequences


def test_packing_places_every_id_once(spark, library, odd_docs, no_docs):
    check_packing(library, odd_docs, packing.pack(odd_docs, PATH, capacity=64), 64)
    check_packing(library, odd_docs, packing.pack(odd_docs, PATH, docs_per_group=3), 4096)
    assert packing.pack(no_docs, PATH).count() == 0


def test_repeated_rows_are_spread_over_packing_groups(spark, library):
    """A third of the rows equal: no group gathers them, and every copy is packed."""
    rows = [(1000 + i, f"text number {i}") for i in range(400)] + [(7, "one row again")] * 200 + [(None, None)] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()
    packed = packing.pack(docs, PATH, docs_per_group=70)
    groups = [r["sequence_id"] >> 32 for r in packed.filter("doc_id = 7 and doc_tokens = 4").collect()]
    assert len(groups) == 200 and max(groups.count(g) for g in set(groups)) < 60
    assert packed.count() == 700
    docs.unpersist()


def test_pipeline_packs_small_batches_with_a_small_cache(spark, library, odd_docs, monkeypatch):
    stored, limits = [], []
    keep, cut = packing.stage, packing.token_pieces
    monkeypatch.setattr(packing, "stage", lambda df, name, rows=None: stored.append((name, rows)) or keep(df, name, rows))
    monkeypatch.setattr(packing, "token_pieces", lambda *a, **b: limits.append(a[-1]) or cut(*a, **b))
    check_packing(library, odd_docs, corpus_pipeline.pack(spark, odd_docs, None), 4096)
    assert stored == [("pieces", 1000)]
    assert limits == [corpus_pipeline.PACKING_CHUNKS] and limits[0] <= 300_000


def test_a_worker_holds_one_encoder_within_its_limit(library):
    small = encoder(PATH, 50)
    for text in fuzz(20):
        assert np.frombuffer(small.encode(text), "<u4").tolist() == ids_of(library, text)
        assert len(small) <= 50
    assert encoder(PATH, 50) is small
    assert encoder(PATH).limit > 50
    assert encoder(PATH, 50) is not small


def test_packing_wastes_little_and_builds_sequences(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    packed = packing.pack(docs, PATH, with_ids=True).cache()
    sequences = check_packing(library, docs, packed, 4096)
    total = packed.agg({"length": "sum"}).first()[0]
    assert len(sequences) == -(-total // 4096)
    built = {r["sequence_id"]: r for r in packing.build_sequences(packed).collect()}
    assert set(built) == set(sequences)
    for r in packed.collect():
        own = np.frombuffer(built[r["sequence_id"]]["ids"], "<u4")
        assert len(own) == 4096 or len(own) & (len(own) - 1) == 0
        assert own[r["offset"] : r["offset"] + r["length"]].tobytes() == bytes(r["ids"])
    packed.unpersist()


def test_first_fit_decreasing_is_the_plain_rule():
    rng = random.Random(5)
    for n in (0, 1, 2, 7, 300):
        lengths = [rng.randint(1, 50) for _ in range(n)]
        bins, offsets = packing.first_fit_decreasing(lengths, 50)
        free = []
        for i in sorted(range(n), key=lambda i: -lengths[i]):
            k = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
            if k == len(free):
                free.append(50)
            assert (bins[i], offsets[i]) == (k, 50 - free[k])
            free[k] -= lengths[i]
    with pytest.raises(ValueError):
        packing.first_fit_decreasing([51], 50)


def test_pfor_blocks_round_trip():
    rng = np.random.default_rng(1)
    runs = [
        np.zeros(0),
        np.array([7]),
        np.full(5000, 3),
        rng.integers(0, 50_000, 10_000),
        np.r_[rng.integers(100, 130, 4000), [2**32 - 1, 0]],
        rng.integers(0, 2**32, 3000),
    ]
    for run in runs:
        ids = run.astype(np.uint32)
        payloads, index = pfor.encode_blocks(ids)
        sizes = [len(p) for p in payloads]
        index["offset"] = 1000 + np.cumsum([0, *sizes])[:-1] if len(sizes) else 0
        assert np.array_equal(pfor.decode_blocks(b"".join(payloads), index), ids)
    _, index = pfor.encode_blocks(np.r_[rng.integers(100, 116, 2040), [60_000] * 8].astype(np.uint32))
    assert index["width"][0] == 4 and index["exceptions"][0] == 8


def test_shards_hold_documents_in_order(spark, library, odd_docs, no_docs):
    folder = shared_folder(spark, "test-shards")
    manifest = pfor.write_token_shards(odd_docs, PATH, folder, shards=4)
    got = sorted(tuple(r) for r in pfor.read_token_shards(spark, manifest).select("start", "n_tokens", "ids_crc32", "doc_id").collect())
    start = 0
    for s, n, _, _ in got:
        assert s == start
        start += n
    ids = [i for *_, i in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    want = sorted(
        (r["doc_id"] or -1, zlib.crc32(np.array([*ids_of(library, r["text"]), 1], "<u4").tobytes())) for r in odd_docs.collect()
    )
    assert sorted((i or -1, c) for _, _, c, i in got) == want
    # Any range of ids decodes alone.
    shard = max(manifest.collect(), key=lambda r: r["n_tokens"])
    fs, local = pfor.open_store(shard["path"])
    with fs.open_input_file(local) as stream:
        reader = pfor.ShardReader(stream)
        everything = np.concatenate(list(reader.runs(1)))
        for a, b in ((0, 1), (2047, 2049), (5000, 12_345), (shard["n_tokens"] - 3, shard["n_tokens"] + 9), (4, 4)):
            assert np.array_equal(reader.ids(a, b), everything[a:b])
    assert pfor.encode_corpus(no_docs, PATH).count() == 0


def test_longest_match_equals_library(spark, odd_docs, no_docs):
    begins, goes_on = wordpiece.sentence_pieces(PIECES)
    vocab = {"[UNK]": 0}
    for p in begins:
        vocab.setdefault(p, len(vocab))
    for p in goes_on:
        vocab.setdefault("##" + p, len(vocab))
    pieces = Tokenizer(models.WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=10**9))
    pieces.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
    automaton = wordpiece.LongestMatch(begins, goes_on)
    for text in [t for t in TEXTS if t and len(t) < 1000] + fuzz():
        for word in text.split():
            tokens = pieces.encode(word).tokens
            assert automaton.count(word) == (None if tokens == ["[UNK]"] else len(tokens)), word
    got = {r["doc_id"]: r for r in wordpiece.token_counts(odd_docs, PIECES).collect()}
    assert (got[90]["n_words"], got[90]["n_tokens"]) == (0, 0) and got[30]["n_words"] == 30_001
    assert wordpiece.token_counts(odd_docs, PIECES).count() == odd_docs.count()
    assert wordpiece.token_counts(no_docs, PIECES).count() == 0


def test_longest_match_backs_off():
    automaton = wordpiece.LongestMatch(["a", "ab", "abcd"], ["b", "c", "cd", "e"])
    assert [automaton.count(w) for w in ("", "a", "abc", "abcd", "abce", "abcde", "x", "ax", "ba")] == [0, 1, 2, 1, 3, 2, None, None, None]
