"""MinHash near-duplicate detection: bands, verification, components.

1. One pass over the texts makes each document's set of shingle hashes and
   from it 400 minima of universal hash functions. One byte of each is kept,
   the sketch; 40 band keys hold five of the first 200 bytes each. Two
   documents at the threshold of 0.8 miss all 40 bands with probability at
   most (1 - 0.8**5)**40 = 1.2e-7.
2. Documents with the same set become one node, so copies cost no pairs.
3. A band bucket does not list its pairs. In the star round each member is
   tried against the bucket's first one; confirmed links are joined to
   components and buckets within one component are finished. Buckets that
   still span components are dealt into bounded blocks; every pair of blocks
   is one unit of work, which compares sketches across components, takes a
   pair in the first bucket that its two members share, and confirms all its
   pairs on the members' full sets. Of the confirmed links a unit puts out a
   spanning forest: the pairs of a group never become rows, and no link
   between components is lost, whatever a bucket's or block's size.
4. A pair is confirmed when its sketches agree in 0.71 of the places or more
   and the full shingle sets meet the threshold exactly. At 0.8 a sketch of
   400 places agrees in 0.71 of them but for a chance of some 1e-5 per pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.staging import TEXT_BATCH_ROWS, stage, temporary

BANDS = 40
ROWS = 5
#: Hash functions of a sketch; the first BANDS * ROWS make the bands.
HASHES = 400
THRESHOLD_PERCENT = 80
#: Share of equal sketch bytes below which a pair is not compared in full.
LEAST_AGREEMENT = 0.71
SHINGLE_WORDS = 5
#: Members of a bucket compared in one task, squared.
BLOCK_ROWS = 256
#: Shingles of a bucket per block, on average, whatever the number of members.
BLOCK_SHINGLES = 500_000
SEED = 7
#: Words a worker remembers the hash of.
CACHE_WORDS = 250_000
#: Shingles hashed together, so that the numbers stay in the processor's cache.
TILE = 32_768

_ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


def shingle_set(text: str | None, size: int, words_of: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``size``-word shingles.

    A-Z are lower-cased, words are runs without ASCII white space. Fewer
    words than ``size`` make one shingle together; no words make none.
    """
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words_of.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(size, len(h))
    n = len(h) - size + 1
    acc = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        acc = acc * _ODD + h[j : j + n]
        acc ^= acc >> np.uint64(29)
    acc *= np.uint64(0xBF58476D1CE4E5B9)
    acc ^= acc >> np.uint64(32)
    return np.unique(acc)


def hash_functions(count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of multiply-add-shift universal hashing."""
    rng = np.random.Generator(np.random.PCG64(seed))
    a = rng.integers(0, 2**64, count, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, 2**64, count, dtype=np.uint64)


def signatures(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of each hash function over each (non-empty) set, as uint32."""
    out = np.empty((len(sets), len(a)), dtype=np.uint32)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= TILE):
            total += len(sets[last])
            last += 1
        x = np.concatenate(sets[first:last])
        starts = np.cumsum([0] + [len(s) for s in sets[first : last - 1]])
        hashed = np.empty_like(x)
        for k in range(len(a)):
            np.multiply(x, a[k], out=hashed)
            hashed += b[k]
            out[first:last, k] = np.minimum.reduceat(hashed, starts) >> np.uint64(32)
        first = last
    return out


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number per band: the band's place and its sketch bytes, so equal keys mean equal bytes."""
    parts = sketches.reshape(len(sketches), bands, rows).astype(np.int64)
    key = np.broadcast_to(np.arange(bands, dtype=np.int64), (len(sketches), bands)).copy()
    for r in range(rows):
        key = key << 8 | parts[:, :, r]
    return key


def sketch(docs: DataFrame, shingle_words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, digest, bands, sketch) of every row; the last three null for empty sets."""
    a, b = hash_functions(max(HASHES, bands * rows))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_of = WordHashes()
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at : at + 512]
                sets = [shingle_set(t, shingle_words, words_of) for t in part["text"]]
                filled = [i for i, s in enumerate(sets) if len(s)]
                out = pd.DataFrame({"doc_id": part["doc_id"].astype("Int64").array, "n_shingles": [len(s) for s in sets]})
                digests, keys, bytes_ = [[None] * len(sets) for _ in range(3)]
                if filled:
                    sig = signatures([sets[i] for i in filled], a, b)
                    low_bytes = sig.astype(np.uint8)
                    for i, k, low in zip(filled, band_keys(low_bytes[:, : bands * rows], bands, rows), low_bytes, strict=True):
                        digests[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                        keys[i], bytes_[i] = k, low.tobytes()
                yield out.assign(digest=digests, bands=keys, sketch=bytes_)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return source.mapInPandas(run, "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary")


def agreement(left: pd.Series, right: pd.Series) -> pd.Series:
    """Share of equal bytes of two sketches."""
    if not len(left):
        return pd.Series([], dtype="float64")
    x = np.frombuffer(b"".join(left), dtype=np.uint8).reshape(len(left), -1)
    y = np.frombuffer(b"".join(right), dtype=np.uint8).reshape(len(right), -1)
    return pd.Series((x == y).mean(axis=1))


class _Verifier:
    """Confirms candidate pairs; full shingle sets are made once per node that needs one."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, shingle_words: int):
        self.docs, self.nodes, self.shingle_words = docs, nodes, shingle_words
        self.sets: DataFrame | None = None
        self.tried: DataFrame | None = None

    def links(self, pairs: DataFrame) -> DataFrame:
        """Of candidate pairs (u, v) not tried before, those whose full sets meet the threshold."""
        pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["u", "v"], "left_anti")
        pairs = stage(pairs, "pairs")
        if pairs.isEmpty():
            return pairs
        self.tried = pairs if self.tried is None else self.tried.unionByName(pairs)
        agree = F.pandas_udf(agreement, "double")
        near = stage(
            self._with("u", self._with("v", pairs, self.nodes.select("node", "n_shingles", "sketch")), self.nodes.select("node", "n_shingles", "sketch"))
            .filter(F.least("n_shingles_u", "n_shingles_v") * 100 >= F.greatest("n_shingles_u", "n_shingles_v") * THRESHOLD_PERCENT)
            .withColumn("alike", agree("sketch_u", "sketch_v"))
            .filter(F.col("alike") >= LEAST_AGREEMENT)
            .select("u", "v"),
            "near-pairs",
        )
        self._add_sets(near)
        both = self._with("u", self._with("v", near, self.sets), self.sets)
        common = F.size(F.array_intersect("shingles_u", "shingles_v"))
        total = F.size("shingles_u") + F.size("shingles_v") - common
        return stage(both.filter(common * 100 >= total * THRESHOLD_PERCENT).select("u", "v"), "links")

    @staticmethod
    def _with(side: str, pairs: DataFrame, facts: DataFrame) -> DataFrame:
        named = facts.select(*[F.col(c).alias(side if c == "node" else f"{c}_{side}") for c in facts.columns])
        return pairs.join(named, side)

    def _add_sets(self, near: DataFrame) -> None:
        wanted = near.select(F.col("u").alias("node")).unionByName(near.select(F.col("v").alias("node"))).distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("node"), "node", "left_anti")
        wanted = stage(wanted, "set-nodes")
        if self.sets is not None and wanted.isEmpty():
            return
        size = self.shingle_words

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            words_of = WordHashes()
            for pdf in batches:
                for at in range(0, len(pdf), 512):
                    part = pdf.iloc[at : at + 512]
                    sets = [shingle_set(t, size, words_of).view(np.int64) for t in part["text"]]
                    yield pd.DataFrame({"node": part["node"].array, "shingles": sets})

        # Equal rows make one set.
        texts = self.docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(wanted, "node", "left_semi").distinct()
        made = stage(texts.mapInPandas(run, "node long, shingles array<long>"), "sets", TEXT_BATCH_ROWS)
        self.sets = made if self.sets is None else self.sets.unionByName(made)


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |A and B| >= 80 * |A or B| over their
    shingle sets; ``component_id`` is the smallest id reachable by links, and
    the row whose id it is stays. Documents without words have an empty set
    and are linked with nothing. Rows sharing an id count as one node with
    each of their texts. A row with a null id takes no part: its
    component_id is null and it is kept. Other columns are not read. An empty
    table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    with temporary(docs.sparkSession) as scope:
        made = sketch(docs, shingle_words).withColumn("row", F.monotonically_increasing_id())
        sketches = stage(made, "sketches", TEXT_BATCH_ROWS)
        classes = stage(
            sketches.filter("digest is not null and doc_id is not null")
            .groupBy(F.col("digest").alias("class"))
            .agg(F.min("doc_id").alias("rep"), F.min_by("row", "doc_id").alias("first_row")),
            "classes",
        )
        nodes = _nodes(sketches, classes)
        labels = _components(docs, nodes, shingle_words)
        named = stage(
            classes.join(labels, classes["rep"] == labels["node"], "left").select(
                "class", F.coalesce("component", "rep").alias("component")
            ),
            "named-classes",
        )
        sketches = stage(sketches.select("doc_id", "n_shingles", "digest"), "found")
        scope.keep(sketches, named)
    found = sketches.join(named.hint("merge"), F.col("digest") == F.col("class"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _nodes(sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """One row per class, of its first document: node, n_shingles, bands, sketch."""
    alone = sketches["row"] == classes["first_row"]
    # Classes grow with the table, so they are merged at every size; so are shared buckets and named classes.
    return stage(
        sketches.join(classes.hint("merge"), alone).select(F.col("doc_id").alias("node"), "n_shingles", "bands", "sketch"), "nodes"
    )


def _components(docs: DataFrame, nodes: DataFrame, shingle_words: int) -> DataFrame:
    """(node, component) of the nodes with links."""
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = stage(
        banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("rep")).filter("n > 1"), "buckets"
    )
    members = stage(banded.join(shared.select("bucket").hint("merge"), "bucket"), "members")
    verifier = _Verifier(docs, nodes, shingle_words)
    stars = members.join(shared, "bucket").select(F.col("rep").alias("u"), F.col("node").alias("v"))
    links = verifier.links(stars)
    labels = stage(connected_components(links), "labels")
    open_members, left = _open(members, labels)
    if left:
        new = _block_links(verifier, open_members, nodes)
        if not new.isEmpty():
            labels = stage(connected_components(links.unionByName(new)), "labels")
    return labels


def _open(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """Members, with component, of the buckets of three or more that span components; their number.

    The one pair of a bucket of two has been tried in the first round.
    """
    now = stage(
        members.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component")),
        "labelled",
    )
    spans = stage(
        now.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("n > 2 and low < high")
        .select("bucket", "n"),
        "open-buckets",
    )
    found = stage(now.join(spans, "bucket"), "open-members")
    return found, found.count()


UNIT = ["bucket", "i", "j"]


def _each(rows: DataFrame, columns: list[str], facts: DataFrame) -> DataFrame:
    """``rows`` (node and ``columns``), distinct, with the node's facts.

    A node stands in as many rows as it has shared buckets, or units of them;
    it is joined once, with these in a list, and dealt out afterwards.
    """
    held = rows.groupBy("node").agg(F.collect_set(F.struct(*columns)).alias("__rows")).join(facts, "node")
    return held.select(*facts.columns, F.explode("__rows").alias("__row")).select("__row.*", *facts.columns)


def _candidates(unit: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The likely pairs (u, v) across components between the unit's two blocks, or within its one."""
    left, right = unit[unit["own"] == unit["i"]], unit[unit["own"] == unit["j"]]
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(left) or not len(right):
        return none
    nx, ny = left["n_shingles"].to_numpy(), right["n_shingles"].to_numpy()
    fit = left["component"].to_numpy()[:, None] != right["component"].to_numpy()
    fit &= 100 * np.minimum(nx[:, None], ny) >= THRESHOLD_PERCENT * np.maximum(nx[:, None], ny)
    u, v = left["node"].to_numpy(), right["node"].to_numpy()
    if unit["i"].iloc[0] == unit["j"].iloc[0]:
        fit &= u[:, None] < v
    if not fit.any():
        return none
    x = np.frombuffer(b"".join(left["sketch"]), dtype=np.uint8).reshape(len(left), -1)
    y = np.frombuffer(b"".join(right["sketch"]), dtype=np.uint8).reshape(len(right), -1)
    band = int(unit["bucket"].iloc[0]) >> 8 * ROWS
    found_u, found_v = [], []
    for r in np.flatnonzero(fit.any(axis=1)):
        few = np.flatnonzero(fit[r])
        same = x[r] == y[few]
        likely = np.flatnonzero(same.mean(axis=1) >= LEAST_AGREEMENT)
        if len(likely):
            # A pair that shares several buckets counts in the first one only.
            first = same[likely, : BANDS * ROWS].reshape(len(likely), BANDS, ROWS).all(axis=2).argmax(axis=1)
            likely = likely[first == band]
            found_u.append(np.full(len(likely), u[r]))
            found_v.append(v[few[likely]])
    if not found_u:
        return none
    return np.concatenate(found_u), np.concatenate(found_v)


def _units(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(bucket, i, j, u, v): the likely pairs of every unit that has any, as two arrays.

    A bucket is dealt into blocks of about ``BLOCK_ROWS`` members, fewer where
    their sets are large; each pair of blocks is one unit of work, so a large
    bucket is shared by many tasks.
    """
    facts = _each(members, ["bucket", "n", "component"], nodes.select("node", "n_shingles", "sketch"))
    weight = stage(facts.groupBy("bucket").agg(F.sum("n_shingles").alias("weight")), "bucket-weights")
    parts = F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.least(F.col("weight") / BLOCK_SHINGLES, F.col("n")))).cast("int")
    dealt = (
        facts.join(weight, "bucket")
        .withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "bucket",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "own",
            "node",
            "component",
            "n_shingles",
            "sketch",
        )
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def answer(unit: pd.DataFrame) -> Iterator[pd.DataFrame]:
            u, v = _candidates(unit)
            if len(u):
                yield pd.DataFrame({**{k: unit[k].iloc[:1].to_numpy() for k in UNIT}, "u": [u], "v": [v]})

        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            keys = pdf[UNIT].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                yield from answer(pdf.iloc[a:b])
            held = pdf.iloc[starts[-1] :]
        if held is not None and len(held):
            yield from answer(held)

    ordered = dealt.repartition(*UNIT).sortWithinPartitions(*UNIT)
    return ordered.mapInPandas(run, "bucket long, i int, j int, u array<long>, v array<long>")


def _forest(u: np.ndarray, v: np.ndarray, sets: dict[int, list[np.ndarray]]) -> list[tuple[int, int]]:
    """Confirmed links among the pairs that connect what they connect; a pair whose nodes are already connected is left."""
    parent: dict[int, int] = {}

    def top(n: int) -> int:
        parent.setdefault(n, n)
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    links = []
    for a, b in zip(u.tolist(), v.tolist()):
        x, y = top(a), top(b)
        if x != y and any(_meet(s, t) for s in sets.get(a, ()) for t in sets.get(b, ())):
            parent[x] = y
            links.append((a, b))
    return links


def _meet(s: np.ndarray, t: np.ndarray) -> bool:
    """Whether two sets of sorted hashes meet the threshold."""
    if len(s) > len(t):
        s, t = t, s
    if 100 * len(s) < THRESHOLD_PERCENT * len(t):
        return False
    at = np.minimum(np.searchsorted(t, s), len(t) - 1)
    common = int((t[at] == s).sum())
    return 100 * common >= THRESHOLD_PERCENT * (len(s) + len(t) - common)


def _block_links(verifier: _Verifier, members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links across components within the open buckets, confirmed unit by unit; a spanning forest of each unit's."""
    units = stage(_units(members, nodes), "units")
    named = units.select(*[F.col(k).alias(f"of_{k}") for k in UNIT], F.explode(F.array_distinct(F.concat("u", "v"))).alias("node"))
    verifier._add_sets(named.select(F.col("node").alias("u"), F.col("node").alias("v")))
    held = _each(named, [f"of_{k}" for k in UNIT], verifier.sets)

    def confirm(key: tuple, unit: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        sets: dict[int, list[np.ndarray]] = {}
        for node, shingles in zip(held["node"], held["shingles"]):
            sets.setdefault(node, []).append(np.asarray(shingles, np.int64).view(np.uint64))
        links = [link for u, v in zip(unit["u"], unit["v"]) for link in _forest(np.asarray(u), np.asarray(v), sets)]
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    made = units.groupBy(*UNIT).cogroup(held.groupBy(*[f"of_{k}" for k in UNIT])).applyInPandas(confirm, "u long, v long")
    return stage(made, "block-links")


def drop_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, all columns unchanged."""
    with temporary(docs.sparkSession) as scope:
        found = near_duplicates(docs, shingle_words)
        dropped = stage(found.filter("not kept").select(F.col("doc_id").alias("__id")).distinct(), "near-dropped")
        scope.keep(dropped)
    return docs.join(dropped, docs["doc_id"] == dropped["__id"], "left_anti")
