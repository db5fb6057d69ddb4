"""Toxicity by a factorization machine over hashed terms.

Terms (words of letters and digits, lower-cased, and their beginnings of
four and five characters) are hashed into 2**22 places. A document's weight at a place is its share of the text's terms,
times 50 and at most 1, so texts of any length compare. The machine scores

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

so that pairs of terms, such as an insult with a group's name, weigh beyond
their sum. It is trained by AdaGrad on a bounded sample of labelled rows.
Only places that at least four documents of the sample use have weights: a
rare place would only learn its document's noise. The trained places (a few
ten thousand) are broadcast, and every whole text is scored where it lies,
without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import TEXT_BATCH_ROWS, stage

#: Places of the hashed terms, and factors of a pair's weight.
PLACES = 1 << 22
FACTORS = 4
#: A place is trained when so many documents of the sample use it.
LEAST_DOCS = 4
#: Lengths of the word beginnings that are terms too.
PREFIXES = (4, 5)
#: Share of the terms at which a place's weight reaches 1.
FULL_SHARE = 0.02
#: Labelled rows the machine is fitted on, at most.
SAMPLE_ROWS = 12_000
EPOCHS = 10
BATCH = 64
RATE = 0.1
#: A row of label 1, the rarer one, counts so many times.
POSITIVE_WEIGHT = 3.0
#: Penalties on linear weights and factors, applied to the places of a batch.
PENALTY_LINEAR = 1e-4
PENALTY_FACTORS = 1e-3
SEED = 11
#: Chunks a worker remembers the places of, some 400 bytes each.
CACHE_CHUNKS = 100_000

_TERM = regex.compile(r"[\p{L}\p{N}]+")


def terms(word: str) -> list[str]:
    """A word and its beginnings, so that inflected forms share a term."""
    return [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) > n)]


class TermPlaces(dict):
    """White-space chunk -> places of its terms, as a tuple."""

    def __missing__(self, chunk: bytes) -> tuple[int, ...]:
        words = _TERM.findall(chunk.decode("utf-8", "replace").lower())
        places = tuple(xxhash.xxh64_intdigest(t.encode()) % PLACES for w in words for t in terms(w))
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = places
        return places


def term_vector(text: str | None, places_of: TermPlaces) -> tuple[np.ndarray, np.ndarray]:
    """Places in rising order and weights of a whole text; empty for no terms."""
    flat = [p for chunk in map(places_of.__getitem__, (text or "").encode().split()) for p in chunk]
    if not flat:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    places, counts = np.unique(np.array(flat, dtype=np.int32), return_counts=True)
    return places, np.minimum(1.0, counts / (FULL_SHARE * len(flat))).astype(np.float32)


@dataclass
class FactorizationMachine:
    bias: float
    places: np.ndarray  # trained places, rising
    linear: np.ndarray  # a weight per trained place
    factors: np.ndarray  # FACTORS per trained place

    def known(self, places: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots and weights of those places that are trained."""
        if not len(self.places) or not len(places):
            return np.empty(0, np.int32), np.empty(0, np.float32)
        slot = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        hit = self.places[slot] == places
        return slot[hit].astype(np.int32), x[hit]

    def score(self, places: np.ndarray, x: np.ndarray) -> float:
        slot, x = self.known(places, x)
        raw = self.bias
        if len(slot):
            vx = self.factors[slot] * x[:, None]
            raw += float(self.linear[slot] @ x) + 0.5 * float((vx.sum(axis=0) ** 2 - (vx**2).sum(axis=0)).sum())
        return 1.0 / (1.0 + float(np.exp(-np.clip(raw, -30.0, 30.0))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = SEED, epochs: int = EPOCHS) -> FactorizationMachine:
    """Logistic loss, AdaGrad over mini-batches; rows are (places, weights, label).

    With no rows, or rows of one label only, the machine is its bias: the
    (smoothed) share of label 1.
    """
    rng = np.random.default_rng(seed)
    n1 = sum(y for _, _, y in rows)
    share = (n1 + 1.0) / (len(rows) + 2.0)
    docs_using = np.zeros(PLACES, dtype=np.int32)
    for places, _, _ in rows:
        docs_using[places] += 1  # a document's places are distinct
    used = np.flatnonzero(docs_using >= LEAST_DOCS).astype(np.int32)
    linear = np.zeros(len(used))
    factors = rng.normal(0, 0.02, (len(used), FACTORS))
    machine = FactorizationMachine(float(np.log(share / (1 - share))), used, linear, factors)
    if n1 in (0, len(rows)):
        factors[:] = 0
        return machine
    data = [(*machine.known(p, x), y) for p, x, y in rows]
    g_bias, g_linear, g_factors = 1e-6, np.full(len(used), 1e-6), np.full(factors.shape, 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            batch = [data[i] for i in order[at : at + BATCH]]
            doc = np.repeat(np.arange(len(batch)), [len(s) for s, _, _ in batch])
            slots = np.concatenate([s for s, _, _ in batch])
            x = np.concatenate([w for _, w, _ in batch]).astype(np.float64)
            y = np.array([label for _, _, label in batch], dtype=np.float64)
            vx = factors[slots] * x[:, None]
            sums = np.column_stack([np.bincount(doc, vx[:, f], minlength=len(batch)) for f in range(FACTORS)])
            squares = np.bincount(doc, (vx**2).sum(axis=1), minlength=len(batch))
            line = np.bincount(doc, linear[slots] * x, minlength=len(batch))
            raw = machine.bias + line + 0.5 * ((sums**2).sum(axis=1) - squares)
            slope = (1.0 / (1.0 + np.exp(-np.clip(raw, -30, 30))) - y) * np.where(y == 1, POSITIVE_WEIGHT, 1.0)
            touched, place = np.unique(slots, return_inverse=True)
            d = slope[doc] * x / len(batch)
            d_linear = np.bincount(place, d, minlength=len(touched)) + PENALTY_LINEAR * linear[touched]
            per = d[:, None] * (sums[doc] - vx)
            d_factors = np.column_stack([np.bincount(place, per[:, f], minlength=len(touched)) for f in range(FACTORS)])
            d_factors += PENALTY_FACTORS * factors[touched]
            g_bias += slope.mean() ** 2
            g_linear[touched] += d_linear**2
            g_factors[touched] += d_factors**2
            machine.bias -= RATE * slope.mean() / np.sqrt(g_bias)
            linear[touched] -= RATE * d_linear / np.sqrt(g_linear[touched])
            factors[touched] -= 0.5 * RATE * d_factors / np.sqrt(g_factors[touched])
    return machine


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")), F.lit(5))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorizationMachine:
    """Fit on the rows of ``docs`` that ``labels`` (doc_id, toxic) marks, outside fold 0.

    At most ``sample_rows`` rows are taken, one per labelled id that ``docs``
    holds, by smallest hash of the id, the same ones on any cluster; of an id
    with several texts the smallest text. Ids labelled both ways, null ids and
    null marks are left out. A row of the sample is its distinct places
    and weights; the sample alone reaches the driver.
    """
    clear = (
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min("toxic").alias("low"), F.max("toxic").alias("toxic"))
        .filter((F.col("low") == F.col("toxic")) & (fold(F.col("__id")) != 0))
    )
    marked = (
        clear.join(docs.select("doc_id"), F.col("doc_id") == F.col("__id"), "left_semi")
        .orderBy(F.xxhash64(F.lit(SEED), "__id"), "__id")
        .limit(sample_rows)
        .select("__id", F.col("toxic").cast("int").alias("__toxic"))
    )

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places_of = TermPlaces()
        for pdf in batches:
            made = [term_vector(t, places_of) for t in pdf["text"]]
            yield pd.DataFrame(
                {"doc_id": pdf["doc_id"], "y": pdf["y"], "p": [m[0].tobytes() for m in made], "x": [m[1].tobytes() for m in made]}
            )

    # Broadcast: ``sample_rows`` ids and marks, 12 bytes each.
    sample = docs.select("doc_id", "text").join(F.broadcast(marked), F.col("doc_id") == F.col("__id"))
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("__toxic").alias("y"))
    rows = sample.select("doc_id", "text", "y").mapInPandas(
        vectors, "doc_id long, y int, p binary, x binary"
    )
    gathered = sorted((r["doc_id"], r["p"], r["x"], r["y"]) for r in rows.toLocalIterator())
    return fit([(np.frombuffer(p, np.int32), np.frombuffer(x, np.float32), y) for _, p, x, y in gathered])


def score(docs: DataFrame, machine: FactorizationMachine, text_col: str = "text") -> DataFrame:
    """``docs`` with a ``score`` column (0 to 1): a null or empty text scores the bias alone."""
    model = docs.sparkSession.sparkContext.broadcast(
        FactorizationMachine(
            machine.bias, machine.places, machine.linear.astype(np.float32), machine.factors.astype(np.float32)
        )
    )

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        places_of, fm = TermPlaces(), model.value
        for texts in series:
            yield pd.Series([fm.score(*term_vector(t, places_of)) for t in texts], dtype="float64")

    return docs.withColumn("score", F.pandas_udf(run, "double")(F.col(text_col)))


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    ``held_out`` marks fold 0, whose labels are never read. Labels, lang,
    source and ids are no inputs of a score. Repeated rows score alike; an
    empty table gives no rows, and without labels every score is 0.5.
    """
    machine = train(docs, labels, sample_rows)
    scored = score(docs.select("doc_id", "text"), machine)
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, all columns unchanged.

    They are stored in batches of ``TEXT_BATCH_ROWS``, so that a worker and
    its executor hold little text at a time.
    """
    machine = train(docs, labels)
    scored = score(docs.select(F.struct(*docs.columns).alias("__row"), F.col("text").alias("__text")), machine, "__text")
    return stage(scored.filter("score < 0.5").select("__row.*"), "not-toxic", TEXT_BATCH_ROWS)
