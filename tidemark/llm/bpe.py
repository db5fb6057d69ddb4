"""BPE encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array. Each round finds every
word's lowest-rank adjacent pair at once (binary search of the pairs' keys in
the sorted key table of merges, then a minimum per word), merges all its
occurrences and drops the words that have none left. Only pairs beside a
merge are looked up again.

Texts are first split at ASCII white space. The tokenizers this supports
(lower case, white space dropped, words with an end mark) give a chunk the
same ids wherever it stands, so each worker keeps the ids of chunks it has
met, bounded by entries, and only new words go through the rounds.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import byte_symbols, drops_white_space

#: Chunks, and words, one worker remembers; both are emptied when full.
CACHE_ENTRIES = 600_000
#: Texts whose new words go through the rounds together.
TEXTS_PER_ROUND = 1024

_NO_RANK = np.int64(1 << 40)


class MergeTable:
    """A tokenizer file's vocabulary and merges as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        if not drops_white_space(config) or config["model"].get("ignore_merges"):
            raise ValueError("only tokenizers that drop white space and merge every word are supported")
        vocab: dict[str, int] = config["model"]["vocab"]
        end = config["model"]["end_of_word_suffix"] or ""
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.final = np.array([vocab[s + end] for s in symbols], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in config["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)  # by rank
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        pattern = config["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of adjacent symbols by binary search; ``_NO_RANK`` where no merge exists."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NO_RANK)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32 bytes) of non-empty words, all merged together."""
        out: list[bytes] = [b""] * len(words)
        if not words:
            return out
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(sizes)
        ids = self.inner[raw]
        ids[ends - 1] = self.final[raw[ends - 1]]
        owner = np.repeat(np.arange(len(words)), sizes)
        rank = np.full(len(ids), _NO_RANK)  # of a symbol with the next one of its word
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inside] = self.rank(ids[inside], ids[inside + 1])
        while len(ids):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            per_word = np.diff(np.r_[starts, len(ids)])
            done = lowest == _NO_RANK
            if done.any():
                data = ids.astype("<u4").tobytes()
                for s, n in zip(starts[done], per_word[done], strict=True):
                    out[owner[s]] = data[4 * s : 4 * (s + n)]
                alive = ~np.repeat(done, per_word)
                ids, owner, rank = ids[alive], owner[alive], rank[alive]
                lowest, per_word = lowest[~done], per_word[~done]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, per_word))
            # In a run of overlapping pairs (a a a) every second one merges.
            run_starts = np.r_[True, np.diff(hit) > 1]
            first = hit[np.maximum.accumulate(np.where(run_starts, np.arange(len(hit)), 0))]
            hit = hit[(hit - first) % 2 == 0]
            ids[hit] = self.merged[rank[hit]]
            keep = np.ones(len(ids), dtype=bool)
            keep[hit + 1] = False
            stale = np.zeros(len(ids), dtype=bool)
            stale[hit] = True
            stale[np.maximum(hit - 1, 0)] = True
            # The symbol before a merge may itself be one that is dropped: its merge is stale already.
            ids, owner, rank, stale = ids[keep], owner[keep], rank[keep], stale[keep]
            again = np.flatnonzero(stale)
            rank[again] = _NO_RANK
            again = again[again + 1 < len(ids)]
            again = again[owner[again] == owner[again + 1]]
            rank[again] = self.rank(ids[again], ids[again + 1])
        return out


def _normalise(text: str) -> str:
    """Normal form C, then each character's own lower case."""
    if text.isascii():
        return text.lower()
    return "".join([c.lower() for c in unicodedata.normalize("NFC", text)])


class BatchEncoder:
    """Encodes lists of texts; remembers chunks and words it has met."""

    def __init__(self, table: MergeTable, limit: int = CACHE_ENTRIES):
        self.table, self.limit = table, limit
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each whole text's ids as little-endian uint32 bytes; null counts as empty."""
        split = [(t or "").encode().split() for t in texts]  # bytes.split: ASCII white space only
        if len(self.chunks) > self.limit:
            self.chunks.clear()
        if len(self.words) > self.limit:
            self.words.clear()
        self._learn(set().union(*split) - self.chunks.keys())
        return [b"".join(map(self.chunks.__getitem__, chunks)) for chunks in split]

    def _learn(self, unseen: set[bytes]) -> None:
        parts = {chunk: self._parts(chunk.decode()) for chunk in unseen}
        new = list({w for ws in parts.values() for w in ws if isinstance(w, bytes)} - self.words.keys())
        self.words.update(zip(new, self.table.encode_words(new), strict=True))
        for chunk, ws in parts.items():
            self.chunks[chunk] = b"".join(
                [self.words[w] if isinstance(w, bytes) else np.array([w], "<u4").tobytes() for w in ws]
            )

    def _parts(self, chunk: str) -> list[bytes | int]:
        """Words as bytes and special tokens as ids, in order."""
        table = self.table
        if table.at_special is None or not table.at_special.search(chunk):
            return [w.encode() for w in table.word.findall(_normalise(chunk))]
        out: list[bytes | int] = []
        for piece in table.at_special.split(chunk):
            if piece in table.special:
                out.append(table.special[piece])
            else:
                out += [w.encode() for w in table.word.findall(_normalise(piece))]
        return out

    def decode(self, ids: bytes) -> str:
        """Token strings joined by a space, special tokens included; unknown ids are skipped."""
        strings = self.table.strings
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        try:
            return " ".join(map(strings.__getitem__, numbers))
        except KeyError:
            return " ".join(strings[i] for i in numbers if i in strings)


@lru_cache(maxsize=2)
def batch_encoder(path: str) -> BatchEncoder:
    """This worker's encoder of a tokenizer file."""
    return BatchEncoder(MergeTable(path))


def encode_and_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row, where ids are little-endian uint32 bytes.

    ``decoded`` is made from the ids alone. A null or empty text has no ids
    and decodes to the empty text. Rows may repeat; other columns are not
    read; an empty table gives no rows. No shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = batch_encoder(tokenizer_path)
        for pdf in batches:
            for at in range(0, len(pdf), TEXTS_PER_ROUND):
                part = pdf.iloc[at : at + TEXTS_PER_ROUND]
                ids = coder.encode(part["text"].tolist())
                for k in range(0, len(ids), 128):  # small frames: ids and texts are several times the input
                    few = ids[k : k + 128]
                    yield pd.DataFrame(
                        {"doc_id": part["doc_id"].iloc[k : k + 128].array, "ids": few, "decoded": [coder.decode(i) for i in few]}
                    )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInPandas(run, "doc_id long, ids binary, decoded string")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, decoded) from (doc_id, ids); null ids count as none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = batch_encoder(tokenizer_path)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "decoded": [coder.decode(i or b"") for i in pdf["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, decoded string")
