"""Token counts by a linear longest-match automaton.

Greedy word pieces take, at each place of a word, the longest piece that
fits. The automaton finds their number in one walk over the word's
characters: the vocabulary is a trie, and each node knows where the walk
goes on when no longer match exists (its failure link) and how many pieces
are then complete (its popped tokens). No piece is ever built.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words one worker remembers the count of; emptied when full.
CACHE_WORDS = 600_000
#: In a cached count, words that no pieces cover are counted above this bit.
_UNKNOWN_BIT = 40
_UNKNOWN = 1 + (1 << _UNKNOWN_BIT)


class LongestMatch:
    """Counts the greedy pieces of a word over pieces that begin words and pieces that go on."""

    def __init__(self, begins: Iterable[str], goes_on: Iterable[str]):
        # Node 0 starts a word, node 1 continues one.
        self.goto: list[dict[str, int]] = [{}, {}]
        complete = [False, False]
        for root, pieces in ((0, begins), (1, goes_on)):
            for piece in pieces:
                node = root
                for c in piece:
                    nxt = self.goto[node].get(c)
                    if nxt is None:
                        nxt = self.goto[node][c] = len(self.goto)
                        self.goto.append({})
                        complete.append(False)
                    node = nxt
                complete[node] = complete[node] or bool(piece)
        self.fail: list[int | None] = [None] * len(self.goto)
        self.popped = [0] * len(self.goto)
        queue = deque([0, 1])
        while queue:  # breadth first, so a node's parent and its failure targets are done
            node = queue.popleft()
            for c, child in self.goto[node].items():
                queue.append(child)
                if complete[child]:
                    self.fail[child], self.popped[child] = 1, 1
                    continue
                at, pops = self.fail[node], self.popped[node]
                while at is not None and c not in self.goto[at]:
                    pops += self.popped[at]
                    at = self.fail[at]
                if at is not None:
                    self.fail[child], self.popped[child] = self.goto[at][c], pops

    def count(self, word: str) -> int | None:
        """Number of greedy pieces; None when no pieces cover the word."""
        goto, fail, popped = self.goto, self.fail, self.popped
        node, n = 0, 0
        for c in word:
            while (nxt := goto[node].get(c)) is None:
                n += popped[node]
                node = fail[node]
                if node is None:
                    return None
            node = nxt
        while node > 1:
            n += popped[node]
            node = fail[node]
            if node is None:
                return None
        return n


def sentence_pieces(path: str) -> tuple[list[str], list[str]]:
    """The word-beginning and the other pieces of a sentencepiece model.

    Control, byte and unknown pieces, and pieces with the mark anywhere but
    in front, are no word pieces.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    mark = "▁"
    begins, goes_on = [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or mark in piece[1:] or piece == mark:
            continue
        (begins if piece[0] == mark else goes_on).append(piece.lstrip(mark))
    return begins, goes_on


class WordCounts(dict):
    """Word's UTF-8 bytes -> its count, a word without cover as one unknown token."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(word.decode())
        value = _UNKNOWN if n is None else n
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


@lru_cache(maxsize=2)
def word_counts(path: str) -> WordCounts:
    return WordCounts(LongestMatch(*sentence_pieces(path)))


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_words, n_tokens, n_unknown.

    Words are the runs of whole texts without ASCII white space. A word that
    no pieces cover is one unknown token. A null or empty text has no words.
    Rows may repeat; other columns are not read; an empty table gives no
    rows. No shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = word_counts(vocabulary_path)
        for pdf in batches:
            words, total = [], []
            for text in pdf["text"]:
                split = (text or "").encode().split()  # bytes.split: ASCII white space only
                words.append(len(split))
                total.append(sum(map(counts.__getitem__, split)))
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"].astype("Int64").array,
                    "n_words": words,
                    "n_tokens": [t & ((1 << _UNKNOWN_BIT) - 1) for t in total],
                    "n_unknown": [t >> _UNKNOWN_BIT for t in total],
                }
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInPandas(run, "doc_id long, n_words long, n_tokens long, n_unknown long")
