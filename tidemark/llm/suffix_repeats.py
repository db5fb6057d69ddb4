"""Repeated passages across documents by enhanced suffix arrays over Spark partitions.

A passage of ``min_len`` bytes that occurs twice has to meet itself in one
task. Every window of that length is keyed by the least hash of its ``GRAM``
byte strings, which depends on the window's bytes alone, so equal windows have
equal keys; neighbouring windows mostly share a key and form one *context*.

1. Documents are packed into compressed chunks of a few megabytes.
2. Each chunk sends its distinct keys, a few bytes each; a bucket of keys
   answers which of them other documents have too. Text with unique keys, most
   of a corpus, goes no further. Whole-document digests travel the same way:
   a copy of an earlier document need not send its contexts again.
3. Each chunk sends its distinct contexts with shared keys. A bucket sorts
   their suffixes, computes common prefixes of neighbours, and scans the tree
   of common-prefix intervals with a stack. An interval of ``min_len`` or more
   whose occurrences differ to the left (or start a context) is a repeat
   group, whose occurrences all go back to their chunks.
4. Each chunk marks, per document, the bytes of occurrences whose group holds
   a smaller document.

A repeat longer than its contexts comes out as a chain of overlapping groups,
which cover it without a gap. A key that more than ``HOT_CONTEXTS`` contexts
share would be one task's work however they are dealt: its windows are keyed
one by one by 128 bits of their own bytes instead and only counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import TEXT_BATCH_ROWS, stage

MIN_LEN = 50
#: Bytes of the hashed strings: a window of MIN_LEN has MIN_LEN - GRAM + 1 of them.
GRAM = 24
#: Windows of one context at most; a longer run of equal keys is cut.
CONTEXT_WINDOWS = 32
#: Bytes of text in a chunk (its compressed row stays below half a megabyte, which the JVM
#: moves about as an ordinary object), and of text worked on at once.
CHUNK_BYTES = 1 << 20
PIECE_BYTES = 256 << 10
#: Bytes of text per bucket of keys.
BUCKET_BYTES = 8 << 20
#: Runs of one key beyond which its windows are counted one by one.
HOT_CONTEXTS = 20_000
#: Suffixes sorted together, but for those of one key; and compared at once.
SLICE_SUFFIXES = 100_000
COMPARED = 20_000
#: Levels of zstd: chunks travel twice and lie on disk, so theirs may cost more.
CHUNK_LEVEL, PAYLOAD_LEVEL = 5, 1
#: Null ids come last: no document is smaller because of one.
LAST_ID = np.iinfo(np.int64).max

_U = np.uint64
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_KEYS, _COPIES, _WINDOWS, _CONTEXTS = 0, 1, 2, 3


# ------------------------------------------------------------------ hashing


class _Hashes:
    """Hashes (mod 2**64) of any strings of some bytes: prefix sums of one number per byte value
    times a power of an odd number, brought back to the string's start by the inverse power."""

    def __init__(self, data: np.ndarray, seed: int):
        multiplier = _MULTIPLIERS[seed]
        up, down = _powers(seed, multiplier, len(data)), _powers(2 + seed, pow(multiplier, -1, 1 << 64), len(data) + 1)
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_BYTES[seed][data] * up, out=self.sums[1:])
        self.down = down

    def every(self, length: int) -> np.ndarray:
        n = max(0, len(self.sums) - length)
        return (self.sums[length:] - self.sums[:n]) * self.down[:n]

    def at(self, start: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.down[start]


_BYTES = [np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, 256, dtype=_U) | _U(1) for seed in (5, 6)]
_POWERS: dict[int, np.ndarray] = {}


def _powers(which: int, base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` mod 2**64, kept by a worker for the next piece."""
    have = _POWERS.get(which)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE_BYTES + 1024), base, _U)
        have[0] = 1
        _POWERS[which] = have = np.cumprod(have)
    return have[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(29))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[: len(values) - done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass
class Runs:
    """Runs of window starts with one key: text, document of the chunk, place there, number of windows, and hashes."""

    data: np.ndarray
    key: np.ndarray
    doc: np.ndarray
    at: np.ndarray
    place: np.ndarray
    windows: np.ndarray
    hashes: _Hashes


def _pieces(texts: list[bytes], min_len: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to some PIECE_BYTES; a longer text in parts that overlap by ``min_len`` - 1 bytes.

    Gives bytes, and per part its document, its offset there and its end in the bytes.
    """
    held, docs, offsets, ends, size = [], [], [], [], 0
    for d, text in enumerate(texts):
        for start in range(0, max(0, len(text) - min_len + 1), PIECE_BYTES):
            part = text[start : start + PIECE_BYTES + min_len - 1]
            size += len(part)
            held.append(part)
            docs.append(d)
            offsets.append(start)
            ends.append(size)
            if size >= PIECE_BYTES:
                yield np.frombuffer(b"".join(held), np.uint8), np.array(docs), np.array(offsets), np.array(ends)
                held, docs, offsets, ends, size = [], [], [], [], 0
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), np.array(docs), np.array(offsets), np.array(ends)


def _runs(texts: list[bytes], min_len: int, gram: int) -> Iterator[Runs]:
    for data, docs, offsets, ends in _pieces(texts, min_len):
        hashes = _Hashes(data, 0)
        key = _sliding_min(_mixed(hashes.every(gram)), min_len - gram + 1)
        starts = np.concatenate(([0], ends[:-1]))
        change = np.empty(len(key), bool)
        change[0] = True
        np.not_equal(key[1:], key[:-1], out=change[1:])
        # Windows that reach into the next part do not count, and a part starts a run.
        usable = np.ones(len(key), bool)
        for e in ends[:-1]:
            usable[max(0, e - min_len + 1) : e] = False
        change[starts[starts < len(key)]] = True
        first = np.flatnonzero(change)
        first = first[usable[first]]
        part = np.searchsorted(ends, first, side="right")
        # A run ends at the next change or with its part's last window.
        following = np.append(np.flatnonzero(change), len(key))
        end = np.minimum(following[np.searchsorted(following, first, side="right")], ends[part] - min_len + 1)
        pieces = -(-(end - first) // CONTEXT_WINDOWS)
        if (pieces > 1).any():
            step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            part, end = np.repeat(part, pieces), np.repeat(end, pieces)
            first = np.repeat(first, pieces) + step * CONTEXT_WINDOWS
            end = np.minimum(end, first + CONTEXT_WINDOWS)
        yield Runs(data, key[first], docs[part], first, offsets[part] + first - starts[part], end - first, hashes)


# ------------------------------------------------------------------ chunks


def _pack(ids: list[int], nulls: list[bool], texts: list[bytes], name: str) -> pd.DataFrame:
    blob = zstandard.ZstdCompressor(level=CHUNK_LEVEL).compress(b"".join(texts))
    lens = np.array([len(t) for t in texts], np.int64)
    return pd.DataFrame(
        {"chunk": [name], "ids": [np.array(ids, np.int64).tobytes()], "nulls": [np.array(nulls, bool).tobytes()], "lens": [lens.tobytes()], "blob": [blob]}
    )


def _unpack(row) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    ids, nulls = np.frombuffer(row.ids, np.int64), np.frombuffer(row.nulls, bool)
    ends = np.cumsum(np.frombuffer(row.lens, np.int64))
    whole = zstandard.ZstdDecompressor().decompress(row.blob, max_output_size=int(ends[-1]) + 1) if ends[-1] else b""
    return ids, nulls, [whole[s:e] for s, e in zip(np.concatenate(([0], ends[:-1])), ends)]


CHUNK = "chunk string, ids binary, nulls binary, lens binary, blob binary"


def pack_chunks(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Documents in compressed chunks of ``chunk_bytes`` of text or more, as they lie in the table."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, n = TaskContext.get().partitionId(), 0
        ids, nulls, texts, size = [], [], [], 0
        for batch in batches:
            for i, missing, text in zip(batch["id"], batch["missing"], batch["text"]):
                ids.append(int(i))
                nulls.append(bool(missing))
                texts.append(bytes(text))
                size += len(text)
                if size >= chunk_bytes:
                    yield _pack(ids, nulls, texts, f"{part}-{n}")
                    ids, nulls, texts, size, n = [], [], [], 0, n + 1
        if ids:
            yield _pack(ids, nulls, texts, f"{part}-{n}")

    the_id = F.col(id_col).cast("long")
    plain = docs.select(
        F.coalesce(the_id, F.lit(LAST_ID)).alias("id"),
        the_id.isNull().alias("missing"),
        F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"),
    )
    return stage(plain.mapInPandas(pack, CHUNK), "repeats-chunks", TEXT_BATCH_ROWS)


# ------------------------------------------------------------------ keys shared by documents

SHEET = "bucket int, kind int, chunk string, payload binary"
ANSWER = "chunk string, kind int, bucket int, payload binary"


def _by_bucket(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its hashes); places keep their order.

    The upper half of a hash names the bucket, so that the lower half is left to tell hashes of a bucket apart.
    """
    home = ((hashes >> _U(32)) % _U(buckets)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    cuts = np.flatnonzero(np.diff(home[order])) + 1
    for group in np.split(order, cuts):
        if len(group):
            yield int(home[group[0]]), group


def _all_runs(texts: list[bytes], min_len: int, gram: int) -> list[Runs]:
    return list(_runs(texts, min_len, gram))


def _chunk_keys(runs: list[Runs]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a chunk, sorted, and in how many runs each occurs."""
    if not runs:
        return np.empty(0, _U), np.empty(0, np.int64)
    return np.unique(np.concatenate([r.key for r in runs]), return_counts=True)


def _grouped(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of equal rows (columns of hashes): the distinct rows in order, each row's class, and each class's least and largest value."""
    order = np.lexsort(rows.T[::-1])
    ordered, held = rows[order], values[order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    cls = np.empty(len(order), np.int64)
    cls[order] = np.cumsum(new) - 1
    if not len(first):
        return ordered, cls, values[:0], values[:0]
    return ordered[first], cls, np.minimum.reduceat(held, first), np.maximum.reduceat(held, first)


def _copy_sheet(texts: list[bytes], ids: np.ndarray, min_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct texts of a chunk (128 bits each), the class of every document long enough, and each class's least id."""
    there = np.flatnonzero([len(t) >= min_len for t in texts])
    digests = np.array([np.frombuffer(hashlib.blake2b(texts[d], digest_size=16).digest(), _U) for d in there], _U).reshape(-1, 2)
    rows, cls, least, _ = _grouped(digests, ids[there])
    return rows, cls, least, there


def _key_sheet(keys: np.ndarray, count: np.ndarray) -> bytes:
    """Lower halves of a bucket's keys, and their runs. A bucket has some hundred thousand keys whatever the
    corpus, so few halves agree by chance; such a key is taken for a shared one, and its contexts are compared."""
    return keys.astype(np.uint32).tobytes() + np.minimum(count, 255).astype(np.uint8).tobytes()


def _key_sheets(chunks: DataFrame, buckets: int, min_len: int, gram: int) -> DataFrame:
    def sheets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids, _, texts = _unpack(row)
                keys, count = _chunk_keys(_all_runs(texts, min_len, gram))
                rows, _, least, _ = _copy_sheet(texts, ids, min_len)
                out = []
                for b, at in _by_bucket(keys, buckets):
                    out.append((b, _KEYS, row.chunk, _key_sheet(keys[at], count[at])))
                for b, at in _by_bucket(rows[:, 0], buckets):
                    out.append((b, _COPIES, row.chunk, rows[at].tobytes() + least[at].tobytes()))
                yield pd.DataFrame(out, columns=["bucket", "kind", "chunk", "payload"])

    return chunks.mapInPandas(sheets, SHEET)


def _answer_keys(payloads: list[bytes], hot: int) -> list[np.ndarray]:
    """Per sheet and key: 0 alone in one run, 1 shared, 2 shared by more than ``hot`` runs."""
    sizes = [len(p) // 5 for p in payloads]
    key = np.concatenate([np.frombuffer(p, np.uint32, n) for p, n in zip(payloads, sizes)])
    count = np.concatenate([np.frombuffer(p, np.uint8, n, 4 * n) for p, n in zip(payloads, sizes)]).astype(np.int64)
    order = np.argsort(key)
    first = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
    total = np.add.reduceat(count[order], first)
    mark = np.empty(len(key), np.uint8)
    mark[order] = np.repeat((total > 1).astype(np.uint8) + (total > hot), np.diff(np.append(first, len(key))))
    return np.split(mark, np.cumsum(sizes)[:-1])


def _answer_least(payloads: list[bytes]) -> list[np.ndarray]:
    """Per sheet and 128-bit hash: the least id that any chunk has for it."""
    sizes = [len(p) // 24 for p in payloads]
    rows = np.concatenate([np.frombuffer(p, _U, 2 * n).reshape(n, 2) for p, n in zip(payloads, sizes)])
    least = np.concatenate([np.frombuffer(p, np.int64, n, 16 * n) for p, n in zip(payloads, sizes)])
    _, cls, found, _ = _grouped(rows, least)
    return np.split(found[cls], np.cumsum(sizes)[:-1])


def _packed(sheet: pd.DataFrame, answers: list[np.ndarray]) -> pd.DataFrame:
    out = sheet[["chunk", "kind", "bucket"]].copy()
    out["payload"] = [_payload_compressor().compress(a.tobytes()) for a in answers]
    return out


def _answered(sheets: DataFrame, hot: int) -> DataFrame:
    def answer(sheet: pd.DataFrame) -> pd.DataFrame:
        payloads = list(sheet["payload"])
        return _packed(sheet, _answer_keys(payloads, hot) if int(sheet["kind"].iloc[0]) == _KEYS else _answer_least(payloads))

    return sheets.groupBy("bucket", "kind").applyInPandas(answer, ANSWER)


def _collected(answers: pd.DataFrame, kind: int, hashes: np.ndarray, buckets: int, dtype, default) -> np.ndarray:
    """A chunk's answers put back in the order of the hashes that it asked for."""
    out = np.full(len(hashes), default, dtype)
    mine = answers[answers["kind"] == kind]
    by_bucket = dict(zip(mine["bucket"], mine["payload"]))
    for b, at in _by_bucket(hashes, buckets):
        if b in by_bucket:
            raw = zstandard.ZstdDecompressor().decompress(by_bucket[b], max_output_size=len(at) * np.dtype(dtype).itemsize + 1)
            out[at] = np.frombuffer(raw, dtype)
    return out


# ------------------------------------------------------------------ contexts


@dataclass
class Contexts:
    """Distinct contexts of a chunk in the order of its text: bytes, key, windows, least and largest id; the runs of each."""

    runs: list[Runs]
    key: np.ndarray
    windows: np.ndarray
    least: np.ndarray
    largest: np.ndarray
    piece: np.ndarray
    at: np.ndarray
    run_piece: np.ndarray
    run_no: np.ndarray
    run_class: np.ndarray
    copy_of: np.ndarray
    hot: list[np.ndarray]


def _contexts(ids: np.ndarray, texts: list[bytes], answers: pd.DataFrame, buckets: int, min_len: int, gram: int) -> Contexts:
    runs = _all_runs(texts, min_len, gram)
    keys, _ = _chunk_keys(runs)
    mark = _collected(answers, _KEYS, keys, buckets, np.uint8, 0)
    rows, cls, _, there = _copy_sheet(texts, ids, min_len)
    least = _collected(answers, _COPIES, rows[:, 0], buckets, np.int64, LAST_ID)
    copy_of = np.full(len(texts), LAST_ID, np.int64)
    copy_of[there] = least[cls]
    sent, hot = [], []
    for p, r in enumerate(runs):
        m = mark[np.searchsorted(keys, r.key)]
        fresh = copy_of[r.doc] >= ids[r.doc]
        sent.append(np.flatnonzero((m == 1) & fresh))
        hot.append(np.flatnonzero((m == 2) & fresh))
    piece = np.concatenate([np.full(len(n), p) for p, n in enumerate(sent)] or [np.empty(0, np.int64)]).astype(np.int64)
    no = np.concatenate(sent or [np.empty(0, np.int64)]).astype(np.int64)
    pick = lambda get: np.concatenate([get(r)[n] for r, n in zip(runs, sent)] or [np.empty(0, np.int64)])
    at, windows = pick(lambda r: r.at), pick(lambda r: r.windows)
    first = pick(lambda r: r.hashes.at(r.at, min_len)).astype(_U)
    last = pick(lambda r: r.hashes.at(r.at + r.windows - 1, min_len)).astype(_U)
    who = ids[pick(lambda r: r.doc).astype(np.int64)] if len(no) else np.empty(0, np.int64)
    # A context is its first and its last window, which together hold all of its bytes.
    key = pick(lambda r: r.key).astype(_U)
    same = np.stack([_mixed(first + windows.astype(_U)), _mixed(last) ^ key], axis=1) if len(no) else np.empty((0, 2), _U)
    _, run_class, low, high = _grouped(same, who)
    one = np.zeros(len(low), np.int64)
    one[run_class] = np.arange(len(run_class))
    by_place = np.argsort(one)
    number = np.empty(len(one), np.int64)
    number[by_place] = np.arange(len(one))
    one, low, high, run_class = one[by_place], low[by_place], high[by_place], number[run_class]
    return Contexts(runs, key[one], windows[one], low, high, piece[one], at[one], piece, no, run_class, copy_of, hot)


@cache
def _payload_compressor() -> zstandard.ZstdCompressor:
    """One for all payloads of a worker: most are small."""
    return zstandard.ZstdCompressor(level=PAYLOAD_LEVEL)


def _planes(numbers: np.ndarray) -> bytes:
    """Differences of neighbours, their lowest bytes first: ids of a chunk mostly lie close together."""
    steps = numbers.copy()
    steps[1:] -= numbers[:-1]
    return steps.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _from_planes(raw: memoryview, dtype, n: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, n * np.dtype(dtype).itemsize).reshape(-1, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype)[:, 0], dtype=dtype)


def _context_payload(key: np.ndarray, least: np.ndarray, largest: np.ndarray, windows: np.ndarray, blob: bytes) -> bytes:
    """Contexts of a chunk for a bucket: their number, 16 bits of each key, and compressed numbers and texts."""
    squeeze = _payload_compressor().compress
    numbers = squeeze(_planes(least) + _planes(largest - least) + windows.astype(np.uint8).tobytes())
    head = len(key).to_bytes(4, "little") + len(numbers).to_bytes(4, "little")
    return head + key.astype(np.uint16).tobytes() + numbers + squeeze(blob)


def _read_contexts(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, least and largest id, windows, and text of a payload."""
    n, size = np.frombuffer(payload, np.uint32, 2).tolist()
    rest = 8 + 2 * n
    raw = memoryview(zstandard.ZstdDecompressor().decompress(payload[rest : rest + size]))
    least = _from_planes(raw, np.int64, n)
    largest = least + _from_planes(raw[8 * n :], np.int64, n)
    text = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload[rest + size :]), np.uint8)
    return np.frombuffer(payload, np.uint16, n, 8), least, largest, np.frombuffer(raw, np.uint8, n, 16 * n).astype(np.int64), text


def _context_rows(chunk: str, c: Contexts, buckets: int, min_len: int) -> list[tuple]:
    out = []
    for b, at in _by_bucket(c.key, buckets):
        blob = b"".join(
            c.runs[c.piece[i]].data[c.at[i] : c.at[i] + c.windows[i] + min_len - 1].tobytes() for i in at
        )
        out.append((b, _CONTEXTS, chunk, _context_payload(c.key[at], c.least[at], c.largest[at], c.windows[at], blob)))
    return out


# ------------------------------------------------------------------ the suffix array of a slice


@dataclass
class Repeats:
    """Repeat groups: members of group g are ``suffixes[begin[g] : end[g]]``, all alike for ``length[g]`` bytes."""

    suffixes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    length: np.ndarray


def _intervals(lcp: np.ndarray, min_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tree of common-prefix intervals by one scan with a stack: (length, first, last member) of each."""
    lengths, firsts, lasts = [], [], []
    stack: list[tuple[int, int]] = []  # (length, first member) of the open intervals
    # Between two changes of the common prefix nothing opens or closes.
    changes = np.flatnonzero(np.diff(lcp, prepend=0, append=0))
    for i, length in zip(changes.tolist(), np.append(lcp, 0)[changes].tolist()):
        begin = i
        while stack and stack[-1][0] > length:
            deep, begin = stack.pop()
            lengths.append(deep)
            firsts.append(begin)
            lasts.append(i)
        if length >= min_len and (not stack or stack[-1][0] < length):
            stack.append((length, begin))
    return np.array(lengths, np.int64), np.array(firsts, np.int64), np.array(lasts, np.int64)


def repeat_groups(
    text: np.ndarray, start: np.ndarray, room: np.ndarray, left: np.ndarray, first_key: np.ndarray, several: np.ndarray, min_len: int
) -> Repeats:
    """Maximal repeats among suffixes: every common-prefix interval of ``min_len`` bytes or
    more whose members differ to the left.

    ``start`` and ``room``: a suffix is ``text[start : start + room]``; ``left``: the byte
    before it, -1 where its context starts; ``first_key``: a hash of its first ``min_len``
    bytes; ``several``: it stands for equal suffixes of more than one document.
    The array is ordered by that hash and then by the further bytes, an order in
    which suffixes with a common prefix of ``min_len`` bytes or more stand together.
    """
    alone = np.flatnonzero(several & (left < 0))
    order = np.argsort(first_key, kind="stable")
    head = np.flatnonzero(np.concatenate(([True], first_key[order][1:] != first_key[order][:-1])))
    size = np.diff(np.append(head, len(order)))
    # Suffixes alone, and classes whose suffixes all have the same byte to the left,
    # yield nothing: the repeat of the latter is found one byte earlier.
    low, high = np.minimum.reduceat(left[order], head), np.maximum.reduceat(left[order], head)
    array = order[np.repeat((size > 1) & ((low != high) | (low < 0)), size)]
    if not len(array):
        return Repeats(alone, np.arange(len(alone)), np.arange(len(alone)) + 1, room[alone])
    width = -(-max(int(room[array].max()) - min_len, 1) // 8) * 8
    tail = np.empty((len(array), width), np.uint8)
    for a in range(0, len(array), COMPARED):
        some = array[a : a + COMPARED]
        reach = start[some][:, None] + np.arange(min_len, min_len + width)
        inside = np.arange(width) < (room[some] - min_len)[:, None]
        tail[a : a + COMPARED] = np.where(inside, text[np.minimum(reach, len(text) - 1)], 0)
    order = np.lexsort((*tail.view(">u8").T[::-1], first_key[array]))
    array, tail = array[order], tail[order]
    # Common prefixes of neighbours, compared byte by byte.
    lcp = np.empty(len(array) - 1, np.int64)
    for a in range(0, len(lcp), COMPARED):
        one, two = array[a : a + COMPARED + 1][:-1], array[a + 1 : a + COMPARED + 1]
        differ = tail[a + 1 : a + 1 + len(two)] != tail[a : a + len(two)]
        more = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        more = np.minimum(more, np.minimum(room[one], room[two]) - min_len)
        opening = np.arange(min_len)
        same = (text[start[one][:, None] + opening] == text[start[two][:, None] + opening]).all(axis=1)
        lcp[a : a + COMPARED] = np.where(same, min_len + more, 0)
    length, first, last = _intervals(lcp, min_len)
    before = left[array]
    changed = np.concatenate(([0], np.cumsum(before[1:] != before[:-1])))
    diverse = (before[first] < 0) | (changed[last] > changed[first])
    length, first, last = length[diverse], first[diverse], last[diverse]
    base = np.arange(len(alone))
    return Repeats(
        np.concatenate([alone, array]),
        np.concatenate([base, first + len(alone)]),
        np.concatenate([base + 1, last + 1 + len(alone)]),
        np.concatenate([room[alone], length]),
    )


#: A repeat in a context: the context's place in the payload, whether the group holds a document smaller
#: than all of the context's (else than all but the least), and the group.
_SPAN = np.dtype([("context", "<i4"), ("at", "u1"), ("length", "u1"), ("below", "u1"), ("group", "<i8")])


def _span_payload(spans: np.ndarray) -> bytes:
    spans = spans[np.lexsort((spans["at"], spans["context"]))]
    columns = b"".join(_planes(np.ascontiguousarray(spans[f])) for f in _SPAN.names)
    return _payload_compressor().compress(columns)


def _read_spans(payload: bytes) -> np.ndarray:
    raw = memoryview(zstandard.ZstdDecompressor().decompress(payload))
    spans, done = np.empty(len(raw) // _SPAN.itemsize, _SPAN), 0
    for f in _SPAN.names:
        spans[f] = _from_planes(raw[done:], _SPAN[f], len(spans))
        done += len(spans) * _SPAN[f].itemsize
    return spans


def _repeats(contexts: DataFrame, min_len: int, every: bool) -> DataFrame:
    def bucket_repeats(sheet: pd.DataFrame) -> pd.DataFrame:
        if int(sheet["kind"].iloc[0]) == _WINDOWS:
            return _packed(sheet, _answer_least(list(sheet["payload"])))
        keys, least, largest, number, windows, owner, texts = [], [], [], [], [], [], []
        for row, payload in enumerate(sheet["payload"]):
            for to, part in zip((keys, least, largest, windows, texts), _read_contexts(payload)):
                to.append(part)
            number.append(np.arange(len(keys[-1])))
            owner.append(np.full(len(keys[-1]), row))
        key, least, largest, number, windows, owner, text = (np.concatenate(a) for a in (keys, least, largest, number, windows, owner, texts))
        begin = np.cumsum(windows + min_len - 1) - (windows + min_len - 1)
        order = np.argsort(key, kind="stable")
        # Slices of some SLICE_SUFFIXES that never part a key.
        upto = np.cumsum(windows[order])
        edge = np.append(np.flatnonzero(key[order][1:] != key[order][:-1]) + 1, len(order))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        group, a = 0, 0
        while a < len(order):
            done = upto[a - 1] if a else 0
            b = edge[np.searchsorted(edge, max(a + 1, np.searchsorted(upto, done + SLICE_SUFFIXES)))] if a + 1 < len(order) else len(order)
            part = order[a:b]
            a = int(b)
            context = np.repeat(part, windows[part])
            step = np.arange(len(context)) - np.repeat(np.cumsum(windows[part]) - windows[part], windows[part])
            start = begin[context] + step
            room = windows[context] + min_len - 1 - step
            left = np.where(step > 0, text[np.maximum(start - 1, 0)].astype(np.int64), -1)
            hashes = _window_hashes(text, begin, windows, part, min_len)
            several = (least < largest)[context]
            r = repeat_groups(text, start, room, left, hashes, several, min_len)
            if not len(r.begin):
                continue
            n = r.end - r.begin
            member = r.suffixes[np.repeat(r.begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            held = context[member]
            edges = np.cumsum(n) - n
            low, high = np.minimum.reduceat(least[held], edges), np.maximum.reduceat(largest[held], edges)
            # An occurrence is told of a group that holds a smaller document than one of its own.
            tell = np.repeat(low < high, n) if every else largest[held] > np.repeat(low, n)
            spans = np.empty(int(tell.sum()), _SPAN)
            spans["context"], spans["at"], spans["length"] = number[held[tell]], step[member[tell]], np.repeat(r.length, n)[tell]
            spans["below"] = (np.repeat(low, n) < least[held])[tell]
            spans["group"] = np.repeat(group + np.arange(len(n)), n)[tell] if every else 0
            found.append((owner[held[tell]], spans))
            group += len(n)
        return _by_owner(sheet, found)

    return contexts.groupBy("bucket", "kind").applyInPandas(bucket_repeats, ANSWER)


def _window_hashes(text: np.ndarray, begin: np.ndarray, windows: np.ndarray, part: np.ndarray, min_len: int) -> np.ndarray:
    """Hashes of every window of the contexts ``part``, context by context."""
    size = windows[part] + min_len - 1
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    joined = text[np.repeat(begin[part], size) + inside]
    return _Hashes(joined, 1).at(np.flatnonzero(inside < np.repeat(windows[part], size)), min_len)


def _by_owner(sheet: pd.DataFrame, found: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """The spans of each chunk that sent a sheet."""
    out = []
    if found:
        owner, spans = (np.concatenate(a) for a in zip(*found))
        order = np.argsort(owner, kind="stable")
        bucket = int(sheet["bucket"].iloc[0])
        for group in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1):
            if len(group):
                out.append((sheet["chunk"].iloc[int(owner[group[0]])], _CONTEXTS, bucket, _span_payload(spans[group])))
    return pd.DataFrame(out, columns=["chunk", "kind", "bucket", "payload"])


# ------------------------------------------------------------------ windows of very common keys


def _hot_windows(c: Contexts, ids: np.ndarray, min_len: int):
    """Every window of the runs with hot keys: 128-bit hash, document's id, document, place."""
    rows, docs, places = [], [], []
    for r, no in zip(c.runs, c.hot):
        if not len(no):
            continue
        n = r.windows[no]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(r.at[no], n) + step
        rows.append(np.stack([_mixed(r.hashes.at(at, min_len)), _Hashes(r.data, 1).at(at, min_len)], axis=1))
        docs.append(np.repeat(r.doc[no], n))
        places.append(np.repeat(r.place[no], n) + step)
    if not rows:
        return np.empty((0, 2), _U), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows), np.concatenate(docs), np.concatenate(places)


def _window_rows(chunk: str, c: Contexts, ids: np.ndarray, buckets: int, min_len: int) -> list[tuple]:
    rows, docs, _ = _hot_windows(c, ids, min_len)
    distinct, _, least, _ = _grouped(rows, ids[docs])
    return [(b, _WINDOWS, chunk, distinct[at].tobytes() + least[at].tobytes()) for b, at in _by_bucket(distinct[:, 0], buckets)]


# ------------------------------------------------------------------ operator


@dataclass
class _Plan:
    chunks: DataFrame
    answers: DataFrame
    buckets: int


def _joined(left: DataFrame, right: DataFrame):
    return left.groupBy("chunk").cogroup(right.groupBy("chunk"))


def _found(docs, id_col, text_col, min_len, gram, chunk_bytes, hot_contexts, every) -> _Plan:
    if not 0 < gram <= min_len:
        raise ValueError("gram must be between 1 and min_len")
    if min_len + CONTEXT_WINDOWS > 255:
        raise ValueError("min_len must be below 224")
    chunks = pack_chunks(docs, id_col, text_col, chunk_bytes)
    total = chunks.agg(F.sum(F.length("blob"))).first()[0] or 0
    buckets = max(8, int(3 * total // BUCKET_BYTES))  # the blobs are compressed to about a third
    answers = stage(_answered(_key_sheets(chunks, buckets, min_len, gram), hot_contexts), "repeats-answers", 2, once=True)

    def contexts(_key, chunk: pd.DataFrame, sheet: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in chunk.itertuples(index=False):
            ids, _, texts = _unpack(row)
            c = _contexts(ids, texts, sheet, buckets, min_len, gram)
            out += _context_rows(row.chunk, c, buckets, min_len) + _window_rows(row.chunk, c, ids, buckets, min_len)
        return pd.DataFrame(out, columns=["bucket", "kind", "chunk", "payload"])

    sent = _joined(chunks, answers).applyInPandas(contexts, SHEET)
    repeats = stage(_repeats(sent, min_len, every), "repeats-found", once=True)
    return _Plan(chunks, answers.unionByName(repeats), buckets)


def _occurrences(ids, texts, sheet, buckets, min_len, gram):
    """A chunk's occurrences: (document, place, length, an id that its own exceeds if the group's least does, bucket, group), and its hot windows."""
    c = _contexts(ids, texts, sheet, buckets, min_len, gram)
    by_class = np.argsort(c.run_class, kind="stable")
    first = np.searchsorted(c.run_class[by_class], np.arange(len(c.key) + 1))
    asked = dict(_by_bucket(c.key, buckets))
    parts = []
    for b, payload in sheet.loc[sheet["kind"] == _CONTEXTS, ["bucket", "payload"]].itertuples(index=False):
        spans = _read_spans(payload)
        context = asked[b][spans["context"]]
        n = first[context + 1] - first[context]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        run = by_class[np.repeat(first[context], n) + step]
        least = np.repeat(np.where(spans["below"] == 1, np.iinfo(np.int64).min, c.least[context]), n)
        spans = np.repeat(spans, n)
        doc, place = np.empty(len(run), np.int64), np.empty(len(run), np.int64)
        for p in np.unique(c.run_piece[run]):
            here = c.run_piece[run] == p
            no = c.run_no[run[here]]
            doc[here], place[here] = c.runs[p].doc[no], c.runs[p].place[no]
        parts.append((doc, place + spans["at"], spans["length"].astype(np.int64), least, np.full(len(run), b), spans["group"]))
    empty = tuple(np.empty(0, np.int64) for _ in range(6))
    found = tuple(np.concatenate(a) for a in zip(*parts)) if parts else empty
    rows, docs, places = _hot_windows(c, ids, min_len)
    distinct, cls, _, _ = _grouped(rows, ids[docs])
    least = _collected(sheet, _WINDOWS, distinct[:, 0], buckets, np.int64, LAST_ID)[cls] if len(rows) else np.empty(0, np.int64)
    return c, found, (docs, places, least)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_len: int = MIN_LEN,
    gram: int = GRAM,
    chunk_bytes: int = CHUNK_BYTES,
    hot_contexts: int = HOT_CONTEXTS,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``spans`` (start, length of the maximal
    removed runs) and ``kept``, the bytes that remain.

    A byte is removed where a string of ``min_len`` bytes covers it that also
    starts in a document with a smaller id; strings are judged on the input.
    Texts are UTF-8 bytes, so ``kept`` may cut a character. Null texts are
    empty, empty and short ones keep all. Rows with equal ids are not smaller
    than one another; null ids come last and never make another text go. Other
    columns are not read. An empty table gives no rows.
    """
    plan = _found(docs, id_col, text_col, min_len, gram, chunk_bytes, hot_contexts, every=False)
    buckets = plan.buckets

    def cut(_key, chunk: pd.DataFrame, sheet: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in chunk.itertuples(index=False):
            ids, nulls, texts = _unpack(row)
            c, (doc, place, length, least, _, _), (hot_doc, hot_place, hot_least) = _occurrences(ids, texts, sheet, buckets, min_len, gram)
            doc, place = np.concatenate([doc, hot_doc]), np.concatenate([place, hot_place])
            length = np.concatenate([length, np.full(len(hot_doc), min_len)])
            gone = np.concatenate([least, hot_least]) < ids[doc]
            copies = np.flatnonzero(c.copy_of < ids)
            doc = np.concatenate([doc[gone], copies])
            place = np.concatenate([place[gone], np.zeros(len(copies), np.int64)])
            length = np.concatenate([length[gone], [len(texts[d]) for d in copies]]).astype(np.int64)
            order = np.lexsort((place, doc))
            doc, place, end = doc[order], place[order], (place + length)[order]
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
            for d, text in enumerate(texts):
                spans, kept = _merged(place[cuts[d] : cuts[d + 1]], end[cuts[d] : cuts[d + 1]]), []
                upto = 0
                for s, e in spans:
                    kept.append(text[upto:s])
                    upto = e
                kept.append(text[upto:])
                out.append((None if nulls[d] else int(ids[d]), len(text), [s for s, _ in spans], [e - s for s, e in spans], b"".join(kept)))
        made = pd.DataFrame(out, columns=["id", "n_bytes", "starts", "lengths", "kept"])
        return made.astype({"id": "Int64", "n_bytes": "int64"})

    schema = "id long, n_bytes long, starts array<long>, lengths array<long>, kept binary"
    cut_docs = _joined(plan.chunks, plan.answers).applyInPandas(cut, schema)
    spans = F.transform(F.arrays_zip("starts", "lengths"), lambda e: F.struct(e["starts"].alias("start"), e["lengths"].alias("length")))
    return cut_docs.select(F.col("id").alias(id_col), "n_bytes", spans.alias("spans"), "kept")


def _merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Runs covered by intervals that are ordered by start; runs that touch are one."""
    if not len(start):
        return []
    reach = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(start) - 1)
    return list(zip(start[first].tolist(), reach[last].tolist()))


def maximal_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_len: int = MIN_LEN,
    gram: int = GRAM,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """All occurrences of every repeat group with two ids or more: ``group_id``, id, ``start``, ``length``.

    Copies of a whole earlier document are left to :func:`remove_repeats`; of
    such texts the one with the smallest id stands for all. Keys that very many
    documents share are not split here, so that every group is listed.
    """
    plan = _found(docs, id_col, text_col, min_len, gram, chunk_bytes, np.iinfo(np.int64).max, every=True)
    buckets = plan.buckets

    def listed(_key, chunk: pd.DataFrame, sheet: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in chunk.itertuples(index=False):
            ids, nulls, texts = _unpack(row)
            _, (doc, place, length, _, bucket, group), _ = _occurrences(ids, texts, sheet, buckets, min_len, gram)
            out += [
                (f"{b}-{g}", None if nulls[d] else int(ids[d]), int(p), int(n))
                for d, p, n, b, g in zip(doc, place, length, bucket, group)
            ]
        return pd.DataFrame(out, columns=["group_id", "id", "start", "length"]).astype({"id": "Int64", "start": "int64", "length": "int64"})

    found = _joined(plan.chunks, plan.answers).applyInPandas(listed, "group_id string, id long, start long, length long")
    return found.withColumnRenamed("id", id_col)


def digests(cut: DataFrame) -> list[Column]:
    """Columns of the digest form of ``remove_repeats``."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["length"])
    return [F.col("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")]
