"""Token files in patched frame-of-reference blocks.

A shard file holds the ids of a run of documents in ascending id order. Ids
are cut into blocks of 2,048: each block subtracts its minimum and packs the
differences at the width that fits a chosen percentile of them; the larger
ones keep their low bits in place and their full difference in the block's
exception list. An index of block starts lets a reader decode any range of
ids alone.

Layout (little-endian): magic, blocks, block index, document table, footer.
Packing works on 64 values at a time, column-wise, so numpy shifts many
blocks of a width together.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.staging import TEXT_BATCH_ROWS, shared_folder, stage
from tidemark.llm.tokens import encoder

BLOCK = 2048
PERCENTILE = 0.95
END_ID = 1
#: Blocks encoded or decoded together.
RUN_BLOCKS = 256

# Fixed values of the file format.
MAGIC = b"PFORTOK1"
INDEX = np.dtype([("offset", "<u8"), ("minimum", "<u4"), ("count", "<u4"), ("exceptions", "<u2"), ("width", "u1"), ("spare", "u1")])
DOCS = np.dtype([("doc_id", "<i8"), ("n_tokens", "<u8"), ("null_id", "u1")])
FOOTER = struct.Struct("<QQQQQ8s")  # block index at, blocks, document table at, documents, ids, magic


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64 values below 2**width into rows of ``width`` 64-bit words."""
    lanes = np.ascontiguousarray(values.reshape(-1, 64).T).astype(np.uint64)
    words = np.zeros((width, lanes.shape[1]), dtype=np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        words[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The inverse of ``_pack``: rows of ``width`` words into a flat run of values."""
    lanes = np.ascontiguousarray(words.reshape(-1, width).T)
    out = np.empty((64, lanes.shape[1]), dtype=np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        value = lanes[word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (lanes[word + 1] << np.uint64(64 - shift))
        out[i] = value & mask
    return np.ascontiguousarray(out.T).reshape(-1)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[list[bytes], np.ndarray]:
    """Payloads and index entries (offsets still zero) of ids cut into blocks."""
    n_blocks = -(-len(ids) // BLOCK)
    index = np.zeros(n_blocks, dtype=INDEX)
    if not n_blocks:
        return [], index
    counts = np.full(n_blocks, BLOCK)
    counts[-1] = len(ids) - BLOCK * (n_blocks - 1)
    table = np.full(n_blocks * BLOCK, ids[-1], dtype=np.uint32)
    table[: len(ids)] = ids
    table = table.reshape(n_blocks, BLOCK)
    minimum = table.min(axis=1)
    diff = table - minimum[:, None]
    diff.reshape(-1)[len(ids) :] = 0
    rank = min(BLOCK - 1, int(percentile * BLOCK))
    fits = np.partition(diff, rank, axis=1)[:, rank]
    width = np.ceil(np.log2(fits.astype(np.float64) + 1)).astype(np.int64)
    large = diff >> np.minimum(width, 31).astype(np.uint32)[:, None] != 0
    large[width >= 32] = False
    index["minimum"], index["count"], index["width"] = minimum, counts, width
    index["exceptions"] = large.sum(axis=1)
    payloads: list[bytes] = [b""] * n_blocks
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            low = diff[rows] & np.uint32((1 << int(w)) - 1)
            packed = _pack(low, int(w)).reshape(len(rows), -1).astype("<u8")
        for k, b in enumerate(rows):
            body = packed[k].tobytes() if w else b""
            if index["exceptions"][b]:
                at = np.flatnonzero(large[b])
                body += at.astype("<u2").tobytes() + diff[b, at].astype("<u4").tobytes()
            payloads[b] = body
    return payloads, index


def decode_blocks(data: bytes, index: np.ndarray) -> np.ndarray:
    """Ids of consecutive blocks whose payloads are ``data`` (from the first one's offset on)."""
    out = np.zeros((len(index), BLOCK), dtype=np.uint32)
    starts = (index["offset"] - index["offset"][0]).astype(np.int64) if len(index) else np.zeros(0, np.int64)
    widths = index["width"].astype(np.int64)
    for w in np.unique(widths):
        rows = np.flatnonzero(widths == w)
        if w:
            size = BLOCK // 8 * int(w)
            words = np.frombuffer(b"".join(data[starts[b] : starts[b] + size] for b in rows), dtype="<u8")
            out[rows] = _unpack(words, int(w)).reshape(len(rows), BLOCK)
    for b in np.flatnonzero(index["exceptions"]):
        n, at = int(index["exceptions"][b]), int(starts[b] + BLOCK // 8 * widths[b])
        places = np.frombuffer(data, dtype="<u2", count=n, offset=at)
        out[b, places] = np.frombuffer(data, dtype="<u4", count=n, offset=at + 2 * n)
    out += index["minimum"][:, None]
    flat = out.reshape(-1)
    return flat[: int(index["count"].sum())] if len(index) else flat


class ShardWriter:
    """Writes one shard; holds a run of ids and the document table, no more."""

    def __init__(self, stream, percentile: float = PERCENTILE):
        self.stream, self.percentile = stream, percentile
        self.at, self.n_ids, self.held = len(MAGIC), 0, bytearray()
        self.index: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        stream.write(MAGIC)

    def add(self, docs: np.ndarray, ids: bytes) -> None:
        """Documents in order and all their ids."""
        self.docs.append(docs)
        self.held += ids
        run = 4 * BLOCK * RUN_BLOCKS
        full = len(self.held) // run * run
        if full:
            for k in range(0, full, run):
                self._blocks(bytes(self.held[k : k + run]))
            del self.held[:full]

    def _blocks(self, ids: bytes) -> None:
        payloads, index = encode_blocks(np.frombuffer(ids, dtype="<u4"), self.percentile)
        sizes = np.array([len(p) for p in payloads], dtype=np.uint64)
        index["offset"] = self.at + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64) if len(sizes) else 0
        self.stream.write(b"".join(payloads))
        self.at += int(sizes.sum())
        self.n_ids += len(ids) // 4
        self.index.append(index)

    def close(self) -> dict:
        if self.held:
            self._blocks(bytes(self.held))
            self.held.clear()
        index = np.concatenate(self.index) if self.index else np.zeros(0, INDEX)
        docs = np.concatenate(self.docs) if self.docs else np.zeros(0, DOCS)
        index_bytes, doc_bytes = index.tobytes(), docs.tobytes()
        self.stream.write(index_bytes)
        self.stream.write(doc_bytes)
        self.stream.write(FOOTER.pack(self.at, len(index), self.at + len(index_bytes), len(docs), self.n_ids, MAGIC))
        return {"n_docs": len(docs), "n_tokens": self.n_ids, "n_bytes": self.at + len(index_bytes) + len(doc_bytes) + FOOTER.size}


class ShardReader:
    """Random access to a shard's ids by its block index."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.seek(0, io.SEEK_END)
        stream.seek(size - FOOTER.size)
        index_at, blocks, docs_at, docs, self.n_ids, magic = FOOTER.unpack(stream.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.index_at = index_at
        stream.seek(index_at)
        self.index = np.frombuffer(stream.read(blocks * INDEX.itemsize), dtype=INDEX)
        self.docs = np.frombuffer(stream.read(docs * DOCS.itemsize), dtype=DOCS)

    def blocks(self, first: int, stop: int) -> np.ndarray:
        """Ids of the blocks from ``first`` up to ``stop``."""
        stop = min(stop, len(self.index))
        if first >= stop:
            return np.zeros(0, np.uint32)
        end = int(self.index["offset"][stop]) if stop < len(self.index) else self.index_at
        self.stream.seek(int(self.index["offset"][first]))
        return decode_blocks(self.stream.read(end - int(self.index["offset"][first])), self.index[first:stop])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids at places ``start`` to ``stop``; decodes only the blocks they lie in."""
        first_at = np.concatenate([[0], np.cumsum(self.index["count"], dtype=np.int64)])
        stop = min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        a = int(np.searchsorted(first_at, start, side="right")) - 1
        b = int(np.searchsorted(first_at, stop, side="left"))
        return self.blocks(a, b)[start - int(first_at[a]) : stop - int(first_at[a])]

    def runs(self, blocks: int = RUN_BLOCKS) -> Iterator[np.ndarray]:
        for first in range(0, len(self.index), blocks):
            yield self.blocks(first, first + blocks)


def open_store(path: str):
    """File system and path within it, for a local path or a URI as Spark names it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


_MANIFEST = "shard int, path string, n_docs long, n_tokens long, n_bytes long"


def write_token_shards(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = None,
    percentile: float = PERCENTILE,
) -> DataFrame:
    """Encode whole texts and write them, ascending by id, as shard files in ``folder``.

    Returns the manifest (shard, path, n_docs, n_tokens, n_bytes), itself
    stored in the shared folder: it names the files of the attempts that
    succeeded, so a repeated task leaves at most an unnamed file behind.
    Null ids come first; equal ids are ordered by a hash of the text. A null
    or empty text is its end id alone. ``folder`` must be shared by all
    executors. An empty table gives an empty manifest.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.xxhash64(text_col).alias("tie"),
    )
    ordered = source.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, writer, stream = encoder(tokenizer_path).encode, None, None
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:07d}-{uuid.uuid4().hex}.pfor"
        for pdf in batches:
            if not len(pdf):
                continue
            if writer is None:
                fs, local = open_store(path)
                fs.create_dir(local.rsplit("/", 1)[0], recursive=True)
                stream = fs.open_output_stream(local)
                writer = ShardWriter(stream, percentile)
            coded = [encode(t) + end for t in pdf["text"]]
            table = np.zeros(len(pdf), dtype=DOCS)
            table["null_id"] = pdf["doc_id"].isna()
            table["doc_id"] = pdf["doc_id"].fillna(0).astype("int64")
            table["n_tokens"] = [len(c) // 4 for c in coded]
            writer.add(table, b"".join(coded))
        if writer is not None:
            done = writer.close()
            stream.close()
            yield pd.DataFrame([{"shard": shard, "path": path, **done}])

    return stage(ordered.mapInPandas(write, _MANIFEST), "pfor-manifest", TEXT_BATCH_ROWS)


def read_token_shards(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Every document as the files hold it: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it over all shards. One
    task reads one shard, a run of blocks at a time.
    """
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = stage(manifest.withColumn("base", F.coalesce(before, F.lit(0))), "pfor-bases")  # a row per file

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, base in zip(pdf["path"], pdf["base"], strict=True):
                fs, local = open_store(path)
                with fs.open_input_file(local) as stream:
                    yield from _documents(ShardReader(stream), int(base))

    files = max(1, shards.count())
    spread = shards.repartitionByRange(files, "shard").select("path", "base")
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(shard: ShardReader, base: int) -> Iterator[pd.DataFrame]:
    """The documents' digests, run by run; a document may span runs."""
    counts = shard.docs["n_tokens"].astype(np.int64)
    ends = np.cumsum(counts)
    crcs = np.zeros(len(counts), dtype=np.int64)
    doc, crc, place = 0, 0, 0
    for run in shard.runs():
        data, first = run.astype("<u4").tobytes(), place
        place += len(run)
        while doc < len(ends) and ends[doc] <= place:
            begin = max(first, ends[doc] - counts[doc])
            crcs[doc] = zlib.crc32(data[4 * (begin - first) : 4 * (ends[doc] - first)], crc)
            doc, crc = doc + 1, 0
        if doc < len(ends):
            begin = max(first, ends[doc] - counts[doc])
            crc = zlib.crc32(data[4 * (begin - first) :], crc)
    ids = pd.Series(shard.docs["doc_id"], dtype="Int64").mask(shard.docs["null_id"] == 1)
    for at in range(0, len(counts), 10_000):
        part = slice(at, at + 10_000)
        yield pd.DataFrame(
            {"doc_id": ids[part], "start": base + ends[part] - counts[part], "n_tokens": counts[part], "ids_crc32": crcs[part]}
        )


def encode_corpus(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the shards and read them back: one row per document."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "pfor-shards")
    return read_token_shards(spark, write_token_shards(docs, tokenizer_path, folder, end_id))
