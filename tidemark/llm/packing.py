"""Packing documents into fixed-length sequences, first-fit decreasing.

A document's ids (with its end id) are cut at multiples of the capacity: the
full pieces are sequences of their own, the remainder is packed. Documents
are dealt by a seeded hash into groups of a bounded expected size, and each
group is packed alone: pieces in falling length, each into the first open
sequence with room. A tournament tree over the sequences' free places finds
that sequence in logarithmic time. With thousands of pieces in a group the
waste is at most the last sequence or two of a group.
"""

from __future__ import annotations

import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import TEXT_BATCH_ROWS, stage
from tidemark.llm.tokens import CACHE_ENTRIES, encoder

CAPACITY = 4096
END_ID = 2
#: Documents expected in a group.
DOCS_PER_GROUP = 4096
SEED = 20_240_229


class TournamentTree:
    """Free places of a row of bins; the winner of a match is the larger."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin with room: its number, and its free places before."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        before = free[node]
        free[node] = before - size
        bin_no = node - self.leaves
        while node > 1:
            node //= 2
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
        return bin_no, before


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces of equal length keep their order.

    A piece longer than the capacity is an error: cut before packing.
    """
    order = np.argsort(-np.asarray(lengths, dtype=np.int64), kind="stable")
    if len(lengths) and lengths[order[0]] > capacity:
        raise ValueError(f"a piece of {lengths[order[0]]} does not fit a bin of {capacity}")
    tree = TournamentTree(max(1, len(lengths)), capacity)
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    for i in order:
        bin_no, before = tree.place(int(lengths[i]))
        bins[i], offsets[i] = bin_no, capacity - before
    return bins, offsets


_PIECE = "start long, length long, doc_tokens long, ids_crc32 long"


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    cache_entries: int = CACHE_ENTRIES,
) -> DataFrame:
    """Each document's ids and its end id, cut into pieces of at most ``capacity``.

    Returns doc_id, grp_hash, start, length, doc_tokens, ids_crc32 and, if
    asked for, ids (little-endian uint32 bytes). A null or empty text is its
    end id alone. No shuffle. ``deal`` is a hash of id and text; the second
    and further rows of a partition that repeat both get hashes of their own,
    by partition and number, so that no group gathers all copies. A worker
    remembers the ids of at most ``cache_entries`` chunks.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path, cache_entries).encode
        part, seen = TaskContext.get().partitionId(), Counter()
        for pdf in batches:
            rows = []
            for doc_id, deal, text in zip(pdf["doc_id"], pdf["deal"], pdf["text"], strict=True):
                copies = seen[deal]
                seen[deal] += 1
                if copies:
                    deal = _own_deal(deal, part, copies)
                ids = encode(text) + end
                total = len(ids) // 4
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    row = (doc_id, deal, at // 4, len(piece) // 4, total, zlib.crc32(piece))
                    rows.append((*row, piece) if with_ids else row)
            yield _frame(rows, with_ids)

    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.lit(SEED), F.col(id_col), F.col(text_col)).alias("deal"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return source.mapInPandas(cut, f"doc_id long, deal long, {_PIECE}" + (", ids binary" if with_ids else ""))


def _own_deal(deal: int, part: int, copies: int) -> int:
    return xxhash.xxh64_intdigest(struct.pack("<qqq", deal, part, copies)) - 2**63


def _frame(rows: list[tuple], with_ids: bool) -> pd.DataFrame:
    names = ["doc_id", "deal", "start", "length", "doc_tokens", "ids_crc32"] + ["ids"] * with_ids
    out = pd.DataFrame(rows, columns=names)
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    docs_per_group: int = DOCS_PER_GROUP,
    with_ids: bool = False,
    cache_entries: int = CACHE_ENTRIES,
) -> DataFrame:
    """Pieces and their places: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Only these short columns are shuffled, unless ``with_ids`` carries the
    ids along for ``build_sequences``. Sequence ids are unique over all
    groups (group number in the high bits). Ties in length are broken by id
    and start. Rows that repeat id and text are packed as often as they
    occur; a null id is packed like any other. An empty table gives no rows.
    The pieces are stored in batches of ``TEXT_BATCH_ROWS`` documents, so that
    a worker and its executor hold little text at a time.
    """
    groups = max(1, -(-docs.count() // docs_per_group))
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids, cache_entries)
    pieces = stage(pieces, "pieces", TEXT_BATCH_ROWS).withColumn("grp", F.pmod("deal", F.lit(groups))).drop("deal")

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", na_position="last")
        bins, offsets = first_fit_decreasing(pdf["length"].tolist(), capacity)
        return pdf.assign(sequence_id=(pdf["grp"].to_numpy() << 32) + bins, offset=offsets).drop(columns="grp")

    schema = f"doc_id long, {_PIECE}" + (", ids binary" if with_ids else "") + ", sequence_id long, offset long"
    return pieces.groupBy("grp").applyInPandas(place, schema)


def build_sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """Each sequence's ids from ``pack(..., with_ids=True)``: sequence_id, n_tokens, ids.

    Ids are padded with ``pad_id`` to the capacity, except when their number
    is a power of two. A sequence holds at most ``capacity`` ids, so its
    pieces gather in bounded memory.
    """
    pad = np.array([pad_id], dtype="<u4").tobytes()
    joined = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("pieces")
    )
    body = F.aggregate(F.col("pieces"), F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    power = F.expr("bit_count(n_tokens) = 1")
    missing = F.when(power, 0).otherwise(F.lit(capacity) - F.col("n_tokens")).cast("int")
    return joined.select("sequence_id", "n_tokens", F.concat(body, F.unhex(F.repeat(F.lit(pad.hex()), missing))).alias("ids"))
