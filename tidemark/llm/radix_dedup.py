"""Exact dedup by distributed MSD radix partitioning.

Documents are split by the length and the leading bytes of their normalised
text, the groups so made by the next bytes, and so on, until a group is a
single document or its texts have ended. Groups that end together are equal by
construction: every byte has been compared, no digest decides.

One round is one grouping and one join. The number of bytes read per round
grows geometrically, so the rounds are logarithmic in the longest text. Only
groups that are still open carry their remaining bytes on, so unique
documents leave after the first round or two and only copies, and documents
with long common openings, travel further. A group holding a third of all
rows is counted with map-side partial sums and joined back by a join that
adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import shared_folder, stage, stage_at, temporary

#: Bytes compared in the first round, and the factor from round to round.
FIRST_BYTES = 32
GROWTH = 16

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column | str) -> Column:
    """Null counts as empty; each run of ASCII white space becomes one space."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), WHITE_SPACE, " ")


def radix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first_bytes: int = FIRST_BYTES,
    growth: int = GROWTH,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after ``normalised``. Of equal texts the
    row with the smallest id stays; null ids come last, and of rows that
    repeat id and text one stays. ``keep_id`` is the id of the row that stays
    (null when every id of the group is null), ``text_sha256`` the digest of
    the normalised text, for output only. Empty and null texts are equal to
    each other. Other columns are not read, whatever their names. An empty
    table gives no rows.
    """
    base = docs.select(F.col(id_col).alias("id"), F.encode(normalised(text_col), "UTF-8").alias("bytes")).select(
        "id",
        F.sha2("bytes", 256).alias("sha"),
        F.length("bytes").alias("size"),
        F.substring("bytes", 1, first_bytes).alias("chunk"),
        F.expr(f"substring(bytes, {first_bytes + 1})").alias("tail"),
    )
    opened = _opened(base, F.concat("chunk", "tail"), ["id", "sha"])
    single, ended = _rounds(opened.filter("open").drop("open"), first_bytes, growth, ["id", "sha"])
    return _decide(_union([opened.filter(~F.col("open")).select("id", "sha"), *single]), _union(ended), id_col)


def _opened(base: DataFrame, tail: Column, carried: list[str]) -> DataFrame:
    """Round one, stored: openings that occur twice (``open``), everything else is already single.

    ``base`` has size, chunk and the ``carried`` columns; ``tail``: the bytes that an open row takes on.
    """
    repeated = stage(
        base.groupBy("size", "chunk")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.col("size").alias("opening_size"), F.col("chunk").alias("opening")),
        "radix-openings",
    )
    # The number of repeated openings grows with the table: merged, never broadcast.
    same = (base["size"] == repeated["opening_size"]) & (base["chunk"] == repeated["opening"])
    first = base.join(repeated.hint("merge"), same, "left")
    path = shared_folder(base.sparkSession, "radix-first")
    is_open = F.col("opening").isNotNull()
    return stage_at(
        first.select(
            F.monotonically_increasing_id().alias("row"),
            *carried,
            is_open.alias("open"),
            F.col("size").cast("long").alias("grp"),
            F.when(is_open, tail).alias("tail"),
        ),
        path,
    )


def _rounds(pending: DataFrame, width: int, growth: int, carried: list[str]) -> tuple[list[DataFrame], list[DataFrame]]:
    """The later rounds over open rows (row, ``carried``, grp, tail): those that became single, and those whose group ended."""
    single, ended = [], []
    while True:
        cut = pending.select(
            "row",
            *carried,
            "grp",
            F.substring("tail", 1, width).alias("chunk"),
            (F.length("tail") <= width).alias("end"),
            F.expr(f"substring(tail, {width + 1})").alias("tail"),
        )
        key = ["grp", "chunk", "end"]
        groups = stage(cut.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("new_grp")), "radix-groups")
        path = shared_folder(pending.sparkSession, "radix-round")
        done = (F.col("n") == 1) | F.col("end")
        split = stage_at(
            cut.join(groups, key).select(
                "row",
                *carried,
                F.col("new_grp").alias("grp"),
                F.when(F.col("n") == 1, 1).when(F.col("end"), 2).otherwise(0).alias("state"),
                F.when(~done, F.col("tail")).alias("tail"),
            ),
            path,
        )
        single.append(split.filter("state = 1").select(*carried))
        ended.append(split.filter("state = 2").select("row", *carried, "grp"))
        pending = split.filter("state = 0").drop("state")
        if pending.isEmpty():
            return single, ended
        width *= growth


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _decide(single: DataFrame, ended: DataFrame, id_col: str) -> DataFrame:
    by_id = ended.groupBy("grp", "id").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("n"))
    heads = stage(
        by_id.groupBy("grp").agg(
            F.min("id").alias("keep_id"),
            F.sum("n").alias("group_size"),
            F.coalesce(F.min_by("row", "id"), F.min("row")).alias("keep_row"),
        ),
        "radix-heads",
    )
    copies = ended.join(heads, "grp").select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    alone = single.select(
        F.col("id").alias(id_col),
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return alone.unionByName(copies)


def drop_exact_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first_bytes: int = FIRST_BYTES,
    growth: int = GROWTH,
) -> DataFrame:
    """The rows of ``docs`` that ``radix_dedup`` keeps, all columns unchanged.

    Whole rows are shuffled once, in round one, and stored with a row number;
    rows with a single opening are kept from there, and of the others the
    rounds name the row numbers that stay. Of rows that repeat id and text one
    is returned. Columns may have any names.
    """
    spark = docs.sparkSession
    columns = docs.columns
    with temporary(spark) as scope:
        numbered = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]).alias("doc"))
        text = f"doc.c{columns.index(text_col)}"
        bytes_ = F.encode(normalised(text), "UTF-8")
        base = numbered.select(
            "doc", F.length(bytes_).alias("size"), F.substring(bytes_, 1, first_bytes).alias("chunk")
        )
        # Every byte travels once: an open row's remaining bytes are made from its text again.
        opened = _opened(base, bytes_, ["doc"])
        is_id = F.col(f"doc.c{columns.index(id_col)}").cast("long").alias("id")
        _, ended = _rounds(opened.filter("open").select("row", is_id, "grp", "tail"), first_bytes, growth, ["id"])
        copies = _union(ended)
        by_id = copies.groupBy("grp", "id").agg(F.min("row").alias("row"))
        keepers = by_id.groupBy("grp").agg(F.coalesce(F.min_by("row", "id"), F.min("row")).alias("kept"))
        dropped = copies.join(keepers.hint("merge"), "grp").filter("row <> kept").select(F.col("row").alias("gone"))
        dropped = stage(dropped, "radix-dropped")
        scope.keep(opened, dropped)
    open_rows = opened.filter("open")
    stay = open_rows.join(dropped.hint("merge"), open_rows["row"] == dropped["gone"], "left_anti")
    kept = opened.filter("not open").select("doc").unionByName(stay.select("doc"))
    return kept.select(*[F.col(f"doc.c{i}").alias(c) for i, c in enumerate(columns)])
