"""Merkle manifest of a table, its leaves placed by bitmap ranks.

A leaf is the digest of a row's fields. Within a group leaves ascend by id, and
a leaf's place is a rank query, not a sort: per group the ids' bitmap is built
as 64-bit words, merged by bitwise or from the partial words of every task
(empty words are not stored), and a popcount directory holds for each word the
rows before it. The directory has three levels, so that no window over it has
more than 2**20 entries, however ids are spread. An id's place is its word's
offset plus the popcount of the lower bits.

Levels are reduced by key: a node's place gives its run (place / 8) and slot
(place mod 8); runs gather their slots in an array of at most 8. Proofs are
handed down from the root, run by run, so each level is joined once and only
at its own size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.staging import stage
from tidemark.operators.windows import RANGE_ROWS, running_sum

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Words per directory entry and entries per entry above: 2**20 each.
FAN = 20
#: Ids have words from -2**57 on; null ids come before all others, in a word of their own.
NULL_WORD = -(2**57) - 1
#: Equal leaves under one id beyond this number are numbered by several tasks.
COPIES = 4096


def digest(*parts: Column) -> Column:
    """H: lowercase hex sha256 of the parts' concatenation."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(values: list[Column]) -> Column:
    """H over the values: ``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(*parts)


def _group_key(group: Column) -> Column:
    """Null first, then bytewise: a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _rows_before(entries: DataFrame, within: list[str], by: str) -> DataFrame:
    """Directory entries with ``before``: the rows of the earlier entries of the same parent."""
    w = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return entries.withColumn("before", F.coalesce(F.sum("rows").over(w), F.lit(0)))


def bitmap_words(rows: DataFrame) -> DataFrame:
    """(g, word) -> ``mask`` of the ids present, ``rows`` and ``before``, the rows of the group in
    lower words; ``size``, the rows of the whole group."""
    words = stage(
        rows.groupBy("g", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"), F.count(F.lit(1)).alias("rows")),
        "merkle-words",
    )
    words = words.withColumn("block", F.shiftright("word", FAN))
    blocks = words.groupBy("g", "block").agg(F.sum("rows").alias("rows")).withColumn("top", F.shiftright("block", FAN))
    tops = blocks.groupBy("g", "top").agg(F.sum("rows").alias("rows"))
    tops = _rows_before(tops, ["g"], "top").withColumn("size", F.sum("rows").over(Window.partitionBy("g")))
    above = tops.select("g", "top", F.col("before").alias("base"), "size")
    blocks = _rows_before(blocks, ["g", "top"], "block").join(above, ["g", "top"])
    above = blocks.select("g", "block", (F.col("before") + F.col("base")).alias("base"), "size")
    words = _rows_before(words, ["g", "block"], "word").join(above, ["g", "block"])
    return words.select("g", "word", "mask", "rows", (F.col("before") + F.col("base")).alias("before"), "size")


def _numbered(repeated: DataFrame, range_rows: int) -> DataFrame:
    """Rows that share group and id, with ``nth`` (from 0) by leaf digest.

    Equal rows are counted first; the counts are added up by a prefix scan,
    which splits an id that many different rows share, and the copies are
    made again from their count, in stretches that are dealt anew.
    """
    keys = ["g", "word", "bit", "id", "leaf", "claimed"]
    counted = stage(repeated.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "merkle-repeated")
    counted = counted.withColumn("k", F.concat_ws("|", "g", "word", "bit"))
    placed = running_sum(counted, "k", ["leaf", "claimed"], "n", "upto", range_rows=range_rows)
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long")))
    stretches = placed.select(*keys, (F.col("upto") - F.col("n")).alias("first"), "n", start.alias("start"))
    stretches = stretches.repartition(F.xxhash64(*keys, "start"))
    last = F.least(F.col("start") + COPIES, F.col("n")) - 1
    each = stretches.select(*keys, "first", F.explode(F.sequence("start", last)).alias("copy"))
    return each.select(*keys, (F.col("first") + F.col("copy")).alias("nth"))


def placed_leaves(rows: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` (id, g, word, bit, leaf, claimed) with ``pos``, the leaf's place, and ``size``, its group's leaves."""
    words = stage(bitmap_words(rows), "merkle-directory")
    lower = F.bitwise_not(F.expr("shiftleft(-1L, bit)"))
    rank = F.col("before") + F.bit_count(F.col("mask").bitwiseAND(lower))
    keep = ["id", "g", "leaf", "claimed", "size"]
    found = rows.join(words, ["g", "word"])
    crowded = words.filter(F.col("rows") > F.bit_count("mask"))
    if crowded.isEmpty():
        return found.select(*keep, rank.alias("pos"))
    # Words in which an id repeats: the lower ids' further rows count too.
    whole = found.filter(F.col("rows") == F.bit_count("mask")).select(*keep, rank.alias("pos"))
    inside = rows.join(crowded.select("g", "word"), ["g", "word"], "left_semi")
    per_id = inside.groupBy("g", "word", "bit").agg(F.count(F.lit(1)).alias("n"))
    further = stage(
        per_id.filter("n > 1").groupBy("g", "word").agg(F.collect_list(F.struct("bit", (F.col("n") - 1).alias("more"))).alias("further")),
        "merkle-further",
    )
    lower_ones = F.filter("further", lambda e: e["bit"] < F.col("bit"))
    added = rank + F.aggregate(lower_ones, F.lit(0).cast("long"), lambda acc, e: acc + e["more"])
    again = F.exists("further", lambda e: e["bit"] == F.col("bit"))
    crowd = inside.join(further, ["g", "word"])
    single = crowd.filter(~again).drop("further").withColumn("nth", F.lit(0).cast("long"))
    several = _numbered(crowd.filter(again).drop("further"), range_rows)
    numbered = single.unionByName(several).join(words, ["g", "word"]).join(further, ["g", "word"])
    return whole.unionByName(numbered.select(*keep, (added + F.col("nth")).alias("pos")))


def _runs(nodes: DataFrame, *carried: str) -> DataFrame:
    """Nodes gathered into runs of ``ARITY`` by key: ``nodes`` in slot order and the digest they make."""
    slot = F.struct((F.col("pos") % ARITY).cast("int").alias("slot"), "digest", *carried)
    runs = nodes.groupBy("g", F.expr(f"pos div {ARITY}").alias("run"), "size").agg(F.sort_array(F.collect_list(slot)).alias("nodes"))
    made = digest(F.array_join(F.transform("nodes", lambda e: e["digest"]), ""))
    return runs.withColumn("made", F.when(F.col("size") > 1, made).otherwise(F.get("nodes", 0)["digest"]))


def _above(size: Column) -> Column:
    return F.when(size > 1, F.ceil(size / ARITY)).otherwise(F.lit(1)).cast("long")


def build_levels(nodes: DataFrame, *carried: str) -> list[DataFrame]:
    """The runs of every level, lowest first, until each group is one node.

    ``nodes``: g, pos, size, digest and ``carried`` columns, kept in the lowest runs.
    """
    levels = [stage(_runs(nodes, *carried), "merkle-level")]
    largest = levels[0].agg(F.max("size")).first()[0] or 1
    while largest > ARITY:
        up = levels[-1].filter(F.col("size") > ARITY).select("g", F.col("run").alias("pos"), _above(F.col("size")).alias("size"), F.col("made").alias("digest"))
        levels.append(stage(_runs(up), "merkle-level"))
        largest = -(-largest // ARITY)
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(g, made, level): the node that each group ends in."""
    out = None
    for k, runs in enumerate(levels):
        top = runs.filter(F.col("size") <= ARITY).select("g", "made", F.lit(k).alias("level"))
        out = top if out is None else out.unionByName(top)
    return out


NO_PATH = "array<struct<left:string,right:string>>"


def hand_down(levels: list[DataFrame], ends: DataFrame, *kept: str) -> DataFrame:
    """The nodes of the lowest level as rows, each with its ``path``: (left, right) siblings up to the root.

    ``ends``: g, level, path (of the group's top node) and ``kept`` columns.
    A level on which a group has a single node adds no entry.
    """
    paths = None
    for k in range(len(levels) - 1, -1, -1):
        start = ends.filter(F.col("level") == k).select("g", F.lit(0).cast("long").alias("run"), "path", *kept)
        paths = start if paths is None else paths.unionByName(start)
        there = levels[k].join(paths, ["g", "run"])
        beside = lambda test: F.array_join(
            F.transform(F.filter("nodes", test), lambda e: e["digest"]), ""
        )
        each = there.select("g", "run", "size", "nodes", "path", *kept, F.explode("nodes").alias("own"))
        slot = F.col("own.slot")
        entry = F.struct(beside(lambda e: e["slot"] < slot).alias("left"), beside(lambda e: e["slot"] > slot).alias("right"))
        path = F.when(F.col("size") > 1, F.concat(F.array(entry), "path")).otherwise(F.col("path"))
        paths = each.select("g", (F.col("run") * ARITY + slot).alias("run"), path.alias("path"), *kept, "own")
        if k:
            paths = paths.drop("own")
    return paths


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings make."""
    return F.aggregate(path, start, lambda acc, e: digest(e["left"], acc, e["right"]))


def _ranked(names: DataFrame) -> DataFrame:
    """Distinct ``g`` in order with ``pos`` and ``size``: ranges are ranked by themselves and moved by the rows before."""
    dealt = stage(names.repartitionByRange("g").withColumn("part", F.spark_partition_id()), "merkle-groups")
    parts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    offsets = parts.select("part", F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("g")) - 1
    size = dealt.count()
    return dealt.withColumn("own", own).join(F.broadcast(offsets), "part").select(
        "g", (F.col("own") + F.col("base")).cast("long").alias("pos"), F.lit(size).cast("long").alias("size")
    )


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    claims: dict[str, Column] | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, ``leaf``, ``claimed`` leaf, ``subroot``, ``root`` and
    ``path`` (left and right siblings from leaf to root, digests as hex).

    ``claims`` maps fields to altered values, whose leaf is ``claimed`` (the
    leaf itself without claims); the tree is always that of the table.

    Null fields have a leaf of their own; null ids come first in their group,
    a null group first of all. Rows that repeat an id follow one another by
    leaf digest, and equal rows each have their own leaf. Other columns are
    not read. An empty table gives no rows. Ids are whole numbers of 64 bits.
    """
    own = [F.col(f) for f in fields]
    claimed = leaf([(claims or {}).get(f, F.col(f)) for f in fields]) if claims else leaf(own)
    the_id = F.col(id_col).cast("long")
    rows = stage(
        docs.select(
            the_id.alias("id"),
            _group_key(F.col(group_col)).alias("g"),
            F.coalesce(F.shiftright(the_id, 6), F.lit(NULL_WORD).cast("long")).alias("word"),
            F.coalesce(the_id.bitwiseAND(F.lit(63)), F.lit(0)).cast("int").alias("bit"),
            leaf(own).alias("leaf"),
            claimed.alias("claimed"),
        ),
        "merkle-leaves",
    )
    leaves = placed_leaves(rows, range_rows).withColumnRenamed("leaf", "digest")
    levels = build_levels(leaves, "id", "claimed")
    subroots = stage(tops(levels), "merkle-subroots")
    names = _ranked(subroots.select("g"))
    top_nodes = names.join(subroots, "g").select(F.lit("").alias("g"), "pos", "size", F.col("made").alias("digest"), F.col("g").alias("member"))
    top_levels = build_levels(top_nodes, "member")
    root = tops(top_levels).select("g", F.col("made").alias("root"), "level").withColumn("path", F.array().cast(NO_PATH))
    ends = hand_down(top_levels, root, "root").select(F.col("own.member").alias("g"), "path", "root")
    ends = stage(ends.join(subroots.withColumnRenamed("made", "subroot"), "g"), "merkle-ends")
    out = hand_down(levels, ends, "subroot", "root")
    return out.select(
        F.col("own.id").alias(id_col), F.col("own.digest").alias("leaf"), F.col("own.claimed").alias("claimed"), "subroot", "root", "path"
    )


def verify(proofs: DataFrame) -> DataFrame:
    """``manifest`` rows with ``folded_root``, recomputed from the claimed leaf, and ``verified``."""
    folded = proofs.withColumn("folded_root", fold(F.col("claimed"), F.col("path")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(path: Column) -> Column:
    """H of a path's siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda e: F.concat(e["left"], e["right"])), ""))


def _sql_part(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"


def manifest_sql() -> str:
    """The manifest of ``documents`` and its check against tampered texts, level by level in recursive SQL."""
    parts = {name: _sql_part(name) for name in ("source", "lang", "n_chars", "text", "other")}
    return _MANIFEST_SQL.format(doc_id=_sql_part("d.doc_id"), **parts)


# crc32 of the decimal id by the table of its bytes; the tree of each group, then that of the groups; siblings by windows.
_MANIFEST_SQL = """
WITH RECURSIVE bits AS (
    SELECT range AS i, range AS v, 0 AS n FROM range(256)
    UNION ALL SELECT i, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END), n + 1 FROM bits WHERE n < 8
), crc AS (
    SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 1 AS ch, 4294967295::BIGINT AS v FROM documents WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT doc_id, s, ch + 1, xor(crc.v >> 8, bits.v) FROM crc
    JOIN bits ON bits.n = 8 AND bits.i = xor(crc.v & 255, ascii(substr(s, ch, 1))::BIGINT) WHERE ch <= length(s)
), tampered AS (
    SELECT doc_id FROM crc WHERE ch = length(s) + 1 AND xor(v, 4294967295::BIGINT) % 3 = 0
), own AS (
    SELECT d.doc_id, coalesce('=' || lang, '') AS g,
           {doc_id} || {source} || {lang} || {n_chars} AS head, text,
           CASE WHEN t.doc_id IS NOT NULL THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other
    FROM documents d LEFT JOIN tampered t ON d.doc_id = t.doc_id
), leaves AS (
    SELECT doc_id, g, sha256(head || {text}) AS leaf, sha256(head || {other}) AS start,
           row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY g) AS size
    FROM own
), lv AS (
    SELECT 0 AS level, g, pos, size, leaf AS digest FROM leaves
    UNION ALL
    SELECT level + 1, g, pos // 8, (size + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM lv WHERE size > 1 GROUP BY level, g, pos // 8, size
), sub AS (
    SELECT g, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS size FROM lv WHERE size = 1
), tv AS (
    SELECT 100 AS level, pos, size, subroot AS digest FROM sub
    UNION ALL
    SELECT level + 1, pos // 8, (size + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM tv WHERE size > 1 GROUP BY level, pos // 8, size
), beside AS (
    SELECT level, g, pos,
           coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM (SELECT level, g, pos, size, digest FROM lv UNION ALL SELECT level, NULL, pos, size, digest FROM tv) WHERE size > 1
    WINDOW w AS (PARTITION BY level, g, pos // 8 ORDER BY pos)
), path AS (
    SELECT a.doc_id, row_number() OVER (PARTITION BY a.doc_id ORDER BY b.level) - 1 AS step, b.l, b.r
    FROM leaves a JOIN sub ON a.g = sub.g
    JOIN beside b ON (b.level < 100 AND b.g = a.g AND b.pos = a.pos >> (3 * b.level)) OR (b.level >= 100 AND b.pos = sub.pos >> (3 * (b.level - 100)))
), fold AS (
    SELECT doc_id, 0 AS step, start AS acc FROM leaves
    UNION ALL
    SELECT f.doc_id, f.step + 1, sha256(p.l || f.acc || p.r) FROM fold f JOIN path p ON p.doc_id = f.doc_id AND p.step = f.step
), proof AS (
    SELECT a.doc_id, sha256(coalesce(string_agg(l || r, '' ORDER BY step), '')) AS proof_sha256, count(step) AS steps
    FROM leaves a LEFT JOIN path ON path.doc_id = a.doc_id GROUP BY a.doc_id
)
SELECT a.doc_id, a.leaf, sub.subroot, top.digest AS root, p.proof_sha256, f.acc AS folded_root, f.acc = top.digest AS verified
FROM leaves a JOIN sub ON a.g = sub.g JOIN (SELECT digest FROM tv WHERE size = 1) top ON true
JOIN proof p ON p.doc_id = a.doc_id JOIN fold f ON f.doc_id = a.doc_id AND f.step = p.steps
"""
