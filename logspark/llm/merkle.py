"""Merkle dataset manifest: a digest of every row, trees over them, and a proof of each row against one root.

1. A row's leaf is the SHA-256 of its columns, each as `-` if null, else UTF-8 byte count, colon and value.
2. Leaves are numbered in their group by a range-partitioned sort: a row's place is its place in its range plus the rows
   of the ranges before it, which are a few counts.
3. Slot pivot: conditional aggregates spread the children of a parent into slot columns, and the concatenated columns of
   a run hash to its parent. A pass pivots LEVELS levels at once (fanout ** LEVELS columns, the inner levels are
   expressions over them), so that a tree of n leaves takes log(n) / log(fanout ** LEVELS) passes, each over so much
   fewer rows. Each pass is written, as the way down reads it again.
4. The groups' roots are the leaves of one more tree, in the order of the groups; its root is that of the dataset.
5. On the way down each parent hands every child the siblings found so far and the child's own, which are the slot
   columns of its run without its own slot: a join for each pass, on group and index, of a table that is small above.

A path is a list of (left, right) for each level that hashes, bottom up: what stands left and right of the node in its
run. A lone last run has both empty and hashes its one node again. A group of one row has its leaf as root.

Edge cases: a null group is a group of its own, before all others; null ids come first; rows that share an id are
ordered by their leaf, equal rows are leaves of their own with one leaf digest; an empty table gives an empty manifest.
Other columns, whatever their names, are ignored. Nothing here depends on the size of a group, and no group meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logspark.llm.tables import small, written

#: Levels of a tree of fanout 2 that one pass pivots; a wider tree takes fewer, so that no pass has more than 16 slots.
LEVELS = 3
#: The path of a root.
NONE = "cast(array() AS array<struct<left: string, right: string>>)"


def field(col: Column) -> Column:
    """A value of a leaf: `-` if null, else its UTF-8 byte count, a colon and itself."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def group_key(col: Column) -> Column:
    """A group as a text that is never null: nulls first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows (with a column group) with index, their place in their group from 0, and size, the rows of the group."""
    ranged = rows.repartitionByRange(F.col("group"), *order).sortWithinPartitions(F.col("group"), *order)
    placed = written(ranged.withColumn("_place", F.monotonically_increasing_id()), "ordered")  # range and place in it
    span = F.shiftright("_place", 33).alias("_range")
    parts = placed.groupBy("group", span).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    by = W.partitionBy("group")  # a row for each range at most
    before = F.coalesce(F.sum("_n").over(by.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = written(parts.select("group", "_range", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(by).alias("size")), "ranges")
    held = placed.withColumn("_range", span).join(small(parts), ["group", "_range"])
    return held.withColumn("index", F.col("_place") + F.col("_shift")).drop("_place", "_range", "_shift")


def _size(level: int, fanout: int) -> str:
    """Nodes of a group this many levels above those that size counts, as SQL."""
    return f"((size + {fanout**level - 1}) div {fanout**level})"


def _inner(table: DataFrame, fanout: int, levels: int) -> DataFrame:
    """A pivoted table with the nodes of its inner levels: n{level}_{slot}, of which level 0 are the children themselves."""
    width = fanout**levels
    out = table.selectExpr("*", *[f"c{j}.digest AS n0_{j}" for j in range(width)])
    for i in range(levels):
        runs = [[f"n{i}_{m}" for m in range(p * fanout, (p + 1) * fanout)] for p in range(width // fanout ** (i + 1))]
        hashed = [f"CASE WHEN {run[0]} IS NULL OR {_size(i, fanout)} = 1 THEN {run[0]} ELSE sha2(concat_ws('', {', '.join(run)}), 256) END" for run in runs]
        out = out.selectExpr("*", *[f"{h} AS n{i + 1}_{p}" for p, h in enumerate(hashed)])
    return out


def _levels(fanout: int) -> int:
    if fanout < 2:
        raise ValueError("a parent has at least two slots")
    return next((n for n in range(LEVELS, 0, -1) if fanout**n <= 16), 1)


def climb(nodes: DataFrame, payload: list[str], fanout: int) -> list[DataFrame]:
    """The pivoted table of each pass, bottom up, written: group, index of the parent, size (of the children's level), slots c0, c1, ...

    nodes: group, index, size, digest and payload, which stays with the slots of the first pass.
    """
    levels = _levels(fanout)
    width, tables = fanout**levels, []
    while True:
        item = F.struct("digest", *payload)
        dealt = nodes.select("group", F.expr(f"index div {width}").alias("index"), "size", F.expr(f"index % {width}").alias("slot"), item.alias("item"))
        table = written(dealt.groupBy("group", "index", "size").agg(*[F.expr(f"max(CASE WHEN slot = {j} THEN item END)").alias(f"c{j}") for j in range(width)]), "slots")
        tables.append(table)
        if (table.agg(F.max("size")).head()[0] or 0) <= width:
            return tables
        nodes = tops(table, fanout).withColumn("size", F.expr(_size(levels, fanout)))
        payload = []


def tops(table: DataFrame, fanout: int) -> DataFrame:
    """group, index, size (still of the level of the slots) and digest of the parents of a pivoted table."""
    levels = _levels(fanout)
    return _inner(table, fanout, levels).select("group", "index", "size", F.col(f"n{levels}_0").alias("digest"))


def descend(tables: list[DataFrame], seeds: DataFrame, payload: list[str], fanout: int) -> DataFrame:
    """A row for each node that climb got: group, digest, payload, path, and the columns of seeds.

    seeds has a row for each group: group, path (what stands above the group's root) and columns that its nodes get.
    """
    levels = _levels(fanout)
    width = fanout**levels
    carried = [c for c in seeds.columns if c not in ("group", "path")]
    above = seeds.withColumn("index", F.lit(0).cast("long"))
    for depth, table in reversed(list(enumerate(tables))):
        slots = []
        for j in range(width):
            own = []
            for i in range(levels):
                at = j // fanout**i
                first = at // fanout * fanout
                left, right = (f"concat_ws('', {', '.join(f'n{i}_{m}' for m in some)})" if some else "''" for some in (range(first, at), range(at + 1, first + fanout)))
                own.append(f"CASE WHEN {_size(i, fanout)} > 1 THEN array(struct({left} AS left, {right} AS right)) ELSE {NONE} END")
            slots.append(f"CASE WHEN c{j} IS NOT NULL THEN struct({j} AS slot, c{j} AS item, concat({', '.join(own)}, path) AS path) END")
        rows = _inner(table, fanout, levels).join(above, ["group", "index"])
        found = rows.selectExpr("group", "index", *carried, f"explode(filter(array({', '.join(slots)}), s -> s IS NOT NULL)) AS one")
        kept = [f"one.item.{c}" for c in (["digest", *payload] if not depth else [])]
        above = found.selectExpr("group", *carried, f"index * {width} + one.slot AS index", "one.path AS path", *kept)
    return above.drop("index")


def manifest(leaves: DataFrame, payload: list[str], fanout: int = 2) -> DataFrame:
    """A row for each leaf: group, digest, payload, path, subroot (of its group) and root.

    leaves: group (a group_key), digest, and payload, whose first column orders the leaves of a group, nulls first.
    """
    nodes = numbered(leaves.select("group", "digest", *payload), [F.col(payload[0]), F.col("digest")])
    tables = climb(nodes, payload, fanout)
    roots = tops(tables[-1], fanout).select(F.lit("").alias("group"), "digest", F.col("group").alias("of"))
    above = climb(numbered(roots, [F.col("of")]), ["of"], fanout)
    top = tops(above[-1], fanout).select("group", F.col("digest").alias("root"), F.expr(NONE).alias("path"))
    seeds = descend(above, top, ["of"], fanout).select(F.col("of").alias("group"), F.col("digest").alias("subroot"), "root", "path")
    return descend(tables, seeds, payload, fanout)


def proof_digest(path: Column) -> Column:
    """The SHA-256 of all siblings of a path, from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(path, lambda e: F.concat(e["left"], e["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf has with the siblings of a path."""
    return F.aggregate(path, leaf, lambda at, e: F.sha2(F.concat(e["left"], at, e["right"]), 256))


def prove(docs: DataFrame, columns: list[str], group_col: str, id_col: str, fanout: int = 2, tampered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """The manifest of a table and a check of each row against it.

    One row for each row of docs: id, leaf, subroot, root, path, proof_sha256, folded_root and verified. folded_root is
    that of the row as it is checked: with the values of tampered, columns by name, where `where` is true, else as it was.
    """
    changed = [(tampered or {}).get(c, F.col(f"`{c}`")) for c in columns]
    seen = F.when(F.coalesce(where, F.lit(False)), leaf_digest(*changed)) if where is not None else F.lit(None).cast("string")
    leaves = docs.select(group_key(F.col(f"`{group_col}`")).alias("group"), leaf_digest(*[F.col(f"`{c}`") for c in columns]).alias("digest"), F.col(f"`{id_col}`").alias("id"), seen.alias("seen"))
    proofs = manifest(written(leaves, "leaves"), ["id", "seen"], fanout)
    folded = proofs.withColumn("folded_root", fold(F.coalesce("seen", "digest"), F.col("path")))
    return folded.select("id", F.col("digest").alias("leaf"), "subroot", "root", "path", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def verify_documents(docs: DataFrame, fanout: int = 2) -> DataFrame:
    """The contract's table: documents by language, of which every seventh by CRC-32 is checked with a tampered n_chars."""
    key = F.col("`doc_id`").cast("string")
    out = prove(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", fanout, {"n_chars": F.col("`n_chars`").cast("long") + 1}, F.crc32(key.cast("binary")) % 7 == 0)
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
