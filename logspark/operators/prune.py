"""Pruning: from postings or bitmaps to the chunks that can hold matches. A chunk is never pruned that holds one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logspark.operators.index import FACTORS
from logspark.operators.search import gate_expr
from logspark.session import written

#: Rows that a join of this module may broadcast (two keys each); above it Spark shuffles.
BROADCAST_ROWS = 500_000
#: Chunks that a search may name in its scan.
FEW = 1000
#: Hashes of a list that filters are tested with.
LISTED = 100_000


def by_size(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a side of at most limit rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def keep_chunks(events: DataFrame, chunks: DataFrame) -> DataFrame:
    """Events of the chunks. Few of them become lists of values, which reach the scan; a list may keep some chunks too many."""
    chunks = written(chunks.select("object_id", "chunk_id"), "chunks")  # the index is evaluated once
    found = chunks.limit(FEW + 1).collect()
    if len(found) > FEW:
        return events.join(by_size(chunks), ["object_id", "chunk_id"], "left_semi")
    lists = [sorted({r[c] for r in found if r[c] is not None}) for c in ("object_id", "chunk_id")]
    return events.where(F.col("object_id").isin(lists[0]) & F.col("chunk_id").isin(lists[1]))


#: Hexadecimal digits with the first, second, third and fourth bit set.
DIGITS = ("13579BDF", "2367ABEF", "4567CDEF", "89ABCDEF")


def bloom_might_contain(token: str | Column) -> Column:
    """P5. Over rows of filters: false only if the token is not in the set behind the filter, or is one of another part."""
    return _in_filter(F.xxhash64(F.lit(token) if isinstance(token, str) else token))


def _part_of(h: Column) -> Column:
    """The part that a hash is in: its first bits are the part's number; parts is a power of two, and 1 where there is one part."""
    return F.floor(F.shiftrightunsigned(h, 32) / F.lit(1 << 32) * F.col("parts"))


def filters_of(tokens: DataFrame, filters: DataFrame, keys: list[str]) -> DataFrame:
    """P5. Tokens (keys, token), each with the one filter of its keys that its hash belongs to, however many parts the keys have:
    keys have few numbers of parts, and a number and the hash give the part, so this is a join on equal columns."""
    numbers = filters.select(*keys, "parts").distinct()
    asked = tokens.join(by_size(numbers), keys).withColumn("part", _part_of(F.xxhash64("token")).cast("int"))
    return asked.join(filters, [*keys, "parts", "part"])


def _in_filter(h: Column) -> Column:
    """Whether the bits of a token's hash are set; they are tested one after the other, and no more of them once one is not."""
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)
    own = (F.col("parts") == 1) | (_part_of(h) == F.col("part"))

    def bit(i: int) -> Column:
        a, b = FACTORS[i]
        place = F.shiftright(low * F.lit(a) + high * F.lit(b), 20) % F.col("bits")
        byte = F.hex(F.substring(F.col("bitmap"), F.shiftright(place, 3).cast("int") + 1, F.lit(1)))
        digit = F.substring(byte, F.lit(2) - F.shiftright(place, 2).bitwiseAND(F.lit(1)).cast("int"), F.lit(1))  # the second one holds the low bits
        return (F.col("hashes") <= i) | (F.instr(F.get(F.array(*map(F.lit, DIGITS)), place.bitwiseAND(F.lit(3)).cast("int")), digit) > 0)

    return reduce(lambda a, b: a & b, [own, *(bit(i) for i in range(len(FACTORS)))])


def _hashes(tokens: list[str]) -> Column:
    """The hashes of tokens as one list, so that the size of a plan does not grow with them."""
    return F.transform(F.array(*map(F.lit, tokens)), lambda t: F.xxhash64(t))  # noqa: PLW0108


def filters_with_any(filters: DataFrame, tokens: DataFrame) -> DataFrame:
    """P6. Filters that may hold one of the tokens of a DataFrame of one column. A filter tests their hashes one after the other,
    in lists of about LISTED, and stops at the first one that it may hold."""
    hashes = tokens.select(F.xxhash64(tokens.columns[0]).alias("_h")).distinct()
    lists = hashes.groupBy(F.pmod("_h", F.lit(max(1, -(-hashes.count() // LISTED))))).agg(F.collect_list("_h").alias("_hashes")).select("_hashes")
    return filters.join(F.broadcast(lists), F.exists("_hashes", _in_filter)).drop("_hashes")


def might_contain_any(tokens: list[str]) -> Column:
    """P6. Without tokens false."""
    return F.exists(_hashes(tokens), _in_filter) if tokens else F.lit(False)


def might_contain_all(tokens: list[str]) -> Column:
    """P6. Of filters of one part: whether all may be in it; without tokens true."""
    return F.forall(_hashes(tokens), _in_filter) if tokens else F.lit(True)


def distinct_chunks(hits: DataFrame) -> DataFrame:
    """U4."""
    return hits.select("object_id", "chunk_id").distinct()


def _found(rows: DataFrame) -> DataFrame:
    """object_id, chunk_id, found: the query's tokens in each chunk, of all its buckets; at most as many as the query has."""
    return rows.groupBy("object_id", "chunk_id").agg(F.collect_set("token").alias("found"))


def _gate(text: str, tokens: list[list[str]]) -> Column:
    quoted = lambda t: "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"
    tests = {i: " AND ".join(f"array_contains(found, {quoted(t)})" for t in need) for i, need in enumerate(tokens) if need}
    return gate_expr(text, tests)


def can_prune(spark, text: str, tokens: list[list[str]]) -> bool:
    """Whether a chunk with none of the tokens fails the search: Spark folds the tree over constants."""
    tests = {i: "false" for i, need in enumerate(tokens) if need}
    return not spark.sql("VALUES (0)").select(gate_expr(text, tests).alias("x")).head().x  # a local relation: no job


def prune_by_postings(postings: DataFrame, text: str, tokens: list[list[str]], template_hashes: list[str] | DataFrame | None = None) -> DataFrame | None:
    """J3, J4, P7. Chunks whose tokens may satisfy the search, and hold one of the template hashes if some are given; many of
    them come as a DataFrame of one column.

    None: the search can't prune, every chunk stays.
    """
    need = sorted({t for c in tokens for t in c})
    chunks = None
    if need and can_prune(postings.sparkSession, text, tokens):
        chunks = _found(postings.where(F.col("token").isin(need))).where(_gate(text, tokens)).select("object_id", "chunk_id")
    if _given(template_hashes):
        hashed = prune_by_template(postings, template_hashes)
        chunks = hashed if chunks is None else chunks.join(hashed, ["object_id", "chunk_id"], "left_semi")
    return chunks


def _given(hashes: list[str] | DataFrame | None) -> bool:
    return isinstance(hashes, DataFrame) or bool(hashes)


def prune_by_template(postings: DataFrame, hashes: list[str] | DataFrame) -> DataFrame:
    """J4. Chunks with one of the template hashes."""
    if isinstance(hashes, DataFrame):
        return distinct_chunks(postings.join(by_size(hashes.toDF("token")), "token", "left_semi"))
    return distinct_chunks(postings.where(F.col("token").isin(hashes)))


def prune_by_bitmap(filters: DataFrame, text: str, tokens: list[list[str]], template_hashes: list[str] | DataFrame | None = None) -> DataFrame | None:
    """P5, P6, P7. As prune_by_postings, from bitmaps: a token, or any of the template hashes, counts as found if a bitmap of the chunk may hold it."""
    need = sorted({t for c in tokens for t in c})
    chunks = None
    if need and can_prune(filters.sparkSession, text, tokens):
        held = F.filter(F.array(*map(F.lit, need)), lambda t: _in_filter(F.xxhash64(t)))
        rows = filters.select("object_id", "chunk_id", F.explode(held).alias("token"))
        chunks = _found(rows).where(_gate(text, tokens)).select("object_id", "chunk_id")
    if _given(template_hashes):
        held = filters_with_any(filters, template_hashes) if isinstance(template_hashes, DataFrame) else filters.where(might_contain_any(template_hashes))
        hashed = distinct_chunks(held)
        chunks = hashed if chunks is None else chunks.join(hashed, ["object_id", "chunk_id"], "left_semi")
    return chunks


def hits_to_chunks(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """J1."""
    return distinct_chunks(hits).join(chunks, ["object_id", "chunk_id"])


def range_join(ranges: DataFrame, lines: DataFrame, block: int = 65536) -> DataFrame:
    """J2. Lines that start in a range (object_id, offset, length); each once for each range that holds it.

    Ranges are cut at blocks of offsets, so the join is by object and block and no line meets a range of another block.
    """
    last = F.floor((F.col("offset") + F.greatest(F.col("length") - 1, F.lit(0))) / block)
    cut = ranges.where("length > 0").withColumn("_block", F.explode(F.sequence(F.floor(F.col("offset") / block), last)))
    held = lines.withColumn("_block", F.floor(F.col("line_start") / block))
    return held.join(cut, ["object_id", "_block"]).where("line_start >= offset AND line_start < offset + length").drop("_block")


def merge_ranges(chunks: DataFrame, most: int = 1024) -> DataFrame:
    """J1, A8. Ranges of adjacent chunks (object_id, chunk_id, offset, length) joined: object_id, offset, length, n_chunks.

    Gaps and islands: a chunk that starts where the one before it ends continues its range. Ranges end at every `most`-th
    chunk number, so that no request is larger than that many chunks and an object's chunks are dealt over many groups.
    """
    w = W.partitionBy("object_id", "_group").orderBy("offset")
    held = chunks.select("object_id", "offset", "length", F.floor(F.col("chunk_id") / most).alias("_group")).where("length > 0")
    new = held.withColumn("_new", (F.coalesce(F.lag(F.col("offset") + F.col("length")).over(w), F.lit(-1)) != F.col("offset")).cast("int"))
    islands = new.withColumn("_island", F.sum("_new").over(w))
    return islands.groupBy("object_id", "_group", "_island").agg(F.min("offset").alias("offset"), F.sum("length").alias("length"), F.count(F.lit(1)).alias("n_chunks")).drop("_group", "_island")


def sort_ranges(ranges: DataFrame) -> DataFrame:
    """T1."""
    return ranges.dropDuplicates().orderBy("object_id", "offset", "length")


def match_templates(templates: DataFrame, terms: list[str]) -> DataFrame:
    """J7. Templates that hold all the terms."""
    from logspark.operators.search import line_has_terms

    return templates.where(line_has_terms(F.col("template"), terms)).select("template_hash")


def with_template(events: DataFrame, templates: DataFrame) -> DataFrame:
    """J5. Events with their template, the first of its hash."""
    from logspark.operators.index import merge_templates

    return events.join(merge_templates(templates).select("template_hash", "template"), "template_hash")
