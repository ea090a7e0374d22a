"""MinHash near-duplicates by min-max hashing.

Each permutation of the shingles gives two signature values, its minimum and its maximum, so that HASHES values need
half as many hash evaluations; both are unbiased for the Jaccard similarity. Bands of ROWS values are the buckets.

1. One pass over the texts (no shuffle) makes signatures and a digest of each shingle set. Rows with equal sets become
   one class, represented by its smallest id, however many they are; a digest pre-aggregates them before the shuffle.
2. Buckets with two or more classes give candidates: all pairs of a bucket of at most SMALL classes, and of a larger one
   a spanning tree of the pairs whose sketches agree most, so that pairs grow with members. A bucket of more than HOT is
   dealt into slots of about that size, twice and differently, so that slots of one dealing tie those of the other.
3. A pair is a link only if its whole shingle sets say so: 100 * intersection >= percent * union. Pairs whose sketches
   agree in fewer than LEAST of 64 bytes (at a similarity of 0.8: one in ten million) are not looked at. Sets travel to
   cells, not to pairs: what the candidate pairs hold together goes to one cell, or by blocks to the cells of two blocks
   where it is large, so that a set is shuffled once, or once for each block, however many partners it has.
4. The members of large buckets that still hold several connected components are compared by prefix filtering: of two
   sets at the threshold the rarest shingles, all but percent of them, have one in common, and the first they have in
   common stands so far in front that enough others can follow. Sets meet under such a shingle only, never in a bucket as
   a whole, so pages that share a template but no rare shingle do not meet. Where more than SMALL do, their sketches are
   compared in blocks of bounded size; pairs of different components are confirmed as in 3. The order of shingles comes from counts in 2^SLOT_BITS slots, a table of fixed size; any order is right.
5. Connected components over the links, distributed; texts travel only for classes that share a bucket.

At a similarity of 0.8 a pair shares no bucket with probability (1 - 0.8^5)^30, about 7e-6.

Edge cases: a null, empty or blank text has an empty set, is linked with nothing and is its own component; fewer words
than a shingle are one shingle; repeated rows are all returned, with equal values; a null id takes part and gets the
component of its class (null if the class has no other id); an empty table gives an empty result. Ids are taken to be
unique: different texts under one id may be merged. Columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logspark.llm.common import LOWER, arrow_schema, id_text, map_rows, mix, shingles, word_hashes
from logspark.llm.tables import BROADCAST_IDS, components, small, written

ROWS, BANDS = 5, 30
HASHES = ROWS * BANDS
SMALL = 8
LEAST = 34
#: Members of a bucket's slot, and copies of a text, that one key may have.
HOT = 512
#: Hot buckets that a filter may name.
HOT_KEYS = 10_000
#: Sketches, or sets, in a block; slots of the shingle counts.
BLOCK, SLOT_BITS = 1024, 18
#: Bytes of sets in a block of a large group, and in a cell of small ones.
BLOCK_BYTES, CELL_BYTES = 4 << 20, 1 << 20
#: Bits of a key filter: eight for each key, between these powers of two.
LEAST_BITS, MOST_BITS = 16, 28
_rng = np.random.default_rng(20)
MULTIPLY = _rng.integers(0, 1 << 63, HASHES // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FLIP = _rng.integers(0, 1 << 63, HASHES // 2, dtype=np.uint64)


def shingle_set(data: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text, A-Z lower-cased."""
    return np.unique(shingles(word_hashes(data.translate(LOWER)), k))


def signature(of: np.ndarray) -> np.ndarray:
    """Minima, then maxima, under each permutation."""
    low, high = np.full(HASHES // 2, ~np.uint64(0)), np.zeros(HASHES // 2, np.uint64)
    for at in range(0, len(of), 512):
        h = (of[at : at + 512, None] ^ FLIP) * MULTIPLY
        low, high = np.minimum(low, h.min(0)), np.maximum(high, h.max(0))
    return np.concatenate((low, high))


def bands(values: np.ndarray) -> list[int]:
    """One 64-bit bucket key for each band."""
    return [int.from_bytes(hashlib.blake2b(bytes([j]) + v.tobytes(), digest_size=8).digest(), "little", signed=True) for j, v in enumerate(values.reshape(BANDS, ROWS))]


def _signed(doc_id, data: bytes, k: int) -> tuple:
    found = shingle_set(data, k)
    if not len(found):
        return doc_id, 0, None, None, None
    values = signature(found)
    return doc_id, len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest(), bands(values), (values[:64] >> np.uint64(40)).astype(np.uint8).tobytes()


def _confirm(pairs: pa.Table, sets: pa.Table, percent: int) -> pa.Table:
    """Of the pairs (cell, a, b) of a cell, those that its whole sets (to, id, shingles) make links."""
    at = {i: k for k, i in enumerate(sets.column("id").to_pylist())}
    held = sets.column("shingles")
    taken = lambda i: np.frombuffer(held[at[i]].as_py(), np.uint64)
    keep, last, p = [], None, None
    pairs = pairs.select(["a", "b"]).sort_by("a")
    for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
        if a != last:
            last, p = a, taken(a)
        q = taken(b)
        both = len(np.intersect1d(p, q, assume_unique=True))
        keep.append(100 * both >= percent * (len(p) + len(q) - both))
    return pairs.filter(pa.array(keep, pa.bool_()))


def _sketch(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 64)


def _alike(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs whose sketches agree in LEAST bytes or more."""

    def run(batches):
        for t in batches:
            x, y = _sketch(t.column(2)), _sketch(t.column(3))
            yield t.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= LEAST, pa.bool_()))

    k = small(sketches)
    both = pairs.join(k.toDF("a", "ka"), "a").join(k.toDF("b", "kb"), "b")
    return both.select("a", "b", "ka", "kb").mapInArrow(run, "a long, b long")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs a < b, those that are links by the whole sets (id, n, shingles), which come to each cell once."""
    cells = written(_cells(pairs, sets), "cells")
    held = cells.select("cell", F.col("a").alias("id")).union(cells.select("cell", "b")).distinct()
    brought = sets.join(small(held), "id").select("cell", "id", "shingles").toDF("to", "id", "shingles")
    return cells.groupBy("cell").cogroup(brought.groupBy("to")).applyInArrow(lambda p, s: _confirm(p, s, percent), "a long, b long")


def _cells(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(cell, a, b): pairs of one connected group have one cell, which small groups share; a large one is dealt over
    blocks, and a pair's cell is that of its two blocks. A cell holds few sets, whatever the partners of each are."""
    nodes = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    groups = written(components(pairs, nodes).join(sets.select("id", "n"), "id"), "groups")
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("sets"), (8 * F.sum("n")).alias("bytes"))
    large = sizes.select("component", F.greatest(F.ceil(F.col("sets") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).alias("blocks")).where("blocks > 1")
    cells = -(-8 * (groups.agg(F.sum("n")).head()[0] or 0) // CELL_BYTES) or 1
    at = small(groups.join(small(large), "component", "left").select("id", "component", F.pmod(F.xxhash64("id"), "blocks").alias("block")))
    both = pairs.join(at.toDF("a", "group", "i"), "a").join(at.toDF("b", "_", "j"), "b")
    one = F.xxhash64(F.pmod(F.xxhash64("group"), F.lit(cells)))
    return both.select(F.when(F.col("i").isNull(), one).otherwise(F.xxhash64("group", F.least("i", "j"), F.greatest("i", "j"))).alias("cell"), "a", "b")


def _key_filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of hashes of keys (one long column), of at most 2^MOST_BITS bits: it has all of them, and few others."""
    bits = min(max(LEAST_BITS, (8 * keys.count()).bit_length()), MOST_BITS)

    def run(batches):
        held = np.zeros(1 << bits >> 6, np.uint64)
        for b in batches:
            slots = mix(b.column(0).to_numpy().view(np.uint64)) >> np.uint64(64 - bits)
            np.bitwise_or.at(held, slots >> np.uint64(6), np.uint64(1) << (slots & np.uint64(63)))
        at = np.flatnonzero(held)
        for k in range(0, len(at), 1 << 16):
            part = at[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(held[part].view(np.int64))], names=["word", "bits"])

    words = keys.mapInArrow(run, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << bits >> 6, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _passes(keep: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a key filter may hold each key."""
    slots = mix(keys.view(np.uint64)) >> np.uint64(64 - (len(keep) << 6).bit_length() + 1)
    return (keep[slots >> np.uint64(6)] >> (slots & np.uint64(63)) & np.uint64(1)).astype(bool)


def _members(classes: DataFrame, keep: np.ndarray) -> DataFrame:
    """(key, id, n) of the bands of classes (id, n, bands) that a key filter lets through."""
    sent = classes.sparkSession.sparkContext.broadcast(keep)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                keys = part.column(2).flatten().to_numpy()
                met = np.flatnonzero(_passes(sent.value, keys))
                row = pa.array(met // BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys[met]), part.column(0).take(row), part.column(1).take(row)], names=["key", "id", "n"])

    return classes.select("id", "n", "bands").mapInArrow(run, "key long, id long, n long")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows (doc_id, text) of these ids. Where they are too many for a broadcast, a filter lets few other texts
    through to the shuffle."""
    if nodes.count() > BROADCAST_IDS:
        sent = docs.sparkSession.sparkContext.broadcast(_key_filter(nodes.select("id")))

        def run(batches):
            for b in batches:
                yield b.filter(pa.array(_passes(sent.value, b.column(0).fill_null(0).to_numpy())))

        docs = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, text string")
    return docs.join(small(nodes), F.col("doc_id") == F.col("id"), "left_semi")


def _buckets(classes: DataFrame) -> DataFrame:
    """(top, key, id, n) of the members of buckets with two or more classes (id, n, bands); top is the bucket, key it or
    its slot. Most keys are of one class: a filter of the others keeps them out of the shuffle that brings members together."""
    sizes = written(classes.select(F.explode("bands").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    members = written(_members(classes, _key_filter(sizes.select("key"))), "members")
    hot = sizes.where(f"size > {HOT}").select("key", F.ceil(F.col("size") / HOT).alias("slots"))  # one for HOT members at most
    named = [r.key for r in hot.select("key").limit(HOT_KEYS + 1).collect()]
    # Members of hot buckets stay out of the shuffle that finds those of all others.
    rest = members.where(~F.col("key").isin(named)) if len(named) <= HOT_KEYS else members.join(small(hot), "key", "left_anti")
    cold = rest.join(sizes.where(f"size <= {HOT}").select("key"), "key")
    dealt = members.join(small(hot), "key")
    slots = F.explode(F.array(*[F.xxhash64("key", F.lit(i), F.pmod(F.xxhash64("id", F.lit(i)), F.col("slots"))) for i in range(2)]))
    columns = lambda key: (F.col("key").alias("top"), key.alias("key"), "id", "n")
    return cold.select(*columns(F.col("key"))).union(dealt.select(*columns(slots)))


def _pairs(bucket: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs a < b: all of a small bucket, a spanning tree of a large one."""
    sizes = bucket.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    little = bucket.join(sizes.where(f"size <= {SMALL}").select("key"), "key")
    every = little.alias("x").join(little.alias("y"), "key").where(f"x.id < y.id and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)").selectExpr("x.id a", "y.id b").distinct()
    large = bucket.join(sizes.where(f"size > {SMALL}").select("key"), "key").join(small(sketches), "id").select("key", "id", "n", "sketch")
    return _alike(every, sketches).union(large.groupBy("key").applyInArrow(lambda t: _tree(t, percent), "a long, b long")).distinct()


def _tree(t: pa.Table, percent: int) -> pa.Table:
    """A spanning forest of the rows (key, id, n, sketch), with the most alike pairs, by Prim's algorithm."""
    ids, n, sketch = t.column("id").to_numpy(), t.column("n").to_numpy(), _sketch(t.column("sketch"))
    best, link = np.full(len(ids), -1), np.zeros(len(ids), np.int64)
    left = np.ones(len(ids), bool)
    a, b = [], []
    for _ in range(len(ids)):
        at = int(np.argmax(np.where(left, best, -2)))
        left[at] = False
        if best[at] >= LEAST:
            a.append(min(ids[at], ids[link[at]]))
            b.append(max(ids[at], ids[link[at]]))
        alike = np.where(100 * np.minimum(n, n[at]) >= percent * np.maximum(n, n[at]), (sketch == sketch[at]).sum(1), -1)
        nearer = alike > best
        best[nearer], link[nearer] = alike[nearer], at
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _open(bucket: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, component) of the members of large buckets that hold several components."""
    seen = written(bucket.select("top", "id").join(labels, "id"), "seen")
    several = seen.groupBy("top").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high")).where(f"size > {SMALL} and low <> high")
    return seen.join(small(several.select("top")), "top").select("id", "component").distinct()


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _count_shingles(sets: DataFrame) -> np.ndarray:
    """How many sets have a shingle of each slot (a set may count more than once)."""

    def run(batches):
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                np.add.at(total, _slots(np.frombuffer(x, np.uint64)), 1)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["slot", "n"])

    counts = sets.select("shingles").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << SLOT_BITS, np.int64)
    out[counts.column("slot").to_numpy()] = counts.column("n").to_numpy()
    return out


def _prefixes(held: DataFrame, percent: int) -> DataFrame:
    """(key, id, component, n, place) of the rarest shingles of sets (id, component, shingles), by which those at the threshold meet."""
    sent = held.sparkSession.sparkContext.broadcast(_count_shingles(held))
    schema = "keys array<struct<key: long, place: int>>, id long, component long, n long"
    types = arrow_schema(held.sparkSession, schema)

    def run(batches):
        for b in batches:
            rows = []
            for i, c, x in zip(*(b.column(k).to_pylist() for k in ("id", "component", "shingles")), strict=True):
                x = np.frombuffer(x, np.uint64)
                n = sent.value[_slots(x)]
                rare = np.lexsort((x, n))[: len(x) - -(-percent * len(x) // 100) + 1]
                met = np.flatnonzero(n[rare] > 1)  # no other set has those of one
                rows.append(([{"key": k, "place": p} for k, p in zip(x[rare[met]].view(np.int64).tolist(), met.tolist(), strict=True)], i, c, len(x)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), types, strict=True)], schema=types)

    return held.select("id", "component", "shingles").mapInArrow(run, schema).select(F.explode("keys").alias("k"), "id", "component", "n").select("k.key", "id", "component", "n", "k.place")


def _met(posted: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs a < b of different components whose sketches agree, of rows (key, id, component, n, place) with a key in common."""
    sizes = posted.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    met = posted.join(sizes.select("key", "size"), "key")
    # If a shingle is the first in common, no more can be than those from there on: place in its own set tells how many.
    enough = f"{100 + percent} * least(x.n - x.place, y.n - y.place) >= {percent} * (x.n + y.n)"
    few = met.where(f"size <= {SMALL}")
    every = few.alias("x").join(few.alias("y"), "key").where(f"x.id < y.id and x.component <> y.component and {enough}").selectExpr("x.id a", "y.id b").distinct()
    left = met.where(f"size > {SMALL}").join(small(sketches), "id")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    held = left.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = held.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "component", "n", "place", "block", "sketch")

    def compare(t: pa.Table) -> pa.Table:
        ids, comps, n, place, block = (t.column(c).to_numpy() for c in ("id", "component", "n", "place", "block"))
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        sketch = _sketch(t.column("sketch"))
        right = np.flatnonzero(block == j)
        a, b = [], []
        for k in np.flatnonzero(block == i):
            follow = np.minimum(n[right] - place[right], n[k] - place[k])
            fits = right[(comps[right] != comps[k]) & ((100 + percent) * follow >= percent * (n[right] + n[k])) & ((ids[right] > ids[k]) | (i != j))]
            fits = fits[(sketch[fits] == sketch[k]).sum(1) >= LEAST]
            a += np.minimum(ids[fits], ids[k]).tolist()
            b += np.maximum(ids[fits], ids[k]).tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return _alike(every, sketches).union(dealt.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")).distinct()


def near_duplicates(df: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: doc_id, n_shingles, component_id, kept."""
    docs = id_text(df, id_col, text_col)
    signed = written(map_rows(docs, "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary", lambda i, t: _signed(i, t, k)), "signatures")
    filled = signed.where("digest is not null")
    classes = filled.groupBy("digest").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("rows"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = written(classes, "classes")
    bucket = written(_buckets(classes.where("id is not null").select("id", "n", "bands")), "buckets")
    nodes = written(bucket.select("id").distinct(), "candidates")
    once = not signed.select("doc_id").join(small(nodes), F.col("doc_id") == F.col("id"), "left_semi").groupBy("doc_id").count().where("count > 1").isEmpty()
    sketches = classes.join(small(nodes), "id", "left_semi").select("id", "sketch")
    sketches = sketches.dropDuplicates(["id"]) if once else sketches
    pairs = written(_pairs(bucket, sketches, percent), "pairs")
    sets = map_rows(_texts(docs, nodes), "id long, n long, shingles binary", lambda i, t: (i, len(x := shingle_set(t, k)), x.tobytes())).where("n > 0")
    sets = written(sets.dropDuplicates(["id"]) if once else sets, "sets")
    links = written(_links(pairs, sets, percent), "links")
    labels = components(links, nodes)
    left = written(_open(bucket, labels), "open")
    if not left.isEmpty():
        posted = written(_prefixes(left.join(sets, "id"), percent), "prefixes")
        met = written(_met(posted, sketches, percent), "pairs")
        labels = components(links.union(written(_links(met, sets, percent), "links")), nodes)
    # A row alone in its class and without links is its own component: most rows need no name.
    names = classes.join(labels, "id", "left").select("digest", "rows", F.coalesce("component", "id").alias("name"), "id").where("rows > 1 or name <> id")
    return _named(signed, written(names.select("digest", "rows", "name"), "names"))


def _named(signed: DataFrame, names: DataFrame) -> DataFrame:
    """Rows with the component of their class. Classes of many copies come by broadcast (one for HOT rows at most); all
    other rows, and those without words, are spread over the keys of the join."""
    hot = small(names.where(f"rows > {HOT}").select("digest", F.col("name").alias("first")))
    seen = signed.select("doc_id", "n_shingles", "digest").join(hot, "digest", "left")
    key = F.when(F.col("digest").isNotNull() & F.col("first").isNull(), F.col("digest")).otherwise(F.hex(F.xxhash64("doc_id")).cast("binary").substr(1, 8))
    rest = small(names.where(f"rows <= {HOT}").select(F.col("digest").alias("key"), "name"))
    component = F.coalesce("first", "name", "doc_id")
    return seen.withColumn("key", key).join(rest, "key", "left").select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(df: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one document of each component, the one with the smallest id; of rows that share its id, one stays."""
    judged = written(near_duplicates(df, k, percent, id_col, text_col), "judged")
    gone = small(judged.where("not kept").select(F.col("doc_id").alias("_gone")).distinct())
    left = df.join(gone, df[f"`{id_col}`"] == gone["_gone"], "left_anti")
    if judged.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return left
    known = F.col(f"`{id_col}`").isNotNull()
    return left.where(known).dropDuplicates([id_col]).union(left.where(~known))
