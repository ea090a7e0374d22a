"""Document fingerprints of closed syncmers, and their likeness by position.

A k-mer (K code points) is an anchor if its least inner s-mer (S code points, by hash, the leftmost of equal ones) is its
first or its last one. That depends on the k-mer alone, so the same passage has the same anchors in every text, wherever
it stands; about one place in (K - S + 1) / 2 is an anchor, and there is at least one in any K - S + 1 places in a row.
A fingerprint holds the 32-bit hashes of all anchors of a whole text in order of place, in base64. A text of fewer than
K code points is one anchor.

The likeness of two fingerprints is 2 m / (a + b): a and b are their anchors and m is the longest chain of equal anchors
that stand in the same order in both; the n-th occurrence of an anchor is matched with the n-th one of the other. It is 1
for equal fingerprints, two empty ones included, and 0 if only one is empty.

Edge cases: null and empty texts have the fingerprint ''; equal texts have equal ones; texts of one repeated sign are
anchors all over and cost no more than their length. Of two documents with one id the one of the smaller hash of its text
comes first; null ids come before all others; a lone document is its own next one. Other columns are ignored.

Scale: fingerprints need no shuffle. next_pairs brings each document to the next one by id with one shuffle of the texts:
ids are sorted by Spark in ranges, whose first keys (one for each range) tell every row its range; a range is a group of
the shuffle, sorted inside a task, and ends with a copy of the first document of the next range. No task sees more than
its ranges, whatever the size of the table, and an id that holds many rows is split by their texts.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logspark.llm.common import arrow_schema, id_text, map_rows, mix
from logspark.llm.tables import written

K, S = 16, 4
#: Bytes of text that a range of ids holds about, and the least number of ranges for each shuffle partition.
RANGE_BYTES, RANGES = 32 << 20, 4
_FACTOR, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _hashes(points: np.ndarray, starts: np.ndarray | slice, n: int) -> np.ndarray:
    """Hashes of n code points from each of these starts; a slice has the number of starts as its end."""
    out = None
    for i in range(n):
        part = points[i : i + starts.stop] if isinstance(starts, slice) else points[starts + i]
        out = part * _STEP if out is None else out * _FACTOR + part * _STEP
    return mix(out)


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each n values in a row."""
    width, out = 1, values
    while width < n:
        step = min(width, n - width)
        out = np.minimum(out[:-step], out[step:])
        width += step
    return out


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places and 32-bit hashes of the closed syncmers of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    if n <= k:
        places = np.zeros(1, np.int64)
    else:
        inner = k - s + 1
        small = _hashes(points, slice(n - s + 1), s)
        ahead = _least(small, inner - 1)[: n - k + 1]  # of all inner ones but the last
        last = small[inner - 1 :]
        places = np.flatnonzero((last < ahead) | ((small[: n - k + 1] == ahead) & (ahead <= last)))
    return places, (_hashes(points, places, min(n, k)) >> np.uint64(32)).astype(np.uint32)


def written_as(hashes: np.ndarray) -> str:
    """A fingerprint as text."""
    return base64.b64encode(hashes.astype("<u4").tobytes()).decode()


def read_as(fingerprint: str) -> np.ndarray:
    """The hashes of a fingerprint."""
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def _occurrences(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (hash, number of its earlier occurrences) as one number, sorted, and the places of these."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    at = np.arange(len(ranked))
    return (ranked.astype(np.uint64) << np.uint64(32)) | (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64), order


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1: the share of anchors in the longest chain that stands in both in one order."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) == len(b) and (a == b).all():
        return 1.0
    (in_a, at_a), (in_b, at_b) = _occurrences(a), _occurrences(b)
    found = np.minimum(np.searchsorted(in_b, in_a), len(in_b) - 1)
    met = in_b[found] == in_a
    pairs = at_b[found[met]][np.argsort(at_a[met])]  # places in b, in the order of a
    if len(pairs) > 1 and not (pairs[1:] > pairs[:-1]).all():
        ends: list[int] = []
        for p in pairs.tolist():  # patience sorting: ends[i] is the least end of a chain of i + 1
            at = bisect_left(ends, p)
            ends[at : at + 1] = [p]
        pairs = ends
    return 2 * len(pairs) / (len(a) + len(b))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """doc_id, n_chars, n_anchors and fingerprint of each row of df."""

    def row(doc_id, data: bytes) -> tuple:
        text = data.decode("utf-8", "replace")
        hashes = anchors(text, k, s)[1]
        return doc_id, len(text), len(hashes), written_as(hashes)

    return map_rows(id_text(df, id_col, text_col), "doc_id long, n_chars long, n_anchors long, fingerprint string", row)


def anchor_places(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """doc_id, place and anchor: a row for each anchor, for joins of passages on the anchor."""

    def row(doc_id, data: bytes) -> tuple:
        places, hashes = anchors(data.decode("utf-8", "replace"), k, s)
        return doc_id, places.tolist(), hashes.astype(np.int64).tolist()

    lists = map_rows(id_text(df, id_col, text_col), "doc_id long, places array<long>, hashes array<long>", row)
    return lists.select("doc_id", F.inline(F.arrays_zip(F.col("places").alias("place"), F.col("hashes").alias("anchor"))).alias("place", "anchor"))


def likenesses(df: DataFrame, a: str, b: str, out: str = "likeness") -> DataFrame:
    """df with the likeness of two columns of fingerprints; null if one of them is."""

    @F.pandas_udf("double")
    def compare(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else likeness(read_as(p), read_as(q)) for p, q in zip(x, y, strict=True)], dtype="float64")

    return df.withColumn(out, compare(F.col(a), F.col(b)))


def next_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents in sorted groups: group, last, doc_id, text. Inside a group every row is followed by the next document;
    a row with last = 1 closes it with the first document of the next group (the last group: of the first one)."""
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col).withColumns({"text": F.coalesce("text", F.lit("")), "null": F.col("doc_id").isNotNull().cast("int"), "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0))})
    rows = rows.withColumn("hash", F.xxhash64("text"))
    key = ["null", "id", "hash"]
    ids = written(rows.select(*key, F.octet_length("text").alias("n")), "ids")
    total = ids.agg(F.sum("n")).head()[0] or 0
    n = max(RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    ranged = written(ids.select(*key).repartitionByRange(n, *key).withColumn("range", F.spark_partition_id()), "ids")
    firsts = sorted(tuple(r["first"]) for r in ranged.groupBy("range").agg(F.min(F.struct(*key)).alias("first")).collect())  # one for each range

    @F.pandas_udf("int")
    def group_of(null: pd.Series, id_: pd.Series, hash_: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(firsts, x) - 1 for x in zip(null.tolist(), id_.tolist(), hash_.tolist(), strict=True)], dtype="int32")

    own = rows.select(group_of(*key).alias("group"), F.lit(0).alias("last"), *key, "doc_id", "text")
    ends = spark.createDataFrame([(*x, (i - 1) % len(firsts)) for i, x in enumerate(firsts)], "null int, id long, hash long, group int")
    closing = rows.join(F.broadcast(ends), key).dropDuplicates(["group"]).select("group", F.lit(1).alias("last"), *key, "doc_id", "text")
    return own.unionByName(closing).repartition("group").sortWithinPartitions("group", "last", *key).select("group", "last", "doc_id", "text")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """One row for each row of docs: its fingerprint, that of its edited text (the last half replaced by the beginning of the
    next document, as far as that goes), and how alike its own is to the edited one's and to the next document's."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_anchors long"
    types = arrow_schema(docs.sparkSession, schema)

    def one(doc_id, text: str, own: np.ndarray, following: str, next_one: np.ndarray) -> tuple:
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        changed = anchors(edited, k, s)[1]
        return doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written_as(own), written_as(changed), likeness(own, changed), likeness(own, next_one), len(own)

    def run(batches):
        held = None  # group, doc_id, text and anchors of the row before
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part, out = b.slice(at, 256), []
                for group, last, doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    own = anchors(text, k, s)[1]
                    if held and held[0] == group:
                        out.append(one(*held[1:], text, own))
                    held = None if last else (group, doc_id, text, own)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), types, strict=True)], schema=types)

    return next_pairs(docs, id_col, text_col).mapInArrow(run, schema)
