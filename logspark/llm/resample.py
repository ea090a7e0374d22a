"""Target-distribution importance resampling: documents are drawn with odds that make them look like a target corpus.

1. Features are the runs of 1 to `runs` consecutive words, hashed into BUCKETS buckets. Each task counts its own in one
   array; Spark adds the arrays up, for the source and for the target.
2. A bucket's gain is the logarithm of its smoothed share in the target over that in the source, in thousandths. The
   gains, one array of BUCKETS numbers, go to the tasks; a document's weight is their sum over its features.
3. Gumbel noise from a hash of the document's id turns "the greatest scores" into a draw without replacement.
4. The documents of at least `least` words are ordered by score, then id, by distributed radix sort (see radix.py), and
   the first of them are drawn; their places are the ranks.

Edge cases: null, empty and wordless texts have no feature, weight 0, a score of noise alone and are not drawn where
least is above 0. A null id hashes as the empty text and comes after all ids of its score; rows that share an id share
their noise, and rows that tie in score and id are drawn in an order that is settled once. Without a target every gain
follows from the source alone; an empty source gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logspark.llm.common import ALNUM, arrow_schema, id_text, map_rows
from logspark.llm.radix import radix_places
from logspark.llm.tables import written

#: Buckets of features, words a drawn document has at least, the seed of the noise.
BUCKETS, LEAST, SEED = 10_000, 20, 2024
#: Words whose bucket a worker remembers.
REMEMBERED = 200_000

_seen: dict[tuple[int, bytes], int] = {}


def buckets_of(data: bytes, runs: int, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of each feature."""
    words = data.translate(ALNUM).split()
    seen, out = _seen, []
    if len(seen) > REMEMBERED:
        seen.clear()
    for w in words:
        b = seen.get((buckets, w))
        if b is None:
            b = crc32(w) % buckets
            if len(w) < 64:
                seen[buckets, w] = b
        out.append(b)
    for k in range(2, runs + 1):
        out += [crc32(b" ".join(words[i : i + k])) % buckets for i in range(len(words) - k + 1)]
    return len(words), np.array(out, np.int64)


def count_features(df: DataFrame, text_col: str = "text", runs: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts; a task sends each bucket once."""
    types = arrow_schema(df.sparkSession, "bucket int, n long")

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for data in b.column(0).cast(pa.large_binary()).to_pylist():
                total += np.bincount(buckets_of(data or b"", runs, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], schema=types)

    return df.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(run, types_ddl(types)).groupBy("bucket").agg(F.sum("n").alias("n"))


def types_ddl(types: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'long'}" for f in types)


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket from two tables of counts, each of at most `buckets` rows."""

    def counted(df: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for r in df.collect():
            out[r.bucket] = r.n
        return out

    s, t = counted(source), counted(target)
    all_s, all_t = float(s.sum()), float(t.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (all_s + buckets) / ((a + 1.0) * (all_t + buckets)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", runs: int = 1, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of each row of df."""
    buckets = len(gain)

    def row(doc_id, data: bytes) -> tuple:
        n_words, found = buckets_of(data, runs, buckets)
        weight = int(gain[found].sum())
        return doc_id, n_words, len(found), weight, weight + noise(doc_id, seed)

    return map_rows(id_text(df, id_col, text_col), "doc_id long, n_words long, n_features long, weight long, score long", row)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", runs: int = 1, buckets: int = BUCKETS, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """One row for each row of docs: doc_id, n_features, weight, score and rank; rank is null for what is not drawn.

    Of the N documents of at least `least` words floor(percent * N / 100) are drawn.
    """
    gain = gains(count_features(docs, text_col, runs, buckets), count_features(target, target_col, runs, buckets), buckets)
    scored = written(score(docs, gain, id_col, text_col, runs, seed), "scored")
    last = F.col("doc_id").isNull().cast("long")
    drawn = percent * scored.where(F.col("n_words") >= least).count() // 100
    open_ = scored.where(F.col("n_words") >= least).withColumns({"_null": last, "_id": F.coalesce("doc_id", F.lit(0))})
    placed = radix_places(open_, [("score", True), ("_null", False), ("_id", False)])
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = placed.select(*columns, F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank"))
    return ranked.union(scored.where(F.col("n_words") < least).select(*columns, F.lit(None).cast("long").alias("rank")))


def drop_undrawn(docs: DataFrame, target: DataFrame, percent: int = 10, id_col: str = "doc_id", **kw) -> DataFrame:
    """The rows of docs that are drawn, with all their columns; rows that share an id stay if one of them is drawn."""
    ids = resample(docs, target, percent, id_col, **kw).where("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, F.col(f"`{id_col}`").eqNullSafe(F.col("_drawn")), "left_semi")
