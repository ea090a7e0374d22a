"""Shared small helpers of the training-data operators: Arrow batch plumbing and word hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_WHITE = bytes([0x20, *range(0x09, 0x0E)])  # separators of words [^\x20\x09-\x0D]+
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))  # A-Z only
# Separators of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ become blanks; all other bytes stay, A-Z lower-cased.
ALNUM = bytes(0x20 if c < 0x30 or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in LOWER)


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; other columns, whatever their names, are left behind."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


_held: list = [None, None]


def hold(key: object, make: Callable[[], object]) -> object:
    """One object for each Python worker, kept between tasks of the same key; a task of another key lets it go first."""
    if _held[0] != key:
        _held[:] = [None, None]
        _held[:] = [key, make()]
    return _held[1]


def map_rows(df: DataFrame, schema: str, fn: Callable[[object, bytes], tuple], extra: tuple[object, Callable[[], object]] | None = None) -> DataFrame:
    """Applies fn(doc_id, utf8 bytes) -> tuple to each row of a (doc_id, text) frame, a batch of rows at a time.

    A null text is passed as empty bytes. Rows stay in their partition: no shuffle. extra, if given, is a key and a
    function that makes fn's third argument (an automaton, a model), which a worker holds until another key's task.
    """
    spark = df.sparkSession
    types = arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = hold(*(extra or (None, lambda: None)))
        more = (held,) if extra else ()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = [fn(i, t or b"", *more) for i, t in zip(part.column(0).to_pylist(), part.column(1).cast(pa.large_binary()).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), types, strict=True)], schema=types)
        pa.default_memory_pool().release_unused()  # a worker that waits for its next task keeps no batches

    return df.mapInArrow(run, schema)


def arrow_schema(spark, ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


_M = (1 << 64) - 1


def _random(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = _random(256, 11)
_POW = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15 | 1, dtype=np.uint64))
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[list(WORD_WHITE)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each bit of the result depends on all bits of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of UTF-8 text, in order."""
    starts, ends = word_bounds(data)
    return hash_words(data, starts, ends)


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words."""
    if not data:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    white = np.concatenate(([True], _IS_WHITE[np.frombuffer(data, np.uint8)], [True]))
    edges = np.flatnonzero(white[1:] != white[:-1])
    return edges[::2], edges[1::2]


def hash_words(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at these bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    offset = np.arange(len(raw), dtype=np.int64)
    offset -= np.repeat(np.append(0, starts), np.diff(np.concatenate(([0], starts, [len(raw)]))))
    value = _BYTE[raw] * _POW[offset & 0xFFFF]
    if (ends - starts).max() > 0x10000:
        value *= _POW[(offset >> 16) + 7]
    value[_IS_WHITE[raw]] = 0
    return mix(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of k consecutive words; of the whole sequence where there are fewer words; none without words."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[i : n - k + 1 + i] + np.uint64(k))
    return out
