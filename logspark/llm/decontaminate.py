"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of test questions and answers.

A text is lower-cased (A-Z) and cut in words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+; the words, joined by single blanks,
are scanned once, and each match is mapped back to word numbers and to code points of the original text.
Every 13 consecutive words of an item are a window; an item of fewer words, but not none, is one window.

Edge cases: a null or empty text has no words and no hits; a null or empty benchmark item has no window; equal items
and repeated rows are all counted (an item_id once); with an empty benchmark nothing is hit. Other columns are ignored.

Scale: documents are never shuffled. The benchmark, not the corpus, is what tasks hold: its windows go out in blocks
of at most BLOCK_BYTES of text (or one item, if longer). One block is scanned lazily; of several each has a job of its
own, which writes its hits to the shared folder, and its windows are released before the next block's are made. Hits are
merged by the text's digest, so driver and tasks hold one block at a time.
"""

from __future__ import annotations

import hashlib
import itertools

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logspark.llm.common import ALNUM, arrow_schema, hold, id_text, map_rows
from logspark.llm.tables import small, written

WINDOW = 13
#: Benchmark text in one automaton.
BLOCK_BYTES = 4 << 20
#: Texts with hits that a join may broadcast.
HIT_ROWS = 100_000
SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<long>, spans string"


def normalise(data: bytes) -> list[bytes]:
    return data.translate(ALNUM).split()


def windows(items: list[tuple[int, bytes]], size: int) -> dict[str, tuple[int, tuple]]:
    """Normalised window, with a blank on both sides -> (words, ids of its items). Bytes stand as Latin-1 characters."""
    found: dict[bytes, tuple[int, set]] = {}
    for item, data in items:
        words = normalise(data)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            part = words[i : i + size]
            found.setdefault(b" " + b" ".join(part) + b" ", (len(part), set()))[1].add(item)
    return {k.decode("latin-1"): (n, tuple(ids)) for k, (n, ids) in found.items()}


def build(of: dict[str, tuple[int, tuple]]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for k, (n, ids) in of.items():
        made.add_word(k, (len(k), n, ids))
    if of:
        made.make_automaton()
    return made


def scan(data: bytes, machine: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, hit word intervals (merged) and item ids."""
    words = normalise(data)
    if not words or not len(machine):
        return len(words), [], set()
    text = (b" " + b" ".join(words) + b" ").decode("latin-1")
    hits = list(machine.iter(text))
    if not hits:
        return len(words), [], set()
    blanks = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
    starts = np.searchsorted(blanks, [end - length + 1 for end, (length, _, _) in hits])
    merged: list[tuple[int, int]] = []
    for s, n in sorted((int(s), n) for s, (_, (_, n, _)) in zip(starts, hits, strict=True)):
        if merged and s <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(merged[-1][1], s + n)
        else:
            merged.append((s, s + n))
    return len(words), merged, {i for _, (_, _, ids) in hits for i in ids}


def original(data: bytes, intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word intervals as code points of the original text, ends exclusive."""
    blank = np.concatenate(([True], np.frombuffer(data.translate(ALNUM), np.uint8) == 32, [True]))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    point = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
    return [(int(point[edges[2 * a]]), int(point[edges[2 * b - 1]])) for a, b in intervals]


def union(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted([*a, *b]):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], e)
        else:
            out.append((s, e))
    return out


def row(doc_id, data: bytes, n: int, hit: list[tuple[int, int]], items: set) -> tuple:
    n_hit = sum(b - a for a, b in hit)
    named = ",".join(sorted(map(str, items)))
    spans = ",".join(f"{a}:{b}" for a, b in original(data, hit)) if hit else ""
    return doc_id, n, n_hit, len(items), hashlib.sha256(named.encode()).hexdigest(), n_hit > 0 and 20 * n_hit >= n, sorted(items), spans


def blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text"):
    """The benchmark's (id, text) rows in lists of at most BLOCK_BYTES of text; one is in the driver's memory at a time."""
    part, held = [], 0
    for item, text in benchmark.select(F.col(item_col).cast("long"), F.col(text_col).cast("binary")).where(F.col(text_col).isNotNull() & F.col(item_col).isNotNull()).toLocalIterator():
        if part and held + len(text) > BLOCK_BYTES:
            yield part
            part, held = [], 0
        part.append((item, bytes(text)))
        held += len(text)
    yield part


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs; spans are the hit passages as code points start:end, items the ids of the items found."""
    df = id_text(docs, id_col, text_col)
    parts = blocks(benchmark)
    first, second = next(parts), next(parts, None)
    if second is None:
        key, sent = _sent(docs.sparkSession, first, window)
        return map_rows(df, SCHEMA, lambda i, t, m: row(i, t, *scan(t, m)), (("windows", key), lambda: build(sent.value)))
    hits = small(_merged(df, itertools.chain([first, second], parts), window), HIT_ROWS)
    both = df.withColumn("_key", F.md5("text")).join(hits, "_key", "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "hit", "items")
    types = arrow_schema(df.sparkSession, SCHEMA)

    def run(batches):
        for b in batches:
            rows = []
            for d, t, h, i in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = (t or "").encode()
                rows.append(row(d, data, len(normalise(data)), union([(x["a"], x["b"]) for x in h or ()], []), set(i or ())))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), types, strict=True)], schema=types)

    return both.mapInArrow(run, SCHEMA)


def _sent(spark, items: list[tuple[int, bytes]], window: int) -> tuple:
    """Name and broadcast of a block's windows."""
    made = windows(items, window)
    return hashlib.sha256(repr(sorted(made.items())).encode()).hexdigest(), spark.sparkContext.broadcast(made)


def _merged(docs: DataFrame, parts, window: int) -> DataFrame:
    """(_key, n, hit, items) of the texts of docs with hits, by digest; a scan for each block, then its windows are released."""
    spark = docs.sparkSession
    names = "_key string, n long, hit array<struct<a: int, b: int>>, items array<long>"
    types = arrow_schema(spark, names)
    rows = docs.select(F.md5("text").alias("_key"), "text")
    found = None
    for part in parts:
        key, sent = _sent(spark, part, window)

        def run(batches, key=key, sent=sent):
            machine = hold(("windows", key), lambda: build(sent.value))
            for b in batches:
                hits = []
                for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    n, hit, items = scan((t or "").encode(), machine)
                    if hit:
                        hits.append({"_key": k, "n": n, "hit": [{"a": x, "b": y} for x, y in hit], "items": sorted(items)})
                yield pa.RecordBatch.from_pylist(hits, schema=types)

        hits = written(rows.mapInArrow(run, names), "hits")
        sent.destroy()
        found = hits if found is None else found.unionByName(hits)
    once = found.distinct().groupBy("_key").agg(F.max("n").alias("n"), F.flatten(F.collect_list("hit")).alias("hit"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return written(once, "hits")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """The rows of docs that are not contaminated, with their columns as they were; texts never leave their partition."""
    text = F.col(f"`{text_col}`").cast("string")
    parts = blocks(benchmark)
    first, second = next(parts), next(parts, None)
    if second is not None:
        hits = _merged(docs.select(text.alias("text")), itertools.chain([first, second], parts), window)

        @F.pandas_udf("boolean")
        def bad(n, hit):
            return type(n)([20 * sum(b - a for a, b in union([(x["a"], x["b"]) for x in h], [])) >= w for w, h in zip(n, hit, strict=True)])

        return docs.join(small(hits.where(bad("n", "hit")).select("_key"), HIT_ROWS), F.md5(text) == F.col("_key"), "left_anti")
    key, sent = _sent(docs.sparkSession, first, window)

    @F.pandas_udf("boolean")
    def clean(texts):
        machine = hold(("windows", key), lambda: build(sent.value))
        found = [scan((t or "").encode(), machine) for t in texts]
        n = [sum(b - a for a, b in hit) for _, hit, _ in found]
        return type(texts)([x == 0 or 20 * x < w for x, (w, _, _) in zip(n, found, strict=True)])

    return docs.where(clean(text))
