"""W1, W2, W3. Scans over the rows of an object in order, in two levels, so that no task sees an object as a whole.

Running sums and last values: rows are sorted by Spark in ranges and written with their places; a block is a run of places.
Each block is summed up by itself, the sums of an object's blocks (one row for each) give what enters each block, and a
block's rows start from that. What a block hands on is a sum or a last value, so the blocks need no order of work.

Greedy chunks: a chunk ends with the line that makes it longer than R bytes, so the chunk that starts at s ends before the
first line that starts after s + R: what one chunk hands to the next is the threshold s + R. A block of FACTOR x R bytes maps
the threshold that enters it to the one that leaves it and to the chunks that start in it. Only the lines in its first R
bytes and the one after them can be entered, so that this map is a short table. GROUP blocks in a row are composed to one
table of the same form, again and again until an object is one table; on the way down each group, then each block, gets the
threshold that enters it, and with that its chunks' starts.

Edge cases: a null object is one object; equal places in an order are settled when the rows are written; an empty table
gives an empty one; a line longer than a block leaves blocks without lines, which are passed over.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logspark.session import written

#: Rows of a block as a power of two; bytes of a block of greedy chunks in chunks; tables that are composed to one.
BLOCK_BITS, FACTOR, GROUP = 16, 64, 256


def joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left with the columns of right's row of the same keys, nulls being equal; right has one row at most for each."""
    other = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return left.join(other, on, "left").drop(*[f"_of_{k}" for k in keys])


def in_blocks(df: DataFrame, partition: list[str], order: list) -> DataFrame:
    """df, sorted in ranges and written, with _place, which ascends in each object, and _block, a run of places."""
    ranged = df.repartitionByRange(*partition, *order).sortWithinPartitions(*partition, *order)
    held = written(ranged.withColumn("_place", F.monotonically_increasing_id()), "scan")
    return held.withColumn("_block", F.shiftright("_place", BLOCK_BITS))


def running_sum(df: DataFrame, value: Column, partition: list[str], order: list, out: str) -> DataFrame:
    """df with the sum of value over the rows of the object before each row, 0 for the first."""
    held = in_blocks(df.withColumn("_value", value), partition, order)
    sums = held.groupBy(*partition, "_block").agg(F.sum("_value").alias("_sum"))
    earlier = F.sum("_sum").over(W.partitionBy(*partition).orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    inside = F.sum("_value").over(W.partitionBy(*partition, "_block").orderBy("_place").rowsBetween(W.unboundedPreceding, -1))
    rows = joined(held.withColumn("_inside", inside), sums.select(*partition, "_block", earlier.alias("_earlier")), [*partition, "_block"])
    total = F.coalesce("_inside", F.lit(0)) + F.coalesce("_earlier", F.lit(0))
    return rows.withColumn(out, total).drop("_value", "_place", "_block", "_inside", "_earlier")


def last_value(df: DataFrame, value: str, partition: list[str], order: list, out: str) -> DataFrame:
    """df with the last value that is not null up to each row of its object."""
    held = in_blocks(df, partition, order)
    lasts = held.where(F.col(value).isNotNull()).groupBy(*partition, "_block").agg(F.max_by(value, "_place").alias("_last"))
    blocks = joined(held.select(*partition, "_block").distinct(), lasts, [*partition, "_block"])
    earlier = F.last("_last", ignorenulls=True).over(W.partitionBy(*partition).orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    inside = F.last(value, ignorenulls=True).over(W.partitionBy(*partition, "_block").orderBy("_place").rowsBetween(W.unboundedPreceding, 0))
    rows = joined(held.withColumn("_inside", inside), blocks.select(*partition, "_block", earlier.alias("_earlier")), [*partition, "_block"])
    return rows.withColumn(out, F.coalesce("_inside", "_earlier")).drop("_place", "_block", "_inside", "_earlier")


# ---- greedy chunks ------------------------------------------------------------------------------------------------------
TABLE = "object string, block long, entries array<long>, outs array<long>, counts array<long>, rest_out long, rest_count long"


def _chain(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a chunk that starts at each line of a block: the line of the next one (their number if it is not in the block),
    the threshold that leaves the block, and the chunks that start in it from there on."""
    n = len(starts)
    following = np.searchsorted(starts, starts + size, side="right")
    outs, counts = starts + size, np.ones(n, np.int64)
    for i in range(int(np.searchsorted(following, n)) - 1, -1, -1):
        outs[i], counts[i] = outs[following[i]], counts[following[i]] + 1
    return following, outs, counts


def _tables(size: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        starts = np.sort(pdf["line_start"].to_numpy())
        _, outs, counts = _chain(starts, size)
        n = int(np.searchsorted(starts, key[1] * size * FACTOR + size, side="right")) + 1  # nothing enters behind these
        return pd.DataFrame([(key[0], key[1], starts[:n], outs[:n], counts[:n], None, 0)], columns=["object", "block", "entries", "outs", "counts", "rest_out", "rest_count"]).astype({"rest_out": "Int64"})

    return run


def _through(row, x: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Thresholds after a table, the chunks that start in it, and which thresholds no line of it has met; fresh says which came so."""
    at = np.searchsorted(row.entries, x, side="right")
    met = at < len(row.entries)
    safe = np.minimum(at, len(row.entries) - 1)
    rest = row.rest_out
    passed = x if pd.isna(rest) else np.full(len(x), int(rest))
    return np.where(met, np.asarray(row.outs)[safe], passed), np.where(met, np.asarray(row.counts)[safe], row.rest_count), fresh & ~met & bool(pd.isna(rest))


def _compose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """A group of tables in a row as one table: it is entered where its first one is."""
    rows = list(pdf.sort_values("block").itertuples(index=False))
    entries = np.asarray(rows[0].entries)
    x = np.append(entries - 1, entries[-1])  # the last one stands for what passes all lines that can be entered
    counts, fresh = np.zeros(len(x), np.int64), np.ones(len(x), bool)
    for row in rows:
        x, n, fresh = _through(row, x, fresh)
        counts += n
    rest = None if fresh[-1] else int(x[-1])
    return pd.DataFrame([(key[0], key[1], entries, x[:-1], counts[:-1], rest, int(counts[-1]))], columns=["object", "block", "entries", "outs", "counts", "rest_out", "rest_count"]).astype({"rest_out": "Int64"})


def _enter(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The threshold that enters each table of a group, and the chunks that started before it."""
    x, before, out = np.array([pdf["enter"].iloc[0]]), int(pdf["before"].iloc[0]), []
    for row in pdf.sort_values("block").itertuples(index=False):
        out.append((key[0], row.block, int(x[0]), before))
        x, n, _ = _through(row, x, np.ones(1, bool))
        before += int(n[0])
    return pd.DataFrame(out, columns=["object", "block", "enter", "before"])


def chunk_starts(lines: DataFrame, size: int, object_col: str = "object_id") -> DataFrame:
    """object, block, before (chunks that started in earlier blocks) and starts (those of the block), for each block with lines."""
    rows = lines.select(F.col(object_col).cast("string").alias("object"), "line_start", F.expr(f"line_start div {size * FACTOR}").alias("block"))
    level = written(rows.groupBy("object", "block").applyInPandas(_tables(size), TABLE), "jumps")
    levels, up = [level], F.expr(f"block div {GROUP}").alias("block")
    while not levels[-1].where("block > 0").isEmpty():
        grouped = levels[-1].withColumn("_group", up)
        levels.append(written(grouped.groupBy("object", "_group").applyInPandas(_compose, TABLE), "jumps"))
    entered = levels[-1].select("object", "block", F.lit(-1).cast("long").alias("enter"), F.lit(0).cast("long").alias("before"))
    for level in reversed(levels[:-1]):
        grouped = joined(level.withColumn("_group", up), entered.withColumnRenamed("block", "_group"), ["object", "_group"])
        entered = written(grouped.groupBy("object", "_group").applyInPandas(_enter, "object string, block long, enter long, before long"), "entered")

    def cut(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        starts = np.sort(pdf["line_start"].to_numpy())
        following, _, _ = _chain(starts, size)
        at, found = int(np.searchsorted(starts, pdf["enter"].iloc[0], side="right")), []
        while at < len(starts):
            found.append(int(starts[at]))
            at = int(following[at])
        return pd.DataFrame([(key[0], key[1], int(pdf["before"].iloc[0]), found)], columns=["object", "block", "before", "starts"])

    return joined(rows, entered, ["object", "block"]).groupBy("object", "block").applyInPandas(cut, "object string, block long, before long, starts array<long>")


def greedy_chunks(lines: DataFrame, size: int, object_col: str = "object_id") -> DataFrame:
    """W1. lines (line_start and others) with chunk_id: a chunk ends with the line that makes it longer than size bytes."""
    starts = written(chunk_starts(lines, size, object_col), "starts").withColumnRenamed("object", "_object").withColumnRenamed("block", "_block")
    held = lines.withColumns({"_object": F.col(object_col).cast("string"), "_block": F.expr(f"line_start div {size * FACTOR}")})
    chunk = F.col("before") - 1 + F.size(F.filter("starts", lambda s: s <= F.col("line_start")))
    return joined(held, starts, ["_object", "_block"]).withColumn("chunk_id", chunk.cast("long")).drop("_object", "_block", "before", "starts")
