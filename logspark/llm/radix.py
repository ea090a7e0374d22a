"""Distributed LSD radix sort: stable counting-sort passes over the digits of a composite key.

A pass counts the rows of each (digit, block) of consecutive places, turns the counts into the first place of each by two
prefix sums, over digits and over the blocks of a digit, and gives every row that place plus its rank in (digit, block).
Rows with smaller digits come first and equal ones keep their order, so after the most significant digit the places are
the order of the key. Each pass is written with its places, so that a lost executor costs one pass, and the table of the
pass before it is deleted.

Scale: a row is shuffled once a pass. A (digit, block) has at most one block's rows, whatever the ties. There are at most
BLOCKS blocks (and one for each input partition in the first pass), hence BLOCKS x 2**DIGIT counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logspark.llm.tables import delete_table, written

#: Bits of a digit; the most blocks of a pass; the least rows of a block.
DIGIT, BLOCKS, LEAST = 11, 1 << 14, 1 << 8


def digits_of(name: str, low: int, high: int, descending: bool, bits: int) -> list[Column]:
    """The digits of a long column with these bounds, least significant first; none if all values are one."""
    span = high - low
    col = F.col(name)
    if span < 1 << 63:
        value = F.lit(high) - col if descending else col - F.lit(low)
    else:  # the difference would not fit: the bits of the value itself, with the sign bit turned
        value = col.bitwiseXOR(F.lit((1 << 63) - 1 if descending else -(1 << 63)))
    return [F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << bits) - 1)).cast("int") for at in range(0, min(span.bit_length(), 64), bits)]


def radix_places(df: DataFrame, keys: list[tuple[str, bool]], bits: int = DIGIT) -> DataFrame:
    """df with place, each row's place from 0 in the order of keys: long columns without nulls, most significant first, true for descending.

    Rows that tie in all keys stand in an order that is settled when they are first written. An empty table stays empty.
    """
    at = written(df.withColumn("place", F.monotonically_increasing_id()), "radix")
    bounds = at.agg(F.count(F.lit(1)), *[f(k) for k, _ in keys for f in (F.min, F.max)]).head()
    if not bounds[0]:
        return at
    rows = LEAST
    while rows * BLOCKS < bounds[0]:
        rows *= 2  # a power of two, so that blocks never span input partitions in the first pass
    digits = [d for i, (k, down) in reversed(list(enumerate(keys))) for d in digits_of(k, bounds[1 + 2 * i], bounds[2 + 2 * i], down, bits)]
    for digit in digits or [F.lit(0)]:  # one pass at least, which makes the places dense
        placed = written(_sort_by(at, digit, rows), "radix")
        delete_table(at)
        at = placed
    return at


def _sort_by(at: DataFrame, digit: Column, rows: int) -> DataFrame:
    """One stable counting sort: the same rows with their places after it."""
    keyed = at.withColumns({"_digit": digit, "_block": F.shiftright("place", rows.bit_length() - 1)})
    counts = keyed.groupBy("_digit", "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    totals = keyed.groupBy("_digit").agg(F.count(F.lit(1)).alias("_n"))  # a row for each digit
    smaller = totals.select("_digit", earlier(W.orderBy("_digit")).alias("_smaller"))
    firsts = counts.withColumn("_before", earlier(W.partitionBy("_digit").orderBy("_block"))).join(F.broadcast(smaller), "_digit")
    firsts = firsts.select("_digit", "_block", (F.col("_before") + F.col("_smaller")).alias("_first"))
    rank = F.row_number().over(W.partitionBy("_digit", "_block").orderBy("place")) - 1
    return keyed.withColumn("_rank", rank).join(firsts, ["_digit", "_block"]).withColumn("place", F.col("_first") + F.col("_rank")).select(*at.columns)
