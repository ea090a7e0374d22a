"""Symbol trees, their inverted index and positions."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logspark.session import written


def read_symbol_units(spark: SparkSession, path: str) -> DataFrame:
    """E5. JSON units, one a line, with the file as unit id."""
    return spark.read.text(path).select(F.xxhash64(F.input_file_name(), "value").alias("unit_id"), F.col("value").alias("unit"))


def walk_symbols(df: DataFrame, col: str = "unit", max_depth: int | None = None) -> DataFrame:
    """C34. value, context, depth and path of each node, level by level.

    Each level is written, until one is empty; with max_depth, for trees known to be no deeper, nothing is written.
    """
    node = "array<string>"
    level = df.select("unit_id", F.explode(F.from_json(F.get_json_object(col, "$.nodes"), node)).alias("node"), F.lit("").alias("above"))
    out = None
    for depth in itertools.count() if max_depth is None else range(max_depth):
        if max_depth is None:
            level = written(level, "symbols")
            if out is not None and level.isEmpty():
                break
        value = F.get_json_object("node", "$.value")
        rows = level.select("unit_id", "node", value.alias("value"), F.get_json_object("node", "$.context").alias("context"), F.concat(F.col("above"), F.lit("/"), value).alias("path"))
        found = rows.select("unit_id", "value", "context", F.lit(depth).alias("depth"), "path")
        out = found if out is None else out.unionByName(found)
        level = rows.select("unit_id", F.explode(F.from_json(F.get_json_object("node", "$.children"), node)).alias("node"), F.col("path").alias("above"))
    return out


def build_symbol_index(nodes: DataFrame) -> DataFrame:
    """A17. Postings: a row for each unit of each symbol. index.list_parts makes sorted lists of bounded size of them."""
    return nodes.select(F.col("value").alias("symbol"), "unit_id").distinct()


def symbol_positions(postings: DataFrame, units: DataFrame) -> DataFrame:
    """J8. Start and length of each unit of each symbol."""
    return postings.select("symbol", "unit_id").join(units, "unit_id")
