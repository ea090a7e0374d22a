"""User extensions: SQL expressions, registered functions and parametrised statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def expr(sql_text: str) -> Column:
    """E1. A user's SQL expression over the row."""
    return F.expr(sql_text)


def truthy(value: Column) -> Column:
    """E1. Whether an evaluated value counts as true: true, or text that says so; null doesn't."""
    return F.coalesce(F.lower(value.cast("string")) == "true", F.lit(False))


def register(spark: SparkSession, name: str, body: str | Callable, returns: str = "string", arguments: str = "") -> None:
    """E1. A function for SQL: from a SQL body, which Spark inlines, or from a Python function, batch by batch."""
    if isinstance(body, str):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {body}")
    else:
        spark.udf.register(name, F.pandas_udf(body, returns))


def register_includes(spark: SparkSession) -> None:
    """P1. includes(a, v) as a SQL function, for use outside of searches."""
    register(spark, "includes", "coalesce(contains(a, v), false)", "boolean", "a STRING, v STRING")


def run_sql(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """E6. A statement with named parameters (:name) and frames ({name})."""
    return spark.sql(text, args=args or {}, **frames)
