"""Tagged counters and their export as samples; the hook for metric sinks."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logspark.functions.scalar import metric_name


class MetricSink(Protocol):
    """E2. Takes the samples of a batch, e.g. from foreachBatch."""

    def write(self, samples: DataFrame, batch_id: int) -> None: ...

    def close(self) -> None: ...


class TableSink:
    """E2. Samples as Parquet, a folder for each batch, so that a batch that is run again replaces its own rows."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def write(self, samples: DataFrame, batch_id: int) -> None:
        samples.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def close(self) -> None:
        pass


#: E2. Kind of a sink -> what makes it from options; users add their own.
SINKS: dict[str, Callable[[dict[str, str]], MetricSink]] = {"table": TableSink}


def create_sink(options: dict[str, str]) -> MetricSink:
    """E2. The sink that options name by kind."""
    if options.get("kind") not in SINKS:
        raise ValueError(f"unknown kind of sink {options.get('kind')!r}")
    return SINKS[options["kind"]](options)


def counters(summaries: DataFrame, tags: list[str], value: str) -> DataFrame:
    """A13. Sum of a value by tags."""
    return summaries.groupBy(*tags).agg(F.sum(value).alias("value"))


def to_samples(df: DataFrame, name: str, labels: list[str], value: str, ts: str, kind: str = "counter") -> DataFrame:
    """K11. Series name, labels in order of name as text, time and value."""
    text = F.concat_ws(",", *[F.concat(F.lit(f"{x}="), F.coalesce(F.col(x).cast("string"), F.lit(""))) for x in sorted(labels)])
    return df.select(metric_name(F.lit(name), F.lit(kind)).alias("name"), F.lit(kind).alias("kind"), text.alias("labels"), F.col(ts).alias("ts"), F.col(value).cast("double").alias("value"))


def zero_start(samples: DataFrame, offset_ms: int = 60_000) -> DataFrame:
    """W8. A zero before the first sample of each counter whose first value is positive."""
    first = samples.where("kind = 'counter'").groupBy("name", "kind", "labels").agg(F.min("ts").alias("ts"), F.min_by("value", "ts").alias("value"))
    return samples.unionByName(first.where("value > 0").withColumn("ts", F.col("ts") - offset_ms).withColumn("value", F.lit(0.0)))


def new_series(samples: DataFrame, known: DataFrame) -> DataFrame:
    """J9. Samples of series that are not known yet."""
    return samples.join(known, ["name", "labels"], "left_anti")
