"""Continuous index build, counters, first-seen series, templates and OTLP output.

A stream run to its end with availableNow gives what the batch operators give on the same rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming import StreamingQueryListener

from logspark.functions.scalar import time_bucket
from logspark.operators import segments
from logspark.operators.index import compact_templates, distinct_tokens
from logspark.operators.metrics import MetricSink
from logspark.operators.records import to_otlp


def bucket_stream(df: DataFrame, resolution: str, watermark: str, ts: str = "ts") -> DataFrame:
    """X1. Tumbling windows; watermarks need TIMESTAMP, so a time without zone is read as UTC by the session."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return timed.groupBy(F.window(ts, resolution)).agg(F.count(F.lit(1)).alias("n"))


def stream_index(events: DataFrame, root: str, checkpoint: str, width: int = segments.WIDTH):
    """X2, S13. Adds the postings of each micro-batch as a segment and merges segments level by level; a batch that is run
    again adds nothing. Read them with segments.read."""

    def build(batch: DataFrame, batch_id: int) -> None:
        segments.append(distinct_tokens(batch), root, "postings", batch_id)
        segments.compact(batch.sparkSession, root, "postings", width)

    return events.writeStream.foreachBatch(build).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_buckets(df: DataFrame, resolution_ms: int, late_ms: int, root: str, checkpoint: str, ts: str = "ts_ms"):
    """X1, X3. Counts of each time bucket by micro-batch, as parts that add up, in a table for rows in time and one for late rows.

    A row is late if the newest time of all batches before its own is more than late_ms ahead of it. No row is dropped,
    however late. The newest time so far is one row that each batch writes beside its counts, and the next one reads, so
    that a batch's work does not grow with those before it. Read the counts with read_buckets.
    """
    spark = df.sparkSession

    def build(batch: DataFrame, batch_id: int) -> None:
        before = _newest(spark, root, batch_id)
        late = F.col(ts) < F.lit(before - late_ms) if before is not None else F.lit(False)
        counted = batch.groupBy(time_bucket(ts, resolution_ms).alias("bucket"), late.alias("late")).agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("newest"))
        counted.write.mode("overwrite").partitionBy("late").parquet(f"{root}/buckets/batch={batch_id}")
        own = spark.read.schema("newest long").parquet(f"{root}/buckets/batch={batch_id}").agg(F.max("newest").alias("newest"))
        own.select(F.greatest("newest", F.lit(before).cast("long")).alias("newest")).write.mode("overwrite").parquet(f"{root}/newest/batch={batch_id}")

    return df.writeStream.foreachBatch(build).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _newest(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """The newest time of the batches before this one, as the last of them has written it."""
    return spark.read.schema("newest long").parquet(f"{root}/newest/batch={batch_id - 1}").head()[0] if batch_id else None  # one row


def read_buckets(spark: SparkSession, root: str) -> DataFrame:
    """X1, X3. bucket, n (all rows) and n_late."""
    rows = spark.read.schema("bucket long, n long, newest long, late boolean, batch long").parquet(f"{root}/buckets")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("late"), F.col("n")).otherwise(0)).alias("n_late"))


def split_late(df: DataFrame, watermark_ms: int, newest: str = "newest_ms", ts: str = "ts_ms") -> tuple[DataFrame, DataFrame]:
    """X3. Rows in time, and late ones for a table of their own; none is dropped."""
    late = F.col(ts) < F.col(newest) - watermark_ms
    return df.where(~late), df.where(late)


def first_seen_stream(samples: DataFrame, ts: str = "ts", watermark: str = "1 day") -> DataFrame:
    """X4. The first sample of each series; keys idle for longer than the watermark are forgotten."""
    return samples.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(["name", "labels"])


def first_seen_ttl(samples: DataFrame, ttl_ms: int, ts: str = "ts", watermark: str = "1 hour") -> DataFrame:
    """X4. Samples (name, labels, time ts in ms) of series that are new: not seen yet, or not for longer than ttl_ms.

    The state of a series is its last time. Any sample renews it; a timer in event time drops a series that is idle for
    longer than ttl_ms once the watermark has passed, so state holds the series of the last ttl_ms only. A sample that is
    older than the series' last time is never new, and one that is behind the watermark is dropped. Returns name, labels and ts; first_seen_ttl_batch is its batch form.
    """
    timed = samples.select("name", "labels", F.col(ts).alias("ts"), F.timestamp_millis(ts).alias("_time")).withWatermark("_time", watermark)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        times = sorted({int(t) for b in batches for t in b["ts"]})
        last, new = (state.get[0] if state.exists else None), []
        for t in times:
            if last is None or t - last > ttl_ms:
                new.append(t)
            last = t if last is None else max(last, t)
        state.update((last,))
        state.setTimeoutTimestamp(max(last + ttl_ms + 1, state.getCurrentWatermarkMs() + 1))
        if new:
            yield pd.DataFrame({"name": key[0], "labels": key[1], "ts": new})

    return timed.groupBy("name", "labels").applyInPandasWithState(step, "name string, labels string, ts long", "last long", "append", GroupStateTimeout.EventTimeTimeout)


def first_seen_ttl_batch(samples: DataFrame, ttl_ms: int, ts: str = "ts") -> DataFrame:
    """X4. The batch form of first_seen_ttl: samples whose series has no other one in the ttl_ms before."""
    rows = samples.select("name", "labels", F.col(ts).alias("ts")).distinct()
    before = F.lag("ts").over(W.partitionBy("name", "labels").orderBy("ts"))
    return rows.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("ts") - F.col("_before") > ttl_ms)).drop("_before")


def first_seen(samples: DataFrame) -> DataFrame:
    """X4. The first row of each series ever: keys are never forgotten, state grows with the number of series only."""
    return samples.dropDuplicates(["name", "labels"])


def stream_counters(df: DataFrame, tags: list[str], value: str) -> DataFrame:
    """X5. Cumulative sums by tags, for output mode update or complete."""
    return df.groupBy(*tags).agg(F.sum(value).alias("value"))


def start_counters(df: DataFrame, tags: list[str], value: str, sink: MetricSink, checkpoint: str, step: str | None = "1 minute"):
    """X5, E2. Emits changed counters to a sink each step; without a step for what there is, then the sink is closed."""
    trigger = {"processingTime": step} if step else {"availableNow": True}
    return stream_counters(df, tags, value).writeStream.outputMode("update").foreachBatch(sink.write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def close_counters(query, sink: MetricSink) -> None:
    """X5. Stops a query of start_counters once it has taken in what its source holds, so that nothing is left unsent, and closes the sink."""
    if query.isActive:
        query.processAllAvailable()
        query.stop()
    query.awaitTermination()
    sink.close()


def stream_templates(df: DataFrame) -> DataFrame:
    """X6."""
    return df.select("template_hash", "template").dropDuplicates(["template_hash"])


def maybe_compact(spark: SparkSession, root: str, version: int, last_ms: int, now_ms: int, interval_ms: int) -> bool:
    """X7. Called for each batch: merges the templates if the interval is over."""
    return compact_templates(spark, root, version, last_ms, now_ms, interval_ms)


def stream_otlp(df: DataFrame, send: Callable[[DataFrame], None], checkpoint: str, batch: int = 100, every: str | None = None):
    """X8. Export requests of each micro-batch, at most batch records each, to send; every (such as 200 milliseconds) makes it run on."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return df.writeStream.foreachBatch(lambda rows, _: send(to_otlp(rows, batch))).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def observe_source(df: DataFrame, text: str, name: str = "source") -> DataFrame:
    """X10. Has a stream's source counted by StreamCounters: rows and UTF-8 bytes of a column, batch by batch."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes"))


class StreamCounters(StreamingQueryListener):
    """X10. Rows read and written, bytes of observed sources, batches and milliseconds of all queries since the start, and since
    the last call of delta. every calls tell with the delta, at most once in so many seconds, as batches end."""

    NAMES = ("rows", "batches", "written", "ms", "bytes")

    def __init__(self, tell: Callable[[dict[str, int]], None] | None = None, every: float = 30.0, source: str = "source") -> None:
        self.rows = self.batches = self.written = self.ms = self.bytes = 0
        self._last = dict.fromkeys(self.NAMES, 0)
        self._tell, self._every, self._source, self._told = tell, every, source, time.monotonic()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows += p.numInputRows
        self.batches += 1
        self.written += max(0, p.sink.numOutputRows)
        self.ms += p.batchDuration
        seen = (p.observedMetrics or {}).get(self._source)
        self.bytes += seen["bytes"] if seen else 0
        if self._tell and time.monotonic() - self._told >= self._every:
            self._told = time.monotonic()
            self._tell(self.delta())

    def delta(self) -> dict[str, int]:
        now = {n: getattr(self, n) for n in self.NAMES}
        out = {n: now[n] - self._last[n] for n in self.NAMES}
        self._last = now
        return out

