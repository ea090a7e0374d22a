"""From a search to its rows, and what is told about it: results by slice, byte counts, counters and the reason."""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logspark.functions.scalar import query_reason, slice_label, time_slice
from logspark.operators import prune
from logspark.operators.search import QueryOptions, clause_tokens, combine_filters, in_range
from logspark.session import written
from logspark.sources.files import read_chunks, scan_filters_between

EVENT_FIELDS = {"k": "enrichment['k']", "event_type": "enrichment['event_type']", "user_id": "enrichment['user_id']", "this": "text", "this.text": "text"}


def candidates(events: DataFrame, options: QueryOptions, postings: DataFrame | None = None, filters: DataFrame | None = None, template_hashes: list[str] | DataFrame | None = None, tokens: list[list[str]] | None = None) -> DataFrame | None:
    """Chunks that can hold matches; None if the index can't tell. Resolved tokens or hashes may be given (P21)."""
    if not options.search:
        return None
    tokens = clause_tokens(events.sparkSession, options.search) if tokens is None else tokens
    if postings is not None:
        return prune.prune_by_postings(postings, options.search, tokens, template_hashes)
    return prune.prune_by_bitmap(filters, options.search, tokens, template_hashes) if filters is not None else None


def search(events: DataFrame, options: QueryOptions, postings: DataFrame | None = None, filters: DataFrame | None = None, template_hashes: list[str] | DataFrame | None = None, tokens: list[list[str]] | None = None, fields: dict[str, str] | None = None) -> DataFrame:
    """Matching events. The index only leaves out chunks; every event left is tested, so the rows never depend on it."""
    chunks = candidates(events, options, postings, filters, template_hashes, tokens)
    rows = events.where(in_range(F.col("ts_ms"), options.t0, options.t1))
    if chunks is not None:
        rows = prune.keep_chunks(rows, chunks)
    return rows.where(combine_filters(options.filters, options.search, fields=fields or EVENT_FIELDS))


def search_stored(spark: SparkSession, root: str, target: str, options: QueryOptions, kind: str = "postings", resolution: int = 3_600_000, template_hashes: list[str] | DataFrame | None = None, fields: dict[str, str] | None = None) -> DataFrame:
    """P7, S4. A search over a stored index (index.write_filters, write_events): the index and the events are read for the
    days of the time range only, and of the events only the chunks that are left."""
    index = scan_filters_between(spark, root, target, options.t0, options.t1, resolution, kind)
    events = scan_filters_between(spark, root, target, options.t0, options.t1, resolution, "events")
    side = {"postings": index} if kind == "postings" else {"filters": index}
    return search(events, options, template_hashes=template_hashes, fields=fields, **side)


def counters_of(spark: SparkSession, root: str, target: str, options: QueryOptions, kind: str = "postings", resolution: int = 3_600_000, template_hashes: list[str] | None = None) -> DataFrame:
    """A7. Counters of a stored search: index keys, chunks scanned, matched and skipped (by the search, by the template gate),
    keys of matched chunks beyond their first, requests, objects, and bytes of the events of chunks matched and skipped."""
    index = scan_filters_between(spark, root, target, options.t0, options.t1, resolution, kind)
    side = {"postings": index} if kind == "postings" else {"filters": index}
    keys = index.select("object_id", "chunk_id", "bucket").distinct().groupBy("object_id", "chunk_id").agg(F.count(F.lit(1)).alias("n"))
    gates = {"_search": candidates(index, options, **side), "_template": None}
    if template_hashes:
        gates["_template"] = prune.prune_by_template(index, template_hashes) if kind == "postings" else prune.distinct_chunks(index.where(prune.might_contain_any(template_hashes)))
    for name, chunks in gates.items():
        keys = keys.withColumn(name, F.lit(True)) if chunks is None else keys.join(prune.by_size(written(chunks.withColumn(name, F.lit(True)), "gate")), ["object_id", "chunk_id"], "left")
    sizes = read_chunks(spark, root).select("object_id", "chunk_id", "n_bytes")
    held = keys.join(sizes, ["object_id", "chunk_id"], "left").withColumn("_hit", F.col("_search").isNotNull() & F.col("_template").isNotNull())
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return held.agg(
        total("n").alias("keys"), F.count(F.lit(1)).alias("scanned"), F.count_if("_hit").alias("matched"), F.count_if(F.col("_search").isNull()).alias("skipped_search"),
        F.count_if(F.col("_search").isNotNull() & F.col("_template").isNull()).alias("skipped_template"), total(F.when(F.col("_hit"), F.col("n") - 1)).alias("skipped_duplicate"),
        F.count_distinct(F.when(F.col("_hit"), F.col("object_id"))).alias("requests"), F.count_distinct("object_id").alias("objects"),
        total(F.when(F.col("_hit"), F.col("n_bytes"))).alias("bytes"), total(F.when(~F.col("_hit"), F.col("n_bytes"))).alias("bytes_skipped"),
    )


def result_bytes(matches: DataFrame) -> DataFrame:
    """K6. UTF-8 bytes of the matched events of each object."""
    return matches.groupBy("object_id").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n_events"))


def total_result_bytes(markers: DataFrame) -> DataFrame:
    """A9."""
    return markers.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def range_totals(ranges: DataFrame) -> DataFrame:
    """A8."""
    return ranges.groupBy("object_id").agg(F.count(F.lit(1)).alias("n_ranges"), F.sum("length").alias("n_bytes"))


def cap_per_group(df: DataFrame, keys: list[str], order: list, n: int = 2000) -> DataFrame:
    """W6. The first n rows of each group; Spark cuts groups before the shuffle as well."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def limit_bytes(df: DataFrame, order: list, max_bytes: int, size: str = "bytes", day: str | None = None) -> DataFrame:
    """W7. Rows as long as the bytes before them stay under the limit.

    The running sum has two levels, sums of each day and then inside it, so that no task sees all rows. day is a column
    that the order starts with; without one, ranges of the order, dealt by Spark and written, take its place.
    """
    if day is None:
        ranged = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
        return limit_bytes(ranged, order, max_bytes, size, "_range").drop("_range")
    days = df.groupBy(day).agg(F.sum(size).alias("_sum"))  # a row for each day
    earlier = F.coalesce(F.sum("_sum").over(W.orderBy(day).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    held = df.join(days.select(F.col(day), earlier.alias("_earlier")), day).where(F.col("_earlier") < max_bytes)
    inside = F.coalesce(F.sum(size).over(W.partitionBy(day).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return held.withColumn("_before", inside + F.col("_earlier")).where(F.col("_before") < max_bytes).drop("_before", "_earlier")


def limit_bytes_early(rows_of: Callable[[str], DataFrame], days: list[str], order: list, max_bytes: int, size: str = "bytes") -> tuple[DataFrame | None, list[str]]:
    """W7, A9. As limit_bytes, a day at a time: rows of the days in order until their bytes reach the limit, and the days
    that were read. What is after the limit is never read; rows_of gives the rows of one day, such as a search in it.
    """
    kept, total, read = [], 0, []
    for day in days:
        if total >= max_bytes:
            break
        rows = written(rows_of(day), "day")
        read.append(day)
        kept.append(limit_bytes(rows, order, max_bytes - total, size))
        total += rows.agg(F.coalesce(F.sum(size), F.lit(0))).head()[0]
    return (reduce(DataFrame.unionByName, kept) if kept else None), read


def result_counters(df: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """A18. Written, dropped, empty and control-character events of each group, and whether it was cut."""
    n = F.count(F.lit(1))
    return df.groupBy(*keys).agg(F.least(n, F.lit(cap)).alias("written"), F.greatest(n - cap, F.lit(0)).alias("dropped"), F.count_if(F.trim("text") == "").alias("empty"), F.count_if(F.col("text").rlike(r"[\x00-\x1F]")).alias("control"), (n > cap).alias("truncated"))


def scan_counters(gated: DataFrame) -> DataFrame:
    """A7. Of index rows with in_time, search_ok and template_ok: scanned, matched, skipped by each test, duplicates."""
    scanned = gated.where("in_time")
    matched = F.col("search_ok") & F.col("template_ok")
    chunk = F.struct("object_id", "chunk_id")
    return scanned.agg(F.count(F.lit(1)).alias("scanned"), F.count_distinct(F.when(matched, chunk)).alias("matched"), F.count_if(~F.col("search_ok")).alias("skipped_search"), F.count_if(F.col("search_ok") & ~F.col("template_ok")).alias("skipped_template"), (F.count_if(matched) - F.count_distinct(F.when(matched, chunk))).alias("skipped_duplicate"))


def query_summary(counters: DataFrame, query_id: str = "q") -> DataFrame:
    """K9. The completion record of a query."""
    return counters.select(F.lit(query_id).alias("query_id"), "scanned", "matched", "skipped_search", "skipped_template", "requests", query_reason("scanned", "matched", "tasks", "requests").alias("reason"))


def slices(spark: SparkSession, t0: int, t1: int, base: int, most: int) -> DataFrame:
    """C39. The half-open slices of a range, the last one ending with it."""
    step = time_slice(t0, t1, base, most) or t1 - t0
    return spark.range(t0, t1, step).select(F.col("id").alias("slice_from"), F.least(F.col("id") + step, F.lit(t1)).alias("slice_to")).withColumn("label", slice_label("slice_from", "slice_to"))


def write_results(matches: DataFrame, root: str, query_id: str, cap: int = 2000, kind: str = "results") -> DataFrame:
    """K7, K8, X9. Results as JSON lines by slice, at most cap for each slice and object; returns the counters."""
    found = written(matches, "matches")  # the search runs once, its rows are used twice
    kept = cap_per_group(found, ["slice", "object_id"], ["seq"], cap)
    kept.write.mode("overwrite").partitionBy("slice").json(f"{root}/{kind}/query_id={query_id}")
    return result_counters(found, ["slice", "object_id"], cap)


def write_summaries(df: DataFrame, root: str, query_id: str, cap: int = 2000) -> DataFrame:
    """K8."""
    return write_results(df, root, query_id, cap, "summaries")


def write_by_slice(df: DataFrame, root: str, query_id: str, labels: list[str], cap: int = 2000) -> None:
    """X9. One job for each slice, so that a slice can be read once it is there; the search itself runs once."""
    df = written(df, "found")
    for label in labels:
        kept = cap_per_group(df.where(F.col("slice") == label), ["object_id"], ["seq"], cap)
        kept.drop("slice").write.mode("overwrite").json(f"{root}/results/query_id={query_id}/slice={label}")


def read_results(spark: SparkSession, root: str, query_id: str, schema, kind: str = "results") -> DataFrame:
    """S8."""
    return spark.read.schema(schema).json(f"{root}/{kind}/query_id={query_id}")


def write_query_log(df: DataFrame, root: str) -> None:
    """K14. By query, in order of time."""
    df.repartitionByRange("query_id", "worker_id", "ts").sortWithinPartitions("query_id", "worker_id", "ts").write.mode("append").partitionBy("query_id").parquet(f"{root}/query_log")


def run_with_deadline(spark: SparkSession, fn: Callable[[], object], ms: int) -> tuple[object, bool]:
    """T7. fn's result and whether its jobs were stopped after ms."""
    tag = f"deadline-{threading.get_ident()}"
    late = threading.Event()

    def stop() -> None:
        late.set()
        spark.sparkContext.cancelJobsWithTag(tag)

    timer = threading.Timer(ms / 1000, stop)
    spark.sparkContext.addJobTag(tag)
    timer.start()
    try:
        return fn(), False
    except Exception:
        if not late.is_set():
            raise
        return None, True
    finally:
        timer.cancel()
        spark.sparkContext.removeJobTag(tag)
