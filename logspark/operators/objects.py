"""From raw log objects to an index of byte ranges, and from a search back to the ranges of the objects that can match.

An index of objects holds a row for each chunk with its place in its object (offset, length), the bounds of its times and,
by chunk and time bucket, its tokens or their Bloom filters. A search prunes chunks by the index, joins adjacent ones to
ranges, reads these ranges of the raw objects and tests every line it has read, so that the rows are those of a full scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logspark.functions.scalar import time_bucket
from logspark.operators import index, prune
from logspark.operators.results import EVENT_FIELDS, candidates
from logspark.operators.search import QueryOptions, combine_filters, in_range, overlaps
from logspark.session import written
from logspark.sources import files

#: Adds ts_ms, enrichment (a map) and tokens to lines (object_id, line_start, line_end, text).
Parse = Callable[[DataFrame], DataFrame]
#: Bytes of a chunk.
CHUNK_BYTES = 65536


def index_objects(spark: SparkSession, path: str, root: str, target: str, parse: Parse, byte_range: int = CHUNK_BYTES, resolution: int = 3_600_000, greedy: bool = False) -> None:
    """K1, K2. Writes the index of all objects under path: chunks, postings and filters."""
    lines = index.assign_chunks(files.read_lines(spark, path), byte_range, greedy)
    events = parse(lines).select(F.lit(target).alias("target"), "object_id", "chunk_id", "line_start", "line_end", "ts_ms", time_bucket("ts_ms", resolution).alias("bucket"), "tokens")
    index.write_chunks(index.chunk_table(events), root)
    index.write_filters(index.distinct_tokens(events), root, "postings")
    index.write_filters(index.build_bloom(index.read_index(spark, root, "postings")), root, "filters")


def find_chunks(spark: SparkSession, root: str, target: str, options: QueryOptions, kind: str = "postings", resolution: int = 3_600_000, template_hashes: list[str] | None = None) -> DataFrame:
    """P7, P9, J1. The chunks that can hold matches, with their places."""
    rows = files.scan_filters_between(spark, root, target, options.t0, options.t1, resolution, kind)
    chunks = files.read_chunks(spark, root)
    if options.t0 or options.t1:
        chunks = chunks.where(overlaps(F.col("min_ts"), F.col("max_ts"), options.t0, options.t1))
    hits = candidates(rows, options, template_hashes=template_hashes, **({"postings": rows} if kind == "postings" else {"filters": rows}))
    return chunks if hits is None else prune.hits_to_chunks(hits, chunks)


def search_objects(spark: SparkSession, root: str, target: str, options: QueryOptions, parse: Parse, kind: str = "postings", resolution: int = 3_600_000, template_hashes: list[str] | None = None, fields: dict[str, str] | None = None) -> DataFrame:
    """S2, J1, P7. Lines of the raw objects that match, read by the ranges of the chunks that can hold them."""
    ranges = written(prune.merge_ranges(find_chunks(spark, root, target, options, kind, resolution, template_hashes)), "ranges")
    lines = parse(files.read_object_ranges(ranges))
    return lines.where(in_range(F.col("ts_ms"), options.t0, options.t1) & combine_filters(options.filters, options.search, fields=fields or EVENT_FIELDS))


def read_counters(spark: SparkSession, root: str, target: str, options: QueryOptions, kind: str = "postings", resolution: int = 3_600_000) -> DataFrame:
    """A7, A8. What a search over objects asks for: objects, chunks, ranges and bytes, beside those that the index holds."""
    ranges = prune.merge_ranges(find_chunks(spark, root, target, options, kind, resolution))
    asked = ranges.agg(F.count_distinct("object_id").alias("objects"), F.coalesce(F.sum("n_chunks"), F.lit(0)).alias("chunks"), F.count(F.lit(1)).alias("ranges"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    held = files.read_chunks(spark, root).agg(F.count_distinct("object_id").alias("objects_held"), F.count(F.lit(1)).alias("chunks_held"), F.sum("length").alias("bytes_held"))
    return asked.join(F.broadcast(held))  # one row each
