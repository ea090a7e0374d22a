"""Schemas of the data model, as Spark DDL."""

from __future__ import annotations

from pyspark.sql.types import StructType

DDL = {
    "log_lines": "object_id STRING, line_start BIGINT, line_end BIGINT, text STRING",
    "events": "target STRING, object_id STRING, seq BIGINT, chunk_id BIGINT, ts_ms BIGINT, bucket BIGINT, text STRING, n_bytes INT, enrichment MAP<STRING,STRING>, tokens ARRAY<STRING>",
    "query_terms": "idx INT, field STRING, value STRING, kind STRING",
    "chunks": "object_id STRING, chunk_id BIGINT, offset BIGINT, length BIGINT, min_ts BIGINT, max_ts BIGINT, n_events BIGINT, n_bytes BIGINT",
    "filters": "target STRING, bucket BIGINT, object_id STRING, chunk_id BIGINT, part INT, parts INT, n INT, bits INT, hashes INT, bitmap BINARY, fpr DOUBLE",
    "postings": "target STRING, bucket BIGINT, object_id STRING, chunk_id BIGINT, token STRING",
    "templates": "template_hash STRING, template STRING, first_seen BIGINT",
    "ranges": "object_id STRING, offset BIGINT, length BIGINT",
    "summaries": "message_pattern STRING, user_service STRING, severity_level STRING, http_code STRING, summaryVolume BIGINT, summaryBytes BIGINT",
    "encoded_events": "seq BIGINT, template_hash STRING, template STRING, encoded STRING",
    "query_summary": "query_id STRING, scanned BIGINT, matched BIGINT, skipped_search BIGINT, skipped_template BIGINT, requests BIGINT, reason STRING",
    "query_log": "query_id STRING, worker_id STRING, ts TIMESTAMP, level STRING, message STRING, data MAP<STRING,STRING>",
    "records": "tag STRING, body STRING, time_ns BIGINT, observed_ns BIGINT, attributes MAP<STRING,STRING>, resource MAP<STRING,STRING>",
    "samples": "name STRING, kind STRING, labels STRING, ts BIGINT, value DOUBLE",
    "symbol_units": "unit_id BIGINT, unit STRING",
}


def schema(name: str) -> StructType:
    """The schema of a table of the data model."""
    return StructType.fromDDL(DDL[name])
