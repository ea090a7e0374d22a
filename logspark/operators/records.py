"""Log records: OTLP and forward shapes flattened to rows and put together again, layouts and rolled output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logspark.functions.scalar import _quoted, any_value_to_json, date_pattern, observed_time, pick_tag, split_markers
from logspark.operators.prune import by_size
from logspark.session import written

VALUE = "struct<stringValue:string,boolValue:string,intValue:string,doubleValue:string,bytesValue:string,arrayValue:string,kvlistValue:string>"
ATTRIBUTES = f"array<struct<key:string,value:{VALUE}>>"
OTLP = f"resourceLogs array<struct<resource:struct<attributes:{ATTRIBUTES}>,scopeLogs:array<struct<logRecords:array<struct<timeUnixNano:string,observedTimeUnixNano:string,body:{VALUE},attributes:{ATTRIBUTES}>>>>>>"
#: Records of an export request at most.
BATCH = 1024


def _plain(v):
    """C17. Text of a parsed value: a string as it is, else its JSON."""
    nested = lambda k: F.when(v[k].isNotNull(), any_value_to_json(F.concat(F.lit(f'{{"{k}":'), v[k], F.lit("}"))))
    quoted = F.when(v["bytesValue"].isNotNull(), _quoted(v["bytesValue"]))
    return F.coalesce(v["stringValue"], v["boolValue"], v["intValue"], v["doubleValue"], quoted, nested("arrayValue"), nested("kvlistValue"))


def _attributes(col):
    """Key-value list as a map of plain values; of equal keys the last one holds."""
    a = F.coalesce(col, F.expr(f"cast(array() as {ATTRIBUTES})"))
    keys = F.transform(a, lambda x: x["key"])
    last = F.filter(a, lambda x, i: ~F.array_contains(F.slice(keys, i + 2, F.size(a)), x["key"]))
    once = F.when(F.size(F.array_distinct(keys)) == F.size(keys), a).otherwise(last)
    return F.map_from_entries(F.transform(once, lambda x: F.struct(x["key"], _plain(x["value"]))))


def flatten_otlp(df: DataFrame, col: str = "request") -> DataFrame:
    """S9. A row for each log record of JSON export requests: tag, body, time_ns, observed_ns, attributes, resource."""
    # Lists and maps are read as their JSON text, and scalars of any type as text.
    r = df.select(F.explode(F.from_json(col, OTLP)["resourceLogs"]).alias("r"))
    s = r.select(_attributes(F.col("r.resource.attributes")).alias("resource"), F.explode("r.scopeLogs").alias("s"))
    x = s.select("resource", F.explode("s.logRecords").alias("x"))
    return x.select(
        pick_tag("resource").alias("tag"), _plain(F.col("x.body")).alias("body"), F.col("x.timeUnixNano").try_cast("long").alias("time_ns"), F.col("x.observedTimeUnixNano").try_cast("long").alias("observed_ns"),
        _attributes(F.col("x.attributes")).alias("attributes"), "resource",
    )


def _parts(rows: DataFrame, batch: int) -> DataFrame:
    """part of each row (key, record), so that no key and part has more than batch of them, also of equal ones.

    Equal rows are counted, combined before the shuffle, and numbered again as copies. A key's rows are dealt over as
    many slots as it has eight batches, and numbered inside a slot: no task orders all rows of a large key.
    """
    once = written(rows.groupBy("key", "record").agg(F.count(F.lit(1)).alias("_n")), "records")
    sizes = once.groupBy("key").agg(F.ceil(F.sum("_n") / (8 * batch)).alias("_slots"))
    copies = once.select("key", "record", F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_copy"))
    dealt = copies.join(by_size(sizes), "key").withColumn("_slot", F.pmod(F.xxhash64("record", "_copy"), F.col("_slots")))
    number = F.row_number().over(W.partitionBy("key", "_slot").orderBy("record", "_copy"))
    return dealt.withColumn("part", F.floor((number - 1) / batch)).drop("_slots", "_copy")


def _by_resource(records: DataFrame, rec) -> DataFrame:
    key = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("resource"))))
    return records.select(key.alias("key"), rec.alias("record"))


def group_by_resource(records: DataFrame, batch: int = BATCH) -> DataFrame:
    """A14. The records of each resource in sorted lists of at most batch records, as JSON."""
    rows = _by_resource(records, F.to_json(F.struct("time_ns", "observed_ns", "body", "attributes")))
    return _parts(rows, batch).groupBy("key", "_slot", "part").agg(F.sort_array(F.collect_list("record")).alias("records")).select(F.col("key").alias("resource"), "records")


def to_otlp(records: DataFrame, batch: int = BATCH) -> DataFrame:
    """K10. Export requests as JSON, each with at most batch records of one resource; markers are stripped, observed time is filled."""
    now = F.unix_micros(F.current_timestamp()) * 1000
    attributes = lambda m: F.transform(F.array_sort(F.map_entries(m)), lambda e: F.struct(e["key"].alias("key"), F.struct(e["value"].alias("stringValue")).alias("value")))
    rec = F.struct(F.col("time_ns").cast("string").alias("timeUnixNano"), observed_time("observed_ns", "time_ns", now).cast("string").alias("observedTimeUnixNano"), F.struct(F.col("body").alias("stringValue")).alias("body"), attributes(split_markers("attributes")).alias("attributes"))
    grouped = _parts(_by_resource(records, rec), batch).groupBy("key", "_slot", "part").agg(F.collect_list("record").alias("recs"))
    resource = attributes(F.from_json("key", "map<string,string>"))
    log = F.struct(F.struct(resource.alias("attributes")).alias("resource"), F.array(F.struct(F.col("recs").alias("logRecords"))).alias("scopeLogs"))
    return grouped.select(F.to_json(F.struct(F.array(log).alias("resourceLogs"))).alias("request"), F.size("recs").alias("n_records"))


FORWARD = "tag string, time long, record string, entries array<struct<time:long,record:string>>"


def flatten_forward(df: DataFrame, col: str = "message") -> DataFrame:
    """S10. tag, time and record of forward messages in JSON: one record, or a list of entries; a record that is no map is dropped."""
    m = df.select(F.from_json(col, FORWARD).alias("m"))
    each = F.when(F.col("m.entries").isNotNull(), F.col("m.entries")).otherwise(F.array(F.struct(F.col("m.time").alias("time"), F.col("m.record").alias("record"))))
    rows = m.select(F.col("m.tag").alias("tag"), F.explode(each).alias("e")).select("tag", "e.time", "e.record")
    return rows.where(F.col("record").startswith("{"))


def with_tag_first(df: DataFrame, tag: str = "tag") -> DataFrame:
    """C32."""
    return df.select(tag, *[c for c in df.columns if c != tag])


def project(df: DataFrame, names: str) -> DataFrame:
    """C31. Columns by a comma list."""
    return df.select(*[n.strip() for n in names.split(",") if n.strip()])


def layout(df: DataFrame, fields: list[str], kind: str = "json", delimiter: str = " ") -> DataFrame:
    """K12. Chosen fields as a JSON object or as delimited text."""
    if kind == "json":
        return df.select(F.to_json(F.struct(*fields)).alias("line"))
    return df.select(F.concat_ws(delimiter, *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]).alias("line"))


def write_rolled(df: DataFrame, path: str, unit: str, ts: str = "ts") -> None:
    """K13. Parquet by time unit."""
    with_rolled(df, unit, ts).write.mode("append").partitionBy("rolled").parquet(path)


def with_rolled(df: DataFrame, unit: str, ts: str = "ts") -> DataFrame:
    return df.withColumn("rolled", F.date_format(ts, date_pattern(unit)))


def union_all(*dfs: DataFrame) -> DataFrame:
    """U1."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def composite(templates: DataFrame, events: DataFrame) -> DataFrame:
    """S12. Templates, then events, as one frame with their kind."""
    return union_all(templates.withColumn("kind", F.lit("template")), events.withColumn("kind", F.lit("event")))
