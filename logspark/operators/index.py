"""Index build: line places, chunks, tokens, postings, bitmaps, templates and the tables they live in.

Postings (one row for each token of a chunk and time bucket) are exact; Bloom filters are their short form, each sized
by the tokens it holds. Tables are Parquet, partitioned by target and day and sorted by chunk.
"""

from __future__ import annotations

import math
import random
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from logspark.functions.scalar import DELIMITERS, object_hash, tokenize
from logspark.model import schema
from logspark.operators import scans
from logspark.session import delete_paths, written

#: The least false-positive rate of a filter in hundredths, the accuracy in hundredths that bounds the greatest one, and
#: the bytes of a filter's bitmap.
RATE, ACCURACY, FILTER_BYTES = 1, 90, 4096
#: Factors of the two halves of a token's hash in its i-th place; small enough that no product leaves a signed long.
_draw = random.Random(29)
FACTORS = [(_draw.getrandbits(29) | 1, _draw.getrandbits(29) | 1) for _ in range(7)]
#: Values of a part of a list.
PART_ROWS = 100_000
CHUNK = ["target", "bucket", "object_id", "chunk_id"]


def line_offsets(df: DataFrame, object_col: str, order, text: str) -> DataFrame:
    """S1, W3. line_start and line_end in bytes, each line with its line feed, within an object; see scans."""
    rows = scans.running_sum(df, F.octet_length(text) + 1, [object_col], list(order), "line_start")
    return rows.withColumn("line_end", F.col("line_start") + F.octet_length(text) + 1)


def document_lines(docs: DataFrame) -> DataFrame:
    """S1. Lines of a documents table as log lines, each document an object: place in the document, start and end in bytes.

    The offsets of a document's lines need its own text only, so a running sum inside the row gives them without a
    shuffle, by blocks of 256 lines so that long documents stay cheap.
    """
    cut = docs.select(F.col("doc_id").alias("object_id"), F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("_lines"))
    sized = cut.withColumn("_n", F.transform("_lines", lambda x: F.octet_length(x) + 1))
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    blocks = F.transform(F.sequence(F.lit(0), (F.size("_n") / 256).cast("int")), lambda b: total(F.slice("_n", b * 256 + 1, F.lit(256))))
    before = sized.withColumn("_blocks", blocks)
    before = before.withColumn("_before", F.transform("_blocks", lambda _, b: total(F.slice("_blocks", F.lit(1), b))))
    rows = before.select("object_id", "_n", "_before", F.posexplode("_lines").alias("line_no", "text"))
    block = (F.col("line_no") / 256).cast("int")
    start = F.get("_before", block) + total(F.slice("_n", block * 256 + 1, F.col("line_no") % 256))
    return rows.select("object_id", "line_no", "text", start.cast("long").alias("line_start")).withColumn("line_end", F.col("line_start") + F.octet_length("text") + 1)


def assign_chunks(lines: DataFrame, byte_range: int, greedy: bool = False, object_col: str = "object_id") -> DataFrame:
    """W1. chunk_id of each line: its offset by the chunk size or, greedy, a new chunk once one is longer than that.

    The default is a plain expression; greedy chunks are found by jump tables of blocks, see scans.
    """
    if byte_range <= 0:
        raise ValueError("byte_range must be positive")
    if greedy:
        return scans.greedy_chunks(lines, byte_range, object_col)
    return lines.withColumn("chunk_id", F.floor(F.col("line_start") / byte_range).cast("long"))


def fill_forward(df: DataFrame, col: str, partition, order, out: str | None = None) -> DataFrame:
    """W2. Missing values take the last one before them; see scans."""
    return scans.last_value(df, col, list(partition), list(order), out or col)


def event_tokens(values: Column, whole: Column | None = None, delims: str = DELIMITERS) -> Column:
    """A1. Tokens of an event: its enrichment values cut at delimiters; whole values (variables, template hash) uncut."""
    cut = F.flatten(F.transform(values, lambda v: tokenize(F.coalesce(v, F.lit("")), delims)))
    return F.array_distinct(F.concat(cut, F.filter(whole, lambda v: F.coalesce(F.trim(v) != "", F.lit(False)))) if whole is not None else cut)


def distinct_tokens(events: DataFrame) -> DataFrame:
    """U3. Postings: the distinct tokens of each chunk and bucket."""
    return events.select(*CHUNK, F.explode("tokens").alias("token")).distinct()


def token_sets(events: DataFrame) -> DataFrame:
    """A1. The sorted token set of each chunk and bucket."""
    return distinct_tokens(events).groupBy(*CHUNK).agg(F.sort_array(F.collect_set("token")).alias("tokens"))


def filter_size(n: int, rate: float) -> tuple[int, int]:
    """A2. Bits, in whole bytes, and hash functions of a filter of n tokens at a false-positive rate."""
    if not 0 < rate < 1:
        raise ValueError("the rate must be between 0 and 1")
    bits = max(1, -int(n * math.log(rate) / math.log(2) ** 2 // 8)) * 8
    return bits, max(1, round(-math.log2(rate)))


def tokens_for(rate: float, limit: int = FILTER_BYTES) -> int:
    """A3. The most tokens of a filter of this many bytes at a false-positive rate."""
    if not 0 < rate < 1:
        raise ValueError("the rate must be between 0 and 1")
    return max(1, int(limit * 8 * math.log(2) ** 2 / -math.log(rate)))


def build_bloom(postings: DataFrame, limit: int = FILTER_BYTES, accuracy: int = ACCURACY, least: int = RATE) -> DataFrame:
    """A2, A3. Bloom filters of the distinct postings of each chunk and bucket, sized by their tokens.

    A filter takes the first rate of least, least + 1, ... (100 - accuracy) per cent at which it is no longer than limit
    bytes. Where none is, its tokens are bisected by the first bits of their hashes, again and again, and each part is a
    filter of its own: part and parts tell which tokens are in it. A row has n, bits, hashes, bitmap and the rate that its
    tokens give, fpr.

    Spark gathers the 64-bit hashes of a chunk's tokens, which a chunk's bytes bound; places are set in Arrow batches.
    """
    if not 0 < least <= 100 - accuracy < 100:
        raise ValueError("rates go from least to 100 - accuracy per cent")
    rates = [r / 100 for r in range(least, 100 - accuracy + 1)]
    most = [tokens_for(r, limit) for r in rates]
    gathered = postings.groupBy(*CHUNK).agg(F.collect_set(F.xxhash64("token")).alias("tokens"))
    out = StructType([f for f in schema("filters") if f.name in CHUNK] + [f for f in schema("filters") if f.name not in CHUNK])

    def run(batches):
        for b in batches:
            rows, made = [], []
            lists = b.column("tokens")
            flat, offsets = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
            offsets = offsets - offsets[0]
            for row in range(b.num_rows):
                for part in _filters(flat[offsets[row] : offsets[row + 1]], 0, 0, rates, most):
                    rows.append(row)
                    made.append(part)
            keys = b.select(CHUNK).take(pa.array(rows, pa.int64()))
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.float64())
            columns = list(zip(*made, strict=True)) if made else [()] * len(types)
            yield pa.RecordBatch.from_arrays([*keys.columns, *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=out.names)

    return gathered.select(*CHUNK, "tokens").mapInArrow(run, out)


def _filters(tokens: np.ndarray, part: int, depth: int, rates: list[float], most: list[int]) -> list[tuple]:
    """part, parts, n, bits, hashes, bitmap and fpr of the filters of these hashes."""
    n = len(tokens)
    if n > most[-1]:  # more than the last rate allows
        high = (tokens >> np.uint64(63 - depth)) & np.uint64(1) == 1
        return _filters(tokens[~high], part * 2, depth + 1, rates, most) + _filters(tokens[high], part * 2 + 1, depth + 1, rates, most)
    rate = next((r for r, m in zip(rates, most, strict=True) if n <= m), rates[-1])
    bits, hashes = filter_size(n, rate)
    low, high, held = tokens & np.uint64(0xFFFFFFFF), tokens >> np.uint64(32), np.zeros(bits, bool)
    for a, b in FACTORS[:hashes]:
        held[(low * np.uint64(a) + high * np.uint64(b) >> np.uint64(20)) % np.uint64(bits)] = True
    return [(part, 1 << depth, n, bits, hashes, np.packbits(held, bitorder="little").tobytes(), (1 - math.exp(-hashes * n / bits)) ** hashes)]


def chunk_bounds(events: DataFrame) -> DataFrame:
    """A4. Least and greatest time and the number of events of each chunk."""
    return events.groupBy("object_id", "chunk_id").agg(F.min("ts_ms").alias("min_ts"), F.max("ts_ms").alias("max_ts"), F.count(F.lit(1)).alias("n_events"), F.sum("n_bytes").alias("n_bytes"))


def chunk_table(lines: DataFrame) -> DataFrame:
    """K2, A4. A row for each chunk of lines: its place in its object, the bounds of its times, and what it holds."""
    start = F.min("line_start")
    return lines.groupBy("object_id", "chunk_id").agg(start.alias("offset"), (F.max("line_end") - start).alias("length"), F.min("ts_ms").alias("min_ts"), F.max("ts_ms").alias("max_ts"), F.count(F.lit(1)).alias("n_events"), F.sum(F.col("line_end") - F.col("line_start")).alias("n_bytes"))


def object_summary(chunks: DataFrame) -> DataFrame:
    """A5. Bounds over an object's chunks, without least times of 0."""
    return chunks.groupBy("object_id").agg(F.min(F.when(F.col("min_ts") > 0, F.col("min_ts"))).alias("min_ts"), F.max("max_ts").alias("max_ts"), F.count(F.lit(1)).alias("n_chunks"), F.sum("n_events").alias("n_events"), F.sum("n_bytes").alias("n_bytes"))


def index_stats(filters: DataFrame, n: str = "n", step: int = 50) -> DataFrame:
    """A6. Histogram of element counts in steps."""
    return filters.groupBy((F.floor(F.col(n) / step) * step).cast("long").alias("n_floor")).agg(F.count(F.lit(1)).alias("filters"))


def index_totals(filters: DataFrame) -> DataFrame:
    """A6. Of bitmaps: filters, chunks, buckets (epochs), elements, bytes, mean size of a group of parts, least and greatest false-positive rate in millionths."""
    rate = F.round(F.col("fpr") * 1_000_000).cast("long")
    chunk = F.struct("target", "object_id", "chunk_id")
    sums = filters.agg(
        F.count(F.lit(1)).alias("filters"), F.count_distinct(chunk).alias("chunks"), F.count_distinct("bucket").alias("buckets"), F.sum("n").alias("elements"), F.sum(F.octet_length("bitmap")).alias("bytes"),
        F.count_distinct(F.struct(*CHUNK)).alias("groups"), F.min(rate).alias("min_rate"), F.max(rate).alias("max_rate"),
    )
    return sums


def key_sizes(filters: DataFrame, step: int = 50) -> DataFrame:
    """A6. Histogram of the lengths of index keys in steps."""
    key = F.concat_ws("/", "target", F.col("bucket").cast("string"), object_hash("object_id"), F.col("chunk_id").cast("string"), F.col("part").cast("string"))
    return filters.groupBy((F.floor(F.length(key) / step) * step).cast("long").alias("size_floor")).agg(F.count(F.lit(1)).alias("filters"))


def observe_build(df: DataFrame, name="index") -> DataFrame:
    """A20. Counts rows, bytes and tokens of a build of events while it runs; name may be an Observation."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.sum("n_bytes").alias("bytes"), F.sum(F.size("tokens")).alias("tokens"))


def with_debug_values(token_sets_df: DataFrame, limit: int = 200) -> DataFrame:
    """K16. The sorted tokens as text, cut."""
    return token_sets_df.withColumn("debug", F.left(F.array_join(F.sort_array("tokens"), ","), F.lit(limit)))


def reverse_index(df: DataFrame) -> DataFrame:
    """K3. A row for each index key of each object."""
    key = F.concat_ws("/", "target", F.col("bucket").cast("string"), object_hash("object_id"), F.col("chunk_id").cast("string"))
    return df.select("object_id", key.alias("key")).distinct()


def list_parts(rows: DataFrame, key: str, value: str, out: str, size: int = PART_ROWS) -> DataFrame:
    """Sorted lists of the values of each key, in parts of about size values by their hash: key, part, parts, out."""
    parts = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts")).withColumnRenamed(key, "_key")
    placed = rows.join(parts, F.col(key).eqNullSafe(F.col("_key"))).withColumn("part", F.pmod(F.xxhash64(value), F.col("parts")).cast("int"))
    return placed.groupBy(key, "part", "parts").agg(F.sort_array(F.collect_list(value)).alias(out))


def _append(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("append").partitionBy(*by).parquet(path)


def write_filters(df: DataFrame, root: str, kind: str = "filters") -> None:
    """K1. Bitmaps or postings by target and day, sorted so that chunks and buckets are found by row groups."""
    day = df.withColumn("bucket_day", F.date_format(F.timestamp_millis("bucket"), "yyyy-MM-dd"))
    order = ["target", "bucket_day", "bucket", "object_id", "chunk_id"]
    rows = day.repartitionByRange(*order).sortWithinPartitions(*order)  # by range, so that a busy day is spread out
    _append(rows, f"{root}/{kind}", "target", "bucket_day")


def read_index(spark: SparkSession, root: str, kind: str = "filters") -> DataFrame:
    """S3. An index table with target and day as text: Spark would take a target of digits for a number.

    Tables of the data model have its schema, so that no footer is read to find it.
    """
    found = schema(kind) if kind in ("events", "filters", "postings") else spark.read.parquet(f"{root}/{kind}").schema
    named = [T.StructField(f.name, f.dataType) for f in found if f.name not in ("target", "bucket_day")]
    named += [T.StructField(name, T.StringType()) for name in ("target", "bucket_day")]
    return spark.read.schema(T.StructType(named)).parquet(f"{root}/{kind}")


def write_events(events: DataFrame, root: str) -> None:
    """K2. Events in the layout of the index: by target and day, sorted by chunk, so that a search reads few row groups."""
    write_filters(events, root, "events")


def write_reverse(df: DataFrame, root: str) -> None:
    """K3. A row for each index key of each object, by range of objects."""
    reverse_index(df).repartitionByRange("object_id", "key").sortWithinPartitions("object_id", "key").write.mode("append").parquet(f"{root}/reverse")


def write_chunks(df: DataFrame, root: str) -> None:
    """K2. Chunks by range of objects, so that those of an object are found by row groups."""
    df.repartitionByRange("object_id", "chunk_id").sortWithinPartitions("object_id", "chunk_id").write.mode("append").parquet(f"{root}/chunks")


def append_templates(df: DataFrame, root: str) -> None:
    """K4. One raw set of templates, each hash once."""
    df.dropDuplicates(["template_hash"]).write.mode("append").parquet(f"{root}/templates/raw")


def merge_templates(raw: DataFrame, merged: DataFrame | None = None) -> DataFrame:
    """U2, A15. Each template hash once, the first seen."""
    rows = raw if merged is None else raw.unionByName(merged, allowMissingColumns=True)
    return rows.groupBy("template_hash").agg(F.min_by("template", F.struct("first_seen", "template")).alias("template"), F.min("first_seen").alias("first_seen"))


def compact_templates(spark: SparkSession, root: str, version: int, last_ms: int = 0, now_ms: int = 0, min_interval_ms: int = 0) -> bool:
    """K5, X7. Merges raw and the latest merged templates into a new version, if one is due; tells whether it did.

    The raw files and versions that went into it are deleted once it is complete, so that a crash leaves duplicates at
    most, which the next merge removes. Raw files that arrive meanwhile stay.
    """
    if now_ms - last_ms < min_interval_ms:
        return False
    rows = read_templates(spark, root)
    inputs = list(rows.inputFiles())  # names of the few files of a template store
    merge_templates(rows).write.mode("error").parquet(f"{root}/templates/merged/version={version}")
    delete_paths(spark, inputs)
    return True


def read_templates(spark: SparkSession, root: str) -> DataFrame:
    """S5. Raw templates and the newest merged version."""
    from pyspark.errors import AnalysisException

    columns, found = ["template_hash", "template", "first_seen"], []
    for kind in ("raw", "merged"):
        try:
            rows = spark.read.parquet(f"{root}/templates/{kind}")
        except AnalysisException:  # none yet, or all merged
            continue
        found.append((latest_merged(rows, "version") if kind == "merged" else rows).select(*columns))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "template_hash string, template string, first_seen long")


def latest_merged(files: DataFrame, version: str) -> DataFrame:
    """W4. Rows of the newest version."""
    return files.join(F.broadcast(files.agg(F.max(version).alias("_newest"))), F.col(version) == F.col("_newest"), "left_semi")  # one row


def delete_object(spark: SparkSession, root: str, kind: str, object_id: str) -> int:
    """K15. Takes an object's entries out of one index table and returns their number.

    Only the folders that hold the object are rewritten, as the file names of its rows tell them: their other rows are
    staged, then overwrite these folders, and what held nothing else is deleted. Rows are never missing in between, and
    a deletion that was stopped can be run again.
    """
    rows = read_index(spark, root, kind).withColumn("_folder", F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""))
    own = rows.where(F.col("object_id") == object_id).groupBy("_folder").agg(F.count(F.lit(1)).alias("n"))
    touched = {r["_folder"]: r.n for r in own.collect()}  # a row for each day of one object
    if not touched:
        return 0
    kept = without_object(rows.where(F.col("_folder").isin(*touched)), object_id)
    staged = written(kept, f"kept-{kind}")
    full = {r["_folder"] for r in staged.select("_folder").distinct().collect()}
    staged.drop("_folder").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("target", "bucket_day").parquet(f"{root}/{kind}")
    delete_paths(spark, sorted(set(touched) - full))
    return sum(touched.values())


def without_object(df: DataFrame, object_id) -> DataFrame:
    """J6, U5. Rows of all other objects."""
    return df.where(~F.col("object_id").eqNullSafe(F.lit(object_id)))


def mask_template(text: Column) -> Column:
    """A template of a line: runs of digits, hexadecimal numbers and quoted strings as one sign. The rule is this library's own."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, '"[^"]*"', '"*"'), r"\b[0-9a-f]*[0-9][0-9a-f]*\b", "#"), r"[0-9]+", "#")


def template_events(events: DataFrame, text: str) -> DataFrame:
    """Adds template and template_hash to events."""
    return events.withColumn("template", mask_template(F.col(text))).withColumn("template_hash", object_hash("template"))


def first_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """A15. The value of the first row of each key, by map-side combined aggregation."""
    return df.groupBy(key).agg(F.min_by(value, order).alias(value))


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int) -> None:
    """S6, J1. An index table bucketed and sorted by object and chunk, so that a large object is spread out: tables with one
    number of buckets are joined on these as they lie, without a shuffle. An index that grows takes more buckets, all alike."""
    df.write.mode("overwrite").option("path", path).bucketBy(buckets, "object_id", "chunk_id").sortBy("object_id", "chunk_id").saveAsTable(table)


def content_digest(df: DataFrame, keys: list[str], line: str) -> DataFrame:
    """A16. MD5 of a group's lines in order; a digest for each group, whose lines it has to hold together."""
    return df.groupBy(*keys).agg(F.md5(F.array_join(F.sort_array(F.collect_list(line)), "\n").cast("binary")).alias("digest"))


def digest_tree(df: DataFrame, keys: list[str], line: str, depth: int = 3) -> DataFrame:
    """A16. The digests of a group's lines as a tree: keys, level, prefix, digest; that of level 0 stands for all lines.

    A leaf holds the lines whose MD5 begins with `depth` hexadecimal digits, each once with its count, in order of their
    MD5; a node above holds its up to sixteen children. The order of lines does not matter, no task holds a group, and a
    changed line changes the nodes of one path only, by which changed_prefixes finds it and update_tree puts it right.
    """
    if not 0 < depth <= 16:
        raise ValueError("depth goes from 1 to 16")
    counted = df.groupBy(*keys, F.md5(F.col(line).cast("binary")).alias("_md5")).agg(F.count(F.lit(1)).alias("_n"))
    each = F.concat_ws(":", "_md5", F.col("_n").cast("string"))
    leaves = counted.groupBy(*keys, F.left("_md5", F.lit(depth)).alias("prefix")).agg(_digest_of(each).alias("digest"))
    return _levels_above(leaves, keys, depth)


def _digest_of(item: Column) -> Column:
    return F.md5(F.array_join(F.sort_array(F.collect_list(item)), ",").cast("binary"))


def _levels_above(leaves: DataFrame, keys: list[str], depth: int) -> DataFrame:
    at = written(leaves.select(*keys, F.lit(depth).alias("level"), "prefix", "digest"), "digests")
    levels = [at]
    for level in range(depth - 1, -1, -1):
        child = F.concat_ws(":", F.right("prefix", F.lit(1)), "digest")
        at = written(at.groupBy(*keys, F.left("prefix", F.lit(level)).alias("prefix")).agg(_digest_of(child).alias("digest")).select(*keys, F.lit(level).alias("level"), "prefix", "digest"), "digests")
        levels.append(at)
    return reduce(DataFrame.unionByName, levels)


def changed_prefixes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys and prefix of the leaves in which two trees differ; below equal nodes nothing is compared."""
    depth = max(t.agg(F.max("level")).head()[0] or 0 for t in (old, new))
    found = None
    for level in range(depth + 1):
        sides = [t.where(F.col("level") == level).select(*keys, "prefix", F.col("digest").alias(name)) for t, name in ((old, "_old"), (new, "_new"))]
        if found is not None:
            sides = [s.join(found, (F.left(s["prefix"], F.lit(level - 1)) == found["_above"]) & reduce(lambda a, b: a & b, [s[k].eqNullSafe(found[f"_{k}"]) for k in keys]), "left_semi") for s in sides]
        on = reduce(lambda a, b: a & b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*keys, "prefix"]])
        both = sides[0].alias("a").join(sides[1].alias("b"), on, "full_outer").where("NOT (_old <=> _new)")
        found = written(both.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(f"_{k}") for k in keys], F.coalesce("a.prefix", "b.prefix").alias("_above")), "changed")
    return found.select(*[F.col(f"_{k}").alias(k) for k in keys], F.col("_above").alias("prefix"))


def update_tree(tree: DataFrame, lines: DataFrame, keys: list[str], line: str, prefixes: DataFrame, depth: int = 3) -> DataFrame:
    """A tree after its lines have changed: only the leaves of prefixes (keys, prefix) are hashed again, from all their lines."""
    on = lambda left, prefix: reduce(lambda a, b: a & b, [left[k].eqNullSafe(prefixes[k]) for k in keys]) & (prefix == prefixes["prefix"])
    own = lines.join(prefixes, on(lines, F.left(F.md5(lines[line].cast("binary")), F.lit(depth))), "left_semi")
    leaves = tree.where(F.col("level") == depth)
    kept = leaves.join(prefixes, on(leaves, leaves["prefix"]), "left_anti").select(*keys, "prefix", "digest")
    fresh = digest_tree(own, keys, line, depth).where(F.col("level") == depth).select(*keys, "prefix", "digest")
    return _levels_above(kept.unionByName(fresh), keys, depth)
