"""File sources: log objects with byte offsets, byte ranges of them, syslog lines, index tables and stores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from logspark.functions.scalar import syslog_msg, time_bucket
from logspark.operators import scans
from logspark.operators.index import read_index
from logspark.operators.prune import by_size
from logspark.session import written


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """S1. Lines of text files with their byte offsets: object_id (the file), line_start, line_end, text.

    A file may be split between tasks. A line starts after all bytes before it: those of its own split, which a task sums
    up in order over Arrow batches, and those of the file's splits before it, a few numbers that are summed first. Lines
    end with a line feed; a carriage return stays in the text, so that offsets are exact whatever the bytes. Texts are
    read twice and never shuffled.
    """
    place = F.struct("_metadata.file_path", "_metadata.file_block_start")
    rows = spark.read.option("lineSep", "\n").text(path).select(place["file_path"].alias("object_id"), place["file_block_start"].alias("_split"), F.col("value").alias("text"))
    sizes = rows.groupBy("object_id", "_split").agg(F.sum(F.octet_length("text") + 1).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("object_id").orderBy("_split").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = written(sizes.select("object_id", "_split", before.alias("_before")), "splits")
    lines = rows.mapInArrow(_offsets, "object_id string, _split long, _at long, text string").join(by_size(sizes), ["object_id", "_split"])
    start = F.col("_before") + F.col("_at")
    return lines.select("object_id", start.alias("line_start"), (start + F.octet_length("text") + 1).alias("line_end"), "text")


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of lines in their split, which come in order, one split after the other."""
    held, total = None, 0
    for b in batches:
        at = 0
        files, splits = b.column(0), b.column(1)
        sizes = pc.add(pc.binary_length(b.column(2)), 1).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = pc.dictionary_encode(files).indices.to_numpy(zero_copy_only=False)
        ends = [*(np.flatnonzero((np.diff(codes) != 0) | (np.diff(splits.to_numpy()) != 0)) + 1).tolist(), b.num_rows]
        places = np.zeros(b.num_rows, np.int64)
        for end in ends if b.num_rows else ():
            key = files[at].as_py(), splits[at].as_py()
            if key != held:
                held, total = key, 0
            sums = np.cumsum(sizes[at:end])
            places[at:end] = total + sums - sizes[at:end]
            total += int(sums[-1])
            at = end
        yield pa.RecordBatch.from_arrays([files, splits, pa.array(places), b.column(2)], names=["object_id", "_split", "_at", "text"])


@dataclass
class _Range(InputPartition):
    path: str
    offset: int
    length: int


class RangeSource(DataSource):
    """S2, E4. Lines that start in byte ranges of an object; one partition for each range.

    Options: path and ranges, as offset:length,offset:length. A line belongs to the range it starts in. A path with a
    scheme is opened by Arrow's file system for it (object stores, HDFS), any other one is local; only the range is read.
    """

    @classmethod
    def name(cls) -> str:
        return "byte_ranges"

    def schema(self) -> str:
        return "object_id string, line_start long, text string"

    def reader(self, schema):
        return _RangeReader(self.options)


class _RangeReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.ranges = options["path"], options["ranges"]

    def partitions(self):
        found = sorted({tuple(map(int, r.split(":"))) for r in self.ranges.split(",") if r})
        return [_Range(self.path, o, n) for o, n in found if n > 0]

    def read(self, partition):
        yield from _range_lines(partition.path, partition.offset, partition.length)


#: Bytes that one request of a range asks for.
PIECE = 8 << 20


def _range_lines(uri: str, offset: int, length: int) -> Iterator[pa.RecordBatch]:
    """Lines that start in a byte range of an object, in batches; nothing outside but the rest of the last line is read."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    system, path = FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (LocalFileSystem(), uri)
    with system.open_input_file(path) as f:
        size = f.size()
        end = min(offset + length, size)
        at = start = max(0, offset - 1)  # the byte before tells whether a line starts at the offset
        rest, step = b"", 1 << 16
        while at < end or rest:
            if at < end:
                piece = f.read_at(min(PIECE, end - at), at)
            else:  # the last line goes on behind the range
                piece, step = f.read_at(min(step, size - at), at), step * 2
            at += len(piece)
            data = rest + piece
            cut = len(data) if at >= size else data.find(b"\n", len(rest)) + 1 if at > end else data.rfind(b"\n") + 1
            if cut:
                yield _lines_at(uri, data[:cut], start, offset, end)
                start += cut
            rest = b"" if at > end and cut else data[cut:]
            if at >= size:
                return


def _lines_at(uri: str, data: bytes, start: int, least: int, end: int) -> pa.RecordBatch:
    """The lines of data, which starts at a line and at this byte of its object, that start in [least, end)."""
    lines = pc.split_pattern(pa.array([data], pa.large_binary()), b"\n").flatten()
    if data.endswith(b"\n"):
        lines = lines[:-1]
    sizes = pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    places = start + np.cumsum(sizes) - sizes
    held = pa.array((places >= least) & (places < end))
    if not held.true_count:
        return pa.RecordBatch.from_arrays([pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.string())], names=["object_id", "line_start", "text"])
    lines, places = lines.filter(held).cast(pa.binary()), pa.array(places).filter(held)
    text = pa.StringArray.from_buffers(len(lines), lines.buffers()[1], lines.buffers()[2], offset=lines.offset)  # whatever the bytes
    return pa.RecordBatch.from_arrays([pa.repeat(uri, len(lines)), places, text], names=["object_id", "line_start", "text"])


def read_object_ranges(ranges: DataFrame, split_bytes: int = 64 << 20) -> DataFrame:
    """S2, J1. Lines that start in byte ranges of many objects: object_id, line_start, line_end, text.

    ranges (object_id, offset, length) is a DataFrame, so that their number is not bounded by the driver; they are dealt
    over tasks in order of object and offset, by about split_bytes for each task. A line belongs to the range it starts in.
    """
    total = ranges.agg(F.sum("length")).head()[0] or 0
    least = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranges.where("length > 0").select("object_id", "offset", "length").repartitionByRange(max(least, -(-total // split_bytes)), "object_id", "offset").sortWithinPartitions("object_id", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield from _range_lines(path, offset, length)

    lines = dealt.mapInArrow(run, "object_id string, line_start long, text string")
    return lines.select("object_id", "line_start", (F.col("line_start") + F.octet_length("text") + 1).alias("line_end"), "text")


def read_ranges(spark: SparkSession, path: str, ranges: list[tuple[int, int]]) -> DataFrame:
    """S2. Lines in byte ranges of one object; for event tables filter on chunk_id instead."""
    spark.dataSource.register(RangeSource)
    return spark.read.format("byte_ranges").option("path", path).option("ranges", ",".join(f"{o}:{n}" for o, n in ranges)).load()


def read_syslog(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """S11. Messages of RFC 5424 lines."""
    lines = (spark.readStream.format("text") if stream else spark.read.format("text")).load(path)
    return lines.select(F.col("value").alias("line"), syslog_msg("value").alias("msg"))


def scan_filters(spark: SparkSession, root: str, target: str, after: int | None = None, kind: str = "filters") -> DataFrame:
    """S3, T6. Index rows of a target, in buckets after a given one; target is a partition, so others are not read."""
    rows = read_index(spark, root, kind).where(F.col("target") == target)
    return keys_after(rows, after) if after is not None else rows


def keys_after(filters: DataFrame, bucket: int) -> DataFrame:
    """T6. Buckets are numbers, so their order is that of time."""
    return filters.where(F.col("bucket") > bucket)


#: The order of an index table's keys.
KEY = ("bucket", "object_id", "chunk_id")


def key_pages(spark: SparkSession, root: str, target: str, n: int, after: tuple | None = None, kind: str = "postings") -> Iterator[tuple[list, tuple | None, int]]:
    """S3, T6. Distinct keys of a target in their order, n at a time: the page, the key to go on after (None at the end), and
    the number of files that were opened for it.

    The days of a table are read in order, from that of the key on and no further than the page needs; of a day only the
    row groups whose bounds can hold keys after it. A page is taken with one top-n for each day.
    """
    fs, path = _listing(spark, f"{root}/{kind}/target={target}")
    days = sorted(s.getPath().getName().partition("=")[2] for s in fs.listStatus(path))
    rows = scan_filters(spark, root, target, kind=kind)
    while True:
        page, files = [], 0
        first = None if after is None else datetime.fromtimestamp(after[0] / 1000, UTC).strftime("%Y-%m-%d")
        for day in days:
            if len(page) == n or (first is not None and day < first):
                continue
            own = rows.where(F.col("bucket_day") == day)
            if after is not None and day == first:
                own = own.where((F.col("bucket") >= after[0]) & (F.struct(*KEY) > F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(KEY, after, strict=True)])))
            files += len(fs.listStatus(path.suffix(f"/bucket_day={day}")))
            page += [tuple(r) for r in own.select(*KEY).distinct().orderBy(*KEY).limit(n - len(page)).collect()]
        after = page[-1] if len(page) == n else None
        yield page, after, files
        if after is None:
            return


def all_key_pages(spark: SparkSession, root: str, target: str, n: int, kind: str = "postings") -> DataFrame:
    """S3, T6. The pages of key_pages from the first to the last one, as a table of the keys and their page: a key's place in
    their order, by a running count in blocks, tells its page, so the work does not grow with the number of pages."""
    keys = scan_filters(spark, root, target, kind=kind).select(*KEY).distinct()
    return scans.running_sum(keys, F.lit(1), [], list(KEY), "_at").select(*KEY, F.floor(F.col("_at") / n).alias("page"))


def _listing(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def between(filters: DataFrame, t0: int, t1: int, resolution: int) -> DataFrame:
    """S4. Buckets that can hold times in [t0, t1)."""
    return filters.where((F.col("bucket") >= time_bucket(F.lit(t0).cast("long"), resolution)) & (F.col("bucket") < t1))


def scan_filters_between(spark: SparkSession, root: str, target: str, t0: int, t1: int, resolution: int, kind: str = "filters") -> DataFrame:
    """S4. As between, with the days of the window as a partition filter."""
    rows = scan_filters(spark, root, target, kind=kind)
    if not t0 and not t1:  # no bounds
        return rows
    day = lambda ms: F.date_format(F.timestamp_millis(F.lit(ms)), "yyyy-MM-dd")
    return between(rows.where((F.col("bucket_day") >= day(t0 - t0 % resolution)) & (F.col("bucket_day") <= day(t1))), t0, t1, resolution)


def read_chunks(spark: SparkSession, root: str) -> DataFrame:
    """S6."""
    return spark.read.parquet(f"{root}/chunks")


def read_object_entries(spark: SparkSession, root: str, object_id: str, kind: str = "filters") -> DataFrame:
    """S7."""
    return read_index(spark, root, kind).where(F.col("object_id") == object_id)


def stream_objects(spark: SparkSession, path: str, schema, most: int | None = None) -> DataFrame:
    """S13. New Parquet objects as they arrive, at most so many in a micro-batch."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", most) if most else reader).parquet(path)


@dataclass(frozen=True)
class Store:
    """E3. Any place that Spark reads, by its URI and format."""

    uri: str
    format: str = "parquet"

    def read(self, spark: SparkSession, name: str = "") -> DataFrame:
        return spark.read.format(self.format).load(f"{self.uri}/{name}".rstrip("/"))

    def write(self, df: DataFrame, name: str = "", mode: str = "append") -> None:
        df.write.format(self.format).mode(mode).save(f"{self.uri}/{name}".rstrip("/"))
