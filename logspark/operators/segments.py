"""X2, K1. Index tables that grow by batches: segments, merged level by level, and a manifest that names the live ones.

A segment is a folder of Parquet files, sorted and partitioned like any index table. A writer first writes its segment,
then the next version of the manifest, which only one writer can create; another one that was first makes it start again
from that version. A reader takes one version and reads what it names, so it sees the table before or after a commit and
never a part of one. Merging takes `width` segments of a level, drops rows that stand in several of them and writes one
segment of the next level, so a row is rewritten once for each level and the number of live segments grows with the
logarithm of the batches. Segments that were merged stay until vacuum, for readers of older versions.

A batch that is run again is known by its number and adds nothing. A writer that dies leaves a folder that no version
names. A manifest is one small file: its size follows from the number of live segments, not from the table.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logspark.model import schema
from logspark.session import delete_paths

#: Segments of a level that are merged, rows of a file.
WIDTH, FILE_ROWS = 4, 5_000_000
#: Seconds that a version may take to be written.
PATIENCE = 5.0
ORDER = ["target", "bucket_day", "bucket", "object_id", "chunk_id"]


def _fs(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def versions(spark: SparkSession, root: str, kind: str) -> list[int]:
    """Numbers of the manifest's versions, oldest first."""
    fs, path = _fs(spark, f"{root}/{kind}/_manifest")
    return sorted(int(s.getPath().getName().split(".")[0]) for s in fs.listStatus(path)) if fs.exists(path) else []


def live(spark: SparkSession, root: str, kind: str, version: int | None = None) -> tuple[int, list[dict]]:
    """A version, the newest one by default, and its segments; 0 and none before the first commit.

    A version whose file is not complete belongs to a writer that is at work or has died, and is passed over.
    """
    for v in [version] if version is not None else reversed(versions(spark, root, kind)):
        fs, path = _fs(spark, f"{root}/{kind}/_manifest/{v:012d}.json")
        stream = fs.open(path)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if text.endswith("\n"):
            return v, json.loads(text)
    return 0, []


def commit(spark: SparkSession, root: str, kind: str, change: Callable[[list[dict]], list[dict] | None]) -> bool:
    """Writes the version after the newest one, change of its segments; False if change gives None, which means nothing to do.

    The number follows from what was read, so a commit in between takes it and this one starts again. A newest version
    that is not complete is waited for; its writer counts as dead after PATIENCE seconds.
    """
    waited = 0.0
    while True:
        last = max(versions(spark, root, kind), default=0)
        found, segments = live(spark, root, kind)
        if found < last and waited < PATIENCE:
            waited += 0.2
            time.sleep(0.2)
            continue
        if found > last:
            continue
        changed = change(segments)
        if changed is None:
            return False
        number = last + 1
        fs, path = _fs(spark, f"{root}/{kind}/_manifest/{number:012d}.json")
        try:
            out = fs.create(path, False)  # fails if there is one
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                continue
            raise
        out.write(bytearray((json.dumps(changed) + "\n").encode()))
        out.close()
        return True


def _write(df: DataFrame, root: str, kind: str, name: str) -> None:
    rows = df if "bucket_day" in df.columns else df.withColumn("bucket_day", F.date_format(F.timestamp_millis("bucket"), "yyyy-MM-dd"))
    rows = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    rows.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("target", "bucket_day").parquet(f"{root}/{kind}/segment={name}")


def append(df: DataFrame, root: str, kind: str, batch: int) -> bool:
    """Adds a batch as a segment of the lowest level; False if the batch is in the table already."""
    spark = df.sparkSession
    has = lambda segments: any(batch in s["batches"] for s in segments)
    if has(live(spark, root, kind)[1]):
        return False
    name = uuid.uuid4().hex
    _write(df, root, kind, name)
    return commit(spark, root, kind, lambda now: None if has(now) else [*now, {"name": name, "level": 0, "batches": [batch]}])


def read(spark: SparkSession, root: str, kind: str, version: int | None = None) -> DataFrame:
    """The rows of a version, with target and day as text. Rows that several segments hold come several times."""
    return _rows_of(spark, root, kind, live(spark, root, kind, version)[1])


def _rows_of(spark: SparkSession, root: str, kind: str, segments: list[dict]) -> DataFrame:
    fields = [T.StructField(f.name, f.dataType) for f in schema(kind) if f.name != "target"] + [T.StructField(c, T.StringType()) for c in ("segment", "target", "bucket_day")]
    if not segments:
        return spark.createDataFrame([], T.StructType(fields)).drop("segment")
    paths = [f"{root}/{kind}/segment={s['name']}" for s in segments]
    return spark.read.schema(T.StructType(fields)).option("basePath", f"{root}/{kind}").parquet(*paths).drop("segment")


def compact(spark: SparkSession, root: str, kind: str, width: int = WIDTH, full: bool = False) -> int:
    """Merges the segments of each level that has `width` of them, or with full all of them into one; returns the number of merges."""
    merges = 0
    while True:
        _, segments = live(spark, root, kind)
        levels = sorted({s["level"] for s in segments})
        due = next((d for level in levels if len(d := [s for s in segments if s["level"] == level]) >= width), None)
        if full:
            due = segments if len(segments) > 1 else None
        if not due:
            return merges
        taken, name = {s["name"] for s in due}, uuid.uuid4().hex
        _write(_rows_of(spark, root, kind, due).distinct(), root, kind, name)
        merged = {"name": name, "level": max(s["level"] for s in due) + 1, "batches": sorted(b for s in due for b in s["batches"])}
        # Another writer may have merged some of them; its version stands then, and the folder written here is named by none.
        merges += commit(spark, root, kind, lambda now: [*(s for s in now if s["name"] not in taken), merged] if taken <= {s["name"] for s in now} else None)


def vacuum(spark: SparkSession, root: str, kind: str, keep: int = 1) -> int:
    """Deletes all but the last `keep` versions and the segments that only they name; returns the number of segments."""
    numbers = versions(spark, root, kind)
    kept = {s["name"] for v in numbers[-keep:] for s in live(spark, root, kind, v)[1]}
    old = {s["name"] for v in numbers[:-keep] for s in live(spark, root, kind, v)[1]} - kept
    delete_paths(spark, [f"{root}/{kind}/segment={n}" for n in sorted(old)])
    delete_paths(spark, [f"{root}/{kind}/_manifest/{v:012d}.json" for v in numbers[:-keep]])
    return len(old)
