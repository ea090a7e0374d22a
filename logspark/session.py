"""Session set-up: settings the engine relies on, and the package's way to the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def build_session(app: str = "logspark", cores: int | None = None, **conf: str) -> SparkSession:
    """A local session with UTC, AQE and as many shuffle partitions as cores; on a cluster spark-submit sets master and sizes."""
    n = cores or os.cpu_count() or 4
    base = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": str(n), "spark.ui.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    builder = SparkSession.builder.appName(app).master(f"local[{n}]")
    return builder.config(map=base | conf).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in Python workers, once for each application: Spark's file server sends a zip of it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(), "logspark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; where it is unset, a temporary folder on one machine and an error on a cluster."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="logspark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables in the shared one."""
    return f"{shared_folder(spark)}/run-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the run's folder: its lineage ends there and lost executors cost nothing before it."""
    path = f"{run_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Deletes files or folders by the file system that holds them."""
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p) if "%" not in p else jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(p))
        path.getFileSystem(conf).delete(path, True)


def delete_table(df: DataFrame) -> None:
    """Deletes a table that written made, once nothing reads it any more."""
    files = df.inputFiles()
    delete_paths(df.sparkSession, [f.rpartition("/")[0] for f in list(files)[:1]])


def clean(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application; lazy results that read them have to be written before."""
    delete_paths(spark, [run_folder(spark)])
