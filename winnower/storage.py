"""Shared folders and small sidecar files."""

from __future__ import annotations

import json
import re
import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession, label: str) -> str:
    """New folder name below the checkpoint folder that the cluster names.

    A session without that setting keeps such folders in its warehouse, if all
    executors can see it: a folder of the driver's own machine is refused unless
    the executors run there too.
    """
    base = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get(_WAREHOUSE_DIR)
        own = urlsplit(base).scheme in ("", "file")
        if own and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {_CHECKPOINT_DIR}: executors do not share {base}")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """The same rows, read from a table in a new shared folder; cuts lineage."""
    folder = shared_folder(spark, label)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, system = _hadoop_path(spark, path)
    return system.exists(target)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds; none if it does not exist."""
    target, system = _hadoop_path(spark, folder)
    if not system.exists(target):
        return []
    return [status.getPath().getName() for status in system.listStatus(target)]


def remove_folder(spark: SparkSession, path: str) -> None:
    target, system = _hadoop_path(spark, path)
    system.delete(target, True)


def write_small_json(spark: SparkSession, path: str, content: dict) -> None:
    """Write one small JSON file of fixed name, on any file system Spark knows."""
    target, system = _hadoop_path(spark, path)
    stream = system.create(target, True)
    try:
        stream.write(bytearray(json.dumps(content, ensure_ascii=False, indent=2), "utf-8"))
    finally:
        stream.close()


def replace_small_json(spark: SparkSession, path: str, content: dict) -> None:
    """Write one small JSON file so that readers see the old content or the new one, never less."""
    beside, _, name = path.rpartition("/")
    fresh = f"{beside}/_{name}-{uuid.uuid4().hex}"
    write_small_json(spark, fresh, content)
    fs = spark._jvm.org.apache.hadoop.fs
    source, target = fs.Path(fresh), fs.Path(path)
    overwrite = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    files = fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    files.rename(source, target, overwrite)


def read_small_json(spark: SparkSession, path: str) -> dict:
    target, system = _hadoop_path(spark, path)
    stream = system.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
