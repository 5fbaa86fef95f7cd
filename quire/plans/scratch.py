"""Folders that driver and executors share, for reports that queries write and read again."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_dropped: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession, name: str, drop: bool = False) -> str:
    """A new path under ``spark.checkpoint.dir``; under /tmp where that is unset and all run on one machine, as in tests. ``drop``: deleted when
    the process ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that driver and executors share")
    path = f"{(shared or '/tmp/checkpoints').rstrip('/')}/quire-{uuid.uuid4().hex}-{name}"
    if drop:
        _dropped.append((spark, path))
    return path


def drop_folders() -> None:
    while _dropped:
        spark, path = _dropped.pop()
        try:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session is gone already
            return


atexit.register(drop_folders)


def one_file_each(df: DataFrame, name: str, value: str, order: list[str] | None = None) -> list[str]:
    """Write the text column ``value`` to a file for each ``name`` (the file's name), its rows as lines by ``order``, gzipped; the paths, in the order of ``name``."""
    spark = df.sparkSession
    path = folder(spark, "reports")
    rows = df.withColumnRenamed(name, "file").repartition("file").sortWithinPartitions("file", *(order or []))
    rows.select("file", F.col(value).alias("value")).write.partitionBy("file").text(path, compression="gzip")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/file=*/part-*")
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []
    return sorted(str(f.getPath().toString()) for f in found)
