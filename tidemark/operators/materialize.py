"""Create table as: a narrow intermediate result written once and read by all that use it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a local session, where all is one machine, may do without and gets a folder in its warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of an action inside go when it has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def create_table_as(df: DataFrame, name: str) -> DataFrame:
    """df as Parquet in the shared folder, read again: its plan runs once, however often it is used."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_made: dict[tuple, tuple] = {}


def shared_table(spark: SparkSession, name: str, inputs: list[str], make: Callable[[], DataFrame]) -> DataFrame:
    """create_table_as(make(), name), once for all queries of an application as long as the input files (paths, lengths, times) stay as they are and the table is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()

    def files(folder: str) -> list[tuple]:
        root = path(folder)
        fs = root.getFileSystem(conf)
        found, out = fs.listFiles(root, True), []
        while found.hasNext():
            x = found.next()
            out.append((str(x.getPath()), x.getLen(), x.getModificationTime()))
        return sorted(out)

    key = (spark.sparkContext.applicationId, shared_folder(spark), name, tuple(f for folder in inputs for f in files(folder)))
    done = _made.get(key)
    if done:
        mark = path(f"{done[0]}/_SUCCESS")
        if mark.getFileSystem(conf).exists(mark):
            return spark.read.schema(done[1]).parquet(done[0])
    df = make()
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    _made[key] = folder, df.schema
    return spark.read.schema(df.schema).parquet(folder)
