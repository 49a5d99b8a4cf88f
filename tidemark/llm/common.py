"""What several corpus operators share: staging tables, checked broadcasts, null-safe texts, sketches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the word pattern [^\x20\x09-\x0D]+, as a Java character class.
SPACES = "[ \\t-\\r]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session, where all is one machine, may do without: it gets one in its warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_scratch: list[list[str]] = []


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the actions inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stage(df: DataFrame, name: str = "stage", codec: str = "snappy") -> DataFrame:
    """Write df to the shared folder and read it again: later steps survive lost executors and never recompute it. The shuffle files of the write go when it has ended."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", codec).parquet(path)
    if _scratch:
        _scratch[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that are staged inside are deleted at the end; what is returned from inside must be made by keep()."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            to = spark._jvm.org.apache.hadoop.fs.Path(path)
            to.getFileSystem(spark._jsc.hadoopConfiguration()).delete(to, True)


def keep(df: DataFrame, name: str) -> DataFrame:
    """stage() of a result that outlives the scratch() around it; it goes with the next one outside, if there is one."""
    _scratch.append([])
    try:
        return stage(df, name)
    finally:
        paths = _scratch.pop()
        if len(_scratch) > 1:
            _scratch[-2].extend(paths)


def arrow_rows(spark: SparkSession, n: int):
    """Arrow batches of n rows for the actions inside: for rows of many kilobytes."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(n))


#: Bytes of a Parquet row group of texts: what a task holds while it writes one, and of a column while it reads one.
ROW_GROUP = 16 << 20


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """For the whole session of a query or pipeline over texts: Arrow batches of so many rows, Parquet batches of half as many, small row groups. The usual ones hold tens of megabytes, several times over, in the executor and its workers, and what an executor's heap has grown to it keeps."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(max(1, rows // 2)))
    spark.conf.set("parquet.block.size", str(ROW_GROUP))


def small(df: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """A broadcast hint if a count shows at most max_rows narrow rows; beyond that a plain shuffled join stays."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text."""
    bare = F.trim(text, F.lit(" \t\n\v\f\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once for each row, also where body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sketch_bucket(v: Column) -> Column:
    """Bucket of a non-negative integer in a log-linear quantile sketch: exact below 32, then 16 buckets an octave (error at most 1/16)."""
    shift = F.greatest(F.length(F.bin(v)) - 5, F.lit(0)).cast("int")
    return F.when(v < 32, v).otherwise(shift * 16 + F.call_function("shiftright", v, shift))


def sketch_value(b: Column) -> Column:
    """Least value of a bucket."""
    shift = F.greatest(F.floor(b / 16) - 1, F.lit(0)).cast("int")
    return F.when(b < 32, b).otherwise(F.call_function("shiftleft", b % 16 + 16, shift))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
