"""Readers and writers of landed data: CSV layers, stored pages, API responses, files; and the constraint report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.metrics import iso_duration_seconds, video_type
from tidemark.functions.text import iso_timestamp, safe_int

col = F.col

VIDEO_ITEMS = (
    "items array<struct<id:string,statistics:struct<viewCount:string,likeCount:string,commentCount:string>,"
    "snippet:struct<title:string,publishedAt:string>,contentDetails:struct<duration:string>>>"
)
CHANNEL_ITEMS = (
    "items array<struct<id:string,statistics:struct<subscriberCount:string,viewCount:string,videoCount:string,hiddenSubscriberCount:boolean>,"
    "contentDetails:struct<relatedPlaylists:struct<uploads:string>>>>"
)


def read_layer(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with a header, all columns text, in the given order; a byte-order mark before the first name is dropped."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    return raw.select(*[col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in columns])


def write_layer(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def merge_layer(old: DataFrame, new: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Earlier and new rows by column name, the first of each key kept; position orders within each side, earlier rows come first."""
    from tidemark.operators.relational import dedupe

    both = old.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    return dedupe(both, keys, [col("__side"), col(position)]).drop("__side")


def resume_from(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not processed yet."""
    return df.join(done.select(*keys), list(keys), "left_anti")


def read_html_dir(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, html): the .html files of a folder; the id is the file name without the ending."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").option("recursiveFileLookup", True).load(path)
    return files.select(F.regexp_extract("path", "([^/]+)\\.html$", 1).alias("page_id"), F.decode("content", "UTF-8").alias("html"))


def register_files(files: DataFrame, source_id: int, known: DataFrame) -> DataFrame:
    """Rows for files (path, content) that are not registered: digest, size, name, status stored."""
    new = files.select(
        F.lit(source_id).cast("long").alias("source_id"),
        col("path").alias("source_url"),
        F.sha2("content", 256).alias("sha256"),
        F.length("content").cast("long").alias("file_size_bytes"),
        F.element_at(F.split("path", "/"), -1).alias("original_filename"),
        F.lit("stored").alias("extraction_status"),
    )
    return known.unionByName(new.join(known.select("source_id", "source_url"), ["source_id", "source_url"], "left_anti"))


def resolve_source(sources: DataFrame, name: str) -> DataFrame:
    """(source_id, error) of the named source; error where there is none. Always one row."""
    return sources.where(col("source_name") == name).agg(F.min("id").alias("source_id")).withColumn("error", F.when(col("source_id").isNull(), f"no source named {name}"))


def replace_load(target: DataFrame, load: DataFrame, key: str) -> DataFrame:
    """target with the rows of the loaded keys replaced."""
    return target.join(load.select(key).distinct(), key, "left_anti").unionByName(load.select(*target.columns))


def append_history(df: DataFrame, path: str, time: str = "collected_at", unit: str = "day") -> None:
    """Append to the history, partitioned by day (or month, for long loads): column d. Large partitions are split, small ones come to one file."""
    rows = df.withColumn("d", F.date_trunc(unit, time).cast("date"))
    rows.hint("rebalance", F.col("d")).write.mode("append").partitionBy("d").parquet(path)


def _items(json_rows: DataFrame, schema: str) -> DataFrame:
    return json_rows.select(F.explode_outer(F.from_json("json", schema)["items"]).alias("i")).where("i.id IS NOT NULL")


def normalize_stats(json_rows: DataFrame, collected_at: Column) -> DataFrame:
    """Snapshot rows from landed statistics (column json); missing counters are 0."""
    n = lambda c: F.coalesce(safe_int(col(f"i.statistics.{c}")), F.lit(0)).alias({"viewCount": "views", "likeCount": "likes", "commentCount": "comments"}[c])
    return _items(json_rows, VIDEO_ITEMS).select(col("i.id").alias("post_id"), collected_at.alias("collected_at"), n("viewCount"), n("likeCount"), n("commentCount"))


def normalize_video_details(json_rows: DataFrame) -> DataFrame:
    """Post rows from landed video details; rows without an id are dropped."""
    seconds = iso_duration_seconds(col("i.contentDetails.duration"))
    n = lambda c, name: F.coalesce(safe_int(col(f"i.statistics.{c}")), F.lit(0)).alias(name)
    return _items(json_rows, VIDEO_ITEMS).select(
        col("i.id").alias("post_id"),
        col("i.snippet.title").alias("title"),
        iso_timestamp(col("i.snippet.publishedAt")).alias("post_date"),
        n("viewCount", "views"),
        n("likeCount", "likes"),
        n("commentCount", "comments"),
        seconds.alias("duration"),
        video_type(seconds, col("i.snippet.title")).alias("video_type"),
    )


def normalize_channel(json_rows: DataFrame) -> DataFrame:
    """Creator snapshot rows from landed channels; counters that are no numbers are null."""
    n = lambda c, name: safe_int(col(f"i.statistics.{c}")).alias(name)
    return _items(json_rows, CHANNEL_ITEMS).select(
        col("i.id").alias("channel_id"),
        n("subscriberCount", "followers"),
        n("viewCount", "channel_view_count"),
        n("videoCount", "channel_video_count"),
        col("i.statistics.hiddenSubscriberCount").alias("hidden_subscriber_count"),
        col("i.contentDetails.relatedPlaylists.uploads").alias("uploads"),
    )


def constraint_report(rules: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(rule, violations) from named frames of violating rows."""
    parts = [df.agg(F.lit(name).alias("rule"), F.count("*").alias("violations")) for name, df in rules]
    return reduce(DataFrame.unionByName, parts)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return df.where(col(key).isNotNull()).join(parent.select(col(parent_key).alias(key)), key, "left_anti")


def outside(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    return df.where(col(column).isNotNull() & ~col(column).isin(*domain))
