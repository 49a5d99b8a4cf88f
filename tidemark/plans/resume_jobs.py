"""Jobs that seek, resume and append once: cursors over ranked tables, layered work behind a commit log, histories and the windows kept beside them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.materialize import create_table_as, shared_folder
from tidemark.operators.pages import page_title
from tidemark.operators.ranks import RankedTable
from tidemark.plans.registry import query
from tidemark.sources.resume import BatchHistory, ResumableJob, TrailingWindows
from tidemark.sources.tables import Tables
from tidemark.streaming import jobs as S

col = F.col


def folder(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def ranked_creators(t: Tables) -> RankedTable:
    return RankedTable.write(t.creators, folder(t, "creators"), ["id"], 16)


@query(
    "s18_cursor_seek",
    """SELECT 'middle' AS batch, id, channel_id, r - 1 AS position, (SELECT CASE WHEN count(*) // 2 + 40 >= count(*) THEN 0 ELSE count(*) // 2 + 40 END FROM creators) AS next_cursor FROM (SELECT *, row_number() OVER (ORDER BY id) AS r FROM creators) WHERE r - 1 >= (SELECT count(*) // 2 FROM creators) AND r - 1 < (SELECT count(*) // 2 + 40 FROM creators)
  UNION ALL SELECT 'last', id, channel_id, r - 1, 0 FROM (SELECT *, row_number() OVER (ORDER BY id) AS r FROM creators) WHERE r > (SELECT count(*) - 7 FROM creators)
  UNION ALL SELECT 'past the end', id, channel_id, r - 1, 5 FROM (SELECT *, row_number() OVER (ORDER BY id) AS r FROM creators) WHERE r <= 5""",
)
def s18(t):
    """Three batches of creators by cursor: in the middle, one that wraps, and a cursor past the end."""
    table = ranked_creators(t)
    out = None
    for name, cursor, n in (("middle", table.total // 2, 40), ("last", table.total - 7, 30), ("past the end", table.total + 3, 5)):
        rows, following = table.round_robin(cursor, n)
        rows = rows.select(F.lit(name).alias("batch"), "id", "channel_id", "position", F.lit(following).cast("long").alias("next_cursor"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "s19_resume_ledger",
    r"""WITH x AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, (SELECT max(page_id) + 1 FROM pages) AS n FROM pages)
  SELECT page_id, host, CASE WHEN page_id < n // 2 THEN page_id // (n // 5) ELSE 3 + (page_id - n // 2) // (n // 5) END::INTEGER AS chunk FROM x""".replace("WITH x AS", "SELECT * FROM (WITH x AS") + ")",
)
def s19(t):
    """A layer over the stored pages in chunks: it stops at a page that cannot be read, is mended, and goes on with that page; the log tells which chunk made a row."""
    from tidemark.functions.text import host_of

    pages = t.raw("pages").select("page_id", "url")
    n = pages.agg(F.max("page_id")).first()[0] + 1
    broken = n // 2

    def job() -> ResumableJob:  # each run finds its place in the log
        return ResumableJob(t.spark, path, "page_id", "page_id bigint, host string")

    path = folder(t, "layer")
    hosts = lambda rows: rows.select("page_id", host_of(col("url")).alias("host"))
    first = job().run(pages, lambda rows: hosts(rows).withColumn("host", F.when(col("page_id") != broken, col("host"))), n // 5, stop=col("host").isNull())
    assert first["failed_row_index"] == broken and job().next_index() == broken
    job().run(pages, hosts, n // 5, stop=col("host").isNull())
    return job().result()


HISTORY = "id bigint, post_id string, collected_at timestamp_ntz, views bigint, likes bigint, comments bigint"


def _history(t: Tables) -> BatchHistory:
    return BatchHistory(t.spark, folder(t, "history"), HISTORY)


@query("t07_exactly_once_append", "SELECT d, count(*) AS snapshots, count(DISTINCT post_id) AS posts FROM (SELECT DISTINCT post_id, collected_at, collected_at::DATE AS d FROM ehist) GROUP BY 1")
def t07(t):
    """Snapshots arrive in two parts that repeat half an hour of rows, the first micro-batch is delivered again: each (post, time) is in the history once."""
    rows = t.event_history.select("id", "post_id", col("collected_at").cast("timestamp").alias("collected_at"), "views", "likes", "comments")
    rows = create_table_as(rows, "snapshots")  # counters run once, for three deliveries
    path, history = folder(t, "arrivals"), _history(t)
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp")
    for k, part in enumerate((col("collected_at") < middle, col("collected_at") >= middle - F.expr("INTERVAL 30 MINUTES"))):
        rows.where(part).write.parquet(f"{path}/in/k={k}")
        S.append_stream(S.landed(t.spark, rows.schema, f"{path}/in"), history, f"{path}/checkpoint")
    history.append(rows.where(col("collected_at") < middle).withColumn("collected_at", col("collected_at").cast("timestamp_ntz")), 0)  # delivered again
    return history.read().groupBy("d").agg(F.count("*").alias("snapshots"), F.count_distinct("post_id").alias("posts"))


WINDOWS = {"24h": 24, "5d": 120, "7d": 168}


@query(
    "s07_trailing_windows",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS trailing, post_id, count(*) AS checks, (arg_max(views, (collected_at, id)) - arg_min(views, (collected_at, id)))::BIGINT AS views_growth, (arg_max(likes, (collected_at, id)) - arg_min(likes, (collected_at, id)))::BIGINT AS likes_growth,
  (arg_max(comments, (collected_at, id)) - arg_min(comments, (collected_at, id)))::BIGINT AS comments_growth FROM ehist WHERE collected_at BETWEEN TIMESTAMP '2024-01-30 06:30:00' - INTERVAL {hours} HOUR AND TIMESTAMP '2024-01-30 06:30:00' GROUP BY post_id"""
        for name, hours in WINDOWS.items()
    ),
)
def s07_windows(t):
    """Trailing reports from daily aggregates that two appends have kept up to date, each for the days that it touched."""
    history, rows = _history(t), t.event_history.select("id", "post_id", "collected_at", "views", "likes", "comments")
    windows, middle = TrailingWindows(history, folder(t, "daily")), F.lit("2024-01-27 12:00:00").cast("timestamp_ntz")
    for n, part in enumerate((col("collected_at") < middle, col("collected_at") >= middle)):
        windows.refresh(history.append(rows.where(part), n))
    out: DataFrame | None = None
    for name, hours in WINDOWS.items():
        one = windows.report("2024-01-30 06:30:00", hours).select(F.lit(name).alias("trailing"), "*")
        out = one if out is None else out.unionByName(one)
    return out
