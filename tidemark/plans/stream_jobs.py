"""Streaming forms over the event table, held against the batch answers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.materialize import create_table_as, shared_folder
from tidemark.plans.registry import query
from tidemark.sources.tables import Tables
from tidemark.streaming import jobs as S
from tidemark.streaming.state import BucketedState, run_stream

col = F.col


def _folder(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"


def _run(t: Tables, rows: DataFrame, arrivals: Sequence, kind: str, run) -> DataFrame:
    """The state after rows have landed part by part, in the order of arrivals, and run(stream, state, checkpoint) has gone on from its folders after each of them."""
    path, out = _folder(t), None
    for k, part in enumerate(arrivals):
        rows.where(part).write.parquet(f"{path}/in/k={k}")
        state = BucketedState(t.spark, f"{path}/state", S.SCHEMAS[kind], [S.SCHEMAS[kind].split()[0]], buckets=8)
        out = run(S.landed(t.spark, rows.schema, f"{path}/in"), state, f"{path}/checkpoint")
    return out


def _stepwise(step):
    return lambda stream, state, checkpoint: run_stream(stream, state, step, checkpoint)


def _halves(late: bool) -> list:
    """The event history in two arrivals; late: the newer half comes first."""
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    both = [col("collected_at") < middle, col("collected_at") >= middle]
    return both[::-1] if late else both


@query("t04_creator_latest_stream", "SELECT creator_id, max_by(followers, (collected_at, id)) AS followers, max(collected_at) AS collected_at FROM ehist GROUP BY 1")
def t04(t):
    return _run(t, t.event_history, _halves(True), "creator", _stepwise(S.latest_creator_step))


@query("t01_post_latest_stream", "SELECT post_id, views, likes, comments, collected_at FROM ehist QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY collected_at >= TIMESTAMP '2024-01-16' DESC, id DESC) = 1")
def t01(t):
    return _run(t, t.event_history, _halves(False), "post", _stepwise(S.latest_post_step))


@query(
    "t02_queue_stream",
    """SELECT post_id, score AS priority_score, collected_at AS last_checked, checks, collected_at + to_minutes(CASE WHEN aged THEN greatest(base_min, CASE WHEN score >= 300000 THEN 720 ELSE 1440 END) ELSE base_min END) AS next_check FROM
  (SELECT *, checks >= 3 AND post_date < collected_at - INTERVAL 7 DAY AS aged,
     CASE WHEN score >= 700000 THEN 30 WHEN score >= 300000 THEN 60 WHEN score >= 150000 THEN 120 WHEN score >= 50000 THEN 240 WHEN score >= 10000 THEN 480 ELSE 720 END AS base_min FROM
   (SELECT post_id, collected_at, (views + 10 * likes + 20 * comments)::DOUBLE AS score, count(*) OVER (PARTITION BY post_id) AS checks, min(collected_at) OVER (PARTITION BY post_id) AS post_date FROM ehist
    QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY collected_at >= TIMESTAMP '2024-01-16' DESC, id DESC) = 1))""",
)
def t02(t):
    return _run(t, t.event_history, _halves(False), "queue", _stepwise(S.queue_step(t.event_posts)))


@query("t03_enqueue_stream", "SELECT post_id, min(collected_at) AS enqueued_at FROM ehist GROUP BY 1")
def t03(t):
    return _run(t, t.event_history, _halves(False), "enqueued", _stepwise(S.enqueue_step))


@query("t05_strike_stream", "SELECT post_id, failure_count, first_failed_at, last_failed_at, last_success_at, status FROM failures")
def t05(t):
    rows = create_table_as(t.attempts.select("post_id", "seq", "collected_at", "missed"), "attempts")  # numbered once, landed in three parts
    return _run(t, rows, [col("seq") <= 2, col("seq") == 3, col("seq") > 3], "strikes", S.strike_stream)


@query(
    "t06_hourly_windows",
    """SELECT post_id, date_trunc('hour', collected_at) AS hour, count(*) AS checks, max(views) AS views FROM ehist
  WHERE date_trunc('hour', collected_at) + INTERVAL 1 HOUR <= (SELECT max(collected_at) FROM ehist) - INTERVAL 1 HOUR GROUP BY ALL""",
)
def t06(t):
    """Hourly counts as a stream: the windows that the watermark has closed when all events have come."""
    path = _folder(t)
    t.event_history.select("post_id", "collected_at", "views").write.parquet(f"{path}/in")
    stream = S.landed(t.spark, "post_id string, collected_at timestamp_ntz, views long", f"{path}/in").withColumn("collected_at", col("collected_at").cast("timestamp"))
    x = S.windowed_stream(stream, f"{path}/out", f"{path}/checkpoint")
    return x.select("post_id", col("window.start").cast("timestamp_ntz").alias("hour"), "checks", "views")


@query("t06_hourly_batch", "SELECT post_id, date_trunc('hour', collected_at) AS hour, count(*) AS checks, max(views) AS views FROM ehist GROUP BY ALL")
def t06b(t):
    """The same counts of all windows, as a batch over the function that serves the stream."""
    x = S.windowed_counts(t.event_history)
    return x.select("post_id", col("window.start").cast("timestamp_ntz").alias("hour"), "checks", "views")
