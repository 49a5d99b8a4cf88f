"""Commit logs: a run that dies, one that stops, batches that come twice; windows that stay equal to the history."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.sources.resume import BatchHistory, ResumableJob, TrailingWindows

col = F.col
SCHEMA = "i bigint, v bigint"
HISTORY = "id bigint, post_id string, collected_at timestamp_ntz, views bigint, likes bigint, comments bigint"


def job(spark, path):
    return ResumableJob(spark, str(path), "i", SCHEMA)


def double(rows):
    return rows.select(col("id").alias("i"), (col("id") * 2).alias("v"))


def values(result):
    return sorted((r.i, r.v) for r in result.collect())


def test_a_run_that_dies_goes_on_where_it_was(spark, tmp_path):
    seen = []

    def dies(rows):
        seen.append(rows.agg(F.min("i")).first()[0])
        if len(seen) == 3:
            raise RuntimeError("lost")
        return rows.select("i", (col("i") * 2).alias("v"))

    items = spark.range(10).select(col("id").alias("i"))
    with pytest.raises(RuntimeError):
        job(spark, tmp_path).run(items, dies, 3)
    assert job(spark, tmp_path).next_index() == 6 and values(job(spark, tmp_path).result()) == [(k, 2 * k) for k in range(6)]
    spark.createDataFrame([(6, 0)], SCHEMA).write.parquet(f"{tmp_path}/chunk=2")  # what the dead run had written does not count
    assert len(values(job(spark, tmp_path).result())) == 6
    assert job(spark, tmp_path).run(items, dies, 3)["last_completed_index"] == 9
    assert seen == [0, 3, 6, 6, 9] and values(job(spark, tmp_path).result()) == [(k, 2 * k) for k in range(10)]
    assert job(spark, tmp_path).run(items, dies, 3)["status"] == "complete" and len(seen) == 5


def test_a_stop_keeps_the_earlier_index(spark, tmp_path):
    items = spark.range(10).select(col("id").alias("i"))
    work = lambda rows: rows.select("i", (col("i") * 2).alias("v"))
    said = job(spark, tmp_path).run(items, work, 4, stop=col("v") == 12)
    assert said == {"status": "stopped", "last_completed_index": 5, "next_row_index": 6, "failed_row_index": 6}
    assert values(job(spark, tmp_path).result()) == [(k, 2 * k) for k in range(6)]
    assert job(spark, tmp_path).run(items, work, 4, stop=col("v") == 12)["last_completed_index"] == 5  # still there
    job(spark, tmp_path).run(items, work, 4)
    assert values(job(spark, tmp_path).result()) == [(k, 2 * k) for k in range(10)]


def test_no_rows(spark, tmp_path):
    assert job(spark, tmp_path).run(spark.range(0).select(col("id").alias("i")), double, 3)["status"] == "complete"
    assert job(spark, tmp_path).result().collect() == []


def snapshots(spark, rows):
    return spark.createDataFrame([(i, p, datetime(2026, 1, 1) + timedelta(hours=h), v, v, v) for i, p, h, v in rows], HISTORY)


def test_batches_count_once(spark, tmp_path):
    history = BatchHistory(spark, str(tmp_path), HISTORY)
    assert history.read().count() == 0
    assert history.append(snapshots(spark, [(1, "a", 1, 5), (2, "a", 30, 6)]), 0) == ["2026-01-01", "2026-01-02"]
    assert history.append(snapshots(spark, [(1, "a", 1, 5), (9, "z", 1, 5)]), 0) == []
    snapshots(spark, [(3, "b", 2, 1)]).withColumn("d", F.lit("2026-01-01").cast("date")).write.partitionBy("d").parquet(f"{tmp_path}/rows/batch=1")  # begun, never committed
    assert sorted(r.id for r in history.read().collect()) == [1, 2]
    history.append(snapshots(spark, [(4, "b", 2, 1)]), 1)
    assert sorted(r.id for r in history.read().collect()) == [1, 2, 4]


def test_windows_equal_the_history(spark, tmp_path):
    history = BatchHistory(spark, f"{tmp_path}/h", HISTORY)
    windows = TrailingWindows(history, f"{tmp_path}/w")
    rows = [(k, f"p{k % 3}", (k * 7) % 200, k * k) for k in range(120)]
    for n in range(3):
        windows.refresh(history.append(snapshots(spark, rows[n::3]), n))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "w").rglob("*.parquet")}
    windows.refresh(history.append(snapshots(spark, [(500, "p0", 190, 3)]), 3))
    rows.append((500, "p0", 190, 3))
    kept = {p: t for p, t in before.items() if p.exists()}
    assert {p.parent.name for p in before} - {p.parent.name for p in kept} == {"d=2026-01-08"} and all(p.stat().st_mtime_ns == t for p, t in kept.items())
    for hours in (5, 24, 120, 168):
        until = 193
        want = {}
        for i, p, h, v in sorted(rows, key=lambda x: (x[2], x[0])):
            if until - hours <= h <= until:
                want.setdefault(p, []).append(v)
        got = {r.post_id: (r.checks, r.views_growth) for r in windows.report("2026-01-09 01:00:00", hours).collect()}
        assert got == {p: (len(v), v[-1] - v[0]) for p, v in want.items()}


def test_deliveries_of_snapshots_read_rows_that_are_made_once(spark, monkeypatch):
    from tidemark.plans.snapshots import QUERIES
    from tidemark.sources.resume import BatchHistory

    plans, real = [], BatchHistory.append
    monkeypatch.setattr(BatchHistory, "append", lambda self, rows, n: (plans.append(rows._jdf.queryExecution().optimizedPlan().toString()), real(self, rows, n))[1])
    QUERIES["t07_exactly_once_append"](spark, "/root/testdata/sf0.001")
    assert len(plans) >= 3 and "Window" not in plans[-1]
