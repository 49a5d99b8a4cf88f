"""Incremental and keyed state: restarts, repeated batches, what a batch may touch."""

import random
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from tidemark.operators.relational import strike_state
from tidemark.sources.ledger import Ledger
from tidemark.streaming import jobs as S
from tidemark.streaming.state import BucketedState, run_stream

ROWS = "creator_id long, followers long, collected_at timestamp_ntz, id long"
DAY = datetime(2026, 1, 1)


def creators(spark, path, **more):
    return BucketedState(spark, path, S.SCHEMAS["creator"], ["creator_id"], **more)


def followers(df):
    return {r.creator_id: r.followers for r in df.collect()}


def test_state_survives_a_restart(spark, tmp_path):
    land = lambda k, rows: spark.createDataFrame(rows, ROWS).write.parquet(f"{tmp_path}/in/k={k}")
    run = lambda: run_stream(S.landed(spark, ROWS, f"{tmp_path}/in"), creators(spark, f"{tmp_path}/state"), S.latest_creator_step, f"{tmp_path}/checkpoint")
    land(0, [(1, 10, datetime(2026, 1, 2), 1), (2, 5, datetime(2026, 1, 1), 2)])
    first = followers(run())
    assert first == {1: 10, 2: 5}
    assert followers(run()) == first  # nothing new: the state stays
    land(1, [(1, 7, datetime(2026, 1, 1), 3), (3, 1, datetime(2026, 1, 3), 4)])  # a late row changes nothing
    assert followers(run()) == {1: 10, 2: 5, 3: 1}


def test_no_rows_give_the_empty_state(spark, tmp_path):
    spark.createDataFrame([], ROWS).write.parquet(f"{tmp_path}/in/k=0")
    out = run_stream(S.landed(spark, ROWS, f"{tmp_path}/in"), creators(spark, f"{tmp_path}/state"), S.latest_creator_step, f"{tmp_path}/checkpoint")
    assert out.count() == 0 and [f"{c} {t}" for c, t in out.dtypes] == ["creator_id bigint", "followers bigint", "collected_at timestamp_ntz"]


def batch(spark, rows):
    return spark.createDataFrame([(k, n, DAY + timedelta(days=n), n) for k, n in rows], ROWS)


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_untouched_buckets_are_not_rewritten(spark, tmp_path):
    state = creators(spark, str(tmp_path), buckets=16)
    state.apply(batch(spark, [(k, 1) for k in range(100)]), 0, S.latest_creator_step)
    before = files(tmp_path)
    state.apply(batch(spark, [(7, 2)]), 1, S.latest_creator_step)
    after = files(tmp_path)
    assert {f: after[f] for f in before} == before and len({f.split("/")[1] for f in set(after) - set(before)}) == 1
    assert spark.read.parquet(str(tmp_path / "v=2")).count() == 1  # the changed row alone
    assert followers(state.rows()) == {k: 1 for k in range(100)} | {7: 2}


def test_full_buckets_are_compacted_and_old_folders_go(spark, tmp_path):
    state = creators(spark, str(tmp_path), buckets=2, depth=2)
    for n in range(7):
        state.apply(batch(spark, [(k, n) for k in range(4)]), n, S.latest_creator_step)
        assert followers(state.rows()) == dict.fromkeys(range(4), n)
    live = {f for names in state.live().values() for f in names}
    assert all(len(names) <= 2 for names in state.live().values())
    held = {"/".join(f.split("/")[:2]) for f in files(tmp_path)}
    assert live <= held and len(held) <= len(live) + 6  # and what the last commit has just left
    assert len(list((tmp_path / "_log").glob("*.json"))) == 2


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    state = creators(spark, str(tmp_path))
    assert state.apply(batch(spark, [(1, 1)]), 0, S.latest_creator_step)
    assert not state.apply(batch(spark, [(1, 9)]), 0, S.latest_creator_step)
    state._write(batch(spark, [(1, 5)]).drop("id"), "v=2", 2)  # begun, never committed
    assert followers(state.rows()) == {1: 1}
    assert state.apply(batch(spark, [(2, 3)]), 1, S.latest_creator_step)
    assert followers(state.rows()) == {1: 1, 2: 3}


def test_the_ledger_commits_once(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/log")
    assert ledger.last() == -1 and not ledger.has(0)
    assert ledger.commit(0, {"a": 1}) and not ledger.commit(0, {"a": 2}) and ledger.read(0) == {"a": 1}
    assert ledger.commit(12, {}) and ledger.last() == 12
    ledger.forget(12)
    assert not ledger.has(0) and [p.name for p in (tmp_path / "log").glob("[!.]*")] == ["00000000000000000012.json"]


def test_strikes_equal_the_ordered_fold(spark, tmp_path):
    r = random.Random(11)
    rows = [(f"p{k}", s, DAY + timedelta(hours=s), r.random() < 0.6) for k in range(30) for s in range(1, r.randrange(2, 14))]
    schema = "post_id string, seq long, collected_at timestamp_ntz, missed boolean"
    cuts, out = [0, 3, 3, 7, 99], None
    state = BucketedState(spark, f"{tmp_path}/state", S.SCHEMAS["strikes"], ["post_id"], buckets=4, depth=2)
    for k, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):  # one arrival is empty
        spark.createDataFrame([x for x in rows if low < x[1] <= high], schema).write.parquet(f"{tmp_path}/in/k={k}")
        out = S.strike_stream(S.landed(spark, schema, f"{tmp_path}/in"), state, f"{tmp_path}/checkpoint")
    want = strike_state(spark.createDataFrame(rows, schema), "post_id", ["seq"], "missed", "collected_at").select(*out.columns)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


def test_strikes_fold_whole_micro_batches_like_the_posts_one_by_one(spark):
    r = random.Random(12)
    rows = [(f"p{k}", s * 3 + 1, DAY + timedelta(hours=r.randrange(50)), r.random() < 0.5) for k in range(60) for s in range(r.randrange(1, 12))]
    schema, state, want = "post_id string, seq long, collected_at timestamp_ntz, missed boolean", spark.createDataFrame([], S.SCHEMAS["strikes"]), {}
    for low, high in ((0, 9), (9, 16), (16, 99)):
        part = [x for x in rows if low < x[1] <= high]
        for post, _, at, missed in sorted(part, key=lambda x: x[1]):
            now = want.get(post)
            if missed:
                want[post] = (now[0] + 1, now[1], at, now[3]) if now else (1, at, at, None)
            elif now:
                want[post] = (0, now[1], now[2], at)
        changed = S.strike_step()(state, spark.createDataFrame(part, schema)).collect()
        held = {x.post_id: x for x in state.collect()} | {x.post_id: x for x in changed}
        state = spark.createDataFrame(list(held.values()), S.SCHEMAS["strikes"])
        assert {k: tuple(x)[1:5] for k, x in held.items()} == want
    assert len(want) > 40


def test_strikes_make_no_call_per_post(spark, tmp_path):
    schema = "post_id string, seq long, collected_at timestamp_ntz, missed boolean"
    spark.createDataFrame([(f"p{k}", 1, DAY, True) for k in range(20)], schema).write.parquet(f"{tmp_path}/in/k=0")
    state = BucketedState(spark, f"{tmp_path}/state", S.SCHEMAS["strikes"], ["post_id"], buckets=2)
    S.strike_stream(S.landed(spark, schema, f"{tmp_path}/in"), state, f"{tmp_path}/checkpoint")
    assert not list((tmp_path / "checkpoint").glob("state/*")) and state.rows().count() == 20  # the posts' rows are the only state
