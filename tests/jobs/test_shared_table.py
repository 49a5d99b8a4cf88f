"""Tables that several queries share."""

from pyspark.sql import functions as F

from tidemark.operators.materialize import shared_table
from tidemark.plans.queue_jobs import FEATURE_COLUMNS, features_v2, post_features
from tidemark.plans.snapshots import QUERIES
from tidemark.sources.tables import Tables


def test_made_once_while_the_input_stays(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.read.parquet(f"{tmp_path}/in").selectExpr("id + 1 AS x")

    def rows():
        return sorted(r.x for r in shared_table(spark, "t", [f"{tmp_path}/in"], make).collect())

    spark.range(3).write.parquet(f"{tmp_path}/in")
    assert rows() == [1, 2, 3] and rows() == [1, 2, 3] and len(made) == 1
    spark.range(5, 7).write.mode("append").parquet(f"{tmp_path}/in")  # another input: another table
    assert rows() == [1, 2, 3, 6, 7] and len(made) == 2
    spark.range(0).write.mode("overwrite").parquet(f"{tmp_path}/in")
    assert rows() == [] and rows() == [] and len(made) == 3


def test_partitions_of_the_states_grow_with_the_table(spark):
    t = Tables(spark, "/root/testdata/sf0.01")
    rows = t.raw("lineitem")
    assert t._dealt(rows, "l_orderkey", "lineitem").rdd.getNumPartitions() == 4  # the session's own number is enough
    assert t._dealt(rows, "l_orderkey", "lineitem", rows=rows.count() // 9).rdd.getNumPartitions() >= 9


def test_what_the_posts_rows_hold_is_not_joined_again(spark):
    for name in ("q19_recompute_next_check", "q48_dq_checks"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Window" not in plan, name


def test_batches_take_the_lags_from_the_posts_rows(spark):
    for name in ("q04_queue_batch_v2", "q35_batch_comparison", "q35_batch_profile", "q21_legacy_low_batch"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "lineitem" not in plan and "max_by" not in plan and "post-states" not in plan, name


def test_coverage_and_checks_are_columns_of_the_posts_rows(spark):
    for name in ("q37_coverage_daily", "q38_guardrail_debt", "q39_legacy_low_counts", "q32_checks_histogram"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan, name


def test_a_run_shuffles_neither_all_responses_nor_all_posts(spark):
    plan = QUERIES["q23_run_summary"](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    assert "from_json" not in plan.optimizedPlan().toString()  # responses were met once, with the batch's uploads
    anti = [x for x in plan.executedPlan().toString().split("\n") if "LeftAnti" in x]
    assert anti and all("BroadcastHashJoin" in x for x in anti)


def test_lags_of_the_posts_rows_are_those_of_the_history(spark, tmp_path):
    """Ties, misses, nulls, times within a day, posts without attempts: what the states hold equals the as-of join of the history."""
    import random
    from datetime import datetime, timedelta

    rng, t0 = random.Random(5), datetime(1997, 3, 1)
    maybe = lambda v: None if rng.random() < 0.1 else v
    items = [
        (k, i, 7, rng.choice([1.0, 3.0]), maybe(rng.uniform(10, 90_000)), maybe(rng.choice("RAN")), maybe(t0 + timedelta(hours=rng.choice([0, 1, 5, 6, 7, 18, 24, 25, 60]))))
        for k in range(200) for i in range(rng.randint(1, 7)) if k % 9
    ]
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"
    spark.createDataFrame(items, schema).selectExpr("*", "1L AS l_suppkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(k, k % 5, "O" if k % 4 else "F", "1-URGENT", 10.0, t0) for k in range(200)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    t = Tables(spark, str(tmp_path))
    cols = [c for c in FEATURE_COLUMNS if c != "post_id"]
    got = {r.post_id: tuple(r[c] for c in cols) for r in post_features(t).collect()}
    joined = features_v2(t.posts.withColumn("collected_at", F.coalesce("collected_at", t.as_of)), t.history)
    assert got == {r.post_id: tuple(r[c] for c in cols) for r in joined.collect()} and len(got) == 200
    assert {x[cols.index("history_level")] for x in got.values()} == {"full", "partial", "low"}
