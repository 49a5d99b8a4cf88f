from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.operators import relational as R
from tidemark.plans.entity_jobs import register_collection_result, sync_latest
from tidemark.plans.market_jobs import CHECKS, file_status, normalize_registrations
from tidemark.sources import readers

T0 = datetime(2026, 1, 1)


def test_asof_ties_take_the_greatest_id_and_early_times_have_none(spark):
    left = spark.createDataFrame([("a", datetime(2026, 1, 2)), ("b", datetime(2026, 1, 2))], "k string, t timestamp_ntz")
    right = spark.createDataFrame([("a", datetime(2026, 1, 1, 12), 1, 10), ("a", datetime(2026, 1, 1, 12), 2, 20), ("a", datetime(2026, 1, 1, 23), 3, 30), ("b", datetime(2026, 1, 2), 4, 1)], "k string, t timestamp_ntz, id long, v long")
    out = {r.k: r for r in R.asof_join(left, right, "k", "t", "t", {"x": M.minutes(360), "y": M.minutes(3000)}, ["v"], "id").collect()}
    assert out["a"].x.v == 20 and out["a"].y is None and out["b"].x is None


def test_quota_batch_properties(spark):
    rows = [(f"p{i:03d}", i % 6 + 1, i // 7, i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, band int, due int, checks int")
    order = [F.col("due").asc(), F.col("id").asc()]
    out = R.quota_batch(df, "id", "band", {1: 2, 2: 2, 3: 2, 4: 2, 5: 2, 6: 2}, 30, order, order, (F.col("checks") < 2, [F.col("checks").asc(), F.col("id").asc()], 4)).collect()
    assert len(out) == 30 == len({r.id for r in out})
    guard = [r for r in out if r.slice_order == 0]
    assert len(guard) == 4 and all(r.checks == 0 for r in guard) and all(r.checks >= 2 for r in out if r.slice_order)
    for b in range(1, 7):
        fifo = sorted((d, i) for i, band, d, c in rows if band == b and c >= 2)[:2]
        assert {i for _, i in fifo} == {r.id for r in out if r.slice_order == 1 and r.band == b}


def test_dedupe_forms(spark):
    df = spark.createDataFrame([("u", 1, "a", 2), ("u", 2, "b", 9), ("v", 3, "c", 1), ("u", 4, "d", 9)], "k string, pos int, val string, score int")
    pick = lambda x: {r.k: (r.pos, r.val) for r in x.collect()}
    assert pick(R.dedupe(df, ["k"], [F.col("pos")])) == {"u": (1, "a"), "v": (3, "c")}
    assert pick(R.dedupe_best(df, ["k"], F.col("score"), F.col("pos"))) == {"u": (2, "b"), "v": (3, "c")}
    assert pick(R.dedupe_last_at_first(df, ["k"], "pos")) == {"u": (1, "d"), "v": (3, "c")}


def test_missing_ids(spark):
    req = spark.createDataFrame([("B", 1), ("l", 2), ("a", 3), ("B", 4), (None, 5)], "k string, pos int")
    got = spark.createDataFrame([("a",), ("extra",)], "k string")
    assert [r.k for r in R.missing(req, got, "k", "pos").orderBy("pos").collect()] == ["B", "l"]
    assert R.missing(got, got, "k").count() == 0


def test_half_open_period(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 31, 23, 59),), (datetime(2026, 2, 1),), (datetime(2025, 12, 31),)], "t timestamp_ntz")
    assert R.period_filter(df, "t", "2026-01-01", "2026-01-31").count() == 1


STATE = "post_id string, failure_count int, first_failed_at timestamp_ntz, last_failed_at timestamp_ntz, last_success_at timestamp_ntz, status string"


def test_three_strikes_and_recovery(spark):
    state = spark.createDataFrame([], STATE)
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "post_id string")
    now = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    state, actions = register_collection_result(state, ids("m", "h", "m"), ids("h"), now)
    assert [(r.post_id, r.failure_count, r.status) for r in state.collect()] == [("m", 1, "unavailable_candidate")]
    assert [(r.post_id, r.action_taken) for r in actions.collect()] == [("m", "missing")]
    for _ in range(2):
        state, _ = register_collection_result(state, ids("m", "h"), ids("h"), now)
    assert state.first().status == "unavailable" and state.first().failure_count == 3
    state, actions = register_collection_result(state, ids("m"), ids("m"), now)
    assert (state.first().status, state.first().failure_count, state.first().first_failed_at) == ("recovered", 0, T0) and actions.first().action_taken == "returned"


def test_strike_fold(spark):
    rows = [("a", i, T0, m) for i, m in enumerate([True, True, False, True])] + [("b", i, T0, True) for i in range(3)] + [("c", 0, T0, False)]
    df = spark.createDataFrame(rows, "k string, seq long, t timestamp_ntz, missed boolean")
    got = {r.k: (r.failure_count, r.status) for r in R.strike_state(df, "k", ["seq"], "missed", "t").collect()}
    assert got == {"a": (1, "unavailable_candidate"), "b": (3, "unavailable")}


def test_creator_sync_ignores_late_rows(spark):
    state = spark.createDataFrame([(1, 5, datetime(2026, 1, 2))], "id long, f long, t timestamp_ntz")
    late = spark.createDataFrame([(1, 9, datetime(2026, 1, 1), 7)], "id long, f long, t timestamp_ntz, seq long")
    assert sync_latest(state, late, "id", ["f"], "t", "seq", True).first().f == 5
    assert sync_latest(state, late, "id", ["f"], "t", "seq", False).first().f == 9


def test_merges(spark):
    t = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    s = spark.createDataFrame([(2, 5), (3, 7)], "k int, v int")
    as_dict = lambda x: {r.k: r.v for r in x.collect()}
    assert as_dict(R.upsert(t, s, ["k"])) == {1: 10, 2: 5, 3: 7}
    assert as_dict(R.insert_absent(t, s, ["k"])) == {1: 10, 2: 20, 3: 7}
    assert as_dict(R.merge_with(t, s, ["k"], {"v": F.col("t.v") + F.col("s.v")}, {"v": F.col("s.v")})) == {1: 10, 2: 25, 3: 7}
    assert as_dict(R.delete_where(t, s, ["k"])) == {1: 10}
    assert as_dict(readers.replace_load(t, s, "k")) == {1: 10, 2: 5, 3: 7}


def test_registrations_and_checks(spark):
    rows = [
        ("f/2026/04/2026_04_02.pdf", 1, ["A) Autos", "187.313", "1,2"]), ("f/2026/04/2026_04_02.pdf", 2, ["B) Com. Leves", "49.943"]), ("f/2026/04/2026_04_02.pdf", 3, ["A + B", "237.256"]),
        ("f/2026/04/2026_04_02.pdf", 4, ["D) Ônibus 2.000", ""]), ("f/2026/04/2026_04_02.pdf", 5, ["note", "5"]), ("f/2026/04/2026_04_02.pdf", 6, ["A) Autos", "9"]),
    ]
    df = spark.createDataFrame(rows, "path string, row_number int, cells array<string>")
    n = normalize_registrations(df)
    assert {r.segment_code: r.mes_atual for r in n.collect()} == {"autos": 187313, "comerciais_leves": 49943, "autos_comerciais_leves": 237256, "onibus": 2000}
    checks = R.sum_checks(n, ["path"], "segment_code", "mes_atual", CHECKS)
    got = {r.check_name: r for r in checks.collect()}
    assert got["autos_plus_light"].passed and not got["sum_to_total"].passed and got["sum_to_total"].severity == "warning" and got["sum_to_total"].note
    assert file_status(checks, ["path"]).first().extraction_status == "validated"


def test_landed_json(spark):
    js = '{"items":[{"id":"v1","statistics":{"viewCount":"5","likeCount":"x"},"snippet":{"title":"T","publishedAt":"2026-01-01T00:00:00Z"},"contentDetails":{"duration":"PT5M"}},{"statistics":{}}]}'
    df = spark.createDataFrame([(js,), ("bad",)], "json string")
    r = readers.normalize_video_details(df).collect()
    assert len(r) == 1 and (r[0].post_id, r[0].views, r[0].likes, r[0].duration, r[0].video_type, r[0].post_date) == ("v1", 5, 0, 300, "long", T0)
    assert readers.normalize_stats(df, F.lit(T0)).count() == 1


def test_layers_and_files(spark, tmp_path):
    (tmp_path / "l.csv").write_text("﻿nome,valor\na,1\n", encoding="utf-8")
    assert readers.read_layer(spark, str(tmp_path / "l.csv"), ["nome", "valor", "x"]).first().asDict() == {"nome": "a", "valor": "1", "x": None}
    (tmp_path / "p1.html").write_text("<html>é</html>", encoding="utf-8")
    (tmp_path / "n.txt").write_text("x")
    assert [(r.page_id, r.html) for r in readers.read_html_dir(spark, str(tmp_path)).collect()] == [("p1", "<html>é</html>")]


def test_series(spark):
    from datetime import date

    df = spark.createDataFrame([("a", date(2026, 1, 1), 10), ("a", date(2026, 3, 1), 30)], "k string, m date, v long")
    by = {r.m.month: r for r in R.series_change(df, "k", "m", "v", lags=(1,)).collect()}
    safe = {r.m.month: r for r in R.series_change(df, "k", "m", "v", lags=(1,), calendar_safe=True).collect()}
    assert by[3].lag_1 == 10 and by[3].ytd == 40 and safe[3].lag_1 is None


def test_last_at_first_place_keeps_the_null_key(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "b", 4), ("k", "c", 2), ("k", "d", 3)], "k string, v string, n int")
    assert sorted(map(str, R.dedupe_last_at_first(df, ["k"], "n").collect())) == ["Row(k='k', v='d', n=2)", "Row(k=None, v='b', n=1)"]
