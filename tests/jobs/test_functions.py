from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.functions import text as T


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def ts(x):
    return F.lit(x).cast("timestamp_ntz")


def test_next_check_worked_examples(spark):
    at, post = ts("2026-06-15 12:00:00"), ts("2026-03-01 00:00:00")
    r = one(spark, many=M.next_check(F.lit(1e6), at, post, F.lit(900)), few=M.next_check(F.lit(1e6), at, post, F.lit(2)), null=M.next_check(F.lit(1e6), F.lit(None).cast("timestamp_ntz"), post, F.lit(2)))
    assert (r.many, r.few, r.null) == (datetime(2026, 6, 16), datetime(2026, 6, 15, 12, 30), datetime(1970, 1, 1, 0, 30))


def test_durations_and_types(spark):
    rows = spark.createDataFrame([("PT1H2M3S", "x"), ("PT45S", "x"), ("P1D", None), (None, "x"), ("P1DT2H", "x"), ("PT10M", "a #Shorts"), ("PT270S", ""), ("PT271S", "")], "d string, t string")
    s = M.iso_duration_seconds(F.col("d"))
    got = rows.select(s.alias("s"), M.video_type(s, F.col("t")).alias("v")).collect()
    assert [r.s for r in got] == [3723, 45, 0, 0, 0, 600, 270, 271]
    assert [r.v for r in got][-3:] == ["short", "short", "long"]


@pytest.mark.parametrize("score, band", [(700_000, 6), (300_000, 5), (299_999, 4), (50_000, 3), (10_000, 2), (9_999, 1)])
def test_bands(spark, score, band):
    assert one(spark, b=M.priority_band(F.lit(float(score)))).b == band


def test_velocity_and_levels(spark):
    r = one(spark, none=M.velocity_raw(F.lit(5), F.lit(1), F.lit(1), F.lit(0.0)), up=M.velocity_raw(F.lit(12), F.lit(-6), F.lit(None).cast("int"), F.lit(6.0)), low=M.history_level(F.lit(None), F.lit(None)))
    assert (r.none, r.up, r.low) == (0.0, 2.0, "low")


def test_age_modes(spark):
    ref = ts("2026-01-31 00:00:00")
    r = one(spark, a=M.age_bucket(F.lit(None).cast("timestamp_ntz"), ref), b=M.age_bucket(F.lit(None).cast("timestamp_ntz"), ref, "old_30d_plus"), c=M.age_bucket_offline(F.lit(None).cast("timestamp_ntz"), ts("2026-01-24 00:00:00"), ref))
    assert (r.a, r.b, r.c) == ("unknown", "old_30d_plus", "recent_4_7d")


def test_rates(spark):
    r = one(spark, e=M.engagement_rate_pct(F.lit(300), F.lit(1), F.lit(1)), z=M.engagement_rate_pct(F.lit(0), F.lit(1), F.lit(1)), g=M.growth_pct(F.lit(0), F.lit(5)), m=M.change_pct(F.lit(3), F.lit(0)), c=M.change_pct(F.lit(110), F.lit(100)))
    assert (r.e, r.z, r.g, r.m, r.c) == (0.6667, 0.0, None, None, 10.0)


def test_gates(spark):
    r = one(spark, a=M.onboarding_gate(F.lit(1), F.lit("youtube"), F.lit(None).cast("boolean"), F.lit("c")), b=M.onboarding_gate(F.lit(1), F.lit("youtube"), F.lit(False), F.lit("c")), h=M.health_status(F.lit(30.0)), k=M.health_status(F.lit(121.0)))
    assert (r.a, r.b, r.h, r.k) == (None, "inactive", "ok", "nok")


def test_brazilian_numbers(spark):
    cells = F.array(F.lit("A) 187.313"), F.lit("-9,23%"), F.lit("--"), F.lit("187313"))
    r = one(spark, n=T.br_numbers(cells), v=T.first_volume(T.br_numbers(cells)), i=T.parse_int_br(F.lit("187.313")), d=T.parse_decimal_br(F.lit("-9,23%")), dash=T.parse_int_br(F.lit("--")))
    assert r.n == ["187.313", "-9,23", "187", "313"] and (r.v, r.i, r.d, r.dash) == ("187.313", 187313, -9.23, None)


def test_names_and_periods(spark):
    r = one(
        spark, a=T.normalized_name(F.lit("  São João ")), b=T.normalize_key(F.lit("D) Ônibus")), c=T.normalize_label(F.lit("Caminhões  X")), d=T.reference_period(F.lit("market/2026/04/2026_04_02.pdf")),
        e=T.reference_period(F.lit("x/2026_13.pdf")), f=T.safe_filename(F.lit(" a/b?c ")), y=T.year_of(F.lit("model 1998 and 2001")), n=T.normalize_text(F.lit("a  b\n c ")),
    )
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.y, r.n) == ("sao joao", "d onibus", "caminhoes x", date(2026, 4, 1), None, "a_b_c", "1998", "a b c")


def test_urls(spark):
    base = F.lit("http://a.b/c/d.asp?fabricante=Fiat&x=1")
    r = one(
        spark, rel=T.resolve_link(base, F.lit("e.asp?y=2")), root=T.resolve_link(base, F.lit("\\z")), q=T.resolve_link(base, F.lit("?k=1")), ab=T.resolve_link(base, F.lit("https://x/y")), p=T.query_param(base, "FABRICANTE"),
        n=T.page_number(F.lit("http://a/?pagina=x&page=4")), s=T.same_catalog_signature(base, F.lit("http://a.b/q?fabricante=fiat")), t=T.same_catalog_signature(base, F.lit("http://a.b/q?fabricante=ford")), err=T.is_error_url(F.lit("http://a/Erro.asp?x")),
    )
    assert (r.rel, r.root, r.q, r.ab, r.p, r.n, r.s, r.t, r.err) == ("http://a.b/c/e.asp?y=2", "http://a.b/z", "http://a.b/c/d.asp?k=1", "https://x/y", "Fiat", 4, True, False, True)


def test_sql_forms_agree(spark):
    M.register_sql_functions(spark)
    r = spark.sql("SELECT post_priority(1, 2, NULL) AS p, priority_band(300000D) AS b, post_priority_v2(1D, 2D, 3D, 'partial') AS v").first()
    assert r.p == 21.0 and r.b == 5 and abs(r.v - 1.4) < 1e-12
