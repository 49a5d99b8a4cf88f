"""Scores, bands, ages and rates of measured posts, as Column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    """Fixed values of the scores and of the re-check rules."""

    # weights of views, likes, comments
    weights: tuple[int, int, int] = (1, 10, 20)
    # least score of bands 6, 5, 4, 3, 2
    band_cuts: tuple[int, ...] = (700_000, 300_000, 150_000, 50_000, 10_000)
    band_cuts_v2: tuple[int, ...] = (120, 90, 70, 50, 35)
    # minutes to the next check for bands 6 ... 1
    delays: tuple[int, ...] = (30, 60, 120, 240, 480, 720)
    # first-generation rule: least score, hours
    cuts_v0: tuple[int, ...] = (50_000, 20_000, 5_000)
    hours_v0: tuple[int, ...] = (1, 3, 6, 12)
    # least hours between checks of covered old posts: bands 5 and 6, other bands
    old_hours: tuple[int, int] = (12, 24)
    least_checks: int = 3
    quotas: tuple[int, ...] = (8, 8, 8, 7, 7, 6)
    batch: int = 50
    guardrail: int = 6
    quotas_v2: tuple[int, ...] = (8, 8, 8, 6, 6, 4)
    batch_v2: int = 40
    short_seconds: int = 270


POLICY = Policy()


def ladder(value: Column, cuts: tuple, results: list) -> Column:
    """results[i] for the first cuts[i] that value reaches, else the last result."""
    out = None
    for cut, result in zip(cuts, results, strict=False):
        out = F.when(value >= cut, result) if out is None else out.when(value >= cut, result)
    return out.otherwise(results[-1])


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds with fractions between two timestamps without zone."""
    return (later - earlier).cast("interval second").cast("decimal(20,6)").cast("double")


def hours_between(later: Column, earlier: Column) -> Column:
    return seconds_between(later, earlier) / 3600.0


def minutes(n: Column | int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n) if isinstance(n, int) else n)


def or0(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def round_half_up(value: Column, digits: int) -> Column:
    """Decimal rounding, half away from zero, then double."""
    return F.round(value.cast("decimal(38,12)"), digits).cast("double")


def post_priority(views: Column, likes: Column, comments: Column, p: Policy = POLICY) -> Column:
    return (or0(views) * p.weights[0] + or0(likes) * p.weights[1] + or0(comments) * p.weights[2]).cast("double")


def priority_band(score: Column, p: Policy = POLICY) -> Column:
    return ladder(score, p.band_cuts, [F.lit(k) for k in (6, 5, 4, 3, 2, 1)])


def base_delay(score: Column, cuts: tuple, p: Policy = POLICY) -> Column:
    return ladder(score, cuts, [minutes(m) for m in p.delays])


def next_check_simple(score: Column, checked_at: Column, p: Policy = POLICY) -> Column:
    return checked_at + base_delay(score, p.band_cuts, p)


def next_check_v0(score: Column, checked_at: Column, p: Policy = POLICY) -> Column:
    return checked_at + ladder(score, p.cuts_v0, [minutes(60 * h) for h in p.hours_v0])


def age_bucket(posted: Column, ref: Column, missing: str = "unknown") -> Column:
    """new, recent, warm or old at ref; missing: what a null date counts as ('unknown' by the rule, 'old_30d_plus' in reports)."""
    day = lambda n: minutes(24 * 60 * n)
    return (
        F.when(posted.isNull(), missing)
        .when(posted >= ref - day(3), "new_0_3d")
        .when(posted >= ref - day(7), "recent_4_7d")
        .when(posted >= ref - day(30), "warm_8_30d")
        .otherwise("old_30d_plus")
    )


def age_bucket_offline(posted: Column, created: Column, ref: Column) -> Column:
    """Age by fractional days, a missing date replaced by the creation time; limits belong to the younger bucket."""
    days = seconds_between(ref, F.coalesce(posted, created)) / 86400
    return F.when(days.isNull(), "unknown").when(days <= 3, "new_0_3d").when(days <= 7, "recent_4_7d").when(days <= 30, "warm_8_30d").otherwise("old_30d_plus")


def next_check(score: Column, checked_at: Column, posted: Column, checks: Column, p: Policy = POLICY) -> Column:
    """Delay by score; covered posts that are warm or old wait longer. A missing check time counts as 1970."""
    at = F.coalesce(checked_at, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    base = base_delay(score, p.band_cuts, p)
    aged = age_bucket(posted, at).isin("warm_8_30d", "old_30d_plus") & (or0(checks) >= p.least_checks)
    floor = F.when(priority_band(score, p) >= 5, minutes(60 * p.old_hours[0])).otherwise(minutes(60 * p.old_hours[1]))
    return at + F.when(aged, F.greatest(base, floor)).otherwise(base)


def base_popularity(views: Column, likes: Column, comments: Column, p: Policy = POLICY) -> Column:
    return sum((w * F.log(or0(c) + F.lit(1.0)) for w, c in zip(p.weights[1:], (likes, comments), strict=True)), F.log(or0(views) + F.lit(1.0)))


def velocity_raw(dv: Column, dl: Column, dc: Column, hours: Column, p: Policy = POLICY) -> Column:
    rate = lambda d: F.greatest(or0(d) / hours, F.lit(0.0))
    return F.when(hours > 0, p.weights[0] * rate(dv) + p.weights[1] * rate(dl) + p.weights[2] * rate(dc)).otherwise(0.0)


def velocity_score(raw: Column) -> Column:
    return F.log(F.greatest(or0(raw), F.lit(0.0)) + 1)


def acceleration_score(short: Column, long: Column) -> Column:
    return F.log(F.greatest(or0(short) - or0(long), F.lit(0.0)) + 1)


def history_level(at_6h: Column, at_24h: Column) -> Column:
    return F.when(at_6h.isNotNull() & at_24h.isNotNull(), "full").when(at_6h.isNotNull(), "partial").otherwise("low")


def post_priority_v2(base: Column, velocity: Column, acceleration: Column, level: Column) -> Column:
    return F.when(level == "full", 0.4 * base + 0.4 * velocity + 0.2 * acceleration).when(level == "partial", 0.6 * base + 0.4 * velocity).otherwise(base)


def priority_band_v2(score: Column, p: Policy = POLICY) -> Column:
    return ladder(score, p.band_cuts_v2, [F.lit(k) for k in (6, 5, 4, 3, 2, 1)])


def next_check_v2(score: Column, checked_at: Column, p: Policy = POLICY) -> Column:
    return checked_at + base_delay(score, p.band_cuts_v2, p)


def check_band(checks: Column) -> Column:
    return ladder(or0(checks), (500, 200, 50, 3), [F.lit(x) for x in ("overchecked_500_plus", "overchecked_200_499", "overchecked_50_199", "covered_3_49", "needs_coverage")])


def coverage_status(checks: Column, created: Column, as_of: Column) -> Column:
    old = lambda d: created < as_of - minutes(24 * 60 * d)
    return F.when(or0(checks) >= 3, "covered").when(old(7), "recovery_low").when(old(5), "at_risk_bootstrap").otherwise("bootstrap_low")


def low_type(created: Column, as_of: Column) -> Column:
    return F.when(created >= as_of - minutes(7 * 24 * 60), "bootstrap_low").otherwise("legacy_low")


def target_checks(bucket: Column) -> Column:
    return F.when(bucket.isin("warm_8_30d", "old_30d_plus"), 3).otherwise(2)


def engagement_rate_pct(views: Column, likes: Column, comments: Column) -> Column:
    ratio = (or0(likes) + or0(comments)).cast("decimal(20,0)") * 100 / views.cast("decimal(20,0)")
    return F.when(or0(views) > 0, F.round(ratio, 4).cast("double")).otherwise(0.0)


def growth_pct(first: Column, last: Column, digits: int = 4) -> Column:
    """(last - first) / first in percent; null unless first is positive."""
    return F.when(first > 0, F.round((or0(last) - first).cast("decimal(20,0)") * 100 / first.cast("decimal(20,0)"), digits).cast("double"))


def change_pct(value: Column, base: Column) -> Column:
    """Month-over-month or year-over-year change; null where the base is missing or 0."""
    return F.when(base != 0, F.round((value - base).cast("decimal(20,0)") * 100 / base.cast("decimal(20,0)"), 2).cast("double"))


def intake_review_result(normalized: Column, sub_niche_id: Column, entity_id: Column) -> Column:
    return (
        F.when(normalized.isNull() | (normalized == ""), "NORMALIZATION_MISSING")
        .when(sub_niche_id.isNull(), "SUB_NICHE_NOT_FOUND")
        .when(entity_id.isNotNull(), "ENTITY_ALREADY_EXISTS")
        .otherwise("READY_TO_INSERT")
    )


def onboarding_status(creator: Column, posts: Column, queued: Column, dashboard_posts: Column) -> Column:
    return (
        F.when(creator.isNull(), "nok_creator_not_found")
        .when(or0(posts) == 0, "nok_no_posts")
        .when(or0(queued) == 0, "nok_no_queue")
        .when(or0(dashboard_posts) != or0(posts), "atencao_dashboard_mismatch")
        .otherwise("ok")
    )


def onboarding_gate(creator: Column, platform: Column, active: Column, channel: Column) -> Column:
    """Reason that stops an onboarding; null if nothing does. Only an explicit false counts as inactive."""
    return (
        F.when(creator.isNull(), "creator_not_found")
        .when(~platform.eqNullSafe(F.lit("youtube")), "not_youtube")
        .when(active.eqNullSafe(F.lit(False)), "inactive")
        .when(channel.isNull() | (channel == ""), "missing_channel_id")
    )


def health_status(age_minutes: Column) -> Column:
    return F.when(age_minutes <= 30, "ok").when(age_minutes <= 120, "atencao").otherwise("nok")


def iso_duration_seconds(text: Column) -> Column:
    """PT#H#M#S at the start; anything else, days too, is 0."""
    part = lambda k: F.coalesce(F.regexp_extract(text, "^PT(?:(\\d+)H)?(?:(\\d+)M)?(?:(\\d+)S)?", k).try_cast("long"), F.lit(0))
    return F.coalesce(part(1) * 3600 + part(2) * 60 + part(3), F.lit(0))


def video_type(seconds: Column, title: Column, p: Policy = POLICY) -> Column:
    return F.when((seconds <= p.short_seconds) | F.lower(F.coalesce(title, F.lit(""))).contains("#shorts"), "short").otherwise("long")


def hot_now(score: Column, score_6h: Column, hours_6h: Column, score_24h: Column, hours_24h: Column) -> tuple[Column, Column, Column]:
    """(velocity over the last 6 h, velocity before, acceleration) of the linear score, an hour."""
    now = F.when(hours_6h > 0, (score - score_6h) / hours_6h)
    before = F.when(hours_24h - hours_6h > 0, (score_6h - score_24h) / (hours_24h - hours_6h))
    return now, before, now - before


def _delay_sql(cuts: tuple) -> str:
    """Minutes to the next check by the score s, as SQL."""
    return f"CASE {' '.join(f'WHEN s >= {c} THEN {m}' for c, m in zip(cuts, POLICY.delays, strict=False))} ELSE {POLICY.delays[-1]} END"


#: SQL forms of the scalar functions.
SQL_FUNCTIONS = {
    "post_priority": ("v BIGINT, l BIGINT, c BIGINT", "DOUBLE", "CAST(coalesce(v, 0) + coalesce(l, 0) * 10 + coalesce(c, 0) * 20 AS DOUBLE)"),
    "priority_band": ("s DOUBLE", "INT", "CASE WHEN s >= 700000 THEN 6 WHEN s >= 300000 THEN 5 WHEN s >= 150000 THEN 4 WHEN s >= 50000 THEN 3 WHEN s >= 10000 THEN 2 ELSE 1 END"),
    "base_popularity_v2": ("v BIGINT, l BIGINT, c BIGINT", "DOUBLE", "ln(coalesce(v, 0) + 1.0D) + 10 * ln(coalesce(l, 0) + 1.0D) + 20 * ln(coalesce(c, 0) + 1.0D)"),
    "priority_band_v2": ("s DOUBLE", "INT", "CASE WHEN s >= 120 THEN 6 WHEN s >= 90 THEN 5 WHEN s >= 70 THEN 4 WHEN s >= 50 THEN 3 WHEN s >= 35 THEN 2 ELSE 1 END"),
    "velocity_score_v2": ("r DOUBLE", "DOUBLE", "ln(greatest(coalesce(r, 0), 0) + 1)"),
    "acceleration_score_v2": ("s DOUBLE, l DOUBLE", "DOUBLE", "ln(greatest(coalesce(s, 0) - coalesce(l, 0), 0) + 1)"),
    "post_priority_v2": (
        "b DOUBLE, v DOUBLE, a DOUBLE, level STRING",
        "DOUBLE",
        "CASE level WHEN 'full' THEN 0.4D * b + 0.4D * v + 0.2D * a WHEN 'partial' THEN 0.6D * b + 0.4D * v ELSE b END",
    ),
    "next_check": ("s DOUBLE, checked TIMESTAMP_NTZ", "TIMESTAMP_NTZ", f"checked + make_dt_interval(0, 0, {_delay_sql(POLICY.band_cuts)})"),
    "next_check_v2": ("s DOUBLE, checked TIMESTAMP_NTZ", "TIMESTAMP_NTZ", f"checked + make_dt_interval(0, 0, {_delay_sql(POLICY.band_cuts_v2)})"),
    "next_check_by_age": (
        "s DOUBLE, checked TIMESTAMP_NTZ, posted TIMESTAMP_NTZ, checks BIGINT",
        "TIMESTAMP_NTZ",
        f"coalesce(checked, TIMESTAMP_NTZ'1970-01-01 00:00:00') + make_dt_interval(0, 0, CASE WHEN coalesce(checks, 0) >= 3 AND posted < coalesce(checked, TIMESTAMP_NTZ'1970-01-01 00:00:00') - INTERVAL '7' DAY"
        f" THEN greatest({_delay_sql(POLICY.band_cuts)}, CASE WHEN s >= 300000 THEN 720 ELSE 1440 END) ELSE {_delay_sql(POLICY.band_cuts)} END)",
    ),
}


def register_sql_functions(spark: SparkSession) -> None:
    for name, (args, kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")
