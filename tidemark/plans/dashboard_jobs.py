"""Dashboards: creators, growth, data quality, failures, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.operators.relational import asof_join, endpoints
from tidemark.plans.queue_jobs import FEATURES_CTE, hours
from tidemark.plans.registry import query
from tidemark.sources.tables import Tables

col = F.col

CREATOR_CTE = """
roll AS (SELECT creator_id, count(*) AS post_count, coalesce(sum(views), 0)::BIGINT AS total_views, coalesce(sum(likes), 0)::BIGINT AS total_likes, coalesce(sum(comments), 0)::BIGINT AS total_comments,
   max(post_date) AS latest_post_date, max(collected_at) AS latest_collected_at FROM posts GROUP BY 1),
summary AS (SELECT e.id AS entity_id, e.name AS entity_name, e.niche, e.creator_type, c.id AS creator_id, c.platform, c.username, c.channel_id, coalesce(post_count, 0) AS post_count,
   coalesce(total_views, 0) AS total_views, coalesce(total_likes, 0) AS total_likes, coalesce(total_comments, 0) AS total_comments,
   CASE WHEN total_views > 0 THEN round((total_likes + total_comments)::DECIMAL(38,10) * 100 / total_views, 4)::DOUBLE ELSE 0 END AS engagement_rate_pct,
   latest_post_date, latest_collected_at, c.is_active FROM creators c JOIN entities e ON e.id = c.entity_id LEFT JOIN roll r ON r.creator_id = c.id)
"""


def creator_summary(t: Tables) -> DataFrame:
    """A row for each creator; creators without posts have zeros."""
    p = t.posts.groupBy("creator_id").agg(
        F.count("*").alias("post_count"),
        *[F.sum(c).alias(f"total_{c}") for c in ("views", "likes", "comments")],
        F.max("post_date").alias("latest_post_date"),
        F.max("collected_at").alias("latest_collected_at"),
    )
    e = t.entities.select(col("id").alias("entity_id"), col("name").alias("entity_name"), "niche", "creator_type")
    x = t.creators.withColumnRenamed("id", "creator_id").join(e, "entity_id").join(p, "creator_id", "left")
    for c in ("post_count", "total_views", "total_likes", "total_comments"):
        x = x.withColumn(c, M.or0(col(c)))
    return x.withColumn("engagement_rate_pct", M.engagement_rate_pct(col("total_views"), col("total_likes"), col("total_comments")))


SUMMARY = (
    "entity_id entity_name niche creator_type creator_id platform username channel_id post_count total_views total_likes total_comments engagement_rate_pct latest_post_date latest_collected_at is_active"
).split()


@query("q05_creator_summary", f"SELECT {', '.join(SUMMARY)} FROM summary", CREATOR_CTE)
def q05(t):
    return creator_summary(t).select(*SUMMARY)


@query("q54_creator_rankings", "SELECT creator_id, total_views, engagement_rate_pct, post_count, latest_collected_at FROM summary WHERE platform = 'youtube' ORDER BY total_views DESC, creator_id LIMIT 20", CREATOR_CTE)
def q54(t):
    top = creator_summary(t).where("platform = 'youtube'").orderBy(col("total_views").desc(), "creator_id").limit(20)
    return top.select("creator_id", "total_views", "engagement_rate_pct", "post_count", "latest_collected_at")


GROWTH_CTE = """
win AS (FROM ehist WHERE collected_at >= TIMESTAMP '2024-01-24 00:00:00'),
ends AS (SELECT post_id, min_by({'t': collected_at, 'v': views, 'l': likes, 'c': comments}, (collected_at, id)) AS a, max_by({'t': collected_at, 'v': views, 'l': likes, 'c': comments}, (collected_at, id)) AS b FROM win GROUP BY 1),
growth AS (SELECT post_id, p.creator_id, username, a.t AS first_collected_at, b.t AS latest_collected_at, a.v AS first_views, b.v AS latest_views, b.v - a.v AS views_delta_7d,
   CASE WHEN a.v > 0 THEN round((b.v - a.v)::DECIMAL(38,10) * 100 / a.v, 4)::DOUBLE END AS views_growth_pct_7d, b.l - a.l AS likes_delta_7d, b.c - a.c AS comments_delta_7d
   FROM ends JOIN eposts p USING (post_id) JOIN creators c ON c.id = p.creator_id WHERE b.t > a.t)
"""


def post_growth(t: Tables) -> DataFrame:
    """Growth between the first and the last snapshot of the last seven days."""
    e = endpoints(t.event_history, "post_id", "collected_at", "id", ["views", "likes", "comments"], t.as_of_events - hours(168))
    x = e.join(t.event_posts.select("post_id", "creator_id"), "post_id").join(t.creators.select(col("id").alias("creator_id"), "username"), "creator_id")
    for c in ("views", "likes", "comments"):
        x = x.withColumn(f"{c}_delta_7d", M.or0(col(f"latest_{c}")) - M.or0(col(f"first_{c}")))
    return x.withColumn("views_growth_pct_7d", M.growth_pct(col("first_views"), col("latest_views")))


GROWTH = "post_id creator_id username first_collected_at latest_collected_at first_views latest_views views_delta_7d views_growth_pct_7d likes_delta_7d comments_delta_7d".split()


@query("q06_post_growth_7d", f"SELECT {', '.join(GROWTH)} FROM growth", GROWTH_CTE)
def q06(t):
    return post_growth(t).select(*GROWTH)


@query("q55_growth_rankings", "SELECT post_id, username, views_delta_7d, views_growth_pct_7d FROM growth ORDER BY views_delta_7d DESC, views_growth_pct_7d DESC, post_id LIMIT 20", GROWTH_CTE)
def q55(t):
    return post_growth(t).orderBy(col("views_delta_7d").desc(), col("views_growth_pct_7d").desc(), "post_id").limit(20).select("post_id", "username", "views_delta_7d", "views_growth_pct_7d")


def data_quality(t: Tables) -> DataFrame:
    n = lambda df, name: df.agg(F.count("*").alias(name))
    p = t.posts.select("post_id", "collected_at")
    seen = p.select("post_id").join(t.checks, "post_id", "left")
    parts = seen.agg(
        F.count_if(col("last_snapshot_at").isNull()).alias("posts_without_history"),
        F.count_if(col("last_snapshot_at").isNull() | (col("last_snapshot_at") < t.as_of - hours(24))).alias("posts_stale_24h"),
    )
    null_at = p.agg(F.count_if(col("collected_at").isNull()).alias("posts_with_null_collected_at"))
    idle = n(t.creators.join(t.posts.select(col("creator_id").alias("id")), "id", "left_anti"), "creators_without_posts")
    x = parts.crossJoin(null_at).crossJoin(idle)  # one row each
    zero = [col(c) == 0 for c in ("posts_without_history", "posts_with_null_collected_at", "posts_stale_24h", "creators_without_posts")]
    return x.withColumn("is_analytics_ready", zero[0] & zero[1] & zero[2] & zero[3])


QUALITY_SQL = """(SELECT *, posts_without_history = 0 AND posts_with_null_collected_at = 0 AND posts_stale_24h = 0 AND creators_without_posts = 0 AS is_analytics_ready FROM
  (SELECT count(*) FILTER (last_snapshot_at IS NULL) AS posts_without_history, count(*) FILTER (last_snapshot_at IS NULL OR last_snapshot_at < TIMESTAMP '2001-07-31 06:00:00') AS posts_stale_24h,
     count(*) FILTER (collected_at IS NULL) AS posts_with_null_collected_at FROM posts LEFT JOIN checks USING (post_id)), (SELECT count(*) AS creators_without_posts FROM creators WHERE id NOT IN (SELECT creator_id FROM posts)))"""


@query("q07_data_quality_status", f"SELECT * FROM {QUALITY_SQL}")
def q07(t):
    return data_quality(t)


@query(
    "q53_overview_kpis",
    f"""SELECT active_creators, posts, views, mean_engagement, is_analytics_ready FROM (SELECT count(*) FILTER (is_active) AS active_creators, sum(post_count)::BIGINT AS posts, sum(total_views)::BIGINT AS views,
  round(avg(engagement_rate_pct) FILTER (post_count > 0), 6) AS mean_engagement FROM summary), {QUALITY_SQL}""",
    CREATOR_CTE,
)
def q53(t):
    x = creator_summary(t).agg(
        F.count_if("is_active").alias("active_creators"),
        F.sum("post_count").alias("posts"),
        F.sum("total_views").alias("views"),
        F.round(F.avg(F.when(col("post_count") > 0, col("engagement_rate_pct"))), 6).alias("mean_engagement"),
    )
    return x.crossJoin(data_quality(t).select("is_analytics_ready"))  # one row each


REVIEW = "post_id youtube_url failure_count first_failed_at last_failed_at last_success_at status created_at collected_at views likes comments".split()


@query("q08_unavailable_review", f"SELECT {', '.join(REVIEW)} FROM failures LEFT JOIN posts USING (post_id) WHERE status IN ('unavailable_candidate', 'unavailable')")
def q08(t):
    f = t.failures.where(col("status").isin("unavailable_candidate", "unavailable"))
    x = f.join(t.posts.drop("creator_id"), "post_id", "left")
    return x.orderBy("status", col("failure_count").desc(), col("last_failed_at").desc(), "post_id").select(*REVIEW)


@query(
    "q42_dead_post_status",
    """SELECT count(*) FILTER (status = 'unavailable') AS total_dead_posts, count(*) FILTER (status = 'unavailable' AND review IS NULL) AS pending_human_review, count(*) FILTER (review = 'confirmed_unavailable') AS confirmed_unavailable,
  count(*) FILTER (review = 'available_on_manual_check') AS available_on_manual_check, count(*) FILTER (review = 'unclear') AS unclear
  FROM (SELECT *, CASE substr(post_id, 2)::BIGINT % 4 WHEN 1 THEN 'confirmed_unavailable' WHEN 2 THEN 'available_on_manual_check' WHEN 3 THEN 'unclear' END AS review FROM failures)""",
)
def q42(t):
    f = reviewed(t)
    is_ = lambda s: F.count_if(col("human_review_status") == s).alias(s)
    dead = col("status") == "unavailable"
    return f.agg(
        F.count_if(dead).alias("total_dead_posts"),
        F.count_if(dead & col("human_review_status").isNull()).alias("pending_human_review"),
        is_("confirmed_unavailable"),
        is_("available_on_manual_check"),
        is_("unclear"),
    )


def reviewed(t: Tables) -> DataFrame:
    """Failures with a review column that follows from the post's number."""
    k = F.substring("post_id", 2, 20).cast("long") % 4
    review = F.when(k == 1, "confirmed_unavailable").when(k == 2, "available_on_manual_check").when(k == 3, "unclear")
    return t.failures.withColumn("human_review_status", review)


@query(
    "q61_review_kpis",
    """SELECT count(*) FILTER (status <> 'recovered' AND k = 0) AS pending, count(*) FILTER (failure_count >= 3) AS failures_3_plus, count(*) FILTER (k = 1 AND last_failed_at >= TIMESTAMP '2001-07-01 00:00:00' AND last_failed_at < TIMESTAMP '2001-08-02 00:00:00') AS confirmed_in_period
  FROM (SELECT *, substr(post_id, 2)::BIGINT % 4 AS k FROM failures)""",
)
def q61(t):
    r = col("human_review_status")
    period = (col("last_failed_at") >= F.lit("2001-07-01").cast("date")) & (col("last_failed_at") < F.date_add(F.lit("2001-08-01").cast("date"), 1))
    return reviewed(t).agg(
        F.count_if((col("status") != "recovered") & r.isNull()).alias("pending"),
        F.count_if(col("failure_count") >= 3).alias("failures_3_plus"),
        F.count_if((r == "confirmed_unavailable") & period).alias("confirmed_in_period"),
    )


@query(
    "q48_dq_checks",
    """SELECT 'posts_without_history' AS check_name, post_id FROM posts WHERE post_id NOT IN (SELECT post_id FROM history) UNION ALL SELECT 'null_collected_at', post_id FROM posts WHERE collected_at IS NULL
  UNION ALL SELECT 'gap_24h', post_id FROM ehist GROUP BY post_id HAVING max(collected_at) < TIMESTAMP '2024-01-30 00:00:00'""",
)
def q48(t):
    named = lambda df, n: df.select(F.lit(n).alias("check_name"), "post_id")
    bare = t.post_rows.where("total_checagens IS NULL")  # counts the post's rows in the history
    last = t.raw("events").groupBy("user_id").agg(F.max("ts").cast("timestamp_ntz").alias("m"))
    gap = last.select(F.concat(F.lit("e"), col("user_id").cast("string")).alias("post_id"), "m").where(col("m") < t.as_of_events - hours(24))
    return named(bare, "posts_without_history").unionByName(named(t.posts.where("collected_at IS NULL"), "null_collected_at")).unionByName(named(gap, "gap_24h"))


@query("q60_last_snapshot", "SELECT max(collected_at) AS last_snapshot, count(*) AS snapshots, count(*) FILTER (collected_at >= TIMESTAMP '2024-01-30 00:00:00') AS last_day FROM ehist")
def q60(t):
    return t.event_history.agg(F.max("collected_at").alias("last_snapshot"), F.count("*").alias("snapshots"), F.count_if(col("collected_at") >= t.as_of_events - hours(24)).alias("last_day"))


@query(
    "q44_hot_now",
    """SELECT post_id, score - s6 AS delta_6h, (score - s6) / h6 AS velocity_6h, (s6 - s24) / (h24 - h6) AS previous_velocity, (score - s6) / h6 - (s6 - s24) / (h24 - h6) AS acceleration FROM
  (SELECT post_id, (views + 10 * likes + 20 * comments)::DOUBLE AS score, (s6.v + 10 * s6.l + 20 * s6.c)::DOUBLE AS s6, (s24.v + 10 * s24.l + 20 * s24.c)::DOUBLE AS s24, hours_6h AS h6, hours_24h AS h24 FROM ef WHERE s24 IS NOT NULL)
  WHERE h24 > h6 ORDER BY velocity_6h DESC, post_id LIMIT 50""",
    FEATURES_CTE,
    six_digits="velocity_6h previous_velocity acceleration",
)
def q44(t, limit: int = 50):
    """Posts that gain most in the last hours; posts without both earlier snapshots, or with one snapshot for both, have too little history."""
    x = asof_join(t.event_posts, t.event_history, "post_id", "collected_at", "collected_at", {"s6": hours(6), "s24": hours(24)}, ["views", "likes", "comments"], "id")
    score = lambda p: M.post_priority(*[col(f"{p}{c}") for c in ("views", "likes", "comments")])
    h = {s: M.hours_between(col("collected_at"), col(f"{s}.collected_at")) for s in ("s6", "s24")}
    now, before, acceleration = M.hot_now(score(""), score("s6."), h["s6"], score("s24."), h["s24"])
    x = x.where(col("s24").isNotNull() & (h["s24"] > h["s6"])).select("post_id", (score("") - score("s6.")).alias("delta_6h"), now.alias("velocity_6h"), before.alias("previous_velocity"), acceleration.alias("acceleration"))
    return x.orderBy(col("velocity_6h").desc(), "post_id").limit(limit)


@query(
    "q45_creator_growth",
    """SELECT creator_id, b.f - a.f AS follower_delta, CASE WHEN a.f > 0 THEN round((b.f - a.f)::DECIMAL(38,10) * 100 / a.f, 4)::DOUBLE END AS follower_pct, (b.f - a.f) / (epoch_us(b.t - a.t) / 8.64e10) AS followers_a_day
  FROM (SELECT creator_id, min_by({'t': collected_at, 'f': followers}, (collected_at, id)) AS a, max_by({'t': collected_at, 'f': followers}, (collected_at, id)) AS b FROM ehist WHERE collected_at >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY 1) WHERE b.t > a.t""",
    six_digits="followers_a_day",
)
def q45(t):
    e = endpoints(t.event_history, "creator_id", "collected_at", "id", ["followers"], t.as_of_events - hours(168))
    delta = col("latest_followers") - col("first_followers")
    days = M.seconds_between(col("latest_collected_at"), col("first_collected_at")) / 86400
    return e.select("creator_id", delta.alias("follower_delta"), M.growth_pct(col("first_followers"), col("latest_followers")).alias("follower_pct"), (delta / days).alias("followers_a_day"))


@query(
    "q65_collection_audit",
    """SELECT post_id, count(*) AS snapshots, max(gap) AS longest_gap_hours, count(*) FILTER (gap > 24) AS gaps_24h, count(*) FILTER (gap = 0) AS same_time FROM
  (SELECT post_id, epoch_us(collected_at - lag(collected_at) OVER (PARTITION BY post_id ORDER BY collected_at, id)) / 3.6e9 AS gap FROM ehist) GROUP BY 1""",
    six_digits="longest_gap_hours",
)
def q65(t):
    w = Window.partitionBy("post_id").orderBy("collected_at", "id")
    g = t.event_history.select("post_id", M.hours_between(col("collected_at"), F.lag("collected_at").over(w)).alias("gap"))
    return g.groupBy("post_id").agg(F.count("*").alias("snapshots"), F.max("gap").alias("longest_gap_hours"), F.count_if(col("gap") > 24).alias("gaps_24h"), F.count_if(col("gap") == 0).alias("same_time"))


@query(
    "q66_creator_weekly",
    """SELECT creator_id, sn.name AS sub_niche, date_trunc('week', post_date)::DATE AS week, count(*) AS posts, coalesce(sum(views), 0)::BIGINT AS views
  FROM posts JOIN creators c ON c.id = creator_id JOIN entity_sub_niches x ON x.entity_id = c.entity_id JOIN sub_niches sn ON sn.id = x.sub_niche_id WHERE c.is_active GROUP BY ALL""",
)
def q66(t):
    niche = t.entity_sub_niches.join(t.sub_niches.select(col("id").alias("sub_niche_id"), col("name").alias("sub_niche")), "sub_niche_id")
    c = t.creators.where("is_active").join(niche, "entity_id").select(col("id").alias("creator_id"), "sub_niche")
    week = F.trunc("post_date", "week").alias("week")
    return t.posts.join(c, "creator_id").groupBy("creator_id", "sub_niche", week).agg(F.count("*").alias("posts"), M.or0(F.sum("views")).alias("views"))


@query(
    "q10_onboarding_validation",
    """SELECT c.id AS creator_id, coalesce(n, 0) AS posts, coalesce(q, 0) AS queued, CASE WHEN coalesce(n, 0) = 0 THEN 'nok_no_posts' WHEN coalesce(q, 0) = 0 THEN 'nok_no_queue' WHEN coalesce(d, 0) <> n THEN 'atencao_dashboard_mismatch' ELSE 'ok' END AS status,
  CASE WHEN NOT c.is_active THEN 'inactive' END AS gate FROM creators c LEFT JOIN (SELECT creator_id, count(*) AS n, count(*) FILTER (post_id IN (SELECT post_id FROM queue WHERE needs_update)) AS q FROM posts GROUP BY 1) p ON p.creator_id = c.id
  LEFT JOIN (SELECT creator_id, post_count AS d FROM summary) s ON s.creator_id = c.id""",
    CREATOR_CTE,
)
def q10(t):
    queued = t.queue.where("needs_update").select("post_id", F.lit(True).alias("in_queue"))
    p = t.posts.select("creator_id", "post_id").join(queued, "post_id", "left").groupBy("creator_id").agg(F.count("*").alias("posts"), F.count_if("in_queue").alias("queued"))
    d = creator_summary(t).select("creator_id", col("post_count").alias("dash"))
    c = t.creators.withColumnRenamed("id", "creator_id").join(p, "creator_id", "left").join(d, "creator_id", "left")
    status = M.onboarding_status(col("creator_id"), col("posts"), col("queued"), col("dash"))
    gate = M.onboarding_gate(col("creator_id"), col("platform"), col("is_active"), col("channel_id"))
    return c.select("creator_id", M.or0(col("posts")).alias("posts"), M.or0(col("queued")).alias("queued"), status.alias("status"), gate.alias("gate"))
