"""Report packs in full: creator growth with acceleration and rank, the market's six categories and fact pack, batch profiles, coverage lists, discovery runs, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.operators.materialize import create_table_as
from tidemark.operators.ranks import small
from tidemark.operators.relational import endpoints, first_rows, upsert
from tidemark.plans.dashboard_jobs import CREATOR_CTE, creator_summary
from tidemark.plans.layer_jobs import video_responses
from tidemark.plans.market_jobs import SERIES_CTE, registration_summary
from tidemark.plans.queue_jobs import BATCH2_CTE, COVERAGE_CTE, batch_comparison, coverage, hours, post_features
from tidemark.plans.registry import query
from tidemark.plans.resume_jobs import folder, ranked_creators
from tidemark.sources import readers
from tidemark.sources.tables import Tables

col = F.col


GROWTH_CTE = """
visible AS (SELECT * FROM ehist WHERE creator_id % 9 <> 0),
two AS (SELECT creator_id, since, {'t': min(collected_at), 'f': min_by(followers, (collected_at, id))} AS a, {'t': max(collected_at), 'f': max_by(followers, (collected_at, id)), 'v': max_by(views, (collected_at, id)) - min_by(views, (collected_at, id))} AS b
  FROM visible, (VALUES (TIMESTAMP '2024-01-24 00:00:00', TIMESTAMP '2024-01-31 00:00:00'), (TIMESTAMP '2024-01-17 00:00:00', TIMESTAMP '2024-01-24 00:00:00')) w(since, until) WHERE collected_at >= since AND collected_at < until GROUP BY 1, 2),
rate AS (SELECT creator_id, since, b.f - a.f AS delta, CASE WHEN a.f > 0 THEN round((b.f - a.f)::DECIMAL(38,10) * 100 / a.f, 4)::DOUBLE END AS pct, (b.f - a.f) / (epoch_us(b.t - a.t) / 8.64e10) AS a_day, b.v AS views FROM two WHERE b.t > a.t)
"""


def follower_rates(t: Tables, history: DataFrame, until, values=("followers", "views")) -> DataFrame:
    """Growth of each creator in the week before a time: absolute, percent, a day, and of views."""
    week = history.where(col("collected_at") < until)
    e = endpoints(week, "creator_id", "collected_at", "id", list(values), until - hours(168))
    delta = col("latest_followers") - col("first_followers")
    days = M.seconds_between(col("latest_collected_at"), col("first_collected_at")) / 86400
    return e.select("creator_id", delta.alias("follower_delta"), M.growth_pct(col("first_followers"), col("latest_followers")).alias("follower_pct"), (delta / days).alias("followers_a_day"), (col("latest_views") - col("first_views")).alias("views_delta"))


@query(
    "q45_emerging_creators",
    """SELECT creator_id, follower_delta, follower_pct, followers_a_day, acceleration, views_delta, followers_a_view, hidden, CASE WHEN NOT hidden THEN row_number() OVER (PARTITION BY hidden ORDER BY follower_pct DESC NULLS LAST, creator_id) END AS emerging_rank FROM
  (SELECT n.creator_id, n.delta AS follower_delta, n.pct AS follower_pct, n.a_day AS followers_a_day, n.a_day - p.a_day AS acceleration, n.views AS views_delta, CASE WHEN n.views > 0 THEN n.delta / n.views END AS followers_a_view, false AS hidden
   FROM rate n LEFT JOIN rate p ON p.creator_id = n.creator_id AND p.since < n.since WHERE n.since = TIMESTAMP '2024-01-24 00:00:00'
   UNION ALL SELECT DISTINCT creator_id, NULL, NULL, NULL, NULL, NULL, NULL, true FROM ehist WHERE creator_id % 9 = 0 AND collected_at >= TIMESTAMP '2024-01-24 00:00:00') QUALIFY hidden OR emerging_rank <= 200""",
    GROWTH_CTE,
    six_digits="followers_a_day acceleration followers_a_view",
)
def q45_emerging(t, most: int = 200):
    """The creators whose audience grows fastest, with acceleration against the week before and growth for each new view; nothing is told of those with hidden counts."""
    history = t.event_history.select("id", "creator_id", "collected_at", "followers", "views")
    hidden = col("creator_id") % 9 == 0  # the landed channels' flag
    shown = history.where(~hidden)
    until = t.as_of_events
    now, before = follower_rates(t, shown, until), follower_rates(t, shown, until - hours(168)).select("creator_id", col("followers_a_day").alias("before"))
    x = now.join(before, "creator_id", "left")
    a_view = F.when(col("views_delta") > 0, col("follower_delta") / col("views_delta"))
    cols = ["creator_id", "follower_delta", "follower_pct", "followers_a_day", (col("followers_a_day") - col("before")).alias("acceleration"), "views_delta", a_view.alias("followers_a_view"), F.lit(False).alias("hidden")]
    ranked = first_rows(x.select(*cols), [col("follower_pct").desc_nulls_last(), col("creator_id")], most, rank="emerging_rank").withColumn("emerging_rank", col("emerging_rank").cast("long"))
    secret = history.where(hidden & (col("collected_at") >= until - hours(168))).select("creator_id").distinct()
    return ranked.unionByName(secret.select("creator_id", *[F.lit(None).cast(ranked.schema[c].dataType).alias(c) for c in ranked.columns if c not in ("creator_id", "hidden")], F.lit(True).alias("hidden")))


#: The six categories of the monthly report, in its order, as the series of part types has them.
CATEGORIES = ("economy", "small", "medium", "promo", "standard", "large")
CATEGORY_CTE = f"""{SERIES_CTE.strip()},
cat AS (SELECT reference_period, list_position({list(CATEGORIES)}, string_split(segment_code, '_')[-1]) AS sort_key, string_split(segment_code, '_')[-1] AS category, sum(mes_atual)::BIGINT AS units FROM registrations WHERE segment_code <> 'total' GROUP BY ALL)
"""


@query(
    "q46_six_categories",
    """SELECT sort_key::INTEGER AS sort_key, category, max(reference_period) AS last_month, max_by(units, reference_period) AS units, (sum(units) FILTER (year(reference_period) = (SELECT max(year(reference_period)) FROM cat c WHERE c.category = cat.category)))::BIGINT AS ytd,
  list(units ORDER BY reference_period) AS months FROM cat WHERE sort_key IS NOT NULL GROUP BY 1, 2""",
    CATEGORY_CTE,
)
def q46_six(t):
    """A block for each category: last month, year to date, the series of months, in the report's order."""
    kind = F.element_at(F.split("segment_code", "_"), -1)
    place = F.array_position(F.array(*map(F.lit, CATEGORIES)), col("category"))
    x = t.registrations.where("segment_code <> 'total'").groupBy("reference_period", kind.alias("category")).agg(F.sum("mes_atual").alias("units"))
    x = x.where(col("category").isin(*CATEGORIES))
    last = x.groupBy("category").agg(F.max(F.year("reference_period")).alias("year"))
    x = x.join(last, "category").groupBy("category").agg(
        F.max("reference_period").alias("last_month"),
        F.max_by("units", "reference_period").alias("units"),
        F.sum(F.when(F.year("reference_period") == col("year"), col("units"))).alias("ytd"),
        F.transform(F.sort_array(F.collect_list(F.struct("reference_period", "units"))), lambda m: m["units"]).alias("months"),  # a row a month
    )
    return x.select(place.cast("int").alias("sort_key"), "*")


MODELS_CTE = f"""{SERIES_CTE.strip()},
sold AS (SELECT date_trunc('month', l_shipdate)::DATE AS m, p_brand AS brand, p_name AS model, l_quantity::BIGINT AS n, o_orderpriority <> '1-URGENT' AS retail FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey),
lastm AS (SELECT max(m) AS m FROM sold),
brands AS (SELECT brand, sum(n)::BIGINT AS units FROM sold WHERE m = (SELECT m FROM lastm) GROUP BY 1 ORDER BY units DESC, brand LIMIT 3),
models AS (SELECT model, brand, sum(n)::BIGINT AS units FROM sold WHERE m = (SELECT m FROM lastm) GROUP BY 1, 2 ORDER BY units DESC, model, brand LIMIT 5),
tot AS (SELECT * FROM pct WHERE segment_code = 'total' AND reference_period = (SELECT m FROM lastm)),
prior AS (SELECT sum(mes_atual)::BIGINT AS ytd FROM registrations WHERE segment_code = 'total' AND year(reference_period) = (SELECT year(m) - 1 FROM lastm) AND month(reference_period) <= (SELECT month(m) FROM lastm)),
mix AS (SELECT round(sum(n) FILTER (retail)::DECIMAL(38,10) * 100 / sum(n), 2)::DOUBLE AS share FROM sold WHERE m = (SELECT m FROM lastm))
"""


@query(
    "q47_fact_pack_row",
    """SELECT strftime(t.reference_period, '%Y-%m') AS month_target, t.mes_atual AS total, t.lag_1 AS previous, t.mes_atual - t.lag_1 AS delta_abs, t.mom_pct AS delta_pct, mix.share AS retail_share_pct, round(100 - mix.share, 2) AS direct_share_pct,
  (SELECT list(brand || '|' || units ORDER BY units DESC, brand) FROM brands) AS top_brands, (SELECT list(model || '|' || brand || '|' || units ORDER BY units DESC, model, brand) FROM models) AS top_models, t.ytd AS ytd, prior.ytd AS prior_ytd,
  abs(t.yoy_pct) >= 10 AS rule_10pct, t.lag_12 AS same_month_prior_year, t.yoy_pct AS delta_same_month_pct,
  [y FOR y IN [CASE WHEN t.lag_1 IS NULL THEN 'totals.previous' END, CASE WHEN t.lag_12 IS NULL THEN 'rule_10pct.same_month_prior_year' END, CASE WHEN prior.ytd IS NULL THEN 'ytd.prior_ytd' END, 'totals.forecast'] IF y IS NOT NULL] AS missing_required_items FROM tot t, mix, prior""",
    MODELS_CTE,
)
def q47_row(t):
    """One nested row of facts for the latest month; what is required and not there is null and named."""
    p = t.raw("part").select(col("p_partkey").alias("l_partkey"), col("p_brand").alias("brand"), col("p_name").alias("model"))
    o = t.raw("orders").select(col("o_orderkey").alias("l_orderkey"), (col("o_orderpriority") != "1-URGENT").alias("retail"))
    last = F.broadcast(t.raw("lineitem").agg(F.trunc(F.max("l_shipdate"), "month").alias("m")))  # one row
    sold = t.raw("lineitem").select("l_partkey", "l_orderkey", F.trunc("l_shipdate", "month").alias("m"), col("l_quantity").cast("long").alias("n")).join(last, "m").join(p, "l_partkey").join(o, "l_orderkey")
    units = sold.groupBy("model", "brand", "retail").agg(F.sum("n").alias("n"))

    def top(by: list[str], k: int, name: str) -> DataFrame:
        rows = units.groupBy(*by).agg(F.sum("n").alias("units")).orderBy(col("units").desc(), *by).limit(k)
        entry = F.struct((-col("units")).alias("o"), *by, "units")
        return rows.agg(F.transform(F.sort_array(F.collect_list(entry)), lambda r: F.concat_ws("|", *[r[c] for c in by], r["units"].cast("string"))).alias(name))

    share = F.round(F.sum(F.when(col("retail"), col("n"))).cast("decimal(28,6)") * 100 / F.sum("n"), 2).cast("double")
    mix = units.agg(share.alias("retail_share_pct"))
    x = registration_summary(t).where("segment_code = 'total'").join(last, col("reference_period") == col("m"))
    years = t.registrations.where("segment_code = 'total'").join(last, (F.year("reference_period") == F.year("m") - 1) & (F.month("reference_period") <= F.month("m")))
    one = x.crossJoin(mix).crossJoin(years.agg(F.sum("mes_atual").alias("prior_ytd"))).crossJoin(top(["brand"], 3, "top_brands")).crossJoin(top(["model", "brand"], 5, "top_models"))  # one row each
    absent = {"totals.previous": col("lag_1"), "rule_10pct.same_month_prior_year": col("lag_12"), "ytd.prior_ytd": col("prior_ytd"), "totals.forecast": F.lit(None)}
    return one.select(
        F.date_format("reference_period", "yyyy-MM").alias("month_target"),
        col("mes_atual").alias("total"),
        col("lag_1").alias("previous"),
        (col("mes_atual") - col("lag_1")).alias("delta_abs"),
        col("mom_pct").alias("delta_pct"),
        "retail_share_pct",
        F.round(100 - col("retail_share_pct"), 2).alias("direct_share_pct"),
        "top_brands",
        "top_models",
        "ytd",
        "prior_ytd",
        (F.abs("yoy_pct") >= 10).alias("rule_10pct"),
        col("lag_12").alias("same_month_prior_year"),
        col("yoy_pct").alias("delta_same_month_pct"),
        F.array_compact(F.array(*[F.when(c.isNull(), name) for name, c in absent.items()])).alias("missing_required_items"),
    )


@query(
    "q35_batch_profile",
    """SELECT side, coverage_status, history_level, priority_band, count(*) AS posts FROM (SELECT post_id, CASE WHEN a.batch_rank IS NULL THEN 'right_only' WHEN b.batch_rank IS NULL THEN 'left_only' ELSE 'both' END AS side, coalesce(b.priority_band_v2, a.priority_band) AS priority_band
    FROM (FROM batch WHERE batch_rank <= 50) a FULL JOIN (FROM batch2 WHERE batch_rank <= 40) b USING (post_id)) LEFT JOIN (SELECT post_id, coverage_status FROM cov) USING (post_id) LEFT JOIN (SELECT post_id, history_level FROM pf) USING (post_id) GROUP BY ALL""",
    BATCH2_CTE.strip().strip(",") + ", " + COVERAGE_CTE,
)
def q35_profile(t):
    """Who is in either batch: by coverage, level of history and band."""
    sides = batch_comparison(t).select("post_id", "side", F.coalesce("priority_band_v2_b", "priority_band_a").alias("priority_band"))
    sides = create_table_as(sides, "sides")  # two batches: 90 rows at most
    of = lambda df: F.broadcast(df.join(F.broadcast(sides.select("post_id")), "post_id", "left_semi"))
    kinds, levels = of(coverage(t).select("post_id", "coverage_status")), of(post_features(t).select("post_id", "history_level"))
    return sides.join(kinds, "post_id", "left").join(levels, "post_id", "left").groupBy("side", "coverage_status", "history_level", "priority_band").agg(F.count("*").alias("posts"))


@query("q37_coverage_counts", "SELECT coverage_status, checks AS total_checagens, count(*) AS total_posts FROM cov GROUP BY ALL", COVERAGE_CTE)
def q37_counts(t):
    return coverage(t).groupBy("coverage_status", col("checks").alias("total_checagens")).agg(F.count("*").alias("total_posts"))


@query(
    "q37_coverage_topk",
    """SELECT post_id, total_checagens, priority_score, priority_band, rank FROM (SELECT c.post_id, c.checks AS total_checagens, q.priority_score,
   CASE WHEN q.priority_score >= 700000 THEN 6 WHEN q.priority_score >= 300000 THEN 5 WHEN q.priority_score >= 150000 THEN 4 WHEN q.priority_score >= 50000 THEN 3 WHEN q.priority_score >= 10000 THEN 2 ELSE 1 END AS priority_band,
   row_number() OVER (ORDER BY c.checks, c.created_at, q.priority_score DESC NULLS LAST, c.post_id) AS rank FROM cov c LEFT JOIN queue q USING (post_id) WHERE c.checks < 3) WHERE rank <= 4""",
    COVERAGE_CTE,
)
def q37_topk(t, slots: int = 4):
    """The posts that the guardrail's slots go to first."""
    low = coverage(t).where("checks < 3").select("post_id", "created_at", col("checks").alias("total_checagens")).join(t.queue.select("post_id", "priority_score"), "post_id", "left")
    order = [col("total_checagens"), col("created_at"), col("priority_score").desc_nulls_last(), col("post_id")]
    return first_rows(low, order, slots).select("post_id", "total_checagens", "priority_score", M.priority_band(col("priority_score")).alias("priority_band"), "rank")


@query(
    "q33_many_checks",
    "SELECT post_id, count(*) AS total_checagens, max(views) AS views FROM ehist GROUP BY 1 HAVING count(*) >= 50",
)
def q33_many(t):
    return t.event_history.groupBy("post_id").agg(F.count("*").alias("total_checagens"), F.max("views").alias("views")).where("total_checagens >= 50")


@query(
    "q33_few_checks_high_score",
    "SELECT post_id, total_checagens, priority_score FROM (SELECT s.post_id, s.checks AS total_checagens, q.priority_score, row_number() OVER (ORDER BY q.priority_score DESC NULLS LAST, s.post_id) AS r FROM scored s JOIN queue q USING (post_id) WHERE s.checks <= 2) WHERE r <= 100",
)
def q33_few(t):
    few = t.post_rows.where(M.or0(col("total_checagens")) <= 2).select("post_id", M.or0(col("total_checagens")).alias("total_checagens"), "priority_score")
    return first_rows(few, [col("priority_score").desc_nulls_last(), col("post_id")], 100).drop("rank")


@query("q52_value_counts", "SELECT 'p_brand' AS field, p_brand AS value, count(*) AS rows FROM part GROUP BY 2 UNION ALL SELECT 'p_size', p_size::VARCHAR, count(*) FROM part GROUP BY 2")
def q52_values(t):
    """How often each value of a layer's fields occurs, in one pass."""
    fields = ("p_brand", "p_size")
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), col(f).cast("string").alias("value")) for f in fields])).alias("x")
    return t.raw("part").select(pairs).groupBy("x.field", "x.value").agg(F.count("*").alias("rows"))


@query("q38_debt_by_label", "SELECT CASE bucket WHEN 'new_0_3d' THEN 1 WHEN 'recent_4_7d' THEN 2 WHEN 'warm_8_30d' THEN 3 ELSE 4 END AS ordem, bucket, count(*) AS posts FROM (SELECT CASE WHEN d <= 3 THEN 'new_0_3d' WHEN d <= 7 THEN 'recent_4_7d' WHEN d <= 30 THEN 'warm_8_30d' ELSE 'old_30d_plus' END AS bucket, checks FROM (SELECT *, epoch_us(TIMESTAMP '2001-08-01 06:00:00' - created_at) / 8.64e10 AS d FROM cov) JOIN queue USING (post_id)) WHERE checks < CASE WHEN bucket IN ('warm_8_30d', 'old_30d_plus') THEN 3 ELSE 2 END GROUP BY ALL ORDER BY ordem", COVERAGE_CTE)
def q38_labels(t):
    """Debt by age, in the order of the labels and not of their letters."""
    from tidemark.plans.queue_jobs import guardrail_debt

    labels = ("new_0_3d", "recent_4_7d", "warm_8_30d", "old_30d_plus")
    order = F.array_position(F.array(*map(F.lit, labels)), col("bucket")).cast("int")
    return guardrail_debt(t).groupBy("bucket").agg(F.count("*").alias("posts")).select(order.alias("ordem"), "bucket", "posts").orderBy("ordem")


@query("s21_export_rankings", "SELECT rank::VARCHAR AS rank, creator_id::VARCHAR AS creator_id, post_count::VARCHAR AS post_count FROM (SELECT creator_id, post_count, row_number() OVER (ORDER BY post_count DESC NULLS LAST, creator_id) AS rank FROM summary WHERE platform = 'youtube') WHERE rank <= 100", CREATOR_CTE)
def s21(t):
    """A ranking written as CSV with a header, and what a reader finds in it."""
    ranked = first_rows(creator_summary(t).where("platform = 'youtube'").select("creator_id", "post_count"), [col("post_count").desc_nulls_last(), col("creator_id")], 100)
    path = folder(t, "export")
    readers.write_layer(ranked.select("rank", "creator_id", "post_count").coalesce(1), path)  # a hundred rows
    return readers.read_layer(t.spark, path, ["rank", "creator_id", "post_count"])


RUN_CTE = """
asked AS (FROM creators ORDER BY id LIMIT 60 OFFSET 20),
came AS (SELECT c.id AS creator_id, o_orderkey, o_orderkey % 3 = 0 AS new FROM asked c JOIN orders ON o_custkey = c.id WHERE c.id % 11 <> 5 AND c.id % 9 <> 4)
"""


@query(
    "q23_run_summary",
    """SELECT (SELECT count(DISTINCT creator_id) FROM came) AS processed, (SELECT count(*) FROM asked WHERE id % 11 = 5) AS errors, [id || ': channel cannot be read' FOR id IN (SELECT list(id ORDER BY id)[1:10] FROM asked WHERE id % 11 = 5)] AS error_details, 20::BIGINT AS cursor,
  (SELECT CASE WHEN 80 >= count(*) THEN 0 ELSE 80 END FROM creators)::BIGINT AS next_cursor, (SELECT count(*) FROM creators) AS total_creators, (SELECT count(*) FROM asked WHERE id % 11 <> 5) AS snapshots, (SELECT count(*) FROM came WHERE new) AS posts_inserted, (SELECT count(*) FROM came WHERE NOT new) AS posts_updated""",
    RUN_CTE,
)
def q23_summary(t, size: int = 60, cursor: int = 20):
    """A discovery run over landed responses: creators of the cursor, a snapshot of each channel that can be read, posts inserted or updated, the first ten errors, and where the next run begins."""
    table = ranked_creators(t)
    batch, following = table.round_robin(cursor, size)
    batch = F.broadcast(batch.select(col("id").alias("creator_id")))  # a batch: size rows
    failed = batch.where("creator_id % 11 = 5")  # responses that are errors
    read = batch.where("creator_id % 11 <> 5")
    listed = read.where("creator_id % 9 <> 4")  # the others' channels list no uploads
    owner = t.raw("orders").select(F.concat(F.lit("p"), col("o_orderkey").cast("string")).alias("post_id"), col("o_custkey").alias("creator_id"))
    uploads = small(create_table_as(owner.join(listed, "creator_id"), "uploads"))  # of a batch's creators
    found = create_table_as(readers.normalize_video_details(video_responses(t)).join(uploads, "post_id").select("post_id", "creator_id", "title", "views"), "found")
    stored = t.posts.where("id % 3 <> 0").select("post_id", "creator_id", "title", "views")
    after = upsert(stored, small(found), ["post_id"])
    known = create_table_as(stored.select("post_id").join(small(found.select("post_id")), "post_id", "left_semi"), "known")
    changed = found.join(known.withColumn("known", F.lit(True)), "post_id", "left")
    counts = changed.agg(F.count_distinct("creator_id").alias("processed"), F.count_if(col("known").isNull()).alias("posts_inserted"), F.count_if("known").alias("posts_updated"))
    errors = failed.orderBy("creator_id").limit(10).agg(F.transform(F.sort_array(F.collect_list("creator_id")), lambda c: F.concat(c.cast("string"), F.lit(": channel cannot be read"))).alias("error_details"))
    ends = after.agg(F.count("*").alias("posts_after")).select((col("posts_after") - stored.count()).alias("grown"))
    one = counts.crossJoin(failed.agg(F.count("*").alias("errors"))).crossJoin(errors).crossJoin(read.agg(F.count("*").alias("snapshots"))).crossJoin(ends).where("grown = posts_inserted")  # one row each
    whole = {"cursor": cursor, "next_cursor": following, "total_creators": table.total}
    return one.drop("grown").withColumns({k: F.lit(v).cast("long") for k, v in whole.items()})
