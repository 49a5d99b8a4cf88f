"""Further outputs of the report packs: queue, coverage, rankings, audit, onboarding, entity links, discovery and market shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.functions import text as X
from tidemark.operators import pages as P
from tidemark.operators import relational as R
from tidemark.operators.ranks import exact_percentiles
from tidemark.plans.dashboard_jobs import CREATOR_CTE, creator_summary
from tidemark.plans.layer_jobs import video_responses
from tidemark.plans.queue_jobs import BATCH_CTE, eligible
from tidemark.plans.registry import query
from tidemark.plans.resume_jobs import ranked_creators
from tidemark.sources import readers
from tidemark.sources.tables import Tables

col = F.col


@query("c02_source_policy", "SELECT 'creator_history_source' AS rule, count(*) AS violations FROM events WHERE event_type = 'error'")
def c02(t):
    """Snapshots come from the API source only: those that a failed call left are violations."""
    source = F.when(col("event_type") == "error", "manual").otherwise("youtube_api")
    rows = t.raw("events").select(source.alias("source"))
    return readers.constraint_report([("creator_history_source", readers.outside(rows, "source", ("youtube_api",)))])


@query("q31_collections_5_days", "SELECT collected_at::DATE AS day, count(*) AS collections, count(DISTINCT post_id) AS posts FROM history WHERE collected_at >= (SELECT max(collected_at) FROM history) - INTERVAL 5 DAY GROUP BY 1")
def q31_days(t):
    last = t.history.agg(F.max("collected_at").alias("last"))  # one row
    rows = t.history.crossJoin(F.broadcast(last)).where(col("collected_at") >= col("last") - F.expr("INTERVAL 5 DAYS"))
    return rows.groupBy(F.to_date("collected_at").alias("day")).agg(F.count("*").alias("collections"), F.count_distinct("post_id").alias("posts"))


@query("q31_overdue", "SELECT count(*) AS overdue, min(next_check) AS oldest, max(next_check) AS newest FROM elig", BATCH_CTE)
def q31_overdue(t):
    return eligible(t).agg(F.count("*").alias("overdue"), F.min("next_check").alias("oldest"), F.max("next_check").alias("newest"))


@query("q32_eligible_now", "SELECT needs_update, next_check <= TIMESTAMP '2001-08-01 06:00:00' AS due, count(*) AS posts FROM queue GROUP BY ALL")
def q32_eligible(t):
    return t.queue.groupBy("needs_update", (col("next_check") <= t.as_of).alias("due")).agg(F.count("*").alias("posts"))


@query(
    "q32_queue_by_band",
    "SELECT CASE WHEN priority_score >= 700000 THEN 6 WHEN priority_score >= 300000 THEN 5 WHEN priority_score >= 150000 THEN 4 WHEN priority_score >= 50000 THEN 3 WHEN priority_score >= 10000 THEN 2 ELSE 1 END AS priority_band, count(*) AS posts, min(next_check) AS first_due FROM queue GROUP BY 1",
)
def q32_bands(t):
    return t.queue.groupBy(M.priority_band(col("priority_score")).alias("priority_band")).agg(F.count("*").alias("posts"), F.min("next_check").alias("first_due"))


@query(
    "q33_many_checks",
    "SELECT post_id, total_checagens, last_snapshot_at FROM checks WHERE total_checagens >= 6 ORDER BY total_checagens DESC, post_id LIMIT 100",
)
def q33_many(t, least: int = 6):
    return t.checks.where(col("total_checagens") >= least).orderBy(col("total_checagens").desc(), "post_id").limit(100)


@query(
    "q33_few_checks",
    "SELECT post_id, coalesce(total_checagens, 0) AS total_checagens, created_at, next_check FROM posts JOIN queue USING (post_id) LEFT JOIN checks USING (post_id) WHERE coalesce(total_checagens, 0) <= 2 AND needs_update",
)
def q33_few(t, most: int = 2):
    n = M.or0(col("total_checagens"))
    return t.post_rows.where("needs_update").where(n <= most).select("post_id", n.alias("total_checagens"), "created_at", "next_check")


@query("q33_fifo_by_band", "SELECT priority_band, min(next_check) AS first_due, max(next_check) AS last_due, count(*) AS posts, count(*) FILTER (last_checked IS NULL) AS never FROM elig GROUP BY 1 HAVING count(*) > 10", BATCH_CTE)
def q33_fifo(t):
    x = eligible(t).groupBy("priority_band").agg(F.min("next_check").alias("first_due"), F.max("next_check").alias("last_due"), F.count("*").alias("posts"), F.count_if(col("last_checked").isNull()).alias("never"))
    return x.where("posts > 10")


def _ranked(t: Tables, by: str, n: int = 20) -> DataFrame:
    return R.first_rows(creator_summary(t).where("platform = 'youtube'").select("creator_id", by), [col(by).desc_nulls_last(), col("creator_id")], n)


@query("q54_by_engagement", "SELECT creator_id, engagement_rate_pct, row_number() OVER (ORDER BY engagement_rate_pct DESC NULLS LAST, creator_id) AS rank FROM summary WHERE platform = 'youtube' ORDER BY rank LIMIT 20", CREATOR_CTE)
def q54_engagement(t):
    return _ranked(t, "engagement_rate_pct")


@query("q54_by_posts", "SELECT creator_id, post_count, row_number() OVER (ORDER BY post_count DESC NULLS LAST, creator_id) AS rank FROM summary WHERE platform = 'youtube' ORDER BY rank LIMIT 20", CREATOR_CTE)
def q54_posts(t):
    return _ranked(t, "post_count")


@query("q65_idle_creators", "SELECT id AS creator_id, username FROM creators WHERE is_active AND id NOT IN (SELECT creator_id FROM posts WHERE collected_at >= TIMESTAMP '1998-01-01' AND creator_id IS NOT NULL)")
def q65_idle(t):
    recent = t.posts.where(col("collected_at") >= F.lit("1998-01-01").cast("timestamp_ntz")).select("creator_id").distinct()
    return t.creators.where("is_active").withColumnRenamed("id", "creator_id").join(recent, "creator_id", "left_anti").select("creator_id", "username")


@query(
    "q65_view_outliers",
    "WITH s AS (SELECT post_id, views - lag(views) OVER (PARTITION BY post_id ORDER BY collected_at, id) AS step FROM ehist), q AS (SELECT quantile_cont(step, 0.25) AS a, quantile_cont(step, 0.75) AS b FROM s) SELECT post_id, count(*) AS outliers, max(step)::BIGINT AS largest FROM s, q WHERE step > b + 3 * (b - a) GROUP BY 1".replace("WITH s AS", "SELECT * FROM (WITH s AS") + ")",
)
def q65_outliers(t):
    """Steps of a post's views beyond three quartile ranges over the third quartile of all steps."""
    from pyspark.sql import Window

    w = Window.partitionBy("post_id").orderBy("collected_at", "id")
    steps = t.event_history.select("post_id", (col("views") - F.lag("views").over(w)).alias("step"))
    q = exact_percentiles(steps, [], "step", {"a": 0.25, "b": 0.75})  # one row
    far = steps.crossJoin(F.broadcast(q)).where(col("step") > col("b") + 3 * (col("b") - col("a")))
    return far.groupBy("post_id").agg(F.count("*").alias("outliers"), F.max("step").alias("largest"))


@query(
    "q66_creator_comparison",
    "SELECT niche, count(*) AS creators, coalesce(sum(post_count), 0)::BIGINT AS posts, coalesce(sum(total_views), 0)::BIGINT AS views, max(total_views) AS best FROM summary GROUP BY 1",
    CREATOR_CTE,
)
def q66_comparison(t):
    return creator_summary(t).groupBy("niche").agg(F.count("*").alias("creators"), M.or0(F.sum("post_count")).alias("posts"), M.or0(F.sum("total_views")).cast("long").alias("views"), F.max("total_views").alias("best"))


@query(
    "q10_onboarding_sample",
    "SELECT creator_id, post_id, post_date, views FROM posts JOIN creators c ON c.id = creator_id WHERE c.is_active AND collected_at IS NOT NULL ORDER BY post_date DESC, post_id LIMIT 50",
)
def q10_sample(t):
    active = t.creators.where("is_active").select(col("id").alias("creator_id"))
    rows = t.posts.where("collected_at IS NOT NULL").join(active, "creator_id", "left_semi")
    return rows.orderBy(col("post_date").desc(), "post_id").limit(50).select("creator_id", "post_id", "post_date", "views")


@query("q10_dashboard_row", "SELECT creator_id, post_count, total_views, latest_collected_at FROM summary WHERE creator_id IN (SELECT id FROM creators WHERE is_active)", CREATOR_CTE)
def q10_dashboard(t):
    active = t.creators.where("is_active").select(col("id").alias("creator_id"))
    return creator_summary(t).join(active, "creator_id", "left_semi").select("creator_id", "post_count", "total_views", "latest_collected_at")


@query("q12_link_list", "SELECT e.id AS entity_id, e.name, s.name AS sub_niche FROM entities e JOIN entity_sub_niches x ON x.entity_id = e.id JOIN sub_niches s ON s.id = x.sub_niche_id")
def q12_links(t):
    s = t.sub_niches.select(col("id").alias("sub_niche_id"), col("name").alias("sub_niche"))
    return t.entities.select(col("id").alias("entity_id"), "name").join(t.entity_sub_niches, "entity_id").join(s, "sub_niche_id").select("entity_id", "name", "sub_niche")


@query("q12_entities_without_niche", "SELECT id AS entity_id, name FROM entities WHERE id NOT IN (SELECT entity_id FROM entity_sub_niches)")
def q12_without(t):
    return t.entities.select(col("id").alias("entity_id"), "name").join(t.entity_sub_niches, "entity_id", "left_anti")


@query(
    "q23_discovery_run",
    """SELECT c.id AS creator_id, count(o_orderkey) AS found, count(o_orderkey) FILTER (o_orderkey % 3 = 0) AS added, CASE WHEN count(o_orderkey) = 0 THEN 'no_uploads' WHEN count(o_orderkey) FILTER (o_orderkey % 3 = 0) = 0 THEN 'nothing_new' ELSE 'ok' END AS outcome
  FROM (FROM creators ORDER BY id LIMIT 30 OFFSET 20) c LEFT JOIN orders ON o_custkey = c.id GROUP BY 1""",
)
def q23_run(t):
    """A discovery run over landed responses: the next creators of the cursor, their uploads, what is new against the stored posts, and an outcome for each."""
    batch, _ = ranked_creators(t).round_robin(20, 30)
    uploads = readers.normalize_video_details(video_responses(t))
    owner = t.raw("orders").select(F.concat(F.lit("p"), col("o_orderkey").cast("string")).alias("post_id"), col("o_custkey").alias("creator_id"))
    mine = uploads.join(owner, "post_id").join(F.broadcast(batch.select(col("id").alias("creator_id"))), "creator_id")  # a batch: 30 rows
    stored = t.raw("orders").where("o_orderkey % 3 <> 0").select(F.concat(F.lit("p"), col("o_orderkey").cast("string")).alias("post_id"), F.lit(True).alias("known"))
    counts = mine.join(stored, "post_id", "left").groupBy("creator_id").agg(F.count("*").alias("found"), F.count_if(col("known").isNull()).alias("added"))
    out = batch.select(col("id").alias("creator_id")).join(counts, "creator_id", "left").select("creator_id", M.or0(col("found")).alias("found"), M.or0(col("added")).alias("added"))
    return out.withColumn("outcome", F.when(col("found") == 0, "no_uploads").when(col("added") == 0, "nothing_new").otherwise("ok"))


@query("q63_create_creators", "SELECT id, entity_id, platform, username FROM creators UNION ALL SELECT 2000000000 + n_nationkey, n_nationkey, 'instagram', lower(n_name) FROM nation WHERE n_nationkey % 2 = 0")
def q63_create(t):
    """A creator for each resolved entity that has none on the platform."""
    new = t.entities.where("id % 2 = 0").select((col("id") + 2_000_000_000).cast("long").alias("id"), col("id").alias("entity_id"), F.lit("instagram").alias("platform"), F.lower("name").alias("username"))
    return R.insert_absent(t.creators.select("id", "entity_id", "platform", "username"), new, ["entity_id", "platform"])


@query(
    "q47_mix_share",
    "SELECT reference_period, segment_code, mes_atual, round(mes_atual::DECIMAL(38,12) * 100 / sum(mes_atual) OVER (PARTITION BY reference_period), 2)::DOUBLE AS share_pct FROM registrations WHERE segment_code <> 'total'",
)
def q47_share(t):
    parts = t.registrations.where("segment_code <> 'total'")
    totals = parts.groupBy("reference_period").agg(F.sum("mes_atual").alias("month"))
    share = F.round(col("mes_atual").cast("decimal(24,6)") * 100 / col("month").cast("decimal(12,0)"), 2).cast("double")
    return parts.join(totals, "reference_period").select("reference_period", "segment_code", "mes_atual", share.alias("share_pct"))


@query(
    "q47_year_to_date",
    """SELECT year(a.reference_period) AS year, sum(a.mes_atual)::BIGINT AS ytd, sum(b.mes_atual)::BIGINT AS prior_ytd, count(*) FILTER (b.mes_atual IS NULL) AS missing_months FROM registrations a LEFT JOIN registrations b
  ON b.segment_code = 'total' AND b.reference_period = a.reference_period - INTERVAL 1 YEAR WHERE a.segment_code = 'total' GROUP BY 1""",
)
def q47_ytd(t):
    """Each year to date against the same months of the year before, and how many of those are missing."""
    total = t.registrations.where("segment_code = 'total'").select("reference_period", "mes_atual")
    before = total.select(F.add_months("reference_period", 12).alias("reference_period"), col("mes_atual").alias("prior"))
    x = total.join(before, "reference_period", "left").groupBy(F.year("reference_period").alias("year"))
    return x.agg(F.sum("mes_atual").alias("ytd"), F.sum("prior").alias("prior_ytd"), F.count_if(col("prior").isNull()).alias("missing_months"))


@query(
    "q47_top_brands",
    "SELECT month, brand, units, rank FROM (SELECT date_trunc('month', l_shipdate)::DATE AS month, p_brand AS brand, sum(l_quantity::BIGINT)::BIGINT AS units, row_number() OVER (PARTITION BY date_trunc('month', l_shipdate) ORDER BY sum(l_quantity::BIGINT) DESC, p_brand) AS rank FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, date_trunc('month', l_shipdate)) WHERE rank <= 3",
)
def q47_brands(t):
    sold = t.raw("lineitem").join(t.raw("part").select(col("p_partkey").alias("l_partkey"), col("p_brand").alias("brand")), "l_partkey")
    units = sold.groupBy(F.trunc("l_shipdate", "month").alias("month"), "brand").agg(F.sum(col("l_quantity").cast("long")).alias("units"))
    return R.topk(units, ["month"], [col("units").desc(), col("brand")], 3)


def application_pages(t: Tables) -> DataFrame:
    """Pages of a part's applications: links to sheets with a code, whose text is in a font, in the title or in the link."""
    k = col("p_partkey").cast("string")
    label = F.when(col("p_partkey") % 3 == 0, F.concat(F.lit('<font color="darkred">'), "p_name", F.lit("</font> ver"))).when(col("p_partkey") % 3 == 1, F.lit("")).otherwise(col("p_name"))
    link = F.concat(F.lit('<a href="fichadetalhe.asp?codigo='), k, F.lit("&amp;fabricante="), F.url_encode("p_brand"), F.lit('" title="'), "p_brand", F.lit(" "), "p_name", F.lit('">'), label, F.lit("</a>"))
    broken = F.when(col("p_partkey") % 7 == 0, F.lit("<p>Ocorreu um erro</p>")).otherwise(F.lit(""))
    return t.spread("part", "p_partkey", "p_partkey", "p_name", "p_brand").select(
        col("p_partkey").alias("page_id"),
        F.concat(F.lit("https://h.example/c/catalogo.asp?anomod=2000&codigo="), k).alias("url"),
        F.concat(F.lit("<html><body>"), F.when(col("p_partkey") % 5 == 0, F.lit("no link")).otherwise(link), broken, F.lit("</body></html>")).alias("html"),
    )


@query("h07_application_links", "SELECT p_partkey AS page_id, p_partkey::VARCHAR AS codigo, p_brand AS fabricante, p_name AS aplicacao FROM part WHERE p_partkey % 5 <> 0")
def h07(t):
    links = P.page_links(application_pages(t)).withColumn("fabricante", X.query_param(col("url"), "fabricante"))
    return P.application_links(links).select("page_id", col("codigo_ficha").alias("codigo"), "fabricante", col("modelo_texto").alias("aplicacao"))


@query("h12_valid_year_pages", "SELECT p_partkey AS page_id, 'https://h.example/c/catalogo.asp?anomod=2000&codigo=' || p_partkey AS final_url FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0")
def h12(t):
    return P.valid_year_pages(application_pages(t)).select("page_id", "final_url")
