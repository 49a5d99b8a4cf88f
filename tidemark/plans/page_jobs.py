"""Catalogue and discovery jobs over stored pages and landed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.operators import pages as P
from tidemark.operators.relational import topk
from tidemark.plans.registry import query
from tidemark.plans.resume_jobs import ranked_creators
from tidemark.sources.readers import constraint_report, duplicates, orphans, outside

col = F.col

LINKS_CTE = r"""
lk AS (SELECT page_id, url AS from_url, unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"[^>]*>', 1)) AS href FROM pages)
"""


@query("q28_catalog_links", "SELECT page_id, count(*) AS links, count(DISTINCT href) AS targets, min(href) AS first_target FROM lk GROUP BY 1", LINKS_CTE)
def q28(t):
    links = P.page_links(t.spread("pages", "page_id"))
    return links.groupBy("page_id").agg(F.count("*").alias("links"), F.count_distinct("href").alias("targets"), F.min("href").alias("first_target"))


@query(
    "q28_absolute_links",
    r"SELECT page_id, min(regexp_extract(from_url, '^([a-z]+://[^/?#]+)', 1) || href) AS least_url, max(regexp_extract(from_url, '^([a-z]+://[^/?#]+)', 1) || href) AS greatest_url FROM lk GROUP BY 1",
    LINKS_CTE,
)
def q28b(t):
    return P.page_links(t.spread("pages", "page_id")).groupBy("page_id").agg(F.min("url").alias("least_url"), F.max("url").alias("greatest_url"))


@query(
    "q30_fetch_classification",
    r"""SELECT page_id, CASE WHEN code <> 200 THEN 'http_error' WHEN low LIKE '%preencha o campo com os caracteres%' OR low LIKE '%captcha%' OR low LIKE '%valida%' THEN 'validation_required'
  WHEN low LIKE '%ocorreu um erro%' OR low LIKE '%internal server error%' THEN 'site_error' WHEN text NOT LIKE '%ficha t%' THEN 'unexpected_page' ELSE 'success' END AS status,
  CASE WHEN code <> 200 THEN 'http_status_404' WHEN low LIKE '%preencha o campo com os caracteres%' OR low LIKE '%captcha%' OR low LIKE '%valida%' THEN 'captcha_or_validation_detected'
  WHEN low LIKE '%ocorreu um erro%' OR low LIKE '%internal server error%' THEN 'site_error_page' WHEN text NOT LIKE '%ficha t%' THEN 'missing_ficha_tecnica_text' ELSE '' END AS reason FROM
  (SELECT page_id, CASE WHEN page_id % 9 = 4 THEN 404 ELSE 200 END AS code, lower(h) AS low, lower(trim(regexp_replace(regexp_replace(regexp_replace(h, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) AS text FROM
   (SELECT page_id, html || CASE page_id % 9 WHEN 0 THEN '<p>Ocorreu um <!-- x -->ERRO</p><p>ocorreu um erro' WHEN 1 THEN '<p>Ficha <b>T&eacute;cnica' WHEN 2 THEN '<input id=ValidaCampo>' WHEN 3 THEN '<p>ficha tecnica: rodas de ferro fundido' ELSE '' END AS h FROM pages))""",
)
def q30(t):
    """The stored pages with an end that makes some of them error, check and sheet pages; some were not found."""
    k = col("page_id") % 9
    end = F.when(k == 0, "<p>Ocorreu um <!-- x -->ERRO</p><p>ocorreu um erro").when(k == 1, "<p>Ficha <b>T&eacute;cnica").when(k == 2, "<input id=ValidaCampo>").when(k == 3, "<p>ficha tecnica: rodas de ferro fundido").otherwise("")
    pages = t.raw("pages").withColumn("html", F.concat("html", end))
    return P.classify_fetch(pages, F.when(k == 4, 404).otherwise(200)).select("page_id", "status", "reason")


@query(
    "h08_page_numbers",
    r"SELECT page_id, CASE WHEN regexp_extract(url, '[?&]page=([0-9]+)', 1) <> '' THEN regexp_extract(url, '[?&]page=([0-9]+)', 1)::INT ELSE 1 END AS page, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages",
)
def h08(t):
    return t.raw("pages").select("page_id", P.page_number(col("url")).alias("page"), P.host_of(col("url")).alias("host"))


@query(
    "q23_discovery_round_robin",
    "SELECT id, channel_id, (SELECT CASE WHEN 50 >= count(*) THEN 0 ELSE 50 END::BIGINT FROM creators) AS next_cursor FROM (FROM creators ORDER BY id LIMIT 30 OFFSET 20)",
)
def q23(t):
    batch, following = ranked_creators(t).round_robin(20, 30)
    return batch.select("id", "channel_id", F.lit(following).cast("long").alias("next_cursor"))


@query(
    "q24_onboarding_plan",
    "SELECT creator_id, post_id, rn AS rank FROM (SELECT creator_id, post_id, row_number() OVER (PARTITION BY creator_id ORDER BY post_date DESC, post_id) AS rn FROM posts JOIN creators c ON c.id = creator_id WHERE c.is_active AND collected_at IS NULL) WHERE rn <= 50",
)
def q24(t, cap: int = 50):
    """Uploads to collect first for each active creator: newest first, cap at most, those with snapshots skipped."""
    gate = M.onboarding_gate(col("creator_id"), col("platform"), col("is_active"), col("channel_id"))
    ok = t.creators.withColumnRenamed("id", "creator_id").where(gate.isNull()).select("creator_id")
    new = t.posts.where("collected_at IS NULL").join(ok, "creator_id")
    return topk(new, ["creator_id"], [col("post_date").desc(), col("post_id")], max(1, min(cap, 50))).select("creator_id", "post_id", "rank")


def rules(t) -> list[tuple[str, DataFrame]]:
    return [
        ("posts_key", duplicates(t.posts, ["post_id"])),
        ("creators_key", duplicates(t.creators, ["id"])),
        ("history_orphans", orphans(t.history, "post_id", t.posts, "post_id")),
        ("posts_creator", orphans(t.posts, "creator_id", t.creators, "id")),
        ("creators_entity", orphans(t.creators, "entity_id", t.entities, "id")),
        ("creators_platform", outside(t.creators, "platform", ("youtube", "instagram", "tiktok"))),
        ("posts_video_type", outside(t.posts, "video_type", ("short", "long"))),
        ("failures_status", outside(t.failures, "status", ("active", "unavailable_candidate", "unavailable", "recovered"))),
        ("history_negative", t.history.where("views < 0 OR likes < 0 OR comments < 0")),
        ("line_keys", duplicates(t.raw("lineitem"), ["l_orderkey", "l_linenumber"])),
    ]


@query(
    "c01_constraint_report",
    """SELECT 'posts_key' AS rule, (SELECT count(*) FROM (SELECT post_id FROM posts GROUP BY 1 HAVING count(*) > 1)) AS violations UNION ALL SELECT 'creators_key', (SELECT count(*) FROM (SELECT id FROM creators GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'history_orphans', (SELECT count(*) FROM history WHERE post_id NOT IN (SELECT post_id FROM posts)) UNION ALL SELECT 'posts_creator', (SELECT count(*) FROM posts WHERE creator_id NOT IN (SELECT id FROM creators))
  UNION ALL SELECT 'creators_entity', (SELECT count(*) FROM creators WHERE entity_id NOT IN (SELECT id FROM entities)) UNION ALL SELECT 'creators_platform', 0 UNION ALL SELECT 'posts_video_type', 0 UNION ALL SELECT 'failures_status', 0
  UNION ALL SELECT 'history_negative', (SELECT count(*) FROM history WHERE views < 0) UNION ALL SELECT 'line_keys', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))""",
)
def c01(t):
    return constraint_report(rules(t))
