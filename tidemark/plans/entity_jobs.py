"""Entities and intake: review, publishing, duplicates, aliases; and the state changes of the collection cycle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.functions.text import normalize_key, normalized_name
from tidemark.operators.relational import dedupe, insert_absent, merge_with, missing, strike_state, update_from
from tidemark.plans.registry import query
from tidemark.sources.tables import Tables

col = F.col

REVIEW_CTE = """
niche_key AS (SELECT id AS sub_niche_id, lower(trim(strip_accents(name))) AS k FROM sub_niches),
ent_key AS (SELECT id AS entity_id, normalized_name FROM entities),
review AS (SELECT i.*, s.sub_niche_id, e.entity_id, CASE WHEN i.normalized_name IS NULL OR i.normalized_name = '' THEN 'NORMALIZATION_MISSING' WHEN s.sub_niche_id IS NULL THEN 'SUB_NICHE_NOT_FOUND'
   WHEN e.entity_id IS NOT NULL THEN 'ENTITY_ALREADY_EXISTS' ELSE 'READY_TO_INSERT' END AS review_result
   FROM intake i LEFT JOIN niche_key s ON s.k = lower(trim(strip_accents(i.sub_niche_name))) LEFT JOIN ent_key e USING (normalized_name))
"""


def intake_review(t: Tables) -> DataFrame:
    niche = t.sub_niches.select(col("id").alias("sub_niche_id"), normalized_name(col("name")).alias("__niche"))
    known = t.entities.select(col("id").alias("entity_id"), "normalized_name")
    x = t.intake.withColumn("__niche", normalized_name(col("sub_niche_name"))).join(niche, "__niche", "left").join(known, "normalized_name", "left")
    return x.withColumn("review_result", M.intake_review_result(col("normalized_name"), col("sub_niche_id"), col("entity_id"))).drop("__niche")


REVIEW = ["id", "raw_name", "normalized_name", "sub_niche_name", "status", "sub_niche_id", "entity_id", "review_result"]


@query("q01_entity_intake_review", f"SELECT {', '.join(REVIEW)} FROM review", REVIEW_CTE)
def q01(t):
    return intake_review(t).select(*REVIEW)


@query("q51_intake_review_sorted", f"SELECT {', '.join(REVIEW)} FROM review ORDER BY id DESC", REVIEW_CTE)
def q51(t):
    return intake_review(t).orderBy(col("id").desc()).select(*REVIEW)


@query("q50_intake_normalization_check", "SELECT id, normalized_name, lower(trim(strip_accents(raw_name))) AS recalculated, normalized_name IS DISTINCT FROM lower(trim(strip_accents(raw_name))) AS differs FROM intake")
def q50(t):
    again = normalized_name(col("raw_name"))
    return t.intake.select("id", "normalized_name", again.alias("recalculated"), (~col("normalized_name").eqNullSafe(again)).alias("differs"))


def publish_intake(t: Tables, ids: list[int] | None = None, require_niche: bool = False) -> dict[str, DataFrame]:
    """entities, links and intake after the approved rows are published. Rows of one new name insert one entity (the first row's).

    A row whose sub-niche is unknown is marked published all the same; require_niche leaves it approved. ids: these rows only.
    """
    rows = t.intake.where("status = 'approved'")
    if ids is not None:
        rows = rows.where(col("id").isin(ids))
    rows = rows.withColumn("normalized_name", normalized_name(col("raw_name"))).withColumn("__niche", normalized_name(col("sub_niche_name")))
    rows = rows.join(t.sub_niches.select(col("id").alias("sub_niche_id"), normalized_name(col("name")).alias("__niche")), "__niche", "left")
    new = dedupe(rows.select("normalized_name", "id", "raw_name", "niche"), ["normalized_name"], [col("id")])
    new = new.join(t.entities.select("normalized_name"), "normalized_name", "left_anti")
    top = t.entities.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    # ids go on from the greatest: intake ids are unique, so greatest + intake id needs no global rank
    entities = t.entities.select("id", "name", "normalized_name").unionByName(new.crossJoin(F.broadcast(top)).select((col("top") + col("id")).alias("id"), F.trim("raw_name").alias("name"), "normalized_name"))
    links = rows.where("sub_niche_id IS NOT NULL").join(entities.select(col("id").alias("entity_id"), "normalized_name"), "normalized_name").select("entity_id", "sub_niche_id").distinct()
    done = rows.where("sub_niche_id IS NOT NULL") if require_niche else rows
    intake = update_from(t.intake, done.select("id", "normalized_name"), ["id"], {"status": F.lit("published"), "normalized_name": col("s.normalized_name")})
    return {"entities": entities, "links": insert_absent(t.entity_sub_niches, links, ["entity_id", "sub_niche_id"]), "intake": intake}


PUBLISH_CTE = """
app AS (SELECT i.id, trim(raw_name) AS name, lower(trim(strip_accents(raw_name))) AS nn, s.id AS sub_niche_id FROM intake i LEFT JOIN sub_niches s ON lower(trim(strip_accents(s.name))) = lower(trim(strip_accents(i.sub_niche_name))) WHERE status = 'approved'),
fresh AS (SELECT nn, min(id) AS id, min_by(name, id) AS name FROM app WHERE nn NOT IN (SELECT normalized_name FROM entities) GROUP BY nn),
ents AS (SELECT id, name, normalized_name FROM entities UNION ALL SELECT (SELECT max(id) FROM entities) + id, name, nn FROM fresh)
"""


@query("q13_publish_intake_entities", "SELECT id, name, normalized_name FROM ents", PUBLISH_CTE)
def q13a(t):
    return publish_intake(t)["entities"]


@query(
    "q13_publish_intake_links",
    "SELECT entity_id, sub_niche_id FROM entity_sub_niches UNION SELECT e.id, a.sub_niche_id FROM app a JOIN ents e ON e.normalized_name = a.nn WHERE a.sub_niche_id IS NOT NULL",
    PUBLISH_CTE,
)
def q13b(t):
    return publish_intake(t)["links"]


@query("q13_publish_intake_status", "SELECT CASE WHEN id IN (SELECT id FROM app) THEN 'published' ELSE status END AS status, count(*) AS n FROM intake GROUP BY 1", PUBLISH_CTE)
def q13c(t):
    return publish_intake(t)["intake"].groupBy("status").agg(F.count("*").alias("n"))


@query("q63_publish_one", "SELECT id, CASE WHEN id = 5 AND status = 'approved' THEN 'published' ELSE status END AS status FROM intake")
def q63(t):
    return publish_intake(t, ids=[5])["intake"].select("id", "status")


def entity_mapping(t: Tables) -> DataFrame:
    """(old_id, canonical_id) of names that occur more than once; null names never map."""
    groups = t.parts.where("normalized_name IS NOT NULL").groupBy("normalized_name").agg(F.min("id").alias("canonical_id"), F.count("*").alias("n")).where("n > 1")
    return t.parts.join(groups, "normalized_name").where("id <> canonical_id").select(col("id").alias("old_id"), "canonical_id", "normalized_name")


MAP_CTE = """
canon AS (SELECT normalized_name, min(id) AS canonical_id, count(*) AS n FROM (SELECT p_partkey AS id, lower(trim(strip_accents(p_name))) AS normalized_name FROM part) WHERE normalized_name IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
parts AS (SELECT p_partkey AS id, lower(trim(strip_accents(p_name))) AS normalized_name FROM part),
mapping AS (SELECT id AS old_id, canonical_id, normalized_name FROM parts JOIN canon USING (normalized_name) WHERE id <> canonical_id)
"""


@query("q11_dedupe_mapping", "SELECT old_id, canonical_id, normalized_name FROM mapping", MAP_CTE)
def q11a(t):
    return entity_mapping(t)


@query("q11_dedupe_clusters", "SELECT canonical_id, count(*) AS duplicates, list_sort(list(old_id)) AS old_ids FROM mapping GROUP BY 1", MAP_CTE)
def q11b(t):
    return entity_mapping(t).groupBy("canonical_id").agg(F.count("*").alias("duplicates"), F.sort_array(F.collect_list("old_id")).alias("old_ids"))


@query("q11_dedupe_rewritten_links", "SELECT coalesce(canonical_id, l_partkey) AS entity_id, count(*) AS links FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) LEFT JOIN mapping ON old_id = l_partkey GROUP BY 1", MAP_CTE)
def q11c(t):
    links = t.raw("lineitem").select(col("l_partkey").alias("entity_id"), "l_suppkey").distinct()
    mapped = update_from(links, entity_mapping(t).select(col("old_id").alias("entity_id"), "canonical_id"), ["entity_id"], {"entity_id": col("s.canonical_id")})
    return mapped.groupBy("entity_id").agg(F.count("*").alias("links"))


@query("q11_dedupe_residual", "SELECT id, normalized_name FROM parts WHERE id NOT IN (SELECT old_id FROM mapping)", MAP_CTE)
def q11d(t):
    return t.parts.join(entity_mapping(t).select(col("old_id").alias("id")), "id", "left_anti").select("id", "normalized_name")


@query("q11_dedupe_detail", "SELECT old_id, o.p_name AS old_name, canonical_id, c.p_name AS canonical_name, normalized_name FROM mapping JOIN part o ON o.p_partkey = old_id JOIN part c ON c.p_partkey = canonical_id", MAP_CTE)
def q11_detail(t):
    """The mapping with both names, for review by hand."""
    named = lambda key, name: t.parts.select(col("id").alias(key), col("name").alias(name))
    x = entity_mapping(t).join(named("old_id", "old_name"), "old_id").join(named("canonical_id", "canonical_name"), "canonical_id")
    return x.select("old_id", "old_name", "canonical_id", "canonical_name", "normalized_name")


def _moved(t: Tables, rows: DataFrame) -> DataFrame:
    """rows with entity_id set to the canonical one."""
    return update_from(rows, entity_mapping(t).select(col("old_id").alias("entity_id"), "canonical_id"), ["entity_id"], {"entity_id": col("s.canonical_id")})


@query("q11_rewritten_creators", "SELECT c_custkey AS id, c_name AS username, coalesce(canonical_id, c_custkey) AS entity_id FROM customer LEFT JOIN mapping ON old_id = c_custkey", MAP_CTE)
def q11_creators(t):
    """Creators that point to their canonical entity; those of entities without duplicates stay."""
    return _moved(t, t.raw("customer").select(col("c_custkey").alias("id"), col("c_name").alias("username"), col("c_custkey").alias("entity_id")))


@query("q11_rewritten_niches", "SELECT DISTINCT coalesce(canonical_id, p_partkey) AS entity_id, p_size % 5 AS sub_niche_id FROM part LEFT JOIN mapping ON old_id = p_partkey", MAP_CTE)
def q11_niches(t):
    """Links to sub-niches after those that the canonical entity has already are deleted and the others moved: each pair once."""
    links = t.raw("part").select(col("p_partkey").alias("entity_id"), (col("p_size") % 5).alias("sub_niche_id"))
    return _moved(t, links).distinct()


@query("q11_rewritten_entities", "SELECT p_partkey AS id, p_name AS name FROM part WHERE p_partkey NOT IN (SELECT old_id FROM mapping)", MAP_CTE)
def q11_entities(t):
    return t.parts.join(entity_mapping(t).select(col("old_id").alias("id")), "id", "left_anti").select("id", "name")


@query("q11_duplicates_left", "SELECT count(*) AS names_left FROM (SELECT normalized_name FROM parts WHERE id NOT IN (SELECT old_id FROM mapping) GROUP BY 1 HAVING count(*) > 1)", MAP_CTE)
def q11_left(t):
    """Names that still stand for several entities: none."""
    rest = t.parts.join(entity_mapping(t).select(col("old_id").alias("id")), "id", "left_anti")
    return rest.groupBy("normalized_name").count().where("count > 1").agg(F.count("*").alias("names_left"))


@query(
    "q12_entity_link_checks",
    """SELECT e.id AS entity_id, count(DISTINCT c.id) AS creators, count(DISTINCT l.sub_niche_id) AS niches, count(DISTINCT l.sub_niche_id) = 0 AS without_niche
  FROM entities e LEFT JOIN creators c ON c.entity_id = e.id LEFT JOIN entity_sub_niches l ON l.entity_id = e.id GROUP BY 1""",
)
def q12(t):
    c = t.creators.groupBy("entity_id").agg(F.count("*").alias("creators"))
    n = t.entity_sub_niches.groupBy("entity_id").agg(F.count("*").alias("niches"))
    x = t.entities.select(col("id").alias("entity_id")).join(c, "entity_id", "left").join(n, "entity_id", "left")
    return x.select("entity_id", M.or0(col("creators")).alias("creators"), M.or0(col("niches")).alias("niches"), (M.or0(col("niches")) == 0).alias("without_niche"))


@query("q12_unpublished_intake", "SELECT id, raw_name FROM intake WHERE status = 'approved' AND normalized_name NOT IN (SELECT normalized_name FROM entities)")
def q12b(t):
    named = t.intake.where("status = 'approved' AND normalized_name IS NOT NULL")
    return named.join(t.entities.select("normalized_name"), "normalized_name", "left_anti").select("id", "raw_name")


#: Aliases of market names (a parameter of the job; these are examples over the brands of the part table).
ALIASES = [("brand 1", "B1"), ("brand 2", "B2"), ("brand 11", "B1"), ("brand 12", "B2"), ("brand 13", "B1"), ("brand 21", "B2")]


def harmonize(df: DataFrame, column: str, aliases: list[tuple[str, str]]) -> DataFrame:
    """df with canonical: the alias of the normalised name, else the name itself."""
    table = df.sparkSession.createDataFrame(aliases, "__key string, canonical string")
    x = df.withColumn("__key", normalize_key(col(column))).join(F.broadcast(table), "__key", "left")  # a literal list
    return x.withColumn("canonical", F.coalesce("canonical", column)).drop("__key")


ALIAS_VALUES = ", ".join(f"('{a}', '{b}')" for a, b in ALIASES)
ALIAS_CTE = f"harm AS (SELECT p_partkey, p_brand, coalesce(c, p_brand) AS canonical FROM part LEFT JOIN (VALUES {ALIAS_VALUES}) v(k, c) ON k = trim(regexp_replace(lower(strip_accents(p_brand)), '[^a-z0-9+]+', ' ', 'g')))"


@query("q57_alias_harmonization", "SELECT p_brand, canonical, count(*) AS parts FROM harm GROUP BY ALL", ALIAS_CTE)
def q57(t):
    return harmonize(t.raw("part"), "p_brand", ALIASES).groupBy("p_brand", "canonical").agg(F.count("*").alias("parts"))


# State changes of the collection cycle.


@query("q14_collection_failures", "SELECT post_id, failure_count, first_failed_at, last_failed_at, last_success_at, status FROM failures")
def q14(t):
    return strike_state(t.attempts, "post_id", ["seq"], "missed", "collected_at")


def register_collection_result(state: DataFrame, requested: DataFrame, returned: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """(state, actions) after one run: returned posts that have a row recover, missing ones get a row or a strike; three strikes make unavailable."""
    hit = returned.select("post_id").where("post_id IS NOT NULL").distinct()
    gone = missing(requested, returned, "post_id")
    healed = update_from(
        state, hit, ["post_id"], {"failure_count": F.lit(0).cast(state.schema["failure_count"].dataType), "last_success_at": as_of, "status": F.lit("recovered")}
    )
    count = col("t.failure_count") + 1
    after = merge_with(
        healed,
        gone,
        ["post_id"],
        {"failure_count": count, "last_failed_at": as_of, "status": F.when(count >= 3, "unavailable").otherwise("unavailable_candidate")},
        {"failure_count": F.lit(1), "first_failed_at": as_of, "last_failed_at": as_of, "status": F.lit("unavailable_candidate")},
    )
    named = gone.select("post_id", F.lit("missing").alias("action_taken")).unionByName(hit.select("post_id", F.lit("returned").alias("action_taken")))
    # returned ids without a row are no action; the address is null for posts that are new here
    actions = after.join(named, "post_id").select("post_id", *[c for c in ("youtube_url",) if c in after.columns], "status", "failure_count", "action_taken")
    return after, actions.orderBy(F.when(col("action_taken") == "missing", 0).otherwise(1), "post_id")


@query(
    "q14_register_run",
    """SELECT post_id, youtube_url, CASE WHEN returned THEN 'recovered' WHEN n + 1 >= 3 THEN 'unavailable' ELSE 'unavailable_candidate' END AS status, CASE WHEN returned THEN 0 ELSE n + 1 END AS failure_count, CASE WHEN returned THEN 'returned' ELSE 'missing' END AS action_taken
  FROM (SELECT q.post_id, f.youtube_url, f.post_id IS NOT NULL AS known, coalesce(f.failure_count, 0) AS n, substr(q.post_id, 2)::BIGINT % 3 <> 0 AS returned FROM queue q LEFT JOIN failures f USING (post_id) WHERE q.needs_update) WHERE NOT returned OR known""",
)
def q14b(t):
    asked = t.queue.where("needs_update").select("post_id")
    came = asked.where(F.substring("post_id", 2, 20).cast("long") % 3 != 0)
    return register_collection_result(t.failures, asked, came, t.as_of)[1]


def sync_latest(current: DataFrame, new: DataFrame, key: str, values: list[str], time: str, tie: str, guard: bool) -> DataFrame:
    """current with the values of each key's newest new row. guard: a row older than the current one is ignored; else the last inserted wins."""
    order = F.struct(time, tie) if guard else F.struct(tie)
    newest = new.groupBy(key).agg(F.max_by(F.struct(time, *values), order).alias("x")).select(key, "x.*")
    if guard:
        newest = newest.join(current.select(key, col(time).alias("__old")), key).where(col("__old").isNull() | (col(time) >= col("__old"))).drop("__old")
    return update_from(current, newest, [key], {c: col(f"s.{c}") for c in (time, *values)})


@query(
    "q15_sync_creator_latest",
    "SELECT creator_id, max_by(followers, (collected_at, id)) AS followers, max(collected_at) AS collected_at FROM ehist GROUP BY 1",
)
def q15(t):
    h = t.event_history.select("id", "creator_id", "followers", "collected_at")
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    late = h.where(col("collected_at") < middle)  # arrives after the newer half
    empty = h.select("creator_id").distinct().select("creator_id", F.lit(None).cast("long").alias("followers"), F.lit(None).cast("timestamp_ntz").alias("collected_at"))
    first = sync_latest(empty, h.where(col("collected_at") >= middle), "creator_id", ["followers"], "collected_at", "id", True)
    return sync_latest(first, late, "creator_id", ["followers"], "collected_at", "id", True)


@query("q16_sync_post_latest", "SELECT post_id, views, likes, comments, collected_at FROM posts WHERE collected_at IS NOT NULL")
def q16(t):
    base = t.raw("orders").select(F.concat(F.lit("p"), col("o_orderkey").cast("string")).alias("post_id"), *[F.lit(None).cast("long").alias(c) for c in ("views", "likes", "comments")], F.lit(None).cast("timestamp_ntz").alias("collected_at"))
    out = sync_latest(base, t.history, "post_id", ["views", "likes", "comments"], "collected_at", "id", False)
    return out.where("collected_at IS NOT NULL")


@query("q17_enqueue_new_posts", "SELECT post_id, score AS priority_score, TIMESTAMP '2001-08-01 06:00:00' AS next_check FROM scored WHERE order_status = 'F' UNION ALL SELECT post_id, priority_score, next_check FROM queue WHERE needs_update")
def q17(t):
    have = t.queue.where("needs_update").select("post_id", "priority_score", "next_check")
    new = t.posts.select("post_id", M.post_priority(col("views"), col("likes"), col("comments")).alias("priority_score"), t.as_of.alias("next_check"))
    return insert_absent(have, new, ["post_id"])


@query("q18_refresh_queue", "SELECT post_id, priority_score, last_checked, next_check FROM queue")
def q18(t):
    """The queue after the history is appended: counts include the new rows, so two rows of one post both count."""
    old = t.posts.select("post_id", F.lit(0.0).alias("priority_score"), F.lit(None).cast("timestamp_ntz").alias("last_checked"), col("post_date").alias("next_check"))
    x = t.latest.join(t.posts.select("post_id", "post_date"), "post_id")
    score = M.post_priority(col("views"), col("likes"), col("comments"))
    new = x.select("post_id", score.alias("priority_score"), col("collected_at").alias("last_checked"), M.next_check(score, col("collected_at"), col("post_date"), col("checks")).alias("next_check"))
    cols = ("priority_score", "last_checked", "next_check")
    return merge_with(old, new, ["post_id"], {c: col(f"s.{c}") for c in cols}, {c: col(f"s.{c}") for c in cols})


@query(
    "q40_confirm_unavailable",
    "SELECT post_id, CASE WHEN ok THEN 'confirmed_unavailable' END AS human_review_status, CASE WHEN ok THEN 'confirmed by hand' END AS human_review_notes FROM (SELECT *, status <> 'recovered' AND substr(post_id, 2)::BIGINT % 5 = 0 AS ok FROM failures)",
)
def q40(t):
    """Chosen posts confirmed by hand; rows that are not candidates or unavailable stay."""
    chosen = t.failures.where(col("status").isin("unavailable_candidate", "unavailable")).where(F.substring("post_id", 2, 20).cast("long") % 5 == 0).select("post_id")
    blank = t.failures.select("post_id", F.lit(None).cast("string").alias("human_review_status"), F.lit(None).cast("string").alias("human_review_notes"))
    return update_from(blank, chosen, ["post_id"], {"human_review_status": F.lit("confirmed_unavailable"), "human_review_notes": F.lit("confirmed by hand")})


@query("q22_missing_ids", "SELECT 'p' || l_orderkey AS post_id, min(l_partkey) AS position FROM lineitem WHERE 'p' || l_orderkey NOT IN (SELECT post_id FROM history) GROUP BY 1")
def q22(t):
    asked = t.raw("lineitem").select(F.concat(F.lit("p"), col("l_orderkey").cast("string")).alias("post_id"), col("l_partkey").alias("position"))
    return missing(asked, t.history, "post_id", "position")
