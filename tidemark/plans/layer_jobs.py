"""Layers, loads and landed responses: what the readers, merges and page operators give on the star tables and on pages and responses made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.functions import text as X
from tidemark.operators import pages as P
from tidemark.operators import relational as R
from tidemark.operators.materialize import create_table_as, shared_folder
from tidemark.plans.registry import query
from tidemark.sources import readers
from tidemark.sources.tables import Tables

col = F.col


def _folder(t: Tables, name: str) -> str:
    import uuid

    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _parts(t: Tables) -> DataFrame:
    return t.raw("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")


@query("s02_csv_layer", "SELECT p_partkey::VARCHAR AS p_partkey, p_name || ', \"' || p_brand || '\"' AS label, NULL::VARCHAR AS absent FROM part")
def s02(t):
    path = _folder(t, "layer")
    readers.write_layer(t.raw("part").select("p_partkey", F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("label")), path)
    return readers.read_layer(t.spark, path, ["p_partkey", "label", "absent"])


def video_responses(t: Tables) -> DataFrame:
    """One response (column json) for each order: statistics, snippet and duration as text."""
    k = col("o_orderkey")
    seconds = (k % 400).cast("long")
    duration = F.concat(F.lit("PT"), F.floor(seconds / 60).cast("string"), F.lit("M"), (seconds % 60).cast("string"), F.lit("S"))
    item = F.struct(
        F.concat(F.lit("p"), k.cast("string")).alias("id"),
        F.struct(F.when(k % 7 != 0, F.floor("o_totalprice").cast("long").cast("string")).alias("viewCount"), (k % 90).cast("string").alias("likeCount"), F.when(k % 5 == 0, "n/a").otherwise((k % 11).cast("string")).alias("commentCount")).alias("statistics"),
        F.struct(F.when(k % 13 == 0, F.concat("o_orderpriority", F.lit(" #Shorts"))).otherwise(col("o_orderpriority")).alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt")).alias("snippet"),
        F.struct(duration.alias("duration")).alias("contentDetails"),
    )
    return t.raw("orders").select(F.to_json(F.struct(F.array(item).alias("items"))).alias("json"))


STATS = "coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN floor(o_totalprice)::BIGINT END, 0) AS views, (o_orderkey % 90)::BIGINT AS likes, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 11 END::BIGINT AS comments"


@query("s04_stats_responses", f"SELECT 'p' || o_orderkey AS post_id, TIMESTAMP '2001-08-01 06:00:00' AS collected_at, {STATS} FROM orders")
def s04(t):
    return readers.normalize_stats(video_responses(t), t.as_of)


@query(
    "s05_video_details",
    f"""SELECT 'p' || o_orderkey AS post_id, o_orderpriority || CASE WHEN o_orderkey % 13 = 0 THEN ' #Shorts' ELSE '' END AS title, o_orderdate::TIMESTAMP AS post_date, {STATS}, (o_orderkey % 400)::BIGINT AS duration,
  CASE WHEN o_orderkey % 400 <= 270 OR o_orderkey % 13 = 0 THEN 'short' ELSE 'long' END AS video_type FROM orders""",
)
def s05(t):
    return readers.normalize_video_details(video_responses(t))


@query(
    "s06_channel_responses",
    "SELECT 'ch' || c_custkey AS channel_id, CASE WHEN c_custkey % 9 <> 0 THEN floor(c_acctbal)::BIGINT END AS followers, (c_custkey * 3)::BIGINT AS channel_view_count, c_custkey % 9 = 0 AS hidden_subscriber_count, 'UU' || c_custkey AS uploads FROM customer",
)
def s06(t):
    k = col("c_custkey")
    item = F.struct(
        F.concat(F.lit("ch"), k.cast("string")).alias("id"),
        F.struct(F.when(k % 9 == 0, "hidden").otherwise(F.floor("c_acctbal").cast("long").cast("string")).alias("subscriberCount"), (k * 3).cast("string").alias("viewCount"), F.lit("1").alias("videoCount"), (k % 9 == 0).alias("hiddenSubscriberCount")).alias("statistics"),
        F.struct(F.struct(F.concat(F.lit("UU"), k.cast("string")).alias("uploads")).alias("relatedPlaylists")).alias("contentDetails"),
    )
    landed = t.raw("customer").select(F.to_json(F.struct(F.array(item).alias("items"))).alias("json"))
    return readers.normalize_channel(landed).drop("channel_video_count")


@query("s07_append_history", "SELECT date_trunc('month', collected_at)::DATE AS d, count(*) AS snapshots, sum(views)::BIGINT AS views FROM history GROUP BY 1")
def s07(t):
    path, history = _folder(t, "history"), t.history
    for part in (col("collected_at") < F.lit("1996-01-01"), col("collected_at") >= F.lit("1996-01-01")):  # two runs, each appends
        readers.append_history(history.where(part), path, unit="month")
    back = t.spark.read.schema("views long, d date").parquet(path)
    return back.groupBy("d").agg(F.count("*").alias("snapshots"), F.sum("views").alias("views"))


OLD = "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part WHERE p_partkey % 3 <> 0"
NEW = "SELECT p_partkey, upper(p_name) AS p_name, p_brand, p_type, p_size + 1 AS p_size FROM part WHERE p_partkey % 2 = 0"


def _old_new(t: Tables) -> tuple[DataFrame, DataFrame]:
    p = _parts(t)
    return p.where("p_partkey % 3 <> 0"), p.where("p_partkey % 2 = 0").withColumn("p_name", F.upper("p_name")).withColumn("p_size", col("p_size") + 1)


OLD_NEW = f"o AS ({OLD}), n AS ({NEW})"


@query("s08_upsert", "SELECT * FROM n UNION ALL SELECT * FROM o WHERE p_partkey NOT IN (SELECT p_partkey FROM n)", OLD_NEW)
def s08(t):
    return R.upsert(*_old_new(t), ["p_partkey"])


@query("s12_delete_where", "SELECT * FROM o WHERE p_partkey NOT IN (SELECT ps FROM (SELECT l_partkey AS ps FROM lineitem WHERE l_quantity >= 49))", OLD_NEW)
def s12(t):
    doomed = t.raw("lineitem").where("l_quantity >= 49").select(col("l_partkey").alias("p_partkey")).distinct()
    return R.delete_where(_old_new(t)[0], doomed, ["p_partkey"])


@query("s13_replace_load", "SELECT * FROM n WHERE p_size < 20 UNION ALL SELECT * FROM o WHERE p_brand NOT IN (SELECT p_brand FROM n WHERE p_size < 20)", OLD_NEW)
def s13(t):
    old, new = _old_new(t)
    return readers.replace_load(old, new.where("p_size < 20"), "p_brand")


@query("s14_create_table_as", "SELECT p_brand, count(*) AS parts, max(p_size) AS largest FROM part GROUP BY 1")
def s14(t):
    rows = create_table_as(_parts(t), "parts")
    sizes = rows.groupBy("p_brand").agg(F.max("p_size").alias("largest"))
    return rows.groupBy("p_brand").agg(F.count("*").alias("parts")).join(sizes, "p_brand")


@query(
    "s15_register_files",
    """SELECT 7::BIGINT AS source_id, url AS source_url, CASE WHEN page_id % 2 = 0 THEN 'known' ELSE sha256(html) END AS sha256, CASE WHEN page_id % 2 = 0 THEN 0 ELSE strlen(html) END::BIGINT AS file_size_bytes,
  string_split(url, '/')[-1] AS original_filename, CASE WHEN page_id % 2 = 0 THEN 'validated' ELSE 'stored' END AS extraction_status FROM (SELECT page_id, url, coalesce(html, '') AS html FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1)""",
)
def s15(t):
    one = R.dedupe(t.raw("pages").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")), ["url"], [col("page_id")])
    known = one.where("page_id % 2 = 0").select(F.lit(7).cast("long").alias("source_id"), col("url").alias("source_url"), F.lit("known").alias("sha256"), F.lit(0).cast("long").alias("file_size_bytes"), F.element_at(F.split("url", "/"), -1).alias("original_filename"), F.lit("validated").alias("extraction_status"))
    return readers.register_files(one.select(col("url").alias("path"), F.encode("html", "UTF-8").alias("content")), 7, known)


@query("s17_source_lookup", "SELECT min(r_regionkey)::BIGINT AS source_id, NULL::VARCHAR AS error FROM region WHERE r_name = 'ASIA' UNION ALL SELECT NULL, 'no source named ATLANTIS'")
def s17(t):
    sources = t.raw("region").select(col("r_regionkey").cast("long").alias("id"), col("r_name").alias("source_name"))
    return readers.resolve_source(sources, "ASIA").unionByName(readers.resolve_source(sources, "ATLANTIS"))


@query("s19_resume", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber >= 4)")
def s19(t):
    done = t.raw("lineitem").where("l_linenumber >= 4").select(col("l_orderkey").alias("o_orderkey")).distinct()
    return readers.resume_from(t.raw("orders").select("o_orderkey", "o_custkey"), done, ["o_orderkey"])


@query(
    "s20_merge_layer",
    "SELECT p_type, p_partkey, p_name, extra FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY side, p_partkey) AS r FROM (SELECT 0 AS side, p_type, p_partkey, p_name, NULL AS extra FROM part WHERE p_partkey % 2 = 1 AND p_size < 25 UNION ALL SELECT 1, p_type, p_partkey, p_name, p_brand FROM part WHERE p_partkey % 2 = 0)) WHERE r = 1",
)
def s20(t):
    p = _parts(t)
    old = p.where("p_partkey % 2 = 1 AND p_size < 25").select("p_type", "p_partkey", "p_name")
    new = p.where("p_partkey % 2 = 0").select("p_type", "p_partkey", "p_name", col("p_brand").alias("extra"))
    return readers.merge_layer(old, new, ["p_type"], "p_partkey")


@query("p06_half_open_period", "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1996-07-01'")
def p06(t):
    return R.period_filter(t.raw("orders"), "o_orderdate", "1995-01-01", "1996-06-30").select("o_orderkey")


@query("p10_any_of_array", "SELECT post_id, priority_score FROM queue WHERE post_id IN (SELECT 'p' || l_orderkey FROM lineitem WHERE l_quantity = 50)")
def p10(t):
    """Queue rows whose key is any of a list that a job made: the list stays a frame, whatever its length."""
    wanted = t.raw("lineitem").where("l_quantity = 50").select(F.concat(F.lit("p"), col("l_orderkey").cast("string")).alias("post_id")).distinct()
    return t.queue.join(wanted, "post_id", "left_semi").select("post_id", "priority_score")


def review_screen(t: Tables, status: list[str], least: int, pending: bool = False, post_id: str = "", platforms: list[str] = (), name: str = "") -> DataFrame:
    """The review screen's rows under its filters: status from a list, least number of failures, only those that nobody has reviewed, text in the post's id, platform from a list, text in the user name; an empty list or text filters nothing. Most failures first, then the latest."""
    reviewed = (F.substring("post_id", 2, 20).cast("long") % 5 == 0) & (col("status") != "recovered")  # those confirmed by hand (q40_confirm_unavailable)
    rows = t.failures.withColumn("human_review_status", F.when(reviewed, "confirmed_unavailable"))
    rows = rows.join(t.posts.select("post_id", "creator_id"), "post_id").join(t.creators.select(col("id").alias("creator_id"), "platform", "username"), "creator_id")
    keep = [col("status").isin(*status)] if status else []
    keep += [col("human_review_status").isNull()] if pending else []
    keep += [col("post_id").contains(post_id)] if post_id else []
    keep += [col("platform").isin(*platforms)] if platforms else []
    keep += [F.lower("username").contains(name.lower())] if name else []
    for k in keep:
        rows = rows.where(k)
    out = rows.where(col("failure_count") >= least).select("post_id", "status", "failure_count", "username", "platform", "last_failed_at", "human_review_status")
    return out.orderBy(col("failure_count").desc(), col("last_failed_at").desc(), "post_id")


REVIEW_SQL = "SELECT post_id, status, failure_count, username, platform, last_failed_at, human_review_status FROM (SELECT *, CASE WHEN substr(post_id, 2)::BIGINT % 5 = 0 AND status <> 'recovered' THEN 'confirmed_unavailable' END AS human_review_status FROM failures) JOIN posts USING (post_id) JOIN creators c ON c.id = creator_id WHERE "


@query("p11_review_filters", REVIEW_SQL + "status IN ('unavailable', 'unavailable_candidate') AND failure_count >= 1 AND human_review_status IS NULL AND contains(post_id, '1')")
def p11(t):
    return review_screen(t, ["unavailable", "unavailable_candidate"], 1, pending=True, post_id="1")


@query("p11_review_by_name", REVIEW_SQL + "platform = 'youtube' AND failure_count >= 2 AND contains(lower(username), 'customer#00000')")
def p11b(t):
    return review_screen(t, [], 2, platforms=["youtube"], name="CUSTOMER#00000")


@query("a10_keep_first", "SELECT p_brand, p_partkey, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS r FROM part) WHERE r = 1")
def a10(t):
    return R.dedupe(_parts(t).select("p_brand", "p_size", "p_partkey", "p_name"), ["p_brand"], [col("p_size"), col("p_partkey")]).drop("p_size")


@query("a11_last_at_first_place", "SELECT p_type, max_by(p_name, p_partkey) AS p_name, min(p_partkey) AS p_partkey FROM part GROUP BY 1")
def a11(t):
    return R.dedupe_last_at_first(_parts(t).select("p_type", "p_name", "p_partkey"), ["p_type"], "p_partkey")


@query(
    "a12_keep_best",
    """SELECT p_type, p_partkey, points FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY points DESC, p_partkey) AS r FROM
  (SELECT p_type, p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 10 ELSE 0 END + CASE WHEN p_size > 25 THEN 4 ELSE 0 END + CASE WHEN p_brand LIKE '%1' THEN 2 ELSE 0 END + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS points FROM part)) WHERE r = 1""",
)
def a12(t):
    k = col("p_partkey")
    points = P.richness(F.when(k % 3 == 0, "text"), F.when(col("p_size") > 25, "title"), F.when(col("p_brand").endswith("1"), "label"), F.when(k % 2 == 0, "/FichaDetalhe.asp?codigo=1").otherwise("/ficha.asp"))
    return R.dedupe_best(_parts(t).withColumn("points", points).select("p_type", "p_partkey", "points"), ["p_type"], col("points"), k)


@query(
    "f_text_functions",
    r"""SELECT p_partkey, trim(regexp_replace(' ' || p_name || chr(160) || '  ' || p_type, '[\s\x{00A0}]+', ' ', 'g')) AS f32, trim(regexp_replace(translate(lower('É ' || p_name || '  Ã'), 'áàâãêéíóôõúç', 'aaaaeeiooouc'), '\s+', ' ', 'g')) AS f34,
  regexp_replace(regexp_replace('/' || p_name || '?' || p_size, '[^A-Za-z0-9_-]+', '_', 'g'), '^_+|_+$', '', 'g') AS f35, p_partkey::BIGINT * 1000 AS f37, p_size / 4.0::DOUBLE AS f39, CASE WHEN p_size BETWEEN 1 AND 12 THEN make_date(2020, p_size::INT, 1) END AS f40,
  (1900 + p_size)::VARCHAR AS f42, p_name AS f43, p_brand || '?q=' || p_size || '&r=' || (p_size + 1) AS f45, p_size % 2 = 0 AS f47, p_size % 3 = 0 AS f48, CASE WHEN p_size % 4 <> 0 THEN p_size::BIGINT END AS f53,
  CASE WHEN p_size BETWEEN 1 AND 12 THEN make_timestamp(2020, p_size::INT, 5, CASE WHEN p_partkey % 2 = 0 THEN 10 ELSE 13 END, 0, 0) END AS f54, p_size % 5 = 0 AS f55 FROM part""",
)
def f_text(t):
    k, size, name = col("p_partkey"), col("p_size").cast("int"), col("p_name")
    text = size.cast("string")
    base = F.concat(F.lit("https://h.example/catalogo.asp?Fabricante="), F.url_encode(name))
    month = F.lpad(text, 2, "0")
    return t.spread("part", "p_partkey", "p_partkey", "p_name", "p_brand", "p_type", "p_size").select(
        "p_partkey",
        X.normalize_text(F.concat(F.lit(" "), name, F.lit("   "), "p_type")).alias("f32"),
        X.normalize_label(F.concat(F.lit("É "), name, F.lit("  Ã"))).alias("f34"),
        X.safe_filename(F.concat(F.lit("/"), name, F.lit("?"), text)).alias("f35"),
        X.parse_int_br(F.concat(F.translate(F.format_number(k.cast("long") * 1000, 0), ",", "."), F.lit(",99"))).alias("f37"),
        X.parse_decimal_br(F.translate(F.format_number(size / 4, 2), ".", ",")).alias("f39"),
        X.reference_period(F.concat(F.lit("d/2020_"), month, F.lit("_x.pdf"))).alias("f40"),
        X.year_of(F.concat(F.lit("ano "), (size + 1900).cast("string"), F.lit(" flex"))).alias("f42"),
        X.query_param(base, "fabricante").alias("f43"),
        X.build_query(col("p_brand"), {"q": text, "r": (size + 1).cast("string")}).alias("f45"),
        X.same_catalog_signature(F.concat(base, F.lit("&ano=2020")), F.concat(base, F.when(size % 2 == 0, "&ano=2020&pag=2").otherwise("&ano=2021"))).alias("f47"),
        X.is_error_url(F.when(size % 3 == 0, "https://h.example/x/Erro.asp?c=1").otherwise(base)).alias("f48"),
        X.safe_int(F.when(size % 4 == 0, F.concat(text, F.lit("x"))).otherwise(text)).alias("f53"),
        X.iso_timestamp(F.concat(F.lit("2020-"), month, F.when(k % 2 == 0, "-05T10:00:00Z").otherwise("-05T10:00:00-03:00"))).alias("f54"),
        X.is_group_header(F.when(size % 5 == 0, F.upper(F.lit("motor e freio"))).otherwise(F.concat(F.lit("Motor "), text))).alias("f55"),
    )


@query(
    "f_video_functions",
    "SELECT o_orderkey, (o_orderkey % 100000)::BIGINT AS seconds, CASE WHEN o_orderkey % 100000 <= 270 OR o_orderkey % 6 = 0 THEN 'short' ELSE 'long' END AS video_type FROM orders",
)
def f_video(t):
    k = col("o_orderkey")
    s = k % 100000
    text = F.concat(F.lit("PT"), F.floor(s / 3600).cast("string"), F.lit("H"), F.floor(s % 3600 / 60).cast("string"), F.lit("M"), (s % 60).cast("string"), F.lit("S"))
    seconds = M.iso_duration_seconds(text)
    return t.raw("orders").select("o_orderkey", seconds.alias("seconds"), M.video_type(seconds, F.when(k % 6 == 0, "A #SHORTS clip").otherwise("clip")).alias("video_type"))


def catalog_pages(t: Tables) -> DataFrame:
    """Catalogue pages made of the parts: a select of brands, links to a model, a year, a sheet and the next list page, and a sheet's table."""
    k = col("p_partkey").cast("string")
    link = lambda href, label: F.concat(F.lit('<a class="x" href="'), href, F.lit('">'), label, F.lit("</a> "))
    year = (col("p_size") + 1950).cast("string")
    name = F.url_encode("p_name")
    own = F.concat(
        F.lit("<select name='cboFabricante'><option value=''>Selecione</option><option value=0>TODOS<option value=\""), k, F.lit('">'), "p_brand", F.lit("</option></select>"),
        link(F.concat(F.lit("catalogo.asp?fabricante="), F.url_encode("p_brand"), F.lit("&amp;varnome="), name, F.when(col("p_partkey") % 2 == 0, F.lit("&amp;codigo=")).otherwise(F.lit("&amp;codmodelo=")), k), col("p_name")),
        link(F.concat(F.lit("fichadetalhe.asp?fabricante="), F.url_encode("p_brand"), F.lit("&amp;anomod="), year), F.concat(F.lit("ano "), year)),
        link(F.lit("sobre.asp?varnome=x&amp;ano=1999"), F.lit("1999")),
        F.lit("<table><tr><td>MOTOR</td><td></td></tr><tr><td>Tamanho</td><td>"), col("p_size").cast("string"), F.lit("</td><td>Tipo</td><td>"), "p_type", F.lit("<img src='.\\fotos\\"), k,
        F.lit(".jpg'></td></tr><tr><td>Avalie</td><td>5</td></tr><tr><td>Tamanho<td>"), col("p_size").cast("string"), F.lit("</table>"),
    )
    rows = t.spread("part", "p_partkey", "p_partkey", "p_name", "p_brand", "p_type", "p_size").select("p_partkey", own.alias("own"))
    return rows.select(
        col("p_partkey").alias("page_id"),
        F.concat(F.lit("https://h.example/c/catalogo.asp?pag=1&codigo="), k).alias("url"),
        F.concat(F.lit("<html><head><title>Part "), k, F.lit("</title></head><body>"), "own", link(F.concat(F.lit("catalogo.asp?pag=p2&amp;codigo="), k), F.lit("2")), link(F.lit("/c/catalogo.asp?pag=0"), F.lit("0")), F.lit("</body></html>")).alias("html"),
    )


@query("h04_options", "SELECT p_partkey AS page_id, p_brand AS fabricante, p_partkey::VARCHAR AS value, 'https://h.example/catalogofabricante.asp?fabricante=' || p_partkey AS url FROM part")
def h04(t):
    return P.select_options(P.page_elements(catalog_pages(t), ["option"])).drop("position")


@query("h05_model_links", "SELECT p_partkey AS page_id, p_name AS modelo, p_partkey::VARCHAR AS codigo_modelo, NULL::VARCHAR AS rejected FROM part UNION ALL SELECT p_partkey, '2', p_partkey::VARCHAR, 'sem varnome/modelo nos parametros' FROM part UNION ALL SELECT p_partkey, '0', NULL, 'sem varnome/modelo nos parametros' FROM part")
def h05(t):
    return P.model_links(P.page_links(catalog_pages(t))).select("page_id", "modelo", "codigo_modelo", "rejected")


@query("h06_year_links", "SELECT p_partkey AS page_id, (p_size + 1950)::VARCHAR AS ano, p_brand AS fabricante FROM part")
def h06(t):
    links = P.year_links(P.page_links(catalog_pages(t)))
    return links.where(F.lower("url").contains("fichadetalhe.asp")).select("page_id", "ano", X.query_param(col("url"), "fabricante").alias("fabricante"))


@query("h08_pagination_links", "SELECT 'https://h.example/c/catalogo.asp?pag=1&codigo=' || p_partkey AS from_url, 2 AS page, 'https://h.example/c/catalogo.asp?pag=p2&codigo=' || p_partkey AS url, '2' AS label FROM part")
def h08b(t):
    return P.pagination_links(P.page_links(catalog_pages(t)))


def catalog_site(t: Tables) -> DataFrame:
    """A catalogue of stored pages made of the parts: indexes of a hundred makers, makers of up to fifty models, a page a model, two list pages for each of two years, three sheets a year."""
    e = F.url_encode
    site = F.lit("https://h.example/")
    maker = F.concat(F.lit("M "), F.floor(col("p_partkey") / 50).cast("string"))
    p = t.spread("part", "p_partkey", "p_partkey", "p_name", "p_size").select("p_partkey", maker.alias("maker"), F.floor(col("p_partkey") / 5000).alias("index"), "p_name", "p_size", col("p_partkey").cast("string").alias("k"))
    model_url = F.concat(F.lit("catalogo.asp?fabricante="), e("maker"), F.lit("&varnome="), e("p_name"), F.lit("&codigo="), "k")
    a = lambda href, label: F.concat(F.lit("<a href='"), href, F.lit("'>"), label, F.lit("</a>"))
    page = lambda url, body: (F.concat(site, url).alias("url"), F.concat(F.lit("<body>"), body, F.lit("</body>")).alias("html"))
    options = p.select("index", "maker").distinct().groupBy("index").agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit("<option value=\""), "maker", F.lit('">'), "maker"))), "").alias("o"))
    indexes = options.select(*page(F.concat(F.lit("index.asp?n="), col("index").cast("string")), F.concat(F.lit("<select name=fabricante><option value=''>-"), "o", F.lit("</select>"))))
    models = p.groupBy("maker").agg(F.array_join(F.collect_list(F.concat(a(model_url, col("p_name")), a(model_url, F.lit("foto")))), " ").alias("links"))
    makers = models.select(*page(F.concat(F.lit("catalogofabricante.asp?fabricante="), e("maker")), "links"))
    dated = p.select("*", F.explode(F.array(*[(col("p_size") + n).cast("string") for n in (1950, 1960)])).alias("year"))
    own = lambda n: F.concat(F.lit("catalogo.asp?fabricante="), e("maker"), F.lit("&varnome="), e("p_name"), F.lit("&anoini="), "year", F.lit("&anofim="), "year", F.lit("&codmodelo="), "k", F.lit(f"&curpage={n}"))
    years = dated.groupBy("maker", "p_name", "k").agg(F.array_join(F.collect_list(a(own(1), F.concat(F.lit("ano "), "year"))), "").alias("links"))
    years = years.select(*page(model_url, F.concat("links", a(F.lit("sobre.asp?ano=2001"), F.lit("2001")))))
    sheet = lambda n, text: F.concat(F.lit("<a title='"), "maker", F.lit(" V"), F.lit(str(n)), F.lit("' href='fichadetalhe.asp?codigo="), "k", F.lit(str(n)), F.lit("'>"), F.lit(text), F.lit("</a>"))
    first = dated.select(*page(own(1), F.concat(sheet(1, ""), sheet(1, "ver"), sheet(2, "ver"), a(own(2), F.lit(">")), a(own(1), F.lit("1")))))
    second = dated.select(*page(own(2), F.concat(sheet(2, ""), sheet(3, "ver"), a(own(1), F.lit("1")))))
    pages = indexes.unionByName(makers).unionByName(years).unionByName(first).unionByName(second)
    return pages.select(F.xxhash64("url").alias("page_id"), "url", "html")


@query(
    "q28_catalog_discovery",
    """SELECT 'M ' || (p_partkey // 50) AS fabricante, p_name AS modelo, (p_size + y)::VARCHAR AS ano, p_partkey::VARCHAR || n AS codigo_ficha, 'V' || n AS modelo_texto, CASE WHEN n = 3 THEN 2 ELSE 1 END AS pagina_lista, CASE WHEN n = 3 OR n = 2 OR n = 1 THEN 'ver' END AS texto_link
  FROM part, (VALUES (1950), (1960)) v(y), (VALUES (1), (2), (3)) w(n)""",
)
def q28_discovery(t):
    """Manufacturers, models, years and applications chained over the stored pages of a catalogue."""
    apps = P.discover_catalog(P.page_elements(catalog_site(t)))["applications"]
    return apps.select("fabricante", "modelo", "ano", "codigo_ficha", "modelo_texto", col("pagina_lista").cast("int").alias("pagina_lista"), "texto_link")


LINK_GRAPH = r"""
WITH RECURSIVE raw AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"[^>]*>', 1)) AS href FROM pages),
lk AS (SELECT url AS a, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || href AS b FROM raw WHERE starts_with(href, '/')),
e AS (SELECT a, b FROM lk UNION SELECT b, a FROM lk),
r AS (SELECT page_id AS seed, url, 0 AS depth FROM pages WHERE page_id % 10 = 0 UNION SELECT seed, e.b, depth + 1 FROM r JOIN e ON e.a = r.url WHERE depth < 4)
SELECT seed, url, min(depth) AS depth FROM r GROUP BY 1, 2"""


@query("h09_frontier", f"SELECT seed, url, depth::INTEGER AS depth FROM ({LINK_GRAPH}) WHERE depth <= 4")
def h09(t):
    """What each tenth page reaches in four steps over the links of the stored pages, forward and back."""
    links = P.page_links(t.spread("pages", "page_id")).where(col("href").startswith("/"))
    ends = F.array(F.struct(col("from_url").alias("from_url"), col("url").alias("url")), F.struct(col("url").alias("from_url"), col("from_url").alias("url")))
    both = create_table_as(links.select(F.explode(ends).alias("e")).select("e.*").distinct(), "edges")  # one scan for both ways and all levels
    seeds = t.raw("pages").where("page_id % 10 = 0").select(col("page_id").alias("seed"), "url")
    return P.expand_frontier(seeds, both.withColumn("page", F.lit(1)), limit=None, levels=4).select("seed", "url", "depth")


@query("h11_titles", r"SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_extract(html, '<title[^>]*>((?s:.*?))</title>', 1), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) AS title FROM pages")
def h11(t):
    return t.raw("pages").select("page_id", P.page_title(col("html")).alias("title"))


@query(
    "q29_spec_sheets",
    "SELECT p_partkey AS page_id, 'Part ' || p_partkey AS page_title, 'MOTOR' AS \"group\", 'Tamanho' AS field, p_size::VARCHAR AS value, '' AS image_urls FROM part UNION ALL SELECT p_partkey, 'Part ' || p_partkey, 'MOTOR', 'Tipo', p_type, 'https://h.example/fotos/' || p_partkey || '.jpg' FROM part",
)
def q29(t):
    return P.spec_sheets(P.page_elements(catalog_pages(t), ["cell", "title"]))
