"""Catalogue pages as rows: the elements that one scan finds (operators.markup), and the layers of a catalogue as joins and filters over them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import PAGE_KEYS, build_query, host_of, is_error_url, is_group_header, normalize_label, normalize_text, page_number, path_of, query_param, same_catalog_signature, year_of
from tidemark.operators.markup import page_elements
from tidemark.operators.materialize import create_table_as, shared_folder, shuffles_dropped
from tidemark.operators.ranks import small
from tidemark.operators.relational import dedupe, dedupe_best, dedupe_last_at_first

col = F.col

#: Words of a page that asks for a check, words of an error page, and the word of a sheet (fixed values).
VALIDATION_TERMS = ["preencha o campo com os caracteres", "captcha", "valida", "validacao"]
ERROR_TERMS = ["ocorreu um erro", "internal server error", "500 - internal server error"]
SHEET_TERM = "ficha t"

#: Labels of a sheet's own controls, placeholders of a select (fixed values).
UI_LABELS = ["compartilhe", "busca detalhada", "avalie"]
PLACEHOLDERS = ["selecione", "todos", "-"]


def _entities(x: Column) -> Column:
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(char))
    return x


def plain_text(html: Column) -> Column:
    """Visible text: no scripts, styles, comments or tags; the common character references; white space squeezed."""
    x = F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1>|<!--.*?-->", " ")
    return normalize_text(_entities(F.regexp_replace(x, "<[^>]*>", " ")))


def page_title(html: Column) -> Column:
    return normalize_text(_entities(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)))


def _filled(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def _param(key: str) -> Column:
    """A query value of the link's url; blank ones count as absent."""
    return _filled(query_param(col("url"), key))


def _root(url: Column) -> Column:
    return F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def links_of(elements: DataFrame) -> DataFrame:
    """(page_id, position, href, url, label, title, shown, from_url) of the links among page elements; url is absolute."""
    x = elements.where("kind = 'link'")
    return x.select("page_id", "position", col("address").alias("href"), col("target").alias("url"), "label", "title", "shown", col("url").alias("from_url"))


def page_links(pages: DataFrame) -> DataFrame:
    return links_of(page_elements(pages, ["link"]))


def select_options(elements: DataFrame) -> DataFrame:
    """(page_id, position, fabricante, value, url) of the options of selects named after manufacturers. Blank values, blank labels and placeholders are skipped; of one address the last option stands at the place of the first."""
    x = elements.where("kind = 'option'").where(F.lower("name").rlike("fabricante|marca"))
    x = x.where((F.trim("address") != "") & (col("label") != "") & ~F.lower("label").isin(PLACEHOLDERS))
    url = build_query(F.concat(_root(col("url")), F.lit("/catalogofabricante.asp")), {"fabricante": col("address")})
    x = x.select("page_id", "position", col("label").alias("fabricante"), col("address").alias("value"), url.alias("url")).where(col("url").isNotNull())
    return dedupe_last_at_first(x, ["page_id", "url"], "position")


def model_links(links: DataFrame) -> DataFrame:
    """Catalogue links with a model and its code, and the reason of a rejected one."""
    x = links.where(F.lower("href").contains("catalogo.asp?") | F.lower("href").contains("catalogomodelo.asp?"))
    named, model = _param("varnome").isNotNull() | _param("modelo").isNotNull(), F.coalesce(_param("varnome"), _param("modelo"), _filled(col("label")))
    code = F.coalesce(_param("codigo"), _param("codmodelo"), _param("modelo"))
    reason = F.when(~named, "sem varnome/modelo nos parametros").when(model.isNull(), "modelo vazio")
    return x.select("*", model.alias("modelo"), code.alias("codigo_modelo"), reason.alias("rejected"))


def year_links(links: DataFrame) -> DataFrame:
    """Catalogue and sheet links with a year: from the query, else the label, else the address."""
    x = links.where(F.lower("href").contains("catalogo") | F.lower("href").contains("fichadetalhe"))
    year = F.coalesce(*[year_of(_param(k)) for k in ("ano", "anomod", "anofim", "anoini")], year_of(col("label")), year_of(col("url")))
    return x.select("*", year.alias("ano")).where(col("ano").isNotNull())


def richness(shown: Column, title: Column, label: Column, href: Column) -> Column:
    """Points of a link for what it tells: text to show 10, title 4, link text 2, the address of a sheet 1 (fixed values)."""
    has = lambda c, n: F.when(F.coalesce(c, F.lit("")) != "", n).otherwise(0)
    return has(shown, 10) + has(title, 4) + has(label, 2) + F.when(F.lower(href).contains("fichadetalhe.asp"), 1).otherwise(0)


def application_links(links: DataFrame) -> DataFrame:
    """links (with fabricante) to sheets with a code: codigo_ficha, url_ficha, modelo_texto, versao, titulo_aplicacao, texto_link; of one (page, code, address) the richest, the first of equals.

    modelo_texto is the text right inside a dark red font, else the title without the manufacturer, else the link's text.
    """
    title = normalize_text(F.regexp_replace(F.coalesce("title", F.lit("")), "<[^>]*>", " "))
    before = F.concat(F.coalesce("fabricante", F.lit("")), F.lit(" "))
    bare = F.when(F.startswith(title, before), F.trim(F.substr(title, F.length(before) + 1))).otherwise(title)
    # a title that is the manufacturer alone leaves nothing; the link's text is used only where there is no title at all
    shown = F.when(F.coalesce("shown", F.lit("")) != "", col("shown")).when(title != "", bare).otherwise(col("label"))
    x = links.where(F.lower("href").contains("fichadetalhe.asp")).where(_param("codigo").isNotNull())
    x = x.select("*", _param("codigo").alias("codigo_ficha"), col("url").alias("url_ficha"), shown.alias("modelo_texto"))
    x = x.withColumn("versao", F.coalesce(_filled(col("modelo_texto")), _filled(col("label")), query_param(col("url"), "varnome"), F.lit("")))
    x = x.withColumnsRenamed({"title": "titulo_aplicacao", "label": "texto_link", "href": "href_original"}).drop("shown", "url")
    points = richness(col("modelo_texto"), col("titulo_aplicacao"), col("texto_link"), col("href_original"))
    return dedupe_best(x, ["page_id", "codigo_ficha", "url_ficha"], points, col("position"))


def pagination_links(links: DataFrame, signed: bool = True) -> DataFrame:
    """(from_url, page, url, label): links to pages of the same list.

    Same host, a catalogue path, a look of pagination (a page key, a label for next, or digits), a page not before the current
    one, not the current address, and if signed a signature that agrees with the page's own; each once, to be read in the order
    of (page, url).
    """
    label = normalize_label(col("label"))
    keyed = F.lit(False)
    for k in PAGE_KEYS:
        keyed = keyed | _param(k).isNotNull()
    looks = keyed | label.contains("proxim") | F.trim("label").isin(">", ">>") | label.rlike("^[0-9]+$")
    host = host_of(col("url")).isNull() | (host_of(col("url")) == host_of(col("from_url")))
    path = F.lower(path_of(col("url"))).contains("catalogo.asp") | F.lower("href").contains("catalogo.asp")
    same = same_catalog_signature(col("url"), col("from_url")) if signed else F.lit(True)
    x = links.where(host & path & looks & same & (page_number(col("url")) >= page_number(col("from_url"))) & (col("url") != col("from_url")))
    return dedupe(x.select("from_url", page_number(col("url")).alias("page"), "url", "label", "position"), ["from_url", "url"], [col("position")]).drop("position")


def valid_year_pages(pages: DataFrame, status: Column | None = None) -> DataFrame:
    """(page_id, status, final_url, has_spec_link, has_error_text) of the year pages that count: fetched, with a link to a sheet and no error text."""
    code = F.lit(200) if status is None else status
    text = F.lower(plain_text(col("html")))
    sheet = page_links(pages).where(F.lower("href").contains("fichadetalhe.asp")).select("page_id").distinct().withColumn("has_spec_link", F.lit(True))
    checked = pages.select("page_id", code.alias("status"), col("url").alias("final_url"), (text.contains(ERROR_TERMS[0]) | is_error_url(col("url"))).alias("has_error_text"))
    return checked.join(sheet, "page_id").where((col("status") == 200) & ~col("has_error_text")).select("page_id", "status", "final_url", "has_spec_link", "has_error_text")


#: Words of 64 bits in a row of reach(): a row tells which of 512 seeds reach a page.
WORDS = 8


def _runs(blocks: Sequence[tuple[int, int]], most: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, rows) of neighbouring blocks (number, rows) that have at most so many rows together, or of one block."""
    lo = hi = total = None
    for block, rows in blocks:
        if lo is not None and total + rows <= most:
            hi, total = block, total + rows
            continue
        if lo is not None:
            yield lo, hi, total
        lo, hi, total = block, block, rows
    if lo is not None:
        yield lo, hi, total


def reach(seeds: DataFrame, edges: DataFrame, levels: int | None = None, most: int = 32_000_000, task: int = 500_000, hub: int = 4096) -> DataFrame:
    """All that seeds (seed, url) reach over edges (from_url, url) in levels steps: (seed, url, depth), depth the least number of steps.

    The result has up to seeds times pages rows, so nothing on the way holds a row for each. Addresses and seeds are numbered, seeds in
    the order of their addresses, and 512 of them are a block; a row (node, block) of a level tells by bits which seeds of the block
    first reach the node there. A step sends the last level's rows along the edges and joins the bits of one (node, block) by bit_or.
    One job takes as many neighbouring blocks as send at most `most` rows (and `task` rows for each shuffle partition), or one block;
    its shuffle files go when it ends. A page with more than `hub` edges is several keys. Bits become rows where the result is read.
    """
    spark = seeds.sparkSession
    cores, bits = spark.sparkContext.defaultParallelism, 64 * WORDS
    words = [f"w{i}" for i in range(WORDS)]
    any_of = lambda df: df.groupBy("node", "block").agg(*[F.bit_or(w).alias(w) for w in words])
    starts = create_table_as(seeds.select("seed", "url"), "seeds")
    by_place = starts.groupBy("seed").agg(F.min("url").alias("at")).repartitionByRange(-(-starts.count() // 200_000) or 1, "at", "seed").sortWithinPartitions("at", "seed")
    numbered = create_table_as(by_place.select("seed", F.monotonically_increasing_id().alias("n")), "numbered").select("seed", F.shiftright("n", 33).alias("range"), (col("n") % (1 << 33)).alias("n"))
    sizes = sorted(numbered.groupBy("range").count().collect())  # a row for 200,000 seeds
    offsets = spark.createDataFrame([(r[0], sum(x[1] for x in sizes[:i])) for i, r in enumerate(sizes)], "range long, before long")
    n = col("before") + col("n")
    numbered = numbered.join(F.broadcast(offsets), "range").select("seed", F.floor(n / bits).alias("block"), (n % bits).alias("bit"))
    urls = edges.select(F.explode(F.array("from_url", "url")).alias("url")).unionByName(starts.select("url")).distinct()
    nodes = create_table_as(urls.select(F.monotonically_increasing_id().alias("node"), "url"), "nodes")
    ids = lambda node, url: nodes.select(col("node").alias(node), col("url").alias(url))
    steps = create_table_as(edges.select("from_url", "url").join(ids("node", "from_url"), "from_url").join(ids("to", "url"), "url").select("node", "to"), "steps")
    degrees = create_table_as(steps.groupBy("node").agg(F.count("*").alias("n")), "degrees")
    hubs = small(degrees.where(col("n") > hub).select("node", F.ceil(col("n") / hub).cast("int").alias("parts")))
    steps = steps.join(hubs, "node", "left").select("node", F.coalesce(F.pmod(F.xxhash64("to"), "parts"), F.lit(0)).cast("int").alias("part"), "to")

    path = f"{shared_folder(spark)}/reach-{uuid.uuid4().hex}"

    def add(df: DataFrame, depth: int) -> None:
        with shuffles_dropped(spark):
            df.write.mode("append").parquet(f"{path}/depth={depth}")

    def found() -> DataFrame:
        return spark.read.schema(f"node long, block long, {', '.join(f'{w} long' for w in words)}, depth int").parquet(path)

    one = F.call_function("shiftleft", F.lit(1).cast("long"), (col("bit") % 64).cast("int"))
    first = starts.join(numbered, "seed").join(ids("node", "at"), col("url").eqNullSafe(col("at")))
    add(any_of(first.select("node", "block", *[F.when(F.floor(col("bit") / 64) == i, one).otherwise(F.lit(0)).alias(w) for i, w in enumerate(words)])), 0)
    depth, room = 0, min(most, task * int(spark.conf.get("spark.sql.shuffle.partitions")))
    while levels is None or depth < levels:
        seen = found()
        last = seen.where(col("depth") == depth).drop("depth")
        sent = last.select("node", "block").join(degrees, "node").groupBy("block").agg(F.sum("n").alias("n")).collect()  # a row for 512 seeds
        for lo, hi, rows in _runs(sorted((r.block, r.n) for r in sent), room):
            here, tasks = col("block").between(lo, hi), max(cores, -(-rows // task))
            at = last.where(here).join(hubs, "node", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
            to = at.repartition(tasks, "node", "part").join(steps.repartition(tasks, "node", "part"), ["node", "part"]).select(col("to").alias("node"), "block", *words)
            old = any_of(seen.where(here)).withColumnsRenamed({w: f"old_{w}" for w in words})
            new = any_of(to).join(old, ["node", "block"], "left").select("node", "block", *[col(w).bitwiseAND(F.bitwise_not(F.coalesce(f"old_{w}", F.lit(0).cast("long")))).alias(w) for w in words])
            add(new.where(reduce(lambda a, b: a.bitwiseOR(b), map(col, words)) != 0), depth + 1)
        if not sent:
            break
        depth += 1
    seen = found()
    tasks = max(cores, -(-seen.count() // 20_000))  # of 512 result rows each at most
    members = numbered.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bit", "seed"))).alias("s")).select("block", col("s.seed").alias("seeds"))
    x = seen.repartition(tasks, "node").join(nodes.repartition(tasks, "node"), "node").join(small(members, 2000), "block")
    x = x.select("seeds", "url", "depth", F.posexplode(F.array(*words)).alias("k", "word")).where("word <> 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i"))
    x = x.where(F.call_function("shiftright", "word", "i").bitwiseAND(F.lit(1).cast("long")) == 1)
    return x.select(F.get("seeds", col("k") * 64 + col("i")).alias("seed"), "url", "depth")


def expand_frontier(seeds: DataFrame, edges: DataFrame, limit: int | None = 30, levels: int | None = None, fits: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Breadth-first over stored pages: seeds (seed, url), edges (from_url, page, url) -> (seed, place, url, depth, unfinished, stopped).

    A seed's pages are visited in the order in which a queue holds them: by the place of the page that named them first, then
    by (page, url), limit pages and levels steps at most. A seed ends at a page whose address is an error: its visit is the last, stopped is
    true. unfinished: pages were left when the limit was reached. One round a level, each written before the next; a level holds
    at most limit pages of a seed, so a hub's neighbours never count for more. fits(url, seed's url): which edges a seed follows.
    limit None: everything within levels steps, (seed, url, depth) in no order, over error pages too, the same edges for all seeds (reach).
    """
    if limit is None:
        if fits:
            raise ValueError("fits needs a limit")
        return reach(seeds, edges, levels)
    roots = create_table_as(seeds.select("seed", col("url").alias("__root")), "seeds") if fits else None
    seen = create_table_as(seeds.select("seed", F.lit(0).alias("place"), "url", F.lit(0).alias("depth"), is_error_url(col("url")).alias("bad")), "frontier")
    left, depth = None, 0
    steps = edges.select(col("from_url").alias("__at"), "page", col("url").alias("__to"))
    queue = Window.partitionBy("seed").orderBy("place", "page", "url")
    while levels is None or depth < levels:
        ended = seen.where("bad").select("seed").distinct()
        last = seen.where(col("depth") == depth).join(ended, "seed", "left_anti").select("seed", "place", col("url").alias("__at"))
        named = last.join(steps, "__at")
        named = named.join(roots, "seed").where(fits(col("__to"), col("__root"))) if fits else named
        named = named.groupBy("seed", col("__to").alias("url")).agg(F.min(F.struct("place", "page")).alias("x")).select("seed", "url", "x.*")
        new = named.join(seen.select("seed", "url"), ["seed", "url"], "left_anti").withColumn("rank", F.row_number().over(queue)).where(col("rank") <= limit + 1)
        room = seen.groupBy("seed").agg(F.max("place").alias("at"), (limit - F.count("*")).alias("room"))
        new = create_table_as(new.join(room, "seed").select("seed", "url", "rank", "at", "room"), "frontier")
        over = new.where(col("rank") > col("room")).select("seed").distinct()
        left = over if left is None else left.unionByName(over)
        taken = new.where(col("rank") <= col("room")).select("seed", (col("at") + col("rank")).alias("place"), "url", F.lit(depth + 1).alias("depth"), is_error_url(col("url")).alias("bad"))
        first_bad = F.min(F.when(col("bad"), col("place"))).over(Window.partitionBy("seed"))  # limit rows of a seed
        taken = create_table_as(taken.withColumn("end", first_bad).where(col("end").isNull() | (col("place") <= col("end"))).drop("end"), "frontier")
        if taken.isEmpty():
            break
        seen, depth = create_table_as(seen.unionByName(taken), "frontier"), depth + 1
    left = seen.select("seed").limit(0) if left is None else left
    flags = left.distinct().withColumn("more", F.lit(True))
    stops = seen.where("bad").select("seed").distinct().withColumn("stop", F.lit(True))
    out = seen.join(flags, "seed", "left").join(stops, "seed", "left")
    stopped = F.coalesce("stop", F.lit(False))
    return out.select("seed", "place", "url", "depth", (F.coalesce("more", F.lit(False)) & ~stopped).alias("unfinished"), stopped.alias("stopped"))


def classify_fetch(pages: DataFrame, status: Column | None = None) -> DataFrame:
    """(page_id, status, reason, title): http error, validation, site error, unexpected page or success, in this order."""
    code = F.lit(200) if status is None else status
    low, text = F.lower(F.coalesce("html", F.lit(""))), F.lower(plain_text(col("html")))
    x = pages.select("page_id", "url", code.cast("int").alias("code"), low.alias("low"), text.alias("text"), page_title(col("html")).alias("title"))
    holds = lambda terms: F.exists(F.array(*map(F.lit, terms)), lambda w: col("low").contains(w) | col("text").contains(w))
    sent = F.lower("url").contains("fichadetalhevalida.asp")
    kinds = [
        (col("code") != 200, "http_error", F.concat(F.lit("http_status_"), col("code").cast("string"))),
        (sent, "validation_required", F.lit("redirected_to_fichadetalhevalida")),
        (holds(VALIDATION_TERMS), "validation_required", F.lit("captcha_or_validation_detected")),
        (holds(ERROR_TERMS), "site_error", F.lit("site_error_page")),
        (~col("text").contains(SHEET_TERM), "unexpected_page", F.lit("missing_ficha_tecnica_text")),
    ]
    found = F.coalesce(*[F.when(c, F.struct(F.lit(s).alias("status"), r.alias("reason"))) for c, s, r in kinds], F.struct(F.lit("success").alias("status"), F.lit("").alias("reason")))
    return x.select("page_id", found.alias("f"), "title").select("page_id", "f.*", "title")


def spec_sheets(elements: DataFrame) -> DataFrame:
    """(page_id, page_title, group, field, value, image_urls): long rows of each stored sheet, each (group, field, value) once.

    In table rows of two cells or more, cells pair up. A row whose only text is a title sets the group of what follows
    (GERAL before the first); controls are skipped. image_urls: absolute addresses of the value cell's images, by " | ".
    """
    text, cell = normalize_text(col("label")), col("kind") == "cell"
    cells = elements.where("kind IN ('cell', 'title')").select("page_id", "url", F.when(cell, col("line")).alias("line"), F.when(cell, F.struct("position", text.alias("text"), "images")).alias("cell"), F.when(~cell, text).alias("page_title"))
    lines = cells.groupBy("page_id", "line").agg(F.any_value("url").alias("url"), F.sort_array(F.collect_list("cell")).alias("c"), F.max("page_title").alias("page_title"))
    lines = lines.withColumn("page_title", F.coalesce(F.max("page_title").over(Window.partitionBy("page_id")), F.lit(""))).where(F.size("c") >= 2)  # the title stands in the line null
    filled = F.filter("c", lambda c: c["text"] != "")
    alone = F.when(F.size(filled) == 1, F.get(filled, F.lit(0))["text"])
    lines = lines.withColumn("header", F.when(is_group_header(alone), alone)).where(F.size(filled) > 0)
    w = Window.partitionBy("page_id").orderBy("line")
    lines = lines.withColumn("group", F.coalesce(F.last("header", ignorenulls=True).over(w), F.lit("GERAL"))).where(col("header").isNull())
    pair = F.explode(F.sequence(F.lit(0), F.floor(F.size("c") / 2).cast("int") - 1))
    x = lines.select("page_id", "page_title", "line", "url", "group", "c", pair.alias("k")).select("page_id", "page_title", "line", "url", "group", "k", F.get("c", col("k") * 2).alias("f"), F.get("c", col("k") * 2 + 1).alias("v"))
    x = x.where((col("f.text") != "") & (col("v.text") != "") & ~F.lower("f.text").isin(UI_LABELS))

    def absolute(src: Column) -> Column:
        s = F.translate(normalize_text(src), "\\", "/")
        return F.when(s.rlike("^https?://"), s).otherwise(F.concat(_root(col("url")), F.lit("/"), F.regexp_replace(s, "^[./]+", "")))

    x = x.select("page_id", "page_title", "line", "k", "group", col("f.text").alias("field"), col("v.text").alias("value"), F.array_join(F.transform("v.images", absolute), " | ").alias("image_urls"))
    x = dedupe(x, ["page_id", "group", "field", "value"], [col("line"), col("k")])
    return x.select("page_id", "page_title", "group", "field", "value", "image_urls")


def discover_catalog(elements: DataFrame) -> dict[str, DataFrame]:
    """The layers of a catalogue over stored pages: manufacturers, models, years, applications. A layer's links are those of the pages that the layer above names, joined by address, each once between layers."""
    elements = create_table_as(elements, "elements")
    links = links_of(elements)
    makers = dedupe_last_at_first(select_options(elements).drop("page_id"), ["url"], "position")
    at = lambda df, key, *cols: links.join(df.select(col(key).alias("from_url"), *cols), "from_url")
    models = model_links(at(makers, "url", "fabricante")).where("rejected IS NULL").withColumnRenamed("url", "url_modelo")
    models = dedupe(models.select("fabricante", "modelo", "codigo_modelo", "url_modelo", "href", "label", "position"), ["fabricante", "url_modelo"], [col("position"), col("href"), col("label")]).drop("position")
    years = year_links(at(models, "url_modelo", "fabricante", "modelo")).withColumnRenamed("url", "url_ano")
    years = dedupe(years.select("fabricante", "modelo", "ano", "url_ano", col("from_url").alias("url_modelo_origem"), "position"), ["fabricante", "modelo", "ano", "url_ano"], [col("position")]).drop("position")
    seeds = create_table_as(years.select(F.struct("fabricante", "modelo", "ano", "url_ano").alias("seed"), col("url_ano").alias("url")), "years")
    steps = create_table_as(pagination_links(links, signed=False), "steps")
    reached = expand_frontier(seeds, steps, fits=same_catalog_signature)
    lists = reached.select("seed.fabricante", "seed.modelo", "seed.ano", col("seed.url_ano").alias("url_ano_origem"), col("url").alias("from_url"), (col("place") + 1).alias("pagina_lista"))
    found = application_links(links.join(lists, "from_url"))
    names = ["fabricante", "modelo", "ano", "codigo_ficha", "url_ficha"]
    apps = dedupe(found.withColumnRenamed("from_url", "url_lista_atual"), names, [col("pagina_lista"), col("position")]).drop("page_id", "position")
    return {"manufacturers": makers, "models": models, "years": years, "applications": apps}
