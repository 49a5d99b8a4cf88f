"""Stored catalogue pages: the scan on odd markup, the layers' rules on whole pages, the frontier against a queue."""

import random
from collections import deque
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import pages as P
from tidemark.operators.markup import Against, absolute, elements
from tidemark.operators.prefixes import longest_prefix
from tidemark.plans import layer_jobs as L
from tidemark.plans import market_jobs as K
from tidemark.plans.registry import QUERIES
from tidemark.plans.report_jobs import application_pages
from tidemark.sources.tables import Tables

col = F.col
AT = "https://h.example/c/catalogo.asp?fabricante=Fiat&curpage=2"


def pages(spark, *htmls, url=AT):
    return spark.createDataFrame([(i, url, h) for i, h in enumerate(htmls)], "page_id long, url string, html string")


def kinds(html, kind):
    return [x for x in elements(html) if x[0] == kind]


def test_links_however_they_are_quoted():
    html = "<A HREF=x.asp?a=1&amp;b title='T > t'>l <b>b</b></A><a href='y'>q<a href=\"z\">r</a><a name=n>no</a><!-- <a href=w> --><script>'<a href=v>'</script><a href=\"u>x</a>"
    assert [(x[4], x[5], x[6]) for x in kinds(html, "link")] == [("x.asp?a=1&b", "l b", "T > t"), ("y", "q", ""), ("z", "r", ""), ('"u', "x", "")]


def test_a_dark_red_font_gives_the_text_right_inside_it():
    html = "<a href=1><font color=DarkRed>Uno <b>no</b> 1.0<br>x</font> ver</a><a href=2><font color=red>r</font></a>"
    assert [(x[5], x[7]) for x in kinds(html, "link")] == [("Uno no 1.0 x ver", "Uno 1.0 x"), ("r", "")]


def test_cells_of_nested_and_unclosed_tables():
    html = "<table><tr><th>h<td>A<td>B <img src='i.jpg'><tr><td>C</td><td><table><tr><td>n1</td><td>n2</td></tr></table></td></tr></table><td>out</td>"
    cells = [(x[2], x[5], x[8]) for x in kinds(html, "cell")]
    assert cells[:3] == [(1, "A", []), (1, "B", ["i.jpg"]), (2, "C", [])]
    assert [x[1] for x in cells if x[0] == 2] == ["C", "n1 n2", "n1", "n2"] and [x[1] for x in cells if x[0] == 3] == ["n1", "n2"]
    assert "out" not in [x[1] for x in cells]


@pytest.mark.parametrize("part", ['<a href="', "<", "<a b='", "<script>", "<!--", "<td>", "<a href=x>", "<select><option>"])
def test_odd_markup_takes_linear_time(part):
    import time

    took = []
    for n in (5_000, 40_000):
        began = time.perf_counter()
        elements(part * n)
        took.append(time.perf_counter() - began)
    assert took[1] < 40 * took[0] + 0.5


def test_no_page_and_no_tags(spark):
    assert elements("") == [] and elements("plain > text <") == []
    assert P.page_elements(pages(spark, None, "")).collect() == []


def test_plain_addresses_are_put_together_as_others_are():
    r = random.Random(8)
    bits = ["a", "b.asp", "/", "..", ".", "?", "x=1", "&", "#", ":", "http:", "//", ";", "%20", " ", "é", "\\", "@", ""]
    bases = ["https://h.example/c/catalogo.asp?pag=1", "http://h", "mailto:x", "https://h/a/../b//c/./d;p?q#f", "//h/x/y", "/x/y", "http://[bad/x", "http:x/y", "https://h/a/..", "", None]
    for _ in range(20_000):
        base, href = r.choice(bases), "".join(r.choice(bits) for _ in range(r.randrange(7)))
        assert Against(base)(href) == absolute(base, href), (base, href)


def test_whole_tags_and_odd_ones_are_read_alike():
    html = "<a/href=u>1</a><a x='>' href=\"v\"/>2</a><a href = w >3</a><A HREF=y/ href=z>4</a><a b='1'c='2' href>5</a>"
    assert [(x[4], x[5]) for x in kinds(html, "link")] == [("u", "1"), ("v", "2"), ("w", "3"), ("y/", "4"), ("", "5")]


def test_pages_of_a_narrow_table_are_scanned_by_all_tasks_and_once(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    for made in (L.catalog_pages(t), application_pages(t)):
        assert t.raw("part").rdd.getNumPartitions() == 1
        assert P.page_elements(made).select(F.spark_partition_id()).distinct().count() > 2 * spark.sparkContext.defaultParallelism
    for name in ("h04_options", "q29_spec_sheets"):
        assert QUERIES[name](spark, t.dir)._jdf.queryExecution().sparkPlan().toString().count("MapInArrow") == 1, name


def test_kinds_and_batches_change_no_element(spark):
    html = "<title>t</title><a href=x>l</a><table><tr><td>c</table><select name=marca><option value=1>o</select>"
    rows = pages(spark, *[html] * 7)
    every = sorted(map(str, P.page_elements(rows).collect()))
    assert len(every) == 28 and sorted(map(str, P.page_elements(rows, rows=3).collect())) == every
    assert sorted(map(str, P.page_elements(rows, ["link", "cell"], rows=5).collect())) == [x for x in every if "kind='link'" in x or "kind='cell'" in x]


def test_options(spark):
    html = "<select name=xMARCA><option value=' '>a</option><option value=1>Selecione<option value=2>TODOS<option value=3>-<option value='a b'>A<option value=c>C<option value='a b'>B</select><select name=cor><option value=9>z</select>"
    got = sorted((r.position, r.fabricante, r.value, r.url) for r in P.select_options(P.page_elements(pages(spark, html))).collect())
    url = "https://h.example/catalogofabricante.asp?fabricante="
    assert [x[1:] for x in got] == [("B", "a b", url + "a+b"), ("C", "c", url + "c")]


def links(spark, *anchors, url=AT):
    return P.page_links(pages(spark, "".join(f"<a href='{h}'>{t}</a>" for h, t in anchors), url=url))


def test_models_years_and_pagination(spark):
    found = links(spark, ("/catalogo.asp?varnome=Uno&codmodelo=7", "x"), ("/catalogo.asp?modelo=12", "y"), ("/CatalogoModelo.asp?varnome=&modelo=", "z"), ("/lista.asp?varnome=Uno", "n"), ("/catalogo.asp?codigo=1", "w"))
    got = {r.label: (r.modelo, r.codigo_modelo, r.rejected) for r in P.model_links(found).collect()}
    assert got == {"x": ("Uno", "7", None), "y": ("12", "12", None), "z": ("z", None, "sem varnome/modelo nos parametros"), "w": ("w", "1", "sem varnome/modelo nos parametros")}
    found = links(spark, ("/catalogo.asp?ano=x&anofim=1998", "2001"), ("/fichadetalhe.asp?a=1", "flex 2011 1.0"), ("/catalogo2005.asp", "n"), ("/sobre.asp?ano=1999", "s"), ("/catalogo/2007/x", "u"))
    assert {r.href: r.ano for r in P.year_links(found).collect()} == {"/catalogo.asp?ano=x&anofim=1998": "1998", "/fichadetalhe.asp?a=1": "2011", "/catalogo/2007/x": "2007"}
    found = links(
        spark,
        ("catalogo.asp?curpage=p3x", "três"), ("catalogo.asp?curpage=1", "1"), ("catalogo.asp?fabricante=FIAT&x=1&pg=2", ">"), ("catalogo.asp?varnome=Uno", "Próxima"), ("catalogo.asp?fabricante=Ford&curpage=4", "4"),
        ("https://other.example/catalogo.asp?curpage=9", "9"), ("lista.asp?curpage=5", "5"), ("catalogo.asp?curpage=2&fabricante=Fiat", "fim"), ("catalogo.asp?y=2", "mais"), ("catalogo.asp?fabricante=Fiat&curpage=2", "2"), ("catalogo.asp?curpage=p3x", "de novo"),
    )
    got = sorted((r.page, r.url.split("?")[1], r.label) for r in P.pagination_links(found).collect())
    assert got == [(2, "curpage=2&fabricante=Fiat", "fim"), (2, "fabricante=FIAT&x=1&pg=2", ">"), (3, "curpage=p3x", "três")]


def test_applications_keep_the_richest_link(spark):
    html = (
        "<a href='fichadetalhe.asp?codigo=1'></a><a href='fichadetalhe.asp?codigo=1' title='Fiat Uno &lt;b&gt;S&lt;/b&gt;'>ver</a><a href='fichadetalhe.asp?codigo=1' title='Fiat Tipo'>ver</a>"
        "<a href='FichaDetalhe.asp?codigo=2&varnome=V'><font color=darkred>Mobi</font></a><a href='fichadetalhe.asp?codigo='>none</a><a href='ficha.asp?codigo=3'>none</a><a href='fichadetalhe.asp?codigo=4&varnome=V'></a><a href='fichadetalhe.asp?codigo=5'>L</a>"
    )
    rows = P.application_links(P.page_links(pages(spark, html)).withColumn("fabricante", F.lit("Fiat"))).collect()
    assert {r.codigo_ficha: (r.modelo_texto, r.versao) for r in rows} == {"1": ("Uno S", "Uno S"), "2": ("Mobi", "Mobi"), "4": ("", "V"), "5": ("L", "L")}


def test_sheets(spark):
    html = (
        "<title> Car  X </title><table><tr><td>a</td><td>1</td></tr><tr><td>MOTOR</td><td></td></tr><tr><td>Torque</td><td>10<img src='.\\f\\a.jpg'><img src='http://o.example/b.png'></td><td>Peso</td><td></td><td>odd</td></tr>"
        "<tr><td>Compartilhe</td><td>x</td></tr><tr><td>Torque</td><td>10</td></tr><tr><td>lone</td></tr><tr><th>T</th><th>H</th></tr><tr><td>V8</td><td></td></tr></table><img src=c.jpg>"
    )
    got = sorted((r.group, r.field, r.value, r.image_urls, r.page_title) for r in P.spec_sheets(P.page_elements(pages(spark, html))).collect())
    assert got == [("GERAL", "a", "1", "", "Car X"), ("MOTOR", "Torque", "10", "https://h.example/f/a.jpg | http://o.example/b.png", "Car X")]


def test_fetches(spark):
    cases = ["<p>ficha tecnica: rodas de ferro fundido", "<p>Ocorreu um erro", "<b>Valida</b>", "<p>Verificar ficha t", "nothing", "<p>500 - Internal <b>x", None]
    got = {r.page_id: (r.status, r.reason) for r in P.classify_fetch(pages(spark, *cases)).collect()}
    none = ("unexpected_page", "missing_ficha_tecnica_text")
    assert got == {0: ("success", ""), 1: ("site_error", "site_error_page"), 2: ("validation_required", "captcha_or_validation_detected"), 3: ("success", ""), 4: none, 5: none, 6: none}
    assert P.classify_fetch(pages(spark, "ficha t"), F.lit(302)).first().reason == "http_status_302"
    assert P.classify_fetch(pages(spark, "ficha t", url="https://h/FichaDetalheValida.asp?x")).first().reason == "redirected_to_fichadetalhevalida"


def queue_walk(seed, edges, limit):
    """The plain version: one queue."""
    queue, visited, out = deque([seed]), set(), []
    while queue and len(out) < limit:
        url = queue.popleft()
        visited.add(url)
        out.append(url)
        if url.lower().endswith("/erro.asp"):
            return out, False, True
        for _, to in sorted({(p, t) for f, p, t in edges if f == url}):
            if to not in visited and to not in queue:
                queue.append(to)
    return out, bool(queue), False


@pytest.mark.parametrize("seed", [1, 2])
def test_frontier_equals_a_queue(spark, seed):
    r = random.Random(seed)
    urls = [f"https://h/p{i}" for i in range(40)] + ["https://h/x/Erro.asp"]
    edges = sorted({(r.choice(urls[:40]), r.randrange(3), r.choice(urls[: 41 if seed == 2 else 40])) for _ in range(90)})
    one = {(f, t): p for f, p, t in reversed(edges)}  # a page names an address under one number
    edges = [(f, p, t) for (f, t), p in one.items()]
    seeds = [(i, u) for i, u in enumerate(r.sample(urls[:40], 6))]
    got = P.expand_frontier(spark.createDataFrame(seeds, "seed int, url string"), spark.createDataFrame(edges, "from_url string, page int, url string"), limit=7)
    found = {}
    for x in sorted(got.collect(), key=lambda x: (x.seed, x.place)):
        found.setdefault(x.seed, ([], x.unfinished, x.stopped))[0].append(x.url)
    assert found == {s: queue_walk(u, edges, 7) for s, u in seeds}


@pytest.mark.parametrize("literal", [1000, 2])
def test_longest_prefix(spark, literal):
    r = random.Random(3)
    word = lambda n: "".join(r.choice("ab ") for _ in range(r.randrange(n)))
    aliases = sorted({word(5) for _ in range(30)} | {"aba"})
    keys = [(i, word(9)) for i in range(300)] + [(300, None)]
    df = longest_prefix(spark.createDataFrame(keys, "i int, k string"), "k", spark.createDataFrame([(a, f"v{a}") for a in aliases], "alias string, v string"), "alias", "v", "out", literal)
    want = {i: max((a for a in aliases if a and k and k.startswith(a)), key=len, default=None) for i, k in keys}
    assert {x.i: x.out for x in df.collect()} == {i: None if a is None else f"v{a}" for i, a in want.items()}


def test_segments_of_rows(spark):
    rows = [["A+B", "1"], ["A + B", "2"], ["Totalizador", "3"], ["C+D", "4"], ["Motos", "5"], ["E) Mótos", "6"], ["", "Outros 7"], ["x", "Autos"], ["", "Autosx"], ["D) Ônibus", "--", "-1,5", "1.234"], ["Subtotal", "9,5%", "-3"]]
    df = spark.createDataFrame([("m/2026_03.pdf", i, c) for i, c in enumerate(rows)], "path string, row_number int, cells array<string>")
    got = {r.row_number: r.segment_code for r in K.segment_of(df).collect()}
    assert got == {0: "autos_comerciais_leves", 1: "autos_comerciais_leves", 2: "total", 3: "caminhoes_onibus", 4: "motos", 5: "motos", 6: "outros", 9: "onibus", 10: "subtotal"}
    out = K.normalize_registrations(df)
    assert {(r.segment_code, r.segmento, r.mes_atual) for r in out.collect()} == {("autos_comerciais_leves", "Autos + Comerciais Leves", 1), ("total", "Total", 3), ("caminhoes_onibus", "Caminhoes + Onibus", 4), ("motos", "Motos", 5), ("outros", "Outros", 7), ("onibus", "Onibus", 1234)}
    assert [r.segment_code for r in K.missing_codes(out).orderBy("place").collect()] == ["autos", "comerciais_leves", "caminhoes", "subtotal", "implementos_rodoviarios"]


def test_numbers_and_periods_tell_their_errors(spark):
    r = spark.range(1).select(
        T.int_error(F.lit("12x")).alias("a"), T.int_error(F.lit("--")).alias("b"), T.int_error(F.lit("1.234,5")).alias("c"), T.period_error(F.lit("x/2026_13.pdf")).alias("d"), T.period_error(F.lit("x/y.pdf")).alias("e"), T.period_error(F.lit("x/2026_01.pdf")).alias("f"),
        T.reference_period(F.lit("m/2026/ 04/x.pdf")).cast("string").alias("g"), T.page_number(F.lit("http://a/?pg=p2&pagina=x")).alias("h"),
    ).first()
    assert tuple(r) == ("not a whole number: 12x", None, None, "invalid month: 13", "no period in the path", None, "2026-04-01", 2)


def test_the_frontier_of_stored_pages_scans_them_once(spark, monkeypatch):
    edges = []
    real = P.expand_frontier
    monkeypatch.setattr(P, "expand_frontier", lambda seeds, e, **more: (edges.append(e), real(seeds, e, **more))[1])
    QUERIES["h09_frontier"](spark, "/root/testdata/sf0.001")
    plan = edges[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and "pages.parquet" not in plan


def plain_search(seeds, edges, levels):
    """Least steps from each seed, one seed after the other."""
    after, out = {}, {}
    for f, t in edges:
        after.setdefault(f, set()).add(t)
    for seed, url in seeds:
        found, last, depth = {url: 0}, [url], 0
        while last and (levels is None or depth < levels):
            last, depth = sorted({t for f in last for t in after.get(f, ()) if t not in found}), depth + 1
            found.update(dict.fromkeys(last, depth))
        for to, n in found.items():
            out[seed, to] = min(n, out.get((seed, to), n))
    return out


@pytest.mark.parametrize(("levels", "most"), [(3, 32_000_000), (None, 2000)])
def test_reach_equals_a_plain_search(spark, levels, most):
    r = random.Random(5)
    urls = [f"https://h/p{i}" for i in range(150)] + ["https://h/x/Erro.asp"]
    edges = [(r.choice(urls), r.choice(urls)) for _ in range(450)] + [(urls[0], u) for u in urls[:20]] + [(urls[1], urls[2])] * 2
    seeds = [(i, r.choice(urls)) for i in range(1200)] + [(1200, None), (1201, "https://h/alone"), (1202, urls[3]), (1202, urls[4]), (1203, urls[5]), (1203, urls[5])]
    rows = P.reach(spark.createDataFrame(seeds, "seed int, url string"), spark.createDataFrame(edges, "from_url string, url string"), levels, most=most, hub=3).collect()
    got = {(x.seed, x.url): x.depth for x in rows}
    assert len(got) == len(rows)
    assert got == plain_search(seeds, edges, levels)


def test_runs_hold_neighbouring_blocks():
    assert list(P._runs([(0, 5), (1, 5), (2, 1), (4, 20), (5, 1)], 10)) == [(0, 1, 10), (2, 2, 1), (4, 4, 20), (5, 5, 1)]
    assert list(P._runs([], 10)) == []


@pytest.mark.parametrize("third", ["/c", "/x/Erro.asp"])
def test_the_frontier_of_stored_pages_writes_no_row_for_each_pair(spark, tmp_path, third):
    """Pages of one host that share their links: each reaches all others, also over an error page."""
    named = ["/a", "/b", third]
    site = [(10 * i, f"https://h.example/en/{i}", "".join(f'<a class="n" href="{u}">t</a>' for u in (named[i % 3], named[(i + 1) % 3]))) for i in range(600)]
    spark.createDataFrame(site, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    staged = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(staged.rglob("*.parquet"))
    got = {(x.seed, x.url): x.depth for x in QUERIES["h09_frontier"](spark, str(tmp_path)).collect()}
    links = [(u, f"https://h.example{named[(i + k) % 3]}") for i, (_, u, _) in enumerate(site) for k in (0, 1)]
    assert got == plain_search([(i, u) for i, u, _ in site], links + [(t, f) for f, t in links], 4)
    assert len(got) == 600 * 603
    written = sum(pq.read_metadata(f).num_rows for f in set(staged.rglob("*.parquet")) - before if f.is_file())
    assert written < len(got) / 20
