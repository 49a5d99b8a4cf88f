from collections import Counter

from tidemark.llm import html_main as hm

SCHEMA = "page_id long, url string, html string, text string"
HEAD = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"


def page(body, n=0):
    return f"{HEAD}<nav><a href='/a'>Home</a></nav><div class='ad'>Buy now, cheap offers of all kinds for everyone</div>{body}<footer>&copy; site &middot; words</footer></body></html>"


def test_pages(spark):
    article = "<article><h1>Title &amp; more</h1><p>First <b>bold</b>word  text<br>line<p>Second &lt;p&gt; caf&eacute;<div class='comments'><p>A reader says something long and odd</p></div></article>"
    rows = [(i, f"http://h.example/{i}", page(article), "clash") for i in range(5)]
    rows += [
        (10, None, page("<div id='content-12'><p>Only a div with some words.</p></div><div class='sidebar'>side</div>"), "c"),
        (11, "http://h.example/x", "", "c"),
        (12, "http://h.example/y", None, "c"),
        (13, "http://h.example/z", "no markup at all", "c"),
        (14, "bad url", "<html><body><form><p>form</p></form></body></html>", "c"),
        (15, "http://h.example/deep", "<div>" * 30_000 + "deep text" + "<p " * 10, "c"),
        (0, "http://h.example/0", page(article), "c"),
    ]
    got = [(r.page_id, r) for r in hm.extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(got) == len(rows)
    by = dict(got)
    want = "Title & more First boldword text line Second <p> café"
    assert all(by[i].text == want and by[i].n_chars == len(want) and by[i].by_host for i in range(5))
    assert by[10].text == "Only a div with some words." and by[11].text == "" and by[12].text == "" and by[14].text == "" and by[13].text == "no markup at all"
    assert hm.extract_main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_quoted_brackets_and_unclosed_tags():
    p = hm.Page(page('<article data-x="a>b"><p>One<p>Two<ul><li>x<li>y</ul><!-- <p>no</p> --><textarea>t</textarea></article>'))
    assert p.extract(None)[0] == "One Two x y"
    assert hm.Page("<div class='post-77 big'>a</div>").names[1] == ".big.post-#"
    long = hm.Page(page(f'<article title="{"x > y " * 2000}"><p>One text of some length</article>'))
    assert long.extract(None)[0] == "One text of some length"


def test_names_of_furniture_do_not_delete_an_article():
    body = " ".join(f"word{k}" for k in range(60))
    for names in ("post related-reading", "search-engines", "share-price", "social-history entry", "alert-systems", "discussion"):
        assert hm.Page(page(f'<main class="{names}"><p>{body}</p></main>')).extract(None)[0] == body
        inner = hm.Page(page(f'<main><div class="{names}"><p>{body}</p></div></main>'))
        assert inner.extract(None)[0] == body
    side = hm.Page(page(f"<main><p>{body}</p><div class='related'>Read more of this</div><div class='comments'><p>{body[:120]}</p></div></main>"))
    assert side.extract(None)[0] == body


def test_title_and_lead_beside_the_body():
    body = " ".join(f"word{k}" for k in range(200))
    p = hm.Page(page(f"<article><h1>A title</h1><p>A lead.</p><div class='body'><p>{body}</p></div></article>"))
    assert p.extract(None)[0] == f"A title A lead. {body}"


def test_a_body_without_its_tag():
    for html in ("Hello plain <b>text", "<p>Hello plain</p><p>text</p>", "<html><head><title>t</title></head><p>Hello plain text</p></html>", "<html><h1>Hello</h1><p>plain text</p><nav><a href=x>menu</a></nav></html>", "<nav><a href=x>m</a></nav>Hello plain text"):
        assert hm.Page(html).extract(None)[0] == "Hello plain text", html


def test_links_inside_paragraphs_are_text():
    body = " ".join(f"<a href=/{k}>word{k}</a>" for k in range(40))
    p = hm.Page(page(f"<div><p>See {body} too.</p></div><div><ul><li><a href=/m>menu entry of some length</a></li></ul></div>"))
    assert p.extract(None)[0] == "See " + " ".join(f"word{k}" for k in range(40)) + " too."
    dense = hm.Page("<div>" + "<a href=/x>linked words here</a> and plain ones. " * 3 + "</div>")
    assert dense.extract(None)[0] == " ".join(["linked words here and plain ones."] * 3)


def test_no_block_beside_the_longest_is_lost():
    long, short = " ".join(f"word{k}" for k in range(100)), "eight words stand in the block beside it"
    assert hm.Page(page(f"<div id=w><div class=a>{long}</div><div class=b>{short}</div></div>")).extract(None)[0] == f"{long} {short}"
    assert hm.Page(page(f"<div id=w><div class=a>{long}</div><div class=sidebar>{short}</div></div>")).extract(None)[0] == long


def test_planted_texts_are_found_whole():
    """Token precision and recall of made pages whose main text is known."""
    import random

    rng, hit, found, want = random.Random(9), 0, 0, 0
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    for n in range(150):
        paragraphs = [" ".join(word() for _ in range(rng.randrange(5, 60))) for _ in range(rng.randrange(1, 8))]
        inner = "".join(rng.choice(["<p>{}</p>", "<p>{}", "<div>{}</div>", "<section><p>{}</p></section>"]).format(x) for x in paragraphs)
        title = " ".join(word() for _ in range(4))
        main = rng.choice(["<article><h1>{}</h1>{}</article>", "<main><h2>{}</h2><div class=t>{}</div></main>", "<div class='post-body x{n}'><h1>{}</h1>{}</div>", "<div id=a><div>{}</div><div>{}</div></div>"]).replace("{n}", str(n)).format(title, inner)
        menu = "<ul>" + "".join(f"<li><a href=/{k}>{word()}</a>" for k in range(8)) + "</ul>"
        html = f"{HEAD}<header>{word()} {word()}</header><nav>{menu}</nav>{main}<div class=comments><p>{word()} {word()} {word()}</p></div><aside>{word()}</aside><div class='cookie-notice'>{word()} {word()}</div><footer>{menu}</footer>"
        got, true = Counter(hm.Page(html).extract(None)[0].split()), Counter(f"{title} {' '.join(paragraphs)}".split())
        hit, found, want = hit + (got & true).total(), found + got.total(), want + true.total()
    assert hit >= 0.99 * want and hit >= 0.99 * found


def test_a_stub_under_the_hosts_path_falls_back(spark):
    body = " ".join(f"word{k}" for k in range(80))
    rows = [(i, f"http://h.example/{i}", page(f"<article><p>{body} {i}</p></article>"), "c") for i in range(4)]
    rows += [(9, "http://h.example/9", page(f"<article></article><div id='x'><p>{body}</p></div>"), "c")]
    got = {r.page_id: r for r in hm.extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[9].text == body and not got[9].by_host and got[0].by_host


def test_odd_markup_is_linear():
    import time

    for html in ("<a" * 100_000, "<a b='" * 50_000, '<p class="' * 50_000, "<!--" * 100_000, "<p>" * 50_000, "<div><p>" * 20_000, "<![CDATA[" * 50_000, "<" * 300_000, "</" * 100_000, "<b>" * 30_000 + "x", "<script>" * 30_000):
        began = time.perf_counter()
        hm.Page(html).extract(None)
        assert time.perf_counter() - began < 5


def test_tags_match_a_plain_scan():
    """Against a scan, character after character, of well-formed pages."""
    import random

    rng = random.Random(3)

    def plain(html):
        out, at = [], 0
        while at < len(html):
            if html[at] == "<":
                quote, end = "", at + 1
                while quote or html[end] != ">":
                    quote = "" if html[end] == quote else quote or (html[end] if html[end] in "\"'" else "")
                    end += 1
                out.append((at, end + 1))
                at = end
            at += 1
        return out

    for _ in range(200):
        parts = [rng.choice(["text ", "a & b", "<p>", "</p>", "<div class='a > b'>", '<i id="x\'>">', "<br/>", "</div>", "<h1 a=b c>", "x"]) for _ in range(30)]
        assert [t[:2] for t in hm.tags("".join(parts))] == plain("".join(parts))
