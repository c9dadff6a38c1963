from __future__ import annotations

import time
from collections import Counter
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from shopfunnel.llm import html
from shopfunnel.llm.html import extract, main_text, subtrees, template_subtrees


def test_article_of_a_page():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>x</p>";</script></head>
    <body><header>Site</header><nav><ul><li>Menu<li>More</ul></nav><!-- <p>no</p> --><div class="ad box">Buy</div>
    <article><header><h1>Head &amp; line</h1></header><p><b>One  two<br><p>a &lt;b&gt; &eacute;&#233;&nbsp;z
    </p><div class=notice>Mind</div>loose <i>te</i>xt<form><p>Mail</p></form><ul><li>x<li>y</ul>
    <section id="comments"><article><p>Reader</p></article></section><aside>Aside</aside></article>
    <footer>&copy; F</footer>"""
    assert main_text(page) == "Head & line\nOne two\na <b> éé z\nloose text\nx\ny"


def test_pages_without_an_article():
    assert main_text("<body><div id=sidebar>s</div><div><p>a<p>b</div></body>") == "a\nb"
    assert main_text("<main>m<div hidden>h</div></main><p>out") == "m"
    assert main_text("just text &amp more") == "just text & more"
    assert [main_text(x) for x in (None, "", "<p>", "<", "<!-- open", "<script>x")] == ["", "", "", "<", "", ""]
    assert main_text("<article><p>cut off") == "cut off"
    assert main_text("<p>" + "<div>" * 30_000 + "deep") == "deep"


def test_template_of_a_host_goes(spark):
    rows = []
    for k in range(12):
        body = f"<div><div>Same on all pages</div><p>Own text {k}</p><p>Common line</p><div>Rare {k % 6}</div></div>"
        rows.append((k, f"https://Site.example.com:80/{k}?q", body))
    rows += [(50, "http://other.example.com/", "<div><div>Same on all pages</div>x</div>"), (51, None, "<p>no url</p>"),
             (52, "http://site.example.com/n", None), (53, "not a url", "<p>y"), (1, rows[1][1], rows[1][2])]
    pages = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, row string, hashes int")
    got = extract(pages)
    assert got.columns == ["page_id", "url", "row", "hashes", "text"]
    texts = {r.page_id: r.text for r in got.collect()}
    assert texts[3] == "Own text 3\nCommon line\nRare 3" and texts[1] == "Own text 1\nCommon line\nRare 1"
    assert texts[50] == "Same on all pages\nx" and texts[51] == "no url" and texts[52] == "" and texts[53] == "y"
    assert got.filter("page_id = 1").count() == 2


def test_copies_of_an_article_stay(spark):
    page = "<nav>n</nav><article><p>Same article</p><p>Everywhere</p></article>"
    pages = spark.createDataFrame([(k, f"http://h.example.com/{k}", page) for k in range(20)], "page_id long, url string, html string")
    assert {r.text for r in extract(pages).collect()} == {"Same article\nEverywhere"}


def test_empty_table_and_long_page(spark):
    pages = spark.createDataFrame([(1, "http://h.example.com", "<article>" + "<p>word</p>" * 60_000)], "page_id long, url string, html string")
    assert extract(pages).select(F.length("text")).first()[0] == 5 * 60_000 - 1
    assert extract(pages.limit(0)).count() == 0


def test_deep_pages_are_parsed_whole():
    deep = 5_000
    page = f"<div><article><p>a</p>{'<div>' * deep}<nav>n</nav><p>in</p>{'</div>' * deep}<p>b</p></article></div>"
    assert main_text(page) == "a\nin\nb"
    assert main_text(page, template={1}) == "a\nin\nb"
    held = f"<article>{'<div>' * deep}<form>{'<div>' * deep}f{'</div>' * deep}</form>{'</div>' * deep}<p>b</p></article>"
    assert main_text(held) == "b" and len(subtrees(page.replace("article", "section"))) > 0


def test_template_of_one_of_many_layouts_goes(spark, monkeypatch):
    monkeypatch.setattr("shopfunnel.llm.html.TEMPLATE_ANYWAY", 10)
    rows = [(k, f"http://h.example.com/{k}", f"<div><div>Layout {k % 5}</div><p>Own {k}</p></div>") for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in extract(pages).collect()} == {f"Own {k}" for k in range(60)}


@pytest.mark.parametrize("tag", ["div", "section", "ul", "table", "figure"])
def test_copies_of_an_article_in_any_container_stay(spark, tag):
    """Six copies under six URLs of a host of fourteen pages."""
    inner = {"ul": "<li>Same</li>", "table": "<tr><td>Same</td></tr>"}.get(tag, "<p>Same</p>")
    page = f"<div>Menu</div><article><div class='body'><{tag}>{inner}</{tag}></div></article>"
    bare = f"<div><div>Menu</div><{tag}>{inner}</{tag}></div>"
    rows = [(k, f"http://h.example.com/{k}", page if k < 6 else f"<div>Menu</div><p>Own {k}</p>") for k in range(14)]
    rows += [(20 + k, f"http://copies.example.com/{k}", bare) for k in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in extract(pages).collect()}
    assert [texts[k] for k in range(6)] == ["Same"] * 6
    assert [texts[k] for k in range(6, 14)] == [f"Own {k}" for k in range(6, 14)]
    assert [texts[20 + k] for k in range(6)] == ["Menu\nSame"] * 6  # a page never loses all its text


@pytest.mark.parametrize(
    "unit", ["<a ", "<a '", "<a \"", "<a '\"", "<script ", "<!x", "<!--", "<a <b \"' ", "<svg", "</a ", "<a>'", "<p>", "<li><b>", "<script>"]
)
def test_long_broken_pages_take_time_in_proportion(unit):
    start = time.process_time()
    main_text(unit * (5_000_000 // len(unit) if len(unit) > 2 and ">" not in unit else 100_000))
    assert time.process_time() - start < 60


def test_tags_that_are_left_open():
    assert main_text("<p>a <a href='x>b</a> c</p><p>d") == "a b c\nd"
    assert main_text("<p>a<a title='x > y' href=\"it's\">b</a></p>") == "ab"
    assert main_text("<p>x <y") == "x <y" and main_text("<!x") == "<!x" and main_text("<!x>a<?y>b") == "ab"
    assert main_text("a<SCRIPT x>b</script >c<style>d") == "ac"


def test_templates_equal_a_plain_count(spark):
    """Over a given table, and pages made to share blocks."""
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("url", "html")
    blocks = [f"<div><div>Block {k}</div><ul><li>{k}</ul></div>" for k in range(6)]
    made = [(f"http://m.example.com/{k}", "".join(b for j, b in enumerate(blocks) if k % (j + 1) == 0) + f"<p>Own {k}</p>") for k in range(30)]
    made += [(f"http://m.example.com/a{k}", f"<article>{blocks[0]}</article>{blocks[3]}") for k in range(6)] + made[:3]
    pages = given.unionByName(spark.createDataFrame(made, "url string, html string"))
    rows = {(r.url, r.html) for r in pages.collect() if r.html is not None and r.url and urlsplit(r.url).hostname}
    host = {row: urlsplit(row[0]).hostname for row in rows}
    found = {row: subtrees(row[1]) for row in rows}
    sizes, counts = Counter(host.values()), Counter((host[row], h) for row in rows for h in found[row])
    enough = lambda name, n: n >= html.TEMPLATE_PAGES and n >= min(html.TEMPLATE_SHARE * sizes[name], html.TEMPLATE_ANYWAY)
    expected = Counter(tuple(sorted(h for h in found[row] if enough(host[row], counts[host[row], h]))) for row in rows)
    expected.pop((), None)
    assert Counter(tuple(sorted(r.hashes)) for r in template_subtrees(pages).collect()) == expected
    assert len(expected) > 1


def test_clashing_names(spark):
    names = ["_template_row", "_row", "_hashes", "row", "hash", "host", "text"]
    pages = spark.createDataFrame([(f"http://h.example.com/{k}", f"<p>{k}", *"abcdefg") for k in range(6)], ["url", "html", *names])
    got = extract(pages)
    assert got.columns == ["url", *names] and {r.text for r in got.collect()} == set("012345")
