from __future__ import annotations

import pytest
from conftest import SF_DIR, rows

from tripmart.llm import html_text
from tripmart.llm.html_text import main_text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain words", "plain words"),
        ("<p>one<p>two<br>three", "one two three"),
        ("<article><h1>T &amp; U</h1><p>a\n <b>b</b>c&nbsp;d</p></article><footer>f</footer>", "T & U a bc d"),
        ("<body><nav>n</nav><main><p>x</p><aside>s</aside></main></body>", "x"),
        ("<article><p>x</p><div class='share-buttons'>s</div><section id=comments><p>c</p></section></article>", "x"),
        ("<article><script>if (a < b) { t = '</p>' }</script><p>x</p><style>p{}</style><!-- <p>no</p> --></article>", "x"),
        ("<article><p>x<b>y</p><p>z</article>tail", "xy z"),
        ("<article>a &lt;b&gt; &#65;&#x42; &unknown; &amp</article>", "a <b> AB &unknown; &"),
        ("<p title='a>b'>x</p><p>1 < 2</p><p", "x 1 < 2 <p"),
        ("<ul><li>a<li>b</ul><form>f</form><button>b</button>", "a b"),
        ("<div hidden>h</div><div role='navigation'>n</div><div>d</div>", "d"),
        ("<!doctype html><title>t</title><p>never closed <!-- comment", "never closed"),
    ],
)
def test_main_text(html, text):
    assert main_text(html) == text


def test_deep_and_broken_markup():
    assert main_text("<div>" * 20_000 + "x" + "</p>" * 20_000) == "x"
    assert main_text("<a b='" * 2000) is not None


def page(n: int, article: str, template: str = "<div><p>Our site offers things</p><a href=/>go</a></div>") -> str:
    return f"<html><body>{template}{article}</body></html>"


def test_templates_go_and_articles_stay(spark):
    rows_in = [(n, "https://Site.example/a", page(n, f"<div><p>text number {n}</p></div>")) for n in range(8)]
    rows_in += [(100 + n, "https://other.example/a", page(n, f"<article><p>every page</p><p>own {n}</p></article>")) for n in range(8)]
    rows_in += [(200, "https://small.example/", page(0, "<div><p>alone</p></div>")), (201, None, None), (202, None, "")]
    docs = spark.createDataFrame([(*r, "h", 1) for r in rows_in], "page_id bigint, url string, html string, page_host string, text int")
    found = {r["page_id"]: r["text"] for r in html_text.extracted(docs).collect()}
    assert [found[n] for n in range(8)] == [f"text number {n}" for n in range(8)]
    assert [found[100 + n] for n in range(8)] == [f"every page own {n}" for n in range(8)]
    assert found[200] == "Our site offers things go alone"
    assert found[201] == found[202] == ""
    lengths = {r["page_id"]: r["n_chars"] for r in html_text.extracted(docs).collect()}
    assert lengths == {k: len(v) for k, v in found.items()}
    assert rows(html_text.extracted(docs.limit(0))) == []


def test_repeated_rows_stay(spark):
    docs = spark.createDataFrame([(1, "http://a.b/", "<p>x</p>")] * 3 + [(None, "http://a.b/", "<p>y</p>")], "page_id bigint, url string, html string")
    assert sorted(r["text"] for r in html_text.extracted(docs).collect()) == ["x", "x", "x", "y"]


def test_tables_pages_keep_their_article(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_text.extracted(pages).collect():
        article = html[r["page_id"]].split("<article>")[1].split("</article>")[0]
        for tag in ("h1", "/h1", "p", "/p", "b", "/b", "br"):
            article = article.replace(f"<{tag}>", " ")
        import html as library

        assert r["text"] == " ".join(library.unescape(article).split())
