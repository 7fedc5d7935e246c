"""HTML extraction: the article of every given page, and pages with the usual clutter."""

import html as markup
import re

import duckdb
import pytest
from postlens.llm import html

PROSE = "The cat sat on the mat and it was not sure that the dog would be there with all of its friends."


def article_of(page):
    """Cut the explicit article at its paragraph and heading tags; valid for the given pages only."""
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = re.split(r"</?p>|</?h1>", inside)
    texts = [re.sub(r"\s+", " ", markup.unescape(re.sub(r"<[^>]*>", " ", p))).strip() for p in parts]
    return "\n".join(t for t in texts if t)


def test_given_pages(spark):
    path = "/root/testdata/sf0.01/pages.parquet"
    pages = spark.read.parquet(path).withColumn("text", html.F.lit("clash"))
    got = {r.page_id: r for r in html.extract(pages).collect()}
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{path}'").fetchall()
    assert len(got) == len(rows)
    for page_id, url, page in rows:
        assert (got[page_id].url, got[page_id].text) == (url, article_of(page))
        assert got[page_id].n_chars == len(got[page_id].text)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("<article>Hi</article>", "Hi"),
        (f"<main><h1>Title</h1><p>{PROSE}</main><footer>{PROSE}</footer>", f"Title\n{PROSE}"),
        (f"<nav>{PROSE}</nav><p>{PROSE}</p><p>Short one.</p><p>{PROSE}</p><aside>{PROSE}</aside>", f"{PROSE}\nShort one.\n{PROSE}"),
        (f"<article><p>{PROSE}</p><div class='cookie-notice'>{PROSE}</div><p>End</p></article>", f"{PROSE}\nEnd"),
        (f"<article><p>{PROSE}</p><section id=comments><p>{PROSE}</p></section></article>", PROSE),
        (f"<article><header><h1>T</h1></header><p>a &lt;b&gt;&nbsp;\n c<br>d</p><form>{PROSE}<input></form></article>", "T\na <b> c d"),
        ("<article><p>one<p>two<ul><li>x<li>y</ul><script>if (a<b) '</p>'</script>z</article>", "one\ntwo\nx\ny\nz"),
        (f"<div>Menu <a href=x>one</a> <a href=y>two</a></div><p>{PROSE} <a href='z>'>link</a></p><p>{PROSE}", f"{PROSE} link\n{PROSE}"),
        (f"<!-- <p>{PROSE}</p> --><article>1 < 2 & 3 &amp;amp; 4</article>", "1 < 2 & 3 &amp; 4"),
        (f"<p>{PROSE}</p><div class=sidebar><p>{PROSE}</p></div><p hidden>{PROSE}</p>", PROSE),
    ],
)
def test_rules(page, text):
    assert html.main_text(page) == text


def test_ambiguous_blocks_follow_the_nearest_decided_one():
    bad = "<div><a href=x>only links stand here</a></div>"
    short = "<p>a few</p>"
    page = f"{bad}{short}{short}<p>{PROSE}</p>{short}{short}{bad}{short}"
    labels = [b.label for b in html.classify(html.blocks(page))]
    assert labels == ["bad", "bad", "good", "good", "good", "bad", "bad", "bad"]
    assert [b.label for b in html.classify(html.blocks(bad + short + f"<p>{PROSE}</p>"))] == ["bad", "bad", "good"]


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "u", "<p>x</p>"), (1, None, None), (2, "u", "<article>" + f"<p>{PROSE}</p>" * 20_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html.extract(pages).collect()
    assert [(r.page_id, r.n_chars) for r in got] == [(1, 0), (None, 0), (1, 0), (2, 20_000 * (len(PROSE) + 1) - 1)]
    assert html.extract(pages.limit(0)).count() == 0
