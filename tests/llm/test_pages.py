"""Main text of pages: the given pages, other layouts, broken markup."""

from __future__ import annotations

import html
import re

import pyarrow.parquet as pq
from conftest import SMALL, rows
from pyspark.sql import functions as F

from tierflow.llm import html_text, queries

LONG = "This sentence is long enough to count as running text of an article, and it goes on."


def marked_article(page: str) -> str:
    """The article of a page of the given kind, by its tags alone."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark):
    pages = pq.read_table(f"{SMALL}/pages.parquet").to_pydict()
    got = rows(queries.QUERIES["op3_html_main_text"](spark, SMALL))
    texts = [marked_article(p) for p in pages["html"]]
    assert got == sorted(zip(pages["page_id"], pages["url"], texts, map(len, texts)), key=repr)


def test_article_with_everything_around_it():
    page = f"""<html><head><title>T</title><script>if (a < b) document.write("</p><p>no</p>");</script></head><body>
    <header><h1>Site</h1></header><div class="cookie-notice"><p>{LONG}</p></div><nav><ul><li>Menu</li></ul></nav>
    <main><article><header><h1>Head&eacute;r  one</h1></header><p>First &amp; <b>bold</b> tex<i>t</i>.<br>Next&nbsp;line</p>
    <aside>{LONG}</aside><form><p>{LONG}</p><input name=q></form><p></p><p>Be.</p>
    <div class="ad banner"><div><p>{LONG}</p></div></div><ul><li>one</li><li>two <a href="x">link</a></li></ul>
    <style>p {{ x }}</style><table><tr><td>c1</td><td>c2</td></tr></table><!-- <p>hidden</p> --><p hidden>no</p>
    <section id="comments"><p>{LONG}</p></section><p>Last</p></article></main>
    <div id="sidebar">{LONG}</div><footer>{LONG}</footer></body></html>"""
    assert html_text.main_text(page).split("\n") == [
        "Headér one", "First & bold text. Next line", "Be.", "one", "two link", "c1", "c2", "Last",
    ]


def test_page_without_marked_article():
    menu = "".join(f'<li><a href="/{k}">Entry {k}</a></li>' for k in range(9))
    page = f"<body><div><ul>{menu}</ul></div><div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div><a href='x'>more</a></div>"
    assert html_text.main_text(page) == f"{LONG}\nShort.\n{LONG}"
    assert html_text.main_text("<p>Only a few words.</p>") == "Only a few words."


def test_broken_and_odd_pages(spark):
    pages = [
        (1, None), (2, ""), (3, "plain text"), (4, "<p>open <b>never <p>closed"), (5, "<script>never closed <p>x</p>"),
        (6, "<!-- never closed <p>x</p>"), (7, "a < b and c > d"), (8, "<article></article><p>outside</p>"),
        (9, "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"), (None, "<p>null id</p>"), (3, "plain text"),
        (10, "<div><nav><div><p>menu</p></nav><p>after</p>"), (11, "&#x41;&#66;&lt;p&gt; \x00"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, html string").withColumn("text", F.lit("old"))
    made = html_text.with_main_text(frame)
    got = [(r.page_id, r.text) for r in made.collect()]
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in made.collect())
    texts = dict(got)
    assert texts[1] == texts[2] == texts[5] == texts[6] == ""
    assert texts[3] == "plain text" and texts[None] == "null id" and texts[4] == "open never\nclosed"
    assert texts[9].count("\n") == 4999 and texts[10] == "after" and texts[11].startswith("AB<p>")
    assert html_text.with_main_text(frame.limit(0)).count() == 0
