"""Layouts with and without marks: windowed sums find the core, its element bounds the text."""

from __future__ import annotations

import pytest

from tierflow.llm import html_text

LONG = "This sentence is long enough to count as running text of an article, and it goes on."
BODY = [f"{k}. {LONG}" for k in range(5)] + ["Short.", f"End. {LONG}", "Bye."]
P = "".join(f"<p>{x}</p>" for x in BODY)
LINKS = "<ul>" + "".join(f'<li><a href="/{k}">Another page number {k}</a></li>' for k in range(12)) + "</ul>"
NOISE = f"<p>Some notice that nobody reads.</p><div><p>{LONG}</p></div>"

LAYOUTS = {
    "article": f"<body>{LINKS}<article>{P}</article>{NOISE}</body>",
    "main with article": f"<body>{LINKS}<main><div><article>{P}</article></div></main>{NOISE}</body>",
    "content div": f"<body><div>{LINKS}</div><div id=wrap><div class=content>{P}</div><div>{LINKS}</div></div><div>© Someone</div></body>",
    "table": f"<body><table><tr><td>{LINKS}</td><td>{P}</td></tr></table></body>",
    "sections": f"<body><section>{LINKS}</section><section>{P}</section></body>",
    "flat": f"<body>{LINKS}{P}{LINKS}</body>",
    "no body": f"{LINKS}{P}",
    "teaser article beside": f"<body><article><h2>Read this too</h2><p>Come and see.</p></article><div>{P}</div></body>",
    "cards in main": f"<main>{P}" + '<article class="card"><h3>Another story</h3><p>Teaser of it.</p></article>' * 3 + "</main>",
    "ad-free content": f'<body>{LINKS}<div class="ad-free">{P}</div></body>',
    "unclosed": f"<body><div>{LINKS}<div><div class=text>{P}",
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_whole_article_and_nothing_else(name):
    assert html_text.main_text(LAYOUTS[name]).split("\n") == BODY


NAMES = "comment-body post-comments user-comments reader-replies related-posts social-links share-buttons ad-slot site-nav-primary main-sidebar comment".split()


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("tag, key", [("div", "class"), ("section", "id"), ("ul", "class")])
def test_boilerplate_by_the_ends_of_its_name(name, tag, key):
    inside = f'<{tag} {key}="{name}"><p>{LONG}</p><p>Nice.</p><div>More <p>{LONG}</p></div></{tag}>'
    for outer in ("article", "div"):
        page = f"<body>{LINKS}<{outer}><p>{BODY[0]}</p>{inside}{''.join(f'<p>{x}</p>' for x in BODY[1:])}</{outer}>{inside}</body>"
        assert html_text.main_text(page).split("\n") == BODY


def test_comment_articles_and_a_closing_paragraph_after_links():
    comments = f'<article class="comment"><p>{LONG}</p></article>' * 4
    assert html_text.main_text(f"<article>{P}{comments}</article>").split("\n") == BODY
    for outer in ("div", "article", "body"):
        text = html_text.main_text(f"<{outer}>{P}{LINKS}<p>A last word.</p></{outer}>")
        assert text.split("\n")[-1] == "A last word." and text.startswith("\n".join(BODY))


def test_headings_and_a_short_part_outside_every_stretch():
    page = f"<div><h1>Title</h1>{LINKS}<p>By someone</p>{LINKS}{P}</div>"
    assert html_text.main_text(page).split("\n")[0] == "Title" and "By someone" in html_text.main_text(page)


def test_two_articles_of_a_list_page_stay():
    parts = "".join(f"<article><h2>Part {k}</h2><p>{k} {LONG}</p></article>" for k in range(6))
    assert html_text.main_text(f"<main>{parts}</main>").count("\n") == 11
