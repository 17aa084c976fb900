"""Article marks and names that must not decide alone."""

from __future__ import annotations

import pytest

from tierflow.llm import html_text

LONG = "This sentence is long enough to count as running text of an article, and it goes on."


@pytest.mark.parametrize("mark", ["article", "main"])
def test_body_beside_a_marked_teaser(mark):
    body = "".join(f"<p>{k} {LONG}</p>" for k in range(20))
    page = f"<body><{mark}><p>Read this too.</p></{mark}><nav>menu</nav><div>{body}</div></body>"
    text = html_text.main_text(page)
    assert all(f"{k} {LONG}" in text.split("\n") for k in range(20)) and "menu" not in text
    assert html_text.main_text(f"<{mark}>{body}</{mark}><div><p>{LONG}</p></div>").count("\n") == 19


def test_names_and_hidden_inside_an_article():
    page = f"""<article><h2 id="search-methods">Methods of search</h2><div class="overflow-hidden"><p>{LONG}</p></div>
    <p title="The hidden cost">Costs</p><p class="comment">Remark</p><h3 id="related">Related work</h3>
    <div data-hidden="x">Data</div><div class="header-of-chapter">Chapter</div>
    <div class="site-footer">no</div><div class="cookie-notice">no</div><div class="x sidebar">no</div><div hidden>no</div>
    <div aria-hidden="true">no</div><p style="color: red; display: none">no</p><div role="navigation">no</div>
    <div class="hidden">no</div><section id="comments">no</section><p>Last</p></article>"""
    assert html_text.main_text(page).split("\n") == [
        "Methods of search", LONG, "Costs", "Remark", "Related work", "Data", "Chapter", "Last",
    ]
