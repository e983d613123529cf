"""Page extraction: what the cut decides, names and tags that mislead, and an independent slow version on the given pages."""

import html as entities
import re

import numpy as np
import pytest

from modelpulse.llm import html_text
from modelpulse.llm.catalogue import QUERIES
from modelpulse.sources.tables import load

TEXT = "A headline here\nThe first paragraph is long enough to be prose. It has sentences.\nSo has the second one, which goes on for a while."
ARTICLE = "<article><h1>A headline here</h1><p>The first paragraph is long enough to be prose. It has sentences.</p><p>So has the second one, which goes on for a while.</p></article>"


@pytest.fixture(scope="module")
def weights(spark, sf_dir):
    return html_text.fit_classifier(load(spark, sf_dir, "pages"))


@pytest.mark.parametrize(
    "page",
    [
        f"<body class='right-sidebar'>{ARTICLE}",
        f"<html class='js nav-closed'><body>{ARTICLE}",
        f"<body><div id=page class='no-sidebar'>{ARTICLE}</div>",
        f"<body>{ARTICLE.replace('<article>', '<article class="post share-enabled">')}",
        f"<html><head><title>t</title><body>{ARTICLE}",
        f"<html><head><title>t</title><meta charset=utf-8>{ARTICLE}",
        f"<body><form id=aspnetForm>{ARTICLE}</form>",
        f"<body><div class=widget>{ARTICLE}</div>",
        f"<body>{ARTICLE}<div class=comments><article class=comment><p>Nice read, thank you very much. I liked it.</p></article></div>",
        f"<body><div class=mainNav><a href=/>Home</a></div><div class='cookieBanner'>We use cookies. You know that.</div>{ARTICLE}<aside>{ARTICLE}</aside>",
        f"<body>{ARTICLE.replace('</h1>', '</h1><div class=ad>Buy this now, it is a very good thing to have. Really.</div>')}",
    ],
)
def test_names_of_state_and_layout_do_not_hide_the_article(weights, page):
    assert html_text.main_text(page, weights) == TEXT


def test_the_cut_overturns_blocks(weights):
    """Without any article or navigation tag: short lines amid prose stay, a prose-like line amid links goes, against their own costs."""
    prose = "".join(f"<p>Paragraph number {i} is prose that is long enough to read. It has two sentences, and ends with a stop.</p>" for i in range(4))
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(6))
    page = f"<body><div><ul>{links}<li>More is here.</li>{links}</ul></div><div>{prose}<p><a href=/x>See there</a></p>{prose}</div>"
    blocks = html_text.blocks_of(page)
    own, labels = html_text.own_odds(blocks, weights) > 0, html_text.label(blocks, weights)
    changed = {b.text for b, mine, found in zip(blocks, own, labels) if mine != found}
    assert changed == {"See there"} or changed == {"See there", "More is here."}
    text = html_text.main_text(page, weights).split("\n")
    assert len(text) == 9 and text[4] == "See there"


def test_a_hint_gives_way_to_text_and_neighbours(weights):
    """A name that only hints at boilerplate does not take a paragraph out of its article; a plain one does."""
    hint, plain = (ARTICLE.replace("<p>So", f"<p class='{c}'>So") for c in ("body-related-text", "related"))
    assert html_text.main_text(hint, weights) == TEXT
    assert html_text.main_text(plain, weights) == "\n".join(TEXT.split("\n")[:2])


def test_edges_weaken_with_distance_and_across_marks():
    blocks = html_text.blocks_of("<body><article><p>One.</p><p>Two.</p></article><div><section><p>Three.</p></section></div><div class=ad>Four.</div>")
    weight = {(a, b): w for a, b, w in html_text.smoothness(blocks)}
    assert weight[0, 1] > weight[1, 2] > weight.get((2, 3), 0) * html_text.ACROSS > 0
    same = [w for a, b, w in html_text.smoothness(blocks) if (a, b) == (0, 1)]
    assert sum(same) == int((html_text.NEIGHBOUR + html_text.SIBLING) * html_text.SCALE)


def slow_text(page):
    """By regular expressions: what stands in the article, less what the pages' generator puts between."""
    body = re.sub(r"(?is)<!--.*?-->|<(script|style|noscript)\b.*?</\1>", "", page)
    found = re.search(r"(?is)<(article|main)\b.*</\1>", body)
    inside = found.group(0) if found else ""
    inside = re.sub(r"(?is)<(aside|nav|footer|form|button)\b.*?</\1>", "\n", inside)
    inside = re.sub(r"(?is)<(div|p|section)\b[^>]*class=\"[^\"]*(?:ad|notice|share|cookie|comments?|related|promo)[^\"]*\".*?</\1>", "\n", inside)
    inside = re.sub(r"\s+", " ", inside)
    parts = re.split(r"(?i)</?(?:" + "|".join(sorted(html_text.BLOCK_TAGS, key=len, reverse=True)) + r")\b[^>]*>", inside)
    parts = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", " " if False else "", re.sub(r"(?i)<br\s*/?>", " ", p)))).strip() for p in parts]
    return "\n".join(p for p in parts if p)


def test_extraction_equals_the_slow_version(spark):
    """All pages of the smaller tables."""
    n = 0
    for sf_dir in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        pages = {r.page_id: r.html for r in load(spark, sf_dir, "pages").collect()}
        for r in QUERIES["op3_html_text"](spark, sf_dir).collect():
            assert r.text == slow_text(pages[r.page_id] or "")
            n += 1
    assert n == 300


def test_names():
    evidence = lambda name: html_text.name_evidence(name)[0]
    assert all(evidence(n) == -html_text.STRONG for n in ("nav", "main-nav", "cookieNotice", "ad1", "footer_links", "post-comments", "sidebar2"))
    assert all(evidence(n) == 0 for n in ("no-sidebar", "nav-closed", "has-footer", "", "x1", "---", "share-enabled"))
    assert evidence("a-promo-b") == -html_text.HINT and evidence("entry") == html_text.CONTENT_HINT
    assert np.isfinite(html_text.STRONG + html_text.CLASSIFIER_BOUND)
