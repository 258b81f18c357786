from __future__ import annotations

import random
from xml.etree import ElementTree

import pytest

from lapseflow.llm.html_text import extracted, main_text

LONG = "Rain fell on the town, the river rose, and by noon the lower streets stood under water."
MORE = "People carried chairs upstairs, lit candles, and waited for the boats to come round."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<p></p><br>", ""),
        ("just, some plain text without any markup", "just, some plain text without any markup"),
        (f"<article><h1>Flood</h1><p>{LONG}<p>{MORE}</article>", f"Flood {LONG} {MORE}"),
        (f"<p><b>{LONG}<br><p>a&amp;b &copy; &#233; &notacharacter; x&nbsp;y", f"{LONG} a&b © é ¬acharacter; x y"),
        (f"<article><p>one<b>two</b>\n\t three</p><p>{LONG}</p></article>", f"onetwo three {LONG}"),
        (f"<nav><p>{MORE}</p></nav><article><p>{LONG}</p></article><footer>{MORE}</footer>", LONG),
        (f"<script>if (a < b) document.write('<p>{MORE}</p>')</script><div><p>{LONG}</p></div><style>p > a {{}}</style>", LONG),
        (f"<!-- <p>{MORE}</p> --><div><p>{LONG}</p><!-- {MORE} --></div>", LONG),
        (f"<div class='wrap'><div id=sidebar><p>{MORE}</p></div><div class='post-body'><p>{LONG}</p></div></div>", LONG),
        (f"<main><p>{LONG}</p><div class='cookie-notice'>{MORE}</div><form><p>{MORE}</p></form><aside>{MORE}</aside></main>", LONG),
        (f"<article><p>{LONG}</p></article><section id='comments'><p>{MORE}</p><p>{MORE}</p><p>{MORE}</p></section>", LONG),
        (f"<article><p>{LONG}</p></article><div class=comments><article class=comment><p>{MORE}{MORE}</p></article></div>", LONG),
        (f"<div><ul><li><a href=/a>Home, start</a><li><a href=/b>News, all</a></ul><p>{LONG}</p></div>", LONG),
        (f"<table><tr><td><p>{LONG}<td><a href=x>{MORE}</a><a href=y>{MORE}</a></table>", LONG),
        (f"<div><div class=c><p>{LONG}</p></div><div class=c><p>{MORE}</p></div></div>", f"{LONG} {MORE}"),
        (f"<article><p>{LONG}</p></article><section><p>{MORE}</p><p>{MORE}</p></section>", LONG),
        (f"<article><p>{LONG}</p></article><article><p>{MORE}</p></article>", f"{LONG} {MORE}"),
        (f"<article><p>{LONG}</p><div class='text-ad'>{MORE}</div><p class=notice>{MORE}</p><div class=usercomments>{MORE}</div><p>{MORE}</p></article>", f"{LONG} {MORE}"),
        (f"<head><title>T</title><p>{LONG}</p>", LONG),
        (f"<article><p>5 < 6 and {LONG} </p></article", f"5 < 6 and {LONG}"),
        (f"<div hidden>{MORE}</div><div style='display: none'>{MORE}</div><div>{LONG}</div>", LONG),
        (f"<article><p>{LONG}</p></p></div></span><p>{MORE}</p></article>", f"{LONG} {MORE}"),
        # Marks say what an element is, not what it has, and never take out the main text.
        (f"<div class='layout has-sidebar'><article><p>{LONG}</p></article><div class=sidebar>{MORE}</div></div>", LONG),
        (f"<div class='layout has-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<div class='sidebar-layout'><div class=sidebar>{MORE}</div><article><p>{LONG}</p></article></div>", LONG),
        (f"<article id='banner-article'><p>{LONG}</p></article>", LONG),
        (f"<article class='ad-free post'><p>{LONG}</p></article>", LONG),
        (f"<article><p>{LONG}</p><section class='social history'><p>{MORE}</p></section></article>", f"{LONG} {MORE}"),
        (f"<article><p>{LONG}</p><ul class=social><li><a href=x>Tell a friend</a><li><a href=y>Print</a></ul></article>", LONG),
        (f"<article><header><h1>Flood</h1><nav><a href=x>Up</a></nav><p>by me</p></header><p>{LONG}</p></article>", f"Flood {LONG}"),
        (f"<header><h1>Paper</h1></header><article><p>{LONG}</p></article>", LONG),
        (f"<article><p>{LONG}</p><ul><li><a href=x>First source</a><li><a href=y>Second source</a></ul></article>", f"{LONG} First source Second source"),
        (f"<div class=notice><p>{LONG}</p></div>", LONG),
        (f"<div class=widget><p>{LONG}</p><p>{MORE}</p><p>{LONG}</p><p>{MORE}</p><p>{LONG}</p><div class=ad>{MORE}</div></div><p>Short, odd.</p>", f"{LONG} {MORE} {LONG} {MORE} {LONG} Short, odd."),
        (f"<div class=widget><p>{MORE}</p></div><p>{LONG}</p><p>{MORE}</p>", f"{LONG} {MORE}"),
    ],
)
def test_pages(page, want):
    assert main_text(page) == want


def test_long_and_deep_pages():
    deep = "<div>" * 5000 + f"<p>{LONG}</p>" + "</div>" * 5000
    assert main_text(deep) == LONG
    many = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    assert main_text(many) == " ".join([LONG] * 5000)
    assert main_text("<article><p>" + "word, " * 100_000).count("word") == 100_000


def test_rows(spark):
    rows = [(1, f"<p>{LONG}</p>", "t"), (1, f"<p>{LONG}</p>", "t"), (None, None, "t"), (2, "", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text string").selectExpr("*", "page_id AS kept")
    got = extracted(pages)
    assert got.columns == ["page_id", "html", "kept", "text"]
    assert sorted(((r["page_id"], r["text"]) for r in got.collect()), key=str) == [(1, LONG), (1, LONG), (2, ""), (None, "")]
    assert extracted(pages.limit(0)).count() == 0


def random_page(pick: random.Random, depth: int = 0) -> str:
    """Nested containers with prose and links, no words in classes."""
    out = []
    for _ in range(pick.randrange(1, 4)):
        kind = pick.random()
        if kind < 0.4 and depth < 4:
            out.append(f"<div>{random_page(pick, depth + 1)}</div>")
        elif kind < 0.8:
            out.append(f"<p>{' '.join(pick.choices(['rain,', 'fell', 'on', 'town', 'river;'], k=pick.randrange(1, 40)))}</p>")
        else:
            out.append(f"<p><a href=x>{' '.join(pick.choices(['more', 'here'], k=pick.randrange(1, 9)))}</a></p>")
    return "".join(out)


def best_container(source: str) -> list[list[str]]:
    """Brute force: each container's points from each paragraph below it, by path; the prose of the best ones."""
    root = ElementTree.fromstring(f"<html>{source.replace('href=x', '')}</html>")
    scores = {}
    paragraphs = []

    def every(at, above):
        for child in at:
            if child.tag == "p":
                words = "".join(child.itertext()).strip()
                paragraphs.append((words, len(child) > 0, [*above, at]))
            else:
                every(child, [*above, at])

    every(root, [])
    for box in root.iter():
        if box.tag in ("html", "div"):
            mine = [(w, link, chain) for w, link, chain in paragraphs if box in chain]
            size = sum(len(w) for w, _, _ in mine)
            share = sum(len(w) for w, link, _ in mine if link) / size if size else 0
            points = 0.0
            for words, _, chain in mine:
                up = len(chain) - 1 - chain.index(box)
                if words and up < 5:
                    points += (1 + words.count(",") + len(words) / 100) * (1 if up == 0 else 0.5 * (2 / 3) ** (up - 1))
            scores[box] = points * (1 - share)
    best = max(scores.values())
    return [[w for w, link, chain in paragraphs if box in chain and not link] for box, score in scores.items() if abs(score - best) < 1e-9]


@pytest.mark.parametrize("seed", range(60))
def test_the_best_container_of_small_trees_is_kept(seed):
    source = random_page(random.Random(seed))
    got = main_text(source)
    # Siblings may follow and lists of links may go, but all prose of a best container is there, in order.
    assert any(in_order(prose, got) for prose in best_container(source)), (source, got)


def in_order(texts: list[str], whole: str) -> bool:
    at = 0
    for text in texts:
        at = whole.find(text, at)
        if at < 0:
            return False
        at += len(text)
    return True
