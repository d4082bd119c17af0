from __future__ import annotations

import itertools
import random
import time

import pytest

from tallylog.llm import main_text

WORDS = "the quick brown fox jumps over the lazy dog and runs through a field of barley until night falls on the hills"
PROSE = WORDS.capitalize() + "."

PAGE = f"""<!DOCTYPE html><html><head><title>Site</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head>
<body class="with-sidebar"><header class="site"><h2>The site</h2><p>{PROSE}</p></header>
<nav><ul><li><a href="/">Home</a><li><a href="/b">About</a></ul></nav>
<div class="cookie-notice"><p>{PROSE}</p><button>OK</button></div>
<article><h1>Head &amp; line</h1><p>{PROSE}<p>Of.<p>A <b>bold</b>&nbsp;word<br>and   a <a href="x">link</a> &lt;here&gt;.
<div class="ad">{PROSE}</div><ul><li>One thing<li>Another thing</ul>
<blockquote>{PROSE}</blockquote><form><input name="q"><label>Search</label></form></article>
<aside class="sidebar"><p>{PROSE}</p></aside>
<section id="comments"><article class="comment"><p>{PROSE}</p></article></section>
<footer>&copy; 2020 Someone</footer></body></html>"""
TEXT = "\n".join(
    ["Head & line", PROSE, "Of.", "A bold word and a link <here>.", "One thing", "Another thing", PROSE]
)


def test_whole_page():
    assert main_text.extract(PAGE) == TEXT


def test_pages_cut_off_anywhere():
    for end in range(0, len(PAGE), 7):
        text = main_text.extract(PAGE[:end])
        assert not any(mark in text for mark in ("var a", "<p", "<b", "</", "class"))


def test_page_without_marks():
    links = "".join(f'<li><a href="/{k}">Item {k}</a></li>' for k in range(12))
    page = f"<div><ul>{links}</ul></div><div><h2>Title of it</h2><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p></div><div><a>Terms</a> <a>Help</a></div>"
    assert main_text.extract(page) == f"Title of it\n{PROSE}\nShort.\n{PROSE}"


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!--", "<a href='", "</", "<script>x", "<style>a{}", "<nav>Home</nav>"])
def test_pages_without_text(page):
    assert main_text.extract(page) == ""


LONG_PROSE = " ".join([PROSE] * 3)
ARTICLE = "".join(f"<p>{k}. {LONG_PROSE}</p>" for k in range(4))
REST = f"""<div class="cookie-notice"><p>{PROSE}</p></div><div class="share"><p>{PROSE}</p></div><div class="sidebar-left"><p>{PROSE}</p></div>
<section class="comments"><p>{LONG_PROSE}</p></section><footer><p>{PROSE}</p></footer>"""


@pytest.mark.parametrize(
    "shell",
    ['<main class="has-sidebar">{}</main>', '<article class="story share-enabled">{}</article>', '<div class="wrapper no-sidebar">{}</div>',
     '<form id="aspnetForm"><div id="content">{}</div></form>', '<form method="post"><div>{}</div></form>', '<div class="share-page">{}</div>',
     '<main class="sidebar-right">{}</main>', '<div class="comments-page"><main>{}</main></div>', '<div class="overflow-hidden">{}</div>'],
)
def test_marked_shell_of_a_whole_article(shell):
    text = main_text.extract(f"<html><body><nav><a>Home</a></nav>{shell.format(ARTICLE)}{REST}</body></html>")
    assert text == "\n".join(f"{k}. {LONG_PROSE}" for k in range(4))


@pytest.mark.parametrize(
    "rest",
    [f'<div class="comments">{ARTICLE * 3}</div>', f'<aside>{ARTICLE * 3}</aside>', f'<div class="related"><article>{ARTICLE}</article></div>',
     f'<div class="promo">{ARTICLE}</div>', f'<form><p>{LONG_PROSE}</p></form>', f'<div hidden>{ARTICLE * 3}</div>'],
)
def test_marked_parts_beside_an_article_go(rest):
    article = "".join(f"<p>{k}: {LONG_PROSE}</p>" for k in range(5))
    assert main_text.extract(f"<article>{article}</article>{rest}") == "\n".join(f"{k}: {LONG_PROSE}" for k in range(5))


@pytest.mark.parametrize("unit", ["<div>x ", "<div>", "<p><b>y", "<ul><li>z ", "</span><div>", "<button><p>x<div>", "<a href=x>l"])
def test_deep_pages_take_linear_time(unit):
    started = time.process_time()
    main_text.extract(unit * 100_000)
    assert time.process_time() - started < 20


def test_long_pages():
    page = "<html><body><nav>" + "<a>x</a>" * 5000 + "</nav><article>" + f"<p>{PROSE}</p><p>Yes.</p>" * 5000 + "</article></body>"
    assert main_text.extract(page).count("\n") == 9999


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_minimal(seed):
    draw = random.Random(seed)
    n = draw.randint(1, 8)
    worths = [draw.randint(-9, 9) for _ in range(n)]
    edges = [(a, b, draw.randint(0, 6)) for a, b in itertools.combinations(range(n), 2) if draw.random() < 0.5]

    def cost(side):
        cut = sum(w for a, b, w in edges if side[a] != side[b])
        return cut + sum(max(w, 0) for k, w in enumerate(worths) if not side[k]) + sum(max(-w, 0) for k, w in enumerate(worths) if side[k])

    best = min(map(cost, itertools.product([False, True], repeat=n)))
    assert cost(main_text.minimum_cut(worths, edges)) == best


def test_as_query(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", "")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    got = main_text.extract_pages(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(((r.page_id, r.text, r.n_chars) for r in got.collect())) == [
        (1, TEXT, len(TEXT)), (1, TEXT, len(TEXT)), (2, "", 0), (3, "", 0)
    ]
    assert main_text.extract_pages(pages.limit(0)).collect() == []
