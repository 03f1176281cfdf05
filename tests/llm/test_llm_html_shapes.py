"""Page shapes that the main text has to survive, and time in proportion to the page."""

from __future__ import annotations

import time

import pytest

from ledgerwatch.llm.html_text import main_text, names_apart

A = "Some article text that is long enough to count as a block of its own, really."


@pytest.mark.parametrize("page, want", [
    (f'<div class="content has-sidebar"><article><p>{A}</p></article></div>', A),
    (f'<div id="page" class="no-sidebar"><p>{A}</p><p>{A}</p></div>', f"{A} {A}"),
    (f'<div class="sidebar-left"><main><p>{A}</p></main></div><div class="sidebar-left">side</div>', A),
    (f'<article><p>{A}</p><section id="search-results-explained"><p>X {A}</p></section></article>', f"{A} X {A}"),
    (f'<article><p>{A}<p class="advert">Buy<p>Real closing paragraph.</article>', f"{A} Real closing paragraph."),
    (f'<article><ul><li class="share">Share<li>Real item</ul><p>{A}</article>', f"Real item {A}"),
    (f'<article><dl><dt class="ad">x<dd>y<dt>z</dl><p>{A}</article>', f"y z {A}"),
    (f'<article><table><tr><td class="ad">one<td>two</div><tr><td>three</table><p>{A}</article>', f"two three {A}"),
    (f"<article><p>a <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>x+1</annotation></math> b</p><p>{A}</p></article>", f"a x+1 b {A}"),
    (f'<form id="f"><div class="menu-bar"><a>Home</a></div><div><p>{A}</p><p>{A}</p></div></form>', f"{A} {A}"),
    (f'<div><h1><a href=x>Linked title</a></h1><p>{A}</p><p>{A}</p></div><div class="site-footer">Foot</div>', f"Linked title {A} {A}"),
    (f"<div><div><a>Home</a></div><div><a>News</a></div></div><div><p>{A}</p><p>{A}</p></div>", f"{A} {A}"),
    (f"<article><form>Your name</form><p>{A}</p></article>", A),
])
def test_whole_articles_of_common_shapes(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("token, apart", [
    ("sidebar", True), ("site-footer", True), ("share-buttons", True), ("cookieNotice", True), ("nav_main_wrapper", False), ("ad-slot", True),
    ("comment-list", True), ("has-sidebar", False), ("no-comments", False), ("search-results-explained", False), ("content", False), ("download", False)])
def test_classes_say_by_their_head_what_they_are(token, apart):
    assert names_apart(token) is apart


@pytest.mark.parametrize("page", [
    "<div>" * 50_000 + A, "<div>" * 50_000 + "</p>" * 50_000 + A, "<div>" * 50_000 + "</section>" * 50_000 + A, "<table><p><td>" * 20_000 + A,
    "<li><div>" * 50_000 + A, "<p><table>" + "<div>" * 50_000 + A, '<div class="menu">' * 50_000 + A, '<a href="' * 50_000], ids=range(8))
def test_nested_and_unclosed_tags_take_linear_time(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 4  # half a second or two, on a slow machine
