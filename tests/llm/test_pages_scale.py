"""Broken, deep and long pages take time in proportion; names inside articles."""

import time

import pytest

from tokenloom.llm.lineblocks import main_text

LONG = "word " * 39 + "end."

SHAPES = {
    "tags without an end": lambda n: "<a " * n,
    "tags without an end after one": lambda n: "<p>x</p>" + "<div class='x " * n,
    "quotes without an end": lambda n: '<a title="x>y" b' * n,
    "one quote": lambda n: "<a '" * n,
    "both quotes": lambda n: "<a \"'" * n,
    "declarations without an end": lambda n: "<!x" * n,
    "comments without an end": lambda n: "<!-- x" * n,
    "loose signs": lambda n: "<a " + "< " * n,
    "names": lambda n: "<" + "a" * n,
    "nesting": lambda n: "<div>x" * n,
    "nested articles": lambda n: "<article><p>x" * n,
    "nested paragraphs in spans": lambda n: "<span><p>x" * n,
    "nested furniture": lambda n: "<div class=sidebar>" * n + LONG,
    "closed nesting": lambda n: "<div><b>" * n + LONG + "</b></div>" * n,
    "wrong ends": lambda n: "<i>" * n + "</u></p>" * n,
    "regions": lambda n: f"<p>{LONG}</p><nav>x</nav>" * n,
    "short regions": lambda n: "<div><p>x</p></div><nav>x</nav>" * n,
    "scripts": lambda n: "<script>x</script>" * n,
    "open scripts": lambda n: "<script>x" * n,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_time_in_proportion(shape):
    start = time.perf_counter()
    main_text(SHAPES[shape](100_000))
    assert time.perf_counter() - start < 20


def test_deep_and_repeated_text_is_whole():
    n = 20_000
    assert main_text("<div>" * n + LONG) == LONG
    assert main_text("<div class=sidebar>" * n + LONG) == LONG
    assert main_text(f"<p>{LONG}</p><nav>x</nav>" * n) == "\n".join([LONG] * n)
    assert main_text("<article>" + "<p>x</p>" * n + "</article>") == "\n".join(["x"] * n)


def test_names_inside_an_article():
    inside = f"<div class='social-science'><p>{LONG} a</p></div><section id='related-work'><p>{LONG} b</p></section>"
    assert main_text(f"<article><p>{LONG}</p>{inside}</article>") == f"{LONG}\n{LONG} a\n{LONG} b"
    for name in ("ad", "ad-box", "related-posts", "shareButtons", "comment_list", "newsletter-signup-form", "more-stories"):
        for attribute in ("class", "id"):
            assert main_text(f"<article><p>{LONG}</p><div {attribute}='{name}'>{LONG} x</div><p>z</article>") == f"{LONG}\nz"
    # Beside the text, lists of further pages go as well; a header is one in an article, too.
    assert main_text(f"<div><p>{LONG}</div><div class='more-stories'>{LONG}</div>") == LONG
    assert main_text(f"<article><header>x</header><p>{LONG}</article>") == LONG


def test_signs_that_start_no_tag():
    assert main_text(f"<p title='1 < 2'>{LONG} 1 < 2 <3") == f"{LONG} 1 < 2 <3"
    assert main_text(f'<p title="a>b">{LONG}<!x') == f"{LONG}<!x"
    assert main_text(f"<div <p>{LONG}<p") == f"{LONG}<p"
    assert main_text(f"<p>{LONG}<!-- > x --> y<!-- no end > z") == f"{LONG} y"
