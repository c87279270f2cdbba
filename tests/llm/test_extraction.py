"""Page scanning: odd and long html in bounded time, tag ends against a scan by character, tables with odd rows."""

import random
import time

import pytest

from contrail.llm import extraction
from contrail.llm.extraction import Scanner


def end_of_tag(page, at):
    """Where the first ``>`` outside quotes is, character by character; -1 if there is none."""
    quote = ""
    for i in range(at, len(page)):
        if quote:
            quote = "" if page[i] == quote else quote
        elif page[i] in "\"'":
            quote = page[i]
        elif page[i] == ">":
            return i
    return -1


def test_tag_ends_against_a_scan_by_character():
    rng = random.Random(3)
    for _ in range(2000):
        page = "".join(rng.choice(["<a ", "<b x=", '"', "'", ">", "</a>", "t", " ", "<"]) for _ in range(rng.randint(0, 25)))
        scanner, at = Scanner(page), 0
        while token := scanner.token(at):
            start, stop, _, name, _ = token
            assert page[start] == "<" and stop > start
            first = extraction.NAME.match(page, start)
            if first:
                end = end_of_tag(page, first.end())
                assert (name is not None) == (end >= 0) and (name is None or stop == end + 1)
            at = stop


def text_of(page):
    found = extraction.blocks(page)
    return extraction.main_text(found, extraction.best_path(found)[0])


@pytest.mark.parametrize("page", [
    '<a "' * 250_000, "<a \"<b '" * 125_000, "<div>" * 100_000 + "x", "<div>x " * 100_000, "<center>x" * 100_000,
    "<div>x " * 50_000 + "</p></b>" * 50_000, "<div><h1>x</h1>" * 50_000, "<" * 1_000_000, "&amp" * 200_000, "x" * 3_000_000])
def test_long_odd_pages_take_linear_time(page):
    begun = time.process_time()
    assert text_of(page) is not None
    assert time.process_time() - begun < 20


def test_text_of_long_nested_page_is_whole():
    n = 20_000
    assert text_of("<body><article>" + "<div>" * n + "<p>deep &amp; whole</p>" + "</div>" * n + "<p>after</p></article>") == "deep & whole\n\nafter"


def test_hand_marked_pages():
    page = """<html><head><title>no</title><style>p {}</style></head><body class="with-sidebar"><nav><a href="/">Home</a></nav>
      <div id="cookie-notice">We use cookies.</div><header class="site-header"><p>Site</p></header>
      <div class="content"><h1>Head &amp; line</h1><p>First  part,\n with <b>bold</b> words.</p><div class="ad">Buy now.</div>
      <p class='lead "q"'>Second part &lt;3&gt;, longer than all menus.</p><script>var x = "<p>no</p>";</script>
      <form><input name=q> Search</form></div><div class="comments"><p>I liked it.</p></div><footer>Imprint</footer></body></html>"""
    assert text_of(page) == "Head & line\n\nFirst part, with bold words.\n\nSecond part <3>, longer than all menus."


def test_odd_tables(spark):
    kind = "page_id long, url string, html string, host string, path string, text string, voted string"
    assert extraction.extract(spark, spark.createDataFrame([], kind)).collect() == []
    row = (1, "http://a/x", "<body><article><p>A page, with text.</p></article>", "h", "p", "t", "v")
    got = extraction.extract(spark, spark.createDataFrame([row, row, (None,) * 7, (2, None, "", "", "", "", "")], kind)).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [(0, ""), (1, "A page, with text."), (1, "A page, with text."), (2, "")]
