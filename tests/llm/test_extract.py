"""Main texts of pages: markup, and what a host repeats against all strings of five tokens."""

import random
import re

from measlake.llm import extract
from measlake.llm.common import configure
from measlake.llm.markup import Page

PAGES = "page_id bigint, url string, html string"


def text_of(html):
    return Page(html).kept(set())


def texts(pages):
    rows = extract.digest(extract.main_texts(pages)).collect()
    assert all(row.n_chars == len(row.text) for row in rows)
    return sorted(((row.page_id, row.text) for row in rows), key=str)


def test_parts_of_a_page_go():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
      <nav><ul><li><a href="/">Menu</a></li></ul></nav><header><h1>Site</h1></header>
      <div class="cookie-notice">We use cookies</div><form><input><button>Go</button></form>
      <article><header><h1>Head &amp; line</h1><p>By us</p></header><p>One <b>two</b>
      three<br>four&nbsp;five<p>Next<ul><li>a<li>b</ul>
      <div class="ad">Buy</div><script>var t = "</p><p>no";</script><!-- <p>no</p> -->
      <section id="comments"><article><p>First!</p></article></section>last</article>
      <aside>Related</aside><footer>&copy; us</footer></body></html>"""
    assert text_of(page) == "Head & line\nOne two three four five\nNext\na\nb\nlast"


def test_broken_markup():
    assert text_of("") == ""
    assert text_of("a < b &lt;c&gt; <3 <p title='x > y'>d</p>") == "a < b <c> <3\nd"
    assert text_of("<p>x<!-- open") == "x"
    assert text_of("<p>x<script>open") == "x"
    assert text_of("<p title=it's>x") == "x"
    assert text_of("<article><p>x</div></span>y<b>z</article>out") == "x\nyz"
    assert text_of("<form><article>in</article></form><div>out</div>") == "in"
    assert text_of("<p>" * 50000 + "deep" + "<div>" * 50000) == "deep"
    assert text_of("<p>&am &amp &#233; &bogus;</p>") == "&am & é &bogus;"


def plain(rows):
    """Texts that the markup does not place go if a string of five tokens over them is on two pages of the host."""
    pages = [(re.sub("^[^/]*//|/.*", "", url or ""), Page(html or "")) for _, url, html in rows]
    seen = {}
    for host, page in pages:
        for i in range(len(page.stream) - 4):
            seen.setdefault((host, *page.stream[i : i + 5]), set()).add(page.identity())
    result = []
    for (number, _, _), (host, page) in zip(rows, pages):
        repeated = {
            place
            for place in page.unsure()
            for i in range(max(0, place - 4), place + 1)
            if len(seen.get((host, *page.stream[i : i + 5]), ())) > 1
        }
        result.append((number, page.kept(repeated)))
    return sorted(result, key=str)


def test_what_a_host_repeats_goes(spark):
    configure(spark)
    rnd = random.Random(2)
    rows = []
    for i in range(80):
        host = f"h{i % 3}.example"
        frame = f"<div><p>Welcome to {host}</p><p>Call us</p></div>"
        own = "".join(f"<p>{rnd.choice(['shared line', f'line {rnd.random()}'])}</p>" for _ in range(4))
        rows.append((i, f"https://{host}/{i}", f"<body>{frame}<div>{own}</div><div>Imprint<br>of {host}</div>"))
    rows += [(81, "https://h0.example/x", rows[0][2]), (81, "https://h0.example/x", rows[0][2])]
    rows += [(82, None, None), (None, None, ""), (83, "nonsense", "plain text"), (84, "https://one.example/", rows[1][2])]
    rows += [(85, "https://h1.example/a", "<article><p>Call us</p><p>shared line</p></article>")]
    rows += [(86, "https://h1.example/b", "<p>" + "long " * 300000)]
    expected = plain([row if row[0] != 83 else (83, "//", row[2]) for row in rows])
    assert texts(spark.createDataFrame(rows, PAGES).repartition(7)) == expected
    found = dict(expected)
    assert "Welcome" not in found[5] and "Imprint" not in found[5] and "line" in found[5]
    assert found[84].startswith("Welcome") and found[85] == "Call us\nshared line"


def test_copies_do_not_erase_each_other(spark):
    configure(spark)
    rows = [(i, "https://a.example/", "<div><p>The same text, long enough</p><p>More of it</p></div>") for i in range(9)]
    expected = [(i, "The same text, long enough\nMore of it") for i in range(9)]
    assert texts(spark.createDataFrame(rows, PAGES).repartition(4)) == expected


def test_empty_table_and_other_columns(spark):
    configure(spark)
    assert texts(spark.createDataFrame([], PAGES)) == []
    more = spark.createDataFrame([(1, None, "<p>x", "y", 3)], PAGES + ", host string, row int")
    assert texts(more) == [(1, "x")]
