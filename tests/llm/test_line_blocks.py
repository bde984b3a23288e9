import random
import re
import time

import pytest
from stardw.llm.line_blocks import extracted, main_text, regions, tokens

LONG = "This paragraph has a good number of words so that the sums over its lines rise well above the threshold."
CASES = [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"),
    ("<nav><a>Home</a></nav><article><h1>T</h1><p>One &amp;amp; <b>t</b>wo\n three<br>four</p></article><footer>f</footer>",
     "T\nOne &amp; two three four"),
    ("<html><title>x</title><body><div class='ad'>buy</div><article><p>x</p><aside>no</aside><p>y</p>"
     "<div class=comments><p>me too</p></div></article>", "x\ny"),
    ("<main><script>var a='</p>';</script><style>p{}</style><!-- no --><p>kept</p><form>Name<input></form></main>", "kept"),
    (f"<div id=menu><a>Home</a> <a>News</a></div><div><p>{LONG}</p><p>Short.</p></div><div class=sidebar>{LONG}</div>",
     f"{LONG}\nShort."),
    ("<article><header><h1>Title</h1></header><p>a &lt;b&gt; &#233;&nbsp;c</p>", "Title\na <b> é\xa0c"),
    ("<article>" + "<p>word</p>" * 5000 + "</article>", "\n".join(["word"] * 5000)),
    ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    ("<p>unclosed <b", "unclosed <b"),
]


@pytest.mark.parametrize(("html", "text"), CASES, ids=range(len(CASES)))
def test_main_text(html, text):
    assert main_text(html or "") == text


def test_surge_and_dive():
    assert regions([0, 0, 50, 50, 0, 0, 0, 5, 0, 0, 0, 90], 80) == [(2, 4), (11, 12)]
    assert regions([], 1) == []
    assert regions([1, 0, 0, 0, 1], 1) == [(0, 1), (4, 5)]


def test_rows_and_columns_stay(spark):
    rows = [(i, None if i % 2 else f"u{i}", html, i) for i, (html, _) in enumerate(CASES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    found = extracted(pages).orderBy("page_id").collect()
    assert [r.text for r in found] == [t for _, t in CASES]
    assert [r.n_chars for r in found] == list(range(len(CASES)))
    assert extracted(pages.limit(0)).count() == 0


LINKS = "".join(f"<li><a href='/{i}'>A linked headline of some length {i}</a></li>" for i in range(6))
WHOLE = [
    # A teaser in an article, the body elsewhere.
    (f"<article><p>Teaser here.</p></article><div><p>{LONG}</p><p>{LONG}</p></div>", f"Teaser here.\n{LONG}\n{LONG}"),
    # A list of links inside main; a linked title stays.
    (f"<main><h1><a href='/'>Title</a></h1><p>{LONG}</p><div>{LINKS}</div><p>{LONG}</p></main>", f"Title\n{LONG}\n{LONG}"),
    (f"<html><head><meta charset=utf-8><title>t</title><body><p>{LONG}</p></body></html>", LONG),
    (f"<html><head><link rel=x><p>{LONG}</p>", LONG),
    (f"<div class='page no-sidebar'><nav>{LINKS}</nav><p>{LONG}</p><footer>Imprint of the site</footer></div>", LONG),
    (f"<form><div id=menu><a>x</a> y</div><div class='banner'><p>{LONG}</p></div></form>", LONG),
    # Long reader comments do not outweigh an article; items set apart end at the next item.
    (f"<article><p>{LONG}</p></article><div class=comments><p>{LONG}</p><p>{LONG}</p></div>", LONG),
    (f"<ul><li class=ad>Buy<li>{LONG}</ul><div class=ad><b>Buy</div><p>{LONG}</p>", f"{LONG}\n{LONG}"),
    (f"<p>Short outside.</p><article><p>{LONG}</p></article>", LONG),
]


@pytest.mark.parametrize(("html", "text"), WHOLE, ids=range(len(WHOLE)))
def test_line_blocks_decide_on_every_page(html, text):
    assert main_text(html) == text


# All markup as one pattern, which reads broken pages again and again.
PLAIN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-zA-Z][^>]*>",
    re.S | re.I,
)
PIECES = ["<a ", "<b>", "</a>", "<!-- ", "-->", '"', "'", ">", "<script ", "<script>", "</script>", "x ", "<", "/", "<p class=", "<!d ", " "]


def test_tokens_are_those_of_the_plain_pattern():
    rng = random.Random(8)
    for _ in range(20_000):
        html = "".join(rng.choices(PIECES, k=rng.randrange(1, 25)))
        plain = [(m.start(), m.end(), bool(m[2]), (m[3] or "").lower(), m[4] or "") for m in PLAIN.finditer(html)]
        assert list(tokens(html)) == plain, html


@pytest.mark.parametrize("unit", ["<a ", '<a b="x ', "<script ", "<!-- ", "<a '>' ", "<a b=\"'>", "<", "</", "<a ' > "])
@pytest.mark.parametrize("end", ["", '"', ">", "'", "\">"])
def test_broken_pages_take_time_by_their_length(unit, end):
    html = unit * (1_000_000 // len(unit)) + end
    began = time.process_time()
    for _ in tokens(html):
        pass
    assert time.process_time() - began < 5


def test_column_of_the_name_of_the_text_gives_way(spark):
    found = extracted(spark.createDataFrame([(1, "<p>new</p>", "old")], "page_id int, html string, Text string"))
    assert found.columns == ["page_id", "text"]
    assert found.collect() == [(1, "new")]
