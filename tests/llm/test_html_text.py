from __future__ import annotations

import html
import itertools
import random
import re
import time

from tripmill.llm import html_text
from tripmill.llm.catalogue import QUERIES

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="home">
<header><h2>Site name</h2></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. Please accept them all, it is better.</p><button>OK</button></div>
<main><article><h1>Title &amp; more</h1><p>First <b>para</b>graph, with  a&nbsp;few words.
It ends here.<p>Second one &lt;tag&gt; &#x41;&copy <img src=x>is long enough to be of use. Yes.
<aside><p>Read also this. It is promoted here, by us.</p></aside><ul><li>an item of the list</li><li>another item</li></ul></article>
<section id="comments"><h3>Comments</h3><p>I liked this text a lot. It was good. Really.</p><form><label>Name</label><input></form></section></main>
<div class="sidebar"><p>Popular. A longer text that stands beside. With marks.</p></div><!-- <p>no</p> -->
<footer>&copy; 2020. All of it.</footer></body></html>"""


def test_article_without_the_rest():
    assert html_text.main_text(PAGE) == (
        "Title & more First paragraph, with a few words. It ends here. Second one <tag> A© is long enough to be of use. Yes. "
        "an item of the list another item"
    )


def test_cut_is_the_cheapest_of_all_labellings():
    rng = random.Random(0)
    for _ in range(150):
        n = rng.randrange(1, 9)
        costs = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def price(side, costs=costs, edges=edges):
            return sum(abs(c) for c, s in zip(costs, side, strict=True) if (c > 0) != s) + sum(w for a, b, w in edges if side[a] != side[b])

        got = html_text.minimum_cut(costs, edges)
        best = min(price(side) for side in itertools.product([False, True], repeat=n))
        assert abs(price(got) - best) < 1e-6


def test_defined_results():
    for page in (None, "", "  \n", "<p>", "<html><head><title>x</title></head><body></body></html>", "<!-- only -->", "<script>x"):
        assert html_text.main_text(page) == ""
    assert html_text.labelled("<article><p>a < b and <c")[0][0].startswith("a < b and")
    assert html_text.main_text("<article><p>Ends in an entity &am</article>") == "Ends in an entity &am"
    assert html_text.main_text("</div></p><article><p>Stray ends are no harm. None.</span></article>") == "Stray ends are no harm. None."


def test_long_pages_stay_quick():
    page = "<article>" + "<p>A paragraph of some words. It has marks.</p><div class=ad>buy</div>" * 8000 + "</article>"
    text = html_text.main_text(page)
    assert text.count("paragraph") == 8000 and "buy" not in text


def test_awkward_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, "x"), (2, "v", "", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted((tuple(r) for r in html_text.extract(pages).collect()), key=repr)
    text = html_text.main_text(PAGE)
    assert got == sorted([(1, "u", text, len(text)), (1, "u", text, len(text)), (None, None, "", 0), (2, "v", "", 0)], key=repr)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_query_gives_the_articles(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op9_html_extraction"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.DOTALL)[1]
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split()) and r["n_chars"] == len(r["text"])


BODY = "<h1>A title</h1><p>The first paragraph of some words. It has marks.</p><p>The second one is as long. It ends here.</p>"
TEXT = "A title The first paragraph of some words. It has marks. The second one is as long. It ends here."


def test_only_hidden_elements_are_hidden():
    for shown in ("style='overflow:hidden'", 'class="overflow-hidden"', "aria-hidden=false", "data-hidden", 'title="what is hidden: display:none"',
                  'data-x="aria-hidden=true"', 'style="display:none;display:block"', "hidden=until-found"):
        assert html_text.main_text(f"<body><div {shown}><article>{BODY}</article></div>") == TEXT, shown
    for gone in ("hidden", 'hidden=""', "HIDDEN class=x", "aria-hidden = 'true'", 'style="color:red; Display : None"', 'style="visibility:hidden"'):
        assert html_text.main_text(f"<body><article>{BODY}<p {gone}>This is not shown. Not at all.</p></article>") == TEXT, gone
    assert html_text.main_text(f"<div style='visibility:hidden'>no<article style='visibility:visible'>{BODY}</article></div>") == TEXT


def test_names_of_containers_around_the_article():
    side = '<div class="sidebar"><p>Popular. A longer text that stands beside. With marks.</p></div>'
    for name in ("layout with-sidebar", "has-comments", "no-banner x"):
        for inner in (f"<article>{BODY}</article>", f"<main>{BODY}</main>", f"<main><article>{BODY}</article></main>", f"<div class='post'>{BODY}</div>"):
            assert html_text.main_text(f'<body><div class="{name}"><div>{inner}</div>{side}</div></body>') == TEXT, (name, inner)
            assert html_text.main_text(f'<body><div id="{name}">{side}{inner}</div></body>') == TEXT, (name, inner)
        assert html_text.main_text(f'<main><div class="{name}"><article>{BODY}</article></div></main>') == TEXT
    # What stands in bad containers beside the article stays out, also in articles of its own.
    for aside in ("<article><p>Read this next. It is short.</p></article>", "<article class=comment><p>" + "I say so. " * 90 + "</p></article>"):
        assert html_text.main_text(f'<body><article>{BODY}</article><div class="related">{aside}</div></body>') == TEXT
        assert html_text.main_text(f'<body><div class="with-sidebar"><article>{BODY}</article><div class="comments">{aside}</div></div></body>') == TEXT
    assert html_text.main_text(f"<body><div class=x>{BODY}</div><div class=sidebar><article><p>Read this next.</p></article></div></body>") != ""


def test_deep_pages_stay_quick():
    deep = "<div class=with-sidebar>" * 20_000
    assert html_text.main_text(deep + f"<article>{BODY}</article>") == TEXT


def test_quotes_count_only_where_a_value_begins():
    four = "".join(f"<p title=don't>Paragraph {i} of some words. It has marks.</p>" for i in range(4))
    assert html_text.main_text(f"<article>{four}</article>") == " ".join(f"Paragraph {i} of some words. It has marks." for i in range(4))
    assert html_text.main_text(f"<article><p title='a > b' class = \"x>y\" data-z=\"it's\">{TEXT}</p></article>") == TEXT
    assert html_text.main_text(f'<article><p title="never closed>{TEXT}</p></article>') == TEXT
    assert html_text.main_text(f"<article><p a\"b 'c>{TEXT}</p></article>") == TEXT
    assert html_text.attributes_of(""" class=a"b id='c d' hidden x = "1>2" class=z""") == {"class": 'a"b', "id": "c d", "hidden": "", "x": "1>2"}


def test_bad_markup_takes_linear_time():
    n = 1_000_000
    bad = ["<" + "a" * n, "x <y " * (n // 5), '<a b="c ' * (n // 8), "<a b='c> " * (n // 9), "<! " * (n // 3), "</ " * (n // 3), "<!--" * (n // 4),
           "<a " + "=" * n, "<a" + " " * n, "<b>" * (n // 6) + "</i>" * (n // 8), "<b>" * (n // 6) + "x<br>" * (n // 10), "<b>" * (n // 6) + "<p>" * (n // 6),
           "<script>" + "</script " * (n // 9), "<" * n, "&" * n]
    for page in bad:
        began = time.process_time()
        html_text.main_text(page)
        html_text.main_text(f"<article>{BODY}</article>{page}>")
        assert time.process_time() - began < 8, page[:20]


def test_text_before_a_tag_that_never_ends_stays():
    assert html_text.main_text(f"<article>{BODY}</article>" + "<a " * 9).startswith(TEXT)
    assert html_text.main_text("<article><p>" + "x <y " * 50).count("<y") == 50


def test_formulas_and_pictures_in_an_article_keep_their_text():
    for inner in ("<math><mi>x</mi><mo>=</mo><mn>1</mn></math>", "<svg><text>x=1</text></svg>", "<object>x=1</object>", "<noscript>x=1</noscript>", "<canvas>x=1</canvas>"):
        assert html_text.main_text(f"<article>{BODY}<p>We know that {inner} holds. It is so.</p></article>") == f"{TEXT} We know that x=1 holds. It is so."


def test_pages_of_short_plain_lines_keep_them():
    lines = ["Short line one.", "Short line two", "And three."]
    nav = "<nav><a href=/>Home</a> <a href=/b>News</a></nav>"
    page = f"<body>{nav}" + "".join(f"<div>{x}</div>" for x in lines) + "<footer>All rights.</footer></body>"
    assert html_text.main_text(page) == " ".join(lines)
    assert html_text.main_text(f"<body>{nav}<div><a href=/x>All of it a link</a></div></body>") == ""
