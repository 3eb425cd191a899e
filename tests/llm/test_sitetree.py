import html
import random
import re

from conftest import SF_SMALL
from cdclake.llm.sitetree import MARKED, main_text, parse, parse_all

RNG = random.Random(8)


def words(n):
    return " ".join(f"w{RNG.randrange(10**6)}" for _ in range(n))


def texts(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS host", "1 AS path")
    return {r["page_id"]: r["text"] for r in main_text(df, **options).collect()}


def test_given_pages_lose_all_but_their_article(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r["page_id"]: r for r in main_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:h1|p)>", inner)]
        assert got[r["page_id"]]["text"] == "\n".join(x for x in parts if x)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def test_branches_that_a_site_repeats_are_cut(spark):
    rows, want = [], {}
    for i in range(12):
        body = [words(20), words(25)]
        rows.append((i, f"https://www.site.example/{i}", f"<div class='top'><span>Our shop</span><p>Call us</p></div><div class=c{i}><p>{body[0]}<p>{body[1]}</div><div class='x9'>Made by us since 1999</div>"))
        want[i] = "\n".join(body)
    for i in range(2):  # too few pages to judge by
        rows.append((100 + i, f"//other.example:80/{i}", "<p>same</p><p>text</p>"))
        want[100 + i] = "same\ntext"
    assert texts(spark, rows) == want


def test_copies_of_an_article_are_kept(spark):
    page = f"<article><p>{words(30)}</p><p>{words(30)}</p></article>"
    rows = [(i, "http://a.example/x", page) for i in range(6)] + [(10 + i, "http://a.example/y", f"<article><p>{words(30)}</p><p>{words(9)}</p></article>") for i in range(12)]
    assert all(len(t.split("\n")) == 2 for t in texts(spark, rows).values())


def test_copies_are_no_evidence(spark):
    pages = [f"<h1>{words(4)}</h1><p>{words(30)}</p><p>{words(30)}</p>" for _ in range(14)]
    rows = [(i, "http://only.example/x", pages[0]) for i in range(8)]
    rows += [(100 + i, f"http://two.example/{i}", pages[1 + i % 2]) for i in range(20)]
    rows += [(200 + i, f"http://most.example/{i}", pages[max(3, i - 37)]) for i in range(48)]  # 41 of 48 are one page
    got = texts(spark, rows)
    assert got == {i: re.sub("<[^>]*>", "", re.sub("</(h1|p)><", "\n<", page)) for i, _, page in rows}


def test_an_article_element_does_not_replace_the_tree(spark):
    rows, want = [], {}
    for i in range(12):
        story, other = [words(40), words(30)], words(9)
        shared = "".join(f"<div class=row><b>Shop {k}</b></div>" for k in range(30))
        card = "<article class=card><p>Our best story of the year</p></article>" if i % 2 else f"<article class=card><p>{other}</p></article>"
        rows.append((i, f"http://a.example/{i}", f"<body>{shared}<div class=story><h1>{story[0]}</h1><p>{story[1]}</p></div>{card}<footer>{words(5)}</footer></body>"))
        want[i] = "\n".join(story)
    rows.append((99, "http://small.example/", "<div class=story><p>The story</p></div><article class=card>Promoted</article><nav>Menu</nav>"))
    got = texts(spark, rows)
    assert got.pop(99) == "The story\nPromoted"
    assert all(t.startswith(want[i]) and "Shop" not in t for i, t in got.items())


def test_the_tree_sees_furniture_and_markup_is_a_weight(spark):
    page = "<p>One <button>Share</button> two</p><nav><ul><li>a</ul></nav>"
    assert [(t, weight <= MARKED) for _, t, _, weight in parse_all(page)[0]] == [("One two", False), ("Share", True), ("a", True)]
    rows = [(i, f"http://a.example/{i}", f"<p>{words(9)}</p><div class=promo>Buy</div><div class=comments>{words(5)}</div>") for i in range(9)]
    assert all(len(t.split("\n")) == 1 for t in texts(spark, rows).values())
    assert all(len(t.split("\n")) == 2 and "Buy" not in t for t in texts(spark, rows, threshold=0.15).values())  # the tree alone cuts what is shared


def test_markup_names_furniture_and_characters_are_decoded():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header>
    <nav><ul><li>a<li>b</ul></nav><main><header><h1>Big &amp;  news</h1></header><p>One<br>two &eacute;&#233;&nbsp;x &lt;b&gt; &amp</p>
    <script>var a = "</p><p>no</p>";</script><!-- <p>no</p> --><div class="advert-box">buy</div><blockquote>Quote <i>in</i>line</blockquote>
    <aside>side</aside><form><p>mail</p></form><ul><li>x<li>y</ul><table><tr><td>1<td>2</table><p hidden>no</p></main>
    <section id="comments"><article class="comment">me too</article></section><footer>f</footer></body>"""
    blocks = [t for _, t, main in parse(page)[0] if main]
    assert blocks == ["Big & news", "One two éé x <b> &", "Quote inline", "x", "y", "1", "2"]


def test_names_of_the_layout_are_no_furniture():
    page = """<body class="with-sidebar"><div class="page has-sidebar header-fixed" id="nav-wrapper"><div class="leftNav">menu</div>
    <div class="ADS">buy</div><div class="storyBody"><p>Kept</p></div><div id="cookieNotice">ok?</div></div></body>"""
    assert [t for _, t, _ in parse(page)[0]] == ["Kept"]


def test_names_that_hold_a_mark_beside_words_of_contents_are_a_hint(spark):
    rows, want = [], {}
    for i in range(12):
        body = [words(20), words(15)]
        rows.append((i, f"http://a.example/{i}", f"<div class='social-security'><p>{body[0]}</p></div><div id='search-results'>{body[1]}</div><div class='cookie-recipes'>The same</div><div class='site-footer'>{words(4)}</div><div class='comment-text'>{words(6)}</div>"))
        want[i] = "\n".join(body)
    assert texts(spark, rows) == want  # the tree cuts what all pages share, though it is only hinted at


def test_furniture_at_any_depth_and_deep_pages_take_linear_time():
    import time

    deep = "<div>" * 600 + "<p>story</p><nav><a>menu</a></nav><div class=ad>buy</div>"
    assert [t for _, t, _ in parse(deep)[0]] == ["story"]
    start = time.time()
    for page in ("<div>" * 50_000 + "x", "<span>" * 50_000 + "<p>x" * 2000, "<ul>" + "<span>" * 20_000 + "<dt>x</dt>" * 2000, "<b>" * 20_000 + "</i></em>" * 20_000, "<table>" + "<tr><td>x" * 20_000, "<p>" + "<i>" * 20_000 + "<div>y</div>" * 2000):
        parse(page)
    assert time.time() - start < 30


def test_broken_and_empty_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, None, "just text < 5 & more"), (4, "http://h/", "<p>a<b>b</p>c</b>d</div></p>e"), (5, "http://h/", "<p title='x>y' class=>z</p"), (6, "h", "<" * 500 + "q"),
            (7, "http://h/", "<script>never closed <p>x</p>"), (8, "http://h/", "<div>" * 3000 + "deep"), (8, "http://h/", "<p>one</p>"), (None, "http://h/", "<p>" + "long " * 40000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = main_text(df).collect()
    assert len(got) == len(rows) and main_text(df.limit(0)).count() == 0
    by = {r["page_id"]: r["text"] for r in got if r["page_id"] != 8}
    assert by[1] == by[2] == by[7] == "" and by[3] == "just text < 5 & more" and by[4] == "ab\ncd\ne" and len(by[None]) == 5 * 40000 - 1
    assert sorted(r["text"] for r in got if r["page_id"] == 8) == ["deep", "one"]
