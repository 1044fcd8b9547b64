import time

import pytest

from mensario.llm import html_main
from mensario.llm.html_main import BODY, OPEN, common, lines, undecided
from mensario.llm.queries import op3_html
from tests.conftest import TESTDATA

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad <p>x</p> -->
<div class="ad-slot">Buy</div><div class="cookie-notice">We use cookies</div><article><header><h1>Title &amp; more</h1></header>
<p><b>First   line.<br><p>Second&nbsp;&lt;b&gt;
line<aside>By the way</aside><form>Name <input></form><div class="comments">Nice!</div><ul><li>One<li>Two</ul></article>
<div id="sidebar">More</div><footer>&copy; 2024</footer></body></html>"""


def test_markup_roles():
    assert [t for t, r in lines(PAGE)] == ["Title & more", "First line.", "Second <b> line", "One", "Two"]
    assert {r for _, r in lines(PAGE)} == {BODY}


@pytest.mark.parametrize("page", [None, "", "<", "<p", "</p></div>", "<script>", "<!-- open", "<p " + "'" * 5000, "<div>" * 3000 + "x", "&amp;&#x41;&bad; <a href='" + "x" * 50_000])
def test_broken_pages_end(page):
    assert isinstance(lines(page), list)


MAIN = [
    ("<div class='page-with-sidebar'><p>Main text</p></div>", ["Main text"]),
    ("<article><p class='share-price'>Up</p></article>", ["Up"]),
    ("<article><div class='social-policy'>Of the state</div></article>", ["Of the state"]),
    ("<main><h2 class='ad-hoc'>A query</h2></main>", ["A query"]),
    ("<main><p class='form-guide'>How to</p></main>", ["How to"]),
    ("<article><section id='comment-on-the-law'>It is new</section></article>", ["It is new"]),
    ("<div><p><a>The whole sentence is a link</a></p><p>Next</p></div>", ["The whole sentence is a link", "Next"]),
    ("<div class='ad-box'>Buy</div><div id='site-footer'>(c)</div><ul><li><a>Home</a></li></ul><p><a>One</a> <a>Two</a></p><p>Text</p>", ["Text"]),
]


@pytest.mark.parametrize(("page", "want"), MAIN)
def test_a_part_of_a_name_drops_nothing(page, want):
    assert [t for t, _ in lines(page)] == want


@pytest.mark.parametrize("piece", ["<a ", "<a '", "<head>", "<a \">'", "</x>", "<li>", "<", "<!-", "<script>", "<p><b>", "<title>x</title>"])
def test_broken_pages_of_a_megabyte_take_a_moment(piece):
    start = time.perf_counter()
    lines("<div>" * 5000 + piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - start < 8


def test_a_near_copy_is_no_witness():
    marks = lambda *texts: [hash(texts), *map(hash, texts)]
    three, four, other = marks("a", "b", "c"), marks("a", "b", "c", "d"), marks("a", "x", "c", "y")
    assert undecided(three, four, None) == [True] * 3 and undecided(four, three, None) == [True] * 4
    assert undecided(four, other, None) == [False, True, False, True]


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_is_a_longest_common_subsequence(rng):
    for _ in range(300):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 12))] for _ in range(2))
        found = sorted(common(a, b))
        assert len(found) == longest(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)


def test_pages_without_container_lose_what_neighbours_share(spark):
    shell = "<html><body><div>Menu of {h}</div><p>{a}</p><p>{b}</p><div>Imprint of {h}</div></body></html>"
    rows = [(i, f"http://h{i % 2}.example/p/{i // 2:03d}?x={i}", shell.format(h=i % 2, a=f"story {i}", b=f"end {i}"), "text", 1) for i in range(600)]
    rows += [(1000, None, None, "t", 1), (1001, "http://alone/x", "<p>Only text</p>", "t", 1), (1001, "http://alone/x", "<p>Only text</p>", "t", 1)]
    rows += [(1002, "http://art/x", "<nav>m</nav><article><p>Said twice</p></article>", "t", 1), (1003, "http://art/y", "<article><p>Said twice</p></article>", "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, key int")
    found = sorted((r.page_id, r.text) for r in html_main.extract(pages).collect())
    assert found[:600] == [(i, f"story {i}\nend {i}") for i in range(600)]
    assert found[600:] == [(1000, ""), (1001, "Only text"), (1001, "Only text"), (1002, "Said twice"), (1003, "Said twice")]
    assert html_main.extract(pages.limit(0)).collect() == []


def test_query_gives_the_article_of_every_page(spark):
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{TESTDATA}/pages.parquet").collect()}
    for row in op3_html(spark, TESTDATA).collect():
        inside = re.search(r"<article>(.*)</article>", pages.pop(row.page_id), re.S)[1]
        import html as h

        blocks = [" ".join(h.unescape(re.sub(r"<[^>]*>", "", part)).split()) for part in re.split(r"</?(?:p|h1|br)>", inside)]
        assert row.text == "\n".join(b for b in blocks if b) and row.n_chars == len(row.text)
    assert not pages
    assert OPEN != BODY


def test_lines_outside_a_container_go_only_if_shared(spark):
    shell = "<html><body><div>Start of the site</div><div>Lead {i}</div><article><p>Story {i}</p></article><div>All of it, free</div></body></html>"
    card = "<html><body><div>Start of the site</div><p>Main text {i}</p><p>More {i}</p><article class=card>Teaser {i}</article><div>All of it, free</div></body></html>"
    rows = [(i, f"http://h.example/p/{i:03d}", (card if i % 5 == 0 else shell).format(i=i)) for i in range(300)]
    rows += [(1000, "http://one.example/a", shell.format(i="alone"))]
    found = {r.page_id: r.text for r in html_main.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found.pop(1000) == "Start of the site\nLead alone\nStory alone\nAll of it, free"
    assert found == {i: f"Main text {i}\nMore {i}\nTeaser {i}" if i % 5 == 0 else f"Lead {i}\nStory {i}" for i in range(300)}


def test_containers_inside_wrappers():
    said = lambda page: [t for t, _ in lines(page)]
    assert said("<form action=x><div>Menu</div><article><p>Text</p></article></form>") == ["Text"]
    assert said("<div class='layout sidebar-right'><main><p>Text</p></main><div class=sidebar><article>No</article></div></div>") == ["Text"]
    assert said("<form id=aspnetForm><div><p>Text</p></div><nav>Menu</nav></form>") == ["Text"]
    assert said("<div class='related-posts'><article>No</article></div><nav><article>No</article></nav><form>Name</form>") == []
