import numpy as np
import pytest

from terracheck.llm import html

TREE = html.train()
PAGES = [
    ("<html><body><nav><a>Home</a></nav><article><h1>A  title</h1><p><b>First &amp; <i>best</i>.<br><p>Sec&eacute;nd</p></article><footer>&copy; x</footer>", "A title First & best. Secénd"),
    ("<article><p>one</p><div class='ad'>buy this now</div><p>two</p><section id=comments><p>I like this long article a lot, thank you all.</p></section></article>", "one two"),
    ("<script>var t='</p>';</script><style>p{}</style><main>in <script>no</script>line</main><!-- x --><aside>side</aside>", "in line"),
    ("<main><p>a < b and c<d e</p><p>5 &lt; 6 &#x41;&#66;</p></main>", "a < b and c 5 < 6 AB"),
    ("<article>cut off in a tag <p clas", "cut off in a tag"),
    ("<article>cut off in a comment <!-- never closed", "cut off in a comment"),
    ("<article>cut &am", "cut &am"),
    ("<article><form><label>Name</label><input></form><header><h1>T</h1></header>x<p></article><p>outside of it</p>", "T x"),
    ("", ""), (None, ""), ("   ", ""), ("<nav>only a menu</nav>", ""),
    ("</p></div><article>stray</article>", "stray"),
    ('<article><p title="a > b">quoted</p><a href="x">read</a> more words than links here</article>', "quoted read more words than links here"),
    ("<div class='cookie-notice'>We use cookies on this site, please accept them all now.</div><div class='post-content'><p>Text of the post.</p></div>", "Text of the post."),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_main_text(page, want):
    assert html.main_text(page, TREE) == want


def test_tree_follows_its_table_and_shallow_text():
    assert (TREE.feature < 0).sum() <= 20
    x = np.array([(-1, 1, 0, 80, 0, 80, 0, 80, 0), (1, 1, 0, 2, 0, 0, 0, 0, 0), (0, 0, 0, 80, 0.1, 2, 0, 2, 0), (0, 0, 0, 3, 1, 2, 1, 2, 1)], dtype=float)
    assert TREE.keeps(x).tolist() == [False, True, True, False]
    plain = "<body><a>Home</a><h1>Title here</h1><p>" + "word " * 30 + "</p><p>" + "more " * 40 + "</p><p><a>next</a></p>"
    assert html.main_text(plain, TREE) == ("Title here " + "word " * 30 + "more " * 40).strip()


def test_long_and_nested_pages():
    deep = "<article>" + "<div>" * 3000 + "core" + "</div>" * 3000 + "</article>"
    assert html.main_text(deep, TREE) == "core"
    assert len(html.main_text("<article>" + "<p>some words &amp; more</p>" * 20000, TREE).split()) == 80000


def test_extract_keeps_columns_and_matches_articles(spark):
    pages = spark.createDataFrame([(i, p, "t", 1) for i, (p, _) in enumerate(PAGES)] + [(None, PAGES[0][0], "t", 1)], "page_id long, html string, text string, N_CHARS int").repartition(3)
    out = html.extract(pages)
    assert out.columns == ["page_id", "html", "text", "N_CHARS", "text_", "n_chars_"]
    for r in out.collect():
        want = PAGES[r.page_id if r.page_id is not None else 0][1]
        assert (r.text_, r.n_chars_, r.text) == (want, len(want), "t")
    assert html.extract(pages.limit(0)).count() == 0


def test_given_pages(spark):
    """The articles of the given pages, read by a plain pattern."""
    import html as std
    import re

    rows = html.op7_html_extraction(spark, "/root/testdata/sf0.01").collect()
    raw = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(rows) == len(raw)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|\Z)", raw[r.page_id], re.S).group(1)
        assert r.text.split() == std.unescape(re.sub(r"<[^>]*>", " ", article)).split() and r.n_chars == len(r.text)


LONG = "word " * 30
BROKEN = [
    ("<html><head><title>T</title><meta charset=x><script>var a</script><body><article><p>after the head</p></article>", "after the head"),
    ("<head><title>T</title><link href=x><p>" + LONG + "</p>", LONG.strip()),
    ("<body><button>Menu<article><p>core text</p><button>Share</button></article>", "core text"),
    ("<body><nav><button>Menu</nav><article><p>core</p></article><button>Up</button>", "core"),
    ("<body><button>Menu <div class='content'><p>" + LONG + "</p></div>", LONG.strip()),
    ("<article><p>one</p><select><option>A<option>B<p>two</p><svg><path d=x><p>three</p></article>", "one two three"),
    ("<article><p>one</p><video><source src=x><p>two</p><noscript>no<p>three</article>", "one two three"),
    ("<article><p>one <button><div>icon</div>Press</button> two</p><noscript><p>no script</p></noscript>three</article>", "one two three"),
    ("<body><form action=x><div><h1>Title</h1><p>" + LONG + "</p><p>" + LONG + "</p></div></form>", "Title " + (LONG * 2).strip()),
    ("<form><div class='post-content'><p>short text</p></div><nav>one two</nav></form>", "short text"),
    ("<form><div class='post-content'><p>Find it here</p></div></form><p>" + LONG + "</p>", LONG.strip()),
]


@pytest.mark.parametrize("page,want", BROKEN)
def test_silent_elements_that_are_not_closed_and_forms_around_pages(page, want):
    assert html.main_text(page, TREE) == want


def test_many_unclosed_silent_elements():
    assert html.main_text("<article>" + "<button>x<p>y</p>" * 20000, TREE).split() == ["y"] * 20000
