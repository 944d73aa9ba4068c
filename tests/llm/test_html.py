import html as H
import re

from conftest import SF_MID
from warnindex.llm import html_extract as X
from warnindex.llm.queries import op10_html_site_style_tree

P = X.SiteParams()


def alone(page):
    t = X.PageTree(page)
    nodes = [{"key": i, "parent": up, "rank": r} for i, (_, up, r) in enumerate(t.nodes)]
    return X.main_text(nodes, [{"text": x, "node": n} for x, n in t.blocks], {})


def test_parts_go():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="post">
    <header><a>Logo</a></header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">We use cookies</div>
    <div id=wrap><main><div class="breadcrumbs">a &gt; b</div><article class="entry"><header><h1>Head &amp; line</h1></header>
    <p>One <b>bold</b> and<br>two&nbsp;three <p>Next &copy 2020 &lt;tag&gt;</p><div class="ad-slot"><p>Buy</p></div><!-- no -->
    <ul><li>first<li>second</ul><pre>code  x</pre><aside>Aside</aside><table><tr><td>a</td><td>b</td></tr></table>
    <form>Name <input></form><footer>By me</footer></article><section id="comments"><article class="comment">Nice!</article></section></main>
    <div class="sidebar">Side</div></div><footer>End</footer><div>stray</div>"""
    assert alone(page).split("\n\n") == ["Head & line", "One bold and two three", "Next © 2020 <tag>", "first", "second", "code x", "a b"]


def test_odd_input():
    assert alone(None) == alone("") == alone("<html><body></body>") == ""
    assert alone("plain &amp; text") == "plain & text"
    assert alone("<p>a<p>b</div></article><p>c") == "a\n\nb\n\nc"
    assert alone("<article><p>cut <a hre") == alone("<article><p>cut </") == "cut" and alone("<p>1 < 2 <") == "1 < 2 <"
    assert alone("<div class=main_content><p>in<p style='display: none'>no</div><div>out</div>") == "in"
    assert alone("<article>x</article><article>y</article>") == "x\n\ny"
    assert alone("<body><div class=ad>only</div></body>") == ""
    assert alone("<p>deep " + "<div>" * 3000 + "end") == "deep\n\nend"
    assert len(alone("<article><p>" + "word " * 400_000)) == 5 * 400_000 - 1


def test_noise_names_and_forms_around_the_page():
    body = "<nav>Menu</nav>{}<div class=comments><article>Nice!</article></div><footer>End</footer>"
    art = "<article><h1>Head</h1><p>The story itself, long enough.</p><form>Name <input></form></article>"
    text = "Head\n\nThe story itself, long enough."
    for wrap in ("<div class='layout has-sidebar'>{}</div>", "<div id=page class=nav-open>{}</div>", "<form action=/>{}</form>",
                 "<form><div class='no-sidebar'><div id=wrap>{}<div class=sidebar>Side</div></div></div></form>", "<div class='site header-open'>{}</div>",
                 "<div class='elementor-widget'>{}<div>stray</div></div>", "<main><form>{}</form></main>"):
        assert alone(wrap.format(body.format(art))) == alone(body.format(wrap.format(art))) == text, wrap
    assert alone(art.replace("<article>", "<article class='post comments-open'>")) == text
    assert alone(f"<div class='main has-sidebar'>{art}</div>") == text
    # what the names say holds where the article is elsewhere
    assert alone(f"{art}<div class=has-comments><article>Nice!</article></div><form><div class=content>Sign up</div></form>") == text
    assert alone("<div><p>No mark at all, but long.</p></div><div class=comments><article>Nice!</article></div>") == "No mark at all, but long."
    # no article: a form or a layout around the page
    assert alone("<form><div><p>All of the text</p></div><div class=sidebar>Side</div></form>") == "All of the text"


def test_site_tree_saves_wrappers(spark):
    page = lambda i: f"<body><div class=widget><div><p>Sentence {i} of its own</p></div></div><div class=promo><p>Buy it</p></div></body>"
    df = spark.createDataFrame([(i, f"https://w.example/{i}", page(i)) for i in range(8)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in X.extract(df).collect()} == {i: f"Sentence {i} of its own" for i in range(8)}


def soup(i):
    """No semantic tags: only the site tells menus from text."""
    return (f"<body><div class=x1><a>Home</a> <a>News</a> <a>About us</a></div><div class=x2><h2>Story {i}</h2>"
            + "".join(f"<p>sentence {i} {j} of its own</p>" for j in range(2 + i % 3)) + "<p>A passage that all share.</p></div>"
            "<div class=x3><div><p>Terms</p><p>Privacy</p></div></div></body>")


def test_style_tree_finds_repeated_branches(spark):
    rows = [(i, f"https://site.example/{i}", soup(i)) for i in range(12)] + [(50, "https://other.example/", soup(50))]
    rows += [(60 + i, "https://copies.example/x", soup(3)) for i in range(9)]  # copies of one page count once
    rows += [(None, None, None), (7, "https://site.example/7", soup(7)), (80, "http://[bad", "<p>x</p>")]
    df = spark.createDataFrame([(*r, 0, "n") for r in rows], "page_id long, url string, html string, page_key int, text string")
    for p in (P, X.SiteParams(nodes_to_broadcast=0)):
        out = X.extract(df, p)
        assert out.columns == ["page_id", "url", "page_key", "text"]
        got = out.collect()
        assert len(got) == len(rows)
        for r in got:
            own = lambda i: "\n\n".join([f"Story {i}", *[f"sentence {i} {j} of its own" for j in range(2 + i % 3)], "A passage that all share."])
            if r.page_id is None:
                assert r.text == ""
            elif r.page_id == 80:
                assert r.text == "x"
            elif r.page_id < 20:
                assert r.text == own(r.page_id)
            else:  # too few pages to judge: everything stays
                assert r.text == f"Home News About us\n\n{own(50 if r.page_id == 50 else 3)}\n\nTerms\n\nPrivacy"


def strip_page(i, strip=True, quote=False):
    """An article mark, and inside of it an unmarked strip on every page and a quotation on some."""
    return (f"<body><nav>Menu</nav><article><h1>Story {i}</h1><div class=q7><p>lead {i} of its own</p></div><p>sentence {i}</p><p>A passage that all share.</p>"
            + ("<blockquote><p>A quotation that some share.</p></blockquote>" if quote else "")
            + ("<div class=z9><ul><li>Post it</li><li>Mail it</li></ul></div>" if strip else "") + "</article><footer>End</footer></body>")


def test_the_tree_drops_strips_inside_the_article(spark):
    rows = [(i, "https://s.example/%d" % i, strip_page(i, quote=i % 4 == 0)) for i in range(12)]
    rows += [(20 + i, "https://few.example/%d" % i, strip_page(i)) for i in range(2)]  # too few pages to judge
    rows += [(30 + i, "https://same.example/%d" % i, strip_page(1).replace("<nav>", f"<nav>{i} ")) for i in range(6)]  # one article at six places
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    strip = ["Post it", "Mail it"]
    for p in (P, X.SiteParams(nodes_to_broadcast=0)):
        for r in X.extract(df, p).collect():
            n = r.page_id if r.page_id < 20 else r.page_id - 20 if r.page_id < 30 else 1
            want = [f"Story {n}", f"lead {n} of its own", f"sentence {n}", "A passage that all share."]
            want += ["A quotation that some share."] if r.page_id < 20 and n % 4 == 0 else []
            assert r.text.split("\n\n") == want + ([] if r.page_id < 20 else strip), r
    # without the tree the strip stays
    assert alone(strip_page(3)).split("\n\n")[-2:] == strip


def test_empty(spark):
    assert X.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_query_against_plain_reading(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    got = op10_html_site_style_tree(spark, SF_MID).collect()
    assert len(got) == len(pages)
    for r in got:
        art = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        parts = [" ".join(H.unescape(re.sub(r"<(b|/b)>", "", re.sub("<br>", " ", x))).split()) for x in re.split(r"</?(?:p|h1)>", art)]
        assert r.text == "\n\n".join(x for x in parts if x) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url
