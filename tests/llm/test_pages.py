"""Main text of pages: markup, site style trees and odd rows."""

import random
import re

from strataloom.llm.pages import blocks, extract, main_text
from strataloom.llm.queries import QUERIES


def test_markup():
    page = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head>
    <body><header>Site</header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad">Buy</div><!-- <p>no</p> -->
    <main><article><header><h1>Title &amp; more</h1></header><p><b>First&nbsp; para<br>graph.<p>Second &lt;one&gt; <i>in</i>line
    </p><ul><li>one<li>two</ul><form>Name <input> <button>Go</button></form><aside>Side</aside><div id="comments"><p>Nice!</p></div>
    <p hidden>gone</p><div class="cookie-notice">We use</div><pre>a
    b</pre></article></main><footer>&copy; me</footer><p>after"""
    assert main_text(page, set()) == "\n\n".join(["Title & more", "First para graph.", "Second <one> inline", "one", "two", "a b"])
    assert main_text("", set()) == "" and main_text("<p>", set()) == "" and main_text("plain text", set()) == "plain text"
    assert main_text("<article><p>cut in the mid", set()) == "cut in the mid"
    assert main_text('<div class="page-with-sidebar"><p>kept</p></div><p><a href="#">only a link</a></p>', set()) == "kept"
    assert main_text('<article class="comment">x</article><article><p>' + "y " * 40 + "</p></article><article>teaser</article>", set()) == ("y " * 40).strip()
    assert blocks("<p " + "\"'" * 2000)[0] == []


def test_site_furniture(spark):
    """Texts without telling markup that a site repeats go, a copied article stays."""
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(500)]
    text = lambda: " ".join(rnd.choice(words) for _ in range(30))
    rows, want = [], {}
    for i in range(40):
        own = [text() for _ in range(3)] if i % 4 else ["a copied article", "of two parts"]
        body = "".join(f"<p>{p}</p>" for p in own)
        rows.append((i, f"http://{'a' if i < 30 else 'b'}.example/{i}", f"<body><div class='x1'><p>Welcome to the site</p></div><div class='x2'>{body}</div><div class='x3'><p>All rights and wrongs {i % 2}</p></div></body>", "q"))
        want[i] = "\n\n".join(own)
    rows += [(100, None, None, "q"), (101, "relative/path", "", "q"), (None, "http://a.example/z", "<p>lone</p>", "q"), (102, "http://c.example", "<p>first of its host</p>", "q"), (102, "http://c.example", "<p>first of its host</p>", "q")]
    got = extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, site string"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.n_chars == len(r.text)
        if r.page_id in want:
            assert r.text == want[r.page_id], r.page_id
    assert {(r.page_id, r.text) for r in found if r.page_id not in want} == {(100, ""), (101, ""), (None, "lone"), (102, "first of its host")}
    assert extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_query(spark):
    """All pages of the table against the articles cut out by a plain pattern."""
    import html

    folder = "/root/testdata/sf0.01"
    got = {r.page_id: r.text for r in QUERIES["op10_main_text"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[p.page_id] == "\n\n".join(x for x in parts if x), p.page_id


def test_regions_hold_all_they_wrap():
    """Nested regions count with the one around them, short posts and text beside articles stay, lists of links go."""
    body = "<p>" + "long body " * 40 + "</p>"
    long = ("long body " * 40).strip()
    assert main_text(f"<main><h1>Title</h1><p>lead</p><article>{body}</article><p>closing</p></main><p>after</p>", set()) == f"Title\n\nlead\n\n{long}\n\nclosing"
    assert main_text(f"<article><h2>One</h2>{body}<article><p>inner</p></article></article><article><h2>Two</h2><p>short post</p></article>", set()) == f"One\n\n{long}\n\ninner\n\nTwo\n\nshort post"
    cards = "".join(f"<article><h3><a href='/{i}'>Card number {i}</a></h3></article>" for i in range(3))
    assert main_text(f"<div class='x'>{body}<p>end</p></div>{cards}<p><a href='/m'>More</a></p>", set()) == f"{long}\n\nend"
    assert main_text("<article><p>see <a href='/a'>the very long link of this post</a></p></article>", set()) == "see the very long link of this post"
    assert main_text(f"<main><p><a href='/t'>Top</a></p>{body}</main>", set()) == f"Top\n\n{long}"
