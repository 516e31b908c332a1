"""Main text: markup, and the cover where markup names no article."""

from __future__ import annotations

import html as escape

import pytest

from retail_strata.llm import html_text as h

PAGES = "page_id bigint, url string, html string, text string, row bigint, blocks string"


def article(page):
    return " ".join(t for t, zone in h.blocks_of(page) if zone == h.ARTICLE_ZONE)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><h1>A&amp;B</h1><p>x<b>y</b>z<p> one\n two<br>three</article>", "A&B xyz one two three"),
        ("<nav>m</nav><article>t<div class='ad'>no</div>u</article><footer>f</footer>", "t u"),
        ("<main><p>in</p><aside>no</aside></main><p>out</p>", "in"),
        ("<div class='post-content'>in</div><div>out</div>", "in"),
        ("<article>a<section id=comments><article class=comment>no</article></section></article>", "a"),
        ("<body class='has-sidebar'><article>a<form>no</form><script>'</article>'</script>b</article>", "a b"),
        ("<article>a<!-- <p>no</p> -->b<style>p{}</style></article", "ab"),
        ("<article><p>a<p>b<div role=alert>no</div><span class=ad>no<span>no</span>no</span>c", "a b c"),
        ("<header>no</header><article><header><h1>T</h1></header>a &lt;b&gt; &eacute;</article>", "T a <b> é"),
        ("<article></article>", ""),
        ("<div class='layout has-sidebar'><article>in</article><div class=sidebar>no</div></div>", "in"),
        ("<div class='page share-enabled'><main>in</main></div>", "in"),
        ("<div class=sidebar><article>in<div class=ad-slot>no</div></article></div>", "in"),
        ("<article>in</article><div class=related><article>teaser</article></div>", "in"),
        ("<main>in<div id=comments-list><article>no</article></div></main>", "in"),
        ("<nav><article>no</article></nav><div class=entry-content>in</div>", "in"),
        ("<ul class=post-list><li>a</ul><div class=post>in</div>", "in"),
        ("İ" * 20 + "<article>a<script>x</SCRIPT>Kept text.<style>y</style>b</article>", "aKept text.b"),
        ("<article>a<div data-class=ad>b</div><p title='class=ad'>c</article>", "a b c"),
        ("<article>a<scripture>b</scripture><script></scripts>no</script>c</article>", "a b c"),
    ],
)
def test_article_by_markup(page, text):
    assert article(page) == text


def test_attributes_that_pages_repeat_are_read_once(monkeypatch):
    reads = []
    named = h._named
    monkeypatch.setattr(h, "_named", lambda attributes: reads.append(attributes) or named(attributes))
    page = "<article>a<div data-x=once class=ad>no</div>b<div data-x=once class=ad>no</div></article>"
    assert [article(page) for _ in range(3)] == ["a b"] * 3
    assert len(reads) <= 1
    long = f"<article>a<div class='{'x ' * h.SHORT}ad'>no</div>b</article>"
    assert article(long) == "a b"


def test_a_list_of_posts_does_not_hide_the_content():
    page = "<div class='post-list'><a href=/1>one</a></div><div id=content><p>real text</div>"
    assert [t for t, zone in h.blocks_of(page) if zone == h.OPEN_ZONE] == ["one", "real text"]


def test_links_as_the_page_names_them():
    links: list[str] = []
    h.blocks_of(
        """<a data-href="x" href="y">1</a><!-- <a href=no> --><script>"<a href=no>"</script>"""
        """<A HREF='/q?a=1&amp;b=2'>2</a><a name=z>3</a><a title="href=no" href=z>4</a><nav><a href=w>""",
        links,
    )
    assert links == ["y", "/q?a=1&b=2", "z", "w"]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], PAGES)
    got = h.main_text(df, "page_id", "url", "html")
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert all(r.n_chars == len(r.text) for r in got.collect())
    return sorted(((r.page_id, r.text) for r in got.collect()), key=str)


def test_cover_of_a_host(spark, prose):
    menu = "Home News Sport Weather Travel Culture Science Money Contact About us"
    own = [escape.escape(prose(k, 40)) for k in range(6)]
    rows = [(k, f"http://a.example/{k}", f"<div>{menu}</div><p>{own[k]}</p>") for k in range(5)]
    rows += [(5, "http://b.example/", f"<div>{menu}</div><p>{own[5]}</p>")]
    expected = [(k, own[k]) for k in range(5)] + [(5, f"{menu} {own[5]}")]
    assert run(spark, rows) == sorted(expected, key=str)


def test_notices_that_frames_hold_are_cut_from_articles(spark, prose):
    notice = "Read more of our stories every morning with a free account today"
    quoted = escape.escape(prose(50, 12))  # a text of one article that sidebars of other pages tease
    shared = escape.escape(prose(51, 12))  # a text that articles share and no frame holds
    rows, expected = [], []
    for k in range(4):
        own = escape.escape(prose(60 + k, 30))
        lead = f"<p>{quoted}</p>" if k == 0 else ""
        body = f"<article>{lead}<p>{own}</p><div>{notice}</div><p>{shared}</p></article>"
        rows.append((k, f"http://a.example/{k}", f"<nav>m{k} {notice}</nav><aside>{quoted} s{k}</aside>{body}"))
        expected.append((k, " ".join([*([quoted] if k == 0 else []), own, shared])))
    bare = escape.escape(prose(70, 30))
    rows.append((9, "http://b.example/", f"<article>{notice}</article>"))
    rows.append((10, "http://a.example/bare", f"<div>{notice}</div><p>{bare}"))
    assert run(spark, rows) == sorted([*expected, (9, notice), (10, bare)], key=str)


def test_every_page_gives_its_frame_to_the_suffixes(spark):
    menu = "one two three four five six seven eight nine"
    pages = [("h", [(f"{menu} m{k}", h.CHROME_ZONE), (f"text {k}", h.ARTICLE_ZONE)]) for k in range(3)]
    df = spark.createDataFrame(pages, "host string, blocks array<struct<text:string,zone:int>>")
    assert h.repeated_suffixes(df).count() == 2


def test_copies_and_odd_rows(spark, prose):
    same = f"<article>{prose(1, 60)}</article>"
    bare = f"<p>{prose(2, 60)}</p>"
    rows = [(k, "http://a.example/", same) for k in range(6)]
    rows += [(10 + k, "http://a.example/", bare) for k in range(6)]
    rows += [(20, None, None), (21, None, ""), (None, "no url", "just text & more"), (22, "x", "<p>" * 3)]
    rows += [(23, "http://a.example/", "<article>" + "<p>word " * 20_000), (10, "http://a.example/", bare)]
    expected = [(k, prose(1, 60)) for k in range(6)] + [(10 + k, prose(2, 60)) for k in range(6)]
    expected += [(20, ""), (21, ""), (None, "just text & more"), (22, "")]
    expected += [(23, " ".join(["word"] * 20_000)), (10, prose(2, 60))]
    assert run(spark, rows) == sorted(expected, key=str)


def test_empty_table(spark):
    assert run(spark, []) == []
