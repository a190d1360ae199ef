import html as entities
import re

from candlewick.llm import main_text


def text(page):
    return "\n".join(t for t, _ in main_text.blocks(main_text.parse(page)))


def test_blocks_and_marks():
    page = (
        '<body><div class="topbar">x</div><!-- c --><article><header><h1>T&amp;t</h1></header><p>a<b>b <br>c<p>d&nbsp;e<ul><li>1<li>2</ul><aside>no</aside>'
        '<script>var x = "</p>";</script><table><tr><td>x<td>y<tr><td>z</table>tail<form>f</form><div class="cookie-notice">n</div></article><section id="comments">bad</section><footer>f')
    assert text(page) == "T&t\nab c\nd e\n1\n2\nx y\nz\ntail"
    assert text("<div>one</div>two<p>three <i>four</i></p>") == "one\ntwo\nthree four"
    assert text("<main><p>in</p></main><p>out</p>") == "in"
    assert text("<p>&copy; 5 &lt; 6 &amp &unknown;") == "© 5 < 6 & &unknown;"
    assert text("") == "" and text("<p><<>") != ""
    assert text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_names_drop_no_article_and_no_content():
    post = "<h1>T</h1><p>body</p>"
    for names in ('class="post category-social tag-advertising has-comments"', 'id="menu-17" class="sidebar ad"'):
        assert text(f"<article {names}>{post}</article>") == "T\nbody"
        assert text(f"<div {names}><div><main>{post}</main></div></div><p>out</p>") == "T\nbody"
        assert text(f'<div id="page" {names}><article>{post}</article></div>') == "T\nbody"
    for names in ("no-sidebar", "layout-with-sidebar", "ad-free", "has-comments", "menu", "notice", "category-advertising"):
        assert text(f'<div id="page" class="{names}">{post}</div>') == "T\nbody"
    inner = '<p class="notice">a</p><p><span class="share-price">5</span></p><ul class="menu"><li>soup</ul>'
    assert text(f"<article>{post}{inner}</article>") == "T\nbody\na\n5\nsoup"
    for names in ("ad", "site-footer", "adSlot", "ad_unit ad-unit-3", "sidebar-wrapper", "related-posts", "share-buttons", "primary-navigation"):
        assert text(f'<article>{post}<div class="{names}">no</div></article>') == "T\nbody"
    talk = '<section id="comments"><ol><li><article class="comment-body"><p>reply</p></article></ol></section>'
    assert text(f"<article>{post}</article>{talk}") == "T\nbody" and text(talk) == "reply"
    assert text(f'<div hidden><article>x</article></div><article>{post}</article>') == "T\nbody"


def test_template_removal(spark):
    box = "<div><ul><li>Latest stories</li><li>Popular</li></ul></div>"
    pages = [(i, f"http://a.example/{i}", f"<body>{box}<div><p>Story number {i}</p><p>Shared line</p></div></body>", "x", 1) for i in range(8)]
    pages += [(100 + i, f"http://b.example/{i}", f"<body>{box}<p>Other {i}</p></body>", "x", 1) for i in range(3)]
    pages += [(200 + i, "http://c.example/same", f"<body>{box}<p>Copy</p></body>", "x", 1) for i in range(9)]
    pages += [(300, None, f"<body>{box}<p>No site</p></body>", "x", 1), (None, "::bad::", None, "x", 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string, uid long")
    got = {r.page_id: r.text for r in main_text.extract(df).collect()}
    whole = "Latest stories\nPopular\n"
    assert all(got[i] == f"Story number {i}\nShared line" for i in range(8))
    assert all(got[100 + i] == f"{whole}Other {i}" for i in range(3))
    assert all(got[200 + i] == f"{whole}Copy" for i in range(9))
    assert got[300] == f"{whole}No site" and got[None] == ""
    assert main_text.extract(df.limit(0)).count() == 0


def test_copies_and_rare_lists_are_no_templates(spark):
    story = "<article><h1>T</h1><div class='content'><p>One story</p><ul><li>a</li><li>b</li></ul></div><div class='ad'>Advert {0}</div></article>"
    pages = [(i, f"http://a.example/x?from={i}", f"<body><nav>Menu {i}</nav>{story.format(i)}<footer>Foot {i}</footer></body>") for i in range(9)]
    rare = "<ul><li>rare</li></ul>"
    pages += [(100 + i, f"http://b.example/{i}", f"<body><div>Site links</div><p>Page {i}</p>{rare if i < 6 else ''}</body>") for i in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text.extract(df).collect()}
    assert all(got[i] == "T\nOne story\na\nb" for i in range(9))
    assert all(got[100 + i] == f"Page {i}" + ("\nrare" if i < 6 else "") for i in range(40))


def test_pages_against_a_plain_reading(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in df.collect()}
    rows = main_text.extract(df).collect()
    assert len(rows) == len(source)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        parts = (" ".join(entities.unescape(re.sub(r"<[^>]+>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_furniture_around_the_only_article():
    post = "<article><h1>T</h1><p>body</p><form>f</form></article>"
    assert text(f'<form id="aspnetForm"><header>h</header>{post}<footer>f</footer></form>') == "T\nbody"
    assert text(f"<nav><ul><li>home<li>about</ul>{post}") == "T\nbody"
    assert text(f"<nav><a>home</a>{post}<aside><article>teaser</article></aside>") == "T\nbody\nteaser"
    assert text(f"{post}<aside><article>teaser</article></aside>") == "T\nbody"
    assert text('<form id="aspnetForm"><nav>n</nav><h1>T</h1><div><p>body</p></div><form>x</form></form><footer>f</footer>') == "T\nbody"
    assert text("<p>body</p><form><p>your mail</p></form>") == "body"
    assert text(f"<div hidden>{post}</div><p>out</p>") == "out"
    assert text(f"<template>{post}</template><p>out</p>") == "out"
