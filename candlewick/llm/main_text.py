"""Main text of web pages: page structure plus site template removal.

Each page is parsed once, in a task, to its text blocks.  What HTML itself
marks as furniture (navigation, page header and footer, asides, forms,
scripts, hidden parts, ...) or names so (a role, or a whole class or id token
such as ``ad``, ``site-footer``, ``cookie-notice`` or ``comments``) goes at once;
names never drop an article or main, nor what holds one (readers' comments
beside an article excepted).  The main text
is that of the page's articles (``article`` or ``main``, or role main); a page
without any gives its whole body.

Templates without such marks are found by counting: every container subtree is
hashed (tags and text, no attributes), Spark counts per host with how many
different main texts (what the marks leave) a hash occurs, and subtrees with
``MIN_PAGES`` or more of them, and with ``MIN_SHARE`` or more of all main texts
of the host, are deleted with everything below.  Copies of one main text count
once, whatever their adverts, menus or footers, so an article that a site holds
many times is not its own template, and neither is a list that few pages of a
large host share; paragraphs and headings are never counted, only containers,
so a sentence that many articles share stays.

Counting combines before the shuffle on (host, hash, page): a host with a third
of all pages is spread over its subtrees.  Only pages that hold a counted
container inside their main text are joined with the templates.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import common

MIN_PAGES = 5
#: Least share of the host's different main texts that a template is found with.
MIN_SHARE = 0.25

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template iframe object svg math canvas audio video button select option textarea datalist head title dialog".split())
FURNITURE = frozenset("nav aside footer form menu".split())
CONTAINER = frozenset("div section ul ol dl table header footer nav aside form menu figure details center article main".split())
BLOCK = CONTAINER | frozenset("html body p h1 h2 h3 h4 h5 h6 li dt dd tr caption thead tbody tfoot pre blockquote address figcaption fieldset hr summary hgroup search legend".split())
#: Start tags that end an open paragraph.
ENDS_P = BLOCK - frozenset(("tr", "caption", "thead", "tbody", "tfoot"))
#: Start tag -> tags that it ends, up to the nearest of the stoppers.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
#: Class or id tokens that name furniture, alone or as ``[LEADS-]name[-PARTS]``.  Names that also stand
#: for content or layout (menu, notice, share, social, widget, banner, overlay, ...) are left to the counts.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense adsbygoogle nav navbar navigation menubar breadcrumb breadcrumbs sidebar sidenav footer gdpr modal popup "
    "comments commentlist disqus related recommendations pagination pager searchform searchbox "
    "ad-banner ads-banner cookie-banner cookie-bar cookie-notice cookie-consent cookie-law cookie-popup cookie-overlay cookie-message consent-banner gdpr-notice gdpr-consent "
    "nav-menu menu-bar skip-link skip-to-content skip-nav comment-list comment-form comment-respond disqus-thread login-form signup-form search-form search-box "
    "newsletter-signup newsletter-form newsletter-subscribe subscribe-form subscription-form related-posts related-articles related-links related-content related-stories recommended-posts recommended-articles "
    "sponsored-content sponsored-links sponsored-posts share-buttons share-links share-bar sharing-buttons social-buttons social-links social-icons social-media social-share social-sharing".split())
#: Names of furniture outside an article only: an article has a header of its own.
OUTER_NAMES = frozenset("header masthead topbar top-bar".split())
#: Regions whose articles are readers' comments.
COMMENT_NAMES = frozenset("comments commentlist comment-list disqus disqus-thread".split())
LEADS = frozenset("site main page post global primary secondary top bottom".split())
PARTS = frozenset("wrapper wrap container box block area section inner outer slot unit list".split())
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())


def _tokens(value: str | None) -> set[str]:
    """Whole tokens of a class or id: lower case, camelCase humps and _ as hyphens, without LEADS and PARTS."""
    out = set()
    for token in (value or "").split():
        words = _HUMP.sub("-", token).replace("_", "-").lower().split("-")
        out.add("-".join(words))
        while len(words) > 1 and (words[-1] in PARTS or words[-1].isdigit()):
            words.pop()
        out.add("-".join(words))
        if len(words) > 1 and words[0] in LEADS:
            out.add("-".join(words[1:]))
    return out


class _Element:
    __slots__ = ("tag", "items", "names", "article", "hard", "gone", "holds", "drop", "main", "spared", "frame", "digest")

    def __init__(self, tag: str, names: set[str], article: bool, hard: bool, gone: bool = False) -> None:
        self.tag, self.names, self.article, self.hard, self.gone = tag, names, article, hard, gone
        self.spared = self.frame = False
        self.items: list = []  # strings and elements
        self.holds = self.drop = self.main = False
        self.digest = None


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Element("html", set(), False, False)
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag in ENDS_P:
            self._close({"p"}, {"article", "main", "td", "th", "table", "button", "div", "section"})
        if tag in SIBLINGS:
            self._close(*SIBLINGS[tag])
        a = dict(attrs)
        gone = tag in SILENT or "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in (a.get("style") or "").replace(" ", "").lower()
        furniture = gone or tag in FURNITURE or a.get("role") in ROLES
        e = _Element(tag, _tokens(a.get("class")) | _tokens(a.get("id")), tag in ("article", "main") or a.get("role") == "main", furniture, gone)
        self.stack[-1].items.append(e)
        if tag not in VOID:
            self.stack.append(e)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag and tag in ("svg", "math"):
            self.stack.pop()

    def handle_endtag(self, tag):
        if tag in ("html", "body") or tag in VOID:
            return
        self._close({tag}, {"article", "main"} - {tag} if tag not in ("div", "section") else set())

    def _close(self, tags, stoppers):
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in tags:
                del self.stack[k:]
                return
            if self.stack[k].tag in stoppers:
                return

    def handle_data(self, data):
        self.stack[-1].items.append(data)


def parse(html: str) -> _Element:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    mark(tree.root)
    return tree.root


def _post_order(root: _Element) -> list[_Element]:
    out, todo = [], [root]
    while todo:
        e = todo.pop()
        out.append(e)
        todo.extend(x for x in e.items if not isinstance(x, str))
    out.reverse()
    return out


#: What a form holds that frames a page.
FRAMED = frozenset("nav header footer main article h1".split())


def _harden(root: _Element) -> tuple[bool, bool]:
    """Hand down the marks of HTML; whether an article stands free of them, and outside readers' comments."""
    free = others = False
    todo = [(root, False, False, False, False)]
    while todo:
        e, under, gone, inside, comments = todo.pop()
        gone = gone or e.gone
        e.hard = gone or (not e.spared and (under or e.hard or (e.tag == "header" and not inside)))
        comments = comments or (not e.article and bool(e.names & COMMENT_NAMES))
        free = free or (e.article and not e.hard)
        others = others or (e.article and not e.hard and not comments)
        todo.extend((x, e.hard, gone, inside or e.article, comments) for x in e.items if not isinstance(x, str))
    return free, others


def mark(root: _Element) -> None:
    """Set ``drop`` and ``main``: marks of HTML itself first, names after them.

    A name drops neither an article or main nor an element that holds one.
    Regions of readers' comments go with their articles where the page has an
    article or main outside of them.  A form around the page is no furniture.
    Where every article or main of a page lies in furniture (a form around
    all, a menu that is never closed), what holds one is spared.
    """
    order = _post_order(root)
    for e in order:
        inner = any(x.frame for x in e.items if not isinstance(x, str))
        e.frame = inner or e.tag in FRAMED
        if e.tag == "form" and inner and not e.gone:
            e.hard = False
    own = [e.hard for e in order]
    free, others = _harden(root)
    if not free and any(e.article for e in order):
        for e, hard in zip(order, own):
            e.hard = hard
            e.spared = not e.gone and (e.article or any(x.spared for x in e.items if not isinstance(x, str)))
        free, others = _harden(root)
    for e in order:
        e.holds = not e.hard and (e.article or any(x.holds for x in e.items if not isinstance(x, str)))
    todo = [(root, False, False)]
    while todo:
        e, under, inside = todo.pop()
        named = bool(e.names & NAMES) or (not inside and bool(e.names & OUTER_NAMES))
        comments = others and not e.article and bool(e.names & COMMENT_NAMES)
        e.drop = under or e.hard or (named and (not e.holds or comments))
        e.main = e.article and not e.drop
        todo.extend((x, e.drop, inside or e.main) for x in e.items if not isinstance(x, str))


def digests(root: _Element) -> None:
    """Hash every subtree by tags and text; None where it holds no text."""
    for e in _post_order(root):
        parts = []
        for x in e.items:
            if isinstance(x, str):
                if t := " ".join(x.split()):
                    parts.append(t)
            elif x.digest is not None and x.tag not in SILENT:
                parts.append(f"<{x.digest}>")
        e.digest = xxhash.xxh64_intdigest(f"{e.tag}({'|'.join(parts)})") - (1 << 63) if parts else None


def blocks(root: _Element) -> list[tuple[str, list[int]]]:
    """(text, digests of the counted containers around it) of each block in page order."""
    mains = any(e.main for e in _post_order(root))
    out: list[tuple[str, list[int]]] = []
    text: list[str] = []

    def flush(around):
        if words := " ".join("".join(text).split()):
            out.append((words, [a for a in around]))
        text.clear()

    # (element, next item, digests around, whether its text counts)
    todo = [(root, 0, (), not mains)]
    while todo:
        e, at, around, on = todo.pop()
        done = True
        for k in range(at, len(e.items)):
            x = e.items[k]
            if isinstance(x, str):
                if on:
                    text.append(x)
                continue
            if x.drop:
                if x.tag in BLOCK:
                    flush(around)
                continue
            if x.tag == "br":
                text.append(" ")
                continue
            if x.tag in BLOCK:
                flush(around)
            elif x.tag in ("td", "th"):
                text.append(" ")
            more = (*around, x.digest) if x.tag in CONTAINER and x.digest is not None and not x.main else around
            todo.append((e, k + 1, around, on))
            todo.append((x, 0, more, on or x.main))
            done = False
            break
        if done and e.tag in BLOCK:
            flush(around)
    flush(())
    return out


def page(html: str) -> tuple[int, list[tuple[str, list[int]]], list[int]]:
    """(digest of the main text, blocks, digests of all its counted containers)."""
    root = parse(html)
    digests(root)
    counted = {e.digest for e in _post_order(root) if e.tag in CONTAINER and e.digest is not None and not e.main}
    kept = blocks(root)
    return xxhash.xxh64_intdigest("\n".join(t for t, _ in kept)) - (1 << 63), kept, sorted(counted)


_PARSED = "uid long, page_id long, url string, host string, body long, counted array<long>, blocks array<struct<text: string, around: array<long>>>"


def extract(df: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Inside a block white space is one space; blocks are joined by a line feed
    in page order.  A null or empty html gives the empty text.  A page whose
    url is null or has no host has no site, so only its own marks count.
    Repeated rows give a row each; extra columns are left behind.
    """
    host = F.lower(F.try_parse_url(F.col("url"), F.lit("HOST")))
    raw = df.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    raw = raw.select("uid", "page_id", "url", host.alias("host"), "html")

    def run(batches):
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.struct([("text", pa.string()), ("around", pa.list_(pa.int64()))]))]
        for uid, ids, urls, hosts, pages in common.rows(batches):
            got = [page(p) for p in pages]
            cols = (uid, ids, urls, hosts, [g[0] for g in got], [g[2] for g in got], [[{"text": t, "around": a} for t, a in g[1]] for g in got])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["uid", "page_id", "url", "host", "body", "counted", "blocks"])

    parsed = common.cut(raw.mapInArrow(run, _PARSED))
    sited = parsed.where(F.col("host").isNotNull())
    seen = sited.select("host", F.explode("counted").alias("digest"), "body").distinct()
    often = seen.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    bodies = sited.select("host", "body").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    templates = common.cut(often.join(bodies, "host").where(F.col("n") >= min_share * F.col("of")).select("host", "digest"))
    around = F.array_distinct(F.flatten(F.transform("blocks", lambda b: b["around"])))
    asked = parsed.where(F.col("host").isNotNull()).select("uid", "host", F.explode(around).alias("digest"))
    hits = asked.join(templates, ["host", "digest"]).groupBy("uid").agg(F.collect_set("digest").alias("gone"))
    marked = F.size(around) > 0
    clean = parsed.where(~marked).withColumn("gone", F.lit(None).cast("array<long>"))
    both = parsed.where(marked).join(hits, "uid", "left").select(*parsed.columns, "gone").unionByName(clean)
    kept = F.filter("blocks", lambda b: F.col("gone").isNull() | ~F.arrays_overlap(b["around"], F.col("gone")))
    text = F.concat_ws("\n", F.transform(kept, lambda b: b["text"]))
    return both.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
