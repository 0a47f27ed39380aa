"""HTML extraction by site template removal.

A page is parsed once into blocks of text and element subtrees. Every block-level subtree gets a hash of its tags and
text; Spark counts on how many different pages of a host each hash occurs, and subtrees that recur on many pages are
templates and are deleted with all they hold. Inside the article only containers can be templates: paragraphs, headings and
lists of copied articles recur, too, and are text. What is not the same on each page (rotating adverts, comments of readers, related
links) is told by its element, role, class or id. A form, or an element whose class names what a layout has ("has-sidebar"), may wrap
the article itself: what stands in an article or main element there counts if the page has no other and less text beside it.

Pages are parsed where they are read; only hashes are shuffled and each page's deleted spans are joined back to its blocks.
"""

from __future__ import annotations

import html as entities
import re
from hashlib import blake2b

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import map_texts, quoted, written

#: A template occurs on this many different pages of a host; on a small host, where that is more than the share, on the share and
#: on ``LEAST_PAGES`` of them at least. What is a template with ``MANY_PAGES`` stays one however large the host grows.
MANY_PAGES, LEAST_PAGES, SMALL_SHARE = 10, 3, 0.2
# fixed values: elements by what they do
RAW = "script style noscript template textarea title svg iframe object select canvas audio video xmp noembed noframes".split()
TO_THE_END = frozenset("script style textarea title".split())  # without an end tag
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head nav aside footer form dialog menu button fieldset annotation annotation-xml".split())  # annotations repeat a formula
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr
ul""".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li ul ol dl dt dd figure figcaption table thead tbody tfoot tr td th caption".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "body": {"head"}}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
WORDS = re.compile(r"ads?|adverts?|advertisements?|advertising|adsense|banner|breadcrumbs?|comments?|commentlist|cookies?|consent|gdpr|copyright|disqus|footer|"
                   r"masthead|menu|nav|navbar|navigation|newsletter|notices?|pager|pagination|popup|promos?|promotion|related|replies|respond|shar(?:e|ing)|"
                   r"sidebar|signup|social|sponsor(?:ed|s)?|subscribe|toolbar|widgets?|modal|disclaimer|hidden|login|recommended|trending")
#: Words that titles hold, too: on a section or heading of an article they tell nothing unless it recurs across the host.
WEAK_WORDS = re.compile(r"advertising|banner|consent|copyright|cookies?|disclaimer|footer|gdpr|hidden|login|menu|modal|navigation|notices?|promotion|recommended|"
                        r"related|respond|social|sponsor(?:ed|s)?|toolbar|trending|widgets?")
#: Boxes of these hold articles and comments that are not the page's own; an element with another word of the list may wrap the page.
OTHERS = re.compile(r"ads?|adverts?|advertisements?|advertising|adsense|comments?|commentlist|disqus|hidden|modal|popup|promos?|promotion|recommended|related|"
                    r"replies|respond|sponsor(?:ed|s)?|trending|widgets?")
#: An article element with less than this share of the text beside it in the main element is a teaser.
LEAST_OF_MAIN = 0.5
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: In an article the id of one of these counts, as a whole; ids of others are made from titles and terms.
BOXES = frozenset("div ul ol table".split())
SECTION_WORDS = re.compile(r"(?:^|\s)(?:section|level\d|sect\d)(?:\s|$)")
OUTSIDE_WORDS = re.compile(r"header|topbar|top")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/><]*+)(?P<attrs>(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)", re.S | re.I)
RAW_END = {tag: re.compile(rf"</{tag}(?:[\s/][^>]*)?>", re.I) for tag in RAW}
ATTR = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    """Lower-case host of a URL without "www.", an empty text if there is none."""
    m = HOST.match(url or "")
    return m.group(1).lower().removeprefix("www.") if m else ""


def is_boilerplate(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool, bool]:
    """Whether an element is told to be no article text by its name, role, class or id; whether it is if it also recurs; whether it may wrap an article."""
    if tag in DROPPED or tag == "header" and not in_article:
        return True, False, tag == "form" and not in_article
    if not attrs or tag in ("html", "body", "main"):
        return False, False, False
    found = [(name.lower(), (a or b or c).lower()) for name, a, b, c in ATTR.findall(attrs)]
    titled = in_article and (tag in HEADINGS or tag == "section" or any(n == "class" and SECTION_WORDS.search(v) for n, v in found))
    weak = wraps = False
    for name, value in found:
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES:
            return True, False, False
        if name == "id" and (tag in HEADINGS or titled):
            weak = weak or WORDS.fullmatch(value) is not None
        elif name == "id" and in_article:
            if tag in BOXES and WORDS.fullmatch(value):
                return True, False, False
        elif name in ("class", "id"):
            for word in re.split(r"[^a-z0-9]+", value):
                if WORDS.fullmatch(word) or not in_article and OUTSIDE_WORDS.fullmatch(word):
                    if titled and WEAK_WORDS.fullmatch(word):
                        weak = True
                    elif in_article or OTHERS.fullmatch(word):
                        return True, False, False
                    else:
                        wraps = True
    return wraps, weak and not wraps, wraps


class _Node:
    __slots__ = ("tag", "dropped", "article", "main", "first", "weak", "wrapped", "parts")

    def __init__(self, tag, dropped, article, main, first, weak=False, wrapped=False):
        self.tag, self.dropped, self.article, self.main, self.first, self.weak, self.wrapped, self.parts = tag, dropped, article, main, first, weak, wrapped, []


def best_kind(blocks: list[tuple[str, int]]) -> int:
    """The kind of block that is the page's text: articles, unless they are teasers beside the text of a main element; or else main; or else the body."""
    size = [0] * 4
    for t, kind in blocks:
        size[kind] += len(t)
    return 2 if size[3] < LEAST_OF_MAIN * size[2] else max((k for k in range(4) if size[k]), default=0)


def parse(page: str | None) -> tuple[list[tuple[str, int]], list[tuple[int, int, int]]]:
    """([(text, kind)], [(subtree hash, first block, end block)]): kind 0 dropped, 1 body, 2 main, 3 article.

    White space inside a block is one space. Open elements are closed as browsers do in the usual cases: a block closes an open
    paragraph, an item the item before it, an end tag all that is open inside it; others are ignored.
    """
    blocks: list[tuple[str, int]] = []
    nodes: list[tuple[int, int, int]] = []
    text: tuple[list[str], list[str]] = ([], [])  # of the open block: kept, and in dropped inline elements
    root = _Node("", False, False, False, 0)
    stack = [root]

    def flush():
        top = stack[-1]
        for part, kind in zip(text, ((3 if top.article else 2 if top.main else 1) * (-1 if top.wrapped else 1), 0)):
            if part:
                t = " ".join(entities.unescape("".join(part)).split())
                part.clear()
                if t:
                    blocks.append((t, kind))
                    top.parts.append(t)

    def close():
        node = stack.pop()
        digest = blake2b(("\x00".join([node.tag, *node.parts])).encode("utf-8", "replace"), digest_size=8).digest()
        stack[-1].parts.append(digest.hex())
        article = stack[-1].article or stack[-1].main
        if node.tag in BLOCK and len(blocks) > node.first and node.tag not in ("html", "body", "article", "main") and not (article and node.tag in TEXT_BLOCKS and not node.weak):
            nodes.append((int.from_bytes(digest, "big", signed=True), node.first, len(blocks)))

    def close_to(tags, stop):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                if any(n.tag in BLOCK for n in stack[i:]):
                    flush()
                while len(stack) > i:
                    close()
                return
            if stack[i].tag in stop:
                return

    at, page, unclosed = 0, page or "", set()
    while m := TOKEN.search(page, at):
        if m.start() > at:
            text[stack[-1].dropped].append(page[at:m.start()])
        at = m.end()
        if (tag := m["tag"]) is None:
            continue
        tag = tag.lower()
        if tag in RAW_END and not m["end"]:
            if tag == "svg" and m["attrs"].rstrip().endswith("/"):
                continue
            # no end tag from here on: none for the later ones, either
            if tag not in unclosed and (end := RAW_END[tag].search(page, at)):
                at = end.end()
                continue
            unclosed.add(tag)
            if tag in TO_THE_END:
                at = len(page)
            continue
        if m["end"]:
            if tag in BLOCK:
                flush()
            close_to((tag,), () if tag in BLOCK else BLOCK)
            continue
        if tag in BLOCK:
            flush()
            close_to(("p",), BLOCK - {"p"})
            if tag in CLOSED_BY:
                close_to(CLOSED_BY[tag], {"ul", "ol", "dl", "table", "tbody", "menu", "select", "article", "main"})
        elif tag == "br":
            text[stack[-1].dropped].append(" ")
        if tag in VOID:
            continue
        up = stack[-1]
        inside = up.article or up.main
        told, weak, wraps = is_boilerplate(tag, m["attrs"], inside)
        # in a wrapper only an article or a main element may be text
        lost = up.dropped and not up.wrapped or told and not wraps
        wrapped = not lost and (up.wrapped or told)
        article = up.article or tag == "article" and not lost
        main = up.main or not lost and (tag == "main" or "main" in m["attrs"] and re.search(r"role\s*=\s*[\"']?main\b", m["attrs"]) is not None)
        stack.append(_Node(tag, lost or wrapped and not article and not main, article, main, len(blocks), weak, wrapped))
    text[stack[-1].dropped].append(page[at:])
    flush()
    while len(stack) > 1:
        close()
    if any(kind < 0 for _, kind in blocks):
        wrapped, others = sum(len(t) for t, kind in blocks if kind < 0), sum(len(t) for t, kind in blocks if kind == 1)
        lift = wrapped > others and not any(kind > 1 for _, kind in blocks)
        blocks = [(t, kind if kind >= 0 else -kind if lift else 0) for t, kind in blocks]
    return blocks, nodes


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every row: the article's blocks in page order, joined by line breaks.

    With an article element (or else a main one) the text is what stands in it; otherwise all of the body that is left. Articles with less than half of
    the text beside them in the main element are teasers, and the text is that beside them. Null and
    empty pages have an empty text; pages without a host in their URL count as one host; equal rows each stay. Pages
    with equal text count once for a template, so copies of an article do not delete each other.
    """
    narrow = pages.select(F.col(quoted(key)).alias("key"), F.col(quoted(url)).alias("url"), F.col(quoted(page)).alias("page"), F.monotonically_increasing_id().alias("row"))

    def make():
        def fn(urls, htmls):
            hosts, blocks, nodes, whole = [], [], [], []
            for u, h in zip(urls, htmls):
                b, n = parse(h)
                best = best_kind(b)
                hosts.append(host_of(u))
                blocks.append([t if k and k == best else None for t, k in b])
                nodes.append([{"hash": x, "first": f, "end": e, "text": any(t is not None for t in blocks[-1][f:e])} for x, f, e in n])
                kept = "\n".join(t for t in blocks[-1] if t is not None)
                whole.append(int.from_bytes(blake2b(kept.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True))
            return [hosts, blocks, nodes, whole]
        return fn

    fields = [("host", "string"), ("blocks", "array<string>"), ("nodes", "array<struct<hash:bigint,first:int,end:int,text:boolean>>"), ("whole", "bigint")]
    parsed = written(map_texts(narrow, make, fields, ["row", "key", "url"], ["url", "page"]), "pages")
    subtrees = parsed.select("row", "host", "whole", F.explode("nodes").alias("n")).select("row", "host", "whole", "n.hash", "n.first", "n.end", "n.text")
    sizes = parsed.select("host", "whole").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    seen = subtrees.select("host", "hash", "whole").distinct().groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES)
    template = seen.join(sizes, "host").where(F.col("n") >= F.least(F.lit(float(MANY_PAGES)), SMALL_SHARE * F.col("pages"))).select("host", "hash")
    # only spans that hold text not yet dropped by name go back to their pages
    deleted = subtrees.where("text").join(template, ["host", "hash"]).groupBy("row").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    # written first: its size is known then, so few deletions do not shuffle all texts
    deleted = written(deleted, "deleted")
    out = parsed.join(deleted, "row", "left")
    left = F.filter("blocks", lambda b, i: b.isNotNull() & ~F.coalesce(F.exists("spans", lambda s: (s["first"] <= i) & (i < s["end"])), F.lit(False)))
    text = F.array_join(left, "\n")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), text.alias("text"), F.length(text).cast("bigint").alias("n_chars"))
