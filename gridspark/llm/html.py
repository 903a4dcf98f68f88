"""HTML main-text extraction by consensus host paths.

Every page is read once into text blocks, each with the generalised path of its ancestors
(tags and classes, digits as N). A page votes for the container that scores best by the text of
its paragraphs, or for the one around it that this container is a part of; Spark counts the
votes per host, and each page is extracted again with its host's winning path. Pages that lack the winning path, or are of a template of their own, use their own container.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm.common import fresh, released

# A comment, a tag with its attributes, or markup without meaning here (also a tag whose
# quotes do not close).
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>|<[!?/a-zA-Z][^>]*>""", re.DOTALL)
# Path parts kept; elements nested deeper share the path of their ancestor at this depth.
DEPTH = 40
# A page is of another template, where its host's path is a side matter, when its own container holds more than this
# many times the text under that path, and no page that voted for the path has such a container.
OTHER = 4
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no markup; it ends at their own end tag.
RAW = frozenset("script style textarea title xmp noframes iframe noembed".split())
# Elements that are never part of an article's text.
DROPPED = frozenset("script style textarea title head noscript template svg math nav aside footer form button select option iframe object "
                    "canvas audio video dialog menu noframes noembed xmp label input fieldset".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr img".split())
# Start tags that close an open element of the same group first.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "body": {"head"}}
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr main menu nav ol p pre section table ul".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote".split())
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
# Words of a class or id that mark what is not article text.
NOISE = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|"
                   r"subscri\w+|sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|topbar|toolbar|pager|pagination|"
                   r"comments?|commentlist|replies|respond|disqus|share|sharing|social|related|recommend\w*|widgets?|login|signup|search|hidden|"
                   r"skip|legal|copyright|tags?)(?=$|[\s_-]|\d)", re.IGNORECASE)
HEADERS = re.compile(r"(?:^|[\s_-])(?:header|site-header|page-header)(?=$|[\s_-])", re.IGNORECASE)


# Names that say of a container what it has beside the article: no mark of noise.
MODIFIER = re.compile(r"(?<![^\s_-])(?:(?:has|with|without)[_-]\S*|no[_-](?:[a-z]+[_-])*side(?:bar)?(?![a-z]))", re.IGNORECASE)
# Elements that are parts of a text and hold no article by themselves; cells can (layout tables).
PARTS = PARAGRAPHS | frozenset("ul ol dl dt dd table thead tbody tfoot tr caption figure figcaption details summary hgroup address center".split())
CELLS = frozenset(("td", "th"))
OUTER = frozenset(("", "html", "body"))


class Mark:
    """An element that its class or id marks as noise, inside ``around`` (or None)."""
    __slots__ = ("around", "shown", "held", "own", "paragraphs", "inner")

    def __init__(self, around):
        self.around, self.shown = around, False
        self.held = self.own = self.paragraphs = 0  # text inside, without marked parts, and of that in paragraphs
        self.inner = []


class Node:
    __slots__ = ("tag", "path", "depth", "dropped", "article", "mark", "root")

    def __init__(self, tag, path, depth, dropped, article, mark=None, root=None):
        self.tag, self.path, self.depth, self.dropped, self.article = tag, path, depth, dropped, article
        self.mark, self.root = mark, root  # innermost mark; outermost article or main as [mark there, its text]


class Block:
    __slots__ = ("path", "text", "worth", "holders", "paragraph", "mark", "root")

    def __init__(self, *given):
        self.path, self.text, self.worth, self.holders, self.paragraph, self.mark, self.root = given


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(text)}


def opened(tag: str, given: str, parent: Node) -> Node:
    at = attributes(given) if given.strip() else {}
    names = MODIFIER.sub(" ", f"{at.get('class', '')} {at.get('id', '')}").strip()
    kinds = ".".join(sorted({re.sub(r"\d+", "N", c) for c in at.get("class", "").lower().split()}))
    article = parent.article or tag in ("article", "main")
    noise = bool(names) and bool(NOISE.search(names))
    marked = tag not in ("body", "html", "article", "main") and noise or bool(HEADERS.search(names)) and not parent.article
    dropped = (parent.dropped or tag in DROPPED
               or tag == "header" and not parent.article
               or marked and tag in INLINE
               or "hidden" in at or at.get("aria-hidden") == "true" or "display:none" in at.get("style", "").replace(" ", "")
               or at.get("role", "") in ("navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog"))
    path = parent.path if parent.depth >= DEPTH else f"{parent.path}/{tag}.{kinds}" if kinds else f"{parent.path}/{tag}"
    mark = Mark(parent.mark) if marked and not dropped else parent.mark
    root = parent.root or ([mark, 0] if tag in ("article", "main") and not noise else None)
    return Node(tag, path, parent.depth + 1, dropped, article, mark, root)


def unmask(found: list[Block], marks: list[Mark]) -> list[Block]:
    """The blocks outside marked elements. A mark does not count on an element that holds what the page
    is about: its only article, longer than all text outside of marks, or, where no paragraph and
    hardly any text is outside, the most text."""
    for b in found:
        if b.mark is not None:
            b.mark.own += len(b.text)
            b.mark.paragraphs += b.worth if b.paragraph else 0
        if b.root is not None and b.root[0] is b.mark:
            b.root[1] += len(b.text)
    for m in reversed(marks):  # inner ones first
        m.held += m.own
        if m.around is not None:
            m.around.held += m.held
            m.around.inner.append(m)
    open_ = [b for b in found if b.mark is None]
    shown, paragraphs = sum(len(b.text) for b in open_), any(b.paragraph and b.worth for b in open_)
    if not any(b.root is not None for b in open_):
        articles = list({id(b.root): b.root for b in found if b.root is not None and b.root[1]}.values())
        if len(articles) == 1 and articles[0][1] > shown:
            m = articles[0][0]
            while m is not None:
                m.shown = True
                shown, paragraphs, m = shown + m.own, paragraphs or m.paragraphs > 0, m.around
    # from the outside in: what a lifted mark holds is judged again
    order = [(-m.held, k, m) for k, m in enumerate(marks) if m.around is None and not m.shown]
    heapq.heapify(order)
    k = len(marks)
    while order and not paragraphs and 10 * shown < order[0][2].held:
        m = heapq.heappop(order)[2]
        m.shown = True
        shown, paragraphs = shown + m.own, paragraphs or m.paragraphs > 0
        for inner in m.inner:
            k += 1
            heapq.heappush(order, (-inner.held, k, inner))
    for m in marks:  # outer ones first
        m.shown = m.shown and (m.around is None or m.around.shown)
    return [b for b in found if b.mark is None or b.mark.shown]


def container(found: list[Block], best: str, up: dict[str, tuple[str, str]]) -> str:
    """The path of the article that the best-scoring path is part of. ``up`` has the parent's
    path and the tag of each path."""
    chain = [best]
    while chain[-1] in up:
        chain.append(up[chain[-1]][0])
    tags = [up[p][1] if p in up else "" for p in chain]
    if "article" in tags:
        return chain[len(tags) - 1 - tags[::-1].index("article")]
    direct = {b.holders[0] for b in found if b.paragraph and b.worth and b.holders}
    most = len(chain) - 1
    while most and tags[most] in OUTER and tags[most] != "body":
        most -= 1
    at = 0
    # out of lists, tables and sections to what holds them
    while at < most and (tags[at] in PARTS or tags[at] in CELLS and chain[at] not in direct
                         or tags[at] == "section" and (tags[at + 1] not in OUTER or chain[at + 1] in direct)):
        at += 1
    # to an element around it that has paragraphs of its own
    for k in range(at + 1, most + 1):
        if tags[k] not in OUTER and chain[k] in direct:
            at = k
    # and until most text is inside
    whole = sum(len(b.text) for b in found)
    size = Counter()
    for b in found:
        size[b.path] += len(b.text)
    while at < most and 2 * sum(n for p, n in size.items() if p == chain[at] or p.startswith(chain[at] + "/")) < whole:
        at += 1
    while at < most and tags[at] in PARTS:
        at += 1
    return chain[at]


def blocks(html: str) -> tuple[list[tuple[str, str]], str]:
    """(path of the block's element, text) of every block outside dropped elements, in page
    order, and the path of the page's container (empty if there is no text)."""
    stack = [Node("", "", 0, False, False)]
    count: dict[str, int] = {}  # open elements of each tag
    found: list[Block] = []
    marks: list[Mark] = []
    up: dict[str, tuple[str, str]] = {}  # path -> its parent's path, its tag
    text: list[str] = []
    linked = [0]

    def flush():
        if text:
            whole = " ".join("".join(text).split())
            text.clear()
            if whole:
                node = next(n for n in reversed(stack) if n.tag not in INLINE)
                worth = max(0, len(whole) - 2 * linked[0])
                # the paragraph's container, then the two around it
                holders = list(islice((n for n in reversed(stack) if n.tag not in INLINE and n.tag not in ("", "html")), 4))
                paragraph = len(holders) > 1 and holders[0].tag in PARAGRAPHS
                holders = [n.path for n in holders[paragraph:][:3]]
                found.append(Block(node.path, whole, worth, holders, paragraph, node.mark, node.root))
            linked[0] = 0

    def close(until: int):
        while len(stack) > until:
            if stack[-1].tag not in INLINE:
                flush()
            count[stack.pop().tag] -= 1

    at = 0
    while at < len(html):
        m = TOKEN.search(html, at)
        end = m.start() if m else len(html)
        if end > at and not stack[-1].dropped:
            part = unescape(html[at:end])
            text.append(part)
            if count.get("a"):
                linked[0] += len(part)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0 if count.get(tag) else len(stack), -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if stack[k].tag not in INLINE and tag in INLINE:
                    break
            else:
                if tag not in INLINE:
                    flush()
            continue
        if tag not in INLINE:
            flush()
        if tag in VOID:
            continue
        if tag in ENDS_P or tag in CLOSES:
            group = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in group:
                    close(k)
                    break
                if stack[k].tag in SCOPES.get(tag, ()) or stack[k].tag in ("div", "section", "article", "main", "body", "table", "ul", "ol", "nav", "aside", "footer"):
                    break
        if tag in RAW:
            stop = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(html, at)
            at = stop.end() if stop else len(html)
            continue
        if not m[3].rstrip().endswith("/") or tag not in ("path", "use", "rect", "circle"):
            node = opened(tag, m[3], stack[-1])
            if node.mark is not stack[-1].mark:
                marks.append(node.mark)
            if node.path != stack[-1].path:
                up.setdefault(node.path, (stack[-1].path, tag))
            stack.append(node)
            count[tag] = count.get(tag, 0) + 1
    close(1)
    flush()
    found = unmask(found, marks)
    scored: dict[str, float] = {}
    for b in found:
        for share, path in zip((1.0, 0.6, 0.3), b.holders, strict=False):
            scored[path] = scored.get(path, 0) + share * b.worth
    best = container(found, max(sorted(scored), key=lambda p: scored[p]), up) if scored else ""
    return [(b.path, b.text) for b in found], best


FOUND = "page_id long, url string, host string, own string, blocks array<struct<path:string,text:string>>"


@released
def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string())]))
    for batch in batches:
        for lo in range(0, len(batch), 500):
            part = batch.slice(lo, 500)
            got = [blocks(h or "") for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), part.column("host"), pa.array([own for _, own in got], pa.string()),
                 pa.array([[{"path": p, "text": t} for p, t in found] for found, _ in got], kind)],
                names=["page_id", "url", "host", "own", "blocks"])


def host_of(url: str):
    """The lower-cased host of a URL column; without one, empty."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of ``pages`` (page_id, url, html; other columns are
    ignored). All containers below ``DEPTH`` nested elements share one path, so unmarked text
    beside an article at that depth is kept with it; none of the article is lost. Null and textless html gives an empty text; a null url votes with the
    other pages without a host; rows repeat as given."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of("url").alias("host"), "html")
    found = fresh(rows.mapInArrow(_read, FOUND), "blocks")
    votes = found.filter("own <> ''").groupBy("host", "own").agg(F.count(F.lit(1)).alias("votes"))
    winners = fresh(votes.groupBy("host").agg(F.max_by("own", F.struct("votes", "own")).alias("winner")), "winners")
    voted = found.join(winners, "host", "left")

    def inside(path: str):
        return F.filter("blocks", lambda b: (b["path"] == F.col(path)) | b["path"].startswith(F.concat(path, F.lit("/"))))

    def joined(path: str):
        return F.coalesce(F.array_join(F.transform(inside(path), lambda b: b["text"]), " "), F.lit(""))

    judged = voted.select("page_id", "url", "host", "own", joined("winner").alias("by_host"), joined("own").alias("by_page"))
    other = (F.col("by_host") != "") & (F.char_length("by_page") > OTHER * F.char_length("by_host"))
    odd = fresh(judged.filter(other).select("host", "own").distinct(), "odd-paths")
    if not odd.isEmpty():
        judged = judged.join(odd.join(usual_paths(voted), ["host", "own"], "left_anti").withColumn("strange", F.lit(True)), ["host", "own"], "left")
    else:
        judged = judged.withColumn("strange", F.lit(False))
    of_host = (F.col("by_host") != "") & ~(other & F.coalesce("strange", F.lit(False)))
    return judged.select("page_id", "url", F.when(of_host, F.col("by_host")).otherwise(F.col("by_page")).alias("text"))


def usual_paths(voted: DataFrame) -> DataFrame:
    """host, own: the distinct paths, and those around them, on pages that voted for their host's winner."""
    main = voted.filter(F.col("own") == F.col("winner"))
    paths = main.select("host", F.explode(F.array_distinct(F.transform("blocks", lambda b: b["path"]))).alias("path")).distinct()
    parts = F.split("path", "/")
    around = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return paths.select("host", F.explode(around).alias("own")).distinct()
