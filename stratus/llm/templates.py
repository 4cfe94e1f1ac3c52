"""Main text of web pages: site template removal, with the page's own structure as a guard.

A page is read into its elements in one pass (forgiving: unclosed and stray tags do not matter). Three
things are then taken away:

1. What is never text: scripts, styles, comments in the markup, forms, media.
2. What the page itself marks as surroundings: ``nav``, ``header``, ``footer``, ``aside``, ``form`` and
   the like, ARIA roles, and elements with a whole class or id that names a menu, an advert, a notice, comments.
   Inside an ``article`` or ``main`` ids are anchors, and only those of comments count.
   A name is no ground where the element holds the page's only ``article`` or ``main``, or one and most of
   the page's text, or, on a page without any, most of its text.
3. The site's template: every element subtree is hashed (tags and text); in Spark the different pages of a
   host are counted, and those of them that hold a subtree. Subtrees of ``CUT`` elements (blocks that hold
   others; no inline elements, headings, list items or table cells on their own) that stand on at least
   ``SHARE`` of the host's pages, and on ``MANY`` at least, are deleted, inside ``article`` and ``main``
   elements as elsewhere; a passage that fewer pages of a site share is text. Pages that are copies of each
   other, or whose ``article`` and ``main`` elements are, count as one, so an article that was crawled often stays.

Where the ``article`` and ``main`` elements hold at least ``MAIN_PART`` of the text that is left, only theirs
is the main text; else all that is left of the body. An ``article`` named as a comment is surroundings. Block
elements end a block of text; white space in a block becomes one space; blocks are joined by one. Character
references are decoded.

A host with a third of all pages is spread over its subtrees' hashes when they are counted, and its frequent subtrees meet its pages in ``SALTS`` parts.

Defined cases: null or blank html: empty text. Very long pages are read whole, in time linear in their length but for unbalanced quotes. A null url is a host of its own. Repeated rows are
extracted each. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.linkgraph import host_of
from stratus.llm.tables import written

MANY, SHARE, MAIN_PART, SALTS = 5, 0.5, 1 / 3, 16
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template svg math iframe object canvas audio video select textarea title head".split())
AROUND = frozenset("nav header footer aside form button dialog menu fieldset".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                   "option p pre section summary table tbody td tfoot th thead tr ul".split())
CUT = frozenset("address article aside blockquote center details dialog dir div dl fieldset figure footer form header hgroup "
                "menu nav ol p pre section table ul".split())
MAIN = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|newsletter|subscribe|popup|"
    r"modal|nav|navbar|navigation|menu|breadcrumbs?|sidebar|footer|header|masthead|comments?|disqus|replies|respond|"
    r"share|sharing|social|related|recommended|pagination|pager|widget|toolbar|login|signup|search", re.I)
COMMENT = re.compile(r"comments?|comment-body|(?:div-)?comment-\d+|reply|replies", re.I)
RAW = frozenset(("script", "style", "textarea", "title"))  # no tags inside
P_ENDS = BLOCKS - {"br", "caption", "legend", "option", "summary", "td", "th", "tr", "tbody", "thead", "tfoot", "html", "body"}
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
TALK = re.compile(r"comments?|disqus|replies|respond", re.I)  # ids that count inside an article or main: others are anchors there
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
SPACES = re.compile(r"\s+")


class Element:
    __slots__ = ("tag", "around", "named", "kids", "digest")

    def __init__(self, tag: str, around: bool, named: bool) -> None:
        self.tag, self.around, self.named, self.kids, self.digest = tag, around, named, [], 0


def _marks(tag: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element is surroundings by its tag, role or being hidden, and whether by a class or id alone. ``inside``:
    it stands in an article or main."""
    if tag in AROUND:
        return True, False
    if not attributes or tag in ("html", "body", "main"):
        return False, False
    named = False
    if tag == "article":
        return any(COMMENT.fullmatch(x) for name, a, b, c in ATTRIBUTE.findall(attributes)
                   if name.lower() in ("class", "id") for x in (a or b or c).split()), False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "role" and value.strip().lower() in ROLES:
            return True, False
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, False
        telling = NAMES if name == "class" or not inside else TALK
        named = named or name in ("class", "id") and any(telling.fullmatch(x) for x in value.split())
    return False, named


def parse(html: str) -> Element:
    """The tree of a page: kids are elements and decoded strings."""
    root = Element("", False, False)
    stack = [root]
    opened: Counter = Counter()  # tags on the stack
    at, n = 0, len(html)
    last = html.rfind(">") + 1  # no tag ends behind it

    def text(s: str) -> None:
        if s:
            stack[-1].kids.append(unescape(s))

    def cut(depth: int) -> None:
        opened.subtract(e.tag for e in stack[depth:])
        del stack[depth:]

    def close(tags: set, until: set) -> None:
        if not any(opened[t] for t in tags):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                return cut(depth)
            if stack[depth].tag in until:
                return

    while at < n:
        m = TOKEN.search(html, at, last) if at < last else None
        if not m and (comment := html.find("<!--", max(at, last))) >= 0:  # one that is never closed
            text(html[at:comment])
            break
        if not m:
            text(html[at:])
            break
        text(html[at: m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<!--") and (len(m[0]) < 7 or not m[0].endswith("-->")):
                break  # a comment that is never closed
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag]:
                cut(next(d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag))
            continue
        if tag in P_ENDS:
            close({"p"}, {"td", "th", "button", "li", "div", "section", "article", "main", "blockquote", "body"})
        if tag in SAME_ENDS:
            close(SAME_ENDS[tag], SCOPES[tag])
        element = Element(tag, *_marks(tag, m[3], bool(opened["article"] or opened["main"])))
        stack[-1].kids.append(element)
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        stack.append(element)
        opened[tag] += 1
    _settle(root)
    return root


def _walk(root: Element) -> Iterator[tuple[Element, list]]:
    """Every element after its kids."""
    todo = [(root, False)]
    while todo:
        e, done = todo.pop()
        if done:
            yield e
        else:
            todo.append((e, True))
            todo.extend((k, False) for k in reversed(e.kids) if isinstance(k, Element))


def _settle(root: Element) -> None:
    """Names become ``around`` but for elements that hold what the page is about (see above)."""
    sizes: dict[int, tuple[int, bool]] = {}  # text and main elements outside what is surroundings anyway
    for e in _walk(root):
        size, holds = 0, e.tag in MAIN
        for k in e.kids:
            if isinstance(k, str):
                size += len(k.strip())
            elif k.tag not in HIDDEN and not k.around:
                size, holds = size + sizes[id(k)][0], holds or sizes[id(k)][1]
        sizes[id(e)] = size, holds
    whole, mains = sizes[id(root)]
    todo, plain = [root], False  # is a main element outside all named ones?
    while todo and not plain:
        e = todo.pop()
        plain = e.tag in MAIN
        todo.extend(k for k in e.kids if isinstance(k, Element) and k.tag not in HIDDEN and not (k.around or k.named))
    for e in _walk(root):
        if e.named:
            size, holds = sizes[id(e)]
            most = 2 * size > whole
            e.around = e.around or not ((holds and (most or not plain)) if mains else most)


def digest(root: Element) -> None:
    """Hash of each element's subtree: tags and text, white space folded."""
    for e in _walk(root):
        h = blake2b(e.tag.encode(), digest_size=8)
        for k in e.kids:
            if isinstance(k, Element):
                h.update(b"<" + k.digest.to_bytes(8, "little", signed=True))
            elif s := SPACES.sub(" ", k).strip():
                h.update(b">" + s.encode("utf-8", "surrogatepass"))
        e.digest = int.from_bytes(h.digest(), "little", signed=True)


def fragments(root: Element) -> tuple[list[tuple[int, int, bool]], list[tuple[str | None, int]]]:
    """The page's text without its surroundings. Nodes: the ``CUT`` and main elements that text may stand in, as
    ``the node around it (-1: none), its subtree, in a main element``; an element that is not to be cut has
    subtree 0. Parts, in page order: ``text, the node it stands in``; text null ends a block."""
    nodes: list = []
    parts: list = [(None, -1)]
    walk: list = [(root, -1)]
    while walk:
        x, at = walk.pop()
        if x is None or not isinstance(x, str) and x.tag in BLOCKS:
            if parts[-1][0] is not None:
                parts.append((None, -1))
        if x is None:
            continue
        if isinstance(x, str):
            if parts[-1][0] is not None and parts[-1][1] == at:
                parts[-1] = (parts[-1][0] + x, at)
            elif x.strip() or parts[-1][0] is not None:
                parts.append((x, at))
        elif not (x.tag in HIDDEN or x.around):
            inner = at
            if x.kids and (x.tag in CUT or x.tag in MAIN):
                nodes.append((at, x.digest if x.tag in CUT else 0, x.tag in MAIN or at >= 0 and nodes[at][2]))
                inner = len(nodes) - 1
            if x.tag in BLOCKS:
                walk.append((None, inner))
            walk.extend((k, inner) for k in reversed(x.kids))
    return nodes, parts


def main_text(nodes: list, parts: list, template: set) -> tuple[str, bool]:
    """The main text when the subtrees of ``template`` are deleted, and whether it is that of main elements alone."""
    gone: list[bool] = []
    for up, subtree, _ in nodes:
        gone.append(subtree in template or up >= 0 and gone[up])
    left = [(text, at) for text, at in parts if text is None or at < 0 or not gone[at]]
    whole = joined(left)
    mains = joined([(text, at) for text, at in left if text is None or at >= 0 and nodes[at][2]])
    return (mains, True) if mains and len(mains) >= MAIN_PART * len(whole) else (whole, False)


def joined(parts: list) -> str:
    """White space folded in blocks, blocks joined by a space."""
    blocks: list[str] = []
    line: list[str] = []
    for text, _ in [*parts, (None, -1)]:
        if text is not None:
            line.append(text)
        elif line:
            if s := SPACES.sub(" ", "".join(line)).strip():
                blocks.append(s)
            line.clear()
    return " ".join(blocks)


READ = ("page_id long, url string, host string, page long, story long, ups array<int>, subtrees array<long>, "
        "mains array<boolean>, texts array<string>, places array<int>")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.bool_()),
             pa.list_(pa.string()), pa.list_(pa.int32()))
    for batch in batches:
        rows = []
        for html in batch.column(3).to_pylist():
            root = parse(html or "")
            digest(root)
            nodes, parts = fragments(root)
            text, mains = main_text(nodes, parts, set())
            story = int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
            ups, subtrees, inside = zip(*nodes) if nodes else ((), (), ())
            texts, places = zip(*parts)
            rows.append((root.digest, story if mains else root.digest, ups, subtrees, inside, texts, places))
        columns = zip(*rows) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *(pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True))],
            ["page_id", "url", "host", "page", "story", "ups", "subtrees", "mains", "texts", "places"])


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(2, 8)), strict=True)
        texts = [main_text(list(zip(ups, subtrees, mains)), list(zip(texts, places)), set(template or ()))[0]
                 for ups, subtrees, mains, texts, places, template in rows]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])


def template_subtrees(held: DataFrame, many: int = MANY, share: float = SHARE) -> DataFrame:
    """``host, subtree`` of the subtrees that stand on ``share`` of a host's different pages, on ``many`` at least."""
    pages = held.select("host", "story").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    return held.select("host", "story", F.explode("subtrees").alias("subtree")).distinct().groupBy("host", "subtree") \
        .agg(F.count("*").alias("n")).where(F.col("n") >= many) \
        .join(pages, "host").where(F.col("n") >= share * F.col("pages")).select("host", "subtree")


def extract(pages: DataFrame, many: int = MANY, share: float = SHARE) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"), "html")
    read = written(pages.mapInArrow(_read, READ), "read")
    held = read.select("host", "page", "story", F.array_remove(F.array_distinct("subtrees"), F.lit(0).cast("long")).alias("subtrees"))
    frequent = template_subtrees(held, many, share).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # written, so that few templates are known to be few before the pages' texts would be shuffled
    on_page = written(held.select("host", "page", F.pmod("page", F.lit(SALTS)).cast("int").alias("salt"), F.explode("subtrees").alias("subtree")) \
        .join(frequent, ["host", "salt", "subtree"]) \
        .groupBy("host", "page").agg(F.collect_set("subtree").alias("template")), "on_page")
    return read.join(on_page, ["host", "page"], "left") \
        .select("page_id", "url", "ups", "subtrees", "mains", "texts", "places", "template") \
        .mapInArrow(_delete, "page_id long, url string, text string") \
        .withColumn("n_chars", F.char_length("text").cast("long"))
