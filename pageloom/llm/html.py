"""HTML extraction by wrappers: union-free regular expressions inferred per host.

A page is read as a stream of block tags and texts, nested by its tags. A wrapper is such a
stream made general: every element has a tag and is plain, optional or repeated, texts are
constant or slots. A page is a wrapper of itself. Two wrappers of a host are aligned element by
element (longest common subsequence of their labels, level by level): what matches is made
general together, what does not becomes optional, equal neighbours become one repeated
element, and texts that differ become slots. No alternatives are formed, so a wrapper stays
union-free, and since labels come from a fixed alphabet and depth is bounded, so is its size.

Tasks fold the pages they read into one wrapper per host, wrappers of a host are folded in two
more steps (so a host with a third of all pages is never gathered), and each page is then read
through its host's wrapper: the wrapper says which element is the main region and which texts
are constant template.

Defined results: a null or empty page has the text ''; pages of a null or broken url share the host ''; unclosed and
misnested tags close with the block around them; rows are read one by one, so ties and
repeated rows give equal texts; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog.registry import query
from pageloom.llm.common import batches, bounded, land, table

#: A text that this many pages of a host have alike, at the same place outside an article, is template.
CONSTANT_PAGES = 5
#: Elements below this depth stay in the element at it: they end blocks and are left out if unwanted.
MAX_DEPTH = 128
#: Wrappers a task holds before it passes them on.
HELD_HOSTS = 2_000
FIRST_FOLD = 256

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
BLOCKS = frozenset(
    "html head body article section main nav header footer aside form div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody "
    "tfoot tr td th caption blockquote pre figure figcaption address details summary fieldset dialog center hr menu".split()
)
#: Elements that are never part of an article.
OUTSIDE = frozenset("head nav header footer aside form dialog menu select button label option object audio video canvas".split()) | RAW
CLOSES_P = BLOCKS - {"html", "head", "body"}
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6".split())
#: Open elements before these are not closed by a block's, or an item's, start tag.
KEEPS_P = frozenset("div article section td li".split())
KEEPS_ITEM = frozenset("ul ol dl table".split())
#: Start tags that end an open element of the same group.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words in class, id or role that tell what an element is for.
UNWANTED = frozenset(
    "ad ads advert advertisement promo promotion sponsor sponsored banner nav navigation navbar menu breadcrumb breadcrumbs sidebar "
    "widget related recommended footer header masthead cookie cookies consent notice alert popup modal overlay subscribe newsletter "
    "signup share sharing social comment comments disqus replies reply respond login search toolbar pagination pager complementary contentinfo".split()
)
WANTED = frozenset("article content main post entry story body text".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|"
    r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|[^<]++|<",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Names that say what a page has, or has not, rather than what the element is ("has-sidebar").
TELLS = frozenset("has have with without no not is hide hides hidden show shows enable enabled disable disabled".split())
#: Last parts of a name that say nothing; the part before them counts ("comment-list").
PLAIN = frozenset("area bar block body bottom box boxes card cards column container content form group heading holder inner item items left "
                  "link links list main outer panel right row section slot text title top unit wrap wrapper zone".split())
#: Never judged by name, and judged by whole names alone.
WHOLE_PAGE, BY_WHOLE_NAME = frozenset(("html", "body")), frozenset(("main", "article"))
#: Start tags that end these elements, should they be open: they are never inside them.
ENDS = {"body": {"head"}, "main": {"head", "nav", "header", "footer", "aside"}, "article": {"head", "nav", "header"}}


class Node:
    """An element of a page: its label, and its blocks and texts in order."""

    __slots__ = ("label", "tag", "children")

    def __init__(self, label: str, tag: str):
        self.label, self.tag, self.children = label, tag, []


@lru_cache(maxsize=4096)
def label_of(tag: str, rest: str) -> str:
    hints: set[str] = set()
    if tag not in WHOLE_PAGE:
        for found in ATTRIBUTE.finditer(rest):
            for name in (found[1] or found[2] or found[3] or "").split():
                hints |= {name.lower()} & (UNWANTED | WANTED) if tag in BY_WHOLE_NAME else told_by(name)
    return " ".join([tag, *sorted(hints)])


def told_by(name: str) -> set[str]:
    """What one name of a class, id or role says: its last part, or what that belongs to."""
    parts = [w.lower() for w in WORDS.findall(name)]
    if not parts or parts[0] in TELLS:
        return set()
    hints = {parts[-1]} & (UNWANTED | WANTED)
    while len(parts) > 1 and parts[-1] in PLAIN:
        parts.pop()
        hints |= {parts[-1]} & (UNWANTED | WANTED)
    return hints


def parse(html: str) -> Node:
    """The block tree of a page; inline tags leave no trace, ``br`` leaves a blank."""
    root = Node("", "")
    stack, at, size = [root], 0, len(html)
    opened: dict[str, list[int]] = {}  # places in the stack by tag
    nearest: list[dict[str, int]] = [{}]  # for each place, what a start tag there may close

    def leave(place: int) -> None:
        for node in stack[place:]:
            opened[node.tag].pop()
        if place >= MAX_DEPTH:
            stack[place - 1].children.append(Node(stack[place].label, stack[place].tag))
        del stack[place:], nearest[place:]

    while at < size:
        token = TOKEN.match(html, at)
        at = token.end()
        tag = token["tag"]
        if tag is None:
            text = token[0]
            if text[:2] not in ("<!", "<?"):
                stack[-1].children.append(text)
            elif text.startswith("<![CDATA["):
                stack[-1].children.append(text[9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if token["end"]:
            if opened.get(tag):
                leave(opened[tag][-1])
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>|\Z", re.I).search(html, at)
            at = max(close.end(), at)
            continue
        if tag not in BLOCKS and tag not in OUTSIDE:
            if tag == "br":
                stack[-1].children.append(" ")
            continue
        if tag in CLOSES_P and opened.get("head"):
            leave(opened["head"][-1])
        for other in ENDS.get(tag, ()):
            if opened.get(other):
                leave(opened[other][-1])
        if tag in CLOSES_P and "p" in nearest[-1]:
            leave(nearest[-1]["p"])
        if tag in SIBLINGS and (near := max((nearest[-1].get(t, 0) for t in SIBLINGS[tag]))):
            leave(near)
        node = Node(label_of(tag, token["rest"]), tag)
        stack[-1].children.append(node)
        if tag not in VOID and not token["rest"].endswith("/"):
            place, now = len(stack), nearest[-1]
            if place >= MAX_DEPTH:
                inner = Node(node.label, tag)
                if not unwanted(node.label):
                    inner.children = stack[-1].children
                node = inner
            if tag in KEEPS_P or tag in KEEPS_ITEM:
                now = {t: i for t, i in now.items() if not (tag in KEEPS_P if t == "p" else tag in KEEPS_ITEM)}
            if tag in PARAGRAPHS or tag in SIBLINGS:
                now = now | {"p" if tag in PARAGRAPHS else tag: place}
            stack.append(node)
            nearest.append(now)
            opened.setdefault(tag, []).append(place)
    return root


def texts(node: Node) -> list[Node | str]:
    """The children of a node with neighbouring texts joined and cleaned, blank ones left out."""
    out, run = [], []
    for child in [*node.children, None]:
        if isinstance(child, str):
            run.append(child)
            continue
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text:
                out.append(text)
            run = []
        if child is not None:
            out.append(child)
    return out


# A wrapper is [label, optional, repeated, pages, constant, children]; label "#" is a text, whose
# constant is the checksum of what all pages have there, or None for a slot.


def wrapper(node: Node) -> list:
    children = [["#", 0, 0, 1, crc32(c.encode()), []] if isinstance(c, str) else wrapper(c) for c in texts(node)]
    return [node.label, 0, 0, 1, None, squeeze(children)]


def squeeze(children: list[list]) -> list[list]:
    """Neighbours of one label become one repeated element, as do groups that follow themselves."""
    out: list[list] = []
    for child in children:
        if out and out[-1][0] == child[0]:
            out[-1] = join(out[-1], child, repeated=True)
            continue
        out.append(child)
        for width in (2, 3, 4):
            if len(out) >= 2 * width and [c[0] for c in out[-width:]] == [c[0] for c in out[-2 * width : -width]]:
                group = out[-width:]
                del out[-width:]
                for i, c in enumerate(group):
                    out[i - width] = join(out[i - width], c, repeated=True)
                break
    return out


def join(a: list, b: list, repeated: bool = False, within: bool = False) -> list:
    """The wrapper of what either describes. ``repeated``: the two are neighbours in a page;
    ``within``: they lie in such neighbours. Neighbours count as one page and hold no constants."""
    within |= repeated
    pages = max(a[3], b[3]) if within else a[3] + b[3]
    constant = a[4] if a[4] == b[4] and not within else None
    return [a[0], a[1] | b[1], int(repeated or a[2] or b[2]), pages, constant, align(a[5], b[5], within)]


def align(a: list[list], b: list[list], within: bool = False) -> list[list]:
    left, right = [c[0] for c in a], [c[0] for c in b]
    if left == right:
        return squeeze([join(x, y, within=within) for x, y in zip(a, b)])
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if left[i] == right[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and left[i] == right[j]:
            out.append(join(a[i], b[j], within=within))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], 1, *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], 1, *b[j][2:]])
            j += 1
    return squeeze(out)


def unwanted(label: str) -> bool:
    tag, *hints = label.split(" ")
    return tag in OUTSIDE or bool(UNWANTED & set(hints))


def region(w: list) -> list[int] | None:
    """Path (child numbers) to the main region: an article, else a main element, else what is
    called content, whichever most pages have and has most slots; else the whole page."""
    found: list[tuple] = []

    def walk(node: list, path: list[int]) -> int:
        slots = 0
        for i, child in enumerate(node[5]):
            if child[0] == "#":
                slots += child[4] is None or child[3] < CONSTANT_PAGES
            elif not unwanted(child[0]):
                inside = walk(child, [*path, i])
                slots += inside
                tag, *hints = child[0].split(" ")
                rank = 3 if tag == "article" else 2 if tag == "main" or "main" in hints else 1 if WANTED & set(hints) and tag not in ("body", "html") else 0
                if rank and inside:
                    found.append((-rank, -child[3], len(path), [*path, i]))
        return slots

    walk(w, [])
    return min(found)[3] if found else None


def extract(root: Node, w: list) -> str:
    """The page's main text, read through its host's wrapper."""
    path = region(w)
    main: list[tuple[Node, list]] = []

    def find(node: Node, through: list, rest: list[int]) -> None:
        if not rest:
            main.append((node, through))
            return
        for child, part, i in matched(node, through):
            if i == rest[0] and isinstance(child, Node):
                find(child, part, rest[1:])

    if path is not None:
        find(root, w, path)
    if not main:  # not in this page: the same choice by this page alone
        alone = wrapper(root)
        path = region(alone)
        if path is not None:
            find(root, alone, path)
    blocks: list[str] = []

    def read(node: Node, through: list) -> None:
        for child, part, _ in matched(node, through):
            if isinstance(child, Node):
                if not unwanted(child.label):
                    read(child, part)
            # an article keeps what other pages have alike; a page without one leaves its template out
            elif main or not (part and part[4] is not None and part[3] >= CONSTANT_PAGES and part[4] == crc32(child.encode())):
                blocks.append(child)

    for node, through in main or [(root, w)]:
        read(node, through)
    return "\n\n".join(blocks)


def matched(node: Node, through: list) -> Iterator[tuple[Node | str, list, int]]:
    """Children of a page's element with the parts of the wrapper that they match, in order;
    a repeated part (or group of them) matches again."""
    parts, at = through[5], 0
    by_label: dict[str, list[int]] = {}
    for i, part in enumerate(parts):
        by_label.setdefault(part[0], []).append(i)
    for child in texts(node):
        label = child.label if isinstance(child, Node) else "#"
        places = by_label.get(label)
        if not places:
            yield child, [label, 1, 0, 0, None, []], -1
            continue
        i = next((p for p in places if p >= at), next((p for p in reversed(places) if parts[p][2]), places[-1]))
        yield child, parts[i], i
        at = i if parts[i][2] else max(at, i + 1)


def host_column(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1)), F.lit(""))


def dump(w: list) -> str:
    return json.dumps(w, separators=(",", ":"))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper) of every host, from all its pages."""

    def fold(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([dump(w) for w in held.values()])], schema=pa.schema([("host", pa.string()), ("wrapper", pa.string())]))
            held.clear()
            return made

        for batch in batches(source):
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = wrapper(parse(html or ""))
                held[host] = join(held[host], own) if host in held else own
            if len(held) > HELD_HOSTS:
                yield out()
        yield out()

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        made = None
        for text in sorted(rows["wrapper"]):
            own = json.loads(text)
            made = own if made is None else join(made, own)
        return pd.DataFrame({"host": rows["host"].iloc[:1], "wrapper": [dump(made)]})

    parts = pages.select(host_column(url_col).alias("host"), F.col(html_col).alias("html")).mapInArrow(fold, "host string, wrapper string")
    parts = land(parts.withColumn("fold", F.pmod(F.spark_partition_id(), F.lit(FIRST_FOLD))), "wrapper-parts")
    schema = "host string, wrapper string"
    some = parts.groupBy("host", "fold").applyInPandas(lambda rows: meet(rows), schema)
    return land(some.groupBy("host").applyInPandas(lambda rows: meet(rows), schema), "wrappers")


def main_texts(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches(source):
            made = []
            for html, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if text not in known:
                    if len(known) > HELD_HOSTS:
                        known.clear()
                    known[text] = json.loads(text) if text else wrapper(parse(html or ""))
                made.append(extract(parse(html or ""), known[text]) if html else "")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.string()), pa.array(map(len, made), pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    found = bounded(wrappers(pages, url_col, html_col))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"), host_column(url_col).alias("host")).join(found, "host", "left")
    return rows.select("_id", "_url", "_html", "wrapper").mapInArrow(run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars long")


@query("op1_html")
def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
