"""Main text of web pages by wrapper induction.

The pages of a host are laid over each other: their trees of block elements are aligned by simple tree matching,
runs of equal siblings counting as one repeated node. A node whose text is the same on nearly all pages is part of
the template; the varying slots show where the content lies. Induction is a merge, so every task merges its own
pages of a host first and the templates of all tasks afterwards.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.session import materialize

#: Pages (a share of the host's, and a number) on which a text must be the same to be part of the template.
CONSTANT_SHARE, CONSTANT_PAGES = 0.9, 8
#: Children a template node remembers; rarer ones are left out, which makes them content.
MOST_CHILDREN = 64
#: Levels that become nodes; what lies deeper belongs to the last of them, without the parts that are outside.
MOST_LEVELS = 120
#: Hosts a task merges at a time.
TASK_HOSTS = 5_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<([a-zA-Z][^\s/>]*)([^>]*)>?",
    re.DOTALL,
)
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style noscript template textarea title iframe xmp noembed noframes".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Elements that are never part of the article.
_OUTSIDE = set(
    "nav header footer aside form head button select option input dialog menu script style noscript template textarea title "
    "iframe svg math object embed canvas audio video map fieldset".split()
)
_OUTSIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|header|masthead|footer|sidebar|aside|notice|cookies?|consent|gdpr|banner|ads?|advert\w*|"
    r"sponsor\w*|promo\w*|comments?|respond|replies|disqus|share|sharing|social|related|recommend\w*|breadcrumbs?|pagination|pager|popup|"
    r"modal|overlay|newsletter|subscribe|signup|login|search|toolbar|widget|contentinfo|complementary|alert|skip)(?:$|[\s_-])",
    re.IGNORECASE,
)
_CLOSED_BY_BLOCK = {"p"}
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_MAIN = {"article", "main"}


class Node:
    __slots__ = ("tag", "label", "outside", "inline", "parts")

    def __init__(self, tag: str, names: str = "", hidden: bool = False, inline: bool = False):
        self.tag, self.inline = tag, inline
        first = re.sub(r"\d+", "", names.split()[0]) if names.split() else ""
        self.label = f"{tag}.{first}" if first else tag
        named = bool(names) and tag not in ("html", "body", "article", "main") and bool(_OUTSIDE_NAMES.search(names))
        self.outside = tag in _OUTSIDE or hidden or named
        self.parts: list[str | Node] = []


def _lost(tag: str) -> Node:
    """A node outside the tree, for what lies outside the article below the last level: its text goes nowhere."""
    return Node(tag)


def parse(page: str) -> Node:
    """The tree of block elements with decoded text; inline elements dissolve unless their names put them outside."""
    root = Node("#")
    stack: list[tuple[str, Node]] = [("#", root)]
    at = 0
    for_text = lambda begin, end: stack[-1][1].parts.append(entities.unescape(page[begin:end])) if begin < end else None

    def close(depth: int) -> None:
        node = stack[-1][1]
        del stack[depth:]
        if stack[-1][1] is node:
            node.parts.append("\0")  # a block deeper than the tree goes

    while (m := _TOKEN.search(page, at)) is not None:
        for_text(at, m.start())
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    if tag in _INLINE:
                        del stack[depth:]
                    else:
                        close(depth)
                    break
                if tag in _INLINE and stack[depth][0] not in _INLINE:
                    break
            continue
        tag, attributes = (m[2] or m[4] or "").lower(), m[3] if m[2] else m[5]
        if not tag:
            continue
        if tag == "br":
            stack[-1][1].parts.append(" ")
            continue
        if tag in _VOID:
            if tag == "hr":
                stack[-1][1].parts.append("\0")
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        found = {n.lower(): (v or "").strip("\"'") for n, v in _NAMES.findall(attributes)} if attributes else {}
        names = f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}".strip()
        hidden = ("hidden" in found and found["hidden"].lower() != "until-found") or found.get("aria-hidden", "").lower() == "true"
        if tag in _INLINE:
            outside = hidden or bool(names and _OUTSIDE_NAMES.search(names))
            if outside and len(stack) < MOST_LEVELS:
                node = Node(tag, names, hidden, inline=True)
                stack[-1][1].parts.append(node)
                stack.append((tag, node))
            else:
                stack.append((tag, _lost(tag) if outside else stack[-1][1]))
            continue
        for depth in range(len(stack) - 1, 0, -1):
            open_tag = stack[depth][0]
            if open_tag in _CLOSED_BY_BLOCK:
                close(depth)
                break
            if open_tag not in _INLINE:
                break
        if tag in _CLOSES:
            ended, bounds = _CLOSES[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in bounds:
                    break
                if stack[depth][0] in ended and (tag != "tr" or stack[depth][0] == "tr"):
                    close(depth)
                    break
        if len(stack) >= MOST_LEVELS:
            stack[-1][1].parts.append("\0")
            stack.append((tag, _lost(tag) if Node(tag, names, hidden).outside else stack[-1][1]))
            continue
        node = Node(tag, names, hidden)
        stack[-1][1].parts.append(node)
        stack.append((tag, node))
    for_text(at, len(page))
    return root


def runs(node: Node) -> Iterator[list[Node]]:
    """Block children in order, those of one label and with like children next to each other together."""
    run: list[Node] = []
    kind = None
    for part in node.parts:
        if isinstance(part, Node) and not part.inline:
            own = part.label, frozenset(p.label for p in part.parts if isinstance(p, Node) and not p.inline)
            if run and own != kind:
                yield run
                run = []
            kind = own
            run.append(part)
    if run:
        yield run


def text_key(nodes: list[Node]) -> tuple[int, int]:
    """Checksum and length of all text below."""
    crc = size = 0
    stack: list[Node | str] = list(reversed(nodes))
    while stack:
        part = stack.pop()
        if isinstance(part, Node):
            stack += reversed(part.parts)
        elif words := " ".join(part.replace("\0", " ").split()):
            crc, size = zlib.crc32(words.encode("utf-8", "replace"), crc), size + len(words)
    return crc, size


def shape(nodes: list[Node]) -> list:
    """A run of nodes as template node: label, pages, text checksum (null: varying), characters, outside, children."""
    kids: list[list] = []
    for node in nodes:
        own = [shape(run) for run in runs(node)]
        kids = merge_children(kids, own, False) if kids else own
    crc, size = text_key(nodes)
    return [nodes[0].label, 1, crc, size, nodes[0].outside, kids]


def match(a: list, b: list, known: dict[tuple[int, int], int]) -> int:
    """Simple tree matching: size of the largest common subtree that keeps order and levels."""
    if a[0] != b[0]:
        return 0
    if (key := (id(a), id(b))) not in known:
        known[key] = 1 + _table(a[5], b[5], known)[-1][-1]
    return known[key]


def _table(xs: list[list], ys: list[list], known: dict[tuple[int, int], int]) -> list[list[int]]:
    table = [[0] * (len(ys) + 1)]
    for x in xs:
        above, row = table[-1], [0]
        for j, y in enumerate(ys):
            row.append(max(row[j], above[j + 1], above[j] + match(x, y, known)))
        table.append(row)
    return table


def merge_children(xs: list[list], ys: list[list], pages: bool = True) -> list[list]:
    """Aligned children of two nodes; those without a partner keep their place."""
    if [x[0] for x in xs] == [y[0] for y in ys]:
        return [merge(x, y, pages) for x, y in zip(xs, ys, strict=True)]
    known: dict[tuple[int, int], int] = {}
    table = _table(xs, ys, known)
    i, j, out = len(xs), len(ys), []
    while i and j:
        gain = match(xs[i - 1], ys[j - 1], known)
        if gain and table[i][j] == table[i - 1][j - 1] + gain:
            i, j = i - 1, j - 1
            out.append(merge(xs[i], ys[j], pages))
        elif table[i][j] == table[i - 1][j]:
            i -= 1
            out.append(xs[i])
        else:
            j -= 1
            out.append(ys[j])
    out = [*xs[:i], *ys[:j], *reversed(out)]
    if len(out) > MOST_CHILDREN:
        rare = sorted(range(len(out)), key=lambda k: (out[k][1], out[k][3]))[: len(out) - MOST_CHILDREN]
        out = [x for k, x in enumerate(out) if k not in set(rare)]
    return out


def merge(a: list, b: list, pages: bool = True) -> list:
    """Two templates laid over each other; ``pages`` false: two siblings of one page."""
    same = a[2] if a[2] == b[2] else None
    if not pages:
        same = zlib.crc32(str(b[2]).encode(), a[2] or 0)
    return [a[0], a[1] + b[1] if pages else a[1], same, a[3] + b[3], a[4] and b[4], merge_children(a[5], b[5], pages)]


def content_path(template: list) -> list[str]:
    """Labels from the root to the node whose varying text is the content.

    The article or main element with most varying text; else down from the root as long as one child has nine
    tenths of it.
    """

    def varying(node: list) -> int:
        if node[4] or (node[2] is not None and node[1] > 1):
            return 0
        inner = sum(varying(k) for k in node[5])
        return inner + max(0, node[3] - sum(k[3] for k in node[5]))

    mains: list[tuple[int, list[str]]] = []

    def search(node: list, path: list[str]) -> None:
        if node[4]:
            return
        path = [*path, node[0]]
        if node[0].split(".")[0] in _MAIN:
            mains.append((varying(node) or node[3], path))
            if node[0].split(".")[0] == "article":
                return
        for kid in node[5]:
            search(kid, path)

    search(template, [])
    articles = [x for x in mains if x[1][-1].split(".")[0] == "article"]
    if articles or mains:
        return max(articles or mains, key=lambda x: x[0])[1]
    node, path = template, [template[0]]
    while node[5]:
        best = max(node[5], key=varying)
        if not varying(best) or varying(best) < 0.9 * varying(node) or best[0].split(".")[0] in ("p", "li", "ul", "ol", "pre", "blockquote", "tr", "td"):
            break
        node, path = best, [*path, best[0]]
    return path


def constants(template: list) -> dict[str, list[int]]:
    """Checksums of text that is the same on nearly all pages, by path."""
    found: dict[str, list[int]] = {}
    least = max(CONSTANT_PAGES, CONSTANT_SHARE * template[1])

    def search(node: list, path: str) -> None:
        path = f"{path}/{node[0]}"
        if node[2] is not None and node[3]:
            if node[1] >= least:
                found.setdefault(path, []).append(node[2])
            return  # what lies below is constant as part of it
        for kid in node[5]:
            search(kid, path)

    # A host of copies of one page has no template.
    if template[2] is None:
        search(template, "")
    return found


def wrapper(template: list) -> str:
    """What extraction needs of a template, as JSON."""
    return json.dumps([content_path(template), constants(template)])


def content(root: Node, rule: str | None) -> str:
    """The text of a page: the blocks of its content nodes in order, without what is outside or in the template."""
    path, same = json.loads(rule) if rule else ([], {})
    starts = _at(root, path) if path else []
    if not starts:
        own = shape([root])
        starts = _at(root, content_path(own)) or [root]
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            blocks.append(text)

    def walk(node: Node, at: str) -> None:
        hide = set()
        if same:
            for run in runs(node):
                known = same.get(f"{at}/{run[0].label}")
                if known and text_key(run)[0] in known:
                    hide.update(map(id, run))
        for part in node.parts:
            if isinstance(part, str):
                pieces = part.split("\0")
                line.append(pieces[0])
                for piece in pieces[1:]:
                    flush()
                    line.append(piece)
            elif part.inline:
                continue
            elif part.outside or id(part) in hide:
                flush()
            else:
                flush()
                walk(part, f"{at}/{part.label}")
                flush()

    prefix = "/" + "/".join(path)
    for start in starts:
        flush()
        if text_key([start])[0] not in same.get(prefix, ()):
            walk(start, prefix)
        flush()
    return "\n".join(blocks)


def _at(root: Node, path: list[str]) -> list[Node]:
    """All nodes at a path of labels from the root."""
    level = [root] if path and path[0] == root.label else []
    for label in path[1:]:
        level = [part for node in level for part in node.parts if isinstance(part, Node) and part.label == label and not part.outside]
    return level


def hosts(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, host, html``: a null page is the empty one, a null or odd address belongs to the host ''."""
    address = F.coalesce(F.col(url), F.lit(""))
    host = F.lower(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.coalesce(F.col(page), F.lit("")).alias("html"))


def induce(pages: DataFrame) -> DataFrame:
    """``host, rule`` from ``hosts(...)``: each host's wrapper, merged in every task and then over all of them."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}

        def sent() -> pa.RecordBatch:
            rows = pa.array(list(known)), pa.array([json.dumps(t) for t in known.values()])
            return pa.RecordBatch.from_arrays([x.cast(pa.string()) for x in rows], names=["host", "template"])

        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = shape([parse(page.as_py())])
                known[host] = merge(known[host], own) if host in known else own
                if len(known) >= TASK_HOSTS:
                    yield sent()
                    known = {}
        yield sent()

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            names, rules = [], []
            for host, template in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = json.loads(template)
                if host == at:
                    total = merge(total, own)
                    continue
                if total is not None:
                    names.append(at)
                    rules.append(wrapper(total))
                at, total = host, own
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(rules)], names=["host", "rule"])
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([wrapper(total)])], names=["host", "rule"])

    parts = pages.select("host", "html").mapInArrow(first, "host string, template string")
    dealt = parts.repartition("host").sortWithinPartitions("host", "template")
    return dealt.mapInArrow(second, "host string, rule string")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text`` of every page: its main text, blocks joined by a line feed, empty if there is none.

    Null and empty pages have the empty text. Hosts are joined to their wrappers by Spark's own choice: sent to all
    tasks while they are few, otherwise with split partitions for a host of a third of all pages. Repeated rows
    each give a row.
    """
    source = hosts(pages, key, url, page)
    rules = materialize(induce(source), "wrappers")
    joined = source.join(rules, "host", "left").select("page_id", "url", "html", "rule")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rules = batch.column(3).to_pylist()
            texts = [content(parse(p.as_py()), r) for p, r in zip(batch.column(2), rules, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = source.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string")
