"""HTML extraction: wrapper induction over the pages of a host.

A host's reference is a tree of all slots (places in the tree) that enough of its pages have. It is
merged, by simple tree matching, from pages chosen so that each such slot is in one of them; null, empty
and odd pages have no say. Every page's DOM tree is aligned with the reference by simple tree matching.
Over all pages of the host it is counted how often a node of the reference has the same text: a block
whose text nearly all pages share, copies of a page counted once, is template, unless it lies in an article or main element, which are kept whole; the others are slots. A slot that holds
nothing but links on nearly all pages is a menu, whatever it is called. Of each page the slots of the article are kept, without what the markup itself names
as something else (menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments); a class
or id does so only by a whole token, on a slot of the wrapper, and never for what holds the article.

Hosts with too few pages are pooled with those whose pages have the same layout, the set of places (tags and
names) of their blocks.

The references, one for each host, are broadcast only if their size, which is measured, allows it;
else they are joined by host.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.llm.scratch import scoped, small, stored

#: A text is template if this share of the different pages with the node have it, and so many at least:
#: of pages whose longest other text differs, or of pages that differ at all, near copies included.
LEAST_PAGES, LEAST_COPIES, SHARE = 3, 12, 0.9
#: A slot outside of articles is a menu if this share of its characters, over all pages, is in links.
LINKED = 0.9
BROADCAST_BYTES = 16 << 20
#: Longer alignments are halved first.
TABLE_CELLS = 250_000

#: Names of HTML elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul caption option optgroup select".split()
)
CLOSES_P = BLOCK - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "option", "optgroup"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
#: Elements, and words of class, id and role, of what is not an article.
OTHER = RAW | set("nav header footer aside form button select input menu dialog head svg canvas object audio video datalist fieldset".split())
OTHER_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs sidebar side aside complementary footer foot header masthead notice notices cookie cookies consent gdpr alert popup modal "
    "overlay comment comments disqus respond reply replies share sharing social related recommended newsletter subscribe subscription "
    "signup login search pagination pager toolbar widget contentinfo dialog".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>\"[^\"]*\"|'[^']*'|[^'\">])*)>|</?[a-zA-Z][^>]*(?:>|\Z)", re.S
)
_NAMED = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


class Node:
    """An element; children are elements and strings, in order."""

    __slots__ = ("tag", "names", "children", "number", "shape", "size", "text", "links")

    def __init__(self, tag: str, names: str = ""):
        self.tag, self.names, self.children, self.number, self.text, self.links = tag, names, [], -1, "", 0


def parse(html: str) -> Node:
    """The tree of a page. The places of open elements are kept by tag, so the time is linear in the page, whatever its depth."""
    root = Node("#")
    stack, at = [root], 0
    open_: dict[str, list[int]] = {}

    def add(text: str) -> None:
        if text:
            stack[-1].children.append(unescape(text) if "&" in text else text)

    def last(tags) -> int:
        return max([open_[t][-1] for t in tags if open_.get(t)], default=0)

    def close(tags, scope=()) -> None:
        """Close the innermost element of ``tags``, unless one of ``scope`` lies inside of it."""
        k = last(tags)
        if k and k >= last(scope):
            for x in stack[k:]:
                open_[x.tag].pop()
            del stack[k:]

    while m := _TOKEN.search(html, at):
        add(html[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_.get(tag):
                close((tag,))
            elif tag == "p":
                stack[-1].children.append(Node("p"))
            continue
        if tag in CLOSES_P:
            close(("p",), ("td", "th", "button", "object", "table"))
        if tag in SIBLINGS:
            close(SIBLINGS[tag], SCOPES[tag])
        names = " ".join(f"{k.lower()}={v.strip(chr(34) + chr(39))}" for k, v in _NAMED.findall(m[3])) if m[3] else ""
        node = Node(tag, names)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in VOID:
            open_.setdefault(tag, []).append(len(stack))
            stack.append(node)
    add(html[at:])
    return root


def prepared(root: Node) -> list[Node]:
    """Number the elements in page order; each gets the digest of its shape, and each block its text,
    that of blocks inside it left out."""
    nodes: list[Node] = []
    stack = [root]
    while stack:
        x = stack.pop()
        x.number = len(nodes)
        nodes.append(x)
        stack += [c for c in reversed(x.children) if isinstance(c, Node)]
    for x in reversed(nodes):
        size, links, parts, shape = 1, 0, [], [x.tag, x.names]
        for c in x.children:
            if c.__class__ is str:
                parts.append(c)
                continue
            size += c.size
            shape.append(c.shape)
            if c.tag in BLOCK:
                parts.append(" ")
            else:
                parts.append(c.text)
                links += len(c.text.strip()) if c.tag == "a" else c.links
        text = "".join(parts)
        x.text = " ".join(text.split()) if x.tag in BLOCK or x is root else text
        x.size, x.links, x.shape = size, links, hash(tuple(shape))
    return nodes


def _aligned(xs: list[Node], ys: list[Node], weight) -> list[tuple[int, int]]:
    """Places of the pairs, in order, whose weights have the greatest sum. Long lists are halved (Hirschberg),
    so memory is bounded."""
    found, parts = [], [(0, len(xs), 0, len(ys))]

    def sums(rows, columns) -> list[int]:
        row = [0] * (len(columns) + 1)
        for c in rows:
            above, row = row, [0]
            for j, d in enumerate(columns):
                row.append(max(above[j + 1], row[j], above[j] + weight(c, d)))
        return row

    while parts:
        lo, hi, left, right = parts.pop()
        if lo == hi or left == right:
            continue
        if hi - lo > 1 and (hi - lo) * (right - left) > TABLE_CELLS:
            mid = (lo + hi) // 2
            first, last = sums(xs[lo:mid], ys[left:right]), sums(xs[lo:hi][: mid - lo - 1 : -1], ys[left:right][::-1])
            cut = max(range(right - left + 1), key=lambda k: first[k] + last[right - left - k])
            parts += [(mid, hi, left + cut, right), (lo, mid, left, left + cut)]
            continue
        table = [[0] * (right - left + 1)]
        for c in xs[lo:hi]:
            above, row = table[-1], [0]
            for j, d in enumerate(ys[left:right]):
                row.append(max(above[j + 1], row[j], above[j] + weight(c, d)))
            table.append(row)
        i, j, pairs = hi - lo, right - left, []
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((lo + i, left + j))
        found += reversed(pairs)
    return found


def matched(a: Node, b: Node) -> dict[int, int]:
    """Simple tree matching: numbers of ``a``'s elements to those of ``b``. Children are aligned in
    order so that most elements match; equal beginnings and ends are aligned at once. What two
    elements have in common depends on their shapes alone and is found once for two shapes."""
    known: dict[tuple[int, int], tuple[int, int, int, list]] = {}

    def weight(x: Node, y: Node) -> int:
        if x.shape == y.shape:
            return x.size
        return known[x.shape, y.shape][0] if x.tag == y.tag and x.names == y.names else 0

    def inner(x: Node) -> list[Node]:
        return [c for c in x.children if isinstance(c, Node)]

    stack = [(a, b)]
    while stack:
        x, y = stack[-1]
        if x.shape == y.shape or (x.shape, y.shape) in known:
            stack.pop()
            continue
        xs, ys = inner(x), inner(y)
        lo = hi = 0
        while lo < min(len(xs), len(ys)) and xs[lo].shape == ys[lo].shape:
            lo += 1
        while hi < min(len(xs), len(ys)) - lo and xs[-1 - hi].shape == ys[-1 - hi].shape:
            hi += 1
        total = 1 + sum(c.size for c in xs[:lo] + xs[len(xs) - hi :])
        xs, ys = xs[lo : len(xs) - hi], ys[lo : len(ys) - hi]
        kinds: dict[tuple[str, str], list[Node]] = {}
        for d in {d.shape: d for d in ys}.values():
            kinds.setdefault((d.tag, d.names), []).append(d)
        open_ = [(c, d) for c in {c.shape: c for c in xs}.values() for d in kinds.get((c.tag, c.names), ()) if c.shape != d.shape and (c.shape, d.shape) not in known]
        if open_:
            stack += open_
            continue
        pairs = _aligned(xs, ys, weight)
        known[x.shape, y.shape] = (total + sum(weight(xs[i], ys[j]) for i, j in pairs), lo, hi, pairs)
        stack.pop()
    found, stack = {}, [(a, b)]
    while stack:
        x, y = stack.pop()
        found[x.number] = y.number
        xs, ys = inner(x), inner(y)
        if x.shape == y.shape:
            stack += zip(xs, ys, strict=True)
            continue
        _, lo, hi, pairs = known[x.shape, y.shape]
        stack += zip(xs[:lo], ys[:lo], strict=True)
        stack += [(xs[lo + i], ys[lo + j]) for i, j in pairs]
        stack += zip(xs[len(xs) - hi :], ys[len(ys) - hi :], strict=True)
    return found


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _tokens(x: Node) -> Iterator[tuple[str, str]]:
    kind = ""
    for part in x.names.split():
        head, is_kind, value = part.partition("=")
        if is_kind and head in ("class", "id", "role", "hidden", "aria-hidden"):
            kind, part = head, value
        yield kind, part.lower()


def _named_other(x: Node, framed: set[int]) -> bool:
    """Whether its role, or on a slot of the wrapper its class or id, names an element as no article."""
    if not x.names or x.tag in ("html", "body", "article", "main"):
        return False
    return any(w in OTHER_WORDS and (kind == "role" or x.number in framed) for kind, w in _tokens(x) if kind in ("class", "id", "role"))


def _hidden(x: Node) -> bool:
    return bool(x.names) and x.tag not in ("html", "body", "article", "main") and bool(re.search(r"(?<![\w-])hidden=(?!\w)|aria-hidden=true", x.names))


def _dropped(nodes: list[Node], template: set[int], framed: set[int]) -> set[int]:
    """Elements that are no article by what they are or are named. A name doesn't count for what holds an
    article or main element, or more than half of the page's text that is neither template nor in elements
    that are no article."""
    gone = {x.number for x in nodes if x.tag in OTHER or _hidden(x)}
    named = [x for x in nodes if x.number not in gone and _named_other(x, framed)]
    if not named:
        return gone
    held, holds = [0] * len(nodes), [False] * len(nodes)
    for x in reversed(nodes):
        if x.number in gone:
            continue
        total, inside = 0, False
        for c in x.children:
            if c.__class__ is str:
                total += 0 if x.number in template else len(c.strip())
            else:
                total += held[c.number]
                inside = inside or holds[c.number] or c.tag in ("article", "main") or "role=main" in c.names.split()
        held[x.number], holds[x.number] = total, inside
    return gone | {x.number for x in named if not holds[x.number] and 2 * held[x.number] <= held[0]}


def article(nodes: list[Node], template: set[int], framed: set[int]) -> str:
    """Text of the article of a page's ``prepared`` elements, without the elements whose numbers are in ``template``: its blocks, in page
    order, joined by an empty line. ``framed`` has the elements that are on slots of the wrapper."""
    root, gone = nodes[0], _dropped(nodes, template, framed)

    def inside(tag: str) -> list[Node]:
        found, stack = [], [root]
        while stack:
            x = stack.pop()
            if x.tag == tag or tag == "main" and "role=main" in x.names.split():
                found.append(x)
            elif x.number not in gone:
                stack += [c for c in reversed(x.children) if isinstance(c, Node)]
        return found

    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            blocks.append(text)

    for top in inside("article") or inside("main") or [root]:
        flush()
        stack: list = [top]
        while stack:
            x = stack.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                line.append(x)
            elif x.number in gone and x is not top:
                if x.tag in BLOCK:
                    flush()
            elif x.tag == "br":
                line.append(" ")
            else:
                own = [c for c in x.children if isinstance(c, Node) and c.tag in BLOCK] if x.number in template else x.children
                if x.tag in BLOCK:
                    flush()
                    stack.append(None)
                stack += reversed(own)
    flush()
    return "\n\n".join(blocks)


@lru_cache(maxsize=1 << 16)
def _step(above: int, tag: str, names: str, nth: int) -> int:
    return _digest(f"{above} {nth} {tag} {names}")


def paths(nodes: list[Node]) -> list[int]:
    """A digest of each element's place: the elements from the root to it, each with its number among
    those of its name beside it. ``nodes`` are in page order."""
    found = [0] * len(nodes)
    for x in nodes:
        nth: Counter = Counter()
        for c in x.children:
            if isinstance(c, Node):
                nth[c.tag, c.names] += 1
                found[c.number] = _step(found[x.number], c.tag, c.names, nth[c.tag, c.names])
    return found


def _slot(x: Node) -> bool:
    return bool(x.text) and x.tag in BLOCK


def pruned(root: Node, known: set[int]) -> Node:
    """``root``'s elements without the blocks, and all inside, that hold text but no slot of ``known``."""
    nodes = prepared(root)
    at = paths(nodes)
    kept, bearing = [False] * len(nodes), [False] * len(nodes)
    for x in reversed(nodes):
        inner = [c.number for c in x.children if isinstance(c, Node)]
        kept[x.number] = _slot(x) and at[x.number] in known or any(kept[k] for k in inner)
        bearing[x.number] = _slot(x) or any(bearing[k] for k in inner)
    for x in nodes:
        x.children = [c for c in x.children if isinstance(c, Node) and (kept[c.number] or not bearing[c.number])]
    return root


def merged(tree: Node, other: Node) -> None:
    """What ``tree`` lacks of ``other`` is put into it, after what it follows there."""
    nodes = prepared(tree)
    theirs = prepared(other)
    pairs = {i: nodes[j] for i, j in matched(other, tree).items()}
    for x in theirs:
        if x.number not in pairs:
            continue
        own, last = pairs[x.number], None
        for c in x.children:
            if c.number in pairs:
                last = pairs[c.number]
                continue
            k = next((k for k, d in enumerate(own.children) if d is last), -1) + 1
            own.children.insert(k, c)
            last = c


def dumped(root: Node) -> str:
    rows, stack = [], [(root, 0)]
    while stack:
        x, depth = stack.pop()
        rows.append((depth, x.tag, x.names))
        stack += [(c, depth + 1) for c in reversed(x.children) if isinstance(c, Node)]
    return json.dumps(rows, separators=(",", ":"))


def loaded(tree: str) -> Node:
    """The inverse of ``dumped``, prepared."""
    chain: list[Node] = []
    for depth, tag, names in json.loads(tree):
        del chain[depth:]
        x = Node(tag, names)
        if chain:
            chain[-1].children.append(x)
        chain.append(x)
    prepared(chain[0])
    return chain[0]


class _References:
    """References; a task keeps few at a time."""

    def __init__(self):
        self.known: dict[str, Node] = {}

    def __call__(self, tree: str) -> Node:
        root = self.known.get(tree)
        if root is None:
            if len(self.known) > 64:
                self.known.clear()
            root = self.known[tree] = loaded(tree)
        return root


def _batch(rows: list[tuple], **types: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))


def _page(nodes: list[Node]) -> int:
    return _digest("\n".join(x.text for x in nodes))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, path, page, size, key): the places of a page's blocks of text, their number, and
    digests of the page's texts and of its html."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            rows = []
            part = batch.slice(lo, 256)
            for host, html, key in zip(part["host"].to_pylist(), part["html"].to_pylist(), part["key"].to_pylist(), strict=True):
                nodes = prepared(parse(html))
                at = paths(nodes)
                own = [at[x.number] for x in nodes if _slot(x)]
                page = _page(nodes) if own else 0
                rows += [(host, k, page, len(own), key) for k in own]
            yield _batch(rows, host=pa.string(), path=pa.int64(), page=pa.int64(), size=pa.int32(), key=pa.int64())


def layout(nodes: list[Node]) -> int:
    """Digest of the set of places of blocks of text, whatever their number."""
    at, seen = [0] * len(nodes), set()
    for x in nodes:
        if _slot(x):
            seen.add(at[x.number])
        for c in x.children:
            if isinstance(c, Node):
                at[c.number] = _step(at[x.number], c.tag, c.names, 0)
    return _digest(str(sorted(seen)))


def _pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the layout for the host; no host has a space."""
    for batch in batches:
        hosts = [f"layout {layout(prepared(parse(x.as_py())))}" for x in batch["html"]]
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(hosts, pa.string()), batch["html"]], names=["page_id", "url", "host", "html"])


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for host, html, known in zip(batch["host"], batch["html"], batch["paths"], strict=True):
            tree = pruned(parse(html.as_py()), set(known.as_py()))
            size = len(prepared(tree))
            yield _batch([(host.as_py(), -size, dumped(tree))], host=pa.string(), size=pa.int32(), tree=pa.string())


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for host, trees in zip(batch["host"], batch["trees"], strict=True):
            first, *others = dict.fromkeys(t["tree"] for t in trees.as_py())
            root = loaded(first)
            for other in others:
                merged(root, loaded(other))
            yield _batch([(host.as_py(), dumped(root))], host=pa.string(), reference=pa.string())


def _articles(nodes: list[Node]) -> list[tuple[int, int]]:
    """Ranges of the numbers of elements in article and main elements, these included."""
    return [(x.number, x.number + x.size) for x in nodes if x.tag in ("article", "main") or "role=main" in x.names.split()]


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, node, text, page, other, chars, links): the texts at the nodes of the reference, a digest of the
    page, one of its longest text besides, and the characters of the text, in all and in links. Slots of articles
    count as such without links."""
    reference = _References()
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            rows = []
            part = batch.slice(lo, 256)
            for host, html, other in zip(part["host"].to_pylist(), part["html"].to_pylist(), part["reference"].to_pylist(), strict=True):
                root = parse(html)
                nodes = prepared(root)
                page = _page(nodes)
                texts = sorted({x.text for x in nodes if _slot(x)}, key=lambda x: (-len(x), x))[:2]
                longest = [(x, _digest(x)) for x in texts] + [("", 0)]
                own = _articles(nodes)
                for i, j in matched(root, reference(other)).items():
                    if _slot(nodes[i]):
                        text = nodes[i].text
                        links = 0 if any(lo <= i < hi for lo, hi in own) else nodes[i].links
                        rows.append((host, j, _digest(text), page, longest[text == longest[0][0]][1], len(text), links))
            yield _batch(rows, host=pa.string(), node=pa.int32(), text=pa.int64(), page=pa.int64(), other=pa.int64(), chars=pa.int64(), links=pa.int64())


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reference = _References()
    for batch in batches:
        texts, left_out = [], []
        for html, other, template, menus in zip(batch["html"], batch["reference"], batch["template"], batch["menus"], strict=True):
            root = parse(html.as_py())
            nodes, constant = prepared(root), set()
            pairs = matched(root, reference(other.as_py())) if other.is_valid else {}
            own = _articles(nodes)
            # What an article holds is article, constant or not.
            free = [(i, j) for i, j in pairs.items() if nodes[i].tag in BLOCK and not any(lo <= i < hi for lo, hi in own)]
            if known := {(t["node"], t["text"]) for t in template.as_py() or ()}:
                constant = {i for i, j in free if (j, _digest(nodes[i].text)) in known}
            if linked := set(menus.as_py() or ()):
                constant |= {i for i, j in free if j in linked and _slot(nodes[i])}
            texts.append(article(nodes, constant, pairs.keys()))
            left_out.append(len(constant))
        columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(left_out, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_template"])


def _joined(pages: DataFrame, by_host: DataFrame, size: int, how: str = "inner") -> DataFrame:
    return pages.join(F.broadcast(by_host) if size <= BROADCAST_BYTES else by_host, "host", how)


def references(pages: DataFrame) -> DataFrame:
    """host, reference (a tree as ``dumped`` gives it) of the hosts of ``pages`` (host, html) that have
    slots in so many different pages that they can be template."""
    keyed = pages.select("host", "html", F.xxhash64("html").alias("key"))
    places = keyed.mapInArrow(_places, "host string, path long, page long, size int, key long")
    by_page = places.groupBy("host", "path", "page").agg(F.max(F.struct("size", "key")).alias("x"))
    # For each slot, the page with most blocks of those that have it: few pages are chosen for many slots.
    slots = by_page.groupBy("host", "path").agg(F.count("*").alias("n"), F.max(F.struct("x.size", "x.key")).alias("x"))
    slots = stored(slots.where(F.col("n") >= LEAST_PAGES).select("host", "path", "x.key"), "slots")
    chosen = stored(slots.select("host", "key").distinct(), "chosen")
    chosen = keyed.join(small(chosen), ["host", "key"]).groupBy("host", "key").agg(F.min("html").alias("html"))
    known = slots.groupBy("host").agg(F.collect_list("path").alias("paths"))
    trees = chosen.join(known, "host").select("host", "html", "paths").mapInArrow(_pruned, "host string, size int, tree string")
    trees = trees.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("size", "tree"))).alias("trees"))
    return stored(trees.mapInArrow(_merged, "host string, reference string"), "references")


def wrappers(pages: DataFrame) -> DataFrame:
    """host, reference, template (array of node and text, a digest), menus (array of nodes) of every host of
    ``pages`` (host, html) that has a reference."""
    trees = references(pages)
    size = trees.agg(F.sum(F.octet_length("reference"))).first()[0] or 0
    seen = _joined(pages.select("host", "html"), trees, size).mapInArrow(_observed, "host string, node int, text long, page long, other long, chars long, links long")
    sums = [F.sum(c).alias(c) for c in ("chars", "links")]
    counts = seen.groupBy("host", "node", "text").agg(F.count_distinct("page").alias("n"), F.count_distinct("other").alias("apart"), *sums)
    shares = counts.groupBy("host", "node").agg(F.sum("n").alias("all"), F.max(F.struct("n", "text", "apart")).alias("most"), *sums)
    shares = stored(shares, "shares")
    menus = shares.where((F.col("all") >= LEAST_PAGES) & (F.col("links") >= LINKED * F.col("chars")))
    menus = menus.groupBy("host").agg(F.collect_list("node").alias("menus"))
    template = shares.where(((F.col("most.apart") >= LEAST_PAGES) | (F.col("most.n") >= LEAST_COPIES)) & (F.col("most.n") >= SHARE * F.col("all")))
    template = template.groupBy("host").agg(F.collect_list(F.struct("node", F.col("most.text").alias("text"))).alias("template"))
    return stored(trees.join(template, "host", "left").join(menus, "host", "left"), "wrappers")


@scoped
def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points), n_template of every row of ``pages``. n_template counts the
    blocks that the wrapper takes for template or menus; 0 also tells a page without a wrapper, where markup alone decides.

    ``pages`` needs page_id, url and html; other columns are not read. The host is that of the url, in
    lower case; pages of urls that are null or have no host are taken together. Blocks are the texts
    between the borders of block elements, character references decoded, each run of white space
    one space, trimmed; empty ones are left out. Without an article or main element the whole body
    counts. Null, empty and broken html gives what text there is, or an empty one. Repeated rows are
    given each.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    few = rows.groupBy("host").agg(F.count_distinct(F.xxhash64("html")).alias("n")).where(F.col("n") < LEAST_PAGES).select("host")
    few = small(stored(few, "few"))
    pooled = rows.join(few, "host", "left_semi").select("page_id", "url", "host", "html").mapInArrow(_pooled, "page_id long, url string, host string, html string")
    rows = rows.join(few, "host", "left_anti").select("page_id", "url", "host", "html").unionByName(pooled)
    known = wrappers(rows)
    size = known.agg(F.sum(F.octet_length("reference") + 16 * F.greatest(F.size("template"), F.lit(0)) + 8 * F.greatest(F.size("menus"), F.lit(0)))).first()[0] or 0
    found = _joined(rows, known, size, "left").mapInArrow(_extracted, "page_id long, url string, text string, n_template int")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_template")
