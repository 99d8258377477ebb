"""Main text of web pages by wrapper induction.

Pages are read into trees of block elements. Pages of one host and layout (the set of its containers' tags and classes) share a wrapper. Its
tree comes from all of them: their different trees are aligned one after the other by simple tree matching, and those that the wrapper
holds already are passed over: two trees match if their roots do, plus the best order-preserving matching of their children. Elements whose path of keys from the root is on fewer
than ``LEAST_PAGES`` different pages can't hold a template's text and don't enter the tree; their text varies, as part of the element around them. Then every
page is aligned with the wrapper, and the texts at each node are counted over all pages: a text that stands there on nearly all pages, beside other
texts that differ, is template; whatever else stands there is content. So copies of one article don't make a template of it: their other blocks are
the same.

The article is the part of the wrapper with most of the varying text: from the root down to the child that has more than half of it, until the rest is
runs of text blocks. Headings beside it that vary belong to it. A page's text is what it has there without the template's texts. Tags, roles and
class names decide only where alignment can't: varying parts inside the article that are no main text (forms, adverts, reader comments ..), and
pages without a wrapper or that don't fit it.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Callable, Hashable, Iterable, Iterator
from difflib import SequenceMatcher
from itertools import groupby
from operator import itemgetter

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stash

#: Different pages of a layout that it takes for a wrapper, for an element in it, and for a template's text
LEAST_PAGES = 3
#: Share of the different pages at a node that a template's text stands on
CONSTANT = 0.95
#: Longest other blocks of a page by which it is told from copies; a template's text stands beside different ones in all ranks but one
OTHERS = 3
#: Elements nested deeper belong to the one around them
DEPTH = 200
#: Pairs of siblings that are matched by their trees; more are aligned by their keys
SIBLINGS = 250_000
#: Wrappers of at most so many bytes in all are broadcast
BROADCAST_BYTES = 16_000_000
SALTS = 16
#: JSON of wrappers that a Python worker holds read, at most; their nodes take about 25 times as much
KNOWN_BYTES = 8_000_000
#: Trees of one group's pages that its wrapper takes in a round, before those that it holds by then are left out. What so many rounds leave is
#: taken in parts, each from the wrapper so far, and then the parts: no page's tree is passed over that the wrapper doesn't hold
BUNCH, ROUNDS, PARTS = 1000, 4, 64

# Fixed values
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter q rp rt ruby s samp small span strike strong sub sup time tt u var wbr picture source".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = set("nav footer aside form button menu dialog head".split())
#: An open element of the second kind ends where one of the first kind starts
ENDS = {t: {"p"} for t in "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()}
ENDS |= {"li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "td", "th", "tr"}, "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "option": {"option"}, "body": {"head"}}
#: Elements whose bounds an implied end doesn't cross
SCOPE = set("html body article main section div ul ol dl table td th aside nav footer header form blockquote".split())
MARKERS = set(
    "ad ads adv advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer discussion disqus footer "
    "header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted recommended related replies reply "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Marks that don't count in a class name with a word of CONTENT, and not for what holds a heading
WEAK = set("alert banner disclaimer header notice notices related search share sharing".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CONTENT = set("article content entry main post story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|select|object|math)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s>/]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Node:
    """An element: tag, marks (tokens of class, id and role), and its items, blocks of text and elements, in order."""

    __slots__ = ("items", "key", "marked", "marks", "roles", "tag")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.items, self.marks, self.roles, self.marked = tag, [], frozenset(), frozenset(), False
        if attributes and "=" in attributes:
            found = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in _ATTRIBUTE.finditer(attributes)]
            names = [[t for t in _SPLIT.split(name) if t] for kind, v in found if kind != "role" for name in v.split()]
            self.marks = frozenset(t for name in names for t in name)
            self.marked = any(t in MARKERS and not (t in WEAK and CONTENT.intersection(name)) for name in names for t in name)
            self.roles = frozenset(v.strip() for name, v in found if name == "role")
        self.key = tag + "." + " ".join(sorted(t for t in self.marks if not t.isdigit())) if self.marks else tag

    def boilerplate(self) -> bool:
        """By its name no main text, whatever it holds."""
        if self.tag in ("html", "body"):
            return False
        if self.tag in DROPPED or self.roles & ROLES:
            return True
        return self.marked and not (self.marks & MARKERS <= WEAK and any(not isinstance(x, str) and x.tag in _HEADINGS for x in self.items))


def parse(text: str | None) -> Node:
    """The tree of a page; inline elements are not nodes, their text belongs to the block around them."""
    root = Node("#root")
    stack, held = [(root, root.tag)], []  # the node that text goes to, and the open element's own tag
    text = text or ""

    def flush() -> None:
        if held:
            block = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if block:
                stack[-1][0].items.append(block)

    at = 0
    for m in _TOKEN.finditer(text):
        if m.start() > at:
            held.append(text[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                held.append(" ")
            continue
        flush()
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] == tag:
                    del stack[k:]
                    break
            continue
        ends = ENDS.get(tag)
        if ends:
            k = len(stack) - 1
            while k > 0:
                if stack[k][1] in ends:
                    del stack[k:]
                elif stack[k][1] in SCOPE:
                    break
                k -= 1
        node = stack[-1][0]
        if len(stack) <= DEPTH:
            node = Node(tag, m["attributes"])
            stack[-1][0].items.append(node)
        if tag not in VOID and not m["attributes"].endswith("/"):
            stack.append((node, tag))
    rest = text[at:]
    cut = re.search(r"<[a-zA-Z/!?][^<>]*\Z", rest)  # a tag that the page's end cuts off
    held.append(rest[: cut.start()] if cut else rest)
    flush()
    return root


class Slot:
    """A node of a wrapper, or of a page to be aligned: neighbours with one key and no elements inside are one slot."""

    __slots__ = ("children", "key", "nodes", "number")

    def __init__(self, key: str, children: list[Slot], nodes: list[Node] | None = None):
        self.key, self.children, self.nodes, self.number = key, children, nodes or [], -1

    @staticmethod
    def of(node: Node) -> Slot:
        slot = Slot(node.key, [], [node])
        for x in node.items:
            if isinstance(x, str):
                continue
            child = Slot.of(x)
            last = slot.children[-1] if slot.children else None
            if last is not None and last.key == child.key and not last.children and not child.children:
                last.nodes += child.nodes
            else:
                slot.children.append(child)
        return slot

    def dump(self) -> list:
        """[key, children]"""
        return [self.key, [c.dump() for c in self.children]]

    @staticmethod
    def build(data: list) -> Slot:
        return Slot(data[0], [Slot.build(c) for c in data[1]])

    @staticmethod
    def load(data: list) -> Slot:
        """With numbers in document order."""
        slot = Slot.build(data)
        for k, x in enumerate(slot.all()):
            x.number = k
        return slot

    def all(self) -> Iterator[Slot]:
        ahead = [self]
        while ahead:
            x = ahead.pop()
            yield x
            ahead += reversed(x.children)


def match(a: Slot, b: Slot) -> tuple[int, list[tuple[Slot, Slot]]]:
    """Simple tree matching: (size, matched pairs)."""
    if a.key != b.key:
        return 0, []
    if not a.children or not b.children:
        return 1, [(a, b)]
    keys = {c.key for c in b.children}
    left, right = [c for c in a.children if c.key in keys], b.children  # a wrapper has many that one page has no partner for
    m, n = len(left), len(right)
    if m * n > SIBLINGS:
        runs = SequenceMatcher(None, [c.key for c in left], [c.key for c in right], autojunk=False).get_matching_blocks()
        inner = [match(left[r.a + k], right[r.b + k]) for r in runs for k in range(r.size)]
        return 1 + sum(size for size, _ in inner), [(a, b), *(p for _, pairs in inner for p in pairs)]
    inner = {}
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            w = 0
            if left[i - 1].key == right[j - 1].key:
                inner[i, j] = match(left[i - 1], right[j - 1])
                w = inner[i, j][0]
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + w)
    pairs, i, j = [(a, b)], m, n
    while i and j:
        if (i, j) in inner and best[i][j] == best[i - 1][j - 1] + inner[i, j][0] and inner[i, j][0]:
            pairs += inner[i, j][1]
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[m][n] + 1, pairs


def strays(pairs: list[tuple[Slot, Slot]]) -> list[tuple[Slot, Slot]]:
    """(the wrapper's node, the page's) of the page's nodes without a partner whose parents have that one."""
    partnered = {id(b) for _, b in pairs}
    return [(a, c) for a, b in pairs for c in b.children if id(c) not in partnered]


def absorb(wrapper: Slot, page: Slot) -> None:
    """Align a page, or another wrapper, with the wrapper: what has no partner is added where it stands."""
    _, pairs = match(wrapper, page)
    partner = {id(b): a for a, b in pairs}
    for a, b in pairs:
        merged, at = [], 0
        for child in b.children:
            same = partner.get(id(child))
            if same is None:
                merged.append(child)
                continue
            while a.children[at] is not same:
                merged.append(a.children[at])
                at += 1
            merged.append(same)
            at += 1
        a.children = merged + a.children[at:]


def shape(page: str | None) -> str:
    """A page's tree without its texts, as JSON."""
    return _json(Slot.of(parse(page)))


def _json(slot: Slot) -> str:
    return json.dumps(slot.dump(), ensure_ascii=False, separators=(",", ":"))


def paths(shape: str) -> set[int]:
    """Hashes of the keys from the root down to each node."""
    found, ahead = set(), [("", json.loads(shape))]
    while ahead:
        above, (key, children) = ahead.pop()
        path = _hash(f"{above} {key}")
        found.add(path)
        ahead += [(path, c) for c in children]
    return found


def pruned(shape: str, kept: frozenset[int]) -> str | None:
    """The tree without the nodes whose paths are not kept; None if the root's isn't."""

    def cut(above, node: list) -> list | None:
        path = _hash(f"{above} {node[0]}")
        if path not in kept:
            return None
        return [node[0], [c for c in (cut(path, x) for x in node[1]) if c is not None]]

    found = cut("", json.loads(shape))
    return None if found is None else json.dumps(found, ensure_ascii=False, separators=(",", ":"))


def skeleton(pages: list[str]) -> str | None:
    """The wrapper's tree of a few pages as JSON, or None if too few of them differ; wrappers() makes it of many."""
    shapes = [shape(p) for p in dict.fromkeys(pages)]
    if len(shapes) < LEAST_PAGES:
        return None
    on = Counter(p for x in shapes for p in paths(x))
    kept = frozenset(p for p, n in on.items() if n >= LEAST_PAGES)
    return merged((0, x) for x in sorted({pruned(x, kept) for x in shapes}))[0]


def merged(trees: Iterable[tuple[int, str]]) -> tuple[str, int]:
    """The trees in one, and the rank of the last: each comes with its rank."""
    trees = iter(trees)
    last, first = next(trees)
    wrapper = Slot.build(json.loads(first))
    for rank, tree in trees:
        absorb(wrapper, Slot.build(json.loads(tree)))
        last = rank
    return _json(wrapper), last


def holds(wrapper: Slot, tree: str) -> bool:
    """Every node of the tree has a partner in the wrapper, so that absorbing it would change nothing."""
    page = Slot.build(json.loads(tree))
    return match(wrapper, page)[0] == sum(1 for _ in page.all())


def _hash(text: str) -> int:
    return int.from_bytes(xxhash.xxh64_digest(text.encode("utf-8", "surrogatepass")), "big", signed=True)


def sightings(page: str | None, wrapper: Slot) -> list[tuple]:
    """(slot, text, characters, named, first, others ..) of each different block at the wrapper's nodes.

    Texts are hashes; named: it lies in boilerplate by name; first: no block of this node came before; others: the page's longest blocks but this one.
    What stands in elements that the wrapper doesn't have is one row for each of its nodes around them: slot -1 - its number, with their characters.
    """
    root = parse(page)
    inside, ahead = set(), [(root, False)]
    while ahead:
        node, named = ahead.pop()
        named = named or node.boilerplate()
        if named:
            inside.add(id(node))
        ahead += [(x, named) for x in node.items if not isinstance(x, str)]
    found = []
    pairs = match(wrapper, Slot.of(root))[1]
    for a, b in pairs:
        texts = {x: id(node) in inside for node in b.nodes for x in node.items if isinstance(x, str)}
        found += [(a.number, t, named, k == 0) for k, (t, named) in enumerate(texts.items())]
    longest = sorted({t for _, t, _, _ in found}, key=lambda t: (-len(t), t))[: OTHERS + 1]
    number = {t: _hash(t) >> 32 for t in longest}
    out = []
    for slot, t, named, first in found:
        others = [number[x] for x in longest if x != t][:OTHERS]
        out.append((slot, _hash(t), len(t), named, first, *others, *[0] * (OTHERS - len(others))))
    loose = Counter()
    for a, c in strays(pairs):
        loose[a.number] += sum(len(t) for x in c.all() for node in x.nodes if id(node) not in inside for t in node.items if isinstance(t, str))
    return out + [(-1 - slot, 0, chars, False, False, *[0] * OTHERS) for slot, chars in loose.items() if chars]


class Wrapper:
    """A wrapper's tree with its template texts and the node of its article."""

    def __init__(self, tree: str, fixed: list[tuple[int, int]], masses: list[tuple[int, int]]):
        self.root = Slot.load(json.loads(tree))
        self.fixed: dict[int, set[int]] = {}
        for slot, text in fixed:
            self.fixed.setdefault(slot, set()).add(text)
        slots = list(self.root.all())
        own = dict(masses)
        loose = {k for k in range(len(slots)) if own.get(-1 - k)}
        whole = [own.get(k, 0) + own.get(-1 - k, 0) for k in range(len(slots))]
        for slot in reversed(slots):
            whole[slot.number] += sum(whole[c.number] for c in slot.children)
        #: The article's node, then those of the same path by falling mass: a page without the first has its article there if that is most of its text
        self.articles: list[int] = []
        #: Headings that belong to the article, and nodes whose headings do that the wrapper doesn't have, by number
        self.headings, self.around = set(), set()
        if whole and whole[0]:
            at, beside, above = self.root, [], []
            while True:
                heavy = max(at.children, key=lambda c: whole[c.number], default=None)
                if heavy is None or 2 * whole[heavy.number] <= whole[at.number] or not (heavy.number in loose or any(whole[c.number] for c in heavy.children)):
                    break
                beside += [c for c in at.children if c is not heavy]
                above.append(at)
                at = heavy
            level = [self.root]
            for x in [*above, at][1:]:
                level = [c for y in level for c in y.children if c.key == x.key]
            self.articles = [at.number, *sorted((x.number for x in level if x is not at and whole[x.number]), key=lambda k: -whole[k])]
            beside = [c for c in beside if not _site_header(c.key)]
            self.headings = {x.number for c in beside for x in [c, *c.children] if x.key.partition(".")[0] in _HEADINGS and own.get(x.number)}
            self.around = {x.number for x in [*above, *beside]}


def _site_header(key: str) -> bool:
    tag, _, marks = key.partition(".")
    return tag == "header" or "header" in marks.split() and not CONTENT.intersection(marks.split())


def _blocks(node: Node, template: dict[int, set[int]], wanted: set[int] | None = None) -> list[str]:
    """Texts in page order without those of the template and what boilerplate by name holds; wanted: only what lies in these nodes."""
    out: list[str] = []
    ahead = [(iter(node.items), template.get(id(node), ()), wanted is None or id(node) in wanted)]
    while ahead:
        items, fixed, inside = ahead[-1]
        x = next(items, None)
        if x is None:
            ahead.pop()
        elif isinstance(x, str):
            if inside and not (fixed and _hash(x) in fixed):
                out.append(x)
        elif not x.boilerplate() or wanted is not None and id(x) in wanted:
            ahead.append((iter(x.items), template.get(id(x), ()), inside or wanted is not None and id(x) in wanted))
    return out


def _length(blocks: list[str]) -> int:
    return sum(map(len, blocks))


def _articles(node: Node, wanted) -> list[Node]:
    """The outermost nodes that are wanted, outside of boilerplate and headers."""
    out, ahead = [], [node]
    while ahead:
        x = ahead.pop()
        if wanted(x):
            out.append(x)
        else:
            ahead += [y for y in reversed(x.items) if not isinstance(y, str) and not (y.boilerplate() or y.tag == "header")]
    return out


def main_text(page: str | None, wrapper: Wrapper | None = None) -> str:
    root = parse(page)
    template: dict[int, set[int]] = {}
    if wrapper is not None:
        pairs = match(wrapper.root, Slot.of(root))[1]
        at: dict[int, set[int]] = {}
        for a, b in pairs:
            at.setdefault(a.number, set()).update(id(node) for node in b.nodes)
            for node in b.nodes:
                if a.number in wrapper.fixed:
                    template[id(node)] = wrapper.fixed[a.number]
        article = next((k for k in wrapper.articles if k in at), None)
        if article is not None and (article == wrapper.articles[0] or 2 * _length(_blocks(root, template, at[article])) > _length(_blocks(root, template))):
            beside = set().union(*(at[k] for k in wrapper.headings if k in at))
            for a, c in strays(pairs):
                if a.number in wrapper.around and not _site_header(c.key):
                    beside |= {id(n) for x in [c, *c.children] for n in x.nodes if n.tag in _HEADINGS and not n.boilerplate()}
            return "\n".join(_blocks(root, template, at[article] | beside))
    # no wrapper, or a page that it doesn't fit: names decide
    for wanted in (lambda n: n.tag == "article", lambda n: n.tag == "main" or "main" in n.roles, lambda n: n.tag in ("div", "section", "td") and bool(n.marks & CONTENT)):
        regions = _articles(root, wanted)
        if regions:
            return "\n".join(x for r in regions for x in _blocks(r, template))
    body = _articles(root, lambda n: n.tag == "body") or [root]
    shell = Node("#body")
    shell.items = [x for node in body for x in node.items if isinstance(x, str) or x.tag != "header"]
    for node in body:
        if id(node) in template:
            template[id(shell)] = template.get(id(shell), set()) | template[id(node)]
    return "\n".join(_blocks(shell, template))


class Known:
    """What a Python worker has read of its groups' wrappers; read anew where they have more than KNOWN_BYTES in all."""

    def __init__(self, read: Callable):
        self.read, self.held, self.size = read, {}, 0

    def get(self, key: Hashable, *sources):
        found = self.held.get(key)
        if found is None:
            size = sum(x.nbytes if hasattr(x, "nbytes") else len(x) for x in sources)
            if self.size + size > KNOWN_BYTES:
                self.held.clear()
                self.size = 0
            found = self.held[key] = self.read(*sources)
            self.size += size
        return found


def _grouped(pages: DataFrame, url_col: str, html_col: str, *more: str) -> DataFrame:
    """Columns _0.. for those asked for, url, html, and the group: host, and layout (the containers' tags and classes without numbers)."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    containers = F.regexp_extract_all(F.lower(html_col), F.lit(r"<(?:article|aside|div|footer|form|header|main|nav|section|table)\b(?:[^>]*?\sclass\s*=\s*[\"'][^\"'>]*)?"), F.lit(0))
    layout = F.xxhash64(F.array_sort(F.array_distinct(F.transform(containers, lambda x: F.regexp_replace(x, r"[0-9]+|\s.*?class\s*=\s*[\"']", " ")))))
    return pages.select(*[F.col(c).alias(f"_{k}") for k, c in enumerate(more)], host.alias("host"), F.coalesce(layout, F.lit(0)).alias("layout"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))


def _with_wrappers(rows: DataFrame, found: DataFrame, size: int, how: str, dealt_by: str = "html") -> DataFrame:
    """rows joined with their groups' wrappers: broadcast where those are small, else shuffled with the groups' pages dealt over several tasks."""
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(found), ["host", "layout"], how)
    salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(dealt_by), F.lit(SALTS)).cast("int")).join(salted, ["host", "layout", "salt"], how).drop("salt")


def _grown(trees: DataFrame, more: DataFrame) -> DataFrame:
    """(host, layout, part, tree, last): the tree of each group's part with those of more, by rank, and the last rank."""
    both = trees.select("host", "layout", "part", F.lit(False).alias("more"), F.lit(0).cast("long").alias("rank"), "tree")
    both = both.unionByName(more.select("host", "layout", "part", F.lit(True).alias("more"), "rank", "tree"))

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for row in zip(*[batch[c].tolist() for c in ("host", "layout", "part", "rank", "tree")], strict=True))
        for (host, layout, part), group in groupby(rows, key=itemgetter(0, 1, 2)):
            tree, last = merged(row[3:] for row in group)
            yield pd.DataFrame({"host": [host], "layout": [layout], "part": [part], "tree": [tree], "last": [last]})

    dealt = both.repartition("host", "layout", "part").sortWithinPartitions("host", "layout", "part", "more", "rank", "tree")
    return dealt.mapInPandas(grow, "host string, layout long, part int, tree string, last long")


def _all_merged(rest: DataFrame) -> DataFrame:
    """(host, layout, tree) of groups; rest: (host, layout, rank, tree), different trees with a hash as rank."""

    def lacking(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Known(lambda wrapper: Slot.build(json.loads(wrapper)))
        for batch in batches:
            keep = []
            for host, layout, tree, wrapper in zip(*[batch[c].tolist() for c in ("host", "layout", "tree", "wrapper")], strict=True):
                keep.append(not holds(known.get((host, layout), wrapper), tree))
            yield batch.loc[keep, ["host", "layout", "rank", "tree"]]

    tasks = int(rest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Spark limits each task's rows by group before the shuffle; equal ranks are taken together
    first = Window.partitionBy("host", "layout").orderBy("rank")
    trees = rest.limit(0).withColumn("part", F.lit(0))
    for _ in range(ROUNDS):
        taken = rest.withColumn("n", F.rank().over(first)).where(F.col("n") <= BUNCH).withColumn("part", F.lit(0))
        trees = stash(_grown(trees, taken), "trees")
        size = trees.agg(F.sum(F.octet_length("tree") + F.octet_length("host"))).first()[0] or 0
        if _with_wrappers(rest, trees.select("host", "layout", "last"), size, "inner", "tree").where("rank > last").isEmpty():
            return trees
        # trees are small beside the work on them: dealt by number, where Spark would make few tasks by their bytes
        ahead = _with_wrappers(rest.repartition(tasks, "rank"), trees.select("host", "layout", F.col("tree").alias("wrapper"), "last"), size, "inner", "tree").where("rank > last")
        rest = stash(ahead.select("host", "layout", "rank", "tree", "wrapper").mapInPandas(lacking, rest.schema), "shapes")
        if rest.isEmpty():
            return trees
    parts = rest.withColumn("part", F.pmod("rank", F.lit(PARTS)).cast("int"))
    bases = parts.select("host", "layout", "part").distinct().join(trees.drop("part"), ["host", "layout"])
    return _grown(trees, _grown(bases, parts).select("host", "layout", F.lit(0).alias("part"), F.col("part").cast("long").alias("rank"), "tree"))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, layout, tree, fixed, masses) of groups that have a wrapper."""
    rows = _grouped(pages, url_col, html_col).where("host <> '' and html is not null")

    def outline(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["host", "layout", "rank"]].assign(shape=[shape(p) for p in batch["html"].tolist()])

    outlines = rows.withColumn("rank", F.xxhash64("html")).select("host", "layout", "rank", "html").mapInPandas(outline, "host string, layout long, rank long, shape string")
    shapes = stash(outlines.distinct().groupBy("host", "layout", "shape").agg(F.count(F.lit(1)).alias("n")), "shapes")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            on = Counter()
            for host, layout, tree, n in zip(*[batch[c].tolist() for c in ("host", "layout", "shape", "n")], strict=True):
                for path in paths(tree):
                    on[host, layout, path] += n
            yield pd.DataFrame([(*k, n) for k, n in on.items()], columns=["host", "layout", "path", "n"])

    on = shapes.mapInPandas(walk, "host string, layout long, path long, n long").groupBy("host", "layout", "path").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_PAGES)
    kept = stash(on.groupBy("host", "layout").agg(F.collect_list("path").alias("kept")), "paths")
    size = kept.agg(F.sum(8 * F.size("kept") + F.octet_length("host"))).first()[0] or 0

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Known(lambda kept: frozenset(kept.tolist()))
        for batch in batches:
            trees = []
            for host, layout, tree, kept in zip(*[batch[c].tolist() for c in ("host", "layout", "shape", "kept")], strict=True):
                trees.append(pruned(tree, known.get((host, layout), kept)))
            yield batch[["host", "layout"]].assign(tree=trees)

    cut_trees = _with_wrappers(shapes, kept, size, "inner", "shape").select("host", "layout", "shape", "kept").mapInPandas(cut, "host string, layout long, tree string").distinct()
    trees = _all_merged(stash(cut_trees.withColumn("rank", F.xxhash64("tree")), "shapes"))
    trees = stash(trees.select("host", "layout", "tree", F.monotonically_increasing_id().alias("g")), "trees")
    size = trees.agg(F.sum(F.octet_length("tree") + F.octet_length("host"))).first()[0] or 0
    joined = _with_wrappers(rows, trees, size, "inner").select("g", "tree", "html")

    def see(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Known(lambda tree: Slot.load(json.loads(tree)))
        for batch in batches:
            out = []
            for g, tree, page in zip(batch["g"].tolist(), batch["tree"].tolist(), batch["html"].tolist(), strict=True):
                out += [(g, *s) for s in sightings(page, known.get(g, tree))]
            yield pd.DataFrame(out, columns=["g", "slot", "text", "chars", "named", "first", *others])

    others = [f"other_{k}" for k in range(OTHERS)]
    seen = stash(joined.mapInPandas(see, "g long, slot int, text long, chars int, named boolean, first boolean, " + ", ".join(f"{o} int" for o in others)), "sightings")
    texts = stash(seen.groupBy("g", "slot", "text").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(~F.col("named"), F.col("chars"))).alias("chars"), F.count_if("first").alias("firsts")), "texts")
    slots = texts.groupBy("g", "slot").agg(F.sum("firsts").alias("pages"), F.coalesce(F.sum("chars"), F.lit(0)).alias("mass"))
    # texts that differ from page to page, most of them, are left out before the join by node
    steady = texts.where((F.col("n") >= LEAST_PAGES) & (F.col("slot") >= 0)).join(slots, ["g", "slot"]).where(F.col("n") >= CONSTANT * F.col("pages")).select("g", "slot", "text", texts["chars"])
    # copies of one article have its blocks beside each other: a template's have different ones
    company = seen.join(steady, ["g", "slot", "text"], "left_semi").groupBy("g", "slot", "text").agg(F.array_sort(F.array(*[F.count_distinct(o) for o in others])).alias("company"))
    fixed = steady.join(company.where(F.element_at("company", 2) >= LEAST_PAGES), ["g", "slot", "text"], "left_semi")
    fixed = fixed.groupBy("g", "slot").agg(F.collect_list(F.struct("slot", "text")).alias("fixed"), F.coalesce(F.sum("chars"), F.lit(0)).alias("less"))
    slots = slots.join(fixed, ["g", "slot"], "left").select("g", F.coalesce("fixed", F.array().cast("array<struct<slot:int,text:bigint>>")).alias("fixed"), "slot", (F.col("mass") - F.coalesce("less", F.lit(0))).cast("long").alias("mass"))
    wrapped = slots.groupBy("g").agg(F.flatten(F.collect_list("fixed")).alias("fixed"), F.collect_list(F.struct("slot", "mass")).alias("masses"))
    return trees.join(wrapped, "g").select("host", "layout", "tree", "fixed", "masses")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id_col, url, text (blocks joined by one line feed; empty if none), n_chars.

    Null and empty pages have empty text. Pages without a host in the url (null too) and pages of a layout with fewer than LEAST_PAGES different
    pages are read without a wrapper. Repeated rows are read each for itself and count once for the wrapper. Very long pages are read whole, elements nested deeper
    than DEPTH as part of the one around them. A table without rows gives none; other columns are ignored.
    """
    small_batches(pages.sparkSession)
    kind = pages.schema[id_col].dataType.simpleString()
    # as JSON, which is read once for a wrapper and not for every page
    found = stash(wrappers(pages, url_col, html_col).select("host", "layout", "tree", F.to_json(F.struct("fixed", "masses")).alias("counts")), "wrappers")
    size = found.agg(F.sum(F.octet_length("tree") + F.octet_length("host") + F.octet_length("counts"))).first()[0] or 0
    joined = _with_wrappers(_grouped(pages, url_col, html_col, id_col), found, size, "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def wrapper(tree: str, counts: str) -> Wrapper:
            found = json.loads(counts)
            return Wrapper(tree, [(x["slot"], x["text"]) for x in found["fixed"]], [(x["slot"], x["mass"]) for x in found["masses"]])

        known = Known(wrapper)
        for batch in batches:
            texts = []
            for host, layout, page, tree, counts in zip(*[batch[c].tolist() for c in ("host", "layout", "html", "tree", "counts")], strict=True):
                texts.append(main_text(page, None if tree is None else known.get((host, layout), tree, counts)))
            yield pd.DataFrame({"id": batch["_0"], "url": batch["url"], "text": texts})

    out = joined.select(F.col("_0").cast("string").alias("_0"), "url", "host", "layout", "html", "tree", "counts").mapInPandas(run, "id string, url string, text string")
    return out.select(F.col("id").cast(kind).alias(id_col), "url", "text", F.char_length("text").cast("long").alias("n_chars"))
