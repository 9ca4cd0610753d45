"""Main text of web pages by wrapper induction.

A page is read into a tree of its block elements; texts between block borders
are its leaves. Scripts, styles and the like are skipped. Menus, page headers and
footers, sidebars, notices, adverts, forms and reader comments, told by element,
role or class, are marked: they stay in the tree and are dropped after the
alignment. Never marked are body, main and article elements and what holds the
page's article (``_settle``); a host's pages decide together on nodes that align.
Runs of siblings of one kind are folded into one node, so that lists of any
length align.

Pages of a host are aligned by simple tree matching: nodes match if their labels
are equal, and children by the largest order-keeping matching of their subtrees.
A bounded sample of a host's pages makes its wrapper: the ``SAMPLE`` smallest by
a hash of their texts, of equal texts one page only, so that the same pages are
taken however many rows or partitions there are. A text that comes at one place of
the tree on nearly all of them is template, inside of articles, too; there, only
pages with different articles count (less than half of their text in common), as
pages of a host may be copies of each other. Every page is aligned with its host's
wrapper; its text is all that is neither template nor below a marked node, so
that what varies or doesn't align is kept wherever it stands. Fewer than ``SEEN``
such pages give no template, and nothing but marked nodes is dropped then.

Pages are dealt by host and sorted by the hash of their texts; hosts with more
than a quarter of a partition's fair share of the pages (fewer than four a
partition, hence a broadcast) are cut into pieces by a hash of the page. Every
piece gets its host's sample, so that all have the same wrapper.

Defined cases: null html is empty and has an empty text; a null url, or one
without a host, belongs to one host without name; a page alone on its host is its
own wrapper. A tag cut off by the end of the page is no text. Repeated rows give
repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import map_arrow, partitions, table, written

SAMPLE = 24              # pages a host's wrapper is made from
SEEN, MATCHED, SAME = 3, 0.6, 0.9    # pages, share of pages, share of equal texts that make template
HOT_PER_PARTITION = 4
CELLS = 1 << 18          # of a table of sizes held at once
OUT_ROWS = 256
DEEPEST = 150            # levels of the tree; what lies deeper belongs to the lowest one

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section
summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
NEVER = frozenset("""aside button canvas dialog embed fieldset footer form head header iframe input menu nav noscript object
script search select style svg template textarea title video audio""".split())
ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status
toolbar""".split())
# words of class and id
WORDS = frozenset("""ad ads adsense advert adverts advertisement advertising breadcrumb breadcrumbs comment comments
commentlist consent cookie cookies disqus gdpr login menu modal nav navbar navigation newsletter notice notices pager
pagination popup promo promotion recommended related share sharing sidebar signup social sponsor sponsored
subscribe subscription toolbar""".split())
PAGE_WORDS = frozenset("alert banner footer header masthead widget widgets".split())   # outside of an article
CONTENT = ("article", "main")
# parts named by their element or as comments; other marks are classes that page wrappers have as well
SURE = NEVER - {"fieldset", "form", "dialog"}
SURE_WORDS = frozenset("comment comments commentlist disqus".split())
# a start tag of the key ends an open element of its values
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
BARRIERS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",),
            "th": ("table",), "tbody": ("table",), "tfoot": ("table",)}
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
# class words that say what a wrapper is with or without
MODIFIER = re.compile(r"(?<!\S)(?:no|non|not|without|with|has|hide)[-_]\S*|\S+[-_]free(?!\S)", re.I)
WORD_CUT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")


class Node:
    """A block element or a listed one: label, children (nodes, or the number of
    a text). ``listed``: 0, 1 if on the lists, 2 if surely so; ``marked`` as of
    the whole page."""

    __slots__ = ("tag", "label", "kids", "content", "listed", "marked", "own", "live", "articles")

    def __init__(self, tag: str, label: str, content: bool, own: bool = False, listed: int = 0):
        self.tag, self.label, self.kids, self.content = tag, label, [], content
        self.own, self.listed, self.marked = own, listed, listed > 0    # own: an article or main itself
        self.live = self.articles = 0


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): entities.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(raw)} if raw and not raw.isspace() else {}


def _listed(tag: str, given: dict[str, str], content: bool) -> int:
    """0 if an element isn't on the lists, 2 if it surely is boilerplate, else 1."""
    role = given.get("role", "").lower()
    if tag in ("html", "body", *CONTENT) or role in CONTENT:
        return 0
    if tag in SURE and not (tag == "header" and content) or role in ROLES - {"dialog", "form"}:
        return 2
    if tag in NEVER and tag != "header":
        return 1
    if not given:
        return 0
    named = [MODIFIER.sub(" ", given[k]) for k in ("class", "id") if k in given]
    words = {w.lower() for n in named for w in WORD_CUT.split(n)}
    if words & SURE_WORDS:
        return 2
    return int(role in ROLES or "hidden" in given or given.get("aria-hidden") == "true" or bool(words & WORDS)
               or (not content and bool(words & PAGE_WORDS)))


def _label(tag: str, given: dict[str, str], listed: int) -> str:
    """Tag and words of the class; listed nodes align with listed ones only."""
    return ".".join([tag, *sorted({w.lower() for w in WORD_CUT.split(given.get("class", "")) if w})]) + "!" * (listed > 0)


def _settle(root: Node, texts: list[str]) -> None:
    """Take the marks from nodes that hold the page's article: a main element;
    articles with more text than those outside of marked nodes (for sure
    boilerplate: if there are none outside); or more than half of the page's
    text where no other article holds it (not for sure boilerplate)."""
    free = 0        # text of articles outside of marked nodes

    def main(node: Node) -> int:
        """The text in main elements below."""
        if node.own and not node.label.startswith("article"):
            return weight(node)
        held = sum(main(kid) for kid in node.kids if not isinstance(kid, int))
        if held:
            node.marked = False
        return held

    def weight(node: Node) -> int:
        return sum(len(texts[kid]) if isinstance(kid, int) else weight(kid) for kid in node.kids)

    def weigh(node: Node, marked: bool, inside: bool) -> None:
        """``live``: text without what is surely boilerplate; ``articles``: text in articles."""
        nonlocal free
        marked, inside = marked or node.marked, inside or node.own
        node.live = node.articles = 0
        for kid in node.kids:
            if isinstance(kid, int):
                n = len(texts[kid])
                node.live += n
                if inside:
                    node.articles += n
                    free += 0 if marked else n
            else:
                weigh(kid, marked, inside)
                node.live += kid.live if kid.listed < 2 or not kid.marked else 0
                node.articles += kid.articles

    def decide(node: Node, holds) -> None:
        for kid in node.kids:
            if not isinstance(kid, int):
                kid.marked = kid.marked and not holds(node, kid)
                decide(kid, holds)

    main(root)
    weigh(root, False, False)
    decide(root, lambda node, kid: not node.content and kid.articles > free and (kid.listed < 2 or not free))
    free = 0
    weigh(root, False, False)
    decide(root, lambda node, kid: kid.listed < 2 and (node.content or not free) and 2 * kid.live > root.live)


def read(page: str) -> tuple[Node, list[str]]:
    """The tree of a page's blocks and its texts in page order."""
    root = Node("body", "body", False)
    stack, texts, run = [root], [], []
    deep: Counter = Counter()    # open elements below the deepest level, by node and tag
    inline: Counter = Counter()  # open nodes that aren't blocks, by tag
    at, end = 0, len(page)

    def flush() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            stack[-1].kids.append(len(texts))
            texts.append(text)

    def close(tag: str, barriers: tuple[str, ...] = ()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                flush()
                for node in stack[i:]:
                    inline[node.tag] -= node.tag not in BLOCKS
                del stack[i:]
                for key in [k for k in deep if k[0] > i]:
                    del deep[key]
                return
            if stack[i].tag in barriers:
                return

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            lt = end
        if lt > at:
            run.append(entities.unescape(page[at:lt]))
        if lt == end:
            break
        if page.startswith("<!--", lt):
            at = page.find("-->", lt + 4)
            at = end if at < 0 else at + 3
            continue
        after = page[lt + 1:lt + 2]
        if after in ("!", "?"):
            at = page.find(">", lt)
            at = end if at < 0 else at + 1
            continue
        if not (after.isascii() and after.isalpha()) and not (after == "/" and page[lt + 2:lt + 3].isalpha()):
            if lt + 1 < end:
                run.append("<")
            at = lt + 1
            continue
        m = TAG.match(page, lt)
        if m is None:            # cut off by the end of the page
            break
        at, closing, tag = m.end(), m[1] == "/", m[2].lower()
        if closing:
            if deep[len(stack), tag] > 0:
                flush()
                deep[len(stack), tag] -= 1
            elif tag in BLOCKS or inline[tag]:
                close(tag, CONTENT if tag not in CONTENT else ())
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = end if stop is None else page.find(">", stop.start()) + 1 or end
            continue
        if stack[-1].tag == "head" and (tag in BLOCKS or tag in ("html", "body")):
            close("head")
        given = _attributes(m[3])
        inside = stack[-1].content
        listed = 0 if tag in VOID or (m[3].endswith("/") and tag not in BLOCKS) else _listed(tag, given, inside)
        if tag == "br":
            run.append(" ")
        if tag not in BLOCKS and not listed and not (inline[tag] and tag not in VOID and not m[3].endswith("/")):
            continue
        if tag not in BLOCKS:
            flush()
            if len(stack) >= DEEPEST and (not listed or len(stack) > DEEPEST):
                deep[len(stack), tag] += 1
                continue
            node = Node(tag, _label(tag, given, listed), inside, False, listed)
            stack[-1].kids.append(node)
            stack.append(node)
            inline[tag] += 1
            continue
        if tag not in ("html", "body"):
            close("p", ("article", "main", "section", "td", "th", "li", "div", "table"))
        for other in CLOSES.get(tag, ()):
            close(other, BARRIERS[tag])
        flush()
        if tag in VOID or tag in ("html", "body"):
            continue
        if len(stack) >= DEEPEST and (not listed or len(stack) > DEEPEST):
            deep[len(stack), tag] += 1
            continue
        own = tag in CONTENT or given.get("role", "").lower() in CONTENT
        node = Node(tag, _label(tag, given, listed), inside or own, own, listed)
        stack[-1].kids.append(node)
        stack.append(node)
    flush()
    _settle(root, texts)
    return root, texts


class Folded:
    """A node of the folded tree: runs of siblings of one label in one; ``texts``
    are the numbers of its own texts. ``weight``: nodes below. ``article``: holds
    an article or main. ``kind``: the labels of the whole subtree."""

    __slots__ = ("label", "kids", "texts", "content", "weight", "marked", "article", "kind")

    def __init__(self, label: str, nodes: list[Node]):
        self.label, self.kids, self.texts = label, [], []
        self.content = any(n.content for n in nodes)
        self.marked = nodes[0].marked
        run: list[Node] = []
        for kid in (k for n in nodes for k in n.kids):
            if isinstance(kid, int):
                self.texts.append(kid)
                continue
            if run and (run[0].label, run[0].marked) != (kid.label, kid.marked):
                self.kids.append(Folded(run[0].label, run))
                run = []
            run.append(kid)
        if run:
            self.kids.append(Folded(run[0].label, run))
        self.weight = 1 + sum(k.weight for k in self.kids)
        self.article = any(n.own for n in nodes) or any(k.article for k in self.kids)
        self.kind = hashlib.blake2b("\0".join([label, *(k.kind.hex() for k in self.kids)]).encode("utf-8", "replace"),
                                    digest_size=16).digest()

    def walk(self) -> Iterator[Folded]:
        yield self
        for kid in self.kids:
            yield from kid.walk()

    def shape(self) -> tuple:
        """What tells trees of the same texts apart."""
        return (self.label, self.marked, self.content, tuple(self.texts), *(kid.shape() for kid in self.kids))

    def unmarked(self, marked) -> Iterator[Folded]:
        """The nodes that aren't below one for which ``marked`` holds."""
        if not marked(self):
            yield self
            for kid in self.kids:
                yield from kid.unmarked(marked)


class Matching:
    """Simple tree matching: the largest order-keeping matching of two trees with
    equal labels, and its pairs.

    The size depends on the labels only, so it is worked out once for each two
    kinds of subtrees. Equal subtrees at the beginnings and ends of two lists of
    children match each other. Between them a row of the table of sizes is one
    numpy expression (the best of the row above and of a match, then a running
    maximum); large tables are never held: the list is halved where the sizes of
    both halves add up best."""

    def __init__(self):
        self.sizes: dict[tuple[bytes, bytes], int] = {}

    def size(self, a: Folded, b: Folded) -> int:
        if a.label != b.label:
            return 0
        if a.kind == b.kind:
            return a.weight
        found = self.sizes.get((a.kind, b.kind))
        if found is None:
            front, x, y, back = self._trimmed(a.kids, b.kids)
            found = 1 + sum(k.weight for k in a.kids[:front]) + sum(k.weight for k in a.kids[len(a.kids) - back:])
            if x and y:
                found += int(self._last_row(x, y, self._table(x, y))[-1])
            self.sizes[a.kind, b.kind] = found
        return found

    def pairs(self, a: Folded, b: Folded) -> Iterator[tuple[Folded, Folded]]:
        if a.label != b.label:
            return
        yield a, b
        front, x, y, back = self._trimmed(a.kids, b.kids)
        matched = [*zip(a.kids[:front], b.kids[:front]), *(self._matched(x, y) if x and y else ()),
                   *(zip(a.kids[-back:], b.kids[-back:]) if back else ())]
        for p, q in matched:
            yield from self.pairs(p, q)

    @staticmethod
    def _trimmed(x: list[Folded], y: list[Folded]) -> tuple[int, list[Folded], list[Folded], int]:
        """How many first and last children are equal subtrees, and what lies between."""
        front, least = 0, min(len(x), len(y))
        while front < least and x[front].kind == y[front].kind:
            front += 1
        back = 0
        while back < least - front and x[-1 - back].kind == y[-1 - back].kind:
            back += 1
        return front, x[front:len(x) - back], y[front:len(y) - back], back

    def _table(self, x: list[Folded], y: list[Folded]) -> dict[bytes, np.ndarray]:
        """For each kind among ``x``, its sizes with each of ``y``."""
        kinds = list({k.kind: k for k in y}.values())
        place = {k.kind: i for i, k in enumerate(kinds)}
        at = np.array([place[k.kind] for k in y])
        return {k.kind: np.array([self.size(k, other) for other in kinds], dtype=np.int64)[at]
                for k in {k.kind: k for k in x}.values()}

    @staticmethod
    def _next_row(row: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        new = row.copy()
        np.maximum(new[1:], np.where(sizes > 0, row[:-1] + sizes, 0), out=new[1:])
        return np.maximum.accumulate(new)

    def _last_row(self, x: list[Folded], y: list[Folded], table: dict[bytes, np.ndarray], back: bool = False) -> np.ndarray:
        row = np.zeros(len(y) + 1, dtype=np.int64)
        for kid in reversed(x) if back else x:
            row = self._next_row(row, table[kid.kind][::-1] if back else table[kid.kind])
        return row

    def _matched(self, x: list[Folded], y: list[Folded]) -> list[tuple[Folded, Folded]]:
        """The pairs of the best matching of two lists."""
        table = self._table(x, y)
        out, todo = [], [(0, len(x), 0, len(y))]
        while todo:
            a, b, c, d = todo.pop()
            if a == b or c == d:
                continue
            own = {k.kind: table[k.kind][c:d] for k in x[a:b]}
            if (b - a) * (d - c) > CELLS and b - a > 1:
                half = (a + b) // 2
                up = self._last_row(x[a:half], y[c:d], own)
                down = self._last_row(x[half:b], y[c:d], own, back=True)[::-1]
                cut = c + int(np.argmax(up + down))
                todo += [(a, half, c, cut), (half, b, cut, d)]
                continue
            rows = [np.zeros(d - c + 1, dtype=np.int64)]
            for kid in x[a:b]:
                rows.append(self._next_row(rows[-1], own[kid.kind]))
            i, j = b - a, d - c
            while i and j:
                if rows[i][j] == rows[i - 1][j]:
                    i -= 1
                elif rows[i][j] == rows[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out.append((a + i, c + j))
        return [(x[i], y[j]) for i, j in sorted(out)]


def align(a: Folded, b: Folded, matching: Matching | None = None) -> tuple[int, list[tuple[Folded, Folded]]]:
    """The size of the largest matching of two trees, and its pairs."""
    pairs = list((matching or Matching()).pairs(a, b))
    return len(pairs), pairs


class Page:
    def __init__(self, source: str | None):
        root, self.texts = read(source or "")
        self.tree = Folded(root.label, [root])

    def of(self, node: Folded) -> tuple[str, ...]:
        return tuple(self.texts[t] for t in node.texts)


def _articles(pages: list[Page]) -> list[Page]:
    """Pages with different articles: of pages whose articles have more than half
    of their text in common, the first."""
    kept: list[tuple[Page, Counter]] = []
    for page in pages:
        own = Counter(page.texts[t] for n in page.tree.walk() if n.content for t in n.texts)
        size = sum(len(t) * n for t, n in own.items())
        for _, other in kept:
            common = sum(len(t) * n for t, n in (own & other).items())
            if 2 * common > min(size, sum(len(t) * n for t, n in other.items())):
                break
        else:
            if own:
                kept.append((page, own))
    return [page for page, _ in kept]


class Wrapper:
    """Made from some pages of a host: the model tree, the texts that are
    template by its nodes, and the nodes that are marked."""

    def __init__(self, pages: list[Page]):
        different = list({tuple(p.texts): p for p in pages}.values())
        model = max(different, key=lambda p: p.tree.weight)
        self.tree, self.matching = model.tree, Matching()
        articles = {id(p) for p in _articles(different)}
        # of each node: pages that have it, and pages that have a text there;
        # pages with different articles only, for nodes inside of articles
        having: Counter = Counter()
        seen: dict[int, Counter] = {id(n): Counter() for n in self.tree.walk()}
        votes: Counter = Counter()
        for page in different:
            for own, other in align(self.tree, page.tree, self.matching)[1]:
                votes[id(own)] += 1 if other.marked else -1
                if other.texts and (id(page) in articles or not (own.content or other.content)):
                    having[id(own)] += 1
                    seen[id(own)].update(set(page.of(other)))
        self.marked = {id(n) for n in self.tree.walk() if votes[id(n)] > 0 or (n.marked and not votes[id(n)])}
        self.template: dict[int, set[str]] = {}
        for node in self.tree.walk():
            n = having[id(node)]
            if n >= SEEN and n >= MATCHED * (len(articles) if node.content else len(different)):
                self.template[id(node)] = {t for t, k in seen[id(node)].items() if k >= SEEN and k >= SAME * n}

    def text(self, page: Page) -> str:
        """The page's texts that are neither template nor below a marked node. A
        node that aligns is marked as in the wrapper, unless it holds an article
        here."""
        pairs = align(self.tree, page.tree, self.matching)[1]
        template = {t for own, other in pairs for t in other.texts if page.texts[t] in self.template.get(id(own), ())}
        marked = {id(other): id(own) in self.marked for own, other in pairs if not other.article}
        nodes = page.tree.unmarked(lambda n: marked.get(id(n), n.marked))
        keep = {t for n in nodes for t in n.texts} - template
        return "\n".join(page.texts[t] for t in sorted(keep))


def _host():
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def texts_key(page: Page) -> int:
    """A hash of a page's texts."""
    made = hashlib.blake2b(digest_size=8)
    for t in page.texts:
        made.update(t.encode("utf-8", "replace") + b"\n")
    return int.from_bytes(made.digest(), "big", signed=True)


def _decoded(source: bytes | None) -> str:
    return "" if source is None else source.decode("utf-8", "replace")


def _keyed(rows: DataFrame, unless: str | None = None) -> DataFrame:
    """``rows`` with the hash of each page's texts as ``key``, null where the
    column ``unless`` is set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch.column(batch.schema.get_field_index("html")).cast(pa.binary())
            skip = batch.column(batch.schema.get_field_index(unless)).is_valid().to_pylist() if unless else [False] * len(sources)
            keys = [None if no else texts_key(Page(_decoded(source.as_py()))) for no, source in zip(skip, sources)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=[*batch.schema.names, "key"])

    return map_arrow(rows, run, T.StructType([*rows.schema.fields, T.StructField("key", T.LongType())]))


def _samples(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``(host, html, key)``: the sample of each hot host, chosen by hashes before
    any page moves."""
    own = rows.join(F.broadcast(hot.select("host")), "host").select("host", "html", F.xxhash64("html").alias("page"))
    each = _keyed(own).groupBy("host", "key").agg(F.min("page").alias("page"))
    least = each
    # in two steps, so that a host's candidates from all partitions don't meet in one task
    for by in (["host", F.pmod("key", F.lit(16))], ["host"]):
        least = least.withColumn("at", F.row_number().over(Window.partitionBy(*by).orderBy("key"))).where(F.col("at") <= SAMPLE)
    chosen = written(least.select("host", "key", "page"), "wrapper-samples")
    pages = own.join(F.broadcast(chosen), ["host", "page"])
    return pages.groupBy("host", "key").agg(F.min("html").alias("html"))


def extract(pages: DataFrame, ident: str = "page_id") -> DataFrame:
    """``(ident, url, text, n_chars)`` of a table with ``url`` and ``html``."""
    parts = partitions(pages.sparkSession)
    rows = pages.select(ident, "url", "html", _host().alias("host"))
    hosts = rows.groupBy("host").agg(F.count("*").alias("n"))
    fair = max(rows.count() / (HOT_PER_PARTITION * parts), 4.0 * SAMPLE)
    hot = written(hosts.where(F.col("n") > fair).select(
        "host", F.ceil(F.col("n") / F.lit(fair)).cast("int").alias("pieces")), "hot-hosts")
    piece = F.coalesce(F.pmod(F.xxhash64(ident, F.lit(3)), F.col("pieces")).cast("int"), F.lit(0))
    # kind 0: a page of the sample, for each piece; 1: a page of a hot host; 2: of any other host
    every = _keyed(rows.join(F.broadcast(hot), "host", "left").withColumn("piece", piece), "pieces").withColumn(
        "kind", F.when(F.col("pieces").isNull(), 2).otherwise(1)).drop("pieces")
    samples = _samples(rows, hot).join(F.broadcast(hot), "host").select(
        F.lit(None).cast(pages.schema[ident].dataType).alias(ident), F.lit(None).cast("string").alias("url"), "html", "host",
        "key", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(0).alias("kind"))
    dealt = (every.unionByName(samples).repartition(parts, "host", "piece")
             .sortWithinPartitions("host", "piece", F.col("kind") > 0, "key", F.xxhash64("html"), ident))
    schema = T.StructType([pages.schema[ident], T.StructField("url", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            hosts, pieces, kinds, keys = get("host"), get("piece"), get("kind"), get("key")
            urls, sources = get("url"), get("html").cast(pa.binary())
            for i in range(batch.num_rows):
                yield ((hosts[i].as_py(), pieces[i].as_py()), kinds[i].as_py(), keys[i].as_py(), get(ident)[i],
                       urls[i].as_py(), _decoded(sources[i].as_py()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def sent() -> pa.RecordBatch:
            texts = [t for *_, t in out]
            made = pa.RecordBatch.from_arrays([
                pa.array([x[0].as_py() for x in out], batch_type[0]), pa.array([x[1] for x in out], pa.string()),
                pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.fieldNames())
            out.clear()
            return made

        batch_type: list = []
        group, wrapper = None, None
        sample: dict[int, Page] = {}    # by key, in its order
        waiting: list[tuple] = []       # rows of the sample's texts
        shapes: dict[tuple, Page] = {}  # their pages, each once

        def settle() -> None:
            nonlocal wrapper
            wrapper = Wrapper(list(sample.values()))
            made = {shape: wrapper.text(page) for shape, page in shapes.items()}
            out.extend((i, url, made[shape]) for i, url, shape in waiting)
            waiting.clear()
            shapes.clear()
            sample.clear()

        for own, kind, key, i, url, source in groups(batches):
            if not batch_type:
                batch_type.append(i.type)
            if own != group:
                if waiting:
                    settle()
                group, wrapper = own, None
                sample.clear()
            if kind == 0:
                sample[key] = Page(source)
                continue
            if wrapper is None and (kind == 1 or (key not in sample and len(sample) == SAMPLE)):
                settle()
            if wrapper is not None:
                out.append((i, url, wrapper.text(Page(source))))
            else:
                page = Page(source)
                shape = key, hash(page.tree.shape())
                sample.setdefault(key, shapes.setdefault(shape, page))
                waiting.append((i, url, shape))
            while len(out) >= OUT_ROWS:
                yield sent()
        if waiting:
            settle()
        if out:
            yield sent()

    return map_arrow(dealt, run, schema)


def op9_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
