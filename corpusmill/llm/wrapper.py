"""Main text of web pages by wrapper induction over the pages of a host.

1. Each page is parsed into a DOM tree in which runs of siblings of one kind (tag and
   class) become one repeated node.
2. Pages of a host are read in groups; a group's trees are aligned with a template by
   simple tree matching (the maximum matching of two trees that keeps order and
   ancestors; equal skeletons are matched once), and the template grows by what it lacks.
   Two lists of children with more than ``WIDE`` pairs are joined in order, label by
   label, without a table.
3. A template node collects the texts that the pages have in its slot.  A text found on
   at least ``CONSTANT`` of the group's distinct pages (and ``SUPPORT`` of them) is
   template; the other texts are the slot's varying content.  Pages are distinct by the
   text of their article (of all but boilerplate where they have none), so copies of one
   article are evidence once.
4. The page's content is the subtree that holds its article: an article or main element
   if there is one, else the smallest subtree with most of the varying text, with a title
   (``h1``, or the header of an entry) that stands before it.  Within it, boilerplate
   elements (menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments
   by tag, role or class) and template texts go.  A heading that the template has stays
   where varying text follows it.  A name alone does not make a wrapper boilerplate: what
   holds the article or most of the varying text stays, and a class, an id or a form tag
   only decides for slots that the template has on most pages, or that are small beside
   the content (``View.drops``).  Only a section named as the comments goes whatever its
   size, if other text is left.  An inline element never leaves a block in which other
   text stands beside it.  An article of which the template would leave nearly nothing
   (under ``NEARLY``) keeps its texts.

A host with fewer than ``SUPPORT`` distinct pages has no constant texts; there only step
4's elements decide.  Pages go to (host, salt) by a shuffle: hosts with more than a
thousandth of all pages are salted, and a task holds one group at a time, in an order fixed
by a hash: ``GROUP`` pages, or fewer that reach ``GROUP_CHARS`` together.  Elements may
nest to any depth.  A null or empty html gives an empty text; a null url is a host of its
own.  Repeated rows are pages each, and count once as evidence.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = 256
GROUP_CHARS = 1 << 24
WIDE = 1 << 22  # cells of a table of two lists of children
CONSTANT = 0.8
SUPPORT = 8
NEARLY = 0.05
SMALL = 0.25  # share of the content's varying text up to which a name alone decides
NAMED, FIRM, COMMENTS = 1, 2, 3  # boilerplate by class, id or form; by another tag, role or as hidden; by a comment section's name

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes svg object select annotation annotation-xml".split())
VERBATIM = frozenset("script style noscript iframe textarea title xmp noembed noframes".split())  # to the page's end if they have none
GONE = RAW | frozenset("input button audio video canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img "
    "math menclose mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
#: An opening tag closes an open element of these, up to the nearest element of the second set.
CLOSES = {
    "p": (frozenset(["p"]), frozenset(["body", "div", "article", "section", "td", "li", "blockquote", "button", "main", "aside", "nav", "form"])),
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "body"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "body"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "body"])),
    "tr": (frozenset(["tr"]), frozenset(["table", "tbody", "thead", "tfoot", "body"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table", "body"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table", "body"])),
    "option": (frozenset(["option"]), frozenset(["select", "body"])),
}
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul figure details".split())
BOILER_TAGS = GONE | frozenset("head nav footer aside menu dialog".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer form gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification pagination popup promo promoted promotion related replies reply respond share "
    "sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
COMMENT_NAMES = frozenset(
    "comment comments comment-list comments-list commentlist comment-section comments-section comments-area comment-respond comment-form respond disqus disqus-thread "
    "post-comments reader-comments user-comments article-comments".split()
)
#: Beside one of these a header is the article's own.
ENTRY_WORDS = frozenset("article chapter content entry main page post section single story title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MARK = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
STOP = re.compile(r">|=\s*([\"'])")
ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("boiler", "kids", "label", "tag", "title")

    def __init__(self, tag: str, label: str, boiler: int, title: bool = False):
        self.tag, self.label, self.boiler, self.title = tag, label, boiler, title
        self.kids: list = []  # nodes and text


def _element(tag: str, attrs: str, within: bool) -> Node:
    label, named, firm, title, comments = tag, tag == "form", tag in BOILER_TAGS, tag == "h1", False
    if attrs.strip():
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)}
        for name in f"{found.get('class', '')} {found.get('id', '')}".split():
            words = WORDS.findall(re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name).lower())
            marks = BOILER_WORDS.intersection(words)
            if marks == {"header"} and (within or not ENTRY_WORDS.isdisjoint(words)):
                title = True
            elif tag not in ("html", "body", "main"):
                comments = comments or "-".join(words) in COMMENT_NAMES
                named = named or (tag != "article" and bool(marks))
        role = found.get("role", "").lower()
        named = named or role == "form"
        if tag not in ("html", "body"):  # all of the page
            firm = firm or role in BOILER_ROLES or "hidden" in found or found.get("aria-hidden", "") == "true"
            firm = firm or re.search(r"display\s*:\s*none", found.get("style", ""), re.I) is not None
        label = tag + "." + " ".join(sorted(WORDS.findall(found.get("class", "").lower())))
    firm = firm or (tag == "header" and not within and not title)
    return Node(tag, label, COMMENTS if comments and tag not in INLINE else FIRM if firm else NAMED if named else 0, title)


class Scanner:
    """Finds the ends of a page's tags, in time linear in the page."""

    def __init__(self, html: str):
        self.html, self.plain = html, False
        self.lone: set[str] = set()  # quotes that do not occur any more

    def end(self, at: int) -> int:
        """Place of the ``>`` of the tag whose name ends at ``at``, -1 if it has none.  A
        ``>`` within a quoted value does not end a tag; once quotes would leave one open
        to the end of the page, quotes count no more."""
        p = at
        while not self.plain:
            m = STOP.search(self.html, p)
            if m is None:
                self.plain = True
                break
            if not m[1]:
                return m.start()
            p = m.end()
            if m[1] not in self.lone:
                close = self.html.find(m[1], p)
                if close < 0:
                    self.lone.add(m[1])
                else:
                    p = close + 1
        return self.html.find(">", at)


def parse(html: str) -> Node:
    """A tolerant parse; the root holds whatever there is.  A tag or declaration without
    an end is text, as is all behind it."""
    root = Node("#", "#", 0)
    stack = [root]
    opened: Counter = Counter()  # tags of the stack
    scanner = Scanner(html)
    at = 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            opened[stack.pop().tag] -= 1

    while (m := MARK.search(html, at)) is not None:
        if m[1]:
            end = m.end() - 2 if html.startswith((">", "->"), m.end()) else m.end()
            end = html.find("-->" if end == m.end() else ">", end)
            end = len(html) if end < 0 else html.index(">", end)
        else:
            end = scanner.end(m.end()) if m[3] else html.find(">", m.end())
        if end < 0:
            break
        if m.start() > at:
            stack[-1].kids.append(html[at : m.start()])
        at = end + 1
        if not m[3]:
            continue
        tag = m[3].lower()
        if m[2]:
            if opened[tag]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        shut = CLOSES["p"] if tag in ENDS_P else CLOSES.get(tag)
        if shut and any(opened[t] for t in shut[0]):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in shut[0]:
                    close(k)
                    break
                if stack[k].tag in shut[1]:
                    break
        attrs = html[m.end() : end]
        node = _element(tag, attrs, opened["article"] + opened["main"] > 0)
        stack[-1].kids.append(node)
        closed = attrs.endswith("/")
        if tag in RAW:
            if closed and tag == "svg":
                continue
            raw = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            if raw:
                end = html.find(">", raw.end())
                at = end + 1 if end >= 0 else len(html)
            elif tag in VERBATIM and not closed:
                at = len(html)  # never text
        elif tag not in VOID and not closed:
            stack.append(node)
            opened[tag] += 1
    if at < len(html):
        stack[-1].kids.append(html[at:])
    return root


def squeeze(parts: list[str]) -> str:
    return " ".join(entities.unescape("".join(parts)).split())


class Slot:
    """A run of siblings of one label, with the blocks of text that lie in it directly."""

    __slots__ = ("boiler", "kids", "label", "tag", "texts", "title")

    def __init__(self, label: str, tag: str, boiler: int, title: bool = False):
        self.label, self.tag, self.boiler, self.title = label, tag, boiler, title
        self.kids: list[Slot] = []
        self.texts: list[tuple[int, str]] = []  # place in the page, block

    def below(self, node: Node) -> Slot:
        """The slot of a child: the last one if it continues its run."""
        last = self.kids[-1] if self.kids else None
        if last is None or last.label != node.label or last.boiler != node.boiler:
            last = Slot(node.label, node.tag, node.boiler, node.title)
            self.kids.append(last)
        return last


def slots(root: Node) -> Slot:
    """The tree of block elements as slots: inline elements belong to their block.  A name
    makes an inline element boilerplate only if no other text stands beside it in its
    block, and never in a heading."""
    place = 0
    holders = _with_blocks(root)

    def flush(slot: Slot, run: list[tuple[str, Node | None]]) -> None:
        nonlocal place
        text = squeeze([t for t, _ in run])
        if text:
            names = [n for t, n in run if t.strip()]
            to = slot if slot.tag in HEADINGS or None in names else slot.below(names[0])
            to.texts.append((place, text))
            place += 1
        run.clear()

    top = Slot("#", "#", 0)
    frames: list[tuple[Slot, list, list]] = [(top, [], [(iter(root.kids), None)])]
    while frames:
        slot, run, todo = frames[-1]
        while todo:
            nodes, name = todo[-1]
            kid = next(nodes, None)
            if kid is None:
                todo.pop()
            elif isinstance(kid, str):
                run.append((kid, name))
            elif kid.tag in GONE or (kid.tag in INLINE and kid.boiler >= FIRM and id(kid) not in holders):
                continue  # never text, and no end of a block
            elif kid.tag in INLINE and id(kid) not in holders:
                if kid.tag == "br":
                    run.append((" ", name))
                todo.append((iter(kid.kids), name or (kid if kid.boiler else None)))
            else:
                flush(slot, run)
                frames.append((slot.below(kid), [], [(iter(kid.kids), None)]))
                break
        else:
            flush(slot, run)
            frames.pop()
    return top


def _with_blocks(root: Node) -> set[int]:
    """Nodes below which a block element lies."""
    order: list[tuple[Node, Node | None]] = [(root, None)]
    for node, _ in order:
        order.extend((k, node) for k in node.kids if not isinstance(k, str))
    out: set[int] = set()
    for node, parent in reversed(order):
        if parent is not None and (id(node) in out or not (node.tag in INLINE or node.tag in GONE)):
            out.add(id(parent))
    return out


def shape(slot: Slot) -> tuple:
    """Depth and label of each slot in preorder."""
    out, todo = [], [(slot, 0)]
    while todo:
        s, depth = todo.pop()
        out.append((depth, s.label))
        todo += [(k, depth + 1) for k in reversed(s.kids)]
    return tuple(out)


class Template:
    """Slots that pages are aligned with; a page's slot maps to a number."""

    def __init__(self):
        self.labels: list[str] = ["#"]
        self.kids: list[list[int]] = [[]]
        self.texts: list[Counter] = [Counter()]
        self.pages: list[int] = [0]  # distinct pages that have the slot
        self.known: dict[tuple, list[int]] = {}

    def match(self, a: Slot, b: int, memo: dict) -> tuple[int, list[tuple[Slot, int]]]:
        """Simple tree matching of page slot ``a`` with template slot ``b``: the size of
        the largest matching, and which children it joins."""
        if a.label != self.labels[b]:
            return 0, []
        todo = [(a, b)]
        while todo:  # children first
            p, q = todo[-1]
            if (id(p), q) in memo:
                todo.pop()
                continue
            x, y = p.kids, self.kids[q]
            if not x or not y:
                memo[id(p), q] = 1, []
                continue
            if len(x) * len(y) > WIDE:
                memo[id(p), q] = self._greedy(x, y)
                continue
            weights = np.zeros((len(x), len(y)), np.int64)
            missing = []
            places: dict[str, list[int]] = {}
            for j, k in enumerate(y):
                places.setdefault(self.labels[k], []).append(j)
            for i, k in enumerate(x):
                for j in places.get(k.label, ()):
                    if not k.kids or not self.kids[y[j]]:
                        weights[i, j] = 1
                    elif (id(k), y[j]) in memo:
                        weights[i, j] = memo[id(k), y[j]][0]
                    else:
                        missing.append((k, y[j]))
            if missing:
                todo += missing
                continue
            memo[id(p), q] = self._ordered(x, y, weights)
            todo.pop()
        return memo[id(a), b]

    def _greedy(self, x: list[Slot], y: list[int]) -> tuple[int, list[tuple[Slot, int]]]:
        """Joins each child to the next of its label: for lists too long for a table."""
        places: dict[str, list[int]] = {}
        for j, k in enumerate(y):
            places.setdefault(self.labels[k], []).append(j)
        pairs, at = [], 0
        for k in x:
            found = places.get(k.label, [])
            i = bisect_left(found, at)
            if i < len(found):
                pairs.append((k, y[found[i]]))
                at = found[i] + 1
        return len(pairs) + 1, pairs

    @staticmethod
    def _ordered(x: list[Slot], y: list[int], weights: np.ndarray) -> tuple[int, list[tuple[Slot, int]]]:
        """The heaviest matching of two lists of children that keeps their order."""
        best = np.zeros((len(x) + 1, len(y) + 1), np.int64)
        for i in range(len(x)):
            best[i + 1, 1:] = np.maximum.accumulate(np.maximum(best[i, 1:], best[i, :-1] + weights[i]))
        pairs, i, j = [], len(x), len(y)
        while i and j:
            if best[i, j] == best[i - 1, j]:
                i -= 1
            elif best[i, j] == best[i, j - 1]:
                j -= 1
            else:
                pairs.append((x[i - 1], y[j - 1]))
                i, j = i - 1, j - 1
        return int(best[-1, -1]) + 1, pairs[::-1]

    def align(self, page: Slot) -> list[int]:
        """Template numbers of the page's slots in preorder; adds slots it lacks."""
        form = shape(page)
        if form not in self.known:
            memo: dict = {}
            out: list[int] = []
            todo = [(page, 0)]
            while todo:
                a, b = todo.pop()
                out.append(b)
                joined = {id(p): q for p, q in self.match(a, b, memo)[1]}
                after, below = 0, []
                for p in a.kids:
                    q = joined.get(id(p))
                    if q is None:
                        q = len(self.labels)
                        self.labels.append(p.label)
                        self.kids.append([])
                        self.texts.append(Counter())
                        self.pages.append(0)
                        self.kids[b].insert(after, q)
                    after = self.kids[b].index(q, after) + 1
                    below.append((p, q))
                todo += reversed(below)
            self.known[form] = out
        return self.known[form]


def preorder(slot: Slot) -> Iterator[Slot]:
    todo = [slot]
    while todo:
        s = todo.pop()
        yield s
        todo += reversed(s.kids)


def induce(pages: list[str]) -> list[str]:
    """The main text of each page of one host."""
    template = Template()
    trees = [slots(parse(p)) for p in pages]
    aligned = [list(zip(preorder(t), template.align(t), strict=True)) for t in trees]
    plain = [View(t) for t in trees]
    seen: set[bytes] = set()
    for view, page in zip(plain, aligned, strict=True):
        key = view.digest()
        if key in seen:
            continue
        seen.add(key)
        for slot, number in page:
            template.texts[number].update({t for _, t in slot.texts})
            template.pages[number] += 1
    if len(seen) < SUPPORT:  # nothing is known to be template
        return [content(v, v) for v in plain]
    least = max(SUPPORT, CONSTANT * len(seen))
    views = (View(t, {id(s): (template.texts[n], template.pages[n]) for s, n in page}, least) for t, page in zip(trees, aligned, strict=True))
    return [content(v, p) for v, p in zip(views, plain, strict=True)]


class View:
    """A page's tree with its slots' (texts, pages) of the template: which blocks vary,
    and which boilerplate elements go.  Without ``counts`` every block varies."""

    def __init__(self, tree: Slot, counts: dict[int, tuple[Counter, int]] | None = None, least: float = 0):
        self.tree, self.counts, self.least = tree, counts, least
        self.sizes: dict[int, tuple[int, int]] = {}
        self.articles: dict[int, tuple[int, bool]] = {}
        self._weigh()
        self._articles(NAMED)
        self.inside = FIRM if self.articles[id(tree)][0] else FIRM + 1  # articles lie in firm boilerplate only if nowhere else
        if self.inside > FIRM:
            self._articles(FIRM)
        self.base = self.sizes[id(tree)]
        self.found = self.mains()
        base = tuple(sum(self.sizes[id(s)][k] for s in self.found) for k in (0, 1))
        if base[0]:  # within the articles, what is small beside them
            self.base = base
        self.kept: dict[int, int] = {}  # varying text of a slot's blocks
        for s in reversed(list(preorder(tree))):
            self.kept[id(s)] = sum(len(t) for _, t in self.own(s)) + sum(self.kept[id(k)] for k in s.kids if not self.drops(k))

    def own(self, slot: Slot) -> list[tuple[int, str]]:
        if self.counts is None:
            return slot.texts
        texts = self.counts[id(slot)][0]
        return [x for x in slot.texts if texts[x[1]] < self.least]

    def _weigh(self) -> None:
        """Varying text below each slot: outside of firm boilerplate, and of comments."""
        for slot in reversed(list(preorder(self.tree))):
            free = every = sum(len(t) for _, t in self.own(slot))
            for k in slot.kids:
                f, e = self.sizes[id(k)]
                free += f if k.boiler < FIRM else 0
                every += e if k.boiler < COMMENTS else 0
            self.sizes[id(slot)] = free, every

    def _articles(self, most: int) -> None:
        """For each slot the text of the articles below, and whether there is a main
        element, through boilerplate up to ``most``."""
        reach = [self.tree]
        for slot in reach:
            if slot.tag not in ("article", "main"):
                reach += [k for k in slot.kids if k.boiler <= most]
        self.articles.clear()
        for slot in reversed(reach):
            if slot.tag in ("article", "main"):
                got = sum(len(t) for s in preorder(slot) for _, t in s.texts), slot.tag == "main"
            else:
                below = [self.articles[id(k)] for k in slot.kids if k.boiler <= most]
                got = sum(n for n, _ in below), any(m and n for n, m in below)
            self.articles[id(slot)] = got

    def drops(self, slot: Slot) -> bool:
        """Is the slot boilerplate?"""
        if not slot.boiler:
            return False
        if slot.boiler == COMMENTS:  # whatever their size, if other text is left
            return self.sizes[id(self.tree)][0] > 0
        text, main = self.articles.get(id(slot), (0, False))
        if slot.boiler == FIRM:
            return not (text and self.inside > FIRM) and not (self.counts is not None and 2 * self.sizes[id(slot)][1] > self.base[1])
        if main or (text and 2 * text >= self.articles[id(self.tree)][0]):
            return False
        size = self.sizes[id(slot)][0]
        if 2 * size > self.base[0]:
            return False
        return (self.counts is not None and self.counts[id(slot)][1] >= self.least) or size <= SMALL * self.base[0]

    def blocks(self, top: Slot) -> list[tuple[int, str]]:
        """Varying blocks below a slot and outside of boilerplate.  A heading that the
        template has stays if varying text follows before the next heading of its rank."""
        out: list[tuple[int, str]] = []
        heads: list[tuple[int, int, str, bool]] = []  # place, rank, text, template
        todo = [top]
        while todo:
            slot = todo.pop()
            own = self.own(slot)
            out += own
            if slot.tag in HEADINGS:
                varying = {p for p, _ in own}
                heads += [(p, int(slot.tag[1]), t, p not in varying) for p, t in slot.texts]
            todo += [k for k in slot.kids if not self.drops(k)]
        if any(h[3] for h in heads):
            places = sorted(p for p, _ in out)
            ends = [float("inf")] * 7  # the next heading by rank
            for p, rank, text, shared in sorted(heads, reverse=True):
                after = bisect_right(places, p)
                if shared and after < len(places) and places[after] < min(ends[: rank + 1]):
                    out.append((p, text))
                ends[rank] = p
        return out

    def mains(self) -> list[Slot]:
        """The article and main elements that lie in no other and in no boilerplate."""
        out, todo = [], [self.tree]
        while todo:
            slot = todo.pop()
            if self.articles.get(id(slot), (0, False))[0] == 0 or (slot.boiler and self.drops(slot)):
                continue
            if slot.tag in ("article", "main"):
                out.append(slot)
            else:
                todo += slot.kids
        return out

    def article(self) -> list[tuple[int, str]]:
        return [x for s in self.found for x in self.blocks(s)]

    def digest(self) -> bytes:
        """Of the page's article, or all but boilerplate."""
        blocks = self.article() or self.blocks(self.tree)
        return hashlib.blake2b("\n".join(t for _, t in sorted(blocks)).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def content(view: View, plain: View) -> str:
    """The page's text; ``plain``: the page without a template."""
    if view.found:
        blocks, every = view.article(), plain.article()
        if sum(len(t) for _, t in blocks) < NEARLY * sum(len(t) for _, t in every):
            blocks = every
        if blocks:
            return "\n".join(t for _, t in sorted(blocks))
    top, titles = view.tree, []
    while True:  # the smallest subtree with most of the varying text
        best = max((k for k in top.kids if not view.drops(k)), key=lambda k: view.kept[id(k)], default=None)
        if best is None or view.kept[id(best)] < 0.6 * view.kept[id(view.tree)] or not best.kids:
            break
        for k in top.kids[: top.kids.index(best)]:  # the title may stand before it
            if k.title and not view.drops(k):
                titles += view.blocks(k)
        top = best
    return "\n".join(t for _, t in sorted([*titles, *view.blocks(top)]))


def main_text(pages: DataFrame, hot: int = 2000) -> DataFrame:
    """(page_id, url, text) for ``pages`` (page_id, url, html)."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url"), r"^[a-zA-Z][^:/]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))
    rows = pages.select("page_id", "url", "html", host.alias("host"), F.xxhash64(F.col("page_id").cast("string"), "url", F.length("html")).alias("h"))
    counts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    total = pages.count()
    # hosts with more than a thousandth of all pages: a thousand at most
    few = counts.where(F.col("n") > max(hot, total // 1000)).select("host", F.ceil(F.col("n") / (2 * GROUP)).alias("salts"))
    rows = rows.join(F.broadcast(few), "host", "left").withColumn("salt", F.pmod("h", F.coalesce("salts", F.lit(1))))
    rows = rows.repartition("host", "salt").sortWithinPartitions("host", "salt", "h", "page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key, size = None, 0
        kinds: list = []

        def emit(part: list[tuple]) -> pa.RecordBatch:
            texts = induce([p[2] or "" for p in part])
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in part], kinds[0]), pa.array([p[1] for p in part], pa.string()), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

        for b in batches:
            kinds = [b.schema.field("page_id").type]
            for page, url, html, *k in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "host", "salt")), strict=True):
                if k != key:
                    if held:
                        yield emit(held)
                    held, key, size = [], k, 0
                elif size >= GROUP_CHARS:  # large pages
                    yield emit(held)
                    held, size = [], 0
                elif len(held) >= 2 * GROUP:  # the last group of a host has a whole group's evidence
                    yield emit(held[:GROUP])
                    held = held[GROUP:]
                    size = sum(len(p[2] or "") for p in held)
                held.append((page, url, html))
                size += len(html or "")
        if held:
            yield emit(held)

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.select("page_id", "url", "html", "host", "salt").mapInArrow(run, f"page_id {kind}, url string, text string")


def op1_wrapper(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return main_text(pages).withColumn("n_chars", F.length("text").cast("long"))
