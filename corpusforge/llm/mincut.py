"""Main text of web pages by minimum-cut labelling (operator 5).

A page is read into text blocks with the elements around them.  A small classifier turns
each block's cues (region elements, class words, link share, length, punctuation) into two
costs: being called content and being called boilerplate.  The costs are the capacities of
the block's arcs to the two terminals; neighbouring blocks and blocks of one container are
tied by smoothness arcs.  The minimum cut is the cheapest labelling, and the content blocks in
page order are the text.

Pages are independent, so the job is one narrow pass without a shuffle.

Defined cases: null or empty html gives an empty text; markup that never closes is closed by
the end of the page; repeated rows are extracted alike; an empty table gives no rows; extra
columns are kept unless they clash with the two results.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_QUOTED_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_QUOTES = re.compile(r"\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:@][-\w:.@]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIP = frozenset("script style noscript template title svg math iframe object audio video canvas textarea select "
                  "button datalist".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
                   "nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
_CLOSES_P = _BLOCK - frozenset("body head html caption td th tr tbody thead tfoot option optgroup legend".split())
_P_SCOPE = frozenset("p table td th caption".split())
_CLOSED_BY = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
              "tr": ("tr", ("table",)), "td": ("td th", ("table", "tr")), "th": ("td th", ("table", "tr")),
              "option": ("option", ("select",))}
_REGION = frozenset("nav footer aside form header menu dialog fieldset".split())
_CONTENT_TAGS = frozenset("article main".split())
_BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie "
    "cookies consent notice notices gdpr popup modal overlay sidebar rail widget widgets nav navbar navigation menu "
    "breadcrumb breadcrumbs footer header masthead topbar toolbar comment comments commentlist reply replies respond "
    "disqus discussion related recommended recommendations share sharing social follow subscribe subscription "
    "newsletter signup login search pagination pager copyright legal disclaimer skip alert outbrain taboola".split())
_COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
_GOOD_WORDS = frozenset("article content main post entry story articlebody prose text".split())
_BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())


class _Element:
    """An open element.  ``holder``: the nearest block element, itself included; ``near_p``: likewise the
    nearest paragraph or table part; ``bad``: likewise the nearest boilerplate region, a chain by ``bad_up``."""
    __slots__ = ("tag", "number", "up", "holder", "near_p", "bad", "bad_up", "good", "link", "comment", "soft", "holds_main", "hard")

    def __init__(self, tag: str, number: int, up: "_Element | None"):
        self.tag, self.number, self.up = tag, number, up
        self.holder: _Element = self if up is None or tag in _BLOCK else up.holder
        self.near_p: _Element | None = self if tag in _P_SCOPE else up.near_p if up else None
        self.bad: _Element | None = up.bad if up else None
        self.bad_up: _Element | None = None
        self.hard: bool | None = None
        self.good = up.good if up else 0
        self.link = (up.link if up else False) or tag == "a"
        self.comment = self.soft = self.holds_main = False


class _Block:
    __slots__ = ("text", "chars", "linked", "tag", "parent", "bad", "good")

    def __init__(self, text, linked, tag, parent, bad, good):
        self.text, self.chars, self.linked = text, len(text), linked
        self.tag, self.parent, self.bad, self.good = tag, parent, bad, good


def _cues(e: _Element, attrs: str) -> bool:
    """Mark the element's region; True if its content is never shown."""
    bad = e.tag in _REGION
    if e.tag in _CONTENT_TAGS:
        e.good += 1
    if attrs and "=" in attrs or "hidden" in attrs:
        low = attrs.lower()
        if re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", low) or "display:none" in low.replace(" ", ""):
            return True
        if e.tag not in ("html", "body"):
            words: set[str] = set()
            for m in _ATTR.finditer(attrs):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name in ("class", "id"):
                    words.update(x.lower() for x in _PARTS.findall(value))
                elif name == "role":
                    bad = bad or value.lower() in _BAD_ROLES
                    if value.lower() in ("main", "article"):
                        e.good += 1
            if words & _BAD_WORDS:
                e.soft = not bad
                bad = True
                e.comment = bool(words & _COMMENT_WORDS)
            elif words & _GOOD_WORDS:
                e.good += 1
    if bad:
        e.bad_up, e.bad = e.bad, e
    if (e.tag in _CONTENT_TAGS or e.tag == "h1") and not bad:
        x = e.up
        while x is not None and not x.holds_main:           # what is above a marked element is marked
            x.holds_main = True
            x = x.up
    return False


def _is_hard(x: _Element | None) -> bool:
    """Whether a region around is boilerplate whatever it holds; kept at the elements, once a page is read."""
    chain = []
    while x is not None and x.hard is None:
        chain.append(x)
        x = x.bad_up
    hard = x.hard if x is not None else False
    for x in reversed(chain):
        hard = x.hard = hard or not (x.soft and x.holds_main) or x.comment
    return hard


class _Tags:
    """The markup of a page from left to right, each character read a bounded number of times."""

    def __init__(self, page: str):
        self.page, self.end = page, page.rfind(">") + 1     # no tag ends behind the last >
        self.starts: list[int] = []                         # quoted spans behind the last tag whose quotes don't close
        self.ends: list[int] = []
        self.since = self.upto = -1

    def next(self, at: int) -> re.Match | None:
        m = _MARKUP.search(self.page, at, self.end) if at < self.end else None
        if m is None or not m[2] or not ('"' in m[0] or "'" in m[0]):
            return m
        begin = m.end(2)
        if self._fails(begin):
            return m
        quoted = _QUOTED_TAG.match(self.page, m.start(), self.end)
        if quoted is None:
            spans = [q.span() for q in _QUOTES.finditer(self.page, begin, self.end)]
            self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]
            self.since, self.upto = begin, self.end
            if spans and spans[-1][1] == self.end:          # the last one may never close
                self.upto = spans[-1][0]
        return quoted or m

    def _fails(self, at: int) -> bool:
        """Whether a scan from ``at`` meets the last failed one outside quotes, and so fails too."""
        if not self.since <= at < self.upto:
            return False
        i = bisect_right(self.starts, at) - 1
        return i < 0 or at >= self.ends[i] or at == self.starts[i]


def read_blocks(page: str) -> list[_Block]:
    """Text blocks of a page in order, with the cues of the elements around them."""
    blocks: list[_Block] = []
    stack: list[_Element] = [_Element("", 0, None)]
    opened: dict[str, int] = {}
    number, at, n = 0, 0, len(page)
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                holder = stack[-1].holder
                blocks.append(_Block(text, min(linked, len(text)), holder.tag, (holder.up or holder).number, holder.bad,
                                     holder.good))
        pieces, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            if "&" in text:
                text = _html.unescape(text)
            pieces.append(text)
            if stack[-1].link:
                linked += len(text.strip())

    def close(tag: str) -> None:
        while True:
            x = stack.pop()
            opened[x.tag] -= 1
            if x.tag == tag:
                return

    tags = _Tags(page)
    while at < n:
        m = tags.next(at)
        if not m:                                           # no tag follows; comments and CDATA may
            for part in page[at:].split("<!--", 1)[0].split("<![CDATA["):
                add(part)
            break
        add(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = n                                      # never closed
            continue
        if m[1]:                                            # an end tag
            if tag in _BLOCK:
                flush()
            if tag == "br":
                pieces.append(" ")
            elif opened.get(tag, 0):
                close(tag)
            continue
        attrs = m[3]
        if tag in _BLOCK:
            flush()
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in _VOID:
            continue
        if tag in _SKIP:
            if not attrs.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if tag in _CLOSES_P and opened.get("p", 0):
            if stack[-1].near_p is not None and stack[-1].near_p.tag == "p":
                close("p")
        elif tag in _CLOSED_BY:
            like, stop = _CLOSED_BY[tag]
            like = [x for x in like.split() if opened.get(x, 0)]
            for x in reversed(stack) if like else ():
                if x.tag in like:
                    close(x.tag)
                    break
                if x.tag in stop:
                    break
        elif tag == "body" and opened.get("head", 0):
            close("head")
        number += 1
        e = _Element(tag, number, stack[-1])
        if _cues(e, attrs):                          # never shown: jump behind its end tag
            at = _behind(page, at, tags.end, tag)
            continue
        if not attrs.endswith("/") or tag in _BLOCK:
            stack.append(e)
            opened[tag] = opened.get(tag, 0) + 1
    flush()
    return blocks


def _behind(page: str, at: int, end: int, tag: str) -> int:
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I).finditer(page, at, end):
        depth += -1 if m[1] else 1
        if not depth:
            return m.end()
    return len(page)


def score(b: _Block) -> int:
    """Content minus boilerplate evidence of one block, in units of the smoothness arcs."""
    s = -3
    if _is_hard(b.bad):
        s -= 24
    s += 9 * min(b.good, 2)
    words = b.text.count(" ") + 1
    s += min(6, words // 5)
    share = b.linked / b.chars if b.chars else 0
    s -= round(8 * share) if words < 40 else round(4 * share)
    if b.text[-1] in ".!?。…\"”":
        s += 2
    if b.tag == "p" or b.tag in ("blockquote", "pre"):
        s += 2
    elif b.tag in ("h1", "h2", "h3"):
        s += 2
    elif b.tag == "li" and share > 0.5:
        s -= 3
    if ("©" in b.text or "all rights reserved" in b.text.lower()) and not b.good:
        s -= 8
    return s


def smoothness(blocks: list[_Block]) -> list[tuple[int, int, int]]:
    """Arcs ``(i, j, capacity)``: page neighbours, and neighbours among the blocks of one container."""
    arcs, last = [], {}
    for i, b in enumerate(blocks):
        region = b.bad.number if b.bad else 0
        if i:
            a = blocks[i - 1]
            if region == (a.bad.number if a.bad else 0):
                arcs.append((i - 1, i, 3 if a.parent == b.parent else 1))
        j = last.get((b.parent, region))
        if j is not None and j != i - 1:
            arcs.append((j, i, 2))
        last[b.parent, region] = i
    return arcs


def min_cut(costs: list[int], arcs: list[tuple[int, int, int]]) -> list[bool]:
    """Cheapest labelling: block i pays ``max(0, -costs[i])`` as content and ``max(0, costs[i])``
    as boilerplate, and an arc its capacity where it joins unlike labels.  True is content; of
    equally cheap cuts the one with least content is returned.

    Blocks whose own cost is beyond all their arcs together are settled first and folded into
    the terminals; the rest is cut by maximum flow along shortest augmenting paths.
    """
    n = len(costs)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for i, j, c in arcs:
        near[i][j] = near[i].get(j, 0) + c
        near[j][i] = near[j].get(i, 0) + c
    costs, label = list(costs), [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is None and (costs[i] > sum(near[i].values()) or -costs[i] >= sum(near[i].values())):
            label[i] = costs[i] > 0
            for j, c in near[i].items():
                costs[j] += c if label[i] else -c
                del near[j][i]
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        flow_cut(rest, costs, near, label)
    return [bool(x) for x in label]


def flow_cut(rest: list[int], costs: list[int], near: list[dict[int, int]], label: list) -> None:
    """Maximum flow from the content terminal (-1) to the boilerplate terminal (-2)."""
    cap: dict[int, dict[int, int]] = {i: dict(near[i]) for i in rest}
    cap[-1] = {i: costs[i] for i in rest if costs[i] > 0}
    cap[-2] = {}
    for i in rest:
        cap[i][-1] = 0
        cap[i][-2] = max(0, -costs[i])
        cap[-2][i] = 0
    while True:
        via, queue = {-1: None}, deque([-1])
        while queue and -2 not in via:
            x = queue.popleft()
            for y, c in cap[x].items():
                if c > 0 and y not in via:
                    via[y] = x
                    queue.append(y)
        if -2 not in via:
            break
        path, y = [], -2
        while via[y] is not None:
            path.append((via[y], y))
            y = via[y]
        push = min(cap[x][y] for x, y in path)
        for x, y in path:
            cap[x][y] -= push
            cap[y][x] = cap[y].get(x, 0) + push
    for i in rest:
        label[i] = i in via


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = read_blocks(page)
    keep = min_cut([score(b) for b in blocks], smoothness(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without its ``html`` column, plus ``text`` and ``n_chars`` (code points)."""
    names = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    chosen = pages.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{html}`").alias("_html"))
    out = StructType(chosen.drop("_html").schema.fields[:]).add("text", StringType()).add("n_chars", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                b.columns[:-1] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=b.schema.names[:-1] + ["text", "n_chars"])

    return chosen.mapInArrow(run, out)
