"""Main text of web pages by differencing them with their neighbours.

A page is read into lines, one for each block. Pages of a host are put in order of URL
path, and each is paired with the nearest ones before and after it. The lines of a pair
are aligned by longest common subsequence, and what both share is taken for the site's
and deleted. Three things are not left to chance:

* Menus, adverts and footers often rotate their words. A line inside an element that
  names itself as such (``nav``, ``footer``, ``class="ad"``) is aligned by its place in
  the template, and if the neighbour lacks it, it goes all the same. Names that tell a state
  (``with-sidebar``, ``comments-open``) name no such element. Where the only ``article`` or
  ``main`` lies in an element so named, the name is in doubt and neighbours decide instead.
* Pages of a host with the same own lines (mirrors, print views, ``?ref=`` variants) are one
  class. Classes are paired, not pages, so copies never ask each other, however many there
  are and wherever their paths sort; a class stands where its first page does.
* A neighbour that shares at least half of a page's own lines may still be a copy of it, which
  says nothing about the template; the next ones are asked too, and two must agree.
* In an ``article`` or ``main`` element a shared line may be a quote or a repeated passage of
  the author's. It is deleted as well, unless most of the nearest other texts of the host
  lack it or fewer than two have it; near copies among them have one vote together.
* A class or id inside an ``article`` or ``main`` that sounds like no content (``comments``,
  ``related-work``) decides nothing by itself: what it names goes where a neighbour has
  lines in an element of the same names at the same place, or where there is no neighbour.
* Pages without such an element are also compared block by block (a block is what stands
  in one container). A block that has its place and shape, the elements of its lines one by
  one (equal ones in a row count once), in at least half of the neighbours is the template's,
  whatever its words; where most neighbours have their largest block stands the content.

Pairs are found over the lines' hashes alone. A running number over ranges of URLs cuts
the order into even blocks with a margin, so a host with a third of all pages is spread
like any other, and the same pages give the same pairs however they are partitioned.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
import hashlib
import html
from itertools import accumulate
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import strings_of
from gleanery.session import written

BLOCK = 512  # classes of pages in one alignment task
REACH = 4  # neighbouring classes on each side that may be asked
JURY = 16  # neighbouring classes on each side that vote on a shared line of an article

# Elements that hold no text of the page, that begin a new line, that are no
# content wherever they stand, and that close themselves.
DROPPED = frozenset("script style template noscript svg head title iframe canvas audio video select option datalist textarea button".split())
BREAKING = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
CHROME = frozenset("nav aside form footer menu dialog".split())
RAW = frozenset("script style textarea title".split())
CLOSING = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold text as it flows; the other ones that begin a line are containers.
FLOWING = frozenset("address blockquote br center dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr legend li ol p pre summary table tbody tfoot thead tr ul".split())
LEVELS = 6  # containers inside each other that are told apart
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar".split())
#: Parts of a class or id that name what is no content.
CHROME_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disclaimer disqus footer footnav gdpr header masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo promoted promotion related replies reply share sharing sidebar sidenav skip social sponsor sponsored subscribe toolbar topbar widget".split()
)
#: Names of lists that hold articles of their own, so that an article in them says nothing.
LIST_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial comment comments disqus modal popup promo promoted promotion related replies reply sponsor sponsored widget".split()
)
#: In a class or id of several parts: what follows the first kind, or stands before the second at the end, is a state.
STATE_HEADS = frozenset("with has have no not without hide show".split())
STATE_TAILS = frozenset("open opened closed fixed sticky enabled disabled active inactive collapsed expanded visible hidden on off".split())
TITLE_NAMES = frozenset("header banner masthead social share widget".split())
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
SIMPLE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
NAMED = re.compile(r"(?:^|[\s\"'])(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")


@dataclass
class Page:
    lines: list[str] = field(default_factory=list)
    keys: list[str] = field(default_factory=list)  # what a line is aligned by
    chrome: list[bool] = field(default_factory=list)
    rooted: list[bool] = field(default_factory=list)  # inside article, or main where there is no article
    named: list[bool] = field(default_factory=list)  # in the root, and no content by a class or id alone
    chains: list[tuple[int, ...]] = field(default_factory=list)  # the containers around a line, outermost first
    elements: list[str] = field(default_factory=list)  # the innermost element around a line

    def own(self) -> list[int]:
        """Lines that may be text: those of the article or, without one, all that are content."""
        own = [i for i, r in enumerate(self.rooted) if r and (not self.chrome[i] or self.named[i])]
        return own or [i for i, c in enumerate(self.chrome) if not c]

    def blocks(self) -> tuple[list[int], list[int], int]:
        """For a page without a root: the block of each line, a hash of each block's shape, the largest block."""
        level = next((n for n in range(1, LEVELS) if len({c[:n] for c in self.chains}) > 1), LEVELS)
        number = {c: i for i, c in enumerate(dict.fromkeys(c[:level] for c in self.chains))}
        of = [number[c[:level]] for c in self.chains]
        shapes, sizes = [[] for _ in number], [0] * len(number)
        for block, element, line in zip(of, self.elements, self.lines, strict=True):
            if shapes[block][-1:] != [element]:
                shapes[block].append(element)
            sizes[block] += len(line)
        return of, [line_hash(" ".join(x)) for x in shapes], max(range(len(sizes)), key=sizes.__getitem__, default=0)


def _named(value: str) -> set[str]:
    """Parts of a class or id that name the element; those that tell a state of it are left out."""
    out: set[str] = set()
    for name in value.split():
        parts = [p.lower() for p in NAME_PARTS.findall(name)]
        head = next((n for n, p in enumerate(parts) if p in STATE_HEADS), len(parts))
        if len(parts) < 2 or parts[-1] not in STATE_TAILS:
            out.update(parts[:head])
    return out


def _is_chrome(name: str, attributes: str) -> tuple[bool, bool, str]:
    """Whether an element says it is no content, whether that is in doubt if it holds an article, and which class or id alone says so."""
    names, sure = "", name in CHROME
    chrome, doubt = name in CHROME, name == "form" or name not in CHROME
    for key, a, b, c in NAMED.findall(attributes) if attributes else ():
        key, value = key.lower(), a or b or c
        if key == "role":
            if value.strip().lower() in CHROME_ROLES:
                chrome, doubt, sure = True, doubt and name == "form", True
        elif key == "hidden" or key == "aria-hidden":
            if key == "hidden" or value.lower() == "true":
                chrome, doubt, sure = True, False, True
        elif name not in ("html", "body", "main"):
            parts = _named(value) & CHROME_NAMES
            # an article or a heading is seldom called a header or a banner for being one
            if parts - TITLE_NAMES if name in HEADINGS or name == "article" else parts:
                chrome, doubt = True, doubt and not parts & LIST_NAMES
                names = f"{names}.{value}"
    return chrome, chrome and doubt, "" if sure else names


@dataclass
class Chrome:
    """An element that says it is no content."""

    inside: Chrome | None  # the next one around it
    doubt: bool
    named: bool = False  # inside a root, and by a class or id alone
    holds: bool = False  # an article or main

    def undone(self, rooted: bool) -> bool:
        return self.doubt and self.holds and not rooted


def read_page(source: str) -> Page:
    """The lines of a page in order. Broken markup never fails; time is linear in the length."""
    page, pieces = Page(), []
    stack: list[tuple[str, Chrome | None, str, str, tuple[int, ...]]] = []  # name, innermost chrome, root, slot, containers
    containers = 0
    marks: list[Chrome | None] = []
    elements: list[Chrome] = []
    slots: list[str] = []
    pattern, at, size = TAG, 0, len(source)
    roots: list[str] = []
    opened: dict[str, int] = {}
    endless: set[str] = set()

    def end_line() -> None:
        if not pieces:
            return
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            name, chrome, root, slot, chain = stack[-1] if stack else ("", None, "", "", ())
            page.lines.append(text)
            page.elements.append(name)
            page.chains.append(chain)
            marks.append(chrome)
            slots.append(slot)
            roots.append(root)

    while at < size:
        open_ = source.find("<", at)
        if open_ < 0:
            open_ = size
        if open_ > at:
            pieces.append(html.unescape(source[at:open_]))
        if open_ == size:
            break
        if source.startswith("<!--", open_):
            close = source.find("-->", open_ + 2)
            at = size if close < 0 else close + 3
            continue
        if source[open_ + 1 : open_ + 2] in ("!", "?"):
            close = source.find(">", open_)
            at = size if close < 0 else close + 1
            continue
        m = pattern.match(source, open_)
        if m is None and pattern is TAG and SIMPLE_TAG.match(source, open_):
            pattern = SIMPLE_TAG  # a quote that never closes: from here on a tag ends at the next >
            m = pattern.match(source, open_)
        if m is None:
            if source[open_ + 1 : open_ + 2] == "/" or source[open_ + 1 : open_ + 2].isalpha() and source.find(">", open_) < 0:
                close = source.find(">", open_)
                at = size if close < 0 else close + 1  # a bogus end tag, or a tag that the end cuts off
            else:
                pieces.append("<")
                at = open_ + 1
            continue
        closing, name, attributes = m[1], m[2].lower(), m[3]
        at = m.end()
        if name in BREAKING:
            end_line()
        elif name in ("td", "th"):
            pieces.append(" ")
        if closing:
            if opened.get(name):  # what is still open inside it ends with it
                while True:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
        elif name in DROPPED:
            if not attributes.endswith("/") and name not in endless:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                if close:
                    at = close.end()
                elif name in RAW:
                    at = size
                else:
                    endless.add(name)
        elif name in BREAKING and name not in VOID and not attributes.endswith("/"):
            closes = CLOSING if name in CLOSING else ("p",)
            while stack and stack[-1][0] in closes and (stack[-1][0] in ("p", *HEADINGS) or stack[-1][0] == name):
                opened[stack.pop()[0]] -= 1
            _, chrome, root, slot, chain = stack[-1] if stack else ("", None, "", "", ())
            own, doubt, names = _is_chrome(name, attributes)
            if name == "header" and not root and not (own and not doubt):
                own, doubt = True, False
            if name in ("article", "main") and not own:
                if chrome is None:
                    root = "article" if "article" in (name, root) else "main"
                around = chrome
                while around is not None and around.doubt and not around.holds:
                    around.holds, around = True, around.inside
            if own:
                chrome = Chrome(chrome, doubt, bool(names and root))
                elements.append(chrome)
            if name not in FLOWING and name not in ("html", "body") and len(chain) < LEVELS:
                containers += 1
                chain = (*chain, containers)
            # a hash of the names from the outermost chrome on, so that depth takes no room
            slot = hashlib.blake2b(f"{slot}/{name}{names}".encode("utf-8", "replace"), digest_size=8).hexdigest() if chrome else ""
            stack.append((name, chrome, root, slot, chain))
            opened[name] = opened.get(name, 0) + 1
    end_line()
    rooted = any(r and c is None for r, c in zip(roots, marks, strict=True))
    hides: dict[int, bool] = {}
    for e in elements:  # those around an element come before it
        hides[id(e)] = not e.undone(rooted) or e.inside is not None and hides[id(e.inside)]
    surely: dict[int, bool] = {}  # hidden by more than names inside a root
    for e in elements:
        surely[id(e)] = not e.undone(rooted) and not e.named or e.inside is not None and surely[id(e.inside)]
    page.chrome = [c is not None and hides[id(c)] for c in marks]
    page.named = [h and not surely[id(c)] for c, h in zip(marks, page.chrome, strict=True)]
    page.keys = [slot if c else "t:" + line for slot, c, line in zip(slots, page.chrome, page.lines, strict=True)]
    hidden = [c and not n for c, n in zip(page.chrome, page.named, strict=True)]
    best = next((r for r in ("article", "main") if any(x == r and not c for x, c in zip(roots, hidden, strict=True))), None)
    page.rooted = [best is not None and x == best for x in roots]
    return page


def line_hash(key: str) -> int:
    return int.from_bytes(hashlib.blake2b(key.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def common_lines(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of both.

    Equal ends are paired off; between them, candidates are chained by their places in
    ``b``, over all pairs of equal lines. Where lines repeat so often that these pairs are
    many, rows of the classic table are made as bits instead.
    """
    out, lo, end_a, end_b = [], 0, len(a), len(b)
    while lo < min(end_a, end_b) and a[lo] == b[lo]:
        out.append(lo)
        lo += 1
    tail = []
    while end_a > lo and end_b > lo and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
        tail.append(end_a)
    places: dict[int, list[int]] = {}
    for j in range(end_b - 1, lo - 1, -1):  # from the right, so that a line of a is used once
        places.setdefault(b[j], []).append(j)
    pairs = sum(len(places.get(a[i], ())) for i in range(lo, end_a))
    if pairs > 16 * (end_a + end_b - 2 * lo) + 1024:
        return out + [lo + i for i in _common_by_bits(a[lo:end_a], b[lo:end_b])] + tail[::-1]
    tops: list[int] = []  # least place in b that ends a chain of each length
    links: list[tuple[int, object]] = []
    for i in range(lo, end_a):
        for j in places.get(a[i], ()):
            k = bisect_left(tops, j)
            link = (i, links[k - 1] if k else None)
            if k == len(tops):
                tops.append(j)
                links.append(link)
            else:
                tops[k], links[k] = j, link
    chain, link = [], links[-1] if links else None
    while link is not None:
        chain.append(link[0])
        link = link[1]
    return out + chain[::-1] + tail[::-1]


BIT_TABLE = 1 << 26  # bytes of a table of bits that is kept; a larger one is halved first


def _bit_rows(a: Sequence[int], b: Sequence[int], keep: bool) -> list[int]:
    """Rows of the table of common lengths: bit j is 0 where the length rises at b[j]."""
    at: dict[int, int] = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, [full]
    for x in a:
        hit = row & at.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def _lengths(row: int, n: int) -> list[int]:
    """Common lengths with the first 0 to n lines of b."""
    return [0, *accumulate(1 - int(c) for c in f"{row:0{n}b}"[::-1])] if n else [0]


def _common_by_bits(a: Sequence[int], b: Sequence[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) // 8 > BIT_TABLE:
        half = len(a) // 2
        front = _lengths(_bit_rows(a[:half], b, False)[0], len(b))
        back = _lengths(_bit_rows(a[half:][::-1], b[::-1], False)[0], len(b))
        cut = max(range(len(b) + 1), key=lambda j: front[j] + back[len(b) - j])
        return _common_by_bits(a[:half], b[:cut]) + [half + i for i in _common_by_bits(a[half:], b[cut:])]
    rows, out, j = _bit_rows(a, b, True), [], len(b)
    i = len(a)
    while i and j:
        if rows[i] >> (j - 1) & 1:  # no rise at this line of b
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:  # the rise was there a row before
            i -= 1
        else:
            out.append(i - 1)
            i, j = i - 1, j - 1
    return out[::-1]


def shared_with(page: dict, sides: Sequence[Sequence[dict]]) -> set[int]:
    """Lines of a page that its neighbours share; each side has the nearest first.

    The nearest on a side counts. One that shares at least half of the page's own lines may
    be a copy, or both may be little but template: what it shares counts only where a second
    neighbour shares it too, and the next one on the side is asked as well.
    """
    out: set[int] = set()
    times: Counter[int] = Counter()
    own = set(page["own"])
    for others in sides:
        for other in others:
            hit = common_lines(page["keys"], other["keys"])
            times.update(hit)
            if 2 * len(own.intersection(hit)) < len(own):
                out.update(hit)
                break
    return out | {i for i, n in times.items() if n > 1}


def near_copies(a: set[int], b: set[int]) -> bool:
    """Whether more than four fifths of the smaller text's different lines are in the other."""
    small = min(len(a), len(b))
    return small > 0 and 5 * len(a & b) > 4 * small


def template_blocks(page: dict, sides: Sequence[Sequence[dict]]) -> set[int]:
    """Own lines in blocks that most neighbours have at the same place, counted from either end, in the same shape.

    A neighbour whose largest block stands there speaks for content instead. The page's
    own largest block is only taken where another one has that place. Neighbours that share at least half
    of the page's own lines may be copies and have no vote.
    """
    own, shapes = [page["keys"][i] for i in page["own"]], page["shapes"]
    votes, content, voters = Counter(), Counter(), 0
    for other in (o for others in sides for o in others):
        there = other["shapes"]
        lines = set(other["keys"])
        if not there or 2 * sum(k in lines for k in own) >= len(own):
            continue
        voters += 1
        for b, shape in enumerate(shapes):
            places = {p for p in (b, len(there) - len(shapes) + b) if 0 <= p < len(there) and there[p] == shape}
            if other["largest"] in places:
                content[b] += 1
            elif places:
                votes[b] += 1
    main = {b for b, n in content.items() if 2 * n >= voters} or {page["largest"]}
    taken = {b for b, n in votes.items() if 2 * n >= voters} - main
    return {i for i in page["own"] if page["blocks"][i] in taken}


def site_lines(page: dict, sides: Sequence[Sequence[dict]]) -> set[int]:
    """Lines of an article that its nearest neighbours share and at least half of a jury has.

    Near copies of each other, of the page itself too, have one vote together, and two
    votes are needed: what only a copy or a quote has in common stays.
    """
    own = set(page["own"])
    doubtful = {i for others in sides for o in others[:REACH] for i in common_lines(page["keys"], o["keys"])} & own
    if not doubtful:
        return set()
    groups: list[tuple[set[int], set[int]]] = []  # the first text of a group, and all its lines
    for other in (o for others in sides for o in others):
        lines = {other["keys"][i] for i in other["own"]}
        group = next((g for g in groups if near_copies(g[0], lines)), None)
        if group:
            group[1].update(lines)
        elif lines:
            groups.append((lines, set(lines)))
    votes = {i: sum(page["keys"][i] in g for _, g in groups) for i in doubtful}
    return {i for i, n in votes.items() if n > 1 and 2 * n >= len(groups)}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host without user and port, in lower case; and the path with its query. Empty for null."""
    rest = F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"\A[A-Za-z][A-Za-z0-9+.-]*://|\A//", "")
    host = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"\A[^/?#]*", 0), r"\A.*@", ""), r":[0-9]*\z", "")
    return F.lower(host), F.regexp_replace(F.regexp_replace(rest, r"\A[^/?#]*", ""), r"#.*\z", "")


def _keyed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Id, url, html, and a key that only rows equal in all three share."""
    part = lambda c: F.when(c.isNull(), F.lit("-")).otherwise(F.md5(c.cast("string").cast("binary")))
    cols = [F.col(id_col), F.col(url_col), F.col(html_col)]
    key = F.unhex(F.md5(F.concat_ws(",", *map(part, cols)).cast("binary")))
    return pages.select(cols[0].alias("id"), cols[1].cast("string").alias("url"), cols[2].cast("string").alias("html"), key.alias("page_key"))


def _outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        pages = [read_page(x or "") for x in strings_of(b, "html")]
        keys = [[line_hash(k) for k in p.keys] for p in pages]
        own = [p.own() for p in pages]
        names = [",".join((h, str(any(p.rooted)), *(str(k[i]) for i in o))) for h, p, k, o in zip(strings_of(b, "host"), pages, keys, own, strict=True)]
        classes = [hashlib.blake2b(n.encode("utf-8", "replace"), digest_size=16).digest() for n in names]
        yield pa.RecordBatch.from_arrays(
            [b.column("host"), b.column("path"), b.column("page_key"), pa.array(classes, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(own, pa.list_(pa.int32())), pa.array([any(p.rooted) for p in pages]),
             pa.array([[i for i in o if p.named[i]] for p, o in zip(pages, own, strict=True)], pa.list_(pa.int32())),
             *(pa.array(c, t) for c, t in zip(zip(*[([], [], 0) if any(p.rooted) else p.blocks() for p in pages], strict=True) if pages else ([], [], []), (pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int32()), strict=True))],
            names=["host", "path", "page_key", "class", "keys", "own", "rooted", "named", "blocks", "shapes", "largest"],
        )


OUTLINE = "host string, path string, page_key binary, class binary, keys array<bigint>, own array<int>, rooted boolean, named array<int>, blocks array<int>, shapes array<bigint>, largest int"
#: What goes to the comparison beside the order.
COMPARED = ("keys", "own", "rooted", "named", "blocks", "shapes", "largest")


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks arrive whole and in order; each class is compared with those around it."""

    def done(rows: list[dict]) -> pa.RecordBatch:
        out = []
        for i, row in enumerate(rows):
            if row["margin"]:
                continue
            before = [r for r in rows[max(0, i - JURY) : i][::-1] if r["host"] == row["host"]]
            after = [r for r in rows[i + 1 : i + 1 + JURY] if r["host"] == row["host"]]
            gone = shared_with(row, (before[:REACH], after[:REACH]))
            if row["rooted"]:
                gone = gone.difference(row["own"]) | site_lines(row, (before, after))
                near = [set(r["keys"]) for r in (*before[:REACH], *after[:REACH])] if row["named"] else []
                gone.update(i for i in row["named"] if not near or any(row["keys"][i] in r for r in near))
            else:
                gone |= template_blocks(row, (before[:REACH], after[:REACH]))
            rest = sorted(set(range(len(row["keys"]))).difference(row["own"]))
            out.append((row["class"], [n for n, line in enumerate(row["own"] + rest) if line in gone]))
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([s for _, s in out], pa.list_(pa.int32()))], names=["class", "shared"])

    held: list[dict] = []
    for b in batches:
        for row in b.to_pylist():
            if held and held[0]["block"] != row["block"]:
                yield done(held)
                held = []
            held.append(row)
    if held:
        yield done(held)


def shared_lines(pages: DataFrame) -> DataFrame:
    """``page_key`` and the numbers of the lines shared with neighbours, for each different row.

    Own lines are numbered from 0, the same in all pages of a class. Numbers after those
    count what else the first page of the class has, which is no text anyway.
    """
    host, path = host_and_path(F.col("url"))
    outlines = pages.withColumn("host", host).withColumn("path", path).select("html", "host", "path", "page_key").mapInArrow(_outline, OUTLINE)
    outlines = written(outlines, "html-outlines")
    # copies of a class meet before the shuffle, and the one that comes first stands for all
    first = outlines.groupBy("class").agg(F.min(F.struct("host", "path", "page_key", *COMPARED)).alias("page")).select("class", "page.*")
    order = ["host", "path", "page_key"]
    # the high bits of such an id are the partition, the low bits the place in it
    numbered = first.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    part, inside = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    ranges = written(numbered.select(part.alias("part"), inside.alias("inside"), "host", "class", *COMPARED), "html-order")
    counts = ranges.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))  # one row for each range
    placed = ranges.join(F.broadcast(offsets), "part").withColumn("place", F.col("offset") + F.col("inside")).drop("part", "offset", "inside")
    home = F.floor(F.col("place") / BLOCK)
    asks = F.sequence(F.floor((F.col("place") - JURY) / BLOCK), F.floor((F.col("place") + JURY) / BLOCK))
    spread = placed.select("*", home.alias("home"), F.explode(asks).alias("block")).withColumn("margin", F.col("block") != F.col("home"))
    dealt = spread.repartition("block").sortWithinPartitions("block", "place")
    found = dealt.select("block", "margin", "host", "class", *COMPARED).mapInArrow(_aligned, "class binary, shared array<int>")
    return outlines.select("page_key", "class").join(found.filter(F.size("shared") > 0), "class").select("page_key", "shared").dropDuplicates(["page_key"])


def main_text(source: str | None, shared: Sequence[int] | None) -> str:
    """What is left of a page: of its article or, without one, of all content, the lines that are not the site's.

    Null for ``shared`` says that the page was not compared; then names decide what they can.
    """
    page = read_page(source or "")
    own = page.own()
    gone = {n for n, i in enumerate(own) if page.named[i]} if shared is None else set(shared)
    return "\n".join(page.lines[i] for n, i in enumerate(own) if n not in gone)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every row: id, url, ``text`` and ``n_chars`` (code points).

    White space inside a line is one space, lines are joined by a line feed. A null or
    empty html, or a page of boilerplate only, has an empty text. Bytes that are no UTF-8
    become U+FFFD. Pages with a null or
    hostless url are neighbours of each other. Rows equal in id, url and html are one
    page for pairing and each get their row. Other columns are not looked at.
    """
    keyed = _keyed(pages, id_col, url_col, html_col)
    found = written(shared_lines(keyed), "html-shared")
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h, s) for h, s in zip(strings_of(b, "html"), b.column("shared").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["id", "url", "text", "n_chars"])

    joined = keyed.join(found, "page_key", "left").select("id", "url", "html", F.coalesce("shared", F.array().cast("array<int>")).alias("shared"))
    return joined.mapInArrow(run, f"id {kind}, url string, text string, n_chars bigint").withColumnRenamed("id", id_col)
