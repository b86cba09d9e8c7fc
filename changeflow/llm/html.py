"""Operator 7: main text of web pages, with a suffix array over each host's token streams.

Method: a page is read into blocks of words with their place: inside the article (``article``, ``main``),
in an element that never holds main text (menus, headers, footers, sidebars, notices, adverts, forms,
comments, scripts, styles), or elsewhere. Elements end where HTML says so, end tags left out included.
Class names mark an element for certain when they name nothing else (``ad``, ``ad-slot``), and weakly when
another word stands beside the mark (``social-history``). A form or an element with a compound name
(``search-page``) can be what a page's only article stands in: then the article goes out. Where a page has
nothing else, so does what stands in such a wrapper. In articles, code keeps its classes, cells and inline
elements may be named by their subject, and what is named as something to press has to hold a link or button.

All blocks of a page, articles included, are its token stream. The streams of a host are concatenated and
their suffixes sorted, with the lengths of common prefixes (LCP). From them come the maximal repeats of
``LONG`` words and more on ``SPREAD`` distinct pages, and how many distinct pages hold a block as a whole.
Near copies of a page count as one with it: pages whose windows have the same ``KIN`` minima. Then

- weakly marked blocks go if they stand on ``SPREAD`` distinct pages or repeats cover them, and stay otherwise;
- blocks at the beginning or end of an article go if they stand whole in articles of over half of the host's
  distinct pages with one (``NOTICE`` at least, in most shards): notices that no mark tells. What is between them is the
  article's core and stays, passages that other pages share included; an article of such blocks only stays whole;
- on a page without an article, covered words of the blocks elsewhere go; if that would be over half of
  them, the page is a copy and stays whole.

Menus, adverts and footers that differ from page to page repeat nowhere, so no suffix array can find them:
for these the marks of the markup decide.

Distribution: 32-bit word hashes are shuffled once, by host. A host is cut by a hash into shards of ``SHARD``
characters of html, with a suffix array each. Shards of one host vote on notices, and exchange hashes of the
blocks and windows outside the articles' cores with the pages they stand on, so that a repeat across shards
counts as one inside does. The pages are read again for the output, and meet their cuts by the hash of the
row and their host's notices. Shuffled streams leave the disk as soon as all shards have told what they hold,
before evidence is shuffled. A task holds one shard, and at least one page.

Defined results: null or empty html gives the empty text; a null url belongs to the host ''; unclosed
elements end with their parent, unclosed comments, scripts and styles with the page; broken character
references stay as they are; very long pages are read whole, in time linear in their length; rows that
repeat come out as often and do not make each other boilerplate (they are one page); ties cannot occur, for
counts and lengths alone decide; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import map_rows, settled

#: Repeated substrings of so many words are boilerplate; characters of html in a shard.
LONG, SHARD = 8, 1 << 19
#: Distinct pages on which a repeat has to stand, least ones for a notice in articles, and minima that near copies share.
SPREAD, NOTICE, KIN = 3, 5, 3
#: Rows, and numbers in them, that are broadcast at most.
MOST_BROADCAST, MOST_NUMBERS = 200_000, 4_000_000

#: Elements that never hold main text (fixed values).
NEVER = frozenset("nav header footer aside form script style noscript template iframe button select option textarea dialog menu svg math canvas object audio video head title datalist map".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Start tags that end an open paragraph (fixed values).
ENDS_P = frozenset("address article aside blockquote center details dialog div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements beyond which no end tag reaches.
SCOPE = frozenset("caption table td template th object html".split())
TABLE = frozenset("caption colgroup table tbody td tfoot th thead tr".split())
#: The elements that a start tag ends, and those beyond which it does not reach (fixed values).
ENDS = {
    "li": (("li",), ("ol", "ul", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "tr": (("tr",), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "caption"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "caption"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "caption"), ("table",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
}
#: Words of class and id names that mark what is not main text: our own choice of what sites call such things.
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising alert alerts announcement banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toast toolbar widget widgets".split()
)
#: Words beside a mark that name no content, our own choice likewise.
GENERIC = frozenset(
    "area articles bar block body bottom box btn button buttons center col column container content desktop element fixed form global group head heading icon icons inline inner item items left link links list main message messages mobile module outer page pane panel placeholder policy post posts right row section side site slot space sticky stories story text thread title top unit user view wrap wrapper zone".split()
)
#: Whole class names that make an article element a part of something else.
CARDS = frozenset("ad advert card comment promo related reply sidebar sponsored teaser widget".split())
#: Marks of things to press, which hold a link or a button; and marks that also name what cells and inline text are about.
PRESSED = frozenset("like menu navigation pager pagination search share sharing social toolbar".split())
SUBJECTS = PRESSED | frozenset("alert alerts announcement banner comment comments copyright disclaimer header notice notices promotion related replies reply".split())
CELLS = frozenset("td th caption".split())
#: Characters after a start tag among which the link or button stands.
AHEAD = 4096
_PRESS = re.compile(r"<(?:a|button|input|select|svg|img)(?=[\s/>])", re.I)
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_MAIN = re.compile(r"""(?:^|\s)(?:role\s*=\s*["']?main\b|itemprop\s*=\s*["']?articleBody\b)""", re.I)
_PIECES = re.compile(r"[_\-]+")
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"

#: Where a block stands: in an article, elsewhere, where no text goes out, in an article in a wrapper that is marked, in such a wrapper.
MAIN, OTHER, OUT, LIFTED, HELD = range(5)
UNMARKED, WEAK, WRAPPER, STRONG = range(4)


def _pressable(html: str, at: int, name: str) -> bool:
    """Whether the element that begins at a place has something to press, among its first characters."""
    depth, end = 1, min(len(html), at + AHEAD)
    for m in re.compile(f"<(/?){re.escape(name)}(?=[\\s/>])", re.I).finditer(html, at, end):
        depth += -1 if m[1] else 1
        if not depth:
            end = m.start()
            break
    return _PRESS.search(html, at, end) is not None


def mark_of(name: str, attributes: str, pressable: Callable[[], bool] | None = None, code: bool = False) -> int:
    """How surely an element's name or attributes say that it holds no main text.

    WRAPPER: it may be what a whole page stands in, as forms and ``search-page`` are. ``pressable`` is given
    within an article, where class names are trusted less: cells and inline elements are named by their
    subject, and what is to press but has nothing to press is weakly marked. In ``code`` classes name parts of speech.
    """
    if name in NEVER:
        return WRAPPER if name == "form" else STRONG
    if not attributes or name in ("html", "body", "main"):
        return UNMARKED
    found = UNMARKED
    inline = name in CELLS or name not in BLOCK

    def trusted(marks: set[str], mark: int) -> int:
        """What is left of a mark that only class names give."""
        if code or inline and marks <= SUBJECTS:
            return UNMARKED
        return WEAK if pressable is not None and marks <= PRESSED and not pressable() else mark

    for m in _ATTRIBUTE.finditer(attributes):
        key = m[1].lower()
        value = (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            for token in value.split():
                if name == "article":
                    if token in CARDS:
                        found = max(found, WRAPPER if token == "card" else STRONG)
                elif token in MARKED:
                    found = max(found, trusted({token}, STRONG))
                elif "-" in token or "_" in token:
                    parts = [p for p in _PIECES.split(token) if p]
                    marks = [p in MARKED and before not in ("has", "with", "no", "without") for before, p in zip(["", *parts], parts)]
                    if any(marks):
                        found = max(found, trusted({p for p, on in zip(parts, marks) if on}, WRAPPER if all(on or p in GENERIC for on, p in zip(marks, parts)) else WEAK))
        elif key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return STRONG
        elif key == "style" and "display:none" in value.replace(" ", ""):
            return STRONG
    return found


def _is_main(name: str, attributes: str) -> bool:
    """Whether an element is the article or the part of the page that holds it."""
    return name in ("article", "main") or bool(attributes) and _MAIN.search(attributes) is not None


def _tag_end(html: str, at: int, unclosed: dict[str, bool]) -> int:
    """The place of the ``>`` that ends the tag at ``at``; quoted ones do not, unless their quote stays open."""
    while True:
        end = html.find(">", at)
        if end < 0:
            return -1
        quotes = [(q, i) for q in "\"'" if not unclosed[q] and (i := html.find(q, at, end)) >= 0]
        if not quotes:
            return end
        quote, i = min(quotes, key=lambda x: x[1])
        if html[at:i].rstrip()[-1:] != "=":  # a stray quote
            at = i + 1
            continue
        close = html.find(quote, i + 1)
        if close < 0:
            unclosed[quote] = True
            continue
        at = close + 1


class _Open:
    """The open elements, with the depth of the last one of each name, so that no question walks the stack."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, tuple[int, ...]]] = []
        self.of: dict[str, list[int]] = {}
        self.scopes: list[int] = []

    def push(self, name: str, state: tuple[int, ...]) -> None:
        self.of.setdefault(name, []).append(len(self.stack))
        if name in BLOCK:
            self.of.setdefault("", []).append(len(self.stack))
        if name in SCOPE:
            self.scopes.append(len(self.stack))
        self.stack.append((name, state))

    def last(self, name: str) -> int:
        depths = self.of.get(name)
        return depths[-1] if depths else -1

    def cut(self, depth: int) -> tuple[int, ...]:
        """Ends the element at ``depth`` and all in it; the state before it."""
        while len(self.stack) > depth:
            name, state = self.stack.pop()
            self.of[name].pop()
            if name in BLOCK:
                self.of[""].pop()
            if name in SCOPE:
                self.scopes.pop()
        return state

    def starts(self, name: str) -> int:
        """The depth of the outermost element that a start tag ends, or -1."""
        found, scope = -1, self.scopes[-1] if self.scopes else -1
        if name in ENDS:
            ended, bounds = ENDS[name]
            bound = max(self.last(b) for b in bounds) if name in TABLE else max(scope, *[self.last(b) for b in bounds])
            depths = [d for e in ended if (d := self.last(e)) > bound]
            found = min(depths, default=-1)
        if name in ENDS_P and (p := self.last("p")) > scope and (found < 0 or p < found):
            found = p
        if found < 0 and name in HEADINGS and self.stack and self.stack[-1][0] in HEADINGS:
            found = len(self.stack) - 1
        return found

    def ends(self, name: str) -> int:
        """The depth of the element that an end tag ends, or -1."""
        depth = self.last(name)
        if depth < 0:
            return -1
        if name in BLOCK or name in NEVER:
            bound = self.last("table") if name in TABLE and name != "table" else -1 if name == "table" or not self.scopes or name in SCOPE else self.scopes[-1]
            if name == "li":
                bound = max(bound, self.last("ul"), self.last("ol"))
            return depth if depth > bound else -1
        return depth if depth > self.last("") else -1  # an inline element does not end blocks in it


def blocks_of(html: str | None) -> list[tuple[list[str], int, bool]]:
    """The words of each block that has any, with where it stands, and whether it is weakly marked, in page order."""
    html = html or ""
    out: list[tuple[list[str], int, bool]] = []
    pieces: list[str] = []
    opened = _Open()
    # Open articles, elements that hold no main text, marked wrappers, those of them around the outermost article, weak marks.
    state = main, banned, wraps, around, weak = (0,) * 5
    unclosed = {'"': False, "'": False}

    def flush() -> None:
        if pieces:
            words = "".join(pieces).split()
            pieces.clear()
            if words:
                if banned or main and wraps > around:
                    place = OUT
                elif main:
                    place = LIFTED if around else MAIN
                else:
                    place = HELD if wraps else OTHER
                out.append((words, place, weak > 0))

    def text(a: int, b: int) -> None:
        if b > a:
            t = html[a:b]
            pieces.append(unescape(t) if "&" in t else t)

    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            text(at, n)
            break
        after = html[lt + 1 : lt + 2]
        if after == "!" or after == "?":
            text(at, lt)
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            else:
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        closing = after == "/"
        m = _NAME.match(html, lt + 1 + closing)
        if not m:
            text(at, lt + 1)  # an ordinary sign
            at = lt + 1
            continue
        text(at, lt)
        end = _tag_end(html, m.end(), unclosed)
        if end < 0:
            break  # a tag that never ends
        name = m[0].lower()
        at = end + 1
        if name in BLOCK or name in NEVER:
            flush()
        depth = opened.ends(name) if closing else opened.starts(name)
        if depth >= 0:
            state = opened.cut(depth)
            if state != (main, banned, wraps, around, weak):
                flush()
                main, banned, wraps, around, weak = state
        if closing or name in VOID:
            continue
        attributes = html[m.end() : end]
        if attributes.endswith("/") and name not in BLOCK and name not in RAW:
            continue  # self-closed
        if name in RAW:
            low = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(html, at)
            if low is None:
                break
            at = html.find(">", low.end())
            at = n if at < 0 else at + 1
            continue
        mark = mark_of(name, attributes, partial(_pressable, html, at, name) if main else None, max(opened.last("pre"), opened.last("code")) >= 0)
        is_main = mark != STRONG and _is_main(name, attributes)
        opened.push(name, (main, banned, wraps, around, weak))
        if mark or is_main:
            flush()
            banned += mark == STRONG
            wraps += mark == WRAPPER
            weak += mark == WEAK
            if is_main and not main:
                around = wraps
            main += is_main
    flush()
    return out


#: What a block of a stream is: text of the article, weakly marked text of it, text of a page without one, weakly marked text of that, and what never goes out.
CORE, WEAK_CORE, OPEN, WEAK_OPEN, EVIDENCE = range(5)


def split_page(html: str | None) -> tuple[list[list[str]], list[int], list[list[str]]]:
    """(blocks that may go out, what each is, the other blocks)."""
    blocks = blocks_of(html)
    words = [sum(len(b) for b, p, _ in blocks if p == place) for place in range(5)]
    if words[MAIN]:
        place = MAIN
    elif words[LIFTED] and words[LIFTED] >= words[OTHER]:  # a page whose article stands in a form or a marked wrapper
        place = LIFTED
    else:
        place = OTHER if words[OTHER] else HELD
    first = CORE if place in (MAIN, LIFTED) else OPEN
    return [b for b, p, _ in blocks if p == place], [first + w for _, p, w in blocks if p == place], [b for b, p, _ in blocks if p != place]


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The beginnings of all suffixes in order, and the length of the prefix that each has in common with the one before it.

    Prefix doubling until all ranks differ; the ranks of each doubling give the common prefixes. The last
    token must stand nowhere else.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int32)
    levels, step = [rank], 1
    while n and int(rank.max()) < n - 1:
        # Beyond the end of the stream the next rank is below all others.
        nxt = np.zeros(n, np.int64)
        nxt[: max(0, n - step)] = rank[step:].astype(np.int64) + 1
        rank = np.unique(rank.astype(np.int64) * (n + 1) + nxt, return_inverse=True)[1].astype(np.int32)
        levels.append(rank)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(n, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        same = (a < n) & (b < n) & (level[np.minimum(a, n - 1)] == level[np.minimum(b, n - 1)])
        # A rank holds fewer than 2^k tokens at the stream's end, where it is single: so equal ones are whole.
        a[same] += 1 << k
        b[same] += 1 << k
        common[1:][same] += 1 << k
    return order, common


def repeats(order: np.ndarray, common: np.ndarray, owner: np.ndarray, counts: np.ndarray, least: int, long: int = LONG) -> np.ndarray:
    """For each token the length of the longest substring from it on that begins at suffixes of ``least`` owners, if it is ``long`` at least, else 0.

    ``owner`` and ``counts`` (whether its suffix takes part) are by token.
    """
    out = np.zeros(len(order), np.int64)
    at = np.flatnonzero(counts[order])
    if len(at) < least:
        return out
    lcp = np.minimum.reduceat(np.r_[common, 0], np.r_[0, at[:-1] + 1])  # between suffixes that take part
    order = order[at]
    run = np.cumsum(lcp < long)
    size = np.bincount(run, minlength=run[-1] + 1)
    some = np.flatnonzero(size[run] >= least)
    if not len(some):
        return out
    order, lcp, own = order[some], np.where(np.r_[True, run[some][1:] != run[some][:-1]], 0, lcp[some]).tolist(), owner[order[some]].tolist()
    n, best, seen = len(own), [0] * len(own), {}
    lows: list[int] = []  # places of rising LCPs in the window, from ``head`` on
    a = head = 0
    for b in range(n):
        if lcp[b] == 0:
            seen, lows, a, head = {}, [], b, 0
        seen[own[b]] = seen.get(own[b], 0) + 1
        while len(lows) > head and lcp[lows[-1]] >= lcp[b]:
            lows.pop()
        lows.append(b)
        while seen[own[a]] > 1 or len(seen) > least:  # the shortest window that ends here
            seen[own[a]] -= 1
            if not seen[own[a]]:
                del seen[own[a]]
            a += 1
        while lows[head] <= a and head < len(lows) - 1:
            head += 1
        if len(seen) >= least and lows[head] > a:
            best[b] = lcp[lows[head]]
    for b in range(1, n):
        best[b] = max(best[b], min(best[b - 1], lcp[b]))
    for b in range(n - 2, -1, -1):
        best[b] = max(best[b], min(best[b + 1], lcp[b + 1]))
    found = np.array(best, np.int64)
    out[order] = np.where(found >= long, found, 0)
    return out


def standings(order: np.ndarray, common: np.ndarray, begin: np.ndarray, size: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """On how many owners each block stands as a whole; blocks are given by begin, size (end mark included) and owner."""
    if not len(begin):
        return np.empty(0, np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    by = np.argsort(place[begin], kind="stable")
    between = np.minimum.reduceat(np.r_[common, 0], place[begin[by]] + 1)
    same = np.r_[False, between[:-1] >= size[by][:-1]]
    group = np.cumsum(~same)
    pairs = np.unique(np.stack([group, owner[by]], 1), axis=0)
    out = np.empty(len(begin), np.int64)
    out[by] = np.bincount(pairs[:, 0], minlength=group[-1] + 1)[group]
    return out


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(tokens: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the LONG tokens from each one on (of fewer at the end)."""
    t = _mixed(tokens)
    out, factor = np.zeros(len(t), np.uint64), np.uint64(1)
    for k in range(min(LONG, len(t))):
        out[: len(t) - k] += t[k:] * factor
        factor = np.uint64((int(factor) * int(_FACTOR)) % 2**64)
    return out.view(np.int64)


def block_hashes(tokens: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each block; blocks follow one another."""
    if not len(begin):
        return np.empty(0, np.int64)
    powers = np.cumprod(np.full(int(size.max()), _FACTOR, np.uint64))
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    at = np.repeat(begin, size) + inside
    return np.add.reduceat(_mixed(tokens[at]) * powers[inside], np.cumsum(size) - size).view(np.int64)


def _mixed(tokens: np.ndarray) -> np.ndarray:
    t = tokens.astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return (t ^ (t >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def kin_of(tokens: np.ndarray, key: int) -> int:
    """A hash of the least of the page's windows under KIN hash functions; the key of a page without windows."""
    if len(tokens) < LONG:
        return key
    found, out = window_hashes(tokens)[: len(tokens) - LONG + 1].view(np.uint64), np.uint64(0)
    for k in range(KIN):
        factor = np.uint64((0x9E3779B97F4A7C15 * (2 * k + 3)) % 2**64)
        mixed = (found ^ (found >> np.uint64(29 + k))) * factor
        out = np.bitwise_xor(out, np.multiply(mixed.min(), factor))
    return int(np.array([out], np.uint64).view(np.int64)[0])


def word_hashes(blocks: list[list[str]]) -> np.ndarray:
    hashed = xxhash.xxh32_intdigest
    return np.array([hashed(w.encode("utf-8", "surrogatepass")) for b in blocks for w in b], np.uint32).view(np.int32)


#: The token after each block, and the first of those after pages.
END, PAGE_END = 1 << 32, 1 << 33


class Shard:
    """The streams of a shard's distinct pages, concatenated, with an end mark after each block and another after each page."""

    def __init__(self, group: pa.Table) -> None:
        keys, first = np.unique(group.column("key").to_numpy(), return_index=True)
        self.first = first
        rows = group.select(["words", "sizes", "kinds", "kin"]).take(pa.array(first)).combine_chunks()
        self.keys, self.kin = keys, rows.column("kin").to_numpy()
        flat, lists = ({c: rows.column(c).combine_chunks() for c in ("words", "sizes", "kinds")}, {})
        for c, column in flat.items():
            lists[c] = np.asarray(column.flatten()), np.diff(np.asarray(column.offsets))
        words, sizes = lists["words"][0], lists["sizes"][0].astype(np.int64)
        self.kinds, blocks = lists["kinds"]
        self.of = np.repeat(np.arange(len(keys)), blocks)  # the page of each block
        marks = np.ones(len(sizes), np.int64)  # the end marks after each block
        last = np.cumsum(blocks)[blocks > 0] - 1
        marks[last] += 1
        self.size, self.words = sizes + 1, sizes
        self.begin = np.cumsum(sizes + marks) - (sizes + marks)
        n = int((sizes + marks).sum())
        self.tokens = np.full(n, END, np.int64)
        at = np.repeat(self.begin, sizes) + np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.tokens[at] = words
        self.tokens[self.begin[last] + self.size[last]] = PAGE_END + np.arange(len(last))
        self.block = np.repeat(np.arange(len(sizes)), sizes + marks)  # the block of each token
        self.owner = self.kin[self.of]  # of each block
        self.hashes = block_hashes(self.tokens, self.begin, self.size)
        #: Repeats are looked for in what may be boilerplate: passages that articles share make none.
        self.open = (self.kinds != CORE)[self.block]

    def whole_windows(self) -> np.ndarray:
        """The tokens outside articles from which a window of LONG stays in the page and outside its article."""
        n = len(self.tokens) - LONG + 1
        if n <= 0:
            return np.empty(0, np.int64)
        barred = np.r_[0, np.cumsum((self.tokens >= PAGE_END) | ~self.open)]
        return np.flatnonzero(barred[LONG:] == barred[:-LONG])

    def evidence(self) -> np.ndarray:
        """(hash, owner) of the blocks and windows outside the articles' cores, each once."""
        at, outside = self.whole_windows(), self.kinds != CORE
        own = self.owner[self.block[at]] if len(at) else np.empty(0, np.int64)
        both = np.concatenate([self.hashes[outside], window_hashes(self.tokens)[at]]), np.concatenate([self.owner[outside], own])
        return np.unique(np.stack(both, 1), axis=0)

    def notices(self, order: np.ndarray, common: np.ndarray) -> np.ndarray:
        """The hashes of the article blocks that stand whole on over half of the shard's distinct pages."""
        own = np.flatnonzero(self.kinds <= WEAK_CORE)
        stands = standings(order, common, self.begin[own], self.size[own], self.owner[own])
        return np.unique(self.hashes[own[stands >= max(NOTICE, len(np.unique(self.owner[own])) // 2 + 1)]])

    def cuts(self, order: np.ndarray, common: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """The key and the word ranges to cut of each page that loses weakly marked blocks or covered words."""
        covered = np.zeros(len(self.tokens) + 1, np.int64)
        length = repeats(order, common, self.owner[self.block], self.open, SPREAD)
        at = np.flatnonzero(length)
        np.add.at(covered, at, 1)
        np.add.at(covered, at + length[at], -1)
        outside = np.flatnonzero(self.kinds != CORE)
        stands = np.zeros(len(self.kinds), np.int64)
        stands[outside] = standings(order, common, self.begin[outside], self.size[outside], self.owner[outside])
        return self._cut(covered, stands >= SPREAD)

    def cuts_by(self, shared: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """The same from the hashes of the blocks and windows that stand on SPREAD distinct pages of the host."""
        covered, at = np.zeros(len(self.tokens) + 1, np.int64), self.whole_windows()
        at = at[np.isin(window_hashes(self.tokens)[at], shared)]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + LONG, -1)
        return self._cut(covered, np.isin(self.hashes, shared))

    def _cut(self, covered: np.ndarray, stands: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        hit = (np.cumsum(covered)[:-1] > 0) & self.open
        inside = np.add.reduceat(np.r_[hit & (self.tokens < END), False].astype(np.int64), self.begin) if len(self.begin) else np.empty(0, np.int64)
        weak = np.isin(self.kinds, (WEAK_CORE, WEAK_OPEN)) & (stands | (inside >= self.words))
        some = np.unique(self.of[weak | (np.isin(self.kinds, (OPEN, WEAK_OPEN)) & (inside > 0))])
        edges = np.searchsorted(self.of, np.arange(len(self.keys) + 1))
        for page in some.tolist():
            lo, hi = edges[page], edges[page + 1]
            hi = lo + int((self.kinds[lo:hi] != EVIDENCE).sum())  # evidence stands last
            gone = np.concatenate([np.full(self.words[b], bool(weak[b])) for b in range(lo, hi)])
            if self.kinds[lo] >= OPEN:
                runs = gone | np.concatenate([hit[self.begin[b] : self.begin[b] + self.words[b]] for b in range(lo, hi)])
                gone = runs if 2 * runs.sum() <= len(runs) else gone
            if gone.any():
                yield int(self.keys[page]), np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).tolist()


#: What a shard tells: that it is there, a notice, evidence for the host's other shards, cuts of a page, or a page whose cuts need their evidence.
THERE, VOTE, HASH, CUT, PAGE = range(5)
STREAM = "key long, words array<int>, sizes array<int>, kinds array<tinyint>, kin long"
TOLD = f"kind tinyint, host string, shard long, hash long, cuts array<int>, {STREAM}"


_TOLD = pa.schema(
    [("kind", pa.int8()), ("host", pa.string()), ("shard", pa.int64()), ("hash", pa.int64()), ("cuts", pa.list_(pa.int32())), ("key", pa.int64())]
    + [("words", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), ("kinds", pa.list_(pa.int8())), ("kin", pa.int64())]
)


def _told(key: tuple, group: pa.Table) -> pa.Table:
    """What a shard's suffix array tells, as rows of TOLD."""
    shard, host, number = Shard(group), key[0].as_py(), key[1].as_py()
    several = group.column("shards")[0].as_py() > 1
    order, common = suffix_array(shard.tokens)
    notices = shard.notices(order, common)
    columns = {f.name: [pa.nulls(1, f.type)] for f in _TOLD if f.name not in ("kind", "host", "shard")}
    sizes = [1]

    def add(n: int, **given) -> None:
        sizes.append(n)
        for f in _TOLD:
            if f.name in columns:
                own = given.get(f.name)
                columns[f.name].append(pa.nulls(n, f.type) if own is None else own if isinstance(own, (pa.Array, pa.ChunkedArray)) else pa.array(own, f.type))

    add(len(notices), hash=notices)
    doubt = np.isin(shard.kinds, (WEAK_CORE, OPEN, WEAK_OPEN))
    pages = np.unique(shard.of[doubt])
    found, cut, rest = np.empty((0, 2), np.int64), [], np.empty(0, np.int64)
    if several:
        found, rest = shard.evidence(), shard.first[pages]
    elif len(pages):
        cut = list(shard.cuts(order, common))
    add(len(found), hash=found[:, 0], kin=found[:, 1])
    add(len(cut), key=[k for k, _ in cut], cuts=[c for _, c in cut])
    held = group.take(pa.array(rest)).combine_chunks()
    add(len(rest), **{c: pa.concat_arrays(held.column(c).chunks).cast(_TOLD.field(c).type) if len(rest) else None for c in ("key", "words", "sizes", "kinds", "kin")})
    n = sum(sizes)
    fixed = {"kind": pa.array(np.repeat(np.arange(5), sizes), pa.int8()), "host": pa.array([host] * n, pa.string()), "shard": pa.array([number] * n, pa.int64())}
    made = {c: pa.chunked_array([x for a in parts for x in (a.chunks if isinstance(a, pa.ChunkedArray) else [a])], _TOLD.field(c).type) for c, parts in columns.items()}
    return pa.table({f.name: fixed.get(f.name, made.get(f.name)) for f in _TOLD})


def _cut_across(key: tuple, group: pa.Table, across: pa.Table) -> pa.Table:
    cut = list(Shard(group).cuts_by(across.column("hash").to_numpy())) if group.num_rows else []
    return pa.table({"cut_key": pa.array([k for k, _ in cut], pa.int64()), "cuts": pa.array([c for _, c in cut], pa.list_(pa.int32()))})


def kept_blocks(blocks: list[list[str]], kinds: list[int], cuts: list[int] | None, notices: np.ndarray | None) -> list[list[str]]:
    """The blocks without the word ranges that ``cuts`` (begin, end, begin, end ...) names, and without the article's notices at both ends."""
    if cuts:
        gone, at, out = np.zeros(sum(map(len, blocks)) + 1, bool), 0, []
        for a, b in zip(cuts[::2], cuts[1::2]):
            gone[a:b] = True
        for b in blocks:
            out.append([w for k, w in enumerate(b) if not gone[at + k]])
            at += len(b)
        blocks, kinds = [b for b in out if b], [k for b, k in zip(out, kinds) if b]
    if not blocks or notices is None or not len(notices) or kinds[0] > WEAK_CORE:
        return blocks

    def is_notice(b: list[str]) -> bool:
        tokens = np.r_[word_hashes([b]).astype(np.int64), END]
        return bool(np.isin(block_hashes(tokens, np.zeros(1, np.int64), np.array([len(tokens)])), notices)[0])

    lo, hi = 0, len(blocks)
    while lo < hi and is_notice(blocks[lo]):
        lo += 1
    while hi > lo and is_notice(blocks[hi - 1]):
        hi -= 1
    return blocks[lo:hi] or blocks


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else df


def _few_lists(df: DataFrame, lists: str) -> DataFrame:
    """``df`` broadcast if its rows and the numbers in its lists are few."""
    size = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size(lists)), F.lit(0)).alias("numbers")).first()
    return F.broadcast(df) if size["n"] <= MOST_BROADCAST and size["numbers"] <= MOST_NUMBERS else df


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", array: bool = True) -> DataFrame:
    """(page_id, url, text) of every row. Without ``array`` the markup alone decides, which tests compare with."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), HOST, 1))
    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col), F.xxhash64(html_col, url_col).alias("key"), host.alias("host"))

    def write():
        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            texts = []
            for html, cut, notices in zip(batch.column(2), batch.column(3), batch.column(4)):
                own, kinds, _ = split_page(html.as_py())
                texts.append(" ".join([" ".join(b) for b in kept_blocks(own, kinds, cut.as_py(), None if notices.values is None else notices.values.to_numpy())]))
            yield {id_col: batch.column(0), url_col: batch.column(1), "text": texts}

        return work

    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    schema = f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string"
    if not array:
        return map_rows(rows.select(id_col, url_col, html_col, F.lit(None).cast("array<int>").alias("cuts"), F.lit(None).cast("array<long>").alias("notices")), write, schema)

    def read():
        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            words, sizes, kinds, kin = [], [], [], []
            for html, key in zip(batch.column(3), batch.column(0)):
                own, what, rest = split_page(html.as_py())
                words.append(word_hashes([*own, *rest]))
                sizes.append([len(b) for b in (*own, *rest)])
                kinds.append([*what, *[EVIDENCE] * len(rest)])
                kin.append(kin_of(words[-1][: sum(map(len, own))], key.as_py()))
            yield {"key": batch.column(0), "host": batch.column(1), "shards": batch.column(2), "words": words, "sizes": sizes, "kinds": kinds, "kin": kin}

        return work

    crowd = settled(rows.groupBy("host").agg(F.ceil(F.coalesce(F.sum(F.length(html_col)), F.lit(0)) / SHARD).alias("shards")))
    crowd = crowd.select("host", F.greatest("shards", F.lit(1).cast("long")).alias("shards"))
    sized = rows.join(_few(crowd), "host").select("key", "host", "shards", html_col)
    streams = map_rows(sized, read, f"host string, shards long, {STREAM}").withColumn("shard", F.pmod("key", F.col("shards")))
    told = settled(streams.groupBy("host", "shard").applyInArrow(_told, TOLD))
    votes = told.where(F.col("kind").isin(THERE, VOTE)).groupBy("host", "hash").agg(F.count("*").alias("n"))
    there = votes.where("hash IS NULL").select("host", F.col("n").alias("of"))
    notices = votes.where("hash IS NOT NULL").join(_few(there), "host").where("2 * n > of").groupBy("host").agg(F.collect_list("hash").alias("notices"))
    notices = settled(notices)  # a page has few blocks that over half of the pages have
    held = told.where(F.col("kind") == HASH).select("host", "shard", "hash", "kin")
    shared = held.select("host", "hash", "kin").distinct().groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= SPREAD).select("host", "hash")
    across = held.select("host", "shard", "hash").distinct().join(shared, ["host", "hash"]).select(F.col("host").alias("of_host"), F.col("shard").alias("of_shard"), "hash")
    doubt = told.where(F.col("kind") == PAGE).select("host", "shard", *[c.split()[0] for c in STREAM.split(", ")])
    more = doubt.groupBy("host", "shard").cogroup(across.groupBy("of_host", "of_shard")).applyInArrow(_cut_across, "cut_key long, cuts array<int>")
    cuts = settled(told.where(F.col("kind") == CUT).select(F.col("key").alias("cut_key"), "cuts").unionByName(more))
    joined = rows.join(_few_lists(notices, "notices"), "host", "left").join(_few_lists(cuts, "cuts"), F.col("key") == F.col("cut_key"), "left")
    return map_rows(joined.select(id_col, url_col, html_col, "cuts", "notices"), write, schema)
