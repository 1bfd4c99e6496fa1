"""Main text of web pages by union-free regular expressions inferred per host.

A page is a stream of structure tags and text slots.  Adjacent repeats within
it become repeated groups; the streams of a host's pages are then aligned one
after the other: what only one side has becomes optional, a group repeated on
one side is looked for on the other, and texts that differ make a slot
variable.  The result is the host's wrapper: an expression without unions and
what its slots hold.  Partial wrappers are made per task and merged in two
levels, so a host with most of the pages is never in one task.

Each page is then matched against its host's wrapper, which gives every text
its aligned slot.  A slot, be it optional or repeated, that held one and the
same text on several different pages is fixed and part of the template; what
varies is main text if it lies in the page's content region (article, else
main, else where text without links is) and under no menu, header, footer, sidebar,
notice, advert, form or comment part.  Pages that do not match are read by the
same rules with what is known of their tag paths.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import shared_table, slices

#: Streams are aligned in pieces between shared anchors until a piece has no more pairs of items than this.
PIECE = 160_000
#: A slot is fixed if so many different pages hold the same text in it.
SAME_ON = 3
LONGEST_REPEAT = 24

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
#: Tags inside a run of text; they are part of a slot.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Tags that do not end a block, though they are structure.
CELLS = frozenset(("td", "th"))
OUTSIDE_TAGS = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea iframe svg canvas object dialog menu map xmp noembed noframes fieldset".split()
)
OUTSIDE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads advert advertisement adverts sponsored sponsor promo "
    "banner cookie cookies notice consent gdpr popup modal overlay comment comments commentlist reply replies respond discussion disqus share sharing social related "
    "recommended subscribe newsletter signup login search form widget skip pagination pager toolbar copyright".split()
)
#: Words that say where or how a box is, not what is in it: with an outside word they make an outside name ("site-footer", "comment-list").
PLACE_WORDS = frozenset(
    "area article articles bar block body bottom box container content entry first global group inner item items last left link links list main mobile outer "
    "page panel post posts primary recent right secondary section site stories story text title top unit user wrap wrapper".split()
)
#: With one of these a "header" is the article's own.
ARTICLE_WORDS = frozenset("article content entry post section story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)

#: Tags whose quoted values are short; for all others :class:`_Tags` finds the end.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>]*+)((?:"[^"]{0,1024}"|'[^']{0,1024}'|[^<>"'])*+)>|[^<]+|<""",
    re.DOTALL,
)
_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)")
_BARE = re.compile(r"""[^<>"']*+""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


@lru_cache(1 << 16)
def _name_words(name: str) -> tuple[frozenset[str], bool]:
    """The words of one class, id or role, and whether the whole name is that of an outside part: "related", not "related-work"."""
    words = frozenset(_WORDS.findall(name))
    hits = words & OUTSIDE_WORDS
    own = hits == {"header"} and words & ARTICLE_WORDS
    return words, bool(hits) and not own and words - hits <= PLACE_WORDS


def _mark(name: str, attributes: str) -> str:
    """A tag with its class, id and role words, and "!" if one of the names is outside; digits, which number pages, are left out.

    A heading is never outside by its names: they are often made from its text.
    """
    words = set()
    if "=" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            for part in (m[2] or m[3] or m[4] or "").lower().split():
                found, outside = _name_words(part)
                words |= found
                if outside and name not in HEADINGS:
                    words.add("!")
    return name + "".join(f".{w}" for w in sorted(words))


def _outside(mark: str) -> bool:
    name, *words = mark.split(".")
    return name in OUTSIDE_TAGS or "!" in words


@lru_cache(1 << 16)
def _outside_path(path: str) -> bool:
    return any(_outside(x) for x in path.split("/"))


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")


def _seen(a: list, b: list) -> list:
    """What two parts know of a slot: [least hashes of the pages, hash of the text or None if it varies, characters, characters in links]."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    pages = a[0] if a[0] == b[0] else sorted({*a[0], *b[0]})[:SAME_ON]
    return [pages, a[1] if a[1] == b[1] else None, a[2] + b[2], a[3] + b[3]]


def _all_seen(a: list[list], b: list[list]) -> list[list]:
    return [_seen(x, y) for x, y in zip(a, b, strict=True)]


FIXED, LINKS = 1, 2


def _nature(fact: list) -> int:
    pages, text, size, links = fact
    return (FIXED if len(pages) >= SAME_ON and text is not None else 0) | (LINKS if links * 2 > size else 0)


class _Tags:
    """Tags with quoted values of any length, in time linear in the page: no place is scanned twice in vain."""

    def __init__(self, source: str):
        self.source = source
        self.last: dict[str, int] = {}  # quotes and the place after which there is no other
        self.vain: set[int] = set()  # places outside quotes from where no tag ends

    def at(self, start: int) -> tuple[str, str, str, int] | None:
        """(slash, name, attributes, end) of the tag that starts here."""
        m = _OPEN.match(self.source, start)
        if m is None:
            return None
        quotes = [m.start(2) + i for i, c in enumerate(m[2]) if c in "\"'"]
        for name_end in [m.end(), *reversed(quotes)]:
            stop = self._end(name_end)
            if stop is not None:
                return m[1], self.source[m.start(2) : name_end], self.source[name_end:stop], stop + 1
        return None

    def _end(self, at: int) -> int | None:
        passed = []
        while at not in self.vain:
            passed.append(at)
            at = _BARE.match(self.source, at).end()
            mark = self.source[at : at + 1]
            if mark == ">":
                return at
            if mark not in ("'", '"') or at >= self.last.get(mark, len(self.source)):
                break
            after = self.source.find(mark, at + 1)
            if after < 0:
                self.last[mark] = at
                break
            at = after + 1
        self.vain.update(passed)
        return None


class Page:
    """``items``: structure tags and "#" for each slot; ``slots``: (path, text, characters in links) of each slot."""

    def __init__(self, source: str):
        self.items: list[str] = []
        self.slots: list[tuple[str, list[str], int]] = []
        self.blocks: list[int] = []  # number of the block of each slot
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[str] = []  # marks of the open structure tags
        at, end, block, links, open_slot = 0, len(source), 0, 0, False
        items, slots, match, tags = self.items, self.slots, _TOKEN.match, _Tags(source)

        while at < end:
            m = match(source, at)
            slash, name, attributes = m.groups()
            if name is None and m[0] == "<" and (tag := tags.at(at)):
                slash, name, attributes, at = tag
            else:
                at = m.end()
            if name is None:
                text = m[0]
                if text[0] == "<" and len(text) > 1:
                    if not text.startswith("<![CDATA["):
                        continue
                    text = text[9:].removesuffix("]]>")
                if open_slot:
                    slots[-1][1].append(text)
                    if links:
                        slots[-1] = (slots[-1][0], slots[-1][1], slots[-1][2] + len(text))
                elif text.strip():
                    items.append("#")
                    slots.append(("/".join(stack), [text], len(text) if links else 0))
                    self.blocks.append(block)
                    open_slot = True
                continue
            name = name.lower()
            closing = slash == "/"
            if name in INLINE:
                if name == "a":
                    links = 0 if closing else 1
                elif name == "br" and open_slot:
                    slots[-1][1].append(" ")
                words = _mark(name, attributes) if attributes and not closing and "=" in attributes else ""
                if not words or not _outside(words):
                    continue
            open_slot = False
            if name not in CELLS:
                block += 1
            if name in RAW and not closing:
                stop = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(source, at)
                items.append(f"<{name}>")
                if name == "title" or name == "textarea":
                    text = source[at : stop.start() if stop else end]
                    if text.strip():
                        items.append("#")
                        slots.append(("/".join([*stack, name]), [text], 0))
                        self.blocks.append(block)
                at = stop.end() if stop else end
                continue
            if closing:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth].split(".", 1)[0] == name:
                        del stack[depth:]
                        items.append(f"</{name}>")
                        break
                links = 0
                continue
            mark = _mark(name, attributes)
            if name in CLOSES_P:
                self._close(stack, "p", ("table", "td", "th", "button", "object"))
            elif name == "li":
                self._close(stack, "li", ("ul", "ol", "menu"))
            elif name in ("dt", "dd"):
                self._close(stack, "dt", ("dl",))
                self._close(stack, "dd", ("dl",))
            elif name in ("tr", "td", "th"):
                for cell in ("td", "th") if name != "tr" else ("tr",):
                    self._close(stack, cell, ("table",))
            items.append(f"<{mark}>")
            if name not in VOID and not attributes.endswith("/"):
                stack.append(mark)

    @staticmethod
    def _close(stack: list[str], name: str, barriers: tuple[str, ...]) -> None:
        for depth in range(len(stack) - 1, -1, -1):
            opened = stack[depth].split(".", 1)[0]
            if opened == name:
                del stack[depth:]
                return
            if opened in barriers:
                return


def _body(item: str) -> list[str]:
    return json.loads(item[1:]) if item[0] == "+" else []


def _plus(body: list[str]) -> str:
    return "+" + json.dumps(body, ensure_ascii=False, separators=(",", ":"))


def collapse(items: list[str]) -> list[str]:
    """Adjacent repeats of up to LONGEST_REPEAT items, shortest first, as one repeated group each, again and again."""
    return _collapse(items, [[]] * len(items))[0]


def _collapse(items: list[str], facts: list[list]) -> tuple[list[str], list[list]]:
    """:func:`collapse` with what is known of the slots in each item; a group's slot knows what its repeats know."""
    changed = True
    while changed:
        changed = False
        for width in range(1, min(LONGEST_REPEAT, len(items) // 2) + 1):
            out, told, i = [], [], 0
            while i < len(items):
                body = items[i : i + width]
                n = 1
                if len(body) == width and items[i + width : i + 2 * width] == body:
                    n = 2
                    while items[i + n * width : i + (n + 1) * width] == body:
                        n += 1
                if n > 1:
                    out.append(body[0] if width == 1 and body[0][0] == "+" else _plus(body))
                    known = _joined(facts, i, width)
                    for at in range(i + width, i + n * width, width):
                        known = _all_seen(known, _joined(facts, at, width))
                    told.append(known)
                    i += n * width
                    changed = True
                else:
                    out.append(items[i])
                    told.append(facts[i])
                    i += 1
            items, facts = out, told
        absorbed, facts = _absorb(items, facts, {x for x in items if x[0] == "+"})
        changed = changed or absorbed != items
        items = absorbed
    return items, facts


def _joined(facts: list[list], at: int, n: int) -> list[list]:
    return facts[at] if n == 1 else [x for known in facts[at : at + n] for x in known]


def _absorb(items: list[str], facts: list[list], groups: Iterable[str]) -> tuple[list[str], list[list]]:
    """Single runs of a group's body as the group, next to the group itself or not."""
    there = Counter(items)
    for group in sorted(groups, key=lambda g: (len(g), g)):
        body = _body(group)
        if there[group] < 2 and not all(there[x] for x in body):
            continue
        out: list[str] = []
        told: list[list] = []
        i = 0
        while i < len(items):
            n = len(body) if items[i] == body[0] and items[i : i + len(body)] == body else 0
            if n or items[i] == group:
                known = _joined(facts, i, n or 1)
                if out and out[-1] == group:
                    told[-1] = _all_seen(told[-1], known)
                else:
                    out.append(group)
                    told.append(known)
                i += n or 1
            else:
                out.append(items[i])
                told.append(facts[i])
                i += 1
        if len(out) < len(items) or out != items:
            items, facts, there = out, told, Counter(out)
    return items, facts


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of ``pairs`` (first numbers rising) with rising second numbers."""
    ends: list[int] = []
    last: list[int] = []
    before = []
    for x, (_, k) in enumerate(pairs):
        at = bisect_left(ends, k)
        before.append(last[at - 1] if at else -1)
        ends[at : at + 1] = [k]
        last[at : at + 1] = [x]
    out = []
    x = last[-1] if last else -1
    while x >= 0:
        out.append(pairs[x])
        x = before[x]
    return out[::-1]


def _anchors(a: list[str], b: list[str], width: int) -> list[tuple[int, int]]:
    """Places of the runs of ``width`` items that are in both streams once, in an order both share."""
    x = [tuple(a[i : i + width]) for i in range(len(a) - width + 1)]
    y = [tuple(b[i : i + width]) for i in range(len(b) - width + 1)]
    in_x, in_y = Counter(x), Counter(y)
    where = {g: k for k, g in enumerate(y) if in_y[g] == 1}
    return _rising([(i, where[g]) for i, g in enumerate(x) if in_x[g] == 1 and g in where])


def _nth_to_nth(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Items met with the one that is as many equal ones after the start on the other side, in an order both share."""
    seen: Counter[str] = Counter()
    where = {}
    for k, x in enumerate(b):
        where[x, seen[x]] = k
        seen[x] += 1
    seen.clear()
    pairs = []
    for i, x in enumerate(a):
        if (x, seen[x]) in where:
            pairs.append((i, where[x, seen[x]]))
        seen[x] += 1
    return _rising(pairs)


def align(a: list[str], b: list[str]) -> list[tuple[int, int, int, int]]:
    """Equal stretches a[i:j] == b[k:m] in rising order, over the whole of both streams.

    Long streams are cut at runs of items that both have once, and the pieces
    between again; a long piece without such a run meets n-th with n-th item.
    """
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b), 0)]
    while todo:
        i, j, k, m, level = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            pairs.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            pairs.append((j, m))
        if i == j or k == m:
            continue
        if (j - i) * (m - k) <= PIECE:
            for x, y, n in SequenceMatcher(None, a[i:j], b[k:m], autojunk=False).get_matching_blocks():
                pairs += [(i + x + z, k + y + z) for z in range(n)]
            continue
        met: list[tuple[int, int]] = []
        if level < 8:
            met = _anchors(a[i:j], b[k:m], 1) or _anchors(a[i:j], b[k:m], 8)
        if not met and level <= 8:
            met, level = _nth_to_nth(a[i:j], b[k:m]), 8
        if met:
            # an anchor of several items is met again as the start of its piece
            starts = [(0, 0), *met]
            ends = [*met, (j - i, m - k)]
            todo += [(i + x, i + p, k + y, k + q, level + 1) for (x, y), (p, q) in zip(starts, ends, strict=True)]
    pairs.sort()
    out: list[tuple[int, int, int, int]] = []
    for i, k in pairs:
        if out and out[-1][1] == i and out[-1][3] == k:
            out[-1] = (out[-1][0], i + 1, out[-1][2], k + 1)
        else:
            out.append((i, i + 1, k, k + 1))
    return out


def _n_slots(item: str) -> int:
    return sum(map(_n_slots, _body(item))) if item[0] == "+" else int(item == "#")


class Wrapper:
    """``parts``: [item, whether it may be missing]; ``facts``: what is known of the slots in each part, see :func:`_seen`; ``slots``: path -> the same for all slots of a path."""

    def __init__(self, parts: list[list], slots: dict[str, list], facts: list[list] | None = None):
        self.parts, self.slots = parts, slots
        self.facts = [[[[], None, 0, 0]] * _n_slots(x) for x, _ in parts] if facts is None else facts

    @classmethod
    def of(cls, page: Page) -> Wrapper:
        slots: dict[str, list] = {}
        facts: list[list] = []
        texts_of = [" ".join("".join(texts).split()) for _, texts, _ in page.slots]
        # pages are told apart by what is not under an outside part
        same = _hash("\0".join(t for t, (path, _, _) in zip(texts_of, page.slots, strict=True) if not _outside_path(path)))
        for text, (path, _, links) in zip(texts_of, page.slots, strict=True):
            fact = [[same], _hash(text), len(text), links]
            facts.append([fact])
            slots[path] = _seen(slots[path], fact) if path in slots else fact
        rest = iter(facts)
        items, facts = _collapse(page.items, [next(rest) if x == "#" else [] for x in page.items])
        return cls([[x, False] for x in items], slots, facts)

    def merge(self, other: Wrapper) -> Wrapper:
        groups = {x for x, _ in self.parts + other.parts if x[0] == "+"}
        (a, a_facts), (b, b_facts) = self._with(groups), other._with(groups)
        parts: list[list] = []
        facts: list[list] = []
        done_a = done_b = 0
        for i, j, k, m in [*align([x for x, _ in a], [x for x, _ in b]), (len(a), len(a), len(b), len(b))]:
            parts += [[x, True] for x, _ in a[done_a:i] + b[done_b:k]]
            facts += a_facts[done_a:i] + b_facts[done_b:k]
            parts += [[x, p or q] for (x, p), (_, q) in zip(a[i:j], b[k:m], strict=True)]
            facts += map(_all_seen, a_facts[i:j], b_facts[k:m])
            done_a, done_b = j, m
        slots = self.slots | {path: _seen(self.slots[path], known) if path in self.slots else known for path, known in other.slots.items()}
        return Wrapper(parts, slots, facts)

    def _with(self, groups: set[str]) -> tuple[list[list], list[list]]:
        """The parts with single runs of these groups as the groups; a run that may be missing makes a group that may be."""
        loose = {x for x, missing in self.parts if missing}
        items, facts = _absorb([x for x, _ in self.parts], self.facts, groups)
        return [[x, x in loose or any(y in loose for y in _body(x))] for x in items], facts

    def dump(self) -> str:
        return json.dumps([self.parts, self.slots, self.facts], ensure_ascii=False, separators=(",", ":"), sort_keys=True)

    @classmethod
    def load(cls, text: str) -> Wrapper:
        return cls(*json.loads(text))

    def pattern(self) -> tuple[re.Pattern, dict[str, str]]:
        """The expression over one character a token; every quantifier is possessive, so matching is linear."""
        letters: dict[str, str] = {}

        def write(item: str) -> str:
            if item[0] == "+":
                return f"(?:{''.join(write(x) for x in _body(item))})++"
            return re.escape(letters.setdefault(item, chr(0x4E00 + len(letters))))

        return re.compile("".join(f"(?:{write(x)})?+" if missing else write(x) for x, missing in self.parts)), letters

    def settled(self) -> Wrapper:
        """The same with the nature of each slot in place of what is known of it."""
        return Wrapper(self.parts, self.slots, [[_nature(x) for x in known] for known in self.facts])

    def matcher(self) -> Callable[[list[str]], list | None]:
        """Like :meth:`pattern`, but gives what is in ``facts`` for each slot of a page, or None if it does not match."""

        def node(item: str, known: Iterator) -> tuple:
            body = [node(x, known) for x in _body(item)]
            return (item, body, next(known) if item == "#" else None)

        nodes = [(node(x, iter(known)), missing) for (x, missing), known in zip(self.parts, self.facts, strict=True)]

        def take(of: tuple, items: list[str], at: int, out: list) -> int:
            """The place after one match at ``at``, or ``at`` itself."""
            item, body, known = of
            if not body:
                if at == len(items) or items[at] != item:
                    return at
                if item == "#":
                    out.append(known)
                return at + 1
            while True:
                here, held = at, len(out)
                for x in body:
                    after = take(x, items, here, out)
                    if after == here:
                        del out[held:]
                        return at
                    here = after
                at = here

        def match(items: list[str]) -> list | None:
            out: list = []
            at = 0
            for of, missing in nodes:
                after = take(of, items, at, out)
                if after == at and not missing:
                    return None
                at = after
            return out if at == len(items) else None

        return match

    def region(self) -> str | None:
        """The mark or tag whose inside is content on some page of the host; None: everything."""
        return next(iter(self.regions()), None)

    def regions(self) -> list[str]:
        """The content regions that pages of the host have, first choice first."""
        return _regions((path, known[2] - known[3]) for path, known in self.slots.items())

    def region_of(self, page: Page) -> str | None:
        """The first of the host's regions in which this page has text; if none has any, one that the page has empty."""
        with_text = _regions((path, sum(map(len, texts)) - links) for path, texts, links in page.slots)
        return next(iter(with_text), None) or next((x for x in self.regions() if any(_is_region(y[1:-1], x) for y in page.items if y[0] == "<")), None)

    def is_content(self, path: str, region: str | None) -> bool:
        """Whether texts at ``path`` are main text; outside a named region a text that never varies is part of the template."""
        if not _may_be_content(path, region):
            return False
        if region:
            return True
        return path not in self.slots or _nature(self.slots[path]) == 0


@lru_cache(1 << 16)
def _may_be_content(path: str, region: str | None) -> bool:
    """Whether ``path`` is in the region and under no outside part."""
    if _outside_path(path):
        return False
    marks = path.split("/")
    inside = [i for i, x in enumerate(marks) if _is_region(x, region)] if region else []
    if any(x.split(".")[0] == "header" for x in (marks[: inside[0]] if inside else marks)):
        return False
    return bool(inside) if region else True


REGIONS = ("article", "main", ".main")


def _is_region(mark: str, region: str) -> bool:
    name, *words = mark.split(".")
    return "main" in words if region == ".main" else name == region


@lru_cache(1 << 16)
def _regions_at(path: str) -> tuple[str, ...]:
    return () if _outside_path(path) else tuple(x for x in REGIONS if any(_is_region(mark, x) for mark in path.split("/")))


def _regions(texts: Iterable[tuple[str, int]]) -> list[str]:
    """The regions with unlinked text, of (path, unlinked characters)."""
    found = {x for path, size in texts if size > 0 for x in _regions_at(path)}
    return [x for x in REGIONS if x in found]


def is_main(path: str, nature: int, region: str | None) -> bool:
    """Whether the text of an aligned slot is main text: what is fixed never is, and outside a named region links are not."""
    return _may_be_content(path, region) and not nature & (FIXED if region else FIXED | LINKS)


def main_text(page: Page, is_content) -> str:
    """Texts of the slots with content paths, see :func:`joined_text`."""
    return joined_text(page, [is_content(path) for path, _, _ in page.slots])


def joined_text(page: Page, wanted: list[bool]) -> str:
    """Texts of the wanted slots: a block's white space as single blanks, blocks in page order joined by one line end."""
    blocks: list[tuple[int, list[str]]] = []
    for (_, texts, _), block, keep in zip(page.slots, page.blocks, wanted, strict=True):
        if keep:
            if not blocks or blocks[-1][0] != block:
                blocks.append((block, []))
            blocks[-1][1].extend([" ", *texts])
    lines = (" ".join(html.unescape("".join(texts)).split()) for _, texts in blocks)
    return "\n".join(x for x in lines if x)


def _fold(wrappers: Iterable[str]) -> Wrapper:
    whole = None
    for text in sorted(wrappers, key=lambda t: (len(t), t)):
        part = Wrapper.load(text)
        whole = part if whole is None else whole.merge(part)
    return whole


def infer_wrappers(pages: DataFrame, salts: int = 32) -> DataFrame:
    """(host, settled wrapper) from (host, html): partial wrappers per task, merged per (host, salt), then per host."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Wrapper] = {}
        for batch in slices(batches, "html"):
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                part = Wrapper.of(Page(source))
                held[host] = held[host].merge(part) if host in held else part
                if len(held) > 2000:  # bounded memory; the merge of later parts makes up for it
                    yield _rows(held)
                    held = {}
        if held:
            yield _rows(held)

    def fold(key: str):
        def run(group: pd.DataFrame) -> pd.DataFrame:
            whole = _fold(group["wrapper"])
            return pd.DataFrame({"host": group["host"].iloc[:1], "wrapper": [(whole.settled() if key == "host" else whole).dump()]})

        return run

    parts = pages.select("host", "html").mapInArrow(partial, "host string, wrapper string")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(salts)))
    return salted.groupBy("host", "salt").applyInPandas(fold("salt"), "host string, wrapper string").groupBy("host").applyInPandas(fold("host"), "host string, wrapper string")


def _rows(held: dict[str, Wrapper]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([w.dump() for w in held.values()], pa.string())], names=["host", "wrapper"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points), conforms (the wrapper matches the whole page).

    The slots of a page that conforms are told apart one by one as they are
    aligned, those of other pages by their tag paths.
    Null html is empty and gives empty text.  Pages without a host in their
    url, or without a url, share one wrapper.  Repeated rows are extracted
    each; an empty table gives no rows; other columns are not read.  Whole
    pages: nothing is cut or dropped but what is not main text.
    """
    host = F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), _HOST, 1))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"), host.alias("host")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[str, tuple] = {}
        for batch in slices(batches, "html"):
            texts, conforms = [], []
            for source, text in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                if text not in ready:
                    if len(ready) > 2000:
                        ready.clear()
                    wrapper = Wrapper.load(text)
                    ready[text] = (wrapper, *wrapper.pattern(), wrapper.matcher(), {})
                wrapper, pattern, letters, match, labels = ready[text]
                page = Page(source)
                region = wrapper.region_of(page)

                def is_content(path: str, wrapper=wrapper, region=region, labels=labels) -> bool:
                    if (path, region) not in labels:
                        labels[path, region] = wrapper.is_content(path, region)
                    return labels[path, region]

                whole = pattern.fullmatch("".join(letters.get(x, "\0") for x in page.items)) is not None
                natures = match(page.items) if whole else None
                if natures is None:
                    texts.append(main_text(page, is_content))
                else:
                    texts.append(joined_text(page, [is_main(path, nature, region) for (path, _, _), nature in zip(page.slots, natures, strict=True)]))
                conforms.append(whole)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(conforms)],
                names=["page_id", "url", "text", "n_chars", "conforms"],
            )

    # written first: its size is then known, and while it is small Spark broadcasts it and moves no page
    inferred = shared_table(infer_wrappers(rows), "wrappers")
    return rows.join(inferred, "host").mapInArrow(run, "page_id long, url string, text string, n_chars long, conforms boolean")
