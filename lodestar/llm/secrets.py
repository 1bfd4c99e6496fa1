"""Secret scans: fixed base patterns plus assignment-aware lexing.

The lexer reads lines of source or configuration text as (name, literal)
pairs, remembers what each plain name was bound to, follows names and ``+``
concatenations back to their literals, and scores a literal by the target
name it reaches and by its own shape.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from lodestar.llm.common import id_text, slices

# Fixed values of the base scan: patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "literal")

#: Weight of a name part; a name scores the largest weight among its parts.  The least one lets a
#: random literal of two kinds of characters reach THRESHOLD.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7,
    "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
    "auth": 0.7, "bearer": 0.8, "private": 0.7, "key": 0.7, "dsn": 0.7, "cookie": 0.7, "signature": 0.7,
}
THRESHOLD = 0.55

_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*"
_PAIR = re.compile(
    rf"""(?P<quote>["']?)(?<![A-Za-z0-9_.\-])(?P<name>{_NAME}+)(?P=quote)[\x20\t]*(?::=|=>|=(?!=)|:(?![:/]))[\x20\t]*"""
    rf"""(?P<rhs>(?:"[^"\n]*"|'[^'\n]*'|[^\s"',;#(){{}}\[\]<>]+)(?:[\x20\t]*\+[\x20\t]*(?:"[^"\n]*"|'[^'\n]*'|{_NAME}))*)"""
)
_TERM = re.compile(r""""([^"\n]*)"|'([^'\n]*)'|([^\s"'+]+)""")
_PLAIN = re.compile(_NAME)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points, end exclusive, ordered by start, then kind."""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return ordered(spans)


def ordered(spans: Iterable[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def name_weight(name: str) -> float:
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max((SENSITIVE.get(p, 0.0) for p in parts + joined), default=0.0)


def literal_shape(value: str) -> float:
    """0 to 1: length and variety of characters; words of prose and placeholders score low."""
    return _shape(Counter(value), len(value))


def _shape(counts: dict[str, int], length: int) -> float:
    if length < 8 or len(counts) < 5 or any(c.isspace() for c in counts):
        return 0.0
    total = sum(counts.values())
    entropy = -sum(n / total * math.log2(n / total) for n in counts.values())
    kinds = sum((any(c.islower() for c in counts), any(c.isupper() for c in counts), any(c.isdigit() for c in counts), not all(c.isalnum() for c in counts)))
    return min(1.0, entropy / 4) * (0.45 + 0.2 * min(kinds, 3) if kinds > 1 else 0.3)


class _Value:
    """What a name is bound to: how often each character occurs, the length, and the tree of its literals.

    ``tree`` is a literal's (start, end), or a list of the trees it is put
    together from.  Trees are shared between values, counts are not, so a
    binding costs as much as its different characters, not its whole chain.
    """

    __slots__ = ("counts", "length", "tree")

    def __init__(self, counts: dict[str, int], length: int, tree: tuple[int, int] | list):
        self.counts, self.length, self.tree = counts, length, tree


def _joined(parts: list[_Value]) -> _Value:
    """The concatenation of ``parts``; a part named twice in one expression counts once."""
    parts = list({id(p.tree): p for p in parts}.values())
    if len(parts) == 1:
        return parts[0]
    counts = Counter(parts[0].counts)
    for p in parts[1:]:
        for c, n in p.counts.items():
            counts[c] += n
    length = sum(p.length for p in parts)
    if length > 1 << 60:  # values that double from line to line: only the shares of characters matter
        counts, length = Counter({c: max(1, n >> 30) for c, n in counts.items()}), length >> 30
    return _Value(counts, length, [p.tree for p in parts])


def literal_spans(text: str) -> list[Span]:
    """Literals that reach a sensitive name, directly, through other names or as part of a concatenation.

    A name bound twice keeps its latest binding; a chain of names resolves in
    one step because every binding stores what it reached.  A literal is
    reported once.  The time is linear in the text for a given alphabet: a line
    adds the counts of its operands and visits only trees not reported yet.
    """
    found: list[Span] = []
    bound: dict[str, _Value] = {}
    told: dict[int, object] = {}  # reported trees by identity; held, so that an identity is not used again
    offset = 0
    for line in text.split("\n"):
        if "=" in line or ":" in line:
            for m in _PAIR.finditer(line):
                parts: list[_Value] = []
                at = offset + m.start("rhs")
                for t in _TERM.finditer(m["rhs"]):
                    group = t.lastindex
                    if group == 3 and _PLAIN.fullmatch(t[3]) and t[3] in bound:
                        parts.append(bound[t[3]])
                    else:
                        parts.append(_Value(Counter(t[group]), len(t[group]), (at + t.start(group), at + t.end(group))))
                value = bound[m["name"]] = _joined(parts) if parts else _Value({}, 0, [])
                if (weight := name_weight(m["name"])) and weight * _shape(value.counts, value.length) >= THRESHOLD:
                    open_trees = [value.tree]
                    while open_trees:
                        tree = open_trees.pop()
                        if id(tree) in told:
                            continue
                        told[id(tree)] = tree
                        if isinstance(tree, list):
                            open_trees += tree
                        elif tree[1] > tree[0]:
                            found.append(("literal", *tree))
        offset += len(line) + 1
    return found


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans); a literal inside a base span adds nothing."""
    base = base_spans(text)
    found = literal_spans(text) if "=" in text or ":" in text else []
    starts, reach = [a for _, a, _ in base], list(accumulate((b for *_, b in base), max))

    def covered(start: int, end: int) -> bool:
        i = bisect_right(starts, start)
        return i > 0 and reach[i - 1] >= end

    return base, ordered(base + [s for s in found if not covered(s[1], s[2])])


def join_spans(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, counts by base kind, digest of the base spans, and all spans.

    Whole texts; null or empty text gives zero counts and an empty span list;
    repeated rows are scanned each; other columns are not read.  No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            rows = [scan(t) for t in batch.column(text_col).to_pylist()]
            counts = [Counter(k for k, _, _ in base) for base, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col),
                    *(pa.array([c[k] for c in counts], pa.int64()) for k in KINDS[:3]),
                    pa.array([hashlib.sha256(join_spans(base).encode()).hexdigest() for base, _ in rows], pa.string()),
                    pa.array([join_spans(every) for _, every in rows], pa.string()),
                ],
                names=[id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return id_text(docs, id_col, text_col).mapInArrow(
        run, f"{id_col} long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact(text: str, mark: str = "[SECRET]") -> str:
    """``text`` with every span of :func:`scan` replaced; overlapping spans become one mark."""
    out, at = [], 0
    spans = scan(text)[1]
    i = 0
    while i < len(spans):
        start, end = spans[i][1:]
        while i + 1 < len(spans) and spans[i + 1][1] <= end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], mark]
        at = end
        i += 1
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with secrets masked in ``text_col``; ``length_col``, if there, is brought up to date.

    Rows, order within partitions and all other columns stay; null text stays
    null and a text without secrets stays as it is.
    """
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            old = batch.column(text_col).to_pylist()
            new = [t and redact(t) for t in old]
            at = batch.schema.get_field_index(text_col)
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            if length_col in batch.schema.names:
                at = batch.schema.get_field_index(length_col)
                kind = batch.schema.field(at)
                lengths = [n if a == b or b is None else len(b) for n, a, b in zip(batch.column(length_col).to_pylist(), old, new, strict=True)]
                batch = batch.set_column(at, kind, pa.array(lengths, kind.type))
            yield batch

    return docs.mapInArrow(run, schema)
