"""Hashed word shingles and their MinHash signatures, in numpy."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64(0xD1342543DE82EF95)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation that spreads every input bit."""
    spare = x >> np.uint64(30)
    x = x ^ spare
    x *= _MIX1
    x ^= np.right_shift(x, np.uint64(27), out=spare)
    x *= _MIX2
    x ^= np.right_shift(x, np.uint64(31), out=spare)
    return x


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None, rows: int = 1 << 14) -> np.ndarray:
    """A 64-bit hash of each span of ``symbols`` (or of what ``table`` has for them), given in order and without overlap.

    Every symbol is mixed with its place in its span before the span is summed
    up, so no pattern of symbols, such as a word and its mirror or complement,
    cancels out; unlike spans meet with a probability of 2**-64.  ``rows`` at a
    time, which stay in the processor's cache.
    """
    n = len(symbols)
    sums = np.zeros(n + 1, np.uint64)
    before = np.zeros(n, np.uint64)
    if len(starts):
        before[starts[0] :] = np.repeat(starts.astype(np.uint64) * _PLACE, np.diff(starts, append=n))
    step, spare = np.arange(1, rows + 1, dtype=np.uint64) * _PLACE, np.empty(rows, np.uint64)
    for at in range(0, n, rows):
        part = symbols[at : at + rows]
        x = part.astype(np.uint64) if table is None else table[part]
        t = spare[: len(x)]
        x *= _ODD
        x += step[: len(x)]
        np.subtract(before[at : at + rows], np.uint64(at * int(_PLACE) % 2**64), out=t)
        x -= t
        for shift, times in ((30, _MIX1), (27, _MIX2), (31, None)):
            np.right_shift(x, np.uint64(shift), out=t)
            x ^= t
            if times is not None:
                x *= times
        out = sums[at + 1 : at + 1 + len(x)]
        np.cumsum(x, out=out)
        out += sums[at]
    return mix(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64))


class MinHash:
    """``size`` minima of a set under fixed random linear permutations, 16 low-order bits of each."""

    def __init__(self, size: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.times = rng.integers(0, 2**63, size, np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = rng.integers(0, 2**63, size, np.uint64)

    def of(self, items: np.ndarray, rows: int = 4096) -> np.ndarray:
        low = np.full(len(self.times), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(items), rows):
            low = np.minimum(low, (self.times[:, None] * items[None, at : at + rows] + self.plus[:, None]).min(1))
        return (low & np.uint64(0xFFFF)).astype(np.uint16)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(7).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]


def word_hashes(column) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each row and one past the last) of an Arrow string column without nulls.

    Words are runs of anything but x20, x09-x0D, with A-Z lower-cased.  Hashes
    come from running sums over the whole buffer, so no Python object is made
    for a word.
    """
    kind = np.int64 if column.type == "large_string" else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    rows = offsets - offsets[0]
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    word = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[rows] = True
    starts = np.flatnonzero(word & (edge[:-1] | np.concatenate([[True], ~word[:-1]])))
    ends = np.flatnonzero(word & (edge[1:] | np.concatenate([~word[1:], [True]]))) + 1
    hashes = span_hashes(raw, starts, ends, _BYTE)
    return hashes, np.searchsorted(starts, rows)


def shingle_sets(column, width: int):
    """Yields each row's sorted distinct shingle hashes; fewer words than ``width``: the whole sequence as one."""
    words, first = word_hashes(column)
    whole = np.full(max(0, len(words) - width + 1), width, np.uint64)
    for i in range(width):
        whole = mix(whole * _ODD + words[i : i + len(whole)])
    for a, b in zip(first, first[1:], strict=False):
        if b - a >= width:
            found = np.sort(whole[a : b - width + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif b > a:
            value = np.full(1, b - a, np.uint64)
            for h in words[a:b]:
                value = mix(value * _ODD + h)
            yield value
        else:
            yield np.empty(0, np.uint64)
