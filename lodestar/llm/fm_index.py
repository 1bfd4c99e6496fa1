"""FM-index over a delimited vocabulary with batched searches that allow one error, in numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(codes: np.ndarray, least_depth: int) -> np.ndarray:
    """Starts of the suffixes in order of their first ``least_depth`` codes (at least); codes are 0 or more."""
    n = len(codes)
    base = int(codes.max()) + 2  # the end of the text sorts before every code
    depth = max(1, int(62 / np.log2(base)))
    key = np.zeros(n, np.int64)
    for i in range(depth):
        key *= base
        if i < n:
            key[: n - i] += codes[i:] + 1
    order = np.argsort(key, kind="stable")
    while True:
        new = np.concatenate([[False], key[order[1:]] != key[order[:-1]]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if depth >= least_depth or rank[order[-1]] == n - 1:
            return order
        key = rank * (n + 1)
        key[: max(0, n - depth)] += rank[depth:] + 1
        order = np.argsort(key, kind="stable")
        depth *= 2


class FMIndex:
    """Words joined as $w$w$..$; intervals of suffix ranks, extended to the left for many patterns at once.

    All (code, row) places of the Burrows-Wheeler text are one sorted array, so
    the rank that starts code c's part after ``i`` rows is one binary search.
    """

    def __init__(self, words: list[np.ndarray], sigma: int):
        """``words`` hold codes 1 to sigma; 0 is the delimiter."""
        self.sigma = sigma
        ends = np.cumsum([len(w) + 1 for w in words])
        text = np.zeros(int(ends[-1]) + 1, np.int64)
        letters = np.ones(len(text), bool)
        letters[0] = letters[ends] = False
        text[letters] = np.concatenate(words)
        self.begins = np.concatenate([[0], ends[:-1]])  # the delimiter before each word
        longest = max(len(w) for w in words)
        self.n = len(text)
        self.suffixes = suffix_array(text, longest + 3)
        self.bwt = text[self.suffixes - 1]  # the text begins and ends with a delimiter: rank 0's code is that of the last place
        self.keys = np.sort(self.bwt * self.n + np.arange(self.n))

    def extend(self, code, rank: np.ndarray) -> np.ndarray:
        """The bound of code + pattern from a bound of the pattern."""
        return np.searchsorted(self.keys, np.asarray(code, np.int64) * self.n + rank)

    def letters_before(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the interval, code) of letters that may stand before the intervals: those in short ones, all for long ones."""
        wide = high - low > self.sigma
        size = np.where(wide, self.sigma, high - low)
        which = np.repeat(np.arange(len(low)), size)
        step = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        code = np.where(wide[which], step + 1, self.bwt[np.minimum(low[which] + step, self.n - 1)])
        both = np.unique(which * (self.sigma + 1) + code)
        which, code = np.divmod(both, self.sigma + 1)
        return which[code > 0], code[code > 0]

    def one_error(self, queries: list[np.ndarray], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all pairs one edit apart whose last ``exact`` letters of the query end the word.

        The exact end is matched from its delimiter to the left, then the rest
        letter by letter; before each of its letters one may be inserted,
        replaced or left out, and a match counts if a delimiter comes before it.
        Equal words are not one edit apart.
        """
        lengths = np.array([len(q) for q in queries], np.int64)
        flat = np.concatenate(queries)
        first = np.cumsum(lengths) - lengths
        order = np.argsort(-exact, kind="stable")  # those still being matched stay in front
        low = np.zeros(len(queries), np.int64)
        high = np.full(len(queries), len(self.begins) + 1, np.int64)
        for step in range(int(exact.max(initial=0))):
            q = order[: np.searchsorted(-exact[order], -step)]
            q = q[low[q] < high[q]]
            code = flat[first[q] + lengths[q] - 1 - step]
            low[q], high[q] = self.extend(code, low[q]), self.extend(code, high[q])

        query = np.flatnonzero(low < high)
        rest, low, high = (lengths - exact)[query], low[query], high[query]
        bad = tuple(np.empty(0, np.int64) for _ in range(4))  # query, rest, low, high after the error
        pairs_q, pairs_w = [], []
        while len(query) or len(bad[0]):
            which, code = self.letters_before(low, high)
            l, h = self.extend(code, low[which]), self.extend(code, high[which])
            some = l < h
            which, code, l, h = which[some], code[some], l[some], h[some]
            more = rest[which] > 0
            other = more & (code != flat[np.where(more, first[query[which]] + rest[which] - 1, 0)])
            left = np.flatnonzero(rest > 0)
            # letters left out, inserted, replaced; and those that erred before
            bad_q, bad_r, bad_l, bad_h = (
                np.concatenate(parts)
                for parts in zip(
                    bad,
                    (query[left], rest[left] - 1, low[left], high[left]),
                    (query[which], rest[which], l, h),
                    (query[which[other]], rest[which[other]] - 1, l[other], h[other]),
                    strict=True,
                )
            )
            done = bad_r == 0
            l, h = self.extend(0, bad_l[done]), self.extend(0, bad_h[done])
            hit = l < h  # $word$ is there once: words are distinct
            pairs_q.append(bad_q[done][hit])
            pairs_w.append(np.searchsorted(self.begins, self.suffixes[l[hit]]))
            bad_q, bad_r, bad_l, bad_h = bad_q[~done], bad_r[~done], bad_l[~done], bad_h[~done]
            code = flat[first[bad_q] + bad_r - 1]
            bad_l, bad_h = self.extend(code, bad_l), self.extend(code, bad_h)
            some = bad_l < bad_h
            bad = bad_q[some], bad_r[some] - 1, bad_l[some], bad_h[some]
            query, rest, low, high = query[left], rest[left], low[left], high[left]
            if len(query):
                code = flat[first[query] + rest - 1]
                low, high = self.extend(code, low), self.extend(code, high)
                some = low < high
                query, rest, low, high = query[some], rest[some] - 1, low[some], high[some]
        q, w = np.concatenate(pairs_q or [np.empty(0, np.int64)]), np.concatenate(pairs_w or [np.empty(0, np.int64)])
        both = np.unique(q * len(self.begins) + w)
        return np.divmod(both, len(self.begins))
