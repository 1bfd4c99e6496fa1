"""Token counts by finite-state transducers compiled from a tokenizer file.

Two deterministic transducers count the tokens of a word-end BPE tokenizer:

* The splitter reads character classes and marks where words start.  A batch
  of texts is cut into chunks of equal length; each chunk's state map (the end
  state for every start state) is computed for all chunks at once, the maps are
  composed by a parallel prefix scan, and a second pass with the start states
  then known emits the marks.  Chunks may cut words and texts anywhere.
* The word transducer reads a word's bytes, the last one marked as last.  Its
  state holds every vocabulary entry still being read together with the token
  before it; a transition carries the change in the number of tokens of the
  text read so far.  That number is decided by the last token alone, because a
  sequence of tokens is the tokenizer's own exactly if each adjacent pair is.
  States are compiled as they are met.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lodestar.llm.common import id_text, slices
from lodestar.llm.shingles import span_hashes

CHUNK = 256

# Character classes of the splitter.
SPACE, LETTER, NUMBER, OTHER, QUOTE, STMD, R, V, L, E = range(10)
# States of the splitter: between words, in letters, in other signs, after a quote that starts a word, after quote and r, v, l.
BETWEEN, LETTERS, SIGNS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L = range(7)


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
        elif kind == "Z":
            table[c] = SPACE
    table[[*range(9, 14), 0x85]] = SPACE
    for chars, kind in (("'", QUOTE), ("stmd", STMD), ("r", R), ("v", V), ("l", L), ("e", E)):
        table[[ord(c) for c in chars]] = kind
    return table


@lru_cache(maxsize=1)
def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks) by state and class; mark 1: a word starts here, 2: one started at the character before.

    Words are, first match first: 's 't 're 've 'm 'll 'd, a run of letters, a
    single number, a run of other signs.
    """
    step, mark = np.zeros((7, 10), np.uint8), np.zeros((7, 10), np.uint8)

    def from_between(c: int) -> tuple[int, int]:
        if c == SPACE:
            return BETWEEN, 0
        if c == NUMBER:
            return BETWEEN, 1
        if c == QUOTE:
            return QUOTED, 1
        return (SIGNS, 1) if c == OTHER else (LETTERS, 1)

    pending = {R: QUOTED_R, V: QUOTED_V, L: QUOTED_L}
    ends = {QUOTED_R: E, QUOTED_V: E, QUOTED_L: L}
    for c in range(10):
        is_letter = c in (LETTER, STMD, R, V, L, E)
        is_sign = c in (OTHER, QUOTE)
        for state in range(7):
            to, m = from_between(c)
            if state == LETTERS and is_letter:
                to, m = LETTERS, 0
            elif state in (SIGNS, QUOTED) and is_sign:
                to, m = SIGNS, 0
            elif state == QUOTED and c == STMD:
                to, m = BETWEEN, 0
            elif state == QUOTED and c in pending:
                to, m = pending[c], 0
            elif state in ends:
                if c == ends[state]:
                    to, m = BETWEEN, 0
                elif is_letter:
                    to, m = LETTERS, 2
                else:
                    m |= 2
            step[state, c], mark[state, c] = to, m
    return step, mark


def word_starts(classes: np.ndarray) -> np.ndarray:
    """Whether a word starts at each position of an array of classes that ends in a space."""
    step, mark = _splitter()
    n = len(classes)
    lanes = -(-n // CHUNK)
    grid = np.full(lanes * CHUNK, SPACE, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(lanes, CHUNK).T)
    flat = step.ravel()
    maps = np.tile(np.arange(7, dtype=np.uint8), (lanes, 1)).T.copy()  # by start state, then chunk
    for row in grid:
        maps = flat[maps * np.uint8(10) + row]
    reach = 1
    while reach < lanes:  # prefix scan: each map becomes the composition of all maps up to its chunk
        later = maps.copy()
        later[:, reach:] = np.take_along_axis(maps[:, reach:], maps[:, :-reach].astype(np.intp), 0)
        maps = later
        reach *= 2
    state = np.concatenate([[BETWEEN], maps[BETWEEN, :-1]]).astype(np.uint8)
    marks = np.empty_like(grid)
    flat_mark = mark.ravel()
    for i, row in enumerate(grid):
        at = state * np.uint8(10) + row
        marks[i] = flat_mark[at]
        state = flat[at]
    marks = marks.T.ravel()
    starts = (marks & 1).astype(bool)
    starts[:-1] |= (marks[1:] & 2).astype(bool)
    return starts[:n]


def _bytes_of_units() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    units = {chr(b): b for b in printable}
    units.update({chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(printable))})
    return units


class WordTransducer:
    """Counts the tokens of a word; symbols are bytes, plus 256 for the word's last byte."""

    MOST_STATES = 400_000

    def __init__(self, spec: dict):
        units, vocab = _bytes_of_units(), spec["model"]["vocab"]
        ends = spec["model"]["end_of_word_suffix"]

        def symbols(token: str) -> tuple[int, ...]:
            last = token.endswith(ends) and token != ends
            found = [units[c] for c in (token[: -len(ends)] if last else token)]
            return (*found[:-1], found[-1] + 256) if last else tuple(found)

        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(merges)}
        joined = {(a, b): vocab[a + b] for a, b in merges}
        self.joined = {(vocab[a], vocab[b]): t for (a, b), t in joined.items()}
        self.parts = {t: pair for pair, t in self.joined.items()}
        self.birth = {t: self.rank[pair] for t, pair in self.parts.items()}
        self.symbols = {i: symbols(t) for t, i in vocab.items()}
        self.single = {s[0]: i for i, s in self.symbols.items() if len(s) == 1}
        self.trie: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for i, s in self.symbols.items():
            if len(s) > 1 and (i not in self.parts or self._merge(s) != [i]):
                continue  # no text is ever encoded as this entry
            node = 0
            for x in s:
                if x not in self.trie[node]:
                    self.trie[node][x] = len(self.trie)
                    self.trie.append({})
                    self.token_at.append(-1)
                node = self.trie[node][x]
            self.token_at[node] = i
        ordered = all(max(self.birth.get(a, -1), self.birth.get(b, -1)) < r for (a, b), r in self.rank.items())
        self._adjacent = self._by_lifetimes if ordered else lambda u, t: self._merge(self.symbols[u] + self.symbols[t]) == [u, t]
        self.pairs: dict[tuple[int, int], bool] = {}
        self._clear()

    def _clear(self) -> None:
        start = ((0, -1, 0),)
        self.states, self.known, self.steps = [start], {start: 0}, [{}]

    def _merge(self, symbols: tuple[int, ...]) -> list[int]:
        """Plain BPE: the leftmost pair of least rank, again and again."""
        tokens = [self.single[s] for s in symbols]
        while len(tokens) > 1:
            r, i = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(tokens, tokens[1:], strict=False)))
            if r == 1 << 60:
                break
            tokens[i : i + 2] = [self.joined[tokens[i], tokens[i + 1]]]
        return tokens

    def _edge(self, token: int, side: int) -> list[tuple[int, float, float]]:
        """(piece, birth, death) of the pieces at the right (1) or left (0) edge of ``token`` while it is merged."""
        found, death = [], float("inf")
        while True:
            born = self.birth.get(token, -1)
            found.append((token, born, death))
            if token not in self.parts:
                return found
            death, token = born, self.parts[token][side]

    def _by_lifetimes(self, u: int, t: int) -> bool:
        """Whether no piece at u's right edge merges with one at t's left edge before either is merged on its own side."""
        left = self._edge(t, 0)
        for x, x_born, x_dies in self._edge(u, 1):
            for y, y_born, y_dies in left:
                if x_born < y_dies and y_born < x_dies:
                    r = self.rank.get((x, y))
                    if r is not None and r < x_dies and r <= y_dies:
                        return False
        return True

    def _follows(self, u: int, t: int) -> bool:
        key = (u, t)
        found = self.pairs.get(key)
        if found is None:
            found = self.pairs[key] = u < 0 or self._adjacent(u, t)
        return found

    def _compile(self, state: int, symbol: int) -> tuple[int, int]:
        """The transition of ``state`` under ``symbol``: (next state, change in the number of tokens)."""
        going, last, count = [], -1, 0
        for node, before, n in self.states[state]:
            child = self.trie[node].get(symbol)
            if child is None:
                continue
            going.append((child, before, n))
            token = self.token_at[child]
            if token >= 0 and self._follows(before, token):
                last, count = token, n + 1
        going = [(node, before, n - count) for node, before, n in going if self.trie[node]]
        to = (*going, (0, last, 0))
        number = self.known.get(to)
        if number is None:
            number = self.known[to] = len(self.states)
            self.states.append(to)
            self.steps.append({})
        self.steps[state][symbol] = found = (number, count)
        return found

    def count(self, word: bytes) -> int:
        if len(self.states) > self.MOST_STATES:
            self._clear()
            self.pairs.clear()
        state = total = 0
        steps, last = self.steps, len(word) - 1
        for i, byte in enumerate(word):
            symbol = byte + 256 if i == last else byte
            found = steps[state].get(symbol) or self._compile(state, symbol)
            state = found[0]
            total += found[1]
        return total


class TextCounter:
    """Counts the tokens of batches of texts for one tokenizer file."""

    MOST_WORDS = 1_000_000

    def __init__(self, spec_text: str):
        spec = json.loads(spec_text)
        self.words = WordTransducer(spec)
        marks = [t["content"] for t in spec.get("added_tokens", [])]
        self.marks = re.compile("|".join(re.escape(m) for m in sorted(marks, key=len, reverse=True))) if marks else None
        self.mark_start = min((m[:2] for m in marks), default="")
        self.counts: dict[int, int] = {}

    @staticmethod
    def normal(text: str) -> str:
        if text.isascii():
            return text.lower()
        # one character at a time: no rule for a sigma at the end of a word
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def __call__(self, texts: list[str]) -> np.ndarray:
        special = np.zeros(len(texts), np.int64)
        plain = []
        for i, t in enumerate(texts):
            if self.marks and self.mark_start in t:
                parts = self.marks.split(t)
                special[i] = len(parts) - 1
                plain.append(" ".join(self.normal(p) for p in parts))
            else:
                plain.append(self.normal(t))
        lengths = np.array([len(t) + 1 for t in plain])
        points = np.frombuffer((" ".join(plain) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        classes = code_point_classes()[points]
        starts = word_starts(classes)
        blank = classes == SPACE
        first = np.flatnonzero(starts)
        if not len(first):
            return special
        end = np.flatnonzero(~blank[:-1] & (starts[1:] | blank[1:])) + 1
        hashes = span_hashes(points, first, end)
        distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.counts) > self.MOST_WORDS:
            self.counts.clear()
        known, found = self.counts, np.empty(len(distinct), np.int64)
        joined = None
        for j, h in enumerate(distinct.tolist()):
            n = known.get(h)
            if n is None:
                if joined is None:
                    joined = " ".join(plain)
                at = where[j]
                n = known[h] = self.words.count(joined[first[at] : end[at]].encode("utf-8", "surrogatepass"))
            found[j] = n
        running = np.concatenate([[0], np.cumsum(found[inverse])])
        bounds = np.searchsorted(first, np.concatenate([[0], np.cumsum(lengths)]))
        return special + running[bounds[1:]] - running[bounds[:-1]]


_COUNTERS: dict[str, TextCounter] = {}


def count_tokens(docs: DataFrame, spec_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit), and the columns in ``keep``.

    ``spec_path`` is a tokenizer JSON file that the driver can read; its text
    (a few MB) is sent to the workers.  Counts are those of the tokenizers
    library without added special tokens; special strings inside a text count
    as the one token they are by default.  Null text is empty: 0 and 0.
    Repeated rows are counted each; an empty table gives no rows.  No shuffle.
    """
    with open(spec_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(spec_path)
        for batch in slices(batches, text_col, 4 << 20):
            if counter is None:
                counter = _COUNTERS[spec_path] = TextCounter(spec.value)
            column = batch.column(text_col)
            tokens = counter(column.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pc.binary_length(column).cast(pa.int64()), pa.array(tokens), pa.array(tokens > limit), *map(batch.column, keep)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit", *keep],
            )

    kept = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return id_text(docs, id_col, text_col, *keep).mapInArrow(run, f"{id_col} long, n_bytes long, n_tokens long, over_limit boolean{kept}")
