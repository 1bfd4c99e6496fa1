"""Byte-level BPE encoding and decoding with DuckDB recursive queries, one database in memory per worker.

Within a batch of a partition the pieces of the texts are cut, and each piece
not yet known goes as (position, token) rows into a recursive query.  A round
joins the rows of neighbours with the merge table and contracts every piece's
leftmost pair of least rank; a piece without such a pair stays as it is.
Decoding joins the tokens of the documents with the vocabulary and aggregates
the bytes in order of position.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodestar.llm.common import id_text, slices
from lodestar.llm.shingles import span_hashes
from lodestar.llm.token_counts import NUMBER, SPACE, code_point_classes

_BREAK = 0x110000  # after every text; not a code point
_LETTERS, _NUMBERS, _SIGNS, _SPACES, _END = range(5)

#: k is the piece's number and, in the low 20 bits, the position in it.
CONTRACT = """
with recursive state(step, k, tok) as (
    select 0, k, tok from given
    union all
    (
        with pairs as materialized (
            select step, k, tok, lead(tok) over w as next_tok, lead(k) over w as next_k, lag(k) over w as last_k
            from state window w as (order by k)
        ), best as (
            select k >> 20 as piece, min((merged::bigint << 20) | (k & 1048575)) as b
            from pairs join merges on l = tok and r = next_tok
            where next_k >> 20 = k >> 20
            group by 1
        )
        select step + 1, k, case when k & 1048575 = b & 1048575 then (b >> 20)::int else tok end
        from pairs join best on k >> 20 = piece
        where last_k is null or last_k >> 20 <> k >> 20 or last_k & 1048575 <> b & 1048575
    )
)
select k, tok from state qualify step = max(step) over (partition by k >> 20) order by k
"""
DECODE = "select doc, list(bytes order by pos) as pieces from tokens join vocab using (id) group by doc order by doc"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=1)
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """(kind of every code point and of the break, whether it is a white space other than the blank)."""
    classes = code_point_classes()
    kinds = np.full(len(classes) + 1, _LETTERS, np.uint8)
    kinds[:-1][classes == SPACE] = _SPACES
    kinds[:-1][classes == NUMBER] = _NUMBERS
    kinds[:-1][(classes == 3) | (classes == 4)] = _SIGNS
    kinds[_BREAK] = _END
    return kinds


def cut(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the pieces in texts that each end in a break.

    Pieces, first match first: 's 't 're 've 'm 'll 'd; an optional blank and
    a run of letters, of numbers or of other signs; white space up to, but not
    with, the last one before another character; other white space.
    """
    kind = _kinds()[points]
    n = len(points)
    before = np.concatenate([[_END], kind[:-1]])
    point_before = np.concatenate([[_BREAK], points[:-1]])
    visible = kind < _SPACES
    start = visible & (kind != before)

    def after(i: np.ndarray, by: int) -> np.ndarray:
        return points[np.minimum(i + by, n - 1)]

    quotes = np.flatnonzero((points == ord("'")) & (before != _SIGNS) & (point_before != ord(" ")))
    a, b = after(quotes, 1), after(quotes, 2)
    two = np.isin(a, [ord(c) for c in "stmd"])
    three = np.zeros(len(quotes), bool)
    for pair in ("re", "ve", "ll"):
        three |= (a == ord(pair[0])) & (b == ord(pair[1]))
    start[quotes[two | three] + 1] = False
    ends_at = np.concatenate([quotes[two] + 2, quotes[three] + 3])
    start[ends_at[kind[ends_at] == _LETTERS]] = True

    led = np.flatnonzero(start & (point_before == ord(" ")))
    start[led] = False
    start[led - 1] = True
    space = kind == _SPACES
    run_first = space & (before != _SPACES)
    run_last = space & (np.concatenate([kind[1:], [_END]]) < _SPACES)  # before a visible character
    start |= run_last
    start |= run_first
    starts = np.flatnonzero(start)
    ends = np.concatenate([starts[1:], [n]])
    breaks = np.flatnonzero(kind == _END)
    ends = np.minimum(ends, breaks[np.searchsorted(breaks, starts)]) if len(starts) else ends[:0]
    return starts, ends


class Codec:
    """Encodes and decodes batches for one vocabulary."""

    MOST_PIECES = 1_000_000
    PIECES_A_QUERY = 20_000
    WINDOW = 192

    def __init__(self, ranks: dict[bytes, int]):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            self.size[rank] = len(token)
            for i in range(1, len(token)):
                l, r = ranks.get(token[:i]), ranks.get(token[i:])
                if l is not None and r is not None:
                    left.append(l)
                    right.append(r)
                    merged.append(rank)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        for name, table in (
            ("merges", pa.table({"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "merged": pa.array(merged, pa.int32())})),
            ("vocab", pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "bytes": pa.array(list(ranks), pa.binary())})),
        ):
            self.db.register("loaded", table)
            self.db.execute(f"create table {name} as select * from loaded")
            self.db.unregister("loaded")
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, tuple[int, int]] = {}
        self.store, self.used = np.empty(1 << 20, np.int32), 0

    def _contract(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The tokens of each piece; every piece shorter than 2**20 bytes."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        number = np.repeat(np.arange(len(pieces)), sizes)
        position = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.db.register("given", pa.table({"k": (number << 20) | position, "tok": self.single[raw]}))
        out = self.db.execute(CONTRACT).fetchnumpy()
        self.db.unregister("given")
        bounds = np.searchsorted(out["k"] >> 20, np.arange(len(pieces) + 1))
        return [out["tok"][a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _windowed(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The tokens of long pieces, from overlapping windows.

        Where two windows agree on a token that starts at the same place, the
        first can be left for the second: a sequence is the encoding if each
        adjacent pair of tokens is, and every pair then is one of a window.
        Windows that never agree are doubled, up to the whole piece.
        """
        found: list[np.ndarray | None] = [None] * len(pieces)
        width, left = self.WINDOW, list(range(len(pieces)))
        while left:
            if width >= 1 << 20:
                raise ValueError("windows of 1 MB that never agree")
            step = width // 2
            begins = [list(range(0, max(1, len(pieces[i]) - step), step)) for i in left]
            coded = iter(self._contract([pieces[i][b : b + width] for i, all_b in zip(left, begins, strict=True) for b in all_b]))
            for i, all_b in zip(left, begins, strict=True):
                found[i] = self._stitched(all_b, [next(coded) for _ in all_b])
            left = [i for i in left if found[i] is None]
            width *= 2
        return found

    def _stitched(self, begins: list[int], coded: list[np.ndarray]) -> np.ndarray | None:
        """One encoding from those of overlapping windows; None where two of them do not agree."""
        places = [b + np.concatenate([[0], np.cumsum(self.size[t])[:-1]]) for b, t in zip(begins, coded, strict=True)]
        out, at = [], 0
        for i, tokens in enumerate(coded):
            if i + 1 == len(coded):
                out.append(tokens[places[i] >= at])
                break
            both, mine, theirs = np.intersect1d(places[i], places[i + 1], return_indices=True)
            same = both[(tokens[mine] == coded[i + 1][theirs]) & (both >= at)]
            if not len(same):
                return None
            out.append(tokens[(places[i] >= at) & (places[i] < same[0])])
            at = same[0]
        return np.concatenate(out)

    def _learn(self, hashes: list[int], pieces: list[bytes]) -> None:
        for at in range(0, len(pieces), self.PIECES_A_QUERY):
            some = pieces[at : at + self.PIECES_A_QUERY]
            tokens: list[np.ndarray] = [np.empty(0, np.int32)] * len(some)
            short = [i for i, p in enumerate(some) if len(p) <= self.WINDOW]
            long = [i for i, p in enumerate(some) if len(p) > self.WINDOW]
            for which, coder in ((short, self._contract), (long, self._windowed)):
                for i, t in zip(which, coder([some[i] for i in which]) if which else [], strict=True):
                    tokens[i] = t
            flat = np.concatenate(tokens)
            while self.used + len(flat) > len(self.store):
                self.store = np.concatenate([self.store, np.empty_like(self.store)])
            self.store[self.used : self.used + len(flat)] = flat
            for h, t in zip(hashes[at : at + len(some)], tokens, strict=True):
                self.known[h] = (self.used, len(t))
                self.used += len(t)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, first id of each text and one past the last)."""
        points = np.frombuffer("".join(t + "\0" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        breaks = np.cumsum([len(t) + 1 for t in texts]) - 1
        points[breaks] = _BREAK
        starts, ends = cut(points)
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        hashes, where, inverse = np.unique(span_hashes(points, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > self.MOST_PIECES:
            self._clear()
        listed = hashes.tolist()
        fresh = [j for j, h in enumerate(listed) if h not in self.known]
        if fresh:
            pieces = [points[starts[j] : ends[j]].tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass") for j in where[fresh]]
            self._learn([listed[j] for j in fresh], pieces)
        at, size = np.array([self.known[h] for h in listed], np.int64).T
        sizes = size[inverse]
        running = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.store[np.repeat(at[inverse] - running[:-1], sizes) + np.arange(running[-1])]
        return ids, running[np.searchsorted(starts, np.concatenate([[0], breaks]))]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of each text."""
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.db.register("tokens", pa.table({"doc": doc, "pos": np.arange(len(ids)), "id": ids}))
        found = self.db.sql(DECODE).to_arrow_table().combine_chunks()
        self.db.unregister("tokens")
        out = [b""] * (len(bounds) - 1)
        for chunk in found.to_batches():
            lists = chunk.column("pieces")
            ends = lists.offsets.to_numpy()
            data = lists.values  # binary, so its bytes lie in order in one buffer
            kind = np.int64 if data.type in ("large_binary",) else np.int32
            places = np.frombuffer(data.buffers()[1], kind)[data.offset : data.offset + len(data) + 1]
            raw = memoryview(data.buffers()[2]) if data.buffers()[2] is not None else memoryview(b"")
            for d, a, b in zip(chunk.column("doc").to_pylist(), places[ends[:-1]], places[ends[1:]], strict=True):
                out[d] = bytes(raw[a:b])
        return out


_CODECS: dict[str, Codec] = {}


def encode_decode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (array of int), decoded (binary): the tokens of the text and their bytes.

    ``ranks_path`` is a file of base64 tokens and ranks that the driver can
    read; the ranks are sent to the workers.  Ids are those of the tiktoken
    library without special tokens.  Null text is empty: no ids, no bytes.
    Repeated rows are encoded each; an empty table gives no rows.  No shuffle.
    """
    return _mapped(docs, ranks_path, id_col, text_col, "ids array<int>, decoded binary", _whole)


def digests(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`encode_decode`, with n_tokens, ids_sha256 (little-endian unsigned 32-bit ids) and decoded_sha256 instead."""
    return _mapped(docs, ranks_path, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digest)


def _whole(ids: list[np.ndarray], decoded: list[bytes]) -> tuple[list[pa.Array], list[str]]:
    return [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())], ["ids", "decoded"]


def _digest(ids: list[np.ndarray], decoded: list[bytes]) -> tuple[list[pa.Array], list[str]]:
    shas = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]
    texts = [hashlib.sha256(x).hexdigest() for x in decoded]
    return [pa.array([len(x) for x in ids], pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"]


def _mapped(docs: DataFrame, ranks_path: str, id_col: str, text_col: str, columns: str, made) -> DataFrame:
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, 4 << 20):
            if ranks_path not in _CODECS:
                _CODECS[ranks_path] = Codec(ranks.value)
            codec = _CODECS[ranks_path]
            ids, bounds = codec.encode(batch.column(text_col).to_pylist())
            arrays, names = made([ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)], codec.decode(ids, bounds))
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *arrays], names=[id_col, *names])

    return id_text(docs, id_col, text_col).mapInArrow(run, f"{id_col} long, {columns}")
