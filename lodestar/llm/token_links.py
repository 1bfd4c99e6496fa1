"""Alignment of two tokenizers over a corpus, and how often their ids are linked.

Both libraries report the span of every token.  Places where a token of each
ends cut the text into groups.  Spans give these places coarsely: several
tokens that lie in one character (byte-level pieces, byte-fallback tokens)
cannot be told apart by them, and their ends are refined by the decoded bytes.

A text is tokenized fragment by fragment: neither tokenizer has a token that
runs over a blank between two visible characters (checked when the files are
read), so fragments cut there give the tokens of the whole text, and a
fragment is aligned once for all its occurrences in a block of documents.  The
pairs of a block are counted within the task; what is shuffled is one row per
block and pair, not per document or occurrence.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import id_text, shared_table, slices

BLOCK_BYTES = 4 << 20
LARGE_GROUP = 4096
ADDED = 32_768  # fragments aligned at a time
_MARK = "▁"


def _byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Aligned:
    """Figures of each fragment, its groups as text, and its links as (first, pair, times); a pair is a-id << 32 | b-id."""

    whole: np.ndarray  # both token sequences decode to the fragment
    figures: np.ndarray  # n_a, n_b, n_groups, n_links; zeros if not whole
    groups: list[bytes]  # each group ends in a semicolon
    first: np.ndarray
    pair: np.ndarray
    times: np.ndarray

    def with_more(self, *others: Aligned) -> Aligned:
        every = (self, *others)
        counts = np.concatenate([np.diff(x.first) for x in every])
        return Aligned(
            np.concatenate([x.whole for x in every]),
            np.concatenate([x.figures for x in every]),
            [g for x in every for g in x.groups],
            np.concatenate([[0], np.cumsum(counts)]),
            np.concatenate([x.pair for x in every]),
            np.concatenate([x.times for x in every]),
        )


def token_ends(spans: np.ndarray, clear: np.ndarray, decoded: np.ndarray) -> np.ndarray:
    """End of every token in bytes: that of its span where the span is clear, else that of the decoded bytes.

    A span is not clear if its token ends inside a character, so that the next
    one begins before it ends or it is empty itself.
    """
    return np.where(clear, spans, decoded)


def links_of(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, times) in order of groups; ids of large groups are counted first, so that equal pairs are one."""
    n_a, n_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    large = n_a * n_b > LARGE_GROUP
    small = ~large[group_a]
    of, repeated = group_a[small], n_b[group_a[small]]
    step = np.arange(repeated.sum()) - np.repeat(np.cumsum(repeated) - repeated, repeated)
    group = np.repeat(of, repeated)
    pair = np.repeat(ids_a[small], repeated) << 32 | ids_b[np.searchsorted(group_b, group) + step]
    times = np.ones(len(pair), np.int64)
    if large.any():
        parts = [(group, pair, times)]
        for g in np.flatnonzero(large).tolist():
            x, times_x = np.unique(ids_a[slice(*np.searchsorted(group_a, [g, g + 1]))], return_counts=True)
            y, times_y = np.unique(ids_b[slice(*np.searchsorted(group_b, [g, g + 1]))], return_counts=True)
            found = (x[:, None] << 32 | y[None, :]).ravel()
            parts.append((np.full(len(found), g), found, (times_x[:, None] * times_y[None, :]).ravel()))
        group, pair, times = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(group, kind="stable")
        group, pair, times = group[order], pair[order], times[order]
    return group, pair, times


class Aligner:
    """Aligns fragments by a byte-level tokenizers JSON (A) and a sentencepiece model (B).

    Fragments met before are remembered; the memory is cleared when full, which
    costs time but changes nothing.
    """

    MOST_HELD = 500_000

    def __init__(self, spec: bytes, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec.decode())
        self.a.encode_special_tokens = True
        bytes_of = _byte_of_char()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            known = all(c in bytes_of for c in token)
            self.bytes_a[i] = bytes(bytes_of[c] for c in token) if known else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        self.cuttable = self._keeps_blanks_first(json.loads(spec), pieces, model)
        shown = max(len(self.bytes_a), len(self.bytes_b))
        self.held: dict[str, int] = {}
        self.known = self.add([])
        self.shown = pa.array([f"{i}{sign}".encode() for i in range(shown) for sign in ",|;"], pa.large_binary())

    @staticmethod
    def _keeps_blanks_first(spec: dict, pieces: list[str], model: bytes) -> bool:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        split = spec.get("pre_tokenizer") or {}
        return (
            spec.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and proto.normalizer_spec.name == "identity"
            and proto.normalizer_spec.add_dummy_prefix
            and not proto.normalizer_spec.remove_extra_whitespaces
            and proto.trainer_spec.model_type == proto.trainer_spec.BPE
            and not any(_MARK in p.lstrip(_MARK) for p in pieces)
        )

    def look_up(self, fragments: list[str]) -> tuple[Aligned, np.ndarray]:
        """The alignments held, and the place of each of the distinct ``fragments`` in them."""
        new = [f for f in fragments if f not in self.held]
        if len(self.held) + len(new) > self.MOST_HELD:
            self.held, self.known, new = {}, self.add([]), fragments
        if new:
            n = len(self.held)
            self.held.update(zip(new, range(n, n + len(new)), strict=True))
            parts = [self.add(new[at : at + ADDED]) for at in range(0, len(new), ADDED)]
            self.known = self.known.with_more(*parts)
        return self.known, np.fromiter(map(self.held.__getitem__, fragments), np.int64, len(fragments))

    def _tokens(self, fragments: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For A and for B: tokens of each fragment, ids, begins and ends of the spans.

        If B's model is known not to change its text, no spans are asked of it:
        a token's span is as long as its piece, and ids come at half the cost.
        """
        parts: tuple[list, list] = ([], [])
        for at in range(0, len(fragments), 4096):
            part = fragments[at : at + 4096]
            encoded = self.a.encode_batch(part, add_special_tokens=False)
            ids = [e.ids for e in encoded]
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = itertools.chain.from_iterable(itertools.chain.from_iterable(e.offsets for e in encoded))
            spans = np.fromiter(flat, np.int64, 2 * n.sum())
            parts[0].append((n, np.fromiter(itertools.chain.from_iterable(ids), np.int64, n.sum()), spans[::2], spans[1::2]))
            if self.cuttable:
                pieces = self.b.encode([f[1:] for f in part], return_type=int, num_threads=1)
                n = np.fromiter(map(len, pieces), np.int64, len(part))
                parts[1].append((n, np.fromiter(itertools.chain.from_iterable(pieces), np.int64, n.sum())))
                continue
            protos = self.b.encode([f[1:] for f in part], return_type="proto", num_threads=1)
            n = np.fromiter((len(p.pieces) for p in protos), np.int64, len(part))
            flat = (x for p in protos for t in p.pieces for x in (t.id, t.begin, t.end))
            spans = np.fromiter(flat, np.int64, 3 * n.sum())
            parts[1].append((n, spans[::3], spans[1::3], spans[2::3]))
        return tuple([np.concatenate(x) for x in zip(*side, strict=True)] for side in parts)

    def add(self, fragments: list[str]) -> Aligned:
        """The alignment of each fragment; all begin with a blank."""
        if not fragments:
            none = np.empty(0, np.int64)
            return Aligned(none.astype(bool), none.reshape(0, 4), [], np.zeros(1, np.int64), none, none)
        (n_a, ids_a, begin_a, end_a), (n_b, ids_b, *spans_b) = self._tokens(fragments)
        data = "".join(fragments).encode()
        raw = np.frombuffer(data, np.uint8)
        chars = np.concatenate([np.flatnonzero((raw & 0xC0) != 0x80), [len(raw)]])  # first byte of every character
        count = np.fromiter(map(len, fragments), np.int64, len(fragments))
        starts = chars[np.concatenate([[0], np.cumsum(count)])]
        whole = np.ones(len(fragments), bool)
        sides = []
        for n, ids, size, text in ((n_a, ids_a, self.size_a, self.bytes_a), (n_b, ids_b, self.size_b, self.bytes_b)):
            of = np.repeat(np.arange(len(n)), n)
            total = np.concatenate([[0], np.cumsum(size[ids])])
            bounds = total[np.concatenate([[0], np.cumsum(n)])]
            joined = b"".join(map(text.__getitem__, ids.tolist()))
            if joined != data or not np.array_equal(bounds, starts):
                whole &= [joined[a:b] == data[c:d] for a, b, c, d in zip(bounds, bounds[1:], starts, starts[1:], strict=False)]
            sides.append((of, total[1:] + (starts[:-1] - bounds[:-1])[of]))
        (of_a, decoded_a), (of_b, decoded_b) = sides
        keep_a, keep_b = whole[of_a], whole[of_b]

        inside = np.concatenate([(of_a[1:] == of_a[:-1]) & (begin_a[1:] < end_a[:-1]), [False]])[: len(of_a)]
        first_char = np.cumsum(count) - count
        ends_a = token_ends(chars[first_char[of_a] + end_a], ~inside, decoded_a)[keep_a]
        if spans_b:
            begin_b, end_b = spans_b
            decoded_b = token_ends(starts[of_b] + 1 + end_b, begin_b < end_b, decoded_b)  # A's text has one blank more in front
        ends_b = decoded_b[keep_b]
        of_a, ids_a, of_b, ids_b = of_a[keep_a], ids_a[keep_a], of_b[keep_b], ids_b[keep_b]
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        of_group = np.searchsorted(starts, cuts) - 1
        group, pair, times = links_of(ids_a, ids_b, group_a, group_b, len(cuts))
        of_link = of_group[group]

        def total_of(of: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
            return np.bincount(of, weights, len(fragments)).astype(np.int64)

        figures = np.stack([total_of(of_a), total_of(of_b), total_of(of_group), total_of(of_link, times)], 1)
        first = np.searchsorted(of_link, np.arange(len(fragments) + 1))
        return Aligned(whole, figures, self._shown(len(fragments), of_group, ids_a, ids_b, group_a, group_b), first, pair, times)

    def _shown(self, n: int, of_group: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> list[bytes]:
        """Each fragment's groups as a1,a2|b1;"""
        side = np.concatenate([group_a * 2, group_b * 2 + 1])
        order = np.argsort(side, kind="stable")
        ids, side = np.concatenate([ids_a, ids_b])[order], side[order]
        last = np.concatenate([side[1:] != side[:-1], [True]])[: len(side)]
        sign = np.where(last, 1 + side % 2, 0)
        text = self.shown.take(pa.array(ids * 3 + sign))
        offsets = np.frombuffer(text.buffers()[1], np.int64)[: len(ids) + 1]
        data = text.buffers()[2].to_pybytes() if len(ids) else b""
        bounds = offsets[np.searchsorted(of_group[side // 2], np.arange(n + 1))].tolist()
        return [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


@lru_cache(maxsize=1)
def _aligner(spec: bytes, model: bytes) -> Aligner:
    return Aligner(spec, model)


_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_LEAD = np.zeros(256, np.uint8)  # lead bytes of characters of which none is white space, by their length
_LEAD[[0xC3, 0xCE, 0xCF, 0xD0, 0xD1]] = 2
_LEAD[0xE4:0xEA] = 3


def fragment_starts(raw: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Starts of the fragments: of every row, and each blank between two characters known to be visible.

    ``raw`` are the bytes of the rows, each beginning with a blank; other white
    space and characters not looked up stay inside a fragment.
    """
    n = len(raw)
    if not n:
        return np.empty(0, np.int64)
    blanks = np.flatnonzero(raw == 0x20)
    blanks = blanks[(blanks >= 3) & (blanks + 1 < n)]
    before, after = raw[blanks - 1], raw[blanks + 1]
    left = _VISIBLE[before] | ((before >= 0x80) & ((_LEAD[raw[blanks - 2]] == 2) | (_LEAD[raw[blanks - 3]] == 3)))
    right = _VISIBLE[after] | (_LEAD[after] > 0)
    inner = np.ones(n + 1, bool)
    inner[rows] = False
    blanks = blanks[left & right & inner[blanks] & inner[blanks + 1]]
    return np.union1d(rows[:-1][rows[:-1] < rows[1:]], blanks)


@dataclass
class Block:
    """Documents' figures, their pairs as (first, number in ``keys``, links), and the block's distinct pairs."""

    rows: list[tuple]
    first: np.ndarray
    pair: np.ndarray
    times: np.ndarray
    keys: np.ndarray
    docs: np.ndarray  # documents that hold each pair

    def packed(self) -> bytes:
        parts = [self.first.astype(np.int64), self.pair.astype(np.int32), self.times.astype(np.int32 if self.times.max(initial=0) < 2**31 else np.int64)]
        head = json.dumps([self.rows, [[p.dtype.str, len(p)] for p in parts]]).encode()
        return zstandard.compress(len(head).to_bytes(8, "little") + head + b"".join(p.tobytes() for p in parts), 3)

    @staticmethod
    def unpacked(blob: bytes) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        raw = zstandard.decompress(blob)
        size = int.from_bytes(raw[:8], "little")
        rows, kinds = json.loads(raw[8 : 8 + size])
        at, parts = 8 + size, []
        for kind, n in kinds:
            parts.append(np.frombuffer(raw, kind, n, at))
            at += parts[-1].nbytes
        return rows, *parts


def block_of(aligner: Aligner, ids: list, texts: list[str]) -> Block:
    """The alignment of some documents; null texts are given as empty."""
    raw_texts = [(" " + t).encode() if t else b"" for t in texts]
    rows = np.concatenate([[0], np.cumsum([len(t) for t in raw_texts])]).astype(np.int64)
    data = b"".join(raw_texts)
    starts = fragment_starts(np.frombuffer(data, np.uint8), rows) if aligner.cuttable else rows[:-1][rows[:-1] < rows[1:]]
    offsets = np.concatenate([starts, [len(data)]]).astype(np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
    which = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    found, place = aligner.look_up(pieces.dictionary.to_pylist())

    held = np.searchsorted(starts, rows)  # fragments of a document: held[i] to held[i + 1]
    bad = np.concatenate([[0], np.cumsum(~found.whole[place][which])])
    good_doc = (bad[held[1:]] == bad[held[:-1]]) & (held[1:] > held[:-1])
    sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(found.figures[place][which], 0)])
    sums = (sums[held[1:]] - sums[held[:-1]]) * good_doc[:, None]
    shown = [found.groups[k] for k in place.tolist()]
    out = []
    for i, doc_id in enumerate(ids):
        groups = b"".join([shown[k] for k in which[held[i] : held[i + 1]].tolist()])[:-1] if good_doc[i] else b""
        out.append((doc_id, *sums[i].tolist(), hashlib.sha256(groups).hexdigest() if good_doc[i] else ""))

    def spread(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """begin[0], .., begin[0] + lengths[0] - 1, begin[1], .."""
        return np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())

    counts = np.diff(found.first)[place]
    taken = spread(found.first[place], counts)
    links, begin = found.times[taken], np.cumsum(counts) - counts
    keys, number = np.unique(found.pair[taken], return_inverse=True)
    doc_of = np.repeat(np.arange(len(ids)), np.diff(held))
    keep = good_doc[doc_of]
    doc_of, used = doc_of[keep], which[keep]
    lengths = counts[used]
    at = spread(begin[used], lengths)
    both, where = np.unique(np.repeat(doc_of, lengths) * max(1, len(keys)) + number[at], return_inverse=True)
    times = np.bincount(where, links[at], len(both)).astype(np.int64)  # exact below 2**53
    docs, pair = np.divmod(both, max(1, len(keys)))
    first = np.searchsorted(docs, np.arange(len(ids) + 1))
    n_docs = np.bincount(pair, minlength=len(keys))
    if (n_docs == 0).any():  # pairs of documents that do not decode to their text
        left = np.flatnonzero(n_docs)
        renamed = np.zeros(len(keys), np.int64)
        renamed[left] = np.arange(len(left))
        keys, n_docs, pair = keys[left], n_docs[left], renamed[pair]
    return Block(out, first, pair, times, keys, n_docs)


def _blocks(docs: DataFrame, spec_path: str, model_path: str, id_col: str, text_col: str) -> DataFrame:
    """One row per block of documents: its packed figures and pairs, and its distinct pairs with their documents."""
    with open(spec_path, "rb") as a, open(model_path, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))  # a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, BLOCK_BYTES):
            block = block_of(_aligner(*files.value), batch.column(id_col).to_pylist(), batch.column(text_col).to_pylist())
            name = int.from_bytes(os.urandom(8), "little", signed=True)
            lists = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (block.keys, block.docs)]
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([block.packed()], pa.binary()), *lists], names=["block", "packed", "pairs", "docs"])

    table = id_text(docs, id_col, text_col).mapInArrow(run, "block long, packed binary, pairs array<long>, docs array<long>")
    return shared_table(table, "token-links")  # block names are drawn anew when a task is run again


def _pairs(blocks: DataFrame) -> DataFrame:
    zipped = F.posexplode(F.arrays_zip("pairs", "docs")).alias("number", "entry")
    return blocks.select("block", zipped).select("block", "number", F.col("entry.pairs").alias("pair"), F.col("entry.docs").alias("docs"))


def _counts(pairs: DataFrame) -> DataFrame:
    """(pair, count, best): the documents that hold the pair, and whether no other pair of its A id is held by more."""
    counts = shared_table(pairs.groupBy("pair").agg(F.sum("docs").alias("count")), "token-links-counts")
    a = F.shiftrightunsigned("pair", 32)
    highest = counts.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))
    return counts.withColumn("a", a).join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def pair_counts(docs: DataFrame, spec_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, count, best) of every pair of ids linked in some document; see :func:`align`."""
    counted = _counts(_pairs(_blocks(docs, spec_path, model_path, id_col, text_col)))
    return counted.select(F.shiftrightunsigned("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b"), "count", "best")


def align(docs: DataFrame, spec_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes blank + text by the tokenizers JSON, B the text by the
    sentencepiece model, both without special tokens.  Byte offsets where both
    end a token cut them into groups; an A and a B token of one group are
    linked.  A pair's count is the number of documents (rows of ``docs``) that
    hold it.  Null and empty texts and texts that either does not give back
    byte for byte have no tokens: zeros and ''.  Null ids stay; repeated rows
    count each; an empty table gives no rows; other columns are not read.
    Files are read by the driver.
    """
    blocks = _blocks(docs, spec_path, model_path, id_col, text_col)
    pairs = _pairs(blocks)
    found = pairs.join(_counts(pairs), "pair").select(F.col("block").alias("of"), "number", "count", "best")

    def finish(block: pa.Table, counted: pa.Table) -> pa.Table:
        columns: list[list] = [[] for _ in range(8)]
        order = np.argsort(counted.column("number").to_numpy())
        count = counted.column("count").to_numpy()[order]
        best = counted.column("best").to_numpy()[order].astype(np.int64)
        for blob in block.column("packed"):
            rows, first, pair, times = Block.unpacked(blob.as_buffer().to_pybytes())
            summed = [np.concatenate([[0], np.cumsum(x[pair] * times)]) if len(pair) else np.zeros(1, np.int64) for x in (best, count)]
            n_best, count_sum = (s[first[1:]] - s[first[:-1]] for s in summed)
            for row, x, y in zip(rows, n_best.tolist(), count_sum.tolist(), strict=True):
                for column, value in zip(columns, (*row[:5], x, y, row[5]), strict=True):
                    column.append(value)
        kinds = [pa.int64()] * 7 + [pa.string()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return blocks.select("block", "packed").groupBy("block").cogroup(found.groupBy("of")).applyInArrow(finish, schema)
