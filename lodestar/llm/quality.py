"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's features are the distinct words of its text and the binned
shares of its character and repetition statistics, hashed to ``buckets``.  One
weight vector is shared by all grades; ordered thresholds cut its score:
``P(grade <= k) = sigmoid(threshold[k] - score)``.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import id_text, shared_table, slices

GRADES = 3
#: Lengths in bytes of the word beginnings that are counted.
BEGINNINGS = (4, 6, 8)
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_TO_SPACE = bytes(32 if c in _SYMBOLS or 48 <= c < 58 or c < 33 else c for c in range(256))
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))


def _shares(raw: bytes, words: list[bytes], distinct: int) -> list[bytes]:
    """Names of the statistics' bins; each share falls in one of about ten bins of growing width."""
    size, lines = max(1, len(raw)), [x for x in raw.split(b"\n") if x]
    n = max(1, len(words))
    shares = {
        b"upper": (len(raw) - len(raw.translate(None, _UPPER))) / size,
        b"digit": (len(raw) - len(raw.translate(None, _DIGITS))) / size,
        b"symbol": (len(raw) - len(raw.translate(None, _SYMBOLS))) / size,
        b"exclaim": raw.count(b"!") / size,
        b"bar": raw.count(b"|") / size,
        b"lines": 1 - len(set(lines)) / max(1, len(lines)),
        b"variety": (1 - distinct / n) / max(1.0, np.log2(n + 1)),
        b"length": min(1.0, len(raw) / n / 40),
    }
    return [b"\0%s=%d" % (k, int(np.ceil(2 * np.log2(1 + 1000 * v)))) for k, v in shares.items()] + [b"\0size=%d" % int(np.log2(len(words) + 1))]


def features(text: str, mask: int) -> np.ndarray:
    """Distinct hashed features of one whole text: its words, how often their beginnings occur, and the shares' bins."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.lower().translate(_TO_SPACE).split()
    distinct = set(words)
    crc = zlib.crc32
    found = {crc(w) & mask for w in distinct}
    found.update(crc(x) & mask for x in _shares(raw, words, len(distinct)))
    for size in BEGINNINGS:
        for start, n in Counter([w[:size] for w in words]).items():
            for level in range(1, min(n.bit_length(), 6)):  # twice, four times, ...
                found.add(crc(start, level) & mask)
    return np.fromiter(found, np.int32, len(found))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


def fit(rows: list[np.ndarray], grades: np.ndarray, size: int, steps: int = 500, rate: float = 2.0, noise: float = 0.06, least_rows: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by full-batch AdaGrad on the log-likelihood with an L1 penalty of ``noise / sqrt(rows)``.

    The penalty is about the gradient that chance alone gives a feature.
    Features of fewer than ``least_rows`` rows, and those whose gradient at
    zero is below half the penalty, keep weight 0.
    """
    n = len(grades)
    l1 = noise / np.sqrt(n)
    below = np.array([(grades <= k).mean() for k in range(GRADES - 1)]).clip(0.01, 0.99)
    odds = np.log(below / (1 - below))
    params, params_seen = np.concatenate([odds[:1], np.log(np.maximum(np.diff(odds), 0.1))]), np.full(GRADES - 1, 1e-8)
    row, index = np.repeat(np.arange(n), [len(r) for r in rows]), np.concatenate(rows)

    def ends(score: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _sigmoid(cuts[grades + 1] - score), _sigmoid(cuts[grades] - score)

    def cuts_of(params: np.ndarray) -> np.ndarray:
        return np.concatenate([[-np.inf], np.cumsum(np.concatenate([params[:1], np.exp(params[1:])])), [np.inf]])

    high, low = ends(np.zeros(n), cuts_of(params))
    at_zero = np.bincount(index, ((1 - high - low) / n)[row], size)
    used = np.flatnonzero((np.bincount(index, minlength=size) >= least_rows) & (np.abs(at_zero) > l1 / 2))
    place = np.full(size, -1)
    place[used] = np.arange(len(used))
    column = place[index]
    row, column = row[column >= 0], column[column >= 0]
    weights, seen = np.zeros(len(used)), np.full(len(used), 1e-8)
    for step in range(steps):
        calm = min(1.0, 1.6 * (1 - step / steps))  # smaller steps towards the end
        high, low = ends(np.bincount(row, weights[column], n), cuts_of(params))
        grad = np.bincount(column, ((1 - high - low) / n)[row], len(used))
        seen += grad * grad
        pace = calm * rate / np.sqrt(seen)
        weights = weights - pace * grad
        weights = np.sign(weights) * np.maximum(np.abs(weights) - pace * l1, 0)
        between = np.maximum(high - low, 1e-12)
        by_cut = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            up = np.where(grades == k, high * (1 - high) / between, 0).sum()
            down = np.where(grades == k + 1, low * (1 - low) / between, 0).sum()
            by_cut[k] = (down - up) / n
        by_param = np.array([by_cut.sum(), *(by_cut[k:].sum() * np.exp(params[k]) for k in range(1, GRADES - 1))])
        params_seen += by_param**2
        params = params - 0.1 * calm * by_param / np.sqrt(params_seen)
    whole = np.zeros(size, np.float32)
    whole[used] = weights
    return whole, cuts_of(params)[1:-1]


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 poor, 1 good but toxic, 2 good; the lowest of a document's repeated ratings.

    Ratings with a null id, quality or toxic mark are left out.
    """
    grade: Column = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    whole = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    return whole.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(grade).cast("int").alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, sample_rows: int, buckets: int, text_col: str = "text") -> tuple[np.ndarray, np.ndarray] | None:
    """Weights and thresholds from about ``sample_rows`` rated documents, picked by a hash of the id; None without any.

    One task fits; what it holds is bounded by ``sample_rows``, and what comes
    to the driver by ``buckets``.
    """
    total = ratings.count()
    if not total:
        return None
    share = F.lit(min(1.0, sample_rows / total) * 2.0**32)
    picked = ratings.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**32)) < share)
    mask = buckets - 1

    def to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            rows = [features(t, mask).tobytes() for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.array(rows, pa.binary())], names=["doc_id", "grade", "row"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(i, g, r) for b in batches for i, g, r in zip(b.column("doc_id").to_pylist(), b.column("grade").to_pylist(), b.column("row").to_pylist(), strict=True)]
        if held:
            held.sort()
            weights, cuts = fit([np.frombuffer(r, np.int32) for _, _, r in held], np.array([g for _, g, _ in held]), buckets)
            yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([cuts.tobytes()], pa.binary())], names=["weights", "cuts"])

    rated = id_text(docs, "doc_id", text_col).join(picked, "doc_id").mapInArrow(to_features, "doc_id long, grade int, row binary")
    rows = shared_table(rated, "quality-features").repartition(1).mapInArrow(fitted, "weights binary, cuts binary").collect()
    return (np.frombuffer(rows[0]["weights"], np.float32), np.frombuffer(rows[0]["cuts"], np.float64)) if rows else None


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = 20_000,
    buckets: int = 1 << 20,
    least_tail: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs``: id, expected_grade, tail (probability of the best grade), keep.

    ``keep`` is ``tail >= least_tail``.  Null text counts as empty, which has
    features of its own (no words, no characters).  Repeated rows get the same
    result.  Without usable ratings nothing can be rejected: expected_grade and
    tail are null, keep is true.  Whole texts; no shuffle of the documents.
    """
    model = train(docs, graded(labels), sample_rows, buckets, text_col)
    if model is None:
        return id_text(docs, id_col, text_col).select(id_col, F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("tail"), F.lit(True).alias("keep"))
    held = docs.sparkSession.sparkContext.broadcast(model)  # 4 * buckets bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, cuts = held.value
        for batch in slices(batches, text_col):
            score = np.array([weights[features(t, len(weights) - 1)].sum(dtype=np.float64) for t in batch.column(text_col).to_pylist()])
            above = 1 - _sigmoid(cuts[None, :] - score[:, None])  # P(grade > k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(above.sum(1)), pa.array(above[:, -1]), pa.array(above[:, -1] >= least_tail)],
                names=[id_col, "expected_grade", "tail", "keep"],
            )

    return id_text(docs, id_col, text_col).mapInArrow(run, f"{id_col} long, expected_grade double, tail double, keep boolean")


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that :func:`classify` keeps, with all their columns; same cases as there."""
    buckets, least = options.get("buckets", 1 << 20), options.get("least_tail", 0.5)
    model = train(docs, graded(labels), options.get("sample_rows", 20_000), buckets, text_col)
    if model is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, cuts = held.value
        for batch in slices(batches, text_col):
            score = [weights[features(t or "", len(weights) - 1)].sum(dtype=np.float64) for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(1 - _sigmoid(cuts[-1] - np.array(score)) >= least))

    return docs.mapInArrow(run, docs.schema)
