"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every five-word shingle is hashed once; the hash's high bits name one of
``BINS`` bins and the least hash of a bin stands for it.  An empty bin takes
the value of the first filled bin in its own hashed order of all bins
(optimal densification): a few hashed probes, then the filled bin of least
hash.  Of each value the ``BITS`` low-order bits are packed into longs.  Two
unequal values agree in these bits with probability 2**-BITS, and the
likeness of two fingerprints is corrected for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.packing import SPACES

WIDTH = 5
BINS = 128
BITS = 4
PROBES = 6
_BIN_SHIFT = 64 - (BINS - 1).bit_length()
_PER_LONG = 64 // BITS
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, _BIN_SHIFT).cast("int")


def _low(value: Column) -> Column:
    return value.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")


def with_packed(df: DataFrame, text_col: str, packed_col: str) -> DataFrame:
    """``df`` with the packed fingerprint of ``text_col``, an array of longs; null for a text without words.

    Each step is a column of its own that later steps name more than once, so
    that none is computed again for every element.
    """
    kept = df.columns
    lowered = F.translate(F.coalesce(text_col, F.lit("")), _UPPER, _LOWER)
    df = df.withColumn("_words", F.transform(F.array_remove(F.split(lowered, SPACES), ""), lambda w: F.xxhash64(w)))
    starts = F.slice("_words", 1, F.greatest(F.size("_words") - (WIDTH - 1), F.lit(1)))
    df = df.withColumn("_sorted", F.sort_array(F.transform(starts, lambda _, i: F.xxhash64(F.slice("_words", i + 1, WIDTH)))))
    df = df.withColumn("_least", F.filter("_sorted", lambda x, i: (i == 0) | (_bin(x) != _bin(F.get("_sorted", i - 1)))))
    by_bin = F.map_from_arrays(F.transform("_least", _bin), F.transform("_least", _low))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.try_element_at("_by_bin", b))
    df = df.withColumn("_by_bin", by_bin).withColumn("_dense", F.when(F.size("_by_bin") >= 0, dense))

    def fill(value: Column, b: Column) -> Column:
        probes = [F.get("_dense", F.pmod(F.xxhash64(b, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(PROBES)]
        last = F.array_min(F.transform("_least", lambda x: F.struct(F.xxhash64(b, _bin(x)).alias("h"), _low(x).alias("v"))))["v"]
        return F.coalesce(value, *probes, last)

    df = df.withColumn("_filled", F.transform("_dense", fill))

    def long_of(start: int) -> Column:
        values = F.slice("_filled", start + 1, _PER_LONG)
        return F.aggregate(values, F.lit(0).cast("long"), lambda acc, v: F.shiftleft(acc, BITS).bitwiseOR(v.cast("long")))

    packed = F.array(*[long_of(i) for i in range(0, BINS, _PER_LONG)])
    return df.withColumn(packed_col, F.when(F.size("_least") > 0, packed)).select(*kept, packed_col)


def text_of(packed: Column) -> Column:
    """Lowercase hex of the packed values; empty for a text without words."""
    return F.coalesce(F.array_join(F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity, 0 to 1; two texts without words are alike (1), one without words is unlike any other (0)."""
    ones = int("1" * _PER_LONG, 16)

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(ones)))

    differing = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda acc, n: acc + n)
    by_chance = 1 / (1 << BITS)
    corrected = (1 - differing / F.lit(float(BINS)) - by_chance) / (1 - by_chance)
    return (
        F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), corrected)).cast("double")
    )


def with_next(rows: DataFrame, id_col: str, text_col: str, carried: list[str], per_bucket: int = 2000, most_buckets: int = 20_000) -> DataFrame:
    """``rows`` with the next row's ``carried`` columns (``next_*``), by descending id; after the last comes the first.

    Rows of an equal id follow by text; null ids come last.  Ids are cut into
    buckets at quantiles, which are ids themselves: the row that heads a bucket
    is also sent to the bucket before it, so that every row finds its next one
    within its bucket and the whole order is never in one task.
    """
    n = rows.where(F.col(id_col).isNotNull()).count()
    buckets = max(1, min(most_buckets, -(-n // per_bucket)))
    shares = [i / buckets for i in range(1, buckets)]
    found = rows.agg(F.max(id_col).alias("top"), F.percentile_approx(id_col, shares or [0.5]).alias("cuts")).first()
    heads = sorted({found["top"], *(found["cuts"] if shares else [])}, reverse=True) if n else []
    order = [F.col("_copy"), F.col(id_col).desc_nulls_last(), F.col(text_col)]
    if not heads:
        everything = Window.partitionBy(F.lit(0)).orderBy(*order[1:])  # null ids only
        out = rows.select("*", *[F.coalesce(F.lead(c).over(everything), F.first(c).over(everything)).alias(f"next_{c}") for c in carried])
    else:
        cuts, last = F.array(*[F.lit(h).cast("long") for h in heads]), len(heads) - 1
        own = F.coalesce(F.size(F.filter(cuts, lambda h: h >= F.col(id_col))) - 1, F.lit(last))
        own = F.when(F.col(id_col).isNull(), last).otherwise(own)
        dealt = rows.withColumn("_own", own)
        is_head = F.get(cuts, F.col("_own")) == F.col(id_col)
        before = F.when(F.col("_own") == 0, last).otherwise(F.col("_own") - 1)
        places = F.when(is_head, F.array(F.struct(F.col("_own").alias("b"), F.lit(False).alias("c")), F.struct(before.alias("b"), F.lit(True).alias("c"))))
        places = F.coalesce(places, F.array(F.struct(F.col("_own").alias("b"), F.lit(False).alias("c"))))
        dealt = dealt.withColumn("_place", F.explode(places)).withColumn("_bucket", F.col("_place.b")).withColumn("_copy", F.col("_place.c"))
        within = Window.partitionBy("_bucket").orderBy(*order)
        out = dealt.select("*", *[F.lead(c).over(within).alias(f"next_{c}") for c in carried]).where(~F.col("_copy"))
    return out.select(*rows.columns, *[f"next_{c}" for c in carried])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, both fingerprints, near_edited, near_next.

    The edited text is the text with its last floor(n/2) code points replaced
    by as many first ones (or all) of the next document by descending id; the
    next of the last is the first, and a single row is its own next.  Null
    text is empty; a text without words has the empty fingerprint.  Equal
    texts have equal fingerprints.  Rows of an equal id follow each other by
    text, null ids come last.  An empty table gives no rows; other columns are
    not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = with_next(with_packed(base, "text", "packed"), "doc_id", "text", ["text", "packed"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "packed", "next_packed")
    rows = with_packed(rows, "edited", "edited_packed")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        text_of(F.col("packed")).alias("fingerprint"),
        text_of(F.col("edited_packed")).alias("edited_fingerprint"),
        likeness(F.col("packed"), F.col("edited_packed")).alias("near_edited"),
        likeness(F.col("packed"), F.col("next_packed")).alias("near_next"),
    )
