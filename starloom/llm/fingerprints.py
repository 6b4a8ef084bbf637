"""Document fingerprints: one-permutation MinHash with optimal densification
and b-bit packing, in DataFrame functions only.

The hash of each five-word shingle (of the lower-cased text; fewer words give
their whole sequence as one) falls into one of BINS bins by its top bits; a bin
keeps its least hash. An empty bin takes the value of the occupied bin that
a fixed random ranking puts first for it, as optimal densification does with
its hash walks: every occupied bin is equally likely, independently for each
empty bin. The low BITS bits of each bin's value are packed in bin order and
written in hexadecimal.

Likeness of two fingerprints: the share of equal bins less the share 2**-BITS
that differs but agrees by chance, scaled back to 0..1. Equal texts get 1. A
text without words has the empty fingerprint: likeness 1 to another of these,
0 to any other.

Nulls count as empty texts. Neighbouring documents are found in ascending
doc_id (null first), rows of one doc_id in the order of their texts. A single
document is its own next one. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS, BITS, SHINGLE = 128, 8, 5
_BIN_SHIFT = 64 - (BINS - 1).bit_length()
#: Ranges of neighbouring documents for each shuffle partition.
RANGES_A_PARTITION = 4


def _let(value: Column, body) -> Column:
    """body(value) with value computed once for each row."""
    return F.transform(F.array(value), body)[0]


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, _BIN_SHIFT)


def bins(text: Column) -> Column:
    """The BINS values (BITS low bits each) of a text as an array; empty for
    a text without words."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")

    def hashes(w: Column) -> Column:
        whole = F.xxhash64(F.array_join(w, " "), F.size(w))
        runs = _let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - (SHINGLE - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, SHINGLE)))))
        return F.when(F.size(w) >= SHINGLE, F.sort_array(runs)).when(F.size(w) > 0, F.array(whole)).otherwise(
            F.array().cast("array<bigint>"))

    def least(h: Column) -> Column:
        # Sorted by value, the hashes of a bin are neighbours: the first is its least.
        return F.filter(h, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(h, i - 1))))

    def densify(m: Column) -> Column:
        low = (1 << BITS) - 1
        # A bin and its value in one number; the donor of a bin is the one of least
        # rank hash, whose low bits make room for the value.
        pair = F.transform(m, lambda x: F.shiftleft(_bin(x), BITS).bitwiseOR(x.bitwiseAND(F.lit(low).cast("long"))))
        value = lambda x: x.bitwiseAND(F.lit(low).cast("long")).cast("int")
        return _let(pair, lambda pairs: _let(F.transform(pairs, lambda x: F.shiftright(x, BITS)), lambda have:
            F.transform(F.sequence(F.lit(0).cast("long"), F.lit(BINS - 1).cast("long")), lambda b: _let(
                F.array_position(have, b).cast("int"), lambda at: F.when(at > 0, value(F.get(pairs, at - 1))).otherwise(
                    value(F.array_min(F.transform(pairs, lambda x: F.xxhash64(b, F.shiftright(x, BITS)).bitwiseAND(
                        F.lit(~low).cast("long")).bitwiseOR(x.bitwiseAND(F.lit(low).cast("long")))))))))))

    return _let(words, lambda w: _let(hashes(w), lambda h: _let(least(h), lambda m: F.when(
        F.size(m) > 0, densify(m)).otherwise(F.array().cast("array<int>")))))


def packed(values: Column) -> Column:
    """The fingerprint string of an array of bin values."""
    return F.array_join(F.transform(values, lambda v: F.lpad(F.lower(F.hex(v)), BITS // 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Bias-corrected similarity of two arrays of bin values, from 0 to 1."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    chance = 2.0 ** -BITS
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
            .otherwise(F.greatest(F.lit(0.0), (equal - chance) / (1 - chance))))


def with_next(docs: DataFrame, values: list[str]) -> DataFrame:
    """`docs` (doc_id, text, ...) with next_<name> for each of `values` from the
    next document in ascending doc_id; the last one's next is the first.

    The documents are cut into ranges of doc_id, RANGES_A_PARTITION for each
    shuffle partition; a range's first document is sent to the range before it
    as well, so one shuffle brings all neighbours together."""
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    wanted = RANGES_A_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low, cuts = docs.select(place.alias("k")).agg(
        F.min("k"), F.percentile_approx("k", [i / wanted for i in range(1, wanted)], 100 * wanted)).first()
    # Cut points are ids of the table; a quantile's error only makes ranges uneven.
    starts = sorted({low, *cuts}) if low is not None else [0]
    levels = (len(starts) - 1).bit_length()

    def search(k: Column) -> Column:  # the last start that is not above k, by halving
        table = F.array(*(F.lit(s).cast("long") for s in starts))
        return _let(table, lambda t: F.aggregate(
            F.array(*(F.lit(1 << i) for i in reversed(range(levels)))) if levels else F.array(F.lit(0)), F.lit(0),
            lambda at, step: F.when(F.coalesce(F.get(t, at + step) <= k, F.lit(False)), at + step).otherwise(at)))

    last = len(starts) - 1
    ranged = docs.withColumn("_k", place).withColumn("_range", search(F.col("_k")))
    is_start = F.col("_k").isin(starts) if len(starts) <= 8 else F.get(
        F.array(*(F.lit(s).cast("long") for s in starts)), F.col("_range")) == F.col("_k")
    copy = F.struct(F.when(F.col("_range") > 0, F.col("_range") - 1).otherwise(last).alias("range"),
                    F.lit(True).alias("copy"), (F.col("_range") == 0).alias("wrap"))
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("copy"), F.lit(False).alias("wrap"))
    placed = ranged.withColumn("_at", F.explode(F.when(is_start, F.array(own, copy)).otherwise(F.array(own))))
    order = Window.partitionBy("_at.range").orderBy("_at.wrap", "_k", "_at.copy", "text")
    after = F.lead(F.struct(*values)).over(order)
    return (placed.withColumn("_next", after).filter(~F.col("_at.copy"))
            .select(*docs.columns, *(F.col(f"_next.{v}").alias(f"next_{v}") for v in values)))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """For every document (doc_id, text): n_chars, the sha256 of its edited
    text (the last quarter of its characters replaced by the first as many of
    the next document), both fingerprints, and the likeness of its fingerprint
    to the edited text's (near_edited) and the next document's (near_next)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(docs.withColumn("bins", bins(F.col("text"))), ["text", "bins"])
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - quarter),
                      F.substring(F.col("next_text"), F.lit(1), quarter))
    rows = (rows.withColumn("edited", edited).drop("text", "next_text")
            .withColumn("edited_sha256", F.sha2("edited", 256)).withColumn("edited_bins", bins(F.col("edited"))))
    return rows.select("doc_id", "n_chars", "edited_sha256", packed(F.col("bins")).alias("fingerprint"),
                       packed(F.col("edited_bins")).alias("edited_fingerprint"),
                       likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
                       likeness(F.col("bins"), F.col("next_bins")).alias("near_next"))
