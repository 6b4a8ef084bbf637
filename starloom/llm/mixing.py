"""Mixing sources to target weights by temperature, in DataFrame functions only.

A source's weight is its share of all tokens raised to an exponent between 0
(all sources alike) and 1 (as they are), normalised. The exponent is found by
bisection on the per-source totals: the flattest mix whose most repeated source
is used at most `max_repeats` times, or the mix closest to the given shares
that still has `entropy` (in nats). Each aggregate tries 15 exponents, so it
halves the interval four times.

The budget is `budget` tokens; without one it is the least budget that uses each
document at least once. A source's part of it is spent on whole passes over its
documents and one last, partial pass: the documents lie in blocks (by hash of
doc_id, about BLOCK_ROWS each), the last pass takes the blocks in a random
permutation, and the block that the budget ends in gives its documents in a
random order until the budget is reached. Only totals of blocks are ordered
within a source, never its documents.

Tokens are words between white space. A null source is a source of its own. A
null or empty text has no tokens and follows the passes of its source; sources
without tokens are used once. Rows of one doc_id in a source are taken or left
together. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BLOCK_ROWS = 4096
SEED = 17
#: Aggregates of 15 exponents each: the exponent is known to 2**-32.
ROUNDS = 8


def tokens() -> Column:
    return F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"\S+")), F.lit(0)).cast("long")


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))


def find_exponent(sizes: DataFrame, max_repeats: float | None, entropy: float | None,
                  budget: float | None) -> float:
    """The exponent for per-source totals (tokens)."""
    total = sizes.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    shares = sizes.filter("tokens > 0").select((F.col("tokens") / F.lit(total)).alias("s"))
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / 16
        tried = [low + step * k for k in range(1, 16)]
        got = shares.agg(*(
            f(F.pow("s", F.lit(a))).alias(f"{name}{k}") for k, a in enumerate(tried)
            for name, f in (("z", F.sum), ("h", lambda p: F.sum(p * F.log("s"))),
                            ("most", lambda p: F.max(p / F.col("s"))),
                            ("least", lambda p: F.min(p / F.col("s")))))).first()

        def fits(k: int) -> bool:
            z, h, most, least = (got[f"{n}{k}"] for n in ("z", "h", "most", "least"))
            if entropy is not None:  # falls with the exponent
                return math.log(z) - tried[k] * h / z < entropy
            return (most / least if budget is None else most / z * budget / total) <= max_repeats

        # `fits` holds from some exponent on; without any, the answer is the upper end.
        first = next((k for k in range(15) if fits(k)), 15)
        low, high = low + step * first, low + step * (first + 1)
    return high if entropy is None else low


def mix_plan(docs: DataFrame, max_repeats: float | None = None, entropy: float | None = None,
             budget: float | None = None) -> tuple[DataFrame, DataFrame]:
    """For `docs` (doc_id, source, text): the table (key, doc_id, source,
    tokens), and a row for each source with its weight, passes, and the end of
    its last pass."""
    if (max_repeats is None) == (entropy is None):
        raise ValueError("give either max_repeats or entropy")
    if max_repeats is not None and max_repeats < 1:
        raise ValueError("max_repeats is at least 1")
    counted = stored(docs.select(_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                                 F.col("source").cast("string").alias("source"), tokens().alias("tokens")), "mix-tokens")
    sizes = stored(counted.groupBy("key").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "mix-sizes")
    exponent = find_exponent(sizes, max_repeats, entropy, budget)
    total = sizes.agg(F.sum("tokens")).first()[0] or 1
    power = sizes.withColumn("p", F.when(F.col("tokens") > 0, F.pow(
        F.col("tokens") / F.lit(total), F.lit(exponent))).otherwise(0.0))
    z, cover = power.agg(F.sum("p"), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / F.col("p")))).first()
    spend = float(budget) if budget is not None else (cover or 0.0) * (z or 0.0)
    plan = (power.withColumn("weight", F.when(F.col("tokens") > 0, F.col("p") / F.lit(z)).otherwise(0.0))
            # A hair is added so that a whole pass is not lost to rounding.
            .withColumn("spend", F.floor(F.col("weight") * F.lit(spend) + F.lit(1e-6) * F.col("tokens")).cast("long"))
            .select("key", "weight", F.lit(exponent).alias("exponent"),
                    F.when(F.col("tokens") > 0, F.expr("spend div tokens")).otherwise(1).alias("passes"),
                    F.when(F.col("tokens") > 0, F.expr("spend % tokens")).otherwise(0).alias("rest"),
                    F.ceil(F.col("rows") / BLOCK_ROWS).cast("long").alias("blocks")))
    plan = stored(plan, "mix-plan")
    inside = counted.join(plan.filter("rest > 0").select("key", "blocks", "passes", "rest"), "key").select(
        "key", "tokens", "rest", _turn(), _place())
    reached = F.sum("tokens").over(Window.partitionBy("key").orderBy("turn").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    cut = (inside.groupBy("key", "rest", "turn").agg(F.sum("tokens").alias("tokens")).withColumn("reached", reached)
           .filter("reached >= rest and reached - tokens < rest")
           .select("key", "turn", (F.col("rest") - F.col("reached") + F.col("tokens")).alias("left")))
    cut = stored(cut, "mix-cuts")
    before = F.sum("tokens").over(Window.partitionBy("key").orderBy("place").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.col("tokens")
    end = (inside.join(cut, ["key", "turn"]).withColumn("before", before).filter(F.col("before") < F.col("left"))
           .groupBy("key").agg(F.max("place").alias("end_place")))
    ends = cut.select("key", F.col("turn").alias("end_turn")).join(end, "key")
    return counted, stored(plan.join(ends, "key", "left"), "mix-ends")


def _turn() -> Column:
    """Where the document's block comes in the last pass."""
    block = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.col("blocks"))
    return F.xxhash64(block, "passes", F.lit(SEED)).alias("turn")


def _place() -> Column:
    """Where the document comes within its block in the last pass."""
    return F.xxhash64("doc_id", "passes", F.lit(SEED + 1)).alias("place")


def with_repeats(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """`rows` (key, doc_id, ...) with n_repeats: how often the mix uses each."""
    names = [c for c in rows.columns if c != "key"]
    taken = (F.col("turn") < F.col("end_turn")) | (
        (F.col("turn") == F.col("end_turn")) & (F.col("place") <= F.col("end_place")))
    return (rows.join(plan, "key").select(*names, "weight", "exponent", "passes", "end_turn", "end_place", _turn(), _place())
            .select(*names, "exponent", "weight",
                    (F.col("passes") + F.when(F.coalesce(taken, F.lit(False)), 1).otherwise(0)).cast("long")
                    .alias("n_repeats")))


def mix(docs: DataFrame, max_repeats: float | None = None, entropy: float | None = None,
        budget: float | None = None) -> DataFrame:
    """(doc_id, source, n_tokens, exponent, weight, n_repeats) of every row."""
    counted, plan = mix_plan(docs, max_repeats, entropy, budget)
    return with_repeats(counted.withColumnRenamed("tokens", "n_tokens"), plan)


def mixed_rows(docs: DataFrame, max_repeats: float | None = None, entropy: float | None = None,
               budget: float | None = None) -> DataFrame:
    """The rows of `docs`, all their columns, each as often as the mix uses it."""
    _, plan = mix_plan(docs, max_repeats, entropy, budget)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), row)
    used = with_repeats(rows, plan).filter("n_repeats > 0")
    return used.select("row", F.explode(F.sequence(F.lit(1), F.col("n_repeats")))).select("row.*")
