"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent between 0 (all sources alike) and 1 (as they
are), normalised. The exponent is the largest at which the weights still have the entropy asked for, raised where
a small source would be repeated more often than allowed. Each round of the search tries ``CUTS`` exponents in one
aggregate over the sources and keeps the interval with the change of sign, so sources are never collected.

A source gets its weight's share of the token budget as whole passes and a part of one. Each pass is a permutation of
the source of its own, by a seeded hash. Passes are laid end to end, and every block of the mixture takes the next
piece of each source's line, as long as its weight says: any block, and any run of them, has the target weights. Running
totals are taken per slice of the hash and moved up by the totals of the slices before, so no task holds a source.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import SPACES, stored, whole_text

CUTS, ROUNDS = 32, 6
#: Rows that one slice of a pass holds, about.
SLICE_ROWS = 4096


@dataclass(frozen=True)
class Targets:
    """What the mixture is to meet.

    entropy: share of the highest entropy possible, reached by flattening only. most_passes: how often a document may be
    repeated. budget: tokens as a multiple of all tokens; None is the least budget that gives every source one pass.
    """

    entropy: float = 0.95
    most_passes: float = 4.0
    budget: float | None = 1.0
    block_tokens: int = 1 << 20
    seed: int = 17


def word_count(text: Column) -> Column:
    """Words of a text, 1 at least: a document without words still has a place."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.lit(1)).otherwise(F.size(F.split(bare, "[ \\t-\\r]+", -1))).cast("long")


def units(docs: DataFrame) -> DataFrame:
    """(source, doc_id, hash, copies, tokens): rows with the same source, id and text are one unit."""
    text = whole_text()
    rows = docs.select("source", "doc_id", F.xxhash64(text).alias("hash"), word_count(text).alias("n"))
    same = rows.groupBy("source", "doc_id", "hash").agg(F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"))
    return stored(same.withColumn("tokens", F.col("n") * F.col("copies")), "units")


def _search(totals: DataFrame, good) -> float:
    """An exponent from 0 to 1 at which ``good`` changes: ``good(sums, exponent)`` falls from true to false or is constant."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        tried = [low + (high - low) * i / (CUTS - 1) for i in range(CUTS)]
        logs = F.log("total")
        sums = [F.struct(F.sum(F.exp(logs * x)).alias("z"), F.sum(F.exp(logs * x) * logs * x).alias("s")).alias(f"x{i}") for i, x in enumerate(tried)]
        row = totals.agg(F.min("total").alias("least"), F.max("total").alias("most"), F.sum("total").alias("all"), F.count(F.lit(1)).alias("n"), *sums).head()
        right = [good(row, row[f"x{i}"]["z"], row[f"x{i}"]["s"], x) for i, x in enumerate(tried)]
        if all(right):
            return high
        at = right.index(False)
        if at == 0:
            return low
        low, high = tried[at - 1], tried[at]
    return low


def exponent(totals: DataFrame, targets: Targets) -> float:
    """Exponent of the weights for (source, total); 1.0 for no or one source."""

    def flat_enough(row, z, s, x) -> bool:
        # Entropy of weights t^x / z: ln z - x * sum(t^x ln t) / z.
        return math.log(z) - s / z >= targets.entropy * math.log(row["n"]) - 1e-12

    def too_often(row, z, s, x) -> bool:
        if targets.budget is None:
            passes = (row["most"] / row["least"]) ** (1 - x)
        else:
            passes = targets.budget * row["all"] * row["least"] ** (x - 1) / z
        return passes > targets.most_passes * (1 + 1e-12)

    if totals.isEmpty():
        return 1.0
    by_entropy = _search(totals, flat_enough)
    by_passes = _search(totals, too_often)
    # The search ends just below the change; above it the limit holds.
    step = (1 / (CUTS - 1)) ** ROUNDS
    by_passes = min(1.0, by_passes + step) if by_passes else 0.0
    return max(by_entropy, by_passes)


def shares(totals: DataFrame, targets: Targets) -> DataFrame:
    """(source, total, weight, quota, passes, rest): each source's weight, its tokens of the budget, its whole passes and the rest; stored."""
    x = exponent(totals, targets)
    power = F.exp(F.log("total") * x)
    sums = totals.agg(F.sum(power).alias("z"), F.sum("total").alias("t"), F.max(F.col("total") / power).alias("peak")).head()
    z = sums["z"] or 1.0
    budget = (sums["peak"] or 0.0) * z if targets.budget is None else targets.budget * (sums["t"] or 0)
    # Rounded: sums may differ in their last bits with the order of rows.
    weighed = totals.select("source", "total", F.round(power / z, 12).alias("weight"))
    quota = F.round(F.col("weight") * budget, 3)
    full = weighed.withColumn("quota", quota).withColumn("passes", F.floor(F.col("quota") / F.col("total") + 1e-9))
    return stored(full.withColumn("rest", F.greatest(F.lit(0.0), F.col("quota") - F.col("passes") * F.col("total"))), "shares")


def _key(pass_: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), pass_.cast("int"), "doc_id", "hash")


def _laid_out(rows: DataFrame, bits: int) -> DataFrame:
    """``rows`` (source, pass, key, tokens, ...) with ``before``: the tokens before a row in its pass."""
    slice_ = F.shiftright("key", 64 - bits) if bits else F.lit(0).cast("long")
    sliced = rows.withColumn("slice", slice_)
    sums = sliced.groupBy("source", "pass", "slice").agg(F.sum("tokens").alias("s"))
    lower = F.sum("s").over(Window.partitionBy("source", "pass").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("source").alias("_source"), F.col("pass").alias("_pass"), F.col("slice").alias("_slice"), F.coalesce(lower, F.lit(0)).alias("lower"))
    order = Window.partitionBy("source", "pass", "slice").orderBy("key", "doc_id", "hash").rowsBetween(Window.unboundedPreceding, 0)
    own = sliced.withColumn("own", F.sum("tokens").over(order) - F.col("tokens"))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("pass") == F.col("_pass")) & (F.col("slice") == F.col("_slice"))
    return own.join(sums, same).withColumn("before", F.col("own") + F.col("lower")).drop("_source", "_pass", "_slice", "slice", "own", "lower")


def _bits(found: DataFrame) -> int:
    return min(24, max(0, math.ceil(math.log2(max(1, found.count() / SLICE_ROWS)))))


def _with_shares(found: DataFrame, of: DataFrame) -> DataFrame:
    renamed = of.withColumnRenamed("source", "_of")
    return found.join(renamed, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")


def _totals(found: DataFrame) -> DataFrame:
    return stored(found.groupBy("source").agg(F.sum("tokens").alias("total")), "totals")


def mixture(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """(doc_id, source, n_tokens, pass, block, place): a row per draw of a row of ``docs``, ``place`` ordering a block.

    Tokens are words, 1 at least. The last pass of a source takes documents in its order while they fit into the rest of its
    quota. A null source is a source like any other, rows without an id are told apart by their texts, and rows alike in source, id and
    text are drawn together. An empty table gives an empty result. Other columns are not read.
    """
    found = units(docs)
    of = shares(_totals(found), targets)
    last = F.col("passes") - F.when(F.col("rest") > 0, 0).otherwise(1)
    # Without a whole pass and a rest there is nothing to draw.
    drawn = _with_shares(found, of).withColumn("pass", F.explode(F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last))))
    placed = _laid_out(drawn.withColumn("key", _key(F.col("pass"), targets.seed)), _bits(found))
    placed = placed.where((F.col("pass") < F.col("passes")) | (F.col("before") + F.col("tokens") <= F.col("rest")))
    at = F.col("pass") * F.col("total") + F.col("before")
    placed = placed.withColumn("block", F.floor(at / (F.col("weight") * targets.block_tokens)))
    place = F.xxhash64(F.lit(targets.seed), "block", "pass", "doc_id", "hash")
    rows = placed.select("doc_id", "source", F.col("n").alias("n_tokens"), "pass", "block", place.alias("place"), "copies")
    return rows.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("_", "copies")


def mixed_documents(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """The rows of ``docs`` as often as ``mixture`` draws them, with their columns.

    How far the last pass of a source goes is one key per source, so the texts aren't shuffled.
    """
    found = units(docs)
    of = shares(_totals(found), targets)
    part = _with_shares(found, of).where("rest > 0").withColumn("pass", F.col("passes"))
    placed = _laid_out(part.withColumn("key", _key(F.col("pass"), targets.seed)), _bits(found))
    fits = placed.where(F.col("before") + F.col("tokens") <= F.col("rest"))
    ends = fits.groupBy("source").agg(F.max("key").alias("end")).withColumnRenamed("source", "_source")
    whole = of.join(ends, F.col("source").eqNullSafe(F.col("_source")), "left").select(F.col("source").alias("_of"), "passes", "end")
    whole = stored(whole, "draws")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("source").alias("_source"), "doc_id", F.xxhash64(whole_text()).alias("hash"))
    met = rows.join(whole, F.col("_source").eqNullSafe(F.col("_of")))
    more = F.coalesce(_key(F.col("passes"), targets.seed) <= F.col("end"), F.lit(False)).cast("long")
    times = F.col("passes") + more
    drawn = met.where(times > 0).withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return drawn.select("_row.*")
