"""Quantiles, histogram, density curve and threshold sweep of scores."""

from __future__ import annotations

import math
import struct
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits that each round of a selection settles, from the highest on; together 64.
ROUNDS = (22, 21, 21)


def ordered_long(value: Column) -> Column:
    """A double as a long in the same order: the number that its bits are, negative for negative ones; both zeros are 0.

    Exponent and fraction come from a logarithm, put right by one where rounding moved it past a power of two, and from divisions by
    powers of two, which are exact.
    """
    a = F.abs(value)
    power = lambda e: F.pow(F.lit(2.0), e)
    near = F.floor(F.log2(a))
    e = near + F.when(a >= power(near + 1), 1).when(a < power(near), -1).otherwise(0)
    normal = (e + 1023) * (1 << 52) + ((a / power(e) - 1) * 2.0**52).cast("long")
    tiny = (a * 2.0**537 * 2.0**537).cast("long")
    bits = F.when(a == 0, 0).when(a < 2.0**-1022, tiny).when(a == float("inf"), 2047 << 52).otherwise(normal)
    return F.when(value < 0, -bits).otherwise(bits).cast("long")


def from_ordered(key: int) -> float:
    return math.copysign(struct.unpack("<d", struct.pack("<q", abs(key)))[0], key)


def quantile_values(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, dict[float, float | None]]:
    """Exact quantiles (linear interpolation) of several columns at once; nulls and NaN don't count, an empty column has none.

    Selection by radix: values become longs in the same order, and three aggregates settle their bits from the top. Each counts
    rows per bucket of the next bits among the rows that share the bits of a wanted rank so far, for all
    ranks of all columns in one scan. Buckets are at most 2^22 per column and then 2^21 per rank, whatever the number of rows or of
    different values; the driver gets one row per rank.
    """
    columns = list(wanted)
    pairs = [F.struct(F.lit(i).alias("col"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]
    rows = df.select(F.inline(F.array(*pairs))).where(F.col("v").isNotNull() & ~F.isnan("v"))
    rows = rows.select("col", ordered_long(F.col("v")).alias("key"))
    below, prefix, sizes = 64, F.lit(0).cast("long"), {}
    # (col, rank, bits settled, rows before): one per wanted rank, so literals; the ranks follow from the first counts.
    spots = [F.struct(F.lit(i).alias("col"), F.lit(float(p)).alias("p")) for i, c in enumerate(columns) for p in wanted[c]]
    chosen: list[tuple[int, int, int, int]] = []
    for bits in ROUNDS:
        mine = rows.withColumn("prefix", prefix)
        if chosen:
            held = [F.col("prefix").isin(sorted({x[2] for x in chosen if x[0] == i})) for i in range(len(columns))]
            mine = mine.where(F.coalesce(*[F.when(F.col("col") == i, h) for i, h in enumerate(held)]))
        below -= bits
        counted = mine.groupBy("col", "prefix", F.shiftright("key", below).alias("bucket")).agg(
            F.count(F.lit(1)).alias("c"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        part = Window.partitionBy("col", "prefix")
        ends = counted.withColumns({"end": F.sum("c").over(part.orderBy("bucket")), "n": F.sum("c").over(part)})
        if chosen:
            ranks = F.array(*[F.struct(*[F.lit(x).cast("long").alias(n) for n, x in zip(("col", "rank", "prefix", "base"), row, strict=True)]) for row in chosen])
        else:
            rank = lambda s, side: F.struct(s["col"].alias("col"), side(s["p"] * (F.col("n") - 1)).alias("rank"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("base"))
            ranks = F.flatten(F.transform(F.array(*spots), lambda s: F.array(rank(s, F.floor), rank(s, F.ceil))))
        here = lambda x: (x["col"] == F.col("col")) & (x["prefix"] == F.col("prefix")) & (x["rank"] < x["base"] + F.col("end")) & (x["rank"] >= x["base"] + F.col("end") - F.col("c"))
        met = ends.select("*", F.explode(F.filter(ranks, here)).alias("w"))
        found = met.select("col", "w.rank", "bucket", (F.col("w.base") + F.col("end") - F.col("c")).alias("base"), "n", "low", "high").distinct().collect()
        sizes = sizes or {r["col"]: r["n"] for r in found}
        if all(r["low"] == r["high"] for r in found):
            chosen = [(r["col"], r["rank"], r["low"], r["base"]) for r in found]
            break
        chosen = [(r["col"], r["rank"], r["bucket"], r["base"]) for r in found]
        prefix = F.shiftright("key", below)
    at = {(i, rank): from_ordered(key) for i, rank, key, _ in chosen}

    def value(i: int, p: float) -> float | None:
        if i not in sizes:
            return None
        spot = p * (sizes[i] - 1)
        low, high = at[i, math.floor(spot)], at[i, math.ceil(spot)]
        return low if low == high else low + (high - low) * (spot - math.floor(spot))

    return {c: {p: value(i, p) for p in wanted[c]} for i, c in enumerate(columns)}


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """(p, value) by ``quantile_values``."""
    found = quantile_values(df, {column: probabilities})[column]
    return df.sparkSession.createDataFrame([(float(p), found[p]) for p in probabilities], "p double, value double")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed. Empty bins are listed."""
    value = F.col(column).cast("double")
    span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).select(F.struct("lo", "hi")).scalar()
    width = (F.col("s.hi") - F.col("s.lo")) / bins
    counted = (
        df.where(value.isNotNull()).select(value.alias("v"))
        .withColumn("s", span)
        .withColumn("w", width)
        .withColumn(
            "bin",
            F.when(F.col("w") > 0, F.least(F.floor((F.col("v") - F.col("s.lo")) / F.col("w")), F.lit(bins - 1)))
            .otherwise(0).cast("int"),
        )
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    frame = (
        df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
        .withColumn("w", (F.col("hi") - F.col("lo")) / bins)
        .select("lo", "w", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    )
    return frame.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("w")).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("w")).alias("high"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


#: Terms of the series in a box, and half the width of a box in bandwidths.
TERMS, HALF = 16, math.sqrt(2) / 4
#: Bandwidths beyond which a box adds nothing: exp(-9 * 9 / 2) is below 10^-17.
REACH = 9


def density(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density at ``points`` places over [min, max], bandwidth by Scott's rule.

    A fast Gauss transform: rows are summed up by boxes of the value's range as ``TERMS`` moments about the middle of their box, so the work
    per row doesn't depend on the number of places. A box then adds its Hermite series to the places near it.
    With s = (v - middle) / (sqrt(2) h), at most 1/4 in a box, the rest of the series after K terms is below
    1.09 * sum of (sqrt(2) / 4)^k / sqrt(k!) from k = K on: 2 * 10^-14 of a row's greatest share for 16 terms.
    Without two different values there is no bandwidth, and no density (null).
    """
    value = F.col(column).cast("double")
    rows = df.select(value.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    stats = (
        rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n"), F.stddev_samp("v").alias("sd"))
        .select(F.struct("lo", "hi", "n", F.when(F.col("sd") > 0, F.col("sd") * F.pow("n", F.lit(-0.2))).alias("h")))
        .scalar()
    )
    width = 2 * HALF * F.col("s.h")
    s = (F.col("v") - F.col("s.lo") - (F.col("box") + 0.5) * width) / (math.sqrt(2) * F.col("s.h"))
    boxed = rows.withColumn("s", stats).withColumn("box", F.floor((F.col("v") - F.col("s.lo")) / width)).where("s.h IS NOT NULL")
    boxed = boxed.select("box", s.alias("x"))
    moments = boxed.groupBy("box").agg(F.array(*[F.sum(F.pow("x", F.lit(float(k))) / math.factorial(k)) for k in range(TERMS)]).alias("m"))

    step = (F.col("s.hi") - F.col("s.lo")) / (points - 1)
    middle = F.col("s.lo") + (F.col("box") + 0.5) * width
    first = F.greatest(F.lit(0), F.ceil((middle - REACH * F.col("s.h") - F.col("s.lo")) / step))
    last = F.least(F.lit(points - 1), F.floor((middle + REACH * F.col("s.h") - F.col("s.lo")) / step))
    place = F.col("s.lo") + (F.col("s.hi") - F.col("s.lo")) * F.col("place") / (points - 1)
    near = moments.withColumn("s", stats).withColumn("place", F.explode(F.sequence(first, last)))
    t = (place - middle) / (math.sqrt(2) * F.col("s.h"))
    # Hermite polynomials: H(k + 1) = 2 t H(k) - 2 k H(k - 1).
    start = F.struct(F.lit(0.0).alias("before"), F.lit(1.0).alias("now"), F.lit(0.0).alias("total"))
    series = F.aggregate(
        F.transform("m", lambda m, k: F.struct(m.alias("m"), k.cast("double").alias("k"))), start,
        lambda a, x: F.struct(a["now"].alias("before"), (2 * F.col("t") * a["now"] - 2 * x["k"] * a["before"]).alias("now"),
                              (a["total"] + x["m"] * a["now"]).alias("total")),
        lambda a: a["total"],
    )
    shares = near.withColumn("t", t).select("place", (F.exp(-F.col("t") * F.col("t")) * series).alias("part"))
    sums = shares.groupBy("place").agg(F.sum("part").alias("sum"))
    frame = df.sparkSession.range(points).select(F.col("id").alias("place")).withColumn("s", stats)
    scale = F.col("s.n") * F.col("s.h") * math.sqrt(2 * math.pi)
    # At most ``points`` sums; a place that no box reaches has density 0.
    found = frame.join(F.broadcast(sums), "place", "left")
    return found.where("s.n > 0").select(F.col("place").cast("int").alias("place"), place.alias("x"), (F.coalesce("sum", F.lit(0.0)) / scale).alias("density"))


# The four strategies compared, as (confidence quantile, relevance quantile).
STRATEGIES = (
    ("Top 25% & 25%", 0.75, 0.75),
    ("Top 50% & 50%", 0.50, 0.50),
    ("Top 40% & 50%", 0.60, 0.50),
    ("Top 45% & 50%", 0.55, 0.50),
)


def threshold_sweep(df: DataFrame, strategies=STRATEGIES) -> DataFrame:
    """Rows kept by each pair of quantile thresholds: three scans for the thresholds of both columns, one for all strategies."""
    found = quantile_values(df, {"confidence_score": sorted({s[1] for s in strategies}), "relevance_score": sorted({s[2] for s in strategies})})
    limits = [(n, found["confidence_score"][pc], found["relevance_score"][pr]) for n, pc, pr in strategies]
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    limit = lambda x: F.lit(x).cast("double")
    kept = [
        F.count_if((value("confidence_score") >= limit(tc)) & (value("relevance_score") >= limit(tr))).alias(f"k{i}")
        for i, (_, tc, tr) in enumerate(limits)
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("strategy"),
                limit(tc).alias("confidence_threshold"),
                limit(tr).alias("relevance_threshold"),
                F.col(f"k{i}").alias("kept"),
                (F.col(f"k{i}") / F.col("total") * 100).alias("kept_pct"),
                (F.col("total") - F.col(f"k{i}")).alias("dropped"),
            )
            for i, (name, tc, tr) in enumerate(limits)
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("total"), *kept).select(F.inline(rows))
