"""Quality rules with thresholds that adapt to each language and source.

Every document gets its figures in one pass without a shuffle. For each (lang, source) the
distribution of each ratio of figures is held as a quantile sketch of logarithmic buckets: a count
per bucket, so sketches merge by adding counts, in any order and with the same result. Zeros are in no bucket: the
shares are judged among texts that have any.

Limits follow from the quartiles of these sketches alone. Quartiles of a group are drawn towards those of its language, and these
towards those of all texts, as if each had ``WEIGHT`` documents more of the wider kind: a large group stands for itself, a small one
moves smoothly to the wider sketch. A ratio may lie above the upper quartile by its reach times the spread of the quartiles and
``SLACK`` buckets (for ``word_length`` also below the lower one).

All of it is column expressions: no Python runs on the executors.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import SPACES, stored, whole_text

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Relative width of a bucket.
GAMMA = 1.02
#: Documents of the wider sketch that a group's quartiles are mixed with.
WEIGHT = 200
#: Buckets allowed beside that, a tenth of the value: quartiles may coincide.
SLACK = 5
#: Per ratio: (numerator, denominator, quartile that its spread is measured from, reach in spreads, whether low values are odd too).
RATIOS = {
    "word_length": ("word_chars", "n_words", "q1", 4.0, True),
    "symbol_share": ("n_symbols", "n_words", "q2", 3.0, False),
    "dup_line_share": ("n_dup_lines", "n_lines", "q2", 3.0, False),
    "repeat_share": ("n_repeat_words", "n_words", "q2", 3.0, False),
}
QUARTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75}


def figures(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the columns of ``FIGURES`` and ``n_lines`` (lines with a word), as long.

    Words are runs of characters other than ``SPACES``; a null text has none. Equality of words and
    lines is exact; windows of three words are compared by 64-bit hashes.
    """
    text = whole_text(text_column)
    words = F.filter(F.split(text, "[ \\t-\\r]+", -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = docs.withColumns({"_words": words, "_lines": lines})
    window = F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3),
        lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
    )
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.length(text).cast("long") - F.length(F.regexp_replace(text, "[#*$%&|<>]", "")),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.when(F.size("_words") >= 3, window),
        }
    )
    # Windows beside an equal one in sorted order are repeated. Most texts have none and skip the sort.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_placed", F.when(repeats, placed))
    beside = F.filter(
        F.col("_placed"),
        lambda e, j: F.coalesce(F.get("_placed", j - 1)["h"] == e["h"], F.lit(False))
        | F.coalesce(F.get("_placed", j + 1)["h"] == e["h"], F.lit(False)),
    )
    df = df.withColumn("_at", F.transform(beside, lambda e: e["i"]))
    covered = F.array_union(
        F.array_union("_at", F.transform("_at", lambda i: i + 1)), F.transform("_at", lambda i: i + 2)
    )
    # The partition id, always true, keeps later filters above this projection: pushed below it, they would work out the
    # arrays again for each of their elements.
    repeated = F.when(F.col("_at").isNotNull() & (F.spark_partition_id() >= 0), F.size(covered)).otherwise(0)
    df = df.withColumn("n_repeat_words", repeated.cast("long"))
    return df.drop("_words", "_lines", "_windows", "_placed", "_at")


def _bucket(ratio: str) -> Column:
    """Logarithmic bucket of a ratio; null where it is zero, or the document has no words or lines."""
    above, below, *_ = RATIOS[ratio]
    value = F.col(above) / F.col(below)
    return F.when((F.col(below) > 0) & (F.col(above) > 0), F.ceil(F.log(value) / math.log(GAMMA)).cast("int"))


def with_buckets(df: DataFrame) -> DataFrame:
    return df.withColumns({f"_{r}": _bucket(r) for r in RATIOS})


def sketches(df: DataFrame) -> DataFrame:
    """(lang, source, ratio, bucket, n): quantile sketches of documents that pass the base rules."""
    pairs = F.array(*[F.struct(F.lit(r).alias("ratio"), F.col(f"_{r}").alias("bucket")) for r in RATIOS])
    rows = df.where(~F.col("base_failed")).select("lang", "source", F.explode(pairs).alias("p"))
    counted = rows.where("p.bucket IS NOT NULL").groupBy("lang", "source", "p.ratio", "p.bucket")
    return counted.agg(F.count(F.lit(1)).alias("n"))


def _quartiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """(keys, ratio, total, q1, q2, q3) of sketches merged per key."""
    merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "ratio")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.withColumns({"upto": upto, "total": F.sum("n").over(group)})
    first = lambda share: F.min(F.when(F.col("upto") >= share * F.col("total"), F.col("bucket")))
    return ranked.groupBy(*keys, "ratio").agg(F.max("total").alias("total"), *[first(p).alias(q) for q, p in QUARTILES.items()])


def thresholds(sketch: DataFrame, weight: float = WEIGHT) -> DataFrame:
    """(lang, source, and per ratio its lowest and highest bucket): one row per (lang, source) of the sketches.

    A limit is null where no text of any group has the ratio.
    """
    values = ("total", *QUARTILES)
    named = lambda df, side, *keys: df.select(*[F.col(c).alias(f"{side}_{c}") for c in (*keys, "ratio", *values)])
    own = named(_quartiles(sketch, "lang", "source"), "o", "lang", "source")
    by_lang, all_ = named(_quartiles(sketch, "lang"), "l", "lang"), named(_quartiles(sketch), "a")
    groups = sketch.where(F.col("ratio") == "word_length").select("lang", "source").distinct()
    df = groups.select("lang", "source", F.explode(F.array(*map(F.lit, RATIOS))).alias("ratio"))
    same = lambda side, *keys: reduce(lambda x, k: x & F.col(k).eqNullSafe(F.col(f"{side}_{k}")), keys, F.col("ratio") == F.col(f"{side}_ratio"))
    df = df.join(own, same("o", "lang", "source"), "left").join(by_lang, same("l", "lang"), "left").join(all_, same("a"), "left")

    def mixed(total: str, value: str, wider: Column) -> Column:
        n = F.col(total)
        return F.coalesce((n * F.col(value) + weight * wider) / (n + weight), wider)

    drawn = {q: mixed("o_total", f"o_{q}", mixed("l_total", f"l_{q}", F.col(f"a_{q}").cast("double"))) for q in QUARTILES}
    df = df.select("lang", "source", "ratio", *[v.alias(q) for q, v in drawn.items()])
    cases = {r: (F.col("ratio") == r, base, reach, both) for r, (_, _, base, reach, both) in RATIOS.items()}
    far = F.coalesce(*[F.when(here, (F.col("q3") - F.col(base)) * reach + SLACK) for here, base, reach, _ in cases.values()])
    low = F.coalesce(*[F.when(here, F.col("q1") - F.col("far")) for here, _, _, both in cases.values() if both])
    df = df.withColumn("far", far).select("lang", "source", "ratio", low.alias("low"), (F.col("q3") + F.col("far")).alias("high"))
    one = lambda r, c: F.max(F.when(F.col("ratio") == r, F.col(c))).alias(f"_{r}_{c}")
    return df.groupBy("lang", "source").agg(*[one(r, c) for r in RATIOS for c in ("low", "high")])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _judged(df: DataFrame, limits: DataFrame) -> DataFrame:
    """``df`` with ``kept``. Documents of a group without limits (none passed the base rules) failed those."""
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    met = df.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    odd = F.lit(False)
    for r in RATIOS:
        odd = odd | F.coalesce((F.col(f"_{r}") > F.col(f"_{r}_high")) | (F.col(f"_{r}") < F.col(f"_{r}_low")), F.lit(False))
    return met.withColumn("kept", ~F.col("base_failed") & ~odd)


def quality_verdicts(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, figures, base_failed, kept) for every row of ``docs``.

    Rows with a null or repeated id are judged as rows of their own. A null lang or source is a
    group like any other. A null or empty text has no words and fails the base rules. Ties fall in one
    bucket. An empty table gives an empty result. Other columns are not read.
    """
    named = docs.select(F.col(id_column).alias("doc_id"), "lang", "source", "text")
    found = with_buckets(figures(named).withColumn("base_failed", base_failed())).drop("text")
    found = stored(found, "quality-figures")
    judged = _judged(found, stored(thresholds(sketches(found)), "quality-thresholds"))
    return judged.select(F.col("doc_id").alias(id_column), *FIGURES, "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns. Two passes over the texts, no shuffle of them.

    Nulls in lang and source are groups like any other; rows without a text go. An empty table stays empty.

    The limits come from a stored table with one narrow row per (lang, source), so its size is known when
    Spark chooses how to join. ``docs`` needs lang, source and text; other columns are kept.
    """
    def found(df: DataFrame) -> DataFrame:
        return with_buckets(figures(df).withColumn("base_failed", base_failed()))

    limits = stored(thresholds(sketches(found(docs.select("lang", "source", "text")))), "quality-thresholds")
    row = docs.select(F.struct(*docs.columns).alias("_row"), "lang", "source", "text")
    return _judged(found(row), limits).where("kept").select("_row.*")
