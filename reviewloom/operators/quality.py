"""Expectations, integrity checks and the quality report.

Checks return rows and never raise. All checks of a table's own columns are one aggregate over it. References between
tables compare bitmaps of keys (``keysets.py``); repeated keys are one count per (key space, key) over a single scan of each table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import is_blank, is_trim_empty, n_rows, percent
from ..schemas import (
    CHECKS, DECLARED_REASONS, FOREIGN_KEYS, KNOWN_REASONS, PRIMARY_KEYS, REQUIRED, TEXT_LIMITS, UNIQUE_KEYS,
    ForeignKey,
)
from . import keysets


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _result(df: DataFrame, name: str, failed: Column, total: Column, passed: Column | None = None) -> DataFrame:
    ok = (F.col("failed") == 0) if passed is None else passed
    return df.select(failed.cast("long").alias("failed"), total.cast("long").alias("checked")).select(
        F.lit(name).alias("name"), ok.alias("passed"), "failed", "checked"
    )


# --- expectations ------------------------------------------------------------
def expect_rows(df: DataFrame, name: str = "not_empty") -> DataFrame:
    """One row at least; stops at the first row found."""
    one = df.limit(1).agg(n_rows().alias("n"))
    return _result(one, name, F.when(F.col("n") > 0, 0).otherwise(1), F.col("n"))


def expect_between(df: DataFrame, column: str, low=None, high=None, name: str | None = None) -> DataFrame:
    """Values within bounds; null passes."""
    inside = F.lit(True)
    if low is not None:
        inside = inside & (F.col(column) >= low)
    if high is not None:
        inside = inside & (F.col(column) <= high)
    found = df.agg(F.count_if(~inside).alias("bad"), n_rows().alias("n"))
    return _result(found, name or f"{column}_range", F.col("bad"), F.col("n"))


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(n_rows().alias("n"))


def expect_unique(df: DataFrame, keys: Sequence[str], name: str | None = None) -> DataFrame:
    """No key twice; failed counts all copies of repeated keys."""
    found = key_counts(df, keys).agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("bad"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
    )
    return _result(found, name or f"{'_'.join(keys)}_unique", F.col("bad"), F.col("n"))


def expect_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column, all counted in one pass."""
    one = df.agg(n_rows().alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(f"{c}_not_null").alias("name"), F.col(c).alias("bad"), F.col("n")) for c in columns])
    return one.select(F.inline(rows)).select(
        "name", (F.col("bad") == 0).alias("passed"), F.col("bad").alias("failed"), F.col("n").alias("checked")
    )


def expect_text(df: DataFrame, column: str, max_empty_percent: float = 10.0, name: str | None = None) -> DataFrame:
    """Fewer empty texts than the tolerance."""
    found = df.agg(F.count_if(is_blank(column)).alias("bad"), n_rows().alias("n"))
    ok = percent(F.col("failed"), F.col("checked")) < max_empty_percent
    return _result(found, name or f"{column}_not_empty", F.col("bad"), F.col("n"), ok)


def expect_type(df: DataFrame, column: str, expected: str, name: str | None = None) -> DataFrame:
    """Declared type of a column; reads no data."""
    right = df.schema[column].dataType.simpleString() == expected
    return df.sparkSession.range(1).select(
        F.lit(name or f"{column}_type").alias("name"), F.lit(right).alias("passed"),
        F.lit(0 if right else 1).cast("long").alias("failed"), F.lit(1).cast("long").alias("checked"),
    )


def references(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct referenced keys, orphan keys, orphan rows, and share of valid keys; null keys pass.

    Both tables go through one aggregate over the key instead of a join: one shuffle of
    map-side combined keys, whatever the share of the most frequent one.
    """
    uses = child.select(F.col(column).alias("k"), F.lit(1).alias("used"), F.lit(0).alias("known"))
    keys = parent.select(F.col(parent_column).alias("k"), F.lit(0).alias("used"), F.lit(1).alias("known"))
    per_key = uses.union(keys).where(F.col("k").isNotNull()).groupBy("k").agg(
        F.sum("used").alias("used"), F.max("known").alias("known")
    )
    used, bad = F.col("used") > 0, F.col("known") == 0
    return per_key.agg(
        F.count_if(used).alias("keys"),
        F.count_if(bad).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(bad, F.col("used"))), F.lit(0)).alias("orphan_rows"),
    ).withColumn(
        "valid_pct", F.when(F.col("keys") > 0, (1 - F.col("orphan_keys") / F.col("keys")) * 100).otherwise(100.0)
    )


def expect_references(child, column, parent, parent_column, name: str | None = None) -> DataFrame:
    found = references(child, column, parent, parent_column)
    return _result(found, name or f"{column}_references", F.col("orphan_keys"), F.col("keys"))


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The source checks as (name, passed, failed, checked).

    References go through key sets (``keysets.py``): one scan of each table's keys, besides one of its own columns.
    """
    review, product, links = tables["review"], tables["product"], tables["product_reviews"]
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def check(name: str, failed: Column, checked: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), failed.cast("long").alias("failed"), checked.cast("long").alias("checked"))

    def outside(column: str, low, high=None) -> Column:
        bad = F.col(column) < low
        return F.count_if(bad if high is None else bad | (F.col(column) > high))

    def own(df: DataFrame, *checks: Column) -> DataFrame:
        return df.agg(F.array(*checks).alias("c")).select(F.inline("c"))

    frames = [
        own(
            product,
            check("product_not_empty", F.when(n_rows() > 0, zero).otherwise(one), F.least(n_rows(), one)),
            check("price_positive", outside("price", 0), n_rows()),
        ),
        own(
            review,
            check("rating_range", outside("rating", 1, 5), n_rows()),
            *[check(f"{c}_not_null", F.count_if(F.col(c).isNull()), n_rows()) for c in ("review_id", "rating", "buyer_id")],
            check("review_text_not_empty", F.count_if(is_blank("r_desc")), n_rows()),
        ),
        expect_type(links, "review_id", "bigint", "review_id_type").select("name", "failed", "checked"),
    ]
    keys = [("product_references", "product_reviews", "p_id", "product", "p_id")]
    for key in (
        ("buyer_references", "review", "buyer_id", "buyer", "buyer_id"),
        ("category_references", "product", "category_id", "category", "category_id"),
    ):
        if key[3] in tables:
            keys.append(key)
    copies = review.groupBy("review_id").agg(n_rows().alias("n"))
    repeated = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), zero)
    frames.append(own(copies, check("review_id_unique", repeated, F.coalesce(F.sum("n"), zero))))
    found = keysets.references(tables, [k[1:] for k in keys], count_rows=False)
    name = F.get(F.array(*[F.lit(k[0]) for k in keys]), F.col("pair"))
    frames.append(found.select(name.alias("name"), F.col("orphan_keys").alias("failed"), F.col("keys").alias("checked")))
    ok = F.when(F.col("name") == "review_text_not_empty", percent(F.col("failed"), F.col("checked")) < 10.0)
    return _union(frames).select("name", ok.otherwise(F.col("failed") == 0).alias("passed"), "failed", "checked")


def report_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        n_rows().alias("total_tests"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.round(F.count_if("passed") / n_rows() * 100, 1).alias("success_rate"),
    )


def stored_review_checks(reviews: DataFrame) -> DataFrame:
    """What the document schema of clean reviews demands."""
    return _union(
        [
            expect_not_null(reviews, ["review_id", "rating", "ingestion_timestamp"]),
            expect_between(reviews, "rating", 1, 5, "rating_range"),
            expect_type(reviews, "rating", "int", "rating_type"),
        ]
    )


def joined_checks(joined: DataFrame) -> DataFrame:
    """Null keys after the join; reported only, since left joins allow them."""
    return expect_not_null(joined, ["p_id", "review_id"])


# --- declared constraints ------------------------------------------------------
def _key(columns: Sequence[str]) -> Column:
    """A key of one or more columns, compared as text: whole numbers and dates have one spelling each."""
    return F.array(*[F.col(c).cast("string") for c in columns])


def _given(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey]) -> list[ForeignKey]:
    def has(table: str, column: str) -> bool:
        return table in tables and column in tables[table].columns

    return [k for k in keys if has(k.table, k.column) and has(k.parent, k.parent_column)]


def foreign_key_orphans(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey] = FOREIGN_KEYS) -> DataFrame:
    """Orphans per declared foreign key whose two columns are given; null keys pass. All keys at once, by ``keysets``."""
    given = _given(tables, keys)
    found = keysets.references(tables, [(k.table, k.column, k.parent, k.parent_column) for k in given])
    name = F.get(F.array(*[F.lit(k.name) for k in given]), F.col("pair"))
    return found.select(name.alias("foreign_key"), "keys", "orphan_keys", "orphan_rows")


def _key_counts(tables: Mapping[str, DataFrame], spaces: Sequence[tuple[str, tuple[str, ...]]]) -> DataFrame:
    """(space, k, n): rows per key of each (table, columns); every table is scanned once, keys are null where a column is."""
    entries: dict[str, list[tuple[int, tuple[str, ...]]]] = {}
    for i, (table, columns) in enumerate(spaces):
        entries.setdefault(table, []).append((i, columns))
    parts = []
    for table, wanted in entries.items():
        rows = F.array(*[F.struct(F.lit(i).alias("space"), _key(c).alias("k")) for i, c in wanted])
        parts.append(tables[table].select(F.inline(rows)))
    return _union(parts).groupBy("space", "k").agg(n_rows().alias("n"))


def _has_null() -> Column:
    return F.exists("k", lambda x: x.isNull())


def key_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated and null keys per declared primary or unique key (nulls are allowed in unique keys).

    All keys are counted in one aggregate over one scan of each table.
    """
    rules = []
    for table, df in tables.items():
        declared = [("primary", PRIMARY_KEYS[table])] + [("unique", k) for k in UNIQUE_KEYS.get(table, ())]
        rules += [(table, kind, columns) for kind, columns in declared if set(columns) <= set(df.columns)]
    counted = _key_counts(tables, [(table, columns) for table, _, columns in rules])
    null = _has_null()
    found = counted.groupBy("space").agg(
        F.count_if((F.col("n") > 1) & ~null).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0)).alias("null_rows"),
    )
    spark = next(iter(tables.values())).sparkSession
    listed = [(i, t, kind, ",".join(columns)) for i, (t, kind, columns) in enumerate(rules)]
    declared = spark.createDataFrame(listed, "space int, table_name string, kind string, columns string")
    zero = F.lit(0).cast("long")
    return declared.join(found, "space", "left").select(
        "table_name", "kind", "columns",
        F.coalesce("repeated_keys", zero).alias("repeated_keys"),
        F.when(F.col("kind") == "primary", F.coalesce("null_rows", zero)).otherwise(zero).alias("null_rows"),
    )


def _per_table(df: DataFrame, table: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """(table, rule, violations) for all rules of a table in one pass."""
    one = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, (_, bad) in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations")) for i, (n, _) in enumerate(rules)])
    return one.select(F.lit(table).alias("table_name"), F.inline(rows))


def check_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    frames = []
    for table, df in tables.items():
        rules = [(name, ~F.expr(sql)) for t, name, sql in CHECKS if t == table and name in df.columns]
        if rules:
            frames.append(_per_table(df, table, rules))
    return _union(frames)


def required_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    frames = []
    for table, df in tables.items():
        rules = [(c, F.col(c).isNull()) for c in REQUIRED.get(table, ()) if c in df.columns]
        if rules:
            frames.append(_per_table(df, table, rules))
    return _union(frames)


def length_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    frames = []
    for table, df in tables.items():
        rules = [
            (f"{c}({n})", F.length(F.col(c).cast("string")) > n)
            for c, n in TEXT_LIMITS.get(table, {}).items() if c in df.columns
        ]
        if rules:
            frames.append(_per_table(df, table, rules))
    return _union(frames)


# --- source statistics -----------------------------------------------------------
# Column of the count and the name it is reported under.
MOTIVES = (
    ("duplicates", "Doublons"),
    ("null_ratings", "Rating NULL"),
    ("invalid_ratings", "Rating invalide"),
    ("null_buyers", "Buyer ID NULL"),
    ("empty_descriptions", "Description vide"),
)


def rejection_statistics(review: DataFrame) -> DataFrame:
    """One row: totals, problem rows and counts per motive.

    Counting per review_id first answers "distinct ids that are repeated or have any
    problem" without a window or a self-join; the id column is all that is shuffled.
    """
    tests = {
        "null_ratings": F.col("rating").isNull(),
        "invalid_ratings": (F.col("rating") < 1) | (F.col("rating") > 5),
        "null_buyers": F.col("buyer_id").isNull(),
        "empty_descriptions": is_trim_empty("r_desc"),
    }
    per_id = review.groupBy("review_id").agg(n_rows().alias("n"), *[F.count_if(t).alias(c) for c, t in tests.items()])
    any_problem = reduce(lambda a, b: a | b, [F.col(c) > 0 for c in tests])
    problem = F.col("review_id").isNotNull() & ((F.col("n") > 1) | any_problem)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *tests)]
    return (
        per_id.agg(*sums, F.count_if(F.col("n") > 1).alias("duplicates"), F.count_if(problem).alias("rejected_reviews"))
        .withColumnRenamed("n", "total_reviews")
        .withColumn("clean_reviews", F.col("total_reviews") - F.col("rejected_reviews"))
        .withColumn("rejection_rate", percent(F.col("rejected_reviews"), F.col("total_reviews")))
        .select("total_reviews", "clean_reviews", "rejected_reviews", "rejection_rate", *[c for c, _ in MOTIVES])
    )


def rejection_report(review: DataFrame) -> DataFrame:
    """One row per motive that occurs, with its share of all reviews."""
    rows = F.array(
        *[F.struct(F.lit(label).alias("motive"), F.col(c).alias("nb_reviews"), F.col("total_reviews")) for c, label in MOTIVES]
    )
    return (
        rejection_statistics(review).select(F.inline(rows)).where(F.col("nb_reviews") > 0)
        .select("motive", "nb_reviews", percent(F.col("nb_reviews"), F.col("total_reviews")).alias("percentage"))
    )


def duplicate_count(review: DataFrame) -> DataFrame:
    return key_counts(review, ["review_id"]).agg(F.count_if(F.col("n") > 1).alias("duplicates"))


# --- rejects and run checks ---------------------------------------------------------
def reject_reasons(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("rejection_reason").agg(n_rows().alias("nb_reviews"))


def reason_vocabulary(rejected: DataFrame) -> DataFrame:
    """Rows per reason, whether the store declares it, and whether any rule emits it. Warning only."""
    return reject_reasons(rejected).select(
        "rejection_reason", "nb_reviews",
        F.col("rejection_reason").isin(*DECLARED_REASONS).alias("declared"),
        F.col("rejection_reason").isin(*KNOWN_REASONS).alias("known"),
    )


def rejection_guard(statistics: DataFrame, limit_percent: float = 1.0) -> DataFrame:
    """Status row: share of rejected rows against the accepted limit."""
    rate = percent(F.col("rejected_records"), F.col("total_records_processed"))
    return statistics.select(
        rate.alias("rejection_rate"), F.when(rate < limit_percent, "ok").otherwise("warning").alias("status")
    )


def load_guard(statistics: DataFrame) -> DataFrame:
    """Status row: warning where no row reached the warehouse."""
    n = F.coalesce(F.col("warehouse_inserts"), F.lit(0))
    return statistics.select(n.alias("rows_loaded"), F.when(n > 0, "success").otherwise("warning").alias("status"))


def failed_tables(status: DataFrame) -> DataFrame:
    """(failed, total, names) over load status rows (table_name, location, error); at most one row per table."""
    bad = F.col("location").isNull()
    return status.agg(
        F.count_if(bad).alias("failed"), n_rows().alias("total"),
        F.array_join(F.sort_array(F.collect_list(F.when(bad, F.col("table_name")))), ", ").alias("names"),
    )


def reconcile(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of source and sink per table, and their difference."""
    frames = []
    for name, (source, sink) in pairs.items():
        both = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
            sink.select(F.lit(0).alias("s"), F.lit(1).alias("t"))
        )
        frames.append(
            both.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"), F.coalesce(F.sum("t"), F.lit(0)).alias("sink_rows"))
            .select(F.lit(name).alias("table_name"), "source_rows", "sink_rows", (F.col("source_rows") - F.col("sink_rows")).alias("difference"))
        )
    return _union(frames)
