"""Warehouse tables of one source folder, built once per application and read by all reports.

The reports read the stored ``reviews`` and ``review_relevant`` tables, as dashboards
do, instead of joining and scoring again for each figure. Tables live in the shared
folder under the application's id, so another application never meets them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_rows, join_and_flag, rejected_rows
from ..operators.skew import Profiles
from ..operators.serve import RELEVANT, review_ranking
from ..session import STAGED_CODEC, scratch_path
from ..sources import layout
from ..sources.driver_tables import (
    BUILDERS, CORPUS_LEXICON, STORED_CONFIDENCE, STORED_RELEVANCE, BaseTables, review_class,
)
from ..sources.writers import as_review_relevant, as_reviews
from .jobs import score_reviews, stage_flagged

INGESTED_AT = "2024-01-15 00:00:00"


# Tables that are aggregates of a given table; stored once rather than aggregated per use.
STORED = ("cart_items", "seller_products", "wishlist_item")


class Sources(Mapping[str, DataFrame]):
    """Source tables of a folder, each built at first use."""

    def __init__(self, spark: SparkSession, base: BaseTables):
        self._spark, self._base = spark, base
        self._built: dict[str, DataFrame] = {}
        #: Hot join keys, kept as long as the tables.
        self.profiles = Profiles(self)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            df = BUILDERS[name](self._base)
            if name in STORED:
                path = scratch_path(self._spark, name)
                df.write.parquet(path)
                df = self._spark.read.schema(df.schema).parquet(path)
            self._built[name] = df
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)


@dataclass
class Warehouse:
    spark: SparkSession
    folder: str
    statistics: dict = field(default_factory=dict)
    _keyed: dict = field(default_factory=dict)

    @cached_property
    def base(self) -> BaseTables:
        return BaseTables(self.spark, self.folder)

    @cached_property
    def sources(self) -> Sources:
        return Sources(self.spark, self.base)

    @cached_property
    def classes(self) -> DataFrame:
        return review_class(self.base)

    @cached_property
    def flagged(self) -> DataFrame:
        staged, self.statistics = stage_flagged(join_and_flag(self.sources), scratch_path(self.spark, "flagged"))
        return staged

    @property
    def clean(self) -> DataFrame:
        return clean_rows(self.flagged.where(F.col("verdict") == "clean").drop("verdict"))

    @property
    def rejected(self) -> DataFrame:
        at = F.lit(INGESTED_AT).cast("timestamp")
        return rejected_rows(self.flagged.where(F.col("verdict") == "rejected").drop("verdict"), at)

    @property
    def reviews(self) -> DataFrame:
        return as_reviews(self.clean, F.lit(INGESTED_AT))

    @cached_property
    def review_relevant(self) -> DataFrame:
        scored = score_reviews(
            self.reviews, self.classes, CORPUS_LEXICON, confidence=STORED_CONFIDENCE, relevance=STORED_RELEVANCE
        )
        scored = as_review_relevant(scored)
        path = scratch_path(self.spark, "review_relevant")
        scored.write.option("compression", STAGED_CODEC).parquet(path)
        return self.spark.read.schema(scored.schema).parquet(path)


    # --- layouts for single requests, built at first use ---
    @cached_property
    def ranking(self) -> layout.Bucketed:
        return layout.store_bucketed(review_ranking(self.review_relevant), "review_ranking", ["p_id"], ["by", "rank"])

    @cached_property
    def relevant_by_pair(self) -> layout.Bucketed:
        relevant = self.review_relevant.where(F.col("relevant_status") == RELEVANT)
        return layout.store_bucketed(relevant, "relevant_by_pair", ["buyer_id", "p_id"], ["relevance_score"])

    def keyed(self, table: str, *keys: str) -> layout.Bucketed:
        """A source table bucketed by some of its columns."""
        if (table, keys) not in self._keyed:
            self._keyed[table, keys] = layout.store_bucketed(self.sources[table], table, list(keys))
        return self._keyed[table, keys]

    @cached_property
    def product_pages(self) -> layout.Pages:
        return layout.Pages(self.sources["product"].select("p_id", "p_name"), ["p_id"])

    @cached_property
    def product_names(self) -> layout.TrigramIndex:
        return layout.TrigramIndex(self.sources["product"].select("p_id", "p_name", "price"), "p_name")


_OPEN: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, folder: str, refresh: bool = False) -> Warehouse:
    """The folder's warehouse; its stored tables are kept for the application unless ``refresh`` asks for new ones."""
    key = (spark.sparkContext.applicationId, folder)
    if refresh or key not in _OPEN:
        _OPEN[key] = Warehouse(spark, folder)
    return _OPEN[key]
