"""Corpus preparation as stages over ``documents``; each stage's rows are stored and read again by the next.

All stages take nulls in any column, empty and very long texts, and columns of other names, which they keep (the last returns pieces
instead). Rows that repeat an id are rows of their own (for line dedup they are one document: none of them takes a line from another). An
empty table gives an empty result, without an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewloom.llm import line_dedup, mixing, ngram_join, packing, quality
from reviewloom.llm.registry import tokenizer_path
from reviewloom.llm.tables import stored

#: No source loses a document: the least budget that gives each a whole pass, small sources at most two.
MIXTURE = mixing.Targets(entropy=0.95, most_passes=2.0, budget=None)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits of their language and source; a null or empty text fails the base rules."""
    return quality.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in an earlier document go; ``n_chars`` follows the text. Documents without an id come after all others."""
    return line_dedup.dedup_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more over five-word shingles; texts without words all stay."""
    return ngram_join.first_of_groups(docs, size=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks for; a null source is a source like any other."""
    return mixing.mixed_documents(docs, MIXTURE)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in sequences of 2048 tokens; a null text is an empty one, with its end token alone."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: Similarity search, seeded permutations and packing are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
