"""The operators as named queries over the given tables, with reference SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import divergence, fill_middle, language_id, line_dedup, lz_fingerprint, mixing, ngram_join, packing, quality, rendering, sql, tokens, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, reference: str | None = None):
    def add(build):
        QUERIES[name] = build
        if reference:
            ORACLE_SQL[name] = reference
        return build

    return add


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file; ``REVIEWLOOM_TOKENIZERS`` names another folder."""
    folder = os.environ.get("REVIEWLOOM_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_ngram_jaccard")
def _(spark, folder):
    return ngram_join.linked_groups(documents(spark, folder))


@query("op1_ngram_jaccard_links")
def _(spark, folder):
    return ngram_join.link_counts(documents(spark, folder))


@query("op2_lz_fingerprint")
def _(spark, folder):
    return lz_fingerprint.compare_next(documents(spark, folder))


@query("op3_line_dedup", sql.LINES)
def _(spark, folder):
    return line_dedup.line_report(documents(spark, folder))


@query("op4_quality_rules", sql.QUALITY)
def _(spark, folder):
    return quality.quality_verdicts(documents(spark, folder))


@query("op5_html_extraction")
def _(spark, folder):
    return rendering.extract_text(spark.read.parquet(f"{folder}/pages.parquet"))


@query("op6_toxicity")
def _(spark, folder):
    return toxicity.severity(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query("op7_warc", sql.WARC)
def _(spark, folder):
    return warc.round_trip(spark.read.parquet(f"{folder}/pages.parquet"))


@query("op8_best_fit_packing")
def _(spark, folder):
    return packing.pack_documents(documents(spark, folder), tokenizer_path())


@query("op9_source_mixing")
def _(spark, folder):
    return mixing.mixture(documents(spark, folder))


@query("op10_token_counts")
def _(spark, folder):
    return tokens.count_tokens(documents(spark, folder), tokenizer_path())


@query("op11_fill_in_middle", sql.FILL_MIDDLE)
def _(spark, folder):
    return fill_middle.digests(documents(spark, folder))


@query("op12_language_id")
def _(spark, folder):
    return language_id.identify(documents(spark, folder))


@query("op13_source_divergence", sql.DIVERGENCE)
def _(spark, folder):
    return divergence.audit(documents(spark, folder))
