"""Topics that are learned: tf-idf vectors around one centroid per topic, refined by expectation-maximisation.

Seed words give every text a first share of each topic. In a round the centroids are the normed sums of the texts' vectors by these shares, and the
new shares are the posterior of a mixture of von Mises-Fisher distributions of one concentration: softmax of ``KAPPA``
times the cosine, and the topic's weight. Both steps are joins and aggregates; a text travels as one row with the bag of its
words at most, sums per text and per word besides. The driver sees nothing but the sums per topic. The confidence of a topic is its posterior.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import share_package, stored
from .classify import KEYWORDS

#: Concentration of the topics, and texts that a word occurs in at least.
KAPPA, LEAST_TEXTS = 12.0, 5


def bags(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, bag): words and their numbers; words are runs of letters in lower case. Those without a key, or a word, have none.

    A text is counted where it is read, and nothing is shuffled for it. Rows of one key are one text: these alone are counted
    together, and have a row of ``bag`` per word. So no word comes twice for a key.
    """

    def counted(batches):
        for batch in batches:
            words = batch.column(1)
            row = np.repeat(np.arange(len(words)), words.value_lengths().fill_null(0).to_numpy())
            codes = words.flatten().dictionary_encode()
            many = max(len(codes.dictionary), 1)
            pairs, n = np.unique(row * many + codes.indices.to_numpy(), return_counts=True)
            at, word = np.divmod(pairs, many)
            rows, first = np.unique(at, return_index=True)
            bag = pa.StructArray.from_arrays([codes.dictionary.take(pa.array(word)), pa.array(n, pa.int64())], names=["word", "n"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(pairs)), pa.int32()), bag)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), lists], names=["key", "bag"])

    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    # Few keys come more than once; Spark knows the stored table's size.
    often = stored(rows.groupBy("key").count().where("count > 1").select("key"), "repeated-keys")
    share_package(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    words = F.regexp_extract_all(F.lower(F.col("text")), F.lit(r"\p{L}+"), F.lit(0))
    count = lambda texts: texts.select("key", words.alias("words")).mapInArrow(counted, f"key {kind}, bag array<struct<word: string, n: bigint>>")
    if often.isEmpty():
        return count(rows)
    shared = rows.join(often, "key", "left_semi").select("key", F.explode(words).alias("word")).groupBy("key", "word")
    shared = shared.agg(F.count(F.lit(1)).alias("n")).select("key", F.array(F.struct("word", "n")).alias("bag"))
    return count(rows.join(often, "key", "left_anti")).unionByName(shared)


def vocabulary(found: DataFrame, least: int = LEAST_TEXTS) -> DataFrame:
    """(word, idf): logarithm of texts per text with the word."""
    texts = found.agg(F.count_distinct("key")).scalar()
    counts = found.select(F.explode("bag.word").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n_texts")).where(F.col("n_texts") >= least)
    return counts.select("word", F.log(texts / F.col("n_texts")).alias("idf"))


def _per_text(found: DataFrame, words: DataFrame, *values: Column) -> DataFrame:
    """``values`` per key, with ``length``: that of the text's tf-idf vector, null or 0 where no word of it is known.

    Only sums per text are shuffled where the vocabulary is small enough to be broadcast.
    """
    rows = found.select("key", F.inline("bag")).join(words, "word", "left")
    value = F.col("n") * F.col("idf")
    return rows.groupBy("key").agg(F.sqrt(F.sum(value * value)).alias("length"), *values)


def seed_shares(found: DataFrame, words: DataFrame, keywords: Mapping[str, Sequence[str]]) -> DataFrame:
    """(key, length, shares): each topic's part of the seed words of a text; equal parts where there are none."""
    hits = [F.sum(F.when(F.col("word").isin(*w), F.col("n")).otherwise(0)) for w in keywords.values()]
    told = _per_text(found, words, F.array(*hits).alias("hits"))
    total = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x)
    share = F.transform("hits", lambda h: F.when(total > 0, h / total).otherwise(1.0 / len(keywords)))
    return told.select("key", "length", share.alias("shares"))


@dataclass(frozen=True)
class Topics:
    """What was learned: (word, idf, centre) with an array of one value per topic, and the topics' weights."""

    names: tuple[str, ...]
    words: DataFrame
    weights: tuple[float, ...]


def _centres(found: DataFrame, shares: DataFrame, words: DataFrame, names: Sequence[str]) -> Topics:
    """Maximisation: the normed sums of the vectors by their shares; stored."""
    k = range(len(names))
    weights = shares.where("length > 0").select("key", *[(F.get("shares", F.lit(t)) / F.col("length")).alias(f"w{t}") for t in k])
    # The bags travel whole: a row per text, and only sums per word after that.
    rows = found.join(weights, "key").select(F.inline("bag"), *[f"w{t}" for t in k])
    sums = rows.groupBy("word").agg(*[F.sum(F.col("n") * F.col(f"w{t}")).alias(f"s{t}") for t in k])
    sums = sums.join(words.where("idf > 0"), "word").select("word", "idf", F.array(*[F.col("idf") * F.col(f"s{t}") for t in k]).alias("sums"))
    sums = stored(sums, "topic-sums")
    lengths = sums.agg(*[F.sqrt(F.sum(F.pow(F.get("sums", F.lit(t)), F.lit(2.0)))) for t in k]).first()
    mass = shares.agg(F.count(F.lit(1)), *[F.sum(F.get("shares", F.lit(t))) for t in k]).first()
    centre = F.array(*[F.get("sums", F.lit(t)) / F.lit(lengths[t] or 1.0) for t in k])
    weights = tuple((mass[t + 1] or 0.0) / mass[0] if mass[0] else 1 / len(names) for t in k)
    return Topics(tuple(names), sums.select("word", "idf", centre.alias("centre")), weights)


def posterior(found: DataFrame, topics: Topics, kappa: float = KAPPA) -> DataFrame:
    """Expectation: (key, length, shares) of every text; one without a known word has the topics' weights."""
    k = range(len(topics.names))
    dots = [F.sum(F.col("n") * F.col("idf") * F.get("centre", F.lit(t))).alias(f"c{t}") for t in k]
    met = _per_text(found, topics.words, *dots)
    cosine = [F.when(F.col("length") > 0, F.col(f"c{t}") / F.col("length")).otherwise(0.0) for t in k]
    level = F.array(*[kappa * cosine[t] + F.lit(math.log(max(topics.weights[t], 1e-300))) for t in k])
    rows = met.select("key", "length", level.alias("level"))
    powers = F.transform("level", lambda x: F.exp(x - F.array_max("level")))
    rows = rows.select("key", "length", powers.alias("p"))
    return rows.select("key", "length", F.transform("p", lambda x: x / F.aggregate("p", F.lit(0.0), lambda a, y: a + y)).alias("shares"))


def learn(df: DataFrame, key: str, text: str, keywords: Mapping[str, Sequence[str]] = KEYWORDS, rounds: int = 3, kappa: float = KAPPA, least: int = LEAST_TEXTS) -> Topics:
    """Topics from the texts of ``df`` and seed words; texts without a word teach nothing. Each round is stored."""
    found = stored(bags(df, key, text), "topic-bags")
    words = stored(vocabulary(found, least), "vocabulary")
    shares = stored(seed_shares(found, words, keywords), "topic-shares")
    topics = _centres(found, shares, words, list(keywords))
    for _ in range(rounds - 1):
        shares = stored(posterior(found, topics, kappa), "topic-shares")
        topics = _centres(found, shares, words, list(keywords))
    return topics


def assign(df: DataFrame, key: str, text: str, topics: Topics, kappa: float = KAPPA) -> DataFrame:
    """(key, category_review, confidence_score) of every text of ``df``, also of texts that nothing was learned from.

    A text without a word, or null, has no topic and confidence 0. Of equal posteriors the first topic's counts.
    """
    shares = posterior(bags(df, key, text), topics, kappa)
    best: Column = F.array_max("shares")
    names = F.array(*[F.lit(n) for n in topics.names])
    told = shares.select("key", F.get(names, F.array_position("shares", best).cast("int") - 1).alias("category_review"), best.alias("confidence_score"))
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
    return rows.join(told, "key", "left").select(F.col("key").alias(key), "category_review", F.coalesce("confidence_score", F.lit(0.0)).alias("confidence_score"))
