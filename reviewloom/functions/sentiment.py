"""Lexicon sentiment, computed in Arrow batches.

Rules after Hutto & Gilbert, "VADER" (ICWSM 2014): valence per word, capitals, degree words and negations
among the three words before, contrast word, emphasis marks, then normalisation to -1..1. Tokens of one
character count for nothing, not even as distance. A word is looked up in a dictionary, so the cost doesn't
grow with the lexicon; scoring adds no shuffle to a plan.
"""

from __future__ import annotations

import math
from collections import ChainMap
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field, replace
from functools import cached_property

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import share_package
from .scalar import PUNCTUATION

# Fixed values of the published method.
DEGREE = 0.293
CAPITALS = 0.733
NEGATION = -0.74
DISTANCE_FACTORS = (1.0, 0.95, 0.9)
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, MAX_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96
NORMALISER = 15.0
NEVER_SO = 1.25
#: Idioms of the published method with their valences (fixed values).
IDIOMS = {
    "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5, "to die for": 3.0,
    "beating heart": 3.1, "broken heart": -2.9, "cut the mustard": 2.0, "hand to mouth": -2.0, "back handed": -2.0,
    "upper hand": 1.0, "break a leg": 2.0,
}
#: Degree words of two parts (fixed values): they lower what follows.
_LOWERING_PAIRS = ("kind of", "sort of", "just enough")

# A small lexicon of our own, by strength; pass a larger one as a parameter.
_STRENGTHS = {
    3.0: "love loved loves adore amazing awesome excellent outstanding perfect superb fantastic wonderful best",
    2.5: "great brilliant delighted beautiful impressive fabulous thrilled happy",
    2.0: "good enjoy enjoyed pleased lovely recommend recommended quality reliable favorite satisfied nice glad",
    1.5: "well fine helpful useful comfortable easy friendly fast quick sturdy soft fresh works gentle clean like",
    1.0: "ok okay decent fair adequate cute handy smooth thanks thank bright neat",
    -1.0: "slow small thin cheap noisy dull bland sticky greasy late missing",
    -1.5: "hard difficult weak problem problems issue issues leak leaked leaks unhappy rough dry return returned",
    -2.0: "bad poor broken broke damaged defective disappointed disappointing fail failed fails useless sad wrong "
    "dirty annoying unusable fake itchy",
    -2.5: "awful ugly angry disgusting waste wasted ruined scam nasty painful worse",
    -3.0: "hate hated hates horrible terrible worst disaster dreadful garbage rubbish",
}


# Verbs whose negations are written with "n't" or, carelessly, with "nt".
_VERBS = "ai are ca could dare did do does had has have is might must need ought sha should was were wo would".split()


@dataclass(frozen=True)
class Lexicon:
    """Valences and modifying words, all in lower case. Any word with "n't" in it negates too."""

    valence: Mapping[str, float]
    raising: frozenset[str] = frozenset(
        "very really extremely so absolutely completely totally highly incredibly especially most truly "
        "particularly deeply hugely super".split()
    )
    lowering: frozenset[str] = frozenset(
        "barely hardly slightly somewhat partly almost scarcely marginally kinda sorta occasionally less little".split()
    )
    negating: frozenset[str] = frozenset(
        "not no never none nor neither nobody nothing nowhere cannot cant without rarely seldom despite nope".split()
    ) | frozenset(f"{verb}nt" for verb in _VERBS)
    contrast: str = "but"
    #: Phrases with a valence of their own, and degree words of several parts, as words between single spaces.
    phrases: Mapping[str, float] = field(default_factory=dict)
    lowering_phrases: frozenset[str] = frozenset()

    @cached_property
    def automaton(self) -> dict:
        """The phrases as nested tables by word; ``None`` holds the whole phrase where one ends."""
        start: dict = {}
        for phrase in (*self.phrases, *self.lowering_phrases):
            at = start
            for word in phrase.split():
                at = at.setdefault(word, {})
            at[None] = phrase
        return start

    def joined(self, lowered: list[str]) -> list[tuple[int, int]]:
        """(first, last + 1) of the units of a text: single words, and the longest phrase from where one starts."""
        units, i = [], 0
        while i < len(lowered):
            at, end, j = self.automaton, i + 1, i
            while j < len(lowered) and (at := at.get(lowered[j])) is not None:
                j += 1
                if None in at:
                    end = j
            units.append((i, end))
            i = end
        return units

    def negates(self, word: str) -> bool:
        return word in self.negating or "n't" in word


DEFAULT_LEXICON = Lexicon(
    {w: v for v, words in _STRENGTHS.items() for w in words.split()}, phrases=IDIOMS, lowering_phrases=frozenset(_LOWERING_PAIRS)
)


def lexicon_from_rows(rows, **modifiers) -> Lexicon:
    """Lexicon from (word, valence) pairs; ``raising``, ``lowering`` and ``negating`` words replace the default ones."""
    given = {name: frozenset(w.lower() for w in words) for name, words in modifiers.items()}
    return replace(Lexicon({word.lower(): float(value) for word, value in rows}), **given)


def _emphasis(text: str) -> float:
    asks = text.count("?")
    loud = min(text.count("!"), MAX_EXCLAMATIONS) * EXCLAMATION
    return loud + (0.0 if asks <= 1 else asks * QUESTION if asks <= MAX_QUESTIONS else MANY_QUESTIONS)


def score_text(text: str, lexicon: Lexicon) -> float:
    """Sentiment of one text in -1..1."""
    words = [w.strip(PUNCTUATION) or w for w in text.split() if len(w) > 1]
    lowered = [w.lower() for w in words]
    valence = lexicon.valence
    if lexicon.automaton:
        units = lexicon.joined(lowered)
        if len(units) < len(lowered):
            words = [" ".join(words[i:j]) for i, j in units]
            lowered = [" ".join(lowered[i:j]) for i, j in units]
            valence = ChainMap(lexicon.phrases, valence)
    places = [i for i, w in enumerate(lowered) if w in valence]
    if not places:
        return 0.0
    shouted = sum(map(str.isupper, words))
    mixed = 0 < shouted < len(words)
    turn = lowered.index(lexicon.contrast) if lexicon.contrast in lowered else None
    total = 0.0
    for i in places:
        value = valence[lowered[i]]
        sign = (value > 0) - (value < 0)
        if mixed and words[i].isupper():
            value += sign * CAPITALS
        for distance, factor in enumerate(DISTANCE_FACTORS, start=1):
            before = lowered[i - distance] if i >= distance else None
            # A word with a valence of its own modifies no other word.
            if before is None or before in valence:
                continue
            degree = DEGREE if before in lexicon.raising else -DEGREE if before in lexicon.lowering or before in lexicon.lowering_phrases else 0.0
            if degree:
                if mixed and words[i - distance].isupper():
                    degree += CAPITALS
                value += sign * degree * factor
            if lexicon.negates(before):
                value *= _negation(lowered, i, distance)
        if i and lowered[i - 1] == "least" and "least" not in valence and (i < 2 or lowered[i - 2] not in ("at", "very")):
            value *= NEGATION
        if turn is not None and i != turn:
            value *= BEFORE_CONTRAST if i < turn else AFTER_CONTRAST
        total += value
    total += ((total > 0) - (total < 0)) * _emphasis(text)
    return round(total / math.sqrt(total * total + NORMALISER), 4)


def _negation(lowered: list[str], i: int, distance: int) -> float:
    """What the negation ``distance`` words before place i does: "never so good" praises, "without doubt" negates nothing."""
    word, between = lowered[i - distance], lowered[i - distance + 1 : i]
    if word == "never" and ("so" in between or "this" in between):
        return NEVER_SO
    if word == "without" and "doubt" in between:
        return 1.0
    return NEGATION


def compound(text: str, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Sentiment of a text column in -1..1, null for null."""
    if spark := SparkSession.getActiveSession():
        share_package(spark)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else score_text(t, lexicon) for t in texts], dtype="float64")

    return scored(F.col(text))


def keyword_score(text: str, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Sentiment moved to 0..1; a missing text scores 0.0, not 0.5."""
    return F.coalesce((compound(text, lexicon) + 1) / 2, F.lit(0.0))


#: Reviews that count as much as those of a word when its odds are fitted, and reviews that a fitted word occurs in at least.
PRIOR, LEAST_REVIEWS = 10.0, 5
#: Valence of a word three times as frequent in one kind of reviews is about 2; none is beyond 4.
SCALE, STRONGEST = 2.0, 4.0


def fitted_valences(reviews: DataFrame, text: str = "description", rating: str = "rating", prior: float = PRIOR, least: int = LEAST_REVIEWS) -> DataFrame:
    """(word, valence, n_positive, n_negative): valences of words from the ratings of the reviews they occur in.

    Reviews of 4 or 5 are positive, of 1 or 2 negative, others and those without text don't count. A word counts
    once per review. Its share of either kind is mixed with its share of both by ``prior`` reviews, so that rare words are
    near 0; the valence is the logarithm of their ratio, scaled. One aggregate by word, which combines map-side.
    """
    kind = F.when(F.col(rating) >= 4, 1).when(F.col(rating) <= 2, 0)
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[\p{L}']+"), F.lit(0)))
    rows = reviews.where(F.col(text).isNotNull()).select(kind.alias("kind"), words.alias("words")).where("kind IS NOT NULL")
    total = rows.agg(F.struct(F.count_if(F.col("kind") == 1).alias("p"), F.count_if(F.col("kind") == 0).alias("n"))).scalar()
    counted = rows.select("kind", F.explode("words").alias("word")).groupBy("word").agg(
        F.count_if(F.col("kind") == 1).alias("n_positive"), F.count_if(F.col("kind") == 0).alias("n_negative")
    )
    both = F.col("n_positive") + F.col("n_negative")
    counted = counted.where((both >= least) & (F.length("word") > 1)).withColumn("t", total)
    share = prior * both / (F.col("t.p") + F.col("t.n"))
    odds = F.log((F.col("n_positive") + share) / (F.col("t.p") + prior)) - F.log((F.col("n_negative") + share) / (F.col("t.n") + prior))
    valence = F.greatest(F.lit(-STRONGEST), F.least(F.lit(STRONGEST), SCALE * odds))
    return counted.select("word", valence.alias("valence"), "n_positive", "n_negative")


def learned_lexicon(valences: DataFrame, weakest: float = 0.5, most: int = 20_000, base: Lexicon = DEFAULT_LEXICON) -> Lexicon:
    """A lexicon of the ``most`` strongest fitted words: a dictionary that every Python worker holds, hence the bound."""
    strong = valences.where(F.abs("valence") >= weakest).orderBy(F.abs("valence").desc(), "word").limit(most)
    rows = [(r["word"], r["valence"]) for r in strong.select("word", "valence").collect()]
    return replace(base, valence=dict(rows))
