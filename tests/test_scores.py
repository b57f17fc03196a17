"""Scores, sentiment, topics and distributions."""

import datetime
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.functions import scalar, scoring, sentiment
from reviewloom.operators import classify, distribution


def one(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_text_length_score(spark):
    found = one(spark, scoring.text_length_score("n"), [(300,), (0,), (700,), (1000,), (200_000,)], "n int")
    assert found == pytest.approx([1.0, 0.324652, 0.135335, 0.002187, 0.0], abs=1e-6)


def test_extreme_rating(spark):
    assert one(spark, scoring.is_extreme_rating("r"), [(1,), (5,), (3,), (None,)], "r int") == [1, 1, 0, 0]


def test_sentiment_of_plain_sentences(spark):
    texts = [
        ("I love this product! It's amazing.",), ("I hate this product. Terrible experience.",), (None,), ("A box.",), ("",),
    ]
    good, bad, missing, neutral, empty = one(spark, sentiment.keyword_score("t"), texts, "t string")
    assert good > 0.6 and bad < 0.4 and missing == 0.0 and neutral == 0.5 and empty == 0.5


def _compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


@pytest.mark.parametrize(
    "text, total",
    [
        ("good", 2.0),
        ("very good", 2.0 + 0.293),
        ("slightly good", 2.0 - 0.293),
        ("very bad", -2.0 - 0.293),
        ("not good", 2.0 * -0.74),
        ("not a good", 2.0 * -0.74),
        ("really the good", 2.0 + 0.293 * 0.95),
        ("really it was good", 2.0 + 0.293 * 0.9),
        ("GOOD stuff", 2.0 + 0.733),
        ("GOOD", 2.0),
        ("VERY good stuff", 2.0 + 0.293 + 0.733),
        ("good but bad", 2.0 * 0.5 - 2.0 * 1.5),
        ("good!!", 2.0 + 2 * 0.292),
        ("good!!!!!!", 2.0 + 4 * 0.292),
        ("good???", 2.0 + 3 * 0.18),
        ("good????", 2.0 + 0.96),
        ("bad!", -2.0 - 0.292),
        ('  ("good"),\n\tnice... ', 4.0),
        ("dont like it", 1.5 * -0.74),
        ("it mustn't be good", 2.0 * -0.74),
        ("wouldn't say good", 2.0 * -0.74),
        ("really a b good", 2.0 + 0.293),
        ("SLIGHTLY good stuff", 2.0 - 0.293 + 0.733),
        ("SLIGHTLY bad stuff", -2.0 + 0.293 - 0.733),
        ("not one two three good", 2.0),
    ],
)
def test_sentiment_rules(spark, text, total):
    assert one(spark, sentiment.compound("t"), [(text,)], "t string")[0] == pytest.approx(_compound(total), abs=1e-4)


def test_lexicon_parameter(spark):
    lexicon = sentiment.lexicon_from_rows([("Plouf", 2.0)])
    assert one(spark, sentiment.compound("t", lexicon), [("plouf good",)], "t string")[0] == _compound(2.0)
    lexicon = sentiment.lexicon_from_rows([("Plouf", 2.0)], raising=["Tres"], negating=["Pas"])
    assert one(spark, sentiment.compound("t", lexicon), [("tres plouf",), ("pas plouf",), ("not plouf",)], "t string") == [
        _compound(2.293), _compound(-1.48), _compound(2.0)]


def test_relevance_stays_in_bounds(spark):
    rows = [(100, 1, 1, 1, "Great product!"), (300, 4, 0, 1, "Bad experience."), (0, 5, 1, 1, None)]
    df = spark.createDataFrame(rows, "text_length int, rating int, has_image int, has_orders int, description string")
    for weights in (scoring.WEIGHTS, scoring.PROTOTYPE_TEST_WEIGHTS):
        assert sum(weights.values()) == pytest.approx(1.0)
        scored = scoring.add_scores(df, weights=weights).collect()
        assert all(0 <= r["relevance_score"] <= 100 for r in scored)
        r = scored[0]
        by_hand = 100 * sum(weights[c] * float(r[c]) for c in weights)
        assert r["relevance_score"] == pytest.approx(by_hand)


def test_status_thresholds(spark):
    rows = [(78.3, 58.8), (78.2, 99.0), (99.0, 58.7), (None, 99.0), (float("nan"), 99.0), (99.0, float("nan"))]
    found = one(spark, scoring.relevant_status(), rows, "confidence_score double, relevance_score double")
    assert found == ["RELEVANT"] + ["IRRELEVANT"] * 5


def test_anonymise(spark):
    rows = [("B1",), (None,)]
    salted = "0885ccd1969a4b52b7c097b24be3fb74467e25cdabad9203f5441b63d293b318"
    assert one(spark, scalar.anonymise("b"), rows, "b string") == [salted, None]
    as_text = one(spark, scalar.anonymise("b", null_as_text=True), rows, "b string")
    assert as_text[0] == salted and as_text[1] is not None


def test_small_expressions(spark):
    lists = one(spark, scalar.image_list("t"), [("a, b ,,c",), ("x",), ("",), (None,)], "t string")
    assert lists == [["a", "b", "c"], ["x"], [], []]
    assert one(spark, scalar.stars("n"), [(3,)], "n int") == ["⭐⭐⭐"]
    assert one(spark, scalar.product_label(), [("x", None)], "product_name string, category string") == ["x (N/A)"]
    assert one(spark, scalar.null_spellings("t"), [("NULL",), ("null",), ("",), ("NA",)], "t string") == [None, None, None, "NA"]
    assert one(spark, scalar.number_or_zero("t"), [("1.5",), ("x",), (None,)], "t string") == [1.5, 0.0, 0.0]
    assert one(spark, scalar.estimated_delivery("d"), [(datetime.date(2024, 1, 28),)], "d date") == [datetime.date(2024, 2, 4)]
    assert one(spark, scalar.contains_ignoring_case("t", "ABC"), [("xabcx",), ("ab",)], "t string") == [True, False]


def test_keyword_topics(spark):
    rows = [("Arrived late, package damaged",), ("   ",), (None,), ("nothing to see",)]
    df = classify.classify_by_keywords(spark.createDataFrame(rows, "description string"))
    found = [(r["category_review"], r["confidence_score"]) for r in df.collect()]
    assert found[0] == (classify.TOPICS[2], pytest.approx(0.75))
    assert found[1:3] == [(None, 0.0)] * 2 and found[3] == (classify.TOPICS[0], 0.25)


def test_model_sees_only_texts_that_are_not_blank(spark):
    def load():
        def score(texts, topics):
            assert all(t.strip() for t in texts)
            return [(topics[1], 0.9) for _ in texts]

        return score

    df = spark.createDataFrame([("broken",), (" ",), (None,)], "description string")
    found = [(r["category_review"], r["confidence_score"]) for r in classify.classify_with_model(df, load).collect()]
    assert found == [(classify.TOPICS[1], 0.9), (None, 0.0), (None, 0.0)]
    scaled = classify.scale_confidence(spark.createDataFrame([(0.783,)], "confidence_score double"))
    assert scaled.first()[0] == pytest.approx(78.3)


RNG = random.Random(1)
VALUES = {
    "uniform": [RNG.uniform(0, 100) for _ in range(500)],
    "ties": [float(RNG.choice([1, 1, 1, 2, 50])) for _ in range(300)],
    "heavy": [1e9, 1e-9, 5.0] + [RNG.expovariate(1.0) ** 6 for _ in range(400)],
    "constant": [4.0] * 30,
    "single": [7.5],
    "outlier": [RNG.random() for _ in range(5000)] + [1e12],
}


@pytest.mark.parametrize("name", VALUES)
def test_exact_quantiles(spark, name):
    values = VALUES[name]
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.55, 0.75, 0.99, 1.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(3)
    found = {r["p"]: r["value"] for r in distribution.exact_quantiles(df, "v", probabilities).collect()}
    assert [found[p] for p in probabilities] == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)


def test_doubles_as_ordered_longs(spark):
    draw = random.Random(2)
    values = [struct.unpack("<d", draw.randbytes(8))[0] for _ in range(3000)]
    values += [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308, float("inf"), float("-inf")]
    values += [x for e in range(-1070, 1023, 7) for x in (2.0**e, math.nextafter(2.0**e, 0), math.nextafter(2.0**e, math.inf))]
    values = [v for v in values if not math.isnan(v)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", distribution.ordered_long(F.col("v")).alias("k"))
    for v, k in df.collect():
        assert abs(k) == struct.unpack("<q", struct.pack("<d", abs(v)))[0] and (k < 0) == (v < 0)
        assert distribution.from_ordered(k) == v


def test_quantiles_of_several_columns(spark):
    draw = random.Random(4)
    a = [draw.gauss(0, 1) * 10 ** draw.randint(-300, 300) for _ in range(700)]
    b = [draw.choice([-1.0, 0.0, 2.5]) for _ in range(700)]
    wanted = {"a": [0.0, 0.3, 0.5, 1.0], "b": [0.1, 0.5], "none": [0.5]}
    df = spark.createDataFrame([(x, y, None) for x, y in zip(a, b, strict=True)], "a double, b double, none double").repartition(3)
    found = distribution.quantile_values(df, wanted)
    for name, values in (("a", a), ("b", b)):
        assert [found[name][p] for p in wanted[name]] == pytest.approx(list(np.quantile(values, wanted[name])), rel=1e-12)
    assert found["none"] == {0.5: None}
    assert distribution.quantile_values(df.where("b > 9"), wanted)["a"] == dict.fromkeys(wanted["a"])


def test_values_that_differ_in_the_last_bits(spark):
    values = [1.0 + i * 2.0**-52 for i in range(2000)] + [1e300] * 5
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert distribution.quantile_values(df, {"v": [0.0, 1.0, 400 / 2004]})["v"] == {0.0: 1.0, 1.0: 1e300, 400 / 2004: values[400]}


@pytest.mark.parametrize("name", ["heavy", "ties", "outlier", "constant"])
def test_density_of_odd_values(spark, name):
    values = np.array(VALUES[name])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(3)
    curve = sorted(distribution.density(df, "v", 50).collect())
    assert [r["place"] for r in curve] == list(range(50))
    if name == "constant":
        assert all(r["density"] is None for r in curve)
        return
    h = np.std(values, ddof=1) * len(values) ** -0.2
    want = [np.mean(np.exp(-(((x - values) / h) ** 2) / 2)) / (h * np.sqrt(2 * np.pi)) for x in [r["x"] for r in curve]]
    assert [r["density"] for r in curve] == pytest.approx(want, rel=1e-9, abs=1e-12 / h)


def test_histogram_and_density(spark):
    values = VALUES["uniform"]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = sorted(distribution.histogram(df, "v", 10).collect())
    counts, edges = np.histogram(values, 10)
    assert [r["n"] for r in rows] == list(counts)
    assert [r["low"] for r in rows] == pytest.approx(list(edges[:-1]))
    curve = sorted(distribution.density(df, "v", 20).collect())
    h = np.std(values, ddof=1) * len(values) ** -0.2
    want = [np.mean(np.exp(-(((x - np.array(values)) / h) ** 2) / 2)) / (h * np.sqrt(2 * np.pi)) for x in [r["x"] for r in curve]]
    assert [r["density"] for r in curve] == pytest.approx(want)


def test_threshold_sweep(spark):
    rng = random.Random(5)
    rows = [(rng.uniform(40, 100), rng.uniform(0, 100)) for _ in range(400)]
    df = spark.createDataFrame(rows, "confidence_score double, relevance_score double")
    c, r = np.array(rows).T
    for row in distribution.threshold_sweep(df).collect():
        _, pc, pr = next(s for s in distribution.STRATEGIES if s[0] == row["strategy"])
        kept = int(((c >= np.quantile(c, pc)) & (r >= np.quantile(r, pr))).sum())
        assert (row["kept"], row["dropped"]) == (kept, 400 - kept)
        assert row["kept_pct"] == pytest.approx(kept / 4)


def test_published_values_of_rules():
    """Texts and compounds published with the method, under its valences for the words they hold."""
    words = {"horrible": -2.5, "good": 1.9, "great": 3.1, "uncompelling": -0.9, "smart": 1.7, "handsome": 2.2, "funny": 1.9}
    lexicon = sentiment.replace(sentiment.DEFAULT_LEXICON, valence=words)
    for text, want in (
        ("At least it isn't a horrible book.", 0.431), ("The book was good.", 0.4404), ("The book was kind of good.", 0.3832),
        ("VADER is smart, handsome, and funny.", 0.8316), ("VADER is smart, handsome, and funny!", 0.8439), ("VADER is very smart, handsome, and funny.", 0.8545),
        ("VADER is not smart, handsome, nor funny.", -0.7424),
        ("The plot was good, but the characters are uncompelling and the dialog is not great.", -0.7042),
    ):
        assert sentiment.score_text(text, lexicon) == want


def test_idioms_and_special_negations():
    lexicon = sentiment.replace(sentiment.DEFAULT_LEXICON, valence={"good": 2.0, "bad": -2.0, "broken": -2.0, "die": -3.0, "heart": 1.0})
    score = lambda total: round(total / (total * total + 15) ** 0.5, 4)
    found = lambda text: sentiment.score_text(text, lexicon)
    # The longest phrase counts once, in place of its words; modifiers before it hold.
    assert found("this cake is to die for") == score(3.0) and found("a broken heart") == score(-2.9) and found("broken phone") == score(-2.0)
    assert found("waiting at the bus stop") == 0.0 and found("it's not to die for") == score(3.0 * -0.74)
    assert found("the kiss of good") == score(2.0) and found("to die of heart") == score(-2.0)
    assert found("kind of good") == score(2.0 - 0.293)
    assert found("the least good") == score(2.0 * -0.74) and found("at least good") == score(2.0) and found("the very least good") == score((2.0 + 0.293 * 0.95))
    assert found("it was never good") == score(2.0 * -0.74) and found("never so good") == score((2.0 + 0.293) * 1.25)
    assert found("never was this good") == score(2.0 * 1.25) and found("without a doubt good") == score(2.0) and found("without it good") == score(2.0 * -0.74)


def test_fitted_valences(spark):
    rows = [("Good good toy", 5)] * 30 + [("bad toy", 1)] * 30 + [("odd good", 2)] * 2 + [("rare toy", 5)] * 4 + [("toy", 3)] * 50 + [(None, 5), ("bad", None), ("", 1)]
    df = spark.createDataFrame(rows, "description string, rating int").repartition(3)
    found = {r["word"]: r for r in sentiment.fitted_valences(df).collect()}
    assert set(found) == {"good", "toy", "bad"} and (found["good"]["n_positive"], found["good"]["n_negative"]) == (30, 2)
    p, n, prior = 34, 33, 10
    want = 2 * math.log(((30 + prior * 32 / (p + n)) / (p + prior)) / ((2 + prior * 32 / (p + n)) / (n + prior)))
    assert found["good"]["valence"] == pytest.approx(want) and found["bad"]["valence"] < -2 and abs(found["toy"]["valence"]) < 0.3
    lexicon = sentiment.learned_lexicon(sentiment.fitted_valences(df))
    assert set(lexicon.valence) == {"good", "bad"} and sentiment.score_text("a good toy", lexicon) > 0 > sentiment.score_text("not good", lexicon)
    assert sentiment.fitted_valences(df.limit(0)).collect() == []
