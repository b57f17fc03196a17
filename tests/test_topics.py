"""Learned topics against a plain version, and how well they find what seeds alone don't."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from reviewloom.operators import classify, topics

SEEDS = {"quality": ("great", "love"), "defect": ("broken", "leak"), "delivery": ("late", "package")}
THEMES = {
    "quality": "great love soft shiny sturdy colour comfortable smell".split(),
    "defect": "broken leak crack screw handle melted battery smoke".split(),
    "delivery": "late package courier box doorstep tracking van street".split(),
}
FILLER = "the it a was and of to in this my".split()


def texts(seed, count):
    """Texts of a theme; only some hold one of its seed words."""
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        topic = draw.choice(list(THEMES))
        words = [draw.choice(THEMES[topic][2:]) for _ in range(6)] + [draw.choice(FILLER) for _ in range(8)]
        if draw.random() < 0.3:
            words.append(draw.choice(SEEDS[topic]))
        draw.shuffle(words)
        rows.append((i, " ".join(words).capitalize() + ".", topic))
    return rows


def _brute(rows, seeds, rounds, kappa, least):
    names = list(seeds)
    counts = {i: Counter(re.findall(r"[^\W\d_]+", (t or "").lower())) for i, t in rows}
    counts = {i: c for i, c in counts.items() if c}
    df = Counter(w for c in counts.values() for w in c)
    words = sorted(w for w, n in df.items() if n >= least)
    idf = np.array([np.log(len(counts) / df[w]) for w in words])
    x = {i: np.array([c[w] for w in words]) * idf for i, c in counts.items()}
    x = {i: v / np.linalg.norm(v) if v.any() else v for i, v in x.items()}
    share = {}
    for i, c in counts.items():
        hits = np.array([sum(c[w] for w in seeds[n]) for n in names], float)
        share[i] = hits / hits.sum() if hits.any() else np.full(len(names), 1 / len(names))
    for _ in range(rounds):
        centre = np.array([sum(share[i][t] * x[i] for i in x) for t in range(len(names))])
        centre = centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-300)
        weight = sum(share.values()) / len(share)
        level = {i: kappa * centre @ x[i] + np.log(np.maximum(weight, 1e-300)) for i in x}
        share = {i: np.exp(v - v.max()) / np.exp(v - v.max()).sum() for i, v in level.items()}
    return {i: (names[int(p.argmax())], float(p.max())) for i, p in share.items()}


@pytest.mark.parametrize("rounds", [1, 3])
def test_against_a_plain_version(spark, rounds):
    rows = [(i, t) for i, t, _ in texts(1, 120)] + [(900, "love"), (901, "nothing known here"), (902, ""), (903, None), (904, "123 ?!")]
    df = spark.createDataFrame(rows, "id long, t string").repartition(5)
    learned = topics.learn(df, "id", "t", SEEDS, rounds, kappa=9.0, least=3)
    found = {r["id"]: (r["category_review"], r["confidence_score"]) for r in topics.assign(df, "id", "t", learned, kappa=9.0).collect()}
    want = _brute(rows, SEEDS, rounds, 9.0, 3)
    assert found.keys() == {i for i, _ in rows}
    for i, (topic, confidence) in found.items():
        if i not in want:
            assert (topic, confidence) == (None, 0.0)
            continue
        assert confidence == pytest.approx(want[i][1], abs=1e-9)
        assert topic == want[i][0] or confidence == pytest.approx(1 / 3, abs=1e-6)


def test_rounds_find_topics_of_texts_without_seeds(spark):
    teach, ask = texts(1, 600), texts(2, 300)
    frame = lambda rows: spark.createDataFrame([(i, t) for i, t, _ in rows], "id long, t string")
    truth = {i: topic for i, _, topic in ask}
    right = lambda found: sum(truth[r["id"]] == r["category_review"] for r in found.collect()) / len(truth)
    by_words = right(classify.classify_by_keywords(frame(ask), "t", SEEDS))
    learned = topics.learn(frame(teach), "id", "t", SEEDS, rounds=4)
    assert right(topics.assign(frame(ask), "id", "t", learned)) > 0.97 > 0.7 > by_words


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "id long, t string")
    learned = topics.learn(empty, "id", "t", SEEDS, rounds=2)
    assert topics.assign(empty, "id", "t", learned).collect() == []
    some = spark.createDataFrame([(1, "great"), (None, "great"), (2, None)], "id long, t string")
    assert sorted(r["id"] for r in topics.assign(some, "id", "t", learned).collect()) == [1, 2]


def test_texts_are_counted_where_they_are_read_and_rows_of_one_key_together(spark):
    rows = [(1, "Great love"), (1, "great"), (1, None), (2, "late, late ünd"), (3, ""), (None, "great")]
    frame = lambda rows: spark.createDataFrame(rows, "id long, t string")
    found = {(r["key"], r["word"]): r["n"] for r in topics.bags(frame(rows), "id", "t").selectExpr("key", "inline(bag)").collect()}
    assert found == {(1, "great"): 2, (1, "love"): 1, (2, "late"): 2, (2, "ünd"): 1}
    once = topics.bags(frame(rows[2:5]), "id", "t")
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    assert [(r["key"], len(r["bag"])) for r in once.collect()] == [(2, 2)]
    # Repeated keys teach and are told as one text with all their words.
    base = [(i, t) for i, t, _ in texts(3, 60)]
    twice = base + [(i, t.upper()) for i, t in base[:20]]
    joined = [(i, f"{t} {t.upper()}" if i < 20 else t) for i, t in base]
    told = []
    for rows in (twice, joined):
        learned = topics.learn(frame(rows), "id", "t", SEEDS, 2, least=2)
        told.append({r["id"]: (r["category_review"], pytest.approx(r["confidence_score"])) for r in topics.assign(frame(rows), "id", "t", learned).collect()})
    assert told[0] == told[1]
