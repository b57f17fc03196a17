"""Severity of toxic language by cumulative-link ordinal regression.

For grades 0 to G the model has one weight per feature, shared by all grades, and G ascending thresholds:
P(grade > k) = sigmoid(score - threshold k). The expected severity of a document is the sum of these. Features are the
different words of a text and their stems (first bytes), by 64-bit hashes; those kept are told apart
by class in the labelled sample, so the model is a short table and words never seen weigh nothing.

The model is fitted on a bounded sample of labelled rows (``SAMPLE`` per class, the documented bound), and
scores every document in one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import map_arrow, slices, whole_text
from .words import Words, words_of

#: Labelled rows of either class that the model is fitted on, at most.
SAMPLE = 4_000
STEM = 5
#: A feature is kept if this many documents of the sample have it and its likelihood ratio (G) against chance is as high.
LEAST_DOCUMENTS, LEAST_RATIO = 4, 20.0


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes with their weights, and the thresholds between grades."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) per row and k."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -500, 500)))

    def scores(self, words: Words) -> np.ndarray:
        """Sum of the weights of each row's different features."""
        rows = len(words.first) - 1
        if not len(self.features) or not len(words.hashes):
            return np.zeros(rows)
        row = np.repeat(np.arange(rows), np.diff(words.first))
        total = np.zeros(rows)
        for hashes in (words.hashes, words.stems):
            at = np.searchsorted(self.features, hashes)
            at[at == len(self.features)] = 0
            hit = self.features[at] == hashes
            pairs = np.unique(row[hit] * len(self.features) + at[hit])
            total += np.bincount(pairs // len(self.features), self.weights[pairs % len(self.features)], rows)
        return total


def _features(words: Words, row: int) -> np.ndarray:
    low, high = words.first[row], words.first[row + 1]
    return np.unique(np.concatenate([words.hashes[low:high], words.stems[low:high]]))


def labelled_features(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and label of at most ``sample`` labelled rows per class, chosen by a hash of the id."""
    chosen = None
    for toxic in (0, 1):
        rows = labels.where((F.col("toxic") == toxic) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_id"), "toxic")
        rows = rows.distinct().orderBy(F.xxhash64("_id", F.lit(5)), "_id").limit(sample)
        chosen = rows if chosen is None else chosen.unionAll(rows)

    def found(batches):
        for batch in slices(batches, 0):
            words = words_of(batch.column(0), stem=STEM)
            values = [_features(words, i) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(values, pa.list_(pa.uint64())).cast(pa.list_(pa.int64()), safe=False)], names=["toxic", "features"])

    # At most two samples of ids: a bounded broadcast.
    met = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    table = map_arrow(met.select("text", F.col("toxic").cast("long")), found, "toxic long, features array<long>").toArrow()
    lists = [np.asarray(x.values).view(np.uint64) for chunk in table.column("features").chunks for x in chunk]
    return lists, table.column("toxic").to_numpy()


def graded(features: list[np.ndarray], toxic: np.ndarray, grades: int = 2) -> np.ndarray:
    """Severity grades of labelled rows: 0 for those not toxic, others 1 to ``grades`` by how many of their features only toxic rows have."""
    values, of_row = np.concatenate([*features, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(features)), [len(f) for f in features])
    unique, at = np.unique(values, return_inverse=True)
    bad = np.bincount(at, toxic[of_row], len(unique))
    only = (bad >= LEAST_DOCUMENTS) & (np.bincount(at, 1 - toxic[of_row], len(unique)) == 0)
    marks = np.bincount(of_row, only[at], len(features))
    if not toxic.any():
        return np.zeros(len(features), np.int64)
    cuts = np.quantile(marks[toxic == 1], np.arange(1, grades) / grades)
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, marks, side="left"), 0)


def _likelihood_ratio(yes: np.ndarray, no: np.ndarray, all_yes: int, all_no: int) -> np.ndarray:
    """G of the two-by-two tables of having a feature and being toxic."""
    total, having = all_yes + all_no, yes + no
    cells = [(yes, having * all_yes), (no, having * all_no), (all_yes - yes, (total - having) * all_yes), (all_no - no, (total - having) * all_no)]
    return 2 * sum(np.where(seen > 0, seen * np.log(np.maximum(seen, 1) * total / np.maximum(chance, 1)), 0) for seen, chance in cells)


def fit(features: list[np.ndarray], grade: np.ndarray, rounds: int = 400, decay: float = 1e-3) -> Model:
    """Maximum likelihood with decay, by full steps of Adam; the order of rows doesn't matter.

    With one grade only there is nothing to learn: no features, and thresholds that give that grade.
    """
    top = int(grade.max()) if len(grade) else 0
    if top == 0 or (grade > 0).all():
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(max(top, 1), -20.0 if top else 20.0))
    values, row = np.concatenate(features), np.repeat(np.arange(len(features)), [len(f) for f in features])
    unique, column = np.unique(values, return_inverse=True)
    positive = grade > 0
    yes, no = np.bincount(column, positive[row], len(unique)), np.bincount(column, ~positive[row], len(unique))
    strength = np.where(yes + no >= LEAST_DOCUMENTS, _likelihood_ratio(yes, no, positive.sum(), (~positive).sum()), 0)
    kept = np.flatnonzero(strength >= LEAST_RATIO)
    place = np.full(len(unique), -1)
    place[kept] = np.arange(len(kept))
    mine = place[column] >= 0
    row, column = row[mine], place[column[mine]]
    # Thresholds as a first value and logarithms of the steps, so that they ascend.
    weights = np.zeros(len(kept))
    bounds = np.array([0.0] + [0.0] * (top - 1))
    exact = [np.zeros(len(weights) + top), np.zeros(len(weights) + top)]
    level = np.arange(top)
    for step in range(1, rounds + 1):
        thresholds = np.cumsum(np.concatenate([bounds[:1], np.exp(bounds[1:])]))
        score = np.bincount(row, weights[column], len(grade))
        above = 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds, -500, 500)))
        upper = np.concatenate([np.ones((len(grade), 1)), above], axis=1)[np.arange(len(grade)), grade]
        lower = np.concatenate([above, np.zeros((len(grade), 1))], axis=1)[np.arange(len(grade)), grade]
        chance = np.maximum(upper - lower, 1e-12)
        slope = above * (1 - above)
        up = np.where((grade[:, None] == level + 1), slope, 0) / chance[:, None]
        down = np.where((grade[:, None] == level), slope, 0) / chance[:, None]
        by_score = -(up - down).sum(axis=1) / len(grade)
        by_threshold = (up - down).sum(axis=0) / len(grade)
        by_weight = np.bincount(column, by_score[row], len(weights)) + decay * weights
        tail = np.cumsum(by_threshold[::-1])[::-1]
        by_bound = np.concatenate([tail[:1], tail[1:] * np.exp(bounds[1:])])
        gradient = np.concatenate([by_weight, by_bound])
        exact[0] = 0.9 * exact[0] + 0.1 * gradient
        exact[1] = 0.999 * exact[1] + 0.001 * gradient**2
        change = 0.1 * (exact[0] / (1 - 0.9**step)) / (np.sqrt(exact[1] / (1 - 0.999**step)) + 1e-8)
        weights -= change[: len(weights)]
        bounds -= change[len(weights) :]
    return Model(unique[kept], weights, np.cumsum(np.concatenate([bounds[:1], np.exp(bounds[1:])])))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, grade, toxic) for every row of ``docs``: expected severity, likeliest grade, and whether grade 1 or more is likelier than not.

    A null or empty text has no features. Rows with null or repeated ids stay rows of their own. An empty table gives an
    empty result. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        model = shared.value
        for batch in slices(batches, 1, 2 << 20):
            above = model.above(model.scores(words_of(batch.column(1), stem=STEM)))
            chance = np.concatenate([np.ones((len(above), 1)), above], axis=1) - np.concatenate([above, np.zeros((len(above), 1))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above.sum(axis=1)), pa.array(chance.argmax(axis=1), pa.int32()), pa.array(above[:, 0] > 0.5)],
                names=["doc_id", "severity", "grade", "toxic"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", whole_text().alias("text"))
    return map_arrow(rows, scored, f"doc_id {kind}, severity double, grade int, toxic boolean")


def severity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``score`` of all ``docs`` by a model fitted on the labelled ones; labels with a null id or label count for nothing."""
    features, toxic = labelled_features(docs, labels, sample)
    return score(docs, fit(features, graded(features, toxic)))
