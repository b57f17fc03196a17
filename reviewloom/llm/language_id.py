"""Language identification in two steps: the family first, then one-versus-one linear support vector machines within it.

Features are the letter n-grams of a text's words (a word is a run of letters between two spaces, so n-grams know where
it starts and ends), hashed to ``DIMENSIONS`` places. A score is the mean weight of all n-grams of the text: one gather and one
sum, whatever the length of the text, which is read in pieces. Family machines are one against the rest; between two languages
of a family their own machine decides, and the language with the most votes wins.

The machines are fitted on at most ``SAMPLE`` documents of each language (the documented bound), chosen by a hash of the id;
everything else covers all rows. Prediction is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import map_arrow, slices
from .words import GOLDEN, mix

#: Documents of each language that the machines are fitted on, at most.
SAMPLE = 500
DIMENSIONS, LONGEST = 1 << 14, 4
#: Texts are turned into n-grams by as many bytes at a time.
PIECE = 1 << 20
UNKNOWN = "und"
#: Families of close languages by their codes (fixed values). A language that is not here is compared with others like it.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi", "fo"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la", "ast", "co", "sc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"), "celtic": ("ga", "gd", "cy", "br"), "hellenic": ("el",), "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "ky", "uz", "tk", "tt"), "semitic": ("ar", "he", "mt", "am"), "iranian": ("fa", "ps", "ku", "tg"),
    "indic": ("hi", "bn", "ur", "mr", "gu", "pa", "ne", "si", "or", "as"), "dravidian": ("ta", "te", "kn", "ml"),
    "sinitic": ("zh", "yue", "wuu"), "japonic": ("ja",), "koreanic": ("ko",), "malayic": ("id", "ms", "jv", "su", "tl"),
    "tai": ("th", "lo"), "vietic": ("vi",), "basque": ("eu",),
}
_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_SHIFT = np.uint64(64 - DIMENSIONS.bit_length() + 1)


def family_of(lang: str) -> str:
    """The family of a language code, by its first part: ``pt-BR`` counts as ``pt``."""
    return _OF.get(lang.lower().replace("_", "-").split("-")[0], "other")


def words_only(text_column: str = "text") -> Column:
    """The text as lower-case words of letters and marks between single spaces, one at both ends; null stays null."""
    return F.concat(F.lit(" "), F.lower(F.regexp_replace(text_column, r"[^\p{L}\p{M}]+", " ")), F.lit(" "))


def places(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, place) of all n-grams of 1 to ``LONGEST`` bytes in which a space is the first or the last byte at most."""
    space = data == 0x20
    values = _BYTES[data]
    grams, fine = np.zeros(len(data), np.uint64), np.ones(len(data), dtype=bool)
    for n in range(min(LONGEST, len(data))):
        size = len(data) - n
        grams = grams[:size] * GOLDEN + values[n:]
        if n == 0:
            at = np.flatnonzero(~space)
        else:
            # Of two bytes one is no space; of more, none between the ends is.
            fine = fine[:size] & (~space[n - 1 : -1] if n > 1 else ~(space[:-1] & space[1:]))
            at = np.flatnonzero(fine)
        yield at, ((grams[at] * GOLDEN) >> _SHIFT).astype(np.int64)


def _pieces(low: int, high: int) -> Iterator[tuple[int, int]]:
    """Stretches of a text that overlap by less than the longest n-gram: n-grams that start in the first part are all inside."""
    for start in range(low, high, PIECE):
        yield start, min(start + PIECE + LONGEST - 1, high)


@dataclass(frozen=True)
class Model:
    """Machines as weights per place and a bias: of each family against the rest, and of each two languages of a family."""

    families: tuple[str, ...] = ()
    languages: dict[str, tuple[str, ...]] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMENSIONS)))
    biases: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def pairs(self) -> list[tuple[str, str, str]]:
        """(family, one language, the other) of the machines that follow those of the families."""
        return [(f, a, b) for f in self.families for a, b in combinations(self.languages[f], 2)]

    def margins(self, texts: pa.Array) -> np.ndarray:
        """A margin per text and machine; positive for the family, or the first language."""
        texts = texts.cast(pa.large_string())
        _, offsets, buffer = texts.buffers()
        edges = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(buffer, np.uint8)[edges[0] : edges[-1]] if buffer is not None else np.zeros(0, np.uint8)
        total, count = np.zeros((len(self.biases), len(texts))), np.zeros(len(texts))
        # Texts begin and end with a space, so no n-gram reaches into the next one. A long text comes alone, and in pieces.
        row = np.repeat(np.arange(len(texts)), np.diff(edges)) if len(texts) > 1 else np.zeros(1, np.int64)
        for low, high in _pieces(0, len(data)) if len(texts) == 1 else [(0, len(data))]:
            for at, place in places(data[low:high]):
                if len(texts) == 1:
                    place = place[at < PIECE]
                    of = np.zeros(len(place), np.int64)
                else:
                    of = row[at]
                count += np.bincount(of, minlength=len(texts))
                for m, weights in enumerate(self.weights):
                    total[m] += np.bincount(of, weights[place], len(texts))
        # Sums of a long text may differ in their last digits by the way it was cut.
        return np.round(total / np.maximum(count, 1) + self.biases[:, None], 9).T

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language of each text and the chance of it that the margins on the way give, as logistic functions."""
        if not self.families:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        margins = self.margins(texts)
        sure = 1 / (1 + np.exp(-np.clip(2 * margins, -500, 500)))
        k = len(self.families)
        chosen = margins[:, :k].argmax(axis=1)
        score = sure[:, :k].max(axis=1)
        names = np.empty(len(texts), object)
        pairs = self.pairs()
        for f, family in enumerate(self.families):
            rows, langs = np.flatnonzero(chosen == f), self.languages[family]
            votes, lead = np.zeros((len(rows), len(langs))), np.zeros((len(rows), len(langs)))
            least = np.ones((len(rows), len(langs)))
            for m, (of, a, b) in enumerate(pairs, start=k):
                if of != family:
                    continue
                i, j = langs.index(a), langs.index(b)
                first = margins[rows, m] >= 0
                votes[:, i] += first
                votes[:, j] += ~first
                lead[:, i] += margins[rows, m]
                lead[:, j] -= margins[rows, m]
                least[:, i] = np.minimum(least[:, i], sure[rows, m])
                least[:, j] = np.minimum(least[:, j], 1 - sure[rows, m])
            # Among equal votes the summed margins decide, then the order of the names.
            best = (votes + np.tanh(lead) / 4).argmax(axis=1)
            names[rows] = np.array(langs, object)[best]
            score[rows] *= least[np.arange(len(rows)), best]
        return names.tolist(), np.round(score, 6)


def machine(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """A linear support vector machine by dual coordinate descent (squared hinge); both classes weigh alike in sum.

    ``rows`` are (places, values), ``y`` is 1 or -1. Rows are visited in an order of a fixed seed, so equal input gives equal
    weights. With one class only, the machine always answers that class.
    """
    weights, bias = np.zeros(DIMENSIONS), 0.0
    if not (y > 0).any() or not (y < 0).any():
        return weights, float(np.sign(y.sum()))
    of_class = np.where(y > 0, (y > 0).sum(), (y < 0).sum())
    slack = of_class / (cost * len(y))
    curve = np.array([v @ v for _, v in rows]) + 1 + slack
    alpha = np.zeros(len(y))
    draw = np.random.default_rng(1)
    for _ in range(rounds):
        moved = 0.0
        for i in draw.permutation(len(y)):
            place, value = rows[i]
            slope = y[i] * (value @ weights[place] + bias) - 1 + slack[i] * alpha[i]
            new = max(alpha[i] - slope / curve[i], 0.0)
            if step := new - alpha[i]:
                alpha[i] = new
                weights[place] += step * y[i] * value
                bias += step * y[i]
                moved = max(moved, abs(step) * curve[i])
        if moved < 0.01:
            break
    return weights, bias


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """A model from (language, places, counts) of sample documents; rows without n-grams say nothing."""
    rows = [(lang, place, count / count.sum()) for lang, place, count in rows if len(place)]
    langs = sorted({lang for lang, _, _ in rows})
    if not langs:
        return Model()
    usual = np.zeros(DIMENSIONS)
    for _, place, value in rows:
        usual[place] += value
    # Frequent n-grams would outweigh all others: every place is scaled by its usual size, and the weights take the scale back.
    scale = 1 / np.sqrt(usual / len(rows) + 1e-6)
    x = [(place, value * scale[place]) for _, place, value in rows]
    of = np.array([lang for lang, _, _ in rows], object)
    kin = np.array([family_of(lang) for lang in of], object)
    families = tuple(sorted(set(kin)))
    languages = {f: tuple(lang for lang in langs if family_of(lang) == f) for f in families}
    made = [machine(x, np.where(kin == f, 1.0, -1.0)) for f in families]
    for _, a, b in Model(families, languages).pairs():
        mine = np.flatnonzero((of == a) | (of == b))
        made.append(machine([x[i] for i in mine], np.where(of[mine] == a, 1.0, -1.0)))
    return Model(families, languages, np.stack([w * scale for w, _ in made]), np.array([b for _, b in made]))


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that nothing is learned from: crc32 of the id as text, modulo 3, is 1. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sample_features(docs: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id") -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, places, counts) of at most ``sample`` documents of each language that may be learned from.

    They are chosen by a hash of their id. Only ids are ranked, and the best of each task leave it; the texts of those chosen are read in
    a second pass. A repeated id of a language counts once, with the smallest of its texts.
    """
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col(id_column).isNotNull() & ~held_out(id_column))
    usable = usable.select("lang", "text", F.col(id_column).alias("id"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id", F.lit(7)), "id")
    ids = usable.select("lang", "id").distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample)
    met = usable.join(ids.select("lang", "id"), ["lang", "id"]).groupBy("lang", "id").agg(F.min("text").alias("text"))

    def counted(batches):
        for batch in slices(batches, 1):
            found = []
            for text in batch.column(1):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                count = np.zeros(DIMENSIONS, np.int64)
                for low, high in _pieces(0, len(data)):
                    for at, place in places(data[low:high]):
                        count += np.bincount(place[at < PIECE], minlength=DIMENSIONS)
                at = np.flatnonzero(count)
                found.append((at.astype(np.int32), count[at]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p for p, _ in found], pa.list_(pa.int32())), pa.array([c for _, c in found], pa.list_(pa.int64()))],
                names=["lang", "places", "counts"])

    table = map_arrow(met.select("lang", words_only().alias("words")), counted, "lang string, places array<int>, counts array<long>").toArrow()
    columns = [[x.as_py() if i == 0 else x.values.to_numpy() for x in table.column(i)] for i in range(3)]
    # In one order, however the rows were dealt out.
    return sorted(zip(*columns, strict=True), key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``, from its text alone; ``und`` and 0 without a letter."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, 1, PIECE):
            names, scores = model.predict(batch.column(1))
            bare = batch.column(2).to_numpy(zero_copy_only=False)
            names = [UNKNOWN if b else n for n, b in zip(names, bare, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(np.where(bare, 0.0, scores))],
                names=["id", "lang_pred", "score"])

    bare = ~F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(words_only(), F.lit(" ")).alias("words"), bare.alias("bare"))
    return map_arrow(rows, run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_column)


def identify(docs: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    Learns from rows that are not held out and have text, lang and id. A null text, or one without a letter, is ``und`` with score 0, and so is every text where nothing can be learned. Rows with null or repeated
    ids stay rows of their own; equal texts get equal answers. Other columns are not read; an empty table gives an empty result.
    """
    model = fit(sample_features(docs, sample, id_column))
    return predict(docs, model, id_column).select(id_column, held_out(id_column).alias("held_out"), "lang_pred", "score")
