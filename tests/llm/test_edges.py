"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for each operator and stage."""

import random

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from reviewloom.llm import divergence, fill_middle, language_id, line_dedup, lz_fingerprint, mixing, ngram_join, packing, quality, rendering, tokens, toxicity, warc
from reviewloom.llm.registry import tokenizer_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def _prose(seed, count):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(count))


LONG = _prose(1, 30_000)
SAME = _prose(2, 80)
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "b"), (4, "two words", "en", None), (5, SAME, "en", "a"),
    (6, SAME, "de", "a"), (6, SAME, "de", "a"), (7, LONG, "en", "b"), (8, LONG + " end", "en", "b"), (9, "Größe 漢字\nline of some length\n" + _prose(3, 60), "de", "b"),
    (10, "LINE of some length \nÉlan", "de", "b"), (None, "a text without an id " + _prose(4, 60), "en", "a"), (None, None, None, None),
    (11, "a a a a a a a a", "en", "a"), (12, "<|endoftext|> x\x1cy  z", "en", "a"), (13, SAME.upper(), "en", "b"),
]
#: Names that the operators use inside.
CLASHES = ("n", "hash", "sig", "_row", "_id", "_hash", "_text", "kept", "n_words", "_lines", "range", "pass", "tokens", "length", "digest", "copies", "total")


def frame(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], COLUMNS)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def crowded(docs):
    return docs.select("*", *[F.lit(f"x{c}").alias(c) for c in CLASHES])


OPERATORS = {
    "groups": ngram_join.linked_groups,
    "fingerprints": lz_fingerprint.compare_next,
    "lines": line_dedup.line_report,
    "quality": quality.quality_verdicts,
    "packing": lambda d: packing.pack_documents(d, tokenizer_path()),
    "mixing": mixing.mixture,
    "counts": lambda d: tokens.count_tokens(d, tokenizer_path()),
    "middle": fill_middle.digests,
    "language": language_id.identify,
    "divergence": lambda d: divergence.audit(d, least=2),
    "toxicity": lambda d: toxicity.score(d, toxicity.fit([], __import__("numpy").zeros(0, int))),
}
STAGES = dict(corpus_pipeline.STAGES[:-1])


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_with_more_columns(docs, crowded, name):
    plain = OPERATORS[name](docs)
    assert _rows(OPERATORS[name](crowded)) == _rows(plain)
    if name not in ("packing", "mixing", "divergence"):
        assert plain.count() == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_on_empty_table(docs, name):
    assert OPERATORS[name](docs.where("doc_id < 0")).collect() == []


@pytest.mark.parametrize("name", STAGES)
def test_stage(spark, docs, crowded, name):
    plain, more = STAGES[name](spark, docs, ""), STAGES[name](spark, crowded, "")
    assert plain.columns == docs.columns and more.columns == crowded.columns
    assert _rows(more.select(*docs.columns)) == _rows(plain)
    assert all(r[0] == f"x{c}" for c in CLASHES for r in more.select(c).collect())
    assert STAGES[name](spark, docs.where("doc_id < 0"), "").collect() == []


def test_groups(docs):
    found = {}
    for row in ngram_join.linked_groups(docs).collect():
        found.setdefault(row["doc_id"], (row["n_shingles"], row["component_id"]))
    want = brute.groups({i: t for i, t, *_ in ROWS if i is not None}.items())
    assert {i: f for i, f in found.items() if i is not None} == want
    assert want[13][1] == 5 and want[8][1] == 7 and want[1] == (0, 1)
    assert {tuple(r[1:]) for r in ngram_join.linked_groups(docs).where("doc_id IS NULL").collect()} == {(62, None), (0, None)}


def test_one_of_each_group_stays(docs):
    kept = [r["doc_id"] for r in ngram_join.first_of_groups(docs).collect()]
    assert sorted(k for k in kept if k) == [1, 2, 3, 4, 5, 7, 9, 10, 11, 12] and kept.count(None) == 2


def test_lines(docs):
    found = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in line_dedup.line_report(docs).collect() if r["doc_id"]}
    want = brute.lines(list({i: t for i, t, *_ in ROWS if i is not None}.items()))
    assert found == {i: (n, d, brute.sha256(t)) for i, (n, d, t) in want.items()}
    assert found[10][1] == 1 and found[6][1] == 1 and found[1][:2] == (1, 0)


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_lines_in_any_number_of_batches(docs, batches):
    assert _rows(line_dedup.line_report(docs, batches)) == _rows(line_dedup.line_report(docs))


def test_quality_figures(docs):
    for row in quality.figures(docs).collect():
        assert tuple(row[c] for c in quality.FIGURES) == brute.figures(row["text"])


def test_quality_verdicts(docs):
    for row in quality.quality_verdicts(docs).collect():
        failed = row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"]
        assert row["base_failed"] == failed and not (failed and row["kept"])


def test_fingerprints(docs):
    rows = [r for r in lz_fingerprint.compare_next(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect()]
    texts = {i: t or "" for i, t, *_ in ROWS if i is not None}
    want = brute.edited(texts.items())
    for row in rows:
        own = texts[row["doc_id"]]
        assert row["n_chars"] == len(own) and row["edited_sha256"] == brute.sha256(want[row["doc_id"]])
        assert row["fingerprint"] == lz_fingerprint.as_text(lz_fingerprint.smallest(brute.lz_phrases(own)))
        assert 0 <= row["near_next"] <= 1 and 0 <= row["near_edited"] <= 1
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["near_edited"] == 1.0 and by_id[5]["fingerprint"] == by_id[6]["fingerprint"]


def test_packing(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    found = packing.pack_documents(docs, tokenizer_path(), with_ids=True).collect()
    want = []
    for i, text, *_ in ROWS:
        want += [(i, *p) for p in brute.pieces([*library.encode(text or "", add_special_tokens=False).ids, 0])]
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in found)
    places = {}
    for r in found:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))] and sum(n for _, n in held) <= 2048
    assert len(places) == -(-sum(r["length"] for r in found) // 2048)


def test_sequences_hold_their_pieces(docs):
    placed = packing.pack_documents(docs, tokenizer_path(), with_ids=True).cache()
    for row in packing.sequences(placed).collect():
        parts = sorted((r["offset"], bytes(r["ids"])) for r in placed.where(F.col("sequence_id") == row["sequence_id"]).collect())
        assert bytes(row["ids"]) == b"".join(p for _, p in parts)


def test_counts(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t, *_ in ROWS]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in tokens.count_tokens(docs, tokenizer_path()).collect())


def test_mixing_draws_every_row(docs):
    """With one pass for the largest source at least, nothing is left out; alike rows are drawn together."""
    found = mixing.mixture(docs, mixing.Targets(budget=None, most_passes=2.0, block_tokens=64)).groupBy("doc_id").count().collect()
    drawn = {r["doc_id"]: r["count"] for r in found}
    assert set(drawn) == {i for i, *_ in ROWS} and drawn[6] % 2 == 0


PAGES = [(1, "http://a", "<p>x"), (2, None, "<p>x"), (3, "http://c\r\nX: y", ""), (4, "", None), (None, "u", "<p>x"), (None, "v", "<b>z"), (5, "w", "é" * 70_000), (2, "again", "<p>x"), (6, "q", "\r\n\r\nWARC/1.1")]


def test_warc(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn("first", F.lit(0))
    found = sorted(map(repr, map(tuple, warc.round_trip(pages).collect())))
    payloads = [(p, (h or "").encode()) for p, _, h in PAGES]
    first = {}
    for p, data in sorted(((p, d) for p, d in payloads if p is not None)):
        first.setdefault(data, p)
    import base64
    import hashlib

    want = []
    for p, data in payloads:
        again = p is not None and first[data] < p
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((p, len(data), digest, "revisit" if again else "response", first[data] if again else None))
    assert found == sorted(map(repr, want))
    assert warc.round_trip(pages.where("page_id < 0")).collect() == []


def test_rendering_of_nothing(spark):
    pages = spark.createDataFrame([*PAGES, (7, "", "   "), (8, "", "<" * 2000 + "div>" * 2000)], "page_id long, url string, html string")
    found = rendering.extract_text(pages).collect()
    assert len(found) == len(PAGES) + 2 and all(r["text"] is not None for r in found)
    assert rendering.extract_text(pages.where("page_id < 0")).collect() == []


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["toxic"] for r in toxicity.severity(docs, none).collect()} == {False}
    odd = spark.createDataFrame([(None, 1, 1), (5, 1, None), (5, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r["toxic"] for r in toxicity.severity(docs, odd).collect()} == {True}
