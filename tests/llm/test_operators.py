"""Parts of the operators against brute force, round trips and held-out accuracy; every query against its SQL."""

import gzip
import io
import random
import tracemalloc
from collections import Counter
from html.parser import HTMLParser
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from compare import compare, connect
from reviewloom.llm import completion, lz_fingerprint, mixing, ngram_join, packing, quality, tokens, toxicity, warc, words
from reviewloom.llm.completion import best_fit, fillings, lower_bound, pack
from reviewloom.llm.components import components
from reviewloom.llm.registry import ORACLE_SQL, QUERIES, documents, tokenizer_path
from reviewloom.llm.rendering import render
from reviewloom.llm.tables import map_arrow

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_reference_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLE_SQL[name]) is None


def test_queries_and_entry():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert [n for n in range(1, 14) if any(q.startswith(f"op{n}_") for q in QUERIES)] == list(range(1, 14))


# --- quality rules -----------------------------------------------------------------


def _figures_of(spark, rows):
    """(lang, source, n_words, word_chars, n_symbols) as rows of figures with their buckets."""
    schema = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long"
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    more = {"n_lines": F.lit(10), "n_dup_lines": F.lit(0), "n_repeat_words": F.lit(0), "base_failed": F.lit(False)}
    return quality.with_buckets(df.withColumns(more))


def test_limits_follow_the_source(spark):
    """Sources of one language whose usual level of symbols and usual words differ; a small one is drawn to the language."""
    draw = random.Random(1)
    level = {"plain": 0.01, "code": 0.2, "few": 0.2}
    rows = []
    for source, n in (("plain", 3000), ("code", 3000), ("few", 20)):
        for _ in range(n):
            share = level[source] * draw.choice([1, 1.1, 1.2, 1.3])
            rows.append(("en", source, 1000, int(1000 * (5 if source == "plain" else 7) * draw.uniform(0.97, 1.03)), int(1000 * share)))
    rows += [("de", None, 1000, 6000, 0)] * 40
    found = _figures_of(spark, rows)
    limits = {(r["lang"], r["source"]): r for r in quality.thresholds(quality.sketches(found)).collect()}
    high = {s: 1.02 ** limits["en", s]["_symbol_share_high"] for s in level}
    assert 0.013 < high["plain"] < 0.1 and 0.26 < high["code"] < 2 and high["plain"] < high["few"]
    words = {s: (1.02 ** limits["en", s]["_word_length_low"], 1.02 ** limits["en", s]["_word_length_high"]) for s in level}
    assert words["plain"][0] < words["code"][0] and words["plain"][1] < words["code"][1] and words["plain"][1] < words["few"][1]
    # No text of the group has a symbol: the limit is that of the wider sketch. No text at all has repeated lines: no limit.
    assert limits["de", None]["_symbol_share_high"] is not None and limits["de", None]["_dup_line_share_high"] is None
    judged = quality._judged(found, quality.thresholds(quality.sketches(found)))
    assert judged.where("NOT kept").count() == 0
    odd = _figures_of(spark, [("en", "plain", 1000, 5000, 200), ("en", "code", 1000, 7000, 200), ("en", "plain", 1000, 12000, 10), ("en", "plain", 1000, 5000, 0)])
    judged = quality._judged(odd, quality.thresholds(quality.sketches(found)))
    assert [r["kept"] for r in judged.orderBy("doc_id").collect()] == [False, True, False, True]


def test_sketches_merge(spark):
    """Limits from sketches of parts, added up, are those of the whole."""
    draw = random.Random(2)
    rows = [(draw.choice(["en", None]), draw.choice("ab"), 100, draw.randint(300, 900), draw.randint(0, 50)) for _ in range(600)]
    whole = quality.sketches(_figures_of(spark, rows))
    parts = quality.sketches(_figures_of(spark, rows[:100])).unionAll(quality.sketches(_figures_of(spark, rows[100:])))
    together = lambda s: sorted(map(repr, quality.thresholds(s).collect()))
    assert together(whole) == together(parts) and len(together(whole)) == 4


# --- n-gram join -------------------------------------------------------------------


def _variants(seed, count, base=60, edits=6):
    """Texts in families of edited copies, sizes and distances around the threshold."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdef") for _ in range(3))
    texts, stems = [], []
    for i in range(count):
        if not stems or draw.random() < 0.2:
            stems.append([word() for _ in range(draw.randint(3, base))])
            texts.append(" ".join(stems[-1]))
            continue
        copy = list(draw.choice(stems))
        for _ in range(draw.randint(0, edits)):
            copy[draw.randrange(len(copy))] = word()
        if draw.random() < 0.3:
            copy += [word() for _ in range(draw.randint(1, 9))]
        texts.append(" ".join(copy))
    return list(enumerate(texts))


@pytest.mark.parametrize("size, percent, block", [(4, 85, 2048), (5, 80, 7)])
def test_groups_of_many_near_copies(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = _variants(size, 260) + _variants(9, 60, base=400, edits=30)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    found = ngram_join.linked_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), size, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute.groups(rows, size, percent)


def _links(rows, size, percent):
    """Every two rows that link, by place."""
    sets = [brute.shingles(t, size) for _, t in rows]
    near = lambda x, y: x and y and 100 * len(x & y) >= percent * len(x | y)
    return {(i, j) for i, j in combinations(range(len(rows)), 2) if near(sets[i], sets[j])}


@pytest.mark.parametrize("size, percent, block, held", [(4, 85, 2048, 1 << 23), (5, 80, 7, 3000), (4, 42, 2048, 1 << 23), (3, 30, 50, 1 << 23)])
def test_every_link_is_found(spark, monkeypatch, size, percent, block, held):
    """Also those inside a group that other links connect, between equal texts, and between rows without ids."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "HELD", held)
    texts = [t for _, t in _variants(size, 200, edits=3) + _variants(9, 60, base=400, edits=30)]
    texts += [texts[0], texts[0], texts[7], "", "", None]
    stem = [f"w{i}" for i in range(300)]
    texts += [" ".join([*stem[:i], "x", *stem[i:]]) for i in range(0, 300, 7)]
    rows = list(enumerate(texts))
    want = _links(rows, size, percent)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    members, pairs = ngram_join.links(frame, size, percent)
    of, linked = {r["doc_id"]: r["class"] for r in members.collect()}, [tuple(r) for r in pairs.collect()]
    assert len(linked) == len(set(linked)) and all(a < b for a, b in linked)
    linked = set(linked)
    met = lambda c, d: None not in (c, d) and (c == d or (min(c, d), max(c, d)) in linked)
    assert {(i, j) for i, j in combinations(range(len(rows)), 2) if met(of[i], of[j])} == want
    found = ngram_join.link_counts(frame.withColumn("doc_id", F.when(F.col("doc_id") >= 10, F.col("doc_id"))), size, percent)
    degree = Counter(x for pair in want for x in pair)
    assert Counter((r["doc_id"], r["n_links"]) for r in found.collect()) == Counter((i if i >= 10 else None, degree[i]) for i, _ in rows)


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_size_bands_of_large_tiles(spark, monkeypatch, percent):
    """Classes of a large tile that sizes allow meet in one cell each, those of distant bands in none."""
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    sizes = [int(1.09**k) + 1 for k in range(60)] * 2 + [4, 8, 16, 17, 20, 64, 80, 100]
    marked = spark.createDataFrame([(5, i, n, i) for i, n in enumerate(sizes)], "token long, node long, n long, grp long")
    cells = {}
    for r in ngram_join._cells(marked, percent).collect():
        cells.setdefault((r["i"], r["j"]), []).append((r["block"], r["node"], r["n"]))
    met = Counter()
    for rows in cells.values():
        crossed = len({b for b, *_ in rows}) > 1
        met.update((min(x[1], y[1]), max(x[1], y[1])) for x, y in combinations(rows, 2) if not crossed or x[0] != y[0])
    assert {(i, j) for i, j in combinations(range(len(sizes)), 2) if ngram_join.fit(sizes[i], sizes[j], percent)} <= set(met)
    assert max(met.values()) == 1
    far = (100 / percent) ** 2 * 1.01 if percent < 100 else 2.8**2
    assert all(max(sizes[i], sizes[j]) <= far * min(sizes[i], sizes[j]) for i, j in met)


def test_settling_holds_two_shares(spark, monkeypatch):
    """Of a dense neighbourhood and many small ones, no more than two shares of sets come together."""
    monkeypatch.setattr(ngram_join, "HELD", 1000)
    found = spark.range(400).select(F.col("id").alias("node"), F.lit(50).cast("long").alias("n"))
    dense = [(a, b) for a, b in combinations(range(200), 2)]
    dealt = ngram_join._together(spark.createDataFrame(dense + [(a, a + 1) for a in range(200, 400, 2)], "a long, b long"), found)
    rows = dealt.collect()
    assert sorted((r["a"], r["b"]) for r in rows) == sorted(dense + [(a, a + 1) for a in range(200, 400, 2)])
    held = {}
    for r in rows:
        held.setdefault(tuple(r[c] for c in dealt.columns if c not in ("a", "b")), set()).update((r["a"], r["b"]))
    # Shares are dealt by a hash, so that one may be twice as large as meant.
    assert max(len(nodes) * 50 for nodes in held.values()) <= 2 * 2 * 1000


def test_frequent_shingles_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SAMPLED", 1)
    monkeypatch.setattr(ngram_join, "SEEN", 2)
    rows = _variants(3, 150)
    found = ngram_join.linked_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute.groups(rows)


def test_query_groups(spark):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op1_ngram_jaccard"](spark, FOLDER).collect()}
    assert found == brute.groups([(r["doc_id"], r["text"]) for r in documents(spark, FOLDER).collect()])


@given(st.sets(st.integers(0, 300), max_size=200), st.sets(st.integers(0, 300), max_size=200), st.integers(1, 100))
@settings(max_examples=300, deadline=None)
def test_bitmaps_bound_from_below(a, b, percent):
    x, y = (words.mix(np.array(sorted(s), np.uint64)) for s in (a, b))
    if len(x) and len(y):
        assert ngram_join.apart(ngram_join.bitmap(x), ngram_join.bitmap(y)) <= len(a ^ b)
        if 100 * len(a & b) >= percent * len(a | b):
            assert len(a ^ b) <= ngram_join.most_apart(len(a) + len(b), percent)


@given(st.lists(st.text(alphabet="abAB \t\n\x0b\x1cÉé漢\xa0", max_size=25), max_size=6), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_words_and_shingles(texts, size):
    found = words.words_of(pa.array(texts, pa.string()))
    hashes = {}
    for text, row in zip(texts, range(len(texts)), strict=True):
        want = brute.WORD.findall(text.translate(brute.LOWER))
        assert len(found.row(row)) == len(want)
        for word, value in zip(want, found.row(row).tolist(), strict=True):
            assert hashes.setdefault(word, value) == value
    assert len(set(hashes.values())) == len(hashes)
    sets = list(words.shingle_sets(found, size))
    assert [len(s) for s in sets] == [len(brute.shingles(t, size)) for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(35)] + [(k, k + 1) for k in range(100, 140)]
    edges = [e for e in edges if e[0] != e[1]]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(found) == len({r["node"] for r in found}) and {r["node"]: r["component"] for r in found} == brute.components(edges)


# --- fingerprints --------------------------------------------------------------------


@pytest.mark.parametrize("range_bytes, coarse", [(2_000, 1024), (2_000, 3), (20_000, 1), (1 << 30, 1024)])
def test_query_fingerprints(spark, range_bytes, coarse):
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark, FOLDER).collect()}
    order = sorted(texts, reverse=True)
    following = dict(zip(order, [*order[1:], order[0]], strict=True))
    edited = brute.edited(texts.items())
    marks = {i: lz_fingerprint.smallest(brute.lz_phrases(t)) for i, t in texts.items()}
    for row in lz_fingerprint.compare_next(documents(spark, FOLDER), range_bytes=range_bytes, coarse=coarse).collect():
        i = row["doc_id"]
        changed = lz_fingerprint.smallest(brute.lz_phrases(edited[i]))
        assert row["edited_sha256"] == brute.sha256(edited[i]) and row["n_chars"] == len(texts[i])
        assert (row["fingerprint"], row["edited_fingerprint"]) == (lz_fingerprint.as_text(marks[i]), lz_fingerprint.as_text(changed))
        assert row["near_edited"] == lz_fingerprint.likeness(marks[i], changed) > row["near_next"] == lz_fingerprint.likeness(marks[i], marks[following[i]])


def test_likeness_is_exact_for_small_sets():
    a, b = ({b"x%d" % i for i in r} for r in (range(40), range(20, 60)))
    assert lz_fingerprint.likeness(*map(lz_fingerprint.smallest, (a, b))) == 20 / 60


# --- tokens and packing ----------------------------------------------------------------


@given(st.lists(st.text(alphabet=st.sampled_from("ab Z's\n\t\r\x0b\x1c\x85\xa0 é1²!<|>你👍​"), max_size=30) | st.sampled_from(["<|endoftext|>", "  <|endoftext|>", " don't", "\n\n\n"]), max_size=6).map("".join))
@settings(max_examples=1500, deadline=None)
def test_ids_are_those_of_the_library(text):
    from tokenizers import Tokenizer

    library = _LIBRARY.setdefault("t", None) or _LIBRARY.update(t=Tokenizer.from_file(tokenizer_path())) or _LIBRARY["t"]
    found = tokens.encoder(tokenizer_path())
    assert found.fast is not None
    assert np.concatenate(found.encode(text)).tolist() == library.encode(text, add_special_tokens=False).ids


_LIBRARY: dict = {}


def test_long_texts_are_cut_without_effect(spark):
    from tokenizers import Tokenizer

    text = " ".join(r["text"] for r in documents(spark, FOLDER).collect())[:400_000]
    parts = tokens.encoder(tokenizer_path()).encode(text)
    assert len(parts) > 4
    assert np.concatenate(parts).tolist() == Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids


def test_long_texts_of_the_library_are_cut_too(monkeypatch):
    """Characters of unsettled classes and special strings: split all the same, in one batch, with the ids of the whole texts."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "LONG", 40)
    draw = random.Random(3)
    words = ["λόγος", "<|endoftext|>", "👍🏽", "हिन्दी", "don't", "  ", "\u3000", "\u0301", "x²", "!", "\n", "Σ", "a\u0301b", "\u200b", "١٢٣", "\x85", "\u2028", "ab", "\ufeff"]
    texts = [" ".join(draw.choice(words) for _ in range(300)) for _ in range(40)] + ["", "λ", "plain words " * 30]
    library = Tokenizer.from_file(tokenizer_path())
    found = list(tokens.encoder(tokenizer_path()).encode_all(texts))
    assert sum(len(parts) > 4 for parts in found) >= 40
    for text, parts in zip(texts, found, strict=True):
        assert [i for p in parts for i in p] == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(spark, name):
    path = tokenizer_path(name)
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        count = lambda t: len(library.encode(t))
    else:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    docs = documents(spark, FOLDER).limit(40).cache()
    want = {r["doc_id"]: count(r["text"]) for r in docs.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(docs, path).collect()} == want


def _used(plan, capacity):
    used = Counter()
    for times, content in plan:
        assert times > 0 and sum(content) <= capacity
        for n in content:
            used[n] += times
    return used


@given(st.lists(st.integers(1, 20), max_size=14))
@settings(max_examples=150, deadline=None)
def test_packing_is_optimal_on_small_cases(items):
    counts = dict(Counter(items))
    plan = pack(counts, 20)
    assert _used(plan, 20) == Counter(items) == _used(best_fit(counts, 20), 20)
    number = sum(t for t, _ in plan)
    assert lower_bound(counts, 20) <= number

    def fits(left, bins):
        if not left:
            return True
        tried = set()
        for k, room in enumerate(bins):
            if room >= left[0] and room not in tried:
                tried.add(room)
                if fits(left[1:], [*bins[:k], room - left[0], *bins[k + 1 :]]):
                    return True
        return False

    if number:
        assert not fits(sorted(items, reverse=True), [20] * (number - 1))


def _undominated(items, capacity):
    """All fillings around the largest item that no item left over improves, by trying every subset."""
    (first, *rest), found = sorted(items, reverse=True), set()
    for size in range(len(rest) + 1):
        for chosen in set(combinations(rest, size)):
            room, left = capacity - first - sum(chosen), Counter(rest) - Counter(chosen)
            sums = {(0, 0), *((n, 1) for n in chosen), *((x + y, 0) for x, y in combinations(chosen, 2))}
            if room >= 0 and not any(n + one <= m <= n + room for n, one in sums for m in left):
                found.add((room, (first, *chosen)))
    return found


@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
@settings(max_examples=150, deadline=None)
def test_all_undominated_fillings_are_listed(items):
    listed = [f for f in fillings(sorted(set(items)), Counter(items), 20) if f[1]]
    assert len(listed) == len(set(listed)) and set(listed) == _undominated(items, 20)
    assert [w for w, _ in listed] == sorted(w for w, _ in listed)


def test_fillings_after_one_without_waste():
    listed = [f for _, f in fillings([4, 5, 6, 7, 9], Counter([9, 7, 6, 5, 4]), 20) if f]
    assert (9, 7, 4) in listed and (9, 6, 5) in listed


def test_packing_that_needs_other_fillings():
    counts = {13: 2, 23: 1, 24: 2, 12: 5, 4: 2, 2: 1, 14: 1, 10: 1, 7: 1}
    plan = pack(counts, 40)
    assert _used(plan, 40) == Counter(counts) and sum(t for t, _ in plan) == lower_bound(counts, 40) == 5


def test_packing_of_many_pieces():
    draw = random.Random(4)
    counts = Counter(min(2048, int(draw.lognormvariate(5.8, 1.1)) + 1) for _ in range(200_000))
    plan = pack(counts, 2048)
    assert _used(plan, 2048) == counts
    assert sum(t for t, _ in plan) == lower_bound(counts, 2048)


def test_memory_of_the_search_does_not_grow_with_its_depth(monkeypatch):
    draw = random.Random(1)
    counts = Counter(draw.randint(333, 1000) for _ in range(5000))
    plans, peaks = [], []
    for most in (completion.OPEN, 10**9):
        monkeypatch.setattr(completion, "OPEN", most)
        tracemalloc.start()
        plans.append(pack(counts, 2048, 3000))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert plans[0] == plans[1] and _used(plans[0], 2048) == counts
    assert peaks[0] < 20_000_000 < peaks[1]


def test_pieces_of_a_hot_length_are_numbered_in_shares(spark):
    pieces = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40 + 1).cast("long").alias("length"), F.lit(1).cast("long").alias("ids_crc32"))
    found = packing.numbered(pieces, share_rows=100).groupBy("length").agg(F.array_sort(F.collect_list("_rank")).alias("r")).collect()
    assert all(r["r"] == list(range(len(r["r"]))) for r in found)


# --- mixing ------------------------------------------------------------------------------


@pytest.mark.parametrize("targets", [
    mixing.Targets(block_tokens=500), mixing.Targets(budget=None, most_passes=2.0, block_tokens=300), mixing.Targets(entropy=1.0, most_passes=3.0, budget=0.5, block_tokens=200), mixing.Targets(entropy=0.0, budget=2.5, block_tokens=1000)])
def test_mixing(spark, monkeypatch, targets):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 16)
    draw = random.Random(8)
    rows = [(i, " ".join(["w"] * draw.randint(1, 30) + [str(i)]), "abcd"[min(3, int(draw.expovariate(1.2)))]) for i in range(600)]
    rows += [(1000 + i, f"null {i}", None) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    size = {i: len(t.split()) for i, t, _ in rows}
    totals = Counter()
    for i, _, s in rows:
        totals[s] += size[i]
    x, weight = brute.exponent(totals, targets)
    assert mixing.exponent(mixing._totals(mixing.units(docs)), targets) == pytest.approx(x, abs=1e-6)
    found = mixing.mixture(docs, targets).collect()
    budget = max(totals[s] / weight[s] for s in totals) if targets.budget is None else targets.budget * sum(totals.values())
    drawn = Counter()
    for r in found:
        drawn[r["source"]] += r["n_tokens"]
    for s in totals:
        passes = weight[s] * budget / totals[s]
        assert passes <= max(targets.most_passes, targets.budget or 0) + 1e-6
        assert weight[s] * budget - 31 <= drawn[s] <= weight[s] * budget + 1
        mine = [r for r in found if r["source"] == s]
        times = Counter(r["doc_id"] for r in mine)
        of_source = [i for i, _, t in rows if t == s]
        assert all(int(passes + 1e-9) <= times[i] <= int(passes + 1e-9) + 1 for i in of_source)
        # Every block but the last has its share of the source, up to one document.
        per_block = Counter()
        for r in mine:
            per_block[r["block"]] += r["n_tokens"]
        for b in range(max(per_block)):
            assert abs(per_block[b] - weight[s] * targets.block_tokens) <= 62
    rows_of = Counter(r["doc_id"] for r in found)
    assert Counter(r["doc_id"] for r in mixing.mixed_documents(docs, targets).collect()) == rows_of


# --- WARC ------------------------------------------------------------------------------------


def test_normaliser_on_any_gzip(spark, tmp_path):
    records = [warc.record("response", str(i), f"http://h/{i}", b"x" * (i * 3000), warc.base32_sha1("00" * 20), None) for i in range(20)]
    plain = b"".join(records)
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(plain))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(plain[i : i + 777]) for i in range(0, len(plain), 777)))
    manifest = spark.createDataFrame([(str(tmp_path / n),) for n in ("a.warc.gz", "b.warc.gz")], "archive string")
    for row in warc.normalise(manifest, str(tmp_path / "out")).collect():
        import json
        import zlib

        data = open(row["archive"], "rb").read()
        index = [json.loads(x) for x in open(row["sidecar"])]
        assert row["records"] == len(index) == 20 and gzip.decompress(data) == plain
        assert [zlib.decompress(data[x["offset"] : x["offset"] + x["length"]], 31) for x in index] == records


def test_archive_that_breaks_off():
    data = gzip.compress(warc.record("response", "1", None, b"abc", warc.base32_sha1("00" * 20), None)[:-5])
    with pytest.raises(ValueError):
        list(warc.split_records(warc.inflate(io.BytesIO(data), 7)))


# --- rendering ------------------------------------------------------------------------------


@pytest.mark.parametrize("html, text", [
    ("<p>One<p>Two <b>bold</b>\n text<br>next", "One\n\nTwo bold text\nnext"),
    ("<style>.x{display:none}</style>a<div class='x y'>gone</div><div style='visibility:hidden'>no<i style='visibility:visible'>yes</i></div>", "a\nyes"),
    ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>", "- a\n- b\n  3. x\n  4. y\n- c"),
    ("<ol reversed><li>a<li value=7>b<li>c</ol>", "3. a\n7. b\n6. c"),
    ("<table><tr><th>Name<th align=right>No<tr><td>long name<td align=right>1</table>", "Name       No\nlong name   1"),
    ("<table><tr><td rowspan=2>r<td>2<tr><td>漢字</table>", "r  2\n   漢字"),
    ("<table><tr><td>a<td>b<tr><td colspan=2>across both<tr><td>c<td>d</table>", "a  b\nacross both\nc  d"),
    ("<table>stray<tr><td><table><tr><td>in<td>ner</table><td>x</table>", "stray\n\nin  ner  x"),
    ("<pre>\n a  b\n\n  c</pre>", " a  b\n\n  c"),
    ("<script>var t='</p>';</script>x<!-- <p>no</p> -->y<noscript>z</noscript><template>t</template>", "xy"),
    ("<details><summary>S</summary>hid</details><dialog>d</dialog><p hidden>h</p>e", "S\ne"),
    ("a < b &amp; c &lt;d&gt; 1<2", "a < b & c <d> 1<2"),
    ("<dl><dt>t<dd>d</dl>", "t\n  d"),
    ("<a href=\"x>y\" title='<b>'>link</a></p>after", "link\n\nafter"),
    ("<select><option>a<option>b</select><input value=v><input type=hidden value=h>", "a\nb\nv"),
])
def test_rendering(html, text):
    assert render(html) == text


@pytest.mark.parametrize("html, text", [
    ("<style>@media print{nav,.side{display:none}} @media (max-width:600px){ .main{display:none} }</style><nav>n</nav><div class=side>s</div><div class=main>m</div>", "n\ns\nm"),
    ("<style>@media print{.a{color:red}.b{display:none}}.c{display:none}</style><p class=b>b<p class=c>c", "b"),
    ("<style>@media Screen{.a{display:none}}@media not print,(width<9px){.b{display:none}}@layer x{@media all{.c{display:none}}}</style><p class=a>a<p class=b>b<p class=c>c<p>d", "d"),
    ("<style>@media screen{@media print{.a{display:none}}}@supports (x:y){.b{display:none}}</style><p class=a>a<p class=b>b", "a\n\nb"),
    ("<style>@import 'x{';@media print{.q::after{content:'}'} .a{display:none}}/*}*/.b{display:none}</style><p class=a>a<p class=b>b", "a"),
    ("<style>.a{color:red;.b{display:none};display:none}</style><p class=a>a<p class=b>b", "b"),
    ("<style media=print>p{display:none}</style><style media='screen, print'>.b{display:none}</style><p>a<p class=b>b", "a"),
    ("a<svg><title>t</title><style/><path d='M0'/><clipPath/><defs><text>no</text></defs>no<g><text x=1>one <tspan>two</tspan></text><text>three<tspan x=0 dy=1em>four</tspan></text></g></svg>b", "a one two three four b"),
    ("<svg><text display=none>no</text><text visibility=hidden>no</text><foreignObject><div>div</div></foreignObject></svg>", "div"),
    ("<svg><path><p>after</p>", "after"),
    ("so <math><semantics><mrow><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow><annotation>x=1/2</annotation></semantics></math> holds", "so x= 1 2 holds"),
])
def test_text_in_conditions_drawings_and_formulas(html, text):
    assert render(html) == text


@given(st.lists(st.sampled_from(["<p>", "</p>", "<table>", "<tr>", "<td colspan=2>", "</table>", "<li>", "<ul>", "</ul>", "<div>", "</div>", "<b>", "</i>", "<th>", "<caption>", "<tbody>", "</td>", "<br>", "<pre>", "</pre>", "<h1>", "<dd>", "<option>", "<", "</", "<a b='"]) | st.integers(10, 99).map(lambda n: f"w{n}w"), max_size=30))
@settings(max_examples=400, deadline=None)
def test_no_text_is_lost(parts):
    """Whatever the tags, every word outside of tags is emitted once."""
    html = "".join(parts)
    kept = Counter(w for w in __import__("re").findall(r"w\d\dw", "".join(p for p in parts if not p.startswith("<"))))
    if not any(p in ("<", "</", "<a b='") for p in parts):
        assert Counter(__import__("re").findall(r"w\d\dw", render(html))) == kept
    else:
        render(html)


class _Plain(HTMLParser):
    """Words of a page in order, by the standard library's tokenizer; for pages without hidden parts or tables."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.skipped, self.words, self.glued = 0, [], False

    def handle_starttag(self, tag, attrs):
        self.skipped += tag in ("script", "style", "title")
        self.glued = False

    def handle_endtag(self, tag):
        self.skipped -= tag in ("script", "style", "title")
        self.glued = False

    def handle_data(self, data):
        if not self.skipped:
            self.words += data.split()


def test_query_html(spark):
    """Every visible word of every page, in order; list items have markers besides."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    found = {r["page_id"]: r["text"] for r in QUERIES["op5_html_extraction"](spark, FOLDER).collect()}
    assert set(found) == set(pages)
    for page, html in pages.items():
        plain = _Plain()
        plain.feed(html)
        assert [w for w in found[page].split() if w != "-"] == [w for w in plain.words if w != "-"], page


# --- toxicity -------------------------------------------------------------------------------


def test_severity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    features, toxic = toxicity.labelled_features(docs, labels.where("doc_id % 3 <> 0"))
    model = toxicity.fit(features, toxicity.graded(features, toxic))
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    held = toxicity.score(docs, model).join(labels.where("doc_id % 3 = 0").select("doc_id", F.col("toxic").alias("label")), "doc_id").toPandas()
    rank, bad = held.severity.rank(), held.label == 1
    area = (rank[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert area > 0.94 and held[~bad].toxic.mean() < 0.01
    assert ((held.severity >= 0) & (held.severity <= 2)).all() and (held.toxic == (held.severity > 0.5))[held.grade != 1].mean() > 0.95


def test_ordinal_model_finds_the_order():
    draw = np.random.default_rng(3)
    features, grade = [], []
    for _ in range(1500):
        bad = draw.integers(0, 6)
        features.append(np.unique(np.concatenate([draw.integers(1000, 1400, 20), draw.permutation(20)[:bad]]).astype(np.uint64)))
        grade.append(0 if bad < 1 else 1 if bad < 3 else 2)
    model = toxicity.fit(features, np.array(grade))
    score = [model.weights[np.isin(model.features, f)].sum() for f in features]
    expected = model.above(np.array(score)).sum(axis=1)
    means = [expected[np.array(grade) == g].mean() for g in range(3)]
    assert means[0] < 0.5 < means[1] < 1.5 < means[2]


# --- pipeline -------------------------------------------------------------------------------


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "ngram_jaccard", "source_mixing", "best_fit_packing"]
    docs = documents(spark, FOLDER).cache()
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = {r["doc_id"] for r in QUERIES["op4_quality_rules"](spark, FOLDER).where("kept").collect()}
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["quality_rules"](spark, docs, FOLDER).cache()
    assert {r["doc_id"] for r in kept.collect()} == good and kept.schema == docs.schema
    lines = brute.lines([(i, rows[i]["text"]) for i in good])
    lean = stage["line_dedup"](spark, kept, FOLDER).cache()
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in lean.collect()} == {i: (t, len(t)) for i, (_, _, t) in lines.items()}
    groups = brute.groups([(i, t) for i, (_, _, t) in lines.items()], 5, 80)
    alone = stage["ngram_jaccard"](spark, lean, FOLDER).cache()
    firsts = {i for i, (_, top) in groups.items() if i == top}
    assert sorted(r["doc_id"] for r in alone.collect()) == sorted(firsts) and alone.columns == docs.columns
    mixed = Counter(r["doc_id"] for r in stage["source_mixing"](spark, alone, FOLDER).collect())
    assert set(mixed) == firsts and max(mixed.values()) <= 2
    result = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(r["doc_id"] for r in result if r["piece"] == 0) == mixed
    room = Counter()
    for r in result:
        room[r["sequence_id"]] += r["length"]
    assert max(room.values()) <= 2048 and len(room) == -(-sum(room.values()) // 2048)


def test_workers_find_the_package(spark):
    def here(batches):
        import reviewloom.llm.words

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([reviewloom.llm.words.__name__] * batch.num_rows)], names=["n"])

    assert map_arrow(spark.range(1), here, "n string").head()["n"] == "reviewloom.llm.words"
