"""Fill-in-the-middle, language identification and source divergence against brute force, round trips and held-out accuracy."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewloom.llm import divergence, fill_middle, language_id, seekable
from reviewloom.llm.markup import Node, Sheet
from reviewloom.llm.registry import QUERIES, documents
from reviewloom.llm.rendering import render

FOLDER = "/root/testdata/sf0.001"
UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
TEXTS = st.lists(st.sampled_from(["ab", "Z", " ", "\n", "é", "漢", "👍", "<", "P", ">", "<S", "_", "q" * 9]), max_size=40).map("".join)


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- fill in the middle ------------------------------------------------------------


def _stored(texts, size):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    units, points, frames = seekable._framed(batch, size, most_bytes=3 * size)
    return [seekable.SeekableText(f, u, p) for u, p, f in zip(units.to_pylist(), points.to_pylist(), frames.to_pylist(), strict=True)]


@given(st.lists(TEXTS, max_size=6), st.integers(4, 30))
@settings(max_examples=300, deadline=None)
def test_places_of_units(texts, size):
    for text, kept in zip(texts, _stored(texts, size), strict=True):
        units = UNITS.findall(text)
        assert (kept.n_units, kept.n_points) == (len(units), len(text))
        assert b"".join(kept.read()).decode() == text
        for cut in range(len(units) + 1):
            place = kept.place(cut)
            assert place[2] == len("".join(units[:cut]))
            assert b"".join(kept.read(None, place)).decode() == "".join(units[:cut])
            assert b"".join(kept.read(place)).decode() == "".join(units[cut:])
        if len(units) > 2:
            low, high = kept.place(1), kept.place(len(units) - 1)
            assert b"".join(kept.read(low, high)).decode() == "".join(units[1:-1])


@given(TEXTS.filter(lambda t: not any(m in t for m in ("<P>", "<S>", "<M>"))), st.data(), st.sampled_from(["psm", "spm", "plain"]))
@settings(max_examples=300, deadline=None)
def test_output_and_back(text, data, form):
    kept = _stored([text], 7)[0]
    units = UNITS.findall(text)
    low, high = sorted(data.draw(st.integers(0, len(units))) for _ in range(2))
    parts = ["".join(units[:low]), "".join(units[low:high]), "".join(units[high:])]
    want = {"plain": text, "psm": "<P>{}<S>{}<M>{}".format(parts[0], parts[2], parts[1]), "spm": "<S>{}<P>{}<M>{}".format(parts[2], parts[0], parts[1])}
    rebuilder = fill_middle.Rebuilder(form)
    rebuilder.kept.size = 5
    chunks = list(fill_middle.arranged(kept, form, kept.place(low), kept.place(high)))
    for chunk in chunks:
        rebuilder.write(chunk)
    assert b"".join(chunks).decode() == want[form]
    assert b"".join(rebuilder.read()).decode() == text


def test_cut_frames_alone_are_opened(monkeypatch):
    text = " ".join(f"word{i}" for i in range(4000))
    kept = _stored([text], 256)[0]
    opened = []
    plain = seekable.SeekableText.frame
    monkeypatch.setattr(seekable.SeekableText, "frame", lambda self, i: opened.append(i) or plain(self, i))
    kept.place(5000)
    kept.place(9000)
    assert len(opened) == 2 < len(kept.frames)


def _brute_fim(doc_id, text):
    text, key = text or "", "" if doc_id is None else str(doc_id)
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(digest[8 * g : 8 * g + 8], 16) for g in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, len(units), "plain", None, None, text)
    if h[3] % 100 < 20:
        return (doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def test_fill_in_middle_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(seekable, "FRAME", 1 << 10)
    texts = [None, "", "a", "x" * 300_000, "漢字 " * 90_000, "with <S> inside", "<P", "ab\ncd", "👍" * 5, "one two three " * 30_000]
    rows = [(i, t) for i, t in enumerate(texts * 6)] + [(7, "again"), (7, "again"), (None, "no id at all"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("frames", F.lit("x")).withColumn("n_units", F.lit(1))
    want = sorted((_brute_fim(*r) for r in rows), key=repr)
    found = fill_middle.fill_in_middle(frame)
    assert sorted(map(tuple, found.collect()), key=repr) == want
    digests = sorted(map(tuple, fill_middle.digests(frame).collect()), key=repr)
    texts_of = {sha256(t or "") for _, t in rows}
    assert sorted((*w[:5], sha256(w[5])) for w in want if w[0] is not None) == sorted(d[:6] for d in digests if d[0] is not None)
    assert {d[6] for d in digests} <= texts_of and len(digests) == len(rows)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fill_middle.digests(frame.where("doc_id < 0")).collect() == []


# --- language identification -------------------------------------------------------


def _brute_places(text):
    """Places of all n-grams of the padded text's bytes, by the definition."""
    data, mask = text.encode(), (1 << 64) - 1
    found = []
    for n in range(1, language_id.LONGEST + 1):
        for i in range(len(data) - n + 1):
            gram = data[i : i + n]
            if b" " in gram[1:-1] or (gram.strip(b" ") == b""):
                continue
            value = 0
            for b in gram:
                value = (value * int(language_id.GOLDEN) + int(language_id._BYTES[b])) & mask
            found.append(((value * int(language_id.GOLDEN)) & mask) >> int(language_id._SHIFT))
    return Counter(found)


@given(st.text(alphabet="ab é漢z", max_size=30))
@settings(max_examples=200, deadline=None)
def test_places_of_n_grams(text):
    padded = f" {text} "
    found = Counter()
    for _, place in language_id.places(np.frombuffer(padded.encode(), np.uint8)):
        found.update(place.tolist())
    assert found == _brute_places(padded)


def test_margins_do_not_depend_on_batches(monkeypatch):
    draw = random.Random(3)
    weights = np.random.default_rng(1).normal(size=(3, language_id.DIMENSIONS))
    model = language_id.Model(("x",), {"x": ("a", "b", "c")}, weights, np.zeros(3))
    texts = [" " + " ".join("".join(draw.choice("abcé") for _ in range(draw.randint(1, 9))) for _ in range(draw.randint(0, 80))) + " " for _ in range(40)]
    whole = model.margins(pa.array(texts))
    monkeypatch.setattr(language_id, "PIECE", 32)
    for text, margin in zip(texts, whole, strict=True):
        count = _brute_places(text)
        want = sum(weights[:, p] * n for p, n in count.items()) / max(1, sum(count.values()))
        assert np.allclose(margin, want, atol=1e-8)
        assert (model.margins(pa.array([text])) == margin).all()


def _sentences(seed, letters, count):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) + draw.choice("aeiou") for _ in range(2)) + " " + " ".join(draw.choice(letters) + draw.choice(letters) + draw.choice("aeiou") for _ in range(12)) for _ in range(count)]


def test_votes_within_a_family(spark):
    """Three languages of one family, one of another, and one that no family has."""
    letters = {"sv": "kvsj", "da": "dgbl", "nl": "ghzw", "pt": "lmnr", "xx": "qxyf"}
    rows = [(t, lang) for lang, set_ in letters.items() for t in _sentences(len(lang + set_), set_, 60)]
    frame = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language_id.fit(language_id.sample_features(frame, 30))
    assert model.languages == {"germanic": ("da", "nl", "sv"), "other": ("xx",), "romance": ("pt",)} and len(model.biases) == 6
    found = language_id.identify(frame, 30).join(frame, "doc_id")
    assert found.where("held_out").count() > 50
    assert found.where("held_out AND lang <> lang_pred").count() <= 2


def test_language_of_held_out_rows(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    found = QUERIES["op12_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)


def test_languages_of_odd_rows(spark):
    texts = _sentences(1, "kvsj", 40) + _sentences(2, "lmnr", 40)
    rows = [(i, t, "sv" if i < 40 else "pt") for i, t in enumerate(texts)]
    more = [(100, None, "sv"), (101, "", "pt"), (102, "123 !?", "sv"), (103, "漢", None), (None, texts[0], "sv"), (5, texts[5], "sv"), (104, texts[50] * 9000, None)]
    frame = spark.createDataFrame(rows + more, "doc_id long, text string, lang string").select("*", F.lit(1).alias("words"), F.lit(2).alias("rank"))
    found = {r["doc_id"]: r for r in language_id.identify(frame).collect()}
    assert len(found) == len(rows) + 6 and language_id.identify(frame).count() == len(rows + more)
    assert [tuple(found[i])[2:] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert found[103]["lang_pred"] in ("sv", "pt") and found[104]["lang_pred"] == "pt"
    assert (found[None]["held_out"], found[None]["lang_pred"]) == (False, "sv")
    assert found[None]["score"] == found[0]["score"]
    # Nothing to learn from, one language alone, no rows.
    assert {r["lang_pred"] for r in language_id.identify(frame.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert {r["lang_pred"] for r in language_id.identify(frame.where("lang = 'sv'")).collect()} == {"sv", "und"}
    assert language_id.identify(frame.where("doc_id < 0")).collect() == []
    # A repeated id counts once.
    again = frame.unionByName(frame.where("doc_id = 7")).unionByName(frame.where("doc_id = 7"))
    assert len(language_id.sample_features(again)) == len(language_id.sample_features(frame))


# --- divergence of sources ---------------------------------------------------------


def _brute_audit(rows, least=10, ranks=10):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = term.findall((text or "").translate(lower))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for la, s in counts if la == lang)
        share = {}
        for s in [*sources, None]:
            c = {t: sum(counts[lang, x][t] for x in (sources if s is None else [s])) for t in kept}
            size = sum(c.values())
            share[s] = {t: 1 + 10**9 * (c[t] + 2) // (size + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(o, sum(f(share[s][t], share[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(share[s][t], share[None][t])) for t in kept if counts[lang, s][t] and share[s][t] > share[None][t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, i) for i, (item, value) in enumerate(found[:most], start=1)}
    return out


@pytest.mark.parametrize("block, held", [(1 << 21, 200_000), (64, 50)])
def test_audit(spark, monkeypatch, block, held):
    monkeypatch.setattr(divergence, "HELD", held)
    draw = random.Random(5)
    words = [f"{a}{b}" for a in "abcdé" for b in "XYz漢"]
    text = lambda: " ".join(draw.choice(words[: draw.randint(2, len(words))]) for _ in range(draw.randint(0, 25)))
    rows = [(text(), draw.choice(["en", "de", None, ""]), draw.choice(["a", "b", "c", "É", None])) for _ in range(400)]
    rows += [(None, "en", "silent"), ("rare words only", "fr", "a"), ("", "fr", "b"), (None, None, None), ("lone " * 3, "it", "a")] + [("same", "nl", "a")] * 12
    rows += [(" ".join(words) + " long_tail-x " * 20_000, "en", "a")]
    frame = spark.createDataFrame([(i % 50, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string").repartition(5)
    frame = frame.select("*", *[F.lit("x").alias(c) for c in ("term", "n", "counts", "sizes", "value", "rank")])
    found = [tuple(r) for r in divergence.audit(frame, block=block).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(found) == len(set(found)) and set(found) == _brute_audit(rows)
    assert {r[0] for r in found if r[2] == "pair" and r[4] == 0} >= {"fr"}
    assert divergence.audit(frame.where("doc_id < 0")).collect() == []


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 40)), min_size=1, max_size=60))
@settings(max_examples=200, deadline=None)
def test_runs_meet_exactly(rows):
    columns = np.array(sorted(rows), np.int64)
    sizes = columns.sum(axis=0).tolist()
    p = [divergence.shares(columns[:, i], sizes[i], len(rows)) for i in range(3)]
    assert [x.tolist() for x in p] == [[1 + 10**9 * (int(c) + 2) // (sizes[i] + 2 * len(rows)) for c in columns[:, i]] for i in range(3)]
    want = [int(divergence.divergence(p[a], p[b]).sum()) for a, b in ((0, 1), (0, 2), (1, 2))]
    assert divergence._block_sums(columns, sizes, len(rows)) == want


def test_shares_of_great_counts():
    counts = np.array([0, 7, 10**15, 4 * 10**15], np.int64)
    assert divergence.shares(counts, 9 * 10**15, 1000).tolist() == [1 + 10**9 * (int(c) + 2) // (9 * 10**15 + 2000) for c in counts]


# --- style rules and size of pages --------------------------------------------------


@pytest.mark.parametrize("html, text", [
    ("<style>#a{display:none} .b{display:block}</style><p id=a class=b>hid</p>seen", "seen"),
    ("<style>.b{display:none} p.b{display:block}</style><p class=b>seen</p><i class=b>hid</i>", "seen"),
    ("<style>p{display:none!important}</style><p style='display:block'>hid</p>seen", "seen"),
    ("<style>p{display:none!important}</style><p style='display:block !important'>seen</p>", "seen"),
    ("<style>p{display:none} p{display:block}</style><p>seen</p>", "seen"),
    ("<style>p{display:none !important} p{display:block}</style><p>hid</p>seen", "seen"),
    ("<style>.nav .x{display:none}</style><div class=nav><i><b class=x>hid</b></i></div><b class=x>seen</b>", "seen"),
    ("<style>div > p{display:none}</style><div><p>hid</p><section><p>seen</p></section></div>", "seen"),
    ("<style>div>p,span{display:none}</style><div><p>hid</p></div><span>hid</span>seen", "seen"),
    ("<style>p:not(.k){display:none}</style><p>hid<p class=k>seen", "seen"),
    ("<style>p:not(.k, #i){display:none}</style><p>hid<p id=i>seen", "seen"),
    ("<style>[data-x='1']{display:none} [q]{display:none}</style><p data-x=1>hid<p data-x=2>seen<p q>hid", "seen"),
    ("<style>[title='']{display:none}</style><p title=''>hid<p title=x>seen", "seen"),
    ("<style>a + b, a ~ i, b:hover, ::before{display:none}</style><a>1</a><b>2</b><i>3</i>", "123"),
    ("<p hidden>hid</p><style>.s{display:block}</style><p hidden class=s>seen</p>", "seen"),
    ("<style>.v{visibility:hidden} .v .w{visibility:visible}</style><div class=v>hid<b class=w>seen</b></div>", "seen"),
])
def test_cascade(html, text):
    assert render(html) == text


def test_large_and_deep_pages_take_linear_time():
    pages = ["<div>" * 20_000 + "x", "<style>.a .b .c{display:none} div > p{display:none}</style><div class=a>" + "<div class=b>" * 20_000 + "x",
             "<table>" + "<tr>text in the wrong place " * 12_000 + "</table>", "<table>" * 4_000 + "x" + "</p>" * 4_000, "<b><p>x" * 8_000]
    for html in pages:
        start = time.perf_counter()
        assert "x" in render(html)
        assert time.perf_counter() - start < 3


def _matches(node, selector):
    """A selector as (joint, tag, class) from the outermost on, tried in every way."""
    *outer, (joint, tag, name) = selector
    if (tag and node.tag != tag) or (name and name not in node.attributes.get("class", "").split()):
        return False
    if not outer:
        return True
    around = node.parent
    while around is not None:
        if _matches(around, outer):
            return True
        around = None if joint == ">" else around.parent
    return False


_PART = st.tuples(st.sampled_from([" ", ">"]), st.sampled_from(["", "div", "p", "i"]), st.sampled_from(["", "a", "b"])).filter(lambda x: x[1] or x[2])


@given(st.lists(st.lists(_PART, min_size=1, max_size=4), min_size=1, max_size=4), st.lists(st.tuples(st.integers(0, 9), st.sampled_from(["div", "p", "i"]), st.sampled_from(["", "a", "b", "a b"])), min_size=1, max_size=14))
@settings(max_examples=300, deadline=None)
def test_selectors_against_all_ways(selectors, tree):
    nodes = [Node("html")]
    for place, tag, classes in tree:
        parent = nodes[place % len(nodes)]
        nodes.append(Node(tag, {"class": classes}, parent))
        parent.children.append(nodes[-1])
    text = ["".join((f" {j} " if i else "") + t + (f".{c}" if c else "") for i, (j, t, c) in enumerate(s)) for s in selectors]
    for node in reversed(nodes):  # in any order
        node_sheet = Sheet([",".join(text) + "{display:none}"])
        for other in nodes:
            other.matched = None
        assert (node_sheet.style(node).get("display") == "none") == any(_matches(node, s) for s in selectors)
    sheet = Sheet([",".join(text) + "{display:none}"])
    for other in nodes:
        other.matched = None
    assert [sheet.style(n).get("display") == "none" for n in nodes] == [any(_matches(n, s) for s in selectors) for n in nodes]


def test_partial_counts_of_a_task_leave_it_once(spark):
    words = ["".join(chr(97 + int(c)) for c in str(k)) for k in range(3000)]
    rows = [(i, "en", f"s{i % 3}", " ".join(words)) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").coalesce(1)
    counts = divergence.term_counts(docs)
    assert {tuple(r) for r in counts.groupBy("source").agg(F.count("*"), F.sum("n"), F.sum("n_docs")).collect()} == {
        ("s0", 3000, 34 * 3000, 34 * 3000), ("s1", 3000, 33 * 3000, 33 * 3000), ("s2", 3000, 33 * 3000, 33 * 3000)}
    assert divergence.HELD >= 500_000
