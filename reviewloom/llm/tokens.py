"""Token counts by batch encoding in Arrow functions.

Batches are cut by bytes, and only lengths return. Long texts are split where a token can't reach across: the
pattern of a byte-level BPE always ends a match before a space that stands between two characters
other than white space, and merges stay inside a match. Characters count as such only where no version of Unicode could take them for
white space: visible ASCII, letters and digits. The library gets the parts of all texts of a batch that need it in one call.
Files of other kinds, and those whose added tokens swallow spaces, are not split.

The ids are those of the ``tokenizers`` library. Where that is proven, a faster engine makes them from the same file:
it merges the two neighbours whose joined bytes have the lowest rank, while the file lists pairs. The two agree
if ids follow the order of the merges and each entry of the vocabulary, encoded alone, is itself: then at its rank the
bytes of an entry can only lie there as its own pair. ``_agrees`` checks this for a file, once
per Python worker. Texts with special strings, or with characters outside ``SETTLED`` (whose
classes might differ between Unicode versions), and other kinds of files go through the library itself.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer, models

from .tables import map_arrow, slices, whole_text

#: The published pattern of byte-level BPE (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Latin, Cyrillic, general punctuation, kana, Han and Hangul of early Unicode; no white space in doubt.
SETTLED = "\x00-\x1b\x20-\x84\x86-\u021f\u0410-\u044f\u2010-\u2027\u2030-\u2046\u20ac\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
UNSETTLED = re.compile(f"[^{SETTLED}]")
LONG = 1 << 16
_CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")


def _byte_characters() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _agrees(model: dict, specials: set[str]) -> dict[bytes, int] | None:
    """Ranks of the vocabulary's bytes if the faster engine gives the same ids, else None."""
    byte = _byte_characters()
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in specials}
    if any(c not in byte for t in vocabulary for c in t) or any(c not in vocabulary for c in byte):
        return None
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocabulary.get(a + b, -1) for a, b in pairs]
    if made != sorted(set(made)) or len(made) + 256 != len(vocabulary) or made and made[0] <= max(vocabulary[c] for c in byte):
        return None
    alone = Tokenizer(models.BPE(vocab=vocabulary, merges=pairs))
    entries = list(vocabulary)
    if any(e.ids != [vocabulary[t]] for t, e in zip(entries, alone.encode_batch(entries), strict=True)):
        return None
    return {bytes(byte[c] for c in t): i for t, i in vocabulary.items()}


class Encoder:
    """Ids of whole texts by one tokenizer file, without special tokens added."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.fast = None
        if path.endswith(".model"):
            pieces = SentencePieceProcessor(model_file=path)
            self.batch = lambda texts: pieces.encode(texts, num_threads=1)
            self.splits = False
            return
        tokenizer = Tokenizer.from_file(path)
        self.batch = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        steps, model = kind.get("pre_tokenizer") or {}, kind["model"]
        specials = {t["content"] for t in kind.get("added_tokens", ())}
        plain = not any(kind.get(k) for k in ("normalizer", "truncation", "padding"))
        plain = plain and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        swallow = any(t.get("lstrip") or t.get("rstrip") or " " in t["content"] for t in kind.get("added_tokens", ()))
        byte_level = plain and steps.get("type") == "ByteLevel" and steps.get("use_regex", True) and not steps.get("add_prefix_space")
        self.splits = byte_level and not swallow
        if byte_level:
            if ranks := model.get("type") == "BPE" and _agrees(model, specials):
                self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
                self.special = re.compile("|".join(map(re.escape, specials)) or r"(?!)")
                self.settled: set[str] = set()

    def _proven(self, text: str) -> bool:
        if self.fast is None or self.special.search(text):
            return False
        new = set(text) - self.settled
        if UNSETTLED.search("".join(new)):
            return False
        self.settled |= new
        return True

    def _parts(self, text: str) -> list[str]:
        parts, start = [], 0
        while len(text) - start > LONG and (cut := _CUT.search(text, start + LONG)):
            parts.append(text[start : cut.start()])
            start = cut.start()
        return [*parts, text[start:]]

    def encode_all(self, texts: list[str]) -> Iterator[list[np.ndarray]]:
        """Ids of whole texts, each in parts: one part, or several for a long text."""
        proven = [self._proven(text) for text in texts]
        parts = [self._parts(text) if fast or self.splits else [text] for text, fast in zip(texts, proven, strict=True)]
        left = iter(self.batch([p for own, fast in zip(parts, proven, strict=True) if not fast for p in own]))
        for own, fast in zip(parts, proven, strict=True):
            if fast:
                yield [self.fast.encode_to_numpy(p, disallowed_special=()) for p in own]
            else:
                yield [np.asarray(next(left), np.uint32) for _ in own]

    def encode(self, text: str) -> list[np.ndarray]:
        return next(self.encode_all([text]))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per file and Python worker."""
    return Encoder(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_column: str = "doc_id", text_column: str = "text"):
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    Counts are those of the library for the whole text, without special tokens added.
    A null text counts as empty: 0 bytes, 0 tokens. Rows with a null or repeated id stay
    rows of their own. Other columns are not read. An empty table gives an empty result.
    """

    def lengths(batches):
        tokens = encoder(path)
        for batch in slices(batches, 1):
            counts = [sum(map(len, parts)) for parts in tokens.encode_all(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(batch.column(1)).cast(pa.int64()),
                 pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    found = map_arrow(rows, lengths, f"id {kind}, n_bytes long, n_tokens long")
    return found.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
