"""Column expressions shared by the jobs; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


# Punctuation between a word and white space, on either side; the first test fails fast on letters.
_EDGE_PUNCTUATION = r"(?=\p{Punct})(?:(?<=[^\s\p{Punct}])\p{Punct}++(?!\S)|(?<!\S)\p{Punct}++(?=\S))"


def split_words(text: Column) -> Column:
    """Words between white space, without punctuation at their ends; a token of punctuation alone stays.

    Punctuation goes by one replacement over the whole text, which is much cheaper
    than a function call per word.
    """
    return F.split(F.regexp_replace(text, _EDGE_PUNCTUATION, ""), r"\s+")


def n_rows() -> Column:
    return F.count(F.lit(1))


def is_blank(column: str) -> Column:
    """Null or nothing but Unicode white space (``trim`` would miss tabs and line ends)."""
    return F.col(column).isNull() | F.col(column).rlike(r"(?U)^\s*$")


def is_trim_empty(column: str) -> Column:
    """Null or nothing but spaces, the test used by the source statistics."""
    return F.col(column).isNull() | (F.trim(F.col(column)) == "")


def anonymise(column: str, salt: str = "default_salt", null_as_text: bool = False) -> Column:
    """Salted SHA-256 of an id.

    A null id stays null. ``null_as_text`` hashes the text 'None' instead, which
    gives all missing buyers one shared id.
    """
    text = F.col(column).cast("string")
    if null_as_text:
        text = F.coalesce(text, F.lit("None"))
    return F.sha2(F.concat(F.lit(salt), text), 256)


def image_list(column: str) -> Column:
    """Comma-separated images as a list: trimmed, without empties, [] for null."""
    parts = F.transform(F.split(F.col(column), ","), lambda x: F.trim(x))
    return F.coalesce(F.filter(parts, lambda x: x != ""), F.array().cast("array<string>"))


def stars(column: str) -> Column:
    return F.repeat(F.lit("⭐"), F.col(column))


def product_label(name: str = "product_name", category: str = "category") -> Column:
    return F.concat(F.col(name), F.lit(" ("), F.coalesce(F.col(category), F.lit("N/A")), F.lit(")"))


def contains_ignoring_case(column: str, text: str) -> Column:
    return F.lower(F.col(column)).contains(text.lower())


def null_spellings(column: str, spellings: tuple[str, ...] = ("NULL", "null", "")) -> Column:
    return F.when(F.col(column).isin(*spellings), None).otherwise(F.col(column))


def estimated_delivery(day: Column | str, days: int = 7) -> Column:
    return F.date_add(day, days)


def number_or_zero(column: str) -> Column:
    return F.coalesce(F.col(column).try_cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, and 0 for an empty whole."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


#: Characters that would end a record's line, and the escape itself, with how they are written. No escape holds another's start.
_ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))


def _texts(df: DataFrame, pairs) -> DataFrame:
    def put(column: str) -> Column:
        value = F.col(column)
        for old, new in pairs:
            value = F.replace(value, F.lit(old), F.lit(new))
        return value

    return df.withColumns({f.name: put(f.name) for f in df.schema.fields if f.dataType.simpleString() == "string"})


def one_line(df: DataFrame) -> DataFrame:
    """Texts without line ends, to be read back by ``many_lines``."""
    return _texts(df, _ESCAPES)


def many_lines(df: DataFrame) -> DataFrame:
    return _texts(df, [(new, old) for old, new in reversed(_ESCAPES)])
