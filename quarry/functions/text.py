"""Analyzers: tokenizers and token filters as Column -> Column functions over ARRAY<STRING>.

Every function here compiles to built-in Spark expressions, so analysis stays inside
whole-stage codegen and runs where the data lives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python's str.isspace() accepts (U+0009-U+000D, U+001C-U+0020,
# U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000).
WHITESPACE_CLASS = "[\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"
PUNCTUATION_RUN = "\\p{P}+"
# Fixed value: one trailing prolonged sound mark after at least three katakana.
KATAKANA_STEM = "^(\\p{IsKatakana}{3,})ー$"
POSSESSIVE_SUFFIX = "('|'s)$"

Analyzer = Callable[[Column], Column]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tok_as_is(col) -> Column:
    """Whole value is one token."""
    return F.array(_c(col))


def tok_whitespace(col) -> Column:
    """Split on runs of Unicode whitespace, no empty tokens (Python ``str.split()``)."""
    return F.filter(F.split(_c(col), WHITESPACE_CLASS), lambda x: x != F.lit(""))


def tok_punctuation(col) -> Column:
    """Split on runs of Unicode punctuation; spaces stay inside tokens and empties are kept."""
    return F.split(_c(col), PUNCTUATION_RUN)


def flt_possessive(tokens) -> Column:
    """Strip a trailing apostrophe, else a trailing apostrophe-s."""
    return F.transform(_c(tokens), lambda x: F.regexp_replace(x, POSSESSIVE_SUFFIX, ""))


def flt_lowercase(tokens) -> Column:
    return F.transform(_c(tokens), lambda x: F.lower(x))


def flt_katakana_stem(tokens) -> Column:
    return F.transform(_c(tokens), lambda x: F.regexp_replace(x, KATAKANA_STEM, "$1"))


def flt_stop_terms(tokens, stop_terms: Iterable[str]) -> Column:
    """Drop tokens found in a (small, literal) stop list. For a large list use a left_anti join."""
    stop = F.array(*[F.lit(s) for s in stop_terms]) if stop_terms else F.array().cast("array<string>")
    return F.filter(_c(tokens), lambda x: ~F.array_contains(stop, x))


def chain(tokenizer: Analyzer, *filters: Analyzer) -> Analyzer:
    """Compose a tokenizer with token filters into one analyzer."""

    def run(col) -> Column:
        out = tokenizer(col)
        for f in filters:
            out = f(out)
        return out

    return run


ANALYZERS: dict[str, Analyzer] = {
    "as_is": tok_as_is,
    "whitespace": tok_whitespace,
    "punctuation": tok_punctuation,
    "whitespace_possessive": chain(tok_whitespace, flt_possessive),
    "whitespace_lower": chain(tok_whitespace, flt_lowercase),
    "whitespace_possessive_lower": chain(tok_whitespace, flt_possessive, flt_lowercase),
    "punctuation_lower": chain(tok_punctuation, flt_lowercase),
    "whitespace_katakana": chain(tok_whitespace, flt_katakana_stem),
}


def flt_lowercase_after(tokenizer: Analyzer) -> Analyzer:
    return chain(tokenizer, flt_lowercase)
