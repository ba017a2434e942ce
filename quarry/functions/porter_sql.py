"""The Porter (1980) stemmer as SQL expressions: regular expressions over the word, no Python worker.

M. F. Porter, "An algorithm for suffix stripping", Program 14(3), 130-137, 1980. The measure and the
conditions on a stem are regular expressions (a y is a vowel after a consonant); of several suffixes the
longest is the one that a pattern anchored at the end finds first. Every step is one or two columns that
name the word of the step before, so nothing is computed twice. The expressions are written once for both
dialects that run them: ``RX`` (matches) is the only function whose name differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.porter import STEP2, STEP3, STEP4

START = "^([^aeiou][^aeiouy]*[aeiouy]|[aeiou])"  # up to the first vowel
M_ABOVE_0 = START + "[aeiou]*[^aeiou]"
M_ABOVE_1 = M_ABOVE_0 + "[^aeiouy]*[aeiouy][aeiou]*[^aeiou]"
M_IS_1 = M_ABOVE_0 + "[^aeiouy]*([aeiouy][aeiou]*)?$"
CVC = "^[^aeiou][^aeiouy]*[aeiouy][^aeiouwxy]$"  # measure 1 and consonant, vowel, consonant at the end


def _cut(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _rules(rules: list[tuple[str, str]], condition: str) -> list[tuple[str, str]]:
    """Columns of a step: the longest suffix, the word without it, and the word after the step."""
    suffixes = "|".join(s for s, _ in rules)
    to = " ".join(f"WHEN '{s}' THEN '{r}'" for s, r in rules)
    return [
        ("suf", f"regexp_extract(w, '({suffixes})$', 1)"),
        ("x", "left(w, length(w) - length(suf))"),
        ("w", f"CASE WHEN suf <> '' AND {condition} THEN concat(x, CASE suf {to} END) ELSE w END"),
    ]


TWIN = (  # ends in a double consonant other than l, s and z
    "right(x, 1) = right(left(x, length(x) - 1), 1) AND "
    "(RX(x, '[^aeiouylsz]$') OR RX(x, '(^|[aeiou])y(yy)+$') OR RX(x, '[^aeiouy](yy)+$'))"
)
STEPS: list[tuple[str, str]] = [
    ("w", f"CASE WHEN w LIKE '%sses' OR w LIKE '%ies' THEN {_cut(2)} WHEN w LIKE '%s' AND NOT w LIKE '%ss' THEN {_cut(1)} ELSE w END"),
    (
        "x",
        f"CASE WHEN w LIKE '%eed' THEN NULL WHEN w LIKE '%ed' AND RX({_cut(2)}, '{START}') THEN {_cut(2)} "
        f"WHEN w LIKE '%ing' AND RX({_cut(3)}, '{START}') THEN {_cut(3)} END",
    ),
    (
        "w",
        f"CASE WHEN x IS NULL THEN CASE WHEN w LIKE '%eed' AND RX({_cut(3)}, '{M_ABOVE_0}') THEN {_cut(1)} ELSE w END "
        f"WHEN RX(x, '(at|bl|iz)$') THEN concat(x, 'e') WHEN {TWIN} THEN left(x, length(x) - 1) WHEN RX(x, '{CVC}') THEN concat(x, 'e') ELSE x END",
    ),
    ("w", f"CASE WHEN w LIKE '%y' AND RX({_cut(1)}, '{START}') THEN concat({_cut(1)}, 'i') ELSE w END"),
    *_rules(STEP2, f"RX(x, '{M_ABOVE_0}')"),
    *_rules(STEP3, f"RX(x, '{M_ABOVE_0}')"),
    *_rules([(s, "") for s in STEP4], f"RX(x, '{M_ABOVE_1}') AND (suf <> 'ion' OR RX(x, '[st]$'))"),
    ("x", _cut(1)),
    ("w", f"CASE WHEN w LIKE '%e' AND (RX(x, '{M_ABOVE_1}') OR (RX(x, '{M_IS_1}') AND NOT RX(x, '{CVC}'))) THEN x ELSE w END"),
    ("w", f"CASE WHEN w LIKE '%ll' AND RX(w, '{M_ABOVE_1}') THEN {_cut(1)} ELSE w END"),
]


def stems(words: DataFrame, term: str = "term", out: str = "stem") -> DataFrame:
    """``words`` with the stem of a lower-case word; words of up to two characters are their own. Null: null."""
    df = words.select("*", F.col(term).alias("w"), F.lit(None).cast("string").alias("x"), F.lit("").alias("suf"))
    kept = words.columns
    for name, expression in STEPS:
        columns = {"w": "w", "x": "x", "suf": "suf"} | {name: f"{expression.replace('RX(', 'regexp_like(')} AS {name}"}
        df = df.selectExpr(*[f"`{c}`" for c in kept], *columns.values())
    return df.select(*kept, F.when(F.length(term) <= 2, F.col(term)).otherwise(F.col("w")).alias(out))


def stems_sql(words: str, term: str = "term", out: str = "stem") -> str:
    """The same as a query over a table expression ``words`` with a column ``term``."""
    query = f"SELECT {term}, {term} AS w, NULL::VARCHAR AS x, '' AS suf FROM {words}"
    for name, expression in STEPS:
        columns = {"w": "w", "x": "x", "suf": "suf"} | {name: f"{expression.replace('RX(', 'regexp_matches(')} AS {name}"}
        query = f"SELECT {term}, {', '.join(columns.values())} FROM ({query})"
    return f"SELECT {term}, CASE WHEN length({term}) <= 2 THEN {term} ELSE w END AS {out} FROM ({query})"
