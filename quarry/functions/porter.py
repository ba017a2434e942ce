"""Porter (1980) suffix-stripping stemmer, written from the published rule set.

M. F. Porter, "An algorithm for suffix stripping", Program 14(3), 130-137, 1980.
Used as a small per-term helper: the engine stems the DISTINCT vocabulary once (a pandas UDF
over a few million terms at most) and joins the stems back to the postings.
"""

from __future__ import annotations

VOWELS = "aeiou"


def _cons(w: str, i: int) -> bool:
    c = w[i]
    if c in VOWELS:
        return False
    if c == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC)^m[V]."""
    m, i, n = 0, 0, len(stem)
    while i < n and _cons(stem, i):
        i += 1
    while i < n:
        while i < n and not _cons(stem, i):
            i += 1
        if i >= n:
            break
        m += 1
        while i < n and _cons(stem, i):
            i += 1
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) < 3:
        return False
    i = len(w) - 1
    return _cons(w, i - 2) and not _cons(w, i - 1) and _cons(w, i) and w[i] not in "wxy"


def _apply(word: str, rules, cond) -> tuple[str, bool]:
    """Longest matching suffix wins; if its condition fails the step does nothing."""
    for suf, rep in sorted(rules, key=lambda r: -len(r[0])):
        if word.endswith(suf):
            stem = word[: len(word) - len(suf)]
            if cond(stem, suf):
                return stem + rep, True
            return word, False
    return word, False


# The rule tables of the published algorithm (steps 2, 3 and 4).
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def stem(word: str) -> str:
    if word is None or len(word) <= 2:
        return word
    w = word
    # step 1a
    w, _ = _apply(w, [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")], lambda s, suf: True)
    # step 1b
    extra = False
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    else:
        for suf in ("ed", "ing"):
            if w.endswith(suf) and _has_vowel(w[: -len(suf)]):
                w, extra = w[: -len(suf)], True
                break
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # steps 2 and 3
    w, _ = _apply(w, STEP2, lambda s, suf: _measure(s) > 0)
    w, _ = _apply(w, STEP3, lambda s, suf: _measure(s) > 0)
    # step 4
    w, _ = _apply(
        w,
        [(s, "") for s in STEP4],
        lambda s, suf: _measure(s) > 1 and (suf != "ion" or (len(s) > 0 and s[-1] in "st")),
    )
    # step 5a
    if w.endswith("e"):
        s = w[:-1]
        m = _measure(s)
        if m > 1 or (m == 1 and not _cvc(s)):
            w = s
    # step 5b
    if _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w
