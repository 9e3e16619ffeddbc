"""Porter stemming (M. F. Porter, "An algorithm for suffix stripping", 1980).

Plain suffix tables plus a letter-shape string: ``shape("trouble") == "ccvvccv"``. The default
adds the well-known later extensions (short words and a list of irregular forms are kept,
``-logi``, ``-bli`` and ``-fulli`` are known, ``-ies``/``-ied`` after one letter give ``-ie``).
Spark calls it through an Arrow function that sees each distinct token of a batch once.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (suffix, replacement), applied when the stem before the suffix has measure > 0.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
# Suffixes removed when the stem has measure > 1 ("ion" only after s or t).
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)
# Irregular forms of the extended rules.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

_VOWEL_RUNS = re.compile("v+c+")


def shape(word: str) -> str:
    """One ``c`` or ``v`` per letter; y is a vowel exactly when a consonant stands before it."""
    kinds = []
    for letter in word:
        if letter in "aeiou":
            kinds.append("v")
        elif letter == "y" and kinds and kinds[-1] == "c":
            kinds.append("v")
        else:
            kinds.append("c")
    return "".join(kinds)


def measure(stem: str) -> int:
    """Number of vowel-consonant runs."""
    return len(_VOWEL_RUNS.findall(shape(stem)))


def _has_vowel(stem: str) -> bool:
    return "v" in shape(stem)


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and shape(word)[-1] == "c"


def _short_end(word: str, extended: bool) -> bool:
    """Consonant, vowel, consonant at the end, the last not w, x or y."""
    kinds = shape(word)
    if kinds[-3:] == "cvc" and word[-1] not in "wxy":
        return True
    return extended and kinds == "vc"


def _replace(word: str, rules) -> str:
    """Apply the first rule (suffix, replacement, condition on the stem) whose suffix fits."""
    for suffix, replacement, condition in rules:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            return stem + replacement if condition(stem) else word
    return word


def _longest_first(table, condition):
    return [
        (suffix, replacement, condition)
        for suffix, replacement in sorted(table, key=lambda pair: -len(pair[0]))
    ]


def _some(stem: str) -> bool:
    return measure(stem) > 0


def _many(stem: str) -> bool:
    return measure(stem) > 1


def _ion_or_many(suffix: str):
    if suffix == "ion":
        return lambda stem: stem[-1:] in ("s", "t") and _many(stem)
    return _many


_RULES_2 = _longest_first(STEP_2, _some)
_RULES_2_EXTENDED = _longest_first(
    [pair for pair in STEP_2 if pair[0] != "abli"] + [("bli", "ble"), ("fulli", "ful")], _some
) + [("logi", "log", lambda stem: _some(stem + "l"))]
_RULES_3 = _longest_first(STEP_3, _some)
_RULES_4 = [
    (suffix, "", _ion_or_many(suffix)) for suffix in sorted(STEP_4, key=lambda s: -len(s))
]


def _plural(word: str, extended: bool) -> str:
    if extended and len(word) == 4 and word.endswith("ies"):
        return word[:-1]
    always = lambda stem: True
    return _replace(
        word, [("sses", "ss", always), ("ies", "i", always), ("ss", "ss", always), ("s", "", always)]
    )


def _past(word: str, extended: bool) -> str:
    if extended and word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _some(word[:-3]) else word
    for suffix in ("ed", "ing"):
        stem = word[: len(word) - len(suffix)]
        if word.endswith(suffix) and _has_vowel(stem):
            break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    if measure(stem) == 1 and _short_end(stem, extended):
        return stem + "e"
    return stem


def _final_y(word: str, extended: bool) -> str:
    stem = word[:-1]
    if not word.endswith("y"):
        return word
    if extended:
        fits = len(stem) > 1 and shape(stem)[-1] == "c"
    else:
        fits = _has_vowel(stem)
    return stem + "i" if fits else word


def _suffix_2(word: str, extended: bool) -> str:
    if extended and word.endswith("alli") and _some(word[:-4]):
        return _suffix_2(word[:-2], extended)
    return _replace(word, _RULES_2_EXTENDED if extended else _RULES_2)


def _final_e(word: str, extended: bool) -> str:
    stem = word[:-1]
    if word.endswith("e"):
        m = measure(stem)
        if m > 1 or (m == 1 and not _short_end(stem, extended)):
            return stem
    return word


def stem(token: str, extended: bool = True) -> str:
    word = token.lower()
    if extended:
        if word in IRREGULAR:
            return IRREGULAR[word]
        if len(word) <= 2:
            return word
    word = _final_y(_past(_plural(word, extended), extended), extended)
    word = _replace(_replace(_suffix_2(word, extended), _RULES_3), _RULES_4)
    word = _final_e(word, extended)
    if word.endswith("ll") and _many(word[:-1]):
        word = word[:-1]
    return word


_cached_stem = lru_cache(maxsize=1 << 17)(stem)


def _stem_values(values: pa.Array) -> pa.Array:
    """Stem the distinct values and spread the result back by code."""
    coded = pc.dictionary_encode(values)
    stems = pa.array([_cached_stem(t) for t in coded.dictionary.to_pylist()], pa.string())
    return stems.take(coded.indices)


def stem_tokens(tokens: Column) -> Column:
    """Stem every token of an array column; narrow, so hot tokens cost no shuffle."""

    @F.arrow_udf("array<string>")
    def stems(batch: pa.Array) -> pa.Array:
        flat = _stem_values(batch.flatten())
        lengths = pc.fill_null(pc.list_value_length(batch), 0).cast(pa.int64())
        ends = pc.cumulative_sum(lengths).cast(pa.int32())
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        return pa.ListArray.from_arrays(offsets, flat)

    return stems(tokens)


def stem_column(token: Column) -> Column:
    """Stem a string column, one token per row."""

    @F.arrow_udf("string")
    def stems(batch: pa.Array) -> pa.Array:
        return _stem_values(batch)

    return stems(token)
