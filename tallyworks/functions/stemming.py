"""Porter stemming (M. F. Porter, 1980) as native Spark SQL expressions.

Each step of the algorithm is a function from the name of a word column (or
lambda variable) to a SQL expression. A step mentions its word many times, so
steps are never nested into one expression, which would grow exponentially:
``stem_arrays`` binds every step to the variable of a ``transform``, and
``with_stem`` gives every step its own projection. Of the two, the array form is
the one for whole corpora: it lets a document make its terms distinct in place,
where one row per token would need a shuffle of all of them.

Vowels are a, e, i, o, u, and y after a consonant. Every other character,
digits and capitals included, counts as a consonant.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shape of a stem in the paper's notation [C](VC)^m[V], written as patterns.
_FIRST_VOWELS = "^(?:[^aeiou][^aeiouy]*[aeiouy]|[aeiou])[aeiou]*"
_CONSONANTS = "[^aeiou][^aeiouy]*"
_VOWELS = "[aeiouy][aeiou]*"
HAS_VOWEL = "[aeiou]|.y"
M_OVER_0 = _FIRST_VOWELS + "[^aeiou]"
M_IS_1 = _FIRST_VOWELS + _CONSONANTS + f"(?:{_VOWELS})?$"
M_OVER_1 = _FIRST_VOWELS + _CONSONANTS + _VOWELS + "[^aeiou]"
ENDS_CVC = "^[^aeiou][^aeiouy]*[aeiouy][^aeiouwxy]$"
# A doubled last consonant other than l, s, z.
DOUBLE_END = "(?:" + "|".join(c + c for c in "bcdfghjkmnpqrtvwx0123456789") + ")$"

# The suffix tables of the published algorithm.
STEP_2_SUFFIXES = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize",
    "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
# The 1980 paper has abli -> able; the author's later code has the other two.
STEP_2_PAPER = {"abli": "able"}
STEP_2_REVISED = {"bli": "ble", "logi": "log"}
STEP_3_SUFFIXES = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
# -ion goes only after s or t, and that letter stays.
STEP_4_SUFFIXES = {
    "al": "", "ance": "", "ence": "", "er": "", "ic": "", "able": "", "ible": "", "ant": "",
    "ement": "", "ment": "", "ent": "", "sion": "s", "tion": "t", "ou": "", "ism": "", "ate": "",
    "iti": "", "ous": "", "ive": "", "ize": "",
}

Step = Callable[[str], str]


def _cut(word: str, n_chars: int) -> str:
    return f"left({word}, length({word}) - {n_chars})"


def _plurals(word: str) -> str:
    return f"""CASE WHEN NOT endswith({word}, 's') OR endswith({word}, 'ss') THEN {word}
        WHEN endswith({word}, 'sses') OR endswith({word}, 'ies') THEN {_cut(word, 2)}
        ELSE {_cut(word, 1)} END"""


def _past_and_participle(word: str) -> str:
    """Cut -eed, -ed and -ing. A word that lost -ed or -ing carries a trailing blank until ``_repair``."""

    def cut(n_chars: int) -> str:
        stem = _cut(word, n_chars)
        return f"if({stem} RLIKE '{HAS_VOWEL}', {stem} || ' ', {word})"

    return f"""CASE
        WHEN endswith({word}, 'eed') THEN if({_cut(word, 3)} RLIKE '{M_OVER_0}', {_cut(word, 1)}, {word})
        WHEN endswith({word}, 'ed') THEN {cut(2)}
        WHEN endswith({word}, 'ing') THEN {cut(3)}
        ELSE {word} END"""


def _repair(word: str) -> str:
    stem = _cut(word, 1)
    return f"""CASE WHEN NOT endswith({word}, ' ') THEN {word}
        WHEN {stem} RLIKE '(?:at|bl|iz)$' THEN {stem} || 'e'
        WHEN {stem} RLIKE '{DOUBLE_END}' THEN {_cut(word, 2)}
        WHEN {stem} RLIKE '{ENDS_CVC}' THEN {stem} || 'e'
        ELSE {stem} END"""


def _final_y(word: str) -> str:
    stem = _cut(word, 1)
    return f"if(endswith({word}, 'y') AND {stem} RLIKE '{HAS_VOWEL}', {stem} || 'i', {word})"


def _suffix_table(table: dict[str, str], kept: dict[str, str], measure: str) -> Step:
    """Replace the longest matching suffix if what stands before the cut has the measure.

    ``kept`` counts how much of a replacement already belongs to the measured stem.
    """

    def step(word: str) -> str:
        # Sorted into cases by last letter, so that most words fail a few short tests only.
        by_letter: dict[str, list[str]] = {}
        for suffix in sorted(table, key=len, reverse=True):
            stem = _cut(word, len(suffix) - len(kept.get(suffix, "")))
            tail = table[suffix][len(kept.get(suffix, "")):]
            changed = f"{stem} || '{tail}'" if tail else stem
            by_letter.setdefault(suffix[-1], []).append(
                f"WHEN endswith({word}, '{suffix}') THEN if({stem} RLIKE '{measure}', {changed}, {word})"
            )
        cases = [
            f"WHEN endswith({word}, '{letter}') THEN CASE {' '.join(tests)} ELSE {word} END"
            for letter, tests in by_letter.items()
        ]
        return "CASE " + "\n ".join(cases) + f" ELSE {word} END"

    return step


def _final_e(word: str) -> str:
    stem = _cut(word, 1)
    drop = f"({stem} RLIKE '{M_OVER_1}' OR ({stem} RLIKE '{M_IS_1}' AND NOT {stem} RLIKE '{ENDS_CVC}'))"
    return f"if(endswith({word}, 'e') AND {drop}, {stem}, {word})"


def _final_double_l(word: str) -> str:
    return f"if(endswith({word}, 'll') AND {word} RLIKE '{M_OVER_1}', {_cut(word, 1)}, {word})"


def porter_steps(revised: bool = True) -> list[Step]:
    """The steps in order. ``revised`` takes bli -> ble and logi -> log in step 2, as most libraries do."""
    step_2 = {**STEP_2_SUFFIXES, **(STEP_2_REVISED if revised else STEP_2_PAPER)}
    ion = {"sion": "s", "tion": "t"}
    return [
        _plurals,
        _past_and_participle,
        _repair,
        _final_y,
        _suffix_table(step_2, {}, M_OVER_0),
        _suffix_table(STEP_3_SUFFIXES, {}, M_OVER_0),
        _suffix_table(STEP_4_SUFFIXES, ion, M_OVER_1),
        _final_e,
        _final_double_l,
    ]


def with_stem(frame: DataFrame, word: str, stem: str = "stem", revised: bool = True) -> DataFrame:
    """Add the stem of one word column; words of one or two characters stay as they are."""
    out = frame.withColumn(stem, F.col(word))
    for step in porter_steps(revised):
        out = out.withColumn(stem, F.expr(step(f"`{stem}`")))
    return out.withColumn(stem, F.expr(f"if(length(`{word}`) > 2, `{stem}`, `{word}`)"))


def stem_arrays(frame: DataFrame, tokens: str, revised: bool = True) -> tuple[DataFrame, Column]:
    """The frame with working columns in place of ``tokens``, and the array of all stems over it.

    Tokens of one or two characters are passed over by every step, also where a
    longer token has been cut down to the same letters, so they travel apart.

    The stems are an expression, not a column, because they are there to be
    exploded: Spark puts a filter on the size of an exploded *column* and moves
    it to the scan, which would run every step twice.
    """
    out = frame.withColumns({
        "_long": F.expr(f"filter(`{tokens}`, w -> length(w) > 2)"),
        "_short": F.expr(f"filter(`{tokens}`, w -> length(w) <= 2)"),
    }).drop(tokens)
    for step in porter_steps(revised):
        out = out.withColumn("_long", F.expr(f"transform(_long, w -> {step('w')})"))
    return out, F.concat("_long", "_short")


def stem_vocabulary(tokens: DataFrame, token: str = "token", revised: bool = True) -> DataFrame:
    """Each distinct token once, with its stem: ``(token, stem)``."""
    return with_stem(tokens.select(token).where(F.col(token) != "").distinct(), token, "stem", revised)
