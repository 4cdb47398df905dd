"""English suffix stripping (Porter, 1980, with the usual later amendments) as one Column.

Each step reads the word ``c.w`` and its shape ``c.s``, a string with ``C`` or ``V`` for every
letter; the number of ``VC`` in the shape of a stem is Porter's measure. The steps are SQL
text, which Spark parses far faster than Python can build the same tree call by call. Meant
for a table of distinct words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A condition on the SQL of a stem and of its shape.
Condition = Callable[[str, str], str]

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky", "skies": "sky",
    "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "inning": "inning", "innings": "inning", "outing": "outing",
    "outings": "outing", "canning": "canning", "cannings": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Suffix tables of Porter's steps 2, 3 and 4.
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
]
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]

# Endings that make a word a candidate for English stemming.
ENGLISH_ENDING = "^[a-z]*(?:ing|ed|tion|s)$"


def shape(word: str) -> str:
    """A y is a vowel after a consonant. One that starts the word or follows a vowel is none; of
    a run left after that every other one is, which pairs from its start tell at any length."""
    letters = f"translate({word}, 'abcdefghijklmnopqrstuvwxz', 'VCCCVCCCVCCCCCVCCCCCVCCCC')"
    with_y = f"translate(replace(regexp_replace({letters}, '(^|V)y', '$1C'), 'yy', 'VC'), 'y', 'V')"
    return f"CASE WHEN contains({word}, 'y') THEN {with_y} ELSE {letters} END"


def measure(stem_shape: str) -> str:
    return f"regexp_count({stem_shape}, 'VC')"


def _more_than(m: int) -> Condition:
    return lambda stem, stem_shape: f"{measure(stem_shape)} > {m}"


def _short_syllable(stem: str, stem_shape: str) -> str:
    """Ends consonant, vowel, consonant other than w, x, y; or is one vowel and a consonant."""
    closed = f"endswith({stem_shape}, 'CVC') AND NOT {stem} RLIKE '[wxy]$'"
    return f"(({closed}) OR {stem_shape} = 'VC')"


def _without(letters: int, text: str = "c.w") -> str:
    return f"left({text}, length({text}) - {letters})"


def _by_suffix(rules: list[tuple[str, str, Condition | None]]) -> str:
    """The first suffix that matches decides, whether or not its condition holds."""
    branches = []
    for suffix, replacement, condition in rules:
        stem, stem_shape = _without(len(suffix)), _without(len(suffix), "c.s")
        to = f"concat({stem}, '{replacement}')"
        if condition is not None:
            to = f"CASE WHEN {condition(stem, stem_shape)} THEN {to} ELSE c.w END"
        branches.append(f"WHEN endswith(c.w, '{suffix}') THEN {to}")
    return f"CASE {' '.join(branches)} ELSE c.w END"


def _plurals() -> str:
    rules = _by_suffix([("sses", "ss", None), ("ies", "i", None), ("ss", "ss", None), ("s", "", None)])
    return f"CASE WHEN c.w RLIKE '^.ies$' THEN {_without(1)} ELSE {rules} END"


def _past() -> str:
    """Marks what is left to repair after -ed or -ing with a trailing ``+``."""
    def has_vowel(stem: str, stem_shape: str) -> str:
        return f"contains({stem_shape}, 'V')"

    rules = _by_suffix([("eed", "ee", _more_than(0)), ("ed", "+", has_vowel), ("ing", "+", has_vowel)])
    ied = f"CASE WHEN length(c.w) = 4 THEN {_without(1)} ELSE {_without(2)} END"
    return f"CASE WHEN endswith(c.w, 'ied') THEN {ied} ELSE {rules} END"


def _repair() -> str:
    stem, stem_shape = _without(1), _without(1, "c.s")
    double = f"substring(c.w, -2, 1) = substring(c.w, -3, 1) AND endswith({stem_shape}, 'C')"
    short = f"{measure(stem_shape)} = 1 AND {_short_syllable(stem, stem_shape)}"
    return f"""CASE WHEN NOT endswith(c.w, '+') THEN c.w
        WHEN {stem} RLIKE '(?:at|bl|iz)$' THEN concat({stem}, 'e')
        WHEN {double} AND {stem} RLIKE '[lsz]$' THEN {stem}
        WHEN {double} THEN {_without(2)}
        WHEN {short} THEN concat({stem}, 'e')
        ELSE {stem} END"""


def _final_y() -> str:
    def after_consonant(stem: str, stem_shape: str) -> str:
        return f"length({stem}) > 1 AND endswith({stem_shape}, 'C')"

    return _by_suffix([("y", "i", after_consonant)])


def _alli() -> str:
    return _by_suffix([("alli", "al", _more_than(0))])


def _step2() -> str:
    def before_ogi(stem: str, stem_shape: str) -> str:
        return f"{measure(_without(3, 'c.s'))} > 0"

    rules = [(suffix, to, _more_than(0)) for suffix, to in STEP2]
    return _by_suffix([*rules, ("logi", "log", before_ogi)])


def _step3() -> str:
    return _by_suffix([(suffix, to, _more_than(0)) for suffix, to in STEP3])


def _step4() -> str:
    def after_s_or_t(stem: str, stem_shape: str) -> str:
        return f"{measure(stem_shape)} > 1 AND {stem} RLIKE '[st]$'"

    special = {"ion": after_s_or_t}
    return _by_suffix([(suffix, "", special.get(suffix, _more_than(1))) for suffix in STEP4])


def _final_e() -> str:
    def droppable(stem: str, stem_shape: str) -> str:
        m = measure(stem_shape)
        return f"{m} > 1 OR ({m} = 1 AND NOT {_short_syllable(stem, stem_shape)})"

    return _by_suffix([("e", "", droppable)])


def _double_l() -> str:
    long = f"{measure(_without(1, 'c.s'))} > 1"
    return f"CASE WHEN endswith(c.w, 'll') AND {long} THEN {_without(1)} ELSE c.w END"


STEPS = [
    _plurals, _past, _repair, _final_y, _alli, _step2, _step3, _step4, _final_e, _double_l,
]


def english_stem(term: str) -> Column:
    """The stem of the word in a column.

    Each step runs over a one-element array, which names its word: written out, a step would
    repeat the steps before it at every mention.
    """
    word = term
    for step in STEPS:
        shaped = f"transform(array({word}), w -> struct(w AS w, {shape('w')} AS s))"
        word = f"transform({shaped}, c -> {step()})[0]"
    own = ", ".join(f"'{w}', '{stem}'" for w, stem in IRREGULAR.items())
    return F.expr(
        f"coalesce(map({own})[{term}], CASE WHEN length({term}) <= 2 THEN {term} ELSE {word} END)"
    )


def looks_english(term: Column) -> Column:
    return term.rlike(ENGLISH_ENDING)
