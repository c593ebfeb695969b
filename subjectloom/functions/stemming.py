"""English suffix stripping (Porter 1980, with the usual later refinements).

Twice, so that one can be held against the other: ``porter_stem`` for one token, which the
operators use, and plain SQL projections, one per step, for a frame with one row per distinct
token. There column ``w`` is the word so far and ``s`` its *shape*, which spells each letter as
``c`` (consonant) or ``v`` (vowel); the measure of a stem is the number of ``vc`` pairs in it.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame

# Whole words with their own stem.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Suffix -> replacement; of several that a word ends in, the longest decides.
PLURALS = (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", ""))
DOUBLE_SUFFIXES = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
SINGLE_SUFFIXES = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
LONG_STEM_SUFFIXES = (
    ("al", ""), ("ance", ""), ("ence", ""), ("er", ""), ("ic", ""), ("able", ""), ("ible", ""),
    ("ant", ""), ("ement", ""), ("ment", ""), ("ent", ""), ("ion", ""), ("ou", ""), ("ism", ""),
    ("ate", ""), ("iti", ""), ("ous", ""), ("ive", ""), ("ize", ""),
)


def _cut(column: str, letters: int | str) -> str:
    return f"left({column}, length({column}) - {letters})"


def _measure(shape: str) -> str:
    return f"((length({shape}) - length(replace({shape}, 'vc', ''))) / 2)"


def _closed(word: str, shape: str) -> str:
    """Ends consonant-vowel-consonant, the last not w, x or y; or is vowel-consonant."""
    return f"(({shape} LIKE '%cvc' AND right({word}, 1) NOT IN ('w', 'x', 'y')) OR {shape} = 'vc')"


def _shape(word: str) -> str:
    """``y`` is a vowel right after a consonant and a consonant elsewhere."""
    spelled = f"translate(regexp_replace({word}, '[^aeiouy]', 'c'), 'aeiou', 'vvvvv')"
    return f"replace(replace(replace({spelled}, 'cy', 'cv'), 'yy', 'cv'), 'y', 'c')"


def _when(condition: str, word: str, otherwise: str = "w") -> str:
    return f"CASE WHEN {condition} THEN {word} ELSE {otherwise} END"


def _changed(word: str) -> list[dict[str, str]]:
    return [{"w": word}, {"w": "w", "s": _shape("w")}]


def _suffix_step(rules, condition: str, override: tuple[str, str] | None = None):
    """Finds the word's suffix (``x``), then replaces it where the condition on the stem's
    shape (``t``) and letters (``b``) holds."""
    found = "|".join(suffix for suffix, _ in rules)
    table = "".join(f" WHEN '{suffix}' THEN '{new}'" for suffix, new in rules)
    changed = f"CASE WHEN x <> '' AND {condition} THEN concat(b, CASE x{table} END) ELSE w END"
    if override is not None:
        changed = _when(*override, otherwise=changed)
    return [
        {"w": "w", "s": "s", "x": f"regexp_extract(w, '({found})$', 1)"},
        {"w": "w", "s": "s", "x": "x", "b": _cut("w", "length(x)"), "t": _cut("s", "length(x)")},
        *_changed(changed),
    ]


def _past_and_gerund() -> list[dict[str, str]]:
    cut = (
        "CASE WHEN w LIKE '%ied' OR w LIKE '%eed' THEN 0 "
        f"WHEN w LIKE '%ed' AND {_cut('s', 2)} LIKE '%v%' THEN 2 "
        f"WHEN w LIKE '%ing' AND {_cut('s', 3)} LIKE '%v%' THEN 3 ELSE 0 END"
    )
    mended = (
        "CASE WHEN b LIKE '%at' OR b LIKE '%bl' OR b LIKE '%iz' THEN concat(b, 'e') "
        "WHEN length(b) > 1 AND right(b, 2) = concat(right(b, 1), right(b, 1)) AND t LIKE '%c' "
        f"THEN CASE WHEN right(b, 1) IN ('l', 's', 'z') THEN b ELSE {_cut('b', 1)} END "
        f"WHEN {_measure('t')} = 1 AND {_closed('b', 't')} THEN concat(b, 'e') ELSE b END"
    )
    result = (
        f"CASE WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN {_cut('w', 1)} "
        f"ELSE {_cut('w', 2)} END "
        f"WHEN w LIKE '%eed' THEN CASE WHEN {_measure(_cut('s', 3))} > 0 THEN {_cut('w', 1)} "
        f"ELSE w END WHEN n > 0 THEN {mended} ELSE w END"
    )
    return [
        {"w": "w", "s": "s", "n": cut},
        {"w": "w", "s": "s", "n": "n", "b": _cut("w", "n"), "t": _cut("s", "n")},
        *_changed(result),
    ]


def projections() -> list[dict[str, str]]:
    """The steps in order, each as output column -> SQL expression over the previous step."""
    before = _cut("s", 1)
    ends_long = f"{_measure(before)} > 1"
    some = f"{_measure('t')} > 0"
    many = f"{_measure('t')} > 1 AND (x <> 'ion' OR right(b, 1) IN ('s', 't'))"
    logi = (f"w LIKE '%logi' AND {_measure(_cut('s', 3))} > 0", _cut("w", 1))
    return [
        *_changed("lower(token)"),
        *_suffix_step(PLURALS, "true", ("w LIKE '%ies' AND length(w) = 4", _cut("w", 1))),
        *_past_and_gerund(),
        *_changed(_when(f"w LIKE '%y' AND length(w) > 2 AND {before} LIKE '%c'",
                        f"concat({_cut('w', 1)}, 'i')")),
        *_changed(_when(f"w LIKE '%alli' AND {_measure(_cut('s', 4))} > 0", _cut("w", 2))),
        *_suffix_step(DOUBLE_SUFFIXES, some, logi),
        *_suffix_step(SINGLE_SUFFIXES, some),
        *_suffix_step(LONG_STEM_SUFFIXES, many),
        *_changed(_when(
            f"w LIKE '%e' AND ({ends_long} OR "
            f"({_measure(before)} = 1 AND NOT {_closed(_cut('w', 1), before)}))",
            _cut("w", 1),
        )),
        {"w": _when(f"w LIKE '%ll' AND {ends_long}", _cut("w", 1))},
    ]


def final_choice() -> str:
    """Short words and irregular ones bypass the steps."""
    known = " ".join(f"WHEN '{word}' THEN '{stem}'" for word, stem in IRREGULAR.items())
    return (
        f"coalesce(CASE lower(token) {known} END, "
        "CASE WHEN length(token) <= 2 THEN lower(token) ELSE w END)"
    )


def porter_stems(words: DataFrame) -> DataFrame:
    """``(token)`` to ``(token, stem)``. Words of up to two letters stay as they are."""
    df = words.select("token")
    for step in projections():
        df = df.selectExpr("token", *[f"{sql} AS {name}" for name, sql in step.items()])
    return df.selectExpr("token", f"{final_choice()} AS stem")


def _letters(word: str) -> str:
    """The shape of a word: y after a consonant counts as a vowel, else as a consonant."""
    out: list[str] = []
    for c in word:
        if c == "y":
            out.append("v" if out and out[-1] == "c" else "c")
        else:
            out.append("v" if c in "aeiou" else "c")
    return "".join(out)


def _pairs(word: str) -> int:
    return _letters(word).count("vc")


def _is_short(word: str) -> bool:
    shape = _letters(word)
    return shape == "vc" or (shape.endswith("cvc") and word[-1] not in "wxy")


def _longest(word: str, rules) -> tuple[str, str] | None:
    found = [rule for rule in rules if word.endswith(rule[0])]
    return max(found, key=lambda rule: len(rule[0])) if found else None


def _strip(word: str, rules, allowed) -> str:
    rule = _longest(word, rules)
    if rule is None:
        return word
    stem = word[: len(word) - len(rule[0])]
    return stem + rule[1] if allowed(stem, rule[0]) else word


def _without_past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _pairs(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if not word.endswith(suffix):
            continue
        if "v" not in _letters(stem):
            return word
        if stem.endswith(("at", "bl", "iz")):
            return stem + "e"
        if len(stem) > 1 and stem[-1] == stem[-2] and _letters(stem)[-1] == "c":
            return stem if stem[-1] in "lsz" else stem[:-1]
        return stem + "e" if _pairs(stem) == 1 and _is_short(stem) else stem
    return word


@functools.lru_cache(maxsize=1 << 18)
def porter_stem(token: str | None) -> str | None:
    """The stem of one token; words of up to two letters are only lower-cased."""
    if token is None:
        return None
    word = token.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(token) <= 2:
        return word
    if word.endswith("ies") and len(word) == 4:
        word = word[:-1]
    else:
        word = _strip(word, PLURALS, lambda stem, suffix: True)
    word = _without_past(word)
    if word.endswith("y") and len(word) > 2 and _letters(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    if word.endswith("alli") and _pairs(word[:-4]) > 0:
        word = word[:-2]
    if word.endswith("logi") and _pairs(word[:-3]) > 0:
        word = word[:-1]
    else:
        word = _strip(word, DOUBLE_SUFFIXES, lambda stem, suffix: _pairs(stem) > 0)
    word = _strip(word, SINGLE_SUFFIXES, lambda stem, suffix: _pairs(stem) > 0)
    word = _strip(
        word, LONG_STEM_SUFFIXES,
        lambda stem, suffix: _pairs(stem) > 1 and (suffix != "ion" or stem[-1:] in ("s", "t")),
    )
    before = word[:-1]
    if word.endswith("e") and (
        _pairs(before) > 1 or (_pairs(before) == 1 and not _is_short(before))
    ):
        word = before
    return word[:-1] if word.endswith("ll") and _pairs(word[:-1]) > 1 else word
