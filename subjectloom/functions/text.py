"""The text-cleaning chain as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space, and as part of a word, in Unicode terms.
# Both classes mean the same in Java regular expressions and in RE2.
SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"

# The white space characters themselves, for trimming.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# URL and number patterns.
URL_PATTERN = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
NUMBER_PATTERN = rf"(?=\p{{Nd}})(?<![{WORD}])\p{{Nd}}+(?:\.\p{{Nd}}+)?(?![{WORD}])"

# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Quotation marks that stand as tokens of their own.
QUOTES = "«»“”‘’„"

# Fused words that are two tokens.
FUSED_WORDS = (
    ("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"),
)

# English stop words. Entries with an apostrophe are left out, for punctuation
# is deleted before the list is used and they could never match.
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now d ll m o re
ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn
weren won wouldn
""".split())

_FUSED_PATTERN = (
    rf"(?=[cglw])(?<![{WORD}])(?:"
    + "|".join(f"{a}(?={b}(?![{WORD}]))" for a, b in FUSED_WORDS)
    + ")"
)


def strip(text: Column) -> Column:
    """White space of any kind off both ends."""
    return F.btrim(text, F.lit(BLANKS))


def lowercase(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL_PATTERN, " ")


def strip_numbers(text: Column) -> Column:
    """Standing numbers become a space; digits inside a word (``12th``) stay."""
    return F.regexp_replace(text, NUMBER_PATTERN, " ")


def strip_punctuation(text: Column) -> Column:
    """ASCII punctuation is deleted, so ``state-of-the-art`` becomes one word."""
    return F.translate(text, PUNCTUATION, "")


def _part_fused_words(text: Column) -> Column:
    return F.regexp_replace(text, _FUSED_PATTERN, "$0 ")


def _is_word(token: Column, stop_words: Sequence[str]) -> Column:
    alphabetic = token.rlike(r"^\p{L}+$")
    return alphabetic & ~token.isin(list(stop_words)) if stop_words else alphabetic


def _pieces(text: Column) -> Column:
    return F.split(text, f"[{SPACE}]+")


def tokenize(text: Column) -> Column:
    spaced = F.regexp_replace(text, f"[{QUOTES}]", " $0 ")
    return F.filter(_pieces(_part_fused_words(spaced)), lambda t: t != "")


def keep_words(tokens: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Alphabetic tokens that are not stop words, in order, repeats kept."""
    return F.filter(tokens, lambda t: _is_word(t, stop_words))


def drop_short(tokens: Column, min_length: int = 2) -> Column:
    return F.filter(tokens, lambda t: F.length(t) >= min_length)


def bare_text(text: Column) -> Column:
    """Lower case without URLs, numbers or punctuation."""
    return strip_punctuation(strip_numbers(strip_urls(lowercase(text))))


def _raw_words(text: Column) -> Column:
    """What ``tokenize(bare_text(text))`` gives, but for the quotation marks and blanks that
    the word filter would drop: deleting punctuation and blanking quotes is one translation."""
    unquoted = F.translate(
        strip_numbers(strip_urls(lowercase(text))), QUOTES + PUNCTUATION, " " * len(QUOTES)
    )
    return _pieces(_part_fused_words(unquoted))


def word_tokens(text: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """The tokens that a stemmer or lemma table is applied to."""
    return F.filter(_raw_words(text), lambda t: _is_word(t, stop_words))


def normalize_text(
    text: Column,
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    min_length: int = 2,
) -> Column:
    """The whole chain without stemming: null becomes the empty string."""
    kept = F.filter(
        _raw_words(text), lambda t: (F.length(t) >= min_length) & _is_word(t, stop_words)
    )
    return F.array_join(kept, " ")
