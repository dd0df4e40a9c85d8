"""Column expressions over text."""

from __future__ import annotations

import re
from functools import reduce

from string import ascii_letters, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = r"[ \t\n\x0B\f\r]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def letter_key(word: Column | str) -> Column:
    """The letters of ``word`` in code-point order; case is kept."""
    return F.array_join(F.sort_array(F.split(_col(word), "")), "")


def tokens(text: Column | str) -> Column:
    """Tokens between whitespace; a leading gap gives an empty first token, trailing gaps give none."""
    return F.split(F.regexp_replace(_col(text), WHITESPACE + "$", ""), WHITESPACE)


def words_of(text: Column | str) -> Column:
    """Tokens between whitespace, without empty ones."""
    return F.filter(tokens(text), lambda t: t != "")


def flatten_newlines(text: Column | str) -> Column:
    return F.translate(_col(text), "\n", " ")


def before_mention(text: Column | str) -> Column:
    """``text`` up to the first token that starts with ``@``; all of it when none does."""
    whole = _col(text)
    cut = F.regexp_replace(whole, r"(?s)(^|[ \t\n\x0B\f\r])@.*", "")
    return F.when(F.contains(whole, F.lit("@")), cut).otherwise(whole)


def _without_ascii(text: Column, kept: str) -> Column:
    """``text`` without the ASCII characters that are neither in ``kept`` nor whitespace."""
    dropped = "".join(c for c in map(chr, range(128)) if c not in kept and c not in " \t\n\x0b\f\r")
    return F.translate(text, dropped, "")


def ascii_words_only(text: Column | str) -> Column:
    """``text`` reduced to ASCII letters, digits, hyphens and whitespace.

    A table lookup per character; a pattern with the same class takes five times as long.
    """
    return F.regexp_replace(_without_ascii(_col(text), ascii_letters + digits + "-"), r"[^\x00-\x7F]+", "")


def letters_only(text: Column | str) -> Column:
    """``text`` reduced to letters of any script and whitespace."""
    return F.regexp_replace(_without_ascii(_col(text), ascii_letters), r"[^\x00-\x7F\p{L}]+", "")


def clean_words(text: Column | str) -> Column:
    """Lower-cased tokens of ASCII letters, digits and hyphens; some may be empty."""
    return F.split(F.lower(ascii_words_only(text)), WHITESPACE)


def matches_any_keyword(text: Column | str, keywords: list[str]) -> Column:
    """True when, for some keyword, all of its words occur in ``text``; case does not matter.

    Keywords are cut into words as the text is; one without a letter or digit matches nothing.
    """
    phrases = [[w for w in re.split("[^a-z0-9]+", phrase.lower()) if w] for phrase in keywords]
    once = F.array(F.split(F.lower(_col(text)), "[^a-z0-9]+"))  # one item, so the text is cut once per row

    def hit(found: Column) -> Column:
        tests = [F.size(F.array_except(F.array(*map(F.lit, words)), found)) == 0 for words in phrases if words]
        return reduce(Column.__or__, tests, F.lit(False))

    return F.exists(once, hit)


def contains_any(text: Column | str, tags: Column) -> Column:
    """True when the lower-cased ``text`` contains one of the lower-cased ``tags``."""
    once = F.array(F.lower(_col(text)))  # one item, so the text is lowered once per row
    return F.exists(once, lambda low: F.exists(tags, lambda t: F.contains(low, t)))
