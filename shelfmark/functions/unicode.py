"""Accent folding and compatibility normalisation, both in the JVM."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import let

HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3


def _bases(ch: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", ch) if not unicodedata.combining(c))


def fold_text(text: str) -> str:
    """Driver-side folding of a search term: accents off, lower case."""
    return _bases(text).lower()


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """The folding tables, derived from the Unicode character database.

    Returns (accented letters, then combining marks; the letters' bases; letters with several bases).
    ``translate`` drops what has no counterpart, so the marks need none.
    """
    source, target, several, marks = [], [], {}, []
    for point in range(0x80, 0x110000):
        ch = chr(point)
        if unicodedata.combining(ch):
            marks.append(ch)
        elif not HANGUL_FIRST <= point <= HANGUL_LAST:
            decomposition = unicodedata.decomposition(ch)
            if decomposition and not decomposition.startswith("<"):
                base = _bases(ch)
                if len(base) == 1:
                    source.append(ch)
                    target.append(base)
                else:
                    several[ch] = base
    return "".join(source + marks), "".join(target), several


def _hangul_class(position: str, index: int) -> str:
    """Syllables that share a vowel (28 in a row for each lead) or a tail (one in 28)."""
    if position == "vowel":
        starts = range(HANGUL_FIRST + index * 28, HANGUL_LAST + 1, 588)
        return "[" + "".join(f"{chr(s)}-{chr(s + 27)}" for s in starts) + "]"
    return "[" + "".join(chr(s) for s in range(HANGUL_FIRST + index, HANGUL_LAST + 1, 28)) + "]"


def _fold_hangul(c: Column) -> Column:
    """Syllable -> lead, vowel, tail letters: append the tail, then the vowel, then keep the lead."""
    for tail in range(1, 28):
        c = F.regexp_replace(c, f"({_hangul_class('tail', tail)})", "$1" + chr(0x11A7 + tail))
    for vowel in range(21):
        c = F.regexp_replace(c, f"({_hangul_class('vowel', vowel)})", "$1" + chr(0x1161 + vowel))
    syllables = range(HANGUL_FIRST, HANGUL_LAST + 1)
    leads = "".join(chr(0x1100 + (s - HANGUL_FIRST) // 588) for s in syllables)
    return F.translate(c, "".join(map(chr, syllables)), leads)


def fold_accents(c: Column) -> Column:
    """Canonical decomposition with every combining mark dropped, as native expressions.

    ASCII text is left alone, European text takes one pass of ``translate``. The scripts that need
    more than a letter-to-letter table sit behind one range test.
    """
    source, target, several = _fold_tables()
    wide = f"[{min(several)}-\\x{{10ffff}}]"

    def widened(x: Column) -> Column:
        for ch, base in several.items():
            x = F.replace(x, F.lit(ch), F.lit(base))
        return let(x, lambda y: F.when(y.rlike("[가-힣]"), _fold_hangul(y)).otherwise(y))

    def folded(x: Column) -> Column:
        simple = F.translate(x, source, target)
        rich = F.translate(widened(x), source, target)
        return F.when(~x.rlike(r"[^\x00-\x7F]"), x).when(x.rlike(wide), rich).otherwise(simple)

    return let(c, folded)


def nfkc(c: Column) -> Column:
    """Compatibility composition by the Unicode library that Spark ships for its collations.

    ``try_reflect`` calls it in the JVM, for non-ASCII values only; ASCII is never changed.
    """
    compose = F.try_reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    return F.when(c.rlike(r"[^\x00-\x7F]"), compose).otherwise(c)
