"""Gold-layer vocabulary: genre, subject, creator, title, place, year, search text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.fixed import CREATOR_ALIASES, GENRES, UNKNOWN_PLACES, WHITE_SPACE_CLASS, YEAR_PATTERN
from shelfmark.functions.text import has_text, let, rstrip_chars, split_literal, strip, strip_chars
from shelfmark.functions.unicode import fold_accents


def _lookup(table: Mapping[str, str], key: Column) -> Column:
    """``table[key]``, or ``key`` itself where the table has no such entry."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), key)


def _usable(c: Column) -> Column:
    return has_text(c) & (F.lower(c) != "none")


def normalize_genre(c: Column, vocabulary: Mapping[str, str] = GENRES) -> Column:
    """Upper case, one trailing mark off, then the vocabulary's label if it has one."""
    label = strip(F.regexp_replace(F.upper(strip(c)), r"[.,;:!]$", ""))
    return F.when(_usable(c), let(label, lambda key: _lookup(vocabulary, key)))


def normalize_subject(c: Column) -> Column:
    """Each heading without trailing dots and ``subject:`` prefix, joined with `` | ``."""
    headings = F.transform(
        split_literal(c, "|"), lambda p: strip(F.regexp_replace(rstrip_chars(strip(p), "."), "(?i)^subject:", ""))
    )
    return F.when(_usable(c), F.array_join(F.filter(headings, lambda h: h != ""), " | "))


def normalize_creator(c: Column, aliases: Mapping[str, str] = CREATOR_ALIASES) -> Column:
    """Names out of ``relators:code:person:Name``, trailing marks off, spelling variants merged."""
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])

    def name(agent: Column) -> Column:
        agent = strip(agent)
        coded = F.regexp_extract(agent, r"(?s)^relators:[^:]*:person:(.*)$", 1)
        plain = F.when(agent.rlike(r"^relators:[^:]*:person:"), strip(coded)).otherwise(agent)
        plain = rstrip_chars(plain, ".,;")
        return F.coalesce(F.try_element_at(table, F.lower(plain)), plain)

    names = F.transform(split_literal(F.replace(c, F.lit("||"), F.lit("|")), "|"), name)
    return F.when(has_text(c), F.nullif(F.array_join(F.filter(names, lambda n: n != ""), " | "), F.lit("")))


def normalize_title(c: Column) -> Column:
    return F.when(has_text(c), rstrip_chars(strip(c), "."))


def normalize_place(c: Column) -> Column:
    """Brackets and trailing marks off; texts that say "not known" -> ``Unknown``; ``|`` -> comma."""
    bare = F.regexp_replace(strip(c), r'^\[?"?\[?', "")
    bare = F.regexp_replace(bare, rf"[\]\"'.,;:!?{WHITE_SPACE_CLASS}]+$", "")

    def place(text: Column) -> Column:
        unknown = text.isin("", "?", "-")
        for phrase in UNKNOWN_PLACES:
            unknown = unknown | F.lower(text).contains(phrase)
        listed = F.replace(F.replace(text, F.lit(" |"), F.lit(", ")), F.lit("|"), F.lit(", "))
        listed = strip_chars(F.regexp_replace(listed, rf",[{WHITE_SPACE_CLASS}]*,", ","), " ,")
        return F.when(unknown, "Unknown").otherwise(listed)

    return F.when(has_text(c), let(bare, place))


def extract_year(c: Column) -> Column:
    """First stand-alone year 1500-2029, null if there is none."""
    word = r"[\p{L}\p{N}_]"
    return F.nullif(F.regexp_extract(c, f"(?<!{word})({YEAR_PATTERN})(?!{word})", 1), F.lit("")).cast("bigint")


def decade_of(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("bigint")


def search_text(columns: Sequence[Column]) -> Column:
    """Columns joined with spaces (null = empty), accents off, lower case."""
    return F.lower(fold_accents(F.concat_ws(" ", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])))
