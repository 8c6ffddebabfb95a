"""Text cleaning: white space, nulls, literal replacement, joins of columns and lists."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.fixed import WHITE_SPACE


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Remove white space from both ends. (One parameter only: a second one would receive the
    index when this is used as the lambda of ``transform``.)"""
    return F.trim(c, F.lit(WHITE_SPACE))


def strip_chars(c: Column, chars: str) -> Column:
    """Remove any of ``chars`` from both ends."""
    return F.trim(c, F.lit(chars))


def rstrip_chars(c: Column, chars: str) -> Column:
    return F.rtrim(c, F.lit(chars))


def blank_to_null(c: Column) -> Column:
    """Strip; nothing left means null."""
    return F.nullif(strip(c), F.lit(""))


def null_clean(c: Column, null_tokens: Sequence[str] = ()) -> Column:
    """Strip; blank text and the given tokens become null."""
    clean = blank_to_null(c.cast("string"))
    return F.when(clean.isin(list(null_tokens)), None).otherwise(clean) if null_tokens else clean


def has_text(c: Column) -> Column:
    """True where there is something besides white space."""
    return F.coalesce(strip(c) != "", F.lit(False))


def replace_all(c: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal replacements, one after another."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def split_literal(c: Column, delimiter: str) -> Column:
    """Split on a literal delimiter (``split`` takes a regex)."""
    return F.split(c, "".join(f"[{ch}]" for ch in delimiter) if delimiter.strip() else delimiter)


def split_values(c: Column, delimiter: str = "|") -> Column:
    """Split, strip every part, drop the blank ones."""
    return F.filter(F.transform(split_literal(c, delimiter), strip), lambda p: p != "")


def parse_delimited(c: Column, delimiter: str = "|") -> Column:
    """Display list: parts stripped, blanks dropped, first of equal parts kept, in order."""
    return F.array_distinct(F.coalesce(split_values(c, delimiter), F.array().cast("array<string>")))


def parse_subjects(c: Column) -> Column:
    """As ``parse_delimited``, with ``;`` as the delimiter wherever the text has one."""
    return F.when(c.contains(";"), parse_delimited(c, ";")).otherwise(parse_delimited(c, "|"))


def merge_columns(columns: Sequence[Column], joiner: str = " | ") -> Column:
    """The non-blank columns, stripped and joined; null when there is none."""
    return F.nullif(F.concat_ws(joiner, *[blank_to_null(c) for c in columns]), F.lit(""))


def compose_title(main: Column, rest: Column) -> Column:
    """Title and remainder with one space between."""
    return strip(F.concat(F.coalesce(main, F.lit("")), F.lit(" "), F.coalesce(rest, F.lit(""))))


def compose_extent(*parts: Column) -> Column:
    """Parts joined with commas, without the commas of missing parts."""
    joined = F.concat_ws(", ", *[F.coalesce(p, F.lit("")) for p in parts])
    return strip(strip_chars(F.regexp_replace(joined, r",\s*,", ","), ", "))


def title_cut(c: Column, marker: str = " __ __ __") -> Column:
    """Title without its trailing filler."""
    return F.substring_index(c, marker, 1)


def place_delimiter(c: Column) -> Column:
    return F.replace(c, F.lit("__"), F.lit("|"))


def subject_delimiter(c: Column) -> Column:
    """``a--b`` -> ``subject:a|subject:b``; blank or null -> empty."""
    tagged = F.concat(F.lit("subject:"), F.replace(c, F.lit("--"), F.lit("|subject:")))
    return F.when(has_text(c), tagged).otherwise(F.lit(""))


def form_delimiter(c: Column) -> Column:
    return F.replace(c, F.lit("||"), F.lit("|"))
