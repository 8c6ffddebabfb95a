"""Accession numbers: normal forms, multi-part lists, media file names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.fixed import WHITE_SPACE_CLASS
from shelfmark.functions.text import split_values, strip, strip_chars
from shelfmark.functions.unicode import nfkc


def _dotted(c: Column) -> Column:
    spaced = F.regexp_replace(c, r"[()\[\]'_]", " ")
    return strip_chars(F.regexp_replace(spaced, f"[.{WHITE_SPACE_CLASS},-]+", "."), ".")


def normalize_identifier(c: Column, compatibility: bool = True) -> Column:
    """Lower case, brackets and quotes out, runs of separators to one dot.

    ``compatibility`` applies NFKC first (full-width digits and the like); switch it off where
    the identifiers are known to be ASCII.
    """
    return _dotted(F.lower(nfkc(c) if compatibility else c))


def normalize_name(c: Column) -> Column:
    """Folder and file names: as identifiers without NFKC; null gives empty text."""
    return F.coalesce(_dotted(strip(F.lower(c))), F.lit(""))


def legacy_media_name(c: Column) -> Column:
    """The dotted file name older media runs used."""
    return strip_chars(F.regexp_replace(c, f"[.{WHITE_SPACE_CLASS},-]+", "."), ".")


def simple_key(c: Column) -> Column:
    """Lower case and stripped, blank -> null: the key of the catalogue comparisons."""
    return F.nullif(F.lower(strip(c.cast("string"))), F.lit(""))


def split_ids(c: Column) -> Column:
    """The parts of ``a; b; c``, stripped, blanks dropped."""
    return split_values(c, ";")


def primary_id(c: Column) -> Column:
    """The first part."""
    return strip(F.substring_index(c, ";", 1))


def media_name(c: Column) -> Column:
    """File-system-safe form of one identifier part."""
    return F.regexp_replace(strip(c), "[^a-zA-Z0-9.-]", "_")


def media_filename(c: Column) -> Column:
    """File name of a record's media: its first part, made safe; null gives empty text."""
    return F.coalesce(media_name(primary_id(c)), F.lit(""))


def has_part(c: Column, wanted: str) -> Column:
    """True where ``wanted`` is one of the parts."""
    return F.coalesce(F.array_contains(F.transform(F.split(c, ";"), strip), F.lit(wanted)), F.lit(False))


def has_any_part(c: Column, wanted: Sequence[str]) -> Column:
    """True where any part is in ``wanted``; null identifiers have none."""
    parts = F.transform(F.split(c, ";"), strip)
    return F.coalesce(F.arrays_overlap(parts, F.array(*[F.lit(w) for w in wanted])), F.lit(False))


def media_parts(c: Column) -> Column:
    """The parts with their position: ``array<struct<pos, part>>``."""
    return F.transform(split_ids(c), lambda p, i: F.struct(i.alias("pos"), p.alias("part")))
