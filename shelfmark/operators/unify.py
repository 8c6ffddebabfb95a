"""Union of the silver sources and duplicate marks across them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.identifiers import has_any_part, split_ids
from shelfmark.functions.text import strip
from shelfmark.operators.merge import lookup_join


@dataclass(frozen=True)
class SourceLabels:
    """Values of ``source_system``. Pass your own systems' names to keep existing values."""

    museum: str = "Museum"
    library: str = "Library"


def exclude_ids(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Drop records with any identifier part in ``ids``."""
    return df.where(~has_any_part(F.col("field_identifier"), ids)) if ids else df


def union_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Union by name, missing columns null, every row tagged with its source."""
    tagged = [df.withColumn("source_system", F.lit(label)) for label, df in sources.items()]
    union = tagged[0]
    for df in tagged[1:]:
        union = union.unionByName(df, allowMissingColumns=True)
    return union


def identifier_parts(df: DataFrame, *keep: str) -> DataFrame:
    """One row per identifier part, as ``match_id`` (lower case), with the columns to keep."""
    parts = F.transform(split_ids(F.col("field_identifier")), F.lower)
    return df.select(*keep, F.explode(parts).alias("match_id"))


def mark_duplicates(library: DataFrame, museum: DataFrame, row_key: str) -> DataFrame:
    """Append ``_dup_<row key>`` to library identifier parts that the museum also has.

    Only (identifier, part) travels for the match; the records meet just the identifiers that have a
    duplicate, usually few. Records without a row key are marked too, with an empty key.
    """
    held = identifier_parts(museum).distinct()
    asked = identifier_parts(library, "field_identifier").distinct()
    shared = lookup_join(asked, held, ["match_id"], "left_semi")
    # bounded by the number of parts of one identifier
    shared = shared.groupBy("field_identifier").agg(F.collect_set("match_id").alias("_shared"))
    joined = lookup_join(library, shared, ["field_identifier"], "left")

    suffix = F.concat(F.lit("_dup_"), F.coalesce(F.col(row_key).cast("string"), F.lit("")))
    parts = F.transform(
        F.split("field_identifier", ";"),
        lambda p: F.when(
            F.array_contains(F.col("_shared"), F.lower(strip(p))), F.concat(strip(p), suffix)
        ).otherwise(strip(p)),
    )
    marked = joined.withColumn("field_identifier", F.array_join(parts, "; "))
    return marked.select(*library.columns)
