"""Gap, comparison and duplicate reports between catalogues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.identifiers import normalize_identifier, simple_key
from shelfmark.functions.similarity import jaro_winkler
from shelfmark.operators.dense import assign_ids
from shelfmark.operators.merge import keep_one, lookup_join, spread_nulls
from shelfmark.operators.unify import SourceLabels, identifier_parts


def _published_keys(published: DataFrame) -> DataFrame:
    """Distinct normal-form identifiers of the public archive."""
    key = normalize_identifier(F.col("field_identifier"))
    return published.where("field_identifier IS NOT NULL").select(key.alias("norm_id")).distinct()


def gap_report(catalog: DataFrame, published: DataFrame, row_key: str) -> DataFrame:
    """Records that are not published, by normal form of the identifier.

    A catalogue without ``field_identifier`` is compared by ``access_nbr``, which then gets that name.
    Records without an identifier count as missing; their keys are spread so that they do not
    pile up in one join task.
    """
    if "field_identifier" not in catalog.columns:
        catalog = catalog.withColumnRenamed("access_nbr", "field_identifier")
    key = spread_nulls(normalize_identifier(F.col("field_identifier")), F.col(row_key))
    keyed = catalog.withColumn("norm_id", key)
    return lookup_join(keyed, _published_keys(published), ["norm_id"], "left_anti").drop("norm_id")


def numbered_gap(gap: DataFrame, row_key: str = "id") -> DataFrame:
    """The gap report with dense ids of its own, 1..n, in the order of the old ones."""
    renamed = gap.withColumnRenamed(row_key, "_catalog_id")
    return assign_ids(renamed, [F.col("_catalog_id").asc_nulls_last()], row_key).drop("_catalog_id")


def compare_left(records: DataFrame, published: DataFrame, row_key: str) -> DataFrame:
    """Records with ``exists``: ``both`` if published, else ``left_only``."""
    key = spread_nulls(normalize_identifier(F.col("field_identifier")), F.col(row_key))
    found = _published_keys(published).withColumn("_found", F.lit(True))
    joined = lookup_join(records.withColumn("norm_id", key), found, ["norm_id"], "left")
    exists = F.when(F.col("_found"), "both").otherwise("left_only").alias("exists")
    return joined.select(*records.columns, exists)


def _first_per_key(df: DataFrame, order: Sequence[str], *keep: str) -> DataFrame:
    keyed = df.select(simple_key(F.col("field_identifier")).alias("norm_id"), *keep, *order).where("norm_id IS NOT NULL")
    first = keep_one(keyed, [F.col("norm_id")], [F.col(c).asc_nulls_last() for c in order], collapse_null_keys=True)
    return first.select("norm_id", *keep)


def compare_full(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Full comparison by lower-case identifier, one row per identifier on either side."""
    a = _first_per_key(left, left_order, "field_identifier", "title")
    b = _first_per_key(right, right_order, "field_identifier", "title")
    a = a.select("norm_id", F.col("field_identifier").alias("_left_id"), F.col("title").alias("_left_title"), F.lit(True).alias("_left"))
    b = b.select("norm_id", F.col("field_identifier").alias("_right_id"), F.col("title").alias("_right_title"), F.lit(True).alias("_right"))

    def yes(flag: str):
        return F.when(F.col(flag), "Yes").otherwise("No")

    def text(name: str):
        return F.coalesce(F.col(name), F.lit(""))

    status = F.when(F.col("_left") & F.col("_right"), "Match").when(F.col("_left"), "MARC Only").otherwise("API Only")
    return a.join(b, "norm_id", "full_outer").select(
        F.col("norm_id").alias("normalized_id"),
        status.alias("status"),
        yes("_left").alias("in_marc"),
        text("_left_id").alias("marc_id"),
        text("_left_title").alias("marc_title"),
        yes("_right").alias("in_api"),
        text("_right_id").alias("api_id"),
        text("_right_title").alias("api_title"),
    )


def compare_titles(
    left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str], threshold: float = 0.4
) -> DataFrame:
    """One row of counts: identifiers on one side only, and shared ones with like or unlike titles.

    The similarity is computed only where both sides exist and their titles differ.
    """
    a = _first_per_key(left, left_order, "title").select("norm_id", F.lower("title").alias("_a"), F.lit(True).alias("_left"))
    b = _first_per_key(right, right_order, "title").select("norm_id", F.lower("title").alias("_b"), F.lit(True).alias("_right"))
    differ = F.col("_left") & F.col("_right") & (F.col("_a") != F.col("_b"))
    joined = a.join(b, "norm_id", "full_outer").select(
        "_left", "_right", "_a", "_b", jaro_winkler(F.when(differ, F.col("_a")), F.when(differ, F.col("_b"))).alias("_score")
    )
    alike = (F.col("_score") >= threshold) | ((F.col("_a") == F.col("_b")) & (F.col("_a") != ""))
    both = F.col("_left") & F.col("_right")
    status = joined.select(
        F.when(both, F.when(alike, "Match").otherwise("Mismatch")).when(F.col("_left"), "left").otherwise("right").alias("s")
    )
    matches = F.count_if(F.col("s") == "Match")
    percent = F.round(matches * F.lit(100.0) / F.nullif(F.count("*"), F.lit(0)), 0).cast("int")
    return status.agg(
        F.count_if(F.col("s") == "right").alias("archive_only"),
        F.count_if(F.col("s") == "left").alias("library_only"),
        matches.alias("match"),
        F.count_if(F.col("s") == "Mismatch").alias("mismatch"),
        F.count("*").alias("total"),
        percent.alias("match_pct"),
    )


def duplicates_report(museum: DataFrame, library: DataFrame, labels: SourceLabels = SourceLabels()) -> DataFrame:
    """Identifier parts both sources hold, with the records that hold them."""
    sides = {labels.museum: museum, labels.library: library}
    tagged = [df.select("field_identifier", "title", F.lit(label).alias("source_system")) for label, df in sides.items()]
    parts = identifier_parts(tagged[0].unionByName(tagged[1]), "source_system", "field_identifier", "title")
    held = parts.groupBy("match_id").agg(F.min("source_system").alias("_low"), F.max("source_system").alias("_high"))
    shared = held.where("_low <> _high").select("match_id")
    report = lookup_join(parts, shared, ["match_id"], "left_semi")
    report = report.select("match_id", "source_system", "field_identifier", "title")
    return report.orderBy(F.asc("match_id"), F.desc("source_system"), "field_identifier", "title")
