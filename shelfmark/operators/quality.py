"""Quality rules, quarantine, run metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfmark.functions.text import has_text

Rule = tuple[str, Column]  # message, true where the record fails


def basic_rules(df: DataFrame) -> list[Rule]:
    """A record needs an identifier (or access number) and a title."""
    identifier = "field_identifier" if "field_identifier" in df.columns else "access_nbr"
    return [
        ("Identifier is missing", ~has_text(F.col(identifier))),
        ("Title is missing", ~has_text(F.col("title"))),
    ]


def full_rules() -> list[Rule]:
    """Title, identifier, genre plus one of date/creator/country, and clean agents."""
    described = (
        has_text(F.col("field_edtf_date_created"))
        | has_text(F.col("field_linked_agent"))
        | has_text(F.col("field_place_published"))
    )
    return [
        ("Title is missing", ~has_text(F.col("title"))),
        ("Identifier is missing", ~has_text(F.col("field_identifier"))),
        (
            "Required fields missing (Genre and one of Date/Creator/Country)",
            ~(has_text(F.col("field_genre")) & described),
        ),
        (
            "Underscores found in processed linked agent field",
            F.coalesce(F.col("field_linked_agent").contains("_"), F.lit(False)),
        ),
    ]


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``qa_errors`` (messages joined with `` | ``) and ``qa_pass``."""
    errors = F.array_compact(F.array(*[F.when(failed, F.lit(message)) for message, failed in rules]))
    return df.withColumn("qa_errors", F.array_join(errors, " | ")).withColumn("qa_pass", F.col("qa_errors") == "")


def split_quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed, quarantined)."""
    return checked.where("qa_pass"), checked.where("NOT qa_pass")


def qa_gate(df: DataFrame) -> DataFrame:
    """Drop records that failed; records never checked pass."""
    if "qa_pass" not in df.columns:
        return df
    return df.where(F.coalesce(F.lower(F.col("qa_pass").cast("string")), F.lit("")) != "false")


def observe_counts(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """Count rows (and rows per condition) while ``df`` is written, without a second pass."""
    observation = Observation(name)
    counts = [F.count_if(condition).alias(metric) for metric, condition in conditions.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts), observation


def run_metrics(df: DataFrame, run_id: str, **conditions: Column) -> DataFrame:
    """(``run_id``, ``metric``, ``value``) rows from one pass."""
    counts = {"rows": F.count(F.lit(1)), **{m: F.count_if(c) for m, c in conditions.items()}}
    totals = df.agg(*[c.alias(m) for m, c in counts.items()])
    return totals.select(F.lit(run_id).alias("run_id"), *counts).unpivot(
        "run_id", list(counts), "metric", "value"
    )
