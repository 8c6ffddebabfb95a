"""Query registry and the gold catalogue the registered queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sql
from checks.views import view
from shelfmark.functions import silver, text
from shelfmark.operators.media import media_counts
from shelfmark.operators.shape import spread
from shelfmark.plans.gold import normalize_catalog, unify_catalog
from shelfmark.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, uses: str = "", body: str | None = None):
    """Register a query and, with ``body``, its oracle SQL."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if body is not None:
            ORACLES[name] = sql.oracle(uses, body)
        return fn

    return register


def museum(spark: SparkSession, sf: str) -> DataFrame:
    """Museum view with the silver field rules applied."""
    c = F.col
    return spread(view(spark, sf, "mus")).withColumns(
        {
            "id": c("record_id") * 2 + 1,
            "title": text.title_cut(c("title")),
            "field_linked_agent": silver.agent_roles(c("field_linked_agent"), sql.ROLES),
            "field_edtf_date_created": silver.edtf_date(c("original_date")),
            "field_place_published": text.place_delimiter(c("field_place_published")),
            "field_credit_line": silver.credit_line(c("field_credit_line"), sql.CREDIT),
            "field_extent": silver.clean_extent(c("field_extent")),
        }
    )


def library(spark: SparkSession, sf: str) -> DataFrame:
    """Library view with the silver field rules applied."""
    date = silver.marc_date(F.col("new_264_c"), F.col("new_260_c"))
    df = view(spark, sf, "lib").withColumns({"id": F.col("record_id") * 2, "field_edtf_date_created": date})
    return df.drop("new_264_c", "new_260_c")


def unified(spark: SparkSession, sf: str, with_ids: bool = False) -> DataFrame:
    return unify_catalog(museum(spark, sf), library(spark, sf), excluded=sql.EXCLUDED, with_ids=with_ids)


def gold_plan(spark: SparkSession, sf: str, with_ids: bool = False) -> DataFrame:
    """Normalised catalogue with media counts, computed from the driver's tables."""
    normalized = normalize_catalog(unified(spark, sf, with_ids))
    counted = media_counts(normalized, view(spark, sf, "media"), "id")
    return counted.withColumns({"audio_count": F.lit(0), "has_audio": F.lit(False)})


def gold(spark: SparkSession, sf: str) -> DataFrame:
    """The gold catalogue as dashboards and search read it, computed from the driver's tables.

    It is a plan: a query over few columns and records prunes the rest of the build.
    """
    return gold_plan(spark, sf)
