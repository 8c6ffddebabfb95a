"""Silver tables to the unified and the normalised catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import fixed
from shelfmark.functions import normalize as n
from shelfmark.operators.dense import assign_ids
from shelfmark.operators.shape import align_schema, clean_strings
from shelfmark.operators.unify import SourceLabels, exclude_ids, mark_duplicates, union_sources


def unify_catalog(
    museum: DataFrame,
    library: DataFrame,
    row_key: str = "record_id",
    labels: SourceLabels = SourceLabels(),
    excluded: Sequence[str] = (),
    with_ids: bool = False,
) -> DataFrame:
    """Both sources in one table: exclusions, duplicate marks, aligned and cleaned columns.

    ``with_ids`` numbers the records 1..n, library first, by row key.
    """
    museum, library = exclude_ids(museum, excluded), exclude_ids(library, excluded)
    union = union_sources({labels.library: mark_duplicates(library, museum, row_key), labels.museum: museum})
    if with_ids:
        source_order = F.when(F.col("source_system") == labels.library, 0).otherwise(1)
        union = assign_ids(union, [source_order, F.col(row_key).asc_nulls_last(), F.col("field_identifier"), F.col("title")])
    return clean_strings(align_schema(union))


DATE_COLUMNS = ("field_edtf_date_created", "original_date")


def normalize_catalog(unified: DataFrame) -> DataFrame:
    """Normalised vocabulary, derived years and decades, search text. One narrow pass."""
    present = set(unified.columns)
    cleaners = {
        "field_genre": n.normalize_genre,
        "field_subject": n.normalize_subject,
        "title": n.normalize_title,
        "field_linked_agent": n.normalize_creator,
        "field_place_published": n.normalize_place,
    }
    df = unified.withColumns({c: f(F.col(c)) for c, f in cleaners.items() if c in present})
    dates = [c for c in DATE_COLUMNS if c in present]
    df = df.withColumns({f"{c}_year": n.extract_year(F.col(c)) for c in dates})
    df = df.withColumns({f"{c}_decade": n.decade_of(F.col(f"{c}_year")) for c in dates})
    if DATE_COLUMNS[0] in present:
        df = df.withColumns(
            {"year_created": F.col(f"{DATE_COLUMNS[0]}_year"), "decade_created": F.col(f"{DATE_COLUMNS[0]}_decade")}
        )
    return df.withColumn("search_text", n.search_text([F.col(c) for c in fixed.SEARCH_COLUMNS if c in present]))
