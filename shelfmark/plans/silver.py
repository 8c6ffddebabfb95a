"""Raw extracts to silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import fixed
from shelfmark.functions import silver as rules
from shelfmark.functions import text
from shelfmark.operators.inventory import inventory_join
from shelfmark.operators.shape import add_constants, clean_strings, rename_columns

DEFAULT_CREDIT = "Museum Collection"


def read_role_vocabulary(vocabulary: DataFrame) -> list[tuple[str, str]]:
    """Ordered (role, code) list from a table with ``rank``, ``role``, ``code``.

    The vocabulary is a code list of a cataloguing standard (some hundred entries) and becomes part
    of an expression.
    """
    return [(r.role, r.code) for r in vocabulary.orderBy("rank").select("role", "code").collect()]


def museum_silver(
    raw: DataFrame, roles: Sequence[tuple[str, str]] = (), credit: str = DEFAULT_CREDIT
) -> DataFrame:
    """Museum extract: catalogue names, constants, cleaned fields. One narrow pass, no shuffle."""
    df = add_constants(rename_columns(raw, fixed.MUSEUM_RENAMES), fixed.MUSEUM_CONSTANTS)
    cleaners = {
        "field_genre": F.upper,
        "title": text.title_cut,
        "field_place_published": text.place_delimiter,
        "field_subject": text.subject_delimiter,
        "field_credit_line": lambda c: rules.credit_line(c, credit),
        "field_physical_form": text.form_delimiter,
        "field_linked_agent": lambda c: rules.agent_roles(c, roles) if roles else c,
        "field_extent": rules.clean_extent,
    }
    changed = {name: clean(F.col(name)) for name, clean in cleaners.items() if name in df.columns}
    date = rules.edtf_date(F.col("original_date")) if "original_date" in df.columns else F.lit("")
    return clean_strings(df.withColumns({**changed, "field_edtf_date_created": date}))


def library_silver(
    raw: DataFrame,
    items: DataFrame | None = None,
    item_key: str = "MMS Record ID",
    item_order: str = "Barcode",
    item_location: str = "Permanent Physical Location",
) -> DataFrame:
    """Flattened library records: catalogue names, merged and composed fields, shelf location."""
    df = rename_columns(raw, fixed.LIBRARY_RENAMES)
    if "record_id" not in df.columns and "rec_id" in df.columns:  # tagged records come with their own key
        df = df.withColumnRenamed("rec_id", "record_id")
    present = set(df.columns)

    def col(name: str):
        return F.col(name) if name in present else F.lit(None).cast("string")

    changed = {
        "field_edtf_date_created": rules.marc_date(col("new_264_c"), col("new_260_c")),
        "field_linked_agent": text.merge_columns([col(c) for c in fixed.CREATOR_PARTS]),
        "field_subject_pictured": text.merge_columns([col(c) for c in fixed.PICTURED_PARTS]),
        "field_subject": col("raw_field_subject"),
        "field_note": col("raw_field_note"),
    }
    if "country_code" in present:
        changed["three_letter_code"] = F.substring("country_code", 16, 3)
    if "new_245_a" in present:
        changed["title"] = text.compose_title(col("new_245_a"), col("new_245_b"))
    if "new_300_a" in present:
        changed["field_extent"] = text.compose_extent(col("new_300_a"), col("new_300_b"), col("new_300_c"))
    df = add_constants(df.withColumns(changed), fixed.LIBRARY_CONSTANTS)
    if items is None:
        df = df.withColumns(
            {"alma_source_type": F.lit("/raw/alma/bibliographic"), "field_collection_type": F.lit("Library")}
        )
    else:
        df = inventory_join(df, items, "alma_identifier", item_key, item_order, item_location)
    stripped = {c: text.replace_all(F.col(c), pairs) for c, pairs in fixed.LIBRARY_STRIPS.items() if c in df.columns}
    return clean_strings(df.withColumns(stripped))
