"""Library records enriched from the item inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.silver import collection_type, shelf_location
from shelfmark.operators.merge import keep_one, spread_nulls


def clean_item_key(c: Column) -> Column:
    """Item keys come with quote characters to keep spreadsheets from rounding them."""
    return F.replace(c, F.lit("'"), F.lit(""))


def first_item(items: DataFrame, key: str, order: str) -> DataFrame:
    """The first inventory row of each record by ``order``; where that ties, by all other columns."""
    rest = [F.col(f"`{c}`").asc_nulls_last() for c in items.columns if c not in (key, order)]
    return keep_one(items, [F.col(f"`{key}`")], [F.col(f"`{order}`").asc_nulls_last(), *rest])


def inventory_join(
    records: DataFrame, items: DataFrame, record_key: str, item_key: str, item_order: str, item_location: str
) -> DataFrame:
    """Left join to the first item per record: presence flag, shelf location, collection type.

    All other item columns come along; where the record has a column of that name, the record's stays.
    The item side has one row per record, so a record can only meet one of them. Its key is a new
    column for the reason given at ``lookup_join``.
    """
    taken = {c.lower() for c in [*records.columns, "location", "alma_source_type", "field_collection_type"]}
    more = [c for c in items.columns if c.lower() not in taken and c != item_location]
    right = first_item(items, item_key, item_order).select(
        F.concat(F.col(f"`{item_key}`").cast("string"), F.lit("")).alias("_item"),
        shelf_location(F.col(f"`{item_location}`")).alias("_location"),
        *[F.col(f"`{c}`") for c in more],
    )
    key = spread_nulls(F.col(record_key).cast("string"), F.xxhash64(*records.columns))
    joined = records.drop("location").withColumn("_key", key).join(right, F.col("_key") == F.col("_item"), "left")
    source = F.when(F.col("_item").isNotNull(), "/raw/alma/physical").otherwise("/raw/alma/bibliographic")
    return joined.withColumns(
        {
            "location": F.col("_location"),
            "alma_source_type": source,
            "field_collection_type": collection_type(F.col("_location")),
        }
    ).drop("_key", "_item", "_location")
