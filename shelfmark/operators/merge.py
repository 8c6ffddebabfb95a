"""Keep-one deduplication, upsert, incremental extract rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.identifiers import normalize_identifier


def spread_nulls(key: Column, row_key: Column) -> Column:
    """A join key that equals ``key``, except that rows without one get a value of their own.

    Such rows match nothing either way; spread like this they do not all meet in one task.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), row_key.cast("string")))


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join to a side that has one row, or a few, per key, where ``left`` may have a hot key.

    Spark splits a hot key at run time only between two shuffles. A deduplicated side is already
    partitioned by its key and would skip its shuffle, so its key is made a new column here; that
    costs one more shuffle of the small rows and lets the hot key be split.
    """
    fresh = {k: F.concat(F.col(k).cast("string"), F.lit("")) for k in keys}
    other = right.select(*[fresh[c].alias(f"_join_{c}") if c in fresh else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).cast("string") == F.col(f"_join_{k}") for k in keys])
    return left.join(other, condition, how).drop(*[f"_join_{k}" for k in keys])


def possible(rows: DataFrame, key: str, keys: DataFrame, words: int = 1 << 18) -> DataFrame:
    """The rows whose ``key`` is in ``keys``, and few others: bits in a broadcast table of ``words`` words at most are asked."""

    def placed(df: DataFrame) -> DataFrame:
        place = F.pmod(F.xxhash64(key), F.lit(64 * words))
        return df.withColumns({"_word": F.floor(place / 64), "_bit": (place % 64).cast("int")})

    bits = placed(keys).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    asked = placed(rows).join(F.broadcast(bits), "_word")
    return asked.where(F.bit_get("_bits", F.col("_bit")) == 1).select(*rows.columns)


def keep_one(
    df: DataFrame, keys: Sequence[Column], order: Sequence[Column], collapse_null_keys: bool = False
) -> DataFrame:
    """First row of each key in ``order``, which must be total.

    ``row_number() = 1`` lets Spark keep one row per key and task before the shuffle, so a hot
    key never travels whole. Rows with a null key are all kept unless ``collapse_null_keys``: each
    gets a number of its own as a further key, so one pass serves both kinds.
    """
    named = {f"_key{i}": k for i, k in enumerate(keys)}
    keyed = df.withColumns(named)
    apart = list(named)
    if not collapse_null_keys:
        missing = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in named])
        keyed = keyed.withColumn("_own", F.when(missing, F.monotonically_increasing_id()))
        apart.append("_own")
    window = Window.partitionBy(*apart).orderBy(*order)
    return keyed.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").select(*df.columns)


def upsert_key(df: DataFrame) -> Column:
    """The museum key: record id if the table has one, else normal form of the identifier, else
    the access number."""
    if "record_id" in df.columns:
        return F.col("record_id")
    if "field_identifier" in df.columns:
        return normalize_identifier(F.col("field_identifier"))
    if "access_nbr" in df.columns:
        return F.col("access_nbr")
    raise ValueError("no key column: record_id, field_identifier or access_nbr")


def content_key(df: DataFrame) -> Column:
    """A key of the row's whole content. A column that is null counts as one that is not there."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)])).cast("binary"))


def upsert_latest(
    master: DataFrame | None, deltas: DataFrame, batch_time: str, row: str, full_extract: bool = False
) -> DataFrame:
    """Master after the change batches: the latest row of each key by (batch time, row).

    Rows without a key are told apart by their content, so merging a batch again adds none of them anew. A full
    extract replaces the master.
    """
    rows = deltas if master is None or full_extract else master.unionByName(deltas, allowMissingColumns=True)
    latest = [F.col(batch_time).desc_nulls_last(), F.col(row).desc_nulls_last(), content_key(rows).asc()]
    return keep_one(rows, [spread_nulls(upsert_key(rows).cast("string"), content_key(rows))], latest)


def changed_since(df: DataFrame, watermark, changed: str = "change_dte", added: str = "add_dte") -> DataFrame:
    """Rows changed or added after the watermark; all rows without one. Pushed to the scan."""
    if watermark is None:
        return df
    return df.where((F.col(changed) > F.lit(watermark)) | (F.col(added) > F.lit(watermark)))


def next_watermark(df: DataFrame, previous=None, changed: str = "change_dte", added: str = "add_dte") -> DataFrame:
    """One row: the newest time seen, never earlier than the previous watermark."""
    newest = F.greatest(F.max(changed), F.max(added))
    if previous is not None:
        newest = F.greatest(newest, F.lit(previous).cast(df.schema[changed].dataType))
    return df.agg(newest.alias("watermark"))


def replace_day(history: DataFrame, fresh: DataFrame, day: str, column: str = "snapshot_date") -> DataFrame:
    """History with one day's rows replaced by ``fresh``."""
    date = F.to_date(F.lit(day))
    return history.where(F.col(column) != date).unionByName(fresh.withColumn(column, date))


def collection_add(collection: DataFrame, items: DataFrame, key: str = "field_identifier") -> DataFrame:
    """Append the items that are not in the collection yet."""
    return collection.unionByName(lookup_join(items, collection.select(key).distinct(), [key], "left_anti"))


def collection_remove(collection: DataFrame, items: DataFrame, key: str = "field_identifier") -> DataFrame:
    return lookup_join(collection, items.select(key).distinct(), [key], "left_anti")


def collection_contains(items: DataFrame, collection: DataFrame, key: str = "field_identifier") -> DataFrame:
    """Items with a membership flag."""
    members = collection.select(key).distinct().withColumn("in_collection", F.lit(True))
    return lookup_join(items, members, [key], "left").withColumn("in_collection", F.coalesce("in_collection", F.lit(False)))
