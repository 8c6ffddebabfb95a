"""Reproducible shuffle into shards: a keyed permutation of global row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import fresh, numbered
from shelfmark.llm.permute import permuted


def shard_rows(df: DataFrame, order: Sequence[Column], shards: int, key: int = 0) -> DataFrame:
    """Add ``row``, ``shard`` and ``slot``.

    The rows are numbered in ``order``, the number goes through a Feistel permutation of 0..n-1, and
    place p of the shuffled order is slot ``p // shards`` of shard ``p % shards``. Shard sizes differ
    by one row at most, slots have no gaps, and the place of a row follows from its number, n and
    ``key`` alone (``permute.permute``; ``permute.unpermute`` gives the row at a place).

    Nulls sort first or last as ``order`` says; rows that tie in it may change places with each
    other, so name enough columns to tell unequal rows apart. An empty table stays empty. Columns
    named ``row``, ``shard`` or ``slot`` are replaced.
    """
    rows = numbered(df.drop("row", "shard", "slot"), order, "row")
    place = permuted(F.col("row"), rows.count(), key)
    columns = [c for c in rows.columns if c != "row"]
    spot = fresh("_place", rows)
    placed = rows.select(*columns, "row", place.alias(spot))
    return placed.select(
        *columns, "row", (F.col(spot) % shards).cast("int").alias("shard"), F.floor(F.col(spot) / shards).alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int, key: int = 0) -> DataFrame:
    """Shard and slot of every document, with its size (UTF-8 bytes and one) and its text's CRC-32.

    A null text has no bytes (size 1, CRC 0). Rows are ordered by id (null first), then by size and
    CRC, so only rows alike in all three may change places.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32")]
    return shard_rows(rows, order, shards, key).withColumn("law", F.lit("rows"))
