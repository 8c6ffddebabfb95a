"""Exact deduplication as a stateful stream.

A streaming aggregation keeps, for every digest ever seen, the row that stays: its id, and its content locator (file
and row number). The state lives in RocksDB on the executors' disks, is saved with every batch and never expires, so
a job that is started again with the same folder goes on where it stopped, and a copy that comes years later still
finds the first one. What a batch brings of one digest is merged in each task before the shuffle, so a group that
holds a third of all rows is one state entry per task. Every batch writes the entries it changed.

A hit (a digest that several rows have) is then checked on whole texts: the smallest and the largest text of a digest
must be equal byte for byte, which needs no pairs and merges before the shuffle too. Texts that only share the digest
are told apart by grouping those few by the texts themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.llm.common import cut, shared_dir, stored
from shelfmark.operators.merge import lookup_join
from shelfmark.sources.files import path_exists

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a batch saves what it changed; whole copies of the state are made in the background, less often
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # else every open store reserves 4 MB of disk, whatever it holds, so the disk grows with the partitions
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# Bits of the table that tells which digests can be hits: 16 MB at most, whatever the input.
HIT_BITS = 1 << 27
BITMAP_BITS = 32_768


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _rows(source: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """``doc_id``, ``text`` (null is empty), ``digest`` and ``who`` (id and locator) of Parquet rows."""
    text = F.coalesce("text", F.lit(""))
    who = F.struct("doc_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return source.select("doc_id", text.alias("text"), digest(text).alias("digest"), who.alias("who"))


def _schema(spark: SparkSession, source: str) -> StructType:
    """Only the columns read, so that no other one can get in the way."""
    found = spark.read.parquet(source).schema
    return StructType([found["doc_id"], found["text"]])


def absorb(
    spark: SparkSession, source: str, folder: str, digest: Callable[[Column], Column] = sha256, batch_bytes: int = 256 << 30
) -> None:
    """Take all files of ``source`` that the state in ``folder`` has not seen yet into it.

    ``batch_bytes`` bounds what one micro-batch reads. Each batch writes its changed entries to a folder of its own
    number, so a batch that is repeated after a failure replaces what it wrote.
    """
    session = spark.newSession()
    for key, value in STATE_CONF.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    # as a pattern, the path may also be that of one file
    path = source.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"
    stream = session.readStream.schema(_schema(spark, source)).option("maxBytesPerTrigger", batch_bytes).parquet(pattern)
    kept = _rows(stream, digest).groupBy("digest").agg(F.max("who").alias("who"), F.count("*").alias("n"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    writer = kept.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/state")
    writer.trigger(availableNow=True).start().awaitTermination()


def retained(spark: SparkSession, source: str, folder: str) -> DataFrame:
    """The state as a table: ``digest``, ``who`` (the row that stays) and ``n`` (rows with this digest so far)."""
    id_type = _schema(spark, source)["doc_id"].dataType.simpleString()
    schema = f"digest binary, who struct<doc_id: {id_type}, file: string, row: bigint>, n bigint, batch bigint"
    if not path_exists(spark, f"{folder}/changes"):
        return spark.createDataFrame([], schema).drop("batch")
    changes = spark.read.schema(schema).parquet(f"{folder}/changes")
    # both only grow, so the largest are the newest
    return changes.groupBy("digest").agg(F.max("who").alias("who"), F.max("n").alias("n"))


def possible_hits(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """The rows whose digest is in ``digests``, and few others: a bitmap of fixed size is asked, so that the texts of
    the rest need no shuffle."""
    place = F.pmod(F.xxhash64("digest"), F.lit(HIT_BITS))
    number, position = F.floor(place / BITMAP_BITS), (place % BITMAP_BITS).cast("long")
    bits = digests.select(number.alias("_number"), position.alias("_position"))
    # no more than HIT_BITS / BITMAP_BITS rows of 4 kB
    bitmaps = bits.groupBy("_number").agg(F.bitmap_construct_agg("_position").alias("_bitmap"))
    asked = rows.withColumn("_place", place).join(F.broadcast(bitmaps), F.floor(F.col("_place") / BITMAP_BITS) == F.col("_number"))
    bit = (F.col("_place") % BITMAP_BITS).cast("int")
    byte = F.conv(F.hex(F.substring("_bitmap", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return asked.where(F.bit_get(byte, bit % 8) == 1).select(*rows.columns)


def decisions(
    spark: SparkSession, source: str, folder: str, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per row of ``source``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, by the state in ``folder``.

    Of equal texts the row with the largest id stays (null ids lose; among equal ids, the last by file and row). A null
    text is empty, and all empty texts are equal. The files must be those that the state has seen. Other columns
    are not read.
    """
    rows = _rows(spark.read.schema(_schema(spark, source)).parquet(source), digest)
    groups = stored(retained(spark, source, folder).where("n > 1"), "copies")
    texts = possible_hits(rows.select("digest", "text"), groups)
    ends = texts.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    collided = cut(ends.where("low <> high").select("digest"))

    slim = rows.select("doc_id", "who", "text", F.hex("digest").alias("_key"))
    known = groups.select(F.hex("digest").alias("_key"), F.col("who").alias("_who"), "n")
    if collided.isEmpty():
        return _decided(lookup_join(_without_text(slim), known, ["_key"], "left"))
    # the few rows of a shared digest are grouped by their whole texts instead
    shared = collided.select(F.hex("digest").alias("_key"))
    mixed = lookup_join(slim, shared, ["_key"], "left_semi")
    apart = mixed.groupBy("_key", "text").agg(F.max("who").alias("_who"), F.count("*").alias("n"))
    others = lookup_join(_without_text(slim), shared, ["_key"], "left_anti")
    told = _decided(_without_text(lookup_join(mixed, apart, ["_key", "text"])))
    return _decided(lookup_join(others, known, ["_key"], "left")).unionByName(told)


def _without_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256)).drop("text")


def _decided(rows: DataFrame) -> DataFrame:
    """Result columns of rows with the row that stays (``_who``, null: no other row has the digest)."""
    alone = F.col("_who").isNull()
    return rows.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_who.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("_who").eqNullSafe(F.col("who"))).alias("kept"),
        "text_sha256",
    )


def dedup_files(spark: SparkSession, source: str, folder: str | None = None, **options) -> DataFrame:
    """Run the stream over the Parquet files of ``source`` and return the decisions.

    ``folder`` keeps state and changes between runs; without one, a new folder in the shared one is used.
    """
    folder = folder or f"{shared_dir(spark)}/exact-{uuid.uuid4().hex}"
    absorb(spark, source, folder, **options)
    return decisions(spark, source, folder, **{k: v for k, v in options.items() if k == "digest"})
