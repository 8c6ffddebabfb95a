"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Text columns go to Python in small batches, so that a run of long texts stays small in memory.
TEXT_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}

# A table is broadcast only if it has been counted and its rows take no more than this.
BROADCAST_BYTES = 16 << 20

# White space and words as the contracts define them.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
TEXT_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in TEXT_CONF.items():
        spark.conf.set(key, value)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a session on one machine (tests, laptops) may go without; it gets a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if not current:
        current = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            current = tempfile.mkdtemp(prefix="shelfmark-checkpoint-")
        context.setCheckpointDir(current)
    return context.getCheckpointDir() or current


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later passes read the same rows in the same partitions."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and go on from its files."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Mark a table for broadcast if its counted rows are few; else Spark shuffles both sides.

    ``df`` must be cheap to count: a checkpoint or a stored table.
    """
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def fresh(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    while name in df.columns:
        name = f"_{name}"
    return name


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def row_key() -> Column:
    """A key of the row's id and text; rows alike in both share it."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat_ws("|", doc_id, F.col("text")).cast("binary"))


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Dense row numbers from 0 over the whole table, without a single-task window.

    The table is range-sorted and checkpointed; one row per slice gives the slice's first number.
    Rows that tie in ``order`` get neighbouring numbers in any order.
    """
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")  # so that no name can clash
    rows = cut(df.orderBy(*order).select(whole, F.spark_partition_id().alias("_slice"), at.alias("_at")))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_slice").agg(F.count("*").alias("_size"))
    base = sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    # one row per slice, so no more than shuffle partitions
    joined = rows.join(F.broadcast(base), "_slice")
    return joined.select("_row.*", (F.col("_base") + F.col("_at")).alias(name))
