"""Request logs, log alerts and continuous upsert.

All jobs take a streaming DataFrame or a folder, a target and a checkpoint folder; restarting a
job with the same checkpoint continues where it stopped.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.functions.fixed import ALERT_IGNORES, ALERT_WORDS
from shelfmark.operators.merge import content_key, spread_nulls, upsert_key, upsert_latest
from shelfmark.operators.metrics import request_metrics
from shelfmark.session import cut_lineage
from shelfmark.sources.files import REQUEST_LOG, path_exists, replace_table


def is_alert(line: Column, words: Sequence[str] = ALERT_WORDS, ignores: Sequence[str] = ALERT_IGNORES) -> Column:
    """The line has an alert word and no text that silences it, in any case."""

    def any_of(texts: Sequence[str]) -> Column:
        return line.rlike("(?i)" + "|".join(re.escape(t) for t in texts))

    return any_of(words) & ~any_of(ignores) if ignores else any_of(words)


def alert_lines(logs: DataFrame, width: str = "1 minute", skip: Sequence[str] = ()) -> DataFrame:
    """The lines to report, with the window they belong to: the body of an alert."""
    rows = logs.where(is_alert(F.col("line")))
    if skip:
        rows = rows.where(~F.col("container").rlike("|".join(re.escape(s) for s in skip)))
    return rows.select(F.window("ts", width)["start"].alias("window_start"), "container", "ts", "line")


def log_alerts(logs: DataFrame, width: str = "1 minute", late: str | None = None) -> DataFrame:
    """One alert per container and window: how many lines, the first and the last of them.

    The counts merge before the shuffle, so a container that floods its log costs no more than a
    quiet one; the lines themselves stay in ``alert_lines``. ``late`` sets the watermark (streams).
    """
    rows = logs.where(is_alert(F.col("line")))
    if late is not None:
        rows = rows.withWatermark("ts", late)
    alerts = rows.groupBy(F.window("ts", width).alias("w"), "container").agg(
        F.count("*").alias("lines"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    return alerts.select(F.col("w.start").alias("window_start"), "container", "lines", "first_ts", "last_ts")


def alert_outbursts(logs: DataFrame, gap: str = "5 minutes", late: str | None = None) -> DataFrame:
    """One alert per container and outburst: alert lines less than ``gap`` apart are one, however long it lasts.

    ``opened`` and ``last_ts`` are the times of its first and last line, ``closed`` is ``gap`` after the last.
    Sessions merge in each task before the shuffle and in the state of a stream; ``late`` sets the watermark
    (streams), which closes an outburst once no line can join it any more.
    """
    rows = logs.where(is_alert(F.col("line")))
    if late is not None:
        rows = rows.withWatermark("ts", late)
    alerts = rows.groupBy(F.session_window("ts", gap).alias("w"), "container").agg(
        F.count("*").alias("lines"), F.max("ts").alias("last_ts")
    )
    return alerts.select("container", F.col("w.start").alias("opened"), "last_ts", F.col("w.end").alias("closed"), "lines")


def start_request_log(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Append JSON-line request logs to a table, each file exactly once."""
    rows = spark.readStream.schema(REQUEST_LOG).json(source)
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(target)


def start_request_metrics(
    requests: DataFrame, target: str, checkpoint: str, late: str = "10 minutes", width: str = "1 day"
) -> StreamingQuery:
    """Windowed request metrics, written once their window is closed by the watermark."""
    metrics = request_metrics(requests.withWatermark("ts", late), width)
    writer = metrics.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(target)


def start_log_alerts(logs: DataFrame, target: str, checkpoint: str, late: str = "10 minutes") -> StreamingQuery:
    return _start_alerts(log_alerts(logs, late=late), target, checkpoint)


def start_alert_outbursts(
    logs: DataFrame, target: str, checkpoint: str, gap: str = "5 minutes", late: str = "10 minutes"
) -> StreamingQuery:
    """Outbursts, each written once, when the watermark has passed its end."""
    return _start_alerts(alert_outbursts(logs, gap, late), target, checkpoint)


def _start_alerts(alerts: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    writer = alerts.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(target)


def once(checkpoint: str, merge: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that leaves out batches whose number is in the ledger next to the checkpoint.

    The number is written after the merge. A job that dies in between merges the batch again, which ``merge`` must bear.
    """

    def run(batch: DataFrame, number: int) -> None:
        entry = f"{checkpoint}/merged/{number}"
        spark = batch.sparkSession
        if not path_exists(spark, entry):
            merge(batch)
            spark.range(1).write.mode("overwrite").parquet(entry)

    return run


def start_upsert(
    deltas: DataFrame, target: str, checkpoint: str, batch_time: str, row: str
) -> StreamingQuery:
    """Merge change batches into a table as they arrive.

    A micro-batch that is repeated after a failure gives the same table: the latest row of a key
    wins by (batch time, row), not by arrival, and rows without a key are told apart by content.
    """

    def merge(batch: DataFrame) -> None:
        spark = batch.sparkSession
        master = spark.read.parquet(target) if path_exists(spark, target) else None
        replace_table(upsert_latest(master, batch, batch_time, row), target)

    writer = deltas.writeStream.foreachBatch(once(checkpoint, merge)).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


BUCKET = "key_bucket"


def merge_into_buckets(
    batch: DataFrame, target: str, batch_time: str, row: str, buckets: int = 256, splits: int = 16
) -> None:
    """Upsert a batch into a table partitioned by key bucket, rewriting only the buckets it touches.

    ``splits`` tasks write each bucket. The merged rows are checkpointed before they replace the buckets they were read from. If the
    job dies while buckets are replaced, merging the same batch again gives the same table.
    """
    spark = batch.sparkSession
    # rows without a key are spread over the buckets by content
    key = spread_nulls(upsert_key(batch).cast("string"), content_key(batch))
    fresh = batch.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    touched = [r[BUCKET] for r in fresh.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    master = None
    if path_exists(spark, target):
        master = spark.read.parquet(target).where(F.col(BUCKET).isin(touched))
    merged = cut_lineage(upsert_latest(master, fresh, batch_time, row))
    dealt = merged.repartition(F.col(BUCKET), F.pmod(F.xxhash64(row), F.lit(splits)))
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BUCKET).parquet(target)


def start_bucket_upsert(
    deltas: DataFrame, target: str, checkpoint: str, batch_time: str, row: str, buckets: int = 256
) -> StreamingQuery:
    """As ``start_upsert``, for tables too large to rewrite with every batch."""

    def merge(batch: DataFrame) -> None:
        merge_into_buckets(batch, target, batch_time, row, buckets)

    writer = deltas.writeStream.foreachBatch(once(checkpoint, merge)).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
