"""Streams give the rows of the batch form, also across a restart."""

import json

from helpers import rows
from pyspark.sql import functions as F

from checks.views import view
from shelfmark.operators.merge import upsert_latest
from shelfmark.operators.metrics import request_metrics
from shelfmark.streaming import jobs

SF = "/root/testdata/sf0.001"


def write_in_time_order(spark, df, folder, parts):
    """One file per time slice, so that a stream that takes one at a time sees no late row."""
    timed = df.withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = timed.agg(F.min("ts").cast("long"), F.max("ts").cast("long")).first()
    step = (high - low) / parts + 1
    seconds = F.col("ts").cast("long")
    for i in range(parts):
        part = timed.where((seconds >= low + i * step) & (seconds < low + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(folder)
    return timed


def read_stream(spark, df, folder):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def closing_row(spark, df, folder, **values):
    """A row far in the future, which closes all windows."""
    row = df.limit(1).withColumns({"ts": F.to_timestamp(F.lit("2090-01-01")), **{k: F.lit(v) for k, v in values.items()}})
    row.select(df.columns).coalesce(1).write.mode("append").parquet(folder)


def test_request_log_is_appended_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / d) for d in ("in", "out", "ck"))
    (tmp_path / "in").mkdir()

    def log(name, n):
        lines = [json.dumps({"timestamp": "2024-01-01T00:00:00Z", "endpoint": f"/{name}/{i}", "status_code": 200}) for i in range(n)]
        (tmp_path / "in" / f"{name}.jsonl").write_text("\n".join(lines))

    for name, n, total in (("a", 3, 3), ("b", 2, 5)):
        log(name, n)
        for _ in range(2):  # the second start finds nothing new
            jobs.start_request_log(spark, source, target, checkpoint).awaitTermination()
        assert spark.read.parquet(target).count() == total


def test_request_metrics_stream_equals_batch(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / d) for d in ("in", "out", "ck"))
    timed = write_in_time_order(spark, view(spark, SF, "requests"), folder, 4)
    closing_row(spark, timed, folder, endpoint="/end")
    jobs.start_request_metrics(read_stream(spark, timed, folder), target, checkpoint).awaitTermination()
    streamed = spark.read.parquet(target).where("endpoint != '/end'")
    assert rows(streamed) == rows(request_metrics(timed))


def test_alert_stream_equals_batch_and_drops_late_lines(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / d) for d in ("in", "out", "ck"))
    timed = write_in_time_order(spark, view(spark, SF, "logs"), folder, 3)
    closing_row(spark, timed, folder, container="end", line="ERROR end")
    jobs.start_log_alerts(read_stream(spark, timed, folder), target, checkpoint).awaitTermination()
    batch = rows(jobs.log_alerts(timed))
    assert rows(spark.read.parquet(target).where("container != 'end'")) == batch
    # a line older than the watermark comes after the restart and is dropped
    late = timed.where("line LIKE 'ERROR%'").limit(1).withColumn("container", F.lit("late"))
    late.coalesce(1).write.mode("append").parquet(folder)
    jobs.start_log_alerts(read_stream(spark, timed, folder), target, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(target).where("container != 'end'")) == batch


def test_upsert_stream_equals_batch_across_a_restart(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / d) for d in ("in", "out", "ck"))
    deltas = view(spark, SF, "deltas")
    halves = [deltas.where("status = 'O'"), deltas.where("status != 'O'")]
    for half in halves:
        half.repartition(2).write.mode("append").parquet(folder)
        jobs.start_upsert(read_stream(spark, deltas, folder), target, checkpoint, "add_dte", "row_id").awaitTermination()
    assert rows(spark.read.parquet(target)) == rows(upsert_latest(None, deltas, "add_dte", "row_id"))


def test_bucket_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / d) for d in ("in", "out", "ck"))
    deltas = view(spark, SF, "deltas")
    deltas.where("status = 'O'").repartition(2).write.mode("append").parquet(folder)
    jobs.start_bucket_upsert(read_stream(spark, deltas, folder), target, checkpoint, "add_dte", "row_id", 8).awaitTermination()
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
    one_key = deltas.orderBy("record_id", "row_id").limit(1)
    one_key.write.mode("append").parquet(folder)
    jobs.start_bucket_upsert(read_stream(spark, deltas, folder), target, checkpoint, "add_dte", "row_id", 8).awaitTermination()
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
    assert len({p.parent for p in set(before) ^ set(after)}) == 1
    wanted = upsert_latest(None, deltas.where("status = 'O'").unionByName(one_key), "add_dte", "row_id")
    assert rows(spark.read.parquet(target).drop(jobs.BUCKET)) == rows(wanted)


def test_outbursts_stream_equals_batch_across_a_restart(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / d) for d in ("in", "out", "ck"))
    logs = view(spark, SF, "logs")
    timed = logs.withColumn("ts", F.col("ts").cast("timestamp"))
    middle = timed.agg(F.timestamp_seconds(F.percentile(F.col("ts").cast("double"), 0.5))).first()[0]
    write_in_time_order(spark, timed.where(F.col("ts") < middle), folder, 2)
    jobs.start_alert_outbursts(read_stream(spark, timed, folder), target, checkpoint, "12 hours", "1 minute").awaitTermination()
    write_in_time_order(spark, timed.where(F.col("ts") >= middle), folder, 2)
    closing_row(spark, timed, folder, container="end", line="ERROR end")
    jobs.start_alert_outbursts(read_stream(spark, timed, folder), target, checkpoint, "12 hours", "1 minute").awaitTermination()
    assert rows(spark.read.parquet(target).where("container != 'end'")) == rows(jobs.alert_outbursts(timed, "12 hours"))


def test_batch_killed_between_merge_and_ledger_is_merged_again_without_harm(spark, tmp_path):
    deltas = view(spark, SF, "deltas").withColumn("record_id", F.when(F.col("record_id") % 7 != 0, F.col("record_id")))
    wanted = rows(upsert_latest(None, deltas, "add_dte", "row_id"))
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    merged = []

    def dying(batch):
        jobs.merge_into_buckets(batch, target, "add_dte", "row_id", 4)
        merged.append(1)
        if len(merged) == 1:
            raise RuntimeError("killed")

    run = jobs.once(checkpoint, dying)
    for _ in range(3):
        try:
            run(deltas, 0)
        except RuntimeError:
            pass
    assert len(merged) == 2  # the third call finds the batch in the ledger
    assert rows(spark.read.parquet(target).drop(jobs.BUCKET)) == wanted
