"""The whole batch run: extract, silver, quality, gold, reports, metrics, views.

Each step reads tables and writes tables; nothing but counts passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.fixed import GAP_COLUMNS
from shelfmark.operators import compare, media, merge, metrics, quality
from shelfmark.operators.shape import clean_strings, select_existing
from shelfmark.operators.unify import SourceLabels
from shelfmark.plans.daily import dashboard, snapshot_metrics
from shelfmark.plans.gold import normalize_catalog, unify_catalog
from shelfmark.plans.silver import DEFAULT_CREDIT, library_silver, museum_silver
from shelfmark.sources.files import (
    append_snapshot,
    delta_batches,
    is_full_extract,
    path_exists,
    read_deltas,
    read_request_log,
    remove_paths,
    replace_table,
    write_csv,
)
from shelfmark.sources.registry import Layout, publish_views


def incremental_extract(spark: SparkSession, source: DataFrame, state: str, target: str, stamp: str) -> bool:
    """Write the rows changed since the stored watermark, then move the watermark.

    Data first: a run that dies in between extracts the same rows again instead of losing them.
    Returns whether anything was extracted.
    """
    previous = spark.read.parquet(state).first().watermark if path_exists(spark, state) else None
    changed = merge.changed_since(source, previous)
    name = f"{'full_extract' if previous is None else 'delta'}_{stamp}"
    batch = f"{target}/{name}.parquet"
    changed.write.mode("overwrite").parquet(batch)
    written = spark.read.parquet(batch)
    if written.isEmpty():
        remove_paths(spark, [batch])
        return False
    replace_table(merge.next_watermark(written, previous).coalesce(1), state)
    return True


def merge_deltas(
    spark: SparkSession, layout: Layout, folder: str, row: str, roles=(), credit: str = DEFAULT_CREDIT, remove: bool = False
) -> None:
    """Upsert the change batches of a folder into the museum's silver table.

    ``remove`` deletes the batches once the table is published. Merging one twice does no harm: rows without a key
    are told apart by content.
    """
    batches = delta_batches(spark, folder)
    if not batches:
        return
    path = layout.path("museum_silver")
    master = spark.read.parquet(path) if path_exists(spark, path) else None
    clean = museum_silver(read_deltas(spark, batches), roles, credit)
    full = any(is_full_extract(b) for b in batches)
    replace_table(merge.upsert_latest(master, clean, "_batch_time", row, full), path)
    if remove:
        remove_paths(spark, batches)


def check_museum(spark: SparkSession, layout: Layout, counts: Counts | None = None) -> None:
    """Add the quality columns to the museum's silver table and write the quarantine table."""
    path = layout.path("museum_silver")
    silver = spark.read.parquet(path).drop("qa_errors", "qa_pass")
    write_counted(quality.apply_rules(silver, quality.basic_rules(silver)), layout, "museum_silver", counts)
    _, failed = quality.split_quarantine(spark.read.parquet(path))
    write_counted(failed, layout, "museum_qa_failures", counts)


Counts = dict[str, dict[str, int]]


def write_counted(df: DataFrame, layout: Layout, name: str, counts: Counts | None) -> None:
    """Write a dataset; its rows are counted on the way into ``counts``, not read again."""
    if counts is None:
        replace_table(df, layout.path(name))
        return
    conditions = {"with_identifier": F.col("field_identifier").isNotNull()} if "field_identifier" in df.columns else {}
    if "qa_pass" in df.columns:
        conditions["failed"] = F.lower(F.col("qa_pass").cast("string")) == "false"
    observed, observation = quality.observe_counts(df, name, **conditions)
    replace_table(observed, layout.path(name))
    counts[name] = dict(observation.get)


def write_traffic(spark: SparkSession, layout: Layout, traffic: DataFrame | None, request_logs: str | None, counts: Counts | None) -> None:
    """Daily web-traffic facts from raw rows, and the request log from its JSON lines."""
    if traffic is not None:
        write_counted(metrics.traffic_daily(traffic), layout, "web_traffic", counts)
    if request_logs is not None:
        write_counted(read_request_log(spark, request_logs), layout, "request_log", counts)


def build_gold(
    spark: SparkSession, layout: Layout, labels: SourceLabels = SourceLabels(), excluded: Sequence[str] = (),
    images: DataFrame | None = None, audio: DataFrame | None = None, counts: Counts | None = None,
) -> None:
    """Unified and normalised catalogue from the silver tables and the media listings."""
    museum = spark.read.parquet(layout.path("museum_silver"))
    library = spark.read.parquet(layout.path("library_silver"))
    write_counted(unify_catalog(museum, library, "record_id", labels, excluded, True), layout, "gold_unified_catalog", counts)
    gold = normalize_catalog(spark.read.parquet(layout.path("gold_unified_catalog")))
    for kind, listing, extensions in (("image", images, (".jpg",)), ("audio", audio, (".mp3", ".wav"))):
        if listing is None:
            gold = gold.withColumns({f"{kind}_count": F.lit(0), f"has_{kind}": F.lit(False)})
        else:
            gold = media.media_counts(gold, listing, "id", kind, extensions)
    write_counted(gold, layout, "gold_normalized_catalog", counts)


def build_reports(spark: SparkSession, layout: Layout) -> None:
    """Gap and comparison tables against the public archive."""
    archive = spark.read.parquet(layout.path("archive_raw"))
    unified = spark.read.parquet(layout.path("gold_unified_catalog"))
    gap = compare.gap_report(quality.qa_gate(select_existing(unified, GAP_COLUMNS)), archive, "id")
    replace_table(clean_strings(compare.numbered_gap(gap).drop("access_nbr")), layout.path("missing_objects"))
    museum = quality.qa_gate(spark.read.parquet(layout.path("museum_silver")))
    replace_table(compare.compare_left(museum, archive, "record_id"), layout.path("comparison_museum"))
    library = spark.read.parquet(layout.path("library_silver"))
    replace_table(
        compare.compare_full(library, archive, ["record_id"], ["node_id"]), layout.path("comparison_library")
    )


def build_exports(spark: SparkSession, layout: Layout, day: str, folders: DataFrame | None = None, images: DataFrame | None = None) -> None:
    """CSV reports and sheets of the day: duplicates, both silver tables, and, with listings of raw
    folders and processed images, the image audit with its summary."""
    museum, library = (spark.read.parquet(layout.path(n)) for n in ("museum_silver", "library_silver"))
    reports = f"{layout.root}/reports"
    stamp = day.replace("-", "")
    write_csv(compare.duplicates_report(museum, library), f"{reports}/duplicates_report_{stamp}.csv")
    write_csv(museum, f"{reports}/museum_sheet.csv", quote_all=True)
    write_csv(library, f"{reports}/library_sheet.csv", quote_all=True)
    if folders is not None and images is not None:
        gold = spark.read.parquet(layout.path("gold_normalized_catalog"))
        audit = media.media_audit(gold, folders.select("subdir", "folder").distinct(), images, "id")
        replace_table(audit, layout.path("image_audit_report"))
        written = spark.read.parquet(layout.path("image_audit_report"))
        write_csv(media.audit_summary(written), f"{reports}/image_audit_summary_{stamp}.csv")


def record_metrics(spark: SparkSession, layout: Layout, day: str, counts: Counts) -> None:
    """The counts that the run's writes have taken, added to the metrics history."""
    rows = [(name, metric, int(n)) for name, found in counts.items() for metric, n in found.items()]
    table = spark.createDataFrame(rows, "run_id string, metric string, value bigint")
    append_snapshot(table, f"{layout.root}/gold/snapshots/history_run_metrics", day)


def run_layers(
    spark: SparkSession, layout: Layout, museum_deltas: str, library_raw: DataFrame, day: str,
    items: DataFrame | None = None, images: DataFrame | None = None, delta_row: str = "record_id",
    roles: Sequence[tuple[str, str]] = (), labels: SourceLabels = SourceLabels(), excluded: Sequence[str] = (),
    audio: DataFrame | None = None, folders: DataFrame | None = None, remove_batches: bool = False,
    traffic: DataFrame | None = None, request_logs: str | None = None,
) -> list[str]:
    """Everything in order; quality always before the union. Returns the published views."""
    counts: Counts = {}
    merge_deltas(spark, layout, museum_deltas, delta_row, roles, remove=remove_batches)
    write_counted(library_silver(library_raw, items), layout, "library_silver", counts)
    check_museum(spark, layout, counts)
    build_gold(spark, layout, labels, excluded, images, audio, counts)
    write_traffic(spark, layout, traffic, request_logs, counts)
    build_reports(spark, layout)
    build_exports(spark, layout, day, folders, images)
    record_metrics(spark, layout, day, counts)
    tables = {name: spark.read.parquet(layout.path(name)) for name in (
        "gold_normalized_catalog", "gold_unified_catalog", "museum_silver", "library_silver", "archive_raw")}
    snapshot_metrics(dashboard(*tables.values()), layout, day)
    return publish_views(spark, layout)
