"""Named datasets of the layers, published as views."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from shelfmark.sources.files import _hadoop, path_exists


@dataclass(frozen=True)
class Layout:
    """Where each dataset lives under one root folder."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{DATASETS[name]}"

    def history(self, metric: str) -> str:
        return f"{self.root}/gold/snapshots/history_{metric}"


# dataset name -> folder below the root
DATASETS: Mapping[str, str] = {
    "museum_silver": "silver/museum",
    "library_silver": "silver/library",
    "archive_raw": "raw/archive",
    "comparison_museum": "gold/comparison_museum",
    "comparison_library": "gold/comparison_library",
    "missing_objects": "gold/missing_objects",
    "museum_qa_failures": "gold/museum_qa_failures",
    "gold_unified_catalog": "gold/unified_catalog",
    "gold_normalized_catalog": "gold/unified_catalog_normalized",
    "image_audit_report": "gold/image_audit_report",
    "web_traffic": "gold/web_traffic",
    "request_log": "gold/request_log",
}


def publish_views(spark: SparkSession, layout: Layout) -> list[str]:
    """A temporary view for every dataset and snapshot history that exists; others are skipped."""
    found = {name: layout.path(name) for name in DATASETS if path_exists(spark, layout.path(name))}
    snapshots = f"{layout.root}/gold/snapshots"
    if path_exists(spark, snapshots):
        fs, folder = _hadoop(spark, snapshots)
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("history_"):
                found[name] = f"{snapshots}/{name}"
    published = []
    for name, path in found.items():
        try:
            spark.read.parquet(path).createOrReplaceTempView(name)
        except AnalysisException:  # a history without a row yet has no schema
            continue
        published.append(name)
    return sorted(published)
