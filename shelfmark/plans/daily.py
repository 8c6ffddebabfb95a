"""Dashboard metrics and their daily snapshots."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from shelfmark.operators import metrics
from shelfmark.operators.compare import compare_titles
from shelfmark.sources.files import append_snapshot
from shelfmark.sources.registry import Layout


def dashboard(
    gold: DataFrame, unified: DataFrame, museum: DataFrame, library: DataFrame, archive: DataFrame
) -> Mapping[str, Callable[[], DataFrame]]:
    """The ten dashboard metrics by name."""
    scope = {
        "Public Archive": archive, "Gold Unified Catalog": unified, "Normalized Catalog (Analytics Layer)": gold,
        "Museum Catalog": museum, "Library Catalog": library,
    }
    return {
        "genre_distribution": lambda: metrics.genre_distribution(gold),
        "collection_by_decade": lambda: metrics.collection_by_decade(gold),
        "subject_synergy": lambda: metrics.subject_synergy(gold),
        "temporal_geography": lambda: metrics.temporal_geography(gold),
        "prolific_creators": lambda: metrics.prolific_creators(gold),
        "holding_type": lambda: metrics.holding_type(museum),
        "image_completeness": lambda: metrics.media_completeness(gold),
        "system_health": lambda: metrics.system_health(gold),
        "total_scope": lambda: metrics.total_scope(scope),
        "library_comparison": lambda: compare_titles(
            library, archive.where("field_collection_type = 'Library'"), ["field_identifier"], ["node_id"]
        ),
    }


def snapshot_metrics(queries: Mapping[str, Callable[[], DataFrame]], layout: Layout, day: str) -> None:
    """Write each metric's rows for one day; running a day again replaces them."""
    for name, query in queries.items():
        append_snapshot(query(), layout.history(name), day)
