"""Media joins on file listings: audit, presence and counts, files still to convert.

A listing is a table with one row per file or folder; the files themselves are never opened.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import fixed
from shelfmark.functions.identifiers import legacy_media_name, media_filename, media_name, media_parts, normalize_name
from shelfmark.operators.dense import index_in_group
from shelfmark.operators.merge import lookup_join


@dataclass(frozen=True)
class MediaRoots:
    """Sub-folders to search, in order, for each source; ``others`` for any other source."""

    by_source: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: {"Museum": ("objects", "converted"), "Library": ("library", "converted")}
    )
    others: Sequence[str] = ("objects", "library", "converted", "education")

    def column(self, source: Column) -> Column:
        def folders(names: Sequence[str]) -> Column:
            return F.array(*[F.lit(n) for n in names])

        choice = F.when(F.lit(False), folders(self.others))
        for label, names in self.by_source.items():
            choice = choice.when(source == label, folders(names))
        return choice.otherwise(folders(self.others))


def record_parts(records: DataFrame, *keep: str) -> DataFrame:
    """One row per identifier part that can have media: ``pos``, ``part``."""
    return records.select(*keep, F.inline(media_parts(F.col("field_identifier"))))


def _searched(records: DataFrame, roots: MediaRoots, row_key: str) -> DataFrame:
    """Every (part, sub-folder) a record is looked for in, with the order of preference."""
    parts = record_parts(records, row_key, "source_system")
    return parts.select(
        row_key,
        "pos",
        "part",
        F.posexplode(roots.column(F.col("source_system"))).alias("rank", "subdir"),
        normalize_name(F.col("part")).alias("folder_key"),
    )


def _folders(folders: DataFrame) -> DataFrame:
    """One folder per normal form and sub-folder (the last by name where several share it)."""
    key = normalize_name(F.col("folder")).alias("folder_key")
    return folders.select("subdir", key, "folder").groupBy("subdir", "folder_key").agg(F.max("folder").alias("folder"))


def media_audit(
    records: DataFrame, folders: DataFrame, processed: DataFrame, row_key: str, roots: MediaRoots = MediaRoots()
) -> DataFrame:
    """Raw folder found (first hit by part, then by sub-folder) and processed file found.

    Only keys travel to the listings; just the hits are joined back to the records.
    """
    hits = lookup_join(_searched(records, roots, row_key), _folders(folders), ["subdir", "folder_key"])
    path = F.min_by(F.concat_ws("/", "subdir", "folder"), F.struct("pos", "rank"))
    raw = hits.groupBy(row_key).agg(path.alias("raw_path"))

    names = record_parts(records, row_key).select(
        row_key, F.concat(media_name(F.col("part")), F.lit(".jpg")).alias("file_name")
    )
    done = lookup_join(names, processed.select("file_name").distinct(), ["file_name"], "left_semi")
    done = done.select(row_key).distinct()

    joined = records.join(raw, row_key, "left").join(done.withColumn("_done", F.lit(True)), row_key, "left")
    return joined.select(
        row_key,
        F.col("field_identifier").alias("identifier"),
        "title",
        "source_system",
        F.when(F.col("raw_path").isNotNull(), "Yes").otherwise("No").alias("raw_image_found"),
        F.coalesce("raw_path", F.lit("")).alias("raw_image_path"),
        F.when(F.col("_done"), "Yes").otherwise("No").alias("processed_image_found"),
    )


def audit_summary(audit: DataFrame) -> DataFrame:
    """Totals and percentages of the audit."""
    total = F.nullif(F.count("*"), F.lit(0)).cast("double")
    raw = F.count_if(F.col("raw_image_found") == "Yes")
    done = F.count_if(F.col("processed_image_found") == "Yes")
    return audit.agg(
        F.count("*").alias("total_records"),
        raw.alias("raw_found"),
        done.alias("processed_found"),
        F.coalesce(F.round(raw * 100.0 / total, 2), F.lit(0.0)).alias("raw_pct"),
        F.coalesce(F.round(done * 100.0 / total, 2), F.lit(0.0)).alias("processed_pct"),
    )


def file_counts(listing: DataFrame, extensions: Sequence[str] = (".jpg",)) -> DataFrame:
    """(``base``, ``files``): 1 for ``base`` plus the unbroken run ``base_1``, ``base_2``, ...

    Each file says of its own number that it exists and of the number before that it has a
    successor. The run ends at the first number without one. Grouped by (base, number) first, so
    no group is sorted or collected, however many files one base has.
    """
    suffix = "|".join(e.replace(".", "[.]") for e in extensions)
    stem = F.regexp_extract("file_name", f"(?s)^(.*)({suffix})$", 1)
    numbered = r"(?s)^(.+)_([1-9][0-9]*)$"
    base, k = F.regexp_extract("stem", numbered, 1), F.regexp_extract("stem", numbered, 2)

    def says(base: Column, k: Column, exists: bool) -> Column:
        return F.struct(base.alias("base"), k.cast("long").alias("k"), F.lit(exists).alias("here"), F.lit(not exists).alias("more"))

    # a number beyond a long cannot end an unbroken run: that many files do not exist
    number = F.nullif(k, F.lit("")).try_cast("long")
    facts = F.array_compact(
        F.array(
            says(F.col("stem"), F.lit(0), True),
            F.when(number.isNotNull(), says(base, number, True)),
            F.when(number.isNotNull(), says(base, number - 1, False)),
        )
    )
    numbers = listing.select(stem.alias("stem")).where("stem != ''").select(F.inline(facts))
    numbers = numbers.groupBy("base", "k").agg(F.max("here").alias("here"), F.max("more").alias("more"))
    ends = F.min(F.when(F.col("here") & ~F.col("more"), F.col("k") + 1)).alias("files")
    plain = F.max(F.col("here") & (F.col("k") == 0)).alias("plain")
    return numbers.groupBy("base").agg(ends, plain).where("plain").select("base", "files")


def media_counts(
    records: DataFrame, listing: DataFrame, row_key: str, kind: str = "image", extensions: Sequence[str] = (".jpg",)
) -> DataFrame:
    """Add ``<kind>_count`` and ``has_<kind>``, by the first identifier part that has a file."""
    parts = record_parts(records, row_key).select(row_key, "pos", media_name(F.col("part")).alias("base"))
    found = lookup_join(parts, file_counts(listing, extensions), ["base"])
    found = found.groupBy(row_key).agg(F.min_by("files", "pos").alias("_files"))
    count = F.coalesce("_files", F.lit(0)).cast("int")
    joined = records.join(found, row_key, "left")
    return joined.withColumns({f"{kind}_count": count, f"has_{kind}": count > 0}).drop("_files")


def has_media_flag(records: DataFrame, listing: DataFrame, row_key: str, extension: str = ".jpg") -> DataFrame:
    """``has_image`` by the primary part alone."""
    name = F.concat(media_filename(F.col("field_identifier")), F.lit(extension))
    files = listing.select(F.col("file_name").alias("_file")).distinct()
    named = records.select(row_key, name.alias("_file")).where("_file IS NOT NULL")
    hits = lookup_join(named, files, ["_file"], "left_semi")
    flags = hits.select(row_key, F.lit(True).alias("_hit"))
    joined = records.drop("has_image").join(flags, row_key, "left")
    return joined.withColumn("has_image", F.coalesce("_hit", F.lit(False))).drop("_hit")


def net_new_media(
    records: DataFrame,
    listing: DataFrame,
    existing: DataFrame,
    row_key: str,
    roots: MediaRoots = MediaRoots(),
    extensions: Sequence[str] = fixed.IMAGE_EXTENSIONS,
    target: str = ".jpg",
    blocklist: Sequence[str] = (),
) -> DataFrame:
    """Files to convert: planned outputs without those that exist, under their new or old name.

    ``listing`` has (``subdir``, ``folder``, ``file_name``). Each part uses the first sub-folder
    that holds media; its files are numbered in name order.
    """
    suffix = F.lower(F.concat(F.lit("."), F.substring_index("file_name", ".", -1)))
    usable = listing.where(suffix.isin(list(extensions)) & ~F.col("file_name").startswith("."))
    keyed = usable.join(_folders(usable).select("subdir", "folder", "folder_key"), ["subdir", "folder"])
    numbered = index_in_group(
        keyed.select("subdir", "folder_key", "folder", "file_name"),
        ["subdir", "folder_key"],
        [F.col("file_name"), F.col("folder")],
        "n",
    )
    choice = lookup_join(_searched(records, roots, row_key), _folders(usable), ["subdir", "folder_key"])
    choice = choice.groupBy(row_key, "pos", "part", "folder_key").agg(F.min_by("subdir", "rank").alias("subdir"))
    number = F.when(F.col("n") == 0, "").otherwise(F.concat(F.lit("_"), F.col("n").cast("string")))
    planned = choice.join(numbered, ["subdir", "folder_key"]).select(
        row_key,
        F.concat_ws("/", "subdir", "folder", "file_name").alias("source_path"),
        "file_name",
        F.concat(media_name(F.col("part")), number, F.lit(target)).alias("output"),
        F.concat(legacy_media_name(F.col("part")), number, F.lit(target)).alias("_legacy"),
    )
    done = existing.select(F.col("file_name").alias("_done")).distinct()
    fresh = planned.join(done, F.col("output") == F.col("_done"), "left_anti")
    fresh = fresh.join(done, F.col("_legacy") == F.col("_done"), "left_anti")
    if blocklist:
        fresh = fresh.where(~F.col("file_name").isin(list(blocklist)))
    return fresh.select(row_key, "source_path", "output")
