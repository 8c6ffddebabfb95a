"""Schema work: rename, constants, alignment, pruning, unpivot, output projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfmark.functions import fixed
from shelfmark.functions.fixed import WHITE_SPACE
from shelfmark.functions.identifiers import media_filename, media_name, split_ids
from shelfmark.functions.text import null_clean


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out over all cores. For narrow rows with costly rules: a small file is read in one task, whatever the
    rules cost a row."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def computed_once(df: DataFrame, columns: Sequence[str], condition: Column | None = None) -> DataFrame:
    """The columns of the rows that meet the condition, out of one generator.

    A filter over computed columns would be pushed below them, and so would the null tests of a join key; each then
    computes them anew, several times a row where a rule refers to its input more than once.
    """
    rows = F.array(F.struct(*columns))
    return df.select(F.inline(rows if condition is None else F.filter(rows, lambda _: condition)))


def add_constants(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def clean_strings(df: DataFrame, null_tokens: Sequence[str] = ()) -> DataFrame:
    """Strip every string column; blank text and ``null_tokens`` become null."""
    text = set(string_columns(df))
    if not null_tokens:  # as SQL text: tables can have many hundred columns
        clean = "nullif(trim(BOTH '" + WHITE_SPACE + "' FROM `{0}`), '') AS `{0}`"
        return df.selectExpr(*[clean.format(c) if c in text else f"`{c}`" for c in df.columns])
    return df.select([null_clean(F.col(c), null_tokens).alias(c) if c in text else F.col(c) for c in df.columns])


def prune_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold no value. One aggregation over all columns, one row to the driver."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select([c for c in df.columns if counts[c]])


def align_schema(df: DataFrame, leading: Sequence[str] = fixed.CATALOG_COLUMNS) -> DataFrame:
    """``leading`` first (missing ones as null text), then the other columns by name."""
    known = set(df.columns)
    head = [F.col(c) if c in known else F.lit(None).cast("string").alias(c) for c in leading]
    return df.select(*head, *sorted(known - set(leading)))


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist; the scan reads no others."""
    known = set(df.columns)
    return df.select([c for c in wanted if c in known])


def select_or_null(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns, missing ones as null text."""
    known = set(df.columns)
    return df.select([F.col(c) if c in known else F.lit(None).cast("string").alias(c) for c in wanted])


def resolve_column(df: DataFrame, target: str, candidates: Sequence[str]) -> DataFrame:
    """Rename the first candidate that exists to ``target``; none means a null column."""
    for name in candidates:
        if name in df.columns:
            return df if name == target else df.drop(target).withColumnRenamed(name, target)
    return df.withColumn(target, F.lit(None).cast("string"))


def resolve_lookup(df: DataFrame) -> DataFrame:
    """Column names of the public archive's lookup, which differ between its versions."""
    df = resolve_column(df, "node_id", ["nid", "node", "node_id"])
    return resolve_column(df, "field_identifier", ["field_identifier_external", "field_identifier", "accn"])


def blank_nulls(df: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """Output form: every column as text, null as empty text."""
    return df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns if c not in without])


def rename_for_output(df: DataFrame, names: Mapping[str, str] = fixed.LEGACY_LOOKUP) -> DataFrame:
    """Projection with display names."""
    return df.select([F.col(c).alias(name) for c, name in names.items()])


def record_card(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str] = fixed.CARD_ORDER,
    labels: Mapping[str, str] = fixed.CARD_LABELS,
    hidden: Sequence[str] = fixed.CARD_HIDDEN,
) -> DataFrame:
    """Non-empty fields of each record as (``rank``, ``label``, ``value``) rows, fixed order first.

    Narrow: every row expands in place, nothing is shuffled.
    """
    shown = [c for c in df.columns if c not in set(hidden) and c not in set(key)]
    names = [c for c in order if c in shown] + [c for c in shown if c not in order]
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("rank"),
                F.lit(labels.get(c, c)).alias("label"),
                F.col(c).cast("string").alias("value"),
            )
            for i, c in enumerate(names)
        ]
    )
    return df.select(*key, F.inline(F.filter(fields, lambda f: f["value"] != "")))


def media_variants(df: DataFrame, key: Sequence[str], identifier: Column, count: Column) -> DataFrame:
    """One row per media file of a record: ``base``, ``base_1``, ...; without a count, one per part."""
    base = media_filename(identifier)
    numbered = F.transform(
        F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
        lambda i: F.when(i == 0, base).otherwise(F.concat(base, F.lit("_"), i.cast("string"))),
    )
    names = F.when(count > 0, numbered).otherwise(F.transform(split_ids(identifier), media_name))
    return df.select(*key, F.posexplode(names).alias("position", "media"))


def collection_export(df: DataFrame, image_root: str) -> DataFrame:
    """Saved-collection sheet: fixed columns, image address and sheet formula, null as empty text."""
    url = F.when(
        F.coalesce(F.col("has_image"), F.lit(False)),
        F.concat(F.lit(image_root), media_filename(F.col("field_identifier")), F.lit(".jpg")),
    ).otherwise("")
    formula = F.when(url != "", F.concat(F.lit('=IMAGE("'), url, F.lit('")'))).otherwise("")
    ready = df.withColumns({"image_url": url, "spreadsheet_thumbnail": formula})
    return blank_nulls(select_or_null(ready, fixed.EXPORT_COLUMNS))
