"""File sources and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from shelfmark.operators.inventory import clean_item_key
from shelfmark.operators.shape import resolve_lookup, select_existing

REQUEST_LOG = StructType(
    [
        StructField("timestamp", TimestampType()),
        StructField("endpoint", StringType()),
        StructField("method", StringType()),
        StructField("client_ip", StringType()),
        StructField("status_code", IntegerType()),
        StructField("response_time_ms", DoubleType()),
    ]
)


def read_columns(spark: SparkSession, path: str, wanted: Sequence[str]) -> DataFrame:
    """Parquet scan of the wanted columns that exist."""
    return select_existing(spark.read.parquet(path), wanted)


def delta_batches(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the change batches (``full_extract_*`` or ``delta_*``, files or folders), by name."""
    fs, root = _hadoop(spark, folder)
    if not fs.exists(root):
        return []
    paths = [status.getPath() for status in fs.listStatus(root)]
    return sorted(p.toString() for p in paths if p.getName().startswith(("full_extract_", "delta_")))


def read_deltas(spark: SparkSession, batches: Sequence[str]) -> DataFrame:
    """The change batches as one table, with each batch's time.

    The stamp in the batch's name (``delta_<stamp>``: digits, a date first) decides, as it survives a
    copy of the folder; the file's time stands in where a name has none.
    """
    rows = spark.read.option("mergeSchema", True).parquet(*batches)
    path = F.col("_metadata.file_path")
    stamp = F.regexp_replace(F.regexp_extract(path, r"(?:full_extract|delta)_([0-9][0-9T_:-]*)", 1), "[^0-9]", "")
    day = F.try_to_timestamp(F.rpad(F.substring(stamp, 1, 14), 14, "0"), F.lit("yyyyMMddHHmmss"))
    return rows.select("*", F.coalesce(day, F.col("_metadata.file_modification_time")).alias("_batch_time"))


def is_full_extract(batch: str) -> bool:
    """A full extract replaces the master."""
    return batch.rsplit("/", 1)[-1].startswith("full_extract_")


def remove_paths(spark: SparkSession, paths: Sequence[str]) -> None:
    for path in paths:
        fs, target = _hadoop(spark, path)
        fs.delete(target, True)


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def read_items(spark: SparkSession, pattern: str, key: str = "MMS Record ID") -> DataFrame | None:
    """Item CSV exports: all text, over-long lines skipped, header names stripped, quotes out of the key.

    Exports may differ in their columns, so files are grouped by header (one line of each file is
    looked at) and the groups are united by name.
    """
    fs, glob = _hadoop(spark, pattern)
    files = [str(status.getPath().toString()) for status in (fs.globStatus(glob) or [])]
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        header = spark.read.option("header", True).csv(file).columns
        groups.setdefault(tuple(header), []).append(file)

    def read(header: tuple[str, ...], paths: list[str]) -> DataFrame:
        # a line whose number of fields is not the header's comes with its text: shorter ones are kept,
        # longer ones are not, even if the rest is empty
        schema = StructType([StructField(h, StringType()) for h in (*header, "_line")])
        rows = spark.read.option("header", True).option("enforceSchema", True).option("multiLine", True)
        rows = rows.option("escape", '"').option("columnNameOfCorruptRecord", "_line").option("columnPruning", False)
        fields = F.size(F.split(F.regexp_replace("_line", '"(?:[^"]|"")*"', ""), ","))
        kept = rows.schema(schema).csv(paths).where(F.col("_line").isNull() | (fields <= len(header)))
        return kept.select(*[F.col(f"`{h}`").alias(h.strip()) for h in header])

    if not groups:
        return None
    items = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [read(h, paths) for h, paths in groups.items()]
    )
    return items.withColumn(key, clean_item_key(F.col(key))) if key in items.columns else items


def read_request_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REQUEST_LOG).json(path)


def read_lookup_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved JSON pages (arrays of nodes) of the public archive."""
    return resolve_lookup(spark.read.option("multiLine", True).json(path))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """``field_identifier`` of the records of uploaded CSV lists, in the files under ``path``.

    Line breaks and commas inside quotes do not separate, and two quotes inside quotes are one. If the first record
    names a column ``field_identifier`` (in any case), that one is read; else the first column, without the first
    record if it is called ``id`` or has ``identifier`` in its name. Blank values and blank lines are left out. An
    upload is one file, read by one task.
    """
    text = F.regexp_replace("value", "^\ufeff", "")
    # possessive, so that nothing is tried twice; a quote that is never closed goes to the end
    records = F.regexp_extract_all(text, F.lit(r'(?:[^"\r\n]++|"[^"]*+(?:"|\z))++'), 0)
    records = F.filter(F.transform(records, _bare), lambda r: r != "")
    files = spark.read.text(path, wholetext=True).select(records.alias("records")).where(F.size("records") > 0)
    first = _csv_fields(F.element_at("records", 1))
    files = files.select("records", F.transform(first, F.lower).alias("names"))
    at = F.array_position("names", "field_identifier").cast("int")
    named = F.element_at("names", 1)
    skip = F.when((at > 0) | (named == "id") | named.contains("identifier"), 1).otherwise(0)
    rows = files.select(F.greatest(at, F.lit(1)).alias("at"), skip.alias("skip"), F.posexplode("records").alias("line", "record"))
    value = F.get(_csv_fields(F.col("record")), F.col("at") - 1)
    return rows.where(F.col("line") >= F.col("skip")).select(value.alias("field_identifier")).where("field_identifier != ''")


def _bare(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s\u00a0\ufeff]+|[\s\u00a0\ufeff]+$", "")


def _csv_fields(record: Column) -> Column:
    fields = F.regexp_extract_all(record, F.lit(r'(?:^|,)((?:[^",]++|"[^"]*+(?:"|\z))*+)'), 1)

    def plain(field: Column) -> Column:
        # a quoted part that another one follows ends in a quote
        return _bare(F.regexp_replace(field, r'"([^"]*+)(?:"(?=(")|)|\z)', "$1$2"))

    return F.transform(fields, plain)


def list_media(spark: SparkSession, roots: Mapping[str, str], extensions: Sequence[str]) -> DataFrame:
    """``subdir``, ``folder``, ``file_name``, ``path``, ``length`` and ``modified`` of the media files under the roots.

    ``roots``: name to path. ``folder`` is the folder below the root that the file is in, at any depth (null: the root itself).
    ``extensions`` are matched in any case. Spark lists the folders in parallel; contents are not read. Roots that do not exist
    give no rows.
    """
    letters = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in extensions]
    schema = "subdir string, folder string, file_name string, path string, length bigint, modified timestamp"
    found = [spark.createDataFrame([], schema)]
    for name, root in roots.items():
        if not path_exists(spark, root):
            continue
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        files = reader.option("pathGlobFilter", "*{" + ",".join(letters) + "}").load(root)
        fs, target = _hadoop(spark, root)
        below = F.substring("path", len(fs.makeQualified(target).toString().rstrip("/")) + 2, 1 << 30)
        found.append(
            files.select(
                F.lit(name).alias("subdir"),
                F.when(below.contains("/"), F.substring_index(below, "/", 1)).alias("folder"),
                F.substring_index("path", "/", -1).alias("file_name"),
                "path",
                "length",
                F.col("modificationTime").alias("modified"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write next to ``path``, then swap. A table being read is never overwritten in place."""
    spark = df.sparkSession
    token = uuid.uuid4().hex
    staging, previous = f"{path}.staging-{token}", f"{path}.previous-{token}"
    df.write.partitionBy(*partition_by).parquet(staging)
    fs, target = _hadoop(spark, path)
    make = spark._jvm.org.apache.hadoop.fs.Path
    had_previous = fs.exists(target)
    if had_previous and not fs.rename(target, make(previous)):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(make(staging), target):
        if had_previous:
            fs.rename(make(previous), target)
        raise OSError(f"cannot publish {path}")
    if had_previous:
        fs.delete(make(previous), True)


def write_csv(df: DataFrame, path: str, quote_all: bool = False) -> None:
    """CSV report; ``quote_all`` for sheets."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", quote_all).option("escape", '"').csv(path)


def append_snapshot(df: DataFrame, path: str, day: str, column: str = "snapshot_date") -> None:
    """Add one day's rows to a history table; writing a day again replaces it, also by nothing."""
    dated = df.withColumn(column, F.to_date(F.lit(day)))
    if dated.isEmpty():
        # dynamic overwrite leaves partitions alone that get no row
        remove_paths(df.sparkSession, [f"{path}/{column}={day}"])
        return
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).parquet(path)


def report_dates(names: DataFrame, column: str = "file_name") -> DataFrame:
    """Add ``report_date`` from a dated report name (``name_yyyyMMdd_...``)."""
    digits = F.nullif(F.regexp_extract(column, r"_([0-9]{8})(?:_|\.)", 1), F.lit(""))
    return names.withColumn("report_date", F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date"))


def expired_reports(names: DataFrame, today, column: str = "file_name") -> DataFrame:
    """Dated reports from before ``today`` (a date column or text)."""
    return report_dates(names, column).where(F.col("report_date") < F.to_date(F.lit(today)))


def drop_expired_reports(spark: SparkSession, folder: str, today: str) -> list[str]:
    """Delete dated reports of a folder from before today; returns their names."""
    fs, root = _hadoop(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    if not names:
        return []
    listing = spark.createDataFrame([(n,) for n in names], "file_name string")
    expired = sorted(r.file_name for r in expired_reports(listing, today).collect())
    for name in expired:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"), True)
    return expired
