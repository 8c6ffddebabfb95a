"""Tagged-field (MARC-like) records kept as a long table and flattened on demand.

The long table has one row per subfield: ``rec_id``, ``tag``, ``occ`` (occurrence of the tag),
``pos`` (position in the field), ``code``, ``value``. Values are first reduced per occurrence with
map-side combining; what is finally joined into one text per cell is the cell's own content.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.fixed import NOTE_CODES

FieldSpec = tuple[str, Sequence[str], bool]  # tag, subfield codes, whole field too


def _joined(order: Sequence[str], value: str, joiner: str) -> Column:
    pairs = F.sort_array(F.collect_list(F.struct(*order, F.col(value).alias("_v"))))
    return F.array_join(F.transform(pairs, lambda p: p["_v"]), joiner)


def first_values(tagged: DataFrame) -> DataFrame:
    """First non-empty value of each subfield code in each occurrence."""
    return tagged.where("value != ''").groupBy("rec_id", "tag", "occ", "code").agg(F.min_by("value", "pos").alias("value"))


def column_name(tag: str, code: str) -> str:
    return f"new_{tag}_{code.replace('.', 'dot')}"


def _rows(rows: Sequence[dict], schema: str) -> Column:
    """Stated rows as a constant array of structs."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")


def _numbers(spark: SparkSession, names: Sequence[str], key: str, number: str) -> DataFrame:
    """A small table of the names with their numbers that stays in the JVM."""
    rows = [{key: name, number: i} for i, name in enumerate(names)]
    return F.broadcast(spark.range(1).select(F.inline(_rows(rows, f"{key} string, {number} int"))))


def _runs(df: DataFrame, items: str, part: str) -> DataFrame:
    """``rec_id`` and ``runs``: sorted items as arrays of the neighbours that share ``part``."""
    held = F.col(items)
    begins = F.transform(held, lambda x, i: F.when((i == 0) | ~x[part].eqNullSafe(F.get(held, i - 1)[part]), i))
    starts = F.col("starts")
    run = F.transform(starts, lambda s, k: F.slice(held, s + 1, F.coalesce(F.get(starts, k + 1), F.size(held)) - s))
    return df.select("rec_id", held, F.array_compact(begins).alias("starts")).select("rec_id", run.alias("runs"))


def _by_place(held: str, size: int) -> Column:
    """Cells in the order of their places -> an array of ``size`` texts with each cell at its place, gaps filled with empty text."""
    cells = F.col(held)

    def with_gap(c: Column, i: Column) -> Column:
        before = F.coalesce(F.get(cells, i - 1)["place"], F.lit(-1))
        return F.array(F.array_repeat(F.lit(""), c["place"] - before - 1), F.array(c["cell"]))

    end = F.array(F.struct(F.lit(size).alias("place"), F.lit("").alias("cell")))
    return F.flatten(F.flatten(F.transform(F.concat(cells, end), with_gap)))


def tagged_pivot(tagged: DataFrame, spec: Sequence[FieldSpec], single: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """One row per record, one column per (tag, code): the occurrences' first values joined with
    `` | ``; absent -> empty.

    ``whole field`` adds ``new_<tag>_full``: all text of each occurrence. ``single`` subfields are
    taken from the first occurrence of the field only. One grouping, by record: its subfields become
    an array, sorted by the columns they go to, and neighbours yield the cells. The cells become an
    array with a place for every column, so the work is linear in columns and, but for the sort, in
    cells, whatever the length of the specification.
    """
    wanted = [column_name(tag, code) for tag, codes, _ in spec for code in codes]
    once = [column_name(tag, code) for tag, code in single]
    whole = [tag for tag, _, full in spec if full]
    columns = wanted + once + [f"new_{tag}_full" for tag in whole]
    # the specification as tables, a row per tag and a row per column name: small by their nature
    places: dict[str, list[int]] = {}
    for i, name in enumerate(columns):
        places.setdefault(name, []).append(i)
    tags: dict[str, dict] = {tag: {"whole": [], "once": []} for tag, *_ in [*spec, *single]}
    for tag in whole:
        tags[tag]["whole"] = places[f"new_{tag}_full"]
    for tag, code in single:
        tags[tag]["once"] += places[column_name(tag, code)]
    of_tag = _rows(list(tags.values()), "whole array<int>, once array<int>")
    of_name = _rows([{"places": p} for p in places.values()], "places array<int>")

    spark = tagged.sparkSession
    rows = tagged.select("rec_id", "tag", "occ", "pos", "code", "value")
    known = rows.join(_numbers(spark, list(tags), "tag", "tag_no"), "tag", "left")
    name = F.when(F.col("tag_no").isNotNull(), F.concat(F.lit("new_"), "tag", F.lit("_"), F.replace("code", F.lit("."), F.lit("dot"))))
    known = known.withColumn("name", name).join(_numbers(spark, list(places), "name", "name_no"), "name", "left")
    # rows of other tags only say that the record exists
    subfield = F.when(F.col("tag_no").isNotNull(), F.struct("tag_no", "name_no", "occ", "pos", "code", "value"))
    records = known.groupBy("rec_id").agg(F.collect_list(subfield).alias("subfields"))

    no_code, no_pos = F.lit(None).cast("string"), F.lit(None).cast(tagged.schema["pos"].dataType)

    def items(s: Column) -> Column:
        """What a subfield gives to the columns. Of a part, the first item is the text, or all are if it is a whole field."""

        def item(place: Column, full: bool, part_code: Column, pos: Column, code: Column, value: Column) -> Column:
            key = (place.alias("place"), s["occ"].alias("occ"), s["tag_no"].alias("tag_no"), F.lit(full).alias("full"), part_code.alias("code"))
            return F.struct(F.struct(*key).alias("part"), pos.alias("pos"), code.alias("code"), value.alias("value"))

        cells = F.transform(F.get(of_name, s["name_no"])["places"], lambda p: item(p, False, s["code"], s["pos"], no_code, s["value"]))
        field = F.get(of_tag, s["tag_no"])
        full = F.transform(field["whole"], lambda p: item(p, True, no_code, s["pos"], s["code"], s["value"]))
        # every occurrence has an empty cell for its single columns, so a first one without the subfield counts
        empty = F.transform(field["once"], lambda p: item(p, False, no_code, no_pos, no_code, F.lit("")))
        # a missing value holds its place, so that a part which begins with one has no text
        return F.array_compact(F.array(F.when(F.coalesce(s["value"] != "", F.lit(True)), cells), full, empty))

    records = records.select("rec_id", F.sort_array(F.flatten(F.flatten(F.transform("subfields", items)))).alias("items"))

    def is_once(place: Column) -> Column:
        return place.between(len(wanted), len(wanted) + len(once) - 1)

    def text(run: Column) -> Column:
        first = F.get(run, F.lit(0))
        whole_text = F.array_join(F.transform(run, lambda x: x["value"]), " ")
        return F.when(first["part"]["full"], F.nullif(whole_text, F.lit(""))).otherwise(first["value"])

    def piece(run: Column) -> Column:
        part = F.get(run, F.lit(0))["part"]
        return F.struct(part["place"].alias("place"), part["occ"].alias("occ"), text(run).alias("text"))

    pieces = F.filter(F.transform("runs", piece), lambda p: p["text"].isNotNull())
    # an empty text comes last among those of one occurrence where one of them is taken
    ordered = F.transform(pieces, lambda p: F.struct(p["place"], p["occ"], (is_once(p["place"]) & (p["text"] == "")).alias("blank"), p["text"]))
    records = _runs(records, "items", "part").select("rec_id", F.sort_array(ordered).alias("pieces"))

    def cell(run: Column) -> Column:
        first = F.get(run, F.lit(0))
        joined = F.array_join(F.transform(run, lambda p: p["text"]), " | ")
        return F.struct(first["place"].alias("place"), F.when(is_once(first["place"]), first["text"]).otherwise(joined).alias("cell"))

    records = _runs(records, "pieces", "place").select("rec_id", F.transform("runs", cell).alias("held"))
    records = records.select("rec_id", _by_place("held", len(columns)).alias("cells"))
    # as SQL text: a thousand columns in one call
    return records.selectExpr("rec_id", *[f"coalesce(get(cells, {i}), '') AS `{n.replace('`', '``')}`" for i, n in enumerate(columns)])


def read_field_spec(table: DataFrame) -> tuple[list[FieldSpec], list[tuple[str, str]]]:
    """Field specification from a table with ``tag``, ``code`` and ``mode``, for ``tagged_pivot``.

    Modes: ``joined`` (all occurrences), ``single`` (first occurrence only), ``whole`` (the whole field;
    its code is not looked at). Control fields have the code ``ctrl``. The table is a list of the
    format's fields, some hundred rows.
    """
    rows = table.select("tag", "code", "mode").distinct().orderBy("tag", "code", "mode").collect()
    tags = sorted({r.tag for r in rows if r.mode in ("joined", "whole")})
    spec = [
        (tag, [r.code for r in rows if r.tag == tag and r.mode == "joined"], any(r.tag == tag and r.mode == "whole" for r in rows))
        for tag in tags
    ]
    return spec, [(r.tag, r.code) for r in rows if r.mode == "single"]


def flatten_records(tagged: DataFrame, spec: Sequence[FieldSpec], single: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Flat library records: the wanted cells with the joined subject and note, by ``rec_id``."""
    flat = tagged_pivot(tagged, spec, single)
    return flat.join(joined_subject(tagged), "rec_id", "left").join(joined_note(tagged), "rec_id", "left")


def joined_subject(tagged: DataFrame, tag: str = "650", codes: Sequence[str] = ("a", "x")) -> DataFrame:
    """Subfields joined with `` -- `` within an occurrence, occurrences joined with `` | ``."""
    values = first_values(tagged.where((F.col("tag") == tag) & F.col("code").isin(list(codes))))
    rank = F.array_position(F.array(*[F.lit(c) for c in codes]), F.col("code"))
    headings = values.withColumn("rank", rank).groupBy("rec_id", "occ").agg(_joined(["rank"], "value", " -- ").alias("heading"))
    return headings.groupBy("rec_id").agg(_joined(["occ"], "heading", " | ").alias("raw_field_subject"))


def joined_note(tagged: DataFrame, tag: str = "700", codes: Sequence[str] = NOTE_CODES) -> DataFrame:
    """Subfields in the fixed code order within each occurrence, all joined with `` | ``."""
    values = first_values(tagged.where((F.col("tag") == tag) & F.col("code").isin(list(codes))))
    rank = F.array_position(F.array(*[F.lit(c) for c in codes]), F.col("code"))
    return values.withColumn("rank", rank).groupBy("rec_id").agg(_joined(["occ", "rank"], "value", " | ").alias("raw_field_note"))
