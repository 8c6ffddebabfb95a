"""Related records and the artifact-creator graph."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.identifiers import has_part
from shelfmark.functions.text import parse_subjects, strip
from shelfmark.operators.merge import lookup_join
from shelfmark.operators.sample import sample_n
from shelfmark.operators.search import record_lookup
from shelfmark.operators.shape import computed_once
from shelfmark.session import cut_lineage


def related_to(catalog: DataFrame, identifier: str, n: int = 4, key: str = "id", seed: str = "related") -> DataFrame:
    """Up to n records with an image that share genre, agent or main subject with one record.

    The record itself (one row) is read first; its values become literals of the scan's filter.
    Without any related record, a random draw of n stands in.
    """
    fields = ["field_identifier", "field_subject", "field_genre", "field_linked_agent"]
    record = record_lookup(catalog, identifier).select(*fields, key).orderBy(key).first()
    others = catalog.where(~has_part(F.col("field_identifier"), identifier) & F.col("has_image"))
    others = others.where("field_identifier IS NOT NULL")
    columns = ["title", "field_identifier", "has_image", "image_count"]
    conditions = []
    if record and record.field_subject:
        conditions.append(F.col("field_subject").contains(record.field_subject.split(";")[0].strip()))
    if record and record.field_genre:
        conditions.append(F.col("field_genre") == record.field_genre)
    if record and record.field_linked_agent:
        conditions.append(F.col("field_linked_agent") == record.field_linked_agent)
    if conditions:
        # the first n rows are kept, so that asking whether there are any does not compute the catalogue once more
        found = computed_once(others, [*columns, key] if key not in columns else columns, reduce(lambda a, b: a | b, conditions))
        found = cut_lineage(found.orderBy("field_identifier", key).limit(n).select(*columns))
        if not found.isEmpty():
            return found
    return sample_n(others, key, n, seed).select(*columns)


def related_records(catalog: DataFrame, key: str, n: int = 4) -> DataFrame:
    """For every record, the first n others with an image that share genre, agent or main subject.

    Exact without pairing records: per match key only its first n+1 candidates can be among a
    record's first n (one of them may be the record itself), so each key carries at most n+1.
    """
    genre, agent = F.col("field_genre"), F.col("field_linked_agent")
    subjects = parse_subjects(F.col("field_subject"))

    def match_keys(subject_keys):
        tag = lambda kind, c: F.when(c != "", F.concat(F.lit(kind), c))
        return F.array_distinct(
            F.array_compact(F.concat(F.array(tag("g:", genre), tag("a:", agent)), F.transform(subject_keys, lambda s: tag("s:", s))))
        )

    candidates = catalog.where("has_image AND field_identifier IS NOT NULL").select(
        F.explode(match_keys(subjects)).alias("_match"), F.col("field_identifier").alias("related_identifier"), F.col(key).alias("related_key")
    )
    nearest = Window.partitionBy("_match").orderBy("related_identifier", "related_key")
    candidates = candidates.withColumn("_r", F.row_number().over(nearest)).where(F.col("_r") <= n + 1)
    # a key's candidates travel as one list, so that joining them multiplies no rows that are then sorted
    lists = candidates.groupBy("_match").agg(F.collect_list(F.struct("related_identifier", "related_key")).alias("_list"))

    wanted = catalog.select(key, F.explode(match_keys(F.slice(subjects, 1, 1))).alias("_match"))
    others = F.filter("_list", lambda c: F.col(key) != c["related_key"])
    # dealt by record before they are grouped: grouping in the tasks of the join would hold all their lists
    found = lookup_join(wanted, lists, ["_match"]).select(key, others.alias("_list")).where(F.size("_list") > 0).repartition(key)
    # a pair can come from several match keys
    best = F.slice(F.array_distinct(F.sort_array(F.flatten(F.collect_list("_list")))), 1, n)
    ranked = found.groupBy(key).agg(best.alias("_best")).select(key, F.posexplode("_best").alias("_place", "_found"))
    return ranked.select(key, "_found.related_key", "_found.related_identifier", (F.col("_place") + 1).alias("rank"))


def graph_expand(catalog: DataFrame, nodes: DataFrame, key: str = "id", n: int = 10) -> DataFrame:
    """For each node (artifact with a creator), up to n other artifacts with an image by that creator.

    Per creator only the first n+1 artifacts can be needed.
    """
    first = Window.partitionBy("field_linked_agent").orderBy("field_identifier", key)
    artifacts = computed_once(
        catalog.where("has_image"), ["field_linked_agent", "field_identifier", "title", key],
        F.col("field_linked_agent").isNotNull() & F.col("field_identifier").isNotNull(),
    )
    leading = artifacts.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= n + 1).select(
        F.col("field_linked_agent").alias("creator"),
        F.col("field_identifier").alias("related_identifier"),
        F.col("title").alias("related_title"),
        "_r",
    )
    wanted = nodes.select(F.col("field_identifier").alias("node"), F.col("field_linked_agent").alias("creator")).distinct()
    pairs = lookup_join(wanted, leading, ["creator"]).where(F.col("node") != F.col("related_identifier"))
    # of n+1 candidates without the node itself, n are left, or one too many
    within = Window.partitionBy("node", "creator").orderBy("_r")
    kept = pairs.withColumn("_k", F.row_number().over(within)).where(F.col("_k") <= n)
    return kept.select("node", "creator", "related_identifier", "related_title")


def graph_edges(expanded: DataFrame) -> DataFrame:
    """Edges (``source``, ``target``) from every artifact of the expansion to its creator's hub."""
    hub = F.concat(F.lit("creator_"), F.col("creator"))
    ends = F.array(F.col("node"), F.col("related_identifier"))
    return expanded.select(F.explode(ends).alias("source"), hub.alias("target")).distinct()
