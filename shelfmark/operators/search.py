"""Catalogue search: predicates from a ``SearchSpec``, ranking, pages, lookups, facets."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import fixed
from shelfmark.functions.identifiers import has_part
from shelfmark.functions.text import split_literal, strip
from shelfmark.functions.unicode import fold_text
from shelfmark.operators.merge import keep_one, lookup_join
from shelfmark.operators.shape import select_or_null
from shelfmark.operators.unify import SourceLabels

# What counts as one word of the search box.
_WORDS = re.compile(r'(".*?"|\bAND\b|\bOR\b|\bNOT\b|\S+)', re.IGNORECASE)
_OPERATOR = re.compile(r"\b(AND|OR|NOT)\b", re.IGNORECASE)


@dataclass(frozen=True)
class SearchSpec:
    """State of the search form. Empty means "any"."""

    term: str = ""
    system: str = ""
    genre: str = ""
    creator: str = ""
    subject: str = ""
    place: str = ""
    decade: int | None = None
    min_year: int | None = None
    max_year: int | None = None
    images_only: bool = False
    audio_only: bool = False
    shared_ids: Sequence[str] = field(default_factory=tuple)
    labels: SourceLabels = SourceLabels()


def parse_terms(text: str) -> list[list[tuple[bool, str]]]:
    """Search text -> alternatives of (negated, term) lists that must all hold.

    With AND, OR, NOT or quotes: words next to each other must all hold, NOT binds to the next
    word, AND binds tighter than OR. Otherwise: terms separated by commas, any may hold.
    """
    if not (_OPERATOR.search(text) or '"' in text):
        return [[(False, t.strip())] for t in text.split(",") if t.strip()]
    alternatives: list[list[tuple[bool, str]]] = [[]]
    negated = False
    for word in _WORDS.findall(text):
        operator = word.upper()
        if operator == "OR":
            alternatives.append([])
            negated = False
        elif operator == "NOT":
            negated = True
        elif operator == "AND":
            negated = False
        else:
            term = re.sub(r'^"|"$', "", word)
            if term:
                alternatives[-1].append((negated, term))
            negated = False
    return [a for a in alternatives if a]


def term_matches(term: str) -> Column:
    """The folded search text or the identifier contains the term, literally."""
    low = term.lower()
    return F.coalesce(F.col("search_text").contains(fold_text(low)), F.lit(False)) | F.coalesce(
        F.lower("field_identifier").contains(low), F.lit(False)
    )


def text_predicate(text: str) -> Column | None:
    """Boolean or comma search as one predicate; null where the text has no term."""
    alternatives = [
        reduce(lambda a, b: a & b, [~term_matches(t) if negated else term_matches(t) for negated, t in group])
        for group in parse_terms(text)
    ]
    return reduce(lambda a, b: a | b, alternatives) if alternatives else None


def matching(catalog: DataFrame, text: str, made: Column | None = None, name: str = "score") -> DataFrame:
    """Records that meet the search text, with the column ``made`` if there is one.

    Match and column come out of one generator. A plain filter would be pushed below the projection that
    folds the text, and would fold it anew for every term.
    """
    match = text_predicate(text)
    if match is None:
        return catalog if made is None else catalog.withColumn(name, made)
    made = F.lit(True) if made is None else made
    found = catalog.select("*", F.explode(F.filter(F.array(made), lambda _: match)).alias("_made"))
    return found.withColumnRenamed("_made", name)


def _facet_predicates(spec: SearchSpec) -> dict[str, Column]:
    """Predicates of the facet fields, by facet."""
    contains = {
        "genre": ("field_genre", spec.genre), "creator": ("field_linked_agent", spec.creator),
        "subject": ("field_subject", spec.subject), "place": ("field_place_published", spec.place),
    }
    found = {name: F.col(column).contains(value) for name, (column, value) in contains.items() if value}
    if spec.decade is not None:
        found["decade"] = F.col("decade_created") == spec.decade
    return found


def _common_predicates(spec: SearchSpec) -> list[Column]:
    """Predicates that hold for every facet, but for the search text's."""
    found: list[Column] = []
    if spec.system == "Reference":
        found.append(F.col("field_collection_type") == "Research/Reference Books")
    elif spec.system == spec.labels.library:
        found.append((F.col("source_system") == spec.system) & (F.col("field_collection_type") == "Library"))
    elif spec.system:
        found.append(F.col("source_system") == spec.system)
    if spec.images_only:
        found.append(F.col("has_image"))
    if spec.audio_only:
        found.append(F.col("has_audio"))
    if spec.min_year is not None:
        found.append(F.col("year_created") >= spec.min_year)
    if spec.max_year is not None:
        found.append(F.col("year_created") <= spec.max_year)
    return found


def search(catalog: DataFrame, spec: SearchSpec, uploaded: DataFrame | None = None, scored: bool = False) -> DataFrame:
    """Records that meet the spec. A shared collection replaces every other condition. ``scored`` adds ``score``."""
    score = rank_score(spec.term) if scored else None
    if spec.shared_ids:
        found = catalog.where(F.col("field_identifier").isin(list(spec.shared_ids)))
        return found.withColumn("score", score) if scored else found
    if uploaded is not None:
        catalog = bulk_id_filter(catalog, uploaded)
    for predicate in [*_common_predicates(spec), *_facet_predicates(spec).values()]:
        catalog = catalog.where(predicate)
    if spec.term:
        return matching(catalog, spec.term, score) if scored else matching(catalog, spec.term, name="_met").drop("_met")
    return catalog.withColumn("score", score) if scored else catalog


def bulk_id_filter(catalog: DataFrame, uploaded: DataFrame, column: str = "field_identifier") -> DataFrame:
    """Records whose identifier is in the uploaded list, in any case.

    A semi join: Spark broadcasts the list while its measured size is small, else both sides shuffle.
    """
    wanted = uploaded.select(F.lower(F.col(column)).alias("_wanted")).distinct()
    keyed = catalog.withColumn("_wanted", F.lower("field_identifier"))
    return lookup_join(keyed, wanted, ["_wanted"], "left_semi").drop("_wanted")


def rank_score(text: str) -> Column:
    """Weighted sum over the positive terms, plus the image boost."""
    terms = [t.lower() for group in parse_terms(text) for negated, t in group if not negated]
    weights = fixed.RANK_WEIGHTS

    def points(condition: Column, name: str) -> Column:
        return F.when(condition, F.lit(weights[name])).otherwise(F.lit(0.0))

    score = points(F.col("has_image"), "image_boost")
    for term in terms:
        score = score + points(F.lower("field_identifier") == term, "exact_identifier")
        for column in weights:
            if column == "search_text":
                score = score + points(F.col(column).contains(fold_text(term)), column)
            elif column not in ("exact_identifier", "image_boost"):
                score = score + points(F.lower(column).contains(term), column)
    return score


def ranked_search(catalog: DataFrame, spec: SearchSpec, limit: int = 48, offset: int = 0, tie: str = "id") -> DataFrame:
    """One page of results, best first; without a term, images first, then by identifier."""
    found = search(catalog, spec, scored=bool(spec.term))
    order = [F.desc_nulls_last("has_image"), F.asc_nulls_last("field_identifier"), F.asc(tie)]
    if spec.term:
        order = [F.desc("score"), *order]
    return found.orderBy(*order).offset(offset).limit(limit)


@dataclass(frozen=True)
class By:
    """One column of an order; nulls come last either way."""

    column: str
    descending: bool = False

    def sort(self) -> Column:
        return F.desc_nulls_last(self.column) if self.descending else F.asc_nulls_last(self.column)

    def after(self, value: Column) -> Column:
        """The column comes after ``value``, which is not null."""
        column = F.col(self.column)
        return F.coalesce(column < value if self.descending else column > value, F.lit(True))


# Orders end in a column without repeats, so that every row has a place of its own.
BROWSE_ORDER = (By("has_image", True), By("field_identifier"), By("id"))
SCORE_ORDER = (By("score", True), *BROWSE_ORDER)
DOSSIER_ORDER = (By("has_image", True), By("title"), By("id"))


def after_cursor(df: DataFrame, order: Sequence[By], cursor: str) -> Column:
    """The row comes after the cursor's: equal in some first columns of the order, later in the next one."""
    values = json.loads(cursor)
    met, equal = F.lit(False), F.lit(True)
    for by in order:
        value = F.lit(values[by.column]).cast(df.schema[by.column].dataType)
        if values[by.column] is not None:
            met = met | (equal & by.after(value))
        equal = equal & F.col(by.column).eqNullSafe(value)
    return met


def cursor_page(df: DataFrame, order: Sequence[By], limit: int, cursor: str | None = None) -> DataFrame:
    """The first rows of an order, or those after a cursor, with the ``cursor`` of every row.

    The last row's cursor asks for the next page. No row before it is sorted again, so deep pages cost what the first one does.
    """
    rows = df if cursor is None else df.where(after_cursor(df, order, cursor))
    place = F.to_json(F.struct(*[F.col(by.column) for by in order]), {"ignoreNullFields": "false"})
    return rows.orderBy(*[by.sort() for by in order]).limit(limit).withColumn("cursor", place)


def search_totals(catalog: DataFrame, spec: SearchSpec) -> DataFrame:
    """Matching and overall record counts from one scan."""
    met = F.lit(True)
    if spec.shared_ids:
        met = F.col("field_identifier").isin(list(spec.shared_ids))
    else:
        text = text_predicate(spec.term) if spec.term else None
        for predicate in [*_common_predicates(spec), *_facet_predicates(spec).values(), *([] if text is None else [text])]:
            met = met & predicate
    return catalog.agg(F.count_if(met).alias("filtered"), F.count("*").alias("total"))


FACETS = {
    # facet: (column, split into values, counts distinct records)
    "creator": ("field_linked_agent", True),
    "subject": ("field_subject", True),
    "place": ("field_place_published", True),
    "genre": ("field_genre", False),
    "decade": ("decade_created", False),
}


def responsive_facets(
    catalog: DataFrame, spec: SearchSpec, top: int | None = None, facets: Sequence[str] = tuple(FACETS)
) -> DataFrame:
    """Values and counts of every facet, each under all conditions but its own, from one scan.

    A record that fails no facet condition feeds every facet; one that fails exactly one feeds
    only that facet. Split facets count distinct identifiers, the others count rows. The first
    aggregation is keyed by (facet, value, identifier), so a value held by a third of the records
    is counted in many tasks. ``top`` keeps that many values per facet, for a page.
    """
    conditions = _facet_predicates(spec)
    fails = {f: ~F.coalesce(conditions[f], F.lit(False)) if f in conditions else F.lit(False) for f in FACETS}
    if spec.shared_ids:
        rows = catalog.where(F.col("field_identifier").isin(list(spec.shared_ids)))
        fails = {f: F.lit(False) for f in FACETS}
    else:
        rows = reduce(lambda df, p: df.where(p), _common_predicates(spec), catalog)
        rows = matching(rows, spec.term, name="_met").drop("_met") if spec.term else rows

    failed = reduce(lambda a, b: a + b, [f.cast("int") for f in fails.values()])
    rows = rows.withColumn("_failed", failed).where("_failed <= 1")

    def values(facet: str) -> Column:
        column, split = FACETS[facet]
        text = F.col(column).cast("string")
        listed = F.transform(split_literal(text, "|"), strip) if split else F.array(text)
        feeds = text.isNotNull() & ((F.col("_failed") == 0) | fails[facet])
        tagged = F.transform(listed, lambda v: F.struct(F.lit(facet).alias("facet"), v.alias("value")))
        if split:
            tagged = F.filter(tagged, lambda t: t["value"] != "")
        return F.when(feeds, tagged).otherwise(F.array().cast("array<struct<facet:string,value:string>>"))

    exploded = rows.select("field_identifier", F.inline(F.concat(*[values(f) for f in facets])))
    per_record = exploded.groupBy("facet", "value", "field_identifier").agg(F.count("*").alias("_rows"))
    split_facets = [f for f in facets if FACETS[f][1]]
    weight = F.when(F.col("facet").isin(split_facets), F.lit(1)).otherwise(F.col("_rows"))
    counts = per_record.groupBy("facet", "value").agg(F.sum(weight).alias("count"))
    if top is None:
        return counts
    window = Window.partitionBy("facet").orderBy(F.desc("count"), F.asc("value"))
    return counts.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= top).drop("_rank")


def decade_timeline(catalog: DataFrame, spec: SearchSpec) -> DataFrame:
    """Records by decade under all conditions but the decade's."""
    rows = search(catalog, SearchSpec(**{**spec.__dict__, "decade": None})).where("decade_created IS NOT NULL")
    return rows.groupBy(F.col("decade_created").alias("decade")).agg(F.count("*").alias("count"))


def catalog_view(gold: DataFrame, preferred: str, tie: str = "id") -> DataFrame:
    """Explorer columns, one row per identifier (the id stands in for a missing one), the
    preferred source first."""
    view = select_or_null(gold, [*fixed.EXPLORER_COLUMNS, *([tie] if tie not in fixed.EXPLORER_COLUMNS else [])])
    key = F.coalesce("field_identifier", F.col("id").cast("string"))
    first = F.when(F.col("source_system") == preferred, 1).otherwise(2)
    return keep_one(view, [key], [first.asc(), F.col(tie).asc()], collapse_null_keys=True)


def records_page(catalog: DataFrame, limit: int, offset: int = 0, after_id: int | None = None) -> DataFrame:
    """One page by id. ``after_id`` continues from the last id seen, which stays cheap on deep pages.

    The page's last id is looked for first, so that only the records up to it are computed whole.
    """
    rows = catalog if after_id is None else catalog.where(F.col("id") > after_id)
    last = rows.select("id").orderBy("id").limit(offset + limit).agg(F.max("id")).first()[0]
    upto = F.col("id").isNull() if last is None else F.col("id").isNull() | (F.col("id") <= last)
    return rows.where(upto).orderBy("id").offset(offset).limit(limit)


def simple_search(catalog: DataFrame, text: str, limit: int = 50, offset: int = 0, tie: str = "id") -> DataFrame:
    """Title, description or identifier contains the text in any case; images first, then title."""
    low = text.lower()
    columns = ["title", "field_description_long", "field_identifier"]
    met = reduce(lambda a, b: a | b, [F.coalesce(F.lower(c).contains(low), F.lit(False)) for c in columns])
    order = [F.desc_nulls_last("has_image"), F.asc_nulls_last("title"), F.asc(tie)]
    return catalog.where(met).orderBy(*order).offset(offset).limit(limit)


def record_lookup(catalog: DataFrame, identifier: str) -> DataFrame:
    """Records that carry the identifier, alone or as one part. The scan filters by containment first."""
    held = F.col("field_identifier").contains(identifier)
    return catalog.where(held & has_part(F.col("field_identifier"), identifier))


def record_by_id(catalog: DataFrame, wanted: str) -> DataFrame:
    """The record with this identifier or this numeric id."""
    met = F.col("field_identifier") == wanted
    if wanted.isdigit():
        met = met | (F.col("id") == int(wanted))
    return catalog.where(met).orderBy("id").limit(1)


def named_collection(catalog: DataFrame, words: Sequence[str], source: str, prefix: str) -> DataFrame:
    """Credit line has all words, or the source's identifiers start with the prefix."""
    credit = reduce(lambda a, b: a & b, [F.lower("field_credit_line").contains(w.lower()) for w in words])
    own = (F.col("source_system") == source) & F.col("field_identifier").startswith(prefix)
    return catalog.where(F.coalesce(credit, F.lit(False)) | F.coalesce(own, F.lit(False)))


def dossier_member(catalog: DataFrame, column: str, value: str) -> DataFrame:
    """Records with ``value`` as one of the delimited column's values."""
    listed = F.transform(split_literal(F.col(column), "|"), strip)
    return catalog.where(F.array_contains(listed, F.lit(value)))


def dossier_contains(catalog: DataFrame, column: str, value: str) -> DataFrame:
    """Records with ``value`` anywhere in the column; count them for the total."""
    return catalog.where(F.col(column).contains(value))


def dossier_page(found: DataFrame, limit: int | None = None, tie: str = "id") -> DataFrame:
    """Dossier order: images first, then title."""
    ordered = found.orderBy(F.desc_nulls_last("has_image"), F.asc_nulls_last("title"), F.asc(tie))
    return ordered if limit is None else ordered.limit(limit)
