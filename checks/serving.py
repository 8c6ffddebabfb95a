"""Dashboard metrics, search, facets, related records, retrieval, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import base, sql
from checks.base import query
from checks.views import view
from shelfmark.functions import fixed
from shelfmark.operators import metrics, related, retrieval, sample, search, shape
from shelfmark.operators.search import SearchSpec
from shelfmark.plans.gold import normalize_catalog
from shelfmark.sources.files import read_columns

c = F.col
COLLECTION = f"coalesce({sql.clean('field_collection_type')}, '(Unknown Collection)')"
GENRE = f"coalesce({sql.clean('field_genre')}, '(Unknown Genre)')"


@query("genre_distribution", "gold_text", f"""
SELECT collection, CASE WHEN genre IN (SELECT {GENRE} AS g FROM gold_text GROUP BY g ORDER BY count(*) DESC, g LIMIT 10) THEN genre ELSE 'Other' END AS final_genre,
  count(*) AS total_count FROM (SELECT {COLLECTION} AS collection, {GENRE} AS genre FROM gold_text) GROUP BY ALL""")
def genre_distribution(spark, sf):
    return metrics.genre_distribution(normalize_catalog(base.unified(spark, sf)))


@query("decade_histogram", "gold_text", "SELECT decade_created, count(*) AS total_objects FROM gold_text WHERE decade_created BETWEEN 1800 AND 2025 GROUP BY ALL")
def _(spark, sf):
    return metrics.collection_by_decade(base.gold(spark, sf))


_SUBJECTS = f"SELECT {COLLECTION} AS collection, {sql.strip('p')} AS subject FROM (SELECT field_collection_type, unnest(string_split(field_subject, '|')) AS p FROM gold_text WHERE field_subject <> '')"


@query("subject_synergy", "gold_text", f"""
SELECT collection, subject, count(*) AS total_count FROM ({_SUBJECTS})
WHERE subject IN (SELECT subject FROM ({_SUBJECTS}) GROUP BY subject ORDER BY count(*) DESC, subject LIMIT 20) GROUP BY ALL""")
def _(spark, sf):
    return metrics.subject_synergy(base.gold(spark, sf))


@query("temporal_geography", "gold_text", f"""
SELECT decade_created, region, count(*) AS total_items FROM (
  SELECT decade_created, {sql.strip('p')} AS region FROM (SELECT decade_created, unnest(string_split(field_geographic_subject, ' | ')) AS p FROM gold_text
    WHERE field_geographic_subject <> '' AND decade_created BETWEEN 1850 AND 2000)) WHERE region <> '' GROUP BY ALL HAVING count(*) > 15""")
def _(spark, sf):
    return metrics.temporal_geography(base.gold(spark, sf))


@query("prolific_creators", "gold_text", f"""
SELECT creator, count(*) AS total_works FROM (SELECT {sql.strip('p')} AS creator FROM (SELECT unnest(string_split(field_linked_agent, '|')) AS p FROM gold_text WHERE field_linked_agent <> ''))
WHERE creator <> '' GROUP BY creator ORDER BY total_works DESC, creator LIMIT 15""")
def _(spark, sf):
    return metrics.prolific_creators(base.gold(spark, sf))


@query("holding_type", "mus", "SELECT field_credit_line, count(*) AS count FROM mus GROUP BY ALL")
def _(spark, sf):
    return metrics.holding_type(view(spark, sf, "mus"), "field_credit_line")


@query("media_completeness", "gold", """
SELECT source_system, count(*) AS total_records, CAST(sum(CAST(has_image AS INT)) AS BIGINT) AS images_found,
  round(CAST(sum(CAST(has_image AS INT)) AS DOUBLE) * 100.0::DOUBLE / count(*), 1) AS completeness_pct FROM gold GROUP BY ALL""")
def _(spark, sf):
    return metrics.media_completeness(base.gold(spark, sf))


def _rate(column: str, name: str) -> str:
    return f"round(CAST(count({column}) AS DOUBLE) * 100.0::DOUBLE / count(*), 1) AS {name}"


@query("system_health", "gold_text", f"""
SELECT source_system, count(*) AS total_records, {_rate('title', 'pct_has_title')}, {_rate('field_linked_agent', 'pct_has_creator')},
  {_rate('field_edtf_date_created', 'pct_has_date')}, {_rate('field_genre', 'pct_has_genre')}, {_rate('field_subject', 'pct_has_subject')} FROM gold_text GROUP BY ALL""")
def _(spark, sf):
    return metrics.system_health(base.gold(spark, sf))


_SCOPE = {"Museum": ("mus", 11), "Library": ("lib", 12), "Archive": ("web", 4), "Items": ("items", 3), "Requests": ("requests", 5)}


@query("total_scope", "mus lib web items requests", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS total_records, {w}::BIGINT AS total_columns, count(*) * {w}::BIGINT AS total_values FROM {v}"
    for n, (v, w) in _SCOPE.items()))
def _(spark, sf):
    return metrics.total_scope({n: view(spark, sf, v) for n, (v, _) in _SCOPE.items()})


@query("top_values", "gold_text", "SELECT field_genre, count(*) AS count FROM gold_text WHERE field_genre IS NOT NULL GROUP BY ALL ORDER BY count DESC, field_genre LIMIT 5")
def _(spark, sf):
    return metrics.top_values(base.gold(spark, sf), "field_genre")


@query("column_scan", "", "SELECT doc_id, lang, source FROM documents")
def _(spark, sf):
    return read_columns(spark, f"{sf}/documents.parquet", ["doc_id", "lang", "source", "absent_column"])


_EXPLORER = sql.columns(
    [n for n in fixed.EXPLORER_COLUMNS if not n.endswith("audio") and n != "audio_count"], sql.GOLD_KNOWN
)


@query("catalog_view", "gold", f"""
SELECT {_EXPLORER}, false AS has_audio, 0 AS audio_count FROM gold
QUALIFY row_number() OVER (PARTITION BY coalesce(field_identifier, CAST(id AS VARCHAR)) ORDER BY CASE WHEN source_system = 'Museum' THEN 1 ELSE 2 END, id) = 1""")
def _(spark, sf):
    return search.catalog_view(base.gold(spark, sf), preferred="Museum")


_DENSE = "SELECT * REPLACE (row_number() OVER (ORDER BY CASE WHEN source_system = 'Library' THEN 0 ELSE 1 END, record_id) AS id) FROM gold"
_PAGE = ["id", "field_identifier", "title", "field_genre", "source_system", "year_created", "has_image"]
_WHOLE = sql.UNIFIED_COLUMNS + ["year_created", "decade_created", "image_count", "has_image"]


@query("records_page", "gold", f"""
SELECT {sql.columns(_WHOLE, sql.GOLD_KNOWN, text=True)}, coalesce(CAST(year_created AS VARCHAR), '') AS field_edtf_date_created_year,
  coalesce(CAST(decade_created AS VARCHAR), '') AS field_edtf_date_created_decade, coalesce(CAST({sql.year('original_date')} AS VARCHAR), '') AS original_date_year,
  coalesce(CAST({sql.decade(sql.year('original_date'))} AS VARCHAR), '') AS original_date_decade, '0' AS audio_count, 'false' AS has_audio
FROM ({_DENSE}) ORDER BY CAST(id AS BIGINT) LIMIT 50 OFFSET 100""")
def _(spark, sf):
    page = search.records_page(base.gold_plan(spark, sf, with_ids=True), 50, 100)
    return shape.blank_nulls(page, without=["search_text"])


@query("keyset_page", "gold", f"SELECT {', '.join(_PAGE)} FROM gold WHERE id > 1500 ORDER BY id LIMIT 48")
def _(spark, sf):
    return search.records_page(base.gold(spark, sf).select(_PAGE), 48, after_id=1500)


@query("legacy_lookup", "gold", "SELECT " + ", ".join(
    f'{k if k in sql.GOLD_KNOWN else "CAST(NULL AS VARCHAR)"} AS "{v}"' for k, v in fixed.LEGACY_LOOKUP.items()) + " FROM gold ORDER BY id LIMIT 50")
def _(spark, sf):
    return shape.rename_for_output(search.records_page(base.gold(spark, sf), 50), fixed.LEGACY_LOOKUP)


@query("record_lookup", "gold", "SELECT id, field_identifier, title FROM gold WHERE field_identifier = 'XB115' OR field_identifier LIKE 'XB115;%' OR field_identifier LIKE '%; XB115;%' OR field_identifier LIKE '%; XB115'")
def _(spark, sf):
    return search.record_lookup(base.gold(spark, sf), "XB115").select("id", "field_identifier", "title")


@query("record_by_id", "gold", "SELECT id, field_identifier, title FROM gold WHERE field_identifier = '203' OR id = 203 ORDER BY id LIMIT 1")
def _(spark, sf):
    return search.record_by_id(base.gold(spark, sf), "203").select("id", "field_identifier", "title")


@query("bulk_id_filter", "gold web", "SELECT id, field_identifier FROM gold WHERE lower(field_identifier) IN (SELECT lower(trim(field_identifier)) FROM web)")
def _(spark, sf):
    uploaded = view(spark, sf, "web").select(F.trim("field_identifier").alias("field_identifier"))
    return search.bulk_id_filter(base.gold(spark, sf), uploaded).select("id", "field_identifier")


@query("shared_collection", "gold", "SELECT id, field_identifier FROM gold WHERE field_identifier IN ('XB1', '2022.3.3', 'XB21', 'nothing')")
def _(spark, sf):
    spec = SearchSpec(term="ignored", shared_ids=("XB1", "2022.3.3", "XB21", "nothing"))
    return search.search(base.gold(spark, sf), spec).select("id", "field_identifier")


_FACETED = SearchSpec(system="Library", genre="POST", creator="src1", min_year=1850, max_year=2000)


@query("faceted_filter", "gold", """
SELECT id, field_identifier, field_genre, year_created FROM gold WHERE source_system = 'Library' AND field_collection_type = 'Library'
  AND field_genre LIKE '%POST%' AND field_linked_agent LIKE '%src1%' AND year_created >= 1850 AND year_created <= 2000""")
def _(spark, sf):
    return search.search(base.gold(spark, sf), _FACETED).select("id", "field_identifier", "field_genre", "year_created")


@query("simple_search", "gold", """
SELECT id, title, field_identifier FROM gold WHERE title ILIKE '%red%' OR field_description_long ILIKE '%red%' OR field_identifier ILIKE '%red%'
ORDER BY has_image DESC, title ASC NULLS LAST, id LIMIT 50""")
def _(spark, sf):
    return search.simple_search(base.gold(spark, sf), "Red").select("id", "title", "field_identifier")


@query("named_collection", "gold", """
SELECT id, field_identifier, title FROM gold WHERE (lower(field_credit_line) LIKE '%giftof%' AND lower(field_credit_line) LIKE '%fernanda%')
  OR (source_system = 'Museum' AND field_identifier LIKE '2022.7%')""")
def _(spark, sf):
    found = search.named_collection(base.gold(spark, sf), ["giftof", "Fernanda"], "Museum", "2022.7")
    return found.select("id", "field_identifier", "title")


@query("dossier_member", "gold", f"SELECT id, title FROM gold WHERE list_contains(list_transform(string_split(field_subject, '|'), lambda p: {sql.strip('p')}), 'Subject 3')")
def _(spark, sf):
    return search.dossier_member(base.gold(spark, sf), "field_subject", "Subject 3").select("id", "title")


@query("dossier_contains", "gold", "SELECT id, title FROM gold WHERE field_linked_agent LIKE '%Brand#2%'")
def _(spark, sf):
    return search.dossier_contains(base.gold(spark, sf), "field_linked_agent", "Brand#2").select("id", "title")


@query("dossier_total", "gold", "SELECT count(*) AS total FROM gold WHERE field_linked_agent LIKE '%Brand#2%'")
def _(spark, sf):
    return search.dossier_contains(base.gold(spark, sf), "field_linked_agent", "Brand#2").agg(F.count("*").alias("total"))


@query("dossier_page", "gold", "SELECT id, title FROM gold WHERE field_linked_agent LIKE '%Brand#2%' ORDER BY has_image DESC, title ASC NULLS LAST, id LIMIT 48")
def _(spark, sf):
    found = search.dossier_contains(base.gold(spark, sf), "field_linked_agent", "Brand#2")
    return search.dossier_page(found, 48).select("id", "title")


def _has(term: str, folded: str | None = None) -> str:
    return f"(coalesce(contains(search_text, {sql.lit(folded or term)}), false) OR coalesce(contains(lower(field_identifier), {sql.lit(term)}), false))"


_BOOLEAN = 'red widget NOT "small ring" OR "que la" AND Été OR xb1'
_BOOLEAN_SQL = f"({_has('red')} AND {_has('widget')} AND NOT {_has('small ring')}) OR ({_has('que la')} AND {_has('été', 'ete')}) OR {_has('xb1')}"


@query("boolean_search", "gold", f"SELECT id, field_identifier FROM gold WHERE {_BOOLEAN_SQL}")
def _(spark, sf):
    return search.search(base.gold(spark, sf), SearchSpec(term=_BOOLEAN)).select("id", "field_identifier")


@query("comma_search", "gold", f"SELECT id, field_identifier FROM gold WHERE {_has('blue bolt')} OR {_has('2022.5.')} OR {_has('leçon', 'lecon')}")
def _(spark, sf):
    return search.search(base.gold(spark, sf), SearchSpec(term="blue bolt, 2022.5., Leçon,")).select("id", "field_identifier")


def _points(term: str, folded: str) -> str:
    parts = [f"CASE WHEN lower(field_identifier) = '{term}' THEN 1000.0::DOUBLE ELSE 0.0::DOUBLE END",
             f"CASE WHEN contains(search_text, '{folded}') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"]
    for column, weight in (("field_identifier", 2.0), ("title", 5.0), ("field_genre", 4.5), ("field_linked_agent", 4.0), ("field_subject", 3.0),
                           ("field_place_published", 1.0), ("field_credit_line", 0.5)):
        parts.append(f"CASE WHEN contains(lower({column}), '{term}') THEN {weight}::DOUBLE ELSE 0.0::DOUBLE END")
    return " + ".join(parts)


@query("ranked_search", "gold", f"""
SELECT id, field_identifier, title, score FROM (
  SELECT *, {_points('brand#2', 'brand#2')} + {_points('ring', 'ring')} + {_points('xb12', 'xb12')} + CASE WHEN has_image THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END AS score
  FROM gold WHERE {_has('brand#2')} OR {_has('ring')} OR {_has('xb12')})
ORDER BY score DESC, has_image DESC, field_identifier ASC NULLS LAST, id LIMIT 48""")
def _(spark, sf):
    spec = SearchSpec(term="Brand#2, ring, XB12")
    return search.ranked_search(base.gold(spark, sf), spec).select("id", "field_identifier", "title", "score")


@query("browse_page", "gold", "SELECT id, field_identifier, title FROM gold ORDER BY has_image DESC, field_identifier ASC NULLS LAST, id LIMIT 48 OFFSET 48")
def _(spark, sf):
    return search.ranked_search(base.gold(spark, sf), SearchSpec(), 48, 48).select("id", "field_identifier", "title")


@query("cursor_page", "gold", "SELECT id, field_identifier, title FROM gold ORDER BY has_image DESC, field_identifier ASC NULLS LAST, id LIMIT 48 OFFSET 48")
def _(spark, sf):
    rows = base.gold(spark, sf).select("id", "field_identifier", "title", "has_image")
    last = search.cursor_page(rows, search.BROWSE_ORDER, 48).select("cursor").collect()[-1].cursor
    return search.cursor_page(rows, search.BROWSE_ORDER, 48, last).select("id", "field_identifier", "title")


@query("search_totals", "gold", f"SELECT count(*) FILTER ({_has('brand#2')} AND year_created >= 1850) AS filtered, count(*) AS total FROM gold")
def _(spark, sf):
    return search.search_totals(base.gold(spark, sf), SearchSpec(term="Brand#2", min_year=1850))


_SPEC = SearchSpec(term="brand#1, src1", genre="POSTER", creator="src", decade=1900)
_COND = {"genre": "contains(field_genre, 'POSTER')", "creator": "contains(field_linked_agent, 'src')", "decade": "decade_created = 1900"}


def _others(facet: str) -> str:
    return " AND ".join([f"({_has('brand#1')} OR {_has('src1')})"] + [p for f, p in _COND.items() if f != facet])


def _distinct_facet(facet: str, column: str) -> str:
    return f"""SELECT '{facet}' AS facet, v AS value, count(*) AS count FROM (SELECT DISTINCT field_identifier, {sql.strip('p')} AS v FROM (
      SELECT field_identifier, unnest(string_split({column}, '|')) AS p FROM gold WHERE {_others(facet)} AND {column} IS NOT NULL)) WHERE v <> '' GROUP BY v"""


@query("responsive_facets", "gold", f"""
SELECT * FROM ({_distinct_facet('creator', 'field_linked_agent')}) UNION ALL SELECT * FROM ({_distinct_facet('subject', 'field_subject')})
UNION ALL SELECT * FROM ({_distinct_facet('place', 'field_place_published')})
UNION ALL SELECT 'genre', field_genre, count(*) FROM gold WHERE {_others('genre')} AND field_genre IS NOT NULL GROUP BY field_genre
UNION ALL SELECT 'decade', CAST(decade_created AS VARCHAR), count(*) FROM gold WHERE {_others('decade')} AND decade_created IS NOT NULL GROUP BY decade_created""")
def _(spark, sf):
    return search.responsive_facets(base.gold(spark, sf), _SPEC)


@query("decade_timeline", "gold", f"SELECT decade_created AS decade, count(*) AS count FROM gold WHERE {_others('decade')} AND decade_created IS NOT NULL GROUP BY ALL")
def _(spark, sf):
    return search.decade_timeline(base.gold(spark, sf), _SPEC)


@query("related_to_one", "gold", """
SELECT title, field_identifier, has_image, image_count FROM gold g
WHERE has_image AND field_identifier <> 'XB12' AND EXISTS (SELECT 1 FROM gold r WHERE r.field_identifier = 'XB12' AND (
  contains(g.field_subject, r.field_subject) OR g.field_genre = r.field_genre OR g.field_linked_agent = r.field_linked_agent))
ORDER BY field_identifier, id LIMIT 4""")
def _(spark, sf):
    return related.related_to(base.gold(spark, sf), "XB12")


_RELKEYS = f"""SELECT id, unnest(list_distinct(list_concat([CASE WHEN field_genre <> '' THEN 'g:' || field_genre END, CASE WHEN field_linked_agent <> '' THEN 'a:' || field_linked_agent END],
  list_transform({{}}, lambda s: 's:' || s)))) AS m FROM (SELECT *, list_filter(list_transform(string_split(field_subject, '|'), lambda p: {sql.strip('p')}), lambda p: p <> '') AS subj FROM gold)"""


@query("related_records", "gold", f"""
SELECT id, related_key, related_identifier, rank FROM (
  SELECT id, related_key, related_identifier, row_number() OVER (PARTITION BY id ORDER BY related_identifier, related_key)::INTEGER AS rank FROM (
    SELECT DISTINCT w.id, k.id AS related_key, k.field_identifier AS related_identifier
    FROM ({_RELKEYS.format('subj[1:1]')}) w JOIN (SELECT r.id, m, field_identifier FROM ({_RELKEYS.format('subj')}) r JOIN gold USING (id) WHERE has_image AND field_identifier IS NOT NULL) k
    ON w.m = k.m AND w.id <> k.id)) WHERE rank <= 4""")
def _(spark, sf):
    return related.related_records(base.gold(spark, sf), "id")


_GRAPH = """SELECT node, creator, related_identifier, related_title FROM (
  SELECT n.field_identifier AS node, n.field_linked_agent AS creator, g.field_identifier AS related_identifier, g.title AS related_title,
    row_number() OVER (PARTITION BY n.field_identifier, n.field_linked_agent ORDER BY g.field_identifier, g.id) AS r
  FROM (SELECT DISTINCT field_identifier, field_linked_agent FROM gold WHERE has_image AND field_linked_agent IS NOT NULL AND field_identifier IS NOT NULL) n
  JOIN gold g ON g.field_linked_agent = n.field_linked_agent AND g.has_image AND g.field_identifier <> n.field_identifier) WHERE r <= 10"""


def _expanded(spark, sf):
    gold = base.gold(spark, sf).select("id", "field_identifier", "field_linked_agent", "title", "has_image")
    held = c("field_linked_agent").isNotNull() & c("field_identifier").isNotNull()
    nodes = shape.computed_once(gold.where("has_image"), ["field_identifier", "field_linked_agent"], held)
    return related.graph_expand(gold, nodes)


@query("graph_expand", "gold", _GRAPH)
def _(spark, sf):
    return _expanded(spark, sf)


@query("graph_edges", "gold", f"""
SELECT DISTINCT source, 'creator_' || creator AS target FROM (SELECT node AS source, creator FROM ({_GRAPH}) UNION ALL SELECT related_identifier, creator FROM ({_GRAPH}))""")
def _(spark, sf):
    return related.graph_edges(_expanded(spark, sf))


@query("sample_n", "gold", "SELECT id, title FROM gold WHERE has_image ORDER BY md5(CAST(id AS VARCHAR) || 'deck-1'), id LIMIT 24")
def _(spark, sf):
    return sample.sample_n(base.gold(spark, sf).where("has_image").select("id", "title"), "id", 24, "deck-1")


@query("sample_groups", "gold", """
SELECT CASE WHEN p < 10 THEN p ELSE (p - 10) // 3 END::INTEGER AS group, CASE WHEN p < 10 THEN 0 ELSE (p - 10) % 3 + 1 END::INTEGER AS slot, id, title FROM (
  SELECT id, title, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || 'round-1'), id) - 1 AS p FROM gold WHERE has_image AND title <> '') WHERE p < 40""".replace("AS group,", 'AS "group",'))
def _(spark, sf):
    rows = base.gold(spark, sf).where("has_image AND title != ''").select("id", "title")
    return sample.sample_groups(rows, "id", "title", "round-1")


_WORDS = f"SELECT question_id, unnest(regexp_split_to_array(lower(question), '\\s+')) AS w FROM questions"
_ASKED = f"SELECT question_id, w FROM ({_WORDS}) WHERE length(w) > 2 AND w NOT IN ({', '.join(map(sql.lit, fixed.STOP_WORDS))})"
_HITS = f"""SELECT w, record_id, CASE WHEN contains(t, w) THEN 2 ELSE 0 END + CASE WHEN contains(s, w) THEN 1 ELSE 0 END
  + CASE WHEN contains(d, w) THEN 1 ELSE 0 END + CASE WHEN contains(g, w) THEN 1 ELSE 0 END AS points
  FROM (SELECT DISTINCT w FROM ({_ASKED})) CROSS JOIN (SELECT record_id, lower(title) AS t, lower(field_subject) AS s, lower(field_description_long) AS d, lower(field_genre) AS g FROM lib)"""
_SCORED = f"""SELECT question_id, record_id, CAST(sum(points) AS BIGINT) AS score
  FROM ({_ASKED}) JOIN ({_HITS}) USING (w) WHERE points > 0 GROUP BY ALL"""
_TOP5 = f"SELECT question_id, record_id, score, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, record_id)::INTEGER AS rank FROM ({_SCORED}) WHERE score > 0 QUALIFY rank <= 5"


def _retrieved(spark, sf):
    return retrieval.retrieve(view(spark, sf, "questions"), view(spark, sf, "lib"), "question_id", "question", "record_id")


@query("keyword_retrieval", "questions lib", _TOP5)
def _(spark, sf):
    return _retrieved(spark, sf)


@query("retrieval_context", "questions lib", f"""
SELECT q.question_id, CASE WHEN q.question_id NOT IN (SELECT question_id FROM ({_ASKED})) THEN '' WHEN b IS NULL THEN 'No catalogue record matches.'
  ELSE 'Matching catalogue records:' || chr(10) || b || 'Use these records to answer.' END AS context
FROM questions q LEFT JOIN (SELECT question_id, string_agg(rank || '. Title: ' || coalesce(nullif(title, ''), 'null') || chr(10) || 'ID: ' || coalesce(nullif(field_identifier, ''), 'null') || chr(10)
    || 'Description: ' || coalesce(nullif(field_description_long, ''), 'N/A') || chr(10) || 'Subject: ' || coalesce(nullif(field_subject, ''), 'N/A') || chr(10) || chr(10), '' ORDER BY rank) AS b
  FROM ({_TOP5}) JOIN lib USING (record_id) GROUP BY question_id) USING (question_id)""")
def _(spark, sf):
    return retrieval.retrieval_context(view(spark, sf, "questions"), _retrieved(spark, sf), view(spark, sf, "lib"), "question_id", "question", "record_id")
