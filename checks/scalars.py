"""Field rules: one query per rule over a whole view."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import base, sql
from checks.base import query
from checks.views import table, view
from shelfmark.functions import fixed, identifiers, normalize, silver, text
from shelfmark.operators import shape
from shelfmark.operators.metrics import explode_values
from shelfmark.operators.unify import exclude_ids
from shelfmark.plans.gold import normalize_catalog

c = F.col


def field(name: str, source: str, body: str, **columns) -> None:
    """A projection of the record id and computed columns (built when the query runs)."""

    @query(name, source, body)
    def _(spark, sf):
        return view(spark, sf, source).select("record_id", *[e().alias(n) for n, e in columns.items()])


WEB_IDS = "SELECT record_id, {} AS norm_id FROM (SELECT record_id, field_identifier FROM mus UNION ALL SELECT record_id + 100000000, field_identifier FROM lib UNION ALL SELECT node_id + 200000000, field_identifier FROM web)"


@query("normalize_identifier", "mus lib web", WEB_IDS.format(sql.norm_id("field_identifier")))
def _(spark, sf):
    ids = view(spark, sf, "mus").select("record_id", "field_identifier")
    ids = ids.unionAll(view(spark, sf, "lib").select(c("record_id") + 100000000, "field_identifier"))
    ids = ids.unionAll(view(spark, sf, "web").select(c("node_id") + 200000000, "field_identifier"))
    return ids.select("record_id", identifiers.normalize_identifier(c("field_identifier")).alias("norm_id"))


field("media_filename", "lib", f"SELECT record_id, coalesce({sql.media_name(sql.primary('field_identifier'))}, '') AS media_file FROM lib",
      media_file=lambda: identifiers.media_filename(c("field_identifier")))
field("clean_extent", "mus", f"SELECT record_id, {sql.extent('field_extent')} AS extent FROM mus",
      extent=lambda: silver.clean_extent(c("field_extent")))
field("edtf_date", "mus", f"SELECT record_id, {sql.edtf('original_date')} AS edtf FROM mus",
      edtf=lambda: silver.edtf_date(c("original_date")))
field("edtf_display", "mus", f"SELECT record_id, {sql.edtf_display(sql.edtf('original_date'))} AS display FROM mus",
      display=lambda: silver.edtf_display(silver.edtf_date(c("original_date"))))
field("marc_date_clean", "lib", f"SELECT record_id, {sql.marc_date('new_264_c', 'new_260_c')} AS date_created FROM lib",
      date_created=lambda: silver.marc_date(c("new_264_c"), c("new_260_c")))
field("agent_roles", "mus", f"SELECT record_id, {sql.agents('field_linked_agent')} AS agents FROM mus",
      agents=lambda: silver.agent_roles(c("field_linked_agent"), sql.ROLES))
field("credit_line", "mus", f"SELECT record_id, {sql.credit('field_credit_line')} AS credit FROM mus",
      credit=lambda: silver.credit_line(c("field_credit_line"), sql.CREDIT))
field("title_cut", "lib", f"SELECT record_id, {sql.title_cut('field_description_long')} AS short_title FROM lib",
      short_title=lambda: text.title_cut(c("field_description_long")))
field("delimiter_rewrite", "mus",
      f"SELECT record_id, replace(field_place_published, '__', '|') AS place, {sql.subject_tag('field_subject')} AS subject, replace(field_linked_agent, '||', '|') AS form FROM mus",
      place=lambda: text.place_delimiter(c("field_place_published")), subject=lambda: text.subject_delimiter(c("field_subject")),
      form=lambda: text.form_delimiter(c("field_linked_agent")))
field("merge_columns", "flat",
      f"SELECT record_id, nullif(concat_ws(' | ', {sql.clean('new_260_b')}, {sql.clean('new_100_a')}, {sql.clean('new_245_b')}), '') AS agents FROM flat",
      agents=lambda: text.merge_columns([c("new_260_b"), c("new_100_a"), c("new_245_b")]))
field("compose_text", "flat",
      f"""SELECT record_id, {sql.strip("coalesce(new_245_a, '') || ' ' || coalesce(new_245_b, '')")} AS title,
          {sql.strip(r"trim(regexp_replace(concat_ws(', ', coalesce(new_300_a, ''), coalesce(new_300_b, ''), coalesce(new_300_c, '')), ',\s*,', ',', 'g'), ', ')")} AS extent FROM flat""",
      title=lambda: text.compose_title(c("new_245_a"), c("new_245_b")),
      extent=lambda: text.compose_extent(c("new_300_a"), c("new_300_b"), c("new_300_c")))
field("fixed_substr", "flat", "SELECT record_id, substr(new_008_ctrl, 16, 3) AS three_letter_code FROM flat",
      three_letter_code=lambda: F.substring("new_008_ctrl", 16, 3))


def _stripped(column: str, target: str):
    return text.replace_all(c(column), fixed.LIBRARY_STRIPS[target]).alias(target)


@query("char_strip", "flat", """
SELECT record_id, replace(replace(replace(new_907_full, 'Local', ''), 'local', ''), '@', ' ') AS field_identifier,
       replace(replace(new_245_a, '/', ''), '--', '') AS title, replace(new_655_a, '.', '') AS field_genre,
       replace(new_260_a, ':', '') AS field_place_published FROM flat""")
def _(spark, sf):
    return view(spark, sf, "flat").select(
        "record_id", _stripped("new_907_full", "field_identifier"), _stripped("new_245_a", "title"),
        _stripped("new_655_a", "field_genre"), _stripped("new_260_a", "field_place_published"))


BOTH = "(SELECT record_id, 'm' AS side, {0} FROM mus UNION ALL SELECT record_id, 'l', {0} FROM lib)"


def both(name: str, column: str, expression: str, target: str, rule) -> None:
    """A rule over the museum's and the library's values of one column."""

    @query(name, "mus lib", f"SELECT record_id, side, {expression} AS {target} FROM {BOTH.format(column)}")
    def _(spark, sf):
        rows = view(spark, sf, "mus").select("record_id", F.lit("m").alias("side"), column)
        rows = rows.unionAll(view(spark, sf, "lib").select("record_id", F.lit("l"), column))
        return rows.select("record_id", "side", rule(c(column)).alias(target))


both("normalize_genre", "field_genre", sql.genre("field_genre"), "genre", normalize.normalize_genre)
both("normalize_subject", "field_subject", sql.subject("field_subject"), "subject", normalize.normalize_subject)
both("normalize_title", "title", sql.title("title"), "clean_title", normalize.normalize_title)
both("normalize_place", "field_place_published", sql.place("field_place_published"), "place", normalize.normalize_place)


@query("normalize_creator", "mus lib", f"""
SELECT record_id, side, {sql.creator('a')} AS creator FROM (
  SELECT record_id, 'm' AS side, {sql.agents('field_linked_agent')} AS a FROM mus UNION ALL SELECT record_id, 'l', field_linked_agent FROM lib)""")
def _(spark, sf):
    agents = silver.agent_roles(c("field_linked_agent"), sql.ROLES)
    rows = view(spark, sf, "mus").select("record_id", F.lit("m").alias("side"), agents.alias("a"))
    rows = rows.unionAll(view(spark, sf, "lib").select("record_id", F.lit("l"), "field_linked_agent"))
    return rows.select("record_id", "side", normalize.normalize_creator(c("a")).alias("creator"))


@query("year_decade", "mus lib", f"""
SELECT record_id, side, {sql.year('d')} AS year_created, {sql.decade(sql.year('d'))} AS decade_created FROM (
  SELECT record_id, 'm' AS side, original_date AS d FROM mus UNION ALL
  SELECT record_id, 'l', {sql.marc_date('new_264_c', 'new_260_c')} FROM lib)""")
def _(spark, sf):
    date = silver.marc_date(c("new_264_c"), c("new_260_c"))
    rows = view(spark, sf, "mus").select("record_id", F.lit("m").alias("side"), c("original_date").alias("d"))
    rows = rows.unionAll(view(spark, sf, "lib").select("record_id", F.lit("l"), date))
    year = normalize.extract_year(c("d"))
    return rows.select("record_id", "side", year.alias("year_created"), normalize.decade_of(year).alias("decade_created"))


@query("search_text", "gold", "SELECT id, search_text FROM gold")
def _(spark, sf):
    return normalize_catalog(base.unified(spark, sf)).select("id", "search_text")


field("null_clean", "mus",
      f"SELECT record_id, {sql.clean('field_genre')} AS genre, nullif({sql.clean('field_credit_line')}, 'nan') AS credit FROM mus",
      genre=lambda: text.null_clean(c("field_genre")), credit=lambda: text.null_clean(c("field_credit_line"), ["nan"]))

SHELF = f"CASE WHEN {sql.strip('location')} IN ({', '.join(map(sql.lit, fixed.REFERENCE_SHELVES))}) THEN 'Reference' ELSE {sql.strip('location')} END"


@query("map_location", "items", f"""
SELECT item_id, {SHELF} AS location, CASE WHEN {SHELF} = 'Reference' THEN 'Research/Reference Books' ELSE 'Library' END AS field_collection_type FROM items""")
def _(spark, sf):
    shelf = silver.shelf_location(c("location"))
    rows = view(spark, sf, "items").select("item_id", shelf.alias("location"))
    return rows.withColumn("field_collection_type", silver.collection_type(c("location")))


@query("outbound_link", "flat", f"""
SELECT record_id, CASE WHEN regexp_full_match({sql.strip('new_001_ctrl')}, '[0-9]+')
  THEN 'https://catalogue.example/full?doc=' || {sql.strip('new_001_ctrl')} || '&query=any,contains,' || {sql.primary('new_907_full')} || '&offset=0' END AS link FROM flat""")
def _(spark, sf):
    link = silver.catalog_link(c("new_907_full"), c("new_001_ctrl"), sql.LINK)
    return view(spark, sf, "flat").select("record_id", link.alias("link"))


_PARTS = f"list_filter(list_transform(string_split(field_subject, '|'), lambda p: {sql.strip('p')}), lambda p: p <> '')"


@query("parse_delimited", "lib", f"""
SELECT record_id, array_to_string(list_filter({_PARTS}, lambda v, i: list_position({_PARTS}, v) = i), ' / ') AS subjects FROM lib""")
def _(spark, sf):
    rows = view(spark, sf, "lib")
    return rows.select("record_id", F.array_join(text.parse_subjects(c("field_subject")), " / ").alias("subjects"))


@query("explode_delimited", "lib", f"SELECT record_id, {sql.strip('p')} AS subject FROM (SELECT record_id, unnest(string_split(field_subject, '|')) AS p FROM lib)")
def _(spark, sf):
    return explode_values(view(spark, sf, "lib"), "field_subject", "|", "subject", "record_id")


@query("exclude_ids", "lib", f"""
SELECT record_id, field_identifier FROM lib
WHERE field_identifier IS NULL OR NOT list_has_any(list_transform(string_split(field_identifier, ';'), lambda p: {sql.strip('p')}), ['XB10', '2022.5.5', 'XB7'])""")
def _(spark, sf):
    return exclude_ids(view(spark, sf, "lib"), ["XB10", "2022.5.5", "XB7"]).select("record_id", "field_identifier")


_RENAMED = {"new_907_full": "field_identifier", "new_001_ctrl": "alma_identifier", "new_655_a": "field_genre", "new_260_a": "field_place_published", "new_008_ctrl": "country_code"}
_LEADING = ["field_resource_type", "field_model", "field_identifier", "alma_identifier", "title", "field_genre"]


@query("rename_align", "flat", """
SELECT 'Collection' AS field_resource_type, 'Paged Content' AS field_model, new_907_full AS field_identifier, new_001_ctrl AS alma_identifier,
       CAST(NULL AS VARCHAR) AS title, new_655_a AS field_genre, new_008_ctrl AS country_code, new_260_a AS field_place_published,
       new_100_a, new_245_a, new_245_b, new_260_b, new_300_a, new_300_b, new_300_c, record_id FROM flat""")
def _(spark, sf):
    df = shape.add_constants(shape.rename_columns(view(spark, sf, "flat"), fixed.LIBRARY_RENAMES), fixed.LIBRARY_CONSTANTS)
    return shape.align_schema(df, _LEADING)


@query("prune_empty_columns", "", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    empty = rows.withColumns({"note": F.lit(None).cast("string"), "weight": F.when(c("l_quantity") < 0, c("l_quantity"))})
    return shape.prune_empty_columns(empty)


@query("resolve_columns", "web", "SELECT node_id, field_identifier, title FROM web")
def _(spark, sf):
    page = view(spark, sf, "web").withColumnsRenamed({"node_id": "nid", "field_identifier": "field_identifier_external"})
    return shape.resolve_lookup(page).select("node_id", "field_identifier", "title")


@query("record_card", "gold", f"""
SELECT id, rank, label, value FROM (
  SELECT id, unnest([{', '.join(f"{{'rank': {i}, 'label': {sql.lit(label)}, 'value': CAST({n if n in sql.GOLD_KNOWN else 'NULL'} AS VARCHAR)}}"
                               for i, (n, label) in enumerate((n, fixed.CARD_LABELS.get(n, n)) for n in fixed.CARD_ORDER))}], recursive := true) FROM gold)
WHERE value IS NOT NULL AND value <> ''""")
def _(spark, sf):
    return shape.record_card(base.gold(spark, sf).select("id", *fixed.CARD_ORDER), ["id"])


@query("media_variants", "gold", f"""
SELECT id, i::INTEGER AS position, CASE WHEN i = 0 THEN b ELSE b || '_' || i END AS media FROM (
  SELECT id, {sql.media_name(sql.primary('field_identifier'))} AS b, unnest(range(image_count)) AS i FROM gold WHERE has_image)""")
def _(spark, sf):
    rows = base.gold(spark, sf).where("has_image")
    return shape.media_variants(rows, ["id"], c("field_identifier"), c("image_count"))


@query("collection_export", "gold", f"""
SELECT coalesce(field_identifier, '') AS field_identifier, CASE WHEN u <> '' THEN '=IMAGE("' || u || '")' ELSE '' END AS spreadsheet_thumbnail,
  coalesce(title, '') AS title, coalesce(field_collection_type, '') AS field_collection_type, coalesce(field_genre, '') AS field_genre,
  coalesce(field_description_long, '') AS field_description_long, coalesce(field_linked_agent, '') AS field_linked_agent, coalesce(field_subject, '') AS field_subject,
  coalesce(field_place_published, '') AS field_place_published, coalesce(field_edtf_date_created, '') AS field_edtf_date_created,
  coalesce(CAST(decade_created AS VARCHAR), '') AS decade_created, coalesce(field_extent, '') AS field_extent, '' AS field_collection_note,
  source_system, CAST(id AS VARCHAR) AS id, u AS image_url, '' AS location, '' AS storage_location
FROM (SELECT *, CASE WHEN has_image THEN {sql.lit(sql.IMAGE_ROOT)} || {sql.media_name(sql.primary('field_identifier'))} || '.jpg' ELSE '' END AS u FROM gold)""")
def _(spark, sf):
    return shape.collection_export(base.gold(spark, sf), sql.IMAGE_ROOT)
