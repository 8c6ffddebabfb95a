"""Joins, deduplication, set operations, quality, tagged fields, incremental work."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import base, sql
from checks.base import query
from checks.views import table, view
from shelfmark.functions import fixed
from shelfmark.operators import compare, dense, inventory, media, merge, metrics, quality, shape, tagged, unify
from shelfmark.sources.files import expired_reports
from shelfmark.streaming.jobs import alert_lines, alert_outbursts, log_alerts

c = F.col
KEY = f"nullif(lower({sql.strip('field_identifier')}), '')"


@query("inventory_join", "lib items", f"""
SELECT l.record_id, CASE WHEN i.k IS NOT NULL THEN '/raw/alma/physical' ELSE '/raw/alma/bibliographic' END AS alma_source_type,
  CASE WHEN loc IN ('REF', 'REFO', 'REFDO') THEN 'Reference' ELSE loc END AS location,
  CASE WHEN loc IN ('REF', 'REFO', 'REFDO') THEN 'Research/Reference Books' ELSE 'Library' END AS field_collection_type, item_id
FROM lib l LEFT JOIN (SELECT item_id, replace(mms_id, '''', '') AS k, {sql.strip('location')} AS loc FROM items
  QUALIFY row_number() OVER (PARTITION BY mms_id ORDER BY item_id) = 1) i ON CAST(l.record_id AS VARCHAR) = i.k""")
def _(spark, sf):
    items = view(spark, sf, "items").withColumn("mms_id", inventory.clean_item_key(c("mms_id")))
    records = view(spark, sf, "lib").select("record_id", "field_collection_type")
    joined = inventory.inventory_join(records, items, "record_id", "mms_id", "item_id", "location")
    return joined.select("record_id", "alma_source_type", "location", "field_collection_type", "item_id")


@query("gap_report", "unified web", f"""
SELECT row_number() OVER (ORDER BY id) AS id, source_system, field_identifier, title FROM unified u
WHERE NOT EXISTS (SELECT 1 FROM web w WHERE {sql.norm_id('w.field_identifier')} = {sql.norm_id('u.field_identifier')})""")
def _(spark, sf):
    catalog = shape.select_existing(base.unified(spark, sf), ["id", "source_system", "field_identifier", "title"])
    return compare.numbered_gap(compare.gap_report(catalog, view(spark, sf, "web"), "id"))


@query("comparison_left", "mus web", f"""
SELECT record_id, field_identifier, CASE WHEN EXISTS (SELECT 1 FROM web w WHERE {sql.norm_id('w.field_identifier')} = {sql.norm_id('m.field_identifier')})
  THEN 'both' ELSE 'left_only' END AS exists FROM mus m""".replace("AS exists", 'AS "exists"'))
def _(spark, sf):
    return compare.compare_left(view(spark, sf, "mus").select("record_id", "field_identifier"), view(spark, sf, "web"), "record_id")


_FIRSTS = f"""
a AS (SELECT {KEY} AS k, field_identifier, title FROM lib WHERE {KEY} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY record_id) = 1),
b AS (SELECT {KEY} AS k, field_identifier, title FROM web {{}} QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY node_id) = 1)"""


@query("comparison_full", "lib web", f"""
SELECT * FROM (WITH {_FIRSTS.format(f'WHERE {KEY} IS NOT NULL')}
SELECT coalesce(a.k, b.k) AS normalized_id, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'Match' WHEN a.k IS NOT NULL THEN 'MARC Only' ELSE 'API Only' END AS status,
  CASE WHEN a.k IS NOT NULL THEN 'Yes' ELSE 'No' END AS in_marc, coalesce(a.field_identifier, '') AS marc_id, coalesce(a.title, '') AS marc_title,
  CASE WHEN b.k IS NOT NULL THEN 'Yes' ELSE 'No' END AS in_api, coalesce(b.field_identifier, '') AS api_id, coalesce(b.title, '') AS api_title
FROM a FULL OUTER JOIN b ON a.k = b.k)""")
def _(spark, sf):
    return compare.compare_full(view(spark, sf, "lib"), view(spark, sf, "web"), ["record_id"], ["node_id"])


@query("comparison_fuzzy", "lib web", f"""
SELECT * FROM (WITH {_FIRSTS.format(f"WHERE field_collection_type = 'Library' AND {KEY} IS NOT NULL")},
s AS (SELECT CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN CASE WHEN jaro_winkler_similarity(lower(a.title), lower(b.title)) >= 0.4 THEN 'Match' ELSE 'Mismatch' END
  WHEN a.k IS NOT NULL THEN 'left' ELSE 'right' END AS s FROM a FULL OUTER JOIN b ON a.k = b.k)
SELECT count(*) FILTER (s = 'right') AS archive_only, count(*) FILTER (s = 'left') AS library_only, count(*) FILTER (s = 'Match') AS match,
  count(*) FILTER (s = 'Mismatch') AS mismatch, count(*) AS total, CAST(round(count(*) FILTER (s = 'Match') * 100.0 / nullif(count(*), 0), 0) AS INTEGER) AS match_pct FROM s)""")
def _(spark, sf):
    archive = view(spark, sf, "web").where("field_collection_type = 'Library'")
    return compare.compare_titles(view(spark, sf, "lib"), archive, ["record_id"], ["node_id"])


@query("mark_duplicates", "lib_parts", "SELECT record_id, marked AS field_identifier FROM (SELECT l.record_id, p.marked FROM lib l LEFT JOIN lib_parts p USING (record_id))")
def _(spark, sf):
    library = view(spark, sf, "lib").select("record_id", "field_identifier")
    museum_ids = unify.exclude_ids(view(spark, sf, "mus").select("record_id", "field_identifier"), sql.EXCLUDED)
    return unify.mark_duplicates(library, museum_ids, "record_id")


_SIDE = "SELECT lower(p) AS match_id, {1} AS source_system, field_identifier, title FROM (SELECT trim(unnest(string_split(field_identifier, ';'))) AS p, field_identifier, title FROM {0}) WHERE p <> ''"


@query("duplicates_report", "mus lib", f"""
SELECT * FROM (WITH r AS ({_SIDE.format('mus', "'Museum'")} UNION ALL {_SIDE.format('lib', "'Library'")})
SELECT match_id, source_system, field_identifier, title FROM r
WHERE match_id IN (SELECT match_id FROM r WHERE source_system = 'Museum') AND match_id IN (SELECT match_id FROM r WHERE source_system = 'Library'))""")
def _(spark, sf):
    return compare.duplicates_report(view(spark, sf, "mus"), view(spark, sf, "lib"))


@query("unify_catalog", "unified", f"SELECT {sql.columns(sql.UNIFIED_COLUMNS, sql.UNIFIED_KNOWN)} FROM unified")
def _(spark, sf):
    return base.unified(spark, sf)


@query("dense_ids", "", """
SELECT row_number() OVER (ORDER BY k NULLS LAST, event_id) AS id, k, event_id FROM (
  SELECT CASE WHEN event_type <> 'error' THEN event_type END AS k, event_id FROM events)""")
def _(spark, sf):
    rows = table(spark, sf, "events").selectExpr("CASE WHEN event_type <> 'error' THEN event_type END AS k", "event_id")
    return dense.assign_ids(rows, [c("k").asc_nulls_last(), c("event_id")], "id")


@query("assign_ids", "unified", "SELECT row_number() OVER (ORDER BY CASE WHEN source_system = 'Library' THEN 0 ELSE 1 END, record_id) AS id, record_id, source_system FROM unified")
def _(spark, sf):
    return base.unified(spark, sf, with_ids=True).select("id", "record_id", "source_system")


@query("prev_next", "gold", """
SELECT id, field_identifier, lag(field_identifier) OVER w AS previous, lead(field_identifier) OVER w AS next FROM gold
WINDOW w AS (ORDER BY has_image DESC, field_identifier ASC NULLS LAST, id)""")
def _(spark, sf):
    rows = base.gold(spark, sf).select("id", "field_identifier", "has_image")
    order = [F.desc("has_image"), F.asc_nulls_last("field_identifier"), F.asc("id")]
    return dense.neighbours(rows, order, "field_identifier").drop("has_image")


@query("upsert_latest", "deltas", """
SELECT nullif(record_id, 7 * (record_id // 7)) AS record_id, row_id, add_dte, status, amount FROM deltas
QUALIFY row_number() OVER (PARTITION BY record_id, CASE WHEN record_id % 7 = 0 THEN row_id END ORDER BY add_dte DESC NULLS LAST, row_id DESC) = 1""")
def _(spark, sf):
    # every seventh record has lost its key, and the older batches come twice
    record_id = F.when(F.col("record_id") % 7 != 0, F.col("record_id")).alias("record_id")
    deltas = view(spark, sf, "deltas").select(record_id, "row_id", "add_dte", "status", "amount")
    master, fresh = deltas.where("add_dte < timestamp_ntz'1996-01-01'"), deltas.where("add_dte >= timestamp_ntz'1996-01-01'")
    merged = merge.upsert_latest(merge.upsert_latest(None, master, "add_dte", "row_id"), master, "add_dte", "row_id")
    return merge.upsert_latest(merged, fresh, "add_dte", "row_id")


@query("incremental_extract", "deltas", "SELECT * FROM deltas WHERE change_dte > TIMESTAMP '1997-03-01 00:00:00' OR add_dte > TIMESTAMP '1997-03-01 00:00:00'")
def _(spark, sf):
    return merge.changed_since(view(spark, sf, "deltas"), "1997-03-01 00:00:00.000")


@query("next_watermark", "deltas", "SELECT greatest(max(change_dte), max(add_dte), TIMESTAMP '1997-03-01 00:00:00') AS watermark FROM deltas")
def _(spark, sf):
    return merge.next_watermark(view(spark, sf, "deltas"), "1997-03-01 00:00:00.000")


@query("snapshot_append", "mus lib", """
SELECT snapshot_date, field_genre, n FROM (
  SELECT DATE '2024-01-01' AS snapshot_date, field_genre, count(*) AS n FROM mus GROUP BY ALL
  UNION ALL SELECT DATE '2024-01-02', field_genre, count(*) FROM lib GROUP BY ALL)""")
def _(spark, sf):
    def counts(name: str):
        return view(spark, sf, name).groupBy("field_genre").agg(F.count("*").alias("n"))

    history = counts("mus").withColumn("snapshot_date", F.to_date(F.lit("2024-01-01")))
    history = history.unionByName(counts("mus").withColumn("snapshot_date", F.to_date(F.lit("2024-01-02"))))
    return merge.replace_day(history, counts("lib"), "2024-01-02")


@query("collection_merge", "mus lib", """
SELECT field_identifier, title FROM mus UNION ALL
SELECT field_identifier, title FROM lib l WHERE NOT EXISTS (SELECT 1 FROM mus m WHERE m.field_identifier = l.field_identifier)""")
def _(spark, sf):
    columns = ["field_identifier", "title"]
    return merge.collection_add(view(spark, sf, "mus").select(columns), view(spark, sf, "lib").select(columns))


@query("collection_remove", "lib web", "SELECT record_id, field_identifier FROM lib l WHERE NOT EXISTS (SELECT 1 FROM web w WHERE upper(trim(w.field_identifier)) = l.field_identifier)")
def _(spark, sf):
    gone = view(spark, sf, "web").select(F.upper(F.trim("field_identifier")).alias("field_identifier"))
    return merge.collection_remove(view(spark, sf, "lib").select("record_id", "field_identifier"), gone)


@query("qa_quarantine", "lib", f"""
SELECT record_id, array_to_string(list_filter([CASE WHEN {sql.clean('field_identifier')} IS NULL THEN 'Identifier is missing' END,
  CASE WHEN {sql.clean('title')} IS NULL THEN 'Title is missing' END], lambda e: e IS NOT NULL), ' | ') AS qa_errors FROM lib
WHERE {sql.clean('field_identifier')} IS NULL OR {sql.clean('title')} IS NULL""")
def _(spark, sf):
    library = view(spark, sf, "lib")
    _, failed = quality.split_quarantine(quality.apply_rules(library, quality.basic_rules(library)))
    return failed.select("record_id", "qa_errors")


@query("qa_full_rules", "mus_s", f"""
SELECT record_id, array_to_string(e, ' | ') AS qa_errors, len(e) = 0 AS qa_pass FROM (SELECT record_id, list_filter([
  CASE WHEN title IS NULL THEN 'Title is missing' END, CASE WHEN field_identifier IS NULL THEN 'Identifier is missing' END,
  CASE WHEN field_genre IS NULL OR coalesce(field_edtf_date_created, field_linked_agent, field_place_published) IS NULL
       THEN 'Required fields missing (Genre and one of Date/Creator/Country)' END,
  CASE WHEN contains(field_linked_agent, '_') THEN 'Underscores found in processed linked agent field' END], lambda e: e IS NOT NULL) AS e FROM mus_s)""")
def _(spark, sf):
    museum = unify.exclude_ids(base.museum(spark, sf), sql.EXCLUDED)
    return quality.apply_rules(museum, quality.full_rules()).select("record_id", "qa_errors", "qa_pass")


@query("qa_gate", "lib", f"SELECT record_id FROM lib WHERE {sql.clean('title')} IS NOT NULL AND field_identifier IS NOT NULL UNION ALL SELECT record_id FROM lib")
def _(spark, sf):
    library = view(spark, sf, "lib").select("record_id", "field_identifier", "title")
    checked = quality.apply_rules(library, quality.basic_rules(library)).withColumn("qa_pass", c("qa_pass").cast("string"))
    unchecked = library.withColumns({"qa_errors": F.lit(""), "qa_pass": F.lit(None).cast("string")})
    return quality.qa_gate(checked.unionByName(unchecked)).select("record_id")


@query("run_metrics", "lib mus_s", """
SELECT 'run-1' AS run_id, unnest(['rows', 'with_identifier', 'dated']) AS metric, unnest([count(*), count(field_identifier), count(*) FILTER (new_264_c <> '')]) AS value FROM lib""")
def _(spark, sf):
    return quality.run_metrics(view(spark, sf, "lib"), "run-1", with_identifier=c("field_identifier").isNotNull(), dated=c("new_264_c") != "")


_FIRST = "SELECT rec_id, tag, occ, code, arg_min(value, pos) AS value FROM tagged WHERE value <> '' GROUP BY ALL"


def _cell(tag: str, code: str) -> str:
    return f"coalesce(string_agg(value, ' | ' ORDER BY occ) FILTER (tag = '{tag}' AND code = '{code}'), '') AS new_{tag}_{code}"


@query("tagged_pivot", "tagged", f"""
SELECT * FROM (WITH f AS ({_FIRST}), o AS (SELECT rec_id, min(occ) AS occ FROM tagged WHERE tag = '500' GROUP BY rec_id),
w AS (SELECT rec_id, string_agg(t, ' | ' ORDER BY occ) AS new_650_full FROM (SELECT rec_id, occ, string_agg(value, ' ' ORDER BY pos, code) AS t FROM tagged WHERE tag = '650' GROUP BY ALL) GROUP BY rec_id),
n AS (SELECT f.rec_id, max(CASE WHEN code = 'x' THEN value END) AS new_500_x FROM f JOIN o ON f.rec_id = o.rec_id AND f.occ = o.occ WHERE tag = '500' GROUP BY f.rec_id)
SELECT r.rec_id, {', '.join(f"coalesce({n}, '') AS {n}" for n in ('new_650_a', 'new_650_x', 'new_700_a', 'new_700_b', 'new_500_x', 'new_650_full'))}
FROM (SELECT DISTINCT rec_id FROM tagged) r
LEFT JOIN (SELECT rec_id, {_cell('650', 'a')}, {_cell('650', 'x')}, {_cell('700', 'a')}, {_cell('700', 'b')} FROM f GROUP BY rec_id) USING (rec_id)
LEFT JOIN n USING (rec_id) LEFT JOIN w USING (rec_id))""")
def _(spark, sf):
    spec = [("650", ["a", "x"], True), ("700", ["a", "b"], False)]
    return tagged.tagged_pivot(view(spark, sf, "tagged"), spec, single=[("500", "x")])


# A specification of 250 tags: two joined subfields each, a single one of every second, the whole field of every fifth.
_SPEC_TAGS = [str(100 + i) for i in range(250)]
_WIDE_SPEC = [(tag, ["a", "x"], int(tag) % 5 == 0) for tag in _SPEC_TAGS]
_WIDE_SINGLE = [(tag, "b") for tag in _SPEC_TAGS if int(tag) % 2 == 0]
_WIDE_NAMES = [f"new_{tag}_{code}" for tag in _SPEC_TAGS for code in "ax"] + [f"new_{tag}_b" for tag, _ in _WIDE_SINGLE]
_WIDE_NAMES += [f"new_{tag}_full" for tag, _, full in _WIDE_SPEC if full]
_WIDE_FIRST = _FIRST.replace("tagged", "fields")


@query("tagged_table", "fields", f"""
SELECT rec_id, count(*) FILTER (cell <> '') AS n_filled, md5(string_agg(coalesce(cell, ''), '/' ORDER BY place)) AS cells_md5
FROM (SELECT DISTINCT rec_id FROM fields) CROSS JOIN (SELECT unnest({_WIDE_NAMES}) AS name, unnest(range({len(_WIDE_NAMES)})) AS place)
LEFT JOIN (WITH f AS ({_WIDE_FIRST})
SELECT rec_id, concat('new_', tag, '_', code) AS name, string_agg(value, ' | ' ORDER BY occ) AS cell FROM f WHERE code <> 'b' GROUP BY ALL
UNION ALL SELECT rec_id, concat('new_', tag, '_b'), value FROM f
  JOIN (SELECT rec_id, tag, min(occ) AS occ FROM fields GROUP BY ALL) o USING (rec_id, tag, occ) WHERE code = 'b'
UNION ALL SELECT rec_id, concat('new_', tag, '_full'), string_agg(t, ' | ' ORDER BY occ)
  FROM (SELECT rec_id, tag, occ, string_agg(value, ' ' ORDER BY pos) AS t FROM fields GROUP BY ALL) GROUP BY rec_id, tag) USING (rec_id, name)
GROUP BY rec_id""")
def _(spark, sf):
    wide = tagged.tagged_pivot(view(spark, sf, "fields"), _WIDE_SPEC, single=_WIDE_SINGLE)
    # the cells as one array, which both columns are computed from
    cells = wide.selectExpr("rec_id", f"array({', '.join(_WIDE_NAMES)}) AS cells")
    filled = "cast(size(array_remove(cells, '')) AS bigint) AS n_filled"
    return cells.selectExpr("rec_id", filled, "md5(cast(concat_ws('/', cells) AS binary)) AS cells_md5")


@query("tagged_subject_join", "tagged", f"""
SELECT rec_id, string_agg(h, ' | ' ORDER BY occ) AS raw_field_subject FROM (
  SELECT rec_id, occ, string_agg(value, ' -- ' ORDER BY code) AS h FROM ({_FIRST}) WHERE tag = '650' AND code IN ('a', 'x') GROUP BY ALL) GROUP BY rec_id""")
def _(spark, sf):
    return tagged.joined_subject(view(spark, sf, "tagged"))


@query("tagged_note_join", "tagged", f"""
SELECT rec_id, string_agg(value, ' | ' ORDER BY occ, list_position({fixed.NOTE_CODES}, code)) AS raw_field_note
FROM ({_FIRST}) WHERE tag = '700' AND list_contains({fixed.NOTE_CODES}, code) GROUP BY rec_id""")
def _(spark, sf):
    return tagged.joined_note(view(spark, sf, "tagged"))


@query("media_counts", "gold", "SELECT id, image_count, has_image FROM gold")
def _(spark, sf):
    records = base.unified(spark, sf).select("id", "field_identifier")
    return media.media_counts(records, view(spark, sf, "media"), "id").select("id", "image_count", "has_image")


@query("has_media_flag", "gold_text media", f"""
SELECT id, coalesce({sql.media_name(sql.primary('field_identifier'))} || '.jpg' IN (SELECT file_name FROM media), false) AS has_image FROM gold_text""")
def _(spark, sf):
    records = base.unified(spark, sf).select("id", "field_identifier")
    return media.has_media_flag(records, view(spark, sf, "media"), "id").select("id", "has_image")


_NAME = "trim(regexp_replace(regexp_replace({}, '[()\\[\\]''_]', ' ', 'g'), '[.\\s,-]+', '.', 'g'), '.')"
_PARTS = f"""SELECT id, source_system, i AS pos, {sql.strip('p')} AS part FROM (
  SELECT id, source_system, unnest(string_split(field_identifier, ';')) AS p, unnest(range(len(string_split(field_identifier, ';')))) AS i FROM gold_text) WHERE {sql.strip('p')} <> ''"""
_DIRS = "SELECT *, unnest(CASE source_system WHEN 'Museum' THEN ['objects', 'converted'] ELSE ['library', 'converted'] END) AS subdir, unnest([0, 1]) AS rank FROM parts"
_KEYED = f"parts AS ({_PARTS}), dirs AS ({_DIRS}), fold AS (SELECT subdir, {_NAME.format('lower(' + sql.strip('folder') + ')')} AS k, max(folder) AS folder FROM {{0}} GROUP BY ALL)"
_HIT = f"dirs.subdir = fold.subdir AND {_NAME.format('lower(' + sql.strip('part') + ')')} = fold.k"

_AUDIT = f"""WITH {_KEYED.format('folders')},
raw AS (SELECT id, arg_min(fold.subdir || '/' || fold.folder, pos * 10 + rank) AS path FROM dirs JOIN fold ON {_HIT} GROUP BY id),
done AS (SELECT DISTINCT id FROM parts WHERE {sql.media_name('part')} || '.jpg' IN (SELECT file_name FROM media))
SELECT g.id, g.field_identifier AS identifier, g.title, g.source_system, CASE WHEN path IS NULL THEN 'No' ELSE 'Yes' END AS raw_image_found,
  coalesce(path, '') AS raw_image_path, CASE WHEN done.id IS NULL THEN 'No' ELSE 'Yes' END AS processed_image_found
FROM gold_text g LEFT JOIN raw ON g.id = raw.id LEFT JOIN done ON g.id = done.id"""


def _audit(spark, sf):
    records = base.gold(spark, sf).select("id", "field_identifier", "title", "source_system")
    return media.media_audit(records, view(spark, sf, "folders").select("subdir", "folder").distinct(), view(spark, sf, "media"), "id")


@query("media_audit", "gold_text folders media", f"SELECT * FROM ({_AUDIT})")
def _(spark, sf):
    return _audit(spark, sf)


@query("media_audit_summary", "gold_text folders media", f"""
SELECT count(*) AS total_records, count(*) FILTER (raw_image_found = 'Yes') AS raw_found, count(*) FILTER (processed_image_found = 'Yes') AS processed_found,
  round(count(*) FILTER (raw_image_found = 'Yes') * 100.0::DOUBLE / count(*), 2) AS raw_pct, round(count(*) FILTER (processed_image_found = 'Yes') * 100.0::DOUBLE / count(*), 2) AS processed_pct
FROM ({_AUDIT})""")
def _(spark, sf):
    return media.audit_summary(_audit(spark, sf))


@query("net_new_media", "gold_text folders media", f"""
SELECT * FROM (WITH usable AS (SELECT * FROM folders WHERE regexp_matches(lower(file_name), '[.](tif|tiff|jpg|jpeg|png)$') AND file_name NOT LIKE '.%' AND file_name <> 'scan_2.TIF'),
listed AS (SELECT * FROM folders WHERE regexp_matches(lower(file_name), '[.](tif|tiff|jpg|jpeg|png)$') AND file_name NOT LIKE '.%'),
{_KEYED.format('listed')},
choice AS (SELECT id, pos, part, fold.k, arg_min(fold.subdir, rank) AS subdir FROM dirs JOIN fold ON {_HIT} GROUP BY ALL),
files AS (SELECT l.subdir, fold.k, l.folder, l.file_name, row_number() OVER (PARTITION BY l.subdir, fold.k ORDER BY l.file_name, l.folder) - 1 AS n
  FROM listed l JOIN fold ON l.subdir = fold.subdir AND l.folder = fold.folder),
plan AS (SELECT id, c.subdir || '/' || f.folder || '/' || f.file_name AS source_path, f.file_name, {sql.media_name('part')} || CASE WHEN n = 0 THEN '' ELSE '_' || n END || '.jpg' AS output,
  trim(regexp_replace(part, '[.\\s,-]+', '.', 'g'), '.') || CASE WHEN n = 0 THEN '' ELSE '_' || n END || '.jpg' AS legacy
  FROM choice c JOIN files f ON c.subdir = f.subdir AND c.k = f.k)
SELECT id, source_path, output FROM plan WHERE output NOT IN (SELECT file_name FROM media)
  AND legacy NOT IN (SELECT file_name FROM media) AND file_name <> 'scan_2.TIF')""")
def _(spark, sf):
    records = base.gold(spark, sf).select("id", "field_identifier", "source_system")
    existing = view(spark, sf, "media")
    return media.net_new_media(records, view(spark, sf, "folders"), existing, "id", blocklist=["scan_2.TIF"])


@query("log_alerts", "logs", """
SELECT date_trunc('minute', ts) AS window_start, container, count(*) AS lines, min(ts) AS first_ts, max(ts) AS last_ts FROM logs
WHERE regexp_matches(line, '(?i)error|fatal|exception|traceback') AND NOT regexp_matches(line, '(?i)qa_errors|no such file') GROUP BY ALL""")
def _(spark, sf):
    return log_alerts(view(spark, sf, "logs"))


@query("alert_lines", "logs", """
SELECT date_trunc('minute', ts) AS window_start, container, ts, line FROM logs
WHERE regexp_matches(line, '(?i)error|fatal|exception|traceback') AND NOT regexp_matches(line, '(?i)qa_errors|no such file') AND container <> 'svc-3'""")
def _(spark, sf):
    return alert_lines(view(spark, sf, "logs"), skip=["svc-3"])


@query("request_log_metrics", "requests", """
SELECT date_trunc('day', ts) AS window_start, endpoint, status_code, count(*) AS requests, count(*) FILTER (status_code >= 500) AS errors,
  round(sum(response_time_ms) / count(*), 3) AS avg_ms, max(response_time_ms) AS max_ms FROM requests GROUP BY ALL""".replace("date_trunc('day', ts)", "CAST(date_trunc('day', ts) AS TIMESTAMP)"))
def _(spark, sf):
    return metrics.request_metrics(view(spark, sf, "requests"))


@query("alert_outbursts", "logs", """
SELECT container, min(ts) AS opened, max(ts) AS last_ts, max(ts) + INTERVAL 12 HOUR AS closed, count(*) AS lines FROM (
  SELECT *, sum(CASE WHEN ts <= before + INTERVAL 12 HOUR THEN 0 ELSE 1 END) OVER (PARTITION BY container ORDER BY ts ROWS UNBOUNDED PRECEDING) AS burst FROM (
    SELECT ts, container, lag(ts) OVER (PARTITION BY container ORDER BY ts) AS before FROM logs
    WHERE regexp_matches(line, '(?i)error|fatal|exception|traceback') AND NOT regexp_matches(line, '(?i)qa_errors|no such file')))
GROUP BY container, burst""")
def _(spark, sf):
    return alert_outbursts(view(spark, sf, "logs"), "12 hours")


@query("latency_percentiles", "requests", """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, endpoint, count(response_time_ms) AS requests, quantile_cont(response_time_ms, 0.5) AS p50,
  quantile_cont(response_time_ms, 0.95) AS p95, quantile_cont(response_time_ms, 0.99) AS p99 FROM requests GROUP BY ALL""")
def _(spark, sf):
    return metrics.latency_percentiles(view(spark, sf, "requests"))


@query("traffic_daily", "traffic", """
SELECT CAST(strptime(date_text, '%Y%m%d') AS DATE) AS date, page_path, CAST(sum(sessions) AS INTEGER) AS sessions,
  CAST(sum(active_users) AS INTEGER) AS active_users, CAST(sum(page_views) AS INTEGER) AS page_views FROM traffic GROUP BY ALL""")
def _(spark, sf):
    return metrics.traffic_daily(view(spark, sf, "traffic"))


@query("retention_filter", "reports", """
SELECT file_name, d AS report_date FROM (SELECT file_name, CAST(strptime(regexp_extract(file_name, '_([0-9]{8})_', 1), '%Y%m%d') AS DATE) AS d FROM reports) WHERE d < DATE '2024-01-20'""")
def _(spark, sf):
    return expired_reports(view(spark, sf, "reports"), "2024-01-20")
