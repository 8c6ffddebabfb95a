"""Source views over the driver's tables. The same SQL text runs on Spark and on the SQL oracle."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_VARIANTS = " UNION ALL ".join(
    f"SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'library' ELSE 'converted' END AS subdir, {k} AS k FROM pages"
    + (f" WHERE page_id % 4 >= {k}" if k else "")
    for k in range(4)
)

VIEWS = {
    # museum side
    "mus": """
SELECT p_partkey AS record_id,
       concat('2022.', cast(p_partkey % 97 AS varchar(9)), '.', cast(p_partkey AS varchar(12))) AS field_identifier,
       concat(p_name, '.') AS title,
       CASE WHEN p_partkey % 7 = 0 THEN concat(lower(p_type), '.') WHEN p_partkey % 11 = 0 THEN '' ELSE p_type END AS field_genre,
       concat(p_brand, '__designer||', p_name, '__printmaker') AS field_linked_agent,
       CASE WHEN p_partkey % 10 = 0 THEN 'Unknown' ELSE concat('circa__', cast(1800 + p_partkey % 225 AS varchar(4)), '__', cast(1801 + p_partkey % 225 AS varchar(4))) END AS original_date,
       concat('subject:Design--', p_name, '.') AS field_subject,
       concat('United States__', p_brand) AS field_place_published,
       CASE WHEN p_partkey % 13 = 0 THEN cast(NULL AS varchar(20)) ELSE 'Gift_of Fernanda' END AS field_credit_line,
       concat('Dimensions, overall__', cast(p_size AS varchar(4)), ' inches__', cast(p_size + 1 AS varchar(4)), ' 1/2 inches__height||weight 3 lb') AS field_extent,
       'Objects' AS field_collection_type
FROM part""",
    # library side; the title is the first sentence, the description the whole text
    "lib": """
SELECT doc_id AS record_id,
       CASE WHEN doc_id % 5 = 0 THEN concat('2022.', cast(doc_id % 97 AS varchar(9)), '.', cast(doc_id AS varchar(12)), '; XB', cast(doc_id AS varchar(12)))
            WHEN doc_id % 101 = 3 THEN cast(NULL AS varchar(40))
            ELSE concat('XB', cast(doc_id AS varchar(12))) END AS field_identifier,
       split_part(text, '.', 1) AS title,
       CASE lang WHEN 'en' THEN 'posters.' WHEN 'de' THEN 'Brochure' WHEN 'fr' THEN 'Magazine ' ELSE 'Atlas;' END AS field_genre,
       concat(source, ', | ', lang, '.') AS field_linked_agent,
       CASE WHEN doc_id % 17 = 0 THEN '' ELSE concat('[c', cast(1800 + doc_id % 225 AS varchar(4)), '].') END AS new_264_c,
       concat('c', cast(1850 + doc_id % 150 AS varchar(4)), ',') AS new_260_c,
       concat('Subject ', cast(doc_id % 37 AS varchar(4)), '. | Subject ', cast(doc_id % 11 AS varchar(4)), '.') AS field_subject,
       concat('Region ', cast(doc_id % 7 AS varchar(4)), ' | Region ', cast(doc_id % 5 AS varchar(4))) AS field_geographic_subject,
       CASE WHEN doc_id % 6 = 0 THEN '[S.l.]' ELSE concat('["', source, ' :"]') END AS field_place_published,
       text AS field_description_long,
       'Library' AS field_collection_type
FROM documents""",
    # public archive side
    "web": """
SELECT page_id AS node_id,
       CASE WHEN page_id % 6 = 0 THEN concat('xb', cast(page_id * 2 AS varchar(12)), '.')
            WHEN page_id % 6 = 3 THEN concat(' xb', cast(page_id * 2 AS varchar(12)), ' ')
            ELSE concat('(2022) ', cast(page_id % 97 AS varchar(9)), '-', cast(page_id AS varchar(12))) END AS field_identifier,
       url AS title,
       CASE WHEN page_id % 3 = 0 THEN 'Library' ELSE 'Objects' END AS field_collection_type
FROM pages""",
    # item inventory, several rows per record
    "items": """
SELECT concat('''', cast(o_custkey AS varchar(12))) AS mms_id,
       o_orderkey AS item_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'REF' WHEN '2-HIGH' THEN ' REFO ' ELSE 'STACKS' END AS location
FROM orders""",
    # tagged-field records
    "tagged": """
SELECT l_orderkey AS rec_id, l_linenumber AS occ, l_partkey AS pos,
       CASE l_returnflag WHEN 'A' THEN '650' WHEN 'N' THEN '700' ELSE '500' END AS tag,
       CASE l_linestatus WHEN 'O' THEN 'a' ELSE 'x' END AS code,
       concat('v', cast(l_partkey AS varchar(12))) AS value
FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, l_suppkey + 1000000,
       CASE l_returnflag WHEN 'A' THEN '650' WHEN 'N' THEN '700' ELSE '500' END,
       CASE WHEN l_quantity > 25 THEN 'x' ELSE 'b' END,
       concat('s', cast(l_suppkey AS varchar(12)))
FROM lineitem""",
    # tagged-field records of 250 tags
    "fields": """
SELECT l_orderkey AS rec_id, l_linenumber AS occ, l_partkey AS pos, cast(100 + l_partkey % 250 AS varchar(4)) AS tag,
       CASE l_linestatus WHEN 'O' THEN 'a' ELSE 'x' END AS code, concat('v', cast(l_partkey AS varchar(12))) AS value
FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, l_suppkey + 1000000, cast(100 + l_partkey % 250 AS varchar(4)),
       CASE WHEN l_quantity > 25 THEN 'x' ELSE 'b' END, concat('s', cast(l_suppkey AS varchar(12)))
FROM lineitem""",
    # media files, 1 to 4 variants per base
    "media": f"""
SELECT subdir, CASE WHEN k = 0 THEN concat('XB', cast(page_id AS varchar(12)), '.jpg')
                    ELSE concat('XB', cast(page_id AS varchar(12)), '_', cast(k AS varchar(4)), '.jpg') END AS file_name
FROM ({_VARIANTS}) v
UNION ALL
SELECT 'objects', concat('2022.', cast(p_partkey % 97 AS varchar(9)), '.', cast(p_partkey AS varchar(12)),
                         CASE WHEN p_size > 5 THEN '' ELSE '_1' END, '.jpg')
FROM part WHERE p_size <= 10
UNION ALL
SELECT 'objects', concat('2022.', cast(p_partkey % 97 AS varchar(9)), '.', cast(p_partkey AS varchar(12)), '_3.jpg')
FROM part WHERE p_size > 7""",
    # raw media folders and the files in them
    "folders": f"""
SELECT subdir, CASE WHEN page_id % 3 = 0 THEN concat('(XB', cast(page_id AS varchar(12)), ')') ELSE concat('XB', cast(page_id AS varchar(12))) END AS folder,
       concat('scan_', cast(k AS varchar(4)), CASE WHEN page_id % 11 = 0 THEN '.txt' ELSE '.TIF' END) AS file_name
FROM ({_VARIANTS}) v
UNION ALL
SELECT 'objects', concat('2022-', cast(p_partkey % 97 AS varchar(9)), '-', cast(p_partkey AS varchar(12))), 'front.png'
FROM part WHERE p_size <= 10""",
    # change batches
    "deltas": """
SELECT o_custkey AS record_id, o_orderkey AS row_id,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS change_dte,
       o_orderdate AS add_dte, o_orderstatus AS status, o_totalprice AS amount
FROM orders""",
    # container log lines
    "logs": """
SELECT ts, concat('svc-', cast(user_id % 5 AS varchar(4))) AS container,
       CASE event_type WHEN 'error' THEN concat('ERROR id=', cast(event_id AS varchar(12)))
                       WHEN 'signup' THEN 'error: qa_errors column' ELSE 'INFO ok' END AS line
FROM events""",
    # request log
    "requests": """
SELECT ts, concat('/api/v1/', event_type) AS endpoint, 'GET' AS method,
       CASE event_type WHEN 'error' THEN 500 ELSE 200 END AS status_code, value AS response_time_ms
FROM events""",
    # web traffic with text dates
    "traffic": """
SELECT replace(substr(cast(ts AS varchar(30)), 1, 10), '-', '') AS date_text, concat('/', event_type) AS page_path,
       user_id AS sessions, user_id % 3 AS active_users, 1 AS page_views
FROM events""",
    # dated report files
    "reports": """
SELECT concat('duplicates_report_', replace(substr(cast(ts AS varchar(30)), 1, 10), '-', ''), '_', cast(event_id AS varchar(12)), '.csv') AS file_name
FROM events""",
    # retrieval questions
    "questions": """
SELECT conv_id * 1000 + turn AS question_id, text AS question FROM conversations WHERE role = 'user'""",
    # flattened library records with their raw columns
    "flat": """
SELECT doc_id AS record_id, concat('99', cast(doc_id AS varchar(12))) AS new_001_ctrl,
       CASE WHEN doc_id % 4 = 0 THEN concat('local@XB', cast(doc_id AS varchar(12))) ELSE concat('Local XB', cast(doc_id AS varchar(12))) END AS new_907_full,
       concat(split_part(text, '.', 1), ' /') AS new_245_a, CASE WHEN lang = 'de' THEN cast(NULL AS varchar(9)) ELSE concat('-- ', source) END AS new_245_b,
       concat(cast(n_chars AS varchar(12)), ' p.') AS new_300_a, CASE WHEN lang = 'en' THEN 'ill. ' ELSE '' END AS new_300_b,
       CASE WHEN lang = 'fr' THEN cast(NULL AS varchar(9)) ELSE '28 cm' END AS new_300_c,
       concat('850101s1985    ', lang, 'x  000 0 ', lang) AS new_008_ctrl,
       concat(source, ' : ') AS new_260_a, concat(' ', source) AS new_260_b, CASE WHEN lang = 'es' THEN ' ' ELSE lang END AS new_100_a,
       concat(lang, '.') AS new_655_a
FROM documents""",
}
_NEEDS = {name: [t for t in TABLES if f"FROM {t}" in sql] for name, sql in VIEWS.items()}


@lru_cache(maxsize=256)
def _read(application: str, sf_dir: str, name: str) -> DataFrame:
    return SparkSession.active().read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (its schema is read once per session)."""
    return _read(spark.sparkContext.applicationId, sf_dir, name)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source view on Spark."""
    for needed in _NEEDS[name]:
        table(spark, sf_dir, needed).createOrReplaceTempView(needed)
    return spark.sql(VIEWS[name])
