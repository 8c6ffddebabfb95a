"""Physical plans: what must and what must not be in them."""

import pytest
from pyspark.sql import functions as F

from checks import base, scalars, serving, tables  # noqa: F401
from checks.views import table, view
from shelfmark.operators.media import media_counts
from shelfmark.operators.merge import changed_since

SF = "/root/testdata/sf0.001"
QUERIES = base.QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"related_to_one"}))
def test_no_cross_joins_and_no_single_task_over_rows(spark, name):
    df = QUERIES[name](spark, SF)
    text = plan(df)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    # no window over a whole table in one task; the exceptions run over drawn or per-slice rows
    if name not in ("sample_groups", "prev_next", "assign_ids", "dense_ids", "gap_report", "records_page", "net_new_media"):
        lines = text.splitlines()
        for i, line in enumerate(lines):
            if "- Window [" in line:
                below = next((x for x in lines[i:] if "Exchange" in x), "")
                assert "SinglePartition" not in below


@pytest.mark.parametrize("name", [
    "clean_extent", "edtf_date", "agent_roles", "normalize_genre", "normalize_subject", "normalize_creator", "normalize_place",
    "year_decade", "media_audit", "genre_distribution", "related_records", "tagged_pivot", "tagged_table", "normalize_identifier",
    "credit_line", "gap_report", "comparison_left", "comparison_fuzzy"])
def test_native_operators_stay_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "EvalPython" not in text


@pytest.mark.parametrize("name", ["upsert_latest", "catalog_view", "inventory_join", "related_records", "graph_expand"])
def test_ranked_windows_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["prolific_creators", "sample_n", "simple_search", "browse_page", "top_values"])
def test_top_k_is_not_a_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"related_to_one"}))
def test_queries_scan_the_given_tables(spark, name):
    """Every plan reads the tables it is given, unless it continues from a checkpoint of such a plan."""
    text = plan(QUERIES[name](spark, SF))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert all(SF in line for line in scans) and (scans or "Scan ExistingRDD" in text)


def test_scans_are_pruned_and_filtered(spark):
    text = plan(QUERIES["decade_histogram"](spark, SF))
    assert "text:string" not in text and "p_name" not in text
    extract = plan(changed_since(table(spark, SF, "orders"), "1997-01-01", "o_orderdate", "o_orderdate"))
    assert "PushedFilters: [Or(GreaterThan(o_orderdate" in extract or "GreaterThan(o_orderdate" in extract
    assert "html" not in plan(view(spark, SF, "web"))


def test_hot_keys_are_split(spark):
    """A third of the rows with one key: the join splits that key over several tasks."""
    records = spark.range(0, 300000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("field_identifier"),
        F.repeat(F.lit("x"), 50).alias("title"))
    listing = spark.range(2000).select(F.concat(F.lit("k"), F.col("id").cast("string"), F.lit(".jpg")).alias("file_name"))
    listing = listing.union(spark.createDataFrame([("hot.jpg",), ("hot_1.jpg",)], "file_name string"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        counted = media_counts(records, listing, "id")
        assert counted.where("image_count = 2").count() == 100000
        counted = counted.select("id", "image_count")
        counted.collect()
        assert "skew=true" in plan(counted)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["tagged_pivot", "tagged_table"])
def test_tagged_pivot_shuffles_once(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["tagged_pivot", "tagged_table"])
def test_tagged_pivot_groups_once(spark, name):
    """One grouping by record, once before and once after the shuffle."""
    assert plan(QUERIES[name](spark, SF)).count("ObjectHashAggregate(") == 2


def test_related_pairs_are_not_sorted_in_the_tasks_of_the_join(spark):
    """A match key's candidates are joined as one list; a sort of all pairs would grow with the rows of a key."""
    lines = plan(QUERIES["related_records"](spark, SF)).splitlines()
    start = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(id#" in line)
    above_join = [line for line in lines[start : next(i for i in range(start, len(lines)) if "Join [" in lines[i])]]
    assert not any("Sort [" in line or "WindowGroupLimit" in line for line in above_join)


def test_duplicates_are_exploded_once_per_side(spark):
    text = plan(QUERIES["duplicates_report"](spark, SF))
    assert text.count("FileScan") <= 4 and "CartesianProduct" not in text
