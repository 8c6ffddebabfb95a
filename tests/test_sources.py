import json

from helpers import rows
from pyspark.sql import functions as F

from checks.views import view
from shelfmark.operators import tagged
from shelfmark.plans import gold, layers, silver
from shelfmark.plans.silver import read_role_vocabulary
from shelfmark.sources import files
from shelfmark.sources.registry import Layout, publish_views

SF = "/root/testdata/sf0.001"


def test_item_csv_files_with_different_headers(spark, tmp_path):
    (tmp_path / "PHYSICAL_ITEM_1.csv").write_text("MMS Record ID , Permanent Physical Location\n'991,REF\n'992,a,too,many\n993\n")
    (tmp_path / "PHYSICAL_ITEM_3.csv").write_text("MMS Record ID,Note\n'995,\"two\nlines\"\n'996,x,\n'997,\n")
    (tmp_path / "PHYSICAL_ITEM_2.csv").write_text("Permanent Physical Location,MMS Record ID,Note\nSTACKS,'994,\"x, y\"\n")
    (tmp_path / "other.csv").write_text("a\n1\n")
    items = files.read_items(spark, f"{tmp_path}/PHYSICAL_ITEM*.csv")
    assert rows(items.select("MMS Record ID", "Permanent Physical Location", "Note")) == [
        ("991", "REF", None), ("993", None, None), ("994", "STACKS", "x, y"), ("995", None, "two\nlines"), ("997", None, None)]
    assert files.read_items(spark, f"{tmp_path}/nothing*.csv") is None


def test_lookup_pages_and_request_log(spark, tmp_path):
    (tmp_path / "page1.json").write_text(json.dumps([{"nid": "1", "field_identifier_external": "a", "title": "t"}]))
    page = files.read_lookup_pages(spark, str(tmp_path / "page1.json"))
    assert rows(page.select("node_id", "field_identifier", "title")) == [("1", "a", "t")]
    (tmp_path / "log.jsonl").write_text('{"timestamp": "2024-01-01T00:00:00Z", "endpoint": "/x", "status_code": 200, "response_time_ms": 1.5}\n')
    assert files.read_request_log(spark, str(tmp_path / "log.jsonl")).first().response_time_ms == 1.5


def test_replace_table_swaps_and_can_read_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_table(spark.range(3), path)
    files.replace_table(spark.read.parquet(path).select((F.col("id") + 10).alias("id")), path)
    assert rows(spark.read.parquet(path)) == [(10,), (11,), (12,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_snapshot_of_a_day_is_written_once(spark, tmp_path):
    path = str(tmp_path / "history_x")
    for day, n in (("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-02", 4)):
        files.append_snapshot(spark.range(n), path, day)
    counts = spark.read.parquet(path).groupBy("snapshot_date").count()
    assert rows(counts.select(F.col("snapshot_date").cast("string"), "count")) == [("2024-01-01", 2), ("2024-01-02", 4)]
    files.append_snapshot(spark.range(0), path, "2024-01-02")  # nothing left of that day
    assert [str(r[0]) for r in spark.read.parquet(path).select("snapshot_date").distinct().collect()] == ["2024-01-01"]


def test_expired_reports_are_deleted(spark, tmp_path):
    for name in ("duplicates_report_20240101_101010.csv", "left_vs_right_report_20240102_1.csv", "image_audit_report.csv", "duplicates_report_20240103_1.csv", "x_99999999_1.csv"):
        (tmp_path / name).write_text("")
    gone = files.drop_expired_reports(spark, str(tmp_path), "2024-01-03")
    assert gone == ["duplicates_report_20240101_101010.csv", "left_vs_right_report_20240102_1.csv"]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["duplicates_report_20240103_1.csv", "image_audit_report.csv", "x_99999999_1.csv"]


def test_quoted_csv_export(spark, tmp_path):
    files.write_csv(spark.createDataFrame([('=IMAGE("u")', "")], "a string, b string").coalesce(1), str(tmp_path / "out"), quote_all=True)
    written = next((tmp_path / "out").glob("*.csv")).read_text()
    assert written == '"a","b"\n"=IMAGE(""u"")",""\n'


def test_role_vocabulary_is_ordered(spark):
    table = spark.createDataFrame([(2, "b", "y"), (1, "a", "x")], "rank int, role string, code string")
    assert read_role_vocabulary(table) == [("a", "x"), ("b", "y")]


def test_incremental_extract(spark, tmp_path):
    source = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "record_id int, t string")
    source = source.select("record_id", F.to_timestamp("t").alias("change_dte"), F.lit(None).cast("timestamp").alias("add_dte"))
    state, target = str(tmp_path / "state"), str(tmp_path / "deltas")
    assert layers.incremental_extract(spark, source, state, target, "1")
    assert not layers.incremental_extract(spark, source, state, target, "2")
    more = source.unionByName(source.limit(1).select(F.lit(3).alias("record_id"), F.lit(None).cast("timestamp").alias("change_dte"), F.to_timestamp(F.lit("2024-02-01")).alias("add_dte")))
    assert layers.incremental_extract(spark, more, state, target, "3")
    assert rows(spark.read.parquet(f"{target}/delta_3.parquet").select("record_id")) == [(3,)]
    assert spark.read.parquet(f"{target}/full_extract_1.parquet").count() == 2
    assert str(spark.read.parquet(state).first().watermark) == "2024-02-01 00:00:00"


def test_whole_batch_run(spark, tmp_path):
    """Every layer from raw extracts to views, against the query-level results."""
    layout = Layout(str(tmp_path / "lake"))
    deltas = str(tmp_path / "deltas")
    museum = view(spark, SF, "mus").withColumnsRenamed(
        {"field_identifier": "cat_nbr", "title": "cat_nam", "field_linked_agent": "artist", "field_genre": "name", "original_date": "categ_16"})
    museum.withColumn("user8", F.lit("Loan")).write.parquet(f"{deltas}/full_extract_1.parquet")
    raw_library = view(spark, SF, "flat")
    view(spark, SF, "web").write.parquet(layout.path("archive_raw"))
    images = view(spark, SF, "media")
    (tmp_path / "requests.jsonl").write_text("\n".join(json.dumps({"endpoint": f"/{i}", "status_code": 200}) for i in range(5)))
    traffic = {"traffic": view(spark, SF, "traffic"), "request_logs": str(tmp_path / "requests.jsonl")}
    for _ in range(2):  # a second run of the day changes nothing
        views = layers.run_layers(spark, layout, deltas, raw_library, "2024-01-01", images=images, roles=[("designer", "dsr")], **traffic)
    assert {"web_traffic", "request_log", "history_run_metrics"} <= set(views)
    assert spark.table("request_log").count() == 5 and spark.table("web_traffic").count() > 0
    counted = {(r.run_id, r.metric): r.value for r in spark.table("history_run_metrics").collect()}
    for name in ("museum_silver", "library_silver", "museum_qa_failures", "gold_unified_catalog", "gold_normalized_catalog", "web_traffic"):
        table = spark.table(name)
        assert counted[name, "rows"] == table.count()
        if "field_identifier" in table.columns:
            assert counted[name, "with_identifier"] == table.where("field_identifier IS NOT NULL").count()
    assert {"gold_normalized_catalog", "history_genre_distribution", "missing_objects", "museum_qa_failures"} <= set(views)
    gold = spark.table("gold_normalized_catalog")
    n = view(spark, SF, "mus").count() + raw_library.count()
    assert gold.count() == n and gold.select("id").distinct().count() == n
    assert gold.agg(F.min("id"), F.max("id")).first() == (1, n)
    assert spark.table("history_holding_type").count() == 1
    assert spark.table("history_total_scope").count() == 5
    assert spark.table("missing_objects").count() + spark.table("gold_unified_catalog").join(spark.table("missing_objects"), "id", "left_anti").count() == n
    assert spark.table("comparison_museum").where("exists = 'both'").count() > 0
    assert publish_views(spark, layout) == views


def test_tagged_rows_reach_gold(spark):
    """From long tagged rows to the normalised catalogue without a column made by hand."""
    field = lambda rec, tag, code, value, occ=1: (rec, tag, occ, 1, code, value)
    data = [f for rec in (7, 8) for f in (
        field(rec, "001", "ctrl", f"99{rec}"), field(rec, "907", "a", f"local@XB{rec}"), field(rec, "245", "a", "A title /"), field(rec, "655", "a", "posters."),
        field(rec, "650", "a", "Design"), field(rec, "650", "x", "History"), field(rec, "700", "a", "Some One"), field(rec, "264", "c", "[c1985]."))]
    long = spark.createDataFrame(data, "rec_id long, tag string, occ int, pos int, code string, value string")
    wanted = [(t, c, "joined") for t, c in (("001", "ctrl"), ("245", "a"), ("655", "a"), ("700", "a"), ("264", "c"))] + [("907", "a", "whole")]
    spec, single = tagged.read_field_spec(spark.createDataFrame(wanted, "tag string, code string, mode string"))
    library = silver.library_silver(tagged.flatten_records(long, spec, single))
    museum = silver.museum_silver(view(spark, SF, "mus").limit(5).withColumnsRenamed({"field_identifier": "cat_nbr", "title": "cat_nam"}))
    found = gold.normalize_catalog(gold.unify_catalog(museum, library, with_ids=True))
    assert sorted(r.id for r in found.collect()) == list(range(1, 8))
    mine = found.where("source_system = 'Library'").orderBy("record_id")
    assert rows(mine.select("record_id", "field_identifier", "title", "field_genre", "year_created")) == [
        (7, "XB7", "A title", "POSTER", 1985), (8, "XB8", "A title", "POSTER", 1985)]


def test_uploaded_id_lists(spark, tmp_path):
    def ids(name, text):
        (tmp_path / name).write_bytes(text.encode())
        return sorted(r.field_identifier for r in files.read_id_list(spark, str(tmp_path / name)).collect())

    assert ids("plain.csv", "a1\nb2\r\n\n c3 ,x\n") == ["a1", "b2", "c3"]
    assert ids("named.csv", "\ufeffTitle, FIELD_Identifier\n\"one, two\",a1\nx\ny,\nz,b2\n") == ["a1", "b2"]
    assert ids("id.csv", "ID\na1\nid\n") == ["a1", "id"]
    assert ids("like.csv", "my identifier,b\na1,c") == ["a1"]
    assert ids("quotes.csv", '"a ""b"" c",1\n"two\nlines",2\n"",3\n""x"",4\n"""",5\n"open, 6\n7') == ['"', 'a "b" c', "open, 6\n7", "two\nlines", "x"]
    assert ids("none.csv", " \n\r\n") == []
    assert len(ids("long.csv", "id\n" + "\n".join(f'"x ""{i}"""' for i in range(20_000)))) == 20_000


def test_media_listing_reads_no_contents(spark, tmp_path):
    for name in ("raw/A 1/one.TIF", "raw/A 1/deep/two.jpg", "raw/B/three.txt", "raw/four.jpeg", "done/five.JPG", "done/.hidden.jpg"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * len(name))
    roots = {"objects": str(tmp_path / "raw"), "converted": f"{tmp_path}/done/", "library": str(tmp_path / "none")}
    listing = files.list_media(spark, roots, (".jpg", ".jpeg", ".tif"))
    assert rows(listing.select("subdir", "folder", "file_name", "length")) == [
        ("converted", None, "five.JPG", 13), ("objects", None, "four.jpeg", 13), ("objects", "A 1", "one.TIF", 15), ("objects", "A 1", "two.jpg", 20)]
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()
    assert files.list_media(spark, {"library": str(tmp_path / "none")}, (".jpg",)).count() == 0
