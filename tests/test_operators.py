import numpy as np
import pyarrow as pa
import pytest
from helpers import rows
from pyspark.sql import functions as F

from shelfmark.functions.fixed import RETRIEVAL_WEIGHTS, STOP_WORDS
from shelfmark.operators import compare, dense, media, merge, metrics, quality, related, retrieval, sample, search, shape, tagged, unify


def test_dense_ids_with_a_hot_leading_value(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    numbered = dense.assign_ids(df, [F.asc("k"), F.desc("id")], "n")
    wanted = sorted((r.k, -r.id) for r in df.collect())
    assert [(r.k, -r.id) for r in numbered.orderBy("n").collect()] == wanted
    assert [r.n for r in numbered.orderBy("n").collect()] == list(range(1, 5001))
    keyed = dense.assign_ids(df, [F.asc("k"), F.desc("id")], "n")
    assert rows(keyed.select("id", "n")) == rows(numbered.select("id", "n"))


def test_neighbours_and_group_index_cross_slices(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("g"), F.when(F.col("id") % 7 != 0, F.col("id")).alias("v"))
    found = {r.id: (r.previous, r.next) for r in dense.neighbours(df, [F.desc("id")], "v").collect()}
    values = {r.id: r.v for r in df.collect()}
    assert found == {i: (values.get(i + 1), values.get(i - 1)) for i in range(1000)}
    index = dense.index_in_group(df, ["g"], [F.asc("id")], "n")
    assert {(r.id, r.n) for r in index.collect()} == {(i, i // 2) for i in range(1000)}


def test_keep_one_keeps_rows_without_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, n int")
    newest = [F.desc("n")]
    assert rows(merge.keep_one(df, [F.col("k")], newest)) == [(None, 3), (None, 4), ("a", 2)]
    assert rows(merge.keep_one(df, [F.col("k")], newest, collapse_null_keys=True)) == [(None, 4), ("a", 2)]


def test_upserts_one_by_one_equal_all_at_once(spark):
    batches = [spark.range(20).select((F.pmod(F.hash("id", F.lit(b)), F.lit(9))).alias("record_id"), F.lit(b).alias("batch"), F.col("id").alias("row")) for b in range(4)]
    master = None
    for batch in batches:
        master = merge.upsert_latest(master, batch, "batch", "row")
    everything = batches[0]
    for batch in batches[1:]:
        everything = everything.unionByName(batch)
    assert rows(master) == rows(merge.upsert_latest(None, everything, "batch", "row"))
    # the order of arrival does not matter, and a full extract replaces the master
    backwards = None
    for batch in reversed(batches):
        backwards = merge.upsert_latest(backwards, batch, "batch", "row")
    assert rows(backwards) == rows(master)
    full = merge.upsert_latest(master, batches[1], "batch", "row", full_extract=True)
    assert rows(full) == rows(merge.upsert_latest(None, batches[1], "batch", "row"))


def test_watermark_never_moves_back(spark):
    df = spark.createDataFrame([("2024-01-02", None), (None, "2024-01-03")], "change_dte string, add_dte string")
    df = df.select(F.to_timestamp("change_dte").alias("change_dte"), F.to_timestamp("add_dte").alias("add_dte"))
    assert str(merge.next_watermark(df).first()[0]) == "2024-01-03 00:00:00"
    assert str(merge.next_watermark(df, "2025-01-01").first()[0]) == "2025-01-01 00:00:00"
    assert str(merge.next_watermark(df.limit(0), "2025-01-01").first()[0]) == "2025-01-01 00:00:00"
    assert merge.changed_since(df, None).count() == 2
    assert merge.changed_since(df, "2024-01-02 12:00:00").count() == 1


def test_gap_and_match_make_the_input(spark):
    catalog = spark.createDataFrame([(1, "2022.1"), (2, "(2022) 2"), (3, None), (4, "x")], "id int, field_identifier string")
    published = spark.createDataFrame([("2022-1",), ("2022.2",), (None,)], "field_identifier string")
    gap = compare.gap_report(catalog, published, "id")
    assert rows(gap) == [(3, None), (4, "x")]
    both = compare.compare_left(catalog, published, "id")
    assert both.where("exists = 'left_only'").count() + both.where("exists = 'both'").count() == 4
    assert both.where("exists = 'left_only'").count() == gap.count()


def test_duplicate_marks(spark):
    museum = spark.createDataFrame([("A1; b2",), (None,)], "field_identifier string")
    library = spark.createDataFrame([(7, " a1 ;c"), (8, "d"), (9, None), (10, "B2;")], "record_id int, field_identifier string")
    marked = unify.mark_duplicates(library, museum, "record_id")
    assert rows(marked.orderBy("record_id").select("field_identifier")) == rows(
        spark.createDataFrame([("a1_dup_7; c",), ("d",), (None,), ("B2_dup_10; ",)], "field_identifier string"))
    kept = unify.exclude_ids(library, ["a1"])
    assert kept.count() == 3


def test_collections(spark):
    mine = spark.createDataFrame([("a", "x")], "field_identifier string, title string")
    new = spark.createDataFrame([("a", "y"), ("b", "z")], "field_identifier string, title string")
    assert rows(merge.collection_add(mine, new)) == [("a", "x"), ("b", "z")]
    assert rows(merge.collection_remove(new, mine)) == [("b", "z")]
    assert rows(merge.collection_contains(new, mine).select("field_identifier", "in_collection")) == [("a", True), ("b", False)]


def test_quality_rules(spark):
    df = spark.createDataFrame([("1", "t"), (None, " "), ("", "t")], "field_identifier string, title string")
    checked = quality.apply_rules(df, quality.basic_rules(df))
    passed, failed = quality.split_quarantine(checked)
    assert passed.count() == 1
    assert sorted(r.qa_errors for r in failed.collect()) == ["Identifier is missing", "Identifier is missing | Title is missing"]
    assert quality.qa_gate(checked).count() == 1
    observed, observation = quality.observe_counts(checked, "qa", failed=~F.col("qa_pass"))
    observed.write.format("noop").mode("overwrite").save()
    assert observation.get == {"rows": 3, "failed": 2}


def test_media_runs_against_brute_force(spark):
    names = ["a.jpg", "a_1.jpg", "a_2.jpg", "a_4.jpg", "b_1.jpg", "c.jpg", "c_2.jpg", "a_1_1.jpg", "d.png", "e_01.jpg", "e.jpg", "a.jpg"]
    names += [f"hot_{k}.jpg" for k in range(1, 300)] + ["hot.jpg"]
    listing = spark.createDataFrame([(n,) for n in names], "file_name string")
    stored, wanted = set(names), {}
    for base in {n[:-4] for n in names if n.endswith(".jpg")}:
        count = 1
        while f"{base}_{count}.jpg" in stored:
            count += 1
        wanted[base] = count
    assert {r.base: r.files for r in media.file_counts(listing).collect()} == wanted


def test_media_counts_use_the_first_part_with_a_file(spark):
    records = spark.createDataFrame([(1, "no; a"), (2, "c;a"), (3, None), (4, "x" * 201)], "id int, field_identifier string")
    listing = spark.createDataFrame([("a.mp3",), ("a_1.wav",), ("c.wav",), ("x" * 201 + ".mp3",)], "file_name string")
    counted = media.media_counts(records, listing, "id", "audio", (".mp3", ".wav"))
    assert rows(counted.select("id", "audio_count", "has_audio")) == [(1, 2, True), (2, 1, True), (3, 0, False), (4, 1, True)]


def test_net_new_media(spark):
    records = spark.createDataFrame([(1, "A-1", "Museum"), (2, "b", "Library"), (3, "old 2", "Other")], "id int, field_identifier string, source_system string")
    listing = spark.createDataFrame(
        [("objects", "a.1", "2.tif"), ("objects", "a.1", "1.JPG"), ("objects", "a.1", ".hidden.jpg"), ("converted", "a.1", "0.tif"),
         ("library", "b", "notes.txt"), ("converted", "B", "s.png"), ("education", "old.2", "s.png")], "subdir string, folder string, file_name string")
    existing = spark.createDataFrame([("A-1.jpg",), ("old.2.jpg",)], "file_name string")
    found = media.net_new_media(records, listing, existing, "id")
    assert rows(found) == [(1, "objects/a.1/2.tif", "A-1_1.jpg"), (2, "converted/B/s.png", "b.jpg")]
    assert media.net_new_media(records, listing, existing, "id", blocklist=["s.png"]).count() == 1


def test_tagged_fields(spark):
    data = [(1, "650", 1, 2, "a", "x"), (1, "650", 1, 1, "a", "first"), (1, "650", 1, 3, "x", "sub"), (1, "650", 2, 1, "x", "only"),
            (1, "535", 1, 1, "b", "no a here"), (1, "535", 2, 1, "a", "late"), (2, "900", 1, 1, "a", "other"), (1, "650", 3, 1, "a", "")]
    df = spark.createDataFrame(data, "rec_id int, tag string, occ int, pos int, code string, value string")
    wide = tagged.tagged_pivot(df, [("650", ["a", "x", "."], True)], single=[("535", "a")])
    assert {r.rec_id: r.asDict() for r in wide.collect()} == {
        1: {"rec_id": 1, "new_650_a": "first", "new_650_x": "sub | only", "new_650_dot": "", "new_535_a": "", "new_650_full": "first x sub | only"},
        2: {"rec_id": 2, "new_650_a": "", "new_650_x": "", "new_650_dot": "", "new_535_a": "", "new_650_full": ""},
    }
    assert rows(tagged.joined_subject(df)) == [(1, "first -- sub | only")]


@pytest.mark.parametrize(
    ("text", "groups"),
    [
        ("a, b c,", [[(False, "a")], [(False, "b c")]]),
        ("a b", [[(False, "a b")]]),
        ("a AND b OR not c", [[(False, "a"), (False, "b")], [(True, "c")]]),
        ('"a and b" c NOT d', [[(False, "a and b"), (False, "c"), (True, "d")]]),
        ("OR", []),
        ("android NOT", [[(False, "android")]]),
    ],
)
def test_search_terms(text, groups):
    assert search.parse_terms(text) == groups


@pytest.fixture(scope="module")
def catalog(spark):
    data = [(i, f"ID{i}" if i % 9 else None, f"title {i % 4} red" if i % 2 else f"blue {i}", ["POSTER", "MAP", None][i % 3],
             f"Ann {i % 5}" if i % 6 else None, f"s{i % 7} | s{i % 3}", i % 4 == 0, "Library" if i % 2 else "Museum", 1900 + i % 3 * 10) for i in range(120)]
    df = spark.createDataFrame(data, "id int, field_identifier string, title string, field_genre string, field_linked_agent string, field_subject string, has_image boolean, source_system string, decade_created int")
    return df.withColumns({"search_text": F.lower(F.concat_ws(" ", "title", "field_genre")), "image_count": F.lit(1), "field_place_published": F.lit(None).cast("string")})


def test_boolean_truth_table(spark, catalog):
    found = {r.id for r in search.search(catalog, search.SearchSpec(term='red NOT "title 1" OR blue AND poster')).collect()}
    wanted = {r.id for r in catalog.collect() if ("red" in r.search_text and "title 1" not in r.search_text) or ("blue" in r.search_text and "poster" in r.search_text)}
    assert found == wanted and wanted
    # signs that a pattern match would treat as wild cards are literal
    assert search.search(catalog, search.SearchSpec(term="t_tle, %")).count() == 0


def test_facets_leave_out_their_own_condition(spark, catalog):
    spec = search.SearchSpec(genre="POSTER", creator="Ann 1", decade=1900)
    found = search.responsive_facets(catalog, spec)
    for facet, (column, split) in search.FACETS.items():
        other = search.SearchSpec(**{**spec.__dict__, facet: "" if facet != "decade" else None})
        kept = search.search(catalog, other) if facet in ("genre", "creator", "subject", "place", "decade") else None
        counts: dict = {}
        seen = set()
        for r in kept.collect():
            values = [r[column]] if not split else [v.strip() for v in (r[column] or "").split("|") if v.strip()]
            for v in values:
                if v is None or (split and (r.field_identifier, v) in seen):
                    continue
                seen.add((r.field_identifier, v))
                counts[str(v)] = counts.get(str(v), 0) + 1
        assert {r.value: r["count"] for r in found.where(F.col("facet") == facet).collect()} == counts, facet


def test_related_records_against_brute_force(spark, catalog):
    data = catalog.orderBy("id").collect()
    found = related.related_records(catalog, "id").collect()
    for record in data:
        main = record.field_subject.split("|")[0].strip()
        others = [o for o in data if o.has_image and o.field_identifier and o.id != record.id and (
            (record.field_genre and o.field_genre == record.field_genre)
            or (record.field_linked_agent and o.field_linked_agent == record.field_linked_agent)
            or main in [s.strip() for s in o.field_subject.split("|")])]
        wanted = [o.id for o in sorted(others, key=lambda o: (o.field_identifier, o.id))[:4]]
        assert [r.related_key for r in sorted((r for r in found if r.id == record.id), key=lambda r: r.rank)] == wanted
    assert related.related_to(catalog, "ID5").count() == 4
    lonely = catalog.where("has_image").withColumns({c: F.when(F.col("id") != 4, F.col(c)) for c in ("field_genre", "field_linked_agent", "field_subject")})
    assert related.related_to(lonely, "ID4").count() == 4  # the random stand-in


def test_retrieval_against_brute_force(spark):
    questions = [(i, q) for i, q in enumerate(["Show me red posters", "the in on", "zzz", "map map Été", "re", "poster of the city", *[f"word{i} red" for i in range(30)]])]
    records = [(i, f"Red poster {i}" if i % 3 else None, "maps", f"été word{i % 35} City", "MAP" if i % 2 else "") for i in range(700)]
    asked = spark.createDataFrame(questions, "q int, text string")
    catalog = spark.createDataFrame(records, "id int, title string, field_subject string, field_description_long string, field_genre string").repartition(5)
    found = retrieval.retrieve(asked, catalog, "q", "text", "id").collect()
    for q, text in questions:
        words = [w for w in text.lower().split() if len(w) > 2 and w not in STOP_WORDS]
        scored = []
        for r in records:
            fields = dict(zip(["title", "field_subject", "field_description_long", "field_genre"], r[1:]))
            score = sum(weight for w in words for f, weight in RETRIEVAL_WEIGHTS.items() if fields[f] and w in fields[f].lower())
            if score:
                scored.append((-score, r[0]))
        wanted = [(i, -s) for s, i in sorted(scored)[:5]]
        assert [(r.id, r.score) for r in sorted((r for r in found if r.q == q), key=lambda r: r["rank"])] == wanted
    context = retrieval.retrieval_context(asked, retrieval.retrieve(asked, catalog, "q", "text", "id"), catalog.withColumn("field_identifier", F.lit("x")), "q", "text", "id")
    texts = {r.q: r.context for r in context.collect()}
    assert texts[1] == "" and texts[2] == "No catalogue record matches." and texts[0].count("Title:") == 5


def test_samples_repeat(spark, catalog):
    first = rows(sample.sample_n(catalog.select("id"), "id", 10, "s"))
    assert first == rows(sample.sample_n(catalog.select("id").repartition(7), "id", 10, "s"))
    assert first != rows(sample.sample_n(catalog.select("id"), "id", 10, "t"))
    groups = sample.sample_groups(catalog, "id", "title", "s").collect()
    assert len({r.id for r in groups}) == 40
    assert sorted((r["group"], r.slot) for r in groups) == [(g, s) for g in range(10) for s in range(4)]


def test_prune_and_align(spark):
    df = spark.createDataFrame([(1, None, "x")], "b int, empty string, a string")
    assert shape.prune_empty_columns(df).columns == ["b", "a"]
    assert shape.align_schema(df, ["id", "b"]).columns == ["id", "b", "a", "empty"]
    assert rows(shape.clean_strings(spark.createDataFrame([(" x ", " ", "nan")], "a string, b string, c string"), ["nan"])) == [("x", None, None)]
    assert shape.resolve_lookup(spark.createDataFrame([(1, "z")], "node int, accn string")).columns == ["node_id", "field_identifier"]


def test_top_genres_with_ties(spark):
    df = spark.createDataFrame([("L", g) for g in "aabbcd"] + [("M", None)], "field_collection_type string, field_genre string")
    assert rows(metrics.genre_distribution(df, top=2)) == [("L", "Other", 2), ("L", "a", 2), ("L", "b", 2), ("M", "Other", 1)]


def test_merging_a_batch_twice_is_merging_it_once(spark):
    schema = "record_id long, n int, at timestamp, note string"
    first = spark.sql("SELECT * FROM VALUES (1L, 1, timestamp'2024-01-01', 'a'), (NULL, 2, timestamp'2024-01-01', 'b'), (NULL, 3, timestamp'2024-01-01', NULL), (NULL, 3, timestamp'2024-01-01', NULL) t(record_id, n, at, note)")
    second = spark.createDataFrame([(1, 9, None, "c"), (None, 2, None, "b")], schema).withColumn("at", F.to_timestamp(F.lit("2024-02-01"))).withColumn("extra", F.lit("new"))
    once = merge.upsert_latest(None, first, "at", "n")
    assert once.count() == 3  # equal rows without a key are one
    twice = merge.upsert_latest(once, first, "at", "n")
    assert rows(twice) == rows(once)
    grown = merge.upsert_latest(twice, second, "at", "n")
    assert grown.count() == 4
    assert rows(merge.upsert_latest(merge.upsert_latest(grown, second, "at", "n"), first, "at", "n")) == rows(grown)


def test_all_cursor_pages_are_the_full_order(spark):
    data = [(i, [True, False, None][i % 3], [None, "b", "a", "a"][i % 4], [1.5, None, 0.1][i % 3], ["x", None][i % 2]) for i in range(50)]
    df = spark.createDataFrame(data, "id long, has_image boolean, title string, score double, field_identifier string")
    for order in (search.BROWSE_ORDER, search.SCORE_ORDER, search.DOSSIER_ORDER):
        wanted = [r.id for r in df.orderBy(*[by.sort() for by in order]).collect()]
        found, cursor = [], None
        while page := search.cursor_page(df, order, 17, cursor).collect():
            found += [r.id for r in page]
            cursor = page[-1].cursor
        assert found == wanted


def test_search_folds_the_text_once(spark):
    from checks import base
    from checks.views import view  # noqa: F401
    from shelfmark.plans.gold import normalize_catalog

    catalog = normalize_catalog(base.unified(spark, "/root/testdata/sf0.001"))

    def folds(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("translate(")

    single = folds(catalog.select("id", "search_text"))
    spec = search.SearchSpec(term="Brand, ring, src1 AND (x)")
    assert folds(search.search(catalog, spec).select("id", "search_text")) == single
    assert folds(search.ranked_search(catalog.withColumn("has_image", F.lit(True)), search.SearchSpec(term="a, b, c")).select("id", "search_text", "score")) == single


def test_retrieval_equals_a_plain_scan(spark):
    draw = __import__("random").Random(2)
    words = ["".join(draw.choice("abc") for _ in range(draw.randint(1, 7))) for _ in range(60)] + ["hot"] * 30
    fields = list(RETRIEVAL_WEIGHTS)
    records = [(i, *[None if draw.random() < 0.1 else " ".join(draw.choices(words, k=draw.randint(0, 6))) for _ in fields]) for i in range(80)]
    questions = [(i, " ".join(draw.choices(words + ["the", "Hot"], k=draw.randint(0, 5)))) for i in range(60)]
    catalog = spark.createDataFrame(records, "id long, " + ", ".join(f"{f} string" for f in fields))
    wanted = []
    for q, text in questions:
        asked = [w for w in text.lower().split() if len(w) > 2 and w not in STOP_WORDS]
        points = {r[0]: sum(w * sum(k in (t or "").lower() for k in asked) for w, t in zip(RETRIEVAL_WEIGHTS.values(), r[1:], strict=True)) for r in records}
        best = sorted((-s, i) for i, s in points.items() if s > 0)[:5]
        wanted += [(q, i, -s, n + 1) for n, (s, i) in enumerate(best)]
    found = retrieval.retrieve(spark.createDataFrame(questions, "q long, text string"), catalog, "q", "text", "id")
    assert rows(found) == sorted(wanted, key=lambda t: tuple((True, str(v)) for v in t))
    assert "Pandas" not in found._jdf.queryExecution().executedPlan().toString()


def test_retrieval_writes_no_pairs(spark):
    """Every question meets every record; the bytes shuffled must not grow with their product."""
    n = 600
    questions = spark.range(n).select(F.col("id").alias("q"), F.lit("alpha beta gamma delta epsilon").alias("text"))
    catalog = spark.range(n).select(
        "id", F.lit("alpha beta").alias("title"), F.lit("gamma").alias("field_subject"), F.lit("delta").alias("field_description_long"),
        F.lit("epsilon").alias("field_genre"))
    found = retrieval.retrieve(questions, catalog, "q", "text", "id")
    wanted = [(q, i, 7, i + 1) for q in range(n) for i in range(5)]
    assert sorted(tuple(r) for r in found.collect()) == wanted
    plan = found._jdf.queryExecution().executedPlan()

    def most_bytes(node):
        metric = node.metrics().get("dataSize")
        below = [most_bytes(node.children().apply(i)) for i in range(node.children().size())]
        if node.getClass().getSimpleName().startswith("AdaptiveSparkPlan"):
            below.append(most_bytes(node.executedPlan()))
        if "QueryStageExec" in node.getClass().getSimpleName():
            below.append(most_bytes(node.plan()))
        shuffled = metric.isDefined() and node.metrics().contains("shuffleBytesWritten")
        return max([metric.get().value() if shuffled else 0, *below])

    assert 0 < most_bytes(plan) < 4 * n * n


def test_retrieval_in_several_blocks_and_with_long_words(spark, monkeypatch):
    long = "x" * 30 + "needle" + "y" * 30
    catalog = spark.createDataFrame([(i, "aneedlea" if i % 2 else long, None, "needle needle aneedle", "") for i in range(50)],
                                    "id long, title string, field_subject string, field_description_long string, field_genre string")
    catalog = catalog.withColumn("field_identifier", F.lit("n"))
    asked = spark.createDataFrame([(1, "needle needle"), (2, long + " xxx"), (3, "none")], "q long, text string")
    whole = rows(retrieval.retrieve(asked, catalog, "q", "text", "id"))
    assert whole == [(1, i, 6, i + 1) for i in range(5)] + [(2, 2 * i, 4, i + 1) for i in range(5)]
    texts = rows(retrieval.retrieval_context(asked, retrieval.retrieve(asked, catalog, "q", "text", "id"), catalog, "q", "text", "id"))
    monkeypatch.setattr(retrieval, "BLOCK_RECORDS", 7)
    monkeypatch.setattr(retrieval, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(retrieval, "CONTEXT_QUESTIONS", 1)
    assert rows(retrieval.retrieve(asked, catalog, "q", "text", "id")) == whole
    assert rows(retrieval.retrieval_context(asked, retrieval.retrieve(asked, catalog, "q", "text", "id"), catalog, "q", "text", "id")) == texts


def test_points_of_a_block_equal_brute_force(monkeypatch):
    draw = __import__("random").Random(4)
    weights = [2, 1, 90]
    words = {f"w{i}": sorted(draw.sample(range(100, 130), draw.randint(1, 6))) for i in range(40)}
    fields = [(draw.choice([None, *range(9)]), 1 << draw.randrange(3), draw.sample([*words, "other"], draw.randint(0, 12))) for _ in range(60)]
    asked = [[(k, draw.choice([1, 1, 3, 900])) for k in draw.sample(range(95, 135), draw.randint(0, 12))] for _ in range(50)]
    batches = [
        [pa.RecordBatch.from_pydict({"word": [w], "keywords": pa.array([k], pa.list_(pa.int64()))}) for w, k in words.items()],
        [pa.RecordBatch.from_pydict({"record": pa.array([r], pa.int64()), "fields": pa.array([f], pa.int32()), "words": pa.array([w], pa.list_(pa.string()))}) for r, f, w in fields],
    ]
    keys = sorted({r for r, _, _ in fields}, key=lambda r: (r is not None, r))
    held = {r: {(k, f) for x, f, ws in fields if x == r for w in ws if w in words for k in words[w]} for r in keys}
    for rare, size in ((0, 1 << 20), (16, 1 << 20), (2, 50)):
        for name, value in (("RARE", rare), ("DENSE_BYTES", size), ("ROWS", 3), ("POSTINGS", 5)):
            monkeypatch.setattr(retrieval, name, value)
        block = retrieval._Points(iter(batches[0]), iter(batches[1]), weights)
        flat = np.array([x for q in asked for x in q], dtype=np.int64).reshape(-1, 2)
        found = {q: (places.tolist(), scores.tolist()) for q, places, scores in block.best(np.array([len(q) for q in asked]), flat[:, 0], flat[:, 1], 4)}
        for q, keywords in enumerate(asked):
            points = [sum(t * weights[f.bit_length() - 1] for k, t in keywords for x, f in held[r] if x == k) for r in keys]
            best = sorted((-p, i) for i, p in enumerate(points) if p)[:4]
            assert sorted(zip(*found.get(q, ([], [])))) == sorted((i, -p) for p, i in best)


def test_blocks_bring_no_null_lists(spark):
    """Arrow's writer passes over all nulls before a null list for every row."""
    one = spark.range(50).select((F.col("id") % 3).cast("int").alias("block"), F.array("id").alias("a"))
    two = spark.range(50).select((F.col("id") % 3).cast("int").alias("block"), F.array(F.lit("x")).alias("b"))

    def nulls(*found):
        yield pa.RecordBatch.from_pydict({"n": [sum(b.column(c).null_count for f in found for b in f for c in ("a", "b"))]})

    assert [r.n for r in retrieval._by_block([one, two], 3, nulls, "n long").collect()] == [0, 0, 0]


def test_contexts_are_not_shuffled(spark):
    catalog = spark.createDataFrame([(1, "red map", "x")], "id long, title string, field_identifier string")
    catalog = catalog.withColumns({"field_description_long": F.lit("d"), "field_subject": F.lit("")})
    asked = spark.createDataFrame([(7, "red"), (8, "blue"), (9, None), (None, "of the")], "q long, text string")
    found = retrieval.retrieval_context(asked, spark.createDataFrame([(7, 1, 1)], "q long, id long, rank int"), catalog, "q", "text", "id", "", "", "no")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange")
    assert rows(found)[1:] == [(7, "1. Title: red map\nID: x\nDescription: d\nSubject: N/A\n\n"), (8, "no"), (9, "no")] and rows(found)[0][0] is None


def test_context_of_a_repeated_record_has_all_its_rows(spark):
    catalog = spark.createDataFrame([(1, "b", "x"), (1, "a", "y"), (None, "c", "z")], "id long, title string, field_identifier string")
    catalog = catalog.withColumns({"field_description_long": F.lit("d"), "field_subject": F.lit("")})
    asked = spark.createDataFrame([(7, "word"), (7, "word"), (None, "word"), (8, None)], "q long, text string")
    hits = spark.createDataFrame([(7, 1, 1), (7, None, 2), (None, 1, 1)], "q long, id long, rank int")
    found = [r.context for r in retrieval.retrieval_context(asked, hits, catalog, "q", "text", "id", "", "", "no").where("q = 7").collect()]
    assert found == [
        "1. Title: a\nID: y\nDescription: d\nSubject: N/A\n\n1. Title: b\nID: x\nDescription: d\nSubject: N/A\n\n"] * 2


@pytest.mark.parametrize("name", ["prolific_creators", "graph_expand"])
def test_rules_are_not_computed_in_filters(spark, name):
    """A filter over a computed column must not be moved below the column, where it computes the rules several times a row."""
    from checks import base, serving  # noqa: F401

    catalog = base.museum(spark, "/root/testdata/sf0.001").withColumns({"has_image": F.lit(True), "id": F.col("record_id")})
    query = {"prolific_creators": metrics.prolific_creators, "graph_expand": lambda df: related.graph_expand(df, shape.computed_once(df, ["field_identifier", "field_linked_agent"]))}
    plan = query[name](catalog)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("relators:" in line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter"))


def test_a_small_file_is_dealt_out(spark):
    from checks import base

    assert base.museum(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism


def test_pages_with_repeated_and_missing_ids(spark):
    df = spark.createDataFrame([(i if i % 4 else None, "x") for i in [3, 1, 1, 2, 2, 4, 5, 8, 9, 9]], "id long, title string")
    ids = [None, None, 1, 1, 2, 2, 3, 5, 9, 9]
    for limit, offset in ((3, 0), (4, 1), (5, 3), (2, 8), (5, 9), (5, 20), (0, 0), (1, 0)):
        assert [r.id for r in search.records_page(df, limit, offset).collect()] == ids[offset:offset + limit]
    assert [r.id for r in search.records_page(df, 3, after_id=1).collect()] == [2, 2, 3]
    heavy = df.withColumn("title", F.repeat("title", F.lit(3)))
    plan = search.records_page(heavy, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan  # only the records up to the page are computed


def test_latency_sketches_roll_up(spark):
    from shelfmark.operators import metrics

    requests = spark.range(40_000).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7).alias("ts"),
        F.concat(F.lit("/"), F.col("id") % 2).alias("endpoint"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 10).alias("response_time_ms"),
    )
    exact = {(r.window_start, r.endpoint): r for r in metrics.latency_percentiles(requests).collect()}
    rolled = metrics.rolled_up_percentiles(metrics.latency_sketches(requests)).collect()
    assert {(r.window_start, r.endpoint): r.requests for r in rolled} == {k: r.requests for k, r in exact.items()}
    # the values are uniform over 0 to 10,000, so an error of the rank is one of the value
    for r in rolled:
        e = exact[r.window_start, r.endpoint]
        assert all(abs(r[p] - e[p]) < 10_000 * 0.03 for p in ("p50", "p95", "p99"))
