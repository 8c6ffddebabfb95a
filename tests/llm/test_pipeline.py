"""The stages one after another, each against what it should keep, and the registration."""

import __spark_entry__ as entry
import corpus_pipeline
from shelfmark.llm.queries import ORACLES, QUERIES
from test_matching import contaminated_plainly, jaccard_plainly

SF = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns = docs.dtypes
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.dtypes == columns
        after = [r.doc_id for r in docs.collect()]
        assert set(after) <= set(before)
        if name == "near_duplicates":
            assert sorted(after) == sorted(i for i, (head, _) in jaccard_plainly(before).items() if head == i)
        if name == "decontamination":
            assert sorted(after) == sorted(i for i, t in before.items() if contaminated_plainly(t, items)[1] == 0)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))


def test_run_applies_all_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "mixing", "training_order"]


def test_every_query_is_registered():
    registered = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered) and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
