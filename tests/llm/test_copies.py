"""Exact deduplication, spelling variants and hard negatives against brute force."""

import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import exact, negatives, spelling
from shelfmark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def as_sets(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_exact_dedup"])
def test_queries_match_their_twins(spark, name):
    oracle = duckdb.connect()
    for table in ("documents", "embeddings"):
        oracle.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = oracle.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert as_sets(df.select(*names).collect()) == as_sets(found.fetchall())


# exact deduplication


def write(folder, name, ids, texts):
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "digest": pa.array([1] * len(ids))})
    pq.write_table(table, f"{folder}/{name}.parquet")


def decided(rows):
    """(keep_id, group_size, kept rows) by text."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    largest = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, largest[t or ""], len(groups[t or ""])) for i, t in rows), key=str)


def short(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size) for r in df.collect()), key=str)


BATCHES = [
    ([1, 2, None, 4, 4], ["a", "b", "a", None, None]),
    ([9, 3, 5, 5], ["a", "", "İ\U0001f600", "long " * 50_000]),
    ([None, 7], ["only without an id", "long " * 50_000]),
]


def weak(text):
    """A digest of four values, so that different texts share one."""
    return F.unhex(F.hex(F.crc32(text.cast("binary")) % 4))


@pytest.mark.parametrize("digest", [exact.sha256, weak])
def test_stream_goes_on_after_a_restart(spark, tmp_path, digest):
    source, folder = tmp_path / "docs", str(tmp_path / "state")
    source.mkdir()
    seen = []
    for number, (ids, texts) in enumerate(BATCHES):
        write(source, f"part{number}", ids, texts)
        seen += list(zip(ids, texts))
        df = exact.dedup_files(spark, str(source), folder, digest=digest, batch_bytes=1)
        assert short(df) == decided(seen)
        rows = df.collect()
        texts_of = Counter(t or "" for _, t in seen)
        assert Counter(r.text_sha256 for r in rows if r.kept) == dict.fromkeys({r.text_sha256 for r in rows}, 1)
        assert len({r.text_sha256 for r in rows}) == len(texts_of)
        assert all(r.keep_id == r.doc_id for r in rows if r.kept)
    # nothing new: the state and the answer stay
    assert short(exact.dedup_files(spark, str(source), folder, digest=digest)) == decided(seen)


def test_stream_over_no_rows(spark, tmp_path):
    write(tmp_path, "none", [], [])
    assert exact.dedup_files(spark, str(tmp_path), str(tmp_path / "_state")).count() == 0


def test_open_stores_reserve_no_disk(spark, tmp_path):
    """RocksDB reserves 4 MB for the manifest of each open store unless told not to."""
    source = tmp_path / "documents.parquet"
    source.mkdir()
    write(source, "a", range(50), [f"text {i}" for i in range(50)])
    local = spark.sparkContext._jvm.org.apache.spark.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().conf())
    before = set(Path(local).rglob("MANIFEST-*"))
    exact.absorb(spark, str(source), str(tmp_path / "state"))
    held = [p.stat().st_blocks * 512 for p in Path(local).rglob("MANIFEST-*") if p not in before]
    assert max(held, default=0) < 1 << 20


def test_bitmap_keeps_every_hit(spark):
    rows = spark.range(20_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), "id")
    wanted = rows.where("id % 3 = 0")
    found = {r.id for r in exact.possible_hits(rows, wanted.select("digest")).collect()}
    assert set(range(0, 20_000, 3)) <= found
    assert len(found) < 6_667 + 20


# spelling


def near(one, two):
    if len(one) > len(two):
        one, two = two, one
    if len(one) == len(two):
        return sum(a != b for a, b in zip(one, two)) == 1
    return len(one) + 1 == len(two) and any(two[:i] + two[i + 1 :] == one for i in range(len(two)))


def one_edit(word, alphabet):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in alphabet}
    return (out | {a + c + b for a, b in cuts for c in alphabet}) - {word}


def grouped(counts):
    alphabet = {c for w in counts for c in w}
    forms, rows = {}, []
    for word, n in counts.items():
        around = [w for w in one_edit(word, alphabet) if w in counts]
        best = min(around, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        forms[word] = form
        rows.append((word, form, n, len(around), counts[form] if form else None))
    out = []
    for word, form, n, around, form_n in rows:
        root = word
        while forms[root]:
            root = forms[root]
        out.append((word, form, root, n, around, form_n))
    return sorted(out, key=str)


def words_of(docs):
    counts = Counter()
    for doc_id, text in docs:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def test_spelling_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    counts = words_of(docs)
    found = sorted((tuple(r) for r in QUERIES["op11_spelling"](spark, SF).collect()), key=str)
    assert len(found) > 500
    assert found == grouped(counts)


def test_spelling_of_repeated_letters_ties_and_chains(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 8))): rng.choice([3, 4, 8, 20, 50]) for _ in range(400)}
    words |= {"aaaaa": 1, "aaaaaa": 2, "aaaaaaa": 4, "aaaaaaaa": 8, "baaaa": 2}
    table = spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n long, key string")
    assert sorted((tuple(r) for r in spelling.spelling_groups(table).collect()), key=str) == grouped(words)
    for one in list(words)[:60]:
        assert all(near(one, two) == (two in one_edit(one, "abé")) for two in words if two != one)


def test_spelling_edges(spark, edges, nothing):
    assert spelling.spelling_groups(spelling.corpus_words(nothing)).count() == 0
    counts = words_of([(r.doc_id, r.text) for r in edges.collect()])
    found = spelling.spelling_groups(spelling.corpus_words(edges, every=spelling.SPOILED))
    assert sorted((tuple(r) for r in found.collect()), key=str) == grouped(counts)


# hard negatives


def mined(rows, positives=5, negatives=3, low=50, high=95):
    def good(r):
        return r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])

    clamp = lambda x: max(-(1 << 63) + 1, min((1 << 63) - 1, x))
    whole = [(r[0], [clamp(math.floor(256 * x)) for x in r[1]], r[2], r[3]) for r in rows if good(r)]
    out = []
    for i, a in enumerate(whole):
        if not a[3]:
            continue
        scored = [(clamp(sum(x * y for x, y in zip(a[1], b[1]))), b) for j, b in enumerate(whole) if j != i]
        scored.sort(key=lambda s: (-s[0], s[1][0] is None, s[1][0] or 0))
        for p, b in [s for s in scored if s[1][2] == a[2]][:positives]:
            inside = [s for s in scored if s[1][2] != a[2] and low * p <= 100 * s[0] <= high * p][:negatives]
            out += [(a[0], b[0], k + 1, n[0], p, s) for k, (s, n) in enumerate(inside)]
    return sorted(out, key=str)


VECTORS = "id long, vector array<double>, label int, is_anchor boolean, row string, slot int, anchor int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VECTORS)


def test_negatives_equal_brute_force_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 40)
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    monkeypatch.setattr(negatives, "AT_ONCE", 3)
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.5, 1.0, rng.random()]) for _ in range(6)], rng.randint(0, 3), i % 9 == 0) for i in range(300)]
    rows += [(300 + i, [1.0, 0.5, 0.25, 0.25, 0.5, 1.0], i % 2, i < 20) for i in range(60)]  # one vector, many rows
    found = negatives.hard_negatives(table(spark, rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == mined(rows)


def test_negatives_edges(spark):
    rows = [
        (1, [1.0, 1.0], 0, True), (1, [1.0, 1.0], 0, True), (2, [1.0, 0.5], 0, None), (3, [0.9], 1, False), (None, [0.9, 0.5], 1, True),
        (4, None, 1, True), (5, [1.0, None], 1, True), (6, [float("nan")], 0, True), (7, [float("inf"), 1.0], 1, False),
        (8, [1.0, 1.0], None, True), (9, [], 0, True), (10, [-1.0, -1.0], 0, True), (11, [1e30, 1.0], 1, True), (12, [0.7, 0.6], 1, False),
        (13, [1e15, 2e15], 0, True), (14, [5e14, 1e14], 1, False),
    ]
    found = negatives.hard_negatives(table(spark, rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == mined(rows)
    assert negatives.hard_negatives(table(spark, rows).where("id = 99")).count() == 0
    assert negatives.hard_negatives(table(spark, rows).where("not is_anchor")).count() == 0
