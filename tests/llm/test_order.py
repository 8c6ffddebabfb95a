"""Permutation, sharding, mixing and token output."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import mixing, permute, sharding, tokens
from shelfmark.llm.queries import END_MARK, RANKS, TOKENIZERS

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 97, 1000, 4097])
def test_permutation_and_its_inverse(n):
    x = np.arange(n, dtype=np.uint64)
    for key in (0, 7):
        places = permute.permute(x, n, key)
        assert sorted(places) == list(range(n))
        assert (permute.unpermute(places.astype(np.uint64), n, key) == x).all()
    if n > 90:
        assert (permute.permute(x, n, 0) != permute.permute(x, n, 1)).any()


def test_shards_are_even_gapless_and_computable(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard_documents(docs, 8, key=3).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(8))
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    for i, r in enumerate(sorted(rows, key=lambda r: r.doc_id)):
        place = int(permute.permute(np.array([i], np.uint64), len(rows), 3)[0])
        assert (r.shard, r.slot) == (place % 8, place // 8)
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]))
    again = sharding.shard_documents(docs.repartition(5), 8, key=3).collect()
    assert sorted(again) == sorted(rows)


def test_sharding_edges(edges, nothing):
    rows = sharding.shard_documents(edges, 3).collect()
    assert Counter(r.shard for r in rows) == {0: 4, 1: 3, 2: 3}
    assert [r.size for r in rows if r.doc_id == 3] == [1]
    assert sharding.shard_documents(nothing, 3).collect() == []
    wide = sharding.shard_rows(edges, [F.col("doc_id")], 2)
    assert wide.count() == 10 and "node" in wide.columns


def shared_targets(sizes, weights=(5, 2, 1), most=3):
    """Water filling as described: share, cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, list(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
        open_ = [s for s in open_ if s not in over]
        left -= sum(out[s] for s in over)
    return out


@pytest.mark.parametrize("sizes", [{"a": 100}, {"a": 1, "b": 100, None: 7}, {"a": 3, "b": 900, "c": 40, "d": 0}])
def test_targets_are_shared_and_capped(spark, sizes):
    words = [(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())]
    rows = mixing.mix(spark.createDataFrame(words, "doc_id long, text string, source string"), keep=("source",)).collect()
    wanted = shared_targets(sizes)
    for r in rows:
        assert math.isclose(r.target, wanted[r.source], abs_tol=1e-6)
        assert r.taken <= 3 * r.size and abs(r.taken - r.target) <= 1


def test_mix_hits_each_budget_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix(docs, keep=("doc_id", "source")).collect()
    assert sorted(rows) == sorted(mixing.mix(docs.repartition(7), keep=("doc_id", "source")).collect())
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert all(0 <= target[s] - taken[s] < 1 for s in target)


def test_mixed_documents_hold_the_words_taken(spark, edges, nothing):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    taken = mixing.mix(docs).agg(F.sum("taken")).first()[0]
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert out.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == taken
    assert out.where(F.length("text") != F.col("n_chars")).count() == 0
    assert mixing.mixed_documents(edges).columns == edges.columns
    assert mixing.mix(edges).count() == 10
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return tokens.Vocabulary.read(f"{TOKENIZERS}/{RANKS}", END_MARK)


def written(path, length, shard_rows):
    import pathlib

    records = {}
    for file in pathlib.Path(path.replace("file:", "")).glob("shard=*/part-*"):
        shard = int(file.parent.name.split("=")[1])
        for i, ids in enumerate(tokens.read_record(file.read_bytes(), length)):
            records[shard * shard_rows + i] = ids
    return records


@pytest.mark.parametrize("length", [16, 512])
def test_shards_hold_every_document(spark, vocabulary, length):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = tokens.materialise(docs, vocabulary, length=length, shard_rows=64, key=5).collect()
    records = written(rows[0].path, length, 64)
    assert sorted(records) == sorted(r.slot for r in rows) == list(range(len(rows)))
    stream = []
    for r in sorted(rows, key=lambda r: r.sequence):
        ids = records[r.slot]
        assert zlib.crc32(ids.astype("<u2").tobytes()) == r.crc32
        assert (r.shard, r.byte_offset) == (r.slot // 64, r.slot % 64 * (2 * length + 1))
        assert (ids[r.n_tokens :] == END_MARK).all()
        stream.extend(ids[: r.n_tokens].tolist())
    encoding, texts, part = vocabulary.encoding(), [], []
    for token in stream:
        if token == END_MARK:
            texts.append(encoding.decode(part))
            part = []
        else:
            part.append(token)
    assert sorted(texts) == sorted(r.text for r in docs.select("text").collect())


def test_token_edges(edges, nothing, vocabulary):
    rows = tokens.materialise(edges, vocabulary, length=64).collect()
    assert {i for r in rows for i in r.doc_ids} == {1, 2, None, 3, 4, 5, 6, 7, 8}
    assert tokens.materialise(nothing, vocabulary).collect() == []


def test_long_runs_of_white_space_are_encoded_in_parts(vocabulary):
    encoding = vocabulary.encoding()
    text = "a" + " " * 50_000 + "b"
    ids = np.frombuffer(tokens.token_bytes(text, encoding.encode_to_numpy), "<u2")
    assert encoding.decode(ids.tolist()) == text


def test_ids_beyond_sixteen_bits(spark, tmp_path):
    wide = tokens.Vocabulary.read(f"{TOKENIZERS}/{RANKS}", 70_000)
    docs = spark.createDataFrame([("a", "one two three"), ("7", None), (None, "four")], "doc_id string, text string")
    rows = tokens.write_shards(docs, wide, str(tmp_path / "out"), length=4).collect()
    assert wide.kind() == "<u4" and {r.byte_offset for r in rows} == {17 * i for i in range(len(rows))}
    data = b"".join(f.read_bytes() for f in (tmp_path / "out").rglob("part-*"))
    ids = tokens.read_record(data, 4, "<u4")
    assert (ids == 70_000).sum() >= 3 and ids.max() == 70_000
    assert {i for r in rows for i in r.doc_ids} == {None, 7}
