"""N-gram Jaccard join: MinHash bands propose candidates, full n-gram sets decide.

1. Every text becomes a set of hashed word n-grams; texts with equal sets form one class and go on
   as one row. Band hashes come from MinHash; bands and rows follow from the wanted recall.
2. Classes are shuffled on their band hashes. Members of a bucket are tied to its smallest member, and
   the connected classes form a candidate group. Only ids and hashes move here.
3. The texts of candidate groups are fetched once. A large group is split into blocks, and pairs of
   blocks are compared in tasks of bounded size, on the full n-gram sets. A task returns one row per
   class: its links, and its part of the group's spanning forest. Pairs are never emitted.
4. Link counts are added up; the forests give the final groups.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import TEXT_WORD, cut, fresh, row_key, small, stored
from shelfmark.llm.graph import components
from shelfmark.operators.merge import lookup_join

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.995
MOST_HASHES = 192
BLOCK = 512
CHUNK = 1024
COLUMNS = 4096

_WORD = re.compile(TEXT_WORD)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def banding(similarity: float, recall: float, most: int) -> tuple[int, int]:
    """Bands and rows per band: the longest bands that reach ``recall`` at ``similarity``.

    A pair of that similarity shares a band with probability 1 - (1 - s^rows)^bands. If ``most`` hashes
    cannot reach the recall, that is an error, which names the recall they reach.
    """
    if similarity < 1 and 1 - (1 - similarity) ** most < recall:
        raise ValueError(f"{most} hashes find {1 - (1 - similarity) ** most:.3f} of the pairs at {similarity}, not {recall}")
    best = (most, 1)
    for rows in range(1, most + 1):
        hit = similarity**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if rows * bands > most:
            break
        best = (bands, rows)
    return best


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= 400_000:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def shingles(text: str, words: int, hashes: _WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams; a shorter text is one n-gram of all its words."""
    found = _WORD.findall(text.lower())
    if not found:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    n = max(1, len(found) - words + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(words, len(found))):
        out = (out ^ (out >> np.uint64(32))) * _ODD + each[k : k + n]
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ (out >> np.uint64(32)))


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of the MinHash signature."""
    random = np.random.default_rng(20_240_601)
    factor = (random.integers(0, 1 << 32, bands * rows, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    shift = random.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32)
    values = (grams >> np.uint64(32)).astype(np.uint32)
    least = np.full(bands * rows, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(values), CHUNK):
        part = values[i : i + CHUNK, None] * factor
        part += shift
        np.minimum(least, part.min(axis=0), out=least)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for column in least.reshape(bands, rows).T.astype(np.uint64):
        out = (out ^ (out >> np.uint64(31))) * _ODD + column
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def signed(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """``row_key``, ``doc_id``, the class key (null without words) and the band hashes of every row."""

    @F.pandas_udf("set_key string, bands array<long>")
    def sign(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for s in series:
            keys, found = [], []
            for t in s:
                grams = shingles(t or "", words, hashes)
                keys.append(xxhash.xxh3_128_hexdigest(grams.tobytes()) if len(grams) else None)
                found.append(band_hashes(grams, bands, rows) if len(grams) else None)
            yield pd.DataFrame({"set_key": keys, "bands": found})

    made = docs.select(row_key().alias("row_key"), "doc_id", sign("text").alias("_made"))
    return made.select("row_key", "doc_id", "_made.set_key", "_made.bands")


def candidate_groups(classes: DataFrame) -> DataFrame:
    """``node`` and ``group`` for the classes that share a band hash with another, directly or by a chain."""
    posted = classes.select("node", F.posexplode("bands").alias("_band", "_hash"))
    posted = posted.select("node", F.xxhash64("_band", "_hash").alias("bucket"))
    buckets = posted.groupBy("bucket").agg(F.min("node").alias("first"), F.count("*").alias("_n"))
    buckets = buckets.where("_n > 1").select("bucket", "first")
    ties = lookup_join(posted, buckets, ["bucket"]).where("node <> first")
    return components(ties.select(F.col("node").alias("a"), F.col("first").alias("b")))


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of the other."""
    both = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right)]
    common = np.intersect1d(*[np.unique(x) for x in both])
    sides = []
    for sets, every in zip((left, right), both, strict=True):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(common, every), max(len(common) - 1, 0))
        hit = common[at] == every if len(common) else np.zeros(len(every), bool)
        order = np.argsort(at[hit], kind="stable")
        sides.append((at[hit][order], row[hit][order], len(sets)))
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(common), COLUMNS):
        parts = []
        for column, row, n in sides:
            a, b = np.searchsorted(column, [lo, lo + COLUMNS])
            dense = np.zeros((n, min(COLUMNS, len(common) - lo)), np.float32)
            dense[row[a:b], column[a:b] - lo] = 1
            parts.append(dense)
        out += parts[0] @ parts[1].T
    return out


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component; ``linked`` is a symmetric boolean matrix."""
    root = np.arange(len(linked))
    while True:
        lowest = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1, initial=len(root)))
        lowest = lowest[lowest]
        if (lowest == root).all():
            return root
        root = lowest


def compare_blocks(pdf: pd.DataFrame, words: int, similarity: float) -> pd.DataFrame:
    """Links between the classes of two blocks (or inside one), and a spanning forest of them."""
    pdf = pdf.sort_values("node", ignore_index=True)
    hashes = _WordHashes()
    sets = [shingles(t or "", words, hashes) for t in pdf["text"]]
    sizes = np.array([len(s) for s in sets])
    node, copies, block = (pdf[c].to_numpy(np.int64) for c in ("node", "copies", "block"))
    first, last = int(pdf["low"].iloc[0]), int(pdf["high"].iloc[0])
    one, two = np.flatnonzero(block == first), np.flatnonzero(block == last)
    shared = _intersections([sets[i] for i in one], [sets[i] for i in two])
    near = shared >= similarity * (sizes[one][:, None] + sizes[two][None, :] - shared) - 1e-6
    linked = np.zeros((len(node), len(node)), bool)
    linked[np.ix_(one, two)] = near
    linked |= linked.T
    np.fill_diagonal(linked, False)
    return pd.DataFrame(
        {
            "node": node,
            "links": linked.sum(axis=1),
            "linked_documents": linked @ copies,
            "root": node[_roots(linked)] if len(node) else node,
        }
    )


def links(docs: DataFrame, classes: DataFrame, words: int, similarity: float) -> DataFrame:
    """Per class with a candidate: ``links``, ``linked_documents`` and its ``group`` by verified links."""
    groups = candidate_groups(classes)
    sizes = groups.groupBy("component").agg(F.count("*").alias("_size"))
    wanted = lookup_join(groups, sizes, ["component"]).select(
        "node", "component", F.ceil(F.col("_size") / BLOCK).cast("int").alias("_blocks")
    )
    wanted = lookup_join(classes.select("node", "row_key", "copies"), wanted, ["node"])
    wanted = cut(wanted.withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")))
    texts = docs.select(row_key().alias("row_key"), "text").join(small(wanted, 100), "row_key")
    # rows alike in id and text give the same set: one of them is enough, and tasks merge theirs first
    texts = texts.groupBy("node", "component", "copies", "block", "_blocks").agg(F.any_value("text").alias("text"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    paired = texts.select("*", other).select(
        "component",
        F.least("block", "_other").alias("low"),
        F.greatest("block", "_other").alias("high"),
        "node",
        "copies",
        "block",
        "text",
    )
    once = paired.groupBy("component", "low", "high")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        return compare_blocks(pdf, words, similarity)

    found = cut(once.applyInPandas(compare, "node long, links long, linked_documents long, root long"))
    forest = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("linked_documents").alias("linked_documents"))
    return counts.where("links > 0").join(forest.withColumnRenamed("component", "group"), "node")


def jaccard_join(
    docs: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    most_hashes: int = MOST_HASHES,
) -> DataFrame:
    """One row per document: ``row_key``, ``doc_id``, ``class_id``, ``n_copies``, ``n_text_links``, ``n_links``.

    ``class_id``: the smallest id of the documents tied to it by links of Jaccard similarity
    ``similarity`` or more on sets of ``words``-word n-grams (words as in ``TEXT_WORD``, lower case).
    ``n_copies``: other documents with the same set; ``n_text_links``: different sets it is linked to;
    ``n_links``: all documents it is linked to, copies included.

    A text of fewer words is one n-gram. A text without words (null, empty, punctuation) is linked
    to nothing and is a class of its own. Repeated rows are copies of each other. Other columns are
    not read. A document without an id counts in its class; the class id is null only if no member
    has one.
    """
    bands, rows = banding(similarity, recall, most_hashes)
    signs = stored(signed(docs, words, bands, rows), "signs")
    classes = signs.where("set_key IS NOT NULL").groupBy("set_key")
    classes = classes.agg(
        F.min("doc_id").alias("first_id"),
        F.min("row_key").alias("row_key"),
        F.count("*").alias("copies"),
        F.any_value("bands").alias("bands"),
    )
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()))
    found = links(docs.select("doc_id", "text"), classes, words, similarity)
    narrow = classes.select("node", "set_key", "first_id", "copies")
    joined = cut(lookup_join(narrow, found, ["node"], "left"))
    heads = joined.where("group IS NOT NULL").groupBy("group").agg(F.min("first_id").alias("_head"))
    named = lookup_join(joined, heads, ["group"], "left").select(
        F.col("set_key"),
        F.coalesce("_head", "first_id").alias("class_id"),
        (F.col("copies") - 1).alias("n_copies"),
        F.coalesce("links", F.lit(0)).alias("n_text_links"),
        (F.coalesce("linked_documents", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    ids = signs.select("row_key", "doc_id", F.coalesce("set_key", F.lit("")).alias("set_key"))
    out = lookup_join(ids, named, ["set_key"], "left")
    return out.select(
        "row_key",
        "doc_id",
        F.when(F.col("set_key") == "", F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_copies", "n_text_links", "n_links")],
        (F.col("set_key") != "").alias("has_words"),
    )


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """The documents of which each class keeps one: the first by id (null last), then by content.

    Texts without words are all kept. Of rows alike in id and text one stays. All columns are kept.
    """
    rows = jaccard_join(docs, **options)
    order = Window.partitionBy("class_id", "_odd").orderBy(F.col("doc_id").asc_nulls_last(), "row_key")
    # classes without any id are told apart by content
    odd = F.when(F.col("class_id").isNull(), F.col("row_key")).alias("_odd")
    worded = rows.where("has_words").select("class_id", "doc_id", "row_key", odd)
    # Spark keeps one row per class and task before it shuffles
    first = worded.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("row_key").distinct()
    again = rows.where("has_words").groupBy("row_key").agg(F.count("*").alias("_n")).where("_n > 1").select("row_key")
    dropped = lookup_join(rows.where("has_words").select("row_key").distinct(), first, ["row_key"], "left_anti")
    key, number = fresh("_row_key", docs), fresh("_number", docs)
    keys = docs.withColumn(key, row_key())
    # few rows leave, so those that stay need no shuffle
    gone = cut(dropped.union(again).distinct().withColumnRenamed("row_key", key))
    kept = keys.join(small(gone, 80), key, "left_anti")
    # of rows alike in id and text the first stays
    alike = cut(again.join(first, "row_key", "left_semi").withColumnRenamed("row_key", key))
    same = Window.partitionBy(key).orderBy(F.lit(1))
    one = keys.join(small(alike, 80), key, "left_semi").withColumn(number, F.row_number().over(same)).where(F.col(number) == 1)
    kept = kept.select(*docs.columns).unionByName(one.select(*docs.columns))
    # the join looks for words in lower case: a text of capitals only has some
    found = F.regexp_instr(F.lower("text"), F.lit(TEXT_WORD))
    wordless = F.coalesce(found, F.lit(0)) == 0
    return kept.where(~wordless).unionByName(docs.where(wordless))
