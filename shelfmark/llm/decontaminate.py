"""Benchmark decontamination with a positional inverted index.

The index holds a posting (term, document row, position) for every document word that occurs in the
benchmark; other words can never be asked for. It is written once, each part sorted by term, so a
look-up of few terms skips most of the files. A document row without any such word is in it too, as
a head posting with the row's id and word count.

Every window of ten item words is looked up from its rarest term: its postings, moved back by the
term's offset, are possible starts. They are intersected with the moved postings of the second rarest
term, and what is left, as diagonals (position minus offset), with those of all item words. Runs of
ten consecutive words on a diagonal are occurrences of windows. The same look-up with a tolerance in
the offsets gives proximity matches.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import TEXT_WORD, cut, fresh, row_key, small, stored

WINDOW = 10
SLOP = 2
NEAR_WORDS = 8
HEAD = -1


def words_of(text: Column) -> Column:
    """Words with A-Z in lower case; other letters keep their case. Null has none."""
    plain = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.coalesce(F.regexp_extract_all(plain.otherwise(F.lower(text)), F.lit(TEXT_WORD), 0), F.array().cast("array<string>"))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item`` (a number), ``item_id`` and ``words`` of the distinct items that have a word."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0).distinct()
    return cut(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "words"))


def benchmark_terms(items: DataFrame) -> DataFrame:
    terms = items.select(F.explode("words").alias("term")).distinct()
    return cut(terms.select("term", F.monotonically_increasing_id().alias("term_id")))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings ``term_id``, ``row_id``, ``pos``; head postings (``term_id`` -1) with ``doc_id`` and ``n_words``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", words_of(F.col("text")).alias("_words"))
    # the empty word stands before the first and becomes the head posting
    spread = F.posexplode(F.concat(F.array(F.lit("")), "_words")).alias("_pos", "term")
    tokens = rows.select("row_id", "doc_id", F.size("_words").alias("n_words"), spread)
    heads = terms.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(HEAD).cast("long").alias("term_id"))
    found = tokens.join(small(cut(terms.union(heads)), 64), "term")
    head = F.col("term_id") == HEAD
    postings = found.select(
        "term_id",
        "row_id",
        (F.col("_pos") - 1).alias("pos"),
        F.when(head, F.col("doc_id")).alias("doc_id"),
        F.when(head, F.col("n_words")).cast("long").alias("n_words"),
    )
    return stored(postings.sortWithinPartitions("term_id", "row_id", "pos"), "postings")


def item_terms(items: DataFrame, terms: DataFrame, postings: DataFrame) -> DataFrame:
    """``item``, ``k`` (word number), ``term_id``, ``n`` (words of the item) and the term's count in the index."""
    counts = postings.where(F.col("term_id") >= 0).groupBy("term_id").agg(F.count("*").alias("freq"))
    known = terms.join(counts, "term_id", "left").select("term", "term_id", F.coalesce("freq", F.lit(0)).alias("freq"))
    words = items.select("item", F.size("words").alias("n"), F.posexplode("words").alias("k", "term"))
    return cut(words.join(known, "term").select("item", "k", "n", "term_id", "freq"))


def rarest_terms(terms_of: DataFrame) -> DataFrame:
    """Per window (``item``, ``j``): rarest and second rarest term with their word numbers.

    Windows with a term that no document has are left out: they occur nowhere.
    """
    entry = F.struct("k", "freq", "term_id")
    lists = terms_of.groupBy("item", "n").agg(F.array_sort(F.collect_list(entry)).alias("_all"))
    starts = F.sequence(F.lit(0), F.greatest(F.col("n") - WINDOW, F.lit(0)))
    windows = lists.select("item", F.explode(starts).alias("j"), "_all")
    inside = F.transform(F.slice("_all", F.col("j") + 1, F.lit(WINDOW)), lambda x: F.struct(x["freq"], x["k"], x["term_id"]))
    windows = windows.select("item", "j", F.array_sort(inside).alias("_ranked"))
    one = F.element_at("_ranked", 1)
    two = F.element_at("_ranked", F.least(F.size("_ranked"), F.lit(2)))
    return cut(
        windows.where(one["freq"] > 0).select(
            "item", "j", one["term_id"].alias("t1"), one["k"].alias("k1"), two["term_id"].alias("t2"), two["k"].alias("k2")
        )
    )


def diagonals(postings: DataFrame, windows: DataFrame, slop: int) -> DataFrame:
    """``row_id``, ``item``, ``diagonal`` where a window's two rarest terms stand as in the item, give or take ``slop``."""
    real = postings.where(F.col("term_id") >= 0).select("term_id", "row_id", "pos")
    starts = real.join(small(windows.withColumnRenamed("t1", "term_id"), 80), "term_id")
    starts = starts.select("row_id", "item", "t2", "k2", (F.col("pos") - F.col("k1")).alias("diagonal")).distinct()
    shifts = F.explode(F.sequence(F.lit(-slop), F.lit(slop))).alias("_shift")
    wanted = starts.select("*", shifts).withColumn("_at", F.col("diagonal") + F.col("k2") + F.col("_shift"))
    seconds = windows.select(F.col("t2").alias("term_id")).distinct()
    second = real.join(small(cut(seconds), 16), "term_id").select(
        F.col("term_id").alias("t2"), F.col("row_id").alias("_row"), F.col("pos").alias("_at")
    )
    met = wanted.join(second, (wanted.row_id == F.col("_row")) & (wanted.t2 == second.t2) & (wanted["_at"] == second["_at"]))
    return met.select("row_id", "item", "diagonal").distinct()


def matched_words(postings: DataFrame, found: DataFrame, terms_of: DataFrame, slop: int) -> DataFrame:
    """Item words found on the diagonals: ``row_id``, ``item``, ``diagonal``, ``n``, ``k``, ``exact``."""
    shifts = F.explode(F.sequence(F.lit(-slop), F.lit(slop))).alias("_shift")
    wanted = found.join(small(terms_of, 40), "item").select("row_id", "item", "diagonal", "n", "k", "term_id", shifts)
    wanted = cut(wanted.withColumn("pos", F.col("diagonal") + F.col("k") + F.col("_shift")).where("pos >= 0"))
    # only the postings of rows with a diagonal go on, so the join moves little whatever its kind
    held = small(cut(found.select("row_id").distinct()), 16)
    real = postings.where(F.col("term_id") >= 0).select("term_id", "row_id", "pos").join(held, "row_id", "left_semi")
    met = real.join(wanted, ["row_id", "term_id", "pos"])
    return met.groupBy("row_id", "item", "diagonal", "n", "k").agg(F.max(F.col("_shift") == 0).alias("exact"))


def occurrences(words: DataFrame) -> DataFrame:
    """Runs of exact words long enough to hold a window: ``row_id``, ``item``, ``start``, ``end``."""
    line = Window.partitionBy("row_id", "item", "diagonal").orderBy("k")
    islands = words.where("exact").withColumn("_island", F.col("k") - F.row_number().over(line))
    runs = islands.groupBy("row_id", "item", "diagonal", "_island", "n").agg(
        F.min("k").alias("_first"), F.count("*").alias("_length")
    )
    start = F.col("diagonal") + F.col("_first")
    long = F.col("_length") >= F.least(F.col("n"), F.lit(WINDOW))
    return runs.where(long).select("row_id", "item", start.alias("start"), (start + F.col("_length")).alias("end"))


def near_items(words: DataFrame, least: int) -> DataFrame:
    """Proximity matches: ``row_id``, ``item`` where ``least`` words of a window stand near their places."""
    line = Window.partitionBy("row_id", "item", "diagonal").orderBy("k").rangeBetween(1 - WINDOW, 0)
    counted = words.withColumn("_near", F.count("*").over(line))
    enough = F.col("_near") >= F.ceil(F.least(F.col("n"), F.lit(WINDOW)) * F.lit(least) / WINDOW)
    return counted.where(enough).select("row_id", "item").distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, slop: int = SLOP, near_words: int = NEAR_WORDS
) -> DataFrame:
    """One row per document row: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``,
    ``contaminated``, ``n_near_items`` and ``spans`` (hit words as start and end, merged).

    A window is ten consecutive words of an item, or the whole of a shorter one. ``n_hit`` counts the
    document words inside any exact occurrence; ``items`` are those with an occurring window.
    ``n_near_items`` counts items of which ``near_words`` of a window's ten words (in proportion for
    shorter items) stand within ``slop`` places of theirs, the two rarest among them.

    Null and empty texts have no words, in documents and items alike. Repeated documents each get
    their own row; repeated items count once per id. With an empty benchmark nothing is hit. Other
    columns are not read.
    """
    items = benchmark_items(benchmark)
    terms = benchmark_terms(items)
    postings = build_index(docs, terms)
    terms_of = item_terms(items, terms, postings)
    windows = rarest_terms(terms_of)
    found = cut(diagonals(postings, windows, slop))
    words = cut(matched_words(postings, found, terms_of, slop))
    names = items.select("item", "item_id")

    hits = occurrences(words)
    by_start = Window.partitionBy("row_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(by_start), F.lit(-1))
    merged = hits.select("row_id", "start", "end").distinct().withColumn("_reach", reach)
    more = F.greatest(F.col("end") - F.greatest("start", "_reach"), F.lit(0))
    covered = merged.groupBy("row_id").agg(
        F.sum(more).alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")
    )
    named = hits.select("row_id", "item").distinct().join(small(names, 60), "item")
    listed = named.groupBy("row_id").agg(F.array_sort(F.collect_set("item_id")).alias("_items"))
    near = near_items(words, near_words).groupBy("row_id").agg(F.count("*").alias("n_near_items"))

    heads = postings.where(F.col("term_id") == HEAD).select("row_id", "doc_id", "n_words")
    out = heads.join(covered, "row_id", "left").join(listed, "row_id", "left").join(near, "row_id", "left")
    ids = F.coalesce("_items", F.array().cast("array<string>"))
    count = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id",
        "n_words",
        count.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (count > 0).alias("contaminated"),
        F.coalesce("n_near_items", F.lit(0)).alias("n_near_items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no window of the benchmark; columns and repeated rows stay as they are."""
    keyed = docs.select(row_key().alias("doc_id"), "text")
    found = contamination(keyed, benchmark).where("contaminated")
    key = fresh("_row_key", docs)
    found = cut(found.select(F.col("doc_id").alias(key)).distinct())
    kept = docs.withColumn(key, row_key()).join(small(found, 80), key, "left_anti")
    return kept.select(*docs.columns)
