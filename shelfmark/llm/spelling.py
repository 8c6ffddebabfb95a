"""Spelling variants: words one edit apart, found by permuterm rotations.

A word ``u c v`` with a terminator has the rotation ``v$u c``; without its last character that is ``v$u``,
the prefix that skips the edited ``c``. Among all rotations in sorted order, the prefix range of ``v$u`` holds

- the rotations ``v$u c`` of all words that differ from each other in this one place (replacements), and
- at its head the full rotation ``v$u`` of the word ``u v`` (``c`` deleted, or inserted seen from there).

So the rotations are range-sorted by that prefix and scanned group by group. A group has at most one word
for each character of the alphabet and one more, whatever the corpus holds, and no pair leaves it: each word
takes along how many neighbours it has there and the most frequent one. A character deleted from a run of
equal ones gives the same word at each place of the run; only the first place counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import cut
from shelfmark.operators.merge import lookup_join

LETTER_RUN = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = "$"
SPOILED = 97


def spoiled(run: Column, doc_id: Column, every: int) -> Column:
    """The run, or where ``every`` divides the checksum of id and run, the run less one character."""
    checksum = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (checksum % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(checksum % every == 0, shorter).otherwise(run)


def corpus_words(docs: DataFrame, letters: int = 5, least: int = 3, every: int | None = None) -> DataFrame:
    """``word`` and ``n`` (occurrences) of all runs of Latin letters in ``text``, A-Z in lower case.

    Words of fewer than ``letters`` code points or ``least`` occurrences are left out. ``every`` takes a
    character out of about one run in that many, as a known source of misspellings. Counts merge in each task
    before they are shuffled. A null text has no words; a null id counts as an empty one.
    """
    lower = F.translate("text", UPPER, LOWER)
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit(LETTER_RUN), 0)).alias("run"))
    runs = runs.where(F.length("run") >= letters)
    word = F.col("run") if every is None else spoiled(F.col("run"), F.col("doc_id"), every)
    words = runs.select(word.alias("word")).where(F.length("word") >= letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """``key``, ``word``, ``n``, ``whole`` (the key is a full rotation) and ``first`` (the skipped character does not
    repeat the one before it) for every rotation of every marked word."""
    size = F.length("word")
    twice = F.concat("word", F.lit(MARK), "word", F.lit(MARK))

    def whole(at: Column) -> Column:
        key = F.substring(twice, at + 1, size + 1)
        return F.struct(key.alias("key"), F.lit(True).alias("whole"), F.lit(True).alias("first"))

    def skipping(at: Column) -> Column:
        key = F.substring(twice, at + 1, size)
        first = F.substring("word", at, F.lit(1)) != F.when(at > 1, F.substring("word", at - 1, F.lit(1))).otherwise("")
        return F.struct(key.alias("key"), F.lit(False).alias("whole"), first.alias("first"))

    wholes = F.transform(F.sequence(F.lit(0), size), whole)
    skips = F.transform(F.sequence(F.lit(1), size), skipping)
    return words.select("word", "n", F.inline(F.concat(wholes, skips)))


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (its near word of largest ``n``, ties to the smallest) for each word of
    ``word``, ``n`` that has a near word: one replaced, inserted or deleted code point away."""
    # equal keys come into one slice, so the groups are scanned without another shuffle
    ordered = rotations(words).repartitionByRange("key").sortWithinPartitions("key")
    groups = ordered.groupBy("key").agg(F.collect_list(F.struct("word", "n", "whole", "first")).alias("members"))
    groups = groups.where(F.size("members") > 1)

    def around(one: Column) -> Column:
        def near(other: Column) -> Column:
            replaced = ~one["whole"] & ~other["whole"]
            return (other["word"] != one["word"]) & (replaced | (one["first"] & other["first"]))

        others = F.transform(F.filter("members", near), lambda o: F.struct((-o["n"]).alias("down"), o["word"].alias("word")))
        return F.struct(one["word"].alias("word"), F.size(others).alias("near"), F.array_min(others).alias("best"))

    found = groups.select(F.inline(F.transform("members", around))).where("near > 0")
    best = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return best.select("word", "n_near", F.struct(F.col("best.word").alias("word"), (-F.col("best.down")).alias("n")).alias("best"))


def chain_ends(links: DataFrame) -> DataFrame:
    """``word`` and ``root`` (where its chain of ``form`` ends) for rows ``word``, ``form`` without cycles.

    Every round doubles the reach, so rounds grow with the logarithm of the longest chain.
    """
    ends = cut(links.select("word", F.col("form").alias("root")))
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        stepped = cut(lookup_join(ends, further, ["root"], "left").select("word", "root", "_next"))
        if stepped.where("_next IS NOT NULL").isEmpty():
            return stepped.select("word", "root")
        ends = cut(stepped.select("word", F.coalesce("_next", "root").alias("root")))


def spelling_groups(words: DataFrame, times: int = 2) -> DataFrame:
    """One row per word of ``word`` (distinct, without the mark ``$``) and ``n``: ``word``, ``form``, ``root``, ``n``,
    ``n_near``, ``form_n``.

    ``n_near`` counts the words exactly one inserted, deleted or replaced code point away. ``form`` is the most
    frequent of them (ties: smallest) if it is at least ``times`` as frequent (2 or more, so chains end); ``root`` is
    the last word of the chain of forms, the word itself if it has none. Other columns are not read.
    """
    words = cut(words.select("word", "n"))
    joined = words.join(neighbours(words), "word", "left")
    formed = F.col("best.n") >= F.col("n") * times
    rows = cut(
        joined.select(
            "word",
            F.when(formed, F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best.n")).alias("form_n"),
        )
    )
    ends = chain_ends(rows.where("form IS NOT NULL"))
    out = rows.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
