"""Keyword retrieval: the best catalogue records for each of many questions.

A keyword counts where it occurs anywhere in a field, so questions and records share no join key. Keywords hold
no white space, so each occurrence lies inside one word of the field:

1. The different words of the catalogue are matched to the different keywords by their parts (substrings), an equality
   join; words too long for that are indexed by their three-letter grams, and ``contains`` verifies what comes back.
2. Nearly every question meets nearly every record, so their pairs are never written. Records are dealt out in blocks,
   and every block is sent its words with their keywords, its records with their words, and the questions' keywords.
3. A task holds one block's points, a byte for each frequent keyword and record, adds the rows of a question's keywords
   (one for each keyword, not a product with all of them), and gives back the best n records of its block; a ranked
   window keeps the best n of all. A keyword counts once per field.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.fixed import RETRIEVAL_WEIGHTS, STOP_WORDS, WHITE_SPACE_CLASS
from shelfmark.operators.merge import lookup_join, possible
from shelfmark.session import cut_lineage

GRAM = 3
LONG_WORD = 24  # letters of the longest word that is cut into all its parts
BROADCAST_ROWS = 1_000_000  # keywords that are sent to every task, 48 MB about
BLOCK_RECORDS, BLOCK_CHARS = 8192, 32 << 20  # of a block of records, about
RUN = 1024  # questions looked up at once
RARE = 16  # postings in a block up to which a keyword gets no row of its own
DENSE_BYTES = 64 << 20  # of these rows
ROWS = 64  # rows added at once
POSTINGS = 1 << 18  # postings whose keywords are looked up at once
CONTEXT_QUESTIONS = 1024  # questions that share one copy of their records' texts, about
CONTEXT_BYTES = 8 << 20  # of contexts that leave a task at once, about


def _words(text: Column) -> Column:
    return F.split(F.lower(text), f"[{WHITE_SPACE_CLASS}]+")


def keywords_of(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Lower-case words longer than two letters that are not stop words (repeats stay)."""
    return F.filter(_words(text), lambda w: (F.length(w) >= GRAM) & ~w.isin(list(stop_words)))


def grams_of(word: Column) -> Column:
    """The different three-letter grams of a word of three letters or more."""
    starts = F.sequence(F.lit(1), F.length(word) - GRAM + 1)
    return F.array_distinct(F.transform(starts, lambda i: F.substring(word, i, F.lit(GRAM))))


def parts_of(words: DataFrame) -> DataFrame:
    """(``word``, ``start``, ``keyword``): every substring of three letters or more."""
    rests = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word") - GRAM + 1)).alias("start"))
    rests = rests.select("*", F.explode(F.sequence(F.lit(GRAM), F.length("word") - F.col("start") + 1)).alias("_n"))
    return rests.select("word", "start", F.substring("word", F.col("start"), F.col("_n")).alias("keyword"))


def words_containing(keywords: DataFrame, words: DataFrame) -> DataFrame:
    """``word`` (distinct) and ``keywords``, the numbers of the keywords (``keyword`` distinct, three letters or more, and
    ``number``) that it contains, if any.

    Words of up to ``LONG_WORD`` letters give their parts, so that the work grows with the words and not with words times
    keywords. Longer ones are few; each keyword is looked up among them by its rarest gram.
    """
    parts = parts_of(words.where(F.length("word").between(GRAM, LONG_WORD))).withColumnRenamed("keyword", "part")
    parts = parts.withColumn("key", F.xxhash64("part"))
    asked = keywords.withColumn("key", F.xxhash64("keyword"))
    if keywords.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        asked = F.broadcast(asked)
    else:
        parts, asked = possible(parts, "key", asked), asked.hint("merge")
    # a part that a word has twice counts where it is first
    met = parts.join(asked, "key").where("part = keyword AND locate(keyword, word) = start")
    long = lookup_join(_long_words_containing(keywords.select("keyword"), words.where(F.length("word") > LONG_WORD)), keywords, ["keyword"])
    # no more than a word has parts
    found = [m.groupBy("word").agg(F.collect_list("number").alias("keywords")) for m in (met, long)]
    return found[0].unionByName(found[1])


def _long_words_containing(keywords: DataFrame, words: DataFrame) -> DataFrame:
    index = words.select("word", F.explode(grams_of(F.col("word"))).alias("gram"))
    counts = index.groupBy("gram").agg(F.count("*").alias("held"))
    # a gram that no word has rules its keyword out
    asked = keywords.select("keyword", F.explode(grams_of(F.col("keyword"))).alias("gram"))
    known = asked.join(counts, "gram", "left").groupBy("keyword")
    rarest = known.agg(F.min_by("gram", F.struct(F.coalesce("held", F.lit(0)), "gram")).alias("gram"))
    met = lookup_join(index, rarest, ["gram"])
    return met.where(F.col("word").contains(F.col("keyword"))).select("keyword", "word")


def _blocks(batches: Iterator[pa.RecordBatch], kinds: int) -> Iterator[list[Iterator[pa.RecordBatch]]]:
    """Rows sorted by ``block`` and ``kind`` -> for every block its rows of kind 0, of kind 1 and so on, as they come."""

    def pieces():
        for batch in batches:
            if batch.num_rows:
                marks = batch.column("block").to_numpy().astype(np.int64) * kinds + batch.column("kind").to_numpy()
                edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
                for low, high in zip(edges, edges[1:]):
                    yield int(marks[low]), batch.slice(low, high - low)

    source = pieces()
    ahead = next(source, None)

    def rows(mark: int) -> Iterator[pa.RecordBatch]:
        nonlocal ahead
        while ahead is not None and ahead[0] == mark:
            piece, ahead = ahead[1], next(source, None)
            yield piece

    while ahead is not None:
        block = ahead[0] // kinds
        found = [rows(kinds * block + kind) for kind in range(kinds)]
        yield found
        for _ in chain(*found):
            pass


def _by_block(tables: Sequence[DataFrame], blocks: int, work: Callable, schema: str) -> DataFrame:
    """``work`` over the tables' rows of every ``block``; it gets those of the first, then those of the second and so on, as batches."""
    kinds = len(tables)
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.withColumn("kind", F.lit(i)) for i, t in enumerate(tables)])
    # a null list costs Arrow's writer a pass over all nulls before it, an empty one nothing
    lists = {c: F.array().cast(kind) for c, kind in both.dtypes if kind.startswith("array")}
    both = both.withColumns({c: F.coalesce(c, empty) for c, empty in lists.items()})
    # two partitions at least: a single one would count as the partitioning of whatever window comes after
    dealt = both.repartitionById(max(blocks, 2), F.col("block")).sortWithinPartitions("block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _blocks(batches, kinds):
            yield from work(*found)

    return dealt.mapInArrow(run, schema)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a list column without nulls."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of several runs, one run after another."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


class _Points:
    """What each keyword gives each record of one block: rows of a matrix for frequent keywords, lists for the rest."""

    def __init__(self, words: Iterator[pa.RecordBatch], fields: Iterator[pa.RecordBatch], weights: Sequence[int]):
        names, sizes, numbers = [], [], []
        for batch in words:
            lengths, values = _lists(batch.column("keywords"))
            names.append(batch.column("word"))
            sizes.append(lengths)
            numbers.append(values)
        held = list(fields)
        self.records = None
        if not names or not held:
            return
        # equal points go to the smaller key, so records are held in the order of their keys
        column = pa.chunked_array([batch.column("record") for batch in held])
        self.records = pc.unique(column)
        self.records = self.records.take(pc.sort_indices(self.records, null_placement="at_start"))
        self.n = len(self.records)
        known = pa.chunked_array(names).combine_chunks()
        sizes = np.concatenate(sizes)
        self.keywords, codes = np.unique(np.concatenate(numbers), return_inverse=True)

        postings = []  # by field: word, record
        for batch in held:
            places = pc.index_in(batch.column("record"), value_set=self.records).to_numpy(zero_copy_only=False)
            bits = batch.column("fields").to_numpy()
            column = batch.column("words")
            lengths = np.diff(column.offsets.to_numpy())
            at = pc.index_in(column.flatten(), value_set=known).fill_null(-1).to_numpy()
            bits, places = np.repeat(bits, lengths), np.repeat(places, lengths)
            postings += [(bit, at[chosen], places[chosen]) for bit in np.unique(bits) if (chosen := (bits == bit) & (at >= 0)).any()]
        del held
        stands = sum((np.bincount(at, minlength=len(sizes)) for _, at, _ in postings), np.zeros(len(sizes), dtype=np.int64))
        counts = np.bincount(codes, weights=np.repeat(stands, sizes), minlength=len(self.keywords))
        frequent = np.flatnonzero(counts > RARE)
        frequent = frequent[np.argsort(-counts[frequent], kind="stable")][: max(DENSE_BYTES // self.n, 1)]
        self.row = np.full(len(self.keywords), -1)
        self.row[frequent] = np.arange(len(frequent))

        # a field counts once, however many of its words have the keyword
        table = np.array([sum(w for i, w in enumerate(weights) if b >> i & 1) for b in range(1 << len(weights))])
        table = table.astype(np.min_scalar_type(int(table.max())))
        matrix = np.zeros(len(frequent) * self.n, dtype=np.min_scalar_type(len(table) - 1))
        word = np.repeat(np.arange(len(sizes)), sizes)
        row = self.row[codes]
        dense, rare = (self._runs(word[chosen], len(sizes)) for chosen in (row >= 0, row < 0))
        rows, codes = row[row >= 0], codes[row < 0]
        entries, marks = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=matrix.dtype)]
        for bit, at, place in postings:
            for low in range(0, len(at), POSTINGS):
                some, here = at[low : low + POSTINGS], place[low : low + POSTINGS].astype(np.int64)
                found = rows[_spread(dense[0][some], dense[1][some])] * self.n + np.repeat(here, dense[1][some])
                matrix[found] |= matrix.dtype.type(bit)
                found = codes[_spread(rare[0][some], rare[1][some])] * self.n + np.repeat(here, rare[1][some])
                entries.append(found)
                marks.append(np.full(len(found), bit, dtype=matrix.dtype))
        self.matrix = table[matrix].reshape(len(frequent), self.n)

        entry = np.concatenate(entries)
        order = np.argsort(entry, kind="stable")
        entry = entry[order]
        first = np.flatnonzero(np.diff(entry, prepend=-1))
        bits = np.bitwise_or.reduceat(np.concatenate(marks)[order], first) if len(first) else np.zeros(0, dtype=matrix.dtype)
        code, self.place = np.divmod(entry[first], self.n)
        self.points = table[bits]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(self.keywords)))])
        self.most = np.zeros(len(self.keywords), dtype=np.int64)
        np.maximum.at(self.most, code, self.points)
        self.most[frequent] = self.matrix.max(axis=1)
        self.rows = np.empty((ROWS, self.n), dtype=self.matrix.dtype)

    @staticmethod
    def _runs(word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the runs of every word in a sorted array."""
        lengths = np.bincount(word, minlength=n)
        return np.cumsum(lengths) - lengths, lengths

    def best(self, lengths: np.ndarray, keyword: np.ndarray, times: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of every question with a score above 0: its number, and the places and scores of its n best records."""
        at = np.minimum(np.searchsorted(self.keywords, keyword), len(self.keywords) - 1)
        known = self.keywords[at] == keyword
        question = np.repeat(np.arange(len(lengths)), lengths)[known]
        at, times = at[known], times[known]
        ends = np.searchsorted(question, np.arange(len(lengths) + 1))
        most = np.concatenate([[0], np.cumsum(times * self.most[at])])
        most = most[ends[1:]] - most[ends[:-1]]
        row = self.row[at]
        for q in np.flatnonzero(most):
            low, high = ends[q], ends[q + 1]
            kind = np.min_scalar_type(int(most[q]))
            scores = self._scores(at[low:high], row[low:high], times[low:high], kind)
            found = _best(scores, n)
            yield q, found, scores[found].astype(np.int64)

    def _scores(self, at: np.ndarray, row: np.ndarray, times: np.ndarray, kind: np.dtype) -> np.ndarray:
        """Points of all records for one question; ``kind`` holds every sum."""
        single = row[(row >= 0) & (times == 1)]
        scores = np.zeros(self.n, dtype=kind)
        for low in range(0, len(single), ROWS):
            some = single[low : low + ROWS]
            rows = self.matrix.take(some, axis=0, out=self.rows[: len(some)], mode="clip")
            scores += np.add.reduce(rows, axis=0, dtype=kind)
        for k in np.flatnonzero((row >= 0) & (times > 1)):
            scores += self.matrix[row[k]].astype(kind) * kind.type(times[k])
        for k in np.flatnonzero(row < 0):
            low, high = self.starts[at[k]], self.starts[at[k] + 1]
            scores[self.place[low:high]] += self.points[low:high].astype(kind) * kind.type(times[k])
        return scores


def _best(scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores above 0; of equal ones, the first."""
    n = min(n, len(scores))
    limit = int(scores.max())
    # the n-th score is mostly a few points below the first
    for _ in range(16):
        if limit <= 1 or np.count_nonzero(scores >= limit) >= n:
            break
        limit -= 1
    else:
        limit = max(int(np.partition(scores, len(scores) - n)[len(scores) - n]), 1)
    found = np.flatnonzero(scores >= max(limit, 1))
    above = scores[found] > limit
    return np.concatenate([found[above], found[~above][: n - np.count_nonzero(above)]])


def _best_of_block(n: int, weights: Sequence[int]) -> Callable:
    def work(words: Iterator[pa.RecordBatch], fields: Iterator[pa.RecordBatch], asked: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Points(words, fields, weights)
        if block.records is None:
            return
        for batch in asked:
            for low in range(0, batch.num_rows, RUN):
                run = batch.slice(low, RUN)
                lengths, keyword = _lists(run.column("keywords"))
                _, times = _lists(run.column("times"))
                best = list(block.best(lengths, keyword, times, n))
                if best:
                    row = np.repeat([q for q, _, _ in best], [len(places) for _, places, _ in best])
                    column = np.concatenate([places for _, places, _ in best])
                    values = [run.column("question").take(pa.array(row)), block.records.take(pa.array(column))]
                    values.append(pa.array(np.concatenate([scores for _, _, scores in best])))
                    yield pa.RecordBatch.from_arrays(values, names=["question", "record", "score"])

    return work


def retrieve(
    questions: DataFrame,
    catalog: DataFrame,
    question_id: str,
    question: str,
    key: str,
    n: int = 5,
    weights: Mapping[str, int] = RETRIEVAL_WEIGHTS,
) -> DataFrame:
    """(``question_id``, ``key``, ``score``, ``rank``): the best n records with a score above 0.

    A field gives its weight once for every keyword of the question that it contains, repeats counted. ``question_id``
    must be an integer column; ties go to the smaller key. Equal ids are one question, equal keys one record.
    """
    asked = questions.select(F.col(question_id).cast("bigint").alias("question"), F.explode(keywords_of(F.col(question))).alias("keyword"))
    asked = cut_lineage(asked.groupBy("question", "keyword").agg(F.count("*").alias("times")))
    # keywords go by number from here on; the checkpoint keeps the numbers
    keywords = cut_lineage(asked.select("keyword").distinct().withColumn("number", F.monotonically_increasing_id()))

    size = catalog.agg(F.count("*"), *[F.coalesce(F.sum(F.length(f)), F.lit(0)) for f in weights]).first()
    blocks = 1 + max(size[0] // BLOCK_RECORDS, sum(size[1:]) // BLOCK_CHARS)
    texts = F.array(*[F.struct(F.lit(1 << i).alias("fields"), F.array_distinct(_words(F.col(f))).alias("words")) for i, f in enumerate(weights)])
    fields = catalog.select(F.col(key).alias("record"), F.inline(texts)).where("words IS NOT NULL")
    fields = fields.withColumn("block", F.pmod(F.xxhash64("record"), F.lit(blocks)).cast("int"))

    # the blocks that have a word, a bit each
    places = fields.select("block", F.explode("words").alias("word")).where(F.length("word") >= GRAM)
    places = places.groupBy("word", F.floor(F.col("block") / 64).cast("int").alias("high"))
    places = cut_lineage(places.agg(F.bit_or(F.expr("shiftleft(1L, block % 64)")).alias("bits")))
    matches = words_containing(keywords, places.select("word").distinct())
    low = F.explode(F.sequence(F.lit(0), F.lit(min(blocks, 64) - 1))).alias("low")
    words = places.join(matches, "word").select("word", "keywords", "high", "bits", low).where("bit_get(bits, low) = 1")
    words = words.select("word", "keywords", (F.col("high") * 64 + F.col("low")).alias("block"))

    asked = lookup_join(asked, keywords, ["keyword"]).groupBy("question")
    asked = asked.agg(F.collect_list(F.struct("number", "times")).alias("by"))
    asked = asked.select("question", F.col("by.number").alias("keywords"), F.col("by.times").alias("times"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    record = fields.schema["record"].dataType.simpleString()
    work = _best_of_block(n, list(weights.values()))
    scores = _by_block([words, fields, asked], blocks, work, f"question bigint, record {record}, score bigint")
    best = Window.partitionBy("question").orderBy(F.desc("score"), F.asc("record"))
    ranked = scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
    return ranked.select(F.col("question").alias(question_id), F.col("record").alias(key), "score", "rank")


def retrieval_context(
    questions: DataFrame,
    hits: DataFrame,
    catalog: DataFrame,
    question_id: str,
    question: str,
    key: str,
    opening: str = "Matching catalogue records:\n",
    closing: str = "Use these records to answer.",
    nothing: str = "No catalogue record matches.",
) -> DataFrame:
    """One context text per question: numbered record blocks, a fixed text when nothing matched,
    empty when the question has no keyword.

    A record's text can be long and can be wanted by many questions. Questions are dealt out in groups, a group gets each
    of its records' texts once, and the contexts are put together as they leave the last task; none is shuffled.
    """
    hits = cut_lineage(hits.select(F.col(question_id).alias("_asker"), F.col(key).alias("_record"), "rank"))
    # keyed by text, as the record's own key may be of any type
    wanted = hits.select("_asker", F.col("_record").cast("string").alias("record"), "rank").where("record IS NOT NULL")
    asked = questions.select(question_id, (F.size(keywords_of(F.col(question))) > 0).alias("_asks"))
    groups = 1 + hits.select("_asker").distinct().count() // CONTEXT_QUESTIONS
    group = F.pmod(F.xxhash64(F.col("_asker").cast("string")), F.lit(groups)).cast("int").alias("block")
    needed = wanted.select("record", group).distinct()

    def text(name: str, missing: str) -> Column:
        return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(missing))

    block = F.concat(
        F.lit(". Title: "), text("title", "null"),
        F.lit("\nID: "), text("field_identifier", "null"),
        F.lit("\nDescription: "), text("field_description_long", "N/A"),
        F.lit("\nSubject: "), text("field_subject", "N/A"), F.lit("\n\n"),
    )
    # most records are in no context, and their texts need not be shuffled
    found = possible(catalog.withColumn("_record", F.col(key).cast("string")), "_record", needed.select(F.col("record").alias("_record")))
    texts = lookup_join(found.select(F.col("_record").alias("record"), block.alias("text")), needed, ["record"])
    # at most n records a question
    listed = wanted.groupBy("_asker").agg(F.sort_array(F.collect_list(F.struct("rank", "record"))).alias("by"))
    listed = listed.select("_asker", F.col("by.rank").alias("ranks"), F.col("by.record").alias("records"))
    listed = asked.join(listed, asked[question_id] == listed["_asker"], "left")
    fixed = F.when(~F.col("_asks"), "").when(F.col("ranks").isNull(), nothing).alias("fixed")
    # questions without a record may go anywhere
    group = F.when(F.col("ranks").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int")).otherwise(group)
    listed = listed.select(F.col(question_id).alias("question"), fixed, "ranks", "records", group.alias("block"))

    asker = questions.schema[question_id].dataType.simpleString()
    contexts = _by_block([texts, listed], groups, _contexts(opening, closing, nothing), f"question {asker}, context string")
    return contexts.withColumnRenamed("question", question_id)


def _contexts(opening: str, closing: str, nothing: str) -> Callable:
    """The context of every question of a group; of a record's several rows, in the order of their texts."""

    def work(texts: Iterator[pa.RecordBatch], asked: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        for batch in texts:
            for record, text in zip(batch.column("record").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                held.setdefault(record, []).append(text)
        for rows in held.values():
            rows.sort()
        for batch in asked:
            lists = zip(*[batch.column(c).to_pylist() for c in ("fixed", "ranks", "records")])
            start, size, made = 0, 0, []
            for i, (fixed, ranks, records) in enumerate(lists):
                if fixed is None:
                    pieces = [piece for rank, record in zip(ranks, records) for text in held.get(record, []) for piece in (b"%d" % rank, text)]
                    made.append(b"".join([opening.encode(), *pieces, closing.encode()]) if pieces else nothing.encode())
                else:
                    made.append(fixed.encode())
                size += len(made[-1])
                if size > CONTEXT_BYTES or i == batch.num_rows - 1:
                    column = pa.array(made, pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([batch.column("question").slice(start, len(made)), column], names=["question", "context"])
                    start, size, made = i + 1, 0, []

    return work
