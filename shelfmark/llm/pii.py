"""Sanitising personal data, and the terms around it that give it away.

Emails, addresses, card and phone numbers are found by pattern. Each distinct value is a protected
entity. Terms that stand near mentions of an entity are weighed by corpus co-occurrence: with n
documents, an entity's information is ``IC(e) = log2(n / df(e))`` and a term tells
``PMI(t, e) = log2(n * df(t, e) / (df(t) * df(e)))`` of it. The share ``PMI / IC`` is 1 if the term
occurs with the entity only. A term that few of an entity's texts show counts by the part of them
that do, so that chance words of one mention weigh little; an entity of one text has no others to ask.
Terms above one threshold are removed, terms above a lower one are
generalised to their shape, in every document that mentions the entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import TEXT_WORD, cut, row_key, small

# The contract's patterns. Possessive parts and the look-behind only avoid retries that cannot match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$"
KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalised", "removed")
EDGE = r"[0-9A-Za-z\x80-\x{10FFFF}]"
SPAN = "array<struct<start:int,end:int,value:string>>"


def found_spans(text: Column, pattern: Column) -> Column:
    """Matches of a pattern, leftmost and without overlap: start and end in code points, and the value.

    The pieces between the matches give the positions.
    """
    values = F.regexp_extract_all(text, pattern, 0)
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(values))
    steps = F.zip_with(gaps, values, lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(done: Column, x: Column) -> Column:
        begin = done["at"] + x["gap"]
        end = begin + F.length(x["value"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["found"], F.array(span)).alias("found"))

    return F.aggregate(steps, start, step, lambda done: done["found"])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn's check of a string of digits: from the right, every second digit counts double, less 9 over 9."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(number, F.length(number) - i + 1, F.lit(1)).cast("int")
        double = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, double).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind the valid matches in a text (null: none)."""
    none = F.array().cast(SPAN)
    numeric = text.rlike("[0-9]")
    count = {k: lambda v: F.length(digits(v)) for k in ("card", "phone")}
    valid = {
        "email": lambda s: F.lit(True),
        "ip": lambda s: s["value"].rlike(IP_PARTS),
        "card": lambda s: F.when(count["card"](s["value"]).between(16, 19), luhn(digits(s["value"]))).otherwise(False),
        "phone": lambda s: count["phone"](s["value"]).between(8, 15),
    }
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    present = {"email": text.contains("@"), "ip": numeric, "card": numeric, "phone": numeric & text.contains("+")}
    return {
        k: F.when(present[k], F.filter(found_spans(text, F.lit(pattern[k])), valid[k])).otherwise(none) for k in KINDS
    }


def with_base_spans(docs: DataFrame) -> DataFrame:
    """Row key, id, text and one span column per kind."""
    return docs.select(row_key().alias("row_key"), "doc_id", "text").withColumns(base_spans(F.col("text")))


def entity(kind: str, value: Column) -> Column:
    plain = F.lower(value) if kind == "email" else value if kind == "ip" else digits(value)
    return F.concat(F.lit(f"{kind}:"), plain)


def mentions(rows: DataFrame, context: int) -> DataFrame:
    """``row_key``, ``text_key``, ``entity`` and the text ``before`` and ``after`` every base span."""

    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"], s["end"], entity(kind, s["value"]).alias("entity")))

    spans = [named(k) for k in KINDS]
    found = rows.select("row_key", F.md5(F.col("text").cast("binary")).alias("text_key"), "text", F.inline(F.concat(*spans)))
    # a stretch that holds the words, unless they are very long: then all of the text on that side
    reach = context * 24
    begin = F.greatest(F.col("start") - reach, F.lit(0))
    last = F.length("text") - F.col("end")
    left = F.substring(F.col("text"), begin + 1, F.col("start") - begin)
    right = F.substring(F.col("text"), F.col("end") + 1, F.lit(reach))
    before = F.when((begin == 0) | (n_words(left) > context), left).otherwise(F.substring(F.col("text"), F.lit(1), F.col("start")))
    after = F.when((last <= reach) | (n_words(right) > context), right).otherwise(F.substring(F.col("text"), F.col("end") + 1, last))
    return found.select("row_key", "text_key", "entity", before.alias("before"), after.alias("after"))


def n_words(text: Column) -> Column:
    """Words of a stretch without personal data; one that the stretch cuts counts, so ask for one more."""
    return F.regexp_count(without_personal_data(text), F.lit(TEXT_WORD))


def without_personal_data(text: Column) -> Column:
    for pattern in (EMAIL, IP, CARD, PHONE):
        text = F.regexp_replace(text, pattern, " ")
    return text


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TEXT_WORD), 0)


def near_terms(found: DataFrame, context: int) -> DataFrame:
    """Terms within ``context`` words of a mention, other personal data left out: one row per text and entity."""

    def clean(part: Column) -> Column:
        return words_of(without_personal_data(part))

    left = F.slice(F.reverse(clean(F.col("before"))), 1, context)
    both = F.array_distinct(F.concat(left, F.slice(clean(F.col("after")), 1, context)))
    return found.select("row_key", "text_key", "entity", F.explode(both).alias("term"))


def disclosures(
    docs: DataFrame, found: DataFrame, context: int, least: int, generalise: float, remove: float
) -> DataFrame:
    """``entity``, ``term``, ``share`` and ``kind`` of the terms that reveal an entity.

    ``least``: a term that fewer different texts show near the entity has its share multiplied by
    the part of the entity's texts that show it.
    """
    together = near_terms(found, context).distinct().groupBy("entity", "term")
    together = together.agg(F.count_distinct("row_key").alias("both"), F.count_distinct("text_key").alias("texts"))
    together = cut(together)
    entities = found.groupBy("entity").agg(
        F.count_distinct("row_key").alias("df_entity"), F.count_distinct("text_key").alias("entity_texts")
    )
    wanted = cut(together.select("term").distinct())
    terms = docs.select(F.explode(F.array_distinct(words_of(F.col("text")))).alias("term"))
    # counts merge in every task before they travel, also where the wanted terms are too many to broadcast
    counts = terms.groupBy("term").agg(F.count("*").alias("df_term")).join(small(wanted, 48), "term")
    total = docs.where(F.col("text").isNotNull()).count()
    rows = together.join(entities, "entity").join(counts, "term").withColumn("n", F.lit(float(total)))
    information = F.log2(F.col("n") / F.col("df_entity"))
    pointwise = F.log2(F.col("n") * F.col("both") / (F.col("df_term").cast("double") * F.col("df_entity")))
    support = F.when(F.col("texts") >= least, 1.0).otherwise(F.col("texts") / F.col("entity_texts"))
    share = F.when(information > 0, support * pointwise / information).otherwise(0.0)
    kind = F.when(F.col("share") >= remove, "removed").otherwise("generalised")
    rows = rows.select("entity", "term", share.alias("share")).where(F.col("share") >= generalise)
    return cut(rows.withColumn("kind", kind))


def term_patterns(found: DataFrame, revealing: DataFrame) -> DataFrame:
    """Per document row a pattern for the terms to generalise and one for those to remove."""
    hits = found.select("row_key", "entity").distinct().join(small(revealing, 120), "entity")
    worst = hits.groupBy("row_key", "term").agg(F.max("kind").alias("kind"))  # 'removed' sorts last
    listed = worst.groupBy("row_key").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("term")))).alias(k) for k in TERM_KINDS]
    )
    either = {k: F.when(F.size(k) > 0, F.concat(F.lit(f"(?iu)(?<!{EDGE})(?:"), F.array_join(k, "|"), F.lit(f")(?!{EDGE})"))) for k in TERM_KINDS}
    return cut(listed.select("row_key", *[either[k].alias(f"_{k}") for k in TERM_KINDS]))


def span_list(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of all spans by kind as listed, then start, comma-joined."""

    def written(kind: str) -> Column:
        return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    return F.array_join(F.concat(*[written(k) for k in kinds]), ",")


def sanitised_text() -> Column:
    """The text with every span replaced: base kinds and removed terms by a mark, generalised ones by their shape.

    Where spans overlap, the first to start decides; the rest of an overlapping one goes with it.
    """
    def mark(kind: str, span: Column) -> Column:
        if kind == "generalised":
            return F.regexp_replace(F.regexp_replace(span["value"], r"[^0-9]", "x"), "[0-9]", "9")
        return F.lit("[TERM]" if kind == "removed" else f"[{kind.upper()}]")

    def marked(kind: str) -> Column:
        return F.transform(
            kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), mark(kind, s).alias("mark"))
        )

    every = F.concat(*[marked(k) for k in KINDS + TERM_KINDS])
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        new = F.struct(s["end"].alias("at"), F.concat(done["out"], F.array(gap, s["mark"])).alias("out"))
        longer = F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["out"].alias("out"))
        return F.when(s["start"] >= done["at"], new).otherwise(longer)

    def finish(done: Column) -> Column:
        return F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text)))

    return F.aggregate(F.array_sort(every), start, step, finish)


def sanitise(
    docs: DataFrame,
    context: int = 12,
    least: int = 2,
    generalise: float = 0.8,
    remove: float = 0.9,
) -> DataFrame:
    """One row per document row: ``doc_id``, ``text``, a span column per kind (``email``, ``ip``,
    ``card``, ``phone``, ``generalised``, ``removed``) and ``sanitised``, the text with them replaced.

    A term is a word (``TEXT_WORD``, lower case) within ``context`` words of an entity. All are weighed;
    those that fewer than ``least`` different texts show there count by the part of the entity's texts
    that do. A term over a threshold is replaced wherever it stands in a document that mentions
    the entity. Counts are over all documents, copies included.

    Null texts have no spans and stay null; empty ones stay empty. Repeated rows get equal results.
    With an empty table, or no entity, nothing is added to the base spans. Only ``doc_id`` and
    ``text`` are read.
    """
    rows = with_base_spans(docs)
    some = rows.where(F.size(F.concat(*KINDS)) > 0)
    found = cut(mentions(some, context))
    revealing = disclosures(docs, found, context, least, generalise, remove)
    patterns = term_patterns(found, revealing)
    joined = rows.join(small(patterns, 400), "row_key", "left")
    none = F.array().cast(SPAN)
    terms = {k: F.when(F.col(f"_{k}").isNotNull(), found_spans(F.col("text"), F.col(f"_{k}"))).otherwise(none) for k in TERM_KINDS}
    spans = joined.select("doc_id", "text", *KINDS, *[terms[k].alias(k) for k in TERM_KINDS])
    return spans.withColumn("sanitised", sanitised_text())


def digest(rows: DataFrame) -> DataFrame:
    """The contract's columns from the spans of ``sanitise``, then ``n_generalised``, ``n_removed`` and ``n_spans`` (all kinds)."""
    base, terms = ([F.size(k).cast("long").alias(f"n_{k}") for k in kinds] for kinds in (KINDS, TERM_KINDS))
    total = F.size(F.concat(*KINDS, *TERM_KINDS)).cast("long").alias("n_spans")
    sha = F.sha2(span_list(KINDS).cast("binary"), 256).alias("base_sha256")
    return rows.select("doc_id", *base, sha, span_list(KINDS + TERM_KINDS).alias("spans"), *terms, total)
