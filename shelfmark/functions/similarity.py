"""String similarity that Spark lacks, composed of native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import let

TAKEN = "Ā"  # no byte: bytes are written as the characters 0 to 255


def _byte_text(c: Column) -> Column:
    """One character per UTF-8 byte."""
    return F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")


def _at(text: Column, i: Column) -> Column:
    return F.substring(text, i, F.lit(1))


def _matches(x: Column, y: Column) -> Column:
    """Each byte of ``y`` takes the first free equal byte of ``x`` within reach.

    Gives ``pool`` (``x`` with ``TAKEN`` at what was taken) and ``hits`` (the bytes of ``y`` that found one).
    """
    reach = F.greatest(F.floor(F.greatest(F.length(x), F.length(y)) / 2).cast("int") - 1, F.lit(0))

    def step(state: Column, j: Column) -> Column:
        start = F.greatest(j - reach, F.lit(1))

        def taken(i: Column) -> Column:
            pool = F.overlay(state["pool"], F.lit(TAKEN), i, F.lit(1))
            hit = F.struct(pool.alias("pool"), F.concat(state["hits"], _at(y, j)).alias("hits"))
            return F.when((i > 0) & (i <= j + reach), hit).otherwise(state)

        return let(F.position(_at(y, j), state["pool"], start), taken)

    first = F.struct(x.alias("pool"), F.lit("").alias("hits"))
    return F.aggregate(F.sequence(F.lit(1), F.length(y)), first, step)


def _jaro(x: Column, y: Column, found: Column) -> Column:
    hits = found["hits"]
    m = F.length(hits)
    places = F.filter(F.sequence(F.lit(1), F.length(x)), lambda i: _at(found["pool"], i) == TAKEN)
    ordered = F.array_join(F.transform(places, lambda i: _at(x, i)), "")

    def swaps(same: Column) -> Column:
        apart = F.filter(F.sequence(F.lit(1), m), lambda i: _at(same, i) != _at(hits, i))
        return F.when(same == hits, 0).otherwise(F.floor(F.size(apart) / 2))

    score = let(ordered, lambda o: (m / F.length(x) + m / F.length(y) + (m - swaps(o)) / m) / 3)
    return F.when(m == 0, 0.0).otherwise(score)


def _boosted(x: Column, y: Column, jaro: Column) -> Column:
    shortest = F.least(F.length(x), F.length(y))
    equal = [((shortest >= n) & (F.left(x, F.lit(n)) == F.left(y, F.lit(n)))).cast("int") for n in range(1, 5)]
    prefix = equal[0] + equal[1] + equal[2] + equal[3]
    return F.when(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro)).otherwise(jaro)


def jaro_winkler(a: Column, b: Column) -> Column:
    """Jaro-Winkler similarity over UTF-8 bytes: prefix scale 0.1, prefix of at most 4, the prefix
    boost only above 0.7. Null in, null out; empty text is like nothing."""

    def score(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        return let(let(_matches(x, y), lambda found: _jaro(x, y, found)), lambda jaro: _boosted(x, y, jaro))

    some = (F.length(a) > 0) & (F.length(b) > 0)
    pair = F.struct(_byte_text(a).alias("x"), _byte_text(b).alias("y"))
    return F.when(some, let(pair, score)).when(a.isNotNull() & b.isNotNull(), 0.0)
