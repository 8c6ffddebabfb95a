"""Mixing sources to target weights: every source gives an exact number of words.

Each document has a random key from its content. Per source, the documents in key order and their
running word counts say where the source's budget ends: whole rounds over the source (epochs), then
the documents before a cut key, then a part of the document at the cut. The cut is found by a
range sort of (source, key, words), prefix sums over its slices, and a scan of the one slice per
source that holds the cut; the documents themselves are not sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import SPACE_WORD, cut, small

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
MADE = ("size", "source_size", "target", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def random_key(seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), F.col("text")).cast("binary"))


def targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Words each source shall give, from one row per source (``source``, ``source_size``).

    The weights go round over the sources in code-point order, null last. A source gives at most
    ``most`` times its words; what it cannot give goes to the others by weight. With the sources
    sorted by cap per weight, the level at which the rest is shared is the largest of the levels
    that follow from capping each prefix.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = sizes.select("source", "source_size", weight.alias("_weight"), (F.col("source_size") * most).alias("_cap"))
    whole = Window.partitionBy()
    prefix = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = prefix.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    weights_left = F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    level = (left.cast("double") / weights_left.cast("double")).alias("_level")
    rows = rows.select("*", level).select("*", F.max("_level").over(whole).alias("_most"))
    target = F.least(F.col("_cap").cast("double"), F.col("_most") * F.col("_weight"))
    return rows.select("source", "source_size", target.alias("target"))


def source_cuts(keyed: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row per source: target, whole epochs, cut key and words that a row at the cut key gives."""
    sizes = cut(keyed.groupBy("source").agg(F.sum("_words").alias("source_size")))
    budget = F.least(F.floor("target"), F.col("source_size") * most)
    plan = targets(sizes, weights, most).select("*", budget.alias("_budget"))
    size = F.when(F.col("source_size") > 0, F.col("source_size"))
    plan = cut(
        plan.select(
            "source",
            "source_size",
            "target",
            F.coalesce(F.floor(F.col("_budget") / size), F.lit(0)).alias("_epochs"),
            F.coalesce(F.col("_budget") % size, F.lit(0)).alias("_rest"),
        )
    )
    # rows with equal keys count as one, so that equal rows are treated alike
    grouped = keyed.groupBy("source", "_key").agg(F.sum("_words").alias("_sum"), F.count("*").alias("_rows"))
    ordered = grouped.orderBy(F.col("source").asc_nulls_last(), "_key")
    slices = cut(ordered.select("*", F.spark_partition_id().alias("_slice")))
    parts = slices.groupBy("source", "_slice").agg(F.sum("_sum").alias("_part"))
    by_slice = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("*", F.coalesce(F.sum("_part").over(by_slice), F.lit(0)).alias("_before"))
    wanted = plan.select(F.col("source").alias("_source"), "_rest")
    # one slice per source: the one that holds the cut
    holds = parts.join(wanted, F.col("source").eqNullSafe(F.col("_source"))).where(
        (F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_part"))
    )
    holds = cut(holds.select("_source", F.col("_slice").alias("_held"), "_before", "_rest"))
    inside = slices.join(
        small(holds, 64), (F.col("_slice") == F.col("_held")) & F.col("source").eqNullSafe(F.col("_source"))
    )
    run = Window.partitionBy("_source").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_sum").over(run), F.lit(0)))
    at = inside.where((F.col("_start") <= F.col("_rest")) & (F.col("_rest") < F.col("_start") + F.col("_sum")))
    at = at.select(
        "_source",
        F.col("_key").alias("_cut_key"),
        F.floor((F.col("_rest") - F.col("_start")) / F.col("_rows")).alias("_cut_words"),
    )
    joined = plan.join(at, F.col("source").eqNullSafe(F.col("_source")), "left")
    return cut(joined.select(F.col("source").alias("_from"), "source_size", "target", "_epochs", "_cut_key", "_cut_words"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = "mix", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` and, per document, ``size``, ``source_size``, ``target`` and ``taken`` (words the mix takes).

    The words taken of a source add up to its target, rounded down (less a few words where rows with
    equal key share the cut). ``taken`` is at most ``most`` times the size. Null and empty texts have
    size 0 and give nothing; null is a source of its own. Equal rows have equal keys and are taken
    alike. Columns of the input that are not kept play no part, whatever their names.
    """
    keyed = docs.select("source", random_key(seed).alias("_key"), word_count(F.col("text")).alias("_words"))
    cuts = source_cuts(keyed, weights, most)
    kept = [F.col(c).alias(f"_keep_{c}") for c in keep]
    rows = docs.select("source", *kept, random_key(seed).alias("_key"), word_count(F.col("text")).alias("size"))
    joined = rows.join(small(cuts, 200), F.col("source").eqNullSafe(F.col("_from")))
    part = (
        F.when(F.col("_key") < F.col("_cut_key"), F.col("size"))
        .when(F.col("_key") == F.col("_cut_key"), F.least("size", "_cut_words"))
        .otherwise(0)
    )
    taken = (F.col("_epochs") * F.col("size") + part).alias("taken")
    return joined.select(*[F.col(f"_keep_{c}").alias(c) for c in keep], "size", "source_size", "target", taken)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: each one once per epoch, the one at the cut with its first words only.

    Columns and their order stay. A cut text is its first words joined by spaces, and ``n_chars`` (if
    there) is counted anew.
    """
    columns = docs.columns
    packed = docs.select("doc_id", "source", "text", F.struct(*columns).alias("_row"))
    mixed = mix(packed, keep=("_row",), **options)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0)
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0)
    some = F.when(rest > 0, F.array(rest)).otherwise(F.expr("cast(array() as array<bigint>)"))
    copies = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")), some)
    rows = mixed.select("_row", F.explode(copies).alias("_first"))
    words = F.regexp_extract_all("_row.text", F.lit(SPACE_WORD), 0)
    full = F.col("_first") < 0
    cut_text = F.array_join(F.slice(words, 1, F.greatest(F.col("_first"), F.lit(0)).cast("int")), " ")
    rows = rows.withColumn("_text", F.when(full, F.col("_row.text")).otherwise(cut_text))
    out = {c: F.col("_row").getField(c) for c in columns}
    out["text"] = F.col("_text")
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(full, out["n_chars"]).otherwise(F.length("_text")).cast(kind)
    return rows.select(*[out[c].alias(c) for c in columns])
