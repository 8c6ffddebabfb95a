"""Hard negatives: for each anchor and positive, the best rows of other labels within a window below the positive.

The windows of one anchor's positives overlap, but their upper limits cut the scores into disjoint slots. So:

1. Rows and anchors are dealt into blocks; a task scores one block of rows against one block of anchors with one
   matrix product and keeps, per anchor, the best rows of the same label. A ranked window merges the blocks.
2. The positives' upper limits are each anchor's slots. The blocks are scored again, and a task keeps the best
   ``negatives`` rows of other labels per slot; ranked windows merge them.
3. A window's best rows are the best of all slots from its own limit down: the slots of one anchor are put in
   descending order, and each positive reads off the first rows below its limit, then drops those below its lower one.

No pair of rows leaves a task but the best per anchor, or slot, and block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

# Rows and anchors of one block, and the bytes of a block's vectors.
ROWS, ANCHORS, BLOCK_BYTES = 8192, 1024, 32 << 20
AT_ONCE = 256  # anchors scored at a time
MOST = (1 << 63) - 1
WINDOW = (50, 95)


def usable(vector: Column, label: Column) -> Column:
    """The row has a label and a vector of finite numbers."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(label.isNotNull() & vector.isNotNull() & ~broken, F.lit(False))


def stacked(vectors: pd.Series, width: int) -> np.ndarray:
    """A matrix of the vectors; shorter ones are filled up with zeros."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def inner_products(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; those beyond 64 bits become the nearest 64-bit number."""

    def largest(m: np.ndarray) -> int:
        return max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))

    if largest(one) * largest(two) * one.shape[1] < 1 << 53:
        return (one.astype(np.float64) @ two.astype(np.float64).T).astype(np.int64)
    exact = one.astype(object) @ two.astype(object).T
    return np.clip(exact, -MOST, MOST).astype(np.int64)


def best_columns(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``k`` best allowed scores of each row; ties go to the first column."""
    n = scores.shape[1]
    largest = max(abs(int(scores.max(initial=0))), abs(int(scores.min(initial=0))))
    if n <= k or (largest + 1) * n >= 1 << 62:
        order = np.argsort(-scores, axis=1, kind="stable")  # never the least 64-bit number, so it can be negated
        kept = np.take_along_axis(allowed, order, axis=1)
        kept &= np.cumsum(kept, axis=1) <= k
        row, at = np.nonzero(kept)
        return row, order[row, at]
    # score and column as one number
    least = -(1 << 62)
    keys = np.where(allowed, scores * n + (n - 1 - np.arange(n)), least)
    top = np.argpartition(keys, n - k, axis=1)[:, n - k :]
    row, at = np.nonzero(np.take_along_axis(keys, top, axis=1) > least)
    return row, top[row, at]


def _blocks(rows: DataFrame, anchors: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Rows and anchors with the numbers of the block pairs they take part in: ``_a``, ``_r``."""
    by_bytes = max(1, BLOCK_BYTES // (8 * max(width, 1)))
    parts = -(-max(rows.count(), 1) // min(ROWS, by_bytes))
    groups = -(-max(anchors.count(), 1) // min(ANCHORS, by_bytes))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt_rows = rows.select("*", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("_r"), every(groups).alias("_a"))
    dealt_anchors = anchors.select("*", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)).cast("int").alias("_a"), every(parts).alias("_r"))
    return dealt_rows, dealt_anchors


def _positive_scorer(width: int, k: int):
    def score(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["id", "row"], na_position="last")
        found = []
        label, number = rows["label"].to_numpy(), rows["row"].to_numpy()
        matrix = stacked(rows["vector"], width)
        for start in range(0, len(anchors), AT_ONCE):
            part = anchors.iloc[start : start + AT_ONCE]
            scores = inner_products(stacked(part["vector"], width), matrix)
            own, mine = part["row"].to_numpy(), part["label"].to_numpy()
            row, column = best_columns(scores, (label[None, :] == mine[:, None]) & (number[None, :] != own[:, None]), k)
            ids = rows["id"].iloc[column].reset_index(drop=True)
            found.append(pd.DataFrame({"anchor": own[row], "positive_id": ids, "positive_row": number[column], "positive_score": scores[row, column]}))
        return pd.concat(found) if found else pd.DataFrame(columns=["anchor", "positive_id", "positive_row", "positive_score"])

    return score


def _slot_scorer(width: int, k: int):
    def score(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["id", "row"], na_position="last")
        found = []
        label = rows["label"].to_numpy()
        matrix = stacked(rows["vector"], width)
        for start in range(0, len(anchors), AT_ONCE):
            part = anchors.iloc[start : start + AT_ONCE]
            scores = inner_products(stacked(part["vector"], width), matrix)
            own = part["row"].to_numpy()
            other = label[None, :] != part["label"].to_numpy()[:, None]
            # limits in falling order; slot i holds the scores above the next limit and up to its own
            limits = [list(x) for x in part["limits"]]
            for slot in range(max(map(len, limits))):
                high = np.array([x[slot] if slot < len(x) else -MOST - 1 for x in limits])[:, None]
                low = np.array([x[slot + 1] if slot + 1 < len(x) else -MOST - 1 for x in limits])[:, None]
                row, column = best_columns(scores, other & (scores <= high) & (scores > low), k)
                ids = rows["id"].iloc[column].reset_index(drop=True)
                found.append(pd.DataFrame({"anchor": own[row], "slot": slot, "negative_id": ids, "negative_score": scores[row, column]}))
        return pd.concat(found) if found else pd.DataFrame(columns=["anchor", "slot", "negative_id", "negative_score"])

    return score


def _scored(rows: DataFrame, anchors: DataFrame, width: int, function, schema: str) -> DataFrame:
    dealt_rows, dealt_anchors = _blocks(rows, anchors, width)
    return dealt_anchors.groupBy("_a", "_r").cogroup(dealt_rows.groupBy("_a", "_r")).applyInPandas(function, schema)


def _percent(score: Column, percent: int) -> Column:
    return score.cast("decimal(20,0)") * percent


def hard_negatives(
    rows: DataFrame, positives: int = 5, negatives: int = 3, window: tuple[int, int] = WINDOW, scale: int = 256
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``rows`` has ``id`` (long), ``vector`` (numbers), ``label`` and ``is_anchor``. Rows without a label or with a null,
    NaN or infinite number take no part. Components become ``floor(scale * x)``, within 64 bits; scores are exact integer
    inner products (a score beyond 64 bits counts as the nearest 64-bit number; missing components count as 0).
    Higher scores come first, ties by smaller id, null last. An anchor's positives are its first ``positives`` other rows of
    its label; for each, the first ``negatives`` rows of other labels whose score is between the window's percentages of
    the positive's score come back. Repeated rows are rows of their own, as anchors, positives and negatives. Other columns are not read.
    """
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    kept = rows.where(usable(F.col("vector"), F.col("label")))
    kept = kept.select(
        F.col("id").cast("long").alias("id"),
        "label",
        whole.alias("vector"),
        F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"),
        F.monotonically_increasing_id().alias("row"),
    )
    kept = stored(kept, "vectors")
    width = kept.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0]
    every = kept.select("id", "label", "vector", "row")
    anchors = kept.where("is_anchor").select("id", "label", "vector", "row")

    schema = "anchor long, positive_id long, positive_row long, positive_score long"
    best = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "positive_row")
    found = _scored(every, anchors, width, _positive_scorer(width, positives), schema)
    # a window below a negative score is empty
    ranked = found.withColumn("place", F.row_number().over(best)).where((F.col("place") <= positives) & (F.col("positive_score") >= 0))
    wanted = ranked.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    wanted = stored(wanted, "positives")

    low, high = window
    limit = F.transform("positives", lambda p: F.floor(_percent(p["positive_score"], high) / 100).cast("long"))
    limits = F.sort_array(F.array_distinct(limit), asc=False)
    asking = anchors.join(wanted.select(F.col("anchor").alias("row"), limits.alias("limits")), "row")

    schema = "anchor long, slot int, negative_id long, negative_score long"
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    slots = _scored(every, stored(asking, "anchors"), width, _slot_scorer(width, negatives), schema)
    slots = slots.withColumn("place", F.row_number().over(best)).where(F.col("place") <= negatives)
    # falling scores are rising negated scores; a null id comes last
    entry = F.struct(
        (-F.col("negative_score")).alias("down"), F.col("negative_id").isNull().alias("no_id"), F.col("negative_id").alias("id")
    )
    merged = slots.groupBy("anchor").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    answers = wanted.join(merged, "anchor").select("anchor", "entries", F.inline("positives"))

    def score(e: Column) -> Column:
        return -e["down"]

    below = F.filter("entries", lambda e: _percent(score(e), 100) <= _percent(F.col("positive_score"), high))
    first = F.slice(below, 1, negatives)
    inside = F.filter(first, lambda e: _percent(score(e), 100) >= _percent(F.col("positive_score"), low))
    answers = answers.select("anchor", "positive_id", "positive_score", F.posexplode(inside).alias("at", "entry"))
    ids = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return answers.join(ids, "anchor").select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).alias("rank"),
        F.col("entry.id").alias("negative_id"),
        "positive_score",
        score(F.col("entry")).alias("negative_score"),
    )
