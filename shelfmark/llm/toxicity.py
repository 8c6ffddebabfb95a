"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A bounded sample of labelled texts gives, for each n-gram, the log ratio of its smoothed counts in
toxic and other texts. The n-grams with most evidence become features; their value is the ratio
where they occur, and a regularised logistic regression is fitted on them. Scoring looks at every
n-gram of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, held_out

SIZES = (4, 5, 6)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
TABLE_BITS = 22
# Buckets of one byte for the first count of n-grams: 64 MB.
BUCKET_BITS = 26
# Texts whose features are summed at a time.
BLOCK_TEXTS = 256
THRESHOLD = 0.3
CHARACTERS = 1 << 18


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, a zero before each and at the end; where each begins.

    White space and punctuation count as one blank, so words look the same wherever they stand.
    """
    data = "\0" + "\0".join(t.lower() for t in texts) + "\0"
    codes = np.frombuffer(data.encode("utf-32-le", "replace"), np.uint32)
    starts = np.flatnonzero(codes == 0)[: len(texts)] if "\0" not in "".join(texts) else None
    if starts is None:
        return _codes([t.replace("\0", " ") for t in texts])
    blank = ((codes > 0) & (codes < 48)) | ((codes > 57) & (codes < 97)) | ((codes > 122) & (codes < 128))
    return np.where(blank, np.uint32(32), codes).astype(np.uint64), starts


def _hashes(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Hash of the n-gram that starts at each position, one array per size."""
    value = codes[: len(codes)]
    for n in range(2, max(SIZES) + 1):
        value = (value[:-1] if n > 1 else value) * MULTIPLIER + codes[n - 1 :]
        if n in SIZES:
            yield value ^ (value >> np.uint64(29))


def _bits(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * MULTIPLIER) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _grams(text: str) -> np.ndarray:
    """Distinct n-gram hashes of one text."""
    codes, _ = _codes([text])
    return np.unique(np.concatenate(list(_hashes(codes))))


@dataclass
class Model:
    grams: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0

    def table(self) -> np.ndarray:
        table = np.zeros(1 << TABLE_BITS, bool)
        table[_bits(self.grams)] = True
        return table

    def score(self, texts: list[str], table: np.ndarray) -> np.ndarray:
        total = np.full(len(texts), self.bias)
        if len(self.grams):
            codes, starts = _codes(texts)
            pairs = []
            for hashes in _hashes(codes):
                at = np.flatnonzero(table[_bits(hashes)])
                found = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
                right = self.grams[found] == hashes[at]
                text = np.searchsorted(starts, at[right], side="right") - 1
                pairs.append(np.unique(text * len(self.grams) + found[right]))
            text, gram = np.divmod(np.concatenate(pairs), len(self.grams))
            total += np.bincount(text, self.weights[gram], len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * MULTIPLIER) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _counts(texts: list[str], least: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams in at least ``least`` texts, merged text by text in bounded steps.

    Most n-grams stand in few texts. A first pass counts texts per bucket of hashes, up to 255; an n-gram whose
    bucket has fewer than ``least`` cannot reach it, so the second pass holds only the others, and counts them.
    """
    table = np.zeros(1 << BUCKET_BITS, np.uint8)
    for t in texts:
        at = _buckets(_grams(t))
        seen = table[at]
        table[at] = seen + (seen < 255)
    grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    pending: list[np.ndarray] = []
    size = 0

    def merge() -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([grams, *pending])
        weight = np.concatenate([counts, np.ones(len(every) - len(grams), np.int64)])
        out, back = np.unique(every, return_inverse=True)
        return out, np.bincount(back, weight, len(out)).astype(np.int64)

    for t in texts:
        own = _grams(t)
        pending.append(own[table[_buckets(own)] >= min(least, 255)])
        size += len(pending[-1])
        if size > 2_000_000:
            grams, counts = merge()
            pending, size = [], 0
    grams, counts = merge()
    return grams[counts >= least], counts[counts >= least]


def fit(texts: list[str], toxic: list[int], features: int = 20_000, least: int = 4, alpha: float = 1.0) -> Model:
    """Fit on a sample small enough for one machine; without both classes the score is constant."""
    y = np.array(toxic, float)
    if not len(y) or y.min() == y.max():
        return Model(bias=0.0 if not len(y) else 4.0 * (2 * float(y[0]) - 1))
    positive = [t for t, k in zip(texts, toxic, strict=True) if k]
    grams, in_toxic = _counts(positive, least)
    rows = []
    in_other = np.zeros(len(grams), np.int64)
    for t, k in zip(texts, toxic, strict=True):
        own = _grams(t)
        at = np.minimum(np.searchsorted(grams, own), max(len(grams) - 1, 0))
        at = at[grams[at] == own] if len(grams) else at[:0]
        rows.append(at.astype(np.int32))
        if not k:
            in_other[at] += 1
    p, q = in_toxic + alpha, in_other + alpha
    ratio = np.log((p / (y.sum() + 2 * alpha)) / (q / ((1 - y).sum() + 2 * alpha)))
    # evidence: the ratio against its standard error
    evidence = np.abs(ratio) / np.sqrt(1 / p + 1 / q)
    chosen = np.sort(np.argsort(-evidence, kind="stable")[:features])
    renumber = np.full(len(grams), -1, np.int32)
    renumber[chosen] = np.arange(len(chosen), dtype=np.int32)
    for i, at in enumerate(rows):
        own = renumber[at]
        rows[i] = own[own >= 0]
    weights, bias = _logistic(rows, y, ratio[chosen])
    return Model(grams[chosen], weights * ratio[chosen], bias)


def _logistic(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on features ``ratio`` where present; L2 penalty; Adam steps.

    Each step goes over the texts in blocks, so what it holds beside the rows does not grow with their number.
    """
    blocks = []
    for lo in range(0, len(rows), BLOCK_TEXTS):
        part = rows[lo : lo + BLOCK_TEXTS]
        blocks.append((lo, lo + len(part), np.array([len(r) for r in part]), np.concatenate(part)))
    rows.clear()
    balance = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    w, bias = np.zeros(len(ratio) + 1), 0.0
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        slope = np.append(1e-5 * w[:-1], 0.0)
        value = w[:-1] * ratio
        for lo, hi, sizes, gram in blocks:
            text = np.repeat(np.arange(hi - lo), sizes)
            z = bias + np.bincount(text, value[gram], hi - lo)
            error = balance[lo:hi] * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[lo:hi]) / len(y)
            slope[:-1] += np.bincount(gram, error[text], len(ratio)) * ratio
            slope[-1] += error.sum()
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        bias = w[-1]
    return w[:-1], float(bias)


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled texts of each class outside the held-out fold, by hash of the id.

    The sample is chosen on ids alone; its texts are then read by a broadcast of those ids, of which
    there are twice ``per_class`` at most.
    """
    marked = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id")
    marked = marked.agg((F.max("toxic") > 0).cast("int").alias("_toxic"))
    known = docs.where(F.length("text") > 0).select("doc_id").distinct().join(marked, "doc_id")
    order = F.xxhash64("doc_id")
    classes = [known.where(F.col("_toxic") == c).orderBy(order, "doc_id").limit(per_class) for c in (0, 1)]
    chosen = cut(classes[0].union(classes[1]))
    texts = docs.select("doc_id", "text").where(F.length("text") > 0).join(F.broadcast(chosen), "doc_id")
    # an id that stands for several rows counts once; tasks merge theirs first
    return texts.groupBy("doc_id", "_toxic").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000, **options) -> Model:
    """Fit in one task on ``training_sample``; only the model comes back.

    ``per_class`` bounds the sample, whose texts are used whole. Beside them the task holds a table of 64 MB and the
    n-grams that may stand in ``least`` toxic texts or more.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_toxic", "doc_id"])
        model = fit(list(pdf["text"]), list(pdf["_toxic"]), **options)
        return pd.DataFrame(
            {"grams": [model.grams.view(np.int64)], "weights": [model.weights], "bias": [model.bias]}
        )

    sample = training_sample(docs, labels, per_class).withColumn("_all", F.lit(1))
    fitted = sample.groupBy("_all").applyInPandas(run, "grams array<long>, weights array<double>, bias double")
    rows = fitted.collect()  # one row: at most ``features`` numbers twice
    if not rows:
        return Model()
    r = rows[0]
    return Model(np.array(r["grams"], np.int64).view(np.uint64), np.array(r["weights"], float), r["bias"])


def with_toxicity(df: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Null counts as empty; an empty text has the score of a text without any feature. Only the text
    decides. Equal rows get equal scores; input columns with these names are replaced.
    """

    @F.pandas_udf("double")
    def score(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = model.table()
        for s in series:
            texts = [t or "" for t in s]
            out, batch, size = [], [], 0
            for t in texts:
                if batch and size + len(t) > CHARACTERS:
                    out.append(model.score(batch, table))
                    batch, size = [], 0
                batch.append(t)
                size += len(t)
            if batch:
                out.append(model.score(batch, table))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    base = df.drop("score", "predicted")
    scored = base.withColumn("score", score("text"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
