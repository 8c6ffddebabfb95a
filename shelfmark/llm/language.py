"""Language identification by compression: the language whose sample helps most to compress a text.

For every language a bounded sample of its texts serves as a raw-content zstandard dictionary. A text
is encoded in pieces with each dictionary; the smallest total wins. Where the winner is hardly
smaller than the next, the answer is marked as rejected. Letters are compared in lower case.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, fresh, held_out, small

UNKNOWN = "und"


def middle(text: str, size: int) -> bytes:
    """At most ``size`` bytes from the middle of a text in UTF-8, of whole characters."""
    data = text.encode("utf-8", "replace")
    begin = max(0, len(data) - size) // 2
    return data[begin : begin + size].decode("utf-8", "ignore").encode("utf-8")


def learn_samples(df: DataFrame, per_language: int, sample_bytes: int) -> dict[str, bytes]:
    """Dictionary content per language, from rows outside the held-out fold.

    At most ``per_language`` different texts of each language, those with the smallest content hash,
    so reruns agree; copies count once. Each gives a stretch of no more than its equal share of the
    ``sample_bytes`` as UTF-8. Only hashes are compared; the texts of those chosen are read after.
    """
    known = df.where(F.col("lang").isNotNull() & (F.length("text") > 0) & ~held_out(F.col("doc_id")))
    order = Window.partitionBy("lang").orderBy("_hash")
    share = max(1, sample_bytes // per_language - 1)  # a line break goes with each
    hashed = known.select("lang", F.xxhash64("text").alias("_hash"), "text")
    # copies merge in every task; then Spark keeps the first rows of each language per task
    ranked = hashed.select("lang", "_hash").distinct().withColumn("_n", F.row_number().over(order))
    chosen = small(cut(ranked.where(F.col("_n") <= per_language)), 48)
    rows = hashed.join(chosen, ["lang", "_hash"])
    # a stretch from the middle of a longer text: no text is privileged at its start
    start = F.greatest(F.lit(1), ((F.length("text") - share) / 2).cast("int"))
    rows = rows.select("lang", "_n", F.substring(F.col("text"), start, F.lit(share)).alias("text"))
    rows = rows.groupBy("lang", "_n").agg(F.min("text").alias("text"))
    samples: dict[str, list[tuple[int, str]]] = {}
    for r in rows.collect():  # at most per_language short stretches per language
        samples.setdefault(r["lang"], []).append((r["_n"], middle(r["text"].lower(), share)))
    return {lang: b"\n".join(t for _, t in sorted(parts)) for lang, parts in sorted(samples.items())}


class Classifier:
    def __init__(self, samples: dict[str, bytes], level: int, piece: int):
        self.languages = list(samples)
        self.piece = piece
        self.compressors = []
        for content in samples.values():
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=level)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
                )
            )

    def sizes(self, text: str) -> np.ndarray:
        data = text.lower().encode("utf-8", "replace")
        pieces = [data[i : i + self.piece] for i in range(0, len(data), self.piece)]
        return np.array([sum(len(c.compress(p)) for p in pieces) for c in self.compressors], float)

    def predict(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        best = int(np.argmin(sizes))
        # the weight of evidence: bits saved per kilobyte of text
        saved = (sizes - sizes[best]) * 8 / max(1.0, math.sqrt(len(text)))
        score = float(1 / np.exp(-saved).sum())
        rest = np.delete(sizes, best)
        narrow = len(rest) > 0 and float(rest.min() - sizes[best]) < margin * float(sizes[best])
        return self.languages[best], score, bool(narrow)


def with_language(
    df: DataFrame, samples: dict[str, bytes], margin: float = 0.01, level: int = 9, piece: int = 2048
) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    ``rejected`` marks answers whose size is within ``margin`` of the next language's. A null text
    and a text without a letter get ``und``, score 0, rejected; so does every text if nothing was
    learned. Equal sizes go to the first language by name. Whole texts are encoded, in pieces of
    ``piece`` bytes. Equal rows get equal results; input columns with these names are replaced.
    """

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Classifier(samples, level, piece)
        for s in series:
            yield pd.DataFrame([model.predict(t, margin) for t in s], columns=["lang_pred", "score", "rejected"])

    base = df.drop("lang_pred", "score", "rejected")
    made = fresh("_found", base)
    return base.select("*", predict("text").alias(made)).select(*base.columns, f"{made}.*")


def identify_language(docs: DataFrame, per_language: int = 160, sample_bytes: int = 96 << 10, **options) -> DataFrame:
    """Learn from ``docs`` and predict every row: the columns of ``with_language`` and ``held_out``."""
    samples = learn_samples(docs, per_language, sample_bytes)
    rows = docs.withColumn("held_out", held_out(F.col("doc_id")))
    return with_language(rows, samples, **options)
