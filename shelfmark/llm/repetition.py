"""Quality rules: repetition inside a text, found with a suffix array over its words.

The suffixes of all texts of a batch are sorted together by prefix doubling (a text's suffixes only
ever tie with each other). The ranks of every doubling step give the longest common prefix of
neighbours in the suffix array; the deepest LCP interval that holds a suffix is the longest repeat
that starts there. The union of those spans is the part of the text that repeats.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import fresh

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 3

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_covered long, longest_repeat long, n_repeats long"
)


def longest_repeats(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per position, the length of the longest word sequence from there that occurs again in its text.

    ``words``: word numbers of all texts, one after the other; ``starts``: where each text begins,
    and the end of the last.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    sizes = np.diff(starts)
    text = np.repeat(np.arange(len(sizes)), sizes)
    end = np.repeat(starts[1:], sizes)
    key = text * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    head = np.empty(n, bool)
    head[0] = True
    head[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0)) + 1
    levels, step = [rank.astype(np.int32)], 1
    tied = _tied(head, np.arange(n))
    while len(tied):
        at = order[tied]
        ahead = at + step
        inside = ahead < end[at]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)], 0)
        key = rank[at] * (n + 1) + second
        again = np.argsort(key, kind="stable")
        at, key = at[again], key[again]
        order[tied] = at
        head = np.empty(len(tied), bool)
        head[0] = True
        head[1:] = key[1:] != key[:-1]
        # group heads are positions in the suffix array, so ranks stay comparable with all others
        rank[at] = np.maximum.accumulate(np.where(head, tied, 0)) + 1
        levels.append(rank.astype(np.int32))
        tied = _tied(head, tied)
        step *= 2
    return _common_prefixes(order, levels, end)


def _tied(head: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Suffix-array positions whose group still has more than one suffix."""
    single = head & np.append(head[1:], True)
    return at[~single]


def _common_prefixes(order: np.ndarray, levels: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    n = len(order)
    left, right = order[:-1], order[1:]
    pairs = np.flatnonzero(levels[0][left] == levels[0][right])
    left, right = left[pairs], right[pairs]
    shared = np.zeros(len(pairs), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = left + shared, right + shared
        inside = (a < end[left]) & (b < end[right])
        same = inside & (levels[level][np.minimum(a, n - 1)] == levels[level][np.minimum(b, n - 1)])
        shared[same] += 1 << level
    longest = np.zeros(n, np.int64)
    longest[left] = shared
    longest[right] = np.maximum(longest[right], shared)
    return longest


def _covered(lengths: np.ndarray, least: int) -> np.ndarray:
    """Positions inside any repeat of at least ``least`` words."""
    n = len(lengths)
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(lengths >= least)
    np.add.at(edge, at, 1)
    np.subtract.at(edge, at + lengths[at], 1)
    return np.cumsum(edge[:-1]) > 0


def _windows(lengths: np.ndarray, window: int) -> np.ndarray:
    """Positions inside a window of ``window`` words that occurs again."""
    at = lengths >= window
    out = at.copy()
    for k in range(1, window):
        out[k:] |= at[:-k]
    return out


def measure(texts: list[str], least: int) -> list[tuple[int, ...]]:
    """The measures in ``FIELDS`` for each text."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    starts, words = [0], []
    for t in texts:
        # splits bytes at the six ASCII white-space characters only
        words.extend(map(numbers.__getitem__, t.encode("utf-8", "replace").split()))
        starts.append(len(words))
    ids, bounds = np.array(words, np.int64), np.array(starts, np.int64)
    lengths = longest_repeats(ids, bounds)
    repeat3 = np.concatenate(([0], np.cumsum(_windows(lengths, WINDOW))))[bounds]
    covered = np.concatenate(([0], np.cumsum(_covered(lengths, least))))[bounds]
    # a repeat is maximal to the left unless the one that starts a word earlier reaches as far
    first = np.zeros(len(lengths), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    earlier = np.concatenate(([0], lengths[:-1])) if len(lengths) else lengths
    maximal = (lengths >= least) & (first | (earlier != lengths + 1))
    repeats = np.concatenate(([0], np.cumsum(maximal)))[bounds]
    out = []
    for i, t in enumerate(texts):
        lo, hi = bounds[i], bounds[i + 1]
        lines = [x for x in t.split("\n") if x.strip(SPACES)]
        out.append(
            (
                int(hi - lo),
                len(t) - sum(map(t.count, SPACES)),
                sum(map(t.count, SYMBOLS)),
                len(lines) - len(set(lines)),
                int(repeat3[i + 1] - repeat3[i]),
                int(covered[i + 1] - covered[i]),
                int(lengths[lo:hi].max()) if hi > lo else 0,
                int(repeats[i + 1] - repeats[i]),
            )
        )
    return out


def _batches(texts: list[str], characters: int) -> Iterator[list[str]]:
    batch, size = [], 0
    for t in texts:
        if batch and size + len(t) > characters:
            yield batch
            batch, size = [], 0
        batch.append(t)
        size += len(t)
    if batch:
        yield batch


def with_repetition(
    df: DataFrame,
    least: int = 10,
    most_covered: float = 0.35,
    most_repeat: int = 100,
    characters: int = 1 << 20,
) -> DataFrame:
    """Add the measures of ``FIELDS``, ``base_failed`` and ``kept`` to every row.

    ``n_covered``: words inside maximal repeats of at least ``least`` words; ``longest_repeat``: words
    of the longest repeat; ``n_repeats``: places where a left-maximal repeat of that length starts.
    A row is kept unless it fails the base rules (under 50 words, or more than half of its words in
    repeated 3-word windows), or more than ``most_covered`` of its words are covered, or its longest
    repeat exceeds ``most_repeat`` words. Covered words also lie in repeated 3-word windows, so a
    ``most_covered`` of 0.5 or more rejects nothing that the base rules keep. ``characters`` bounds how much text is sorted at once; a
    longer text is sorted alone and whole.

    Null and empty texts have no words, so they fail the base rules. Equal rows get equal results.
    Input columns with names of the result are replaced; all others stay.
    """

    @F.pandas_udf(FIELDS)
    def measures(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FIELDS.split(", ")]
        for s in series:
            rows = []
            for batch in _batches([t or "" for t in s], characters):
                rows.extend(measure(batch, least))
            yield pd.DataFrame(rows, columns=names)

    names = [f.split()[0] for f in FIELDS.split(", ")]
    base = df.drop(*names, "base_failed", "kept")
    made = fresh("_measures", base)
    rows = base.select("*", measures("text").alias(made)).select(*base.columns, f"{made}.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    bad = (F.col("n_covered") > most_covered * F.col("n_words")) | (F.col("longest_repeat") > most_repeat)
    return rows.select("*", failed.alias("base_failed"), (~failed & ~bad).alias("kept"))
