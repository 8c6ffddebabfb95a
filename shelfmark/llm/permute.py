"""Keyed pseudo-random permutation of 0..n-1: a Feistel network with cycle walking.

The numbers are written as (left, right) with ``left < a`` and ``right < b``, where ``a * b`` is the
smallest near-square not below ``n``. Each round adds a keyed hash of one half to the other, which
can be undone. Values that fall outside 0..n-1 are sent through again until they are inside.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """64-bit finalizer (splitmix)."""
    z = x + np.uint64(key)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _keys(key: int) -> list[int]:
    seeds = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return [int(k) for k in _mix(seeds, key % (1 << 64))]


def _radix(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, -(-n // a)


def _forward(x: np.ndarray, a: int, b: int, keys: list[int]) -> np.ndarray:
    left, right = np.divmod(x, np.uint64(b))
    for i, k in enumerate(keys):
        if i % 2 == 0:
            left = (left + _mix(right, k) % np.uint64(a)) % np.uint64(a)
        else:
            right = (right + _mix(left, k) % np.uint64(b)) % np.uint64(b)
    return left * np.uint64(b) + right


def _backward(x: np.ndarray, a: int, b: int, keys: list[int]) -> np.ndarray:
    left, right = np.divmod(x, np.uint64(b))
    for i, k in reversed(list(enumerate(keys))):
        if i % 2 == 0:
            left = (left + np.uint64(a) - _mix(right, k) % np.uint64(a)) % np.uint64(a)
        else:
            right = (right + np.uint64(b) - _mix(left, k) % np.uint64(b)) % np.uint64(b)
    return left * np.uint64(b) + right


def _walk(step, x: np.ndarray, n: int, key: int) -> np.ndarray:
    a, b = _radix(n)
    keys = _keys(key)
    out = step(np.asarray(x, dtype=np.uint64), a, b, keys)
    outside = out >= n
    while outside.any():
        out[outside] = step(out[outside], a, b, keys)
        outside = out >= n
    return out.astype(np.int64)


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """Place of each number in the shuffled order."""
    return _walk(_forward, x, n, key)


def unpermute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """Number at each place of the shuffled order."""
    return _walk(_backward, x, n, key)


def permuted(column: Column, n: int, key: int) -> Column:
    """``permute`` of a long column without nulls."""

    @F.pandas_udf("long")
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(np.uint64), n, key))

    return place(column)
