"""String similarity by longest common subsequence, on arrays of strings."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column

from .udf import vectorised


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, with one bit of a Python integer for each character of a."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    free = every
    for c in b:
        hit = free & where.get(c, 0)
        free = (free + hit | free - hit) & every
    return len(a) - free.bit_count()


def ratio(a: str, b: str) -> float:
    """0 to 100: twice the common length over both lengths; two empty strings are alike."""
    total = len(a) + len(b)
    return 200.0 * common(a, b) / total if total else 100.0


def token_set_ratio(a: str, b: str) -> float:
    """Best ratio among the shared words and the shared words with either rest; 100 when one side's words are among the other's."""
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    shared, only_a, only_b = sorted(left & right), sorted(left - right), sorted(right - left)
    if shared and not (only_a and only_b):
        return 100.0
    both, rest_a, rest_b = " ".join(shared), " ".join(only_a), " ".join(only_b)
    gap = 1 if shared else 0
    # the shared words stand in front on both sides: only the rests need comparing
    ahead = len(both) + gap
    total = 2 * ahead + len(rest_a) + len(rest_b)
    best = 200.0 * (ahead + common(rest_a, rest_b)) / total
    if shared:
        for rest in (rest_a, rest_b):
            best = max(best, 200.0 * len(both) / (len(both) + ahead + len(rest)))
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string with a window of the longer of its length, also where the window hangs over an end."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 100.0 if not long else 0.0
    n, best = len(short), 0.0
    letters = set(short)
    for first in range(1 - n, len(long)):
        window = long[max(0, first) : first + n]
        # a window whose edge letter isn't in the short string is no better than the one without it
        if (first > 0 and window[-1] not in letters) or (first < 0 and window[-1] not in letters):
            continue
        best = max(best, ratio(short, window))
        if best == 100.0:
            break
    return best


def best_of(text: str, others: Iterable[str]) -> tuple[float, int]:
    """Highest ratio to any of the others and the first place that has it; (0, -1) when all are 0. Pairs too unequal in length to win aren't compared."""
    top, which = 0.0, -1
    for i, other in enumerate(others):
        total = len(text) + len(other)
        if total and 200.0 * min(len(text), len(other)) / total <= top:
            continue
        score = ratio(text, other)
        if score > top:
            top, which = score, i
    return top, which


def _pairwise(function):
    @vectorised("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else function(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run


def ratio_of(a: Column, b: Column) -> Column:
    return _pairwise(ratio)(a, b)


def token_set_ratio_of(a: Column, b: Column) -> Column:
    return _pairwise(token_set_ratio)(a, b)


def partial_ratio_of(a: Column, b: Column) -> Column:
    return _pairwise(partial_ratio)(a, b)
