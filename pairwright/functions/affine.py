"""Affine-gap distance of two short texts.

A gap costs once for its start and again for each of its letters. Letters of
the longer text beyond the length of the shorter one are cheaper, so that an
abbreviation is near the whole word. The table of the dynamic programme is
filled row by row: one step for each letter of the shorter text, which keeps the
best costs that end in a match, and those that end in a gap of either text. A
step is taken for many pairs at once, in numpy on the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Costs:
    """What the learned matcher's text fields are compared with."""

    match: float = 1.0
    mismatch: float = 11.0
    gap: float = 10.0
    letter: float = 7.0
    abbreviation: float = 0.125


# Above any cost of texts that fit in a row.
FAR = 1e15
# Letters of the longer texts that are held at once.
LETTERS_AT_ONCE = 1 << 18


def _codes(texts: list[str]) -> np.ndarray:
    """Code points, a row for each text, filled up with zeros."""
    width = max(map(len, texts))
    points = np.frombuffer("".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return points.reshape(len(texts), width)


def _table(long: list[str], short: list[str], c: Costs) -> np.ndarray:
    """Costs of turning all of each ``short`` into all of its ``long``; no text is empty."""
    n, m = np.array([len(t) for t in long]), np.array([len(t) for t in short])
    x, y = _codes(long).T, _codes(short).T
    letters, rows = len(x), len(n)
    best = np.repeat((c.gap + c.letter * np.arange(letters + 1.0))[:, None], rows, axis=1)
    best[0] = 0.0
    down = np.full_like(best, FAR)
    # Letters of the long text beyond the length of the short one are cheaper.
    scale = np.where(np.arange(1, letters + 1)[:, None] <= m, 1.0, c.abbreviation)
    out = np.empty(rows)
    for i in range(1, len(y) + 1):
        # Down: a gap in the long text. It is known from the row above alone.
        down = np.minimum(down, best + c.gap) + c.letter
        diagonal = best[:-1] + np.where(x == y[i - 1], c.match, c.mismatch)
        without = np.minimum(down[1:], diagonal)
        best = np.empty_like(best)
        best[0] = c.gap + c.letter * i
        across = np.full(rows, FAR)
        for j in range(1, letters + 1):
            across = np.minimum(across, best[j - 1] + c.gap * scale[j - 1]) + c.letter * scale[j - 1]
            best[j] = np.minimum(across, without[j - 1])
        ends = np.flatnonzero(m == i)
        out[ends] = best[n[ends], ends]
    return out


def _costs(c: Costs) -> Callable[[Iterator[tuple[pd.Series, pd.Series]]], Iterator[pd.Series]]:
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            out = np.full(len(a), np.nan)
            known = np.flatnonzero((a.notna() & b.notna()).to_numpy())
            pairs = [(x, y) if len(x) >= len(y) else (y, x) for x, y in zip(a.iloc[known], b.iloc[known])]
            sizes = np.array([(len(x), len(y)) for x, y in pairs], np.int64).reshape(-1, 2)
            bare = sizes[:, 1] == 0
            out[known[bare]] = c.gap + c.letter * sizes[bare, 0]
            # Pairs of like lengths share a table.
            order = np.lexsort((sizes[:, 1], sizes[:, 0]))
            order = order[~bare[order]]
            at = 0
            while at < len(order):
                end = min(len(order), at + max(1, LETTERS_AT_ONCE // int(sizes[order[at], 0])))
                while end > at + 1 and (end - at) * sizes[order[end - 1], 0] > 2 * LETTERS_AT_ONCE:
                    end = at + (end - at) // 2
                part = order[at:end]
                out[known[part]] = _table([pairs[k][0] for k in part], [pairs[k][1] for k in part], c)
                at = end
            yield pd.Series(out)
    return of


def affine_gap(a: Column, b: Column, costs: Costs = Costs()) -> Column:
    """The cost divided by the length of both texts together; null if a text is null or both are empty.

    Equal texts cost a match for each letter. Work grows with the product of
    the lengths: meant for names and categories, not for descriptions.
    """
    filled = F.pandas_udf(_costs(costs), "double")
    # Only pairs of different texts need the table.
    total = F.when(a == b, costs.match * F.length(a)).otherwise(filled(F.when(a != b, a), F.when(a != b, b)))
    size = F.length(a) + F.length(b)
    return F.when(size > 0, total / size)
