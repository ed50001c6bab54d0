"""Suffix arrays by the difference cover of three: sort sampled triples, recurse on their names, merge."""

from __future__ import annotations

import numpy as np


def _pairs(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Order-preserving numbers of the pairs; what doesn't fit into 63 bits is renamed first."""
    factor = int(low.max(initial=0)) + 1
    if int(high.max(initial=0) + 1) * factor >= 2**63:
        high = np.unique(high, return_inverse=True)[1]
    return high * factor + low


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of ``text`` (integers of 1 and more) in the order of the suffixes."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    s = np.zeros(n + 4, np.int64)
    s[:n] = text
    # A sample position past the end keeps the two halves of the recursion's text apart.
    ones, twos, zeros = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([ones, twos])
    triples = _pairs(_pairs(s[sample], s[sample + 1]), s[sample + 2])
    order = np.argsort(triples, kind="stable")
    fresh = np.ones(len(order), np.int64)
    fresh[1:] = triples[order][1:] != triples[order][:-1]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(fresh)
    if len(order) and names[order[-1]] < len(order):
        order = suffix_array(names)
    rank = np.zeros(n + 4, np.int64)
    rank[sample[order]] = np.arange(1, len(order) + 1)
    sampled = sample[order]
    sampled = sampled[sampled < n]

    rest = zeros[np.argsort(_pairs(s[zeros], rank[zeros + 1]), kind="stable")]
    # A remaining suffix goes after those sampled ones that are less: by (symbol, rank) among the
    # positions 1 mod 3, by (symbol, symbol, rank) among those 2 mod 3.
    first, second = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    both = np.concatenate([first, rest])
    keys = _pairs(s[both], rank[both + 1])
    less = np.searchsorted(keys[: len(first)], keys[len(first) :])
    both = np.concatenate([second, rest])
    keys = _pairs(_pairs(s[both], s[both + 1]), rank[both + 2])
    less += np.searchsorted(keys[: len(second)], keys[len(second) :])
    merged = np.empty(n, np.int64)
    places = less + np.arange(len(rest))
    free = np.ones(n, bool)
    free[places] = False
    merged[places], merged[free] = rest, sampled
    return merged
