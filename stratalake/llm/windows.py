"""Words of a text as numbers, and the windows of words that a text repeats."""

from __future__ import annotations

import numpy as np


def numbered_words(words: list[bytes]) -> np.ndarray:
    """Each word as the number of different words before its first use."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def in_repeated_windows(ids: np.ndarray, width: int) -> np.ndarray:
    """For each word, whether a window of `width` words holds it that starts at two places or more.

    Exact: windows get numbers by pairs of shorter windows' numbers, so equal numbers are equal windows.
    """
    out = np.zeros(len(ids), bool)
    if len(ids) <= width:
        return out
    names, have = ids, 1
    while have < width:
        step = min(have, width - have)
        pairs = names[:-step] * (int(names.max()) + 1) + names[step:]
        names, have = np.unique(pairs, return_inverse=True)[1], have + step
    starts = np.flatnonzero(np.bincount(names)[names] > 1)
    if len(starts):
        edges = np.zeros(len(ids) + 1, np.int64)
        edges[starts] += 1
        edges[starts + width] -= 1
        out = np.cumsum(edges[:-1]) > 0
    return out


def stretches(flags: np.ndarray) -> np.ndarray:
    """(start, end) of the maximal stretches of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges.reshape(-1, 2)
