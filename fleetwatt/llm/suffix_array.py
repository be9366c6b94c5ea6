"""Suffix arrays by prefix doubling, and permuted common prefixes.

Both compare whole words of 64 bits of packed symbols and work on arrays: no Python step per symbol.
"""

from __future__ import annotations

import numpy as np


def _packed(text: list[int] | bytes | np.ndarray) -> tuple[np.ndarray, int, int]:
    """For each position the next symbols as one number, how many they are, and the bits of each."""
    x = np.frombuffer(text, np.uint8) if isinstance(text, bytes) else np.asarray(text)
    bits = max(1, int(x.max()).bit_length())
    per = min(8, 64 // bits)
    x = np.r_[x.astype(np.uint64), np.zeros(per, np.uint64)]
    packed = np.zeros(len(x) - per, np.uint64)
    for i in range(per):
        packed = (packed << np.uint64(bits)) | x[i : len(x) - per + i]
    return packed, per, bits


def suffix_array(text: list[int] | bytes, alphabet: int) -> list[int]:
    """Suffix array of text, whose last symbol 0 occurs nowhere else; symbols are below alphabet.

    Suffixes are sorted by their first few symbols; those that are equal so far, by the ranks of what
    follows, which doubles the symbols that count. A rank is the place of the first equal suffix, so a
    suffix that is alone keeps its place and is not sorted again.
    """
    packed, sorted_by, _ = _packed(text)
    n = len(packed)
    order = np.argsort(packed)
    places, own = np.arange(n), packed[order]
    rank = np.empty(n, np.int64)
    while True:
        # own: what the suffixes at these places were sorted by.
        first = np.r_[True, own[1:] != own[:-1]]
        rank[order[places]] = places[np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))]
        places = places[~(first & np.r_[first[1:], True])]
        if not len(places):
            return order.tolist()
        suffixes = order[places]
        # Equal ones have not met the last symbol yet, so something follows.
        own = rank[suffixes] * n + rank[suffixes + sorted_by]
        by = np.argsort(own)
        order[places], own = suffixes[by], own[by]
        sorted_by *= 2


def common_prefixes(text: list[int] | bytes, array: list[int]) -> np.ndarray:
    """Permuted: for each position, the symbols its suffix shares with the one before it in order."""
    packed, per, bits = _packed(text)
    array = np.asarray(array)
    shared = np.zeros(len(packed), np.int64)
    a, b = array[:-1], array[1:]
    while len(b):
        differ = packed[a + shared[b]] ^ packed[b + shared[b]]
        same = differ == 0
        at = b[~same]
        behind = sum((differ[~same] >> np.uint64(bits * i) != 0).astype(np.int64) for i in range(per))
        shared[at] += per - behind
        a, b = a[same], b[same]
        shared[b] += per
    return shared
