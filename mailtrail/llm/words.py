"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a longest run of digits, letters a-z (A-Z lowered) and characters beyond ASCII;
in UTF-8 the bytes of the latter are those of 0x80 and above, so bytes decide.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

U = np.uint64
_BASE, _MIX1, _MIX2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
#: Bytes hashed at once.
BLOCK = 4 << 20
#: A text has less than 2**31 bytes, as an Arrow batch has.
PLACE_BITS = 31
_powers: dict[str, np.ndarray] = {}


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    #: 64-bit hash of the lowered word.
    hash: np.ndarray
    #: Row of the word's text.
    row: np.ndarray
    #: n+1 offsets: the words of row i are first[i] to first[i + 1].
    first: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * _MIX1
    x = (x ^ (x >> U(27))) * _MIX2
    return x ^ (x >> U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, BLOCK // 2)
        inverse = U(pow(int(_BASE), -1, 1 << 64))
        for name, step in (("up", _BASE), ("down", inverse)):
            table = np.full(size, step, U)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=U)
    return _powers["up"], _powers["down"]


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans (in order of start), whatever lies around them."""
    out = np.empty(len(start), U)
    at = 0
    while at < len(start):
        low = int(start[at])
        to = int(np.searchsorted(start, low + BLOCK, "left"))
        high = int(end[at:to].max())
        up, down = _power(high - low + 1)
        sums = np.zeros(high - low + 1, U)
        np.cumsum((data[low:high].astype(U) + U(1)) * up[: high - low], out=sums[1:])
        a, b = start[at:to] - low, end[at:to] - low
        out[at:to] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(U))
        at = to
    return out


def split_words(data: np.ndarray, ends: np.ndarray) -> Words:
    """Words of the texts whose bytes lie between the n+1 offsets ``ends``."""
    low = _LOWER[data]
    inside = np.zeros(len(low) + 2, np.int8)
    inside[1:-1] = _WORD[low]
    turn = np.diff(inside)
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    # A border between texts inside a run of word bytes ends one word and starts another.
    cut = ends[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(low))])
    cut = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)] if len(cut) else cut
    if len(cut):
        start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
    row = np.searchsorted(ends, start, "right") - 1
    first = np.searchsorted(start, ends)
    return Words(start, end, span_hashes(low, start, end), row, first)


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, and whether they lie in one text."""
    n = len(words.hash)
    if n < k:
        return np.zeros(0, U), np.zeros(0, bool)
    acc = words.hash[: n - k + 1].copy()
    for j in range(1, k):
        acc = mix(acc * _BASE + words.hash[j : n - k + 1 + j])
    return acc, words.row[: n - k + 1] == words.row[k - 1 :]


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """Leftmost place of the least key in each window of ``width`` keys.

    Keys are compared by their upper bits, always as many: equal windows choose alike.
    """
    n = len(keys) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    tagged = (keys >> U(PLACE_BITS) << U(PLACE_BITS)) | np.arange(len(keys), dtype=U)
    span, low = 1, tagged
    while span * 2 <= width:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[:n], low[width - span : width - span + n])
    return (low[:n] & U((1 << PLACE_BITS) - 1)).astype(np.int64)
