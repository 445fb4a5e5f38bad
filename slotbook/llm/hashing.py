"""64-bit hashes of all words of many texts at once.

A word's hash is taken from prefix sums of a polynomial over the bytes (modulo
2**64, with a mixed value per byte), divided by the power of its place, and mixed
with its length: a few array operations per text instead of one call per word.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
BASE = np.uint64(_BASE)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def separators(kept) -> np.ndarray:
    """A table of bytes, true for those that ``kept`` (byte -> bool) does not keep."""
    return np.array([not kept(b) for b in range(256)])


SPACES = separators(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: letters, digits and all bytes outside ASCII make words; punctuation parts them
PUNCTUATION = separators(lambda b: b >= 0x80 or chr(b).isalnum())


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 21)
        for name, b in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def words_of(texts: list[bytes], apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, number of words up to the end of each text)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    up, down = _powers(len(data))
    outside = np.ones(len(data) + 2, bool)
    outside[1:-1] = apart[data]
    edge = np.flatnonzero(outside[1:] != outside[:-1])
    first, last = edge[::2], edge[1::2]              # words are data[first:last]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64)])
    words = mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return words, np.searchsorted(first, np.cumsum([len(t) + 1 for t in texts]))


def word_hashes(texts: list[bytes], apart: np.ndarray) -> list[np.ndarray]:
    words, upto = words_of(texts, apart)
    return np.split(words, upto[:-1]) if texts else []
