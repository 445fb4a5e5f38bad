"""What a worker keeps of the words it has encoded: bounded in bytes, for all encoders together.

Two generations: words are looked up in the younger, those found in the older one move over,
and when the younger has its share of bytes it becomes the older and the one before goes.  So
frequent words stay, and a text of new words never throws everything away.  Workers are reused by
later stages; when another encoder begins, or work that encodes nothing (``release``), words and encoder are
dropped and their memory goes back to the system.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from typing import Any

import pyarrow as pa

BYTES = 128 << 20      # of both generations, by an estimate of what an entry takes
ENTRY = 180            # bytes of an entry besides its key and value
_active: list[WordMemory] = []
_encoders: dict[str, Any] = {}


class _Words(dict):
    """Values by word; words that are not there are listed and have none."""
    __slots__ = ("missed",)

    def __missing__(self, word: bytes) -> None:
        self.missed.append(word)


def kept_encoder(path: str, make: Callable[[str], Any]) -> Any:
    """One encoder for each Python worker, until another vocabulary file is asked for or ``release``."""
    if path not in _encoders:
        release()
        _encoders[path] = make(path)
    return _encoders[path]


def release() -> None:
    """Drop all words and encoders: for work in the same workers that encodes nothing."""
    if _active or _encoders:
        for memory in _active:
            memory.clear()
        _active.clear()
        _encoders.clear()
        give_back()


def give_back() -> None:
    """Return memory that earlier work in this worker has freed to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc alone has it
    if trim:
        trim(0)


class WordMemory:
    def __init__(self, learn: Callable[[set[bytes]], dict[bytes, bytes]], size: int = BYTES):
        """``learn``: the values of words that are not known."""
        self.learn, self.size = learn, size
        self.clear()

    def clear(self) -> None:
        self.young, self.old, self.used = _Words(), {}, 0

    def _begin(self) -> None:
        if _active[:1] != [self]:
            for other in _active:
                other.clear()
            _active[:] = [self]
        if self.used > self.size // 2:
            self.old, self.young, self.used = self.young, _Words(), 0

    def values(self, texts: list[list[bytes]]) -> list[list[bytes]]:
        """The values of the words of each text, in order.  Texts are looked up first, and only what
        they miss is learnt."""
        self._begin()
        young = self.young
        young.missed = missed = []
        get, out, short = young.__getitem__, [], []
        for i, words in enumerate(texts):
            before = len(missed)
            out.append(list(map(get, words)))
            if len(missed) > before:
                short.append(i)
        if short:
            self._add(set(missed))
            for i in short:
                out[i] = list(map(get, texts[i]))
        return out

    def once(self, words: list[bytes]) -> list[bytes]:
        """The values of different words, in order."""
        self._begin()
        young = self.young
        young.missed = missed = []
        out = list(map(young.__getitem__, words))
        if missed:
            self._add(set(missed))
            more = map(young.__getitem__, missed)
            out = [next(more) if x is None else x for x in out]
        return out

    def known(self, word: bytes) -> bytes | None:
        """The value of a word, if it is kept."""
        found = self.young.get(word)
        return self.old.get(word) if found is None else found

    def _add(self, new: set[bytes]) -> None:
        """Bring words that the younger generation lacks into it."""
        # asked word by word: the older generation is much larger than what is new
        known = {w: self.old[w] for w in filter(self.old.__contains__, new)}
        new.difference_update(known)
        for some in (known, self.learn(new) if new else {}):
            self.young.update(some)
            self.used += sum(map(len, some)) + sum(map(len, some.values())) + ENTRY * len(some)
