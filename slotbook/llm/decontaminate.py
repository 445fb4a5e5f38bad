"""Benchmark decontamination by latent semantic retrieval.

Texts are seen as overlapping passages of ``size`` words.  A passage is a TF-IDF vector: word weights come from document frequencies counted over the whole corpus
(in a fixed number of hash buckets).  A randomised SVD, computed in parallel over
the passages of the benchmark and of all documents, gives the latent space of the
benchmark's words.

Every passage of every document whose surroundings could hold enough of an item's words in
any order is then projected, and its latent cosine with all items' passages taken.  That bound is exact:
a leak misses at most a known number of an item's words, so it holds some of any larger number
of them, and the item's rarest are looked for.  No share of plain weight is asked for, as
rare words put in place of an item's own take most of it.  Items much shorter than a
passage are searched with passages of half the words, or a quarter, and so on.  Every passage found for
an item is checked on the words themselves: the longest common
subsequence of item and surroundings, and for paraphrases, which keep less of
the order, also the words of the item's answer - its last sentence.  Surroundings that
overlap are checked as one stretch first, which bounds what each of them can hold.

The benchmark is the query set; it is taken in blocks of a fixed number of items.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotbook.llm.common import written
from slotbook.llm.hashing import PUNCTUATION, words_of
from slotbook.llm.word_ids import slices
from slotbook.llm.word_memory import release

BUCKET_BITS = 16
CELLS = 1 << 24      # pairs of words held as an array by a task
ROWS = 256
PARTS = (8, 1)       # passages looked at together, first and once more
LEAK = pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64()),
                  ("answer", pa.float64())])
LEAKS_DDL = "array<struct<item_id:long,cosine:double,lcs:double,answer:double>>"


@dataclass(frozen=True)
class LeakRules:
    """Words of a passage; latent dimensions; latent cosine from which a passage is a candidate; share of the item's words
    that must follow one another (``copied``), or that must do so when the share ``answered`` of
    its answer is there too; items of a block."""
    size: int = 16
    dimensions: int = 128
    cosine: float = 0.5
    copied: float = 0.7
    paraphrased: float = 0.5
    answered: float = 0.8
    block: int = 2000


def _bytes(texts: list[str | None]) -> list[bytes]:
    return [(t or "").lower().encode("utf-8", "replace") for t in texts]


def _texts(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts, some megabytes at a time: no more of a batch is held as Python objects."""
    for a, z in slices(column):
        yield _bytes(column.slice(a, z - a).to_pylist())


def _different(keys: np.ndarray) -> np.ndarray:
    """The different keys, in order: by a sort, which numpy does several times as fast as its table of hashes."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def buckets(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _count(batches):
    """Document frequencies by bucket."""
    release()
    df = np.zeros(1 << BUCKET_BITS, np.int64)
    for b in batches:
        for data in _texts(b.column(0)):
            words, upto = words_of(data, PUNCTUATION)
            of = np.repeat(np.arange(len(data)), np.diff(upto, prepend=0))
            # distinct (document, bucket) pairs, one count each
            pair = _different(of << BUCKET_BITS | buckets(words))
            df += np.bincount(pair & ((1 << BUCKET_BITS) - 1), minlength=1 << BUCKET_BITS)
    at = np.flatnonzero(df)
    for i in range(0, len(at), 1 << 14):
        some = at[i:i + (1 << 14)]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["bucket", "df"])


def passages(n: np.ndarray, size: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, first word) of the passages of texts of n words, ``step`` apart; a
    text's last passage ends with it."""
    many = np.where(n > 0, -(-np.maximum(n - size, 0) // step) + 1, 0)
    text = np.repeat(np.arange(len(n)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    return text, np.minimum(nth * step, np.maximum(n[text] - size, 0))


def passage_size(words: int, size: int) -> int:
    """Words of a passage for an item of so many words: halved until the item fills three quarters of it."""
    while size > 1 and 4 * words < 3 * size:
        size //= 2
    return size


class Fit:
    """What the passes over the fit's passages need: word weights and the vocabulary."""

    def __init__(self, idf: np.ndarray, vocabulary: np.ndarray, size: int):
        self.idf, self.vocabulary, self.size = idf, vocabulary, size
        self.held = np.zeros(len(idf), bool)
        self.held[buckets(vocabulary)] = True

    def index(self, words: np.ndarray) -> np.ndarray:
        """Place of each word in the vocabulary, -1 for others."""
        out = np.full(len(words), -1, np.int64)
        some = np.flatnonzero(self.held[buckets(words)])
        if len(some) and len(self.vocabulary):
            at = np.minimum(np.searchsorted(self.vocabulary, words[some]), len(self.vocabulary) - 1)
            hit = self.vocabulary[at] == words[some]
            out[some[hit]] = at[hit]
        return out

    def rows(self, words: np.ndarray, size: int = 0) -> np.ndarray:
        """Unit TF-IDF vectors over the vocabulary, one for each passage of a text; the norm counts all words."""
        weight, at, size = self.idf[buckets(words)], self.index(words), size or self.size
        start = passages(np.array([len(words)]), size, max(size // 2, 1))[1]
        out = np.zeros((len(start), len(self.vocabulary)), np.float32)
        for row, a in zip(out, start.tolist(), strict=True):
            b = a + size
            some = at[a:b] >= 0
            np.add.at(row, at[a:b][some], weight[a:b][some])
            row /= max(np.sqrt((weight[a:b] ** 2).sum()), 1e-9)
        return out


class Pairs:
    """Sums by pair of words, (smaller, larger) number, of which ``times`` takes the product with a
    narrow matrix.  All cells are held while they are few; else pairs, and their product when they are many."""

    def __init__(self, omega: np.ndarray):
        self.omega, self.n = omega.astype(np.float64), len(omega)
        self.total = np.zeros(omega.shape)
        self.cells = np.zeros(self.n * self.n) if self.n * self.n <= CELLS else None
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.many = 0

    def add(self, v: np.ndarray, u: np.ndarray, x: np.ndarray) -> None:
        key = np.minimum(v, u) * self.n + np.maximum(v, u)
        if self.cells is not None:
            np.add.at(self.cells, key, x)
            return
        self.held.append((key, x))
        self.many += len(key)
        if self.many > CELLS // 2:
            self._reduce()
            if self.many > CELLS // 4:
                self._multiply()

    def _reduce(self) -> None:
        if self.held:
            key, at = np.unique(np.concatenate([k for k, _ in self.held]), return_inverse=True)
            self.held = [(key, np.bincount(at, np.concatenate([x for _, x in self.held]), len(key)))]
            self.many = len(key)

    def _multiply(self) -> None:
        """Add (P + P') * omega of the pairs held, some rows of P at a time."""
        for key, x in self.held:
            edges = np.searchsorted(key, np.arange(0, self.n + ROWS, ROWS) * self.n)
            for i, (a, z) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                rows = slice(i * ROWS, min((i + 1) * ROWS, self.n))
                some = np.zeros((rows.stop - rows.start, self.n))
                some.ravel()[key[a:z] - i * ROWS * self.n] = x[a:z]
                self.total[rows] += some @ self.omega
                self.total += some.T @ self.omega[rows]
        self.held, self.many = [], 0

    def times(self) -> np.ndarray:
        if self.cells is not None:
            cells = self.cells.reshape(self.n, self.n)
            for i in range(0, self.n, ROWS):         # the smaller number comes first: no cells before the diagonal
                some = cells[i:i + ROWS, i:]
                self.total[i:i + ROWS] += some @ self.omega[i:]
                self.total[i:] += some.T @ self.omega[i:i + ROWS]
            return self.total
        self._reduce()
        self._multiply()
        return self.total


def _together(fit: Fit, omega: np.ndarray):
    """One row per partition and some words: its passages' X'X * omega, X their unit TF-IDF vectors.

    X'X is summed over the pairs of known words less than a passage apart: the weights of both, over the
    squared norms of the passages that hold both, which are running sums over the passages' starts."""
    size = fit.size

    def sums(batches):
        release()
        pairs = Pairs(omega)
        for b in batches:
            for data in _texts(b.column(0)):
                words, upto = words_of(data, PUNCTUATION)
                weight, at = fit.idf[buckets(words)], fit.index(words)
                begin = np.concatenate([[0], upto[:-1]])
                text, start = passages(upto - begin, size, max(size // 2, 1))
                start = begin[text] + start
                mass = np.concatenate([[0.0], np.cumsum(weight ** 2)])
                norm = mass[np.minimum(start + size, upto[text])] - mass[start]
                upon = np.concatenate([[0.0], np.cumsum(1 / np.maximum(norm, 1e-18))])
                place = np.flatnonzero(at >= 0)
                first, last = (np.repeat(x, upto - begin)[place] for x in (begin, upto))
                below = np.concatenate([[0], np.cumsum(np.bincount(start, minlength=len(words)))])   # starts before a place
                until = upon[below[place + 1]]
                before = upon[below[np.maximum(place - size + 1, first)]]
                word, heavy = at[place], weight[place]
                pairs.add(word, word, (until - before) * heavy ** 2 / 2)
                near, last = np.arange(len(place)), np.minimum(place + size, last)
                for d in range(1, size):
                    # those with a d-th word after them less than a passage apart have one before it, too
                    near = near[:np.searchsorted(near, len(place) - d)]
                    near = near[place[near + d] < last[near]]
                    if not len(near):
                        break
                    far = near + d
                    pairs.add(word[near], word[far], np.maximum(until[near] - before[far], 0) * heavy[near] * heavy[far])
        total = pairs.times()
        for i in range(0, len(total), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([total[i:i + ROWS].tobytes()], pa.binary())],
                                             names=["row", "part"])
    return sums


def _added(batches):
    """The sums of the parts, by their first row."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for i, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            x = np.frombuffer(part)
            total[i] = total[i] + x if i in total else x
    for i, x in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([x.tobytes()], pa.binary())], names=["row", "part"])


def randomised_svd(texts: DataFrame, fit: Fit, dimensions: int) -> np.ndarray:
    """Right singular vectors (words x dimensions) of the TF-IDF passages of ``texts``.

    Range finding with a random projection: one pass gives S = X'X * omega, and with it the Gram matrix omega' * S of
    Y = X * omega; Y * root has orthonormal columns, and its product with X is root' * S'.  The driver gathers S.
    """
    n = len(fit.vocabulary)
    width = min(n, dimensions + 16)
    if not n:
        return np.zeros((0, 0), np.float32)
    omega = np.random.default_rng(7).standard_normal((n, width)).astype(np.float32)
    total = np.zeros((n, width))
    parts = texts.mapInArrow(_together(fit, omega), "row long, part binary")
    for r in parts.repartition(8, "row").mapInArrow(_added, "row long, part binary").toLocalIterator():
        x = np.frombuffer(r["part"]).reshape(-1, width)
        total[r["row"]:r["row"] + len(x)] = x
    gram = omega.T.astype(np.float64) @ total
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    keep = values > values.max(initial=0) * 1e-9
    if not keep.any():
        return np.zeros((n, 0), np.float32)
    space, _, _ = np.linalg.svd(total @ (vectors[:, keep] / np.sqrt(values[keep])), full_matrices=False)
    return np.ascontiguousarray(space[:, :dimensions].astype(np.float32))


@dataclass
class Item:
    item_id: int
    words: list[int]
    answer: set[int]

    def __post_init__(self):
        self.counts = Counter(self.words)
        self.places = places_of(self.words)


def telling(words: np.ndarray, rarity: np.ndarray, need: float) -> tuple[list[int], int]:
    """(places of rare words of an item, how many of them any text needs that holds
    ``need`` of the item's words).  ``words``: the item's different words' counts."""
    order = np.argsort(-rarity, kind="stable")
    counts = words[order]
    rest = counts.sum() - np.cumsum(counts)
    for least in (5, 3, 2, 1):
        # with fewer than ``least`` of the first n, a text holds the rest and the most frequent of them at most
        for n in range(least, len(counts) + 1):
            if rest[n - 1] + np.sort(counts[:n])[::-1][:least - 1].sum() < need - 1e-9:
                return order[:n].tolist(), least
    return order.tolist(), 0


class Index:
    """A block of items: their latent passages, and their words for the checks."""

    def __init__(self, items: list[tuple[int, str]], fit: Fit, space: np.ndarray, rules: LeakRules):
        self.fit, self.space, self.rules = fit, space, rules
        self.items: list[Item] = []
        rows: dict[int, list[np.ndarray]] = {}
        of: dict[int, list[int]] = {}
        pairs: list[tuple[int, int]] = []
        least: list[int] = []
        holds: list[tuple[np.ndarray, np.ndarray]] = []
        for item_id, text in items:
            words = words_of(_bytes([text]), PUNCTUATION)[0]
            if not len(words):
                continue
            last = [s for s in re.split(r"[.?!\n]+", text) if s.strip()][-1:]
            self.items.append(Item(item_id, words.tolist(), set(
                words_of(_bytes(last), PUNCTUATION)[0].tolist()) if last else set()))
            size = passage_size(len(words), rules.size)
            rows.setdefault(size, []).append(fit.rows(words, size))
            of.setdefault(size, []).extend([len(self.items) - 1] * len(rows[size][-1]))
            different, counts = np.unique(words, return_counts=True)
            rare, some = telling(counts, fit.idf[buckets(different)], self._need(len(words)))
            pairs += [(w, len(self.items) - 1) for w in fit.index(different[rare]).tolist()]
            least.append(some)
            holds.append((fit.index(different), counts))
        self.rows = {size: np.concatenate(x) for size, x in rows.items()}
        self.passages = {size: self._latent(x @ space).astype(np.float32) for size, x in self.rows.items()}
        self.of = {size: np.array(x, np.int64) for size, x in of.items()}
        self.wide = np.array([len(i.words) for i in self.items], np.int64)
        self.least = np.array(least, np.int64)
        # the different words of each item, as bits and as counts
        self.bits = np.zeros((len(holds), len(fit.vocabulary) // 8 + 1), np.uint8)
        for bits, (w, _) in zip(self.bits, holds, strict=True):
            np.bitwise_or.at(bits, w >> 3, (1 << (w & 7)).astype(np.uint8))
        self.held = np.concatenate([k * len(fit.vocabulary) + w for k, (w, _) in enumerate(holds)] or [np.zeros(0, np.int64)])
        self.times = np.concatenate([c for _, c in holds] or [np.zeros(0, np.int64)])
        pairs.sort()
        self.telling = np.array([k for _, k in pairs], np.int64)        # items by word
        self.upto = np.searchsorted(np.array([w for w, _ in pairs], np.int64), np.arange(len(fit.vocabulary) + 1))

    @staticmethod
    def _latent(p: np.ndarray) -> np.ndarray:
        return p / np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-9)

    def candidates(self, words: np.ndarray, upto: np.ndarray) -> dict[tuple[int, int], list[tuple[int, int, float]]]:
        """{(text number, item number): [(first word, word after the last, plain cosine)]} of all passages
        of the texts near to an item, in order; ``words`` and ``upto`` as from ``words_of``."""
        weight, at = self.fit.idf[buckets(words)].astype(np.float32), self.fit.index(words)
        mass = np.concatenate([[0.0], np.cumsum(weight.astype(np.float64) ** 2)])
        hits = self._hits(at)
        begin = np.concatenate([[0], upto[:-1]])
        found: dict[tuple[int, int], list[tuple[int, int, float]]] = {}
        for size in sorted(self.rows):
            text, start = passages(upto - begin, size, max(size // 4, 1))
            a = begin[text] + start
            b = np.minimum(a + size, upto[text])
            own = np.isin(hits[0], self.of[size])        # an item has passages of one size
            for x, y, k in self._near(tuple(h[own] for h in hits), weight, at, a, b, len(words), size):
                place = a[x, None] + np.arange(size)
                inside = place < b[x, None]
                place = np.where(inside, place, 0)
                inside &= at[place] >= 0
                plain = (self.rows[size][y[:, None], np.maximum(at[place], 0)] * weight[place] * inside).sum(1)
                plain /= np.sqrt(mass[b[x]] - mass[a[x]])
                order = np.lexsort((-plain, x, k))       # of an item's passages the nearest
                first = np.ones(len(order), bool)
                first[1:] = (np.diff(x[order]) != 0) | (np.diff(k[order]) != 0)
                for t, n, lo, hi, c in zip(*(v[order[first]].tolist() for v in (text[x], k, a[x], b[x], plain)), strict=True):
                    found.setdefault((t, n), []).append((lo, hi, c))
        return found

    def _need(self, n):
        """Least words that a leak holds of an item of n."""
        return min(self.rules.copied, self.rules.paraphrased) * n

    def _hits(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, first place, last place) of stretches that hold as many of an item's telling words as a leak needs."""
        place = np.flatnonzero(at >= 0)
        many = self.upto[at[place] + 1] - self.upto[at[place]]
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        item = self.telling[np.repeat(self.upto[at[place]], many) + nth]
        place = np.repeat(place, many)
        # numbers of 16 bits are dealt into their order rather than compared
        order = np.argsort(item.astype(np.uint16) if len(self.items) <= 1 << 16 else item, kind="stable")
        item, place = item[order], place[order]
        last = np.arange(len(item)) + np.maximum(self.least[item], 1) - 1
        ok = np.flatnonzero(last < len(item))
        ok = ok[item[last[ok]] == item[ok]]
        return item[ok], place[ok], place[last[ok]]

    def _reach(self, hits: tuple[np.ndarray, np.ndarray, np.ndarray], a: np.ndarray, n: int,
               size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, first, last + 1), by item and without overlap: the passages, which start at ``a``, that have
        such a stretch in their surroundings."""
        item, first, last = hits
        below = np.concatenate([[0], np.cumsum(np.bincount(a, minlength=n))])       # passages that start before a place
        low = below[np.maximum(last - self.wide[item] - size + 1, 0)]
        high = below[np.minimum(first + self.wide[item], n - 1) + 1]
        ok = low < high
        item, low, high = item[ok], low[ok], high[ok]
        if not len(item):
            return item, low, high
        # by item, then place: hits of one item come in order, so runs that meet are neighbours
        shift = item * (len(a) + 1)
        start = np.concatenate([[True], (low + shift)[1:] > np.maximum.accumulate(high + shift)[:-1]])
        run = np.flatnonzero(start)
        return item[run], low[run], np.maximum.reduceat(high, run)

    def _enough(self, at: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of the stretches that hold as many words of their item, in any order, as a leak needs."""
        is_known = at >= 0
        before = np.concatenate([[0], np.cumsum(is_known)])
        lo, hi = (before[np.clip(x, 0, len(at))] for x in (begin, end))
        out, known, n = [], at[is_known], len(self.fit.vocabulary)
        cuts = np.flatnonzero(np.diff(np.cumsum(hi - lo) >> 19)) + 1
        for some in np.split(np.arange(len(item)), cuts):
            many = (hi - lo)[some]
            run = np.repeat(np.arange(len(some)), many)
            word = known[np.arange(len(run)) + np.repeat(lo[some] - (np.cumsum(many) - many), many)]
            of = item[some][run]
            hit = np.flatnonzero(self.bits[of, word >> 3] >> (word & 7).astype(np.uint8) & 1)
            run, word = np.divmod(_different(run[hit] * n + word[hit]), n)
            counts = self.times[np.searchsorted(self.held, item[some][run] * n + word)]
            out.append(some[np.bincount(run, counts, len(some)) >= self._need(self.wide[item[some]]) - 1e-9])
        return np.concatenate(out)

    def _near(self, hits, weight: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray, n: int, size: int):
        """(passage, item's passage, item) of the latent neighbours, some at a time.  A passage is compared with the
        items that it reaches alone: for each item one product of its passages and of those that reach it."""
        item, low, high = self._reach(hits, a, n, size)
        for part in PARTS:
            if not len(item):
                return
            # long runs in parts, as only what lies near one another is one leak
            many = -(-(high - low) // part)
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            item, low, high = np.repeat(item, many), np.repeat(low, many) + nth * part, np.repeat(high, many)
            high = np.minimum(high, low + part)
            some = self._enough(at, item, a[low] - self.wide[item], b[high - 1] + self.wide[item])
            item, low, high = item[some], low[some], high[some]
        if not len(item):
            return
        marks = np.bincount(low, minlength=len(a) + 1)
        marks -= np.bincount(high, minlength=len(a) + 1)
        some = np.flatnonzero(np.cumsum(marks)[:-1] > 0)
        latent = np.concatenate([self._projected(weight, at, a[j], b[j]) for j in (
            some[i:i + 1024] for i in range(0, len(some), 1024))])
        row = np.zeros(len(a), np.int64)
        row[some] = np.arange(len(some))
        of = self.of[size]
        # one row for each item and passage
        many = high - low
        passage = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        item = np.repeat(item, many)
        runs = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        held, count = [], 0
        for lo, hi in zip(runs.tolist(), [*runs[1:].tolist(), len(item)], strict=True):
            k = int(item[lo])
            y0, y1 = np.searchsorted(of, [k, k + 1]).tolist()
            x = passage[lo:hi]
            i, j = np.nonzero(latent[row[x]] @ self.passages[size][y0:y1].T >= self.rules.cosine)
            if len(i):
                held.append((x[i], j + y0, np.full(len(i), k)))
                count += len(i)
            if count > 1 << 16:
                yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
                held, count = [], 0
        if held:
            yield tuple(np.concatenate(c) for c in zip(*held, strict=True))

    def _projected(self, weight: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Unit latent vectors of the passages words[a:b], in order: differences of running sums over
        the words of the benchmark that they hold; words between passages are left out."""
        lo = int(a[0])
        marks = np.bincount(a - lo, minlength=int(b.max()) - lo + 1) - np.bincount(b - lo)
        known = np.flatnonzero((np.cumsum(marks)[:-1] > 0) & (at[lo:lo + len(marks) - 1] >= 0))
        edges = _different(np.concatenate([a, b]))
        cut = np.searchsorted(known, edges - lo)
        known += lo
        parts = np.zeros((len(edges) - 1, self.space.shape[1]), np.float32)
        many = np.diff(cut)
        for j in range(many.max(initial=0)):             # the j-th word between two edges
            some = np.flatnonzero(many > j)
            word = known[cut[some] + j]
            parts[some] += self.space[at[word]] * weight[word, None]
        sums = np.concatenate([np.zeros((1, parts.shape[1])), np.cumsum(parts, axis=0, dtype=np.float64)])
        return self._latent(sums[np.searchsorted(edges, b)] - sums[np.searchsorted(edges, a)]).astype(np.float32)

    def leaks(self, data: list[bytes]) -> list[list[dict]]:
        """The items found in each text."""
        words, upto = words_of(data, PUNCTUATION)
        begin = np.concatenate([[0], upto[:-1]])
        found: list[list[dict]] = [[] for _ in data]
        for (t, k), spans in sorted(self.candidates(words, upto).items()):
            item = self.items[k]
            wide = len(item.words)
            around = [(max(int(begin[t]), lo - wide), min(int(upto[t]), hi + wide), cos) for lo, hi, cos in spans]
            best = max((x for stretch in _stretches(around) for x in self._checked(item, words, stretch)), default=None)
            if best:
                share, answer, cos = best
                found[t].append({"item_id": item.item_id, "cosine": round(cos, 4), "lcs": round(share, 4),
                                 "answer": round(answer, 4)})
        return found

    def _checked(self, item: Item, words: np.ndarray, stretch: list[tuple[int, int, float]]):
        """(lcs, answer, cosine) of the surroundings in a stretch that are leaks.  No part of
        a stretch holds more than the whole does, so most stretches are checked once."""
        def shares(a: int, b: int) -> tuple[float, float]:
            near = words[a:b].tolist()
            here = item.counts.keys() & set(near)
            if not self.is_leak(sum(map(item.counts.__getitem__, here)) / len(item.words), 1.0):
                return 0.0, 0.0
            return (common_length(item.places, len(item.words), near) / len(item.words),
                    len(item.answer.intersection(near)) / len(item.answer) if item.answer else 0.0)

        if len(stretch) > 1 and not self.is_leak(*shares(stretch[0][0], stretch[-1][1])):
            return
        for a, b, cos in stretch:
            share, answer = shares(a, b)
            if self.is_leak(share, answer):
                yield share, answer, cos

    def is_leak(self, share: float, answer: float) -> bool:
        r = self.rules
        return share >= r.copied or (share >= r.paraphrased and answer >= r.answered)


def _stretches(around: list[tuple[int, int, float]]) -> list[list[tuple[int, int, float]]]:
    """Surroundings, in order, grouped into runs that overlap."""
    out: list[list[tuple[int, int, float]]] = []
    for x in around:
        if out and x[0] < out[-1][-1][1]:
            out[-1].append(x)
        else:
            out.append([x])
    return out


def places_of(words: list[int]) -> dict[int, int]:
    """The places of each word as a set of bits."""
    places: dict[int, int] = {}
    for i, x in enumerate(words):
        places[x] = places.get(x, 0) | 1 << i
    return places


def common_length(places: dict[int, int], n: int, b: list[int]) -> int:
    """Length of the longest common subsequence of n words, given their places, and b, by bit-parallel rows; words
    that are not among the n change nothing."""
    full = v = (1 << n) - 1
    for m in filter(None, map(places.get, b)):
        u = v & m
        v = (v + u | v - u) & full
    return n - v.bit_count()


def lcs(a: list[int], b: list[int]) -> int:
    return common_length(places_of(a), len(a), b)


def indexes(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
            item_text: str = "text", rules: LeakRules = LeakRules()) -> Iterator[tuple[Index, bool]]:
    """A fitted index for each block of items, one after the other, and whether it is the last.  Gathers the items of
    a block, one count per bucket and one narrow matrix over the block's words; documents stay where they are."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    total = docs.count()
    counted = docs.select(body.alias("text")).mapInArrow(_count, "bucket long, df long")
    df = np.zeros(1 << BUCKET_BITS)
    for r in counted.groupBy("bucket").agg(F.sum("df").alias("df")).collect():
        df[r["bucket"]] = r["df"]
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0
    items = benchmark.select(F.col(item).cast("long").alias("i"), F.col(item_text).alias("t")).filter("t IS NOT NULL")
    blocks = -(-items.count() // rules.block)
    numbered = written(items.repartitionByRange(max(blocks, 1), "i"), "benchmark-items") if blocks > 1 else items
    for k in range(max(blocks, 1)):
        part = numbered.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k) if blocks > 1 else items
        rows = [(r["i"], r["t"]) for r in part.orderBy("i", "t").collect()]
        if not rows:
            continue
        vocabulary = np.unique(words_of(_bytes([t for _, t in rows]), PUNCTUATION)[0])
        fit = Fit(idf, vocabulary, rules.size)
        texts = docs.select(body.alias("text")).unionByName(part.select(F.col("t").alias("text")))
        yield Index(rows, fit, randomised_svd(texts, fit, rules.dimensions), rules), k == max(blocks, 1) - 1


def leaks_of(text: Column, sent: Broadcast) -> Column:
    """Array of (item_id, cosine, lcs, answer) of the items of one index found in each text."""
    @F.arrow_udf(LEAKS_DDL)
    def leaks(column: pa.Array) -> pa.Array:
        return pa.array([x for data in _texts(column) for x in sent.value.leaks(data)], pa.list_(LEAK))

    # searched once, also where a filter on what was found moves before the column
    return leaks.asNondeterministic()(text)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
               item_text: str = "text", rules: LeakRules = LeakRules(), out: str = "leaks") -> DataFrame:
    """Add ``out``: the benchmark items found in each row's text, in order of item id.

    Null and empty texts hold none, null items are left out, repeated rows are searched alike, and an empty
    benchmark or table gives empty arrays or no rows.  Every column is kept, but for one called ``out``.
    """
    cols = [F.col(f"`{c}`") for c in docs.columns if c != out]
    found = F.array().cast(LEAKS_DDL)
    rows = docs.select(*cols, found.alias(out))
    for index, last in indexes(docs, benchmark, text, item, item_text, rules):
        # an index is of a block's size, and one is held at a time: rows go through a table between blocks
        sent = docs.sparkSession.sparkContext.broadcast(index)
        more = F.concat(F.col(out), leaks_of(F.col(text), sent))
        rows = rows.select(*cols, F.array_sort(more, lambda x, y: F.when(
            x["item_id"] < y["item_id"], -1).when(x["item_id"] > y["item_id"], 1).otherwise(0)).alias(out))
        if not last:
            rows = written(rows, "leaks-so-far")
            sent.unpersist()
    return rows
