"""Mixture-controlled packing by deficit round-robin over source queues.

The documents of a source, one after the other, are a queue of tokens.  In each
round every queue is credited its quantum - the window size times its target share - and
serves whole packets of its credit; what it could not serve stays as its deficit
for the next round.  The rounds' output, cut every ``window`` tokens, fills the
windows, so that each holds the target shares up to one packet per source.

A queue's credit after r rounds is r times its quantum, so what it has served
by then, and with it the place of every token, follows from the round number alone: no
partition waits for another one, and deficits carry over windows and partitions
exactly as in one long run.  A pass encodes the texts once and writes the ids; sums
per source and partition place each document in its queue; a second pass cuts it.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotbook.llm.common import unused, written
from slotbook.llm.word_ids import encoder, slices
from slotbook.llm.word_memory import give_back

SCALE = 1 << 16     # quanta are multiples of 1 / SCALE tokens
SMALL = 200_000     # (partition, source) rows that may be broadcast: some 10 MB


@dataclass(frozen=True)
class Packing:
    window: int = 4096
    packet: int = 64
    end_id: int = 2


def encoded(docs: DataFrame, path: str, packing: Packing, key: str, source: str, text: str) -> DataFrame:
    """(part, doc, queue, n, start, ids): each row's ids with its end id, the partition it was
    read in, and the tokens of its source before it in that partition."""
    end = np.array([packing.end_id], "<u4").tobytes()

    def encode(batches):
        give_back()
        part, queued = TaskContext.get().partitionId(), {}
        for b in batches:
            doc, queue, texts = b.column(0), b.column(1).to_pylist(), b.column(2)
            for i, z in slices(texts):
                ids = [x + end for x in encoder(path).encode(texts.slice(i, z - i))]
                n = [len(x) // 4 for x in ids]
                starts = []
                for q, k in zip(queue[i:z], n, strict=True):
                    starts.append(queued.get(q, 0))
                    queued[q] = starts[-1] + k
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(ids), pa.int64()), doc.slice(i, len(ids)).cast(pa.int64()),
                    pa.array(queue[i:z], pa.string()), pa.array(n, pa.int64()),
                    pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
                    names=["part", "doc", "queue", "n", "start", "ids"])

    return docs.select(F.col(key).cast("long").alias("doc"),
                       F.coalesce(F.col(source).cast("string"), F.lit("")).alias("queue"),
                       F.col(text).cast("string").alias("text")).mapInArrow(
        encode, "part long, doc long, queue string, n long, start long, ids binary")


class Rounds:
    """Places of tokens in the output of all rounds, for queues of given sizes."""

    def __init__(self, sizes: list[int], weights: list[float] | None, packing: Packing):
        self.size = np.array(sizes, np.int64)
        total = int(self.size.sum())
        share = np.array(weights, float) / sum(weights) if weights else self.size / max(total, 1)
        self.quantum = np.maximum(np.round(share * packing.window * SCALE), 1).astype(np.int64)
        self.packet = packing.packet

    def served(self, r: np.ndarray) -> np.ndarray:
        """[round, queue]: tokens served before round r: whole packets, and the last
        packet, which may be short, once the credit covers the queue."""
        credit = np.asarray(r, np.int64)[:, None] * self.quantum[None, :] // SCALE
        return np.where(credit >= self.size[None, :], self.size[None, :], credit // self.packet * self.packet)

    def cuts(self, k: int, a: int, n: int, window: int) -> tuple[np.ndarray, ...]:
        """(start in the document, length, place in the output) of the pieces of one document."""
        return self.cuts_of(k, np.array([a], np.int64), np.array([n], np.int64), window)[1:]

    def cuts_of(self, k: int, a: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
        """(which, start in the document, length, place in the output) of the pieces of documents
        that hold tokens a to a+n-1 of queue k, in order."""
        # the rounds that serve them: those in which the credit reaches the ends of their packets
        low = a // self.packet
        doc, nth = _each((a + n - 1) // self.packet - low + 1)
        credit = np.minimum((low[doc] + nth + 1) * self.packet, self.size[k]) * SCALE
        r = -(-credit // self.quantum[k]) - 1
        new = _starts(doc, r)
        doc, r = doc[new], r[new]
        s, t = self.served(r), self.served(r + 1)
        from_, to = np.maximum(s[:, k], a[doc]), np.minimum(t[:, k], (a + n)[doc])
        place = s.sum(1) + (t[:, :k] - s[:, :k]).sum(1) + (from_ - s[:, k])
        some = to > from_
        doc, from_, to, place = doc[some], from_[some], to[some], place[some]
        # neighbours that also follow one another in the output are one piece
        at = np.flatnonzero(_starts(doc, place - from_))
        last = np.append(at[1:], len(doc)) - 1
        doc, from_, place, length = doc[at], from_[at], place[at], to[last] - from_[at]
        # cut at the ends of windows
        which, nth = _each((place + length - 1) // window - place // window + 1)
        begin = np.maximum(place[which], (place[which] // window + nth) * window)
        end = np.minimum(place[which] + length[which], (place[which] // window + nth + 1) * window)
        return doc[which], (from_ - a[doc] - place)[which] + begin, end - begin, begin


def _each(many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, nth): ``many`` of each."""
    which = np.repeat(np.arange(len(many)), many)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where any column differs from the row before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def tail_sequences(total: int, window: int) -> tuple[int, np.ndarray]:
    """Where the last, partly filled window starts, and the ends of the sequences it is
    split into: powers of two, largest first, which need no padding."""
    start = total // window * window
    rest, ends = total - start, []
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            ends.append((ends[-1] if ends else start) + (1 << bit))
    return start, np.array(ends, np.int64)


def _cutter(queues: list[str], rounds: Rounds, packing: Packing, with_ids: bool):
    number = {q: i for i, q in enumerate(queues)}
    window = packing.window
    tail, ends = tail_sequences(int(rounds.size.sum()), window)
    # the ends of all sequences from the last whole window on
    limits = np.concatenate([[tail], ends]).astype(np.int64)

    def pieces(k: int, a: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        which, start, length, place = rounds.cuts_of(k, a, n, window)
        j = np.searchsorted(limits, place, "right") - 1
        in_tail = np.flatnonzero(j >= 0)
        if len(in_tail):      # at most a window's tokens, cut again at the ends of their sequences
            last = np.searchsorted(limits, place + length, "left") - 1
            many = np.ones(len(place), np.int64)
            many[in_tail] += (last - j)[in_tail]
            piece, nth = _each(many)
            begin = np.where(nth > 0, limits[np.maximum(j[piece] + nth, 0)], place[piece])
            end = place[piece] + length[piece]
            end = np.where(nth + 1 < many[piece], limits[np.minimum(j[piece] + nth + 1, len(limits) - 1)], end)
            which, start = which[piece], start[piece] + (begin - place[piece])
            length, place, j = end - begin, begin, j[piece] + nth
        seq = np.where(j >= 0, tail // window + j, place // window)
        return which, start, length, seq, place - np.where(j >= 0, limits[np.maximum(j, 0)], place // window * window)

    def cut(batches):
        for b in batches:
            doc, n, ids = b.column(0), b.column(2).to_numpy(), b.column(5)
            a = b.column(3).to_numpy() + b.column(4).to_numpy()
            queue = np.array([number[q] for q in b.column(1).to_pylist()], np.int64)
            step = max(1, min(1 << 14, (1 << 20) // len(queues)))     # packets at a time, each beside all queues
            for k in np.unique(queue).tolist():
                rows = np.flatnonzero(queue == k)
                # as many rows as have some ``step`` packets, or one row
                group = np.cumsum(n[rows] // packing.packet + 2) // step
                for some in np.split(rows, np.flatnonzero(np.diff(group)) + 1):
                    which, start, length, seq, off = pieces(k, a[some], n[some])
                    text = [ids[i].as_buffer() for i in some.tolist()]
                    parts = [memoryview(text[w])[4 * s:4 * (s + m)] for w, s, m in zip(
                        which.tolist(), start.tolist(), length.tolist(), strict=True)]
                    columns = [doc.take(pa.array(some[which])), *(pa.array(c, pa.int64()) for c in (
                        start, length, [zlib.crc32(p) for p in parts], n[some][which], seq, off))]
                    if with_ids:
                        columns.append(pa.array([bytes(p) for p in parts], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=NAMES + ["ids"] * with_ids)
    return cut


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = [c.split()[0] for c in PIECES.split(", ")]


def pack(docs: DataFrame, path: str, packing: Packing = Packing(), weights: dict[str, float] | None = None,
         key: str = "doc_id", source: str = "source", text: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of all rows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    Every row is packed, repeated rows each on their own; null or empty text is its end id
    alone, a null source a queue of its own (''), a null key stays null.  ``weights`` gives target
    shares by source (default: the sources' shares of all tokens); a source it lacks gets the
    smallest quantum.  The last window is split into sequences of powers of two.  Other columns
    are ignored.  An empty table gives no pieces.  The driver gathers one number per source.
    """
    tokens = written(encoded(docs, path, packing, key, source, text), "packed-ids")
    sums = tokens.groupBy("part", "queue").agg(F.sum("n").alias("tokens"))
    bases = written(sums.select("part", "queue", "tokens", (F.sum("tokens").over(
        Window.partitionBy("queue").orderBy("part")) - F.col("tokens")).alias("base")), "packed-bases")
    sizes = {r["queue"]: r["n"] for r in bases.groupBy("queue").agg(F.sum("tokens").alias("n")).collect()}
    queues = sorted(sizes)
    rounds = Rounds([sizes[q] for q in queues],
                    [max(weights.get(q, 0.0), 0.0) for q in queues] if weights else None, packing)
    places = bases.select("part", "queue", "base")
    if bases.count() <= SMALL:
        places = F.broadcast(places)
    return tokens.join(places, ["part", "queue"]).select("doc", "queue", "n", "start", "base", "ids").mapInArrow(
        _cutter(queues, rounds, packing, with_ids), PIECES + ", ids binary" * with_ids)
