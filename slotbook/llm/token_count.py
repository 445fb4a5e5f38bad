"""Token counts of whole texts, huge ones by overlap resynchronisation.

Texts up to ``HUGE`` characters are encoded in one go.  A longer one is cut
into pieces that overlap, pieces are encoded in parallel with offsets, and
neighbours are spliced at a common boundary inside their overlap: a place after
white space where both encodings start a token and agree on the ids up to the
next such place.  White space ends every word of the tokenizer, so neither
piece's cut can reach past it: the boundary is proven stable.  Where an overlap
has no such place, the document is cut again with overlaps four times as wide,
until it aligns or is one piece.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotbook.llm.common import unused, written
from slotbook.llm.word_ids import encoder, slices

HUGE = 1 << 16       # characters that are encoded in one go
STEP = 1 << 15       # characters between the starts of two pieces
OVERLAP = 512        # characters that two pieces share at first
EDGE = "array<struct<pos:long,before:long,sig:long>>"
EDGE_ARROW = pa.list_(pa.struct([("pos", pa.int64()), ("before", pa.int64()), ("sig", pa.int64())]))


@dataclass(frozen=True)
class Cutting:
    huge: int = HUGE
    step: int = STEP
    overlap: int = OVERLAP


def id_counts(text: Column, path: str) -> Column:
    """Number of ids of each text (null: 0)."""
    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        return pa.array([len(i) // 4 for a, b in slices(column)
                         for i in encoder(path).encode(column.slice(a, b - a))], pa.int64())

    return count(text)


def pieces_of(text: str, step: int, overlap: int) -> list[tuple[int, int, str]]:
    """(number, start, text) of the pieces; each reaches ``overlap`` into the next."""
    starts = range(0, max(len(text) - overlap, 1), step)
    last = len(starts) - 1
    return [(k, a, text[a:] if k == last else text[a:a + step + overlap]) for k, a in enumerate(starts)]


def boundaries(text: str, ids: np.ndarray, starts: np.ndarray, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """(place, tokens before it, checksum of the ids up to the next place) of the
    word starts in text[lo:hi] at which a token starts."""
    at = [p for p in range(max(lo, 1), min(hi, len(text)))
          if text[p - 1] in " \t\n\r" and not text[p].isspace()]
    before = np.searchsorted(starts, at, "left")
    held = [(p, int(b)) for p, b in zip(at, before, strict=True) if b < len(starts) and starts[b] == p]
    return [(p, b, zlib.crc32(ids[b:held[i + 1][1]].tobytes())) for i, (p, b) in enumerate(held[:-1])]


def _cut(step: int):
    def cut(batches):
        for b in batches:
            for uid, overlap, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = pieces_of(text, step, overlap)
                for i in range(0, len(found), 64):
                    some = found[i:i + 64]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([uid] * len(some), pa.int64()), pa.array([k for k, _, _ in some], pa.int64()),
                        pa.array([len(found)] * len(some), pa.int64()), pa.array([a for _, a, _ in some], pa.int64()),
                        pa.array([overlap] * len(some), pa.int64()), pa.array([t for _, _, t in some], pa.string())],
                        names=["uid", "k", "n", "start", "overlap", "piece"])
    return cut


def _encode(path: str, step: int):
    def encode(batches):
        tokenizer = encoder(path).tokenizer
        for b in batches:
            rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            out = []
            for uid, k, n, start, overlap, text in rows:
                e = tokenizer.encode(text, add_special_tokens=False)
                ids = np.array(e.ids, "<u4")
                starts = np.array([o[0] for o in e.offsets], np.int64)
                left = boundaries(text, ids, starts, 0, overlap) if k else []
                right = boundaries(text, ids, starts, step, len(text)) if k < n - 1 else []
                out.append((uid, k, n, len(ids), *([{"pos": p + start, "before": c, "sig": s} for p, c, s in x]
                                                   for x in (left, right))))
            cols = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(
                    cols, [pa.int64()] * 4 + [EDGE_ARROW] * 2, strict=True)],
                names=["uid", "k", "n", "tokens", "lefts", "rights"])
    return encode


def _spliced(edges: DataFrame) -> DataFrame:
    """(uid, n_tokens): null where two neighbours have no common boundary."""
    a, b = edges.alias("a"), edges.alias("b")
    pairs = a.join(b, (F.col("a.uid") == F.col("b.uid")) & (F.col("a.k") + 1 == F.col("b.k")), "left")
    # the first boundary that both list with the same ids behind it
    common = F.array_min(F.transform(
        F.filter("a.rights", lambda r: F.exists("b.lefts", lambda x: (x["pos"] == r["pos"]) & (x["sig"] == r["sig"]))),
        lambda r: F.struct(r["pos"].alias("pos"), (r["before"] - F.element_at(
            F.filter("b.lefts", lambda x: x["pos"] == r["pos"]), 1)["before"]).alias("gain"))))
    part = F.when(F.col("a.k") == F.col("a.n") - 1, F.col("a.tokens")).otherwise(
        F.when(F.size("a.rights") * F.size("b.lefts") > 0, common["gain"]))
    return pairs.select(F.col("a.uid").alias("uid"), part.alias("part")).groupBy("uid").agg(
        F.when(F.count("*") == F.count("part"), F.sum("part")).alias("n_tokens"))


def huge_counts(huge: DataFrame, path: str, cutting: Cutting) -> DataFrame:
    """(uid, n_tokens) of rows (uid, text): pieces in parallel, spliced by a join."""
    spark = huge.sparkSession
    todo = huge.select("uid", F.lit(cutting.overlap).cast("long").alias("overlap"), "text")
    done: DataFrame | None = None
    overlap = cutting.overlap
    while True:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        edges = (todo.mapInArrow(_cut(cutting.step), "uid long, k long, n long, start long, overlap long, piece string")
                 .repartition(n, "uid", "k")
                 .mapInArrow(_encode(path, cutting.step),
                             f"uid long, k long, n long, tokens long, lefts {EDGE}, rights {EDGE}"))
        counts = written(_spliced(edges), "token-splices")
        fine = counts.filter("n_tokens IS NOT NULL")
        done = fine if done is None else done.unionByName(fine)
        failed = counts.filter("n_tokens IS NULL")
        if failed.isEmpty():
            return done
        overlap *= 4
        todo = (huge.join(failed.select("uid"), "uid", "left_semi")
                .select("uid", F.lit(overlap).cast("long").alias("overlap"), "text"))


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens",
                 cutting: Cutting = Cutting()) -> DataFrame:
    """Add ``out``: the number of ids of each text (null and empty: 0).

    Every input row and column is kept (a column named ``out`` is replaced); repeated
    rows are counted each on their own.  An empty table gives an empty one.
    """
    cols = [c for c in docs.columns if c != out]
    length = F.coalesce(F.length(F.col(text)), F.lit(0))
    short = docs.filter(length <= cutting.huge).select(
        *(F.col(f"`{c}`") for c in cols), id_counts(F.col(text), path).alias(out))
    uid = unused([*docs.columns, out], "uid")
    # numbered once and written: the join below meets the same numbers again
    huge = written(docs.filter(length > cutting.huge).select(
        *(F.col(f"`{c}`") for c in cols), F.monotonically_increasing_id().alias(uid)), "huge-texts")
    counts = huge_counts(huge.select(F.col(uid).alias("uid"), F.col(text).alias("text")), path, cutting)
    long = huge.join(counts.select(F.col("uid").alias(uid), F.col("n_tokens").alias(unused(cols, "counted"))), uid)
    return short.unionByName(long.select(
        *(F.col(f"`{c}`") for c in cols), F.col(unused(cols, "counted")).alias(out)))
