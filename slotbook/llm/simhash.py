"""Near-duplicates by SimHash, with Golay-code fuzzy hashing.

A fingerprint's 64 bits are cut into three segments of at most 23 bits.  Of at most
three differing bits, two of the three segments hold at most one each
(pigeonhole).  The binary Golay code of length 23 is perfect: every word lies within three
bits of just one of its 4,096 codewords, and a word one bit away lies within four bits
of that codeword.  So if one side's key is the nearest codeword of a segment and the other's
are all codewords within four bits (one, or six), words one bit apart share a key.
For each pair of segments one side widens the first segment and the other the second: some
five keys a side instead of twenty-eight, every link still met, and every meeting verified.

Equal fingerprints are one node.  Keys that hold many are never paired out: nodes are
linked with a few pivots of the key, linked nodes are merged, and only nodes of different
components that still meet are compared, in parts.
"""

from __future__ import annotations

from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotbook.llm.common import written
from slotbook.llm.graph import components

SHINGLE = 3
SEED = 42
SLICE = 1 << 16           # shingles hashed at a time
DISTANCE = 3
#: The Golay code's length and generator polynomial.
GOLAY_BITS, GOLAY_GENERATOR = 23, 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))     # first bit, bits
PAIRS = ((0, 1), (0, 2), (1, 2))
LIGHT = 128               # nodes of a key on one side that are met one by one
PIVOTS = 8                # nodes of a heavy key that all others of it are compared with, a round
WORK = 64                 # comparisons a row that the last step may take without another round
MAX_ROUNDS = 6


# -- fingerprints


def fingerprint(text: str | None) -> int:
    """The signed 64-bit SimHash of a text's three-word shingles; zero without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()    # both ASCII only
    if not words:
        return 0
    if len(words) < SHINGLE:
        grams = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
    total, ones = 0, np.zeros(64, np.int64)
    while some := [xxhash.xxh64_intdigest(g, SEED) for g in islice(grams, SLICE)]:
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
        total += len(some)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def simhash(text: Column) -> Column:
    def one_by_one(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py()) for t in texts], pa.int64())

    return F.arrow_udf(one_by_one, "long")(text.cast("string"))


def hex64(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


# -- Golay keys


class Golay:
    """Codeword indices near a word, from the word's syndrome."""

    def __init__(self):
        parity = GOLAY_BITS - 12
        #: remainder of each single bit; the code's words are those of remainder zero
        rest = []
        for i in range(GOLAY_BITS):
            r = 1 << i
            for j in range(GOLAY_BITS - 1, parity - 1, -1):
                if r >> j & 1:
                    r ^= GOLAY_GENERATOR << (j - parity)
            rest.append(r)
        table = np.zeros((3, 256), np.int32)          # remainders by byte
        for k in range(3):
            for b in range(256):
                for i in range(8):
                    if b >> i & 1 and 8 * k + i < GOLAY_BITS:
                        table[k, b] ^= rest[8 * k + i]
        self.table = table
        self.nearest = np.zeros(1 << parity, np.int32)
        errors = [sum(1 << i for i in c) for n in range(4) for c in combinations(range(GOLAY_BITS), n)]
        self.nearest[self.syndrome(np.array(errors))] = errors
        #: errors of weight four with the same remainder: at most five
        self.further = np.full((1 << parity, 5), -1, np.int32)
        filled = np.zeros(1 << parity, np.int32)
        for c in combinations(range(GOLAY_BITS), 4):
            e = sum(1 << i for i in c)
            s = int(self.syndrome(np.array([e]))[0])
            self.further[s, filled[s]] = e
            filled[s] += 1

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.table[0, words & 255] ^ self.table[1, words >> 8 & 255] ^ self.table[2, words >> 16]

    def keys(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n, 6) indices of the codewords within four bits, nearest first, and which of them there are."""
        s = self.syndrome(words)
        errors = np.concatenate([self.nearest[s][:, None], self.further[s]], axis=1)
        return (words[:, None] ^ errors) >> (GOLAY_BITS - 12), errors >= 0


_CODE: list[Golay] = []


def golay() -> Golay:
    if not _CODE:
        _CODE.append(Golay())
    return _CODE[0]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, index of the fingerprint, side) of all keys of both sides."""
    bits = prints.view(np.uint64)
    near = [golay().keys(((bits >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64)) for a, n in SEGMENTS]
    out = []
    for p, (i, j) in enumerate(PAIRS):
        (a, has_a), (b, has_b) = near[i], near[j]
        for side, wide, has, other, shift in ((0, a, has_a, b, 12), (1, b, has_b, a, 0)):
            row, col = np.nonzero(has)
            key = (wide[row, col].astype(np.int64) << shift) | (other[row, 0].astype(np.int64) << (12 - shift))
            out.append((key | p << 24, row, np.full(len(row), side, np.int8)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def golay_keys(nodes: DataFrame) -> DataFrame:
    """(key, side, fp) of distinct fingerprints ``fp``: those at most three bits apart meet in a key of
    side 0 and side 1, whichever of them has which."""
    def run(batches):
        for b in batches:
            prints = b.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(prints), 4096):
                some = prints[at:at + 4096]
                key, row, side = keys_of(np.ascontiguousarray(some))
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(side), pa.array(some[row])],
                                                 ["key", "side", "fp"])
    return nodes.select("fp").mapInArrow(run, "key int, side byte, fp long")


# -- links


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _meetings(rows: DataFrame, also: list[str] = ()) -> DataFrame:
    """(a, b) with a > b of nodes of both sides that share a key, verified."""
    left = rows.filter("side = 0").withColumnRenamed("fp", "a").drop("side")
    right = rows.filter("side = 1").withColumnRenamed("fp", "b").drop("side")
    return left.join(right, ["key", *also]).filter(F.col("a") > F.col("b")).filter(_near("a", "b"))


def _heavy_links(heavy: DataFrame, links: DataFrame) -> DataFrame:
    """All links that the components need of keys with many nodes, given the other links."""
    previous = None
    for turn in range(MAX_ROUNDS + 1):
        of = components(links)
        rows = written(heavy.join(of.withColumnsRenamed({"node": "fp", "component": "c"}), "fp", "left")
                       .withColumn("c", F.coalesce("c", "fp")), "heavy")
        by_part = rows.groupBy("key", "c").agg(F.count_if(F.col("side") == 0).alias("n0"),
                                               F.count_if(F.col("side") == 1).alias("n1"))
        by_key = written(by_part.groupBy("key").agg(
            F.sum("n0").alias("n0"), F.sum("n1").alias("n1"),
            (F.sum("n0") * F.sum("n1") - F.sum(F.col("n0") * F.col("n1"))).alias("work")).filter("work > 0"), "heavy-keys")
        totals = by_key.agg(F.sum("work").alias("work"), F.sum(F.col("n0") + F.col("n1")).alias("rows")).first()
        if not totals.work:
            return links
        rows = rows.join(by_key, "key")
        if totals.work <= WORK * totals.rows or turn == MAX_ROUNDS or (previous and totals.work > previous // 2):
            break
        previous = totals.work
        # round: every node is compared with a few pivots of its keys
        h = F.xxhash64("fp", F.lit(turn))
        pivots = (rows.filter("side = 0").groupBy("key", F.pmod(h, F.lit(PIVOTS)).alias("slot"))
                  .agg(F.min_by(F.struct("fp", "c"), h).alias("p")).select("key", "p.fp", "p.c"))
        met = (rows.filter("side = 1").select("key", F.col("fp").alias("b"), F.col("c").alias("d"))
               .join(pivots.withColumnRenamed("fp", "a"), "key").filter("c <> d").filter(_near("a", "b")))
        links = written(links.unionByName(met.select("a", "b").distinct()), "links")
    # what is left: nodes of different components, one side of a key in parts, the other met with each part
    parts = F.ceil(F.col("n0") / LIGHT).cast("int")
    dealt = rows.filter("side = 0").select("key", F.pmod(F.xxhash64("fp"), parts).cast("int").alias("part"),
                                           F.col("fp").alias("a"), "c")
    other = rows.filter("side = 1").select("key", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
                                           F.col("fp").alias("b"), F.col("c").alias("d"))
    last = dealt.join(other, ["key", "part"]).filter("c <> d").filter(_near("a", "b"))
    return links.unionByName(last.select("a", "b").distinct())


def near_links(nodes: DataFrame) -> DataFrame:
    """(a, b), a > b: links that connect all fingerprints ``fp`` (distinct) which chains of at most
    three bits a step connect.  Between nodes of light keys every link is returned."""
    rows = golay_keys(nodes)
    sizes = rows.groupBy("key").agg(F.count_if(F.col("side") == 0).alias("n0"), F.count_if(F.col("side") == 1).alias("n1"))
    heavy_keys = written(sizes.filter((F.col("n0") > LIGHT) & (F.col("n1") > LIGHT)).select("key"), "heavy-keys")
    if heavy_keys.isEmpty():
        return _meetings(rows).select("a", "b").distinct()
    light = written(_meetings(rows.join(heavy_keys, "key", "left_anti")).select("a", "b").distinct(), "light-links")
    heavy = written(rows.join(heavy_keys, "key", "left_semi"), "heavy-rows")
    return _heavy_links(heavy, light)


def simhash_components(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, fp, component) of every row: its fingerprint (a signed long, see ``hex64``) and the smallest
    doc whose fingerprint is reached by steps of at most three bits.

    A null or empty text, or one without words, has fingerprint zero and is linked like any other; very long texts
    are read whole, hashed in slices.  Rows with the same doc or text each give one row.  A null doc
    stays null and is never the smallest one unless its class has no other.  Other columns are
    ignored, whatever their names; an empty table gives none.
    """
    prints = written(docs.select(F.col(doc).alias("doc"), simhash(F.col(text)).alias("fp")), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc").alias("least")), "nodes")
    linked = components(near_links(nodes))
    classes = (nodes.join(linked.withColumnRenamed("node", "fp"), "fp")
               .groupBy("component").agg(F.min("least").alias("smallest")))
    by_print = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").join(classes, "component", "left").select(
        "fp", F.coalesce("smallest", "least").alias("component"))
    return prints.join(by_print, "fp", "left").select("doc", "fp", "component")

