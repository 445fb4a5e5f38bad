"""Hard negatives from a GNAT-style multiway hyperplane tree.

Every inner node holds some split points that lie far apart; a vector goes to the child of the
nearest one.  For each split point and each sibling child the node keeps the least and
greatest distance from the point to the child's vectors.  A search for vectors whose distance to
the anchor lies in an annulus drops a child when, for any split point, that range misses all
distances which the triangle inequality allows.  Leaves are searched exactly.

Scores are integer inner products.  With the squared lengths of a child's vectors between two
bounds, a window of scores is an annulus of distances, so the tree serves both searches: the
best positives of an anchor, and the negatives in the score windows below its positives.

The tree's shape is fitted on a bounded sample; the ranges are taken over every row.  Rows are
stored in blocks of a leaf, anchors in blocks of their home leaf; a block of anchors is
sent to the blocks of rows that it cannot rule out, each pair of blocks is one matrix
product, and each task keeps only the best few of every search.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from slotbook.llm.common import written

EXACT = float(1 << 53)     # products of doubles are exact below
LONGEST = 2 ** 63 - 1


@dataclass(frozen=True)
class SearchRules:
    """Bounds of the tree, and what a search returns."""
    positives: int = 5
    negatives: int = 5
    window: tuple[int, int] = (80, 100)   # percent of the positive's score
    sample: int = 8192        # rows, about, that the tree's shape is fitted on
    fan: int = 16             # split points of a node
    leaf_rows: int = 2048     # rows expected in a leaf; a block never holds more
    anchor_rows: int = 128    # anchors of a block, at most


# -- the tree


class Node:
    """Split points and, for each, a child: an inner node, or a leaf's number."""

    def __init__(self, number: int, points: np.ndarray):
        self.number, self.points, self.children = number, points, []


class Gnat:
    """Split points of all inner nodes.  ``ranges[node][i, j]``: least and greatest distance from split
    point i to the vectors below child j; ``lengths[leaf]``: bounds of their squared lengths."""

    def __init__(self, sample: np.ndarray, total: int, rules: SearchRules):
        self.nodes: list[Node] = []
        self.leaves = 0
        self.width = sample.shape[1]
        rng = np.random.default_rng(7)
        scale = total / max(len(sample), 1)

        def build(rows: np.ndarray):
            points = far_apart(rows, rules.fan, rng) if len(rows) * scale > rules.leaf_rows else rows[:0]
            near = distances(rows, points).argmin(1) if len(points) > 1 else np.zeros(len(rows), np.int64)
            if not near.any():                 # nothing parts them
                self.leaves += 1
                return self.leaves - 1
            node = Node(len(self.nodes), points)
            self.nodes.append(node)
            # a child with fewer sample rows than the node: the recursion ends
            node.children = [build(rows[near == j]) for j in range(len(points))]
            return node

        self.root = build(sample)
        self.ranges: dict[int, np.ndarray] = {}
        self.lengths: dict[int, tuple[float, float]] = {}

    def place(self, vectors: np.ndarray):
        """Leaf of every vector, and (node, split point, child) -> (least, greatest) distance among them."""
        leaf = np.zeros(len(vectors), np.int64)
        seen: dict[tuple[int, int, int], tuple[float, float]] = {}

        def go(node, rows: np.ndarray) -> None:
            if not len(rows):
                return
            if not isinstance(node, Node):
                leaf[rows] = node
                return
            d = distances(vectors[rows], node.points)
            near = d.argmin(1)
            for j, child in enumerate(node.children):
                own = near == j
                if own.any():
                    low, high = d[own].min(0), d[own].max(0)
                    low[~np.isfinite(low)] = 0.0
                    for i in range(len(node.points)):
                        seen[node.number, i, j] = (float(low[i]), float(high[i]))
                    go(child, rows[own])

        go(self.root, np.arange(len(vectors)))
        return leaf, seen

    def reach(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """(anchors, leaves): whether the leaf may hold a vector whose score lies between low and high."""
        out = np.zeros((len(anchors), self.leaves), bool)
        with np.errstate(over="ignore"):
            length = (anchors * anchors).sum(1)
        floor = min((a for a, _ in self.lengths.values()), default=0.0)
        top = max((b for _, b in self.lengths.values()), default=0.0)

        def go(node, rows: np.ndarray) -> None:
            with np.errstate(over="ignore", invalid="ignore"):
                visit(node, rows)

        def visit(node, rows: np.ndarray) -> None:
            if not isinstance(node, Node):
                if node in self.lengths:
                    a, b = self.lengths[node]
                    # by Cauchy's inequality, with the leaf's own lengths
                    far = np.sqrt(length[rows]) * np.sqrt(b) * (1 + 1e-9) + 1
                    out[rows, node] = ~((low[rows] > far) | (high[rows] < -far))
                return
            # what rounding may cost a distance
            slack = 1e-7 * (np.sqrt(length[rows]) + np.sqrt(top)) + 1e-3
            near = np.sqrt(np.maximum(length[rows] + floor - 2 * high[rows], 0)) - slack
            far = np.sqrt(np.maximum(length[rows] + top - 2 * low[rows], 0)) + slack
            d = distances(anchors[rows], node.points)
            for j, child in enumerate(node.children):
                bounds = self.ranges.get((node.number, j))
                if bounds is None:          # no row below
                    continue
                # |d(q, p) - d(q, x)| <= d(p, x) <= d(q, p) + d(q, x), for every split point p
                least = np.maximum(d - far[:, None], near[:, None] - d)
                room = 2 * slack[:, None]
                ok = ~((bounds[:, 1] < least - room) | (bounds[:, 0] > d + far[:, None] + room)).any(1)
                if ok.any():
                    go(child, rows[ok])

        go(self.root, np.arange(len(anchors)))
        return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances; infinite where the squares leave the range of doubles."""
    with np.errstate(over="ignore", invalid="ignore"):
        square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
        return np.sqrt(np.where(np.isnan(square), np.inf, np.maximum(square, 0)))


def far_apart(rows: np.ndarray, n: int, rng) -> np.ndarray:
    """Up to n distinct rows, each the farthest from those before it among some candidates."""
    if len(rows) < 2:
        return rows[:0]
    some = rows[rng.choice(len(rows), min(len(rows), 3 * n), replace=False)]
    chosen = [0]
    away = distances(some, some[:1])[:, 0]
    while len(chosen) < min(n, len(some)):
        k = int(away.argmax())
        if away[k] <= 1e-6:
            break
        chosen.append(k)
        away = np.minimum(away, distances(some, some[k:k + 1])[:, 0])
    return some[chosen] if len(chosen) > 1 else rows[:0]


# -- rows as matrices


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones end in zeros, which change no inner product."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width).astype(np.float64)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths),
        np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _small(m: np.ndarray) -> bool:
    return not m.size or np.abs(m).max() < 1 << 15


def _packed(m: np.ndarray) -> bytes:
    """A matrix of whole numbers as bytes, two a number where they fit."""
    return m.astype("<i2" if _small(m) else "<f8").tobytes()


def _unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    kind = "<i2" if len(data) == 2 * rows * width else "<f8"
    return np.frombuffer(data, kind).reshape(rows, width).astype(np.float64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers."""
    most = max(np.abs(a).max(initial=0), 1) * max(np.abs(b).max(initial=0), 1) * a.shape[1]
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[[int(x) for x in r] for r in m] for m in (a, b)]
    return np.array([[max(-LONGEST, min(LONGEST, sum(x * y for x, y in zip(r, s, strict=True)))) for s in whole[1]]
                     for r in whole[0]], np.int64).reshape(len(a), len(b))


BLOCK_ARROW = pa.schema([("leaves", pa.list_(pa.int32())), ("n", pa.int32()), ("id_list", pa.list_(pa.int64())),
                         ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())])


def _block(rows: list[tuple], width: int) -> pa.RecordBatch:
    m = np.concatenate([_unpacked(r[3], 1, width) for r in rows])
    ids = [r[1] for r in rows]
    return pa.RecordBatch.from_pylist([{
        "leaves": sorted({r[0] for r in rows}), "n": len(rows), "id_list": ids, "ids": np.array(ids, "<i8").tobytes(),
        "labels": np.array([r[2] for r in rows], "<i8").tobytes(), "vectors": _packed(m)}], BLOCK_ARROW)


def _blocks(placed: DataFrame, width: int, most: int, mixed: bool) -> DataFrame:
    """Rows (leaf, id, label, vector) as blocks of ``most`` rows at most, of one leaf each, or, ``mixed``, of
    neighbouring leaves; a large leaf is dealt over tasks.  The rows of a block of one leaf are in order of id."""
    def run(batches):
        rows: list[tuple] = []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if rows and (len(rows) >= most or r[0] != rows[0][0] and not mixed):
                    yield _block(rows, width)
                    rows = []
                rows.append(r)
        if rows:
            yield _block(rows, width)

    n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(n, "leaf", F.xxhash64("id"), "id").sortWithinPartitions("leaf", "id")
    blocks = ordered.select("leaf", "id", "label", "vector").mapInArrow(run, from_arrow_schema(BLOCK_ARROW))
    return written(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


# -- searches


def _best(scores: np.ndarray, mask: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest scores of each row under the mask; of equal ones the first."""
    n = scores.shape[1]
    if n * max(int(scores.max()), -int(scores.min())) < 1 << 60:
        # one number for score and place
        ranks = np.where(mask, scores * n + (n - 1 - np.arange(n)), -LONGEST)
    else:
        order = np.argsort(-scores.astype(object), axis=1, kind="stable")
        ranks = np.empty(scores.shape, np.int64)
        np.put_along_axis(ranks, order, np.broadcast_to(np.arange(n, 0, -1), scores.shape), 1)
        ranks = np.where(mask, ranks, -LONGEST)
    at = np.argpartition(-ranks, min(k, n) - 1, axis=1)[:, :k]
    row, slot = np.nonzero(np.take_along_axis(mask, at, 1))
    return row, at[row, slot]


PAIR = "block long, n int, ids binary, labels binary, vectors binary, a_n int, a_ids binary, a_labels binary, " \
       "a_vectors binary, a_low binary, a_high binary"
FOUND = "anchor_id long, positive int, other_id long, score long"


def _search(pairs: DataFrame, width: int, k: int, same: bool, windows: int) -> DataFrame:
    """The k best rows of each block for every anchor and window: of the anchor's own label, or of others."""
    def run(batches):
        for b in batches:
            out = []
            for _, n, ids, labels, vectors, a_n, a_ids, a_labels, a_vectors, a_low, a_high in zip(
                    *(c.to_pylist() for c in b.columns), strict=True):
                ids, labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
                a_ids, a_labels = np.frombuffer(a_ids, "<i8"), np.frombuffer(a_labels, "<i8")
                low = np.frombuffer(a_low, "<i8").reshape(a_n, windows)
                high = np.frombuffer(a_high, "<i8").reshape(a_n, windows)
                scores = products(_unpacked(a_vectors, a_n, width), _unpacked(vectors, n, width))
                fit = ((labels == a_labels[:, None]) == same) & (ids != a_ids[:, None])
                for w in range(windows):
                    mask = fit & (scores >= low[:, w, None]) & (scores <= high[:, w, None])
                    if mask.any():
                        r, x = _best(scores, mask, k)
                        out.append((a_ids[r], np.full(len(r), w, np.int32), ids[x], scores[r, x]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                                 ["anchor_id", "positive", "other_id", "score"])

    found = pairs.mapInArrow(run, FOUND)
    order = Window.partitionBy("anchor_id", "positive").orderBy(F.desc("score"), "other_id")
    # each task passes on its best k only
    return found.withColumn("r", F.row_number().over(order).cast("int")).filter(F.col("r") <= k)


def _pairs(anchors: DataFrame, blocks: DataFrame, tree: Gnat, width: int, windows: int, home: bool) -> DataFrame:
    """Blocks of anchors (with windows low and high) beside each block of rows that they reach."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(tree)   # bounded by the sample
    schema = pa.schema([("leaf", pa.int32()), ("a", pa.int64())])

    def reached(batches):
        for b in batches:
            for a, own, n, vectors, low, high in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if home:
                    leaves = own
                else:
                    lo = np.frombuffer(low, "<i8").reshape(n, windows).astype(np.float64)
                    hi = np.frombuffer(high, "<i8").reshape(n, windows).astype(np.float64)
                    some = (lo <= hi).any(1)
                    lo, hi = np.where(lo <= hi, lo, np.inf).min(1), np.where(lo <= hi, hi, -np.inf).max(1)
                    m = _unpacked(vectors, n, width)[some]
                    leaves = np.flatnonzero(shared.value.reach(m, lo[some], hi[some]).any(0)).tolist() if some.any() else []
                if leaves:
                    yield pa.RecordBatch.from_pylist([{"leaf": x, "a": a} for x in leaves], schema)

    where = anchors.select("a", "leaves", "a_n", "a_vectors", "a_low", "a_high").mapInArrow(reached, "leaf int, a long")
    leaf_of = blocks.select(F.col("leaves")[0].alias("leaf"), "block")
    sent = where.join(leaf_of, "leaf").select("a", "block").join(anchors.drop("leaves"), "a")
    return sent.join(blocks.drop("leaves", "id_list"), "block").select(*[c.split()[0] for c in PAIR.split(", ")])


def _with_windows(anchors: DataFrame, bounds: DataFrame, windows: int) -> DataFrame:
    """Blocks of anchors with their windows' ends as matrices.  ``bounds``: anchor_id, lows, highs
    (arrays); anchors without bounds get empty windows."""
    ids = anchors.select("a", F.posexplode("id_list").alias("at", "anchor_id"))
    rows = ids.join(bounds, "anchor_id", "left").groupBy("a").agg(
        F.array_sort(F.collect_list(F.struct("at", F.col("lows"), F.col("highs")))).alias("w"))

    def pack(batches):
        for b in batches:
            out = []
            for a, w in zip(*(c.to_pylist() for c in b.columns), strict=True):
                low = [x["lows"] or [1] * windows for x in w]
                high = [x["highs"] or [0] * windows for x in w]
                out.append({"a": a, "a_low": np.array(low, "<i8").tobytes(), "a_high": np.array(high, "<i8").tobytes()})
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([("a", pa.int64()), ("a_low", pa.binary()),
                                                                 ("a_high", pa.binary())]))

    return written(anchors.drop("id_list").join(rows.mapInArrow(pack, "a long, a_low binary, a_high binary"), "a"),
                   "anchor-windows")


def mine(rows: DataFrame, anchors, rules: SearchRules = SearchRules()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its best
    positives, the best rows of other labels whose score lies in the window below the positive's.

    ``rows``: id (long), label (long), vector (array of whole numbers as doubles); ``anchors``: a condition
    on them.  Scores are inner products, higher first, ties by smaller id.  Rows with a null id, label or vector, or a
    null or non-finite component take no part; shorter vectors are read as ending in zeros, and an
    empty one scores 0 with all.  A repeated row counts as often as it occurs, but no row of the anchor's own id
    is a positive or negative of it, and of several anchor rows with one id that of the least label (then vector) asks.
    Scores beyond 64 bits are cut to the ends of that range.  Other columns are ignored; an empty table gives none.
    """
    spark = rows.sparkSession
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = rows.select(F.col("id").cast("long"), F.col("label").cast("long"),
                        F.col("vector").cast("array<double>"), F.coalesce(anchors, F.lit(False)).alias("anchor")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)
    valid = written(valid, "vectors")
    size = valid.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not size.n:
        return spark.createDataFrame([], result)
    width = max(size.width, 1)
    # the tree's shape: a sample of bounded size, on the driver
    share = min(1.0, rules.sample / size.n)
    some = valid.select("vector").sample(share, 7).collect() if share < 1 else valid.select("vector").collect()
    tree = Gnat(_matrix(pa.array([r.vector for r in some], pa.list_(pa.float64())), width), size.n, rules)
    shared = spark.sparkContext.broadcast(tree)
    range_schema = pa.schema([("node", pa.int32()), ("point", pa.int32()), ("child", pa.int32()),
                              ("low", pa.float64()), ("high", pa.float64())])

    def placed(batches):
        for b in batches:
            i, lb, v, a = b.columns
            m = _matrix(v, width)
            leaf, _ = shared.value.place(m)
            stored = m.astype("<i2" if _small(m) else "<f8")
            yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), i, lb, pa.array(
                [r.tobytes() for r in stored], pa.binary()), a], ["leaf", "id", "label", "vector", "anchor"])

    def ranged(batches):
        total: dict = {}
        for b in batches:
            m = _matrix(b.column(0), width)
            leaf, seen = shared.value.place(m)
            with np.errstate(over="ignore"):
                square = (m * m).sum(1)
            for x in np.unique(leaf):
                own = square[leaf == x]
                seen[-1, -1, int(x)] = (float(own.min()), float(own.max()))
            for k, (lo, hi) in seen.items():
                old = total.get(k, (lo, hi))
                total[k] = (min(lo, old[0]), max(hi, old[1]))
        if total:
            yield pa.RecordBatch.from_pylist([dict(zip(range_schema.names, (*k, *x), strict=True))
                                              for k, x in total.items()], range_schema)

    # bounded by the tree: one row per split point and sibling
    for r in valid.select("vector").mapInArrow(ranged, from_arrow_schema(range_schema)).groupBy(
            "node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        if r.node < 0:
            tree.lengths[r.child] = (r.low, r.high)
        else:
            m = tree.ranges.setdefault((r.node, r.child), np.zeros((len(tree.nodes[r.node].points), 2)))
            m[r.point] = (r.low, r.high)
    table = written(valid.mapInArrow(placed, "leaf int, id long, label long, vector binary, anchor boolean"), "placed")
    shared.unpersist()
    blocks = _blocks(table.drop("anchor"), width, rules.leaf_rows, False)
    asking = table.filter("anchor").groupBy("id").agg(F.min(F.struct("label", "vector", "leaf")).alias("x"))
    anchor_blocks = _blocks(asking.select("id", "x.*"), width, rules.anchor_rows, True).withColumnsRenamed(
        {"block": "a", "n": "a_n", "ids": "a_ids", "labels": "a_labels", "vectors": "a_vectors"})
    ids = anchor_blocks.select(F.explode("id_list").alias("anchor_id"))
    ends = F.lit(-LONGEST), F.lit(LONGEST)

    def bounds(low, high, src):
        return src.select("anchor_id", F.array(low).alias("lows"), F.array(high).alias("highs"))

    # 1. positives in the home leaf: their last score is a lower bound
    k = rules.positives
    home = _search(_pairs(_with_windows(anchor_blocks, bounds(*ends, ids), 1), blocks, tree, width, 1, True), width, k, True, 1)
    least = home.groupBy("anchor_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).filter(F.col("n") == k)
    floor = ids.join(least, "anchor_id", "left").withColumn("s", F.coalesce("s", ends[0]))
    # 2. positives in all leaves that may hold a better one
    best = written(_search(_pairs(_with_windows(anchor_blocks, bounds(F.col("s"), ends[1], floor), 1), blocks, tree, width, 1,
                                  False), width, k, True, 1).select(
        "anchor_id", F.col("r").alias("p"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives")
    # 3. negatives in the windows of the positives: low * s <= 100 * score <= high * s
    lo, hi = rules.window
    s = F.col("positive_score").cast("decimal(38,0)")
    span = best.select("anchor_id", "p", F.ceil(s * lo / 100).cast("long").alias("low"),
                       F.floor(s * hi / 100).cast("long").alias("high"))
    slots = F.sequence(F.lit(1), F.lit(k))

    def at(field, none):
        return F.transform(slots, lambda i: F.coalesce(F.element_at(F.col(field), i.cast("int")), F.lit(none)))

    spans = span.groupBy("anchor_id").agg(
        F.map_from_entries(F.collect_list(F.struct("p", "low"))).alias("l"),
        F.map_from_entries(F.collect_list(F.struct("p", "high"))).alias("h")).select(
        "anchor_id", at("l", 1).alias("lows"), at("h", 0).alias("highs"))
    found = _search(_pairs(_with_windows(anchor_blocks, spans, k), blocks, tree, width, k, False), width, rules.negatives,
                    False, k)
    return found.select("anchor_id", (F.col("positive") + 1).alias("p"), F.col("r").alias("rank"),
                        F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score")).join(
        best, ["anchor_id", "p"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
