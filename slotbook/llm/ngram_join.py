"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its distinct word shingles.  Documents with equal sets
are one node.  Tokens (shingle hashes) are ordered by their hash; a node that links
to another misses at most e = n - ceil(t*n) of its tokens there, so the first e + k
tokens of both share at least k (k, the extension, is a share of n).

1. Every node posts its first e + k tokens.  Tokens in up to ``rare`` nodes are rare
   and indexed alone: nodes that share one are a candidate pair, with the
   number of rare tokens shared.  A pair whose nodes hold f frequent tokens in
   these prefixes must share k - f rare ones, or it is no candidate.
2. A node is heavy if its frequent tokens could be all that it shares (f >= k).  For pairs
   of heavy nodes tokens are put in order again, by the number of heavy nodes that hold them,
   and prefixes taken from whole sets, e + 2 long: they share two tokens.  Either one is
   rare, and is indexed alone; or both are frequent, and the node's 2-token
   combinations of frequent prefix tokens are indexed.
3. Candidates are verified exactly on whole sets; links give components.

A large group of near copies has only frequent tokens.  Before pairs of heavy nodes are
listed, each token's least node is verified against the token's other nodes (a star, not
all pairs), and links contract the group to one component; tokens and combinations
within one component need no comparison at all.  The nodes that the rest connect are
compared whole, in blocks, so no link between different texts is lost.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from slotbook.llm.common import written
from slotbook.llm.graph import components
from slotbook.llm.hashing import BASE, SPACES, mix, word_hashes
from slotbook.llm.word_memory import release

SLICE = 1 << 20         # bytes of text hashed at a time
CHUNK = 1 << 20         # tokens posted at a time
SMALL = 500_000         # rows of one or two numbers that may be broadcast: some 16 MB

@dataclass(frozen=True)
class JoinRules:
    """Words per shingle, threshold in percent, extension of the prefix in percent
    of the set, nodes up to which a token is rare, rounds of stars, nodes in a part of a block."""
    width: int = 5
    percent: int = 80
    extension: int = 5
    rare: int = 16
    rounds: int = 3
    part: int = 400

    def missing(self, n):
        """Tokens of a set of n that a linked set may lack."""
        return n - -(-n * self.percent // 100)

    def extra(self, n):
        return np.maximum(2, n * self.extension // 100)


def shingle_sets(texts: list[str], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes (int64) of each text, A-Z lower-cased.

    Words are runs of bytes other than 0x20 and 0x09-0x0D; a shingle's hash comes from its words' hashes.
    """
    out: list[np.ndarray] = []
    start = 0
    while start < len(texts):
        stop, size, held = start, 0, []
        while stop < len(texts) and (stop == start or size < SLICE):
            held.append((texts[stop] or "").encode("utf-8", "replace").lower())
            size += len(held[-1]) + 1
            stop += 1
        out += _sets(held, width)
        start = stop
    return out


def _sets(held: list[bytes], width: int) -> list[np.ndarray]:
    out = []
    for w in word_hashes(held, SPACES):
        n = len(w)
        if not n:
            out.append(np.zeros(0, np.int64))
            continue
        k = min(width, n)
        s = np.full(n - k + 1, k, np.uint64)
        for i in range(k):
            s = s * BASE + w[i:n - k + 1 + i]
        out.append(np.unique(mix(s).view(np.int64)))
    return out


def node_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sketch(rules: JoinRules):
    def sketch(batches):
        release()
        seen: set[int] = set()
        for b in batches:
            keys, hashes, texts = b.column(0), b.column(1), b.column(2)
            for i in range(0, len(texts), 256):
                sets = shingle_sets(texts.slice(i, 256).to_pylist(), rules.width)
                nodes, posts = [], []
                for s in sets:
                    n = len(s)
                    nodes.append(node_id(s) if n else None)
                    new = n and nodes[-1] not in seen
                    if new:
                        seen.add(nodes[-1])
                    # a copy's prefix is posted once by each task
                    posts.append(s[:rules.missing(n) + int(rules.extra(n))].tobytes() if new else None)
                yield pa.RecordBatch.from_arrays([
                    keys.slice(i, len(sets)), hashes.slice(i, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()),
                    pa.array(posts, pa.binary())], names=["doc", "text_hash", "n", "node", "posts"])
    return sketch


def sketches(docs: DataFrame, key: str, text: str, rules: JoinRules) -> DataFrame:
    """(doc, text_hash, n, node, posts) per row: set size, id of the set, first tokens."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(body).alias("text_hash"),
                       body.alias("text")).mapInArrow(
        _sketch(rules), "doc long, text_hash long, n long, node long, posts binary")


def _post(rules: JoinRules):
    """(token, node, count) rows; a token that is frequent in a chunk of rows
    already is one row (token, null, count)."""
    def post(batches):
        nodes: list[int] = []
        held: list[np.ndarray] = []
        size = 0

        def flush():
            token = np.concatenate(held)
            node = np.repeat(np.array(nodes, np.int64), [len(h) for h in held])
            order = np.argsort(token, kind="stable")
            token, node = token[order], node[order]
            start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            count = np.diff(np.append(start, len(token)))
            often = count > rules.rare
            alone = ~np.repeat(often, count)
            t = np.concatenate([token[alone], token[start[often]]])
            n = pa.array(np.concatenate([node[alone], np.zeros(often.sum(), np.int64)]),
                         mask=np.concatenate([np.zeros(alone.sum(), bool), np.ones(often.sum(), bool)]))
            c = np.concatenate([np.ones(alone.sum(), np.int64), count[often]])
            for i in range(0, len(t), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(t[i:i + (1 << 16)]), n.slice(i, 1 << 16),
                                                  pa.array(c[i:i + (1 << 16)])], names=["token", "node", "count"])

        for b in batches:
            for node, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                nodes.append(node)
                held.append(np.frombuffer(raw.as_buffer(), np.int64).copy())
                size += len(held[-1])
                if size > CHUNK:
                    yield from flush()
                    nodes, held, size = [], [], 0
        if held:
            yield from flush()
    return post


def _group(rules: JoinRules):
    """From rows in order of token: candidate pairs (a, b, rare tokens shared) with a < b,
    and frequent tokens as (token, null, nodes)."""
    def group(batches):
        rest: tuple | None = None          # rows of the last token so far, at most ``rare`` + 1 of them

        def close(token, node, count):
            start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            total = np.add.reduceat(count, start)
            size = np.diff(np.append(start, len(token)))
            often = total > rules.rare
            a, b = [], []
            few = np.flatnonzero(~often & (size > 1))
            for k in np.unique(size[few]).tolist():        # all groups of one size at once
                g = np.sort(node[start[few[size[few] == k]][:, None] + np.arange(k)[None, :]], axis=1)
                i, j = np.triu_indices(k, 1)
                a.append(g[:, i].ravel())
                b.append(g[:, j].ravel())
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                a, b = a[a != b], b[a != b]                # a copy posted by two tasks
                pair, shared = np.unique(np.stack([a, b], 1), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(shared.astype(np.int64))],
                    names=["a", "b", "count"])
            if often.any():
                f = token[start[often]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f), pa.nulls(len(f), pa.int64()), pa.array(total[often])], names=["a", "b", "count"])

        for batch in batches:
            if not batch.num_rows:
                continue
            token = batch.column(0).to_numpy(zero_copy_only=False)
            count = batch.column(2).to_numpy(zero_copy_only=False)
            node = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
            if rest is not None:
                token, node, count = (np.concatenate(x) for x in zip(rest, (token, node, count), strict=True))
            cut = int(np.searchsorted(token, token[-1]))
            if cut:
                yield from close(token[:cut], node[:cut], count[:cut])
            rest = (token[cut:], node[cut:], count[cut:])
            if len(rest[0]) > 4 * rules.rare:      # frequent for certain: its rows count, no more
                rest = (rest[0][:1], np.zeros(1, np.int64), np.array([rest[2].sum()]))
        if rest is not None:
            yield from close(*rest)
    return group


def _small(df: DataFrame) -> DataFrame:
    """For broadcast if its rows are few, as counted."""
    return F.broadcast(df) if df.count() <= SMALL else df


def _sets_of(rules: JoinRules):
    def sets_of(batches):
        release()
        for b in batches:
            texts = b.column(0)
            for i in range(0, len(texts), 256):
                sets = [s for s in shingle_sets(texts.slice(i, 256).to_pylist(), rules.width) if len(s)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([node_id(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "n", "tokens"])
    return sets_of


def _linked(rules: JoinRules):
    def linked(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                s, t = (np.frombuffer(z.as_buffer(), np.int64) for z in (x, y))
                if len(s) > len(t):
                    s, t = t, s
                at = np.searchsorted(t, s)
                both = int((t[np.minimum(at, len(t) - 1)] == s).sum())
                keep.append(100 * both >= rules.percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return linked


def verify(pairs: DataFrame, sets: DataFrame, rules: JoinRules) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    size_ok = (100 * F.least("x.n", "y.n") >= rules.percent * F.greatest("x.n", "y.n"))
    both = (pairs.select("a", "b").join(sets.alias("x"), F.col("a") == F.col("x.node"))
            .join(sets.alias("y"), (F.col("b") == F.col("y.node")) & size_ok)
            .select("a", "b", F.col("x.tokens").alias("s"), F.col("y.tokens").alias("t")))
    return both.mapInArrow(_linked(rules), "a long, b long")


def _tokens(batches):
    for b in batches:
        for node, n, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            t = np.frombuffer(raw.as_buffer(), np.int64)
            for i in range(0, len(t), 1 << 16):
                some = t[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(some), node)), pa.array(np.full(len(some), n)), pa.array(some)],
                    names=["node", "n", "token"])


def _missing(n: Column, rules: JoinRules) -> Column:
    return n - F.ceil(n * rules.percent / F.lit(100))


def heavy_prefixes(sets: DataFrame, heavy: DataFrame, rules: JoinRules) -> DataFrame:
    """(node, token, often): the first e + 2 tokens of heavy nodes, in order of the number of heavy
    nodes that hold them (then of the token).  A node that differs from its group in more than e
    tokens posts only those, which nobody shares."""
    tokens = written(sets.join(_small(heavy.select("node")), "node", "left_semi").mapInArrow(
        _tokens, "node long, n long, token long"), "heavy-tokens")
    counts = tokens.groupBy("token").agg(F.count("*").alias("held"))
    # tokens of one node alone need not be joined back: without a count they come first
    marked = tokens.join(counts.filter("held > 1"), "token", "left")
    order = Window.partitionBy("node").orderBy(F.coalesce("held", F.lit(1)), "token")
    return (marked.withColumn("place", F.row_number().over(order))
            .filter((F.col("place") <= _missing(F.col("n"), rules) + 2) & F.col("held").isNotNull())
            .select("node", "token", (F.col("held") > rules.rare).alias("often")))


def _with_component(postings: DataFrame, comps: DataFrame) -> DataFrame:
    """Postings with each node's component, without keys that lie in one component."""
    p = postings.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    live = p.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                F.min(F.struct("node", "component")).alias("center")).filter("lo <> hi")
    return p.join(live.select("key", "center"), "key")


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def star_pairs(postings: DataFrame, comps: DataFrame) -> DataFrame:
    """Each key's least node with the key's nodes of other components."""
    p = _with_component(postings, comps).filter("component <> center.component")
    return p.select(*_pairs(F.col("node"), F.col("center.node"))).distinct()


def _blocks(rules: JoinRules):
    """Links between the two halves of a block (or inside its one half) that join different components;
    enough of them to connect all that are linked."""
    def blocks(table: pa.Table) -> pa.Table:
        half = table.column("half").to_numpy()
        node, comp, n = (table.column(c).to_numpy() for c in ("node", "component", "n"))
        sets = [np.frombuffer(x.as_buffer(), np.int64) for x in table.column("tokens").combine_chunks()]
        two = half.min() != half.max()
        tokens, place, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        kept = held > 1                                   # others are in no intersection
        column = np.cumsum(kept) - 1
        some = kept[place]
        row, place = row[some], column[place[some]]
        order = np.argsort(place, kind="stable")
        row, place = row[order], place[order]
        both = np.zeros((len(sets), len(sets)), np.float32)
        width = 4096
        for lo in range(0, int(kept.sum()), width):
            i, j = np.searchsorted(place, [lo, lo + width])
            m = np.zeros((len(sets), width), np.float32)
            m[row[i:j], place[i:j] - lo] = 1
            both += m @ m.T
        least = rules.percent * (n[:, None] + n[None, :] - both)
        hit = np.triu((100 * both >= least) & (comp[:, None] != comp[None, :]), 1)
        if two:
            hit &= half[:, None] != half[None, :]
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        out = []
        for x, y in zip(*(v.tolist() for v in np.nonzero(hit)), strict=True):
            f, g = find(int(comp[x])), find(int(comp[y]))
            if f != g:
                root[f] = g
                out.append((int(node[x]), int(node[y])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})
    return blocks


def cross_links(postings: DataFrame, comps: DataFrame, sets: DataFrame, rules: JoinRules) -> DataFrame:
    """Links between nodes of one key and different components.

    Nodes that keys connect, directly or not, are a cluster.  All of a cluster's nodes are compared, in
    blocks: it is dealt into parts of bounded size, and each pair of parts is one block, in which the
    intersections of all sets are one matrix product.  No list of pairs is made.
    """
    p = _with_component(postings, comps)
    spans = written(p.select("node", F.col("center.node").alias("center"), "component").distinct(), "cluster-edges")
    edges = spans.filter("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b"))
    members = written(spans.select("node", F.col("component").alias("inside")).distinct().join(
        components(edges).withColumnRenamed("component", "cluster"), "node"), "cluster-members")
    parts = members.groupBy("cluster").agg(F.ceil(F.count("*") / rules.part).alias("parts"))
    dealt = members.join(parts, "cluster").withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    block = dealt.select("cluster", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"),
                         F.col("part").alias("half"), "node", F.col("inside").alias("component"))
    full = block.join(sets, "node")
    return full.groupBy("cluster", "lo", "hi").applyInArrow(_blocks(rules), "a long, b long")


def heavy_links(sets: DataFrame, heavy: DataFrame, links: DataFrame, tried: DataFrame,
                rules: JoinRules) -> DataFrame:
    """``links`` and those between heavy nodes that its components do not imply."""
    prefix = written(heavy_prefixes(sets, heavy, rules), "heavy-prefixes")
    single = prefix.select("node", F.col("token").alias("key"))
    comps = components(links)
    for _ in range(rules.rounds):
        pairs = written(star_pairs(single, comps).join(tried, ["a", "b"], "left_anti"), "star-pairs")
        new = written(verify(pairs, sets, rules), "star-links")
        tried = tried.union(pairs)
        if new.isEmpty():
            break
        links = links.union(new)
        comps = components(links)
    # frequent tokens that still join two components: combinations of two
    some = _with_component(prefix.filter("often").select("node", F.col("token").alias("key")), comps)
    some = written(some.select("node", F.col("key").alias("token")), "frequent-prefixes")
    combined = (some.alias("p").join(some.alias("q"), (F.col("p.node") == F.col("q.node"))
                                     & (F.col("p.token") < F.col("q.token")))
                .select(F.col("p.node").alias("node"), F.xxhash64("p.token", "q.token").alias("key")))
    rare = prefix.filter("NOT often").select("node", F.col("token").alias("key"))
    rest = cross_links(rare.union(combined), comps, sets, rules)
    return links.union(written(rest, "cross-links"))


def link_nodes(docs: DataFrame, sketched: DataFrame, text: str, rules: JoinRules) -> DataFrame:
    """Verified links (a, b) between nodes; enough of them to connect all that are linked."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    posts = sketched.filter("posts IS NOT NULL").select("node", "posts")
    grouped = written(
        posts.mapInArrow(_post(rules), "token long, node long, count long")
        .repartition(parts, "token").sortWithinPartitions("token")
        .mapInArrow(_group(rules), "a long, b long, count long"), "token-groups")
    frequent = grouped.filter("b IS NULL").select(F.col("a").alias("token"))
    sizes = sketched.filter("node IS NOT NULL").groupBy("node").agg(
        F.first("n").alias("n"), F.min("text_hash").alias("text_hash"))
    # frequent tokens in each node's prefix; a copy's prefix may be there twice
    often = (posts.mapInArrow(_explode, "node long, token long").join(_small(frequent), "token")
             .groupBy("node").agg(F.countDistinct("token").alias("f")))
    extra = F.greatest(F.lit(2), F.floor(F.col("n") * rules.extension / F.lit(100)))
    least = F.greatest(F.lit(2), F.floor(F.ceil(F.col("n") * rules.percent / F.lit(100)) * rules.extension / F.lit(100)))
    nodes = written(sizes.join(often, "node", "left").select(
        "node", "n", "text_hash", F.coalesce("f", F.lit(0)).alias("f"), extra.alias("k"),
        (F.coalesce("f", F.lit(0)) >= least).alias("heavy")), "nodes")
    x, y = nodes.alias("x"), nodes.alias("y")
    pairs = written(
        grouped.filter("b IS NOT NULL").groupBy("a", "b").agg(F.sum("count").alias("shared"))
        .join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
        .filter((100 * F.least("x.n", "y.n") >= rules.percent * F.greatest("x.n", "y.n"))
                & (F.col("shared") >= F.least("x.k", "y.k") - F.least("x.f", "y.f")))
        .select("a", "b"), "candidate-pairs")
    heavy = nodes.filter("heavy").select("node")
    wanted = (pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(heavy).distinct()
              .join(nodes, "node").select("node", "text_hash"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # whole sets of the nodes in question, hashed again from one text each
    sets = written(
        docs.select(body.alias("text"), F.xxhash64(body).alias("text_hash"))
        .join(_small(wanted.select("text_hash").distinct()), "text_hash", "left_semi").select("text")
        .mapInArrow(_sets_of(rules), "node long, n long, tokens binary").dropDuplicates(["node"]), "whole-sets")
    links = written(verify(pairs, sets, rules), "verified-links")
    return links if heavy.isEmpty() else heavy_links(sets, heavy, links, pairs, rules)


def _explode(batches):
    for b in batches:
        raw = b.column(1)
        tokens = [np.frombuffer(x.as_buffer(), np.int64) for x in raw]
        if not tokens:
            continue
        node = np.repeat(b.column(0).to_numpy(zero_copy_only=False), [len(t) for t in tokens])
        token = np.concatenate(tokens)
        for i in range(0, len(token), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(node[i:i + (1 << 17)]), pa.array(token[i:i + (1 << 17)])],
                                             names=["node", "token"])


def clustered(docs: DataFrame, key: str = "doc_id", text: str = "text",
              rules: JoinRules = JoinRules()) -> DataFrame:
    """(doc, text_hash, n, root) per input row: root names the group of linked rows, null for empty sets."""
    sketched = written(sketches(docs, key, text, rules), "sketches")
    comps = components(link_nodes(docs, sketched, text, rules))
    # nodes first: a hot group of copies is one row by the time components are joined
    named = sketched.filter("node IS NOT NULL").select("node").distinct().join(comps, "node", "left").select(
        "node", F.coalesce("component", "node").alias("root"))
    rows = sketched.filter("node IS NOT NULL").join(named, "node").select("doc", "text_hash", "n", "root")
    return rows.unionByName(sketched.filter("node IS NULL").select(
        "doc", "text_hash", "n", F.lit(None).cast("long").alias("root")))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text",
                       rules: JoinRules = JoinRules()) -> DataFrame:
    """One row per input row: doc, n (set size), component (the smallest doc reachable by links).

    Null or empty text, or one without words: n = 0, its own component, linked with nothing.  Texts with fewer words
    than a shingle: one element, the whole sequence.  Equal texts, and rows with equal ids, are linked by their
    sets alone.  A null key stays null; its row links others, and a component of null keys only is null.  Other columns are
    ignored, an empty table gives none.
    """
    rows = written(clustered(docs, key, text, rules), "clusters")
    roots = rows.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc").alias("component"))
    return rows.filter("root IS NOT NULL").join(roots, "root").select("doc", "n", "component").union(
        rows.filter("root IS NULL").select("doc", "n", F.col("doc").alias("component")))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: JoinRules = JoinRules()) -> DataFrame:
    """The rows of ``docs`` without all but one of each group of linked rows: the one with the smallest
    key (then text hash) stays; rows without words are in no group and stay."""
    rows = written(clustered(docs, key, text, rules).filter("root IS NOT NULL")
                   .groupBy("root", "doc", "text_hash").agg(F.count("*").alias("copies")), "clusters")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc").isNull(), "doc", "text_hash")).alias("kept"))
    marked = rows.join(first, "root").select("doc", "text_hash", "copies", (
        F.col("doc").eqNullSafe(F.col("kept.doc")) & (F.col("text_hash") == F.col("kept.text_hash"))).alias("stays"))
    gone = marked.filter("NOT stays").select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"))
    twice = marked.filter("stays AND copies > 1").select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"))
    d, g = docs.alias("d"), _small(gone).alias("g")
    hashed = F.xxhash64(F.coalesce(F.col(f"d.`{text}`").cast("string"), F.lit("")))

    def same(t: str) -> Column:
        return (F.col(f"d.`{key}`").cast("long").eqNullSafe(F.col(f"{t}._doc"))) & (hashed == F.col(f"{t}._hash"))

    left = d.join(g, same("g"), "left_anti")
    if twice.isEmpty():
        return left
    # rows that are there several times with one key and text: any one of them stays
    t = _small(twice)
    once = left.alias("d").join(t.alias("t"), same("t"), "left_anti")
    more = left.alias("d").join(t.alias("t"), same("t"), "left_semi").dropDuplicates([key, text])
    return once.unionByName(more)
