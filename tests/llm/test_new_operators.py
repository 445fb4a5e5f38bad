"""Conversation repair, hard negatives and SimHash against plain Python."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from slotbook.llm import conversation_repair as CR
from slotbook.llm import hard_negatives as HN
from slotbook.llm import queries as Q
from slotbook.llm import simhash as SH
from slotbook.llm.common import on_workers, table

SPACES = " \t\n\x0b\x0c\r"


# -- conversation repair


def least_repair(rows):
    """(cost, audit, lines) of rows (role, text, fault): whole audits compared, state by state."""
    best = {0: (0, "", [])}

    def inserted(ways):
        out = dict(ways)
        for _ in range(4):
            for s, (c, a, lines) in list(out.items()):
                q = 3 if s == 2 else 2
                w = (c + 2, a + "I", [*lines, "assistant:" if s == 2 else "user:"])
                if q not in out or w[:2] < out[q][:2]:
                    out[q] = w
        return out

    nexts = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    for role, text, fault in rows:
        after = {}
        for start, way in best.items():
            # every number of insertions before the row, also detours
            for k in range(4):
                s, (c, a, lines) = start, way
                for _ in range(k):
                    lines = [*lines, "assistant:" if s == 2 else "user:"]
                    s, c, a = (3 if s == 2 else 2), c + 2, a + "I"
                cut = 1 if fault == "truncated" else 0
                ways = [(s, (c + 3, a + "D", lines))]
                if fault not in ("blank", "duplicate"):
                    q = 3 if s == 2 else 2
                    ways.append((q, (c + 2 + cut, a + "R", [*lines, f"{'assistant' if s == 2 else 'user'}:{text}"])))
                    if role and (s, role[0]) in nexts:
                        ways.append((nexts[s, role[0]], (c + cut, a + "K", [*lines, f"{role}:{text}"])))
                for q, w in ways:
                    if q not in after or w[:2] < after[q][:2]:
                        after[q] = w
        best = after
    ends = [w for s, w in inserted(best).items() if s in (0, 3)] if rows else [best[0]]
    # insertions after the last row: from each state its own
    ends = []
    for s, (c, a, lines) in best.items():
        more = {0: [], 1: ["user:", "assistant:"], 2: ["assistant:"], 3: []}[s]
        ends.append((c + 2 * len(more), a + "I" * len(more), lines + more))
    return min(ends, key=lambda w: w[:2])


def with_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(SPACES)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def summary(rows):
    """The contract's values for (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    faulty = with_faults([r[1:] for r in rows])
    turns = {r[0] for r in rows if r[0] is not None}
    initials = [r[1][:1] for r in rows]
    cost, audit, lines = least_repair(faulty)
    n = lambda f: sum(x[2] == f for x in faulty)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n("blank"), n("duplicate"), n("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_solve_is_least():
    rng = random.Random(3)
    texts = ["Fine.", "cut", "", "Good!", "more"]
    for _ in range(1500):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(texts) + rng.choice(["", "x.", " "]))
                for _ in range(rng.randrange(0, 10))]
        faulty = with_faults(rows)
        codes = bytes(CR.code_of(r[:1], CR.CUT if f == "truncated" else CR.GONE if f else CR.FINE) for r, _, f in faulty)
        end = CR.last_state(CR.forward(codes, [0, CR.NEVER, CR.NEVER, CR.NEVER]))
        audit = CR.solve(codes, 0, end) + CR.TAIL[end]
        cost, least, lines = least_repair(faulty)
        assert (CR.cost_of(audit, codes), audit) == (cost, least)
        made = CR.apply(audit, [(r, t) for r, t, _ in faulty], 0)
        # what follows the last row is inserted as well
        assert [f"{r}:{t}" for r, t in made] == lines


def repaired(df, **kw):
    return {r[0]: tuple(r)[1:] for r in CR.summaries(CR.repair(df, **kw)).collect()}


CONV = "conv_id long, turn long, role string, text string, audit string, piece long, part int"


def conversation_rows():
    rng = random.Random(5)
    rows = []
    for c in [None, *range(30)]:
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, t, t + 3, None]), rng.choice(["user", "assistant", "system", "user", None, "bot", ""]),
                         rng.choice(["Hello there.", "cut off", "Yes!", None, " \t\n", "é😀?", "one. two"])))
    # one conversation holds half of all rows, with equal rows and equal turns
    for t in range(160):
        rows.append((99, t // 2, rng.choice(["user", "assistant"]), rng.choice([f"Text {t}.", "Same again.", f"cut {t}", ""])))
    rows += [(7, 1, "user", "x" * 300_000 + "."), (7, 1, "user", "x" * 300_000 + ".")]
    return rows


@pytest.mark.parametrize("kw", [{}, {"block_rows": 5, "fan": 3}])
def test_repair(spark, kw):
    on_workers(spark)
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, "?", 0, 0) for r in rows], CONV)
    want = defaultdict(list)
    for c, t, role, text in rows:
        want[c].append((t, " " if role is None else role, " " if text is None else text))
    assert repaired(df, **kw) == {c: summary(r) for c, r in want.items()}
    assert CR.repair(df.limit(0), **kw).count() == 0
    pieces = CR.repair(df, **kw).filter("conv_id = 99").orderBy("piece").collect()
    assert (len(pieces) > 10) == bool(kw)
    assert len([m for p in pieces for m in p["messages"]]) == sum(p["audit"].count(e) for p in pieces for e in "KRI")


def test_conversation_query(spark, sf_dir):
    given = defaultdict(list)
    for r in table(spark, sf_dir, "conversations").collect():
        given[r["conv_id"]].append(r)
    got = {r[0]: tuple(r)[1:] for r in Q.QUERIES["op12_conversation_repair"](spark, sf_dir).collect()}
    assert len(got) == len(given)
    for c, rows in given.items():
        kept = []
        for r in rows:
            d = zlib.crc32(f"{c}:{r['turn']}".encode()) % 20
            text = "" if d == 1 else r["text"].translate(str.maketrans("", "", ".!?")) if d == 2 else r["text"]
            kept += [(r["turn"], "user" if d == 4 else r["role"], text)] * (d != 0) * (2 if d == 3 else 1)
        assert got[c] == summary(kept), c


# -- hard negatives


def brute_negatives(rows, anchors, k=5):
    """rows: (id, label, vector) that take part."""
    out = []
    dot = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b))
    for a in anchors:
        scored = [(dot(a[2], r[2]), r) for r in rows if r[0] != a[0]]
        best = sorted(((s, r) for s, r in scored if r[1] == a[1]), key=lambda x: (-x[0], x[1][0]))[:k]
        for s, p in best:
            window = sorted(((n, r) for n, r in scored if r[1] != a[1] and 80 * s <= 100 * n <= 100 * s),
                            key=lambda x: (-x[0], x[1][0]))[:k]
            out += [(a[0], p[0], i + 1, r[0], s, n) for i, (n, r) in enumerate(window)]
    return sorted(out)


SMALL = HN.SearchRules(sample=60, fan=3, leaf_rows=16, anchor_rows=4)


def vectors(spark, rows):
    on_workers(spark)
    return spark.createDataFrame([(*r, "?", 0, 0.0) for r in rows], "id long, label int, vector array<double>,"
                                 " leaf string, block long, score double")


@pytest.mark.parametrize("rules", [SMALL, HN.SearchRules()])
def test_mine(spark, rules):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 300, (6, 12))
    rows = []
    for i in range(700):
        v = np.floor(centres[i % 6] + rng.normal(0, 40, 12)).tolist()
        if i % 50 == 3:
            v = v[:7]                                     # shorter
        if i % 3 == 0 and i > 200:
            v = [100.0] * 12                              # a third of all rows is one vector: ties
        rows.append((i, i % 4, v))
    rows += [(1001, 1, []), (1002, 2, [0.0] * 12), (1003, 0, [-3.0] * 12)]
    odd = [(None, 1, [1.0] * 12), (2000, None, [1.0] * 12), (2001, 1, None), (2002, 1, [1.0, None] * 6),
           (2003, 1, [float("nan")] * 12), (2004, 1, [math.inf] * 12)]
    asked = F.col("id") % 25 == 1
    got = sorted(tuple(r) for r in HN.mine(vectors(spark, rows + odd), asked, rules).collect())
    assert got == brute_negatives(rows, [r for r in rows if r[0] % 25 == 1])
    assert got
    assert HN.mine(vectors(spark, rows).limit(0), asked, rules).count() == 0
    assert HN.mine(vectors(spark, odd), asked, rules).count() == 0


def test_mine_large_numbers(spark):
    """Products beyond 2**53 are exact, those beyond 64 bits are cut to the range's end."""
    rng = random.Random(2)
    rows = [(i, i % 2, [float(rng.randrange(1 << 30)) for _ in range(3)]) for i in range(60)]
    asked = F.col("id") % 10 == 0
    got = sorted(tuple(r) for r in HN.mine(vectors(spark, rows), asked, SMALL).collect())
    assert got == brute_negatives(rows, [r for r in rows if r[0] % 10 == 0])
    huge = [(i, i % 2, [1e200 * (i + 1)]) for i in range(20)]
    assert {r["positive_score"] for r in HN.mine(vectors(spark, huge), asked, SMALL).collect()} <= {HN.LONGEST}


def test_repeated_rows(spark):
    """Equal rows count as often as they occur; an anchor's own id is never its positive."""
    rows = [(0, 0, [10.0, 0.0]), (1, 0, [9.0, 0.0]), (1, 0, [9.0, 0.0]), (2, 1, [8.5, 0.0]), (2, 1, [8.5, 0.0])]
    got = HN.mine(vectors(spark, rows), F.col("id") == 0, SMALL).collect()
    assert sorted((r["positive_id"], r["rank"], r["negative_id"]) for r in got) == [(1, 1, 2), (1, 1, 2), (1, 2, 2), (1, 2, 2)]


def test_eliminated_leaves_hold_nothing():
    """No vector with a score in the window lies in a leaf that the ranges rule out; some leaves are ruled out."""
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 400, (20, 8))
    rows = np.floor(centres[rng.integers(0, 20, 3000)] + rng.normal(0, 20, (3000, 8)))
    tree = HN.Gnat(rows[:300], 3000, HN.SearchRules(fan=5, leaf_rows=100))
    leaf, seen = tree.place(rows)
    for (n, i, j), x in seen.items():
        tree.ranges.setdefault((n, j), np.zeros((len(tree.nodes[n].points), 2)))[i] = x
    square = (rows * rows).sum(1)
    tree.lengths = {int(x): (square[leaf == x].min(), square[leaf == x].max()) for x in np.unique(leaf)}
    anchors = rows[:40]
    scores = HN.products(anchors, rows)
    high = np.sort(scores, 1)[:, -5].astype(float)
    reach = tree.reach(anchors, np.ceil(0.8 * high), high)
    missed = [(a, x) for a in range(40) for x in np.flatnonzero((scores[a] >= 0.8 * high[a]) & (scores[a] <= high[a]))
              if not reach[a, leaf[x]]]
    assert not missed
    assert reach.mean() < 0.8


def test_hard_negatives_query(spark, sf_dir):
    rows = []
    for r in table(spark, sf_dir, "embeddings").collect():
        label = (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]
        rows.append((r["vec_id"], label, [math.floor(256 * float(x)) for x in r["embedding"]]))
    got = sorted(tuple(r) for r in Q.QUERIES["op11_hard_negatives"](spark, sf_dir).collect())
    assert got == brute_negatives(rows, [r for r in rows if r[0] % 100 == 0])


# -- SimHash


def brute_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """Smallest doc reachable for (doc, print) rows, by comparing all prints."""
    nodes = sorted(set(p for _, p in prints))
    root = {p: p for p in nodes}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    a = np.array(nodes, np.uint64)
    for i, p in enumerate(nodes):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= 3):
            root[find(p)] = find(nodes[i + 1 + j])
    least = {}
    for d, p in prints:
        r = find(p)
        if d is not None and (least.get(r) is None or d < least[r]):
            least[r] = d
    return sorted(((d, f"{p:016x}", least.get(find(p))) for d, p in prints), key=str)


def found(df):
    return sorted(((r["doc"], r["h"], r["component"]) for r in SH.simhash_components(df).withColumn(
        "h", SH.hex64(F.col("fp"))).collect()), key=str)


def test_simhash_query(spark, sf_dir):
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in Q.QUERIES["op13_simhash"](spark, sf_dir).collect()), key=str)
    assert got == classes([(d, brute_print(t)) for d, t in docs])


def test_simhash_edges(spark):
    on_workers(spark)
    long = " ".join(f"w{i % 997} émile" for i in range(40000))
    texts = [None, "", " \n\t", "One two", "one TWO", "ÉCOLE école", long, long.upper().replace("É", "é"), "a b c", "a b c d", "x" * 90000]
    rows = [(None if i == 4 else i // 2, t, "?", 0, 0) for i, t in enumerate(texts * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, doc string, fp long, component long")
    assert found(df) == classes([(r[0], brute_print(r[1])) for r in rows])
    assert SH.simhash_components(df.limit(0)).count() == 0


def test_golay_keys_meet():
    """Any two words at most three bits apart share a key, whichever side each is on; the code is perfect."""
    g = SH.golay()
    words = np.random.default_rng(1).integers(0, 1 << 23, 500)
    index, there = g.keys(words)
    assert set(there.sum(1).tolist()) == {1, 6}
    rng = np.random.default_rng(9)
    a = rng.integers(-2 ** 63, 2 ** 63 - 1, 400, dtype=np.int64)
    b = a.view(np.uint64).copy()
    for i in range(400):
        for j in rng.choice(64, 3, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(j)
    keys = [defaultdict(set), defaultdict(set)]
    for n, p in enumerate((a, b.view(np.int64))):
        for k, row, side in zip(*SH.keys_of(p)):
            keys[n][row, side].add(k)
    assert all(keys[0][i, 0] & keys[1][i, 1] and keys[0][i, 1] & keys[1][i, 0] for i in range(400))


@pytest.mark.parametrize("work", [64, 0])
def test_heavy_keys(spark, monkeypatch, work):
    """Chains of near prints in keys that count as heavy, with pivot rounds and compared in parts."""
    on_workers(spark)
    monkeypatch.setattr(SH, "LIGHT", 4)
    monkeypatch.setattr(SH, "WORK", work)
    rng = random.Random(6)
    prints = set()
    for centre in (0, 0x5A5A_5A5A_5A5A_5A5A, 0xFFFF_0000_FFFF_0000):
        p = centre
        for _ in range(250):
            # steps of up to four bits in the last segment: some chains break
            p = p if rng.random() < 0.8 else centre
            q = p
            for _ in range(rng.randrange(1, 5)):
                q ^= 1 << rng.randrange(43, 64)
            prints.add(q)
            p = q
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    from slotbook.llm.graph import components
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = SH.near_links(nodes)
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 3 for a, b in links.collect())
    got = {r["node"]: r["component"] for r in components(links).collect()}
    want = classes([(p, p) for p in prints])
    groups = defaultdict(set)
    for d, _, c in want:
        groups[c].add(d)
    mine = defaultdict(set)
    for p in prints:
        s = p - (1 << 64) if p >> 63 else p
        mine[got.get(s, s)].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))
    assert len(groups) > 3
