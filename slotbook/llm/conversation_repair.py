"""Repair of a conversation's structure by Hirschberg's divide and conquer.

A repaired conversation has the role initials ``(s?(ua)+)?``.  Four states say what
stands before a row: nothing, a system turn, a user turn, an assistant turn.  Every row
is kept, given the other role, or deleted, and empty turns may be inserted; from each
state only one role can be inserted or given, so the edits' initials (the audit) fix
the result.  A forward vector holds, for each state, the least cost to get there
and how the cheapest audits of the states compare as text; a backward vector holds the least
cost to the end.  They meet mid-conversation, the audit-least of the cheapest
crossings is taken, and both halves are solved alike: linear space.

A conversation is cut into blocks of bounded rows and bytes, so that one that holds a
third of all rows is dealt over many tasks.  Blocks are the leaves of the same
recursion: 4 x 4 matrices of vectors are multiplied up in groups of ``FAN``, then crossings are
chosen down the groups, and each block is solved between its two crossings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from slotbook.llm.common import written

SPACES = " \t\n\x0b\x0c\r"
BLOCK_ROWS = 20_000      # rows of a block, at most
BLOCK_BYTES = 4 << 20    # characters of a block, but for one row's
FAN = 256                # blocks solved together
#: What the edits cost.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FINE, CUT, GONE = 0, 1, 2            # a row: as it is, truncated, to be deleted
INITIALS = "sua"
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: the one state that an inserted or renamed user or assistant turn leads to
FORCED = (USER, USER, ASSISTANT, USER)
TAIL = ("", "II", "I", "")           # insertions from a state to a legal end
NEVER = 1 << 60
LEGAL = ("su", "ua", "au")


def _moves() -> list[list[dict[int, tuple[int, str]]]]:
    """For each row code and state before: state after -> (cost, audit), the cheapest, audit-least."""
    out = []
    for code in range(9):
        kind, initial = divmod(code, 4)
        extra = TRUNCATED if kind == CUT else 0
        table = []
        for before in range(4):
            best: dict[int, tuple[int, str]] = {}
            at = before
            for k in range(4):
                ways = [(at, DELETE, "D")]
                if kind != GONE:
                    ways.append((FORCED[at], RENAME + extra, "R"))
                    if initial < 3 and (at, INITIALS[initial]) in NEXT:
                        ways.append((NEXT[at, INITIALS[initial]], extra, "K"))
                for q, c, e in ways:
                    best[q] = min(best.get(q, (NEVER, "")), (c + INSERT * k, "I" * k + e))
                at = FORCED[at]
            table.append(best)
        out.append(table)
    return out


MOVES = _moves()
_ORDER = {a: i for i, a in enumerate(sorted({a for t in MOVES for b in t for _, a in b.values()}))}
#: for each row code and state after: (state before, cost << 8 | order of the audit) pairs.  A
#: vector's entry is cost << 8 | rank << 6: the rank of the state's audit among the four comes before
#: the order of the row's own audit, and no audit of the same rows is the beginning of another.
STEPS = [[[(p, c << 8 | _ORDER[a]) for p in range(4) for q2, (c, a) in t[p].items() if q2 == q] for q in range(4)]
         for t in MOVES]
assert len(_ORDER) <= 64


def code_of(initial: str, kind: int) -> int:
    return 8 if kind == GONE else 4 * kind + (INITIALS.find(initial) if initial else -1) % 4


def _ranked(values: list[int]) -> list[int]:
    """Entries with the ranks of their low eight bits in place of those."""
    order = sorted(v & 255 for v in values if v < NEVER)
    return [v if v >= NEVER else v >> 8 << 8 | order.index(v & 255) << 6 for v in values]


def _from(state: int) -> list[int]:
    return [0 if s == state else NEVER for s in range(4)]


def forward(codes: bytes, vector: list[int]) -> list[int]:
    for code in codes:
        vector = _ranked([min((min(vector[p] + s, NEVER) for p, s in ways), default=NEVER) for ways in STEPS[code]])
    return vector


def backward(codes: bytes, costs: list[int]) -> list[int]:
    for code in reversed(codes):
        costs = [min(c + costs[q] for q, (c, _) in MOVES[code][p].items()) for p in range(4)]
    return costs


def crossing(vector: list[int], costs: list[int]) -> int:
    """The state where the cheapest way crosses; of several, the one with the least audit."""
    return min((s for s in range(4) if vector[s] < NEVER), key=lambda s: ((vector[s] >> 8) + costs[s], vector[s] & 255))


def solve(codes: bytes, before: int, after: int) -> str:
    """The least of the cheapest audits that lead from one state to another."""
    if len(codes) < 2:
        return MOVES[codes[0]][before][after][1] if codes else ""
    half = len(codes) // 2
    meet = crossing(forward(codes[:half], _from(before)),
                    backward(codes[half:], [0 if s == after else NEVER for s in range(4)]))
    return solve(codes[:half], before, meet) + solve(codes[half:], meet, after)


def last_state(vector: list[int]) -> int:
    return crossing(vector, [INSERT * len(t) for t in TAIL])


def cost_of(audit: str, codes: bytes) -> int:
    rows, total = iter(codes), 0
    for e in audit:
        if e == "I":
            total += INSERT
            continue
        cut = TRUNCATED if next(rows) // 4 == CUT else 0
        total += DELETE if e == "D" else cut + (RENAME if e == "R" else 0)
    return total


def apply(audit: str, rows, state: int) -> list[tuple[str, str]]:
    """The messages that the edits make of the rows (role, text), from ``state`` on."""
    out, rest = [], iter(rows)
    for e in audit:
        if e == "I":
            state = FORCED[state]
            out.append(("user" if state == USER else "assistant", ""))
            continue
        role, text = next(rest)
        if e == "R":
            state = FORCED[state]
            out.append(("user" if state == USER else "assistant", text))
        elif e == "K":
            state = NEXT[state, role[0]]
            out.append((role, text))
    return out


# -- matrices of blocks: 16 entries, row = state before, column = state after


def matrix(codes: bytes) -> list[int]:
    return [v for p in range(4) for v in forward(codes, _from(p))]


def times(vector: list[int], m) -> list[int]:
    """A vector carried over a block: entry = cost, rank so far, rank inside the block."""
    out = []
    for q in range(4):
        out.append(min((NEVER if vector[p] >= NEVER or m[4 * p + q] >= NEVER else
                        (vector[p] >> 8) + (m[4 * p + q] >> 8) << 8 | (vector[p] >> 6 & 3) << 2 | m[4 * p + q] >> 6 & 3)
                       for p in range(4)))
    return _ranked(out)


def _product(matrices) -> list[int]:
    out = []
    for p in range(4):
        v = _from(p)
        for m in matrices:
            v = times(v, m)
        out += v
    return out


def _between(matrices, before: int, after: int) -> list[tuple[int, int]]:
    """(state before, state after) of each block on the audit-least cheapest way."""
    if len(matrices) == 1:
        return [(before, after)]
    half = len(matrices) // 2
    v = _from(before)
    for m in matrices[:half]:
        v = times(v, m)
    costs = [0 if s == after else NEVER for s in range(4)]
    for m in reversed(matrices[half:]):
        costs = [min((m[4 * p + q] >> 8) + costs[q] if m[4 * p + q] < NEVER else NEVER for q in range(4)) for p in range(4)]
    meet = crossing(v, costs)
    return _between(matrices[:half], before, meet) + _between(matrices[half:], meet, after)


# -- first pass: rows in order -> solved conversations and open blocks

MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
#: a block of rows: what is found in them, and either their solution or what solving needs
BLOCK_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int32()), ("solved", pa.bool_()),     # block: in its part
    ("min_turn", pa.int64()), ("max_turn", pa.int64()), ("turns", pa.int64()),
    ("first_initial", pa.string()), ("last_initial", pa.string()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("cost", pa.int64()), ("audit", pa.string()), ("messages", MESSAGES),
    ("codes", pa.binary()), ("matrix", pa.list_(pa.int64()))])
SOLVED_ARROW = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int32()),
                          ("cost", pa.int64()), ("audit", pa.string()), ("messages", MESSAGES)])


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema):
    """Rows as batches of some megabytes."""
    some, size = [], 0
    for r in rows:
        some.append(r)
        size += 200 + sum(len(m[0]) + len(m[1]) for m in r[schema.names.index("messages")] or ())
        if size > BLOCK_BYTES or len(some) >= 2000:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in some], schema)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in some], schema)


def _block(conv, part, block, rows, solved) -> tuple:
    turns = {r[1] for r in rows if r[1] is not None}
    codes = bytes(code_of(r[2][:1], CUT if r[4] == "truncated" else GONE if r[4] else FINE) for r in rows)
    initials = [r[2][:1] for r in rows]
    pairs = list(zip([r[2] for r in rows], [r[3] for r in rows], strict=True))
    audit = cost = None
    messages, kept = pairs, codes
    if solved:
        end = last_state(forward(codes, _from(START)))
        audit = solve(codes, START, end) + TAIL[end]
        cost, messages, kept = cost_of(audit, codes), apply(audit, pairs, START), None
    faults = [sum(r[4] == f for r in rows) for f in ("blank", "duplicate", "truncated")]
    return (conv, part, block, solved, min(turns, default=None), max(turns, default=None), len(turns),
            initials[0], initials[-1], *faults,
            sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, messages, kept, None if solved else matrix(codes))


def _blocks(batches, most: int):
    def found():
        conv, rows, size, block, part, first = None, [], 0, 0, 0, True
        for r in _rows(batches):
            if rows and r[0] != conv:
                # the first and the last conversation of a task may lie in other tasks too
                yield _block(conv, part, block, rows, not first)
                rows, size, block, first = [], 0, block + 1, False
            elif len(rows) >= most or size > BLOCK_BYTES:
                yield _block(conv, part, block, rows, False)
                rows, size, block, first = [], 0, block + 1, True     # all blocks of such a conversation are open
            conv, part = r[0], r[5]
            rows.append(r[:5])
            size += len(r[2]) + len(r[3])
        if rows:
            yield _block(conv, part, block, rows, False)
    return _batches(found(), BLOCK_ARROW)


def faults(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, ``fault`` (blank, duplicate, truncated or null), and uid and sig, which order
    the rows of one turn: by role, MD5 of the text, and place in the table."""
    tail = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    rows = written(rows.withColumns({
        "sig": F.md5("text"), "uid": F.monotonically_increasing_id(),
        "fault": F.when(tail == "", "blank").when(~F.substring(tail, -1, 1).isin(".", "!", "?"), "truncated")}), "turns")
    # the first of equal messages, where there are several: one narrow row each, combined before the shuffle
    again = (rows.filter("fault IS NULL OR fault <> 'blank'").groupBy("conv_id", "role", "sig")
             .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("turn", "uid")).alias("first")).filter("n > 1")
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("sig").alias("s"), "first.uid"))
    same = (F.col("conv_id").eqNullSafe(F.col("c"))) & (F.col("role") == F.col("r")) & (F.col("sig") == F.col("s"))
    return rows.join(again.withColumnRenamed("uid", "first_uid"), same, "left").select(
        "conv_id", "turn", "role", "text", F.when(F.col("uid") != F.col("first_uid"), "duplicate")
        .otherwise(F.col("fault")).alias("fault"), "sig", "uid")


def repair(conversations: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """Pieces of repaired conversations: conv_id, piece (0, 1, …), ``messages`` (role, text), ``audit``
    (initials of the edits Keep, Rerole, Delete, Insert), ``cost``, and of the rows as they came:
    min_turn, max_turn, turns (distinct, those of earlier pieces left out), blank, duplicate, truncated and
    illegal (neighbours that may not follow each other).  Most conversations are one piece;
    the audit and messages of larger ones are those of their pieces in order.

    ``conversations``: conv_id, turn, role, text; other columns are ignored.  Rows go by turn,
    null turns first; in one turn by role, MD5 of the text and place.  A null conv_id is one conversation; a
    null role or text is one space.  A role that starts with none of s, u, a - an empty one too - cannot be
    kept.  Empty texts are blank, very long ones are carried whole, repeated rows are
    duplicates, equally cheap repairs go by the ASCII-least audit; an empty table gives no piece.
    """
    spark = conversations.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = ["conv_id", "turn", "role", "sig", "uid"]
    ordered = faults(conversations).repartitionByRange(n, *key).sortWithinPartitions(*key)
    found = written(ordered.select("conv_id", "turn", "role", "text", "fault", F.spark_partition_id().alias("part"))
                    .mapInArrow(lambda b: _blocks(b, block_rows), from_arrow_schema(BLOCK_ARROW)), "blocks")
    stats = ["min_turn", "max_turn", "turns", "blank", "duplicate", "truncated", "illegal"]
    columns = ["conv_id", "piece", "messages", "audit", "cost", *stats]
    whole = found.filter("solved").withColumn("piece", F.lit(0).cast("long")).select(*columns)
    place = Window.partitionBy("conv_id").orderBy("part", "block")
    passed = place.rowsBetween(Window.unboundedPreceding, -1)
    joint = F.concat(F.lag("last_initial").over(place), F.col("first_initial"))
    open_blocks = written(found.filter("NOT solved").select(
        "conv_id", "part", "block", (F.row_number().over(place) - 1).cast("long").alias("piece"), "matrix", "min_turn",
        "max_turn", "blank", "duplicate", "truncated",
        (F.col("turns") - F.when(F.max("max_turn").over(passed) == F.col("min_turn"), 1).otherwise(0)).alias("turns"),
        (F.col("illegal") + F.when(~joint.isin(*LEGAL), 1).otherwise(0)).alias("illegal")), "open-blocks")
    ways = _ways(open_blocks.select("conv_id", F.col("piece").alias("i"), "matrix"), fan)
    placed = open_blocks.drop("matrix").join(
        ways.select(F.col("conv_id").alias("c"), "i", "before", "after", "last"),
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("i"))).drop("c", "i")
    texts = found.filter("NOT solved").select("part", "block", "messages", "codes")
    solved = placed.select("conv_id", "part", "block", "before", "after", "last").join(texts, ["part", "block"]).select(
        "conv_id", "part", "block", "before", "after", "last", "codes", "messages").mapInArrow(
        _solve_blocks, from_arrow_schema(SOLVED_ARROW))
    return whole.unionByName(solved.drop("conv_id").join(placed, ["part", "block"]).select(*columns))


def _solve_blocks(batches):
    def rows():
        for conv, part, block, before, after, last, codes, messages in _rows(batches):
            audit = solve(codes, before, after)
            cost = cost_of(audit, codes)
            if last:
                audit, cost = audit + TAIL[after], cost + INSERT * len(TAIL[after])
            yield conv, part, block, cost, audit, apply(audit, [(m["role"], m["text"]) for m in messages], before)
    return _batches(rows(), SOLVED_ARROW)


def _ways(blocks: DataFrame, fan: int) -> DataFrame:
    """conv_id, i, before, after, last: between which states each block lies.  Up: products of ``fan``
    neighbours until one is left; down: the crossings of each group, given its own ends."""
    levels = [blocks]
    while True:
        level = levels[-1].withColumn("g", F.floor(F.col("i") / fan).cast("long"))

        def up(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
            ms = [list(map(int, m)) for m in g.sort_values("i")["matrix"]]
            return pd.DataFrame({"conv_id": [g["conv_id"].iloc[0]], "i": [key[1]], "matrix": [_product(ms)]}).astype(
                {"conv_id": "Int64"})

        levels.append(written(level.groupBy("conv_id", "g").applyInPandas(
            up, "conv_id long, i long, matrix array<long>"), "products"))
        if levels[-1].filter("i > 0").isEmpty():
            break
    end = F.udf(lambda m: last_state(list(m[:4])), "int")
    ends = levels.pop().select("conv_id", "i", F.lit(START).alias("before"), end("matrix").alias("after"),
                               F.lit(True).alias("last"))
    for level in reversed(levels):
        parent = ends.select(F.col("conv_id").alias("c"), F.col("i").alias("g"), "before", "after", "last")
        rows = level.withColumn("g", F.floor(F.col("i") / fan).cast("long"))
        given = rows.join(parent.withColumnRenamed("g", "pg"),
                          F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("g") == F.col("pg"))).drop("c", "pg")

        def down(g: pd.DataFrame) -> pd.DataFrame:
            g = g.sort_values("i")
            ms = [list(map(int, m)) for m in g["matrix"]]
            ways = _between(ms, int(g["before"].iloc[0]), int(g["after"].iloc[0]))
            out = pd.DataFrame({"conv_id": g["conv_id"].astype("Int64"), "i": g["i"], "before": [b for b, _ in ways],
                                "after": [a for _, a in ways], "last": False})
            out.loc[out["i"] == out["i"].max(), "last"] = bool(g["last"].iloc[0])
            return out

        ends = written(given.groupBy("conv_id", "g").applyInPandas(
            down, "conv_id long, i long, before int, after int, last boolean"), "crossings")
    return ends


# -- summaries

SUMMARY_ARROW = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _digests(batches):
    def done(conv, h):
        return pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": h.hexdigest()}], SUMMARY_ARROW)

    conv, h, any_yet = None, None, False
    for c, _, messages in _rows(batches):
        if h is None or c != conv:
            if h is not None:
                yield done(conv, h)
            conv, h, any_yet = c, hashlib.sha256(), False
        for m in messages:
            h.update(("\n" if any_yet else "").encode() + f"{m['role']}:{m['text']}".encode("utf-8", "replace"))
            any_yet = True
    if h is not None:
        yield done(conv, h)


def summaries(pieces: DataFrame) -> DataFrame:
    """One row per conversation that has rows: gaps, faults, cost, audit and the digest of the repaired
    ``role:text`` lines.  Only the digest of a conversation of several pieces is taken in order, by streaming."""
    pieces = written(pieces, "pieces")
    several = pieces.filter("piece > 0").select(F.col("conv_id").alias("c")).distinct()
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    out = ["conv_id", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    one = pieces.join(several, same, "left_anti").withColumn("repaired_sha256", F.sha2(F.array_join(F.transform(
        "messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n"), 256))
    parts = pieces.join(several, same, "left_semi")
    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digests = (parts.select("conv_id", "piece", "messages").repartition(n, "conv_id")
               .sortWithinPartitions("conv_id", "piece").mapInArrow(_digests, from_arrow_schema(SUMMARY_ARROW)))
    sums = parts.groupBy("conv_id").agg(
        F.min("min_turn").alias("min_turn"), F.max("max_turn").alias("max_turn"),
        *[F.sum(c).alias(c) for c in ("turns", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "")
        .alias("audit"))
    many = sums.join(digests.withColumnRenamed("conv_id", "c"), same).drop("c")
    return one.select(*out).unionByName(many.select(*out))
