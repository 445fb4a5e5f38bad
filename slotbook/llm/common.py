"""Helpers shared by the operators of this subpackage: reading a table,
writing an intermediate table to the shared folder, and column expressions
for regular-expression spans with code-point positions."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotbook.session import scratch_path

SPAN_TYPE = "array<struct<s:int,e:int,m:string,l:string,r:string>>"
BLOCK = 64   # elements per block of the two-level prefix sum


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def on_workers(spark: SparkSession) -> None:
    """Let local Python workers import this package from wherever the driver was
    started; on a cluster it is shipped with ``--py-files`` as usual."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Let at most so many rows go to a Python worker at once: a batch of texts is held by the JVM and by the
    worker, for each core.  A smaller number that the session has is kept."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    has = int(spark.conf.get(name))
    if has <= 0 or has > rows:
        spark.conf.set(name, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's own reader (any store)."""
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read
    back: cuts the lineage, survives a lost executor, and later actions reuse it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _add(a: Column, b: Column) -> Column:
    return a + b


def prefix_sums(lengths: Column) -> Column:
    """Exclusive running sums of an int array.  Two levels (blocks of
    ``BLOCK``) keep a text with very many matches far from quadratic."""
    zero = F.lit(0)

    def within(v: Column) -> Column:
        def one(_, i):
            b = (i / BLOCK).cast("int")
            return F.get(v["p"], b) + F.aggregate(
                F.slice(v["x"], b * BLOCK + 1, i - b * BLOCK), zero, _add)
        return F.transform(v["x"], one)

    def blocks(x: Column) -> Column:
        last = ((F.size(x) - 1) / BLOCK).cast("int")
        sums = F.transform(F.sequence(zero, F.greatest(last, zero)),
                           lambda b: F.aggregate(F.slice(x, b * BLOCK + 1, BLOCK), zero, _add))
        return let(sums, lambda s: let(
            F.struct(x.alias("x"),
                     F.transform(s, lambda _, b: F.aggregate(F.slice(s, 1, b), zero, _add))
                     .alias("p")), within))

    return let(lengths, blocks)


def regex_spans(text: Column, pattern: str, context: int = 0) -> Column:
    """Leftmost non-overlapping matches of a Java pattern as an array of
    (s, e, m, l, r): start and end in code points, the match and up to
    ``context`` characters of the text between it and the neighbouring matches.

    The pieces between matches (``split``) and the matches themselves come
    from the same scan order, so positions are running sums of their lengths.
    """
    empty = F.array().cast(SPAN_TYPE)

    def positions(v: Column) -> Column:
        lengths = F.transform(v["m"], lambda m, i: F.length(F.get(v["g"], i)) + F.length(m))

        def place(p: Column) -> Column:
            def one(m, i):
                start = F.get(p, i) + F.length(F.get(v["g"], i))
                left = F.substring(F.get(v["g"], i), F.lit(-context), F.lit(context)) \
                    if context else F.lit("")
                right = F.substring(F.get(v["g"], i + 1), F.lit(1), F.lit(context)) \
                    if context else F.lit("")
                return F.struct(start.alias("s"), (start + F.length(m)).alias("e"),
                                m.alias("m"), left.alias("l"), right.alias("r"))
            return F.transform(v["m"], one)

        return let(prefix_sums(lengths), place)

    found = let(F.struct(F.split(text, pattern, -1).alias("g"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")),
                positions)
    return F.when(text.rlike(pattern), found.cast(SPAN_TYPE)).otherwise(empty)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of (k, s, e) structs, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", x["k"], x["s"].cast("string"), x["e"].cast("string"))))


def redact(text: Column, spans: Column, tag: Callable[[Column], Column]) -> Column:
    """``text`` with each span (k, s, e) replaced by ``tag(kind)``; spans that
    overlap or touch inside one another are replaced once, by the first tag."""
    def cut(v: Column) -> Column:
        ends = F.transform(v["x"], lambda _, i: F.coalesce(
            F.array_max(F.transform(F.slice(v["x"], 1, i), lambda y: y["e"])), F.lit(0)))

        def pieces(e: Column) -> Column:
            body = F.transform(v["x"], lambda x, i: F.when(x["e"] <= F.get(e, i), F.lit("")).otherwise(
                F.concat(F.substring(v["t"], F.get(e, i) + 1,
                                     F.greatest(x["s"] - F.get(e, i), F.lit(0))),
                         F.when(x["s"] >= F.get(e, i), tag(x["k"])).otherwise(F.lit("")))))
            end = F.greatest(F.array_max(F.transform(v["x"], lambda y: y["e"])), F.lit(0))
            return F.concat(F.array_join(body, ""),
                            F.substring(v["t"], end + 1, F.length(v["t"])))
        return let(ends, pieces)

    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    return F.when(F.size(spans) == 0, text).otherwise(
        let(F.struct(text.alias("t"), ordered.alias("x")), cut))


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column (in any case) is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
