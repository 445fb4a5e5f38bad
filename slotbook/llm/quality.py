"""Quality rules from tokeniser fertility.

A public sentencepiece vocabulary, used as it is, measures every text: characters
per token, share of byte-fallback tokens, and entropy of the token histogram as
a share of its maximum.  Texts of one language sit close together in these
measures; keyboard noise, symbol-laden text or another script do not.  The bands are
quartile fences of each group (language, or script) over all its documents, and
the one for characters per token narrows with the root of the number of
tokens, as the spread of a mean does.  A few fixed rules on words come first.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotbook.llm.common import unused, written
from slotbook.llm.word_ids import slices
from slotbook.llm.word_memory import WordMemory, give_back, kept_encoder

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
SMALL = 100_000      # groups that may be broadcast: some 10 MB
MEASURES = pa.struct([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                      ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
                      ("n_tokens", pa.int64()), ("chars_per_token", pa.float64()),
                      ("byte_share", pa.float64()), ("entropy", pa.float64())])
MEASURES_DDL = ("struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,"
                "n_tokens:long,chars_per_token:double,byte_share:double,entropy:double>")


@dataclass(frozen=True)
class QualityRules:
    """Limits of the fixed rules and widths of the bands (in quartile ranges)."""
    min_words: int = 50
    max_repeat_percent: int = 50
    fertility_width: float = 4.0     # of deviations times the root of the token count
    fertility_slack: float = 0.01    # of the group's median, on top
    entropy_width: float = 3.0       # below the lower quartile
    byte_slack: float = 0.2          # above the upper quartile


class Pieces:
    """Piece ids of single words, each encoded once and kept."""

    def __init__(self, path: str):
        import sentencepiece
        give_back()       # what earlier work in this worker has freed, before words are kept
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.words = WordMemory(self._learn)

    def _learn(self, new: set[bytes]) -> dict[bytes, bytes]:
        order = list(new)
        ids = self.model.encode([w.decode("utf-8", "replace") for w in order], num_threads=1)
        return {w: np.array(i, "<u4").tobytes() for w, i in zip(order, ids, strict=True)}


def pieces(path: str) -> Pieces:
    return kept_encoder(path, Pieces)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    n = len(words) - 2
    if n < 2 or len(set(words)) == len(words):
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == n:
        return 0
    count = Counter(windows)
    total, covered = 0, -1
    for i, w in enumerate(windows):
        if count[w] > 1:
            total += i + 2 - max(covered, i - 1)
            covered = i + 2
    return total


def measure_text(text: str, words: list[bytes], pieces_of: list[bytes], data: bytes, p: Pieces) -> tuple:
    spaces = len(data) - len(data.translate(None, SPACE))
    lines = [x for x in data.split(b"\n") if x.strip(SPACE)]
    chars = len(text) - spaces
    ids = np.frombuffer(b"".join(pieces_of), "<u4")
    n = len(ids)
    if n:
        counts = np.unique(ids, return_counts=True)[1]
        entropy = 1.0 if n == 1 else float(1 - (counts * np.log2(counts)).sum() / (n * np.log2(n)))
        ratios = (chars / n, float(p.is_byte[ids].mean()), entropy)
    else:
        ratios = (None, None, None)
    return (len(words), chars, len(data) - len(data.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), n, *ratios)


def measures(text: Column, path: str) -> Column:
    """Struct of the measures of each text (null: as empty).

    Marked as if results could differ, so that Spark takes a row's measures once: a filter on them would else
    move below a join as a second call, with a second worker for each core.
    """
    @F.arrow_udf(MEASURES_DDL)
    def measure(column: pa.Array) -> pa.Array:
        p, out = pieces(path), []
        # some megabytes at a time: no more of a batch is held as Python objects
        for a, z in slices(column):
            some = [t or "" for t in column.slice(a, z - a).to_pylist()]
            data = [t.encode("utf-8", "replace") for t in some]
            words = [d.split() for d in data]
            out += [measure_text(t, w, i, d, p) for t, w, i, d in zip(some, words, p.words.values(words), data, strict=True)]
        cols = zip(*out, strict=True) if out else [[] for _ in MEASURES]
        return pa.StructArray.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(cols, MEASURES, strict=True)], fields=list(MEASURES))

    return measure.asNondeterministic()(text)


def base_failed(q: Column, rules: QualityRules) -> Column:
    return (q["n_words"] < rules.min_words) | (
        100 * q["n_repeat_words"] > rules.max_repeat_percent * q["n_words"])


def measured(docs: DataFrame, path: str, group: str = "lang", text: str = "text",
             out: str = "quality") -> DataFrame:
    """Add ``out``: the measures of each row, and the group its band is of."""
    cols = [F.col(f"`{c}`") for c in docs.columns if c != out]
    label = F.coalesce(F.col(group).cast("string"), F.lit("")) if group in docs.columns else F.lit("")
    raw = unused([*docs.columns, out], "measures")
    return docs.select(*cols, measures(F.col(text), path).alias(raw)).select(
        *cols, F.struct(f"{raw}.*", label.alias("band")).alias(out))


def fit_bands(q: DataFrame, rules: QualityRules = QualityRules(), out: str = "quality") -> DataFrame:
    """One row of fences per group, over all rows that pass the fixed rules.

    Quantile sketches merge map-side, so a group of any size is one small row per task.
    """
    ok = q.select(F.col(out)).filter(~base_failed(F.col(out), rules))
    # the median first: deviations are taken from it
    middle = ok.groupBy(F.col(f"{out}.band").alias("band")).agg(
        F.percentile_approx(f"{out}.chars_per_token", 0.5, 10000).alias("middle"))
    # one row per group, and broadcast if those are few, as counted: rows are not dealt out by group
    middle = written(middle, "band-middles")
    if middle.count() <= SMALL:
        middle = F.broadcast(middle)
    scaled = ok.withColumn("band", F.col(f"{out}.band")).join(middle, "band").withColumn(
        "z", (F.col(f"{out}.chars_per_token") - F.col("middle")) * F.sqrt(f"{out}.n_tokens"))
    quart = [0.25, 0.75]
    f = scaled.groupBy("band").agg(
        F.first("middle").alias("middle"),
        F.percentile_approx("z", quart, 10000).alias("z"),
        F.percentile_approx(f"{out}.entropy", quart, 10000).alias("h"),
        F.percentile_approx(f"{out}.byte_share", quart, 10000).alias("b"))
    return f.select(
        "band", "middle", ((F.col("z")[1] - F.col("z")[0]) * rules.fertility_width).alias("spread"),
        (F.col("middle") * rules.fertility_slack).alias("slack"),
        (F.col("h")[0] - rules.entropy_width * (F.col("h")[1] - F.col("h")[0])).alias("least_entropy"),
        (F.col("b")[1] + rules.byte_slack).alias("most_bytes"))


def judge(q: DataFrame, bands: DataFrame, rules: QualityRules = QualityRules(),
          out: str = "quality") -> DataFrame:
    """Add base_failed and kept to ``q`` (columns of these names are replaced).

    Null or empty text: no words, so base_failed.  A group without a band (no
    document passes the fixed rules) rejects by those alone.  Repeated rows are judged alike.
    """
    cols = [F.col(f"q.`{c}`") for c in q.columns if c not in ("base_failed", "kept")]
    m = F.col(f"q.{out}")
    outside = (F.abs(m["chars_per_token"] - F.col("f.middle"))
               > F.col("f.slack") + F.col("f.spread") / F.sqrt(m["n_tokens"])) \
        | (m["entropy"] < F.col("f.least_entropy")) | (m["byte_share"] > F.col("f.most_bytes"))
    failed = base_failed(m, rules)
    # one row per group: Spark broadcasts it when its measured size allows
    return q.alias("q").join(bands.alias("f"), m["band"] == F.col("f.band"), "left").select(
        *cols, failed.alias("base_failed"),
        (~failed & ~F.coalesce(outside, F.lit(False))).alias("kept"))
