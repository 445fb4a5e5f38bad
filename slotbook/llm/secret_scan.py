"""Secret scans: fixed patterns, and sliding-window Shannon entropy over
candidate strings.

Everything is a column expression on the document's own row: no shuffle, no
Python.  A candidate is a maximal run of token characters; where parts of a run (between
``= / _ -``) hold a stand-in such as "sample", the rest of it on either side is taken instead.
A window slides over it with the counts of its characters kept up to date (one
character enters, one leaves), and with them the sum of c*log2(c) from which
the entropy follows; windows at or above the threshold of the candidate's
character class are merged into spans.  Candidates on the allow list are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotbook.llm.common import SPAN_TYPE, regex_spans, unused

# The base patterns.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ASSIGN_VALUE = 8
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LENGTH = 16
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"

# Candidate strings and harmless forms of them.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
ALLOWED = (
    r"^[0-9+/_=-]+$",                                                  # numbers, dates, rules
    r"^[A-Za-z+/_=-]+[0-9]{1,4}$",                                     # words, then a number
    r"^[0-9]{1,4}[A-Za-z+/_=-]+$",                                     # a number, then words
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",           # UUID
    # words, joined by signs or as humps
    r"^[+/_=-]*+(?:(?:[A-Z]?[a-z]{2,}+|[A-Z][a-z](?=[A-Z][a-z]{2})|[A-Z]{2,}+(?![a-z])|[A-Za-z](?![A-Za-z]))[+/_=-]*+)++$",
)
STAND_INS = (
    r"(?i:example|sample|placeholder|changeme|dummy|x{6})",
    r"(?i:0123456789|abcdefghij|qwertyuiop)",                          # runs of keys
)
SHORTEST = 20


@dataclass(frozen=True)
class EntropyClass:
    """A character class: its pattern, window length and threshold in bits."""
    name: str
    pattern: str
    window: int
    bits: float


# the first class whose pattern a candidate fits
CLASSES = (
    EntropyClass("hex", r"^[0-9a-fA-F]+$", 20, 3.0),
    EntropyClass("alnum", r"^[0-9A-Za-z]+$", 20, 3.6),
    EntropyClass("base64", r"^[0-9A-Za-z+/=_-]+$", 20, 3.6),
)


@dataclass(frozen=True)
class SecretRules:
    classes: tuple[EntropyClass, ...] = CLASSES
    allowed: tuple[str, ...] = field(default=ALLOWED)
    stand_ins: tuple[str, ...] = field(default=STAND_INS)


KINDS = ("assign", "access", "hex", "entropy")


def base_spans(text: Column) -> dict[str, Column]:
    """Spans (s, e, m, …) of the three base patterns; failing matches dropped."""
    assign = F.filter(regex_spans(text, ASSIGN), lambda x: F.length(
        F.regexp_extract(x["m"], f"^{ASSIGN}$", 1)) >= ASSIGN_VALUE)
    access = F.filter(regex_spans(text, ACCESS), lambda x: F.length(x["m"]) >= ACCESS_LENGTH)
    return {"assign": assign, "access": access, "hex": regex_spans(text, HEX)}


def _window_runs(cls: EntropyClass, m: str) -> str:
    """SQL: merged windows of string ``m`` with entropy >= the class's bits, as
    array<struct<s,e>> relative to the string.

    State: c, the count of each symbol in the window; z, the sum of c*log2(c);
    runs, the spans so far.  Entropy of a full window is log2(w) - z/w.
    """
    w = cls.window
    f = "array(" + ",".join(f"{c * math.log2(c) if c else 0.0!r}D" for c in range(w + 2)) + ")"
    most = (math.log2(w) - cls.bits) * w + 1e-9
    step = f"""
      element_at(transform(array(struct(
          element_at(k.ch, i + 1) AS x,
          IF(i >= {w}, element_at(k.ch, i + 1 - {w}), '') AS y)), o ->
        element_at(transform(array(struct(
            a.c[CAST(array_position(k.al, o.x) AS INT) - 1] AS cx,
            IF(o.y = '', 0, a.c[CAST(array_position(k.al, o.y) AS INT) - 1]) AS cy)), n ->
          element_at(transform(array(
              IF(o.x = o.y, a.z, a.z + k.f[n.cx + 1] - k.f[n.cx]
                 + IF(o.y = '', 0D, k.f[n.cy - 1] - k.f[n.cy]))), z ->
            named_struct(
              'c', transform(k.al, (s, j) -> a.c[j] + IF(s = o.x, 1, 0) - IF(s = o.y, 1, 0)),
              'z', z,
              'runs', CASE
                 WHEN i < {w - 1} OR z > {most!r}D THEN a.runs
                 WHEN size(a.runs) > 0 AND element_at(a.runs, -1).e >= i - {w - 1}
                   THEN concat(slice(a.runs, 1, size(a.runs) - 1), array(named_struct(
                          's', element_at(a.runs, -1).s, 'e', i + 1)))
                 ELSE concat(a.runs, array(named_struct('s', i - {w - 1}, 'e', i + 1))) END)
          ), 1)), 1)), 1)"""
    return f"""
      element_at(transform(array(named_struct(
          'ch', split({m}, ''), 'al', array_distinct(split({m}, '')), 'f', {f})), k ->
        aggregate(sequence(0, size(k.ch) - 1),
          named_struct('c', transform(k.al, s -> 0), 'z', 0D,
                       'runs', CAST(array() AS array<struct<s:int,e:int>>)),
          (a, i) -> {step}, a -> a.runs)), 1)"""


def candidates(text: Column, rules: SecretRules) -> Column:
    """Spans of the candidate strings that are not on the allow list."""
    part = f"(?![A-Za-z0-9+]*?(?:{'|'.join(rules.stand_ins) or '(?!)'}))[A-Za-z0-9+]++"
    rest = f"(?<![A-Za-z0-9+]){part}(?:[=/_-]++{part})*+=*+"       # parts without a stand-in

    def beside(x: Column) -> Column:
        some = F.filter(regex_spans(x["m"], rest), lambda y: F.length(y["m"]) >= SHORTEST)
        return F.transform(some, lambda y: F.struct(
            (x["s"] + y["s"]).alias("s"), (x["s"] + y["e"]).alias("e"), y["m"].alias("m"),
            y["l"].alias("l"), y["r"].alias("r")))

    runs = F.transform(regex_spans(text, CANDIDATE), lambda x: F.when(
        _any(x["m"], rules.stand_ins), beside(x).cast(SPAN_TYPE)).otherwise(F.array(x).cast(SPAN_TYPE)))
    return F.filter(F.flatten(runs), lambda x: ~_any(x["m"], rules.allowed))


def entropy_spans(found: str, rules: SecretRules) -> Column:
    """Spans (s, e) of the high-entropy stretches of the candidates in column
    ``found``, in code points of the text."""
    arms = " ".join(f"WHEN x.m RLIKE '{c.pattern}' THEN {_window_runs(c, 'x.m')}"
                    for c in rules.classes)
    none = "CAST(array() AS array<struct<s:int,e:int>>)"
    return F.expr(f"""flatten(transform(`{found}`, x -> transform(
        CASE {arms} ELSE {none} END,
        r -> named_struct('s', x.s + r.s, 'e', x.s + r.e))))""")


def _any(c: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | c.rlike(p)
    return out


def scan_secrets(docs: DataFrame, text: str = "text", rules: SecretRules = SecretRules(),
                 out: str = "secret_spans") -> DataFrame:
    """Add ``out``: all secret spans of a row, array<struct<s, k_no, e, k>> in
    order of start, then kind (assign, access, hex, entropy).

    Null text: treated as empty, no spans.  Empty and very long texts, repeated
    rows and empty tables need no special case: a row's spans depend on its own
    text only, and every input column is kept.  A column already named ``out``
    is replaced; the working column's name is chosen not to clash.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    cols = [F.col(f"`{c}`") for c in docs.columns if c != out]
    held, first = unused([*docs.columns, out], "candidates"), unused([*docs.columns, out], "base")
    base = base_spans(body)

    def tagged(spans: Column, k: int) -> Column:
        return F.transform(spans, lambda x: F.struct(
            x["s"].alias("s"), F.lit(k).alias("k_no"), x["e"].alias("e"),
            F.lit(KINDS[k]).alias("k")))

    step = docs.select(*cols, candidates(body, rules).alias(held), F.concat(
        *(tagged(base[k], i) for i, k in enumerate(KINDS[:3]))).alias(first))
    return step.select(*cols, F.array_sort(F.concat(
        F.col(first), tagged(entropy_spans(held, rules), 3))).alias(out))
