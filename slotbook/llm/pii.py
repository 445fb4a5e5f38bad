r"""Personal data: fixed patterns, and information-theoretic sanitisation of the
terms that give protected entities away.

Protected entities are the values that the patterns find (an e-mail address, a number) and
the classes that they belong to: their kind, and an address's domain, a network's prefix, a card's
issuer, a phone's country and area.  Over the whole corpus, a term discloses an entity
as far as their point-wise mutual information goes,

    PMI(t, e) = log2( n(t, e) * N / (n(t) * n(e)) ),

measured against the entity's own information log2(N / n(e)); n(e), n(t) and n(t, e) count the
documents that hold the entity, the term, and both.  A term that gives away at least ``alpha`` of it,
and was met together with the entity in enough different texts, is a span of its own wherever it
stands, also in documents without the entity: a ``term`` if it discloses a value, to be removed; a
``hint`` if it discloses a class alone, to be generalised.

Column functions throughout.  One pass finds the base spans and, for the documents that have
some, their words; a second counts the candidate terms over all documents, a third finds the texts that
hold those over the threshold.  Words are combined or filtered before anything is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotbook.llm.common import redact, regex_spans, unused, written

# The base patterns.  Possessive quantifiers and the look-behind (a match
# can only start where its first run starts, or where the match before it ended) find the same
# matches as the plain patterns in one pass over long runs.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"
KINDS = ("email", "ip", "card", "phone", "term", "hint")

# a term: a word of letters alone that is no part of an address or a number
TERM = r"(?<![\p{L}\p{N}@._%+-])\p{L}{3,}+(?![\p{L}\p{N}@]|[._%+-][\p{L}\p{N}])"
SMALL = 200_000      # terms that may be broadcast: some 10 MB
FEW = 20_000         # texts with their terms or spans that may be broadcast


@dataclass(frozen=True)
class Disclosure:
    """Share of an entity's information that a term may give away, and the numbers of different texts that
    must show it together with a value, or with a class."""
    alpha: float = 0.9
    support: int = 2
    class_support: int = 3


def base_spans(text: Column) -> dict[str, Column]:
    """Valid spans of each base kind, in order."""
    def digits(x: Column) -> Column:
        return F.regexp_replace(x["m"], "[^0-9]", "")

    return {
        "email": regex_spans(text, EMAIL),
        "ip": F.filter(regex_spans(text, IP), lambda x: x["m"].rlike(IP_PARTS)),
        "card": F.filter(regex_spans(text, CARD), lambda x: F.length(digits(x)).between(13, 19)
                         & F.call_function("luhn_check", digits(x))),
        "phone": F.filter(regex_spans(text, PHONE),
                          lambda x: F.length(digits(x)).between(9, 15)),
    }


def entities(kind: str, x: Column) -> Column:
    """The entities of a match: (name, whether it is a class)."""
    value = x["m"] if kind == "ip" else F.lower(x["m"]) if kind == "email" else F.regexp_replace(x["m"], "[^0-9]", "")
    group = {"email": lambda v: F.substring_index(v, "@", -1), "ip": lambda v: F.substring_index(v, ".", 2),
             "card": lambda v: F.substring(v, 1, 6), "phone": lambda v: F.substring(v, 1, 4)}[kind](value)

    def entity(*parts: Column, of_class: bool) -> Column:
        return F.struct(F.concat(F.lit(f"{kind}:"), *parts).alias("entity"), F.lit(of_class).alias("of_class"))

    return F.array(entity(F.lit("="), value, of_class=False), entity(F.lit("~"), group, of_class=True), entity(of_class=True))


def words_of(text: Column) -> Column:
    """The different terms of a text, lower-cased one by one as they are found."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def find_base(docs: DataFrame, keep: list[str], text: str, out: str, near: str, text_key: str) -> DataFrame:
    """``keep`` columns, base spans array<struct<k,s,e>>, a key of the text, and ``near``: the entities found
    and the text's words (null without entities)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kinds = KINDS[:4]
    held = {k: unused([*keep, text, out, near, text_key], f"spans_{k}") for k in kinds}
    base = base_spans(body)
    cols = [F.col(f"`{c}`") for c in keep]
    found = docs.select(*cols, body.alias(unused([*keep, *held.values(), out, near, text_key], "body")),
                        *(base[k].alias(held[k]) for k in kinds))
    body = F.col(found.columns[len(keep)])

    def named(kind: str) -> Column:
        return F.transform(held[kind], lambda x: F.struct(
            F.lit(kind).alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    def entities_of(kind: str) -> Column:
        return F.flatten(F.transform(held[kind], lambda x: entities(kind, x)))

    every = F.array_distinct(F.concat(*map(entities_of, kinds)))
    some = F.size(F.concat(*(named(k) for k in kinds))) > 0
    return found.select(
        *cols, F.xxhash64(body).alias(text_key), F.concat(*(named(k) for k in kinds)).alias(out),
        F.when(some, F.struct(every.alias("entities"), words_of(body).alias("words"))).alias(near))


def _few(df: DataFrame, most: int = SMALL) -> DataFrame:
    """For broadcast if its rows are few, as counted."""
    return F.broadcast(df) if df.count() <= most else df


def disclosing_terms(found: DataFrame, docs: DataFrame, text: str, d: Disclosure, near: str, text_key: str) -> DataFrame:
    """(entity, of_class, term, n_te, n_t, n_e) of the pairs over the threshold.  ``found``: rows of ``find_base``."""
    total = float(found.count())
    # each different text once, with the number of its documents
    texts = found.filter(F.col(near).isNotNull()).groupBy(F.col(text_key).alias("of")).agg(
        F.count("*").alias("copies"), F.first(near).alias("near"))
    held = texts.select("copies", F.explode("near.entities").alias("x"), F.col("near.words").alias("words")).select(
        "copies", "x.entity", "x.of_class", "words")
    sizes = written(held.groupBy("entity").agg(F.sum("copies").alias("n_e")), "pii-entities")
    least = F.when(F.col("of_class"), d.class_support).otherwise(d.support)
    pairs = written(held.select("copies", "entity", "of_class", F.explode("words").alias("term"))
                    .groupBy("entity", "of_class", "term").agg(F.sum("copies").alias("n_te"), F.count("*").alias("texts"))
                    .filter(F.col("texts") >= least).join(_few(sizes), "entity"), "pii-pairs")
    info, n = F.log2(F.lit(total) / F.col("n_e")), F.lit(total)
    pairs = pairs.filter(info > 0)
    terms = pairs.select("term").distinct()
    every = docs.select(F.explode(words_of(F.coalesce(F.col(text).cast("string"), F.lit("")))).alias("term"))
    counts = every.join(_few(terms), "term").groupBy("term").agg(F.count("*").alias("n_t"))
    pmi = F.log2(F.col("n_te") * n / (F.col("n_t") * F.col("n_e")))
    return pairs.join(counts, "term").filter(pmi >= d.alpha * info).select(
        "entity", "of_class", "term", "n_te", "n_t", "n_e")


def _marks(docs: DataFrame, pairs: DataFrame, text: str) -> DataFrame:
    """(of, marks): the spans of disclosing terms in each text that holds some."""
    flagged = written(pairs.groupBy("term").agg(F.min("of_class").alias("of_class")), "pii-terms")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.xxhash64(body).alias("of"), body.alias("body"))
    hit = (texts.select("of", F.explode(words_of(F.col("body"))).alias("term")).join(_few(flagged), "term")
           .groupBy("of").agg(F.collect_set(F.when(~F.col("of_class"), F.col("term"))).alias("terms"),
                              F.collect_set(F.when(F.col("of_class"), F.col("term"))).alias("hints")))
    hit = written(hit, "pii-texts")

    def marked(kind: str, words: str) -> Column:
        return F.transform(F.filter("all", lambda x: F.array_contains(words, F.lower(x["m"]))), lambda x: F.struct(
            F.lit(kind).alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    found = texts.join(_few(hit, FEW), "of").dropDuplicates(["of"]).withColumn("all", regex_spans(F.col("body"), TERM))
    return found.select("of", F.concat(marked("term", "terms"), marked("hint", "hints")).alias("marks"))


def find_personal_data(docs: DataFrame, text: str = "text", d: Disclosure = Disclosure(),
                       out: str = "pii_spans", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) and ``out``: the spans of a row, array<struct<k,s,e>>, ordered by
    kind (email, ip, card, phone, term, hint), then start.

    Null text is empty and has no spans.  Texts of any length and any number of matches, repeated rows
    (equal texts get equal spans, and are one text as support) and empty tables are handled; a column called ``out``
    is replaced.
    """
    keep = [c for c in (keep if keep is not None else docs.columns) if c != out]
    near, text_key = unused([*docs.columns, out], "near"), unused([*docs.columns, out], "text_key")
    found = written(find_base(docs, keep, text, out, near, text_key), "pii-base")
    pairs = written(disclosing_terms(found, docs, text, d, near, text_key), "pii-disclosing")
    cols = [F.col(f"`{c}`") for c in keep]
    if pairs.isEmpty():
        return found.select(*cols, out)
    of, marks = unused([*docs.columns, out], "text_of"), unused([*docs.columns, out], "marks")
    spans = written(_marks(docs, pairs, text).select(F.col("of").alias(of), F.col("marks").alias(marks)), "pii-marks")
    none = F.array().cast("array<struct<k:string,s:int,e:int>>")
    return found.join(_few(spans, FEW), F.col(text_key) == F.col(of), "left").select(
        *cols, F.concat(F.col(out), F.coalesce(marks, none)).alias(out))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with values generalised to their kind, terms removed, and hints generalised."""
    return redact(text, spans, lambda k: F.when(k == "term", F.lit("")).otherwise(
        F.concat(F.lit("["), F.upper(k), F.lit("]"))))
