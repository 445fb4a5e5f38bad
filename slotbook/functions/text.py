"""Text functions as ``Column -> Column`` expressions (JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotbook.specs import COST_TYPE

# Java's String.trim strips every character up to U+0020, not only spaces.
_JTRIM_CHARS = "".join(chr(i) for i in range(0x21))
# Characters that are special in a Java regex outside a character class.
_REGEX_META = ".$|()[{^?*+\\"


def quote_regex(sep: str) -> str:
    """A Java regex matching ``sep`` literally (Spark's split takes a regex).

    A one-character separator is given as itself (or backslash-escaped when
    it is a regex metacharacter): Java's ``String.split`` then splits on the
    character directly instead of compiling a pattern for every row."""
    if len(sep) == 1 and not ("\ud800" <= sep <= "\udfff"):
        return "\\" + sep if sep in _REGEX_META else sep
    return r"\Q" + sep.replace(r"\E", r"\E\\E\Q") + r"\E"


def jtrim(c: Column) -> Column:
    """Trim as Java's String.trim does (Q25): every character up to U+0020
    at either end; a plain character-set trim, no regular expression."""
    return F.btrim(c, F.lit(_JTRIM_CHARS))


def split_keep(c: Column, sep: str) -> Column:
    """Split on a literal separator keeping trailing empty fields."""
    return F.split(c, quote_regex(sep), -1)


def part(arr: Column, i: int) -> Column:
    """Element ``i`` of an array, '' when the array is shorter (P10)."""
    return F.coalesce(F.get(arr, i), F.lit(""))


def split_fixed(c: Column, sep: str, length: int) -> list[Column]:
    """P10: the first ``length`` parts of ``c``, missing ones as ''.

    A longer input is not cut by the reference; only indexes below
    ``length`` are ever read, so returning those is equivalent.
    """
    arr = split_keep(F.coalesce(c, F.lit("")), sep)
    return [part(arr, i) for i in range(length)]


def first_element(c: Column, sep: str) -> Column:
    """The text before the first ``sep`` (whole text when absent)."""
    return part(split_keep(F.coalesce(c, F.lit("")), sep), 0)


def url_domain(c: Column) -> Column:
    """text after the first '://' up to the next '/'; '' without '://'.

    Keeps a port and a '?query' that has no slash; unlike parse_url it does
    not need a well-formed URL.
    """
    pos = F.instr(c, "://")
    rest = F.substring_index(F.substr(c, pos + F.lit(3)), "/", 1)
    return F.when(pos > 0, rest).when(pos == 0, F.lit(""))


def blank_to_zero(c: Column) -> Column:
    """A blank (or absent) key part becomes '0' at the table boundary."""
    return F.when(jtrim(F.coalesce(c, F.lit(""))) == "", F.lit("0")).otherwise(c)


def java_long(c: Column) -> Column:
    """The value of ``c`` as Java's Long.parseLong reads it, else null."""
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("bigint"))


def decimal_or_null(c: Column, dtype: str = COST_TYPE) -> Column:
    """Decimal value of a numeric text (surrounding blanks ignored), else null."""
    return jtrim(c).try_cast(dtype)
