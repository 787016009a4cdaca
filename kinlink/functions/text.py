"""Text helpers that keep UTF-16 code-unit semantics inside Spark SQL expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Private-use stand-ins: surrogate units D800-DFFF become E000-E7FF, so that every unit is one character.
ASTRAL = "[\\x{10000}-\\x{10FFFF}]"
DOTTED_I = ""


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row: lambda variables are bound, repeated expressions are not."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unit_text(value: Column) -> Column:
    """The string with one character for each UTF-16 unit. Strings without astral characters stay as they are."""
    code = F.hex(F.encode(value, "UTF-16BE"))
    units = F.regexp_extract_all(code, F.lit("(....)"), F.lit(1))
    moved = F.transform(units, lambda u: F.when(u.rlike("^D[89A-F]"), F.concat(F.lit("E"), F.translate(F.substring(u, 2, 1), "89ABCDEF", "01234567"), F.substring(u, 3, 2))).otherwise(u))
    return F.when(value.rlike(ASTRAL), F.decode(F.unhex(F.array_join(moved, "")), "UTF-16BE")).otherwise(value)


def plain_text(units: Column) -> Column:
    """Back from ``unit_text``; a unit of a split pair, which no string can hold, stays a private-use character."""
    paired = units.rlike("[\\x{E000}-\\x{E3FF}][\\x{E400}-\\x{E7FF}]")
    code = F.hex(F.encode(units, "UTF-16BE"))
    back = F.regexp_extract_all(code, F.lit("(E[0-3]..E[4-7]..|....)"), F.lit(1))
    joined = F.transform(
        back,
        lambda u: F.when(
            F.length(u) == 8, F.concat(F.lit("D"), F.translate(F.substring(u, 2, 1), "0123", "89AB"), F.substring(u, 3, 2), F.lit("D"), F.translate(F.substring(u, 6, 1), "4567", "CDEF"), F.substring(u, 7, 2))
        ).otherwise(u),
    )
    return F.when(paired, F.decode(F.unhex(F.array_join(joined, "")), "UTF-16BE")).otherwise(units)


def unit_lower(units: Column) -> Column:
    """Lower case unit by unit: without the final sigma's context, and with the dotted capital I as a letter of its own."""
    return F.lower(F.translate(units, "Σİ", "σ" + DOTTED_I))


def characters(units: Column) -> Column:
    """The characters of a string as an array; of the empty string, the empty array."""
    return F.when(F.length(units) == 0, F.array().cast("array<string>")).otherwise(F.split(units, ""))


def blank(value: Column) -> Column:
    return value.isNull() | (F.length(value) == 0)
