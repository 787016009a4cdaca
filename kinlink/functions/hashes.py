"""Blocking hashes: one column to a value that similar records share.

Families are made from their parameters: a name is a family, its parameter and, for numbers, the type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinlink.functions.text import plain_text, unit_text

Hash = Callable[[Column], Column]
KINDS = {"Dbl": "double", "Float": "float", "Int": "int", "Long": "long"}
# fixed values: upper ends of the prefix boxes
BOX_2 = ["aa", "jz", "oz"]
BOX_3 = ["aaa", "ezz", "izz", "mzz", "qzz", "uzz"]
RANGES = [(0, 10), (10, 100), (100, 1000), (1000, 10000)]


def first_chars(n: int) -> Hash:
    return lambda v: plain_text(F.substring(unit_text(v.cast("string")), 1, n))


def last_chars(n: int) -> Hash:
    return lambda v: plain_text(F.right(unit_text(v.cast("string")), F.lit(n)))


def last_word(v: Column) -> Column:
    """The last piece between spaces; only spaces give null, the empty string itself."""
    text = v.cast("string")
    trimmed = F.rtrim(text)
    return F.when(text == "", text).when(trimmed != "", F.substring_index(trimmed, " ", -1))


def is_null_or_empty(v: Column) -> Column:
    return F.coalesce(F.length(v.cast("string")) == 0, F.lit(True))


def box(bounds: list[str]) -> Hash:
    """0 for strings no longer than the bounds, else the number of the last bound not above the prefix, or one more than all."""
    n = len(bounds[0])

    def hashed(v: Column) -> Column:
        text = unit_text(v.cast("string"))
        prefix, out = F.substring(text, 1, n), F.lit(len(bounds) + 1)
        for i, low in enumerate(bounds, 1):
            out = F.when(prefix >= low, F.lit(i)).otherwise(out)
        return F.when(F.length(text) > n, out).otherwise(F.lit(0))

    return hashed


def less_than_zero(v: Column) -> Column:
    return F.coalesce(v < 0, F.lit(False))


def truncate(places: int, kind: str) -> Hash:
    """Toward zero at so many places, computed in double. Values too large for it have no places to cut."""

    def hashed(v: Column) -> Column:
        scaled = v.cast("double") * float(10**places)
        whole = F.when(scaled < 0, F.ceil(scaled)).otherwise(F.floor(scaled))
        return (whole / float(10**places)).cast(kind)

    return hashed


def trim_digits(digits: int, kind: str) -> Hash:
    """Integers divide toward zero, floating values are floored."""
    if kind in ("int", "long"):
        return lambda v: F.call_function("div", v, F.lit(10**digits)).cast(kind)
    return lambda v: F.floor(v.cast("double") / float(10**digits)).cast(kind)


def range_between(low: int, high: int, kind: str) -> Hash:
    out = "long" if kind == "long" else "int"
    return lambda v: F.coalesce(((v.cast("double") >= low) & (v.cast("double") < high)).cast("int"), F.lit(0)).cast(out)


def round_half_up(v: Column) -> Column:
    """Half up; NaN is 0, values beyond a long are its ends."""
    x = v.cast("double")
    low = F.floor(x)
    ends = F.when(F.isnan(x), F.lit(0)).when(x >= float(2**63), F.lit(2**63 - 1)).when(x <= float(-(2**63)), F.lit(-(2**63)))
    whole = F.abs(x) >= float(2**52)
    rounded = F.when(whole, low).otherwise(low + F.when(x - low >= 0.5, F.lit(1)).otherwise(F.lit(0)))
    return F.when(x.isNotNull(), F.coalesce(ends, F.when(~F.isnan(x) & (F.abs(x) < float(2**63)), rounded)).cast("long"))


def same(v: Column) -> Column:
    return v


def _all() -> dict[str, Hash]:
    out: dict[str, Hash] = {f"first{n}Chars": first_chars(n) for n in (1, 2, 3, 4)}
    out |= {f"last{n}Chars": last_chars(n) for n in (1, 2, 3)}
    out |= {"lastWord": last_word, "isNullOrEmpty": is_null_or_empty}
    out |= {f"identity{k}": same for k in ("String", "Integer", "Long", "Boolean")}
    out |= {"first2CharsBox": box(BOX_2), "first3CharsBox": box(BOX_3)}
    out |= {f"lessThanZero{k}": less_than_zero for k in KINDS}
    out |= {f"truncate{k}To{n}Places": truncate(n, k.lower()) for k in ("Double", "Float") for n in (1, 2, 3)}
    out |= {f"trimLast{n}Digits{k}": trim_digits(n, kind) for n in (1, 2, 3) for k, kind in KINDS.items()}
    out |= {f"rangeBetween{a}And{b}{k}": range_between(a, b, kind) for a, b in RANGES for k, kind in KINDS.items()}
    return out | {"round": round_half_up}


HASHES = _all()
