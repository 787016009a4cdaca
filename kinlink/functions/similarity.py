"""Similarity scores: two columns to a double, never null.

All are compositions of built-in functions. ``gate`` is the common rule for text: a null or empty side scores 1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinlink.functions.text import blank, characters, let, unit_lower, unit_text

# fixed values: the letter groups that count as near, and the scores and penalties of the affine alignment
NEAR_GROUPS = ["dt", "gj", "rl", "mn", "pbv", "aeuio", ",."]
SAME, NEAR, OTHER, GAP_OPEN, GAP_EXTEND = 5.0, 3.0, -3.0, 5.0, 1.0
# fixed values: token patterns
TOKENS = r"[\p{L}]+|[\p{N}]+"
NUMBERS = "[0-9]+"
PRODUCT_CODE = r"\s[a-zA-Z]{0,4}\s\d+\s([a-zA-Z]{0,4}\s)?|(\s?([a-z0-9A-Z]*\d+(\.\d+)?[a-z0-9A-Z]*)\s?)"



def _text(value: Column) -> Column:
    return value.cast("string")


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def gate(left: Column, right: Column, score: Column) -> Column:
    return F.when(blank(_text(left)) | blank(_text(right)), F.lit(1.0)).otherwise(score)


def exact(left: Column, right: Column) -> Column:
    return _flag(left.isNull() | right.isNull() | (left == right))


def string_base(left: Column, right: Column) -> Column:
    return gate(left, right, _flag(_text(left) == _text(right)))


def check_null(left: Column, right: Column) -> Column:
    return _flag(left.isNotNull() & right.isNotNull())


def check_blank_or_null(left: Column, right: Column) -> Column:
    return _flag(~blank(_text(left)) & ~blank(_text(right)))


def _wrap_int(value: Column) -> Column:
    """A long cut to its low 32 bits, signed."""
    return F.shiftright(F.shiftleft(value, 32), 32)


def _wrap_add(a: Column, b: Column, carry: int = 0) -> Column:
    """64-bit addition that wraps: by halves, as plain addition raises on overflow."""
    mask = F.lit(0xFFFFFFFF).cast("long")
    low = a.bitwiseAND(mask) + b.bitwiseAND(mask) + F.lit(carry).cast("long")
    high = F.shiftrightunsigned(a, 32) + F.shiftrightunsigned(b, 32) + F.shiftrightunsigned(low, 32)
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(mask))


def _ratio(total: Column, apart: Column, least: int) -> Column:
    """Twice the absolute difference over the sum; the smallest integer has no absolute value and stays negative."""
    size = F.when(apart == F.lit(least), apart.cast("double")).otherwise(F.abs(apart.cast("double")))
    return F.coalesce(F.when(total == 0, F.lit(0.0)).otherwise(F.try_divide(2.0 * size, total.cast("double"))), F.lit(0.0))


def integer(left: Column, right: Column) -> Column:
    # sums of integers are checked one by one; those of doubles are not, and are exact here
    l, r = left.cast("int").cast("double"), right.cast("int").cast("double")
    return _ratio(_wrap_int((l + r).cast("long")), _wrap_int((l - r).cast("long")), -(2**31))


def long(left: Column, right: Column) -> Column:
    l, r = left.cast("long"), right.cast("long")
    return _ratio(_wrap_add(l, r), _wrap_add(l, F.bitwise_not(r), 1), -(2**63))


def _quotient(top: Column, bottom: Column) -> Column:
    """IEEE division: a zero divisor gives an infinity or NaN instead of an error."""
    at_zero = F.when((top == 0) | F.isnan(top), F.lit(float("nan"))).when(top > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    return F.coalesce(F.try_divide(top, bottom), at_zero)


def _floating(left: Column, right: Column, kind: str) -> Column:
    l, r = left.cast(kind), right.cast(kind)
    apart = F.abs((l - r).cast(kind)).cast("double")
    l, r = l.cast("double"), r.cast("double")
    usable = l.isNotNull() & r.isNotNull() & ~F.isnan(l) & ~F.isnan(r)
    return F.when(usable, 1.0 - _quotient(apart, 1.0 + l + r)).otherwise(F.lit(1.0))


def double(left: Column, right: Column) -> Column:
    return _floating(left, right, "double")


def float_(left: Column, right: Column) -> Column:
    return _floating(left, right, "float")


def date(left: Column, right: Column) -> Column:
    """On epoch milliseconds made from epoch days, so that no time zone matters."""
    day = F.lit(86_400_000).cast("long")
    l, r = F.unix_date(left.cast("date")).cast("long") * day, F.unix_date(right.cast("date")).cast("long") * day
    apart, total = (l - r).cast("double"), (l + r + 1).cast("double")
    return F.coalesce(1.0 - F.abs(F.try_divide(apart, total)), F.lit(1.0))


def array_double(left: Column, right: Column) -> Column:
    """Absolute cosine, at most 1; 0 where it is not defined."""
    l, r = left.cast("array<double>"), right.cast("array<double>")

    def score(x: Column) -> Column:
        pair = lambda f: F.aggregate(F.zip_with(x["l"], x["r"], f), F.lit(0.0), lambda total, v: total + v)
        norm = F.sqrt(pair(lambda a, b: a * a)) * F.sqrt(pair(lambda a, b: b * b))
        return F.when(norm > 0, F.least(F.lit(1.0), F.abs(F.try_divide(pair(lambda a, b: a * b), norm))))

    return F.coalesce(F.when((F.size(l) > 0) & (F.size(l) == F.size(r)), let(F.struct(l.alias("l"), r.alias("r")), score)), F.lit(0.0))


def _overlap(left: Column, right: Column, empty: Column) -> Column:
    """Shared over all of two sets of tokens; ``empty`` where neither has any."""
    return let(
        F.struct(left.alias("l"), right.alias("r")),
        lambda x: let(
            F.struct(F.size(F.array_intersect(x["l"], x["r"])).alias("both"), (F.size(x["l"]) + F.size(x["r"])).alias("all")),
            lambda n: F.when(n["all"] == 0, empty).otherwise(F.try_divide(n["both"].cast("double"), (n["all"] - n["both"]).cast("double"))),
        ),
    )


def _distinct(value: Column, pattern: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)))


def tokens(value: Column) -> Column:
    """The distinct tokens that ``jaccard`` compares; null and empty text, which score 1, have none and are null."""
    return F.when(~blank(_text(value)), _distinct(F.lower(_text(value)), TOKENS))


def jaccard_of_tokens(left: Column, right: Column) -> Column:
    """``jaccard`` of two texts from their ``tokens``, for texts that are compared more than once."""
    return F.when(left.isNull() | right.isNull(), F.lit(1.0)).otherwise(_overlap(left, right, F.lit(0.0)))


def jaccard(left: Column, right: Column) -> Column:
    return gate(left, right, _overlap(_distinct(F.lower(_text(left)), TOKENS), _distinct(F.lower(_text(right)), TOKENS), F.lit(0.0)))


def numbers_jaccard(left: Column, right: Column) -> Column:
    return F.coalesce(_overlap(_distinct(_text(left), NUMBERS), _distinct(_text(right), NUMBERS), F.lit(0.0)), F.lit(0.0))


def product_code(left: Column, right: Column) -> Column:
    codes = lambda v: F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(_text(v), F.lit("")), F.lit(PRODUCT_CODE), F.lit(0)), lambda t: F.replace(t, F.lit(" "), F.lit(""))))
    return _overlap(codes(left), codes(right), F.lit(1.0))


def jaro(left: Column, right: Column) -> Column:
    """Jaro with a window of half the shorter length plus one, and floored half transpositions.

    The second string is consumed: a matched character is overwritten with a mark, so ``locate`` finds the
    first free match in the window, and the marks tell in the end what was matched.
    """
    mark = ""

    def taken(x: Column) -> Column:
        size = F.length(x["b"])

        def step(state: Column, at: Column) -> Column:
            low = F.greatest(at - x["half"], F.lit(1))
            window = F.substring(state["rest"], low, F.greatest(F.least(size, at + x["half"]) - low + 1, F.lit(0)))
            return let(
                F.struct(F.substring(x["a"], at, 1).alias("c"), low.alias("low"), window.alias("window")),
                lambda w: let(
                    F.instr(w["window"], w["c"]),
                    lambda p: F.when(
                        p > 0,
                        F.struct(F.overlay(state["rest"], F.lit(mark), w["low"] + p - 1, F.lit(1)).alias("rest"), F.concat(state["hit"], w["c"]).alias("hit")),
                    ).otherwise(state),
                ),
            )

        return F.aggregate(F.sequence(F.lit(1), F.length(x["a"])), F.struct(x["b"].alias("rest"), F.lit("").alias("hit")), step)

    def score(x: Column) -> Column:
        def rate(state: Column) -> Column:
            there = F.filter(F.sequence(F.lit(1), F.length(x["b"])), lambda j: F.substring(state["rest"], j, 1) == mark)
            other = F.transform(there, lambda j: F.substring(x["b"], j, 1))
            crossed = F.size(F.filter(F.zip_with(characters(state["hit"]), other, lambda p, q: p != q), lambda odd: odd))
            n = F.length(state["hit"]).cast("double")
            parts = F.try_divide(n, F.length(x["a"]).cast("double")) + F.try_divide(n, F.length(x["b"]).cast("double")) + F.try_divide(n - F.floor(crossed / 2), n)
            return F.when(n == 0, F.lit(0.0)).otherwise(parts / 3.0)

        half = F.floor(F.least(F.length(x["a"]), F.length(x["b"])) / 2).cast("int") + 1
        return F.when(x["a"] == x["b"], F.lit(1.0)).otherwise(let(taken_state(x, half), rate))

    def taken_state(x: Column, half: Column) -> Column:
        return let(F.struct(x["a"].alias("a"), x["b"].alias("b"), half.alias("half")), taken)

    pair = F.struct(unit_lower(unit_text(_text(left))).alias("a"), unit_lower(unit_text(_text(right))).alias("b"))
    return gate(left, right, let(pair, score))


def _classed(text: Column) -> Column:
    """Letters of one near group become one character."""
    return F.translate(text, "".join(NEAR_GROUPS), "".join(chr(0xF000 + i) * len(g) for i, g in enumerate(NEAR_GROUPS)))


def aligned_text(value: Column, near: bool = False) -> Column:
    """A text as ``affine_gap`` compares it, or its letters' near groups."""
    text = unit_lower(unit_text(_text(value)))
    return _classed(text) if near else text


def aligned_letters(value: Column) -> Column:
    return characters(aligned_text(value))


def affine_gap(left: Column, right: Column) -> Column:
    """Local alignment with affine gaps: the best cell over five times the shorter length.

    Cells are filled diagonal by diagonal, as no cell needs another one of its own: each diagonal is one array made from the two
    before it, indexed by the letter of the left side. What lies outside has no element, which counts as 0 here. Letters of one near group
    share a class character.
    """
    zero, none = F.lit(0.0), F.array().cast("array<double>")

    def best(x: Column) -> Column:
        def step(state: Column, d: Column) -> Column:
            def match(i: Column) -> Column:
                other = d - i - 1
                alike = F.when(F.get(x["a"], i - 1) == F.get(x["b"], other), F.lit(SAME)).when(F.get(x["ka"], i - 1) == F.get(x["kb"], other), F.lit(NEAR)).otherwise(F.lit(OTHER))
                return F.greatest(zero, F.greatest(zero, F.get(state["m2"], i - 2), F.get(state["s2"], i - 2), F.get(state["t1"], i - 1)) + alike)

            down = F.transform(x["i"], lambda i: F.greatest(zero, F.get(state["m1"], i - 2) - GAP_OPEN, F.get(state["s1"], i - 2) - GAP_EXTEND))
            along = F.transform(x["i"], lambda i: F.greatest(zero, F.get(state["m1"], i - 1) - GAP_OPEN, F.get(state["t1"], i - 1) - GAP_EXTEND))
            return let(
                F.transform(x["i"], match),
                # the gaps' cells are below the match that they start from, so the best cell is a match
                lambda m: F.struct(state["m1"].alias("m2"), state["s1"].alias("s2"), m.alias("m1"), down.alias("s1"), along.alias("t1"), F.greatest(state["best"], F.array_max(m)).alias("best")),
            )

        first = F.struct(none.alias("m2"), none.alias("s2"), none.alias("m1"), none.alias("s1"), none.alias("t1"), zero.alias("best"))
        return F.aggregate(F.sequence(F.lit(2), F.size(x["a"]) + F.size(x["b"])), first, step, lambda end: end["best"])

    def score(x: Column) -> Column:
        size = F.least(F.length(x["a"]), F.length(x["b"])) * SAME
        letters = F.struct(
            F.sequence(F.lit(1), F.length(x["a"])).alias("i"),
            characters(x["a"]).alias("a"), characters(x["b"]).alias("b"),
            characters(_classed(x["a"])).alias("ka"), characters(_classed(x["b"])).alias("kb"),
        )
        return F.when(x["a"] == x["b"], F.lit(1.0)).when(size == 0, F.lit(0.0)).otherwise(let(letters, best) / size)

    pair = F.struct(unit_lower(unit_text(_text(left))).alias("a"), unit_lower(unit_text(_text(right))).alias("b"))
    return gate(left, right, let(pair, score))


def affine_gap_at_least(left: Column, right: Column) -> Column:
    """No more than ``affine_gap``: its best run without gaps of letters at equal places, in one pass."""

    def best(x: Column) -> Column:
        alike = lambda p, q: F.when(p == q, F.lit(SAME)).when(_classed(p) == _classed(q), F.lit(NEAR)).otherwise(F.lit(OTHER))
        step = lambda state, v: let(F.greatest(F.lit(0.0), state["run"] + v), lambda run: F.struct(run.alias("run"), F.greatest(state["best"], run).alias("best")))
        top = F.aggregate(F.zip_with(x["a"], x["b"], alike), F.struct(F.lit(0.0).alias("run"), F.lit(0.0).alias("best")), step, lambda end: end["best"])
        return F.coalesce(F.try_divide(top, F.least(F.size(x["a"]), F.size(x["b"])) * SAME), F.lit(0.0))

    pair = F.struct(aligned_letters(left).alias("a"), aligned_letters(right).alias("b"))
    return gate(left, right, let(pair, best))


def _before(value: Column, mark: str) -> Column:
    return F.substring_index(_text(value), mark, 1)


def email(left: Column, right: Column) -> Column:
    return gate(left, right, affine_gap(_before(left, "@"), _before(right, "@")))


def pin(left: Column, right: Column) -> Column:
    return gate(left, right, _flag(_before(left, "-") == _before(right, "-")))


def _letters_only(value: Column) -> Column:
    return F.translate(_text(value), "0123456789.", "")


def only_alphabets_exact(left: Column, right: Column) -> Column:
    return gate(left, right, _flag(_letters_only(left) == _letters_only(right)))


def only_alphabets_affine(left: Column, right: Column) -> Column:
    return gate(left, right, affine_gap(_letters_only(left), _letters_only(right)))


def same_first_word(left: Column, right: Column) -> Column:
    """Affine gap of what stands before the first hyphen."""
    return gate(left, right, affine_gap(_before(left, "-"), _before(right, "-")))


# fixed values: the public names of the functions
SIMILARITIES = {
    "SimilarityFunctionExact": exact,
    "StringSimilarityFunction": string_base,
    "CheckNullFunction": check_null,
    "CheckBlankOrNullFunction": check_blank_or_null,
    "IntegerSimilarityFunction": integer,
    "LongSimilarityFunction": long,
    "DoubleSimilarityFunction": double,
    "FloatSimilarityFunction": float_,
    "DateSimilarityFunction": date,
    "ArrayDoubleSimilarityFunction": array_double,
    "JaccSimFunction": jaccard,
    "NumbersJaccardFunction": numbers_jaccard,
    "ProductCodeFunction": product_code,
    "JaroWinklerFunction": jaro,
    "AJaroWinklerFunction": jaro,
    "AffineGapSimilarityFunction": affine_gap,
    "EmailMatchTypeFunction": email,
    "PinCodeMatchTypeFunction": pin,
    "OnlyAlphabetsExactSimilarity": only_alphabets_exact,
    "OnlyAlphabetsAffineGapSimilarity": only_alphabets_affine,
    "SameFirstWordFunction": same_first_word,
}
#: Known by name without a rule; asking for it raises.
UNSUPPORTED = {"BigramJaccSimFn"}
