"""Bounds of similarity scores from fixed-size sketches of single values, for pairs that need no full score.

A sketch of a set is its size and a bitmap of 256 bits, one for each hash of an item. The bits of two bitmaps together are no more than
the items of the union, so what two sets share is bounded from above; collisions, and items without a bit, only loosen the bound.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinlink.functions import similarity
from kinlink.functions.similarity import NEAR, OTHER, SAME
from kinlink.functions.text import let

WORDS = 4
#: Longer strings have no sketch of their letters: the bitmap would be full, and counting letters is quadratic.
MOST_LETTERS = 256
#: Letters that have bits of their own, one a time that the letter stands in a string, while the bits last; other letters are hashed.
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "
#: Letters of a word of packed text, bits of a letter, and the beginnings of texts whose runs bound an alignment from below.
LANES, LANE = 10, 6
BEGINNINGS = [3, 4, 5, 6, 7, 8, 10, 12, 14, 16, 18, 20, 24, 28, 32, 40]

#: Scores of a few instructions, computed for every pair.
CHEAP = {
    "SimilarityFunctionExact", "StringSimilarityFunction", "CheckNullFunction", "CheckBlankOrNullFunction", "PinCodeMatchTypeFunction", "OnlyAlphabetsExactSimilarity",
    "IntegerSimilarityFunction", "LongSimilarityFunction", "DoubleSimilarityFunction", "FloatSimilarityFunction", "DateSimilarityFunction",
}
#: Of these the ones that may leave 0 to 1. All other scores are within.
UNBOUNDED = {"IntegerSimilarityFunction", "LongSimilarityFunction", "DoubleSimilarityFunction", "FloatSimilarityFunction", "DateSimilarityFunction"}
#: Scores that a bound from sketches may spare; the others are as costly as a letter alignment, or cheap.
COSTLY = {"AffineGapSimilarityFunction", "EmailMatchTypeFunction", "OnlyAlphabetsAffineGapSimilarity", "SameFirstWordFunction"}
#: Scores that a pass over both strings bounds from below.
AT_LEAST = {"AffineGapSimilarityFunction": similarity.affine_gap_at_least}


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _bits(items: Column) -> list[Column]:
    """The words of the bitmap of some items."""
    hashed = F.transform(items, lambda x: F.xxhash64(x))
    bit = lambda h: F.call_function("shiftleft", _long(1), F.shiftright(h, 2).bitwiseAND(_long(63)).cast("int"))
    word = lambda w: F.aggregate(F.filter(hashed, lambda h: h.bitwiseAND(_long(3)) == w), _long(0), lambda t, h: t.bitwiseOR(bit(h)))
    return [word(w) for w in range(WORDS)]


def _given(size: Column, words: list[Column], there: Column) -> Column:
    """A sketch; one of size 0 where there is none."""
    return F.when(there, F.array(size.cast("long"), *words)).otherwise(F.array(*(_long(0) for _ in range(len(words) + 1))))


def _tokens(tokens: Column) -> Column:
    return _given(F.size(tokens), _bits(tokens), tokens.isNotNull())


def _counted(text: Column) -> list[Column]:
    """The words of the bitmap of the letters of a text, repeats included."""
    a_word = -(-len(LETTERS) // WORDS)
    room = 64 // a_word
    other = F.array_sort(similarity.characters(F.translate(text, LETTERS, "")))
    numbered = F.transform(other, lambda c, i: F.concat(c, (i + 1 - F.array_position(other, c)).cast("string")))

    def run(i: int) -> Column:
        times = F.least(F.length(text) - F.length(F.replace(text, F.lit(LETTERS[i]), F.lit(""))), F.lit(room))
        return F.shiftleft(F.call_function("shiftleft", _long(1), times) - _long(1), i % a_word * room)

    own = [sum((run(i) for i in range(w * a_word, min((w + 1) * a_word, len(LETTERS)))), _long(0)) for w in range(WORDS)]
    strange = F.length(F.translate(text, LETTERS, "")) > 0
    return [x.bitwiseOR(F.when(strange, y).otherwise(_long(0))) for x, y in zip(own, _bits(numbered))]


def _fits(text: Column) -> Column:
    return F.coalesce((F.length(text) > 0) & (F.length(text) <= MOST_LETTERS), F.lit(False))


def _same(text: Column) -> Column:
    return _given(F.length(text), _counted(text), _fits(text))


def _near(text: Column) -> Column:
    """The pairs of letters, as near groups, that stand side by side; the size is that of the text, one more than theirs."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1))), lambda i: F.substring(text, i, 2))
    return _given(F.length(text), [F.when(F.length(text) > 1, w).otherwise(_long(0)) for w in _bits(pairs)], _fits(text))


def _lanes(text: Column) -> Column:
    """How many letters begin a text of known letters, and these letters, ten a word, six bits each."""
    code = lambda i: F.when(F.length(text) > i, F.instr(F.lit(LETTERS), F.substring(text, i + 1, 1)).cast("long")).otherwise(_long(0))
    words = [sum((F.shiftleft(code(LANES * w + i), LANE * i) for i in range(LANES)), _long(0)) for w in range(WORDS)]
    known = F.coalesce((F.length(text) > 0) & (F.length(F.translate(text, LETTERS, "")) == 0), F.lit(False))
    return _given(F.least(F.length(text), F.lit(LANES * WORDS)), words, known)


#: What a sketch is made from, and the sketch.
MADE: dict[str, tuple[Callable[[Column], Column], Callable[[Column], Column]]] = {
    "tokens": (similarity.tokens, _tokens),
    "same": (similarity.aligned_text, _same),
    "near": (lambda v: similarity.aligned_text(v, True), _near),
    "lanes": (similarity.aligned_text, _lanes),
}
SKETCHES: dict[str, Callable[[Column], Column]] = {kind: lambda v, made=made: let(made[0](v), made[1]) for kind, made in MADE.items()}
#: What a score needs of either side, and the score from both.
PREPARED = {"JaccSimFunction": (similarity.tokens, similarity.jaccard_of_tokens)}
#: What a score's bound is made from.
NEEDED = {"JaccSimFunction": ["tokens"], "AffineGapSimilarityFunction": ["same", "near"]}
#: The same of its bound from below; these stay arrays, since they are read of few pairs.
NEEDED_BELOW = {"AffineGapSimilarityFunction": ["lanes"]}


def prepared_column(name: str, field: str) -> str:
    return f"__{name}_{field}"


def sketch_columns(field: str, kind: str) -> list[str]:
    return [f"__{kind}_{field}_{i}" for i in range(WORDS + 1)]


def _all(sizes: tuple[Column, Column], words: list[str], prefix: str) -> Column:
    """At least as many items as the union has bits, or as the larger set has items. Doubles, since sums of integers are checked one by one."""
    bits = [F.bit_count(F.col(c).bitwiseOR(F.col(prefix + c))).cast("double") for c in words]
    return F.greatest(sum(bits[1:], bits[0]), *sizes)


def highest(name: str, field: str, prefix: str) -> Column:
    """No less than the score of a pair whose sides hold their sketches' columns; 1 without sketches."""
    one = F.lit(1.0)

    def sizes(kind: str, less: float = 0.0) -> tuple[Column, Column]:
        column = sketch_columns(field, kind)[0]
        a, b = F.col(column).cast("double"), F.col(prefix + column).cast("double")
        return (a - F.lit(less), b - F.lit(less)) if less else (a, b)

    def union(kind: str, less: float = 0.0) -> Column:
        return _all(sizes(kind, less), sketch_columns(field, kind)[1:], prefix)

    def shared(kind: str, less: float = 0.0) -> Column:
        a, b = sizes(kind, less)
        return a + b - union(kind, less)

    if name == "JaccSimFunction":
        ratio = F.try_divide(shared("tokens"), union("tokens"))
        return F.when(F.least(*sizes("tokens")) <= 0.0, one).otherwise(F.coalesce(ratio, one))
    if name == "AffineGapSimilarityFunction":
        # a letter that is aligned twice has paid a gap that costs no less than it gains; between aligned letters that are not side by side
        # stands a break that costs no less than a near letter gains, so only one more of them than the pairs shared gain that
        top = (shared("near", 1.0) + F.lit(1.0)) * F.lit(NEAR) + shared("same") * F.lit(SAME - NEAR)
        return F.when(F.least(*sizes("same")) <= 0.0, one).otherwise(F.least(one, F.coalesce(F.try_divide(top, F.least(*sizes("same")) * F.lit(SAME)), one)))
    return one


def lowest(name: str, field: str, prefix: str, apart: Callable[[int], Column] | None = None) -> Column:
    """No more than the score of a pair whose sides hold their sketches' columns; ``apart`` gives what ``differences`` gives."""
    if name != "AffineGapSimilarityFunction":
        return F.lit(0.0)
    apart = apart or differences(field, prefix)
    size = sketch_columns(field, "same")[0]
    first = lambda side: F.get(F.col(f"{side}__lanes_{field}"), F.lit(0))
    both = F.least(first(""), first(prefix))
    runs = []
    for n in BEGINNINGS:
        full = [F.bit_count(apart(w).bitwiseAND(_long(sum(1 << LANE * i for i in range(min(LANES, n - w * LANES)))))).cast("double") for w in range(WORDS) if n > w * LANES]
        runs.append(F.when(both >= n, F.lit(SAME * n) - sum(full[1:], full[0]) * F.lit(SAME - OTHER)).otherwise(F.lit(0.0)))
    return F.coalesce(F.try_divide(F.greatest(F.lit(0.0), *runs), F.least(F.col(size), F.col(prefix + size)) * F.lit(SAME)), F.lit(0.0))


def differences(field: str, prefix: str) -> Callable[[int], Column]:
    """By word of packed text, a bit for each letter that differs."""

    def apart(w: int) -> Column:
        x = F.get(F.col(f"__lanes_{field}"), F.lit(w + 1)).bitwiseXOR(F.get(F.col(f"{prefix}__lanes_{field}"), F.lit(w + 1)))
        some = x
        for i in range(1, LANE):
            some = some.bitwiseOR(F.shiftright(x, i))
        return some.bitwiseAND(_long(sum(1 << LANE * i for i in range(LANES))))

    return apart
