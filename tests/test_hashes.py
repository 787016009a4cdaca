import math

import pytest
from pyspark.sql import functions as F

from kinlink.functions import hashes
from kinlink.functions.hashes import HASHES
from kinlink.functions.preprocess import stop_words, vector_value
from kinlink.operators import blocking, registry

TEXTS = ["Lantern", None, "q", "", "øre ører", "two  words", "77.b", "  pad  "]
NUMBERS = [-250.6789, -3.0009, -0.0101, 0.0, 0.0101, 3.0009, 250.6789, 8.0]


def hashed(spark, name, values, kind):
    frame = spark.createDataFrame([(v,) for v in values], f"v {kind}").coalesce(1)
    return [r[0] for r in frame.select(HASHES[name](F.col("v"))).collect()]


def test_names():
    assert len(HASHES) == 54


def plain_last_word(v):
    if not v:
        return v
    words = v.rstrip(" ").split(" ")
    return words[-1] or None if v.rstrip(" ") else None


def test_text_hashes(spark):
    some = lambda f: [None if v is None else f(v) for v in TEXTS]
    for n in (1, 2, 3, 4):
        assert hashed(spark, f"first{n}Chars", TEXTS, "string") == some(lambda v: v[:n])
    for n in (1, 2, 3):
        assert hashed(spark, f"last{n}Chars", TEXTS, "string") == some(lambda v: v[-n:])
    assert hashed(spark, "lastWord", [*TEXTS, "   ", "p q  "], "string") == [plain_last_word(v) for v in [*TEXTS, "   ", "p q  "]]
    assert hashed(spark, "isNullOrEmpty", TEXTS, "string") == [not v for v in TEXTS]
    for name, bounds, n in (("first2CharsBox", hashes.BOX_2, 2), ("first3CharsBox", hashes.BOX_3, 3)):
        values = [*TEXTS, *(b + "m" for b in bounds), *(chr(ord(b[0]) - 1) + "zzzz" for b in bounds), bounds[0]]
        want = [0 if v is None or len(v) <= n else max((i for i, b in enumerate(bounds, 1) if v[:n] >= b), default=len(bounds) + 1) for v in values]
        assert hashed(spark, name, values, "string") == want
    assert hashed(spark, "first2Chars", ["🚲x"], "string") == ["🚲"]
    assert hashed(spark, "last3Chars", ["b🚲y"], "string") == ["🚲y"]


def test_truncate(spark):
    for n in (1, 2, 3):
        cut = [math.trunc(v * 10**n) / 10**n for v in NUMBERS]
        assert hashed(spark, f"truncateDoubleTo{n}Places", NUMBERS, "double") == pytest.approx(cut, abs=1e-12)
    # as floats, three places of which are no longer exact
    assert hashed(spark, "truncateFloatTo3Places", NUMBERS, "float") == pytest.approx([math.trunc(v * 1000) / 1000 for v in NUMBERS], abs=1.1e-3)


def test_trim_digits(spark):
    ints = [-437, 437, 8, -8, None]
    for n in (1, 2, 3):
        toward_zero = [None if v is None else int(v / 10**n) for v in ints]
        assert hashed(spark, f"trimLast{n}DigitsInt", ints, "int") == toward_zero
        assert hashed(spark, f"trimLast{n}DigitsLong", [2**61 + 5, -437], "long") == [(2**61 + 5) // 10**n, int(-437 / 10**n)]
        assert hashed(spark, f"trimLast{n}DigitsDbl", [-437.0, 437.0], "double") == [math.floor(-437 / 10**n), 437 // 10**n]


def test_ranges_and_signs(spark):
    assert hashed(spark, "rangeBetween10And100Dbl", [9.9, 10.0, 99.9, 100.0, None], "double") == [0, 1, 1, 0, 0]
    assert hashed(spark, "lessThanZeroInt", [-1, 0, None], "int") == [True, False, False]


def test_round(spark):
    # fixed values: what the definition (half up, then the nearest long) gives at its edges
    values = [None, float("nan"), -math.inf, -1.5, -0.5, 0.0, math.nextafter(0.5, 0), 0.5, 1.5, math.inf, 2.0**53 + 2]
    assert hashed(spark, "round", values, "double") == [None, 0, -(2**63), -1, 0, 0, 0, 1, 2, 2**63 - 1, 2**53 + 2]


def test_java_hash_and_tree(spark):
    frame = spark.createDataFrame([("",), ("|A",), ("|Al",), ("|null",), ("|😀",)], "v string").coalesce(1)
    assert [r[0] for r in frame.select(blocking.java_string_hash(F.col("v"))).collect()] == [0, 3909, 121287, 117909507, 1892063]
    tree = blocking.from_json(blocking.to_json(blocking.Node("first1Chars", "v", None, [blocking.Node("last1Chars", "v", "A"), blocking.Node("last2Chars", "v", None)])))

    def java(text):
        h = 0
        for c in text:
            h = (h * 31 + ord(c)) & 0xFFFFFFFF
        return h - 2**32 if h >= 2**31 else h

    df = spark.createDataFrame([("Ab",), ("xb",), (None,)], "v string").coalesce(1)
    assert [r["h"] for r in blocking.block_hashes(df, tree, "h").collect()] == [java("|A|b"), java("|x"), java("|null")]
    deep = blocking.Node("first1Chars", "v")
    for _ in range(97):
        deep = blocking.Node("first1Chars", "v", None, [deep])
    with pytest.raises(ValueError):
        blocking.block_hashes(df, deep, "h")


def test_candidates_and_learning(spark):
    rows = [(i, f"{'ab'[i % 2]}{i // 4} smith") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, name string")
    tree = blocking.learn_tree([{"l": {"name": "a1 smith"}, "r": {"name": "a1 smyth"}}], {"name": ["first1Chars", "lastWord", "first2Chars"]}, df, most_block=5)
    assert tree.function == "first2Chars"
    pairs = blocking.candidate_pairs(blocking.block_hashes(df, tree, "h"), None, "h", "id")
    want = {(i, j) for i, a in rows for j, b in rows if i < j and a[:2] == b[:2]}
    assert {(r["id"], r["z_id"]) for r in pairs.collect()} == want


def test_hot_blocks_are_dealt(spark):
    """A block above the bound gives the same pairs from several tasks, within one table and between two."""
    rows = [(i, "hot" if i % 3 else f"c{i % 7}", "ab"[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, b string, source string")
    for bound in (1000, 20):
        got = [(r["id"], r["z_id"]) for r in blocking.candidate_pairs(df, None, "b", "id", part_rows=bound).collect()]
        assert len(got) == len(set(got)) and set(got) == {(i, j) for i, x, _ in rows for j, y, _ in rows if i < j and x == y}
        got = [(r["id"], r["z_id"]) for r in blocking.candidate_pairs(df, df, "b", "id", part_rows=bound).collect()]
        assert len(got) == len(set(got)) and set(got) == {(i, j) for i, x, _ in rows for j, y, _ in rows if x == y}
        got = blocking.candidate_pairs(df, None, "b", "id", "z_", "source", bound).count()
        assert got == sum(i < j and x == y and s != t for i, x, s in rows for j, y, t in rows)


def test_preprocess(spark):
    df = spark.createDataFrame([(" The Cat AND dog ",), (None,), ("",)], "v string").coalesce(1)
    assert [r[0] for r in df.select(stop_words(F.col("v"), r"(?i)\b(?:the|and)\b")).collect()] == ["  Cat  dog ", None, ""]
    assert registry.preprocess(df, "trim", ["v"]).first()[0] == "The Cat AND dog"
    assert registry.preprocess(df, "case_normalize", ["v"]).first()[0] == " the cat and dog "
    with pytest.raises(ValueError):
        registry.preprocess(df, "trim", ["nope"])
    with pytest.raises(ValueError):
        registry.remove_stop_words(df, "v", None)


def test_vectors(spark):
    kind = "id long, vector struct<type:int,size:int,indices:array<int>,values:array<double>>"
    rows = [(0, (1, None, None, [0.5, 1.5])), (1, (0, 3, [0, 1], [0.9, 0.2])), (2, (0, 3, [0, 2], [0.9, 0.2])), (3, None), (4, (1, None, None, [0.5]))]
    assert [r[0] for r in spark.createDataFrame(rows, kind).coalesce(1).select(vector_value(F.col("vector"))).collect()] == [1.5, 0.2, 0.0, None, None]
