import math
import random

import pytest
from pyspark.sql import functions as F

from kinlink.functions import similarity as S
from kinlink.operators import registry

TEXT_PAIRS = [
    ("harbour", None), ("", ""), ("Lantern", "LANTERN"), ("brook", "broko"), ("ledger", "fledgling"), ("Zoë", "ZOË"), ("K-7 plum", "K7 plums"), ("🚲b", "🚲c"),
    ("four 4 five 5", "5 five 4"), ("qqq", "www"), (" x", "x "), ("p\tq", "p q"), ("oak oak elm", "elm oak"), ("[a]{2}", "[A]{2}"), ("naïve façade", "NAIVE façade"), ("98.6 F", "98 6 F"),
    ("north-east", "north east"), ("ΟΔΟΣ", "οδος"), ("İzmir", "izmir"), ("a", "aaaaaaaaaaaa"),
]


def units(text):
    data = text.encode("utf-16-be", "surrogatepass")
    return [data[i : i + 2] for i in range(0, len(data), 2)]


def lowered(text):
    return [u if 0xD8 <= u[0] <= 0xDF else tuple(units(u.decode("utf-16-be").lower())) if len(u.decode("utf-16-be").lower()) > 1 else units(u.decode("utf-16-be").lower())[0] for u in units(text)]


def plain_jaro(a, b):
    a, b = lowered(a), lowered(b)
    if a == b:
        return 1.0
    half, used, first = min(len(a), len(b)) // 2 + 1, [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - half), min(len(b), i + half + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                first.append(c)
                break
    second = [c for c, u in zip(b, used) if u]
    n = len(first)
    if not n:
        return 0.0
    crossed = sum(x != y for x, y in zip(first, second)) // 2
    return (n / len(a) + n / len(b) + (n - crossed) / n) / 3


def plain_affine(a, b):
    a, b = lowered(a), lowered(b)
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    near = [{c.encode("utf-16-be") for c in g} for g in S.NEAR_GROUPS]
    m, s, t = ([[0.0] * (len(b) + 1) for _ in range(len(a) + 1)] for _ in range(3))
    best = 0.0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            x, y = a[i - 1], b[j - 1]
            score = 5 if x == y else 3 if any(x in g and y in g for g in near) else -3
            m[i][j] = max(0, m[i - 1][j - 1] + score, s[i - 1][j - 1] + score, t[i][j - 1] + score)
            s[i][j] = max(0, m[i - 1][j] - 5, s[i - 1][j] - 1)
            t[i][j] = max(0, m[i][j - 1] - 5, t[i][j - 1] - 1)
            best = max(best, m[i][j], s[i][j], t[i][j])
    return best / (5 * min(len(a), len(b)))


def scores(spark, rows, kind, function):
    frame = spark.createDataFrame(rows, f"l {kind}, r {kind}").coalesce(1)
    return [r[0] for r in frame.select(function(F.col("l"), F.col("r"))).collect()]


def random_pairs(n):
    rng = random.Random(5)
    letters = "abdtgjmn,.é😀 "
    return [tuple("".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))) for _ in range(2)) for _ in range(n)]


@pytest.mark.parametrize("function,plain", [(S.jaro, plain_jaro), (S.affine_gap, plain_affine)])
def test_alignments_against_plain_loops(spark, function, plain):
    rows = TEXT_PAIRS + random_pairs(120)
    for (a, b), got in zip(rows, scores(spark, rows, "string", function)):
        want = 1.0 if not a or not b else plain(a, b)
        assert got == pytest.approx(want, abs=1e-9), (a, b)


def test_jaro_pinned(spark):
    rows = [("MARTHA", "MARHTA"), ("DWAYNE", "DUANE"), ("CRATE", "TRACE"), ("abc", "xyz"), ("Same", "same"), ("", "abc")]
    want = [0.9444444444444445, 0.8222222222222223, 0.9333333333333332, 0, 1, 1]
    assert scores(spark, rows, "string", S.jaro) == pytest.approx(want, abs=1e-12)
    assert scores(spark, [(b, a) for a, b in rows], "string", S.jaro) == pytest.approx(want, abs=1e-12)


def test_token_scores(spark):
    rows = [("New York", "new-york"), ("new york", "new jersey"), (None, "a"), ("..", "!!"), ("a1", "a 1")]
    assert scores(spark, rows, "string", S.jaccard) == pytest.approx([1, 1 / 3, 1, 0, 1])
    assert scores(spark, [("a 10", "b 10"), ("a", "b"), (None, "1"), ("1 2", "2 3")], "string", S.numbers_jaccard) == pytest.approx([1, 0, 0, 1 / 3])
    assert scores(spark, [(None, ""), ("x", None), ("ab12", "ab12 x"), ("ab12", "cd")], "string", S.product_code) == pytest.approx([1, 1, 1, 0])


def test_simple_rules(spark):
    rows = [(None, "a"), ("", "a"), ("a", "a"), ("a", "b"), (" ", "a")]
    assert scores(spark, rows, "string", S.exact) == [1, 0, 1, 0, 0]
    assert scores(spark, rows, "string", S.string_base) == [1, 1, 1, 0, 0]
    assert scores(spark, rows, "string", S.check_null) == [0, 1, 1, 1, 1]
    assert scores(spark, rows, "string", S.check_blank_or_null) == [0, 0, 1, 1, 1]
    assert scores(spark, [("12-3", "12-4"), ("1", "2")], "string", S.pin) == [1, 0]
    assert scores(spark, [("a1.b", "ab22"), ("a", "b")], "string", S.only_alphabets_exact) == [1, 0]
    assert scores(spark, [("@x", "ab@y"), ("ab@x", "ab@y")], "string", S.email) == [1, 1]
    assert scores(spark, [("ab-c", "ab-d"), ("12ab", "ab.")], "string", S.same_first_word)[0] == 1


def test_numbers_wrap_like_machine_integers(spark):
    top = 2**31 - 1
    assert scores(spark, [(top, 1), (-(2**31), 1), (5, 5), (3, -3), (None, 2), (7, 2)], "int", S.integer) == pytest.approx([2 * (top - 1) / -(2**31), 2 * top / -top, 0, 0, 0, 10 / 9])
    big = 2**63 - 1
    assert scores(spark, [(big, 1), (5, 7), (None, None)], "long", S.long) == pytest.approx([2 * (big - 1) / -(2**63), 4 / 12, 0])


def test_floating_and_dates(spark):
    got = scores(spark, [(1.0, 3.0), (None, 1.0), (float("nan"), 1.0), (-1.0, 0.0), (-0.5, -0.5)], "double", S.double)
    assert got[:3] == pytest.approx([1 - 2 / 5, 1, 1]) and got[3] == -math.inf and math.isnan(got[4])
    import datetime

    day = datetime.date
    rows = [(day(2020, 1, 1), day(2020, 1, 1)), (day(1970, 1, 1), day(1970, 1, 2)), (None, day(2020, 1, 1))]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kathmandu"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert scores(spark, rows, "date", S.date) == pytest.approx([1, 1 - 86400000 / 86400001, 1])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_arrays(spark):
    rows = [([1.0, 0.0], [0.0, 1.0]), ([1.0, 2.0], [2.0, 4.0]), ([1.0], [1.0, 2.0]), ([], []), (None, [1.0]), ([None, 1.0], [1.0, 1.0]), ([0.0], [0.0]), ([1.0], [-1.0])]
    assert scores(spark, rows, "array<double>", S.array_double) == pytest.approx([0, 1, 0, 0, 0, 0, 0, 1])


def test_registry(spark):
    df = spark.createDataFrame([("a b", "b c")], "l string, r string")
    assert registry.similarity(df, "some.package.JaccSimFunction", "l", "r", "s").first()["s"] == pytest.approx(1 / 3)
    batch = registry.similarity_batch(df, ["EXACT_SIMILARITY", "JARO_SIMILARITY"], ["l", "l"], ["r", "r"], ["x", "y"])
    assert batch.first()["x"] == 0 and registry.guard_plan(spark.range(2).selectExpr("id + 1 AS x")) is not None
    with pytest.raises(registry.UnsupportedOperation):
        registry.similarity(df, "BigramJaccSimFn", "l", "r", "s")
    with pytest.raises(registry.UnsupportedOperation):
        registry.resolve("last4Chars")
    with pytest.raises(registry.DisabledOperation):
        registry.similarity(df, "JaccSimFunction", "l", "r", "s", registry.Policy(disabled=frozenset({"similarity.JaccSimFunction"})))
    with pytest.raises(ValueError):
        registry.similarity_batch(df, ["EXACT_SIMILARITY"], [], ["r"], ["x"])
    for foreign in (df.mapInArrow(lambda x: x, df.schema), df.withColumn("u", F.udf(lambda v: v)("l")), df.groupBy("l").applyInArrow(lambda x: x, df.schema)):
        with pytest.raises(registry.GuardViolation):
            registry.guard_plan(foreign)
        audit = registry.Policy.parse("audit")
        assert registry.guard_plan(foreign, audit) is foreign and any(m.startswith("guard ") for m in audit.diagnostics.seen)
        off = registry.Policy.parse(None)
        assert off.mode == "OFF" and registry.guard_plan(foreign, off) is foreign and not off.diagnostics.seen
    with pytest.raises(ValueError):
        registry.Policy.parse("sometimes")
    shown = spark.range(1).selectExpr("id AS MapInArrow", "'PythonUDF' AS s")
    assert registry.guard_plan(shown) is shown
    assert len(S.SIMILARITIES) == 21


def test_engine(spark, caplog):
    import logging

    from kinlink.operators.engine import Engine

    engine = Engine(spark, registry.Policy(disabled=frozenset({"similarity.JaccSimFunction"}), explain=True))
    status = engine.status()
    assert status["mode"] == "STRICT" and status["api"] == "classic" and status["capabilities"]["similarity"] == 21 and status["spark"] == spark.version
    df = spark.createDataFrame([("a b", "b c")], "l string, r string")
    with caplog.at_level(logging.INFO, "kinlink"):
        assert engine.exact(df, "l", "r").first()["z_exact"] == 0 and "z_jaro" in engine.jaro(df, "l", "r").columns
        with pytest.raises(registry.DisabledOperation):
            engine.jaccard(df, "l", "r")
        engine.exact(df, "l", "r")
    said = [m.split(" run=")[0] for m in caplog.messages]
    assert said.count("explain decision=rewrite operation=similarity.SimilarityFunctionExact") == 1
    assert "explain decision=disabled operation=similarity.JaccSimFunction" in said
    assert engine.preprocess(df, "trim", ["l"]).first()["l"] == "a b"


def test_tokens_once(spark):
    rows = [("a b", "b c"), (None, "x"), ("", ""), ("..", "!!"), ("A b 1", "1 B a")]
    frame = spark.createDataFrame(rows, "l string, r string").coalesce(1)
    both = frame.select(S.jaccard(F.col("l"), F.col("r")), S.jaccard_of_tokens(S.tokens(F.col("l")), S.tokens(F.col("r")))).collect()
    assert [r[0] for r in both] == [r[1] for r in both]
