"""The phases on blocks whose pairs are too many to score one by one, held against full scores of every pair."""

import random
import time

import pytest
from pyspark.sql import functions as F

from kinlink.functions import sketches
from kinlink.operators import blocking, model, registry
from kinlink.plans import phases
from kinlink.plans.phases import Config, Field
from kinlink.sources.stash import stash

RECORD = "z_zid long, z_source string, name string, brand string, size int"


def names(n: int, seed: int = 5) -> list:
    dice = random.Random(seed)
    words = ["red ring", "Old Plate", "cold bolt", "hot nut", "dt gj", "tiny  gear"]
    odd = [None, "", " ", "!!!", "é", "\U0001f600 ring", "İ Σ", "x" * 300, "a" * 40]
    return [dice.choice(odd) if dice.random() < 0.1 else f"{dice.choice('ab')}{dice.randrange(40):02d}{dice.choice('cdt')} {dice.choice(words)}{dice.choice(['', 'x', ' y'])}" for _ in range(n)]


def records(spark, n: int, seed: int = 5):
    dice = random.Random(seed)
    rows = [(i, dice.choice("ab"), v, dice.choice(["p", "q", "r", None]), dice.choice([1, 2, 3, 40, -1, None])) for i, v in enumerate(names(n, seed))]
    return stash(spark.createDataFrame(rows, RECORD), "given").df


def test_likely_pairs_keep_scores_within_bounds(spark):
    left, right = names(300, 1), names(300, 2)
    pairs = spark.createDataFrame(list(zip(left, right)) + [(v, v) for v in left[:40]], "name string, z_name string")
    for kind in ("tokens", "same", "near"):
        for side in ("name", "z_name"):
            for i, c in enumerate(sketches.sketch_columns("name", kind)):
                pairs = pairs.withColumn(("z_" if side != "name" else "") + c, F.get(sketches.SKETCHES[kind](F.col(side)), F.lit(i)))
    for name in ("JaccSimFunction", "AffineGapSimilarityFunction"):
        low = sketches.AT_LEAST[name](F.col("name"), F.col("z_name")) if name in sketches.AT_LEAST else F.lit(0.0)
        rows = pairs.select("name", "z_name", low.alias("low"), registry.rule(name)(F.col("name"), F.col("z_name")).alias("score"), sketches.highest(name, "name", "z_").alias("high")).collect()
        assert all(r["low"] <= r["score"] + 1e-12 and r["score"] <= r["high"] + 1e-12 for r in rows)
        assert sum(r["high"] < 0.8 for r in rows) > 50


@pytest.mark.parametrize("across", [True, False])
@pytest.mark.parametrize("kinds, weights, degree", [
    (["exact", "fuzzy", "text"], [1.0, -0.5, 6.0], 1),
    (["exact", "fuzzy", "fuzzy"], [2.0, -0.7, 3.5, 2.0], 1),
    (["exact", "fuzzy", "fuzzy"], [0.5, 0.3, -0.2, -0.1, 0.4, 2.0, -1.5, 1.0, 2.0, 0.2, 3.0, 0.6, -0.4, 1.1], 2),
])
def test_linked_clusters_are_those_of_all_scored_pairs(spark, across, kinds, weights, degree):
    config = Config([Field("brand", kinds[0]), Field("size", kinds[1], "int"), Field("name", kinds[2])])
    fitted = model.MatchModel([f"sim_{i}" for i in range(len(config.features()))], weights, -4.0, 0.4, degree=degree)
    given, tree = records(spark, 260), blocking.Node("first1Chars", "name")
    full = phases.scored_pairs(given, config, fitted, tree, across=across).where("prediction = 1").select("z_zid", "z_z_zid")
    assert 0 < full.count()
    clusters = lambda edges: {tuple(r) for r in phases.connected_components(given.select("z_zid"), edges, "z_zid", "z_z_zid", "c").collect()}
    assert clusters(phases.match_edges(given, config, fitted, tree, "match", across=across)) == clusters(full)


def test_link_of_one_large_block(spark):
    """25 million pairs of two sources in one block: few can match."""
    rows = spark.range(10_000).select(
        F.col("id").alias("z_zid"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("z_source"), F.concat(F.lit("a"), F.md5(F.floor(F.col("id") / 2).cast("string")), F.lit(" ring")).alias("name"),
        F.lit("p").alias("brand"), (F.floor(F.col("id") / 2) % 50).cast("int").alias("size"),
    )
    config = Config([Field("brand", "exact"), Field("size", "exact", "int"), Field("name", "text")])
    fitted, tree = model.MatchModel(["sim_0", "sim_1", "sim_2"], [1.0, 1.0, 6.0], -7.0, 0.5, degree=1), blocking.Node("first1Chars", "name")
    given = stash(rows, "given").df
    start = time.time()
    linked = phases.link(given, config, fitted, tree)
    assert {(r["z_zid"], r["z_cluster"]) for r in linked.collect()} == {(i, i - i % 2) for i in range(10_000)}
    assert phases.likely_pairs(given, config, fitted, tree, across=True).count() < 250_000 and time.time() - start < 120


def test_match_aligns_few_pairs(spark):
    """Half a million pairs in blocks: most are decided by bounds, and those that bounds leave open are mostly connected by others."""
    rows = spark.range(4_000).select(F.col("id").alias("z_zid"), F.concat(F.lit("a"), F.substring(F.md5(F.floor(F.col("id") / 2).cast("string")), 1, 20), F.when(F.col("id") % 2 == 0, "").otherwise("x")).alias("name"), F.lit("p").alias("brand"))
    config = Config([Field("name", "fuzzy"), Field("brand", "exact")])
    given, tree = stash(rows, "given").df, blocking.Node("first2Chars", "name")
    fitted = model.MatchModel(["sim_0", "sim_1", "sim_2"], [6.0, 1.0, 1.0], -6.5, 0.5, degree=1)
    start = time.time()
    assert {(r["z_zid"], r["z_cluster"]) for r in phases.match(given, config, fitted, tree).collect()} == {(i, i - i % 2) for i in range(4_000)}
    assert time.time() - start < 60


def plain_least_certain(given, config, fitted, tree, most):
    found, scores = phases.score_features(phases._paired(given, config, tree, phases.DEFAULT, False), config)
    mean = sum((F.coalesce(F.col(n), F.lit(0.0)) for n in scores), F.lit(0.0)) / len(scores)
    found = found.withColumn("z_score", mean) if fitted is None else model.predict(found, fitted).withColumn("z_score", F.col("score"))
    rows = found.orderBy(F.abs(F.col("z_score") - 0.5), "z_zid", "z_z_zid").limit(most).collect()
    return [(r["z_zid"], r["z_z_zid"], r["z_score"], r["name"], r["z_name"]) for r in rows]


@pytest.mark.parametrize("kind, most", [("null_or_blank", 20), ("null_or_blank", 3000), ("text", 20), ("text", 1), ("fuzzy", 30)])
def test_training_pairs_are_those_of_all_pairs(spark, kind, most):
    given = records(spark, 150, 7)
    given = stash(given.unionAll(given.where("z_zid % 40 = 0").withColumn("brand", F.lit("q"))).unionAll(given.limit(1).withColumn("z_zid", F.lit(None).cast("long"))), "given").df
    config = Config([Field("brand", "exact"), Field("size", "exact", "int"), Field("name", kind)])
    fitted = None if kind != "text" else model.MatchModel(["sim_0", "sim_1", "sim_2"], [1.0, 1.0, 6.0], -5.0, 0.5, degree=1)
    tree = blocking.Node("identityInteger", "size")
    found = phases.find_training_data(given, config, fitted, tree, most=most).collect()
    assert [(r["z_zid"], r["z_z_zid"], r["z_score"], r["name"], r["z_name"]) for r in found] == plain_least_certain(given, config, fitted, tree, most)


def test_training_pairs_of_one_large_block(spark):
    """1.25 billion pairs in one block; the scores tell only five kinds of record apart."""
    given = stash(spark.range(50_000).select(F.col("id").alias("z_zid"), F.lit(1).alias("size"), F.concat(F.lit("b"), F.col("id") % 5).alias("brand"), F.md5(F.col("id").cast("string")).alias("name")), "given").df
    config = Config([Field("brand", "exact"), Field("size", "exact", "int"), Field("name", "null_or_blank")])
    start = time.time()
    found = phases.find_training_data(given, config, None, blocking.Node("identityInteger", "size"), most=20).collect()
    apart = [j for j in range(1, 30) if j % 5][:20]
    assert [(r["z_zid"], r["z_z_zid"]) for r in found] == [(0, j) for j in apart]
    assert time.time() - start < 60


def test_bounds_of_edited_texts(spark):
    """Bounds from sketches, of texts that share most of their letters, hold on either side."""
    dice, rows = random.Random(3), []
    for _ in range(1500):
        text = [dice.choice("abdtgjmn12 é,.") for _ in range(dice.randrange(1, 14))]
        other = [dice.choice("abdtgj1 ") if dice.random() < 0.2 else c for c in text if dice.random() < 0.9] + text[: dice.randrange(4)]
        rows.append(("".join(text), "".join(other)))
    pairs = spark.createDataFrame(rows, "name string, z_name string")
    for side in ("", "z_"):
        pairs = pairs.withColumn(f"{side}__lanes_name", sketches.SKETCHES["lanes"](F.col(f"{side}name")))
        pairs = pairs.withColumns({side + c: F.get(sketches.SKETCHES[kind](F.col(f"{side}name")), F.lit(i)) for kind in ("same", "near") for i, c in enumerate(sketches.sketch_columns("name", kind))})
    name = "AffineGapSimilarityFunction"
    scores = [c.alias(n) for n, c in (("low", sketches.lowest(name, "name", "z_")), ("score", registry.rule(name)(F.col("name"), F.col("z_name"))), ("high", sketches.highest(name, "name", "z_")))]
    found = stash(pairs, "given").df.select(*scores).collect()
    assert all(r["low"] <= r["score"] + 1e-12 and r["score"] <= r["high"] + 1e-12 for r in found)
    assert sum(r["low"] > 0.5 for r in found) > 100 and sum(r["high"] < 0.8 for r in found) > 100


def test_match_of_blocks_as_at_sixty_copies(spark):
    """5.3 million pairs in blocks of some 590 records, most of which other matches connect."""
    code = F.concat(F.lit("abc"), F.substring(F.md5(F.floor(F.col("id") / 2).cast("string")), 1, 5), F.lit(" red ring"), F.when(F.col("id") % 2 == 0, "").otherwise("x"))
    truth = F.floor(F.col("id") / 2)
    rows = spark.range(18_000).select(F.col("id").alias("z_zid"), F.concat(F.lpad((truth % 30).cast("string"), 2, "0"), code).alias("name"), F.concat(F.lit("b"), truth % 25).alias("brand"), (truth % 50).cast("int").alias("size"))
    config = Config([Field("name"), Field("brand", "exact"), Field("size", "fuzzy", "int")])
    fitted = model.MatchModel([f"sim_{i}" for i in range(4)], [3.12, 3.8, 2.8, -1.23], -3.98, 0.4, degree=1)
    given = stash(rows, "given").df
    start = time.time()
    found = phases.match(given, config, fitted, blocking.Node("first2Chars", "name")).groupBy(F.floor(F.col("z_zid") / 2).alias("truth")).agg(F.count_distinct("z_cluster").alias("n"), F.count("*").alias("records"))
    assert found.where("n = 1 AND records = 2").count() == 9_000 and time.time() - start < 60
