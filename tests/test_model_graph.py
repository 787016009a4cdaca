import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from kinlink.operators import graph, model, registry
from kinlink.operators.registry import Policy
from kinlink.plans import evidence, phases
from kinlink.sources import io
from kinlink.sources.stash import stash


def test_optimizer_status():
    assert model.optimizer_status([0.7, 0.5, 0.5 - 1e-9], 2, 50, 1e-6) == "converged"
    assert model.optimizer_status([0.7, 0.5, 0.4], 50, 50, 1e-6) == "max-iter-exhausted"
    assert model.optimizer_status([0.7, 0.5, 0.4], 2, 50, 1e-6) == "line-search-stalled"
    assert model.optimizer_status([0.7, float("nan")], 50, 50, 1e-6) == "line-search-stalled"
    assert model.optimizer_status([], 0, 50, 1e-6) == "converged"


def test_polynomial_order(spark):
    # fixed values: the order of the terms, and the number of terms of 20 features
    assert model.term_paths(2, 3) == [(0,), (0, 0), (0, 0, 0), (1,), (0, 1), (0, 0, 1), (1, 1), (0, 1, 1), (1, 1, 1)]
    assert len(model.term_paths(20, 3)) == sum(math.comb(19 + d, d) for d in (1, 2, 3)) == 1770
    from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([(0.5, -2.0, 3.0), (None, 1.0, 2.0)], "a double, b double, c double").coalesce(1)
    filled = df.fillna(0.0)
    want = PolynomialExpansion(degree=3, inputCol="v", outputCol="t").transform(VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(filled)).select(vector_to_array("t"))
    got = df.select(model.polynomial(["a", "b", "c"], 3))
    assert [r[0] for r in got.collect()] == [pytest.approx(r[0]) for r in want.collect()]


def test_area_under_curve(spark):
    rng = random.Random(2)
    rows = [(round(rng.random(), 1), float(rng.random() < 0.4)) for _ in range(60)]
    ones, zeros = ([s for s, y in rows if y == k] for k in (1, 0))
    want = sum(0.5 if a == b else float(a > b) for a, b in itertools.product(ones, zeros)) / (len(ones) * len(zeros))
    assert model.area_under_curve(spark.createDataFrame(rows, "score double, label double")) == pytest.approx(want)
    assert model.area_under_curve(spark.createDataFrame([(0.1, 1.0)], "score double, label double")) == 0.5
    assert model.area_under_curve(spark.createDataFrame([], "score double, label double")) == 0.5


def test_fit_save_load_predict(spark, tmp_path):
    rows = [(i, float(i % 3), float(i % 4), float(i % 2 == 0)) for i in range(64)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label double")
    fitted = model.fit(df, ["a", "b"], degree=2, regularizations=[0.01, 0.1], max_iter=20)
    assert fitted.threshold == 0.40 and fitted.regularization in (0.01, 0.1)
    model.save(spark, fitted, str(tmp_path))
    loaded = model.load(spark, str(tmp_path))
    assert loaded == fitted
    out = model.predict(df, loaded)
    assert {"features", "expanded", "raw", "probability", "prediction", "score"} <= set(out.columns)
    r = out.first()
    assert r["raw"][0] == -r["raw"][1] and sum(r["probability"]) == pytest.approx(1)
    with pytest.raises(model.ModelError):
        model.load(spark, str(tmp_path / "nowhere"))
    edge = model.MatchModel(["a"], [0.0], 0.0, threshold=0.5, degree=1)
    assert model.predict(df, edge).first()["prediction"] == 0  # equal to the threshold
    with pytest.raises(model.ModelError):
        model.predict(df, model.MatchModel(["a"], [0.0, 1.0], 0.0, degree=1))


def test_fit_agrees_with_spark_ml_and_import(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    df = spark.createDataFrame([(float(i % 5), float(i % 5 > 2 or i % 7 == 0)) for i in range(70)], "a double, label double")
    assembler = VectorAssembler(inputCols=["a"], outputCol="v")
    fitted = LogisticRegression(featuresCol="v", regParam=0.01).fit(assembler.transform(df))
    ours = model.from_pipeline([assembler, fitted], degree=1)
    want = [r["prediction"] for r in fitted.transform(assembler.transform(df)).collect()]
    assert [r["prediction"] for r in model.predict(df, ours).collect()] == want


def test_non_finite_policy(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (1.0, 0.0), (2.0, 1.0), (0.5, 0.0)], "a double, label double")
    with pytest.raises(Exception, match="not finite"):
        model.fit(df, ["a"], degree=1, regularizations=[0.1])
    assert model.fit(df, ["a"], degree=1, policy=Policy("REWRITE"), regularizations=[0.1]).features == ["a"]


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double").coalesce(1)
    assert [tuple(r) for r in model.standardize(df, ["a", "b"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


EDGES = [("a", "b"), ("b", "c"), ("d", "e"), ("f", "g"), ("g", "h"), ("h", "i"), ("i", "f"), ("j", "k"), ("k", "l"), ("l", "m"), ("m", "j"), ("a", "a"), ("a", None), ("c", "b")]


def test_components(spark):
    vertices = spark.createDataFrame([(c, 1) for c in "abcdefghijklmn"] + [("n", 2)], "id string, x int")
    out = graph.connected_components(vertices, spark.createDataFrame(EDGES, "id string, right string"), "id", "right", "cluster")
    got = {}
    for r in out.collect():
        got.setdefault(r["cluster"], set()).add(r["id"])
    assert got == {"a": set("abc"), "d": set("de"), "f": set("fghi"), "j": set("jklm"), "n": {"n"}}
    assert out.count() == 15
    with pytest.raises(graph.NotConverged):
        graph.connected_components(vertices, spark.createDataFrame([(chr(97 + i), chr(98 + i)) for i in range(13)], "id string, right string"), "id", "right", "c", max_iterations=1)
    empty = spark.createDataFrame([], "id string, right string")
    assert graph.connected_components(vertices, empty, "id", "right", "cluster").where("cluster <> id").count() == 0


def test_components_random(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(55)]
    root = list(range(80))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    out = graph.connected_components(spark.range(80), spark.createDataFrame(edges, "id long, r long"), "id", "r", "c")
    assert {r["id"]: r["c"] for r in out.collect()} == {i: find(i) for i in range(80)}


def test_fingerprints(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "x int, y string")
    one, two = (evidence.output_fingerprint(d).first() for d in (df, df.select("y", "x").repartition(3)))
    assert one == two and one["rows"] == 3
    assert evidence.output_fingerprint(df.limit(2)).first() != one
    assert evidence.plan_fingerprint(df.select("x")) == evidence.plan_fingerprint(df.select("x"))
    notes = registry.Diagnostics()
    assert notes.note("x", rows=1) and not notes.note("x", rows=1)
    assert evidence.decisions(["JaccSimFunction", "nope"]) == {"JaccSimFunction": "rewrite", "nope": "unsupported"}


def test_io(spark, tmp_path):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, value string")
    for kind in ("csv", "json", "parquet"):
        props = {"location": str(tmp_path / kind)} | ({"header": "true"} if kind == "csv" else {})
        io.write_pipe(src, io.Pipe("t", kind, props))
        assert set(io.read_pipe(spark, io.Pipe("t", kind, props, "id int, value string")).collect()) == set(src.collect())
    ids = [r["z_zid"] for r in io.with_row_id(src.repartition(2)).collect()]
    assert len(set(ids)) == 3 and min(ids) >= 0
    path = io.transient_dir(str(tmp_path))
    src.write.parquet(path)
    io.drop_transient(spark, path)
    with pytest.raises(ValueError):
        io.drop_transient(spark, str(tmp_path))
    with pytest.raises(ValueError):
        io.transient_dir(str(tmp_path), "not-a-uuid")


def test_phases(spark):
    text = '{"fieldDefinition": [{"fieldName": "name", "matchType": "fuzzy", "dataType": "\\"string\\""}, {"fieldName": "zip", "matchType": "exact", "dataType": "string"}, {"fieldName": "junk", "matchType": "dont_use", "dataType": "string"}], "modelId": 7, "modelDir": "m"}'
    config = phases.Config.parse(text)
    assert config.model_path == "m/7" and len(config.features()) == 3
    names = ["alice", "bruno", "carla", "diego", "elena", "fabio", "greta", "heinz"]
    marked = [(2 * i + k, 1, f"m{i}", n + "x" * k, str(i), "j") for i, n in enumerate(names) for k in (0, 1)]
    marked += [(100 + 2 * i + k, 0, f"n{i}", names[(i + k * 3) % 8], str(i + k), "j") for i in range(8) for k in (0, 1)]
    raw = spark.createDataFrame(marked, "z_zid long, z_isMatch int, z_cluster string, name string, zip string, junk string")
    with pytest.raises(registry.GuardViolation):  # rows that are still Python objects
        phases.train(raw, raw, config)
    frame = stash(raw, "marked").df
    records = frame.where("z_zid < 16").drop("z_isMatch", "z_cluster")
    fitted, tree = phases.train(frame, records, config, regularizations=[0.01], degree=1, max_iter=20)
    found = {r["z_zid"]: r["z_cluster"] for r in phases.match(records, config, fitted, tree).collect()}
    assert found == {i: i - i % 2 for i in range(16)}
    two = records.withColumn("z_source", F.when(F.col("z_zid") % 2 == 0, "a").otherwise("b"))
    linked = phases.link(two, config, fitted, tree)
    assert linked.count() == 16 and {r["z_zid"] for r in phases.representatives(linked).collect()} == set(range(0, 16, 2))
    pairs = phases.find_training_data(records, config, fitted, tree, most=3)
    labelled = phases.label(pairs, spark.createDataFrame([(pairs.first()["z_cluster"], 1)], "z_cluster string, z_isMatch int"))
    assert sorted(r["z_isMatch"] for r in labelled.collect()) == [1, 2, 2]
    with pytest.raises(model.ModelError):
        phases.train(frame.where("z_cluster = 'm1'"), records, config)


def test_gradient_both_ways(spark):
    rng = random.Random(4)
    rows = [(i, rng.random(), rng.random(), float(rng.random() < 0.5)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label double").coalesce(1)
    fitted = model.MatchModel(["a", "b"], [0.5, -1.0, 0.25, 2.0, -0.75], 0.1, degree=2)
    want = [0.0] * 6
    margins = {}
    for i, a, b, y in rows:
        terms = [a, a * a, b, a * b, b * b]
        margins[i] = 0.1 + sum(w * t for w, t in zip(fitted.coefficients, terms))
        for k, t in enumerate([1.0, *terms]):
            want[k] += (1 / (1 + math.exp(-margins[i])) - y) * t / len(rows)
    assert [r["gradient"] for r in model.gradient(df, fitted).orderBy("position").collect()] == pytest.approx(want)
    assert model.gradient_by_columns(df, fitted, batch=4) == pytest.approx(want)
    assert {r["id"]: r["margin"] for r in model.margins_by_row(df, fitted, "id").collect()} == pytest.approx(margins)


def test_changed_edges(spark):
    before, after = (spark.createDataFrame(x, "v int, m int") for x in ([(2, 1), (3, 1), (3, 1)], [(2, 1), (4, 1)]))
    assert sorted(graph.changed_edges(before, after).collect()) == [(3, 1), (4, 1)] and graph.changed_edges(before, before).isEmpty()
