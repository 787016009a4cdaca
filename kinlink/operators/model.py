"""The match model: polynomial terms of similarity scores and a regularized logistic curve."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.operators.registry import DEFAULT, Policy
from kinlink.sources.stash import stash

# fixed values: the grid of regularizations and thresholds, folds and seed
REGULARIZATIONS = [0.0001, 0.001, 0.01, 0.1, 1.0]
THRESHOLDS = [0.40, 0.45, 0.50, 0.55]
FOLDS, SEED, MAX_ITER, TOLERANCE, DEGREE = 2, 13, 100, 1e-6, 3
VERSION = 1
#: Terms that a margin's range is written out for.
MOST_BOUNDED_TERMS = 100


class ModelError(ValueError):
    """A model cannot be read, or does not fit the data."""


def term_paths(n: int, degree: int = DEGREE) -> list[tuple[int, ...]]:
    """Index paths of all terms up to ``degree``, in the order of Spark ML's expansion: by the last feature, then its powers."""
    out: list[tuple[int, ...]] = []

    def below(last: int, room: int) -> list[tuple[int, ...]]:
        """Terms, the constant first, of features up to ``last`` with at most ``room`` factors."""
        if last < 0 or room == 0:
            return [()]
        found = []
        for power in range(room + 1):
            found += [p + (last,) * power for p in below(last - 1, room - power)]
        return found

    out = below(n - 1, degree)
    return out[1:]


def polynomial(features: list[str | Column], degree: int = DEGREE) -> Column:
    """The terms as one array; null features are 0."""
    if not 1 <= degree <= 3:
        raise ValueError("the degree is 1, 2 or 3")
    base = F.array(*(F.coalesce((F.col(f) if isinstance(f, str) else f).cast("double"), F.lit(0.0)) for f in features))
    paths = F.array(*(F.array(*(F.lit(i) for i in p)) for p in term_paths(len(features), degree)))
    return F.element_at(F.transform(F.array(base), lambda x: F.transform(paths, lambda p: F.aggregate(p, F.lit(1.0), lambda t, i: t * F.get(x, i)))), 1)


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column less its mean over its population deviation; a constant column divides by 1."""
    stats = df.agg(*(f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    return df.withColumns({c: (F.col(c) - F.lit(stats[f"m_{c}"] or 0.0)) / F.lit(stats[f"s_{c}"] or 1.0) for c in columns})


def area_under_curve(df: DataFrame, score: str = "score", label: str = "label") -> float:
    """Rank-sum area with half credit for ties; 0.5 with one class only."""
    return auc_frame(df, score, label).first()[0]


def auc_frame(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row with the area. Distinct scores are dealt to ranges and written; running sums are taken within each range and over the
    totals of the ranges, which are as few as the partitions, so no task sees all scores."""
    by = df.groupBy(F.col(score).alias("s")).agg(F.sum(F.when(F.col(label) == 1, 1.0).otherwise(0.0)).alias("p"), F.sum(F.when(F.col(label) == 1, 0.0).otherwise(1.0)).alias("n"))
    held = stash(by.repartitionByRange("s").withColumn("range", F.spark_partition_id()), "scores").df
    before = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    ranges = held.groupBy("range").agg(F.min("s").alias("low"), F.sum("n").alias("total")).select("range", F.coalesce(F.sum("total").over(before), F.lit(0.0)).alias("offset"))
    within = F.coalesce(F.sum("n").over(Window.partitionBy("range").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ranked = held.withColumn("within", within).join(F.broadcast(ranges), "range")
    credit = F.col("p") * (F.col("offset") + F.col("within") + F.col("n") / 2)
    return ranked.agg(F.coalesce(F.try_divide(F.sum(credit), F.sum("p") * F.sum("n")), F.lit(0.5)).alias("auc"))


@dataclass
class MatchModel:
    """Everything that a prediction needs."""

    features: list[str]
    coefficients: list[float]
    intercept: float
    threshold: float = 0.5
    regularization: float = REGULARIZATIONS[0]
    degree: int = DEGREE
    metric: float = 0.5
    status: str = "converged"
    iterations: int = 0
    grid: list[float] = field(default_factory=lambda: list(REGULARIZATIONS))
    version: int = VERSION

    def check(self) -> MatchModel:
        if self.version != VERSION:
            raise ModelError(f"model version {self.version} is not read")
        if not self.features:
            raise ModelError("the model has no features")
        if not 1 <= self.degree <= 3:
            raise ModelError(f"degree {self.degree} is not 1, 2 or 3")
        if len(self.coefficients) != len(term_paths(len(self.features), self.degree)):
            raise ModelError("coefficients and terms differ in number")
        if self.regularization not in self.grid:
            raise ModelError("the regularization is not of the grid")
        if self.status not in ("converged", "line-search-stalled", "max-iter-exhausted"):
            raise ModelError(f"unknown status {self.status}")
        return self


def fold_of(label: str, features: list[str], folds: int = FOLDS, seed: int = SEED) -> Column:
    """A fold by content, stable over partitions and retries; equal rows share one."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(label).cast("double"), *(F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features)), F.lit(folds)).cast("int")


def _finite(df: DataFrame, features: list[str], policy: Policy) -> DataFrame:
    value = {f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features}
    bad = {f: F.isnan(v) | (F.abs(v) == float("inf")) for f, v in value.items()}
    if not policy.strict:
        return df.withColumns({f: F.when(bad[f], 0.0).otherwise(v) for f, v in value.items()})
    odd = F.lit(False)
    for b in bad.values():
        odd = odd | b
    return df.withColumns({f: F.when(odd, F.raise_error(F.lit("a feature is not finite"))).otherwise(v).cast("double") for f, v in value.items()})


def _fit_once(df: DataFrame, features: list[str], label: str, degree: int, reg: float, max_iter: int, tolerance: float):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import PolynomialExpansion, VectorAssembler

    terms = PolynomialExpansion(degree=degree, inputCol="__v", outputCol="__t").transform(VectorAssembler(inputCols=features, outputCol="__v").transform(df))
    fitted = LogisticRegression(featuresCol="__t", labelCol=label, regParam=reg, elasticNetParam=0.0, maxIter=max_iter, tol=tolerance, standardization=True).fit(terms)
    return fitted


def fit(df: DataFrame, features: list[str], label: str = "label", degree: int = DEGREE, policy: Policy = DEFAULT, regularizations: list[float] = REGULARIZATIONS, thresholds: list[float] = THRESHOLDS, folds: int = FOLDS, seed: int = SEED, max_iter: int = MAX_ITER, tolerance: float = TOLERANCE) -> MatchModel:
    """Cross-validate the grid by area under curve, then fit on all rows. The metric ignores the threshold, so the first of
    the first best regularization is taken. ``df`` is labelled pairs: it is cached by the fit, not collected.
    """
    policy.check("model.nativeLogisticCv")
    if not features:
        raise ModelError("the model has no features")
    data = _finite(df.select(*features, F.col(label).cast("double").alias("label")), features, policy).withColumn("fold", fold_of("label", features, folds, seed)).cache()
    try:
        best = None
        for reg in regularizations:
            scores = []
            for k in range(folds):
                train = data.where(F.col("fold") != k)
                if train.select("label").distinct().limit(2).count() < 2:
                    scores.append(0.5)
                    continue
                fitted = _fit_once(train, features, "label", degree, reg, max_iter, tolerance)
                held = predict(data.where(F.col("fold") == k), _artifact(fitted, features, degree, reg, thresholds[0], regularizations, 0.0, max_iter))
                scores.append(area_under_curve(held, "score", "label"))
            mean = sum(scores) / len(scores)
            if best is None or mean > best[0]:
                best = (mean, reg)
        fitted = _fit_once(data, features, "label", degree, best[1], max_iter, tolerance)
        return _artifact(fitted, features, degree, best[1], thresholds[0], regularizations, best[0], max_iter).check()
    finally:
        data.unpersist()


def optimizer_status(history: list[float], iterations: int, max_iter: int, tolerance: float) -> str:
    """How the fit ended, from its losses: a fit that stops before its last iteration while its loss still falls by more than the
    tolerance, relative, or that ends on a loss that is not finite, has stalled in its line search."""
    if history and not all(map(math.isfinite, history)):
        return "line-search-stalled"
    if iterations >= max_iter:
        return "max-iter-exhausted"
    last = history[-2:]
    if len(last) == 2 and abs(last[0] - last[1]) > tolerance * max(abs(last[0]), abs(last[1]), 1e-6):
        return "line-search-stalled"
    return "converged"


def _artifact(fitted, features, degree, reg, threshold, grid, metric, max_iter) -> MatchModel:
    iterations = fitted.summary.totalIterations if fitted.hasSummary else 0
    status = optimizer_status(list(fitted.summary.objectiveHistory) if fitted.hasSummary else [], iterations, max_iter, fitted.getTol())
    return MatchModel(list(features), [float(c) for c in fitted.coefficients], float(fitted.intercept), threshold, reg, degree, metric, status, int(iterations), list(grid))


def _margin(expanded: Column, model: MatchModel) -> Column:
    weights = F.array(*(F.lit(c) for c in model.coefficients))
    return F.aggregate(F.zip_with(expanded, weights, lambda x, w: x * w), F.lit(model.intercept), lambda t, v: t + v)


def _probability(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), margin))))


def is_match(features: list[Column], model: MatchModel) -> Column:
    """Whether ``predict`` gives 1 for these features, which are the model's in order."""
    return _probability(_margin(polynomial(features, model.degree), model)) > model.threshold


def bounded(model: MatchModel) -> bool:
    """Whether ``decided`` may stand for predictions: the threshold is a margin, and the terms are few enough for one expression."""
    return 0 < model.threshold < 1 and len(model.check().coefficients) <= MOST_BOUNDED_TERMS


def decided(model: MatchModel, known: dict[str, Column], highest: dict[str, Column], unbounded: set[str], lowest: dict[str, Column] | None = None) -> tuple[Column, Column]:
    """(surely no match, surely a match), from features that are known and others that are from ``lowest``, else 0, to ``highest``.

    The margin's range is exact but for rounding, for which it is widened. ``unbounded`` are known features that may leave -1 to 1. NaN decides nothing.
    """
    low = high = F.lit(model.intercept)
    fixed, wide = 1.0 + abs(model.intercept) + sum(map(abs, model.coefficients)), 0
    size = F.lit(fixed)
    for path, weight in zip(term_paths(len(model.features), model.degree), model.coefficients):
        names = [model.features[i] for i in path]
        term = least = F.lit(weight)
        for n in names:
            if n in known:
                value = F.coalesce(known[n].cast("double"), F.lit(0.0))
                term, least = term * value, least * value
            else:
                term, least = term * highest[n], least * (lowest or {}).get(n, F.lit(0.0))
        if unbounded & set(names):
            size, wide = size + F.abs(term), wide + 1
        # the term is the known factors times what is between two numbers that are not negative
        if not set(names) & set(highest):
            least = term
        elif set(names) & set(known):
            least, term = F.least(least, term), F.greatest(least, term)
        elif weight < 0:
            least, term = term, least
        low, high = low + least, high + term
    cut, slack = math.log(model.threshold / (1 - model.threshold)), size * 1e-9
    if wide > 1:
        none = high < F.lit(cut) - slack
    else:
        # one term that is not bounded is no larger than the margin and all others, so a number stands for the slack
        bound = cut - 2e-9 * fixed
        none = high < F.lit(bound / (1 - 1e-9 if bound < 0 else 1 + 1e-9))
    return none, (low > F.lit(cut) + slack) & ~F.isnan(low)


def predict(df: DataFrame, model: MatchModel, policy: Policy = DEFAULT) -> DataFrame:
    """Adds ``features``, ``expanded``, ``raw`` [-m, m], ``probability`` [1-p, p], ``prediction`` and ``score``: a projection only.

    The prediction is 1 where the score is above the threshold; equal is 0.
    """
    policy.check("model.nativePrediction")
    model.check()
    out = df.withColumn("features", F.array(*(F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in model.features)))
    out = out.withColumn("expanded", polynomial(model.features, model.degree)).withColumn("__m", _margin(F.col("expanded"), model))
    out = out.withColumn("score", _probability(F.col("__m")))
    return out.withColumns({"raw": F.array(-F.col("__m"), F.col("__m")), "probability": F.array(1.0 - F.col("score"), F.col("score")), "prediction": (F.col("score") > model.threshold).cast("double")}).drop("__m")


def margins_by_row(df: DataFrame, model: MatchModel, row_id: str) -> DataFrame:
    """``df`` with ``margin``: terms by position, times the coefficient there, summed by row id and joined back on it.

    ``predict`` gives the same from a projection; this form holds one term a row, however many terms the model has. Row ids are distinct.
    """
    spark = df.sparkSession
    weights = spark.createDataFrame(list(enumerate(model.check().coefficients)), "position int, weight double").coalesce(1)
    terms = df.select(F.col(row_id).alias("__id"), F.posexplode(polynomial(model.features, model.degree)).alias("position", "term"))
    sums = terms.join(F.broadcast(weights), "position").groupBy("__id").agg((F.sum(F.col("term") * F.col("weight")) + F.lit(model.intercept)).alias("margin"))
    return df.join(sums, df[row_id] == sums["__id"]).drop("__id")


def _residual(df: DataFrame, model: MatchModel, label: str) -> DataFrame:
    return predict(df, model).select("expanded", (F.col("score") - F.col(label).cast("double")).alias("residual"))


def gradient(df: DataFrame, model: MatchModel, label: str = "label") -> DataFrame:
    """Rows (position, gradient) of the mean logistic loss: residual times term, summed by exploded position; the intercept has position -1."""
    left = _residual(df, model, label)
    terms = left.select("residual", F.posexplode(F.concat(F.array(F.lit(1.0)), "expanded")).alias("position", "term"))
    by = terms.groupBy("position").agg((F.sum(F.col("residual") * F.col("term")) / F.count("*")).alias("gradient"))
    return by.select((F.col("position") - 1).alias("position"), "gradient")


def gradient_by_columns(df: DataFrame, model: MatchModel, label: str = "label", batch: int = 256) -> list[float]:
    """The same gradient, intercept first, as averages of ``batch`` columns a pass: no row is exploded."""
    left = _residual(df, model, label)
    out: list[float] = []
    for low in range(0, len(model.coefficients) + 1, batch):
        some = range(low, min(low + batch, len(model.coefficients) + 1))
        row = left.agg(*(F.avg(F.col("residual") * (F.lit(1.0) if i == 0 else F.get("expanded", F.lit(i - 1)))).alias(f"g{i}") for i in some)).first()
        out += [x or 0.0 for x in row]
    return out


FOLDER = "_kinlink_match_model_v1"


def save(spark, model: MatchModel, path: str) -> None:
    row = asdict(model.check())
    schema = "features array<string>, coefficients array<double>, intercept double, threshold double, regularization double, degree int, metric double, status string, iterations int, grid array<double>, version int"
    spark.createDataFrame([tuple(row[f.split(" ")[0]] for f in schema.split(", "))], schema).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{FOLDER}")


def load(spark, path: str) -> MatchModel:
    """The two newest fields, ``grid`` and ``iterations``, may be absent."""
    try:
        rows = spark.read.parquet(f"{path.rstrip('/')}/{FOLDER}").limit(2).collect()
    except Exception as error:
        raise ModelError(f"no model at {path}: {error}") from error
    if len(rows) != 1:
        raise ModelError(f"the model at {path} has {len(rows)} rows")
    row = {k: v for k, v in rows[0].asDict().items() if v is not None}
    return MatchModel(**{k: row[k] for k in MatchModel.__dataclass_fields__ if k in row}).check()


def from_pipeline(stages, degree: int = DEGREE, threshold: float = 0.5) -> MatchModel:
    """The artifact of fitted Spark ML stages: an assembler, a polynomial expansion and a logistic regression."""
    features = next(s.getInputCols() for s in stages if type(s).__name__ == "VectorAssembler")
    fitted = next(s for s in stages if type(s).__name__ == "LogisticRegressionModel")
    reg = fitted.getRegParam()
    return MatchModel(list(features), [float(c) for c in fitted.coefficients], float(fitted.intercept), threshold, reg, degree, grid=sorted({*REGULARIZATIONS, reg})).check()


def import_cross_validator(path: str) -> MatchModel:
    """The best model of a saved Spark ML cross-validator."""
    from pyspark.ml.tuning import CrossValidatorModel

    best = CrossValidatorModel.load(path).bestModel
    return from_pipeline(getattr(best, "stages", [best]))
