"""The phases of a linkage run: find training data, label, train, match and link."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinlink.functions import sketches
from kinlink.functions.text import blank, let
from kinlink.operators import blocking, model, registry
from kinlink.operators.graph import connected_components, star_forest
from kinlink.operators.registry import DEFAULT, Policy, rule
from kinlink.plans.evidence import finish
from kinlink.sources.io import Pipe, read_pipe
from kinlink.sources.stash import settle, stash

ID, RIGHT, CLUSTER, MATCH, SCORE, BLOCK, ROOT = "z_zid", "z_", "z_cluster", "z_isMatch", "z_score", "z_hash", "__root"

#: What each match type compares with, by the type of the column.
FUZZY = {
    "string": ["AffineGapSimilarityFunction", "JaccSimFunction"],
    "int": ["IntegerSimilarityFunction"],
    "bigint": ["LongSimilarityFunction"],
    "double": ["DoubleSimilarityFunction"],
    "float": ["FloatSimilarityFunction"],
    "date": ["DateSimilarityFunction"],
    "array<double>": ["ArrayDoubleSimilarityFunction"],
}
BY_TYPE = {
    "exact": ["SimilarityFunctionExact"],
    "email": ["EmailMatchTypeFunction"],
    "pincode": ["PinCodeMatchTypeFunction"],
    "numeric": ["NumbersJaccardFunction"],
    "numeric_with_units": ["ProductCodeFunction"],
    "text": ["JaccSimFunction"],
    "null_or_blank": ["CheckBlankOrNullFunction"],
    "only_alphabets_exact": ["OnlyAlphabetsExactSimilarity"],
    "only_alphabets_fuzzy": ["OnlyAlphabetsAffineGapSimilarity"],
}
HASHES = {
    "string": ["first1Chars", "first2Chars", "first3Chars", "last1Chars", "last2Chars", "last3Chars", "lastWord", "identityString"],
    "int": ["identityInteger", "trimLast1DigitsInt", "trimLast2DigitsInt"],
    "bigint": ["identityLong", "trimLast1DigitsLong", "trimLast2DigitsLong"],
    "double": ["truncateDoubleTo1Places", "trimLast1DigitsDbl", "round"],
    "float": ["truncateFloatTo1Places", "trimLast1DigitsFloat"],
    "boolean": ["identityBoolean"],
}
LEAST_EACH = 5


@dataclass
class Field:
    name: str
    match_type: str = "fuzzy"
    data_type: str = "string"
    stop_words: str | None = None


@dataclass
class Config:
    fields: list[Field]
    data: list[Pipe] = field(default_factory=list)
    output: list[Pipe] = field(default_factory=list)
    model_id: str = "1"
    folder: str = "models"
    partitions: int | None = None
    label_sample: float = 0.5

    @staticmethod
    def parse(text: str) -> Config:
        """From JSON; the key that ends in ``Dir`` names the folder of models."""
        d = json.loads(text)
        pipes = lambda k: [Pipe(p["name"], p["format"], p.get("props", {}), p.get("schema")) for p in d.get(k, [])]
        fields = [Field(f["fieldName"], str(f.get("matchType", "fuzzy")).lower(), str(f.get("dataType", "string")).strip('"').lower(), f.get("stopWords")) for f in d["fieldDefinition"]]
        return Config(fields, pipes("data"), pipes("output"), str(d.get("modelId", "1")), next((v for k, v in d.items() if k.endswith("Dir")), "models"), d.get("numPartitions"), float(d.get("labelDataSampleSize", 0.5)))

    @property
    def model_path(self) -> str:
        return f"{self.folder}/{self.model_id}"

    def compared(self) -> list[Field]:
        return [f for f in self.fields if f.match_type != "dont_use"]

    def features(self) -> list[tuple[str, str]]:
        """(field, similarity) in order; a match type may list several types with commas."""
        out = []
        for f in self.compared():
            for kind in f.match_type.split(","):
                names = FUZZY.get(f.data_type) if kind.strip() == "fuzzy" else BY_TYPE.get(kind.strip())
                if not names:
                    raise ValueError(f"match type {kind} of {f.name} ({f.data_type}) is not known")
                out += [(f.name, n) for n in names]
        return out


def read_data(spark: SparkSession, config: Config) -> DataFrame:
    """All sources of the configuration, by column name, with their name in ``z_source``."""
    frames = [read_pipe(spark, p).withColumn("z_source", F.lit(p.name)) for p in config.data]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def prepare(df: DataFrame, config: Config, policy: Policy = DEFAULT) -> DataFrame:
    for f in config.compared():
        if f.stop_words:
            df = registry.remove_stop_words(df, f.name, f.stop_words, policy)
    return df


def score_features(pairs: DataFrame, config: Config, policy: Policy = DEFAULT) -> tuple[DataFrame, list[str]]:
    """All similarity columns in one projection."""
    found = config.features()
    names = [f"sim_{i}" for i in range(len(found))]
    return registry.similarity_batch(pairs, [n for _, n in found], [f for f, _ in found], [RIGHT + f for f, _ in found], names, policy), names


def marked_pairs(marked: DataFrame, config: Config) -> DataFrame:
    """Labelled pairs from a marked table: two rows of one cluster form a pair."""
    other = marked.select(F.col(CLUSTER), *(F.col(c).alias(RIGHT + c) for c in marked.columns if c != CLUSTER))
    return marked.join(other, CLUSTER).where(F.col(ID) < F.col(RIGHT + ID))


def train_tree(df: DataFrame, config: Config, pairs: DataFrame, most_block: int = 100, sample: int = 5000) -> blocking.Node:
    """A blocking tree from at most ``sample`` records and labelled matches, those of the lowest hashes, so that runs agree."""
    names = [f.name for f in config.compared() if f.data_type in HASHES]
    known = pairs.where(F.col(MATCH) == 1).orderBy(F.xxhash64(ID, RIGHT + ID), ID, RIGHT + ID).select(*names, *(RIGHT + n for n in names)).limit(sample).collect()
    as_pairs = [{"l": {n: r[n] for n in names}, "r": {n: r[RIGHT + n] for n in names}} for r in known]
    fields = {f.name: HASHES[f.data_type] for f in config.compared() if f.data_type in HASHES}
    return blocking.learn_tree(as_pairs, fields, df.orderBy(F.xxhash64(*names), *names).select(*names).limit(sample), most_block)


def train(marked: DataFrame, records: DataFrame, config: Config, policy: Policy = DEFAULT, save_to: str | None = None, **settings) -> tuple[model.MatchModel, blocking.Node]:
    """The model and the tree from a marked table; at least five pairs of either label are needed."""
    pairs = marked_pairs(prepare(marked, config, policy), config)
    counts = {r[MATCH]: r["n"] for r in pairs.groupBy(MATCH).agg(F.count("*").alias("n")).collect()}
    if min(counts.get(0, 0), counts.get(1, 0)) < LEAST_EACH:
        raise model.ModelError(f"training needs {LEAST_EACH} pairs of either label, there are {counts}")
    scored, names = score_features(pairs, config, policy)
    finish(scored, "train", policy)
    fitted = model.fit(scored.withColumn("label", (F.col(MATCH) == 1).cast("double")), names, policy=policy, **settings)
    tree = train_tree(records, config, pairs)
    if save_to:
        spark = marked.sparkSession
        model.save(spark, fitted, save_to)
        spark.createDataFrame([(blocking.to_json(tree),)], "value string").coalesce(1).write.mode("overwrite").text(f"{save_to}/blocking_tree")
    return fitted, tree


def load_trained(spark: SparkSession, path: str) -> tuple[model.MatchModel, blocking.Node]:
    return model.load(spark, path), blocking.from_json(spark.read.text(f"{path}/blocking_tree").first()[0])


def _slim(df: DataFrame, config: Config, tree: blocking.Node, policy: Policy, across: bool) -> DataFrame:
    hashed = blocking.block_hashes(prepare(df, config, policy), tree, BLOCK, policy)
    if config.partitions:
        hashed = hashed.repartition(config.partitions, BLOCK)
    keep = [ID, BLOCK, *(f.name for f in config.compared()), *(["z_source"] if across else [])]
    return hashed.select(*keep)


def _paired(df: DataFrame, config: Config, tree: blocking.Node, policy: Policy, across: bool) -> DataFrame:
    return blocking.candidate_pairs(_slim(df, config, tree, policy, across), None, BLOCK, ID, RIGHT, "z_source" if across else None)


def scored_pairs(df: DataFrame, config: Config, fitted: model.MatchModel, tree: blocking.Node, policy: Policy = DEFAULT, across: bool = False) -> DataFrame:
    """Candidate pairs with their score and prediction."""
    pairs, _ = score_features(_paired(df, config, tree, policy, across), config, policy)
    return model.predict(pairs, fitted, policy).withColumn(SCORE, F.col("score"))


def _similar(name: str, field_: str) -> Column:
    """A score of a pair, from what its sides were prepared to if there is such."""
    if name in sketches.PREPARED:
        column = sketches.prepared_column(name, field_)
        return sketches.PREPARED[name][1](F.col(column), F.col(RIGHT + column))
    return rule(name, "similarity")(F.col(field_), F.col(RIGHT + field_))


def _unbounded(found: list[tuple[str, str]]) -> set[str]:
    return {f"sim_{i}" for i, (_, name) in enumerate(found) if name in sketches.UNBOUNDED}


def _by_cost(found: list[tuple[str, str]], affordable: set[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    """Scores to compute, and upper bounds of the others."""
    known = {f"sim_{i}": _similar(name, f) for i, (f, name) in enumerate(found) if name in affordable}
    return known, {f"sim_{i}": sketches.highest(name, f, RIGHT) for i, (f, name) in enumerate(found) if name not in affordable}


def _sketched(df: DataFrame, config: Config, tree: blocking.Node, policy: Policy, across: bool) -> DataFrame:
    """Records with their block, and for each compared field that needs it its sketches, column by column, and tokens."""
    found, spark = config.features(), df.sparkSession
    kinds = sorted({(f, kind) for f, name in found for kind in sketches.NEEDED.get(name, [])})
    every = sorted({*kinds, *((f, kind) for f, name in found for kind in sketches.NEEDED_BELOW.get(name, []))})
    made = {f"__of_{kind}_{f}": sketches.MADE[kind][0](F.col(f)) for f, kind in every}
    whole = {f"__{kind}_{f}": sketches.MADE[kind][1](F.col(f"__of_{kind}_{f}")) for f, kind in every}
    prepared = {sketches.prepared_column(name, f): sketches.PREPARED[name][0](F.col(f)) for f, name in found if name in sketches.PREPARED}
    # by rows, since sketches cost more than bytes tell; written, since it is read for either side and for the blocks' sizes
    slim = _slim(df, config, tree, policy, across).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), BLOCK, ID)
    held = stash(finish(slim.withColumns(made | prepared).withColumns(whole).drop(*made), "sketch", policy), "sketches").df
    # numbers that are never null keep the join's condition short enough to be compiled
    flat = {c: F.coalesce(F.get(f"__{kind}_{f}", F.lit(i)), F.lit(0).cast("long")) for f, kind in kinds for i, c in enumerate(sketches.sketch_columns(f, kind))}
    return held.withColumns(flat).drop(*(f"__{kind}_{f}" for f, kind in kinds))


def _likely(held: DataFrame, config: Config, fitted: model.MatchModel, across: bool) -> DataFrame:
    """Pairs of sketched records but for those of one ``__root``, if they have such, and those that cannot match; these leave the join at once."""
    found = config.features()
    known, highest = _by_cost(found, sketches.CHEAP)
    keep = ~model.decided(fitted, known, highest, _unbounded(found))[0]
    if ROOT in held.columns:
        keep = (F.col(ROOT) != F.col(RIGHT + ROOT)) & keep
    return blocking.candidate_pairs(held, None, BLOCK, ID, RIGHT, "z_source" if across else None, keep=keep)


def likely_pairs(df: DataFrame, config: Config, fitted: model.MatchModel, tree: blocking.Node, policy: Policy = DEFAULT, across: bool = False) -> DataFrame:
    """Candidate pairs but for those that cheap scores and bounds from sketches show to be no matches."""
    return _likely(_sketched(df, config, tree, policy, across), config, fitted, across)


def _bounds(found: list[tuple[str, str]], highest: dict[str, Column], parts: dict[str, str]) -> dict[str, Column]:
    """Lower bounds from sketches of the scores that ``highest`` bounds from above; ``parts`` names the columns that ``_differing`` made."""
    apart = lambda f: lambda w: F.col(parts[f"{f} {w}"])
    return {n: sketches.lowest(found[int(n[4:])][1], found[int(n[4:])][0], RIGHT, apart(found[int(n[4:])][0])) for n in highest}


def _differing(pairs: DataFrame, found: list[tuple[str, str]]) -> tuple[DataFrame, dict[str, str]]:
    fields = sorted({f for f, name in found if "lanes" in sketches.NEEDED_BELOW.get(name, [])})
    parts = {f"{f} {w}": f"__apart_{f}_{w}" for f in fields for w in range(sketches.WORDS)}
    return pairs.withColumns({parts[f"{f} {w}"]: sketches.differences(f, RIGHT)(w) for f in fields for w in range(sketches.WORDS)}), parts


def sure_edges(held: DataFrame, config: Config, fitted: model.MatchModel, across: bool) -> DataFrame:
    """Of the pairs that bounds from sketches show to match, each record's one with the smallest id before its own."""
    found = config.features()
    pairs, parts = _differing(_likely(held, config, fitted, across), found)
    known, highest = _by_cost(found, {name for _, name in found} - sketches.COSTLY)
    pairs = pairs.withColumns(known | {f"__low_{n}": c for n, c in _bounds(found, highest, parts).items()} | {f"__high_{n}": c for n, c in highest.items()})
    yes = model.decided(fitted, {n: F.col(n) for n in known}, {n: F.col(f"__high_{n}") for n in highest}, _unbounded(found), {n: F.col(f"__low_{n}") for n in highest})[1]
    # a row number keeps the filter from being pushed down, where what it needs would be computed again for each use
    pairs = pairs.select(ID, RIGHT + ID, yes.alias("__yes"), F.monotonically_increasing_id().alias("__row"))
    return pairs.where((F.col("__row") >= 0) & F.col("__yes")).groupBy(RIGHT + ID).agg(F.min(ID).alias(ID))


def judged_pairs(held: DataFrame, config: Config, fitted: model.MatchModel, policy: Policy = DEFAULT, across: bool = False) -> DataFrame:
    """Pairs of sketched records that match (``yes``), or that only costly scores can tell; of the latter, also the other scores and the compared columns."""
    found = config.features()
    for _, name in found:
        policy.check(registry.resolve(name, "similarity"))
    policy.check("model.nativePrediction")
    pairs, parts = _differing(_likely(held, config, fitted, across), found)
    known, highest = _by_cost(found, {name for _, name in found} - sketches.COSTLY)
    near = _bounds(found, highest, parts)
    below = {f"sim_{i}": sketches.AT_LEAST[name](F.col(f), F.col(RIGHT + f)) for i, (f, name) in enumerate(found) if name in sketches.AT_LEAST}

    def verdict(x: Column) -> Column:
        """True, false, or null where only the costly scores tell: by bounds from sketches, then by passes over both strings."""
        some, top = {n: x[n] for n in known}, {n: x[n] for n in highest}
        if not highest:
            return model.is_match([some[n] for n in fitted.features], fitted)
        no, yes = model.decided(fitted, some, top, _unbounded(found), {n: x[f"low_{n}"] for n in highest})
        passed = F.lit(None).cast("boolean")
        if below:
            passed = let(F.struct(*(c.alias(n) for n, c in below.items())), lambda y: F.when(model.decided(fitted, some, top, _unbounded(found), {n: y[n] for n in below})[1], True))
        return F.when(no, False).when(yes, True).otherwise(passed)

    values = F.struct(*(c.alias(n) for n, c in (known | highest).items()), *(c.alias(f"low_{n}") for n, c in near.items()))
    # a row number keeps the filter from being pushed into the join, whose condition runs for every pair
    scored = pairs.withColumn("__row", F.monotonically_increasing_id()).withColumn("__s", let(values, lambda x: F.struct(verdict(x).alias("yes"), *(x[n].alias(n) for n in known))))
    undecided = F.col("__s.yes").isNull()
    compared = sorted({f for f, name in found if name in sketches.COSTLY})
    columns = {c: F.when(undecided, F.col(c)) for f in compared for c in (f, RIGHT + f)} | {n: F.when(undecided, F.col("__s")[n]) for n in known if highest}
    kept = scored.where((F.col("__row") >= 0) & F.coalesce(F.col("__s.yes"), F.lit(True)))
    roots = [c for c in (ROOT, RIGHT + ROOT) if ROOT in held.columns]
    return kept.select(ID, RIGHT + ID, *roots, F.coalesce(F.col("__s.yes"), F.lit(False)).alias("yes"), *(v.alias(c) for c, v in columns.items()))


def _rooted(df: DataFrame, forest: DataFrame, column: str) -> DataFrame:
    """``df`` with the ids of a column that hang on others in a star forest replaced by these."""
    roots = forest.select(F.col("v").alias("__v"), F.col("m").alias("__m"))
    return df.join(roots, F.col(column) == F.col("__v"), "left").withColumn(column, F.coalesce("__m", column)).drop("__v", "__m")


def match_edges(df: DataFrame, config: Config, fitted: model.MatchModel, tree: blocking.Node, phase: str, policy: Policy = DEFAULT, across: bool = False) -> DataFrame:
    """Pairs of ids with the connected components of all pairs that the model predicts to match.

    Pairs that bounds decide either way get no full scores, and pairs that need them get none where other matches connect their ends: at
    first those that bounds from sketches tell, then also those that passes over both strings tell.
    """
    found = config.features()
    names = [f"sim_{i}" for i in range(len(found))]
    if not model.bounded(fitted) or not set(fitted.features) <= set(names):
        return finish(scored_pairs(df, config, fitted, tree, policy, across).where("prediction = 1").select(ID, RIGHT + ID), phase, policy)
    held = _sketched(df, config, tree, policy, across)
    costly = {f"sim_{i}": (name, f) for i, (f, name) in enumerate(found) if name in sketches.COSTLY}
    if not costly:
        return finish(judged_pairs(held, config, fitted, policy, across), phase, policy).select(ID, RIGHT + ID)
    sure = star_forest(finish(sure_edges(held, config, fitted, across), phase, policy), ID, RIGHT + ID).df
    held = _rooted(held.withColumn(ROOT, F.col(ID)), sure, ROOT)
    judged = stash(finish(judged_pairs(held, config, fitted, policy, across), phase, policy), "judged").df
    passed = star_forest(judged.where("yes"), ROOT, RIGHT + ROOT).df
    apart = _rooted(_rooted(judged.where("not yes"), passed, ROOT), passed, RIGHT + ROOT).where(F.col(ROOT) != F.col(RIGHT + ROOT))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    apart = apart.repartition(tasks, ID, RIGHT + ID).withColumn("__row", F.monotonically_increasing_id())
    scores = [rule(costly[n][0], "similarity")(F.col(costly[n][1]), F.col(RIGHT + costly[n][1])) if n in costly else F.col(n) for n in fitted.features]
    matched = apart.where((F.col("__row") >= 0) & model.is_match(scores, fitted)).select(ROOT, RIGHT + ROOT)
    last = star_forest(finish(matched, phase, policy), ROOT, RIGHT + ROOT).df
    ends = _rooted(_rooted(held.select(ID, ROOT), passed, ROOT), last, ROOT)
    return ends.where(F.col(ID) != F.col(ROOT)).select(ID, F.col(ROOT).alias(RIGHT + ID))


def _clusters(df: DataFrame, edges: Callable[[], DataFrame]) -> DataFrame:
    """Records with their component; what was written on the way is dropped."""
    held = settle(edges, "matches")
    out = connected_components(df, held.df, ID, RIGHT + ID, CLUSTER)
    held.drop()
    return out


def match(df: DataFrame, config: Config, fitted: model.MatchModel, tree: blocking.Node, policy: Policy = DEFAULT) -> DataFrame:
    """Records with the cluster of the matches within one source."""
    return _clusters(df, lambda: match_edges(df, config, fitted, tree, "match", policy))


def link(df: DataFrame, config: Config, fitted: model.MatchModel, tree: blocking.Node, policy: Policy = DEFAULT) -> DataFrame:
    """Records that are linked with a record of another source, with their cluster."""
    linked = _clusters(df, lambda: match_edges(df, config, fitted, tree, "link", policy, across=True))
    several = linked.groupBy(CLUSTER).agg(F.count("*").alias("n")).where("n > 1").select(CLUSTER)
    return linked.join(several, CLUSTER, "left_semi")


def _told(df: DataFrame, config: Config) -> Column:
    """A digest, of 128 bits, of all that the scores can see of a record."""
    seen = {}
    for f, name in config.features():
        kind, c = df.schema[f].dataType, F.col(f)
        if name == "CheckNullFunction":
            seen[f"null {f}"] = c.isNull()
        elif name == "CheckBlankOrNullFunction":
            seen[f"blank {f}"] = blank(c.cast("string"))
        else:
            seen[f"value {f}"] = c if kind.typeName() in ("array", "struct", "map", "binary") else c.cast("string")
    return F.md5(F.to_json(F.struct(*(v.alias(k) for k, v in seen.items())), {"ignoreNullFields": "false"}))


def find_training_data(df: DataFrame, config: Config, fitted: model.MatchModel | None, tree: blocking.Node, most: int = 20, policy: Policy = DEFAULT) -> DataFrame:
    """Candidate pairs to label, the least certain first (without a model, those with middling scores).

    Records of a block that no score can tell apart are one class. Pairs of classes are scored; only records whose id can begin one of the
    ``most`` pairs then meet the other class, so the pairs of a block are neither made nor scored one by one.
    """
    found = settle(lambda: _least_certain(df, config, fitted, tree, most, policy), "uncertain").df.orderBy("__far", ID, RIGHT + ID)
    cluster = F.sha2(F.concat_ws("|", F.col(ID).cast("string"), F.col(RIGHT + ID).cast("string")), 256)
    return found.drop("__far").withColumn(CLUSTER, cluster).withColumn(MATCH, F.lit(None).cast("int"))


def _least_certain(df: DataFrame, config: Config, fitted: model.MatchModel | None, tree: blocking.Node, most: int, policy: Policy) -> DataFrame:
    slim = _slim(df, config, tree, policy, False)
    names, fields = slim.columns, list(dict.fromkeys(f.name for f in config.compared()))
    key = F.concat_ws("|", F.col(BLOCK).cast("string"), _told(slim, config))
    records = stash(slim.where(F.col(ID).isNotNull()).withColumn("__class", key), "records").df

    # a class: one of its records, its first ids in order, and its last id
    place = F.row_number().over(Window.partitionBy("__class").orderBy(ID))
    first = records.select("__class", ID).distinct().withColumn("__place", place).where(F.col("__place") <= most)
    first = first.groupBy("__class").agg(F.array_sort(F.collect_list(ID)).alias("__ids"))
    stood = records.groupBy("__class", BLOCK).agg(F.max(ID).alias("__last"), F.any_value(F.struct(*fields)).alias("__r")).join(first, "__class")
    stood = stash(stood.select("__class", BLOCK, "__ids", "__last", *(F.col("__r")[f].alias(f) for f in fields)), "classes").df

    # an id below the last one of the other class begins a pair with it, so the first ids of a class are enough: later ones come after as
    # many pairs of the same score; and what comes after so many of these beginnings is not asked for
    begins = F.get("__ids", F.lit(0)) < F.col(RIGHT + "__last")
    scored = _uncertainty(blocking.candidate_pairs(stood, stood, BLOCK, "__class", RIGHT, keep=begins), config, fitted, policy)
    able = scored.select("__class", RIGHT + "__class", "__far", F.explode(F.filter("__ids", lambda i: i < F.col(RIGHT + "__last"))).alias(ID))
    cut = able.select("__far", ID).orderBy("__far", ID).limit(most).agg(F.max(F.struct("__far", ID)).alias("__cut"))
    cut = stash(cut, "cut").df
    wanted = able.join(F.broadcast(cut), F.struct("__far", ID) <= F.col("__cut")).select("__class", RIGHT + "__class", ID)
    wanted = stash(wanted, "wanted").df
    left = records.join(wanted, ["__class", ID]).select(*names, RIGHT + "__class")
    right = records.select("__class", *names).toDF(*(RIGHT + c for c in ["__class", *names]))
    pairs = left.join(right, RIGHT + "__class").where(F.col(ID) < F.col(RIGHT + ID)).drop(RIGHT + "__class").select(*names, *(RIGHT + c for c in names))
    return _uncertainty(pairs, config, fitted, policy).orderBy("__far", ID, RIGHT + ID).limit(most)


def _uncertainty(pairs: DataFrame, config: Config, fitted: model.MatchModel | None, policy: Policy) -> DataFrame:
    """Pairs with their scores and how far these are from the middle."""
    pairs, names = score_features(pairs, config, policy)
    if fitted is None:
        mean = sum((F.coalesce(F.col(n), F.lit(0.0)) for n in names), F.lit(0.0)) / len(names)
        pairs = pairs.withColumn(SCORE, mean)
    else:
        pairs = model.predict(pairs, fitted, policy).withColumn(SCORE, F.col("score"))
    return pairs.withColumn("__far", F.abs(F.col(SCORE) - 0.5))


def label(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with the labels (z_cluster, z_isMatch) of a table; what it does not hold stays undecided, 2."""
    given = labels.select(CLUSTER, F.col(MATCH).alias("__given"))
    return pairs.join(given, CLUSTER, "left").withColumn(MATCH, F.coalesce("__given", MATCH, F.lit(2))).drop("__given")


def representatives(df: DataFrame, cluster: str = CLUSTER, order: str = ID) -> DataFrame:
    """The first record, by ``order``, of each cluster."""
    place = F.row_number().over(Window.partitionBy(cluster).orderBy(order))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")
