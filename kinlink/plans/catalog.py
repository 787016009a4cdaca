"""The registered queries of the linkage engine and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinlink.functions import hashes, similarity
from kinlink.functions.preprocess import case_normalize, stop_words, trim, vector_value
from kinlink.operators import blocking, model, registry
from kinlink.operators.graph import connected_components
from kinlink.plans import evidence

Query = Callable[[SparkSession, str], DataFrame]
STOP = r"\b(the|and|of)\b"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --- inputs: pairs of rows whose keys follow one another, and null or blank sides made from the key

_PARTS = "SELECT p_partkey AS id, CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN '' ELSE concat(p_name, ' ', CAST(p_partkey % 7 AS {s}), '-', p_brand) END AS v, p_size AS i, p_retailprice AS d FROM part"
_CUSTOMERS = "SELECT c_custkey AS id, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END AS d, CAST(CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END AS {f}) AS f, CAST(floor(c_acctbal) AS INT) AS i, CAST(floor(c_acctbal * 1000) AS BIGINT) AS l, c_acctbal < 0 AS b FROM customer"


def _dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by the key that they are joined on: scores cost more than their rows' bytes tell, by which partitions would be coalesced."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _pairs(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    base = spark.sql(sql.format(s="STRING", f="FLOAT").replace(f"FROM {table}", "FROM {df}"), df=_read(spark, sf_dir, table))
    left = base.select("id", *(F.col(c).alias(f"l_{c}") for c in base.columns if c != "id"))
    right = base.select((F.col("id") - 1).alias("id"), *(F.col(c).alias(f"r_{c}") for c in base.columns if c != "id"))
    return _dealt(left, "id").join(right, "id")


_PART_SQL = "(WITH b AS ({0}) SELECT x.id, x.v AS l_v, y.v AS r_v, x.i AS l_i, y.i AS r_i, x.d AS l_d, y.d AS r_d FROM b x JOIN b y ON y.id = x.id + 1)".format(_PARTS.format(s="VARCHAR"))
_CUSTOMER_SQL = "(WITH b AS ({0}) SELECT x.id, x.d AS l_d, y.d AS r_d, x.f AS l_f, y.f AS r_f, x.i AS l_i, y.i AS r_i, x.l AS l_l, y.l AS r_l FROM b x JOIN b y ON y.id = x.id + 1)".format(_CUSTOMERS.format(f="FLOAT"))


def _score(function: Callable[[Column, Column], Column], table: str, sql: str, column: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pairs = _pairs(spark, sf_dir, table, sql)
        return pairs.select("id", F.round(function(F.col(f"l_{column}"), F.col(f"r_{column}")), 6).alias("score"))

    return run


_BLANK = "l_v IS NULL OR r_v IS NULL OR l_v = '' OR r_v = ''"


def _gated(body: str) -> str:
    return f"CASE WHEN {_BLANK} THEN 1.0 ELSE {body} END"


def _set_sql(pattern: str, lower: bool) -> tuple[str, str]:
    f = (lambda c: f"lower({c})") if lower else (lambda c: c)
    l, r = (f"list_distinct(regexp_extract_all({f(c)}, '{pattern}'))" for c in ("l_v", "r_v"))
    return f"len(list_intersect({l}, {r}))::DOUBLE", f"len(list_distinct(list_concat({l}, {r})))"


def _affine_sql(left: str, right: str) -> str:
    """The alignment as nested folds: both folds carry (j, m, s, t, best); the outer one's j is the row."""
    members = "".join(similarity.NEAR_GROUPS).replace("'", "''")
    classes = "".join(chr(0xF000 + i) * len(g) for i, g in enumerate(similarity.NEAR_GROUPS))
    state = "{{'j': {j}, 'm': {m}, 's': {s}, 't': {t}, 'best': {best}}}"
    empty = "[]::DOUBLE[]"
    steps = lambda n: f"list_transform(range(1, {n} + 1), lambda q: {state.format(j='q', m=empty, s=empty, t=empty, best='0::DOUBLE')})"
    score = "(CASE WHEN la[x.j] = lb[y.j] THEN 5 WHEN ka[x.j] = kb[y.j] THEN 3 ELSE -3 END)"
    m = f"greatest(0, greatest(acc.m[y.j], acc.s[y.j], w.t[y.j]) + {score})::DOUBLE"
    gap = "greatest(0, acc.m[y.j + 1] - 5, acc.s[y.j + 1] - 1)::DOUBLE"
    along = "greatest(0, w.m[y.j] - 5, w.t[y.j] - 1)::DOUBLE"
    cell = state.format(j="y.j", m=f"list_append(w.m, {m})", s=f"list_append(w.s, {gap})", t=f"list_append(w.t, {along})", best=f"greatest(w.best, {m}, {gap}, {along})")
    row = f"list_reduce(list_prepend({state.format(j='0::BIGINT', m='[0::DOUBLE]', s='[0::DOUBLE]', t='[0::DOUBLE]', best='acc.best')}, {steps('len(lb)')}), lambda w, y: {cell})"
    zeros = "list_transform(range(0, len(lb) + 1), lambda q: 0::DOUBLE)"
    whole = f"list_reduce(list_prepend({state.format(j='0::BIGINT', m=zeros, s=zeros, t=zeros, best='0::DOUBLE')}, {steps('len(la)')}), lambda acc, x: {row}).best"
    chars = lambda v: f"CASE WHEN {v} = '' THEN []::VARCHAR[] ELSE string_split({v}, '') END"
    classed = lambda v: chars(f"translate({v}, '{members}', '{classes}')")
    return (
        f"WITH p AS MATERIALIZED (SELECT id, l_v, r_v, {left} AS l, {right} AS r FROM {_PART_SQL}), q AS MATERIALIZED (SELECT *, lower(l) AS a, lower(r) AS b FROM p),"
        f" c AS MATERIALIZED (SELECT *, {chars('a')} AS la, {chars('b')} AS lb, {classed('a')} AS ka, {classed('b')} AS kb FROM q WHERE a <> b AND a <> '' AND b <> ''),"
        f" d AS (SELECT id, {whole} / (5 * least(len(la), len(lb))) AS score FROM c)"
        f" SELECT q.id, round(CASE WHEN {_BLANK} OR l = '' OR r = '' OR a = b THEN 1.0 ELSE d.score END::DOUBLE, 6) AS score FROM q LEFT JOIN d ON d.id = q.id"
    )


def _jaro_sql() -> str:
    """The second string is consumed mark by mark, as in the Spark expression's definition."""
    step = "{{'i': {i}, 'rest': {rest}, 'hit': {hit}}}"
    low = "greatest(x.i - half, 1)"
    window = f"substr(acc.rest, {low}, greatest(least(length(b), x.i + half) - {low} + 1, 0))"
    place = f"instr({window}, substr(a, x.i, 1))"
    rest = f"CASE WHEN {place} > 0 THEN substr(acc.rest, 1, {low} + {place} - 2) || chr(1) || substr(acc.rest, {low} + {place}) ELSE acc.rest END"
    fold = f"list_reduce(list_prepend({step.format(i='0::BIGINT', rest='b', hit=chr(39) * 2)}, list_transform(range(1, length(a) + 1), lambda k: {step.format(i='k', rest=chr(39) * 2, hit=chr(39) * 2)})), lambda acc, x: {step.format(i='x.i', rest=rest, hit=f'acc.hit || CASE WHEN {place} > 0 THEN substr(a, x.i, 1) ELSE {chr(39) * 2} END')})"
    return (
        f"WITH q AS MATERIALIZED (SELECT id, l_v, r_v, lower(l_v) AS a, lower(r_v) AS b, least(length(l_v), length(r_v)) // 2 + 1 AS half FROM {_PART_SQL}),"
        f" c AS MATERIALIZED (SELECT id, a, b, {fold} AS z FROM q WHERE a <> b AND a <> '' AND b <> ''),"
        " d AS MATERIALIZED (SELECT *, length(z.hit)::DOUBLE AS n, len(list_filter(list_zip(string_split(z.hit, ''), list_transform(list_filter(range(1, length(b) + 1), lambda j: substr(z.rest, j, 1) = chr(1)), lambda j: substr(b, j, 1))), lambda w: w[1] <> w[2])) // 2 AS crossed FROM c)"
        f" SELECT q.id, round(CASE WHEN {_BLANK} OR q.a = q.b THEN 1.0 WHEN n = 0 THEN 0.0 ELSE (n / length(q.a) + n / length(q.b) + (n - crossed) / n) / 3 END::DOUBLE, 6) AS score FROM q LEFT JOIN d ON d.id = q.id"
    )


def _similarity_sql() -> dict[str, str]:
    both, union = _set_sql(r"[\p{L}]+|[\p{N}]+", True)
    nboth, nunion = _set_sql("[0-9]+", False)
    product = similarity.PRODUCT_CODE.replace("'", "''")
    codes = lambda c: f"list_distinct(list_transform(regexp_extract_all(coalesce({c}, ''), '{product}'), lambda t: replace(t, ' ', '')))"
    pl, pr = codes("l_v"), codes("r_v")
    punion = f"len(list_distinct(list_concat({pl}, {pr})))"
    part = {
        "SimilarityFunctionExact": "CASE WHEN l_v IS NULL OR r_v IS NULL OR l_v = r_v THEN 1.0 ELSE 0.0 END",
        "StringSimilarityFunction": _gated("CASE WHEN l_v = r_v THEN 1.0 ELSE 0.0 END"),
        "CheckNullFunction": "CASE WHEN l_v IS NOT NULL AND r_v IS NOT NULL THEN 1.0 ELSE 0.0 END",
        "CheckBlankOrNullFunction": f"CASE WHEN {_BLANK} THEN 0.0 ELSE 1.0 END",
        "JaccSimFunction": _gated(f"CASE WHEN {union} = 0 THEN 0.0 ELSE {both} / {union} END"),
        "NumbersJaccardFunction": f"CASE WHEN {_BLANK} OR {nunion} = 0 THEN 0.0 ELSE {nboth} / {nunion} END",
        "ProductCodeFunction": f"CASE WHEN {punion} = 0 THEN 1.0 ELSE len(list_intersect({pl}, {pr}))::DOUBLE / {punion} END",
        "PinCodeMatchTypeFunction": _gated("CASE WHEN split_part(l_v, '-', 1) = split_part(r_v, '-', 1) THEN 1.0 ELSE 0.0 END"),
        "OnlyAlphabetsExactSimilarity": _gated("CASE WHEN regexp_replace(l_v, '[0-9.]', '', 'g') = regexp_replace(r_v, '[0-9.]', '', 'g') THEN 1.0 ELSE 0.0 END"),
    }
    wrap = lambda v, bits: f"((({v}) + {2 ** (bits - 1)}::HUGEINT) % {2**bits}::HUGEINT + {2**bits}::HUGEINT) % {2**bits}::HUGEINT - {2 ** (bits - 1)}::HUGEINT"

    def ratio(c: str, bits: int) -> str:
        total, apart = (wrap(f"l_{c}::HUGEINT {op} r_{c}::HUGEINT", bits) for op in "+-")
        size = f"CASE WHEN {apart} = -{2 ** (bits - 1)}::HUGEINT THEN ({apart})::DOUBLE ELSE abs(({apart})::DOUBLE) END"
        return f"CASE WHEN l_{c} IS NULL OR r_{c} IS NULL OR {total} = 0 THEN 0.0 ELSE 2.0 * ({size}) / ({total})::DOUBLE END"

    floating = lambda c, apart: f"CASE WHEN l_{c} IS NULL OR r_{c} IS NULL THEN 1.0 ELSE 1.0 - ({apart}) / (1.0::DOUBLE + l_{c}::DOUBLE + r_{c}::DOUBLE) END"
    customer = {
        "IntegerSimilarityFunction": ratio("i", 32),
        "LongSimilarityFunction": ratio("l", 64),
        "DoubleSimilarityFunction": floating("d", "abs(l_d - r_d)"),
        "FloatSimilarityFunction": floating("f", "abs(l_f - r_f)::DOUBLE"),
    }
    out = {k: f"SELECT id, round(({v})::DOUBLE, 6) AS score FROM {_PART_SQL}" for k, v in part.items()}
    out |= {k: f"SELECT id, round(({v})::DOUBLE, 6) AS score FROM {_CUSTOMER_SQL}" for k, v in customer.items()}
    out |= {"JaroWinklerFunction": _jaro_sql(), "AJaroWinklerFunction": _jaro_sql()}
    before = lambda v, mark: f"split_part({v}, '{mark}', 1)"
    letters = lambda v: f"regexp_replace({v}, '[0-9.]', '', 'g')"
    for name, l, r in (
        ("AffineGapSimilarityFunction", "l_v", "r_v"),
        ("EmailMatchTypeFunction", before("l_v", "@"), before("r_v", "@")),
        ("OnlyAlphabetsAffineGapSimilarity", letters("l_v"), letters("r_v")),
        ("SameFirstWordFunction", before("l_v", "-"), before("r_v", "-")),
    ):
        out[name] = _affine_sql(l, r)
    out["DateSimilarityFunction"] = (
        "WITH b AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS v FROM orders), p AS (SELECT x.id, (x.v - DATE '1970-01-01')::BIGINT * 86400000 AS l, (y.v - DATE '1970-01-01')::BIGINT * 86400000 AS r FROM b x JOIN b y ON y.id = x.id + 1) "
        "SELECT id, round(CASE WHEN l IS NULL OR r IS NULL THEN 1.0 ELSE 1.0 - abs((l - r)::DOUBLE / (l + r + 1)::DOUBLE) END::DOUBLE, 6) AS score FROM p"
    )
    out["ArrayDoubleSimilarityFunction"] = (
        "WITH b AS (SELECT vec_id AS id, CASE WHEN vec_id % 23 = 0 THEN NULL ELSE embedding::DOUBLE[] END AS v FROM embeddings) "
        "SELECT x.id, round(CASE WHEN x.v IS NULL OR y.v IS NULL THEN 0.0 ELSE least(1.0, abs(list_dot_product(x.v, y.v) / (sqrt(list_dot_product(x.v, x.v)) * sqrt(list_dot_product(y.v, y.v))))) END::DOUBLE, 6) AS score FROM b x JOIN b y ON y.id = x.id + 1"
    )
    return out


def _date(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 11 != 0, F.to_date("o_orderdate")).alias("v"))
    other = base.select((F.col("id") - 1).alias("id"), F.col("v").alias("w"))
    return base.join(other, "id").select("id", F.round(similarity.date(F.col("v"), F.col("w")), 6).alias("score"))


def _array(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 23 != 0, F.col("embedding").cast("array<double>")).alias("v"))
    other = base.select((F.col("id") - 1).alias("id"), F.col("v").alias("w"))
    return base.join(other, "id").select("id", F.round(similarity.array_double(F.col("v"), F.col("w")), 6).alias("score"))


def _similarity_queries() -> dict[str, Query]:
    customer = {"IntegerSimilarityFunction": "i", "LongSimilarityFunction": "l", "DoubleSimilarityFunction": "d", "FloatSimilarityFunction": "f"}
    out: dict[str, Query] = {}
    for name, function in similarity.SIMILARITIES.items():
        if name in customer:
            out[name] = _score(function, "customer", _CUSTOMERS, customer[name])
        elif name == "DateSimilarityFunction":
            out[name] = _date
        elif name == "ArrayDoubleSimilarityFunction":
            out[name] = _array
        else:
            out[name] = _score(function, "part", _PARTS, "v")
    return out


# --- blocking hashes

_KIND = {"Dbl": ("d", "DOUBLE"), "Float": ("f", "FLOAT"), "Int": ("i", "INTEGER"), "Long": ("l", "BIGINT")}


def _hash_input(name: str) -> tuple[str, str, str]:
    """Table, its SQL and the column that a hash is applied to."""
    if name.startswith("truncate"):
        return "customer", _CUSTOMERS, "d" if "Double" in name else "f"
    if name == "round":
        return "customer", _CUSTOMERS, "d"
    if name.startswith("identity"):
        k = name.removeprefix("identity")
        return ("part", _PARTS, "v") if k == "String" else ("customer", _CUSTOMERS, {"Integer": "i", "Long": "l", "Boolean": "b"}[k])
    for k, (column, _) in _KIND.items():
        if name.endswith(k):
            return "customer", _CUSTOMERS, column
    return "part", _PARTS, "v"


def _hash_query(name: str) -> Query:
    table, sql, column = _hash_input(name)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = spark.sql(sql.format(s="STRING", f="FLOAT").replace(f"FROM {table}", "FROM {df}"), df=_read(spark, sf_dir, table))
        return base.select("id", hashes.HASHES[name](F.col(column)).alias("h"))

    return run


def _box_sql(bounds: list[str]) -> str:
    n = len(bounds[0])
    cases = " ".join(f"WHEN substr(v, 1, {n}) >= '{b}' THEN {i}" for i, b in reversed(list(enumerate(bounds, 1))))
    return f"CASE WHEN v IS NULL OR length(v) <= {n} THEN 0 {cases} ELSE {len(bounds) + 1} END"


def _hash_sql(name: str) -> str:
    table, sql, column = _hash_input(name)
    base = sql.format(s="VARCHAR", f="FLOAT")
    if name.startswith("first") and name.endswith("Chars"):
        body = f"substr(v, 1, {name[5]})"
    elif name.startswith("last") and name.endswith("Chars"):
        body = f"right(v, {name[4]})"
    elif name == "lastWord":
        body = "CASE WHEN v = '' THEN v WHEN rtrim(v, ' ') = '' THEN NULL ELSE list_last(string_split(rtrim(v, ' '), ' ')) END"
    elif name == "isNullOrEmpty":
        body = "v IS NULL OR v = ''"
    elif name == "first2CharsBox":
        body = _box_sql(hashes.BOX_2)
    elif name == "first3CharsBox":
        body = _box_sql(hashes.BOX_3)
    elif name.startswith("identity"):
        body = column
    elif name.startswith("lessThanZero"):
        body = f"coalesce({column} < 0, false)"
    elif name.startswith("truncate"):
        scale = f"{10 ** int(name.split('To')[1][0])}::DOUBLE"
        body = f"(trunc({column}::DOUBLE * {scale}) / {scale})::{'DOUBLE' if 'Double' in name else 'FLOAT'}"
    elif name.startswith("trimLast"):
        scale, kind = 10 ** int(name[8]), next(t for k, (_, t) in _KIND.items() if name.endswith(k))
        body = f"({column} // {scale})::{kind}" if kind in ("INTEGER", "BIGINT") else f"floor({column}::DOUBLE / {scale}::DOUBLE)::{kind}"
    elif name.startswith("rangeBetween"):
        low, high = name.removeprefix("rangeBetween").rstrip("DblFoatIntLg").split("And")
        kind = "BIGINT" if name.endswith("Long") else "INTEGER"
        body = f"coalesce(({column}::DOUBLE >= {low} AND {column}::DOUBLE < {high})::INTEGER, 0)::{kind}"
    else:
        body = f"(floor({column}) + CASE WHEN {column} - floor({column}) >= 0.5 THEN 1 ELSE 0 END)::BIGINT"
    return f"SELECT id, {body} AS h FROM ({base})"


# --- trees, preprocessing, vectors, model, graph, evidence

TREE = blocking.Node("first1Chars", "p_name", None, [blocking.Node("trimLast1DigitsInt", "p_size", "a", [blocking.Node("lastWord", "p_type", 1)]), blocking.Node("lessThanZeroInt", "p_size", "b")])


def _java_hash_sql(text: str) -> str:
    unsigned = f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)), lambda h, u: (h * 31 + u) % 4294967296)"
    return f"CASE WHEN length({text}) = 0 THEN 0 ELSE (CASE WHEN {unsigned} >= 2147483648 THEN {unsigned} - 4294967296 ELSE {unsigned} END) END::INTEGER"


_TREE_TEXT = (
    "('|' || coalesce(substr(p_name, 1, 1), 'null') || CASE WHEN substr(p_name, 1, 1) = 'a' THEN '|' || coalesce(CAST(p_size // 10 AS VARCHAR), 'null') || CASE WHEN p_size // 10 = 1 THEN '|' || list_last(string_split(rtrim(p_type, ' '), ' ')) ELSE '' END ELSE '' END"
    " || CASE WHEN substr(p_name, 1, 1) = 'b' THEN '|' || CASE WHEN p_size < 0 THEN 'true' ELSE 'false' END ELSE '' END)"
)


def tree_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.block_hashes(_read(spark, sf_dir, "part"), TREE, "h").select("p_partkey", "h")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the candidate lists of customers that share the balance, without its last digit, and the nation."""
    tree = blocking.Node(None, None, None, [blocking.Node("trimLast1DigitsDbl", "c_acctbal"), blocking.Node("identityInteger", "c_nationkey")])
    df = _read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    hashed = blocking.block_hashes(df, tree, "h")
    pairs = blocking.candidate_pairs(hashed, None, "h", "c_custkey", "z_", "c_mktsegment")
    return pairs.groupBy("c_custkey").agg(F.count("*").alias("n"))


_CANDIDATES_SQL = "SELECT a.c_custkey, count(*) AS n FROM customer a JOIN customer b ON floor(a.c_acctbal / 10) = floor(b.c_acctbal / 10) AND a.c_nationkey = b.c_nationkey AND a.c_custkey < b.c_custkey AND a.c_mktsegment <> b.c_mktsegment GROUP BY 1"


def link_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-source link: suppliers and customers of one nation whose balances share a hash."""
    s = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("bal"))
    c = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"))
    tree = blocking.Node("identityInteger", "nation", None, [])
    left, right = (blocking.block_hashes(x, tree, "h") for x in (s, c))
    pairs = blocking.candidate_pairs(left, right, "h", "id")
    return pairs.where(F.floor(F.col("bal") / 100) == F.floor(F.col("z_bal") / 100)).select("id", "z_id")


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = _read(spark, sf_dir, "lineitem")
    return line.select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") / 50).cast("double").alias("q"), F.col("l_discount").cast("double").alias("x"), F.col("l_tax").cast("double").alias("t"), (F.col("l_returnflag") == "R").cast("int").alias("label")
    )


_FEATURES = "SELECT l_orderkey, l_linenumber, (l_quantity / 50)::DOUBLE AS q, l_discount::DOUBLE AS x, l_tax::DOUBLE AS t, (l_returnflag = 'R')::INTEGER AS label FROM lineitem"
MODEL = model.MatchModel(["q", "x"], [0.5, -1.25, 0.75, 2.0, -0.5, 0.25, -3.0, 1.5, 0.125], -0.2, 0.45)
_MARGIN = "(-0.2 + 0.5*q - 1.25*q*q + 0.75*q*q*q + 2.0*x - 0.5*q*x + 0.25*q*q*x - 3.0*x*x + 1.5*q*x*x + 0.125*x*x*x)"


def polynomial(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = F.transform(model.polynomial(["q", "x", "t"], 2), lambda v: F.round(v, 6))
    return _features(spark, sf_dir).select("l_orderkey", "l_linenumber", *(F.get(terms, F.lit(i)).alias(f"t{i}") for i in range(9)))


_TERMS = ["q", "q*q", "x", "q*x", "x*x", "t", "q*t", "x*t", "t*t"]


def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.standardize(_features(spark, sf_dir), ["q", "x"]).select("l_orderkey", "l_linenumber", F.round("q", 6).alias("q"), F.round("x", 6).alias("x"))


def predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.predict(_features(spark, sf_dir), MODEL).select("l_orderkey", "l_linenumber", F.round("score", 6).alias("score"), F.col("prediction"))


def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.auc_frame(_features(spark, sf_dir).select(F.col("x").alias("score"), "label")).select(F.round("auc", 6).alias("auc"))


_AUC_SQL = (
    f"WITH f AS ({_FEATURES}), g AS (SELECT x AS s, sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS n FROM f GROUP BY x), w AS (SELECT *, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g) "
    "SELECT round(sum(p * (below + n / 2)) / (sum(p) * sum(n)), 6) AS auc FROM w"
)


def fit_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cross-validated fit on order features; saved, loaded and applied.

    The intercept is not regularized, so at the optimum the mean score is the share of positive labels, which SQL can tell.
    """
    import uuid

    from kinlink.sources.stash import delete, shared_dir

    data = _features(spark, sf_dir)
    fitted = model.fit(data, ["q", "x"], "label", degree=2, regularizations=[0.01, 0.1], max_iter=50)
    path = f"{shared_dir(spark)}/kinlink/model-{uuid.uuid4().hex}"
    model.save(spark, fitted, path)
    loaded = model.load(spark, path)
    delete(spark, path)
    return model.predict(data, loaded).agg(F.count("*").alias("n"), F.round(F.avg("score"), 3).alias("mean_score"), F.lit(loaded.status).alias("status"))


def fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal rows share a fold: no (label, features) combination is in two."""
    f = _features(spark, sf_dir).select("q", "x", "label", model.fold_of("label", ["q", "x"]).alias("fold"))
    return f.groupBy("q", "x", "label").agg(F.count_distinct("fold").alias("folds"))


def margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Margins of the distinct feature rows by sums over row ids."""
    line = _features(spark, sf_dir).select("q", "x").distinct().withColumn("row", F.round(F.col("q") * 50000 + F.col("x") * 100).cast("long"))
    return model.margins_by_row(line, MODEL, "row").select("row", F.round("margin", 6).alias("margin"))


def gradients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gradient of the stated model by exploded positions, and by batched averages of columns."""
    data = _features(spark, sf_dir)
    by_columns = spark.createDataFrame(list(enumerate(model.gradient_by_columns(data, MODEL, batch=4), -1)), "position int, batched double")
    return model.gradient(data, MODEL).join(by_columns, "position").select("position", F.round("gradient", 6).alias("gradient"), F.round("batched", 6).alias("batched"))


def changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from nations to balance bands that customers have and suppliers lack, or the other way."""
    from kinlink.operators.graph import changed_edges

    edges = lambda t, p: _read(spark, sf_dir, t).select(F.col(f"{p}_nationkey").alias("v"), F.floor(F.col(f"{p}_acctbal") / 100).alias("m"))
    return changed_edges(edges("supplier", "s"), edges("customer", "c"))


def vector_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors made of customer balances: dense for even keys, sparse for odd ones, null for every 13th."""
    base = _read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    dense = F.struct(F.lit(1).alias("type"), F.lit(None).cast("int").alias("size"), F.lit(None).cast("array<int>").alias("indices"), F.array(F.lit(0.5), F.col("c_acctbal")).alias("values"))
    sparse = F.struct(F.lit(0).alias("type"), F.lit(30).alias("size"), F.array(F.lit(0), F.col("c_nationkey") + 1).cast("array<int>").alias("indices"), F.array(F.lit(0.5), F.col("c_acctbal")).alias("values"))
    kind = "struct<type:int,size:int,indices:array<int>,values:array<double>>"
    vector = F.when(F.col("c_custkey") % 13 == 0, F.lit(None).cast(kind)).when(F.col("c_custkey") % 2 == 0, dense.cast(kind)).otherwise(sparse.cast(kind))
    return base.withColumn("v", vector).select("c_custkey", vector_value(F.col("v")).alias("value"))


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers chained to the next one of their nation and balance band."""
    customer = _read(spark, sf_dir, "customer")
    band = Window.partitionBy("c_nationkey", F.floor(F.col("c_acctbal") / 500)).orderBy("c_custkey")
    edges = customer.select(F.col("c_custkey").alias("a"), F.lead("c_custkey").over(band).alias("b"))
    return connected_components(customer.select(F.col("c_custkey").alias("a")), edges, "a", "b", "cluster")


_COMPONENTS_SQL = "SELECT c_custkey AS a, min(c_custkey) OVER (PARTITION BY c_nationkey, floor(c_acctbal / 500)) AS cluster FROM customer"


def preprocessed(kind: str) -> Query:
    rules = {"trim": trim, "caseNormalize": case_normalize, "stopWords": lambda c: stop_words(c, STOP)}

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _read(spark, sf_dir, "part").select("p_partkey", rules[kind](F.concat(F.lit("  "), F.initcap("p_name"), F.lit(" the of and  "))).alias("v"))

    return run


def _pre_sql(body: str) -> str:
    return f"SELECT p_partkey, {body} AS v FROM (SELECT p_partkey, '  ' || list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), 'string_agg', ' ') || ' the of and  ' AS s FROM part)"


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of a table and of the same table dealt and ordered differently."""
    n = _read(spark, sf_dir, "nation")
    first, second = evidence.output_fingerprint(n), evidence.output_fingerprint(n.repartition(3).orderBy(F.desc("n_name")))
    return first.select("rows", "digest").join(second.select("digest"), "digest")


_HALF = "CAST('0x' || substr(md5(j), {at}, 12) AS BIGINT)::HUGEINT"
_FINGERPRINT_SQL = (
    "SELECT count(*) AS rows, sha256(count(*)::VARCHAR || ':' || " + " || ':' || ".join(f"sum({_HALF.format(at=i)})::VARCHAR" for i in (1, 13)) + ") AS digest "
    "FROM (SELECT to_json({'n_name': n_name, 'n_nationkey': n_nationkey, 'n_regionkey': n_regionkey})::VARCHAR AS j FROM nation)"
)


def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinlink.sources.io import with_row_id

    d = with_row_id(_read(spark, sf_dir, "orders").repartition(5))
    return d.agg(F.count("*").alias("n"), F.count_distinct("z_zid").alias("ids"), (F.min("z_zid") >= 0).alias("non_negative"))


def formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table through CSV, JSON and Parquet pipes."""
    import uuid

    from kinlink.sources.io import Pipe, drop_transient, read_pipe, transient_dir, write_pipe
    from kinlink.sources.stash import shared_dir

    root, src = transient_dir(shared_dir(spark), str(uuid.uuid4())), _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = None
    for kind in ("csv", "json", "parquet"):
        props = {"location": f"{root}/{kind}"} | ({"header": "true"} if kind == "csv" else {})
        write_pipe(src, Pipe("nation", kind, props))
        back = read_pipe(spark, Pipe("nation", kind, props, "n_nationkey int, n_name string")).select(F.lit(kind).alias("format"), "n_nationkey", "n_name")
        out = back if out is None else out.unionByName(back)
    kept = spark.createDataFrame(out.collect(), out.schema)  # 75 rows; the folder is transient
    drop_transient(spark, root)
    return kept


def phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trained match over all parts, each with a planted variant: clusters and records of each part."""
    from kinlink.plans.phases import Config, Field, match, train
    from kinlink.sources.stash import stash

    part = _read(spark, sf_dir, "part")
    code = F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 8)
    base = part.select(F.col("p_partkey").alias("truth"), F.concat_ws(" ", code, "p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    variant = base.withColumn("name", F.concat("name", F.lit("x")))
    records = stash(base.withColumn("z_zid", F.col("truth") * 2).unionByName(variant.withColumn("z_zid", F.col("truth") * 2 + 1)), "records").df
    config = Config([Field("name", "fuzzy", "string"), Field("brand", "exact", "string"), Field("size", "fuzzy", "int")])
    # labels come from people, for few records: 40 known matches and 20 known differences
    labelled = records.join(F.broadcast(records.select("truth").distinct().orderBy("truth").limit(40)), "truth")
    cluster = lambda kind, value: F.concat(F.lit(kind), value.cast("string")).alias("z_cluster")
    same = labelled.select("z_zid", F.lit(1).alias("z_isMatch"), cluster("m", F.col("truth")), "name", "brand", "size")
    other = labelled.where(F.col("z_zid") == F.col("truth") * 2).select("z_zid", F.lit(0).alias("z_isMatch"), cluster("n", F.floor(F.col("truth") / 2)), "name", "brand", "size")
    fitted, tree = train(same.unionByName(other), records, config, regularizations=[0.01], degree=1, max_iter=20)
    found = match(records, config, fitted, tree)
    return found.groupBy("truth").agg(F.count_distinct("z_cluster").alias("clusters"), F.count("*").alias("records"))


def _part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts from two sources: as they are, and with a letter more in their name."""
    part = _read(spark, sf_dir, "part")
    code = F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 8)
    base = part.select(F.col("p_partkey").alias("truth"), F.concat_ws(" ", code, "p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    return base.withColumn("z_zid", F.col("truth") * 2).withColumn("z_source", F.lit("a")).unionByName(base.withColumn("name", F.concat("name", F.lit("x"))).withColumn("z_zid", F.col("truth") * 2 + 1).withColumn("z_source", F.lit("b")))


def linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records linked across two sources by exact scores and a stated model; the first record of each cluster."""
    from kinlink.plans.phases import Config, Field, link, representatives
    from kinlink.sources.stash import stash

    records = stash(_part_records(spark, sf_dir), "records").df.where("truth % 7 <> 0 OR z_source = 'a'")
    config = Config([Field("brand", "exact", "string"), Field("size", "exact", "int"), Field("name", "text", "string")])
    fitted = model.MatchModel(["sim_0", "sim_1", "sim_2"], [1.0, 1.0, 6.0], -5.0, 0.5, degree=1)
    found = link(records, config, fitted, blocking.Node("first3Chars", "name"))
    return representatives(found).select("z_zid", "z_cluster")


#: The code is the first word of the name, so two names of one part share all tokens but the last one's letter more.
_LINKED_SQL = (
    "WITH RECURSIVE r AS MATERIALIZED (SELECT p_partkey * 2 + s.i AS id, s.i AS src, p_brand, p_size, concat(substr(md5(p_partkey::VARCHAR), 1, 8), ' ', p_name, CASE WHEN s.i = 1 THEN 'x' ELSE '' END) AS name"
    " FROM part, (VALUES (0), (1)) s(i) WHERE p_partkey % 7 <> 0 OR s.i = 0), t AS MATERIALIZED (SELECT *, list_distinct(regexp_extract_all(lower(name), '[\\p{L}]+|[\\p{N}]+')) AS w, substr(name, 1, 3) AS h FROM r),"
    " e AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM t a JOIN t b ON a.h = b.h AND a.src <> b.src"
    "  WHERE (a.p_brand = b.p_brand)::INT + (a.p_size = b.p_size)::INT + 6.0 * len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) - 5.0 > 0),"
    " c AS (SELECT a AS id, a AS m FROM e UNION SELECT c.id, e.b FROM c JOIN e ON e.a = c.m)"
    " SELECT id AS z_zid, low AS z_cluster FROM (SELECT id, min(m) AS low FROM c GROUP BY id) WHERE id = low"
)


def training_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 pairs to label of records that share the size, and the labels that a table gives for some of them."""
    from kinlink.plans.phases import Config, Field, find_training_data, label

    records = _part_records(spark, sf_dir).where("z_source = 'a'")
    config = Config([Field("brand", "exact", "string"), Field("size", "exact", "int"), Field("name", "null_or_blank", "string")])
    found = find_training_data(records, config, None, blocking.Node("identityInteger", "size"))
    given = found.where("z_zid % 4 = 0").select("z_cluster", F.lit(1).alias("z_isMatch"))
    return label(found, given).select("z_zid", "z_z_zid", F.round("z_score", 6).alias("score"), "z_isMatch")


_TRAINING_SQL = (
    "WITH p AS (SELECT a.p_partkey * 2 AS z_zid, b.p_partkey * 2 AS z_z_zid, ((a.p_brand = b.p_brand)::INT + 2) / 3.0::DOUBLE AS s FROM part a JOIN part b ON a.p_size = b.p_size AND a.p_partkey < b.p_partkey)"
    " SELECT z_zid, z_z_zid, round(s, 6) AS score, CASE WHEN z_zid % 4 = 0 THEN 1 ELSE 2 END::INTEGER AS z_isMatch FROM p ORDER BY abs(s - 0.5), z_zid, z_z_zid LIMIT 20"
)


def engine_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each mode makes of a match whose input runs Python: refused or not, logged or not."""
    from kinlink.plans.phases import Config, Field, match

    records = _part_records(spark, sf_dir).where("truth < 50 AND z_source = 'a'")
    foreign = records.mapInArrow(lambda batches: batches, records.schema)
    config = Config([Field("brand", "exact", "string")])
    fitted = model.MatchModel(["sim_0"], [1.0], -2.0, 0.5, degree=1)
    rows = []
    for mode in registry.MODES:
        policy = registry.Policy.parse(mode.lower())
        try:
            match(foreign, config, fitted, blocking.Node("identityInteger", "size"), policy)
            refused = False
        except registry.GuardViolation:
            refused = True
        rows.append((mode, refused, any(m.startswith("guard ") for m in policy.diagnostics.seen)))
    return spark.createDataFrame(rows, "mode string, refused boolean, logged boolean")


FLAGSHIP_TREE = blocking.Node(None, None, None, [blocking.Node("first4Chars", "text"), blocking.Node("lastWord", "text")])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: block on the first characters and the last word, score whole texts, cluster, and count cluster sizes.

    Each text is tokenized once. Pairs are made of ids and numbers of tokens; sets whose sizes alone rule the similarity out are not
    fetched, the others' hashed tokens come by id.
    """
    from kinlink.sources.stash import stash

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    hashed = blocking.block_hashes(docs, FLAGSHIP_TREE, "h").withColumn("tokens", similarity.tokens(F.col("text")))
    held = stash(hashed.select("doc_id", "h", F.size("tokens").alias("n"), F.transform("tokens", lambda t: F.xxhash64(t)).alias("tokens")), "tokens").df
    pairs = blocking.candidate_pairs(held.select("doc_id", "h", "n"), None, "h", "doc_id")
    # a text that is null or empty has no tokens, null, and scores 1 with any
    fits = F.col("n").isNull() | F.col("z_n").isNull() | ((F.least("n", "z_n") >= 0.8 * F.greatest("n", "z_n")) & (F.greatest("n", "z_n") > 0))
    pairs = pairs.where(fits).select("doc_id", "z_doc_id")
    sides = [held.select(F.col("doc_id").alias(k), F.col("tokens").alias(t)) for k, t in (("doc_id", "left"), ("z_doc_id", "right"))]
    scored = _dealt(pairs, "doc_id").join(sides[0], "doc_id").join(sides[1], "z_doc_id").where(similarity.jaccard_of_tokens(F.col("left"), F.col("right")) >= 0.8)
    clustered = connected_components(docs.select("doc_id"), scored.select("doc_id", "z_doc_id"), "doc_id", "z_doc_id", "cluster")
    return clustered.groupBy("cluster").agg(F.count("*").alias("n"))


_FLAGSHIP_SQL = f"""WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, text, substr(text, 1, 4) AS f, CASE WHEN text = '' THEN text WHEN rtrim(text, ' ') = '' THEN NULL ELSE list_last(string_split(rtrim(text, ' '), ' ')) END AS w, list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}]+|[\\p{{N}}]+')) AS t FROM documents),
 e AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM d a JOIN d b ON a.f IS NOT DISTINCT FROM b.f AND a.w IS NOT DISTINCT FROM b.w AND a.doc_id <> b.doc_id
  WHERE a.text IS NULL OR b.text IS NULL OR a.text = '' OR b.text = '' OR (len(list_distinct(list_concat(a.t, b.t))) > 0 AND len(list_intersect(a.t, b.t))::DOUBLE / len(list_distinct(list_concat(a.t, b.t))) >= 0.8)),
 r AS (SELECT doc_id AS a, doc_id AS m FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.m), c AS (SELECT a, min(m) AS cluster FROM r GROUP BY a)
SELECT cluster, count(*) AS n FROM c GROUP BY cluster"""


def queries() -> dict[str, Query]:
    out = {f"similarity_{k}": q for k, q in _similarity_queries().items()}
    out |= {f"blocking_{k}": _hash_query(k) for k in hashes.HASHES}
    out |= {f"preprocess_{k}": preprocessed(k) for k in ("trim", "caseNormalize", "stopWords")}
    out |= {
        "blocking_tree": tree_hash,
        "blocking_candidates": candidates,
        "link_pairs": link_pairs,
        "vector_value": vector_values,
        "model_polynomial": polynomial,
        "model_standardize": standardized,
        "model_predict": predict,
        "model_auc": auc,
        "model_margins_by_row": margins,
        "model_gradient": gradients,
        "graph_changed_edges": changed,
        "model_fit_save_load": fit_model,
        "model_folds": fold_sizes,
        "graph_connected_components": components,
        "evidence_fingerprint": fingerprint,
        "source_formats": formats,
        "source_row_ids": row_ids,
        "phases_train_match": phases,
        "phases_link": linked,
        "phases_training_pairs": training_pairs,
        "engine_modes": engine_modes,
        "flagship_document_clusters": flagship,
    }
    return out


def oracle_sql() -> dict[str, str]:
    out = {f"similarity_{k}": v for k, v in _similarity_sql().items()}
    out |= {f"blocking_{k}": _hash_sql(k) for k in hashes.HASHES}
    out |= {
        "preprocess_trim": _pre_sql("trim(s)"),
        "preprocess_caseNormalize": _pre_sql("lower(s)"),
        "preprocess_stopWords": _pre_sql(f"regexp_replace(s, '{STOP}', '', 'g')"),
        "blocking_tree": f"SELECT p_partkey, {_java_hash_sql(_TREE_TEXT)} AS h FROM part",
        "blocking_candidates": _CANDIDATES_SQL,
        "link_pairs": "SELECT s_suppkey AS id, c_custkey AS z_id FROM supplier JOIN customer ON s_nationkey = c_nationkey AND floor(s_acctbal / 100) = floor(c_acctbal / 100)",
        "vector_value": "SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN c_acctbal WHEN c_nationkey = 0 THEN c_acctbal ELSE 0.0 END AS value FROM customer",
        "model_polynomial": f"SELECT l_orderkey, l_linenumber, {', '.join(f'round({t}, 6) AS t{i}' for i, t in enumerate(_TERMS))} FROM ({_FEATURES})",
        "model_standardize": f"WITH f AS ({_FEATURES}), s AS (SELECT avg(q) AS mq, stddev_pop(q) AS sq, avg(x) AS mx, stddev_pop(x) AS sx FROM f) SELECT l_orderkey, l_linenumber, round((q - mq) / sq, 6) AS q, round((x - mx) / sx, 6) AS x FROM f, s",
        "model_predict": f"SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-{_MARGIN})), 6) AS score, CAST(1 / (1 + exp(-{_MARGIN})) > 0.45 AS INTEGER)::DOUBLE AS prediction FROM ({_FEATURES})",
        "model_auc": _AUC_SQL,
        "model_margins_by_row": f"SELECT round(q * 50000 + x * 100)::BIGINT AS row, round({_MARGIN}, 6) AS margin FROM (SELECT DISTINCT q, x FROM ({_FEATURES}))",
        "model_gradient": "WITH r AS (SELECT 1 / (1 + exp(-{m})) - label AS r, * FROM ({f})) {u}".format(
            m=_MARGIN,
            f=_FEATURES,
            u=" UNION ALL ".join(f"SELECT {i}::INTEGER AS position, round(avg(r * {t}), 6) AS gradient, round(avg(r * {t}), 6) AS batched FROM r" for i, t in enumerate(["1", "q", "q*q", "q*q*q", "x", "q*x", "q*q*x", "x*x", "q*x*x", "x*x*x"], -1)),
        ),
        "graph_changed_edges": "WITH s AS (SELECT s_nationkey AS v, floor(s_acctbal / 100)::BIGINT AS m FROM supplier), c AS (SELECT c_nationkey AS v, floor(c_acctbal / 100)::BIGINT AS m FROM customer) (SELECT * FROM c EXCEPT SELECT * FROM s) UNION ALL (SELECT * FROM s EXCEPT SELECT * FROM c)",
        "model_folds": f"SELECT q, x, label, 1::BIGINT AS folds FROM ({_FEATURES}) GROUP BY ALL",
        "graph_connected_components": _COMPONENTS_SQL,
        "evidence_fingerprint": _FINGERPRINT_SQL,
        "model_fit_save_load": f"SELECT count(*) AS n, round(avg(label), 3) AS mean_score, 'converged' AS status FROM ({_FEATURES})",
        "phases_link": _LINKED_SQL,
        "phases_training_pairs": _TRAINING_SQL,
        "engine_modes": "SELECT * FROM (VALUES ('OFF', false, false), ('AUDIT', false, true), ('REWRITE', false, true), ('STRICT', true, false)) AS m(mode, refused, logged)",
        "source_formats": "SELECT f.format, n_nationkey, n_name FROM nation, (VALUES ('csv'), ('json'), ('parquet')) AS f(format)",
        "source_row_ids": "SELECT count(*) AS n, count(*) AS ids, true AS non_negative FROM orders",
        "flagship_document_clusters": _FLAGSHIP_SQL,
        "phases_train_match": "SELECT p_partkey AS truth, 1::BIGINT AS clusters, 2::BIGINT AS records FROM part",
    }
    return out
