"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Tokens are summed by cell (the combination of all dimensions). The operator looks for the expected tokens of each cell, at most
the tokens it has, that are nearest to the tokens themselves (in relative entropy) and whose sums meet each category's aim; together
they are ``budget`` of all tokens. Bounded raking finds them: for one dimension after another the weights of a category's
cells are multiplied by the factor f with sum(least(tokens, f * weight)) = aim, until every margin, measured before it is met
again, is within ``tolerance`` of its aim. A cell's probability is its expected tokens over its tokens, so clipping is part of the
raking and cannot move a margin afterwards. A document is kept where a uniform number made from its key lies below.

A category's aim is its target share of the budget, or all its tokens where the share asks for more than there are; what is then
missing goes to the other categories in proportion to their shares. ``margins`` reports target, aim and expected tokens of each.

Cells are pre-aggregated with partial sums: what is raked has at most one row a combination, each round is one small job over a
written table, and its plan is the same every round. Nothing is collected but single numbers. The probabilities join the documents by
what their size allows; texts are not shuffled.
Defined cases: a null dimension value is a category of its own (``""`` stands for it); null and empty texts have no
tokens, take part in no sum, and get their cell's probability, or 1 where no cell has tokens; target categories
without rows are left out and the other shares scaled up; categories without a target keep their share of tokens; where the margins
stop coming nearer, as no weights can meet all aims at once, a warning names how far they are off, and where they still come
nearer after ``most_rounds`` rounds ``NotConverged`` is raised; an empty table gives an empty result; rows with equal keys,
null keys among them, get equal draws; a draw equal to the probability is not kept; a dimension named like a column of the
result is refused, other columns may have any name.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.operators.graph import NotConverged
from kinlink.sources.stash import stash

TOLERANCE = 1e-6
MOST_ROUNDS = 1000
STALL_ROUNDS = 20
TEMPERATURE = 0.5
BUDGET = 0.5
TOPICS = 8
#: Cells of one part of the raked table, and rounds of one job where there is one part.
PART_CELLS = 500_000
JOB_ROUNDS = 2


def token_count(text: str) -> Column:
    """Runs of non-blank characters."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^ \t\n\r\f]+")), F.lit(0)).cast("long")


def topic_of(text: str) -> Column:
    """A stated topic model for tables without a topic column: each word of seven or more ASCII letters in the whole text votes for
    one of eight buckets, by the first digit of its MD5; the bucket with most votes is the topic, ties go to the first.
    ``t`` stands for texts without such a word."""
    votes = F.array_join(F.transform(F.regexp_extract_all(F.col(text), F.lit("[A-Za-z]{7,}"), F.lit(0)), lambda w: F.substring(F.md5(F.lower(w)), 1, 1)), "")

    def winner(box: Column) -> Column:
        of = F.array(*(F.length(box) - F.length(F.translate(box, f"{2 * i:x}{2 * i + 1:x}", "")) for i in range(TOPICS)))
        return F.concat(F.lit("t"), (F.array_position(of, F.array_max(of)) - 1).cast("string"))

    named = F.element_at(F.transform(F.array(votes), winner), 1)
    return F.when(F.coalesce(F.col(text), F.lit("")).rlike("[A-Za-z]{7,}"), named).otherwise(F.lit("t"))


def draw(key: str, seed: int = 0) -> Column:
    """A number in [0, 1) from the key."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


#: The bounds of f in a group with sum(least(cap, f * weight)) = total: the sum is concave and bends where a cap is reached, so f is the
#: largest of (total - caps of the first k) / (weights of the rest) over k, in the order in which caps are reached.
_LEVEL = """
SELECT *, max(CASE WHEN rest_ > 0 THEN ({total} - full_) / rest_ END) OVER (PARTITION BY {by}) AS level_, sum(least({cap}, {weight})) OVER (PARTITION BY {by}) AS now_
FROM (SELECT *, coalesce(sum({cap}) OVER (PARTITION BY {by} ORDER BY ratio_, {ties} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
    sum({weight}) OVER (PARTITION BY {by} ORDER BY ratio_ DESC, {reverse} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rest_
  FROM (SELECT *, CASE WHEN {weight} > 0 THEN {cap} / {weight} ELSE double('inf') END AS ratio_ FROM {table}))"""


def _level(table: str, by: str, cap: str, weight: str, total: str, ties: list[str]) -> str:
    """SQL of ``table`` with ``level_``, the f of each group, null where all weights are 0, and ``now_``, the sum at f = 1."""
    return _LEVEL.format(table=table, by=by, cap=cap, weight=weight, total=total, ties=", ".join(ties), reverse=", ".join(f"{t} DESC" for t in ties))


def _aims(cells: DataFrame, names: list[str], targets: dict[str, DataFrame], temperature: float, budget: float) -> DataFrame:
    """Rows (dimension, value, tokens, share, aim) of the categories that have tokens."""
    parts = None
    for d in names:
        sums = cells.groupBy(d).agg(F.sum("tokens").alias("tokens")).select(F.lit(d).alias("dimension"), F.col(d).alias("value"), "tokens")
        if d in targets:
            given = targets[d].select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"), F.col("share").cast("double").alias("given")).groupBy("value").agg(F.sum("given").alias("given"))
            sums = sums.join(given, "value", "left").select("dimension", "value", "tokens", "given")
        else:
            sums = sums.withColumn("given", F.pow("tokens", F.lit(temperature)))
        parts = sums if parts is None else parts.unionAll(sums)
    all_of = Window.partitionBy("dimension")
    free = F.coalesce(F.sum(F.when(F.col("given").isNull(), F.col("tokens"))).over(all_of), F.lit(0.0)) / F.sum("tokens").over(all_of)
    share = F.when(F.col("given").isNull(), F.col("tokens") / F.sum("tokens").over(all_of)).otherwise(F.coalesce(F.try_divide("given", F.sum("given").over(all_of)), F.lit(0.0)) * (1 - free))
    shared = parts.withColumn("share", share).withColumn("wanted", F.sum("tokens").over(all_of) * budget)
    sql = _level("{shared}", "dimension", "tokens", "share", "wanted", ["value"])
    return cells.sparkSession.sql(f"SELECT dimension, value, tokens, share, least(tokens, coalesce(level_, 0.0) * share) AS aim FROM ({sql})", shared=shared)


def _rounds(state: DataFrame, names: list[str], parts: int, rounds: int) -> DataFrame:
    """Each dimension's aims met in turn, ``rounds`` times; ``off`` is the largest distance of a margin from its aim before it is met.

    A single part needs no exchange: all windows of the job run in its one task.
    """
    columns = ", ".join([*(f"`{d}`" for d in names), "tokens", *(f"`aim_{d}`" for d in names)])
    for _ in range(rounds):
        sql = "{state}"
        for d in names:
            table = f"({sql})" if d != names[0] else sql
            if parts > 1:
                table = f"(SELECT /*+ REPARTITION({parts}, `{d}`) */ * FROM {table})"
            level = _level(table, f"`{d}`", "tokens", "weight", f"`aim_{d}`", [f"`{x}`" for x in names if x != d] or ["tokens"])
            apart = f"CASE WHEN `aim_{d}` > 0 THEN abs(now_ / `aim_{d}` - 1) ELSE now_ END"
            off = apart if d == names[0] else f"greatest(off, {apart})"
            sql = f"SELECT {columns}, weight * coalesce(level_, 1.0) AS weight, {off} AS off FROM ({level})"
        state = state.sparkSession.sql(sql, state=state)
    return state.coalesce(parts)


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, temperature: float = TEMPERATURE, budget: float = BUDGET, tolerance: float = TOLERANCE, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """Cells (the dimensions and ``tokens``, one row a combination) with ``aim_`` of each dimension and ``expected`` tokens.

    ``targets``: rows (value, share) by dimension; a dimension without has shares proportional to its tokens to the power ``temperature``.
    """
    names = [c for c in cells.columns if c != "tokens"]
    held = stash(cells.where("tokens > 0").withColumn("tokens", F.col("tokens").cast("double")), "cells")
    parts = max(1, -(-held.df.count() // PART_CELLS))
    aims = stash(_aims(held.df, names, targets or {}, temperature, budget), "aims")
    state = held.df
    for d in names:
        own = aims.df.where(F.col("dimension") == d).select(F.col("value").alias(d), F.col("aim").alias(f"aim_{d}"))
        state = state.join(own, d)
    now = stash(state.withColumn("weight", F.col("tokens")).withColumn("off", F.lit(0.0)).coalesce(parts), "raked")
    held.drop()
    aims.drop()
    offs: list[float] = []
    rounds, at_once = 0, JOB_ROUNDS if parts == 1 else 1
    while rounds < most_rounds:
        some = min(at_once, most_rounds - rounds)
        after, rounds = stash(_rounds(now.df.coalesce(parts), names, parts, some), "raked"), rounds + some
        now.drop()
        now = after
        offs.append(now.df.agg(F.max("off")).first()[0] or 0.0)
        if offs[-1] <= tolerance:
            break
        before = -1 - -(-STALL_ROUNDS // at_once)
        if len(offs) >= -before and offs[-1] >= offs[before] * (1 - 1e-4):
            warnings.warn(f"no weights meet all aims: after {rounds} rounds a margin is off by {offs[-1]:.2g} of its aim", stacklevel=2)
            break
    else:
        raise NotConverged(f"after {rounds} rounds a margin is off by {offs[-1] if offs else 1:.2g} of its aim")
    return now.df.select(*names, "tokens", *(f"aim_{d}" for d in names), F.least("tokens", "weight").alias("expected"))


def margins(raked: DataFrame) -> DataFrame:
    """Rows (dimension, value, tokens, aim, expected, off) of what ``rake`` returns."""
    out = None
    for c in raked.columns:
        if f"aim_{c}" not in raked.columns:
            continue
        own = raked.groupBy(c).agg(F.sum("tokens").alias("tokens"), F.max(f"aim_{c}").alias("aim"), F.sum("expected").alias("expected"))
        own = own.select(F.lit(c).alias("dimension"), F.col(c).alias("value"), "tokens", "aim", "expected", F.abs(F.try_divide("expected", "aim") - 1).alias("off"))
        out = own if out is None else out.unionAll(own)
    return out


def _named(dimensions: dict[str, Column], taken: set[str]) -> dict[str, Column]:
    if clash := taken & set(dimensions):
        raise ValueError(f"dimensions cannot be named {', '.join(sorted(clash))}")
    return {d: F.coalesce(c.cast("string"), F.lit("")) for d, c in dimensions.items()}


def _chances(slim: DataFrame, names: list[str], **settings) -> DataFrame:
    """Rows (the dimensions, ``__p``), one a cell with tokens."""
    raked = rake(slim.groupBy(*names).agg(F.sum("tokens").alias("tokens")), **settings)
    return raked.select(*names, (F.col("expected") / F.col("tokens")).alias("__p"))


def mix(df: DataFrame, dimensions: dict[str, Column], targets: dict[str, DataFrame] | None = None, text: str = "text", key: str = "doc_id", seed: int = 0, **settings) -> DataFrame:
    """Rows (key, the dimensions, tokens, probability, kept). ``dimensions`` maps names to columns of ``df``; ``settings`` go to ``rake``."""
    named = _named(dimensions, {key, "tokens", "probability", "kept"})
    slim = stash(df.select(F.col(key), *(c.alias(d) for d, c in named.items()), token_count(text).alias("tokens")), "slim").df
    out = slim.join(_chances(slim.drop(key), list(named), targets=targets, **settings), list(named), "left")
    out = out.withColumn("probability", F.coalesce("__p", F.lit(1.0)))
    return out.select(key, *named, "tokens", "probability", (draw(key, seed) < F.col("probability")).alias("kept"))


def dimensions() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of("text")}


def sample(df: DataFrame, dimensions: dict[str, Column], text: str = "text", key: str = "doc_id", seed: int = 0, **settings) -> DataFrame:
    """The rows of ``df``, all columns, that the mixture keeps. Draws depend on the key alone, so equal keys of a cell go together."""
    named = {f"__{d}": c for d, c in _named(dimensions, set()).items()}
    if targets := settings.get("targets"):
        settings = settings | {"targets": {f"__{d}": t for d, t in targets.items()}}
    chances = _chances(df.select(*(c.alias(d) for d, c in named.items()), token_count(text).alias("tokens")), list(named), **settings)
    drawn = df.withColumns(named).join(chances, list(named), "left").where(draw(key, seed) < F.coalesce("__p", F.lit(1.0)))
    return drawn.select(*df.columns)


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """Query op4: documents raked to tempered source, language and topic margins; half of the tokens are drawn."""
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), dimensions(), tolerance=1e-9)
    return out.withColumn("probability", F.round("probability", 4))


#: Steps of the SQL, one dimension each; a round of three is at rest long before on the given tables, which the tests check.
SQL_STEPS = 900

_TOPIC_SQL = "array_to_string(list_transform(regexp_extract_all(text, '[A-Za-z]{7,}'), lambda w: substr(md5(lower(w)), 1, 1)), '')"
_COUNTS_SQL = "[" + ", ".join(f"length(votes) - length(translate(votes, '{2 * i:x}{2 * i + 1:x}', ''))" for i in range(TOPICS)) + "]"
_BOUND = "max(CASE WHEN {rest} > 0 THEN ({total} - {full}) / {rest} END) OVER (PARTITION BY {by})"
_FULL = "coalesce(sum({cap}) OVER (PARTITION BY {by} ORDER BY {ratio}, {ties} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
_REST = "sum({weight}) OVER (PARTITION BY {by} ORDER BY {ratio}, {ties} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def mixing_sql(docs: str = "documents") -> str:
    """The bounded raking as a recursion whose step meets the aims of one dimension."""
    own = lambda what: "CASE n % 3 WHEN 0 THEN {} WHEN 1 THEN {} ELSE {} END".format(*(what.format(d=d) for d in ("source", "lang", "topic")))
    shares = " UNION ALL ".join(f"SELECT '{d}' AS dimension, {d} AS value, sum(tokens) AS tokens, sqrt(sum(tokens)) AS share FROM cells GROUP BY {d}" for d in ("source", "lang", "topic"))
    category = {"by": "dimension", "ratio": "tokens / share", "ties": "value"}
    cell = {"by": "by_", "ratio": "tokens / weight", "ties": "source, lang, topic"}
    joins = " ".join(f"JOIN aims a_{d} ON a_{d}.dimension = '{d}' AND a_{d}.value = c.{d}" for d in ("source", "lang", "topic"))
    return rf"""
slim AS MATERIALIZED (
  SELECT doc_id, source, lang, tokens, CASE WHEN votes = '' THEN 't' ELSE 't' || CAST(list_position({_COUNTS_SQL}, list_max({_COUNTS_SQL})) - 1 AS VARCHAR) END AS topic
  FROM (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce({_TOPIC_SQL}, '') AS votes,
    CAST(coalesce(len(regexp_extract_all(text, '[^ \t\n\r\f]+')), 0) AS BIGINT) AS tokens FROM {docs})),
cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM slim GROUP BY ALL HAVING sum(tokens) > 0),
shares AS MATERIALIZED (SELECT *, (SELECT sum(tokens) * 0.5 FROM cells) AS wanted FROM ({shares})),
bounds AS MATERIALIZED (SELECT *, {_FULL.format(cap='tokens', **category)} AS full_, {_REST.format(weight='share', **category)} AS rest FROM shares),
aims AS MATERIALIZED (SELECT dimension, value, least(tokens, share * {_BOUND.format(rest='rest', full='full_', total='wanted', by='dimension')}) AS aim FROM bounds),
raking AS (
  SELECT 0 AS n, c.*, a_source.aim AS aim_source, a_lang.aim AS aim_lang, a_topic.aim AS aim_topic, c.tokens AS weight FROM cells c {joins}
  UNION ALL
  SELECT n + 1, source, lang, topic, tokens, aim_source, aim_lang, aim_topic, weight * {_BOUND.format(rest='rest', full='full_', total='aim', by='by_')}
  FROM (SELECT *, {_FULL.format(cap='tokens', **cell)} AS full_, {_REST.format(weight='weight', **cell)} AS rest
    FROM (SELECT *, {own('{d}')} AS by_, {own('aim_{d}')} AS aim FROM raking WHERE n < {SQL_STEPS}))),
chances AS MATERIALIZED (SELECT source, lang, topic, least(tokens, weight) / tokens AS probability FROM raking WHERE n = {SQL_STEPS}),
mixed AS MATERIALIZED (
  SELECT s.doc_id, s.source, s.lang, s.topic, s.tokens, coalesce(p.probability, 1.0) AS probability,
    CAST(CAST('0x' || substr(md5('0:' || CAST(s.doc_id AS VARCHAR)), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0 < coalesce(p.probability, 1.0) AS kept
  FROM slim s LEFT JOIN chances p USING (source, lang, topic))
"""


OP4_SQL = f"WITH RECURSIVE {mixing_sql()} SELECT doc_id, source, lang, topic, tokens, round(probability, 4) AS probability, kept FROM mixed"
