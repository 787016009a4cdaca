"""URL filter: a tree of path templates for each host, judged by smoothed labelled purity; explicit rules go first.

The tree is grown level by level with grouped counts. Below a prefix of templates, a segment keeps its own branch when it
holds at least ``least_share`` of the rows there and ``least_count`` rows; all others are generalised to the wildcard
of their shape (``{num}``, ``{num}.ext``, ``{hex}``, ``{word}``, ``{any}``). A branch whose share of good labels does not differ from that of
its siblings by more than a Hoeffding bound is merged into the wildcard too. A template's purity is its share of good labels,
smoothed towards its host's, and that towards all rows'. A template is rejected where its purity, raised by the one-sided
Hoeffding bound of its labels, is below ``threshold`` times the share of all rows: it is surely worse than the table as a whole.

Counts are grouped with partial sums, so a hot host or path is never gathered; nothing is collected but the tree's depth. Verdicts
are made for distinct paths and joined back to the rows by a salted key.
Defined cases: a null url, or one without ``://``, has empty host and path; unlabelled templates are allowed, so a table without
labels allows all; rows that repeat, urls or keys, count as often as they occur and are judged alike; branches with equal counts are
treated alike, as nothing is ranked; leading and trailing slashes make no segment, and the empty path has the empty template; an
empty table gives an empty result; paths are used whole, segments from ``depth`` on as one; other columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.sources.stash import stash

DEPTH = 12
LEAST_SHARE = 0.02
LEAST_COUNT = 5
CONFIDENCE = 0.05
STRENGTH = 4.0
THRESHOLD = 0.9
SALTS = 16
MOST_RULES = 1000
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_columns(host: str, path: str, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = text.find("/")
        own_host, own_path = (text, "") if at < 0 else (text[:at], text[at:])
        fits = ((F.col(host) == own_host) | F.col(host).endswith("." + own_host)) & F.col(path).startswith(own_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def shape(segment: Column) -> Column:
    """The wildcard of a segment's form."""
    return (
        F.when(segment.rlike(r"^[0-9]+$"), F.lit("{num}"))
        .when(segment.rlike(r"^[0-9]+\.[A-Za-z0-9]{1,5}$"), F.concat(F.lit("{num}."), F.lower(F.regexp_extract(segment, r"\.([A-Za-z0-9]{1,5})$", 1))))
        .when(segment.rlike(r"^[0-9a-fA-F-]{8,}$"), F.lit("{hex}"))
        .when(segment.rlike(r"^[\p{L}_-]+$"), F.lit("{word}"))
        .otherwise(F.lit("{any}"))
    )


def _segments(path: str, depth: int) -> Column:
    bare = F.regexp_replace(F.col(path), "^/+|/+$", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "/", depth))


def templates(df: DataFrame, label: str = "label", depth: int = DEPTH, least_share: float = LEAST_SHARE, least_count: int = LEAST_COUNT, confidence: float = CONFIDENCE) -> DataFrame:
    """Rows (host, path, template) for each distinct host and path. ``df``: host, path, ``label`` (1 good, 0 bad, null)."""
    paths = df.groupBy("host", "path").agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col(label) == 1).cast("long")), F.lit(0)).alias("good"), F.coalesce(F.sum((F.col(label) == 0).cast("long")), F.lit(0)).alias("bad"))
    now = stash(paths.withColumn("segments", _segments("path", depth)).withColumn("prefix", F.lit("")), "paths")
    deepest = now.df.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(deepest):
        here = now.df
        segment = F.get("segments", F.lit(level))
        live = here.withColumn("segment", segment).withColumn("kind", shape(F.col("segment")))
        branch = live.where(F.col("segment").isNotNull()).groupBy("host", "prefix", "segment").agg(F.sum("n").alias("bn"), F.sum("good").alias("bg"), F.sum("bad").alias("bb"))
        whole = branch.groupBy("host", "prefix").agg(F.sum("bn").alias("tn"), F.sum("bg").alias("tg"), F.sum("bb").alias("tb"), F.count("*").alias("branches"))
        both = branch.join(whole, ["host", "prefix"])
        own, rest = F.col("bg") + F.col("bb"), F.col("tg") + F.col("tb") - F.col("bg") - F.col("bb")
        apart = F.abs(F.col("bg") / own - (F.col("tg") - F.col("bg")) / rest)
        bound = F.sqrt(F.lit(0.5) * F.log(F.lit(2.0 / confidence))) * (1 / F.sqrt(own) + 1 / F.sqrt(rest))
        alike = F.when((own > 0) & (rest > 0), apart <= bound).otherwise(F.lit(True))
        frequent = (F.col("bn") >= least_share * F.col("tn")) & (F.col("bn") >= least_count)
        kept = both.where(frequent & ((F.col("branches") == 1) | ~alike)).select("host", "prefix", "segment", F.lit(True).alias("literal"))
        named = live.join(kept, ["host", "prefix", "segment"], "left")
        part = F.when(F.col("literal"), F.col("segment")).otherwise(F.col("kind"))
        grown = F.when(F.col("segment").isNull(), F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), part))
        after = stash(named.withColumn("prefix", grown).drop("segment", "kind", "literal"), "paths")
        now.drop()
        now = after
    return now.df.select("host", "path", F.col("prefix").alias("template"), "good", "bad")


def purities(found: DataFrame, strength: float = STRENGTH, confidence: float = CONFIDENCE) -> DataFrame:
    """Rows (host, template, purity, highest, prior) of the result of templates(); ``highest`` is null without labels."""
    by = found.groupBy("host", "template").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    hosts = by.groupBy("host").agg(F.sum("g").alias("hg"), F.sum("b").alias("hb"))
    every = hosts.agg(((F.coalesce(F.sum("hg"), F.lit(0)) + 1) / (F.coalesce(F.sum("hg") + F.sum("hb"), F.lit(0)) + 1)).alias("prior"))
    host = hosts.crossJoin(F.broadcast(every)).select("host", "prior", ((F.col("hg") + strength * F.col("prior")) / (F.col("hg") + F.col("hb") + strength)).alias("host_purity"))
    purity = (F.col("g") + strength * F.col("host_purity")) / (F.col("g") + F.col("b") + strength)
    bound = F.sqrt(F.lit(0.5 * math.log(1 / confidence)) / (F.col("g") + F.col("b")))
    return by.join(host, "host").select("host", "template", "prior", purity.alias("purity"), F.when(F.col("g") + F.col("b") > 0, purity + bound).alias("highest"))


def judge(df: DataFrame, labels: DataFrame | None = None, rules: list[tuple[str, str]] = RULES, url: str = "url", key: str = "page_id", threshold: float = THRESHOLD) -> DataFrame:
    """Rows (key, host, path, rule, verdict, template, purity). ``labels``: rows (key, label) that teach the purities."""
    slim = df.select(F.col(key), host_of(url).alias("host"), path_of(url).alias("path"))
    if labels is None:
        taught = slim.withColumn("label", F.lit(None).cast("int"))
    else:
        taught = slim.join(labels.select(F.col(key), F.col("label").cast("int").alias("label")).dropDuplicates([key]), key, "left")
    taught = stash(taught, "urls")
    found = stash(templates(taught.df), "templates")
    judged = found.df.join(purities(found.df), ["host", "template"]).select("host", "path", "template", "purity", (F.col("highest") < threshold * F.col("prior")).alias("bad"))
    # a path that holds a third of the rows is dealt to several tasks
    judged = judged.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = taught.df.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    rule, verdict = rule_columns("host", "path", rules)
    method = F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))
    return salted.join(judged, ["host", "path", "salt"]).select(key, "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "template", F.round("purity", 6).alias("purity"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    """Query op5: every page's url. No table labels urls, so it is assumed that the number in a page's path is the ``doc_id`` of its
    document, whose quality label the page teaches with."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    number = F.expr("try_cast(regexp_extract(url, '/([0-9]{1,18})', 1) AS BIGINT)")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    taught = pages.select("page_id", number.alias("doc_id")).join(labels, "doc_id").select("page_id", "label")
    return judge(pages, taught)
