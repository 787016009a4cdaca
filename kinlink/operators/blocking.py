"""Blocking trees: learned from known matches, kept as JSON, compiled to one hash column, joined on it."""

from __future__ import annotations

import dataclasses
import json
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.operators.registry import DEFAULT, Policy, rule

MOST_NODES = 1024
MOST_DEPTH = 96
#: Rows of a block that one task gets.
PART_ROWS = 20_000


@dataclass
class Node:
    """``function`` over ``field``; ``value`` is the parent's hash that leads here. The root may have no function."""

    function: str | None = None
    field: str | None = None
    value: object = None
    children: list[Node] = dataclasses.field(default_factory=list)

    def to_dict(self) -> dict:
        return {"function": self.function, "field": self.field, "value": self.value, "children": [c.to_dict() for c in self.children]}

    @staticmethod
    def from_dict(d: dict) -> Node:
        return Node(d.get("function"), d.get("field"), d.get("value"), [Node.from_dict(c) for c in d.get("children", [])])


def to_json(tree: Node) -> str:
    return json.dumps(tree.to_dict(), ensure_ascii=False)


def from_json(text: str) -> Node:
    return Node.from_dict(json.loads(text))


def java_string_hash(text: Column) -> Column:
    """``h = 31 h + unit`` over UTF-16 units, cut to 32 bits at each step so that nothing overflows."""
    code = F.hex(F.encode(text, "UTF-16BE"))
    units = F.transform(F.regexp_extract_all(code, F.lit("(....)"), F.lit(1)), lambda u: F.conv(u, 16, 10).cast("long"))
    wrapped = F.aggregate(units, F.lit(0).cast("long"), lambda h, u: (h * 31 + u).bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))
    return F.shiftright(F.shiftleft(wrapped, 32), 32).cast("int")


def _check(tree: Node) -> None:
    seen, stack = 0, [(tree, 1)]
    while stack:
        node, depth = stack.pop()
        seen += 1
        if seen > MOST_NODES or depth > MOST_DEPTH:
            raise ValueError(f"a blocking tree has at most {MOST_NODES} nodes and {MOST_DEPTH} levels")
        stack += [(c, depth + 1) for c in node.children]


def tree_text(tree: Node, policy: Policy = DEFAULT) -> Column:
    """The path of a row through the tree: ``|`` and the hash, node by node."""
    if tree.function is None:
        return F.concat(F.lit(""), *(tree_text(c, policy) for c in tree.children))
    hashed = rule(tree.function, "blocking", policy)(F.col(tree.field))
    out = F.concat(F.lit("|"), F.coalesce(hashed.cast("string"), F.lit("null")))
    for child in tree.children:
        if child.value is not None:
            out = F.concat(out, F.when(hashed == F.lit(child.value), tree_text(child, policy)).otherwise(F.lit("")))
    return out


def block_hashes(df: DataFrame, tree: Node, out: str, policy: Policy = DEFAULT) -> DataFrame:
    policy.check("blocking.tree")
    _check(tree)
    return df.withColumn(out, java_string_hash(tree_text(tree, policy)))


def candidate_pairs(left: DataFrame, right: DataFrame | None, block: str, row_id: str, prefix: str = "z_", source: str | None = None, part_rows: int = PART_ROWS, keep: Column | None = None) -> DataFrame:
    """Pairs of one block, right-hand columns prefixed. Within one table each unordered pair comes once; between two all cross pairs.

    With ``source``, only pairs of different sources; with ``keep``, a cheap condition on both sides' columns, only pairs that meet it.
    Rows are dealt to as many tasks as shuffles have partitions, since pairs cost more than their rows' bytes tell. A block of more than ``part_rows`` rows is dealt to parts: each pair of parts is a
    join key of its own, to which the rows of both parts go, so that no task gets a whole hot block.
    """
    same = right is None
    right = left if same else right
    counted = [x.groupBy(F.col(block).alias("__b")).agg(F.count("*").alias("__n")) for x in ([left] if same else [left, right])]
    sizes = counted[0] if same else counted[0].unionAll(counted[1]).groupBy("__b").agg(F.max("__n").alias("__n"))
    hot = sizes.where(F.col("__n") > part_rows).select("__b", F.ceil(F.col("__n") / part_rows).cast("int").alias("__parts"))

    def dealt(df: DataFrame, side: int) -> DataFrame:
        held = df.join(hot, df[block].eqNullSafe(hot["__b"]), "left").drop("__b").withColumn("__parts", F.coalesce("__parts", F.lit(1)))
        held = held.withColumn("__own", F.when(F.col("__parts") > 1, F.pmod(F.xxhash64(row_id), F.col("__parts"))).otherwise(0).cast("int"))
        every = F.sequence(F.lit(0), F.col("__parts") - 1)
        if same:
            cell = F.transform(every, lambda p: F.struct(F.least(p, F.col("__own")).alias("t"), F.greatest(p, F.col("__own")).alias("q")))
        else:
            cell = F.transform(every, lambda p: F.struct(F.col("__own").alias("t"), p.alias("q")) if not side else F.struct(p.alias("t"), F.col("__own").alias("q")))
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return held.withColumn("__cell", F.explode(cell)).drop("__parts").repartition(tasks, block, "__cell")

    here = dealt(left, 0)
    there = dealt(right, 1).select(*(F.col(c).alias(prefix + c) for c in [*right.columns, "__own", "__cell"]))
    on = (F.col(block) == F.col(prefix + block)) & (F.col("__cell") == F.col(prefix + "__cell"))
    if same:
        # rows of one part meet in the cell of that part alone
        on &= (F.col(row_id) < F.col(prefix + row_id)) & ((F.col("__own") != F.col(prefix + "__own")) | (F.col("__cell.t") == F.col("__cell.q")))
    if source:
        on &= F.col(source) != F.col(prefix + source)
    if keep is not None:
        on &= keep
    return here.join(there, on).drop("__own", "__cell", prefix + "__own", prefix + "__cell")


def learn_tree(pairs: list[dict], fields: dict[str, list[str]], sample: DataFrame, most_block: int = 100, most_loss: float = 0.05, depth: int = 3) -> Node:
    """A greedy tree: at each node the (field, hash) with the smallest largest block among those that lose few known matches.

    ``pairs``: known matches as dicts with ``l`` and ``r`` records (a small, labelled set); ``sample``: a bounded sample of records. The
    candidate hashes are computed by Spark once; the choice itself runs over these hashed rows.
    """
    choices = [(f, h) for f, hashes in fields.items() for h in hashes]
    columns = [rule(h, "blocking")(F.col(f)).cast("string").alias(f"c{i}") for i, (f, h) in enumerate(choices)]
    rows = [tuple(r) for r in sample.select(*columns).collect()]
    spark = sample.sparkSession
    names = sorted(fields)
    hashed = []
    for side in ("l", "r"):
        frame = spark.createDataFrame([(i, *(p[side].get(n) for n in names)) for i, p in enumerate(pairs)], "i int, " + ", ".join(f"`{n}` {sample.schema[n].dataType.simpleString()}" for n in names))
        hashed.append({r[0]: tuple(r[1:]) for r in frame.select("i", *columns).collect()})
    known = [(hashed[0][i], hashed[1][i]) for i in range(len(pairs))]
    budget = [MOST_NODES - 1]

    def grow(rows: list[tuple], known: list[tuple], used: frozenset, left: int, value) -> Node | None:
        if left == 0 or len(rows) <= most_block or budget[0] <= 0:
            return None
        best = None
        for i in range(len(choices)):
            if i in used:
                continue
            lost = sum(a[i] != b[i] for a, b in known)
            if known and lost > most_loss * len(known):
                continue
            sizes = Counter(r[i] for r in rows)
            rank = (max(sizes.values()), lost, i)
            if len(sizes) > 1 and (best is None or rank < best[0]):
                best = (rank, i, sizes)
        if best is None:
            return None
        _, i, sizes = best
        budget[0] -= 1
        node = Node(choices[i][1], choices[i][0], value)
        for v, n in sizes.most_common():
            if v is None or n <= most_block:
                continue
            child = grow([r for r in rows if r[i] == v], [p for p in known if p[0][i] == p[1][i] == v], used | {i}, left - 1, v)
            if child:
                node.children.append(child)
        return node

    found = grow(rows, known, frozenset(), depth, None)
    if found is None:
        field_, hash_ = choices[0]
        found = Node(hash_, field_)
    return found
