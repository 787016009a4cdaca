"""Connected components by alternating large-star and small-star contraction.

Edges are undirected; edges with a null end and self edges are dropped. Each round is written to the shared
folder, so lineage stays short and a lost executor costs one task, not the loop. The loop ends when the edges form
a star forest, tested exactly; reaching ``max_iterations`` before that raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.sources.stash import Stash, stash

MAX_ITERATIONS = 128


class NotConverged(RuntimeError):
    """The iteration bound was reached before the graph was a star forest."""


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a vertex is hung on the smallest of the vertex and its neighbours."""
    both = edges.select(F.col("v").alias("u"), F.col("m").alias("w")).unionAll(edges.select(F.col("m").alias("u"), F.col("v").alias("w")))
    low = both.groupBy("u").agg(F.min("w").alias("lw"))
    joined = both.join(low, "u").where(F.col("w") > F.col("u"))
    return joined.select(F.col("w").alias("v"), F.least("u", "lw").alias("m")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex and its smaller neighbours are hung on the smallest of these."""
    low = edges.groupBy("v").agg(F.min("m").alias("lm"))
    hung = edges.join(low, "v").where(F.col("m") > F.col("lm")).select(F.col("m").alias("v"), F.col("lm").alias("m"))
    return hung.unionAll(low.select("v", F.col("lm").alias("m"))).distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """No vertex hangs on two others, none that hangs carries another."""
    ends = edges.select(F.col("v").alias("x"), F.lit(1).alias("hangs"), F.lit(0).alias("carries")).unionAll(edges.select(F.col("m").alias("x"), F.lit(0).alias("hangs"), F.lit(1).alias("carries")))
    seen = ends.groupBy("x").agg(F.sum("hangs").alias("hangs"), F.max("carries").alias("carries"))
    return seen.where((F.col("hangs") > 1) | ((F.col("hangs") > 0) & (F.col("carries") > 0))).isEmpty()


def star_forest(edges: DataFrame, a: str, b: str, max_iterations: int = MAX_ITERATIONS) -> Stash:
    """A stash of (v, m): each vertex with an edge, but for roots, and the smallest vertex of its component."""
    held = stash(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m")).distinct(),
        "edges",
    )
    for _ in range(max_iterations):
        if _is_star_forest(held.df):
            return held
        after = stash(_small_star(_large_star(held.df)), "edges")
        held.drop()
        held = after
    if _is_star_forest(held.df):
        return held
    raise NotConverged(f"the components did not converge within {max_iterations} iterations")


def changed_edges(before: DataFrame, after: DataFrame) -> DataFrame:
    """Edges of one round that the other lacks, as sets and either way: empty where a round changed nothing."""
    return after.subtract(before).unionAll(before.subtract(after))


def connected_components(vertices: DataFrame, edges: DataFrame, id_col: str, right_id: str, cluster: str, max_iterations: int = MAX_ITERATIONS) -> DataFrame:
    """Vertex rows as they are, plus ``cluster``: the smallest id reachable, the own id where no edge is.

    ``edges`` holds one end in ``id_col`` and the other in ``right_id``. Repeated vertex rows are kept, a null id gets
    a null cluster.
    """
    roots = star_forest(edges, id_col, right_id, max_iterations).df.select(F.col("v").alias("__v"), F.col("m").alias("__m"))
    joined = vertices.join(roots, vertices[id_col] == roots["__v"], "left")
    return joined.withColumn(cluster, F.coalesce("__m", id_col)).drop("__v", "__m")


def min_label_components(vertices: DataFrame, edges: DataFrame, id_col: str, a: str, b: str, label: str) -> DataFrame:
    """Rows (id, label): the smallest label of each vertex's component. One row a distinct id is expected."""
    roots = star_forest(edges, a, b).df.select(F.col("v").alias("__v"), F.col("m").alias("__m"))
    own = vertices.select(F.col(id_col).alias("__id"), F.col(label).alias("__l"))
    rooted = own.join(roots, own["__id"] == roots["__v"], "left").select("__id", "__l", F.coalesce("__m", "__id").alias("__root"))
    least = rooted.groupBy("__root").agg(F.min("__l").alias("label"))
    return rooted.join(least, "__root").select(F.col("__id").alias(id_col), "label")
