"""Near-duplicate vectors with a robust-pruned flat graph.

1. Equal vectors are folded to one with its number of copies; vectors that link with nothing are set aside.
2. Centroids are fitted on at most ``sample`` vectors (and ``SAMPLE_BYTES`` bytes); each vector goes to the shards of its ``overlap`` nearest.
   A shard of more than ``REFINE`` times ``shard`` vectors gets centroids of its own, fitted on a sample of it, and its vectors go
   to the nearest of these, so the number of shards follows the number of vectors. A shard of more than ``leaf`` vectors that
   centroids cannot split (near copies) is dealt to parts, and each pair of parts becomes a task.
3. In each shard nearest candidates are robustly pruned to a sparse graph with detours of factor ``alpha``.
4. The adjacency lists of a vector from all its shards are united and go back to its shards.
5. Every vector is searched in its shards: greedily with a beam from the medoid, then the range is expanded from each match
   to its neighbours until no new match is met. What the search has not visited is compared in blocks, since no edge need
   lead into a large group of near copies; so nothing is missed within a shard. Matches are verified in double precision.
6. All shards that two vectors share find their link, and it counts in the first of them; a shard reports link counts and a spanning
   forest, at most one row a vector, never its pairs.
7. ``audit_recall`` compares with brute force for a sample of queries against all vectors, in blocks; the query states it.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing and keep their row;
vectors of different lengths never link; the rows of a repeated id are vectors of their own, each with its row; an empty table gives an
empty result, with recall 1; extra columns are ignored; a null id is the smallest of its component and keeps its row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.arrow import map_rows
from kinlink.llm.groups import Labels, whole_groups
from kinlink.operators.graph import min_label_components
from kinlink.sources.stash import stash

THRESHOLD = 0.95
SAMPLE = 20_000
SAMPLE_BYTES = 64 << 20
SHARD = 1000
CENTROIDS = 1024
LENGTHS = 64
REFINE = 4
LEVELS = 4
OVERLAP = 3
LEAF = 2000
DEGREE = 24
CANDIDATES = 64
ALPHA = 1.2
BEAM = 32
AUDIT = 200


def clean(vector) -> bytes | None:
    """Little-endian doubles of a usable vector, else None."""
    if vector is None or len(vector) == 0 or any(x is None for x in vector):
        return None
    out = np.asarray(vector, "<f8")
    return out.tobytes() if np.isfinite(out).all() and out.any() else None


def unit(rows: list[bytes]) -> np.ndarray:
    """Rows of unit length; scaled first, so that no norm overflows."""
    x = np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(sample: np.ndarray, n: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means with spread-out starts."""
    n = min(n, len(sample))
    centers = sample[np.linspace(0, len(sample) - 1, n).astype(int)].copy()
    for _ in range(rounds):
        near = (sample @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, sample)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centers = np.where(norm > 0, sums / np.maximum(norm, 1e-300), centers)
    return centers


def robust_graph(x: np.ndarray, degree: int = DEGREE, candidates: int = CANDIDATES, alpha: float = ALPHA) -> np.ndarray:
    """Neighbour lists (n, degree), filled up with -1: of the nearest candidates, those that no closer choice makes a detour to."""
    n = len(x)
    k = min(candidates, n - 1)
    if k <= 0:
        return np.full((n, degree), -1)
    near = x @ x.T
    np.fill_diagonal(near, -2)
    pool = np.argpartition(-near, k - 1, axis=1)[:, :k]
    rows = np.arange(n)[:, None]
    pool = np.take_along_axis(pool, np.argsort(-near[rows, pool], axis=1, kind="stable"), axis=1)
    far = np.sqrt(np.maximum(2 - 2 * near[rows, pool], 0))
    alive, out = np.ones(pool.shape, bool), np.full((n, degree), -1)
    for step in range(degree):
        live = alive.any(axis=1)
        if not live.any():
            break
        pick = alive.argmax(axis=1)
        chosen = np.where(live, pool[np.arange(n), pick], -1)
        out[:, step] = chosen
        between = np.sqrt(np.maximum(2 - 2 * near[chosen[:, None], pool], 0))
        alive &= alpha * between > far
        alive[np.arange(n), pick] = False
    return out


def neighbour_lists(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Undirected edges as (start of each row, neighbours)."""
    code = np.unique(np.concatenate([a * n + b, b * n + a]))
    a, b = code // n, code % n
    keep = a != b
    a, b = a[keep], b[keep]
    return np.searchsorted(a, np.arange(n + 1)), b


def range_search(x: np.ndarray, start: np.ndarray, nbrs: np.ndarray, queries: np.ndarray, threshold: float, beam: int = BEAM):
    """Pairs (query, node) at or above the threshold: beam search from the medoid, expansion of the range, then all nodes not visited."""
    n, q = len(x), len(queries)
    mean = x.mean(axis=0)
    medoid = int((x @ mean).argmax())
    beam = min(beam, n)
    seen = np.zeros((q, n), bool)
    seen[:, medoid] = True
    held = np.full((q, beam), -1)
    score = np.full((q, beam), -np.inf)
    done = np.ones((q, beam), bool)
    held[:, 0], score[:, 0], done[:, 0] = medoid, queries @ x[medoid], False
    hit_q, hit_n = [], []

    def visit(asked: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unseen neighbours of the nodes, once for each query, with their cosines."""
        width = start[node + 1] - start[node]
        at = np.repeat(start[node] - np.r_[0, np.cumsum(width)[:-1]], width) + np.arange(width.sum())
        code = np.unique(np.repeat(asked, width) * n + nbrs[at])
        asked, node = code // n, code % n
        new = ~seen[asked, node]
        asked, node = asked[new], node[new]
        seen[asked, node] = True
        near = np.empty(len(asked))
        for low in range(0, len(asked), 1 << 16):
            part = slice(low, low + (1 << 16))
            near[part] = np.einsum("ij,ij->i", queries[asked[part]], x[node[part]])
        return asked, node, near

    first = score[:, 0] >= threshold
    hit_q.append(np.flatnonzero(first))
    hit_n.append(np.full(first.sum(), medoid))
    while True:
        open_score = np.where(done, -np.inf, score)
        pick = open_score.argmax(axis=1)
        asked = np.flatnonzero(open_score[np.arange(q), pick] > -np.inf)
        if not len(asked):
            break
        done[asked, pick[asked]] = True
        asked, node, near = visit(asked, held[asked, pick[asked]])
        if not len(asked):
            continue
        match = near >= threshold
        hit_q.append(asked[match])
        hit_n.append(node[match])
        count = np.bincount(asked, minlength=q)
        rows, slot = np.flatnonzero(count), np.arange(len(asked)) - np.repeat((np.cumsum(count) - count)[count > 0], count[count > 0])
        width = int(count.max())
        back = np.full(q, -1)
        back[rows] = np.arange(len(rows))
        ids, vals = np.full((len(rows), width), -1), np.full((len(rows), width), -np.inf)
        ids[back[asked], slot], vals[back[asked], slot] = node, near
        ids, vals = np.concatenate([held[rows], ids], axis=1), np.concatenate([score[rows], vals], axis=1)
        flags = np.concatenate([done[rows], np.zeros((len(rows), width), bool)], axis=1)
        top = np.argpartition(-vals, beam - 1, axis=1)[:, :beam]
        held[rows], score[rows] = np.take_along_axis(ids, top, axis=1), np.take_along_axis(vals, top, axis=1)
        done[rows] = np.take_along_axis(flags, top, axis=1) | (held[rows] < 0)
    asked, node = np.concatenate(hit_q), np.concatenate(hit_n)
    yield asked, node
    while len(asked):
        more = []
        for low in range(0, len(asked), 1 << 16):
            a, b, near = visit(asked[low : low + (1 << 16)], node[low : low + (1 << 16)])
            more.append((a[near >= threshold], b[near >= threshold]))
        asked, node = (np.concatenate(c) for c in zip(*more))
        yield asked, node
    for low in range(0, q, 256):
        asked, node = np.nonzero((queries[low : low + 256] @ x.T >= threshold) & ~seen[low : low + 256])
        yield asked + low, node


def _group_slices(table: pa.Table):
    group = table.column("grp").to_numpy()
    edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]).tolist()
    for low, high in zip(edge, [*edge[1:], len(group)]):
        yield table.slice(low, high - low)


def _build(leaf: int):
    """Adjacency rows (uid, near): lists of each group's graph."""

    def run(batches):
        for table in whole_groups(batches, leaf):
            for part in _group_slices(table):
                uid = part.column("uid").to_numpy()
                if len(uid) < 2:
                    continue
                graph = robust_graph(unit(part.column("vec").to_pylist()))
                rows = [uid[g[g >= 0]] for g in graph]
                yield from pa.table({"uid": pa.array(uid), "near": pa.array(rows, pa.list_(pa.int64()))}).to_batches()

    return run


def _search(threshold: float, leaf: int):
    """Rows (a, b, links): b's links counted here, by copies, and the smallest uid that b is linked with here."""

    def run(batches):
        for table in whole_groups(batches, 2 * leaf):
            for part in _group_slices(table):
                yield from _search_group(part, threshold).to_batches()

    return run


def _search_group(part: pa.Table, threshold: float) -> pa.Table:
    uid, copies, me = part.column("uid").to_numpy(), part.column("copies").to_numpy(), part.column("shard")[0].as_py()
    order = np.argsort(uid)
    uid, copies, part = uid[order], copies[order], part.take(pa.array(order))
    n = len(uid)
    empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
    if n < 2:
        return empty
    x = unit(part.column("vec").to_pylist())
    near = part.column("near").combine_chunks()
    near = near.chunk(0) if isinstance(near, pa.ChunkedArray) else near
    ends = np.asarray(near.offsets)
    owner = np.repeat(np.arange(n), np.diff(ends))
    other = near.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    place = np.minimum(np.searchsorted(uid, other), n - 1)
    inside = uid[place] == other
    tree, ask = (np.flatnonzero(part.column(c).to_numpy(zero_copy_only=False)) for c in ("tree", "ask"))
    back = np.full(n, -1)
    back[tree] = np.arange(len(tree))
    a, b = back[owner[inside]], back[place[inside]]
    both = (a >= 0) & (b >= 0)
    start, nbrs = neighbour_lists(len(tree), a[both], b[both])
    codes = []
    for low in range(0, len(ask), 512):
        own = ask[low : low + 512]
        for asked, found in range_search(x[tree], start, nbrs, x[own], threshold):
            u, v = own[asked], tree[found]
            keep = u != v
            codes.append(np.unique(np.minimum(u, v)[keep] * n + np.maximum(u, v)[keep]))
    pairs = np.unique(np.concatenate(codes)) if codes else np.empty(0, np.int64)
    u, v = pairs // n, pairs % n
    lists = part.column("shards").to_pylist()
    shards = np.repeat(-1 - np.arange(n)[:, None], max(map(len, lists)), axis=1)  # fillers that no other vector has
    for i, own in enumerate(lists):
        shards[i, : len(own)] = own
    shared = (shards[u][:, :, None] == shards[v][:, None, :]).any(axis=2)
    counts_here = shards[u][np.arange(len(u)), shared.argmax(axis=1)] == me
    joined = Labels(n)
    joined.link(u, v)
    links = np.bincount(u[counts_here], weights=copies[v[counts_here]], minlength=n) + np.bincount(v[counts_here], weights=copies[u[counts_here]], minlength=n)
    told = np.flatnonzero((links > 0) | (joined.label != np.arange(n)))
    return pa.table({"a": pa.array(uid[joined.label[told]]), "b": pa.array(uid[told]), "links": pa.array(links[told].astype(np.int64))})


def _fold(batches):
    """Rows (id, digest, vec) of all rows; digest and vec are null where a vector links with nothing."""
    for b in batches:
        vecs = [clean(v) for v in b.column(1).to_pylist()]
        digests = [None if v is None else hashlib.md5(v).digest() for v in vecs]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.binary()), pa.array(vecs, pa.binary())], names=["id", "digest", "vec"])


def _nearest(vecs: list[bytes], centers: np.ndarray, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and cosines of each vector's nearest centroids, the nearest first."""
    near = unit(vecs) @ centers.T
    pick = np.argsort(-near, axis=1, kind="stable")[:, :overlap]
    return pick, np.take_along_axis(near, pick, axis=1)


def _coarse(folded: DataFrame, overlap: int, sample: int, shard: int) -> DataFrame:
    """Rows (uid, shard, score): the first level, from centroids that the driver fits on a bounded sample."""
    sizes = {r["dim"]: r["n"] for r in folded.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(LENGTHS).collect()}
    centers: dict[int, np.ndarray] = {}
    for dim, n in sizes.items():
        most = max(2, min(sample, SAMPLE_BYTES // dim) * n // sum(sizes.values()))
        rows = folded.where(F.col("dim") == dim).select("vec", F.xxhash64("digest").alias("h")).orderBy("h").limit(most).select("vec").collect()
        centers[dim] = fit_centroids(unit([bytes(r[0]) for r in rows]), max(1, min(CENTROIDS, round(n / shard))))
    shared = folded.sparkSession.sparkContext.broadcast(centers)  # at most CENTROIDS, and no more than the sample holds, of LENGTHS lengths

    def assign(batches):
        for b in batches:
            vecs, dims, uid = b.column(1).to_pylist(), b.column(2).to_numpy(), b.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                c = shared.value.get(dim)
                pick, score = (np.zeros((len(rows), 1), np.int64), np.ones((len(rows), 1))) if c is None else _nearest([vecs[i] for i in rows], c, overlap)
                width = pick.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(uid[rows], width)), pa.array((pick + (dim << 24)).ravel()), pa.array(score.ravel())], names=["uid", "shard", "score"])

    return map_rows(folded.select("uid", "vec", "dim"), assign, "uid long, shard long, score double")


def _refined(folded: DataFrame, member: DataFrame, large: DataFrame, overlap: int, shard: int, leaf: int) -> DataFrame:
    """Rows (uid, shard, score) in place of the memberships of large shards: centroids of each, fitted on a sample of it."""
    held = member.join(large, "shard").join(folded.select("uid", "vec"), "uid")
    some = held.where(F.pmod(F.xxhash64("uid", F.lit("sample")), F.ceil(F.col("n") / (4 * CENTROIDS))) == 0).select("shard", "n", "vec")

    def fit(table: pa.Table) -> pa.Table:
        vecs, n = table.column("vec").to_pylist(), table.column("n")[0].as_py()
        vecs = vecs[: max(2, SAMPLE_BYTES // len(vecs[0]))]
        found = fit_centroids(unit(vecs), max(2, min(CENTROIDS, round(n / shard))))
        return pa.table({"shard": table.column("shard").slice(0, 1), "centers": pa.array([found.astype("<f8").tobytes()], pa.binary())})

    centers = stash(some.groupBy("shard").applyInArrow(fit, "shard long, centers binary"), "centers").df
    parts = F.ceil(F.col("n") / leaf).cast("int")
    dealt = held.withColumn("part", F.pmod(F.xxhash64("uid"), parts).cast("int")).select("uid", "shard", "part", "vec")
    each = centers.join(large, "shard").select("shard", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "centers")

    def assign(rows: pa.Table, own: pa.Table) -> pa.Table:
        if not rows.num_rows or not own.num_rows:
            return pa.table({"uid": pa.array([], pa.int64()), "shard": pa.array([], pa.int64()), "at": pa.array([], pa.int32()), "score": pa.array([], pa.float64())})
        vecs = rows.column("vec").to_pylist()
        c = np.frombuffer(own.column("centers")[0].as_py(), "<f8").reshape(-1, len(vecs[0]) // 8)
        pick, score = _nearest(vecs, c, overlap)
        width = pick.shape[1]
        return pa.table({"uid": np.repeat(rows.column("uid").to_numpy(), width), "shard": np.repeat(rows.column("shard").to_numpy(), width), "at": pick.ravel().astype(np.int32), "score": score.ravel()})

    found = dealt.groupBy("shard", "part").cogroup(each.groupBy("shard", "part")).applyInArrow(assign, "uid long, shard long, at int, score double")
    return found.select("uid", F.xxhash64("shard", "at").bitwiseAND(F.lit(2**63 - 1)).alias("shard"), "score")


def shards_of(folded: DataFrame, overlap: int = OVERLAP, sample: int = SAMPLE, shard: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """Rows (uid, shards): at most ``overlap`` shards of each vector. ``folded``: uid, vec, dim, digest."""
    member = stash(_coarse(folded, overlap, sample, shard), "members")
    for _ in range(LEVELS):
        large = member.df.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > REFINE * shard)
        if large.isEmpty():
            break
        large = stash(large, "large").df
        rest = member.df.join(large, "shard", "left_anti").select("uid", "shard", "score")
        every = rest.unionByName(_refined(folded, member.df, large, overlap, shard, leaf))
        best = F.slice(F.sort_array(F.collect_set(F.struct("score", "shard")), asc=False), 1, overlap)  # of overlap squared at most
        after = stash(every.groupBy("uid").agg(best.alias("x")).select("uid", F.explode("x").alias("x")).select("uid", "x.shard", "x.score"), "members")
        member.drop()
        member = after
    return member.df.groupBy("uid").agg(F.sort_array(F.collect_set("shard")).alias("shards"))


def near_duplicates(df: DataFrame, vector: str = "embedding", key: str = "vec_id", threshold: float = THRESHOLD, overlap: int = OVERLAP, leaf: int = LEAF, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """Rows (key, n_links, component_id, kept), one for each row of ``df``."""
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    rows = stash(map_rows(df.select(key, vector), _fold, f"id {kind}, digest binary, vec binary"), "vectors").df
    good = rows.where("digest is not null")
    folded = good.groupBy("digest").agg(F.any_value("vec").alias("vec"), F.count("*").alias("copies"), F.min("id").alias("first"), F.max(F.col("id").isNull()).alias("unnamed"))
    folded = stash(folded.withColumn("uid", F.monotonically_increasing_id()).withColumn("dim", F.octet_length("vec")), "folded").df
    placed = stash(folded.select("uid", "vec", "copies").join(shards_of(folded, overlap, sample, shard, leaf), "uid"), "placed").df
    member = placed.withColumn("shard", F.explode("shards"))
    sized = member.groupBy("shard").agg(F.ceil(F.count("*") / leaf).cast("int").alias("parts"))
    member = member.join(sized, "shard").withColumn("own", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    built = member.select("uid", "vec", F.xxhash64("shard", "own").alias("grp")).repartition(tasks, "grp").sortWithinPartitions("grp").mapInArrow(_build(leaf), "uid long, near array<long>")
    united = stash(built.groupBy("uid").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "adjacency").df
    linked = member.join(united, "uid", "left").withColumn("near", F.coalesce("near", F.array().cast("array<long>")))
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.least(p, F.col("own")).alias("t"), F.greatest(p, F.col("own")).alias("q")))
    asked = linked.withColumn("x", F.explode(others)).select("uid", "vec", "copies", "shards", "shard", "near", F.xxhash64("shard", "x.t", "x.q").alias("grp"), (F.col("x.t") == F.col("own")).alias("tree"), (F.col("x.q") == F.col("own")).alias("ask"))
    found = stash(asked.repartition(tasks, "grp").sortWithinPartitions("grp").mapInArrow(_search(threshold, leaf), "a long, b long, links long"), "found").df
    links = found.groupBy("b").agg(F.sum("links").alias("links"))
    vertices = folded.select("uid", "copies", "digest", F.struct((~F.col("unnamed")).alias("named"), "first").alias("first"))
    labels = min_label_components(vertices, found.where("a <> b"), "uid", "a", "b", "first")
    label = F.when(F.col("label.named"), F.col("label.first"))
    classes = vertices.join(labels, "uid").join(links, F.col("uid") == F.col("b"), "left").select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), label.alias("component_id"))
    bad = rows.where("digest is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = good.select("id", "digest").join(classes, "digest").drop("digest").unionByName(bad)
    return every.select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def audit_recall(df: DataFrame, found: DataFrame, vector: str = "embedding", key: str = "vec_id", threshold: float = THRESHOLD, queries: int = AUDIT) -> float:
    """Links found over links there are, for a sample of query vectors against all vectors by brute force."""
    rows = map_rows(df.select(key, vector), _fold, f"id {df.schema[key].dataType.simpleString()}, digest binary, vec binary").where("digest is not null")
    picked = rows.select("id", "vec", F.xxhash64(F.col("id").cast("string"), F.lit("audit")).alias("h")).orderBy("h").limit(queries).select("id", "vec").collect()
    once = {r["id"] for r in rows.where(F.col("id").isin([r["id"] for r in picked])).groupBy("id").agg(F.count("*").alias("n")).where("n = 1").collect()}  # a repeated id has several vectors
    by_size: dict[int, list] = {}
    for r in picked:
        if r["id"] not in once:
            continue
        by_size.setdefault(len(r["vec"]), []).append((r["id"], bytes(r["vec"])))
    asked = {d: ([i for i, _ in v], unit([x for _, x in v])) for d, v in by_size.items()}

    def count(batches):
        for b in batches:
            ids, vecs = b.column(0).to_pylist(), b.column(1).to_pylist()
            total: dict = {}
            for d, (own, q) in asked.items():
                at = [i for i, v in enumerate(vecs) if len(v) == d]
                if at:
                    near = q @ unit([vecs[i] for i in at]).T >= threshold
                    for i, n in zip(own, near.sum(axis=1).tolist()):
                        total[i] = total.get(i, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(list(total), b.schema.field(0).type), pa.array(list(total.values()), pa.int64())], names=["id", "n"])

    exact = map_rows(rows.select("id", "vec"), count, f"id {df.schema[key].dataType.simpleString()}, n long").groupBy("id").agg((F.sum("n") - 1).alias("n"))
    told = found.groupBy(F.col(key).alias("id")).agg(F.sum("n_links").alias("n_links"))
    both = exact.join(told, exact["id"].eqNullSafe(told["id"])).agg(F.sum("n"), F.sum("n_links")).first()
    return 1.0 if not both[0] else both[1] / both[0]


def op6_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Query op6: all vectors at cosine 0.95; ``audited_recall`` is that of ``AUDIT`` vectors against all."""
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = stash(near_duplicates(df), "classes").df
    return found.withColumn("audited_recall", F.lit(audit_recall(df, found)))
