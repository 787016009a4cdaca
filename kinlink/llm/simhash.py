"""SimHash near-duplicates found with BK-trees.

Fingerprints: 64 bits, a bit is set where more than half of the shingles' XXH64 values set it. Two fingerprints
within the radius agree on at least one of ``radius + 1`` bit blocks, so each distinct fingerprint goes to one
group for each block. A shard holds a forest: one BK-tree for each group, children keyed by their integer
Hamming distance to the parent; a search follows only edges within the radius of its own distance. A group of
more than ``leaf`` fingerprints is split again by the same argument on the remaining bits; what is still larger is
dealt to parts, and each pair of parts, one as tree and one as queries, becomes a group of its own.

Trees are sent with the groups' queries rather than to every task, since together they grow with the corpus; a task
holds a few groups at a time. A shard reports no pairs but a spanning forest of its links, at most one row a fingerprint.
Defined cases: null and empty texts have fingerprint zero, linked like any other; repeated rows share one fingerprint;
null keys keep their rows, and a component is null only where all its keys are;
an empty table gives an empty result; extra columns are ignored; texts are read whole, a bounded piece of shingles at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.arrow import bounded_batches, map_rows
from kinlink.llm.groups import Labels, whole_groups
from kinlink.operators.graph import min_label_components
from kinlink.sources.stash import stash

SEED = 42
BITS = 64
RADIUS = 3
SHINGLE = 3
LEAF = 20_000
PIECE = 1 << 16


def words_of(text: str | None) -> list[bytes]:
    """Words split at ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], size: int, seed: int = SEED):
    """XXH64 of the shingles, repeats included, a bounded piece at a time."""
    if words and len(words) < size:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    n, digest = len(words) - size + 1, xxhash.xxh64_intdigest
    for at in range(0, n, PIECE):
        end = min(at + PIECE, n)
        shingles = map(b" ".join, zip(*(words[at + i : end + i] for i in range(size))))
        yield np.fromiter((digest(s, seed) for s in shingles), np.uint64, end - at)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.byteswap().view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def majority(ones: np.ndarray, n: int) -> int:
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a whole text."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(words_of(text), size, seed):
        ones += bit_counts(hashes)
        n += len(hashes)
    return majority(ones, n) if n else 0


def fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """Rows (key, fp): the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            values = np.array([fingerprint(x, size) for x in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values)], names=[key, "fp"])

    return map_rows(df.select(key, text), run, f"`{key}` {df.schema[key].dataType.simpleString()}, fp long")


class BKForest:
    """BK-trees over distinct fingerprints, one for each group, laid out level by level in arrays.

    A node's children follow one another, ordered by their distance to it, so the children within a band
    of distances are one slice.
    """

    def __init__(self, values: np.ndarray, groups: np.ndarray):
        n = len(values)
        self.values, self.child_at, self.child_end = np.asarray(values, np.uint64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.order, self.key = np.empty(n, np.int64), np.zeros(n, np.int64)
        rest = np.lexsort((self.values, groups))
        group = np.asarray(groups)[rest]
        placed, parents = 0, None
        self.roots: dict[int, int] = {}
        while len(rest):
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            heads = rest[first]
            slots = placed + np.arange(len(heads))
            self.order[slots] = heads
            if parents is None:
                self.roots = dict(zip(group[first].tolist(), slots.tolist()))
            else:
                up, keys = parents[first], self.key_of[first]
                self.key[slots] = keys
                edge = np.flatnonzero(np.r_[True, up[1:] != up[:-1]])
                self.child_at[up[edge]] = slots[edge]
                self.child_end[up[edge]] = slots[np.r_[edge[1:] - 1, len(up) - 1]] + 1
            owner = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(rest)]))
            stay = np.ones(len(rest), bool)
            stay[first] = False
            rest, owner = rest[stay], owner[stay]
            apart = np.bitwise_count(self.values[rest] ^ self.values[heads[owner]]).astype(np.int64)
            by = np.lexsort((apart, owner))
            rest, owner, apart = rest[by], owner[by], apart[by]
            parents, self.key_of = slots[owner], apart
            group = owner * (BITS + 1) + apart
            placed += len(heads)
        self.at = self.values[self.order]

    def search(self, queries: np.ndarray, groups: np.ndarray, radius: int, block: int = 4096):
        """Yields (query index, value index) arrays of matches, for a block of queries at a time."""
        root = np.array([self.roots.get(g, -1) for g in groups.tolist()], np.int64)
        queries = np.asarray(queries, np.uint64)
        for low in range(0, len(queries), block):
            asked = np.flatnonzero(root[low : low + block] >= 0) + low
            node = root[asked]
            while len(asked):
                apart = np.bitwise_count(queries[asked] ^ self.at[node]).astype(np.int64)
                near = apart <= radius
                if near.any():
                    yield asked[near], self.order[node[near]]
                start, end = self.child_at[node], self.child_end[node]
                width = end - start
                total = int(width.sum())
                if not total:
                    break
                child = np.repeat(start - np.r_[0, np.cumsum(width)[:-1]], width) + np.arange(total)
                asked, apart = np.repeat(asked, width), np.repeat(apart, width)
                follow = np.abs(self.key[child] - apart) <= radius
                asked, node = asked[follow], child[follow]


def _shard(table: pa.Table, radius: int) -> pa.Table:
    """Whole groups of a shard: ``tree`` rows build the trees, ``ask`` rows search them.

    Returns star links (a, b), a the smallest fingerprint of what is linked here.
    """
    fp, group = table.column("fp").to_numpy().view(np.uint64), table.column("grp").to_numpy()
    tree, ask = (np.flatnonzero(table.column(c).to_numpy(zero_copy_only=False)) for c in ("tree", "ask"))
    values = np.unique(fp)
    at = np.searchsorted(values, fp)
    forest, joined = BKForest(fp[tree], group[tree]), Labels(len(values))
    for asked, found in forest.search(fp[ask], group[ask], radius):
        joined.link(at[ask[asked]], at[tree[found]])
    member = np.flatnonzero(joined.label != np.arange(len(values)))
    return pa.table({"a": values[joined.label[member]].view(np.int64), "b": values[member].view(np.int64)})


def _bits(value, low: int, width: int):
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))


def _grouped(keyed: DataFrame) -> DataFrame:
    """With the size n of the group; fingerprints alone in a group are left out, as they meet nothing there."""
    return keyed.join(keyed.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1"), "grp")


def links(distinct: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints within the radius. ``distinct``: one column fp."""
    blocks = radius + 1
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    first = [F.struct(F.xxhash64(F.lit(i), _bits(F.col("fp"), edges[i], edges[i + 1] - edges[i])).alias("grp"), F.lit(i).alias("block")) for i in range(blocks)]
    coarse = _grouped(distinct.select("fp", F.explode(F.array(*first)).alias("x")).select("fp", "x.grp", "x.block"))
    coarse = stash(coarse, "blocks").df
    small = coarse.where(F.col("n") <= leaf).select("fp", "grp", "n")
    # a larger group is split again: what shares a block and is within the radius shares a piece of the other bits
    fine = []
    for i in range(blocks):
        low, high = edges[i], edges[i + 1]
        above = F.shiftleft(F.shiftrightunsigned("fp", high), low) if high < BITS else F.lit(0).cast("long")
        rest = above.bitwiseOR(F.col("fp").bitwiseAND(F.lit((1 << low) - 1)))
        width = BITS - (high - low)
        cuts = [round(j * width / blocks) for j in range(blocks + 1)]
        fine.append(F.array(*(F.xxhash64(F.col("grp"), F.lit(j), _bits(rest, cuts[j], cuts[j + 1] - cuts[j])) for j in range(blocks))))
    large = coarse.where(F.col("n") > leaf).select("fp", F.explode(F.element_at(F.array(*fine), F.col("block") + 1)).alias("grp"))
    groups = small.unionAll(_grouped(large).select("fp", "grp", "n"))
    # what is still larger is dealt to parts; each pair of parts, one as trees and one as queries, is a group
    parts = F.ceil(F.col("n") / leaf).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.least(p, F.col("own")).alias("t"), F.greatest(p, F.col("own")).alias("q")))
    dealt = groups.withColumn("parts", parts).withColumn("own", own).select("fp", "grp", "own", F.explode(others).alias("x"))
    keyed = dealt.select("fp", F.xxhash64("grp", "x.t", "x.q").alias("grp"), (F.col("x.t") == F.col("own")).alias("tree"), (F.col("x.q") == F.col("own")).alias("ask"))

    def run(batches):
        for table in whole_groups(batches, 4 * leaf):
            yield from _shard(table, radius).to_batches()

    shards = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(shards, "grp").sortWithinPartitions("grp").mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """Rows (key, fp, component): component is the smallest key reachable over links of at most ``radius`` bits."""
    printed = stash(fingerprints(df, text, key, size), "simhash").df
    first = stash(printed.groupBy("fp").agg(F.min(key).alias("first")), "fps")
    edges = stash(links(first.df.select("fp")), "links")
    labels = min_label_components(first.df, edges.df, "fp", "a", "b", "first")
    return printed.join(labels.select("fp", F.col("label").alias("component")), "fp").select(key, "fp", "component")


KEPT_SHINGLE = 5
KEPT_SIMILARITY = 0.8
KEPT_RADIUS = 16
MINIMA = 8
PART_ROWS = 2000
PART_SHINGLES = 2_000_000
TABLE_ROWS = 500
COMPARED = 64


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x165667B19E3779F9)


def _described(size: int):
    def run(batches):
        for b in batches:
            prints, minima, sizes = [], [], []
            for text in b.column(2).to_pylist():
                ones, n, low = np.zeros(BITS, np.int64), 0, np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
                for hashes in shingle_hashes(words_of(text), size):
                    ones += bit_counts(hashes)
                    n += len(hashes)
                    low = np.minimum(low, [_mixed(hashes, i).min() for i in range(MINIMA)])
                prints.append(majority(ones, n) if n else 0)
                minima.append(low.view(np.int64))
                sizes.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(minima, pa.list_(pa.int64())), pa.array(sizes, pa.int64())], names=["key", "digest", "fp", "minima", "size"])

    return run


class _Group:
    """The rows of a group that may be alike: tree rows within the radius of ask rows that meet in no earlier group."""

    def __init__(self, table: pa.Table):
        self.fp = table.column("fp").to_numpy().view(np.uint64)
        self.tree, self.ask = (table.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "ask"))
        before = table.column("before").to_pylist()  # minima of earlier places, equally many in a group
        self.before = np.array(before, np.int64).reshape(len(before), -1)

    def pairs(self, radius: int, most: int = PIECE):
        """Yields (a, b) arrays of about ``most`` pairs of row numbers, each pair once; rows of equal fingerprint are all paired."""
        values, of = np.unique(self.fp, return_inverse=True)
        rows = {side: np.flatnonzero(held)[np.argsort(of[held], kind="stable")] for side, held in (("tree", self.tree), ("ask", self.ask))}
        start = {side: np.searchsorted(of[r], np.arange(len(values) + 1)) for side, r in rows.items()}
        trees, asks = (np.flatnonzero(np.diff(start[side])) for side in ("tree", "ask"))
        forest = BKForest(values[trees], np.zeros(len(trees), np.int64))
        for asked, found in forest.search(values[asks], np.zeros(len(asks), np.int64), radius, 256):
            low_a, low_b = start["ask"][asks[asked]], start["tree"][trees[found]]
            n_a, n_b = start["ask"][asks[asked] + 1] - low_a, start["tree"][trees[found] + 1] - low_b
            # one stretch for each asking row, so that a pair of large classes is cut too
            at = np.repeat(low_a - np.r_[0, np.cumsum(n_a)[:-1]], n_a) + np.arange(n_a.sum())
            low_b, n_b = np.repeat(low_b, n_a), np.repeat(n_b, n_a)
            total = np.cumsum(n_b)
            cut = 0
            while cut < len(at):
                end = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + most, "right")))
                width, low = n_b[cut:end], low_b[cut:end]
                a = rows["ask"][np.repeat(at[cut:end], width)]
                b = rows["tree"][np.repeat(low - np.r_[0, np.cumsum(width)[:-1]], width) + np.arange(width.sum())]
                cut = end
                # what both asks and is a tree on either side would come twice
                once = (a != b) & ((a < b) | ~(self.tree[a] & self.ask[b]))
                yield a[once], b[once]

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether this is the first group that the two rows share."""
        return ~(self.before[a] == self.before[b]).any(axis=1)


def _slices(table: pa.Table):
    group = table.column("grp").to_numpy()
    edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]).tolist()
    for low, high in zip(edge, [*edge[1:], len(group)]):
        if high - low > 1:
            yield table.slice(low, high - low)


def _proposed(table: pa.Table, radius: int) -> pa.Table:
    """Rows (node, base) of a group with a proposal that is decided here."""
    group, wanted = _Group(table), np.zeros(table.num_rows, bool)
    for a, b in group.pairs(radius):
        new = ~(wanted[a] & wanted[b])
        a, b = a[new], b[new]
        new = group.apart(a, b)
        wanted[a[new]] = wanted[b[new]] = True
    return table.select(["node", "base"]).filter(pa.array(wanted))


def _decided(table: pa.Table, radius: int, size: int, similarity: float) -> pa.Table:
    """A spanning forest (a, b) of the proposals of a group that are alike; what is joined already is not compared again."""
    opened, group, n = zstandard.ZstdDecompressor(), _Group(table), table.num_rows
    sets = []
    for text in table.column("packed").to_pylist():
        hashes = list(shingle_hashes(words_of(opened.decompress(text).decode("utf-8", "surrogatepass")), size))
        sets.append(np.unique(np.concatenate(hashes)) if hashes else np.empty(0, np.uint64))
    count = np.array([len(x) for x in sets])
    joined, links = Labels(n), []
    for a, b in group.pairs(radius):
        new = joined.label[a] != joined.label[b]
        a, b = a[new], b[new]
        # the smaller set over the larger bounds the similarity
        fit = np.minimum(count[a], count[b]) >= similarity * np.maximum(count[a], count[b]) * (1 - 1e-9)
        a, b = a[fit], b[fit]
        new = group.apart(a, b)
        a, b = a[new], b[new]
        by = np.argsort(a, kind="stable")
        a, b = a[by], b[by]
        edge = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]).tolist() if len(a) else []
        for low, high in zip(edge, [*edge[1:], len(a)]):
            one, others = int(a[low]), b[low:high]
            others = others[joined.label[others] != joined.label[one]]
            while len(others):
                some, others = others[:COMPARED], others[COMPARED:]
                both = _common(sets[one], [sets[i] for i in some.tolist()])
                either = count[one] + count[some] - both
                alike = some[np.where(either > 0, both / np.maximum(either, 1), 1.0) >= similarity]
                links += [(one, i) for i in alike.tolist()]
                joined.link(np.full(len(alike), one), alike)
                others = others[joined.label[others] != joined.label[one]]
    node = table.column("node").to_numpy()
    ends = node[np.array(links, np.int64).reshape(-1, 2)]
    return pa.table({"a": pa.array(ends[:, 0], pa.int64()), "b": pa.array(ends[:, 1], pa.int64())})


def _common(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Numbers of common values of one sorted set with each of the others."""
    if not len(one):
        return np.zeros(len(others), np.int64)
    ends = np.cumsum([len(x) for x in others])
    values = np.concatenate(others)
    hit = one[np.minimum(np.searchsorted(one, values), len(one) - 1)] == values
    total = np.r_[0, np.cumsum(hit)]
    return total[ends] - total[np.r_[0, ends[:-1]]]


def _packed(batches):
    press = zstandard.ZstdCompressor(level=1)
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([press.compress((t or "").encode("utf-8", "surrogatepass")) for t in b.column(2).to_pylist()], pa.binary())], names=["key", "digest", "packed"])


def shingle_set(text: str | None, size: int) -> set[bytes]:
    words = words_of(text)
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(a: str | None, b: str | None, size: int = KEPT_SHINGLE) -> float:
    """Exact similarity of the shingle sets; two texts without words are alike."""
    x, y = shingle_set(a, size), shingle_set(b, size)
    return len(x & y) / len(x | y) if x or y else 1.0


def _dealt(member: DataFrame, parts: DataFrame, columns: list[str]) -> DataFrame:
    """Members of each base dealt to its parts; each pair of parts, one as tree and one as queries, is a group."""
    member = member.join(parts, "base").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.least(p, F.col("own")).alias("t"), F.greatest(p, F.col("own")).alias("q")))
    dealt = member.withColumn("x", F.explode(others))
    return dealt.select(*columns, "base", F.xxhash64("base", "x.t", "x.q").alias("grp"), (F.col("x.t") == F.col("own")).alias("tree"), (F.col("x.q") == F.col("own")).alias("ask"))


def keep_first(df: DataFrame, text: str = "text", key: str = "doc_id", size: int = KEPT_SHINGLE, similarity: float = KEPT_SIMILARITY, radius: int = KEPT_RADIUS, leaf: int = LEAF) -> DataFrame:
    """The rows of ``df``, all columns: of each group of texts whose shingle sets are alike, the row with the smallest key.

    A radius that finds a similarity of 0.8 is too wide for bit blocks, so the shards are those of shared minima: texts
    that have one of ``MINIMA`` minimum shingle hashes in common meet, and the shard's BK-tree proposes all pairs within the
    radius. Each proposal between texts that are not joined yet is decided by the exact similarity of the sets of 64-bit
    shingle hashes, in the first shard that the two share, and groups are the components. Only texts with a proposal are sent
    to shards, in parts of at most ``PART_SHINGLES``; no pairs are written. Rows that repeat key and text count as one
    document and stay or go together.
    """
    kind = df.schema[key].dataType.simpleString()
    docs = df.select(F.col(key).alias("key"), F.unhex(F.md5(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"))).alias("digest"), F.col(text).alias("text"))
    described = map_rows(docs, _described(size), f"key {kind}, digest binary, fp long, minima array<long>, size long")
    nodes = described.groupBy("digest").agg(F.min("key").alias("first"), F.min(F.struct("fp", "minima", "size")).alias("x"))
    nodes = stash(nodes.select("digest", "first", "x.fp", "x.minima", "x.size").withColumn("node", F.monotonically_increasing_id()), "nodes").df
    keyed = nodes.select("node", "fp", "size", "minima", F.posexplode("minima")).select("node", "fp", "size", F.slice("minima", F.lit(1), F.col("pos")).alias("before"), F.xxhash64("pos", "col").alias("base"))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = keyed.groupBy("base").agg(F.count("*").alias("n")).where("n > 1").select("base", F.ceil(F.col("n") / leaf).cast("int").alias("parts"))
    columns = ["node", "fp", "before"]

    def propose(batches):
        for table in whole_groups(batches, 2 * leaf):
            for part in _slices(table):
                yield from _proposed(part, radius).to_batches()

    met = _dealt(keyed, sized, columns).repartition(tasks, "grp").sortWithinPartitions("grp").mapInArrow(propose, "node long, base long")
    met = stash(met.distinct(), "met").df
    # texts of those that have a proposal, once each
    asked = met.select("node").distinct().join(nodes.select("node", "digest", "first"), "node")
    packed = map_rows(docs, _packed, f"key {kind}, digest binary, packed binary")
    texts = packed.join(asked, (packed["digest"] == asked["digest"]) & packed["key"].eqNullSafe(asked["first"])).groupBy("node").agg(F.any_value("packed").alias("packed"))
    texts = stash(texts, "texts").df
    # again by group, now with the texts, in parts of bounded shingles
    member = stash(met.join(keyed, ["node", "base"]), "members").df
    sized = member.groupBy("base").agg(F.greatest(F.ceil(F.count("*") / min(leaf, PART_ROWS)), F.ceil(F.sum("size") / PART_SHINGLES)).cast("int").alias("parts"))

    def decide(batches):
        for table in whole_groups(batches, TABLE_ROWS):
            for part in _slices(table):
                yield from _decided(part, radius, size, similarity).to_batches()

    bounded_batches(df.sparkSession)
    dealt = _dealt(member, sized, columns).join(texts, "node")
    edges = stash(dealt.repartition(tasks, "grp").sortWithinPartitions("grp").mapInArrow(decide, "a long, b long"), "links").df
    labels = min_label_components(nodes, edges, "node", "a", "b", "first")
    kept = nodes.join(labels, "node").where(F.col("first").eqNullSafe(F.col("label"))).select(F.col("first").alias("__first"), F.col("digest").alias("__digest"))
    mine = F.unhex(F.md5(F.encode(F.coalesce(df[text], F.lit("")), "UTF-8")))
    return df.join(kept, df[key].eqNullSafe(kept["__first"]) & (mine == kept["__digest"]), "left_semi")


def op9_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Query op9: three-word shingles, links at 3 or fewer bits."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
