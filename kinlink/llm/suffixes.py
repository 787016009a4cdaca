"""Exact removal of repeated byte strings with suffix arrays.

Every byte that lies in a string of ``length`` bytes which also starts elsewhere, in the same text or another, is
removed; overlaps count and all strings are judged on the input.

1. Equal texts are folded to one with its number of copies.
2. Each window of ``length`` bytes has the smallest hash of its 32-byte seeds as its key. Consecutive windows with
   one key form a region. Equal windows have equal keys, so windows can repeat only between regions of one key; a
   region that occurs once, under a key that no other region has, is not looked at again. Regions are equal where key, length
   and a 128-bit hash are.
3. The distinct regions of a key go to a shard. A shard sorts the suffixes of its bytes by Larsson-Sadakane
   refinement, takes common prefixes by Kasai's walk and marks windows next to which a common prefix of ``length``
   bytes or more lies.
4. A key with more bytes than ``shard_bytes`` is dealt to several shards. Each gives the sorted 128-bit digests of its distinct windows,
   and these are merged by binary search, one part of the digests a task.
5. Marked windows go back to all texts that hold the region; removed runs are their union.

Defined cases: null is the empty text; texts shorter than ``length`` lose nothing; repeated rows and null keys each get
their own result row; an empty table gives an empty result; extra columns are ignored, whatever their names; texts are read whole. A text
is looked at ``CHUNK`` bytes at a time, with the bytes that the last windows reach into, so that memory beyond the text itself
and what is kept of it does not follow its length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.arrow import BATCH_BYTES, map_rows
from kinlink.sources.stash import stash

LENGTH = 400
SEED = 32
MOST_WINDOWS = 4096
SHARD_BYTES = 2 << 20
CHUNK = 1 << 20
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _seed_hashes(data: bytes) -> np.ndarray:
    """A hash of the 32 bytes at each position."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    m = len(data) - SEED + 1
    h = words[:m] * np.uint64(_MIX[0])
    for i, factor in enumerate(_MIX[1:], 1):
        h ^= h >> np.uint64(31)
        h += words[8 * i : 8 * i + m] * np.uint64(factor)
        h *= np.uint64(_MIX[0])
    h ^= h >> np.uint64(32)
    return h


def _sliding(values: np.ndarray, width: int, fold, fill) -> np.ndarray:
    """Fold of each run of ``width`` values, from running folds within blocks."""
    padded = np.full(-(-len(values) // width) * width, fill, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = fold.accumulate(blocks, axis=1).ravel()
    behind = fold.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return fold(behind[:n], ahead[width - 1 : width - 1 + n])


def regions(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, first windows, numbers of windows, and whether a key's seed occurs twice in the text."""
    if len(data) < length:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 2, np.empty(0, bool))
    width, most = length - SEED + 1, np.iinfo(np.uint64).max
    h = _seed_hashes(data)
    low = _sliding(h, width, np.minimum, most)
    start = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    # where a seed is the smallest of some window; seeds that are so twice may repeat within their own region
    around = np.concatenate((np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)))
    at = np.flatnonzero(_sliding(around, width, np.maximum, 0) == h)
    value, times = np.unique(h[at], return_counts=True)
    size = np.diff(np.r_[start, len(low)])
    if size.max() > MOST_WINDOWS:
        pieces = -(-size // MOST_WINDOWS)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size, start = np.minimum(np.repeat(size, pieces) - nth * MOST_WINDOWS, MOST_WINDOWS), np.repeat(start, pieces) + nth * MOST_WINDOWS
    keys = low[start]
    return keys, start, size, np.isin(keys, value[times > 1])


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``data`` (bytes) sorted by at least their first ``depth`` bytes, and their ranks.

    Larsson-Sadakane: a group of suffixes alike in h bytes is sorted by the ranks h bytes further on, which doubles h;
    groups of one are left alone. A rank is the place of its group's last suffix.
    """
    n = len(data)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    first = np.ndarray((n,), ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)
    order = np.argsort(first, kind="stable")
    # the end of the text sorts before any byte: among suffixes with equal padded words the shorter comes first
    tail = np.arange(max(0, n - 8), n)
    ordered = first[order]
    split = np.r_[True, ordered[1:] != ordered[:-1]]
    if len(tail):
        short = np.flatnonzero(order >= n - 8)
        for at in short:
            lo = np.searchsorted(ordered, ordered[at], "left")
            hi = np.searchsorted(ordered, ordered[at], "right")
            part = order[lo:hi]
            length = np.minimum(n - part, 8)
            by = np.argsort(length, kind="stable")
            order[lo:hi] = part[by]
            split[lo + 1 : hi] = np.diff(length[by]) > 0
    ends = np.r_[np.flatnonzero(split)[1:], n] - 1
    group = np.cumsum(split) - 1
    rank = np.empty(n, np.int64)
    rank[order] = ends[group]
    h = 8
    size = np.diff(np.r_[-1, ends])
    open_at = np.flatnonzero(np.repeat(size, size) > 1)
    while h < depth and len(open_at):
        suffix = order[open_at]
        ahead = suffix + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        own = rank[suffix]
        by = np.argsort(own * (n + 2) + second, kind="stable")
        order[open_at] = suffix[by]
        own, second = own[by], second[by]
        new = np.r_[True, (own[1:] != own[:-1]) | (second[1:] != second[:-1])]
        last = np.r_[np.flatnonzero(new)[1:], len(new)] - 1
        which = np.cumsum(new) - 1
        rank[order[open_at]] = open_at[last][which]
        size = np.bincount(which)
        open_at = open_at[size[which] > 1]
        h *= 2
    return order, rank


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int, lanes: int = 32768) -> np.ndarray:
    """Length, up to ``most``, of the common prefix of each suffix in order with the one before it.

    Kasai's walk goes through the text and starts each comparison one byte short of the last; here many stretches of the
    text are walked side by side. ``order`` need be sorted by the first ``most`` bytes only: what was alike is carried where
    the two suffixes, a byte further on, still lie in order, as all between them is then as alike; else the count is from zero.
    """
    n = len(data)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.where(place > 0, order[np.maximum(place - 1, 0)], -1)  # by text position
    found = np.zeros(n, np.int64)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    words = np.ndarray((n,), "<u8", padded.tobytes(), strides=(1,))
    stretch = -(-n // lanes)
    here = np.arange(0, n, stretch)
    carried, last = np.zeros(len(here), np.int64), np.full(len(here), n)
    for step in range(stretch):
        at = here + step
        live = at < n
        at = at[live]
        other = before[at]
        ran = np.maximum(carried[live] - 1, 0)
        next_ = last[live] + 1
        ran[(other < 0) | (next_ >= n) | (place[np.minimum(next_, n - 1)] >= place[at])] = 0
        todo = np.flatnonzero(other >= 0)
        while len(todo):
            a, b, r = at[todo], other[todo], ran[todo]
            room = np.minimum(n - np.maximum(a, b) - r, most - r)
            ok = room > 0
            todo, a, b, r, room = todo[ok], a[ok], b[ok], r[ok], room[ok]
            if not len(todo):
                break
            apart = words[a + r] ^ words[b + r]
            same = np.where(apart == 0, 8, np.bitwise_count((apart & (~apart + np.uint64(1))) - np.uint64(1)) >> 3)
            same = np.minimum(same, room)
            ran[todo] = r + same
            todo = todo[(same == 8) & (room > 8)]
        carried[live], last[live] = ran, other
        found[at] = ran
    return found[order]


def repeated_windows(parts: list[bytes], sizes: list[int], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Over the windows of all parts, in order: whether each repeats among them, and its place in the joined bytes."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    lengths = np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(lengths) - lengths
    count = np.asarray(sizes, np.int64)
    where = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
    order, _ = suffix_array(data, length)
    alike = common_prefixes(data, order, length) >= length
    block = np.cumsum(~alike)
    valid = np.zeros(len(data), bool)
    valid[where] = True
    held = np.bincount(block[valid[order]], minlength=block[-1] + 1)
    twice = np.zeros(len(data), bool)
    twice[order] = held[block] > 1
    return twice[where], where


def _intervals(table: pa.Table, flags: np.ndarray) -> pa.Table:
    """Rows (key, r1, r2, at, n): runs of marked windows of each region."""
    size = table.column("n").to_numpy()
    ends = np.cumsum(size)
    # a run ends with its region
    start = np.flatnonzero(flags & ~np.r_[False, flags[:-1]] | flags & np.isin(np.arange(len(flags)), ends - size))
    stop = np.flatnonzero(flags & ~np.r_[flags[1:], False] | flags & np.isin(np.arange(len(flags)), ends - 1)) + 1
    owner = np.searchsorted(ends, start, "right")
    held = table.select(["key", "r1", "r2"]).take(pa.array(owner))
    return held.append_column("at", pa.array(start - (ends - size)[owner])).append_column("n", pa.array(stop - start))


def _shard(length: int):
    def run(table: pa.Table) -> pa.Table:
        flags, _ = repeated_windows(table.column("bytes").to_pylist(), table.column("n").to_pylist(), length)
        return _intervals(table, flags)

    return run


def _dealt_shard(length: int):
    """For a dealt key: rows that mark what repeats within a shard, digest null, and the sorted run of its windows.

    The run has one row for each distinct window; only a window that is alone in its shard says where it lies.
    """

    def run(table: pa.Table) -> pa.Table:
        parts, sizes = table.column("bytes").to_pylist(), table.column("n").to_pylist()
        flags, where = repeated_windows(parts, sizes, length)
        marks = _intervals(table, flags)
        data = memoryview(b"".join(parts))
        digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(data[i : i + length]) for i in where.tolist()]), "S16")
        digests, first = np.unique(digests, return_index=True)
        source = np.repeat(np.arange(len(sizes)), sizes)
        low, alone = np.cumsum(sizes) - np.asarray(sizes), ~flags[first]
        n = len(digests)
        runs = table.select(["key", "r1", "r2"]).take(pa.array(source[first]))
        runs = runs.append_column("at", pa.array(np.where(alone, first - low[source[first]], 0), mask=~alone)).append_column("n", pa.array(np.ones(n, np.int64)))
        whole = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), n, [None, pa.py_buffer(digests.tobytes())]).cast(pa.binary())
        runs = runs.append_column("digest", whole).append_column("shard", pa.array(np.full(n, table.column("shard")[0].as_py(), np.int64)))
        return pa.concat_tables([marks.append_column("digest", pa.nulls(marks.num_rows, pa.binary())).append_column("shard", pa.nulls(marks.num_rows, pa.int64())), runs])

    return run


def merge_runs(digest: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Which windows of several shards' sorted runs occur in another run: each run is looked up in the merged others by binary search."""
    merged = np.empty(0, digest.dtype)
    met: list[np.ndarray] = []
    for s in np.unique(shard):
        values = np.unique(digest[shard == s])
        at = np.searchsorted(merged, values)
        hit = np.zeros(len(values), bool)
        inside = at < len(merged)
        hit[inside] = merged[at[inside]] == values[inside]
        met.append(values[hit])
        fresh = values[~hit]
        merged = np.insert(merged, np.searchsorted(merged, fresh), fresh)
    both = np.unique(np.concatenate(met)) if met else merged
    at = np.searchsorted(both, digest)
    inside = at < len(both)
    out = np.zeros(len(digest), bool)
    out[inside] = both[at[inside]] == digest[inside]
    return out


def _merge_group(table: pa.Table) -> pa.Table:
    hit = merge_runs(np.frombuffer(b"".join(table.column("digest").to_pylist()), "S16"), table.column("shard").to_numpy())
    hit &= table.column("at").is_valid().to_numpy()
    return table.filter(pa.array(hit)).select(["key", "r1", "r2", "at", "n"])


def _join_marks(batches):
    """Marks of a region, gathered and joined into maximal runs."""
    for b in batches:
        out = []
        for marks in b.column(3).to_pylist():
            runs: list[list[int]] = []
            for low, high in sorted((m["at"], m["at"] + m["n"]) for m in marks):
                if runs and low <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], high)
                else:
                    runs.append([low, high])
            out.append([{"at": low, "n": high - low} for low, high in runs])
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())])))], names=["key", "r1", "r2", "marks"])


def _texts(batches):
    """Compressed texts keyed by digest, equal texts of a batch folded."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for b in batches:
        counts: dict[bytes, list] = {}
        for text in b.column(0).to_pylist():
            data = (text or "").encode("utf-8", "surrogatepass")
            digest = hashlib.md5(data).digest()
            if digest in counts:
                counts[digest][1] += 1
            else:
                counts[digest] = [data, 1]
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array([squeeze.compress(v[0]) for v in counts.values()], pa.binary()), pa.array([v[1] for v in counts.values()], pa.int64())], names=["digest", "packed", "copies"])


def _open(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _find_regions(length: int, chunk: int):
    names = ["text_id", "key", "r1", "r2", "lo", "n", "again", "copies"]

    def run(batches):
        for b in batches:
            for text_id, packed, copies in zip(*(b.column(i).to_pylist() for i in range(3))):
                data = _open(packed)
                view = memoryview(data)
                for begin in range(0, max(1, len(data) - length + 1), chunk):
                    keys, start, size, again = regions(data[begin : begin + chunk + length - 1] if len(data) > chunk else data, length)
                    if not len(keys):
                        continue
                    start = start + begin
                    prints = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[a : a + n + length - 1]) for a, n in zip(start.tolist(), size.tolist())]), "<i8").reshape(-1, 2)
                    m = len(keys)
                    columns = [np.full(m, text_id, np.int64), keys.view(np.int64), prints[:, 0].copy(), prints[:, 1].copy(), start, size.astype(np.int32), again, np.full(m, copies, np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def _cut_out(length: int):
    names = ["key", "r1", "r2", "n", "shard", "dealt", "bytes"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())

    def run(batches):
        for b in batches:
            for packed, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = _open(packed)
                for low in range(0, len(wanted), 2000):
                    out = [(w["key"], w["r1"], w["r2"], w["n"], w["shard"], w["dealt"], data[w["lo"] : w["lo"] + w["n"] + length - 1]) for w in wanted[low : low + 2000]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return run


def removed_spans(n_bytes: int, starts: np.ndarray, counts: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs covered by the windows that start in [start, start + count)."""
    spans: list[list[int]] = []
    for i in np.argsort(starts, kind="stable").tolist():
        low, high = int(starts[i]), int(starts[i] + counts[i] + length - 1)
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high)
        else:
            spans.append([low, high])
    return [(a, min(b, n_bytes)) for a, b in spans]


def _judge(length: int, with_text: bool):
    types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
    names = ["digest", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types)], names=names)

    def run(batches):
        for b in batches:
            out, held = [], 0
            for digest, packed, marks in zip(*(b.column(i).to_pylist() for i in range(3))):
                data = _open(packed)
                marks = marks or []
                spans = removed_spans(len(data), np.array([m["at"] for m in marks], np.int64), np.array([m["n"] for m in marks], np.int64), length)
                kept, at = [], 0
                for low, high in spans:
                    kept.append(data[at:low])
                    at = high
                kept = b"".join([*kept, data[at:]])
                out.append((digest, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if with_text else None, [{"start": a, "end": z} for a, z in spans]))
                held += len(kept) if with_text else 0
                if held > BATCH_BYTES:  # a batch of packed texts may open to far more
                    yield batch(out)
                    out, held = [], 0
            yield batch(out)

    return run


def remove_repeats(df: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, shard_bytes: int = SHARD_BYTES, with_text: bool = False, chunk: int = CHUNK) -> DataFrame:
    """Rows (key, n_bytes, n_removed, n_spans, kept_sha256, kept, spans), one for each row; ``kept`` only ``with_text``."""
    if length < SEED + 1:
        raise ValueError(f"the length must exceed the seeds' {SEED} bytes")
    bytes_of = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    folded = map_rows(df.select(text), _texts, "digest binary, packed binary, copies long").groupBy("digest").agg(F.any_value("packed").alias("packed"), F.sum("copies").alias("copies"))
    texts = stash(folded.withColumn("text_id", F.monotonically_increasing_id()), "texts").df
    region = ["key", "r1", "r2", "n"]
    found = stash(map_rows(texts.select("text_id", "packed", "copies"), _find_regions(length, chunk), "text_id long, key long, r1 long, r2 long, lo long, n int, again boolean, copies long"), "regions").df
    distinct = found.groupBy(*region).agg(F.sum("copies").alias("copies"), F.min(F.struct("text_id", "lo")).alias("one"), F.max("again").alias("again"))
    by_key = distinct.groupBy("key").agg(F.count("*").alias("regions"), F.sum(F.col("n") + F.lit(length - 1)).alias("bytes"))
    suspect = distinct.join(by_key, "key").where((F.col("regions") > 1) | F.col("again") | (F.col("copies") > 1))
    suspects = stash(suspect.select(*region, "copies", "one", "bytes", ((F.col("regions") > 1) | F.col("again")).alias("sorted")), "suspects")
    suspect = suspects.df
    whole = suspect.where("copies > 1").select("key", "r1", "r2", F.lit(0).cast("long").alias("at"), F.col("n").cast("long").alias("n"))
    # regions to sort, by the shard they go to
    total = suspect.where("sorted").agg(F.sum(F.col("n") + F.lit(length - 1))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    dealt = F.col("bytes") > shard_bytes
    shard = F.when(dealt, F.xxhash64("key", F.pmod(F.xxhash64("r1", F.lit(1)), F.ceil(F.col("bytes") / shard_bytes)))).otherwise(F.pmod(F.xxhash64("key"), F.lit(shards)))
    wanted = suspect.where("sorted").select(F.col("one.text_id").alias("text_id"), F.struct("key", "r1", "r2", F.col("one.lo").alias("lo"), "n", shard.alias("shard"), dealt.alias("dealt")).alias("w"))
    wanted = wanted.groupBy("text_id").agg(F.collect_list("w").alias("wanted"))
    cut = stash(map_rows(texts.join(wanted, "text_id").select("packed", "wanted"), _cut_out(length), "key long, r1 long, r2 long, n long, shard long, dealt boolean, bytes binary"), "pieces")
    pieces = cut.df
    marks = "key long, r1 long, r2 long, at long, n long"
    here = pieces.where("not dealt").groupBy("shard").applyInArrow(_shard(length), marks)
    sorted_runs = stash(pieces.where("dealt").groupBy("shard").applyInArrow(_dealt_shard(length), f"{marks}, digest binary, shard long"), "runs")
    runs = sorted_runs.df
    ranges = F.ceil(F.lit(max(total, 1)) / shard_bytes).cast("long")
    across = runs.where("digest is not null").withColumn("range", F.pmod(F.xxhash64("digest"), ranges)).groupBy("range").applyInArrow(_merge_group, marks)
    marked = whole.unionByName(here).unionByName(runs.where("digest is null").select("key", "r1", "r2", "at", "n")).unionByName(across)
    gathered = marked.groupBy("key", "r1", "r2").agg(F.collect_list(F.struct("at", "n")).alias("marks"))  # at most a region's windows
    marked = stash(gathered.mapInArrow(_join_marks, "key long, r1 long, r2 long, marks array<struct<at:long,n:long>>"), "marks").df
    for done in (suspects, cut, sorted_runs):
        done.drop()
    moved = F.transform("marks", lambda m: F.struct((F.col("lo") + m["at"]).alias("at"), m["n"].alias("n")))
    placed = found.select("text_id", "key", "r1", "r2", "lo").join(marked, ["key", "r1", "r2"]).groupBy("text_id").agg(F.flatten(F.collect_list(moved)).alias("marks"))
    judged = map_rows(
        texts.join(placed, "text_id", "left").select("digest", "packed", "marks"),
        _judge(length, with_text),
        "digest binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start:long,end:long>>",
    )
    return df.select(key, F.unhex(F.md5(bytes_of)).alias("digest")).join(judged, "digest").drop("digest")


def op2_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Query op2: strings of 400 bytes over all documents.

    ``text`` is what is left, as text: U+FFFD stands where a cut went through a character; ``kept_sha256`` is of the bytes.
    """
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=True)
    left = F.make_valid_utf8(F.col("kept").cast("string"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", (F.col("n_removed") > 0).alias("repeats"), left.alias("text"))
