"""Line deduplication by an exact set-similarity join.

A line is the set of its five-word shingles (a shorter line is one token: all its words); words are split at ASCII white space. A line goes
when an earlier line, by (key, text hash, line number), has Jaccard similarity of ``threshold`` or more, equal sets included. Keys that
are not integers are ordered by their hash.

1. Every line gets a 128-bit hash of its token set; lines of equal sets are one class from here on. A task folds its equal
   lines first, so a line that is everywhere comes once from each run; the rest travels as sorted compressed runs, a block for each
   range of hashes. The same pass counts tokens by hash bucket; these counts over all documents, a table of fixed size,
   give the rarity order.
2. Prefix filter: two sets as alike as asked share one of the rarest ``n - ceil(threshold n) + 1`` tokens of each. The prefix
   tokens travel as runs too; tokens of one line only are dropped, and so are tokens whose lines are those of another token.
3. The blocks of lines give the later members of each class, and where the first one lies if its class shares a prefix token.
4. The token sets of these lines are made from their documents. A token's lines are compared, each with earlier ones: in small
   groups by length and by bitmaps that bound how far two sets are apart, many groups at once, in others by prefix, length and
   positional filters; what is left open is verified exactly. A token with more than ``leaf`` lines or ``LEAF_TOKENS`` tokens is
   dealt to parts, and each pair of parts is a group of its own. A group reports classes to remove, never pairs.
5. Lines to remove go back to their documents.

Lines with fewer than four tokens can only match equal sets, so step 2 has none of their tokens. Memory follows the longest line.
Defined cases: null text stays null with no lines; blank lines have no tokens and stay; rows that repeat key and text
count as one document and are treated alike; equal keys with other texts are ordered by the text's hash; null keys come first;
an empty table gives an empty result; extra columns are kept, whatever their names; texts are read whole.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.arrow import map_rows
from kinlink.llm.groups import whole_groups
from kinlink.sources.stash import stash

THRESHOLD = 0.8
SHINGLE = 5
SKETCH_BITS = 16
LEAF = 1000
LEAF_TOKENS = 1 << 19
#: All pairs of a group of so many lines, of up to ``BITMAP`` tokens each, are held against a bound; other groups go through an index.
ALL_PAIRS = 512
BITMAP = 1024
PAIRS = 1 << 15
#: Bytes of a token's hash that travel to the comparison; two given tokens agree in them by chance once in 2 ** 48.
TOKEN_BYTES = 6
RUN = 1 << 19
RUN_LINES = 1 << 18
BLOCK = 1 << 20
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix(x: np.ndarray, factor=_M2) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * factor
    x = (x ^ (x >> np.uint64(29))) * _M1
    return x ^ (x >> np.uint64(32))


_PLACES = np.array([pow(int(_M2), i, 1 << 64) for i in range(SHINGLE)], np.uint64)  # a factor for each place in a shingle
_FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
PIECE = 1 << 19
#: Words of more bytes are hashed one by one.
LONG_WORD = 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where its texts end; null is empty."""
    column = column.fill_null("") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_string(column.type) else np.int32, len(column) + 1, column.offset * (8 if pa.types.is_large_string(column.type) else 4)).astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of each word: runs without ASCII white space, cut at the ends of texts."""
    word = (data - np.uint8(9) > 4) & (data != 32)
    before, after = np.empty_like(word), np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    after[-1], after[:-1] = False, word[1:]
    begins = offsets[:-1][(offsets[:-1] < len(data))]
    before[begins], after[begins[begins > 0] - 1] = False, False
    start = np.flatnonzero(word & ~before)
    size = np.flatnonzero(word & ~after) + 1 - start
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data),), "<u8", padded, strides=(1,))
    h = mix((eight[start] & _FIRST_BYTES[np.minimum(size, 8)]) + size.astype(np.uint64) * _M1, _M3)
    for done in range(8, LONG_WORD, 8):
        more = np.flatnonzero(size > done)
        if not len(more):
            break
        h[more] = mix(h[more] ^ eight[start[more] + done] & _FIRST_BYTES[np.minimum(size[more] - done, 8)], _M3)
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(padded[start[i] : start[i] + size[i]])
    return start, h | np.uint64(1)


class LineTokens:
    """Token sets of the lines of some texts: ``text`` and ``line`` number of each line, its tokens at start:start + n."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
        start, w = word_hashes(data, offsets) if len(data) else (np.empty(0, np.int64), np.empty(0, np.uint64))
        breaks = np.flatnonzero(data == 10)
        begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))  # of lines; no word runs past one
        first = np.searchsorted(start, begin)
        counts = np.diff(first, append=len(start))
        begin, head, counts = begin[counts > 0], first[counts > 0], counts[counts > 0]
        self.text = np.searchsorted(offsets, begin, "right") - 1
        self.line = np.searchsorted(breaks, begin) - np.searchsorted(breaks, offsets[self.text])
        pad = size - 1  # after each line, so that no shingle runs into the next
        padded = np.zeros(len(w) + pad * len(head), np.uint64)
        padded[np.arange(len(w)) + np.repeat(pad * np.arange(len(head)), counts)] = w
        shingles = np.maximum(counts - pad, 1)
        at = np.repeat(head + pad * np.arange(len(head)) - (np.cumsum(shingles) - shingles), shingles) + np.arange(shingles.sum())
        token = padded[: len(padded) - pad] * _PLACES[0]
        for i in range(1, size):
            token += padded[i : len(padded) - pad + i] * _PLACES[i]
        token = mix(token[at], _M3)
        owner = np.repeat(np.arange(len(head)), shingles)
        bits = max(1, len(head).bit_length())
        packed = np.sort(owner.astype(np.uint64) << np.uint64(64 - bits) | token >> np.uint64(bits))
        self.n = shingles
        if (packed[1:] == packed[:-1]).any():  # most pieces have no line with a shingle twice
            token, owner = _sorted_by(token, token, owner)
            keep = np.r_[True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])]
            token, owner = token[keep], owner[keep]
            self.n = np.bincount(owner, minlength=len(head))
        self.token, self.owner = token, owner
        self.start = np.cumsum(self.n) - self.n
        self.k1 = np.add.reduceat(mix(token, _M2), self.start) + self.n.astype(np.uint64) if len(head) else np.empty(0, np.uint64)

    @functools.cached_property
    def k2(self) -> np.ndarray:
        return np.add.reduceat(mix(self.token, _M3), self.start) if len(self.start) else np.empty(0, np.uint64)

    def by_rarity(self, rank: np.ndarray) -> None:
        """Order each line's tokens by the rank of their bucket, then by themselves."""
        key = rank[bucket_of(self.token)] << np.uint64(64 - SKETCH_BITS) | self.token & np.uint64((1 << 64 - SKETCH_BITS) - 1)
        self.token, _ = _sorted_by(key, self.token, self.owner)


def ranks(sketch: np.ndarray) -> np.ndarray:
    """The place of each bucket by its count, then by its number."""
    out = np.empty(len(sketch), np.uint64)
    out[np.argsort(sketch, kind="stable")] = np.arange(len(sketch), dtype=np.uint64)
    return out


def _sorted_by(key: np.ndarray, token: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens by owner and key: one sort of packed words that end in the place, and a full one of what that leaves open."""
    bits, low = (max(1, int(x).bit_length()) for x in ((owner[-1], len(owner)) if len(owner) else (0, 0)))
    places = np.uint64(low)
    packed = np.sort(owner.astype(np.uint64) << np.uint64(64 - bits) | key >> np.uint64(bits + low) << places | np.arange(len(owner), dtype=np.uint64))
    order = (packed & np.uint64((1 << low) - 1)).astype(np.int64)
    packed >>= places
    same = packed[1:] == packed[:-1]
    if same.any():
        open_at = np.flatnonzero(np.r_[same, False] | np.r_[False, same])
        order[open_at] = order[open_at][np.lexsort((key[order[open_at]], packed[open_at]))]
    return token[order], owner[order]


def parts_of(column: pa.Array):
    """(first row, bytes, ends of texts, first line) of pieces of a column, about ``PIECE`` bytes each.

    A text much longer than that is cut at line ends, so that memory follows the longest line, not the longest text.
    """
    data, offsets = text_bytes(column)
    low = 0
    while low < len(column):
        high = min(max(low + 1, int(np.searchsorted(offsets, offsets[low] + PIECE))), len(column))
        at, last, line = int(offsets[low]), int(offsets[high]), 0
        if high > low + 1 or last - at < 4 * PIECE:
            yield low, data[at:last], offsets[low : high + 1] - at, 0
        else:
            while at < last:
                end = min(at + PIECE, last)
                while end < last and data[end - 1] != 10:
                    ahead = np.flatnonzero(data[end : min(end + PIECE, last)] == 10)
                    end = end + int(ahead[0]) + 1 if len(ahead) else min(end + PIECE, last)
                yield low, data[at:end], np.array([0, end - at]), line
                line += int((data[at:end] == 10).sum())
                at = end
        low = high


def bucket_of(token: np.ndarray) -> np.ndarray:
    return (token >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def prefix_length(n: np.ndarray, threshold: float) -> np.ndarray:
    """Tokens of which similar sets share one; none where only equal sets are similar."""
    need = np.ceil(threshold * n - 1e-9).astype(np.int64)
    return np.where(n / (n + 1) >= threshold - 1e-12, n - need + 1, 0)


def _block(values: np.ndarray, blocks: int) -> np.ndarray:
    """The range of hashes that a value lies in."""
    return ((values >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _cuts(values: np.ndarray, blocks: int):
    """(block, low, high) of the stretches of sorted values."""
    block = _block(values, blocks)
    edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])[: len(block)]
    yield from zip(block[edge].tolist(), edge.tolist(), [*edge[1:].tolist(), len(block)])


#: A line's class (k1, k2) and place (ord, h, line).
_LINE = [("k1", "<u8"), ("k2", "<u8"), ("ord", "<i8"), ("h", "<i8"), ("line", "<i4")]


def _pack_lines(lines: np.ndarray) -> bytes:
    """Columns of sorted lines, one after another."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(lines[n]).tobytes() for n, _ in _LINE))


def _open_lines(packed: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(packed)
    n = len(data) // 36
    out, at = np.empty(n, _LINE), 0
    for name, kind in _LINE:
        out[name] = np.frombuffer(data, kind, n, at)
        at += n * np.dtype(kind).itemsize
    return out


def fold_lines(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first line of each class, by class, and all lines that lie elsewhere, by place."""
    lines = lines[np.argsort(lines["k1"], kind="stable")]
    same = lines["k1"][1:] == lines["k1"][:-1]
    several = np.r_[same, False] | np.r_[False, same] if len(lines) else np.empty(0, bool)
    alone, rest = lines[~several], lines[several]
    rest = rest[np.lexsort([rest[n] for n in ("line", "h", "ord", "k2", "k1")])]
    fresh = np.r_[True, (rest["k1"][1:] != rest["k1"][:-1]) | (rest["k2"][1:] != rest["k2"][:-1])][: len(rest)]
    first = rest[fresh][np.cumsum(fresh) - 1]
    later = rest[(rest["line"] != first["line"]) | (rest["h"] != first["h"]) | (rest["ord"] != first["ord"])]
    kept = np.concatenate([alone, rest[fresh]])
    return kept[np.argsort(kept["k1"], kind="stable")], later[np.lexsort([later[n] for n in ("line", "h", "ord")])]


def _by_document(later: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Columns (ord, h, lines) of lines sorted by place."""
    edge = np.flatnonzero(np.r_[True, (later["ord"][1:] != later["ord"][:-1]) | (later["h"][1:] != later["h"][:-1])][: len(later)])
    lists = pa.ListArray.from_arrays(pa.array(np.r_[edge, len(later)].astype(np.int32)), pa.array(np.ascontiguousarray(later["line"])))
    return pa.array(later["ord"][edge]), pa.array(later["h"][edge]), lists


_PASS = "kind int, a long, b long, lines array<int>, run binary"
RUN_OF_LINES, GONE, COUNT = 0, 1, 2


def _rows(kind: int, a, b, lines=None, run=None) -> pa.RecordBatch:
    n = len(a)
    columns = [pa.array(np.full(n, kind, np.int32)), a, b, pa.nulls(n, pa.list_(pa.int32())) if lines is None else lines, pa.nulls(n, pa.binary()) if run is None else run]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "a", "b", "lines", "run"])


def _lines_and_counts(blocks: int):
    """Rows of runs (block, lines of the run), of lines that are not the first of their class here (ord, h, lines), and of counts (bucket, n)."""

    def run(batches):
        sketch, held, n = np.zeros(1 << SKETCH_BITS, np.int64), [], 0

        def flush():
            kept, later = fold_lines(np.concatenate(held))
            for block, low, high in _cuts(kept["k1"], blocks):
                yield _rows(RUN_OF_LINES, pa.array([block], pa.int64()), pa.array([high - low], pa.int64()), run=pa.array([_pack_lines(kept[low:high])], pa.binary()))
            if len(later):
                order, h, lists = _by_document(later)
                yield _rows(GONE, order, h, lines=lists)

        for b in batches:
            order, h = b.column(0).to_numpy(), b.column(1).to_numpy()
            for low, data, offsets, line in parts_of(b.column(2)):
                found = LineTokens(data, offsets)
                sketch += np.bincount(bucket_of(found.token), minlength=len(sketch))
                lines = np.empty(len(found.text), _LINE)
                lines["k1"], lines["k2"], lines["line"] = found.k1, found.k2, found.line + line
                lines["ord"], lines["h"] = order[found.text + low], h[found.text + low]
                held.append(lines)
                n += len(lines)
            if n >= RUN_LINES:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()
        full = np.flatnonzero(sketch)
        if len(full):
            yield _rows(COUNT, pa.array(full), pa.array(sketch[full]))

    return run


def _split_runs(blocks: int):
    """Runs cut for a larger number of blocks."""

    def run(batches):
        for b in batches:
            for packed in b.column(0).to_pylist():
                lines = _open_lines(packed)
                for block, low, high in _cuts(lines["k1"], blocks):
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([_pack_lines(lines[low:high])], pa.binary())], names=["block", "run"])

    return run


_PLACED = "k1 long, k2 long, ord long, h long, lines array<int>"


def _place(runs: pa.Table, wanted: pa.Table) -> pa.Table:
    """Of a block: where the first line of each wanted class lies, and with null classes the lines that are not first."""
    kept, later = fold_lines(np.concatenate([_open_lines(r) for r in runs.column("run").to_pylist()] or [np.empty(0, _LINE)]))
    asked = np.sort(wanted.column("line_key").to_numpy().view(np.uint64))
    at = np.minimum(np.searchsorted(asked, kept["k1"]), max(len(asked) - 1, 0))
    kept = kept[asked[at] == kept["k1"]] if len(asked) else kept[:0]
    order, h, lists = _by_document(later)
    nulls, names = pa.nulls(len(order), pa.int64()), ["k1", "k2", "ord", "h", "lines"]
    first = [pa.array(np.ascontiguousarray(kept[c]).view(np.int64)) for c in names[:4]]
    one = pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1, dtype=np.int32)), pa.array(np.ascontiguousarray(kept["line"])))
    return pa.concat_tables([pa.table([*first, one], names=names), pa.table([nulls, nulls, order, h, lists], names=names)])


def _pack_run(token: np.ndarray, line: np.ndarray) -> bytes:
    """A sorted run: differences of the tokens by byte planes, then the lines."""
    planes = np.diff(token, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes() + line.tobytes())


def _open_run(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(packed)
    n = len(data) // 16
    planes = np.frombuffer(data, np.uint8, 8 * n).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64), np.frombuffer(data, np.uint64, n, 8 * n)


def _prefixes(rank, blocks: int, threshold: float):
    def run(batches):
        tokens, lines, held = [], [], 0

        def flush():
            token, line = np.concatenate(tokens), np.concatenate(lines)
            order = np.argsort(token)
            token, line = token[order], line[order]
            for block, low, high in _cuts(token, blocks):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([_pack_run(token[low:high], line[low:high])], pa.binary())], names=["block", "run"])

        for b in batches:
            for _, data, offsets, _ in parts_of(b.column(0)):
                found = LineTokens(data, offsets)
                found.by_rarity(rank.value)
                p = prefix_length(found.n, threshold)
                at = np.repeat(found.start - (np.cumsum(p) - p), p) + np.arange(p.sum())
                tokens.append(found.token[at])
                lines.append(np.repeat(found.k1, p))
                held += len(at)
            if held >= RUN:
                yield from flush()
                tokens, lines, held = [], [], 0
        if held:
            yield from flush()

    return run


def _postings(table: pa.Table) -> pa.Table:
    """Rows (s1, s2, line): lines of each token that several lines have, s1 and s2 a hash of these lines."""
    runs = [_open_run(r) for r in table.column("run").to_pylist()]
    token, line = (np.concatenate(c) for c in zip(*runs))
    order = np.argsort(token)
    token, line = token[order], line[order]
    again = np.r_[token[1:] == token[:-1], False] if len(token) else np.empty(0, bool)
    again[1:] |= again[:-1].copy()
    token, line = token[again], line[again]  # most tokens are of one line
    order = np.lexsort((line, token))
    token, line = token[order], line[order]
    keep = np.r_[True, (token[1:] != token[:-1]) | (line[1:] != line[:-1])][: len(token)]
    token, line = token[keep], line[keep]
    if not len(token):
        return pa.table({n: pa.array([], pa.int64()) for n in ("s1", "s2", "line_key")})
    start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    size = np.diff(np.r_[start, len(token)])
    s1, s2 = np.add.reduceat(mix(line, _M2), start), np.add.reduceat(mix(line, _M3), start)
    several = np.flatnonzero(size > 1)
    order = several[np.lexsort((s2[several], s1[several]))]
    fresh = order[np.r_[True, (s1[order][1:] != s1[order][:-1]) | (s2[order][1:] != s2[order][:-1])][: len(order)]]
    width = size[fresh]
    at = np.repeat(start[fresh] - (np.cumsum(width) - width), width) + np.arange(width.sum())
    return pa.table({"s1": np.repeat(s1[fresh], width).view(np.int64), "s2": np.repeat(s2[fresh], width).view(np.int64), "line_key": line[at].view(np.int64)})


def _cut_lines(text: bytes, numbers: list[int]) -> list[bytes]:
    """Lines of a text by number."""
    out, at, line = [], 0, 0
    for n in sorted(numbers):
        while line < n:
            at = text.index(b"\n", at) + 1
            line += 1
        end = text.find(b"\n", at)
        out.append(text[at : end if end >= 0 else len(text)])
    return out


def _token_sets(rank):
    """Rows (k1, k2, ord, h, line, n, tokens) of the wanted lines of compressed texts, a piece of lines at a time."""

    def run(batches):
        opened = zstandard.ZstdDecompressor()

        def flush(lines: list[bytes], places: list[tuple]):
            found = LineTokens(np.frombuffer(b"".join(lines), np.uint8), np.cumsum([0, *map(len, lines)]))
            found.by_rarity(rank.value)
            own = [places[i] for i in found.text.tolist()]
            short = np.ascontiguousarray(found.token.view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES])
            sets = [short[s : s + n].tobytes() for s, n in zip(found.start.tolist(), found.n.tolist())]
            longs = [pa.array(found.k1.view(np.int64)), pa.array(found.k2.view(np.int64)), *(pa.array([p[i] for p in own], pa.int64()) for i in (0, 1))]
            return pa.RecordBatch.from_arrays([*longs, pa.array([p[2] for p in own], pa.int32()), pa.array(found.n), pa.array(sets, pa.binary())], names=["k1", "k2", "ord", "h", "line", "n", "tokens"])

        lines, places, held = [], [], 0
        for b in batches:
            for order, h, packed, wanted in zip(*(b.column(i).to_pylist() for i in range(4))):
                numbers = sorted(set(wanted))
                for n, x in zip(numbers, _cut_lines(opened.decompress(packed), numbers)):
                    lines.append(x)
                    places.append((order, h, n))
                    held += len(x)
                    if held >= PIECE:
                        yield flush(lines, places)
                        lines, places, held = [], [], 0
        if lines:
            yield flush(lines, places)

    return run


def similar_to_earlier(sets: list[np.ndarray], threshold: float = THRESHOLD) -> list[int]:
    """Numbers of the sets, in order, that an earlier one resembles; tokens of each are in the common order of rarity."""
    index: dict[int, list[tuple[int, int]]] = {}
    whole: list[np.ndarray] = []
    leaders: list[int] = []
    out = []

    def alike(x: np.ndarray, y: np.ndarray) -> bool:
        n, m = len(x), len(y)
        if min(n, m) < threshold * max(n, m) - 1e-9:
            return False
        both = int((y[np.minimum(np.searchsorted(y, x), m - 1)] == x).sum())
        return both >= threshold * (n + m - both) - 1e-9

    for j, tokens in enumerate(sets):
        own, n = np.sort(tokens), len(tokens)
        match = next((i for i in reversed(leaders) if alike(whole[i], own)), None)
        prefix = tokens[: int(prefix_length(np.array(n), threshold))].tolist()
        if match is None:
            shared: dict[int, int] = {}
            for place, token in enumerate(prefix):
                for i, other in index.get(token, ()):
                    m = len(whole[i])
                    if min(n, m) < threshold * max(n, m) - 1e-9:  # lengths
                        continue
                    had = shared.get(i, 0)
                    need = math.ceil(threshold / (1 + threshold) * (n + m) - 1e-9)
                    if had + 1 + min(n - place - 1, m - other - 1) >= need:  # positions
                        shared[i] = had + 1
            match = next((i for i in sorted(shared) if alike(whole[i], own)), None)
            if match is not None:
                leaders = [*(x for x in leaders if x != match), match][-8:]
        if match is not None:
            out.append(j)
        whole.append(own)
        for place, token in enumerate(prefix):
            index.setdefault(token, []).append((j, place))
    return out


def _open_tokens(packed: np.ndarray) -> np.ndarray:
    out = np.zeros((len(packed) // TOKEN_BYTES, 8), np.uint8)
    out[:, :TOKEN_BYTES] = packed.reshape(-1, TOKEN_BYTES)
    return out.view(np.uint64).ravel()


def _bitmaps(tokens: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each set a bit at its tokens' places; two sets differ in at least as many tokens as bits."""
    out = []
    ends, rows = np.cumsum(n), PAIRS // 8
    for low in range(0, len(n), rows):
        own = n[low : low + rows]
        bits = np.zeros((len(own), BITMAP), bool)
        bits[np.repeat(np.arange(len(own)), own), (tokens[ends[low] - n[low] : ends[low + len(own) - 1]] & np.uint64(BITMAP - 1)).astype(np.int64)] = True
        out.append(np.packbits(bits, axis=1).view(np.uint64))
    return np.concatenate(out)


def _common(tokens: np.ndarray, start: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many tokens the sets of each pair share."""
    out = np.zeros(len(a), np.int64)
    ends = np.cumsum(n[a] + n[b])
    low = 0
    while low < len(a):
        high = min(max(low + 1, int(np.searchsorted(ends, ends[low] + LEAF_TOKENS))), low + PAIRS, len(a))
        sets = np.stack([a[low:high], b[low:high]], axis=1).ravel()
        width = n[sets]
        at = np.repeat(start[sets] - (np.cumsum(width) - width), width) + np.arange(width.sum())
        key = np.sort(np.repeat((np.arange(len(sets)) // 2).astype(np.uint64) << np.uint64(8 * TOKEN_BYTES), width) | tokens[at])
        same = (key[1:][key[1:] == key[:-1]] >> np.uint64(8 * TOKEN_BYTES)).astype(np.int64)
        out[low:high] = np.bincount(same, minlength=high - low)
        low = high
    return out


def similar_by_pairs(tokens: np.ndarray, n: np.ndarray, members: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """What ``similar_to_earlier`` gives, for many small groups at once: whether each set resembles an earlier one of its group.

    ``members`` has the sizes of the groups, ``n`` of the sets. Pairs whose bitmaps differ in more bits than alike sets can differ in
    tokens are not looked at; the others are counted in full, each set's most alike first, until one is alike enough.
    """
    start = np.cumsum(n) - n
    place = np.arange(len(n)) - np.repeat(np.cumsum(members) - members, members)
    maps = _bitmaps(tokens, n)
    begin, kept = np.cumsum(place) - place, []
    low = 0
    while low < len(n):  # all pairs of a set and an earlier one, a bounded number at a time
        high = max(low + 1, int(np.searchsorted(begin, begin[low] + PAIRS)))
        j = np.repeat(np.arange(low, high), place[low:high])
        i = np.arange(len(j)) + begin[low] - begin[j] + j - place[j]
        near = np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9
        i, j = i[near], j[near]
        apart = np.bitwise_count(maps[i] ^ maps[j]).sum(axis=1, dtype=np.int64)
        near = apart <= (n[i] + n[j]) * (1 - threshold) / (1 + threshold) + 1e-6
        kept.append((i[near], j[near], apart[near]))
        low = high
    i, j, apart = (np.concatenate(c) for c in zip(*kept))
    order = np.lexsort((apart, j))
    i, j = i[order], j[order]
    out = np.zeros(len(n), bool)
    while len(j):
        first = np.r_[True, j[1:] != j[:-1]]
        a, b = i[first], j[first]
        both = _common(tokens, start, n, a, b)
        out[b[both >= threshold * (n[a] + n[b] - both) - 1e-9]] = True
        left = ~first & ~out[j]
        i, j = i[left], j[left]
    return out


def _compare(threshold: float, leaf: int):
    def run(batches):
        for table in whole_groups(batches, leaf, most_bytes=2 * TOKEN_BYTES * LEAF_TOKENS):
            group = table.column("grp").to_numpy()
            k1, k2 = (table.column(c).to_numpy() for c in ("k1", "k2"))
            fresh = np.r_[True, (group[1:] != group[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]
            table, group, k1, k2 = table.filter(pa.array(fresh)), group[fresh], k1[fresh], k2[fresh]
            packed, ends = text_bytes(pa.concat_arrays(table.column("tokens").chunks))
            tokens, ends = _open_tokens(packed), ends // TOKEN_BYTES
            edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
            members, n = np.diff(edge), np.diff(ends)
            few = (members <= ALL_PAIRS) & (np.maximum.reduceat(n, edge[:-1]) <= BITMAP)  # longer sets fill their bitmaps
            hit = np.zeros(len(group), bool)
            small = np.repeat(few, members)
            if small.any():
                hit[small] = similar_by_pairs(tokens[np.repeat(small, n)], n[small], members[few], threshold)
            for low, high in zip(edge[:-1][~few].tolist(), edge[1:][~few].tolist()):
                sets = [tokens[ends[i] : ends[i + 1]] for i in range(low, high)]
                hit[low + np.array(similar_to_earlier(sets, threshold), np.int64)] = True
            yield from pa.table({"k1": k1[hit], "k2": k2[hit]}).to_batches()

    return run


def order_of(kind: str, key: str):
    """A long by which documents are ordered: the key, or its hash where it is no integer; null first."""
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    return F.coalesce(F.col(key).cast("long") if whole else F.xxhash64(F.col(key).cast("string")), F.lit(-(2**63)).cast("long"))


def text_hash(key: str, text: str):
    return F.xxhash64(F.col(key).cast("string"), F.col(text))


def _squeeze(names: list[str], text: str):
    """The batch with its text column compressed."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            whole = b.column(b.schema.get_field_index(text))
            whole = whole.cast(pa.large_binary() if pa.types.is_large_string(whole.type) else pa.binary())
            packed = pa.array([None if t is None else press.compress(t) for t in whole.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([packed if n == text else b.column(i) for i, n in enumerate(names)], names=names)

    return run


def repeated_lines(df: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, leaf: int = LEAF) -> DataFrame:
    """Rows (ord, h, removed): the numbers of the lines to remove from the document of this order and text hash."""
    spark = df.sparkSession
    docs = df.select(order_of(df.schema[key].dataType.simpleString(), key).alias("ord"), text_hash(key, text).alias("h"), F.col(text).alias("text")).where("text is not null")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first_pass = stash(map_rows(docs, _lines_and_counts(tasks), _PASS), "lines")
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    counts = first_pass.df.where(F.col("kind") == COUNT).groupBy("a").agg(F.sum("b").alias("n")).collect()  # at most 2 ** SKETCH_BITS rows
    for r in counts:
        sketch[r["a"]] = r["n"]
    blocks = max(tasks, math.ceil(sketch.sum() / 4 / BLOCK))
    shared = spark.sparkContext.broadcast(ranks(sketch))
    runs = map_rows(docs.select("text"), _prefixes(shared, blocks, threshold), "block long, run binary")
    posted = stash(runs.groupBy("block").applyInArrow(_postings, "s1 long, s2 long, line_key long").distinct(), "postings")
    postings = posted.df
    # where the wanted lines lie, and what is not the first of its class
    held = first_pass.df.where(F.col("kind") == RUN_OF_LINES)
    most = held.agg(F.sum("b")).first()[0] or 0
    fine = max(1, math.ceil(most / tasks / BLOCK)) * tasks
    held = held.select(F.col("a").alias("block"), "run") if fine == tasks else held.select("run").mapInArrow(_split_runs(fine), "block long, run binary")
    high = F.shiftrightunsigned("line_key", 32)
    asked = postings.select("line_key").distinct().withColumn("block", F.shiftright(high * F.lit(fine).cast("long"), 32))
    places = stash(held.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(_place, _PLACED), "placed")
    placed = places.df
    here = stash(first_pass.df.where(F.col("kind") == GONE).select(F.col("a").alias("ord"), F.col("b").alias("h"), "lines"), "gone")
    first_pass.drop()
    gone = here.df.unionByName(placed.where("k1 is null").select("ord", "h", "lines"))
    # the token sets of the wanted lines
    wanted = placed.where("k1 is not null").groupBy("ord", "h").agg(F.flatten(F.collect_list("lines")).alias("wanted"))  # a document's lines at most
    packed = map_rows(docs, _squeeze(["ord", "h", "text"], "text"), "ord long, h long, text binary")
    sets = packed.join(wanted, ["ord", "h"]).select("ord", "h", "text", "wanted").mapInArrow(_token_sets(shared), "k1 long, k2 long, ord long, h long, line int, n long, tokens binary")
    found = stash(sets, "sets")  # a repeated row gives its lines again, which the comparison passes over
    sets = found.df
    member = postings.join(sets.groupBy("k1", "k2").agg(F.max("n").alias("n")), F.col("line_key") == F.col("k1")).drop("line_key")
    parts = F.greatest(F.ceil(F.count("*") / leaf), F.ceil(F.sum("n") / LEAF_TOKENS)).cast("int")
    sized = member.groupBy("s1", "s2").agg(parts.alias("parts"), F.count("*").alias("members")).where("members > 1").drop("members")
    member = member.drop("n").join(sized, ["s1", "s2"]).withColumn("own", F.pmod(F.xxhash64("k1", "k2"), F.col("parts")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.least(p, F.col("own")).alias("t"), F.greatest(p, F.col("own")).alias("q")))
    grouped = member.withColumn("x", F.explode(others)).select("k1", "k2", F.xxhash64("s1", "s2", "x.t", "x.q").alias("grp")).join(sets, ["k1", "k2"])
    near = grouped.repartition(tasks, "grp").sortWithinPartitions("grp", "ord", "h", "line").select("grp", "k1", "k2", "tokens").mapInArrow(_compare(threshold, 4 * leaf), "k1 long, k2 long").distinct()
    near = stash(near, "near")
    found.drop()
    posted.drop()
    first = placed.where("k1 is not null").join(near.df, ["k1", "k2"], "left_semi").select("ord", "h", "lines")
    out = stash(gone.unionByName(first).groupBy("ord", "h").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("removed")), "removed").df
    for done in (near, places, here):
        done.drop()
    return out


def _finish(text: str, names: list[str], at: dict[str, str]):
    """Batches of ``names``; ``at`` holds the joined columns' names of the packed text and the removed lines."""

    def run(batches):
        opened = zstandard.ZstdDecompressor()
        for b in batches:
            removed = b.column(b.schema.get_field_index(at["removed"])).to_pylist()
            total, gone, out = [], [], []
            for packed, r in zip(b.column(b.schema.get_field_index(at["text"])).to_pylist(), removed):
                data = None if packed is None else opened.decompress(packed)
                r = set(r or ())
                total.append(data.count(b"\n") + 1 if data else 0)
                gone.append(len(r))
                out.append(b"\n".join(x for i, x in enumerate(data.split(b"\n")) if i not in r) if r else data)
            columns = {text: pa.array(out, pa.binary()).view(pa.string()), "n_lines": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[n] if n == text else b.column(i) for i, n in enumerate(names)] + [columns["n_lines"], columns["n_removed"]], names=[*names, "n_lines", "n_removed"])

    return run


def deduplicate(df: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, leaf: int = LEAF) -> DataFrame:
    """All columns of ``df``, the text without the removed lines, and n_lines and n_removed (replacing columns so named)."""
    gone = repeated_lines(df, text, key, threshold, leaf)
    df = df.drop("n_lines", "n_removed")
    names = df.columns
    # numbered names while rows are joined, so that no column of the table can clash
    plain = {c: f"c{i}" for i, c in enumerate(names)}
    held = df.select(*(F.col(f"`{c}`").alias(p) for c, p in plain.items()))
    kinds = {p: held.schema[p].dataType.simpleString() for p in plain.values()}
    numbered = held.withColumn("ord", order_of(kinds[plain[key]], plain[key])).withColumn("h", text_hash(plain[key], plain[text]))
    own = plain[text]
    packed = map_rows(numbered, _squeeze(numbered.columns, own), ", ".join(f"{c} {'binary' if c == own else numbered.schema[c].dataType.simpleString()}" for c in numbered.columns))
    joined = packed.join(gone, ["ord", "h"], "left").select(*plain.values(), "removed")
    kinds = ", ".join(f"{p} {k}" for p, k in kinds.items()) + ", n_lines long, n_removed long"
    out = joined.mapInArrow(_finish(own, list(plain.values()), {"text": own, "removed": "removed"}), kinds)
    return out.select(*(F.col(p).alias(c) for c, p in plain.items()), "n_lines", "n_removed")


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Query op8: lines of all documents; what is left of each text is stated by its hash."""
    found = deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
