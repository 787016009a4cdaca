"""Motion-JPEG clips in AVI files as a column.

Files that are written here hold intra-coded lossless JPEG (process 14: one component, 8 bits, predictor 1), each frame alone in a ``00dc`` chunk,
and an ``idx1`` index. The writer's Huffman table gives every category s a code of 9 - s bits, so that a
code and its s extra bits always take 9 bits; such frames are read at once. The reader also takes sequential DCT frames (baseline
and extended, 8 bits), as cameras write them, lossless frames of any predictor and table, several interleaved components, restart intervals
of DCT frames, and OpenDML indexes; a frame is its first component, which is the luma. Frames without Huffman tables need
``dht``, the tables' segment.

Shots: each frame's histogram is compared with the one before it; a cut lies where the difference exceeds the mean
of the differences in the window before it by ``factor`` standard deviations, and by ``floor`` at least.

Defined cases: a null medium gives no clips; a medium that is damaged, cut short, or of a kind that is not read gives one
row with the reason in ``error`` and nulls; a file without frames gives no clips; without a frame rate the times are null; null and empty
texts become one frame of blanks; a file without an index is walked chunk by chunk; equal payloads give equal files and rows
that repeat give equal rows; an empty table gives an empty result; extra columns are ignored; files are read whole, and a text
takes about 30 bytes of memory a byte while its file is made.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinlink.llm.arrow import map_rows

WIDTH, HEIGHT, FPS = 16, 12, 25
BINS = 16
HISTORY = 8
FACTOR = 2.0
FLOOR = 0.25

#: Huffman code of category s: s ones... see _codes(); the table's lengths by category, as the file states them.
_LENGTHS = [9 - s for s in range(9)]


def _canonical(lengths: list[int], symbols: list[int]) -> dict[int, tuple[int, int]]:
    """Code and length by symbol; ``lengths`` ascending, as a DHT segment lists them."""
    out, code, last = {}, 0, 0
    for length, symbol in zip(lengths, symbols):
        code <<= length - last if last else 0
        out[symbol] = (code, length)
        code, last = code + 1, length
    return out


def _dht(symbols: list[int], lengths: list[int]) -> bytes:
    counts = bytes(lengths.count(i) for i in range(1, 17))
    body = b"\x00" + counts + bytes(symbols)
    return b"\xff\xc4" + struct.pack(">H", 2 + len(body)) + body


_SYMBOLS = sorted(range(9), key=lambda s: _LENGTHS[s])
_CODES = _canonical([_LENGTHS[s] for s in _SYMBOLS], _SYMBOLS)


def _word_table() -> np.ndarray:
    """The 9 bits of each difference from -255 to 255."""
    out = np.zeros(511, np.uint16)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        extra = d if d > 0 else d + (1 << s) - 1
        out[d + 255] = _CODES[s][0] << s | extra
    return out


_WORDS = _word_table()
_DIFFERENCES = np.zeros(512, np.int16)
_DIFFERENCES[_WORDS] = np.arange(-255, 256)


def _head(width: int, height: int) -> bytes:
    frame = b"\xff\xc3" + struct.pack(">HBHHB", 11, 8, height, width, 1) + b"\x01\x11\x00"
    scan = b"\xff\xda" + struct.pack(">HB", 8, 1) + b"\x01\x00" + b"\x01\x00\x00"
    return b"\xff\xd8" + frame + _dht(_SYMBOLS, [_LENGTHS[s] for s in _SYMBOLS]) + scan


def encode_frames(frames: np.ndarray) -> list[bytes]:
    """Lossless JPEG files of frames (n, height, width) of bytes."""
    n, height, width = frames.shape
    x = frames.astype(np.int16)
    apart = np.empty_like(x)
    apart[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
    apart[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
    apart[:, 0, 0] = x[:, 0, 0] - 128
    words = _WORDS[(apart + 255).reshape(n, -1)]
    samples = words.shape[1]
    short = -samples % 8
    if short:  # the scan is filled up with ones
        words = np.concatenate([words, np.full((n, short), 511, np.uint16)], axis=1)
    w = words.reshape(n, -1, 8)
    packed = np.empty((n, w.shape[1], 9), np.uint8)
    packed[:, :, 0] = w[:, :, 0] >> 1
    for i in range(1, 8):
        packed[:, :, i] = (w[:, :, i - 1] << (8 - i)) & 255 | w[:, :, i] >> (i + 1)
    packed[:, :, 8] = w[:, :, 7] & 255
    packed = np.ascontiguousarray(packed.reshape(n, -1)[:, : (samples * 9 + 7) // 8])
    head, size, flat = _head(width, height), packed.shape[1], packed.ravel()
    full = np.flatnonzero(flat == 255)
    stuffed = np.insert(flat, full + 1, 0).tobytes()
    ends = np.arange(1, n + 1) * size
    ends = (ends + np.searchsorted(full, ends)).tolist()
    return [head + stuffed[a:b] + b"\xff\xd9" for a, b in zip([0, *ends[:-1]], ends)]


class Head:
    """What the segments before a frame's scan say. ``at``: where the scan begins."""

    def __init__(self, data: bytes, dht: bytes = b""):
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG frame")
        self.process, self.width, self.height, self.restart = 0, 0, 0, 0
        self.components: list[tuple[int, int, int, int]] = []  # id, sampling across, down, quantization table
        self.codes: dict[int, dict[int, tuple[int, int]]] = {}
        self.steps: dict[int, np.ndarray] = {}
        self.scan: list[tuple[int, int]] = []  # number of the component, its tables
        self.first = self.shift = 0
        self._tables(dht)
        at = 2
        while True:
            if at + 4 > len(data) or data[at] != 0xFF:
                raise ValueError("the frame ends before its scan")
            marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            body = data[at + 4 : at + 2 + size]
            if marker in (0xC0, 0xC1, 0xC3):
                precision, self.height, self.width, n = struct.unpack(">BHHB", body[:6])
                if precision != 8 or not self.height or not self.width:
                    raise ValueError("only 8-bit frames of stated size are read")
                self.process = marker
                self.components = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                raise ValueError(f"JPEG process {marker:#x} is not read")
            elif marker == 0xC4:
                self._tables(body)
            elif marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.steps[body[0] & 15] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, 1).astype(np.float64)
                    body = body[1 + 64 * (1 + wide) :]
            elif marker == 0xDD:
                self.restart = int.from_bytes(body[:2], "big")
            elif marker == 0xDA:
                ids = [c[0] for c in self.components]
                self.scan = [(ids.index(body[1 + 2 * i]), body[2 + 2 * i]) for i in range(body[0])]
                self.first, self.shift = body[1 + 2 * body[0]], body[3 + 2 * body[0]] & 15
                self.at = at + 2 + size
                break
            at += 2 + size
        if not self.process or not self.scan or self.scan[0][0] != 0 or len(self.scan) != len(self.components):
            raise ValueError("only frames of one interleaved scan are read")

    def _tables(self, body: bytes) -> None:
        while body:
            counts = body[1:17]
            lengths = [i + 1 for i, c in enumerate(counts) for _ in range(c)]
            self.codes[body[0]] = _canonical(lengths, list(body[17 : 17 + len(lengths)]))
            body = body[17 + len(lengths) :]

    def lookup(self, table: int) -> tuple[list[int], list[int]]:
        """Symbol and code length for each 16-bit prefix."""
        if table not in self.codes:
            raise ValueError("a Huffman table is missing")
        symbol, length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        for s, (code, n) in self.codes[table].items():
            low = code << (16 - n)
            symbol[low : low + (1 << (16 - n))], length[low : low + (1 << (16 - n))] = s, n
        return symbol.tolist(), length.tolist()


class Bits:
    """Bits of a scan, stuffed zeros removed; beyond the end there are ones."""

    def __init__(self, data: bytes):
        self.data, self.at, self.held, self.left = data, 0, 0, 0

    def fill(self) -> None:
        more = self.data[self.at : self.at + 8]
        if not more and self.at > len(self.data) + 64:
            raise ValueError("the scan ends early")
        self.at += 8
        self.held = (self.held & ((1 << self.left) - 1)) << 64 | int.from_bytes(more.ljust(8, b"\xff"), "big")
        self.left += 64

    def symbol(self, lookup: tuple[list[int], list[int]]) -> int:
        if self.left < 16:
            self.fill()
        prefix = self.held >> (self.left - 16) & 0xFFFF
        n = lookup[1][prefix]
        if not n:
            raise ValueError("the scan holds a code that no table has")
        self.left -= n
        return lookup[0][prefix]

    def extra(self, n: int) -> int:
        """A signed difference of category n."""
        if not n:
            return 0
        if self.left < n:
            self.fill()
        self.left -= n
        value = self.held >> self.left & ((1 << n) - 1)
        return value if value >> (n - 1) else value - (1 << n) + 1


def _stretches(scan: bytes) -> list[bytes]:
    """The scan between its restart markers, without stuffed zeros; it ends at any other marker."""
    out, at, begin = [], 0, 0
    while True:
        at = scan.find(b"\xff", at)
        after = scan[at + 1 : at + 2] if at >= 0 else b""
        if at < 0 or not after or not (after == b"\x00" or 0xD0 <= after[0] <= 0xD7 or after == b"\xff"):
            out.append(scan[begin : at if at >= 0 else len(scan)])
            return [x.replace(b"\xff\x00", b"\xff") for x in out]
        if 0xD0 <= after[0] <= 0xD7:
            out.append(scan[begin:at])
            begin = at + 2
        at += 1 if after == b"\xff" else 2


def _undo(apart: np.ndarray, predictor: int, shift: int = 0) -> np.ndarray:
    """Samples of (n, height, width) differences."""
    x = apart.astype(np.int64)
    _, height, width = x.shape
    x[:, 0, 0] += 1 << (7 - shift)
    if predictor == 1:
        x[:, :, 0] = np.cumsum(x[:, :, 0], axis=1)
        x = np.cumsum(x, axis=2)
    elif predictor == 2:
        x[:, 0, :] = np.cumsum(x[:, 0, :], axis=1)
        x = np.cumsum(x, axis=1)
    elif 3 <= predictor <= 7:
        x[:, 0, :] = np.cumsum(x[:, 0, :], axis=1) & 0xFFFF
        for r in range(1, height):
            x[:, r, 0] = x[:, r, 0] + x[:, r - 1, 0] & 0xFFFF
            for c in range(1, width):
                left, up, corner = x[:, r, c - 1], x[:, r - 1, c], x[:, r - 1, c - 1]
                guess = {3: corner, 4: left + up - corner, 5: left + (up - corner >> 1), 6: up + (left - corner >> 1), 7: left + up >> 1}[predictor]
                x[:, r, c] = x[:, r, c] + guess & 0xFFFF
    else:
        raise ValueError(f"predictor {predictor} is not known")
    return (x << shift & 255).astype(np.uint8)


def _lossless(head: Head, scan: bytes) -> np.ndarray:
    """The first component of a lossless frame, any Huffman tables."""
    if head.restart or any(c[1:3] != head.components[0][1:3] for c in head.components):
        raise ValueError("lossless frames with restarts or subsampled components are not read")
    bits, tables = Bits(_stretches(scan)[0]), [head.lookup(t >> 4) for _, t in head.scan]
    out = np.empty(head.width * head.height, np.int64)
    for i in range(len(out)):
        for c, table in enumerate(tables):
            n = bits.symbol(table)
            value = 32768 if n == 16 else bits.extra(n)
            if not c:
                out[i] = value
    return _undo(out.reshape(1, head.height, head.width), head.first, head.shift)[0]


def _zigzag() -> np.ndarray:
    """Places in a block, row by row, of the coefficients in the order of a scan."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([8 * r + c for r, c in cells])


_WAVES = np.cos((2 * np.arange(8)[None, :] + 1) * np.arange(8)[:, None] * np.pi / 16) * np.where(np.arange(8) == 0, 8**-0.5, 0.5)[:, None]


def _dct(head: Head, scan: bytes) -> np.ndarray:
    """The first component of a sequential DCT frame."""
    across, down = max(c[1] for c in head.components), max(c[2] for c in head.components)
    alone = len(head.components) == 1
    own = [(1, 1) if alone else c[1:3] for c in head.components]
    unit_w, unit_h = (8, 8) if alone else (8 * across, 8 * down)
    cols, rows = -(-head.width // unit_w), -(-head.height // unit_h)
    tables = {t: head.lookup(t) for _, both in head.scan for t in (both >> 4, 16 | both & 15)}
    stretches = _stretches(scan)
    each = head.restart or cols * rows
    wide, high = own[0]
    blocks = np.zeros((rows * high, cols * wide, 64))
    order = _zigzag().tolist()
    for unit in range(cols * rows):
        if unit % each == 0:
            if unit // each >= len(stretches):
                raise ValueError("the scan ends early")
            bits, before = Bits(stretches[unit // each]), [0] * len(own)
        for c, both in head.scan:
            dc, ac = tables[both >> 4], tables[16 | both & 15]
            for k in range(own[c][0] * own[c][1]):
                before[c] += bits.extra(bits.symbol(dc))
                block = blocks[unit // cols * high + k // wide, unit % cols * wide + k % wide] if not c else None
                if block is not None:
                    block[0] = before[c]
                at = 1
                while at < 64:
                    both_of = bits.symbol(ac)
                    run, n = both_of >> 4, both_of & 15
                    if not n:
                        if run < 15:
                            break
                        at += 16
                        continue
                    at += run
                    value = bits.extra(n)
                    if at > 63:
                        raise ValueError("a block has too many coefficients")
                    if block is not None:
                        block[order[at]] = value
                    at += 1
    steps = np.empty(64)
    if head.components[0][3] not in head.steps:
        raise ValueError("a quantization table is missing")
    steps[order] = head.steps[head.components[0][3]]
    x = (blocks * steps).reshape(*blocks.shape[:2], 8, 8)
    levels = np.einsum("ki,abkl,lj->abij", _WAVES, x, _WAVES) + 128
    image = np.clip(np.rint(levels), 0, 255).astype(np.uint8).transpose(0, 2, 1, 3).reshape(8 * blocks.shape[0], 8 * blocks.shape[1])
    if not alone:
        image = np.repeat(np.repeat(image, down // high, axis=0), across // wide, axis=1)
    return image[: head.height, : head.width]


def decode_frame(data: bytes, dht: bytes = b"") -> np.ndarray:
    """The first component (height, width) of one JPEG frame."""
    head = Head(data, dht)
    return (_lossless if head.process == 0xC3 else _dct)(head, data[head.at :])


def decode_frames(files: list[bytes], dht: bytes = b"") -> np.ndarray:
    """Frames (n, height, width) of JPEG files of one size."""
    if not files:
        return np.empty((0, 0, 0), np.uint8)
    head = Head(files[0], dht)
    width, height, at, samples = head.width, head.height, head.at, head.width * head.height
    plain = head.process == 0xC3 and len(head.scan) == 1 and head.codes.get(head.scan[0][1] >> 4) == _CODES and head.first == 1 and not head.shift and not head.restart
    size = (samples * 9 + 7) // 8
    scans = [f[at:-2].replace(b"\xff\x00", b"\xff") for f in files] if plain and all(f.startswith(files[0][:at]) for f in files) else []
    if not scans or any(len(x) != size for x in scans):
        out = [decode_frame(f, dht) for f in files]
        if len({x.shape for x in out}) > 1:
            raise ValueError("the frames differ in size")
        return np.stack(out)
    packed = np.frombuffer(b"".join(scans), np.uint8).reshape(len(files), size)
    short = -size % 9
    if short:
        packed = np.concatenate([packed, np.full((len(files), short), 255, np.uint8)], axis=1)
    p = packed.reshape(len(files), -1, 9).astype(np.uint16)
    words = np.empty((len(files), p.shape[1], 8), np.uint16)
    for i in range(8):
        words[:, :, i] = (p[:, :, i] << (i + 1) | p[:, :, i + 1] >> (7 - i)) & 511
    apart = _DIFFERENCES[words.reshape(len(files), -1)[:, :samples]].reshape(len(files), height, width)
    return _undo(apart, 1)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\x00" * (len(body) & 1)


def write_avi(frames: np.ndarray, fps: int = FPS) -> bytes:
    """An AVI file of motion JPEG with an idx1 index."""
    n, height, width = frames.shape
    files = encode_frames(frames)
    most = max(map(len, files), default=0)
    avih = struct.pack("<14I", 1_000_000 // fps, most * fps, 0, 0x10, n, 0, 1, most, width, height, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIIIHHHH", 0, 0, 0, 0, 1, fps, 0, n, most, 0xFFFFFFFF, 0, 0, 0, width, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 8, b"MJPG", width * height, 0, 0, 0, 0)
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    pack, parts = struct.Struct("<4sI").pack, [b"movi"]
    for f in files:
        parts += (pack(b"00dc", len(f)), f, b"\x00" * (len(f) & 1))
    size = np.array([len(f) for f in files], np.uint32)
    index = np.zeros((n, 4), "<u4")
    index[:, 0], index[:, 1], index[:, 3] = int.from_bytes(b"00dc", "little"), 0x10, size
    step = 8 + size + (size & 1)
    index[:, 2] = 4 + np.cumsum(step) - step
    body = b"AVI " + hdrl + _chunk(b"LIST", b"".join(parts)) + _chunk(b"idx1", index.tobytes())
    return _chunk(b"RIFF", body)


def _dml_frames(data: bytes, at: int) -> list[tuple[int, int]]:
    """(offset, size) of the frames of an OpenDML index: of a list of chunks, or of a list of such lists."""
    kind, n = data[at + 11], int.from_bytes(data[at + 12 : at + 16], "little")
    if kind == 1:
        base = int.from_bytes(data[at + 20 : at + 28], "little")
        rows = np.frombuffer(data[at + 32 : at + 32 + 8 * n], "<u4").reshape(-1, 2).astype(np.int64)
        return [(base + a, size & 0x7FFFFFFF) for a, size in rows.tolist()]
    lists = [int.from_bytes(data[i : i + 8], "little") for i in range(at + 32, at + 32 + 16 * n, 16)]
    return [x for i in lists if data[i + 11 : i + 12] == b"\x01" for x in _dml_frames(data, i)]


def parse_avi(data: bytes) -> dict:
    """Width, height, frames a second and (offset, size) of each video frame, from the index where there is one."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    out = {"width": 0, "height": 0, "fps": 0.0, "frames": []}
    movi, index, video = (0, 0), b"", False
    dml: list[tuple[int, int]] = []

    def walk(at: int, end: int) -> None:
        nonlocal movi, index, video
        while at + 8 <= end:
            name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
            if name == b"LIST":
                if data[at + 8 : at + 12] == b"movi" and not movi[1]:
                    movi = (at + 8, at + 8 + size)
                else:
                    walk(at + 12, at + 8 + size)
            elif name == b"avih" and at + 48 <= end:
                out["width"], out["height"] = struct.unpack("<2I", data[at + 40 : at + 48])
                span = int.from_bytes(data[at + 8 : at + 12], "little")
                out["fps"] = out["fps"] or (1e6 / span if span else 0.0)
            elif name == b"strh":
                video = data[at + 8 : at + 12] == b"vids"
                if video and at + 36 <= end:
                    scale, rate = struct.unpack("<2I", data[at + 28 : at + 36])
                    out["fps"] = rate / scale if scale and rate else out["fps"]
            elif name == b"indx" and video:
                dml.extend(_dml_frames(data, at))
            elif name == b"idx1":
                index = data[at + 8 : at + 8 + size]
            at += 8 + size + (size & 1)

    walk(12, min(len(data), 8 + int.from_bytes(data[4:8], "little")))
    if dml:
        out["frames"] = dml
    elif index:
        rows = np.frombuffer(index[: len(index) // 16 * 16], "<u4").reshape(-1, 4)
        rows = rows[(rows[:, 0] >> 16 & 0xFFFF) == int.from_bytes(b"dc", "little")]
        # offsets count from the movi list's name, in some files from the file's start
        base = movi[0] if not len(rows) or rows[0, 2] < movi[0] else 0
        out["frames"] = list(zip((rows[:, 2].astype(np.int64) + base + 8).tolist(), rows[:, 3].tolist()))
    else:
        at = movi[0] + 4
        while at + 8 <= min(movi[1], len(data)):
            size = int.from_bytes(data[at + 4 : at + 8], "little")
            if data[at + 2 : at + 4] == b"dc":
                out["frames"].append((at + 8, size))
            at += 8 + size + (size & 1)
    return out


def read_avi(data: bytes, dht: bytes = b"") -> tuple[np.ndarray, float]:
    """Decoded frames and frames a second; what cannot be read raises a ``ValueError``."""
    try:
        found = parse_avi(data)
        if any(a + n > len(data) for a, n in found["frames"]):
            raise ValueError("the file is cut short")
        return decode_frames([data[a : a + n] for a, n in found["frames"]], dht), found["fps"]
    except (struct.error, IndexError, KeyError) as error:
        raise ValueError(f"a damaged file: {error}") from error


def histogram_differences(frames: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Half the L1 distance, between 0 and 1, of each frame's histogram and the one before it; the first has 0."""
    n = len(frames)
    if not n:
        return np.empty(0)
    flat = frames.reshape(n, -1)
    level = (flat.astype(np.int64) * bins >> 8) + np.arange(n)[:, None] * bins
    counts = np.bincount(level.ravel(), minlength=n * bins).reshape(n, bins) / flat.shape[1]
    return np.r_[0.0, np.abs(np.diff(counts, axis=0)).sum(axis=1) / 2]


def shots(frames: np.ndarray, history: int = HISTORY, factor: float = FACTOR, floor: float = FLOOR) -> list[tuple[int, int]]:
    """Shots as (first frame, end frame)."""
    apart = histogram_differences(frames)
    n = len(apart)
    if not n:
        return []
    total, square = np.r_[0.0, np.cumsum(apart)], np.r_[0.0, np.cumsum(apart * apart)]
    at = np.arange(n)
    low = np.maximum(at - history, np.minimum(at, 1))
    seen = np.maximum(at - low, 1)
    mean = (total[at] - total[low]) / seen
    spread = np.sqrt(np.maximum((square[at] - square[low]) / seen - mean * mean, 0))
    cut = np.flatnonzero(apart > np.maximum(mean + factor * spread, floor)).tolist()
    edges = [0, *(c for c in cut if c), n]
    return list(zip(edges, edges[1:]))


def clips(df: DataFrame, media: str = "media", key: str = "doc_id", dht: bytes = b"") -> DataFrame:
    """Timed clip rows (key, clip, start_s, end_s, first_frame, n_frames, mean_level, error) of an AVI column."""

    def run(batches):
        for b in batches:
            out = []
            for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if data is None:
                    continue
                try:
                    frames, fps = read_avi(data, dht)
                except ValueError as error:
                    out.append((k, *(None,) * 6, str(error)))
                    continue
                for i, (low, high) in enumerate(shots(frames)):
                    out.append((k, i, low / fps if fps else None, high / fps if fps else None, low, high - low, float(frames[low:high].mean()), None))
            if out:
                types = (b.schema.field(0).type, pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[key, "clip", "start_s", "end_s", "first_frame", "n_frames", "mean_level", "error"])

    kind = df.schema[key].dataType.simpleString()
    return map_rows(df.select(key, media), run, f"`{key}` {kind}, clip int, start_s double, end_s double, first_frame int, n_frames int, mean_level double, error string")


def payload(text: str | None, unit: int = WIDTH * HEIGHT) -> tuple[bytes, int]:
    """UTF-8 bytes of a text, blanks appended up to a positive multiple of ``unit``, and the length before that."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data.ljust(max(1, -(-len(data) // unit)) * unit, b" "), len(data)


def to_media(text: str | None) -> bytes:
    """A text's payload as an AVI file, a byte a sample."""
    data, _ = payload(text)
    return write_avi(np.frombuffer(data, np.uint8).reshape(-1, HEIGHT, WIDTH))


def media_column(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, media): each whole text as an AVI file."""

    def run(batches):
        for b in batches:
            for k, t in zip(b.column(0), b.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array([k.as_py()], b.schema.field(0).type), pa.array([to_media(t)], pa.binary())], names=[key, "media"])

    return map_rows(df.select(key, text), run, f"`{key}` {df.schema[key].dataType.simpleString()}, media binary")


def digest(text: str | None) -> tuple:
    """What the query states of a text: its file is written, read back and described."""
    _, n = payload(text)
    media = to_media(text)
    frames, fps = read_avi(media)
    stored = frames.tobytes()
    found = shots(frames)
    longest = max(z - a for a, z in found)
    feature = f"frames={len(frames)};clips={len(found)};longest_s={longest / fps:.2f};mean={frames.mean():.3f};shift={histogram_differences(frames).mean():.4f}"
    return n, len(stored), hashlib.sha256(stored).hexdigest(), zlib.crc32(stored[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature, len(found)


def describe(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_clips"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches):
        for b in batches:
            out = [digest(t) for t in b.column(1).to_pylist()]
            columns = zip(*out) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=[key, *names])

    kinds = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in zip(names, types))
    return map_rows(df.select(key, text), run, f"`{key}` {df.schema[key].dataType.simpleString()}, {kinds}")


def op3_avi_media(spark, sf_dir: str) -> DataFrame:
    """Query op3: each document as a motion-JPEG AVI file, read back."""
    return describe(spark.read.parquet(f"{sf_dir}/documents.parquet"))
