"""Bounded-space online packing of token sequences.

Each partition keeps at most ``open_windows`` windows open. A document's tokens are cut into full windows and a
remainder; the remainder goes to the open window that it fits best. When it fits none and no window may be opened,
the fullest is topped up with the head of the remainder and emitted. At the end of a partition the open windows are
merged, the emptiest filling the fullest, so that one partial window is left; these leftovers, at most
one a partition, are merged in groups of ``merge`` partitions, and what is then left is cut at powers of two.

Defined cases: a null or empty text is the single end id; repeated rows are packed once each; null keys are kept;
an empty table gives no pieces; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.arrow import map_rows
from kinlink.sources.stash import stash

WINDOW = 4096
OPEN = 64
LEAST_CUT = 16
MERGE = 64
END_ID = 2
CACHE = 400_000
PIECE = 4 << 20
GROUPS_FROM = 1 << 30


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, else the next from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


def _letters_and_numbers(end: int) -> tuple[str, str]:
    kinds = [unicodedata.category(chr(c))[0] for c in range(end)]
    return tuple("".join(chr(c) for c in range(end) if kinds[c] == k) for k in "LN")


class WordTokenizer:
    """Ids of whole texts, with the ids of words kept.

    A tokenizer that composes, folds white space, lower-cases and then splits at ``WORDS`` treats each word alone. For texts of
    Latin letters, where composing changes nothing, the same split is made here, and only words that are not known are
    encoded. Other texts, and other tokenizers, go through the tokenizer whole. Known words are kept in two
    generations of at most ``CACHE`` each; the older is dropped when the younger is full.
    """

    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    LATIN_END = 0x180

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            stated = json.load(f)
        steps = [n["type"] for n in (stated["normalizer"] or {}).get("normalizers", [])]
        splits = (stated["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.alone = steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in splits] == ["Split", "ByteLevel"] and splits[0]["pattern"] == {"Regex": self.WORDS}
        self.special = [t["content"] for t in stated.get("added_tokens", [])]
        letters, numbers = _letters_and_numbers(self.LATIN_END)
        self.words = re.compile(self.WORDS.replace(r"\p{L}", re.escape(letters)).replace(r"\p{N}", re.escape(numbers)))
        self.other = re.compile(f"[^\t-\r -~\xa0-{chr(self.LATIN_END - 1)}]")
        self.byte_letters = _byte_letters()

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for text in texts:
            if not text:
                yield b""
            elif not self.alone or self.other.search(text) or any(t in text for t in self.special):
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                parts, at = [], 0
                while at < len(text):
                    end = text.find(" ", at + PIECE)
                    end = len(text) if end < 0 else end
                    parts.append(self._plain(text[at:end]))
                    at = end
                yield b"".join(parts)

    def _plain(self, text: str) -> bytes:
        words = self.words.findall(text.lower())
        try:
            return b"".join(map(self.young.__getitem__, words))
        except KeyError:
            return b"".join(map(self._word, words))

    def _word(self, word: str) -> bytes:
        found = self.young.get(word)
        if found is None:
            found = self.old.get(word)
            if found is None:
                spelt = "".join(map(self.byte_letters.__getitem__, word.encode()))
                found = np.array([t.id for t in self.tokenizer.model.tokenize(spelt)], "<u4").tobytes()
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[word] = found
        return found


@functools.cache
def tokenizer_at(path: str) -> WordTokenizer:
    """One tokenizer a worker, so that tasks share its known words."""
    return WordTokenizer(path)


def _u32(n: int) -> bytes:
    return n.to_bytes(4, "little")


class Packer:
    """Packs pieces (key, start, ids, tokens of the document) into windows of ``size`` ids."""

    def __init__(self, size: int, most_open: int, first_id: int):
        self.size, self.most, self.next_id = size, most_open, first_id
        self.open: list[list] = []  # [filled, pieces]

    def _emit(self, pieces: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for key, start, ids, total in pieces:
            n = len(ids) // 4
            out.append((key, start, n, zlib.crc32(ids), total, self.next_id, offset, None))
            offset += n
        self.next_id += 1
        return out

    def add(self, key, ids: bytes) -> Iterator[tuple]:
        """Rows of the windows that are emitted while this document is placed."""
        total, start, step = len(ids) // 4, 0, 4 * self.size
        while total - start >= self.size:
            yield from self._emit([(key, start, ids[4 * start : 4 * start + step], total)])
            start += self.size
        while start < total:
            rest = total - start
            fits = [w for w in self.open if w[0] + rest <= self.size]
            if fits:
                best = max(fits, key=lambda w: w[0])
            elif len(self.open) < self.most:
                best = [0, []]
                self.open.append(best)
            else:
                full = max(self.open, key=lambda w: w[0])
                gap = self.size - full[0]
                if gap >= LEAST_CUT:
                    full[1].append((key, start, ids[4 * start : 4 * (start + gap)], total))
                    start += gap
                self.open.remove(full)
                yield from self._emit(full[1])
                continue
            best[0] += rest
            best[1].append((key, start, ids[4 * start :], total))
            start = total
            if best[0] == self.size:
                self.open.remove(best)
                yield from self._emit(best[1])

    def merge(self) -> Iterator[tuple]:
        """Merge the open windows, the emptiest into the fullest; at most one partial window stays open."""
        held = sorted(self.open, key=lambda w: w[0])
        while len(held) > 1:
            low, full = held[0], held[-1]
            gap = self.size - full[0]
            while gap and low[1]:
                key, start, ids, total = low[1].pop()
                n = len(ids) // 4
                if n <= gap:
                    full[1].append((key, start, ids, total))
                else:  # the head fills the gap, the tail stays
                    full[1].append((key, start, ids[: 4 * gap], total))
                    low[1].append((key, start + gap, ids[4 * gap :], total))
                    n = gap
                gap, low[0], full[0] = gap - n, low[0] - n, full[0] + n
            if not gap:
                yield from self._emit(full[1])
                held.pop()
            if not low[1]:
                held.pop(0)
        self.open = held

    def close(self) -> Iterator[tuple]:
        """Cut what is left into windows whose lengths are powers of two."""
        for filled, pieces in self.open:
            while filled:
                room = 1 << (filled.bit_length() - 1)
                filled -= room
                window = []
                while room:
                    key, start, ids, total = pieces.pop()
                    n = min(len(ids) // 4, room)
                    window.append((key, start, ids[: 4 * n], total))
                    if 4 * n < len(ids):
                        pieces.append((key, start + n, ids[4 * n :], total))
                    room -= n
                yield from self._emit(window)
        self.open = []

    def leftovers(self) -> Iterator[tuple]:
        for _, pieces in self.open:
            for key, start, ids, total in pieces:
                yield key, start, len(ids) // 4, None, total, None, None, ids


def _columns(key: str, kind: str) -> str:
    return f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def pack(df: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id", window: int = WINDOW, open_windows: int = OPEN, merge: int = MERGE) -> DataFrame:
    """Pieces (key, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    kind = df.schema[key].dataType.simpleString()

    def schema_of(first: pa.Field) -> pa.Schema:
        long = pa.int64()
        return pa.schema([first, *((n, long) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")), ("ids", pa.binary())])

    def run(batches):
        tokenizer, packer, schema = tokenizer_at(tokenizer_path), Packer(window, open_windows, TaskContext.get().partitionId() << 32), None
        for b in batches:
            schema = schema or schema_of(b.schema.field(0).with_name(key))
            out = []
            for k, ids in zip(b.column(0).to_pylist(), tokenizer.ids(b.column(1).to_pylist())):
                out += packer.add(k, ids + _u32(END_ID))
            if out:
                yield from _table(out, schema).to_batches()
        if schema:
            yield from _table([*packer.merge(), *packer.leftovers()], schema).to_batches()

    packed = map_rows(df.select(key, text), run, _columns(key, kind)).withColumn("part", F.spark_partition_id())
    placed = stash(packed, "pieces").df

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("n", "ascending")])
        group = table.column("part")[0].as_py() // merge
        packer = Packer(window, table.num_rows, (GROUPS_FROM + group) << 32)
        by_part: dict[int, list] = {}
        for k, start, ids, total, part in zip(*(table.column(c).to_pylist() for c in (key, "start", "ids", "doc_tokens", "part"))):
            by_part.setdefault(part, [0, []])
            by_part[part][0] += len(ids) // 4
            by_part[part][1].append((k, start, ids, total))
        packer.open = list(by_part.values())
        rows = [*packer.merge(), *packer.close()]
        schema = schema_of(table.schema.field(key))
        return _table(rows, schema).drop_columns(["ids"])

    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    left = placed.where(F.col("sequence_id").isNull()).select(key, "start", "ids", "doc_tokens", "part", F.col("length").alias("n"), F.floor(F.col("part") / merge).alias("group"))
    merged = left.groupBy("group").applyInArrow(meet, _columns(key, kind).removesuffix(", ids binary"))
    return placed.where(F.col("sequence_id").isNotNull()).select(*names).unionByName(merged.select(*names))


def op7_packing(spark, sf_dir: str) -> DataFrame:
    """Query op7: sequences of 4096 ids of the public word tokenizer, id 2 after each document."""
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
