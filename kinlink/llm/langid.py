"""Language identification by rank-order n-gram profiles and the out-of-place distance.

A text is lower-cased and cut to runs of letters; each run is padded with one boundary mark on either
side and gives its 1-, 2- and 3-grams. The most frequent grams of a language, ranked by count, are its
profile. A document's own ranked grams are compared with each profile: a gram costs the difference of
its two ranks, a gram that the profile lacks costs the profile's length.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; ties between languages go to
the alphabetically first; equal counts rank by the gram's code; repeated rows count as often as they occur in training and are
predicted alike, null keys keep their rows; extra columns are ignored; an empty
training table gives ``und`` everywhere, an empty table to predict an empty result. Texts are read whole, in pieces cut between letter runs.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinlink.llm.arrow import map_rows, rows

TOP = 400
MARK = 0x5F
PIECE = 1 << 20
MOST_LANGUAGES = 5000


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _pieces(text: str):
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and end > at and text[end - 1].isalpha():
            end -= 1
        if end == at:  # one letter run longer than a piece
            end = min(at + PIECE, len(text))
        yield text[at:end]
        at = end


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted gram codes of a text and their counts; a code packs up to three code points of 21 bits."""
    found = []
    for piece in _pieces(text):
        points = np.frombuffer(piece.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        letter = _letters()[points]
        if not letter.any():
            continue
        points = np.where(letter, points, MARK)
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # one mark after each run
        points = np.concatenate(([MARK], points[keep], [MARK]))
        mark = points == MARK
        pair = points[:-1] << 21 | points[1:]
        pair = pair[~(mark[:-1] & mark[1:])]
        triple = points[:-2] << 42 | points[1:-1] << 21 | points[2:]
        found += [points[~mark], pair, triple[~mark[1:-1]]]
        if len(found) > 60:
            found = [np.concatenate(found)]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.unique(np.concatenate(found), return_counts=True)


def _merge(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    values, inverse = np.unique(np.concatenate(codes), return_inverse=True)
    return values, np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)


def _count(batches):
    held: dict[str, tuple[list, list]] = {}
    for text, lang in rows(batches):
        codes, counts = grams(text or "")
        own = held.setdefault(lang, ([], []))
        own[0].append(codes)
        own[1].append(counts)
        if len(own[0]) >= 256:
            merged = _merge(*own)
            held[lang] = ([merged[0]], [merged[1]])
    for lang, own in held.items():
        codes, counts = _merge(*own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], names=["lang", "gram", "n"])


def learn_profiles(train: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """Profiles as rows (lang, gram, rank from 0), learned over all rows whose language is not null."""
    counted = map_rows(train.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")), _count, "lang string, gram long, n long")
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(best) - 1).where(F.col("rank") < top).select("lang", "gram", "rank")


class Profiles:
    """Profiles as a rank table: bounded by languages x ``top`` entries, checked when built."""

    def __init__(self, entries: list[tuple[str, int, int]], top: int = TOP):
        self.top, self.langs = top, sorted({e[0] for e in entries})
        if len(self.langs) > MOST_LANGUAGES:
            raise ValueError(f"{len(self.langs)} languages to learn; at most {MOST_LANGUAGES} are broadcast")
        self.codes = np.unique(np.array([e[1] for e in entries], np.int64))
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int32)
        at = {x: i for i, x in enumerate(self.langs)}
        for lang, gram, rank in entries:
            self.ranks[np.searchsorted(self.codes, gram), at[lang]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = grams(text or "")
        if not len(codes) or not self.langs:
            return "und", 0.0
        own = codes[np.lexsort((codes, -counts))[: self.top]]
        at = np.searchsorted(self.codes, own)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != own)] = len(self.codes)
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, self.top, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(apart.argmin())
        return self.langs[best], float(1 - apart[best] / (self.top * len(own)))


def identify(df: DataFrame, profiles: DataFrame, text: str = "text", key: str = "doc_id", top: int = TOP) -> DataFrame:
    """Rows (key, lang_pred, score): a map over the documents, without a shuffle."""
    learned = Profiles([tuple(r) for r in profiles.select("lang", "gram", "rank").collect()], top)
    shared = df.sparkSession.sparkContext.broadcast(learned)

    def predict(batches):
        for b in batches:
            out = [shared.value.predict(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], names=[key, "lang_pred", "score"])

    kind = df.schema[key].dataType.simpleString()
    return map_rows(df.select(key, text), predict, f"`{key}` {kind}, lang_pred string, score double")


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """Query op1: documents whose crc32 mod 5 is not 0 teach, every document is predicted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    learned = learn_profiles(docs.where(~F.coalesce(held_out, F.lit(False))))
    out = identify(docs, learned)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
