"""Quality classifier from zstandard dictionaries.

One dictionary is trained on texts labelled good, one on texts labelled bad. A text is cut into blocks and
each block is compressed with either dictionary. The normalised difference of the compressed sizes, over the text and
in its worst block, joins the compression ratio (which tells runs of one word, that both dictionaries shorten alike)
and a length term. A logistic curve of second degree over these, fitted by Newton's method on labelled rows that the
dictionaries have not seen, turns them into a calibrated score between 0 and 1. Beside it stands the score of a curve over the
size difference alone, as bytes saved by the good dictionary for each byte of text.

Blocks keep the dictionary in reach over the whole of a long text, and memory bounded. Training takes at most
``sample`` rows a class (lowest hash of the key first). The curves are fitted on whole texts, whose sizes the executors take; a
dictionary gets the whole of a text of up to ``dict_text`` bytes, and blocks from all over a longer one. Scoring reads every text whole.
Defined cases: null and empty texts have sizes 0 and get the score of the curve there; an empty table to learn from, or one
with a single class, gives the smoothed share of good labels; an empty table to score gives an empty result; null labels and labels
without a document are not learned from; repeated rows score alike; equal hashes are taken in the order of their keys; extra
columns are ignored, and kept by ``keep_good``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.arrow import map_rows

SAMPLE = 2000
DICT_TEXT = 16 << 10
DICT_BYTES = 64 << 10
BLOCK = 1024
LEVEL = 3
RIDGE = 0.1


def _second_degree(x: np.ndarray) -> np.ndarray:
    n = x.shape[1]
    return np.column_stack([x, *(x[:, i] * x[:, j] for i in range(n) for j in range(i, n))])


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; small samples, which the trainer refuses, serve as raw content."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICT_BYTES:]


class CompressionModel:
    """Two dictionaries, and the weights of the logistic curve over what their compressed sizes give."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad, self._by = good, bad, None
        self.curve, self.plain = Curve(5), Curve(1)

    def __getstate__(self):
        return self.__dict__ | {"_by": None}

    def _compressors(self):
        if self._by is None:
            self._by = []
            for content in (self.good, self.bad):
                held = zstandard.ZstdCompressionDict(content) if content else None
                if held:
                    held.precompute_compress(level=LEVEL)
                self._by.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False))
        return self._by

    def sizes(self, text: str | None) -> np.ndarray:
        """Normalised size difference of the text and of its worst block, log compression ratio of both, the length's term, and
        the size difference for each byte of text: positive where the good dictionary fits better."""
        data = (text or "").encode("utf-8", "surrogatepass")
        if not data:
            return np.zeros(6)
        by = self._compressors()
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        good, bad = (np.array([len(c.compress(b)) for b in blocks], float) for c in by)
        raw = np.array([len(b) for b in blocks], float)
        full = raw >= min(BLOCK / 4, raw[0])
        total = raw.sum() + 8
        worst = ((bad - good) / (bad + good))[full].min(), np.log((good / (raw + 8))[full].min())
        return np.array([(bad.sum() - good.sum()) / (bad.sum() + good.sum()), worst[0], np.log(good.sum() / total), worst[1], total**-0.5, (bad.sum() - good.sum()) / raw.sum()])

    def calibrate(self, sizes: np.ndarray, y: np.ndarray, share: float | None = None) -> None:
        """Fit both curves. ``sizes``: rows of ``sizes``; ``y``: their labels, ``share``: the part of good labels in the whole table."""
        sizes = np.asarray(sizes, float).reshape(-1, 6)
        self.curve.fit(sizes[:, :5], y, share)
        self.plain.fit(sizes[:, 5:], y, share)

    def scores(self, text: str | None) -> tuple[float, float, float]:
        """The score, the size difference for each byte of text, and the score of that alone."""
        x = self.sizes(text)
        return self.curve(x[:5]), float(x[5]), self.plain(x[5:])

    def score(self, text: str | None) -> float:
        return self.scores(text)[0]


class Curve:
    """A logistic curve of second degree over a few numbers."""

    def __init__(self, n: int):
        terms = _second_degree(np.zeros((1, n))).shape[1]
        self.mean, self.scale, self.weights = np.zeros(terms), np.ones(terms), np.zeros(terms + 1)

    def fit(self, sizes: np.ndarray, y: np.ndarray, share: float | None = None) -> None:
        """Newton's method for a logistic curve of second degree, with a light ridge.

        ``share``: the part of good labels in the whole table, which the rows' weights restore.
        """
        y = np.asarray(y, float)
        if len(set(y.tolist())) < 2:
            share = (y.sum() + 1) / (len(y) + 2) if share is None else share
            self.weights[-1] = math.log(share / (1 - share))
            return
        x = _second_degree(np.asarray(sizes))
        self.mean, self.scale = x.mean(axis=0), np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
        x = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        share = y.mean() if share is None else share
        weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
        w = np.zeros(x.shape[1])
        w[-1] = math.log(share / (1 - share))
        ridge = np.append(np.full(len(w) - 1, RIDGE), 1e-6)

        def loss(v):
            z = x @ v
            return weight @ (np.logaddexp(0, z) - y * z) + v @ (ridge * v) / 2

        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
            step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + np.diag(ridge), x.T @ (weight * (p - y)) + ridge * w)
            rate, before = 1.0, loss(w)
            while rate > 1e-6 and loss(w - rate * step) > before:
                rate /= 2
            w = w - rate * step
            if np.abs(rate * step).max() < 1e-8:
                break
        self.weights = w

    def __call__(self, x: np.ndarray) -> float:
        x = (_second_degree(x[None, :])[0] - self.mean) / self.scale
        z = float(np.clip(x @ self.weights[:-1] + self.weights[-1], -40, 40))
        return 1 / (1 + math.exp(-z))


def spread(text: str, most: int = DICT_TEXT, block: int = BLOCK) -> bytes:
    """The bytes of a text, or blocks at even distances over the whole of a long one."""
    data = text.encode("utf-8", "surrogatepass")
    if len(data) <= most:
        return data
    starts = np.linspace(0, len(data) - block, most // block).astype(int).tolist()
    return b"".join(data[i : i + block] for i in starts)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id", sample: int = SAMPLE, dict_text: int = DICT_TEXT) -> CompressionModel:
    """Fit on at most ``sample`` rows a class for the dictionaries and as many for the curves.

    The rows are chosen among the labels, so that only 4 ``sample`` keys are broadcast and no text is shuffled; the driver gets at most
    ``dict_text`` bytes of 2 ``sample`` texts, and six numbers of as many others.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(label).cast("int").alias("y"), F.xxhash64(F.col(key).cast("string"), F.lit("quality")).alias("h"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    texts = docs.where(F.length(text) > 0).select(F.col(key).alias("__doc"), F.col(text).alias("text"))

    def taught(curve: int) -> DataFrame:
        chosen = None
        for y in (0, 1):
            part = known.where((F.col("y") == y) & (F.pmod("h", F.lit(2)) == curve)).orderBy("h", "__key").limit(sample)
            chosen = part if chosen is None else chosen.unionAll(part)
        return texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__key")).select("y", "h", "text")

    def cut(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([spread(t, dict_text) for t in b.column(2).to_pylist()], pa.binary())], names=["y", "h", "data"])

    rows = sorted((r["h"], bytes(r["data"]), r["y"]) for r in map_rows(taught(0), cut, "y int, h long, data binary").collect())
    model = CompressionModel(*(_dictionary([x for _, x, own in rows if own == y]) for y in (1, 0)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([shared.value.sizes(t).tolist() for t in b.column(2).to_pylist()], pa.list_(pa.float64()))], names=["y", "h", "sizes"])

    rest = sorted((r["h"], r["y"], r["sizes"]) for r in map_rows(taught(1), measure, "y int, h long, sizes array<double>").collect())
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    model.calibrate(np.array([x for _, _, x in rest]), np.array([y for _, y, _ in rest]), share)
    return model


def score(df: DataFrame, model: CompressionModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, score, difference, difference_score): a map without a shuffle. The broadcast model is two dictionaries of fixed size."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            found = np.array([shared.value.scores(x) for x in b.column(1).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(found[:, i].copy()) for i in range(3))], names=[key, "score", "difference", "difference_score"])

    return map_rows(df.select(key, text), run, f"`{key}` {df.schema[key].dataType.simpleString()}, score double, difference double, difference_score double")


def keep_good(df: DataFrame, model: CompressionModel, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows, all columns kept, whose score reaches the threshold."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            kept = [shared.value.score(x) >= threshold for x in b.column(b.schema.get_field_index(text)).to_pylist()]
            yield b.filter(pa.array(kept, pa.bool_()))

    return map_rows(df, run, df.schema)


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out third."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return labels.where(~held_out).select("doc_id", F.col("quality").alias("label"))


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Query op10: labelled documents whose crc32 mod 3 is not 1 teach, every document is scored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "difference", "difference_score")
