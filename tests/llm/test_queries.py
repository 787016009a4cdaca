"""The registered queries over whole tables against brute force, and the pipeline against plain stages, odd rows included."""

import hashlib
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from kinlink.llm import compression, langid, lines, mixing, packing, simhash, suffixes, urls, vectors
from tests.llm.test_other_ops import plain_judge, plain_rule
from tests.llm.test_text_ops import brute_lines, brute_repeats, components, plain_fingerprint

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture(scope="module")
def documents(data):
    return pd.read_parquet(f"{data}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


def held(value, mod, rest):
    return zlib.crc32(str(value).encode()) % mod == rest


def plain_grams(text):
    out, run = Counter(), ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            run += c
        elif run:
            padded = f"_{run}_"
            out.update(run)
            out.update(padded[i : i + 2] for i in range(len(padded) - 1))
            out.update(padded[i : i + 3] for i in range(len(padded) - 2))
            run = ""
    return out


def plain_ranked(counts, top):
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:top]]


def test_op1(spark, data, documents):
    counts = {}
    for r in documents.itertuples():
        if not held(r.doc_id, 5, 0) and r.lang is not None:
            counts.setdefault(r.lang, Counter()).update(plain_grams(r.text))
    profiles = {k: {g: i for i, g in enumerate(plain_ranked(c, langid.TOP))} for k, c in counts.items()}
    got = {r["doc_id"]: r for r in langid.op1_language_id(spark, data).collect()}
    assert len(got) == len(documents)
    for r in documents.itertuples():
        own = plain_ranked(plain_grams(r.text), langid.TOP)
        assert got[r.doc_id]["held_out"] == held(r.doc_id, 5, 0)
        if not own:
            assert (got[r.doc_id]["lang_pred"], got[r.doc_id]["score"]) == ("und", 0.0)
            continue
        apart = {k: sum(abs(p[g] - i) if g in p else langid.TOP for i, g in enumerate(own)) for k, p in sorted(profiles.items())}
        best = min(apart, key=apart.get)
        assert got[r.doc_id]["lang_pred"] == best and got[r.doc_id]["score"] == pytest.approx(1 - apart[best] / (langid.TOP * len(own)))


def test_op2(spark, data, documents):
    got = suffixes.op2_suffix_array_dedup(spark, data).toPandas().sort_values("doc_id")
    want = brute_repeats(documents.text, 400)
    assert list(zip(got.n_bytes, got.n_removed, got.n_spans, got.kept_sha256)) == want
    assert (got.repeats == (got.n_removed > 0)).all() and [sum(s["end"] - s["start"] for s in x) for x in got.spans] == got.n_removed.tolist()


def test_op2_text(spark, tmp_path):
    rng = np.random.default_rng(5)
    words = lambda n: " ".join("".join(rng.choice(list("abcdeé"), 7)) for _ in range(n))
    long, short = [words(60) for _ in range(3)], " ".join("".join(rng.choice(list("abcde"), 6)) for _ in range(51))
    texts = [None, "", "x" * 300] + [words(200) for _ in range(4)] + [words(20) + " " + p + " " + words(30) for p in long * 3] + [f"{words(9)} {short} {words(9)}" for _ in range(2)]
    texts += [words(9) + " " + long[0] + "é" + words(5), words(9) + " " + long[0] + "è" + words(5)]  # their first byte is shared
    pd.DataFrame({"doc_id": range(len(texts)), "text": texts}).to_parquet(f"{tmp_path}/documents.parquet")
    got = suffixes.op2_suffix_array_dedup(spark, str(tmp_path)).toPandas().sort_values("doc_id")
    assert list(zip(got.n_bytes, got.n_removed, got.n_spans, got.kept_sha256)) == brute_repeats(texts, 400)
    assert not any(p in t for p in long for t in got.text)
    for text, left, spans, sha in zip(texts, got.text, got.spans, got.kept_sha256):
        data, at, kept = (text or "").encode(), 0, b""
        for s in spans:
            kept, at = kept + data[at : s["start"]], s["end"]
        kept += data[at:]
        assert hashlib.sha256(kept).hexdigest() == sha and left.replace("\ufffd", "") == kept.decode(errors="ignore")
    whole = [i for i, t in enumerate(texts) if not any(p in (t or "") for p in long)]
    assert got.text.iloc[whole].tolist() == [texts[i] or "" for i in whole] and (got.n_removed.to_numpy() > 0).sum() == len(texts) - len(whole) == 11
    assert got.text.str.contains("\ufffd").sum() == 2


def test_opened_texts_leave_in_small_batches():
    pack = zstandard.ZstdCompressor().compress
    given = pa.RecordBatch.from_arrays([pa.array([bytes([i]) for i in range(6)]), pa.array([pack(bytes(3 << 20))] * 6), pa.nulls(6, pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())])))], names=["digest", "packed", "marks"])
    got = list(suffixes._judge(400, True)([given]))
    assert [b.num_rows for b in got] == [2, 2, 2, 0] and pa.Table.from_batches(got).column("digest").to_pylist() == [bytes([i]) for i in range(6)]


def test_op5(spark, data):
    pages, labels = pd.read_parquet(f"{data}/pages.parquet"), pd.read_parquet(f"{data}/labels.parquet")
    quality = dict(zip(labels.doc_id, labels.quality))
    rows, taught = [], []
    for p in pages.itertuples():
        host, path, _, _ = plain_rule(p.url)
        rows.append((p.page_id, host, path))
        number = pd.Series([p.url]).str.extract(r"/([0-9]{1,18})")[0][0]
        if isinstance(number, str) and int(number) in quality:
            taught.append((p.page_id, quality[int(number)]))
    want = plain_judge(rows, taught)
    got = urls.op5_url_filter(spark, data).collect()
    assert len(got) == len(pages)
    url = dict(zip(pages.page_id, pages.url))
    for r in got:
        host, path, rule, verdict = plain_rule(url[r["page_id"]])
        template, purity, method = want[r["page_id"]]
        assert (r["host"], r["path"], r["rule"], r["verdict"], r["template"]) == (host, path, rule, verdict or method, template)
        assert r["purity"] == pytest.approx(purity, abs=2e-6)


def test_op7(spark, data, documents):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    whole = tokenizers.Tokenizer.from_file(path)
    got = packing.op7_packing(spark, data).toPandas()
    texts = dict(zip(documents.doc_id, documents.text))
    for key, own in got.sort_values("start").groupby("doc_id"):
        ids, at = np.array(whole.encode(texts.pop(key) or "", add_special_tokens=False).ids + [2], "<u4"), 0
        for p in own.itertuples():
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert not texts
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    sizes = got.groupby("sequence_id").length.sum()
    assert sizes.max() <= 4096 and sum(0 if n & (n - 1) == 0 else 4096 - n for n in sizes) / sizes.sum() < 0.1


def test_packing_odd_rows(spark):
    """Rows that repeat and null keys are pieces of their own; no id is lost at ties of windows."""
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    df = spark.createDataFrame([(1, "a b c")] * 3 + [(None, "a b c"), (None, None), (2, "")], "doc_id long, text string").withColumn("length", F.lit("clash"))
    got = packing.pack(df, path, window=16, open_windows=2, merge=2).toPandas()
    assert got.groupby("sequence_id").length.sum().max() <= 16 and (got[got.start == 0].doc_id.fillna(-1).sort_values().tolist()) == [-1, -1, 1, 1, 1, 2]
    tokens = got[got.start == 0].groupby(got.doc_id.fillna(-1)).doc_tokens.sum()
    assert got.groupby(got.doc_id.fillna(-1)).length.sum().to_dict() == tokens.to_dict()


def test_op8(spark, data, documents):
    rows = list(zip(documents.doc_id, documents.text))
    want = brute_lines(rows)
    for r in lines.op8_line_dedup(spark, data).collect():
        assert r["kept_sha256"] == hashlib.sha256(want[r["doc_id"]].encode()).hexdigest()


def test_op9(spark, data, documents):
    prints = [plain_fingerprint(t) for t in documents.text]
    want = components(documents.doc_id.tolist(), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op9_simhash_near_dedup(spark, data).collect()}
    assert got == {k: (f"{p:016x}", want[k]) for k, p in zip(documents.doc_id, prints)}


def test_op6(spark, data):
    vecs = pd.read_parquet(f"{data}/embeddings.parquet").sort_values("vec_id")
    x = np.array(vecs.embedding.tolist(), float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = vectors.op6_embedding_near_dedup(spark, data).toPandas().sort_values("vec_id")
    linked = x @ x.T >= 0.95
    assert got.n_links.tolist() == (linked.sum(axis=1) - 1).tolist() and (got.audited_recall == 1.0).all()
    want = components(vecs.vec_id.tolist(), lambda i, j: linked[i, j])
    assert got.component_id.tolist() == [want[k] for k in vecs.vec_id]


def test_curve_is_the_optimum():
    """The calibrated curve against the definition: no small step lowers the weighted loss, and likelier texts score higher."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 1))
    y = (x[:, 0] + rng.normal(scale=0.7, size=300) > 0).astype(float)
    curve = compression.Curve(1)
    curve.fit(x, y, 0.7)
    terms = (np.column_stack([x, x * x]) - curve.mean) / curve.scale
    weight = np.where(y == 1, 0.7 / y.mean(), 0.3 / (1 - y.mean()))

    def loss(w):
        z = terms @ w[:-1] + w[-1]
        return weight @ np.log(1 + np.exp(-np.where(y == 1, z, -z))) + compression.RIDGE / 2 * w[:-1] @ w[:-1] + 5e-7 * w[-1] ** 2

    best = loss(curve.weights)
    for i in range(3):
        for step in (-0.01, 0.01):
            moved = curve.weights.copy()
            moved[i] += step
            assert loss(moved) > best
    assert curve(np.array([1.0])) > 0.8 > 0.3 > curve(np.array([-1.0]))


def plain_mixture(cells):
    """Probabilities by cell; ``cells``: tokens by (source, lang, topic)."""
    keys, t = list(cells), np.array(list(cells.values()), float)
    wanted = t.sum() * mixing.BUDGET

    def level(cap, w, total):
        low, high = 0.0, 1.0
        while np.minimum(cap, high * w).sum() < total * (1 - 1e-12):
            high *= 2
            if high > 1e30:
                return high
        for _ in range(200):
            low, high = ((low + high) / 2, high) if np.minimum(cap, (low + high) / 2 * w).sum() < total else (low, (low + high) / 2)
        return high

    groups = []
    for d in range(3):
        names = sorted({k[d] for k in keys})
        own = [np.array([k[d] == n for k in keys]) for n in names]
        sums = np.array([t[m].sum() for m in own])
        groups += list(zip(own, np.minimum(sums, level(sums, sums**0.5, wanted) * sums**0.5)))
    w = t.copy()
    for _ in range(60):
        for m, aim in groups:
            w[m] *= level(t[m], w[m], aim)
    return dict(zip(keys, np.minimum(t, w) / t))


def test_pipeline(spark, data, tmp_path):
    import corpus_pipeline
    from kinlink.sources.stash import stash

    source = data.replace("sf0.001", "sf0.01")
    table = pd.read_parquet(f"{source}/documents.parquet")
    odd = [(900001, None, "en", "src1", None), (900002, "", None, None, 0), (None, "no key, some words of text here", "en", "src2", 5), (900003, " \n\n ", "de", "src3", 4)]
    repeated = [tuple(r) for r in table.sort_values("doc_id").head(20).itertuples(index=False)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.read.parquet(f"{source}/documents.parquet").select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))
    extra = spark.createDataFrame(odd, schema).unionByName(spark.createDataFrame(repeated, schema=", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in table.columns)).select(*docs.columns))
    folder = str(tmp_path)
    docs.unionByName(extra).withColumns({"h": F.lit(1), "removed": F.lit("x"), "node": F.lit(2.0), "tokens": F.lit(3)}).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{source}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, outs = docs.columns, [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stash(stage(spark, docs, folder), name).df
        assert docs.columns == columns
        outs.append(docs.toPandas())
    none = lambda x: None if pd.isna(x) else x
    rows = [[(none(k), none(t)) for k, t in zip(o.doc_id, o.text)] for o in outs]
    # what stays by the classifier, one text after another
    model = compression.fit(spark.read.parquet(f"{folder}/documents.parquet"), compression.training_labels(spark.read.parquet(f"{folder}/labels.parquet")))
    order = lambda x: (x[0] is not None, x[0] or 0, x[1] or "")
    assert sorted(rows[1], key=order) == sorted((r for r in rows[0] if model.score(r[1]) >= 0.5), key=order)
    # lines, of distinct documents in the order of their keys
    want = brute_lines(sorted(set(rows[1]), key=order))
    assert {k: t or "" for k, t in rows[2]} == want and Counter(k for k, _ in rows[2]) == Counter(k for k, _ in rows[1])
    # one of each group of alike texts
    distinct = sorted(set(rows[2]), key=order)
    sets = [frozenset(simhash.shingle_set(t, 5)) for _, t in distinct]
    alike = lambda i, j: min(len(sets[i]), len(sets[j])) >= 0.8 * max(len(sets[i]), len(sets[j])) and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    first = components([order((k, "")) for k, _ in distinct], alike)
    kept = {k for k, _ in rows[3]}
    assert kept == {k[1] if k[0] else None for k in first.values()} and Counter(rows[3]) == Counter(r for r in rows[2] if r[0] in kept)
    # the mixture: tokens, cells and draws by hand
    cells, own = Counter(), []
    topics = {r["text"]: r["t"] for r in spark.createDataFrame([(t,) for t in {t for _, t in rows[3]}], "text string").select("text", mixing.topic_of("text").alias("t")).collect()}
    for r in outs[3].itertuples():
        cell = none(r.source) or "", none(r.lang) or "", topics[none(r.text)]
        n = len([w for w in __import__("re").split(r"[ \t\n\r\f]+", none(r.text) or "") if w])
        cells[cell] += n
        own.append((none(r.doc_id), cell))
    chance = plain_mixture({k: n for k, n in cells.items() if n})
    drawn = []
    for k, cell in own:
        u = int(hashlib.md5(f"0:{int(k)}".encode() if k is not None else b"0").hexdigest()[:12], 16) / 16**12
        p = chance.get(cell, 1.0)
        assert abs(u - p) > 1e-6 or k is None
        drawn += [k] if u < p else []
    assert Counter(k for k, _ in rows[4]) == Counter(drawn)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).toPandas()
    assert set(last.doc_id.map(none)) == {k for k, _ in rows[4]}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "mixture", "packing"]
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, empty, folder).count() == 0
