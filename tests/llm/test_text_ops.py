"""Operators on texts against brute force, on small fixtures with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from kinlink.llm import compression, langid, lines, packing, simhash, suffixes

SCHEMA = "doc_id long, text string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


# --- language


def test_languages(spark):
    texts = {"en": "the house and the garden of the king where they think", "de": "das haus und der garten des königs wo sie denken", "fr": "la maison et le jardin du roi où ils pensent"}
    rng = random.Random(0)
    rows = []
    for i in range(60):
        lang = sorted(texts)[i % 3]
        words = texts[lang].split()
        rows.append((i, " ".join(rng.choice(words) for _ in range(30)), lang))
    train = spark.createDataFrame([*rows, (99, None, "en"), (98, "x", None)], "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(train, top=50)
    assert profiles.groupBy("lang").count().where("count > 50").count() == 0
    asked = spark.createDataFrame([(1, texts["de"]), (2, texts["fr"].upper()), (3, None), (4, "123 !!"), (5, ""), (6, texts["en"] * 3000)], SCHEMA)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(asked.withColumn("lang_pred", F.lit(1)), profiles, top=50).collect()}
    assert [got[i][0] for i in range(1, 7)] == ["de", "fr", "und", "und", "und", "en"]
    assert all(0 <= s <= 1 for _, s in got.values())
    assert langid.identify(asked, profiles.limit(0)).where("lang_pred <> 'und'").count() == 0
    assert langid.identify(asked.limit(0), profiles).count() == 0


def test_grams_by_hand():
    codes, counts = langid.grams("Ab b")
    pack = lambda s: sum(ord(c) << 21 * (len(s) - 1 - i) for i, c in enumerate(s))
    want = {"a": 1, "b": 2, "_a": 1, "ab": 1, "b_": 2, "_b": 1, "_ab": 1, "ab_": 1, "_b_": 1}
    assert dict(zip(codes.tolist(), counts.tolist())) == {pack(k): v for k, v in want.items()}
    whole = langid.grams("wort, " * 400_000)  # longer than a piece
    assert whole[1].min() == 400_000


# --- quality


def test_quality_held_out(spark, data):
    found = compression.op10_quality_classifier(spark, data)
    labelled = found.where("held_out").join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").toPandas()
    assert found.count() == spark.read.parquet(f"{data}/documents.parquet").count()
    assert (labelled.predicted == labelled.quality).mean() > 0.85


def test_quality_edge_cases(spark):
    docs = frame(spark, [(i, "good words here " * 5 if i % 2 else "$$$ !!! " * 5) for i in range(80)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(200, 1), (3, None)], "doc_id long, label int")
    model = compression.fit(docs, labels)
    asked = frame(spark, [(1, None), (2, ""), (3, "good words here " * 5), (3, "good words here " * 5), (4, "$$$ !!! " * 5), (5, "x" * 200_000)])
    got = compression.score(asked.withColumn("score", F.lit("clash")), model).toPandas()
    assert len(got) == 6 and got.score.between(0, 1).all()
    by = got.groupby("doc_id").score.agg(["min", "max"])
    assert by.loc[3, "min"] == by.loc[3, "max"] > 0.5 > by.loc[4, "max"]
    one = compression.fit(docs.limit(0), labels.limit(0))
    assert compression.keep_good(asked, one).count() in (0, 6)


# --- repeated byte strings


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for b in data:
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out = []
    for b in data:
        cover = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                cover[p] += 1
                cover[p + length] -= 1
        gone = np.cumsum(cover)[: len(b)] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int), 0]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_strings(spark):
    rng = random.Random(1)
    words = lambda n: " ".join("".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 9))) for _ in range(n))
    shared = [words(60) for _ in range(3)]
    texts = [None, "", "a" * 900, "ab" * 400, "x"] + [words(rng.randrange(80)) + rng.choice(shared)[rng.randrange(40) :] + words(rng.randrange(60)) for _ in range(40)]
    texts += texts[:12]
    want = brute_repeats(texts, 100)
    for shard_bytes, chunk in ((1 << 20, 1 << 20), (2000, 150)):  # the second deals keys to several shards, and texts to chunks
        got = suffixes.remove_repeats(frame(spark, list(enumerate(texts))).withColumn("digest", F.lit(0)), length=100, shard_bytes=shard_bytes, chunk=chunk, with_text=True).toPandas().sort_values("doc_id")
        assert list(zip(got.n_bytes, got.n_removed, got.n_spans, got.kept_sha256)) == want
        assert [hashlib.sha256(k).hexdigest() for k in got.kept] == [w[3] for w in want]
    assert suffixes.remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("n,letters", [(1, 1), (7, 1), (9, 2), (300, 2), (2000, 4)])
def test_suffix_array_and_prefixes(n, letters):
    rng = random.Random(n)
    text = bytes(97 + rng.randrange(letters) for _ in range(n))
    data = np.frombuffer(text, np.uint8)
    order, _ = suffixes.suffix_array(data, n + 1)
    want = sorted(range(n), key=lambda i: text[i:])
    assert order.tolist() == want
    got = suffixes.common_prefixes(data, order, 100, lanes=7)
    for k in range(1, n):
        a, b = text[want[k - 1] :], text[want[k] :]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert got[k] == min(same, 100)


def test_windows_of_a_large_shard():
    """Over 32 KB a lane walks several steps, and passages alike over more than the sorted depth are ties."""
    rng = random.Random(11)
    word = lambda n: bytes(rng.choice(b"abcd") for _ in range(n))
    parts = []
    for _ in range(120):
        passage = word(rng.randrange(520, 700))
        parts += [word(rng.randrange(500)) + passage + word(rng.randrange(500)) for _ in range(2)]
    rng.shuffle(parts)
    data, sizes = b"".join(parts), [len(p) - 399 for p in parts]
    got, where = suffixes.repeated_windows(parts, sizes, 400)
    windows = [data[i : i + 400] for i in where.tolist()]
    times = pd.Series(windows).value_counts()
    assert len(data) > 1 << 17 and got.tolist() == [times[w] > 1 for w in windows]
    depth = np.frombuffer(data, np.uint8)
    order, _ = suffixes.suffix_array(depth, 400)
    found = suffixes.common_prefixes(depth, order, 400)
    for k in range(1, len(order), 7):
        a, b = (data[i : i + 400] for i in order[k - 1 : k + 1])
        assert found[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


# --- packing


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_word_ids(tokenizer):
    from tokenizers import Tokenizer

    whole, ours = Tokenizer.from_file(tokenizer), packing.WordTokenizer(tokenizer)
    rng = random.Random(0)
    letters = [chr(c) for c in range(1, 0x200)] + ["'s", "'re", " ", "\n", "..", "<|endoftext|>", "ab", "Σ", "日本", "\u0301"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(2000)] + [None, ""] + [f"a{chr(c)}b {chr(c)}" for c in range(1, 0x200)]
    for text, ids in zip(texts, ours.ids(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == (whole.encode(text, add_special_tokens=False).ids if text else []), repr(text)


def test_packing_covers_everything(spark, tokenizer):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["house", "tree", "sea"]) for _ in range(rng.choice([1, 20, 90, 400])))) for i in range(60)] + [(60, None), (61, ""), (62, "sky " * 3000)]
    got = packing.pack(frame(spark, rows, 5).withColumn("part", F.lit(1)), tokenizer, window=128, open_windows=4, merge=2).toPandas()
    for key, text in rows:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for p in got[got.doc_id == key].sort_values("start").itertuples():
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    sizes = got.groupby("sequence_id").length.sum()
    assert sizes.max() <= 128
    padding = sum(0 if n & (n - 1) == 0 else 128 - n for n in sizes)
    assert padding / sizes.sum() < 0.02
    assert packing.pack(frame(spark, []), tokenizer).count() == 0


# --- lines


def brute_lines(rows, threshold=0.8):
    seen, index, out = [], {}, {}
    for key, text in rows:
        keep = []
        for line in (text or "").split("\n") if text else []:
            words = line.split()
            if words:
                own = frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
                near = set().union(*(index.get(s, ()) for s in own))
                hit = any(len(own & seen[i]) / len(own | seen[i]) >= threshold - 1e-12 for i in near)
                for s in own:
                    index.setdefault(s, set()).add(len(seen))
                seen.append(own)
                if hit:
                    continue
            keep.append(line)
        out[key] = "\n".join(keep)
    return out


def test_lines(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 8, 12, 60, 90]))) for _ in range(50)]

    def edited(line):
        words = line.split()
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        return " ".join(words)

    rows = [(None, "x\ny\nx")] + [(i, rng.choice([None, "", "\n\n", "a b c"]) if rng.random() < 0.05 else "\n".join(edited(rng.choice(base)) for _ in range(rng.randrange(1, 7)))) for i in range(120)]
    rows.append((500, "\n".join(f"long {i} line of its own {i}" for i in range(5000))))
    want = brute_lines(rows)
    for leaf in (1000, 5):
        df = frame(spark, rows + rows[5:9]).selectExpr("doc_id", "text", "doc_id AS h", "1 AS n_lines", "'k' AS key", "1 AS packed", "2 AS removed", "3 AS `or d`", "4 AS c0")
        got = lines.deduplicate(df, leaf=leaf).toPandas()
        assert {None if pd.isna(k) else int(k): t or "" for k, t in zip(got.doc_id, got.text)} == want
        assert list(got.columns) == ["doc_id", "text", "h", "key", "packed", "removed", "or d", "c0", "n_lines", "n_removed"] and len(got) == len(rows) + 4
    assert lines.deduplicate(frame(spark, [])).count() == 0


def test_words_of_any_length():
    """Hashes of words of a few bytes, of several times eight and of many, at the ends of texts and with zero bytes."""
    rng = random.Random(8)
    words = [bytes(rng.choice(b"\0ab\x1f\x85\xa0") for _ in range(n)) for n in [*range(1, 42), 100, 1000] for _ in range(4)]
    rng.shuffle(words)
    texts = [b"", words[0], words[0], b" ", *(rng.choice([b"", b" ", b"\t"]) + b"".join(w + rng.choice([b" ", b"\n", b"\r\n", b"\v\f"]) for w in words) for _ in range(2)), words[1], b""]
    got = lines.word_hashes(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    want = [w for t in texts for w in t.split()]
    at = [len(b"".join(texts[:i])) + m.start() for i, t in enumerate(texts) for m in re.finditer(rb"[^ \t-\r]+", t)]
    assert got[0].tolist() == at and len(set(got[1].tolist())) == len(set(want)) == len(set(zip(want, got[1].tolist())))


def families(rng, sizes, length):
    """Groups of sets, (sizes of groups, sets): copies of a few sets with some tokens replaced."""
    sets = []
    for size in sizes:
        base = [rng.sample(range(1 << 47), length()) for _ in range(max(1, size // 5))]
        for _ in range(size):
            own = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, len(own) // 10, len(own) // 9, len(own) // 8, len(own) // 4])):
                own[rng.randrange(len(own))] = rng.randrange(1 << 47)
            sets.append(np.array(sorted(set(own[: rng.choice([len(own), len(own) * 8 // 10 + 1])])), np.uint64))
    return sizes, sets


@pytest.mark.parametrize("threshold,most,all_pairs", [(0.8, 1 << 15, 512), (0.8, 16, 7), (0.5, 40, 512)])
def test_groups_are_compared_exactly(monkeypatch, threshold, most, all_pairs):
    rng = random.Random(5)
    sizes, sets = families(rng, [1, 2, 2, 30, 3, 1, 12, 7, 8, 25, 1], lambda: rng.choice([4, 5, 9, 10, 30, 100, 900, 1500]))
    want, low = [], 0
    for size in sizes:
        own = [set(x.tolist()) for x in sets[low : low + size]]
        want += [any(len(a & b) >= threshold * len(a | b) - 1e-9 for a in own[:j]) for j, b in enumerate(own)]
        low += size
    monkeypatch.setattr(lines, "PAIRS", most)
    monkeypatch.setattr(lines, "ALL_PAIRS", all_pairs)
    n = np.array([len(x) for x in sets])
    assert lines.similar_by_pairs(np.concatenate(sets), n, np.array(sizes), threshold).tolist() == want and 0 < sum(want) < len(want) - len(sizes)
    packed = [x.view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for x in sets]
    place = list(range(len(sets)))
    table = pa.table({"grp": np.repeat(np.arange(len(sizes)), sizes), "k1": place, "k2": place, "tokens": packed})
    # a row that comes twice is passed over
    table = table.take(pa.array(sorted([*place, 3, 40])))
    for rows in (10, 1000):
        got = [k for b in lines._compare(threshold, rows)(table.to_batches(max_chunksize=9)) for k in b.column(0).to_pylist()]
        assert sorted(got) == [i for i in place if want[i]]


def test_small_groups_take_little_time():
    """Most tokens are of two or three lines; a group at a time, numpy's calls would cost more than the comparison."""
    rng = random.Random(6)
    sizes, sets = families(rng, [2, 3] * 600, lambda: rng.randrange(40, 120))
    packed = [x.view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for x in sets]
    table = pa.table({"grp": np.repeat(np.arange(len(sizes)), sizes), "k1": range(len(sets)), "k2": range(len(sets)), "tokens": packed})

    def one_by_one():
        edge = np.cumsum([0, *sizes]).tolist()
        return [low + i for low, high in zip(edge, edge[1:]) for i in lines.similar_to_earlier(sets[low:high])]

    def at_once():
        return sorted(k for b in lines._compare(0.8, 4000)(table.to_batches()) for k in b.column(0).to_pylist())

    def seconds(run):
        began = time.process_time()
        assert run() == one
        return time.process_time() - began

    one = one_by_one()
    assert min(seconds(at_once) for _ in range(3)) < min(seconds(one_by_one) for _ in range(3)) / 2


# --- fingerprints


def plain_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def components(keys, linked):
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    groups = {}
    for i, k in enumerate(keys):
        groups.setdefault(find(i), []).append(k)
    return {k: min(g) for g in groups.values() for k in g}


def test_fingerprint_by_hand():
    for text in [None, "", " \t", "One", "a b", "A b C d a b c", "É é Ç\x0bx y z", "w " * 300]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("leaf", [20_000, 8])
def test_links_of_planted_fingerprints(spark, leaf):
    rng = random.Random(7)
    values = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(40):
        v = rng.getrandbits(64)
        values.add(v)
        for _ in range(rng.randrange(4)):
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                v ^= 1 << b
            values.add(v)
    shared = rng.getrandbits(64)
    values |= {shared ^ (rng.getrandbits(16)) for _ in range(40)}  # many of one block
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), leaf=leaf).collect()
    want = components(list(range(len(values))), lambda i, j: (values[i] ^ values[j]).bit_count() <= 3)
    place = {v: i for i, v in enumerate(signed)}
    edges = {(place[r["a"]], place[r["b"]]) for r in found}
    got = components(list(range(len(values))), lambda i, j: (i, j) in edges or (j, i) in edges)
    assert got == want


def test_simhash_components(spark):
    rng = random.Random(2)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(200)) for _ in range(10)]
    rows = [(i, base[i % 10] + (" extra" if i % 3 else "")) for i in range(40)] + [(50, None), (51, ""), (52, "  "), (3, base[3] + " extra"), (60, "long words " * 60_000)]
    got = {(r["doc_id"], r["fp"]): r["component"] for r in simhash.near_duplicates(frame(spark, rows).withColumn("fp", F.lit(0)), size=3).collect()}
    prints = [plain_fingerprint(t) for _, t in rows]
    want = components([(k, i) for i, (k, _) in enumerate(rows)], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    assert got == {(k, signed[i]): want[k, i][0] for i, (k, _) in enumerate(rows)}
    unnamed = simhash.near_duplicates(frame(spark, [(None, base[0]), (None, base[1]), (7, base[1])])).collect()
    assert sorted((r["doc_id"] or 0, r["component"] or 0) for r in unnamed) == [(0, 0), (0, 7), (7, 7)]


def test_keep_first(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(2000)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 200]))] for _ in range(30)]
    rows = []
    for i in range(120):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 3])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    rows += [(300, None), (301, ""), (302, rows[0][1])]
    got = {r["doc_id"] for r in simhash.keep_first(frame(spark, rows).selectExpr("doc_id", "text", "1 AS node", "2 AS key")).collect()}
    first = components([k for k, _ in rows], lambda i, j: simhash.jaccard(rows[i][1], rows[j][1]) >= 0.8)
    assert got == set(first.values())
    assert simhash.keep_first(frame(spark, [])).count() == 0


def test_keep_first_large_groups(spark):
    """Groups of edited copies that are alike to an original, less so to one another: every proposal counts."""
    rng = random.Random(5)
    rows = []
    for g, (n, length) in enumerate([(40, 200)] * 4 + [(25, 60)] * 4):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(length)]
        copies = []
        for _ in range(n):
            words = list(base)
            for _ in range(rng.randrange(1, 5 * length // 200 + 1)):
                words[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
            copies.append(" ".join(words))
        rows += [(1000 * g + i, text) for i, text in enumerate([*copies, " ".join(base)])]
    want = components([k for k, _ in rows], lambda i, j: rows[i][0] // 1000 == rows[j][0] // 1000 and simhash.jaccard(rows[i][1], rows[j][1]) >= 0.8)
    for leaf in (20_000, 16):  # the second deals groups to parts
        # every bit pattern is within this radius, so that only the decisions are tested
        got = {r["doc_id"] for r in simhash.keep_first(frame(spark, rows), radius=simhash.BITS, leaf=leaf).collect()}
        assert got == set(want.values())


def test_keep_first_equal_fingerprints():
    """Rows of one fingerprint are all compared, not only neighbours in order."""
    texts = ["a b c d e f g h i j k l", "z y x w v u t s r q p o", "a b c d e f g h i j k l m"]
    packed = [simhash.zstandard.ZstdCompressor().compress(t.encode()) for t in texts]
    table = simhash.pa.table({"node": [7, 8, 9], "fp": [5, 5, 5], "before": simhash.pa.array([[], [], []], simhash.pa.list_(simhash.pa.int64())), "tree": [True] * 3, "ask": [True] * 3, "packed": packed})
    assert simhash._decided(table, 16, 5, 0.8).to_pylist() == [{"a": 7, "b": 9}]
