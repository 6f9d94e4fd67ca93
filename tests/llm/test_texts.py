"""Text operators against brute force, round trips and held-out accuracy, and their defined cases."""

import hashlib
import json
import math
import random
import re
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from pointlane.llm import bpe, langid, lines, minhash, mixing, sharding, toxicity
from pointlane.llm._components import connected_components
from pointlane.llm._text import text_bytes, word_hashes

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 60_000
#: Names that operators use inside.
CLASHES = (
    "size", "score", "ids", "node", "component", "n_lines", "n_dropped", "sid", "key", "key1", "times", "row_number", "lang_pred", "bits_per_byte", "label", "toxic", "bytes", "of", "held_out", "text_key",
    "line_no", "form", "leaf", "first", "place", "taken", "slot", "block", "rank", "target", "sig", "short", "grp", "bucket", "n_tokens", "decoded", "shard", "law", "h", "part", "row", "copies",
    "__key", "__id", "__drops", "__text", "__of", "__slot", "__lines", "__dropped", "__row", "__kept", "__in", "__own_score", "carried", "drops", "drop_id", "kept_id", "row_key", "name", "shared", "of_row", "at_slot",
)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, clashing extra columns."""
    rows = [
        (1, "The same line here stays.\nx", "en", "a", 5), (1, "The same line here stays.\nx", "en", "a", 5), (2, None, None, None, None), (3, "", "en", "b", 0), (4, LONG, "en", "b", 9),
        (None, "no id at all here", "en", None, 1), (5, "???", None, "a", 3), (5, "another text of id five", "en", "a", 3), (6, " \n\t", "fr", "c", 2), (7, "one", "fr", "c", 3),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    for name in CLASHES:
        frame = frame.withColumn(name, F.lit("clash"))
    return frame.withColumns({"a map": F.create_map(F.lit("k"), F.col("n_chars")), "an array": F.array(F.col("lang")), "a struct": F.struct("source", F.lit(1).alias("x"))})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def test_word_hashes_depend_on_the_word_alone():
    texts = ["Ab c  ab", "", "c\nAB é", LONG]
    hashes, firsts = word_hashes(*text_bytes(pa.array(texts)))
    flat = [w for t in texts for w in words(t)]
    assert len(hashes) == len(flat) and firsts.tolist() == [0, 3, 3, 6, 6 + 60_000]
    by_word = {}
    for w, h in zip(flat, hashes.tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_ppm_probabilities_sum_to_one_and_match_a_direct_count():
    raw = b"\n\n\nabracadabra abra"
    grams = Counter(int.from_bytes(raw[k : k + 4], "big") for k in range(len(raw) - 3))
    lang, keys, n = ["x"] * len(grams), np.array(list(grams)), np.array(list(grams.values()), float)
    model = langid.freeze(lang, keys, n)
    for context in (b"abr", b"bra", b"zab", b"zza", b"zzz"):
        column = pa.array([(context + bytes([c])).decode() for c in range(128)])
        alone, _ = langid.code_lengths(model, pa.array([context.decode()]))
        assert (2.0 ** (alone[0, 0] - langid.code_lengths(model, column)[0][:, 0])).sum() < 1 + 1e-4
    # Many languages in panels cost each text what each of them alone does.
    many = langid.freeze([f"l{k:02}" for k in range(9) for _ in keys], np.tile(keys, 9), np.concatenate([n * (k + 1) for k in range(9)]))
    column = pa.array(["abracad", "", "xyz abra é"])
    assert len(many.panels) == 3 and many.langs == [f"l{k:02}" for k in range(9)]
    for k in (0, 5, 8):
        assert np.allclose(langid.code_lengths(langid.freeze(lang, keys, n * (k + 1)), column)[0][:, 0], langid.code_lengths(many, column)[0][:, k], atol=1e-3)
    text = b"abrak"
    counts = {}
    for k in range(3, len(raw)):
        for n in range(4):
            counts.setdefault(raw[k - n : k], Counter())[raw[k]] += 1

    def prob(context, symbol):
        lower = (lambda s: prob(context[1:], s)) if context else (lambda s: 1 / 256)
        seen = counts.get(context)
        if not seen:
            return lower(symbol)
        n, d = sum(seen.values()), len(seen)
        if symbol in seen:
            return seen[symbol] / (n + d)
        return d / (n + d) * lower(symbol) / (1 - sum(lower(s) for s in seen))

    padded = b"\n\n\n" + text
    exact = -sum(np.log2(prob(padded[k - 3 : k], padded[k])) for k in range(3, len(padded)))
    bits, sizes = langid.code_lengths(model, pa.array([text.decode()]))
    assert sizes[0] == 5 and abs(bits[0, 0] - exact) < 1e-3


def test_language_id_held_out(documents):
    out = langid.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (out.lang_pred == out.lang).mean() > 0.9


def test_language_id_cases(odd, none, documents):
    model = langid.train(documents)
    out = langid.predict(odd, model, keep=["doc_id", "lang_pred"]).toPandas()
    assert len(out) == 10 and (out.lang_pred == "und").sum() == 4 and out.score.between(0, 1).all()
    assert langid.identify(none).count() == 0
    assert set(langid.predict(odd, langid.train(none)).toPandas().lang_pred) == {"und"}
    assert langid.accept(none).columns == none.columns
    from pyspark.sql import functions as F

    clash = documents.select("*", F.lit("own").alias("score"), F.lit("own").alias("lang_pred"), F.lit("own").alias("bits_per_byte"))
    back = langid.accept(clash)
    assert back.columns == clash.columns and {tuple(r) for r in back.select(*langid.VERDICT).distinct().collect()} == {("own",) * 3}
    kept = langid.accept(documents)
    assert kept.count() >= 0.97 * documents.where("text rlike '[a-z]'").count() and kept.columns == documents.columns


def test_toxicity(spark, documents, odd, none):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = toxicity.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert out.predicted[out.toxic == 1].mean() > 0.9 and out.predicted[out.toxic == 0].mean() < 0.05
    assert out.toxic_in_lang[out.toxic == 1].mean() > 0.85 and out.toxic_in_lang[out.toxic == 0].mean() < 0.05
    odd_out = toxicity.classify(odd, labels).toPandas()
    assert len(odd_out) == 10 and odd_out.score.between(0, 1).all()
    assert toxicity.classify(none, labels).count() == 0
    assert toxicity.classify(docs, labels.limit(0)).toPandas().predicted.sum() == 0
    cuts = toxicity.calibrate(spark.createDataFrame([(0.9, "a", 1), (0.1, "a", 0), (0.4, "b", 1), (0.3, "b", 0)], "score double, lang string, label int")).toPandas()
    assert cuts.f1.tolist() == [1, 1] and all(0 < t <= 1 for t in cuts.threshold)


def test_toxicity_forward_and_gradients_against_plain_python():
    rng = np.random.default_rng(3)
    t = toxicity
    texts = [np.stack([rng.integers(0, 20, n), rng.integers(t.BUCKETS, t.BUCKETS + 9, n)], 1).astype(np.int32) for n in (1, 2, 7, 30)]
    embed = np.zeros((t.BLANK + 1, t.DIM))
    embed[:20], embed[t.BUCKETS : t.BUCKETS + 9] = rng.standard_normal((20, t.DIM)), rng.standard_normal((9, t.DIM))
    size = len(t.WIDTHS) * t.FILTERS
    model = t.CnnModel(embed, [rng.standard_normal((w, t.DIM, t.FILTERS)) for w in t.WIDTHS], rng.standard_normal(size), rng.standard_normal(size), 0.2)

    def plain(ids):
        """A window may run beyond the text's end, where words count as nothing."""
        at = lambda k: model.embed[ids[k, 0]] + model.embed[ids[k, 1]] if k < len(ids) else np.zeros(t.DIM)
        last = len(ids) + max(max(t.WIDTHS) - 1, 1)  # the gap between texts is part of the pooled range
        tops = [max(sum(float(at(k + j) @ f[j][:, c]) for j in range(w)) for k in range(last)) for w, f in zip(t.WIDTHS, model.filters, strict=True) for c in range(t.FILTERS)]
        hidden = np.maximum(np.array(tops) + model.bias, 0)
        return 1 / (1 + np.exp(-(hidden @ model.out + model.base)))

    firsts = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    ids, starts = t._spread(np.concatenate(texts), firsts)
    p, hidden, raw, x, spots = t.forward(model, ids, starts)
    wanted = [plain(x) for x in texts]
    assert np.allclose(p, wanted) and np.allclose(t.score_ids(model, model.tables(), np.concatenate(texts), firsts), wanted, atol=1e-5)
    y = np.array([1, 0, 1, 0])
    loss = lambda: -np.log(np.where(y == 1, q := t.forward(model, ids, starts)[0], 1 - q)).sum()
    grads, rows, values = t.backward(model, ids, p - y, hidden, raw, x, spots)
    dense = np.zeros_like(embed)
    np.add.at(dense, rows, values)
    dense[t.BLANK] = 0
    for array, grad in [*zip([*model.filters, model.bias, model.out], grads, strict=True), (model.embed, dense)]:
        live = np.argwhere(np.abs(grad) > 1e-6)
        for at in live[rng.choice(len(live), min(6, len(live)), replace=False)].tolist():
            at, was = tuple(at), array[tuple(at)]
            array[at] = was + 1e-6
            up = loss()
            array[at] = was - 1e-6
            down = loss()
            array[at] = was
            assert abs((up - down) / 2e-6 - grad[at]) < 1e-4 * max(1, abs(grad[at]))


def test_toxicity_sample_is_bounded_and_leaves_rows_for_thresholds(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('some words ', 20) || id AS text").union(spark.sql("SELECT 7L, 'same text' FROM range(5000)"))
    labels = spark.range(4000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    drawn = toxicity.draw(docs, labels, sample_docs=10**6, sample_bytes=50_000)
    rows = drawn.join(docs.selectExpr("doc_id", "text", "xxhash64(text) AS key").distinct(), ["doc_id", "key"]).toPandas()
    assert 60_000 < rows.text.str.len().sum() < 140_000 and not rows.duplicated(["doc_id", "key"]).any()
    known = toxicity.known_labels(labels).toPandas()
    assert 0.1 < known.apart.mean() < 0.2 and not set(known[known.apart].doc_id) & set(rows.doc_id)


def test_bpe_equals_the_tokenizers_library(spark, documents, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    reference, own = Tokenizer.from_file(path), bpe.ByteBpe(bpe.load(path))
    rng = random.Random(9)
    pool = [chr(c) for c in [*range(0, 0x250), 0x2028, 0x3000, 0x85, 0x1F600, 0x4E2D, 0x0661, 0xFEFF]]
    texts = ["".join(rng.choice(pool) if rng.random() < 0.3 else rng.choice(" \n\tabethin'sdlmv019.,<|") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += [t[:9] + "<|endoftext|>" + t[9:] for t in texts[:200]] + ["a" * 5000, " " * 300 + "x", LONG]
    for text, ids, wanted in zip(texts, own.encode(texts), reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == wanted.ids, text[:50]
        assert own.decode(ids) == reference.decode(wanted.ids, skip_special_tokens=False)
    # Words and texts beyond what is kept or encoded at once.
    long = ["".join(rng.choice("acgt") for _ in range(40_000)), " ".join("ab" * rng.randint(1, 50) for _ in range(200_000)) + "<|endoftext|>x"]
    for text, ids in zip(long, own.encode(long), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids
    assert max(map(len, own.words)) <= bpe.LONGEST_CACHED
    spec = json.loads(bpe.load(path))
    with pytest.raises(ValueError, match="normalizer"):
        bpe.ByteBpe(json.dumps(spec | {"normalizer": {"type": "NFC"}}))
    for frame in (documents, odd):
        got = sorted(map(tuple, bpe.round_trip(frame, path).collect()), key=str)
        want = []
        for r in frame.collect():
            ids = reference.encode(r["text"] or "", add_special_tokens=False).ids
            want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        assert got == sorted(want, key=str)
    assert bpe.round_trip(none, path).count() == 0


def test_bpe_memory_of_one_long_word():
    """In a process of its own: 2 MB of letters without a break."""
    code = (
        "import random, resource, public_tokenizers\nfrom pointlane.llm import bpe\n"
        "own = bpe.ByteBpe(bpe.load(public_tokenizers.path('byte_bpe_50k.json')))\nbefore = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "text = ''.join(random.Random(1).choices('acgt', k=2_000_000))\nids = own.encode([text])[0]\nassert own.decode(ids) == text\n"
        "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True, cwd=Path(__file__).parents[2])
    assert int(out.stdout) < 400


def plain_feistel(row, n, seed, rounds=6):
    """The definition, with Python's numbers alone."""
    mask = (1 << 64) - 1
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)

    def mixed(x, key):
        x = (x + key) * 0x9E3779B97F4A7C15 & mask
        x ^= x >> 29
        x = x * 0xBF58476D1CE4E5B9 & mask
        return x ^ x >> 32

    while True:
        left, right = divmod(row, b)
        for k in range(rounds):
            key = (seed * rounds + k + 1) * 0xD1342543DE82EF95 & mask
            if k % 2:
                right = (right + mixed(left, key) % b) % b
            else:
                left = (left + mixed(right, key) % a) % a
        row = left * b + right
        if row < n:
            return row


def test_feistel_against_plain_python():
    for n, seed in ((2, 0), (10, 1), (1000, 0), (65_537, 7), (10**12 + 39, 3)):
        rows = np.unique(np.linspace(0, n - 1, 300).astype(np.int64))
        assert sharding.permute(rows, n, seed).tolist() == [plain_feistel(int(r), n, seed) for r in rows]


def test_feistel_is_a_bijection_and_shards_are_even(documents, odd, none):
    for n in (1, 2, 3, 7, 100, 1000, 4097):
        assert sorted(sharding.permute(np.arange(n), n).tolist()) == list(range(n))
    for frame in (documents, odd):
        out = sharding.shard(frame, 16).toPandas()
        again = sharding.shard(frame.repartition(7), 16).toPandas()
        key = lambda d: sorted(map(tuple, d[["doc_id", "size", "text_crc32", "shard", "slot"]].fillna(-1).to_numpy().tolist()))
        assert key(out) == key(again)
        n = out.groupby("shard").slot
        sizes = [n.get_group(s).shape[0] if s in n.groups else 0 for s in range(16)]
        assert max(sizes) - min(sizes) <= 1 and all(sorted(g) == list(range(len(g))) for _, g in n)
        want = sorted((len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in frame.collect())
        assert sorted(zip(out["size"].tolist(), out.text_crc32.tolist(), strict=True)) == want
    assert sharding.shard(none).count() == 0


def brute_near(rows, width, percent):
    sets = {}
    for doc_id, text in rows:
        w = words(text)
        s = set() if not w else {tuple(w)} if len(w) < width else {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
        sets.setdefault(doc_id, []).append(s)
    up = {d: d for d in sets if d is not None}

    def find(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(up)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return find


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_minhash_against_brute_force(spark, documents, width, percent):
    rng = random.Random(6)
    base = [rng.choice("abcdefghijklmnop") + str(rng.randint(0, 300)) for _ in range(120)]
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    for k in range(250):  # one large group of near copies of differing closeness
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = str(rng.random())
        rows.append((10_000 + k, " ".join(w)))
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width, percent).toPandas().set_index("doc_id")
    find = brute_near(rows, width, percent)
    assert out.component_id.to_dict() == {d: find(d) for d, _ in rows}
    assert (out.kept == (out.index == out.component_id)).all()


def test_chain_of_loose_mates_makes_no_group():
    """20,000 documents, each half like the next: their bands collide along a chain, yet tiles grow with their number alone."""
    rng = np.random.default_rng(2)
    sig = rng.integers(0, 1 << 32, (20_000, minhash.HASHES), dtype=np.uint32)
    for k in range(1, len(sig)):  # half of the minima are the neighbour's
        same = rng.random(minhash.HASHES) < 0.5
        sig[k, same] = sig[k - 1, same]
    bands, rows = minhash.choose_bands(85)
    band = sig[:, : bands * rows].reshape(len(sig), bands, rows)
    hit = (band[1:] == band[:-1]).all(2).any(1)
    assert hit.mean() > 0.2  # many do share a bucket
    counted = []
    for n in (5_000, 20_000):
        members = [(int(b), int(k)) for b in range(bands) for k in range(n - 1) if (band[k + 1, b] == band[k, b]).all()]
        table = pa.table({
            "bucket": pa.array(np.repeat(np.arange(len(members)), 2)), "tile_i": pa.array([0] * 2 * len(members), pa.int32()), "tile_j": pa.array([0] * 2 * len(members), pa.int32()), "chunk": pa.array([0] * 2 * len(members), pa.int32()),
            "node": pa.array([k + d for _, k in members for d in (0, 1)]), "n_shingles": pa.array([100] * 2 * len(members)), "short": pa.array([sig[k + d].astype("<u2").tobytes() for _, k in members for d in (0, 1)], pa.binary()),
        })
        found = [x for x in minhash._pruned(iter(table.to_batches(max_chunksize=999)), 85, minhash.least_matches(85, 1e-5))]
        assert sum(x.num_rows for x in found) == 0
        counted.append(len(members))
    assert 3.5 < counted[1] / counted[0] < 4.5


def test_survivors_connect_what_plain_pairs_connect():
    rng = np.random.default_rng(4)
    sig = rng.integers(0, 1 << 16, (300, minhash.HASHES)).astype("<u2")
    for k in range(40, 300):  # groups of near copies of differing closeness
        other = int(rng.integers(0, 40))
        same = rng.random(minhash.HASHES) < rng.choice([0.5, 0.8, 0.95])
        sig[k, same] = sig[other, same]
    sizes, least = rng.integers(90, 110, 300), minhash.least_matches(85, 1e-5)
    runs = [3, 20, 33, 100, 144]
    bucket = np.repeat(np.arange(len(runs)), runs)
    table = pa.table({"bucket": bucket, "tile_i": np.zeros(300, np.int32), "tile_j": np.zeros(300, np.int32), "chunk": np.zeros(300, np.int32), "node": np.arange(300), "n_shingles": sizes, "short": pa.array([s.tobytes() for s in sig], pa.binary())})

    def parts(edges):
        up = list(range(300))
        for a, b in edges:
            x, y = up[a], up[b]
            up = [x if u == y else u for u in up]
        first = {}
        return [first.setdefault(u, k) for k, u in enumerate(up)]

    found = [(a, b) for x in minhash._pruned(iter(table.to_batches(max_chunksize=7)), 85, least) for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True)]
    plain = []
    for a in range(300):
        for b in range(a + 1, 300):
            same = np.cumsum((sig[a] == sig[b]).reshape(-1, minhash.BATCH).sum(1))
            if bucket[a] == bucket[b] and 100 * min(sizes[a], sizes[b]) >= 85 * max(sizes[a], sizes[b]) and all(s >= least[minhash.BATCH * (k + 1)] for k, s in enumerate(same)):
                plain.append((a, b))
    assert plain and len(found) < len(plain) and parts(found) == parts(plain)


def test_near_copies_meet_their_hub_alone(spark):
    """A bucket of near copies needs no tile; one whose hub is an outlier still finds the others, with its largest part never at home."""
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 16, (2, minhash.HASHES)).astype("<u2")
    nodes, mates = [(0, 100, rng.integers(0, 1 << 16, minhash.HASHES).astype("<u2").tobytes())], [(2, 0)]
    for k in range(1, 301):
        nodes.append((k, 100, base[int(k % 3 == 0)].tobytes()))
        mates += [(1, k), (2, k)] if k % 3 else [(2, k)]
    mates.append((3, 0))
    mates.append((3, 1))
    nodes = spark.createDataFrame(nodes, "node long, n_shingles long, short binary")
    mates = spark.createDataFrame(mates, "bucket long, node long")
    least = minhash.least_matches(85, 1e-5)
    met = minhash.stars(mates, nodes, 85, least)
    assert {tuple(r) for r in met.collect()} == {(k, 1) for k in range(2, 301) if k % 3}
    rest = minhash.apart(mates, connected_components(met)).collect()
    assert {r.bucket for r in rest} == {2} and len(rest) == 301
    assert {r.node for r in rest if r.home} == {0, *range(3, 301, 3)}


def test_minhash_cases(odd, none):
    out = minhash.near_duplicates(odd, 3, 85).toPandas()
    assert len(out) == 10 and out[out.doc_id == 1].component_id.tolist() == [1, 1]
    assert out[out.doc_id.isin([2, 3, 6])].n_shingles.tolist() == [0, 0, 0] and out[out.doc_id.isna()].kept.all()
    assert minhash.near_duplicates(none).count() == 0
    # Only the repeated row of id 1 goes; the two texts of id 5 are unlike.
    assert minhash.one_of_each(odd).count() == 9 and minhash.one_of_each(odd).columns == odd.columns


def test_one_of_each_keeps_clean_texts_of_a_repeated_id(spark):
    copied, clean = (" ".join(f"{c}{k}" for k in range(40)) for c in "xy")
    rows = [(3, copied, "a"), (5, copied, "a"), (5, clean, "b"), (5, clean, "a"), (7, clean + " end", "a"), (None, copied, "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for n in (1, 4):
        got = sorted((tuple(r) for r in minhash.one_of_each(frame.repartition(n)).collect()), key=str)
        assert got == sorted([rows[0], rows[3], rows[5]], key=str)


def test_bayes_bounds_keep_pairs_at_the_threshold():
    least = minhash.least_matches(85, 1e-5)
    rng = np.random.default_rng(1)
    hits = rng.random((100_000, 128)) < 0.85
    kept = np.ones(len(hits), bool)
    for n in range(16, 129, 16):
        kept &= hits[:, :n].sum(1) >= least[n]
    assert kept.mean() > 0.999
    assert all(b - a in (0, 1) for a, b in zip(least, least[1:], strict=False)) and least[128] > 80


def test_lines(spark, odd, none):
    body = lambda k: " ".join(c * n + "abcdefgh"[k] for n, c in enumerate("ypqrstuvw", 1))[k % 3 * 2 :] + " " + "abcdefgh"[k] * 4
    rows = [(k, f"{body(k)}\nPage {k} of {k + 10} printed on host\nuser {'abcdefgh'[k] * 3} logged in from the main gate\n\n}}") for k in range(8)]
    rows += [(20, "solo copied text of four words\nhas two lines to keep")] * 3 + [(21 + k, "solo copied text of four words\nhas two lines to keep") for k in range(5)]
    out = {r["doc_id"]: r for r in lines.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), depth=1, min_texts=4).collect()}
    assert out[0]["text"] == rows[0][1] and out[0]["n_dropped"] == 0
    for k in range(1, 8):
        assert out[k]["text"] == f"{body(k)}\n\n}}" and (out[k]["n_lines"], out[k]["n_dropped"]) == (5, 2)
    assert out[20]["n_dropped"] == 0 and out[25]["n_dropped"] == 0
    got = lines.deduplicate(odd)
    assert got.count() == 10 and got.where("text IS NULL").count() == 1 and set(odd.columns) <= set(got.columns)
    assert lines.deduplicate(none).count() == 0


def test_literal_lines_of_two_texts(spark):
    passage = " ".join(f"word{'abcdefgh'[k % 8] * (k // 8 + 1)}" for k in range(60))
    rows = [(1, f"own one\n{passage}\n}}"), (2, f"own two\n  {passage} \n}}"), (3, f"own three\n}}\n{passage}"), (4, "same text of four\nin two rows here"), (5, "same text of four\nin two rows here"), (None, f"{passage}\nno id")]
    out = {r["doc_id"]: r["text"] for r in lines.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), drops=lines.repeats).collect()}
    assert out == {1: rows[0][1], 2: "own two\n}", 3: "own three\n}", 4: rows[3][1], 5: rows[4][1], None: "no id"}


def test_pipeline_drops_lines_of_two_texts(spark):
    import corpus_pipeline as pipeline

    own = lambda k: " ".join(f"{k}{c}" for c in "abcdefghijklmnopqrstuvwxyz" * 2)
    shared = " ".join(f"s{k}" for k in range(30))
    rows = [(k, f"{own(k)}\n{shared}", "en", "a", 9) for k in (1, 2)] + [(3, f"{own(3)}\n{shared[:-1]}!", "en", "a", 9)]
    out = {r["doc_id"]: r for r in pipeline.near_dedup(spark, spark.createDataFrame(rows, DOCS), "").collect()}
    assert out[1]["text"] == rows[0][1] and out[2]["text"] == own(2) and out[2]["n_chars"] == len(own(2)) and out[3]["text"] == rows[2][1]


@pytest.mark.parametrize(("n", "values"), [(100, 3000), (8000, 100), (40000, 3000)])
def test_template_drops_alike_at_every_size(spark, n, values):
    import corpus_pipeline as pipeline
    from pyspark.sql import functions as F

    letters = lambda c: F.translate(F.pmod(F.xxhash64(F.lit(c), "doc_id"), F.lit(values)).cast("string"), "0123456789", "abcdefghij")
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("lang")).withColumn("own", F.translate(F.col("doc_id").cast("string"), "0123456789", "klmnopqrst"))
    rows = rows.withColumn("text", F.concat(F.col("own"), F.lit("\nthe user named "), letters(1), F.lit(" logged in from host "), letters(2), F.lit(" by the gate"))).drop("own")
    out = pipeline.line_dedup(spark, rows, "")
    assert out.where("text like '%logged%'").count() == 1 and out.count() == n


def test_mixing(spark, documents, odd, none):
    rows = documents.select("doc_id", "text", "source")
    out = mixing.mix(rows).join(rows.select("doc_id", "source"), "doc_id").toPandas()
    assert out["size"].tolist() == [len(words(t)) for t in (rows.toPandas().set_index("doc_id").text.loc[out.doc_id])]
    by = out.groupby("source").agg(size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"), own=("size", "sum"))
    assert (by["size"] == by.own).all() and abs(by.target.sum() - by.own.sum()) < 1e-3
    assert ((by.taken - by.target).abs() <= 0.5).all()
    assert (out.taken <= 3 * out["size"]).all() and (by.target <= 3 * by.own + 1e-6).all()
    # water filling by hand
    w = dict(zip(sorted(by.index), [5, 2, 1] * 99, strict=False))
    full, total = set(), float(by.own.sum())
    while True:
        level = (total - sum(3 * by.own[s] for s in full)) / sum(w[s] for s in by.index if s not in full)
        more = {s for s in by.index if s not in full and w[s] * level > 3 * by.own[s]}
        if not more:
            break
        full |= more
    for s in by.index:
        assert abs(by.target[s] - (3 * by.own[s] if s in full else w[s] * level)) < 1e-6 * total
    assert sorted(mixing.mix(rows.repartition(5)).toPandas().taken) == sorted(out.taken)
    cases = mixing.mix(odd).toPandas()
    assert len(cases) == 10 and (cases.taken <= 3 * cases["size"]).all() and mixing.mix(none).count() == 0
    mixed = mixing.mixed(documents)
    assert mixed.columns == documents.columns
    clash = mixing.mixed(odd).collect()
    assert len(clash[0]) == len(odd.columns) and {r["doc_id"] for r in clash if not words(r["text"])} == {2, 3, 6}
    assert mixing.mixed(none).count() == 0


def test_mix_meets_small_targets_beside_a_huge_source(spark):
    from pyspark.sql import functions as F

    huge = spark.range(60).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 80_000).alias("text"), F.lit("a").alias("source"))
    sizes = {"b": 300, "c": 2000, "d": 5000, "e": 20_000}
    for k, (source, n) in enumerate(sizes.items()):
        huge = huge.union(spark.range(20).select(F.col("id") + 1000 * (k + 1), F.repeat(F.lit("w "), n // 20), F.lit(source)))
    for block in (64, 8192):  # blocks far below and far above the small sources
        by = mixing.mix(huge, words=block).groupBy("source_size").agg(F.max("target").alias("target"), F.sum("taken").alias("taken")).collect()
        assert len(by) == 5 and all(abs(r["taken"] - r["target"]) <= 0.5 for r in by)
    got = dict(map(tuple, mixing.mixed(huge).groupBy("source").agg(F.sum(mixing.word_count())).collect()))
    assert all(got[s] == 3 * n for s, n in sizes.items())


def test_mix_of_rows_without_ids(spark):
    """A third of the rows share the null id and the text; none counts twice, none is lost, and stretches follow the mix."""
    from pyspark.sql import functions as F

    rows = spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id, 'same five words in here' AS text, 'a' AS source FROM range(3000)")
    rows = rows.union(spark.sql("SELECT id, repeat('w ', CAST(id % 9 AS INT)), IF(id % 2 = 0, 'a', 'b') FROM range(6000)"))
    plan = mixing.mix(rows, words=32).toPandas()
    by = plan.groupby("source_size").agg(target=("target", "first"), taken=("taken", "sum"))
    assert len(plan) == 9000 and ((by.taken - by.target).abs() <= 0.5).all() and (plan[plan.doc_id.isna()]["size"] == 5).sum() == 3000
    # The first of ties by slot is the first taken, and every stretch of slots is near the mix.
    first = plan[(plan["size"] > 0) & (plan.taken >= plan["size"])].sort_values("first_slot")
    half = first[first.first_slot < first.first_slot.median()]
    share = lambda d: d[d.source_size == plan.source_size.max()]["size"].sum() / d["size"].sum()
    assert abs(share(half) - by.target[plan.source_size.max()] / by.target.sum()) < 0.05
    out = mixing.mixed(rows).groupBy("source").agg(F.sum(mixing.word_count()).alias("n")).collect()
    targets = dict(zip(plan.source_size, plan.target, strict=True))
    own = dict(map(tuple, rows.groupBy("source").agg(F.sum(mixing.word_count())).collect()))
    assert all(abs(r["n"] - targets[own[r["source"]]]) <= 5 for r in out)
    assert mixing.mixed(rows).where("text = ''").count() == 667


def test_language_id_rejects_languages_it_has_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    foreign = {
        "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "zh": "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
        "nl": "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten.",
    }
    rows = spark.createDataFrame([(-k, t, None, "x", 1) for k, t in enumerate(foreign.values(), 1)], DOCS)
    kept = langid.accept(docs.union(rows))
    assert kept.where("doc_id < 0").count() == 0 and kept.count() >= 0.9995 * docs.where("text rlike '[[:alpha:]]'").count()


def stage_functions():
    import corpus_pipeline

    return corpus_pipeline.STAGES


@pytest.mark.parametrize("name", ["language_id", "line_dedup", "minhash_near_dedup", "mixing", "bpe"])
def test_pipeline_stages_keep_odd_columns_and_empty_tables(spark, odd, none, name):
    stage = dict(stage_functions())[name]
    got = stage(spark, odd, SF)
    if name != "bpe":
        assert got.columns == odd.columns and got.schema["a map"].dataType == odd.schema["a map"].dataType
        rows = got.collect()
        assert all(r[c] == "clash" for r in rows for c in CLASHES) and len(rows) >= 1
        # Foreign columns stay with their rows.
        assert all(r["an array"] == [r.lang] and r["a struct"].source == r.source and r["a map"].keys() == {"k"} for r in rows)
    else:
        assert got.count() == odd.count()
    assert stage(spark, none, SF).count() == 0


def test_documents_of_one_name_are_kept(spark):
    from pyspark.sql import functions as F

    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, text), (2, text), (3, text + " more"), (4, "quite another text of other words than those")], "doc_id long, text string")
    few = lambda rows: sorted(r.doc_id for r in rows.collect())
    assert few(minhash.survivors(docs)) == [1, 4]
    assert few(minhash.survivors(docs, name=lambda: F.when(F.col("doc_id") < 3, 7).otherwise(F.col("doc_id")).cast("long"))) == [1, 2, 3, 4]
    assert few(minhash.survivors(docs, name=lambda: F.lit(1).cast("long"))) == [1, 2, 3, 4]
