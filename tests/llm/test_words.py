"""Runs, filter audit and recurring passages against brute force, and their defined cases."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pointlane.llm import filter_audit, passages, runs
from pointlane.llm._words import spelled, split_words, word_ids

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string"
LONG = "word " * 60_000


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "a b c " * 30, "s"), (1, "a b c " * 30, "s"), (2, None, None), (3, "", "s"), (4, LONG, ""), (None, "x y z " * 20, None), (None, "x y z " * 20, "t"), (6, " \n\t", "t"), (7, "one", "t"), (8, "# HELLO WORLD é", "t")]
    frame = spark.createDataFrame(rows, DOCS)
    for name in ("words", "word_id", "shard", "rows", "facts", "runs", "part", "mask", "n", "good", "chunk", "piece", "low", "kept", "spans", "carried", "n_words"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_words_and_spelling():
    texts = ["Ab c  ab", "", None, " \x0b", "c\nAB é", "x", LONG, "ﬀ b c"]
    ids, vocabulary, first = word_ids(pa.array(texts))
    own = [WORD.findall(t or "") for t in texts]
    assert [vocabulary[i].as_py().decode() for i in ids] == [w for ws in own for w in ws] and np.diff(first).tolist() == [len(w) for w in own]
    assert len(vocabulary) == len({w for ws in own for w in ws})
    keep = np.array([k % 3 != 1 for k in range(len(ids))])
    flags = iter(keep)
    want = [" ".join([w for w in ws if next(flags)]) for ws in own]
    assert spelled(ids, vocabulary, first, keep).to_pylist() == want
    words, _ = split_words(pa.array([], pa.string()))
    assert len(words) == 0


def brute_runs(w):
    """(start, length, period) of the maximal repetitions, by trying every period."""
    n, found = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        k, n = rng.choice([1, 2, 2, 3, 5, 40]), rng.choice([0, 1, 23, 24, 25, 60, 200, 500])
        w = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randrange(4)):
            if n > 30:
                p, a, length = rng.randrange(1, rng.choice([6, n // 3 + 1])), rng.randrange(n), rng.randrange(n)
                for i in range(a + p, min(n, a + length)):
                    w[i] = w[i - p]
                if rng.random() < 0.3:
                    w[rng.randrange(n)] = rng.randrange(k)
        texts.append(w + w if rng.random() < 0.2 else w + w + w if rng.random() < 0.2 else w)
    flat = np.array(sum(texts, []), np.int64)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    owner, start, end, period = runs.runs(flat, first)
    total = 0
    for i, w in enumerate(texts):
        got = [(int(s - first[i]), int(e - s), int(q)) for s, e, q in zip(start[owner == i], end[owner == i], period[owner == i], strict=True)]
        assert got == brute_runs(w)
        total += len(got)
    assert total > 15


def test_runs_of_one_long_text():
    words = np.concatenate([np.zeros(300_000, np.int64), np.arange(1, 60_001), np.tile(np.arange(7), 20_000)])
    _, start, end, period = runs.runs(words, np.array([0, len(words)]))
    assert list(zip(start.tolist(), end.tolist(), period.tolist(), strict=True)) == [(0, 300_000, 1), (360_000, 500_000, 7)]


def wanted_runs(doc_id, text, plant=True):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found, keep = brute_runs(w) if n < 5000 else [(0, n, 1)], [True] * n
    for s, length, q in found:
        keep[s + q : s + length] = [False] * (length - q)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    digest = sha("".join(f"{s},{length},{q}\n" for s, length, q in found))
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, digest, sha(" ".join(x for x, k in zip(w, keep, strict=True) if k)))


def test_op11_equals_brute_force(spark, odd, none):
    from pointlane.llm.queries import op11_runs

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id for r in docs if len(WORD.findall(r.text or "")) < 2500}
    got = {r.doc_id: tuple(r) for r in op11_runs(spark, SF).collect()}
    assert len(got) == len(docs) and all(got[r.doc_id] == wanted_runs(r.doc_id, r.text) for r in docs if r.doc_id in short)
    assert sum(r[1] for r in got.values()) > 20
    plain = sorted(map(tuple, runs.summary(runs.detect(odd)).collect()), key=str)
    assert plain == sorted((wanted_runs(r.doc_id, r.text, False) for r in odd.collect()), key=str)
    assert runs.summary(runs.detect(none, plant=True)).count() == 0


def wanted_audit(docs, labels):
    texts = {}
    for d, t, _ in docs:
        if d is not None:
            texts[t or ""] = min(d, texts.get(t or "", d))
    good, toxic = ({d for d, q, t in labels if d is not None and (q, t)[k] == 1} for k in (0, 1))
    masks = []
    for d, t, s in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), d is not None and texts[t] < d)
        masks.append((s or "", "".join(x for x, f in zip("ABCDE", fails, strict=True) if f), d in good, d in toxic))
    out = []
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        removed_by, rows = Counter(), []
        for order in permutations("ABCDE"):
            left = own
            for k, x in enumerate(order):
                here = [m for m in left if x in m[1]]
                left = [m for m in left if x not in m[1]]
                removed_by[x] += len(here)
                rows.append(("".join(order), k + 1, len(left), len(here), sum(x in m[1] and any(y in m[1] for y in order[:k]) for m in own), sum(m[1] == x for m in own), sum(m[2] for m in here), sum(m[3] for m in here)))
        out += [(part, *r, removed_by[r[0][r[1] - 1]]) for r in rows]
    return sorted(out)


def test_filter_audit_equals_brute_force(spark, odd, none):
    labels = [(1, 1, 0), (1, 0, 1), (8, 1, None), (None, 1, 1), (7, None, 1), (99, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    assert sorted(map(tuple, filter_audit.audit(odd, frame).collect())) == wanted_audit(docs, labels)
    assert filter_audit.audit(none, frame).count() == 0
    assert filter_audit.audit(odd, frame.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_document_term_matrix(spark, odd, none):
    matrix = filter_audit.encode(odd.select("doc_id", "text"), ["doc_id"], shard_bytes=100)
    spelled_by = {r.word_id: bytes(r.word).decode() for r in matrix.words.collect()}
    assert len(spelled_by) == len(set(spelled_by.values())) == len({w for r in odd.collect() for w in WORD.findall(r.text or "")})
    got = []
    shards = matrix.shards.collect()
    assert len(shards) > 2
    for s in shards:
        at = 0
        for row, end in zip(s.rows, s.row_ends, strict=True):
            got.append((row.doc_id, {spelled_by[c]: n for c, n in zip(s.columns[at:end], s.counts[at:end], strict=True)}))
            at = end
    of = lambda d, counts: (str(d), sorted(counts.items()))
    assert sorted(of(d, c) for d, c in got) == sorted(of(r.doc_id, Counter(WORD.findall(r.text or ""))) for r in odd.collect())
    assert filter_audit.row_counts(filter_audit.encode(none, ["doc_id"])).count() == 0


def test_rows_of_the_matrix_are_summed_where_they_are_translated(odd):
    rows = filter_audit.row_counts(filter_audit.encode(odd.select("doc_id", "text"), ["doc_id"], shard_bytes=100))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # One Python worker a task; a shard's entries don't come back to the JVM for a second one.
    assert plan.count("FlatMapCoGroupsInArrow") == 1 and "MapInArrow" not in plan
    got = sorted((str(r.doc_id), r.n_words, r.n_distinct) for r in rows.collect())
    assert got == sorted((str(r.doc_id), len(w), len(set(w))) for r in odd.collect() for w in [WORD.findall(r.text or "")])


def wanted_passages(texts, window=35):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_passages_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    made = lambda n: [f"w{rng.randrange(50 if rng.random() < 0.2 else 5000)}" for _ in range(n)]
    shared = [made(rng.choice([34, 35, 36, 52, 53, 70, 300])) for _ in range(6)]
    texts = []
    for _ in range(80):
        parts = [made(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            s = rng.choice(shared)
            a = rng.randrange(max(1, len(s) - 35))
            parts += [s[a : a + rng.choice([30, 35, 36, 80, 400])], made(rng.choice([0, 1, 5, 40]))]
        texts.append(rng.choice([" ", "  ", "\n"]).join(sum(parts, [])))
    texts += ["again " * 90, "again " * 36, "again " * 35, None, "", " ".join(shared[0] * 3)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for size in (1000, 1 << 20):
        got = sorted(map(tuple, passages.digests(passages.remove_repeats(frame, chunk_bytes=size)).collect()))
        assert got == [(i, *w) for i, w in enumerate(wanted_passages(texts))]


def test_passages_of_odd_tables(spark, odd, none):
    got = passages.remove_repeats(odd)
    texts = [r.text for r in odd.collect()]
    want = Counter((r.doc_id, *w) for r, w in zip(odd.collect(), wanted_passages(texts), strict=True))
    assert Counter(map(tuple, passages.digests(got).collect())) == want
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in got.where("doc_id IN (4, 7)").collect()}
    assert spans == {4: [(0, 60_000)], 7: []}
    assert passages.remove_repeats(none).count() == 0


def test_locate_reads_every_place_of_a_tile():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 3, 4000)
    passage = text[100:260].copy()
    gone = passages.locate(text, np.array([0, 4000]), passage, np.array([0, 160]))
    held = {tuple(passage[i : i + 35]) for i in range(160 - 34)}
    want = np.zeros(4000, bool)
    for i in range(4000 - 34):
        if tuple(text[i : i + 35]) in held:
            want[i : i + 35] = True
    assert (gone == want).all() and gone.sum() >= 160
