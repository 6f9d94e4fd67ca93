"""WARC round trips; vector searches and joins against brute force; the pipeline."""

import base64
import hashlib

import numpy as np
import pytest

from pointlane.llm import ann, embedding_dedup, warc
from pointlane.llm._components import connected_components

PAGES = "page_id long, url string, html string, key string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("chunk", [7, 1000, 1 << 18])
def test_warc_round_trip(spark, chunk):
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\nWARC/1.1\r\n" * 3
    rows = [(1, "http://a/é", "same", "c"), (2, None, "same", "c"), (3, "u\r\nX: 1", None, None), (4, "u", "", "c"), (5, "u", tricky, "c"), (6, "u", "é" * 5000 + "\r\n\r\n", "c"), (None, "u", "same", "c"), (7, "u", "same", "c"), (1, "u", "same", "c"), (8, "u", tricky, "c")]
    frame = spark.createDataFrame(rows, PAGES)
    out = sorted((tuple(r) for r in warc.round_trip(frame, 0, chunk).collect()), key=str)
    first = {}
    for page, _, html, _ in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    want = []
    for page, _, html, _ in rows:
        own = page == first[html or ""]
        want.append((page, len((html or "").encode()), digest(html), "response" if own else "revisit", None if own else first[html or ""]))
    assert out == sorted(want, key=str)
    small = warc.round_trip(frame, 100, chunk).toPandas()
    assert (small[small.payload_bytes < 100].record_type == "response").all()
    assert warc.round_trip(frame.limit(0), 0, chunk).count() == 0


def test_warc_default_chunks_and_records_of_their_own(spark):
    rows = [(k, "u", f"{k} " * 200_000, "c") for k in range(3)] + [(9, "http://x/ WARC/1.1", None, "c"), (10, "v", "0 " * 200_000, "c")]
    path = warc.new_path(spark, "test")
    warc.write(spark.createDataFrame(rows, PAGES), path)
    chunks = warc.read(spark, path)
    assert chunks.agg({"chunk_no": "max"}).first()[0] == 1 and max(len(r["chunk"]) for r in chunks.collect()) == warc.CHUNK_BYTES
    out = {r["page_id"]: r for r in warc.pages(chunks).collect()}
    assert all(out[k]["payload_digest"] == digest(t) and out[k]["intact"] for k, _, t, _ in rows) and out[10]["refers_to"] == 0 and len(out) == 5
    text = "".join(r["value"] for r in spark.read.option("wholetext", True).text(path).collect())
    assert "WARC-Type: warcinfo" in text and "WARC-Refers-To-Target-URI: u" in text and "Content-Type: text/html" in text


def test_warc_reads_foreign_archives(spark, tmp_path):
    body = "see WARC/1.0 and WARC/1.1\r\nas text"
    records = [f"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <a{k}>\r\nWARC-Target-URI: u{k}\r\nContent-Length: {len(b)}\r\n\r\n{b}\r\n\r\n" for k, b in enumerate([body, "", "plain"])]
    (tmp_path / "a.warc").write_text("WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nxx\r\n\r\n" + "".join(records) + records[0][: -len(body)], newline="")
    got = warc.pages(warc.read(spark, str(tmp_path / "a.warc"))).collect()
    assert sorted((r["target_uri"], r["payload_digest"], r["intact"]) for r in got)[1:] == [("u0", digest(body), True), ("u1", digest(""), True), ("u2", digest("plain"), True)]
    assert not min((r for r in got), key=lambda r: r["intact"])["intact"]


def test_warc_chunks_carry_running_digests(spark):
    text = "0123456789" * 1000
    path = warc.new_path(spark, "test")
    warc.write(spark.createDataFrame([(1, "u", text, "c")], PAGES), path, 0, 999)
    chunks = warc.read(spark, path)
    rows = warc.digests(chunks).orderBy("chunk_no").collect()
    assert len(rows) == 11 and max(len(r["chunk"]) for r in chunks.collect()) == 999
    for r in rows:
        assert r["digest_so_far"] == digest(text[: 999 * (r["chunk_no"] + 1)]) and r["intact"]


def test_bounds_split_the_version_line():
    payload = b"x" * 5 + b"WARC/1.1\r\n" * 4
    parts = warc.bounds(payload, 1 << 20)
    assert b"".join(payload[a:b] for a, b in parts) == payload and all(b"WARC/1.1\r\n" not in payload[a:b] for a, b in parts)
    assert warc.bounds(b"", 10) == [(0, 0)]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1200, 24)).astype(np.float32)
    x[300:600] = x[:300] + 0.15 * rng.standard_normal((300, 24))
    x[600:800] = x[0] + 0.25 * rng.standard_normal((200, 24))
    x[800:900] = x[1]
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    rows += [(2000, None, 1), (2001, [0.0] * 24, 1), (2002, [float("nan")] * 24, 1), (2003, [None, *[1.0] * 23], None), (2004, [1.0, 2.0], 1), (None, x[3].tolist(), 1), (5, x[5].tolist(), 2)]
    return x, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_embedding_dedup_against_brute_force(spark, vectors, monkeypatch):
    x, frame = vectors
    monkeypatch.setattr(embedding_dedup, "TILE_ROWS", 150)
    out = embedding_dedup.near_duplicates(frame, block_dim=6).toPandas()
    n = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = n @ n.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(near, label[None], len(x)).min(1))
        if (new == label).all():
            break
        label = new
    links = near.sum(1) + near[:, 5] + (np.arange(len(x)) == 5)  # id 5 is there twice
    own = out[out.vec_id < 1200].drop_duplicates("vec_id").set_index("vec_id").sort_index()
    assert (own.component_id.to_numpy() == label).all() and (own.n_links.to_numpy() == links).all()
    rest = out[out.vec_id >= 2000]
    assert (rest.n_links == 0).all() and rest.kept.all() and len(out) == 1207
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_ann_recall(spark, vectors):
    from pyspark.sql import functions as F

    x, frame = vectors
    out = ann.search(frame, F.col("vec_id") % 20 == 0, k=10, rerank=60).toPandas()
    x = x.astype(float)
    hit = 0
    queries = range(0, 1200, 20)
    for q in queries:
        s = x @ x[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -s))[:10]
        own = out[out.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11)) and np.allclose(own.score, s[own.vec_id.to_numpy()], rtol=1e-12)
        assert (own.score.diff().dropna() <= 0).all()
        hit += len(set(best) & set(own.vec_id))
    assert hit / (10 * len(queries)) > 0.9 and not out.vec_id.isin(range(2000, 2005)).any()
    assert ann.search(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(frame.limit(3), F.col("vec_id") % 20 == 0).count() == 2


def test_ann_finds_all_in_a_hot_group(spark):
    """Two groups of a third of the rows each, near copies and exact copies: more than a block reranks."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(9)
    x = rng.standard_normal((3000, 24)).astype(np.float32)
    x[:1000] = x[0] + 0.05 * rng.standard_normal((1000, 24))
    x[1000:2000] = x[1000]
    ids = rng.permutation(3000)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")
    out = ann.search(frame, F.col("vec_id") % 20 == 0).toPandas()
    table = x.astype(float)[np.argsort(ids)]
    for q in range(0, 3000, 20):
        s = np.einsum("ij,j->i", table, table[q])
        s[q] = -np.inf
        assert out[out.query_id == q].sort_values("rank").vec_id.tolist() == np.lexsort((np.arange(3000), -s))[:20].tolist()


def test_beam_search_beats_greedy_coding():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((500, 16))
    books = ann.fit(x, books=4, words=16)
    error = lambda c: ((x - sum(books[m][c[:, m]] for m in range(4))) ** 2).sum()
    assert error(ann.encode(x, books, 8)) <= error(ann.encode(x, books, 1))


def test_components(spark):
    edges = [(k, k + 1) for k in range(100)] + [(200, k) for k in range(201, 260)] + [(300, 300)]
    out = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert out == {k: 0 for k in range(101)} | {k: 200 for k in range(200, 260)}


def test_pipeline(spark):
    import corpus_pipeline as pipeline
    import public_tokenizers
    from test_texts import brute_near, words

    from pointlane.llm import bpe

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    frames = [docs]
    for _, stage in pipeline.STAGES[:-1]:
        frames.append(pipeline.stored(stage(spark, frames[-1], ""), "stage"))
        assert frames[-1].columns == docs.columns
    n = [f.count() for f in frames]
    assert n[0] >= n[1] >= n[2] >= n[3] > 0 and n[1] >= 0.95 * n[0]
    lined, near = [f.collect() for f in frames[2:4]]
    find = brute_near([(r["doc_id"], r["text"]) for r in lined], 5, 80)
    assert sorted(r["doc_id"] for r in near) == sorted({r["doc_id"] for r in lined if find(r["doc_id"]) == r["doc_id"]})
    mixed = sorted(r["doc_id"] for r in frames[4].collect())
    total, before = sum(len(words(r["text"])) for r in frames[4].collect()), sum(len(words(r["text"])) for r in near)
    assert set(mixed) <= {r["doc_id"] for r in near} and 0.7 * before < total < 1.3 * before
    got = sorted(tuple(r[c] for c in ("doc_id", "n_tokens", "ids_sha256")) for r in pipeline.run(spark, "/root/testdata/sf0.001").collect())
    own = bpe.ByteBpe(bpe.load(public_tokenizers.path("byte_bpe_50k.json")))
    ids = own.encode([r["text"] for r in frames[4].collect()])
    assert got == sorted((r["doc_id"], len(i) // 4, hashlib.sha256(i).hexdigest()) for r, i in zip(frames[4].collect(), ids, strict=True))
