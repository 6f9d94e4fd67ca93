"""One query for each operator, over its whole table with production parameters, and the oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, embedding_dedup, filter_audit, langid, lines, minhash, mixing, passages, runs, sharding, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


ORACLES["op6_minhash"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (na + nb - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
parts AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, p.component_id, s.doc_id = p.component_id AS kept FROM sets s JOIN parts p ON p.a = s.doc_id
"""


@query
def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op10_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
parts AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, p.component_id, e.vec_id = p.component_id AS kept
FROM embeddings e JOIN parts p ON p.a = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0)


ORACLES["op1_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS s, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(s, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLES["op8_mixing"] = """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM s0),
s2 AS (SELECT *, CASE sid % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s1),
t AS (SELECT CAST(sum(source_size) AS BIGINT) AS total, CAST(sum(w) AS BIGINT) AS all_w, greatest(1, (CAST(sum(source_size) AS BIGINT) + 1023) // 1024) AS slots FROM s2),
s3 AS (SELECT s2.*, coalesce(sum(source_size) OVER r, 0) AS cap_before, coalesce(sum(w) OVER r, 0) AS w_before FROM s2
  WINDOW r AS (ORDER BY source_size / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT s3.*, w * (total - 3 * cap_before) > 3 * source_size * (all_w - w_before) AS full_ FROM s3, t),
lv AS (SELECT CAST(CAST(total - 3 * coalesce((SELECT sum(source_size) FROM s4 WHERE full_), 0) AS BIGINT) AS DOUBLE) / CAST(all_w - coalesce((SELECT sum(w) FROM s4 WHERE full_), 0) AS DOUBLE) AS level FROM t),
s5 AS (SELECT sid, source, source_size, CASE WHEN full_ THEN CAST(3 * source_size AS DOUBLE) ELSE w * level END AS target FROM s4, lv),
s6 AS (SELECT *, CAST(round(target) AS BIGINT) AS due, sum(target) OVER (ORDER BY sid) / (SELECT CAST(total AS DOUBLE) FROM t) AS high FROM s5),
s7 AS (SELECT *, coalesce(lag(high) OVER (ORDER BY sid), 0) AS low, sid = max(sid) OVER () AS last_ FROM s6),
sl AS (SELECT i AS slot, i * 0.6180339887498949::DOUBLE - floor(i * 0.6180339887498949::DOUBLE) AS u FROM t, range(0, slots) r(i)),
d0 AS (SELECT slot, sid FROM sl JOIN s7 ON u >= low AND (u < high OR last_) AND (low < high OR last_)),
dealt AS (SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS block, count(*) OVER (PARTITION BY sid) AS blocks FROM (
  SELECT slot, sid FROM d0 UNION ALL SELECT CAST(floor(low * slots) AS BIGINT), sid FROM s7, t WHERE due > 0 AND sid NOT IN (SELECT sid FROM d0))),
s8 AS (SELECT s7.*, due // coalesce(blocks, 1) AS even, due % coalesce(blocks, 1) AS more FROM s7 LEFT JOIN (SELECT DISTINCT sid, blocks FROM dealt) USING (sid)),
p AS (SELECT doc_id, size, s8.sid, source_size, target, due, even, more,
    coalesce(sum(size) OVER (PARTITION BY s8.sid ORDER BY md5('8|' || coalesce(CAST(doc_id AS VARCHAR), '')), size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM d JOIN s8 ON d.source IS NOT DISTINCT FROM s8.source),
x AS (SELECT p.*, CAST(place + turn * source_size AS BIGINT) AS a, CAST(least(place + turn * source_size + size, due) AS BIGINT) AS b FROM p, range(0, 3) r(turn) WHERE size > 0 AND place + turn * source_size < due),
y AS (SELECT *, unnest(range(
    CASE WHEN a < more * (even + 1) THEN a // (even + 1) ELSE more + (a - more * (even + 1)) // greatest(even, 1) END,
    CASE WHEN b - 1 < more * (even + 1) THEN (b - 1) // (even + 1) ELSE more + (b - 1 - more * (even + 1)) // greatest(even, 1) END + 1)) AS block FROM x),
taken AS (SELECT y.sid, place, sum(least(b, (block + 1) * even + least(block + 1, more)) - greatest(a, block * even + least(block, more))) AS taken, min(slot) AS first_slot FROM y JOIN dealt USING (sid, block) GROUP BY ALL)
SELECT doc_id, size, source_size, target, CAST(coalesce(CASE WHEN size > 0 THEN taken END, 0) AS BIGINT) AS taken, CASE WHEN size > 0 THEN first_slot END AS first_slot
FROM p LEFT JOIN taken ON p.sid = taken.sid AND p.place = taken.place
"""


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicate(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


ORACLES["op7_line_dedup"] = """
WITH li AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
m AS (SELECT *, string_split(masked, ' ') AS tok FROM (SELECT doc_id, text, line, line_no,
    regexp_replace(trim(regexp_replace(line, '[\\x20\\x09-\\x0D]+', ' ', 'g')), '[^ 0-9]*[0-9][^ ]*', '<*>', 'g') AS masked FROM li)),
o AS (SELECT *, tok[1:3] AS lead, len(tok) AS n FROM m WHERE len(tok) >= 3),
shared AS (SELECT n, lead FROM o GROUP BY n, lead HAVING count(DISTINCT text) >= 4),
f AS (SELECT n, lead, masked, any_value(tok) AS tok, count(DISTINCT text) AS support FROM o JOIN shared USING (n, lead) GROUP BY n, lead, masked),
t AS (SELECT n, lead, masked, support, unnest(tok) AS token, generate_subscripts(tok, 1) AS pos FROM f),
common AS (SELECT n, lead, pos, token FROM t GROUP BY n, lead, pos, token HAVING sum(support) >= 4),
fx AS (SELECT t.n, t.lead, t.masked, count(c.token) AS fixed, list(CASE WHEN c.token IS NULL THEN '<*>' ELSE t.token END ORDER BY t.pos) AS pattern,
    list(c.token IS NOT NULL ORDER BY t.pos) AS marks FROM t LEFT JOIN common c USING (n, lead, pos, token) GROUP BY ALL),
tm AS (SELECT n, lead, masked, CASE WHEN fixed >= 0.6 * n THEN pattern::VARCHAR || marks::VARCHAR ELSE masked END AS template FROM fx),
mk AS (SELECT o.doc_id, o.text, o.line_no, tm.template, o.n, o.lead FROM o JOIN tm USING (n, lead, masked)),
rec AS (SELECT n, lead, template, min({'d': doc_id, 'l': line_no}) AS first FROM mk GROUP BY n, lead, template HAVING count(DISTINCT text) >= 4),
lo AS (SELECT n, lead, masked, min({'d': doc_id, 'l': line_no}) AS first FROM o WHERE n >= 50 GROUP BY n, lead, masked HAVING count(DISTINCT text) >= 2),
dr AS (SELECT mk.doc_id, mk.text, mk.line_no FROM mk JOIN rec USING (n, lead, template) WHERE NOT (mk.doc_id = rec.first.d AND mk.line_no = rec.first.l)
  UNION SELECT o.doc_id, o.text, o.line_no FROM o JOIN lo USING (n, lead, masked) WHERE NOT (o.doc_id = lo.first.d AND o.line_no = lo.first.l)),
kept AS (SELECT li.doc_id, li.text, string_agg(li.line, chr(10) ORDER BY li.line_no) FILTER (dr.line_no IS NULL) AS new_text, count(*) AS n_lines, count(dr.line_no) AS n_dropped
  FROM li LEFT JOIN dr ON li.doc_id = dr.doc_id AND li.text = dr.text AND li.line_no = dr.line_no GROUP BY li.doc_id, li.text)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.new_text, '') END AS text, CAST(coalesce(k.n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(k.n_dropped, 0) AS INTEGER) AS n_dropped
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id AND d.text = k.text
"""


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT d.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d, coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS e FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
g AS (SELECT part, good, toxic, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
    || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails, count(*) AS n FROM f GROUP BY ALL),
x(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
s AS (SELECT filter_order, CAST(i AS INTEGER) AS step, filter_order[i:i] AS own, filter_order[1:i-1] AS before FROM o, range(1, 6) r(i)),
h AS (SELECT g.*, filter_order, step, own, contains(fails, own) AS fails_own, length(translate(fails, before, '')) < length(fails) AS gone FROM g, s),
r AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT gone AND NOT fails_own), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND fails_own), 0) AS removed,
    coalesce(sum(n) FILTER (gone AND fails_own), 0) AS redundant, coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
    coalesce(sum(n) FILTER (NOT gone AND fails_own AND good), 0) AS good_lost, coalesce(sum(n) FILTER (NOT gone AND fails_own AND toxic), 0) AS toxic_lost FROM h GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""


@query
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.summary(runs.detect(table(spark, sf_dir, "documents"), plant=True))


@query
def op13_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.digests(passages.remove_repeats(table(spark, sf_dir, "documents")))


ORACLES["op13_passages"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM s),
again AS (SELECT g FROM h GROUP BY g HAVING count(*) > 1),
hit AS (SELECT r, i FROM h SEMI JOIN again USING (g)),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM hit),
per AS (SELECT r, list(i) AS gone FROM gone GROUP BY r),
kept AS (SELECT d.r, array_agg(x ORDER BY j) FILTER (g.i IS NULL) AS k FROM (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM d) d LEFT JOIN gone g ON d.r = g.r AND d.j = g.i GROUP BY d.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(per.gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(kept.k, ' '), '')) AS kept_sha256
FROM d LEFT JOIN per USING (r) LEFT JOIN kept USING (r)
"""
