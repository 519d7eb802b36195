"""One query per operator, over whole tables, with the SQL twin where SQL can express it."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeops.llm import (bpe, centroids, chat, classifier, learned_partitions, line_dedup, merkle, mixing, quality_rules, simhash,
                         spelling, suffix_dedup, token_counts)
from lakeops.session import load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed(load_table(spark, sf_dir, "documents"))


ORACLES["op1_line_dedup"] = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
numbered AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split),
worded AS (
  SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS seq,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM numbered WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
summed AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY seq) AS upto FROM worded),
by_start AS (
  SELECT a.doc_id, a.seq AS s, min(b.seq) AS e FROM summed a JOIN summed b
  ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.upto - a.upto + a.words >= 50 GROUP BY ALL),
by_end AS (
  SELECT b.doc_id, max(a.seq) AS s, b.seq AS e FROM summed a JOIN summed b
  ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.upto - a.upto + a.words >= 50 GROUP BY ALL),
runs AS (SELECT * FROM by_start UNION SELECT * FROM by_end),
texts AS (
  SELECT r.doc_id, r.s, r.e, string_agg(w.line, chr(10) ORDER BY w.seq) AS run
  FROM runs r JOIN worded w ON r.doc_id = w.doc_id AND w.seq BETWEEN r.s AND r.e GROUP BY ALL),
later AS (
  SELECT doc_id, s, e FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS n FROM texts) WHERE n > 1),
gone AS (
  SELECT DISTINCT w.doc_id, w.seq, w.pos FROM worded w JOIN later l ON w.doc_id = l.doc_id AND w.seq BETWEEN l.s AND l.e),
islands AS (
  SELECT doc_id, min(pos) AS first, max(pos) AS last
  FROM (SELECT *, seq - row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS island FROM gone) GROUP BY doc_id, island),
left_over AS (
  SELECT n.doc_id, count(*) AS n_lines, count(i.doc_id) AS n_removed,
    coalesce(string_agg(n.line, chr(10) ORDER BY n.pos) FILTER (WHERE i.doc_id IS NULL), '') AS kept
  FROM numbered n LEFT JOIN islands i ON n.doc_id = i.doc_id AND n.pos BETWEEN i.first AND i.last GROUP BY n.doc_id)
SELECT l.doc_id, n_lines, n_removed, coalesce(n_runs, 0) AS n_runs, sha256(kept) AS kept_sha256
FROM left_over l LEFT JOIN (SELECT doc_id, count(*) AS n_runs FROM islands GROUP BY doc_id) r ON l.doc_id = r.doc_id
"""


@query
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load_table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


ORACLES["op2_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3, 1, 2][1 + CAST((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 AS INTEGER)] AS weight
  FROM sized GROUP BY source),
limits AS (SELECT *, source_size * 2.0::DOUBLE AS lim FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(lim) OVER (ORDER BY lim / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY lim / weight, source IS NULL, encode(source) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM limits),
first_level AS (SELECT arg_min(level, lim / weight) AS level FROM levels WHERE lim > level * weight),
targets AS (
  SELECT l.source, source_size, CASE WHEN l.lim <= l.level * weight OR f.level IS NULL THEN lim ELSE least(lim, f.level * weight) END AS target
  FROM levels l CROSS JOIN first_level f),
placed AS (
  SELECT s.doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE CAST((budget // source_size) * size
    + greatest(0, least(size, budget - (budget // source_size) * source_size - before)) AS BIGINT) END AS taken
FROM placed
"""


@query
def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(load_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "next_doc_id")


ORACLES["op3_document_fingerprints"] = r"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
ordered AS (
  SELECT doc_id, text, length(text) AS n, coalesce(lead(text) OVER w, first_value(text) OVER w) AS follows,
    coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_doc_id
  FROM base WINDOW w AS (ORDER BY doc_id DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
texts AS (SELECT doc_id, n, text, substr(text, 1, n - n // 3) || substr(follows, 1, n // 3) AS edited, follows, next_doc_id FROM ordered),
leaves AS (
  SELECT doc_id, n, k, t, list_transform(string_split(t, chr(10)), lambda p: CASE WHEN p = '' THEN [substr(md5(''), 1, 12)]
      ELSE list_transform(regexp_extract_all(p, '(?s).{1,64}'), lambda x: substr(md5(x), 1, 12)) END) AS leaves
  FROM (SELECT doc_id, n, 'own' AS k, text AS t FROM texts UNION ALL SELECT doc_id, n, 'edited', edited FROM texts
        UNION ALL SELECT doc_id, n, 'next', follows FROM texts)),
paragraphs AS (SELECT *, list_transform(leaves, lambda x: substr(md5(array_to_string(x, ',')), 1, 12)) AS pars FROM leaves),
bounds AS (SELECT *, list_filter(range(1, len(pars) + 1), lambda i: pars[i][-1] = '0' OR i = len(pars)) AS ends FROM paragraphs),
sections AS (
  SELECT *, list_transform(range(1, len(ends) + 1), lambda j: substr(md5(array_to_string(
    pars[(CASE WHEN j = 1 THEN 1 ELSE ends[j - 1] + 1 END):ends[j]], ',')), 1, 12)) AS secs FROM bounds),
roots AS (
  SELECT *, md5(CAST(length(t) AS VARCHAR) || ',' || array_to_string(secs, ',')) AS root, list_distinct(flatten(leaves)) AS leaf_set FROM sections),
prints AS (
  SELECT *, concat_ws(':', root, array_to_string(secs, ','), array_to_string(list_transform(ends, lambda e: CAST(e AS VARCHAR)), ','),
    array_to_string(pars, ','), array_to_string(list_transform(leaves, lambda x: array_to_string(x, '')), ',')) AS print FROM roots)
SELECT t.doc_id, t.n AS n_chars, sha256(t.edited) AS edited_sha256, o.print AS fingerprint, e.print AS edited_fingerprint,
  CASE WHEN o.root = e.root THEN 1.0::DOUBLE
    ELSE 2.0::DOUBLE * len(list_intersect(o.leaf_set, e.leaf_set)) / (len(o.leaf_set) + len(e.leaf_set)) END AS near_edited,
  CASE WHEN o.root = f.root THEN 1.0::DOUBLE
    ELSE 2.0::DOUBLE * len(list_intersect(o.leaf_set, f.leaf_set)) / (len(o.leaf_set) + len(f.leaf_set)) END AS near_next, t.next_doc_id
FROM texts t JOIN prints o ON t.doc_id = o.doc_id AND o.k = 'own' JOIN prints e ON t.doc_id = e.doc_id AND e.k = 'edited'
JOIN prints f ON t.doc_id = f.doc_id AND f.k = 'next'
"""


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (load_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return classifier.score(docs.select("doc_id", "text"), labels)


@query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load_table(spark, sf_dir, "documents"))


@query
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)], turns.schema)
    return chat.digests(chat.conversations(chat.numbered(turns.unionByName(probe))))


ORACLES["op6_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^<\[\\]', '', 'g'))
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
      ELSE 18 + length(role) + length(regexp_replace(role, '[^<>\[\\]', '', 'g')) END AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.with_spans(load_table(spark, sf_dir, "documents")))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (load_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality_rules.judge(docs.select("doc_id", "text", "lang"), labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, token_counts.read_pieces(tokenizer("piece_bpe_32k.model")), keep=["doc_id"])


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digest(docs, tokenizer("word_bpe_49k.json"), keep=["doc_id"])


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(load_table(spark, sf_dir, "documents"), drop=199)


#: single-byte stand-ins, for a distance that counts bytes
_ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
_STAND_INS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~"

ORACLES["op11_spelling_variants"] = f"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda a, k: xor(a >> 1, 3988292384 * (a & 1))) AS c FROM range(256) AS r(i))),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
lowered AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    [4294967295] || flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
  FROM lowered, crc),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n, translate(word, '{_ACCENTED}', '{_STAND_INS}') AS x FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
      ELSE run END AS word FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
keys AS (
  SELECT word, n, x, l, side, CASE WHEN side = 1 THEN substr(word, 1, CAST(l // 2 AS INTEGER)) ELSE right(word, CAST(l - l // 2 AS INTEGER)) END AS half
  FROM (SELECT *, length(word) + unnest([-1, 0, 1]) AS l FROM words), (VALUES (1), (2)) AS s(side)),
pairs AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM keys AS a JOIN keys AS b USING (l, side, half)
  WHERE a.l = length(a.word) AND levenshtein(a.x, b.x) = 1),
best AS (
  SELECT word, count(*) AS n_near, min({{'less': -near_n, 'near': near}}) AS b FROM pairs GROUP BY word),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -(b).less >= 5 * w.n THEN (b).near END AS form,
    CASE WHEN -(b).less >= 5 * w.n THEN -(b).less END AS form_n FROM words AS w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT walk.word, walk.next, f.form FROM walk JOIN formed AS f ON f.word = walk.next)
SELECT f.word, n, n_near, form, form_n, root FROM formed AS f JOIN walk ON f.word = walk.word AND walk.next IS NULL
"""


@query
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(load_table(spark, sf_dir, "embeddings"), keep=["vec_id"]).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rounds(n: int) -> str:
    """The assignment and the moves of ``n`` rounds, then the last assignment ``a{n}``."""
    near = lambda k: f"""
a{k} AS MATERIALIZED (
  SELECT row, vec_id, v, (d).cluster AS cluster, (d).distance AS distance FROM (
    SELECT row, vec_id, v, min({{'distance': list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT,
      'cluster': cluster}}) AS d FROM kept, c{k} GROUP BY ALL))"""
    move = lambda k: f"""
s{k} AS (SELECT cluster, i, sum(v[i]) AS s, count(*) AS n FROM a{k}, range(1, 65) AS r(i) GROUP BY ALL),
m{k} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS moved FROM s{k} GROUP BY cluster),
c{k + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(moved, c) AS c FROM c{k} AS c LEFT JOIN m{k} USING (cluster))"""
    return ",".join(near(k) + "," + move(k) for k in range(n)) + "," + near(n)


ORACLES["op12_centroid_clustering"] = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS INTEGER) AS cluster, v AS c
  FROM kept QUALIFY cluster < 40),{_rounds(5)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a5 JOIN c5 USING (cluster)
"""


@query
def op13_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.search(load_table(spark, sf_dir, "embeddings"))
