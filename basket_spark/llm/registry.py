"""The queries of this package: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, chat, decontaminate, filter_audit, fingerprint, lang_id, license_scan, minhash, pii, quality, resample, sharding, token_count
from .common import table

#: Words of a shingle and similarity are op2's own; elsewhere five words hold.
OP2_WORDS = 4


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lang_id.identify(docs, lang_id.fit(docs))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=OP2_WORDS)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogate_texts(table(spark, sf_dir, "documents"), pii.session_key(spark))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), sharding.names(sharding.SHARDS))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.digests(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


#: The conversation that every text of the template's own markers must survive.
PROBE = r"\### Assistant: </turn> ok"


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    return chat.read_back(chat.examples(turns.union(probe)))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1,
        "op2_minhash_near_dups": op2,
        "op3_benchmark_contamination": op3,
        "op4_pii_surrogates": op4,
        "op5_fingerprints": op5,
        "op6_license_scan": op6,
        "op7_token_counts": op7,
        "op8_sharding": op8,
        "op9_byte_bpe": op9,
        "op10_chat_format": op10,
        "op11_filter_audit": op11,
        "op12_importance_resampling": op12,
        "op13_quality": op13,
        "pipeline": pipeline,
    }


_OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3])) END AS sh FROM w
), e AS (SELECT doc_id, unnest(sh) AS g FROM s
), f AS (SELECT md5(array_to_string(list_sort(sh), chr(10))) AS k, min(doc_id) AS rep, any_value(len(sh)) AS n FROM s WHERE len(sh) > 0 GROUP BY 1
), r AS (SELECT rep, n, g FROM f JOIN e ON e.doc_id = f.rep
), p AS (
  SELECT a.rep AS a, b.rep AS b FROM r a JOIN r b ON a.g = b.g AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), l AS (SELECT a, b FROM p UNION SELECT b, a FROM p
), c AS (SELECT rep AS node, rep AS reach FROM f UNION SELECT c.node, l.b FROM c JOIN l ON l.a = c.reach
), m AS (SELECT node, min(reach) AS component FROM c GROUP BY node
)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, coalesce(m.component, s.doc_id) AS component_id, s.doc_id = coalesce(m.component, s.doc_id) AS kept
FROM s LEFT JOIN f ON f.k = md5(array_to_string(list_sort(s.sh), chr(10))) AND len(s.sh) > 0 LEFT JOIN m ON m.node = f.rep
"""

_OP10_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) x(i)
), n AS (
  SELECT *, 4 + length(role) + 2 + length(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')) + 8 AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS last FROM t
), s AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY i) AS so_far FROM n)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(so_far) FILTER (role = 'assistant' OR i = last) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""


_OP11_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), x AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda v: v <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM w
), f AS (
  SELECT doc_id, part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d, coalesce(first < doc_id, false) AS e FROM x
), l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1
), m AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
    count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2
), z AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS z
), o AS (
  SELECT p.z || q.z || r.z || s.z || t.z AS filter_order FROM z p, z q, z r, z s, z t
  WHERE length(replace(replace(replace(replace(replace('ABCDE', p.z, ''), q.z, ''), r.z, ''), s.z, ''), t.z, '')) = 0
), y AS (
  SELECT m.*, filter_order, step, filter_order[step] AS filter, translate(fails, filter_order[1:step - 1], '') = fails AS reached FROM m, o, range(1, 6) g(step)
), r AS (
  SELECT part, filter_order, step, filter, sum(n) FILTER (reached AND NOT contains(fails, filter)) AS kept, sum(n) FILTER (reached AND contains(fails, filter)) AS removed,
    sum(n) FILTER (NOT reached AND contains(fails, filter)) AS redundant, sum(n) FILTER (fails = filter) AS unique_fails,
    sum(good) FILTER (reached AND contains(fails, filter)) AS good_lost, sum(toxic) FILTER (reached AND contains(fails, filter)) AS toxic_lost FROM y GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM r
"""

_OP12_SQL = r"""
WITH k AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), d AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda v: v <> '') AS words FROM documents
), b AS (
  SELECT unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda v: v <> '')) AS word FROM benchmark
), e AS (SELECT row, unnest(words) AS word FROM d
), v AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM e UNION SELECT word FROM b)
), u AS (
  SELECT word, CAST(xor(list_reduce([4294967295] || list_transform(range(len(h) // 2), lambda i: CAST('0x' || h[2 * i + 1 : 2 * i + 2] AS BIGINT)), lambda c, x: xor(c >> 8, crc[xor(c & 255, x) + 1])), 4294967295) % 10000 AS INTEGER) AS bucket FROM v, k
), s AS (SELECT bucket, count(*) AS n FROM e JOIN u USING (word) GROUP BY 1
), t AS (SELECT bucket, count(*) AS n FROM b JOIN u USING (word) GROUP BY 1
), g AS (
  SELECT i AS bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000.0::DOUBLE) / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000.0::DOUBLE)))) AS BIGINT) AS gain
  FROM range(10000) r(i) LEFT JOIN s ON s.bucket = i LEFT JOIN t ON t.bucket = i
), w AS (SELECT row, sum(gain) AS weight FROM e JOIN u USING (word) JOIN g USING (bucket) GROUP BY 1
), x AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (row)
), y AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id, n_features) END AS place FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT count(place) * 10 // 100 FROM y) THEN place END AS rank FROM y
"""


def _op8_sql() -> str:
    """The placement, over the two lookup tables as lists; that they are filled as said is tested by itself."""
    shards = sharding.names(sharding.SHARDS)
    slot = f"CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) % {sharding.SLOTS}"
    return (
        f"SELECT doc_id, slot, CAST({sharding.fill(shards)}[slot + 1] AS INTEGER) AS shard, CAST({sharding.fill(shards[:-1])}[slot + 1] AS INTEGER) AS shard_without_last "
        f"FROM (SELECT doc_id, {slot} AS slot FROM documents)"
    )


def oracle_sql() -> dict[str, str]:
    return {"op2_minhash_near_dups": _OP2_SQL, "op8_sharding": _op8_sql(), "op10_chat_format": _OP10_SQL, "op11_filter_audit": _OP11_SQL, "op12_importance_resampling": _OP12_SQL}
