"""Registered queries of the subpackage, each over its whole table, with SQL where SQL can give the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsework.llm import (
    bpe,
    decontaminate,
    host_rules,
    licence_scan,
    lm_interpolation,
    merkle,
    packing,
    probminhash,
    secret_scan,
    spelling,
    training_order,
    url_lists,
    warc,
)
from pulsework.llm.shipping import ship
from pulsework.session import new_work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = os.environ.get("BYTE_BPE_VOCABULARY") or public_tokenizers.path("byte_bpe_50k.json")
ORDER_KEY = 20240101


def _query(sql: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = shipped
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query()
def op1_lm_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_interpolation.score_documents(_table(spark, sf_dir, "documents"))


@_query()
def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token ids of all texts in training order and reads the shards back from the first slot."""
    docs = _table(spark, sf_dir, "documents")
    end = bpe.special_id(VOCABULARY, "<|endoftext|>")
    manifest = training_order.materialise(
        docs, new_work_dir(spark, "order"), ORDER_KEY, dtype="uint16", end=end, vocabulary=VOCABULARY
    )
    read = training_order.read_slots(spark, manifest)
    return read.select("slot", "shard", "doc_id", "part", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"))


@_query()
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.round_trip(_table(spark, sf_dir, "documents"), VOCABULARY)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@_query()
def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.scan_licences(_table(spark, sf_dir, "documents")).drop("spans")


@_query()
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query(
    r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, [x FOR x IN string_split_regex(t, '[\x20\x09-\x0D]+') IF x <> ''] AS ws,
  [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY rid),
m AS (SELECT doc_id, source, cast(len(ws) AS bigint) AS n_words,
    cast(coalesce(list_sum([length(x) FOR x IN ws]), 0) AS bigint) AS word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
    cast(len(ls) - len(list_distinct(ls)) AS bigint) AS n_dup_lines, cast(coalesce(c.n, 0) AS bigint) AS n_repeat_words
  FROM w LEFT JOIN c USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(CASE WHEN base_failed OR n_symbols * 100 > word_chars * 20 OR n_dup_lines > 30
    THEN 1 ELSE 0 END) AS bad FROM f WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT avg(bad / n) AS mean, coalesce(var_samp(bad / n), 0) AS spread FROM h),
q AS (SELECT mean, least(1000, greatest(1, CASE WHEN spread > 0 THEN mean * (1 - mean) / spread - 1 ELSE 1000 END))
  AS weight FROM p),
v AS (SELECT source, (bad + mean * weight) / (n + weight) > 0.75 AND n >= 10 AS host_bad FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(host_bad, false) AS kept
FROM f LEFT JOIN v USING (source)"""
)
def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge_documents(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *host_rules.MEASURES, "base_failed", "kept")


@_query()
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))


@_query()
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query(
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
g AS (SELECT *, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p),
n AS (SELECT *, [cast('0x' || substr(hex, 5 * k + 1, 5) AS bigint) FOR k IN range(8)] AS parts FROM g)
SELECT page_id, cast(octet_length(encode(payload)) AS bigint) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((parts[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31 AS int) + 1, 1)
    FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM n"""
)
def op9_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages as archives and reads these back."""
    manifest = warc.write_archives(_table(spark, sf_dir, "pages"), warc.new_archive_folder(spark))
    read = warc.read_archives(spark, manifest)
    return read.select(
        F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long")
    )


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list that grows with the pages: each page adds or removes itself, its host or its parent domain."""
    keys = url_lists.keys_of(F.col("url"))
    number = F.col("page_id")
    return pages.select(
        F.when(number % 5 == 0, "allow").otherwise("block").alias("list"),
        F.when(number % 3 == 0, keys[0]).when(number % 3 == 1, F.get(keys, F.lit(1))).otherwise(F.get(keys, F.lit(2))).alias("key"),
        F.when(number % 2 == 0, "add").otherwise("remove").alias("action"),
        F.timestamp_add("DAY", (number * 7 % 365).cast("int"), F.lit("2024-01-01").cast("timestamp")).alias("at"),
    )


@_query(
    r"""
WITH p AS (SELECT page_id, url, timestamp '2024-01-01' + INTERVAL (page_id % 365) DAY AS fetched_at,
  lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''))
    AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) AS rest FROM pages),
l AS (SELECT *, string_split(host, '.') AS ls, CASE WHEN regexp_matches(host, '^([0-9]+(\.[0-9]+){3}|\[.*\])$') THEN 1
  ELSE greatest(1, len(string_split(host, '.')) - 1) END AS most FROM p WHERE host <> ''),
k AS (SELECT *, list_concat([host || regexp_replace(rest, '/$', '')],
  [array_to_string(ls[i:], '.') FOR i IN range(1, most + 1)]) AS all_keys FROM l),
u AS (SELECT page_id, url, fetched_at, host,
  list_filter(all_keys, lambda x, i: list_position(all_keys, x) = i) AS keys FROM k),
e AS (SELECT CASE WHEN page_id % 5 = 0 THEN 'allow' ELSE 'block' END AS list,
  CASE page_id % 3 WHEN 0 THEN keys[1] WHEN 1 THEN keys[2] ELSE keys[3] END AS key,
  max(CASE WHEN page_id % 2 = 0 THEN 1 ELSE 0 END) AS is_on,
  timestamp '2024-01-01' + INTERVAL (page_id * 7 % 365) DAY AS noted FROM u GROUP BY 1, 2, 4),
s AS (SELECT *, coalesce(lag(is_on) OVER w, 0) AS was_on FROM e WHERE key IS NOT NULL
  WINDOW w AS (PARTITION BY list, key ORDER BY noted)),
t AS (SELECT *, coalesce(lead(noted) OVER (PARTITION BY list, key ORDER BY noted), timestamp '9999-12-31') AS valid_to
  FROM s WHERE is_on <> was_on),
c AS (SELECT page_id, fetched_at, unnest(keys) AS key FROM u),
m AS (SELECT c.page_id, t.list, c.key, count(*) OVER (PARTITION BY c.page_id) AS n,
  row_number() OVER (PARTITION BY c.page_id ORDER BY length(c.key) DESC, t.list = 'allow' DESC, c.key DESC) AS place
  FROM c JOIN t ON c.key = t.key AND t.is_on = 1 AND t.noted <= c.fetched_at AND c.fetched_at < t.valid_to)
SELECT p.page_id, nullif(p.host, '') AS host, strftime(p.fetched_at, '%Y-%m-%d') AS fetched,
  cast(coalesce(m.n, 0) AS bigint) AS n_active, m.key AS matched_key, coalesce(m.list, 'none') AS verdict,
  coalesce(m.list = 'block', false) AS blocked
FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.place = 1"""
)
def op10_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.timestamp_add("DAY", (F.col("page_id") % 365).cast("int"), F.lit("2024-01-01").cast("timestamp"))
    found = url_lists.evaluate(pages.withColumn("fetched_at", fetched), list_entries(pages))
    return found.select(
        "page_id", "host", F.date_format("fetched_at", "yyyy-MM-dd").alias("fetched"), "n_active", "matched_key", "verdict",
        "blocked",
    )


@_query(
    r"""
WITH RECURSIVE bits AS (SELECT [list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
    FOR i IN range(256)] AS crc),
d AS (SELECT doc_id, lang, cast(n_chars AS hugeint) AS n_chars, coalesce(octet_length(encode(cast(doc_id AS varchar))) || ':' || doc_id, '-')
    || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail,
    xor(list_reduce([cast(ascii(x) AS bigint) FOR x IN string_split(cast(doc_id AS varchar), '')],
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS code FROM documents, bits),
h AS (SELECT doc_id, lang, sha256(head || coalesce(length(cast(n_chars AS varchar)) || ':' || n_chars, '-') || tail) AS leaf,
  CASE WHEN code % 7 = 0 THEN sha256(head || coalesce(length(cast(n_chars + 1 AS varchar)) || ':' || (n_chars + 1), '-') || tail) END AS changed
  FROM d),
l AS (SELECT *, coalesce('=' || lang, '') AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
  count(*) OVER (PARTITION BY lang) AS n FROM h),
t AS (SELECT grp, 0 AS level, r, leaf AS node FROM l
  UNION ALL SELECT grp, level + 1, r // 2, sha256(string_agg(node, '' ORDER BY r))
  FROM (SELECT *, max(r) OVER (PARTITION BY grp) AS last FROM t) WHERE last > 0 GROUP BY grp, level, r // 2),
s AS (SELECT grp, max(level) AS height, arg_max(node, level) AS subroot FROM t WHERE r = 0 GROUP BY grp),
g AS (SELECT *, row_number() OVER (ORDER BY grp) - 1 AS r FROM s),
u AS (SELECT 0 AS level, r, subroot AS node FROM g
  UNION ALL SELECT level + 1, r // 2, sha256(string_agg(node, '' ORDER BY r))
  FROM (SELECT *, max(r) OVER () AS last FROM u) WHERE last > 0 GROUP BY level, r // 2),
top AS (SELECT max(level) AS height, arg_max(node, level) AS root FROM u WHERE r = 0),
p AS (SELECT l.grp, l.r AS leaf_rank, list({'odd': (l.r >> e.level) & 1, 'other': coalesce(b.node, '')} ORDER BY e.level) AS steps
  FROM l JOIN (SELECT DISTINCT grp, level FROM t) e ON e.grp = l.grp JOIN s ON s.grp = l.grp AND e.level < s.height
  LEFT JOIN t b ON b.grp = l.grp AND b.level = e.level AND b.r = xor(l.r >> e.level, 1) GROUP BY l.grp, l.r),
q AS (SELECT g.grp, list({'odd': (g.r >> e.level) & 1, 'other': coalesce(b.node, '')} ORDER BY e.level) AS steps
  FROM g JOIN top ON true JOIN (SELECT DISTINCT level FROM u) e ON e.level < top.height
  LEFT JOIN u b ON b.level = e.level AND b.r = xor(g.r >> e.level, 1) GROUP BY g.grp),
w AS (SELECT l.*, s.subroot, top.root, list_concat(coalesce(p.steps, []), coalesce(q.steps, [])) AS steps
  FROM l JOIN s USING (grp) JOIN top ON true LEFT JOIN p ON p.grp = l.grp AND p.leaf_rank = l.r LEFT JOIN q ON q.grp = l.grp),
z AS (SELECT *, list_reduce([x.odd || x.other FOR x IN steps],
    lambda a, x: sha256(CASE WHEN x[1] = '1' THEN x[2:] || a ELSE a || x[2:] END), coalesce(changed, leaf)) AS folded FROM w)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([x.other FOR x IN steps], '')) AS proof_sha256, folded AS folded_root,
  folded = root AS verified FROM z"""
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of all documents, by language; every proof is folded, those of tampered rows to another root."""
    found = merkle.document_manifest(_table(spark, sf_dir, "documents"))
    folded = merkle.fold(F.col("folded_leaf"), F.col("path"))
    proof = F.sha2(merkle.siblings(F.col("path")), 256)
    found = found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


@_query()
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of all documents in sequences of at most 1,024, with the place of each piece."""
    docs = _table(spark, sf_dir, "documents")
    examples = docs.select("doc_id", packing.document_parts(F.col("text")).alias("parts"))
    packed = packing.pack(examples, VOCABULARY)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to"
    )


@_query(
    r"""
WITH RECURSIVE bits AS (SELECT [list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
    FOR i IN range(256)] AS crc),
r AS (SELECT coalesce(cast(doc_id AS varchar), '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
c AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM r
  WHERE length(run) >= 6 GROUP BY 1, 2),
h AS (SELECT *, hex(encode(id || ':' || run)) AS raw FROM c),
k AS (SELECT run, n, xor(list_reduce([cast('0x' || substr(raw, 2 * i + 1, 2) AS bigint) FOR i IN range(length(raw) // 2)],
    lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS code FROM h, bits),
v AS (SELECT CASE WHEN code % 199 = 0 THEN substr(run, 1, code % length(run)) || substr(run, code % length(run) + 2) ELSE run END AS word,
  n FROM k),
w AS (SELECT word, cast(sum(n) AS bigint) AS n FROM v WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
x AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less FROM (SELECT *, unnest(range(length(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM x a JOIN w b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM x a JOIN w b ON a.less = b.word),
b AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form,
  CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n FROM w LEFT JOIN b USING (word)),
g AS (SELECT word, word AS root, form AS ahead FROM f
  UNION ALL SELECT g.word, f.word, f.form FROM g JOIN f ON f.word = g.ahead)
SELECT f.word, f.form, g.root, f.n, f.n_near, f.form_n FROM f JOIN g ON g.word = f.word AND g.ahead IS NULL"""
)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"))
