"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, decontaminate, embedding_dedup, language_id, line_dedup, near_dedup, packing, pii, secret_scan, sharding
from .common import checkpointed, table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(cut)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    lined = checkpointed(pages.select("page_id", line_dedup.host_of(F.col("url")).alias("host"), line_dedup.html_lines(F.col("html")).alias("text")))
    return line_dedup.drop_boilerplate(lined, F.col("host")).select("page_id", "host", "lines.n_lines", "lines.n_dropped", "text")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.fit(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "language.lang_pred", "language.score")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    planted = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    made = chat_format.format_conversations(turns.unionByName(planted))
    back = made.withColumns({"turns": chat_format.parse(F.col("formatted")), "loss": chat_format.loss_text(F.col("segments"))})
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), "valid",
    )


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def _span_digests(found: DataFrame, spans: str, kinds: tuple[str, ...]) -> DataFrame:
    joined = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter(spans, lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    digest = F.sha2(F.array_join(F.transform(base, joined), ",").cast("binary"), 256)
    return found.select("doc_id", *map(count, kinds), digest.alias("base_sha256"), F.array_join(F.transform(spans, joined), ",").alias("spans"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digests(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")), "pii", pii.KINDS)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digests(secret_scan.find(table(spark, sf_dir, "documents").select("doc_id", "text")), "secrets", secret_scan.KINDS)


SHARDS = [f"shard-{k:03d}" for k in range(64)]


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.place(docs.select("doc_id"), F.col("doc_id"), SHARDS)


OP2_SQL = r"""
WITH stripped AS (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) AS host,
    regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', '', 'g'),
      '(?i)</?(p|div|li|ul|ol|h[1-6]|br|tr|td|th|table|article|section|nav|header|footer|title|body|head|html)(\s[^>]*)?/?>', chr(10), 'g'),
      '<[^>]*>', '', 'g') AS t
  FROM pages),
texts AS (
  SELECT page_id, host, replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&') AS text
  FROM stripped),
once AS (SELECT DISTINCT host, text FROM texts),
totals AS (SELECT host, count(*) AS pages FROM once GROUP BY host),
lines AS (
  SELECT DISTINCT host, text, regexp_replace(unnest(string_split(text, chr(10))), '^[\x20\t\r]+|[\x20\t\r]+$', '', 'g') AS l FROM once),
boiler AS (
  SELECT host, l FROM lines JOIN totals USING (host) WHERE l <> '' GROUP BY host, l, pages
  HAVING count(*) >= 5 AND count(*) > 0.05 * pages),
spots AS (
  SELECT host, text, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM once),
judged AS (
  SELECT s.host, s.text, s.raw, s.pos, regexp_replace(raw, '^[\x20\t\r]+|[\x20\t\r]+$', '', 'g') AS l FROM spots s),
cleaned AS (
  SELECT j.host, j.text, count(*) FILTER (j.l <> '') AS n_lines, count(b.l) AS n_dropped,
    coalesce(string_agg(j.raw, chr(10) ORDER BY j.pos) FILTER (b.l IS NULL), '') AS clean
  FROM judged j LEFT JOIN boiler b ON j.host = b.host AND j.l = b.l GROUP BY j.host, j.text)
SELECT t.page_id, t.host, CAST(c.n_lines AS BIGINT) AS n_lines, CAST(c.n_dropped AS BIGINT) AS n_dropped, c.clean AS text
FROM texts t JOIN cleaned c ON t.host = c.host AND t.text = c.text
"""

OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, CAST(len(w) - 3 AS BIGINT)), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
classes AS (SELECT min(doc_id) AS rep, any_value(s) AS s, list_sort(s) AS k FROM s WHERE len(s) > 0 GROUP BY list_sort(s)),
x AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM classes),
p AS (
  SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS i FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep
  GROUP BY ALL HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT rep AS v, rep AS c FROM classes UNION SELECT e.b, r.c FROM r JOIN e ON r.v = e.a),
l AS (SELECT v, min(c) AS c FROM r GROUP BY v)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.c, s.doc_id) AS component_id, coalesce(l.c, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN classes c ON list_sort(s.s) = c.k LEFT JOIN l ON l.v = c.rep
"""

OP9_SQL = r"""
WITH words AS (
  SELECT 0 AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT 1, item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') FROM benchmark WHERE text IS NOT NULL),
widths AS (SELECT DISTINCT least(len(w), 5) AS k FROM words WHERE kind = 1 AND len(w) > 0),
runs AS (
  SELECT kind, id, w, least(len(w), 5) AS k FROM words WHERE kind = 1 AND len(w) > 0
  UNION ALL SELECT kind, id, w, k FROM words CROSS JOIN widths WHERE kind = 0 AND len(w) >= k),
s AS (SELECT DISTINCT kind, id, unnest(list_transform(range(1, CAST(len(w) - k + 2 AS BIGINT)), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM runs),
n AS (SELECT id, count(*) AS n_item FROM s WHERE kind = 1 GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, n.n_item AS n_item, count(*) AS n_shared
FROM s d JOIN s b ON d.g = b.g AND d.kind = 0 AND b.kind = 1 JOIN n ON n.id IS NOT DISTINCT FROM b.id
GROUP BY d.id, b.id, n.n_item HAVING count(*) >= 0.75 * n.n_item
"""


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
r AS (SELECT conv_id, string_agg(role, '>' ORDER BY turn, role, text) AS path FROM c GROUP BY conv_id)
SELECT c.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))
    + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))) AS BIGINT) AS formatted_chars,
  regexp_full_match(any_value(r.path), '(system>)?user>(tool>)*assistant((>tool)?>user>(tool>)*assistant|>tool>(tool>)*assistant)*') AS valid
FROM c JOIN r ON c.conv_id = r.conv_id GROUP BY c.conv_id
"""

OP5_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
    label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), FALSE))), FALSE)
      AND coalesce(list_bool_or(list_transform(embedding, lambda x: x <> 0)), FALSE) AS good
  FROM embeddings),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.good AND b.good AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS v, vec_id AS c FROM v UNION SELECT e.b, r.c FROM r JOIN e ON r.v = e.a),
l AS (SELECT v, min(c) AS c FROM r GROUP BY v),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, l.c AS component_id, l.c = v.vec_id AS kept
FROM v JOIN l ON l.v = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""

OP10_SQL = (
    "WITH s AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % "
    + f"{sharding.SLOTS} AS INTEGER) AS slot FROM documents) SELECT doc_id, slot, 'shard-' || lpad(string_split('"
    + ",".join(map(str, sharding.lookup_table(SHARDS)))
    + "', ',')[slot + 1], 3, '0') AS shard FROM s"
)


def queries() -> dict:
    found = {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": OP2_SQL, "op3_chat_formatting": OP3_SQL, "op5_embedding_near_dedup": OP5_SQL, "op10_sharding": OP10_SQL,
        "op4_minhash_near_dedup": OP4_SQL, "op9_benchmark_decontamination": OP9_SQL,
    }
