"""One query an operator, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import chat, language_model, media, mixing, near_duplicates, neighbours, packing, quality, token_files, warc, work


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_warc(warc.mark_revisits(table(spark, sf_dir, "pages")), work.folder(spark, "warc"))
    return warc.read_warc(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.read_groups(token_files.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), work.folder(spark, "tokens")))


def op4_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.store_media(table(spark, sf_dir, "documents"), work.folder(spark, "media"))
    return media.decode_media(stored).drop("height", "width")


def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, quality.rate(table(spark, sf_dir, "labels")))
    return quality.classify(docs.select("doc_id", "text"), model).select("doc_id", "expected_grade", "tail_probability", "keep")


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.in_order(mixing.mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "repeats", "position")


def op7_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op8_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(rows, rows.filter(F.col("vec_id") % 50 == 0))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    read = chat.parse_formatted(chat.format_conversations(rows.unionByName(extra)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ngram_jaccard_join, op2_warc, op3_token_files, op4_progressive_jpeg, op5_ordinal_quality, op6_curriculum_mix, op7_deleted_interpolation, op8_hash_prefix_forest, op9_chat_format, op10_packing)}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS a FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(a) = 0 THEN []
    WHEN len(a) < 5 THEN [array_to_string(a, ' ')]
    ELSE list_transform(range(1, len(a) - 3), lambda i: array_to_string(a[i:i + 4], ' ')) END)) AS s FROM w
), classes AS (
  SELECT s, min(doc_id) AS id, count(*) AS copies, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), flat AS (
  SELECT id, n, copies, unnest(s) AS g FROM classes
), pairs AS (
  SELECT a.id AS x, b.id AS y, any_value(b.copies) AS copies FROM flat a JOIN flat b ON a.g = b.g AND a.id <> b.id
  GROUP BY a.id, b.id HAVING count(*) >= 0.8 * (any_value(a.n) + any_value(b.n) - count(*)) - 1e-9
), reach AS (
  SELECT id AS x, id AS y FROM classes UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x
), heads AS (SELECT x, min(y) AS head FROM reach GROUP BY x),
links AS (SELECT x, sum(copies) AS n FROM pairs GROUP BY x)
SELECT t.doc_id, coalesce(h.head, t.doc_id) AS class_id, CAST(coalesce(c.copies - 1 + coalesce(l.n, 0), 0) AS BIGINT) AS n_links
FROM sets t LEFT JOIN classes c ON t.s = c.s LEFT JOIN heads h ON c.id = h.x LEFT JOIN links l ON c.id = l.x
"""

_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP2 = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS last,
    array_to_string(list_transform(range(0, 32), lambda i: substr('{_B32}', 1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest
  FROM p
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM d
"""

OP9 = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<|', '&lt;|'), '</s>', '&lt;/s>'), '<s>', '&lt;s>'),
    '<<SYS>>', '&lt;<SYS>>'), '<</SYS>>', '&lt;</SYS>>'), '[INST]', '&#91;INST]'), '[/INST]', '&#91;/INST]') AS safe,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(safe) + CASE WHEN before IS NULL OR before <> role THEN length('<|im_start|>' || role) + 1 + length('<|im_end|>') + 1 ELSE length('<|turn|>') END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard_join": OP1, "op2_warc": OP2, "op9_chat_format": OP9}
