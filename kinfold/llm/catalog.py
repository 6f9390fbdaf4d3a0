"""The queries of the training-data operators: one opN_<name> each, and the pipeline."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from . import chat, decontaminate, line_dedup, media, mixing, ngram_join, quality, records, token_count, warc
from .shared import partitions, written


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer():
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_media_columns(spark, sf_dir):
    """Every whole text of documents as an ISO media file, and what is read back from it.

    Null and empty texts are one frame of zeros; ids, null or repeated, are kept.
    """
    stored = written(media.texts_to_media(_table(spark, sf_dir, "documents")), "media")
    read = media.probe_column(stored, keys=("doc_id", "n_bytes"))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.to_json("tracks").alias("feature"), "error")


def op2_decontamination(spark, sf_dir):
    """doc_id, item_id, word, similarity, hamming: documents with a window like a benchmark item, and the best window."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark, sf_dir):
    """Tokens of every whole text of documents; null and empty texts have none."""
    return token_count.token_counts(_table(spark, sf_dir, "documents"), tokenizer())


def op4_quality_classifier(spark, sf_dir):
    """doc_id, p_quality, p_toxic, accepted of every document, by views trained on labels."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.scored(docs.select("doc_id", "text", "lang", "source", "n_chars"), model).select("doc_id", "p_quality", "p_toxic", "accepted")


def op5_line_dedup(spark, sf_dir):
    """Lines, dropped lines and the digest of the kept text of every document."""
    kept = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_token_records(spark, sf_dir):
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the record files in ascending id, nulls first."""
    return records.token_records(_table(spark, sf_dir, "documents"), tokenizer())


def op7_chat_formatting(spark, sf_dir):
    """Every conversation as one formatted text and what is read back from it: rows by turn, then role and text."""
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = chat.format_trees(chat.from_turns(rows)).withColumn("turns", chat.parsed_turns(F.col("formatted"))).withColumn("trained", chat.masked_text(F.col("formatted"), F.col("loss")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_ngram_join(spark, sf_dir):
    """doc_id, n_shingles, component_id of every document; null ids have a null component."""
    return ngram_join.ngram_join(_table(spark, sf_dir, "documents"))


def op9_warc(spark, sf_dir):
    """Every page as a record, read back from the archives; a record that doesn't match its digests fails the query."""
    listed = warc.write_archives(_table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    read = warc.read_archives(listed, partitions(spark), strict=True)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "block_ok", "payload_ok")


def op10_mixing(spark, sf_dir):
    """How many words the mix takes of every document."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, i, ls[i] AS line,
                 translate(trim(ls[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
          FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM split)),
rep AS (SELECT k, min(doc_id) AS keeper FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
flagged AS (SELECT l.*, r.k IS NOT NULL AND l.doc_id <> r.keeper AS gone FROM lines l LEFT JOIN rep r ON l.k = r.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""

OP7_SQL = r"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
shown AS (
  SELECT *, replace(replace(replace(text, '\', '\s'), '</turn>', '\e'), '### ', '\h') AS body,
         replace(replace(replace(replace(role, '\', '\s'), '</turn>', '\e'), '### ', '\h'), ':', '\c') AS who
  FROM every),
told AS (
  SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         CAST(sum(length('### ' || who || ': ' || body || '</turn>' || chr(10))) AS BIGINT) AS chars
  FROM shown GROUP BY conv_id)
SELECT CAST(conv_id AS BIGINT) AS conv_id, n AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, chars AS formatted_chars
FROM told
"""

OP10_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
         ([5, 2, 1])[1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)]::DOUBLE AS weight,
         sum(source_size) OVER () AS words
  FROM totals),
stepped AS (
  SELECT *, (CAST(words AS DOUBLE) * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
filled AS (SELECT min(CASE WHEN level * weight <= cap THEN cap / weight END) AS edge FROM stepped),
chosen AS (SELECT level FROM stepped WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN (SELECT count(*) FROM chosen) = 0 THEN cap ELSE least(cap, (SELECT level FROM chosen) * weight) END AS target
  FROM ranked),
needs AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
run AS (
  SELECT s.*, n.source_size, n.target, n.whole, sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h) AS upto
  FROM sized s JOIN needs n ON s.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN upto <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""


def queries():
    found = (op1_media_columns, op2_decontamination, op3_token_counts, op4_quality_classifier, op5_line_dedup, op6_token_records, op7_chat_formatting, op8_ngram_join, op9_warc, op10_mixing)
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql():
    return {"op5_line_dedup": OP5_SQL, "op7_chat_formatting": OP7_SQL, "op10_mixing": OP10_SQL}
