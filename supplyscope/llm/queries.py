"""The ``opN_<name>`` queries: each reads its whole table and applies one operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.llm import (bm25_wand, chat, hmm_lm, label_shards, mixing, multi_index, quality_cnn, query_sharing,
                             simhash, token_counts, token_shards, warc_chunks, whitening)
from supplyscope.llm.common import crc_fold, table
from supplyscope.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

GOOD = 0.3                                     # least score of a document that is kept
END_ID = 2                                     # closes each document's ids
PROBE = r"\### Assistant: </turn> ok"          # the text of conversation -7


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.taken_words(table(spark, sf_dir, "documents"))
    return out.select(F.col("doc").alias("doc_id"), "size", "source_size", "target", "taken", "first_shard", "last_shard")


def op2_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = crc_fold("doc_id", 5) == 0
    model = quality_cnn.train(docs, table(spark, sf_dir, "labels"), ~held)
    out = quality_cnn.scored(docs.withColumn("held_out", held), model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, looked up where an operator needs it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "token-shards")
    entries = token_shards.write_shards(table(spark, sf_dir, "documents"), root, vocabulary("byte_bpe_50k.json"), END_ID)
    index, parts = token_shards.build_index(entries, root)
    out = token_shards.read_back(entries.select("key", "copy"), entries, index, parts, root)
    return out.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op4_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    return warc_chunks.read_archives(warc_chunks.archive_pages(table(spark, sf_dir, "pages"), root), root)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25_wand.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = label_shards.shard_documents(table(spark, sf_dir, "documents"), label_shards.SHARDS)
    return out.select(F.col("doc").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), "law", "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    out = chat.format_conversations(turns.unionByName(probe))
    out = out.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                     chat.masked_text(F.col("formatted"), F.col("mask")).alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


def op9_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hmm_lm.score_documents(table(spark, sf_dir, "documents"), crc_fold("doc_id", 10) == 0)
    return out.select("doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      F.col("base").alias("base_score"), "score")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_query_sharing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_sharing.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_mix_sources, op2_quality_cnn, op3_token_shards, op4_warc_chunks, op5_decontaminate, op6_label_shards, op7_multi_index,
        op8_chat_format, op9_simhash_blocks, op10_hmm_score, op11_token_counts, op12_whitening, op13_query_sharing)}


#: Conversations with the probe; the marks of the template are counted from the roles alone.
CHAT_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
m AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS prev,
         length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS body,
         length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS mark
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'),
                       '')) AS loss_sha256,
       CAST(sum(body + CASE WHEN prev IS NOT DISTINCT FROM role THEN 6 ELSE mark + 15 END) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

#: Every item against every document that holds one of its terms.
SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
b AS (SELECT item_id, {_TERMS} AS t FROM benchmark),
k AS (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS words FROM d WHERE len(t) > 0),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(t) AS term FROM b) GROUP BY item_id, term),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d)
      GROUP BY r, doc_id, n, term),
q AS (SELECT * FROM p WHERE term IN (SELECT term FROM i)),
w AS (SELECT term, CAST(floor(1000 * ln((2 * CAST(any_value(docs) AS DOUBLE) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM q, k GROUP BY term),
s AS (SELECT item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf)
             // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN i USING (term), k GROUP BY item_id, r, doc_id),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
             doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_chat_format": CHAT_SQL, "op13_query_sharing": SEARCH_SQL}
