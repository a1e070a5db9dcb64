"""The operators of this subpackage as queries over the given tables, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.bpe import token_digests
from linkloom.llm.byterepeats import remove_repeated_bytes
from linkloom.llm.chat import TURNS_PER_PIECE, chat_examples
from linkloom.llm.collocations import collocations
from linkloom.llm.exact import exact_duplicates
from linkloom.llm.minhash import near_duplicates
from linkloom.llm.neighbours import nearest_neighbours
from linkloom.llm.packing import best_fit
from linkloom.llm.quality import quality_scores
from linkloom.llm.repair import repaired_conversations
from linkloom.llm.search import bm25_top_k
from linkloom.llm.settings import small_batches
from linkloom.llm.sharding import ROW_BYTES, byte_shards
from linkloom.llm.wordrepeats import remove_repeated_words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 40
#: Folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("LINKLOOM_TOKENIZERS", "/opt/tokenizers")


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = lambda spark, sf: run(small_batches(spark), sf)
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return best_fit(table(spark, sf, "documents"))


@query
def op2_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    sha = F.sha2("kept", 256).alias("kept_sha256")
    return remove_repeated_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", sha)


@query
def op3_bpe(spark: SparkSession, sf: str) -> DataFrame:
    tokenizer = Path(TOKENIZERS, "byte_bpe_50k.json").read_text()
    return token_digests(table(spark, sf, "documents"), tokenizer)


@query
def op4_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_duplicates(table(spark, sf, "documents")).drop("text_hash")


ORACLES["op4_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query
def op7_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return byte_shards(table(spark, sf, "documents"), SHARDS)


ORACLES["op7_sharding"] = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
), rows_ AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS bytes_,
         strlen(coalesce(text, '')) + {ROW_BYTES} AS size FROM documents
), sized AS (
  SELECT doc_id, size, CASE WHEN bytes_ = '' THEN 0 ELSE xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT,
      [('0x' || h)::BIGINT for h in regexp_extract_all(bytes_, '..')]),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) END AS text_crc32
  FROM rows_, crc_table
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS first_, sum(size) OVER () AS total
  FROM sized
), cut AS (
  SELECT *, least((2 * first_ + size) * {SHARDS} // (2 * total), {SHARDS - 1})::INTEGER AS shard
  FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot,
       NULL::INTEGER AS grown_shard
FROM cut
"""


@query
def op8_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    return chat_examples(table(spark, sf, "conversations"))


ORACLES["op8_chat_formatting"] = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role) AS pos
  FROM conversations
), whole AS (
  SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY pos) AS said,
         count(*) AS n FROM turns GROUP BY conv_id
), distinct_ AS (SELECT min(conv_id) AS conv_id, said, n FROM whole GROUP BY said, n
), kept AS (
  SELECT conv_id FROM distinct_ a WHERE NOT EXISTS (
    SELECT 1 FROM distinct_ b WHERE b.said[1] = a.said[1] AND b.n > a.n AND b.said[1:a.n] = a.said)
)
SELECT conv_id, ((pos - 1) // {TURNS_PER_PIECE})::INTEGER AS piece, count(*) AS n_turns,
       string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10)
         || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM turns JOIN kept USING (conv_id) GROUP BY ALL
"""


@query
def op9_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op6_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), width=2)


@query
def op10_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    sha = F.sha2("kept", 256).alias("kept_sha256")
    return remove_repeated_words(docs).select("doc_id", "n_words", "n_removed", sha)


@query
def op5_exact_top_k_search(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    asked = docs.filter("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return bm25_top_k(docs, asked)


@query
def op13_phrase_collocation_mining(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))


@query
def op12_approximate_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf, "embeddings"), every=20, k=20)


ORACLES["op12_approximate_nearest_neighbours"] = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, row_number() OVER () AS uid FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), ranked AS (
  SELECT q.vec_id AS query_id, q.uid AS own, c.vec_id, c.uid, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.uid <> c.uid AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id, uid) AS rank FROM ranked
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM placed WHERE rank <= 20
"""


@query
def op11_conversation_structure_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repaired_conversations(table(spark, sf, "conversations"))
