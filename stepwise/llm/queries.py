"""The registered queries of this subpackage, op1_ to op13_, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from . import langid, quality
from .alignment import align_tokens
from .chat import digests, format_chats
from .embedding_dedup import near_vectors
from .fingerprints import edited_neighbours
from .line_dedup import drop_repeated_lines
from .mixing import mix, word_count
from .near_dedup import near_duplicates
from .packing import pack
from .pattern_packing import pack_by_patterns
from .repair import damaged, repair
from .substring_dedup import drop_repeated_phrases


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_phrases(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    measured = quality.measured(docs).checkpoint()  # read twice: to fit and to score
    out = quality.scored(measured, quality.quality_model(measured, labels))
    return out.select("doc_id", (quality.bucket(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    events = rows.union(added).select("*", F.lit(0).alias("seq"), F.lit("message").alias("kind"))
    return digests(format_chats(events))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(quality.bucket(F.col("doc_id"), 4) != 2))
    out = langid.identify(docs, model)
    languages = F.transform("languages", lambda x: x["lang"]).alias("languages")
    return out.select("doc_id", (quality.bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", languages)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = edited_neighbours(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(_table(spark, sf_dir, "conversations")))


def op12_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_by_patterns(_table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return align_tokens(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")).drop("groups")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality": op5_quality,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_mixing": op7_mixing,
    "op8_language_id": op8_language_id,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_fingerprints": op10_fingerprints,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_pattern_packing": op12_pattern_packing,
    "op13_token_alignment": op13_token_alignment,
}

OP3 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words),
windows AS (SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 19), ' ')) AS h FROM starts),
later AS (SELECT doc_id, i FROM windows
          QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (SELECT e.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY e.i) AS text
         FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i WHERE g.i IS NULL GROUP BY e.doc_id)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(n_kept, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM words d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

OP4 = r"""
WITH lines AS (
  SELECT doc_id, pos, line, lower_ascii AS key FROM (
    SELECT doc_id, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS line,
           translate(regexp_replace(unnest(parts), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
keys AS (SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10
         GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT l.doc_id, l.pos, l.line, k.key IS NOT NULL AND l.doc_id <> k.first_doc AS dropped
           FROM lines l LEFT JOIN keys k ON l.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SQL: dict[str, str] = {
    "op3_substring_dedup": OP3,
    "op4_line_dedup": OP4,
}
