"""The queries ``op1_`` to ``op13_`` on the test tables, and the SQL of some."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfold.llm.ann import fit_index, search
from counterfold.llm.chat import format_chats, read_chats, read_loss, to_turns
from counterfold.llm.common import documents, held_out
from counterfold.llm.divergence import SQL as DIVERGENCE_SQL
from counterfold.llm.divergence import source_divergence
from counterfold.llm.jaccard import jaccard_components
from counterfold.llm.mixing import mix_sources
from counterfold.llm.packing import pack_documents
from counterfold.llm.quality import fit_quality, score_quality
from counterfold.llm.rules import judge, language_references
from counterfold.llm.suffixes import remove_repeats
from counterfold.llm.token_counts import count_tokens
from counterfold.llm.token_files import read_token_files, write_token_files
from counterfold.llm.toxicity import fit_toxicity, score_toxicity
from counterfold.llm.variants import spelling_variants
from counterfold.session import scratch_path


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    scored = score_quality(docs, fit_quality(docs, labels, limit=0.3))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), size=4, percent=85)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    scored = score_toxicity(docs, fit_toxicity(docs, labels), limit=0.5)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", "predicted",
        F.size("passages").alias("n_passages"))


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return judge(docs, language_references(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


#: A conversation that says the control strings of a common template.
EXTRA = [(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(["user", "assistant"])]


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA, rows.schema)
    chats = format_chats(to_turns(rows.unionByName(extra)))
    turns = read_chats(F.col("formatted"))
    said = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = read_loss(F.col("formatted"), F.col("loss_spans"))
    return chats.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length('<|turn|><|text|><|end|>')
    + length(regexp_replace(role, '([<\[])(\\*)(\|(?:turn|text|end)\||/?s>|/?INST\])',
        '\1\\\2\3', 'g'))
    + length(regexp_replace(text, '([<\[])(\\*)(\|(?:turn|text|end)\||/?s>|/?INST\])',
        '\1\\\2\3', 'g'))
    AS chars
  FROM rows),
said AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text)
             FILTER (WHERE role = 'assistant'), '') AS loss,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars
FROM said"""


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = documents(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return search(vectors, F.col("id") % 100 == 0, fit_index(vectors), k=10)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"),
        scratch_path(spark, "token-files"), end=1)
    return read_token_files(spark, files).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), size=1024, end=0)
    return pieces.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(documents(spark, sf_dir))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)")
    return remove_repeats(documents(spark, sf_dir), least=50).select(
        "doc_id", "n_bytes", gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_quality": op2_quality,
    "op3_jaccard": op3_jaccard,
    "op4_mixing": op4_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_rules": op6_rules,
    "op7_chat": op7_chat,
    "op8_neighbours": op8_neighbours,
    "op9_token_files": op9_token_files,
    "op10_packing": op10_packing,
    "op11_divergence": op11_divergence,
    "op12_variants": op12_variants,
    "op13_suffixes": op13_suffixes,
}
ORACLE = {"op7_chat": CHAT_SQL, "op11_divergence": DIVERGENCE_SQL}
