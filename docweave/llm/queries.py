"""The queries of this subpackage, by name; each takes (spark, folder of tables)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import decontaminate, host_rules, line_dedup, prefix_trie, warc, whitening
from docweave.llm.byte_bpe import encode
from docweave.llm.jaccard_join import jaccard_join
from docweave.llm.language_id import held_out, identify, learn_profiles
from docweave.llm.neighbours import nearest
from docweave.llm.quality import learn, rate
from docweave.llm.quotations import link_quotations
from docweave.llm.repeats import without_repeats

RANKS = "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vec"))
    return nearest(vectors, F.col("id") % 50 == 0)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = without_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # Toxic texts are the lowest grade, then the poor ones, then the good ones.
    grade = F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality") + 1)
    model = learn(docs, _table(spark, sf_dir, "labels").select("doc_id", grade.alias("grade")))
    return rate(docs, model).select("doc_id", "expected_grade", "tail_prob", "keep")


def op5_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotations(_table(spark, sf_dir, "conversations"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = learn_profiles(docs.filter(~held_out()))
    return identify(docs.select("doc_id", "text"), profiles).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_warc(_table(spark, sf_dir, "pages"))
    return warc.read_warc(spark, archives).select(
        warc.page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_number("refers_to").alias("refers_to"),
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return whitening.by_component(whitening.whiten(vectors, whitening.learn(vectors)), ["vec_id"])


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(_table(spark, sf_dir, "conversations"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return host_rules.judged(docs, "source", ["doc_id"]).drop("n_filled_lines")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality": op4_quality,
    "op5_quotations": op5_quotations,
    "op6_language_id": op6_language_id,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_warc": op8_warc,
    "op9_decontaminate": op9_decontaminate,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_quality_rules": op13_quality_rules,
}

#: DuckDB SQL of those queries that SQL can express.
ORACLES: dict[str, str] = {
    "op3_line_dedup": line_dedup.SQL,
    "op8_warc": warc.SQL,
    "op9_decontaminate": decontaminate.SQL,
    "op12_conversation_trie": prefix_trie.SQL,
    "op13_quality_rules": host_rules.SQL,
}
