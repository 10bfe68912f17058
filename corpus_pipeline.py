"""A corpus through five stages: language ID, line dedup, near duplicates, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes what a stage keeps to the shared folder and hands the
next one what it reads back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.byte_bpe import encode
from docweave.llm.decontaminate import decontaminated
from docweave.llm.jaccard_join import one_of_each
from docweave.llm.language_id import in_known_language, learn_profiles
from docweave.llm.line_dedup import without_repeats
from docweave.llm.tables import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, by profiles learnt from those that name theirs: all that have a letter."""
    return in_known_language(docs, learn_profiles(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of repeated three-line windows; those that nothing is left of go."""
    return without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids, their number, and whether decoding them gives the text back."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    text = F.coalesce("text", F.lit(""))
    ids = encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, decoded="decoded")
    return ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == text.cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("byte_bpe", tokens),
]

#: Byte-level BPE merges and rank-order profiles are not expressible in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
