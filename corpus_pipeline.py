"""The corpus pipeline: language, near duplicates, repeated passages, benchmark passages, tokens.

Each stage takes what the one before kept, with the columns of ``documents``, and returns what it keeps; the last
returns tokens. ``run`` applies them to the table ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm import byte_bpe, decontaminate, language_id, near_dedup, substring_dedup
from stakeflow.llm.common import small, table, written

#: Documents whose language is less certain are rejected.
LEAST_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without a letter, null texts included, and those of an uncertain
    language, go. All rows of a doc_id go together; those with a null doc_id stay. Extra columns stay as they are."""
    known = language_id.identify(docs, language_id.learn(docs))
    bad = small(known.where((F.col("lang_pred") == language_id.UNKNOWN) | (F.col("score") < LEAST_LANGUAGE_SCORE)).select("doc_id").distinct(), 16)
    return docs.join(bad, "doc_id", "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each class of near duplicates. Of rows of one doc_id, copies of one row, one
    stays; rows with a null doc_id are classes of their own, and stay. Extra columns stay as they are."""
    found = near_dedup.near_duplicate_classes(docs)
    gone = small(found.where("doc_id <> class_id").select("doc_id").distinct(), 16)
    kept = docs.join(gone, "doc_id", "left_anti")
    again = small(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), 16)  # rows that are there twice
    return kept.join(again, "doc_id", "left_anti").unionByName(kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand in earlier ones, their other words joined by spaces. Texts that repeat
    nothing, null ones and rows with a null doc_id included, stay as they are; documents of which nothing is left go."""
    new = "kept"
    while new.lower() in map(str.lower, docs.columns):
        new += "_"
    cut = substring_dedup.remove_repeats(docs).where("doc_id is not null and n_removed > 0").select("doc_id", F.col("kept").alias(new)).dropDuplicates(["doc_id"])
    kept = F.col(new)
    both = docs.join(cut, "doc_id", "left").where(kept.isNull() | (kept != ""))
    n_chars = F.when(kept.isNull(), F.col("n_chars")).otherwise(F.char_length(kept).cast("long"))
    return both.withColumns({"text": F.coalesce(kept, "text"), "n_chars": n_chars}).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``; all rows of a doc_id go together, and null texts stay."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(small(found.select("doc_id").distinct(), 16), "doc_id", "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the tokens as little-endian unsigned 32-bit integers, and the text that they decode to, of every
    row; null texts count as empty."""
    coded = byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", encode),
]

#: SQL can express neither learned models nor byte-pair encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
