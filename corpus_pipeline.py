"""Documents from the raw table to token ids: reject, clean, thin out, decontaminate, encode.

Every stage but the last returns the columns of the rows it is given, unchanged but for `text` and
`n_chars` after line dedup, whatever their names are. A null or empty text goes through all stages that
do not reject it; an empty table gives an empty one. The docstrings of the operators' modules state
what they do with very long texts, ties and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm import (
    bpe_trie,
    line_winnowing,
    positional_index,
    quality_nbsvm,
    simhash_anchors,
)
from tramline.llm.tables import read_table, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; repeated rows share their fate."""
    labels = read_table(spark, sf_dir, "labels")
    return quality_nbsvm.accepted(docs, quality_nbsvm.fit(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that came before; a null text stays null."""
    return line_winnowing.without_repeated_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the smallest id, once if it repeats.

    Texts without words are a class, so one of them stays.
    """
    return simhash_anchors.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not repeat the benchmark; all stay if it is empty."""
    return positional_index.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids, decoded) of every document left."""
    return bpe_trie.encode_documents(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", decontamination),
    ("bpe", bpe),
]

# A trained classifier and the tokenizer's merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each one written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
