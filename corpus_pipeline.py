"""The text operators as a pipeline over documents: reject, deduplicate, mix and encode.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. Between stages the documents
are written as Parquet and read again, so a lost executor costs at most one stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import materialize
from millrace.llm.jaccard import drop_near_duplicates
from millrace.llm.mixing import mix_sources
from millrace.llm.quality import keep_good
from millrace.llm.sentencepieces import encode_pieces
from millrace.llm.toxicity import drop_toxic

#: No SQL engine expresses compression ratios or a fitted lexicon; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with all their columns.

    A null or empty text has too few words and goes; repeated rows stay or go together; an empty table stays empty.
    """
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by a lexicon learned from the labels of those that are left.

    A null or empty text has no matches and stays; repeated rows stay or go together; without labels of both kinds, or
    without rows, nothing is predicted toxic.
    """
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates.

    A null text counts as empty; equal texts without words are one group. A null id comes after all others; of texts
    that share the least id that of the least md5 stays, of rows that share id and text any one.
    """
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's target weight asks, in shuffled order.

    A null source is a source of its own; rows of one id have equal numbers of copies, and a null id hashes as ''.
    Equal keys of the order are told apart by id. An empty table stays empty.
    """
    return mix_sources(docs).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row.

    A null text counts as empty and has no tokens; repeated rows have equal results; an empty table gives an empty one.
    """
    return encode_pieces(docs, remember=400_000)  # executors have four other stages behind them


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
