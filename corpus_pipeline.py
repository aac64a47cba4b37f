"""The corpus pipeline: quality rules, line dedup, near-duplicates, mixing, token ids.

Every stage reads what the one before has written and works on all of it.

Defined results: only the columns of ``documents`` go on, others are left out. Null and empty
texts fail the quality rules. Rows without ``doc_id`` are judged like others and come last
where the first of copies stays; of rows with equal ``doc_id`` and text one stays. Without
labels the base rules alone judge and the mix takes all domains for equally likely. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid.llm import bpe, jaccard, line_chunks, mixing, quality_rules
from pacegrid.llm.common import table, vocabulary, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Every document is taken at least once, and none more than four times.
EPOCHS = (1.0, 4.0)
RANKS = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules learned from ``labels`` keep."""
    judged = quality_rules.judge(docs, table(spark, sf_dir, "labels"))
    return judged.where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated passages; those left without text go."""
    cleaned = line_chunks.dedup_runs(docs.select(*COLUMNS))
    left = cleaned.where(F.col("text").rlike(quality_rules.WORD))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates."""
    return jaccard.one_of_each(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, one to four times."""
    return mixing.mixed(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), bounds=EPOCHS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, checked by decoding them."""
    ranks = vocabulary(RANKS)
    return bpe.digests(bpe.round_trip(docs, ranks))


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", token_ids),
]

#: Learned rules, hashes and ids are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{place}")
    return docs
