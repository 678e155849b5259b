"""The corpus pipeline: documents through five stages, each written as Parquet
and read again as the next one's input.

Every stage works on all that the stage before it kept, and its decisions take
effect: rejected documents go, one document of each near-duplicate group stays,
documents that hold a benchmark item go, personal data is masked, and the last
stage encodes what is left. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colloquy.llm import bpe, decontam, ngram_join, pii, quality
from colloquy.llm.queries import VOCABULARY
from colloquy.session import cut_lineage, discard
from colloquy.sources.tables import table

#: Near duplicates of the pipeline: five words, 80 of 100.
NEAR = ngram_join.Rule(size=5, num=80, den=100)

#: Models and iterative joins stand behind the stages, so SQL has no form of it.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With one document of each group of near duplicates."""
    return ngram_join.keep_one(docs, NEAR)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With personal data replaced by its kind; n_chars follows the text."""
    return pii.masked(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of the masked texts."""
    return bpe.encode(docs, VOCABULARY)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", remove_benchmark),
    ("personal_data", mask_personal_data),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the table documents; the stage tables lie in the
    shared scratch folder and go when the next stage is written."""
    docs, written = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        after = cut_lineage(stage(spark, docs, sf_dir))
        if written is not None:
            discard(written)
        docs = written = after
    return STAGES[-1][1](spark, docs, sf_dir)
