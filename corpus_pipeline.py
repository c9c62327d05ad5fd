"""From raw documents to token ids: five stages, each over all that the one before it kept.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of the
documents: the first two drop the documents they reject, the third keeps one document of
each group of near-duplicates, the fourth repeats documents as often as the mix takes them.
The last returns the ids of each document. Between stages the documents are written as
Parquet in the shared folder and read again, so a lost executor costs one stage at most.

Defined cases are those of the operators: texts that are null or empty are rejected by the
rules; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_chunks, es_mix, fertility, quality_gam, simhash_trie
from tidemark.llm.common import load, python_workers, written
from tidemark.llm.queries import KEEP_SCORE, PATTERN, PIECES, RANKS, bpe_digests, quality_model


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = quality_gam.scorer(quality_model(docs, load(spark, sf_dir, "labels")))
    return docs.where(score(F.col("text").cast("binary")) >= KEEP_SCORE)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    python_workers(spark)
    measures = fertility.measures(RANKS, PATTERN, PIECES)(F.col("text").cast("binary"))
    return docs.where(fertility.kept(measures))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_trie.distinct_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return es_mix.sampled(docs, es_mix.quality_weight())


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_digests(bpe_chunks.encode(docs, RANKS, PATTERN), "ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("token ids", token_ids),
]

#: Hashes, models and encodings of these stages have no SQL form; they are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
