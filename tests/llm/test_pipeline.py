"""The stages of the pipeline, each against its operator's own answer on the same input."""

import inspect

import corpus
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import bpe_chunks, es_mix, fertility, quality_gam, simhash_trie
from tidemark.llm.queries import KEEP_SCORE, PATTERN, PIECES, RANKS, quality_model

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd")) + "/docs"
    real = spark.read.parquet(f"{SF}/documents.parquet").withColumn("size", F.lit("clash"))
    real.unionByName(corpus.documents(spark).select("doc_id", "text", "lang", "source", "n_chars", F.lit("x").alias("size"))).write.parquet(path)
    return spark.read.parquet(path)


def test_signatures():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for f in STAGES.values())


def test_stages_do_what_their_operators_say(spark, odd):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality_gam.scored(odd.withColumn("doc_id", F.monotonically_increasing_id()), quality_model(odd, labels))
    kept = STAGES["quality classifier"](spark, odd, SF)
    assert kept.columns == odd.columns and kept.count() == scored.where(F.col("score") >= KEEP_SCORE).count() < odd.count()

    ruled = STAGES["quality rules"](spark, odd, SF)
    found = fertility.measured(odd, RANKS, PATTERN, PIECES).where("fertility.kept").select(*odd.columns)
    assert rows(ruled) == rows(found) and 0 < ruled.count() < odd.count()

    single = STAGES["near duplicates"](spark, odd, SF)
    # Groups are known by their root: several may have the same smallest id where ids repeat.
    _, of = simhash_trie.grouped(odd, simhash_trie.SHINGLE, simhash_trie.DISTANCE, simhash_trie.UNIT)
    ids = [r.component_id for r in of.select("root", "component_id").distinct().collect()]
    assert single.columns == odd.columns
    assert sorted((r.doc_id for r in single.collect()), key=str) == sorted(ids, key=str)

    mixed = STAGES["source mix"](spark, odd, SF)
    copies = es_mix.mixed(odd, es_mix.quality_weight()).agg(F.sum("mix.copies")).first()[0]
    assert mixed.columns == odd.columns and mixed.count() == copies

    ids = STAGES["token ids"](spark, odd, SF)
    assert ids.count() == odd.count()
    decoded = bpe_chunks.decode(ids, RANKS).select(F.col("bytes").cast("string").alias("text"))
    assert sorted(r.text for r in decoded.collect()) == sorted(r.text or "" for r in odd.collect())


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert rows(corpus_pipeline.run(spark, SF)) == rows(docs)


def test_empty_table(spark, odd):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0
