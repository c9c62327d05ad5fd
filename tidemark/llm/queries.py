"""The registered queries of the operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe_chunks, byte_shards, es_mix, fertility, fim_rotation, kneser_ney, multi_index, periodic_runs, prefix_targets,
    quality_gam, simhash_trie, toxic_cnn, url_trust,
)
from tidemark.llm.common import WORD, load, remainder, text_of

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
KEEP_SCORE, TOXIC_SCORE = 0.3, 0.5
#: Trigrams take more disk than the check tool allows (README); the operator counts any order.
LM_ORDER = 2


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_trust.filtered(pages)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ok = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", ok), (-1, 1, "assistant", ok)], chats.schema)
    examples = prefix_targets.texts(chats.unionByName(probe))
    # The last example holds the whole conversation, every other a prefix of it.
    read = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("text"),
        F.sort_array(F.collect_list(F.struct("example", prefix_targets.trained_text().alias("loss")))).alias("replies"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"),
    )
    turns = read.select("*", prefix_targets.turns_of(F.col("text")).alias("turns"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = turns.select("*", F.array_join(said, "").alias("said"), F.array_join("replies.loss", "").alias("loss"))
    return loss.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def quality_model(docs: DataFrame, labels: DataFrame) -> quality_gam.Model:
    """Fitted on the labelled rows that are not held out."""
    known = labels.select("doc_id", F.col("quality").alias("label")).where(remainder("doc_id", 5) != 0)
    return quality_gam.train(docs, known, cut=KEEP_SCORE)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(docs, load(spark, sf_dir, "labels"))
    return quality_gam.scored(docs, model).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_trie.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_shards.shards(docs, 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = kneser_ney.train(docs, remainder("doc_id", 7) != 2, LM_ORDER)
    return kneser_ney.scored(docs, model).select(
        "doc_id",
        (remainder("doc_id", 7) == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.vocabulary.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return fertility.measured(docs, RANKS, PATTERN, PIECES).select("doc_id", "fertility.*")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return multi_index.neighbours(rows, F.col("vec_id") % 20 == 0, 20)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(bpe_chunks.encode(docs, RANKS, PATTERN))


def bpe_digests(encoded: DataFrame, *more: str) -> DataFrame:
    """What a check of ids and decoded bytes needs."""
    return bpe_chunks.decode(encoded, RANKS).select(
        "doc_id",
        *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return es_mix.mixed(docs, es_mix.quality_weight()).select(
        "doc_id",
        "source",
        "mix.size",
        "mix.source_size",
        "mix.target",
        (F.col("mix.copies") * F.col("mix.size")).alias("taken"),
    )


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxic_cnn.train(docs, labels.where(remainder("doc_id", 5) != 0))
    return toxic_cnn.scored(docs, model).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return fim_rotation.restored(fim_rotation.transformed(docs)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where one id in ten repeats a stretch of its words up to the end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    found = docs.select(
        "doc_id",
        text_of().alias("text"),
        F.floor(h / 10).alias("g"),
        F.when(h % 10 == 0, F.regexp_extract_all(text_of(), F.lit(WORD), F.lit(0))).alias("words"),
    )
    cut = found.selectExpr("*", "cast(g % nullif(size(words), 0) AS int) AS a", "size(words) AS n")
    period = cut.selectExpr("*", "cast(1 + (n - a) div (3 + g % 8) AS int) AS p")
    repeated = "array_repeat(slice(words, a + 1, p), cast((n - a) div p + 1 AS int))"
    planted = f"array_join(slice(concat(slice(words, 1, a), flatten({repeated})), 1, n), ' ')"
    return period.selectExpr("doc_id", f"CASE WHEN n > 0 THEN {planted} ELSE text END AS text")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return runs_digests(periodic_runs.collapsed(with_planted_periods(docs)))


def runs_digests(made: DataFrame) -> DataFrame:
    """The run of the greatest exponent, and digests of all runs and of what is kept."""
    none = "cast(NULL AS struct<start: bigint, length: bigint, period: bigint>)"
    best = f"aggregate(runs, {none}, (a, r) -> if(a IS NULL OR r.length * a.period > a.length * r.period, r, a)) AS best"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return made.selectExpr("*", best).selectExpr(
        "doc_id",
        "cast(size(runs) AS bigint) AS n_runs",
        "best.start",
        "best.length",
        "best.period",
        "1000 * best.length div best.period AS exponent_milli",
        f"sha2({lines}, 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_chat_formatting, op3_quality_classifier, op4_simhash, op5_sharding, op6_lm_scoring, op7_quality_rules, op8_nearest, op9_byte_bpe, op10_mixing,
    op11_toxicity, op12_fill_in_middle, op13_periodic_runs,
)}
