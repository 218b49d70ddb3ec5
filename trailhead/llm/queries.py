"""The operators' queries: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailhead.llm import chat, common, fingerprint, jaccard, langid, neighbours, packing, pieces, quality, token_files, warc
from trailhead.llm.oracle import ORACLE as ORACLE

WORD_BPE, PIECE_MODEL = "word_bpe_49k.json", "piece_bpe_32k.model"
ESCAPED = "\\### Assistant: </turn> ok"


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ESCAPED).alias("text"))
    turns = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digest(chat.render(chat.fold(chat.turns_as_events(turns))))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_path(spark, "tokens")
    token_files.write_tokens(common.table(spark, sf_dir, "documents"), path, public_file(WORD_BPE))
    return token_files.digest(token_files.with_starts(spark, path))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(common.table(spark, sf_dir, "documents"), public_file(PIECE_MODEL))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(spark, sf_dir, "documents"), public_file(WORD_BPE))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited(common.table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_path(spark, "warc")
    warc.write(warc.derive(warc.responses(common.table(spark, sf_dir, "pages"))), path)
    found = warc.read(spark, path)
    text = F.col("block").cast("string")
    links = F.regexp_count(text, F.lit("(?m)^outlink: "))
    return found.select(
        F.expr("try_cast(source_id as bigint)").alias("page_id"), "warc_type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest", "intact",
        F.octet_length("block").cast("long").alias("n_bytes"), F.when(F.col("warc_type") == "metadata", links).cast("long").alias("n_links"), F.when(F.col("warc_type") == "conversion", F.length(text)).cast("long").alias("n_chars"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(quality.train_rows(docs, 5), common.table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", (common.fold_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), F.col("quality_score").alias("score"), F.when(F.col("quality_score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(common.table(spark, sf_dir, "documents"), width=3, percent=90)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(common.fold_bucket(F.col("doc_id"), 4) != 2))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (common.fold_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "lang_set")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_neighbours, op2_chat, op3_token_files, op4_pieces, op5_packing, op6_fingerprints, op7_warc, op8_quality, op9_jaccard, op10_language, pipeline)
}
