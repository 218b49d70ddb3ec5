"""A corpus pipeline of four operators: quality, language, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next stage reads what it kept.  All but the last return
the columns of ``documents``, unchanged, and further columns too, whatever their names.  Null and empty texts are judged like
any other text: the classifier gives them its score for empty text, and the language stage rejects a text without letters.
Repeated rows are judged each; of rows alike the near-duplicate stage keeps one.  Very long texts count whole.  An empty table
gives no rows at any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailhead.llm import common, jaccard, langid, packing, quality, queries

KEEP_QUALITY = 0.3
KEEP_LANGUAGE = 0.35
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose score is KEEP_QUALITY or more; learns from labelled rows outside fold 0 of 5."""
    model = quality.fit(quality.train_rows(docs, 5), common.table(spark, sf_dir, "labels"))
    (own,) = common.free_names(docs, "quality_score")
    return quality.score(docs, model, own).where(F.col(own) >= KEEP_QUALITY).drop(own)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language that holds KEEP_LANGUAGE of the text; learns from rows outside fold 2 of 4."""
    model = langid.fit(docs.where(common.fold_bucket(F.col("doc_id"), 4) != 2))
    own = common.free_names(docs, *langid.RESULTS)
    return langid.predict(docs, model, into=own).where((F.col(own[0]) != "und") & (F.col(own[1]) >= KEEP_LANGUAGE)).drop(*own)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: the smallest doc_id's (null last), then the least text hash's.

    Rows of one id with unrelated texts are in different groups; rows without words are no one's duplicates and all stay."""
    return jaccard.representatives(docs, NEAR_WIDTH, NEAR_PERCENT)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of 2048 tokens."""
    return packing.pack(docs, queries.public_file(queries.WORD_BPE))


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_duplicates", near_duplicate_stage), ("packing", packing_stage)]

#: SQL can express none of the stages' models; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = common.written(stage(spark, docs, sf_dir), name)
        if before:
            common.remove(spark, before)  # only the last table is read from here on
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
