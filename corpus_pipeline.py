"""The corpus pipeline: quality filter, language filter, near-dedup, source mixing, packing.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and
read back as the next stage's ``docs``. All but the last return the columns of ``documents``. Null, empty and
repeated rows fare as the operators' modules say; rows of one doc_id count as one document in near-dedup
(the one whose text has the smallest hash stays), and rows without a doc_id pass it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.llm import langid, mixing, neardup, packing, quality
from stratus.llm.registry import LANGUAGE_SHARES, tokenizer_path
from stratus.llm.tables import table, written


def _apart(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` with all but the needed columns in one, so that none has a name that a stage uses."""
    return docs.select(*needed, F.struct(*(c for c in docs.columns if c not in needed)).alias("_others"))


def _together(rows: DataFrame, docs: DataFrame, *needed: str) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(*(F.col(c) if c in needed else F.col("_others").getField(c).alias(c) for c in docs.columns))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(_apart(docs, "text"), model).where("predicted = 1")
    return _together(scored, docs, "text")


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier tells with enough certainty."""
    told = langid.predict(_apart(docs, "text"), langid.fit(docs)).where("NOT rejected")
    return _together(told, docs, "text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    kept = neardup.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    stays = _apart(docs, "doc_id", "text").join(kept, "doc_id", "left_semi").withColumn("_place", F.row_number().over(one))
    return _together(stays.where("_place = 1"), docs, "doc_id", "text").union(docs.where("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens match the target shares of sources, languages and topics."""
    return mixing.selected(docs, {"lang": LANGUAGE_SHARES})


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training windows."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality_filter),
    ("language", language_filter),
    ("near_dedup", near_dedup),
    ("mix", mix_sources),
    ("pack", pack_windows),
]

# The classifiers and the sampler have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
