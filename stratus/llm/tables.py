"""Reading the input tables and cutting lineage for the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import stratus
from stratus.session import materialize


BATCH_ROWS = 1000  # rows of an Arrow batch: texts are long, and a batch lies in memory more than once


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder the driver has it in (on a cluster that does
    not share the folder: install it, or pass it with --py-files), and keep Arrow batches small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.abspath(stratus.__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write under ``spark.checkpoint.dir`` and read back (survives lost executors)."""
    return materialize(df, f"llm_{name}")


def held_out(doc_id: str, modulus: int, remainder: int):
    """True where crc32 of the id's decimal text leaves ``remainder``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)) == remainder
