import pytest
from pyspark.sql import functions as F

from stratus.llm.tables import importable


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


@pytest.fixture
def docs(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return df.withColumn("n_chars", F.char_length("text").cast("long"))
    return make
