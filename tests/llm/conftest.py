import datetime as dt

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text), with further columns whose names operators use themselves."""

    def make(rows):
        schema = "doc_id long, text string"
        return spark.createDataFrame(rows, schema).withColumns(
            {
                "lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.lit(1),
                "key": F.lit(dt.date(2024, 1, 1)), "n": F.lit(3), "row": F.lit("x"), "block": F.lit(1.5),
                "h": F.lit("h"), "fp": F.lit(2), "word": F.lit("w"), "spans": F.lit("s"), "label": F.lit(9), "score": F.lit(None),
                "w": F.lit(1), "task": F.lit("t"), "length": F.lit(4), "item_id": F.lit(5), "all": F.lit(6), "root": F.lit(7),
            }
        )

    return make


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
