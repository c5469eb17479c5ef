from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from awkward_tables import CLASHING, SCHEMA, SF_DIR, awkward_rows


@pytest.fixture(scope="session")
def awkward(spark):
    docs = spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)
    return docs.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASHING)))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source").collect()


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from scrubline.llm.storage import ship

    ship(spark)
