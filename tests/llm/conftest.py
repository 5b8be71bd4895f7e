import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm_spark(spark):
    from llm.common import prepare

    return prepare(spark)


@pytest.fixture(scope="session")
def docs_rows(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas()
