import pytest

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf01():
    return SF01


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
