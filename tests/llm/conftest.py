import duckdb
import pytest


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(sf):
    """doc_id -> text of the smallest documents table."""
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())


@pytest.fixture
def table(spark):
    """Rows as a documents-like table with extra columns that clash with the operators' own names."""

    def make(rows, schema="doc_id long, text string, source string"):
        df = spark.createDataFrame(rows, schema)
        return df.selectExpr("*", "'x' AS size", "'y' AS fp", "'z' AS row", "'s' AS stats", "'t' AS _stats", "'k' AS _key", "1 AS _copy")

    return make
