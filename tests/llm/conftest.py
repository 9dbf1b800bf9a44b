import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    """Texts of the smallest documents table by id."""
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def frame(spark):
    """(id, text) rows as documents, with an extra column that clashes with inner names."""

    def make(rows, columns="doc_id long, text string", extra=True):
        df = spark.createDataFrame(rows, columns)
        if extra:
            for name in ("id", "ids", "key", "label", "grp", "bands", "range", "n_tokens", "first", "hash"):
                df = df.selectExpr("*", f"'x' as `{name}`")
        return df

    return make
