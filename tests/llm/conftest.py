from pathlib import Path

import pytest

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, one partition each two rows."""

    def make(pairs, source="s"):
        rows = [(i, t, "en", source, None) for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    return make


@pytest.fixture
def sf_small(spark, tmp_path):
    """A folder with the smallest tables of which documents are the first n by doc_id; gives its path."""

    def make(n):
        for name in ("documents", "labels", "benchmark"):
            df = spark.read.parquet(str(SF / f"{name}.parquet"))
            (df.orderBy("doc_id").limit(n) if name == "documents" else df).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return make
