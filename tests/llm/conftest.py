import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents table from (doc_id, text, source) tuples."""
    def make(rows, extra=""):
        full = [(i, t, "en", s, None if t is None else len(t), *more) for i, t, s, *more in rows]
        return spark.createDataFrame(full, DOCS + extra)
    return make


@pytest.fixture(scope="session")
def save(tmp_path_factory):
    """Writes tables as Parquet folders and returns the folder that queries take as sf_dir."""
    def put(**tables):
        root = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.parquet(f"{root}/{name}.parquet")
        return str(root)
    return put
