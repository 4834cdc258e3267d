import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def doc_rows(texts):
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture()
def docs_of(spark):
    def make(texts):
        return spark.createDataFrame(doc_rows(texts), DOCS)

    return make


@pytest.fixture()
def parquet_dir(spark, tmp_dir):
    """Write named frames as the tables of a data folder."""

    def make(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_dir}/{name}.parquet")
        return tmp_dir

    return make
