import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts: ids count up; extra columns have names that operators use inside."""
    def make(texts, ids=None, clash=False, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", (sources or ["s"])[k % len(sources or ["s"])], None if t is None else len(t))
                for k, (i, t) in enumerate(zip(ids, texts))]
        df = spark.createDataFrame(rows, DOC_SCHEMA)
        if clash:
            for c in ("id", "h", "n", "u", "score", "host", "row", "shard", "rank", "text_hash"):
                df = df.selectExpr("*", f"'x' AS {c}")
        return df
    return make
