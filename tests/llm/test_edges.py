"""Nulls, empty tables, very long texts and clashing names of operators whose own tests lack them."""

import random

import pytest
from pyspark.sql import functions as F

from telemetry.llm import site_lines, token_scan

PAGES = "page_id long, url string, html string"


def test_site_lines_empty_table_and_long_text(spark):
    empty = spark.createDataFrame([], PAGES)
    assert site_lines.drop_site_lines(empty, site_lines.html_lines(F.col("html"))).count() == 0
    long = "<p>Menu</p>" + "".join(f"<p>line {i}</p>" for i in range(20_000)) + "<p>" + "x" * 1_000_000 + "</p>"
    pages = spark.createDataFrame([(1, "http://a.example/1", long), (2, "http://a.example/2", "<p>Menu</p><p>own</p>"), (None, None, None)], PAGES)
    for c in ("host", "hashes", "lines", "pages", "kept"):
        pages = pages.selectExpr("*", f"'x' AS `{c}`")
    got = {r.page_id: (r.n_lines, r.n_dropped, r.text) for r in site_lines.drop_site_lines(pages, site_lines.html_lines(F.col("html"))).collect()}
    assert got[1][:2] == (20_002, 1) and got[1][2].startswith("line 0\n") and got[1][2].endswith("x" * 1000)
    assert got[2] == (2, 1, "own") and got[None] == (0, 0, "")


def test_token_counts_of_a_very_long_text(spark, make_docs):
    rng = random.Random(3)
    texts = ["word " * 300_000, "", None, "short text", "x" * 50_000, " ".join(str(rng.randrange(10**6)) for _ in range(50_000))]
    import tiktoken
    enc = tiktoken.Encoding("v", pat_str=token_scan.PATTERN, mergeable_ranks=token_scan.read_vocabulary(), special_tokens={})
    got = {r.doc_id: r.n_tokens for r in token_scan.token_counts(make_docs(texts, clash=True), file_bytes=1 << 16).collect()}
    assert got == {i: len(enc.encode_ordinary(t or "")) for i, t in enumerate(texts)}


@pytest.fixture(scope="module")
def small_tables(spark, tmp_path_factory, make_docs):
    """A folder of tables as the pipeline reads them: null columns, copies, extra columns."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(5)
    good = [" ".join(f"good{rng.randrange(300)}" for _ in range(60)) for _ in range(60)]
    bad = [" ".join(f"bad{rng.randrange(300)}" for _ in range(60)) for _ in range(30)]
    texts = good + bad + [None, "", good[0], good[1]]
    docs = make_docs(texts, ids=[*range(len(texts) - 1), None], clash=True, sources=["a", None, "b"])
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1.0 if i < 60 else 0.0) for i in range(90)], "doc_id long, quality double") \
        .withColumn("quality", F.col("quality").cast("int")).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([("i1", good[2]), (None, None)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts


def test_pipeline_over_nulls_copies_and_extra_columns(spark, small_tables):
    import corpus_pipeline
    folder, texts = small_tables
    out = corpus_pipeline.run(spark, folder)
    rows = out.collect()
    assert rows and {"doc_id", "size", "text_crc32", "shard", "slot"} <= set(out.columns)
    assert all(r.doc_id != 2 for r in rows)  # the benchmark's own text
    assert all(0 <= r.shard < 40 for r in rows)


def test_pipeline_over_empty_documents(spark, small_tables, tmp_path):
    import corpus_pipeline
    folder, _ = small_tables
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
