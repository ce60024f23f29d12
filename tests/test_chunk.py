import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.support import SF, collected, windows
from wellspring.functions.text import WHITESPACE, strip, words
from wellspring.operators.chunk import chunk, row_range_batch
from wellspring.schemas import ARTICLE
from wellspring.sources.articles import article_scan, articles, batches, peek


def chunked(spark, texts, size=512, overlap=64):
    rows = [(i, "t", text) for i, text in enumerate(texts)]
    out = chunk(spark.createDataFrame(rows, ARTICLE), size, overlap).collect()
    found = {}
    for row in sorted(out, key=lambda r: (r.doc_id, r.chunk_no)):
        found.setdefault(row.doc_id, []).append(row.chunk_text)
        assert row.chunk_id == f"{row.doc_id}:{row.chunk_no}"
        assert row.chunk_no == len(found[row.doc_id]) - 1
    return [found.get(i, []) for i in range(len(texts))]


def numbered(n):
    return " ".join(f"w{i}" for i in range(n))


def test_edge_texts(spark):
    texts = ["", "  \n ", None, " a b c\x1cd\x85e  ", numbered(448), numbered(449), numbered(512)]
    found = chunked(spark, texts)
    assert found[:4] == [[], [], [], ["a b c d e"]]
    assert [[len(c.split()) for c in cs] for cs in found[4:]] == [[448], [449, 1], [512, 64]]


@pytest.mark.parametrize("size, overlap", [(64, 64), (4, 5), (4, -1), (0, 0)])
def test_geometry_that_never_ends_is_rejected(spark, size, overlap):
    with pytest.raises(ValueError):
        chunk(spark.createDataFrame([], ARTICLE), size, overlap)


def test_every_document_matches_the_definition(spark):
    docs = articles(spark, f"{SF}/documents.parquet", title="source")
    texts = {row.doc_id: row.text for row in docs.collect()}
    expected = {
        (d, n): c for d, text in texts.items() for n, c in enumerate(windows(text, 512, 64))
    }
    found = {(r.doc_id, r.chunk_no): r.chunk_text for r in chunk(docs).collect()}
    assert found == expected


def test_windows_share_overlap_and_rebuild_the_text(spark):
    text = numbered(1000)
    [found] = chunked(spark, [text], 100, 30)
    parts = [c.split() for c in found]
    for before, after in zip(parts, parts[1:]):
        shared = min(30, len(after), len(before))
        assert after[:shared] == before[70 : 70 + shared]
    assert sum((p[:70] for p in parts), []) == text.split()


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    texts=st.lists(st.text(alphabet="ab" + WHITESPACE, max_size=60), min_size=1, max_size=8),
    size=st.integers(1, 9),
    data=st.data(),
)
def test_any_whitespace_and_geometry(spark, texts, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    assert chunked(spark, texts, size, overlap) == [windows(t, size, overlap) for t in texts]


def test_whitespace_of_every_character(spark):
    points = [c for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, f"a{chr(c)}b") for c in points], "c int, s string")
    split = df.where(F.size(words(F.col("s"))) == 2).select("c").collect()
    assert {r.c for r in split} == {c for c in points if chr(c).isspace()}
    ends = spark.createDataFrame([(c, f"{chr(c)}b{chr(c)}") for c in points], "c int, s string")
    bare = ends.where(strip(F.col("s")) == "b").select("c").collect()
    assert {r.c for r in bare} == {c for c in points if chr(c).isspace()}


def test_chunk_splits_each_text_once(spark):
    plan = chunk(articles(spark, f"{SF}/documents.parquet", title="source"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("split(") == 1 and "Exchange" not in text


def test_batches_by_numbering(spark):
    docs = articles(spark, f"{SF}/documents.parquet", title="source")
    sparse = docs.withColumn("doc_id", F.col("doc_id") * 7 + 3)
    out = collected(batches(sparse, 60).select("doc_id", "batch_id"), "doc_id")
    assert out == [(i * 7 + 3, i // 60) for i in range(docs.count())]
    plan = batches(docs, 60)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # texts stay where they lie
    odd = docs.withColumn("doc_id", F.when(F.col("doc_id") > 3, F.col("doc_id") % 50))
    per = odd.groupBy("doc_id").count().orderBy("doc_id").collect()
    found = {r.doc_id: r.b for r in batches(odd, 60).groupBy("doc_id").agg(F.collect_set("batch_id").alias("b")).collect()}
    before = 0
    for key, n in ((r.doc_id, r["count"]) for r in per):  # a key's rows share the batch of its first
        assert len(found[key]) == 1 and found[key][0] <= before // 60 + 1
        before += n
    last = spark.range(1).select(row_range_batch(F.lit(99_999)), row_range_batch(F.lit(100_000)))
    assert tuple(last.first()) == (0, 1)


def test_peek_takes_the_row_in_key_order(spark):
    docs = articles(spark, f"{SF}/documents.parquet", title="source")
    assert [r.doc_id for r in peek(docs, 20).collect()] == [20]
    assert peek(docs, 10_000).collect() == []
    assert peek(docs.withColumn("doc_id", F.col("doc_id") * 5 - 300), 20).first().doc_id == -200


def test_scan_reads_only_its_columns(spark):
    plan = articles(spark, f"{SF}/documents.parquet", title="source")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in text
    spread = article_scan(spark, f"{SF}/documents.parquet", title="source")
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
