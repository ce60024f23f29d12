"""What a job does besides its rows grows with the input, not with what was written before it."""

import sys
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from tests.support import collected
from tests.test_index import TINY
from wellspring.operators.encode import BATCH_SIZE, encode
from wellspring.plans import ingest as ingest_plan
from wellspring.plans.ingest import chunk_corpus, embed_chunks, ingest, jobs, ledger
from wellspring.schemas import CHUNK, EMBEDDED
from wellspring.sources.articles import batches
from wellspring.sources.tables import files_for, read_batches, write_batches
from wellspring.workspace import scratch


def small_batches(spark, n=300, rows=4):
    docs = spark.range(n * rows).select(F.col("id").alias("doc_id"), F.lit("t").alias("title"), F.concat_ws(" ", F.lit("word"), "id").alias("text"))
    return batches(docs, rows)


def test_small_batches_share_a_job_and_have_a_file_each(spark, monkeypatch):
    groups, real = [], ingest_plan.embed_batches
    monkeypatch.setattr(ingest_plan, "embed_batches", lambda c, p, f, ids: groups.append(ids) or real(c, p, f, ids))
    path = scratch(spark, "t")
    index = ingest(small_batches(spark), path, TINY, 8, batch_rows=4)
    assert index.size().first().ntotal == 1200 and [len(g) for g in groups] == [300]
    for folder in ("chunks", "embedded/rows"):
        assert len(list(Path(path, folder).glob("batch_id=*/*.parquet"))) == 300
    assert ledger(spark, path + "/embedded").agg(F.count("*"), F.sum("n_chunks")).first()[:] == (300, 1200)


def test_a_job_reads_back_its_own_folders(spark):
    path = scratch(spark, "t")
    write_batches(chunk_corpus(small_batches(spark, 12)).withColumn("batch_id", F.when(F.col("batch_id") > 0, F.col("batch_id"))), f"{path}/c")
    chunks = spark.read.schema(CHUNK).parquet(f"{path}/c")
    embed_chunks(chunks, path, TINY, batch_ids=[3, None, 7, 99])
    assert {(r.batch_id, r.n_chunks) for r in ledger(spark, path).collect()} == {(None, 4), (3, 4), (7, 4)}
    part = read_batches(spark, f"{path}/rows", EMBEDDED, [None, 7])
    assert {r.batch_id for r in part.collect()} == {None, 7}
    assert not any("batch_id=3" in file for file in part.inputFiles())
    rest = collected(embed_chunks(chunks, path, TINY).groupBy("batch_id").count(), "batch_id")
    assert rest == [(None, 4)] + [(i, 4) for i in range(1, 12)]


def test_jobs_hold_a_bounded_number_of_chunks():
    sizes = {i: 1000 for i in range(3000)} | {None: 5}
    groups = jobs(list(sizes), sizes)
    assert [len(g) for g in groups] == [1000, 1000, 1000, 1] and sum(groups, []) == list(sizes)
    assert [len(g) for g in jobs(list(range(130)), {i: 10**6 for i in range(130)})] == [64, 64, 2]
    assert jobs([2, 1, 0], sizes, at_once=2) == [[2, 1], [0]] and jobs([], sizes) == []
    assert (files_for(4), files_for(12_501), files_for(10**6)) == (1, 2, 8)


def test_the_index_is_searched_once_for_the_files_that_wait(spark, tmp_path, monkeypatch):
    from tests.support import small_index
    from tests.test_stream import WORDS, Letters, Refusing, inbox, rows_of
    from wellspring.plans import answer as answer_plan
    from wellspring.sources.questions import question_stream, queue_questions, queued_questions
    from wellspring.streaming.answers import answer_stream, responses

    index = small_index(spark, [(i, 0, w, [float(ord(w[0])), float(ord(w[-1]))]) for i, w in enumerate(WORDS)], 2)
    rows = [(f"q{i}", f"{WORDS[i % 8]} {i % 90}", i) for i in range(230)]
    inbox(spark, f"{tmp_path}/inbox", rows + [("f", "fail", 1), ("r", " refuse\n", 1), ("s", "status", 1)], 1)
    queue, searched, real = f"{tmp_path}/queue", [], answer_plan.found_texts
    queue_questions(question_stream(spark, f"{tmp_path}/inbox"), queue, f"{tmp_path}/queued").awaitTermination()
    monkeypatch.setattr(answer_plan, "found_texts", lambda *a: searched.append(1) or real(*a))
    out = {}
    root = Path(scratch(spark, "probe")).parent
    before = set(root.iterdir())
    for name, ahead in (("ahead", queue), ("plain", None)):
        path = f"{tmp_path}/{name}"
        answer_stream(queued_questions(spark, queue), index, Letters(), Refusing(), path, f"{path}/c", retries=1, queue=ahead).awaitTermination()
        out[name] = rows_of(responses(spark, path))
        if name == "ahead":
            assert len(searched) == 1
    assert len(searched) == 4 and out["ahead"] == out["plain"] and len(out["ahead"]) == 232
    assert set(root.iterdir()) <= before


def test_a_micro_batch_of_the_queue_runs_few_jobs(spark, tmp_path):
    from tests.support import small_index
    from tests.test_stream import WORDS, Letters, Refusing
    from wellspring.schemas import REQUEST
    from wellspring.sources.questions import question_stream, queue_questions, queued_questions
    from wellspring.streaming.answers import answer_stream, responses, stream_metrics, totals_before, totals_metrics

    index = small_index(spark, [(i, 0, w, [float(ord(w[0])), float(ord(w[-1]))]) for i, w in enumerate(WORDS)], 2)
    jobs = []
    for files in (2, 10):
        path = f"{tmp_path}/{files}"
        asked = spark.range(0, 10 * files - 3, 1, 1).select(F.concat_ws(" ", F.lit("fig"), "id").alias("query_text"))
        asked.union(spark.createDataFrame([("status",), ("fail",), ("refuse",)], "query_text string")).coalesce(1).write.json(f"{path}/inbox")
        queue_questions(question_stream(spark, f"{path}/inbox"), f"{path}/queue", f"{path}/queued", rows=10).awaitTermination()
        running = answer_stream(queued_questions(spark, f"{path}/queue"), index, Letters(), Refusing(), path, f"{path}/c", retries=1, queue=f"{path}/queue")
        running.awaitTermination()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(running.runId))))
        # ids and times that are made up are the same in both places
        arrived = spark.read.schema(REQUEST).json(f"{path}/arrivals")
        answered = responses(spark, path)
        ids = [r.query_id for r in answered.collect()]
        assert sorted(ids) == sorted(r.query_id for r in arrived.collect()) and len(set(ids)) == 10 * files - 1
        assert arrived.where("ts IS NULL").count() == 0 and answered.where("processing_time >= 0").count() == 10 * files - 3
        totals = totals_before(spark, path, files)
        assert totals == {"arrived": 10 * files - 1, "completed": 10 * files - 3, "failed": 2}
        assert tuple(totals_metrics(totals).values()) == tuple(stream_metrics(spark, path).first())
    assert jobs[1] - jobs[0] <= 8 * 5  # ten for each file before


class Held:
    """Encodes each text as the number of texts that its caller holds as Python objects."""

    def __call__(self):
        def run(texts):
            held = len(sys._getframe(1).f_locals["texts"])
            return np.array([[held]] * len(texts), np.float32)

        return run


def test_a_worker_holds_one_piece_of_a_batch_as_python_texts(spark):
    text = F.when(F.col("id") % 7 > 0, F.concat_ws(" ", F.lit("word"), "id"))
    source = spark.range(0, 3000, 1, 1).select("id", text.alias("text"))
    out = source.select("id", "text", encode(F.col("text"), Held()).alias("e")).collect()
    assert [r.id for r in out] == list(range(3000))
    assert all((r.e.embedding == []) == (r.text is None) for r in out)
    assert max(r.e.embedding[0] for r in out if r.text) == BATCH_SIZE
