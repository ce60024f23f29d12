from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.support import collected, small_index
from wellspring.plans.answer import answer_batch, encode_questions
from wellspring.sources.questions import question_line_stream, question_stream
from wellspring.streaming.answers import answer_stream, responses, statuses, stream_metrics
from wellspring.workspace import scratch, stage

WORDS = ["apple", "pear", "plum", "cherry", "fig", "grape", "lime", "kiwi"]


class Letters:
    def __call__(self):
        def run(texts):
            if any("fail" in t for t in texts):
                raise ValueError("marked")
            return np.array([[ord(t[0]), ord(t[-1])] for t in texts], dtype=np.float32)

        return run


class Refusing:
    def __call__(self):
        def run(system, user):
            if "refuse" in user:
                raise TimeoutError("late")
            return user.split("Question: ")[1]

        return run


@pytest.fixture
def index(spark):
    return small_index(spark, [(i, 0, w, [float(ord(w[0])), float(ord(w[-1]))]) for i, w in enumerate(WORDS)], 2)


def inbox(spark, path, rows, files):
    df = spark.createDataFrame(rows, "query_id string, query_text string, t long")
    df = df.select("query_id", "query_text", F.timestamp_seconds("t").alias("ts"))
    df.repartition(files, "query_id").write.mode("append").json(path)


def run(spark, index, path, **options):
    query = answer_stream(
        question_stream(spark, f"{path}/inbox", max_files=1),
        index, Letters(), Refusing(), f"{path}/out", f"{path}/checkpoint", retries=1, **options,
    )
    query.awaitTermination()
    return query


def rows_of(df):
    return collected(df.select("query_id", "query", "answer", "contexts", "error", "status"), "query_id")


def test_stream_equals_batch_and_restart_repeats_nothing(spark, index, tmp_path):
    rows = [(f"q{i}", f"{w} please", i) for i, w in enumerate(WORDS)]
    rows += [("f", "fail", 1), ("r", "refuse", 1)]
    inbox(spark, f"{tmp_path}/inbox", rows, 3)
    first = run(spark, index, tmp_path)
    assert len(list(Path(tmp_path, "out/responses").glob("batch_id=*"))) >= 2
    table = encode_questions(
        spark.createDataFrame([r[:2] for r in rows], "query_id string, query_text string"), Letters()
    )
    batch = stage(answer_batch(index, table, Refusing(), retries=1), "t")
    assert rows_of(responses(spark, f"{tmp_path}/out")) == [
        (q, t, a, c if s == "completed" else None, e, s) for q, t, a, c, e, s in rows_of(batch)
    ]

    inbox(spark, f"{tmp_path}/inbox", [("late", "fig", 5)], 1)
    second = run(spark, index, tmp_path)
    assert first.id == second.id
    ids = [r.query_id for r in responses(spark, f"{tmp_path}/out").collect()]
    assert sorted(ids) == sorted([r[0] for r in rows] + ["late"])
    metrics = stream_metrics(spark, f"{tmp_path}/out").first()
    assert metrics.active_workers == 0
    assert metrics.total_completed == len(WORDS) + 1 and metrics.queue_size == 0


def test_control_words_are_not_answered(spark, index, tmp_path):
    rows = [("a", " QUIT ", 1), ("b", "status", 1), ("c", "  ", 1), ("d", "plum", 1)]
    inbox(spark, f"{tmp_path}/inbox", rows, 1)
    run(spark, index, tmp_path)
    assert [r.query_id for r in responses(spark, f"{tmp_path}/out").collect()] == ["d"]
    controls = spark.read.json(f"{tmp_path}/out/controls")
    assert collected(controls.select("query_id", "kind"), "query_id") == [
        ("a", "quit"), ("b", "status"), ("c", "blank"),
    ]
    reply = statuses(spark, f"{tmp_path}/out").first()
    assert tuple(reply) == ("b", 1, 4, 0, 0)


def test_status_counts_what_waits(spark, index, tmp_path):
    inbox(spark, f"{tmp_path}/inbox", [(f"q{i}", f"fig {i}", 1) for i in range(9)] + [("s", "STATUS", 1)], 1)
    run(spark, index, tmp_path)
    inbox(spark, f"{tmp_path}/inbox", [("q9", "refuse", 2), ("t", "status", 2)], 1)
    run(spark, index, tmp_path)
    replies = collected(statuses(spark, f"{tmp_path}/out"), "query_id")
    assert replies == [("s", 4, 4, 5, 0), ("t", 1, 4, 0, 9)]
    assert tuple(stream_metrics(spark, f"{tmp_path}/out").first()) == (0, 4, 0, 9)
    assert stream_metrics(spark, f"{tmp_path}/nowhere").first().total_completed == 0


def test_repeated_ids_are_answered_one_by_one(spark, index, tmp_path):
    inbox(spark, f"{tmp_path}/inbox", [("a", "plum", 1), ("a", "fig", 1), ("a", "plum", 1)], 1)
    run(spark, index, tmp_path, k=1)
    out = responses(spark, f"{tmp_path}/out").collect()
    assert sorted((r.query, r.contexts[0]) for r in out) == [("fig", "fig"), ("plum", "plum"), ("plum", "plum")]


def test_replayed_batch_overwrites_itself(spark, index, tmp_path):
    inbox(spark, f"{tmp_path}/inbox", [("a", "plum", 1), ("b", "fig", 1)], 1)
    run(spark, index, tmp_path)
    before = rows_of(responses(spark, f"{tmp_path}/out"))
    # Without its commit entry Spark takes the micro-batch as unfinished and runs it again.
    for entry in Path(tmp_path, "checkpoint/commits").iterdir():
        if entry.name.lstrip(".").startswith("0"):
            entry.unlink()
    run(spark, index, tmp_path)
    assert rows_of(responses(spark, f"{tmp_path}/out")) == before


def test_plain_lines_get_an_id_and_a_time(spark, index, tmp_path):
    Path(tmp_path, "lines").mkdir()
    Path(tmp_path, "lines/a.txt").write_text("plum\n quit \nfig\nplum\n")
    query = answer_stream(
        question_line_stream(spark, f"{tmp_path}/lines"),
        index, Letters(), Refusing(), f"{tmp_path}/out", f"{tmp_path}/checkpoint",
    )
    query.awaitTermination()
    out = responses(spark, f"{tmp_path}/out").collect()
    assert sorted(r.query for r in out) == ["fig", "plum", "plum"]
    assert len({r.query_id for r in out}) == 3 and all(r.query_id.startswith("query_0_") for r in out)
    assert all(0 <= r.processing_time < 600 for r in out)


def test_no_scratch_table_outlives_its_micro_batch(spark, index, tmp_path):
    inbox(spark, f"{tmp_path}/inbox", [("a", "plum", 1)], 1)
    root = Path(scratch(spark, "probe")).parent
    before = set(root.iterdir())
    run(spark, index, tmp_path)
    assert set(root.iterdir()) <= before


def test_intake_is_bounded(spark, index, tmp_path):
    inbox(spark, f"{tmp_path}/inbox", [(f"q{i}", "fig", i) for i in range(12)], 4)
    files = len(list(Path(tmp_path, "inbox").glob("*.json")))
    query = run(spark, index, tmp_path)
    assert files > 1 and len(query.recentProgress) >= files
