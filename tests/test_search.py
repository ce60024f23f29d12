import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.support import brute_force, collected, question_table, vector_table
from wellspring.functions.vectors import as_float32, settle, squared_l2
from wellspring.operators import nearest
from wellspring.operators.nearest import RunningTopK, below, first_copies, kth_largest, marked
from wellspring.operators.search import matrix, numbered, search, search_tile, tiles


def found(df):
    rows = df.select(F.col("query_id").cast("int").alias("q"), "rank", "vec_id", "distance")
    return collected(rows, "q", "rank")


def sample(n, dim, seed=7):
    return np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_equals_brute_force_for_any_partitioning(spark, parts):
    vectors, questions = sample(300, 24), sample(11, 24, 8)
    ids = np.random.default_rng(1).permutation(300) * 5
    table = vector_table(spark, ids, vectors).repartition(parts)
    out = search(table, question_table(spark, questions), 6, "vec_id")
    assert found(out) == brute_force(ids, vectors, questions, 6)


def test_tied_distances_take_the_lower_id(spark):
    vectors = np.random.default_rng(3).integers(0, 2, size=(200, 6)).astype(np.float32)
    questions = vectors[:15]
    table = vector_table(spark, range(200), vectors).repartition(5)
    out = search(table, question_table(spark, questions), 6, "vec_id")
    assert found(out) == brute_force(range(200), vectors, questions, 6)


def test_a_third_of_all_rows_being_copies(spark):
    vectors = sample(900, 16)
    vectors[::3] = vectors[0]
    questions = np.concatenate([vectors[:4], sample(3, 16, 9)])
    table = vector_table(spark, range(900), vectors).repartition(3)
    out = search(table, question_table(spark, questions), 6, "vec_id")
    assert found(out) == brute_force(range(900), vectors, questions, 6)


def test_fewer_rows_than_k_and_no_rows(spark):
    vectors, questions = sample(3, 8), sample(2, 8, 5)
    asked = question_table(spark, questions)
    table = vector_table(spark, range(3), vectors)
    assert found(search(table, asked, 6, "vec_id")) == brute_force(range(3), vectors, questions, 6)
    assert search(table.where("vec_id < 0"), asked, 6, "vec_id").collect() == []
    assert search(table, asked.where("query_id = 'x'"), 6, "vec_id").collect() == []


def test_questions_without_a_vector_are_left_out(spark):
    table = vector_table(spark, range(3), sample(3, 2))
    asked = spark.createDataFrame(
        [("a", [0.0, 0.0]), ("b", []), ("c", None)], "query_id string, embedding array<float>"
    )
    assert {r.query_id for r in search(table, asked, 2, "vec_id").collect()} == {"a"}


def test_many_tiles_give_the_same_hits(spark):
    vectors, questions = sample(120, 12), sample(50, 12, 4)
    table = vector_table(spark, range(120), vectors).repartition(3)
    asked = question_table(spark, questions)
    tiled = search(table, asked, 4, "vec_id", tile_bytes=7 * 12 * 4)
    assert found(tiled) == brute_force(range(120), vectors, questions, 4)


@pytest.mark.parametrize("tile", [1, 5, 7, 400])
def test_tiles_hold_every_question_once(spark, tile):
    asked = numbered(question_table(spark, sample(90, 6, 4)).repartition(7))
    runs = [[r.query_id for r in t.collect()] for t in tiles(asked, tile)]
    assert sorted(q for run in runs for q in run) == sorted(map(str, range(90)))
    assert all(len(run) == tile for run in runs[:-1]) and 0 < len(runs[-1]) <= tile
    few = asked.where("cast(query_id as int) % 9 = 2")
    assert sum(t.count() for t in tiles(few, tile)) == 10 and list(tiles(asked.where("false"), tile)) == []


def test_widths_null_and_not_finite(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [4.0]), (3, [5.0, 6.0]), (4, None), (5, [1.0, float("nan")]), (6, [0.0, None])]
    rows += [(7, []), (8, [float("inf"), 0.0]), (9, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    asked = table.select(F.col("vec_id").cast("string").alias("query_id"), "embedding")
    out = collected(search(table, asked, 2, "vec_id").select("query_id", "rank", "vec_id", "distance"), "query_id", "rank")
    assert out == [("1", 1, 1, 0.0), ("2", 1, 2, 0.0), ("3", 1, 3, 0.0), ("3", 2, 9, 41.0), ("9", 1, 9, 0.0), ("9", 2, 3, 41.0)]


def test_vectors_of_several_widths_are_no_matrix():
    with pytest.raises(ValueError, match="widths"):
        matrix(pa.array([[1.0, 2.0, 3.0], [4.0], [5.0, 6.0]]))
    with pytest.raises(ValueError, match="widths"):
        matrix(pa.array([[1.0, 2.0, 3.0, 4.0], None]))


def test_distances_beyond_single_precision(spark):
    vectors = np.array([[1e19, 0], [-1e19, 1e19], [3e19, 3e19], [1e38, -1e38]], dtype=np.float32)
    out = search(vector_table(spark, range(4), vectors), question_table(spark, vectors), 2, "vec_id")
    best = {q: i for q, rank, i, _ in found(out) if rank == 1}
    assert best == {0: 0, 1: 1, 2: 2, 3: 3}
    assert out.count() == 8


def test_equal_and_missing_question_ids(spark):
    vectors = sample(20, 3)
    asked = spark.createDataFrame(
        [("a", vectors[4].tolist()), ("a", vectors[9].tolist()), (None, vectors[2].tolist())], "query_id string, embedding array<float>"
    )
    out = search(vector_table(spark, range(20), vectors), asked, 3, "vec_id").collect()
    assert sorted((r.query_id or "", r.vec_id) for r in out if r["rank"] == 1) == [("", 2), ("a", 4), ("a", 9)]
    assert len(out) == 9 and len({r.question_no for r in out}) == 3


def test_many_questions_and_no_rows(spark):
    table = vector_table(spark, range(2), sample(2, 3)).where("vec_id < 0")
    assert search(table, question_table(spark, sample(9, 3)), 2, "vec_id", tile_bytes=24).collect() == []


def test_plan_ranks_once_and_reads_no_text(spark, tmp_path):
    vector_table(spark, range(10), sample(10, 4)).withColumn("t", F.lit("long text")).write.parquet(
        f"{tmp_path}/v"
    )
    asked = numbered(question_table(spark, sample(2, 4)))
    out = search_tile(spark.read.parquet(f"{tmp_path}/v"), asked, 4, 3, "vec_id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in plan
    assert plan.count("Exchange") == 1 and "CartesianProduct" not in plan
    assert "NestedLoop" not in plan and plan.count("WindowGroupLimit") == 2


@settings(max_examples=60, deadline=None)
@given(
    n=st.integers(1, 60),
    dim=st.integers(1, 9),
    k=st.integers(1, 8),
    cut=st.integers(1, 17),
    scale=st.sampled_from([1e-3, 1.0, 1e4]),
    whole=st.booleans(),
    seed=st.integers(0, 10**6),
)
def test_running_top_k_in_any_blocks(n, dim, k, cut, scale, whole, seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-2, 3, (n, dim)) if whole else rng.normal(size=(n, dim)) * scale
    rows = rows.astype(np.float32)
    questions = np.concatenate([rows[:2], rng.normal(size=(3, dim)).astype(np.float32)])
    ids = rng.permutation(n).astype(np.int64)
    best = RunningTopK(questions, k)
    for start in range(0, n, cut):
        best.fold(ids[start : start + cut], rows[start : start + cut])
    number, hit, distance = best.hits()
    out = list(zip(number.tolist(), hit.tolist(), distance.tolist()))
    assert out == [(q, i, d) for q, _, i, d in brute_force(ids, rows, questions, k)]


def test_rows_coming_ever_nearer_and_small_blocks(monkeypatch):
    monkeypatch.setattr(nearest, "ROW_BLOCK", 32)
    monkeypatch.setattr(nearest, "QUESTION_BLOCK", 2)
    rows = (np.arange(500, 0, -1)[:, None] * np.ones((1, 5))).astype(np.float32)
    questions = np.zeros((5, 5), dtype=np.float32)
    best = RunningTopK(questions, 6)
    best.fold(np.arange(500), rows)
    out = list(zip(*[part.tolist() for part in best.hits()]))
    assert out == [(q, i, d) for q, _, i, d in brute_force(np.arange(500), rows, questions, 6)]


def test_a_crowd_of_near_copies():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(3000, 12)).astype(np.float32)
    rows[::3] = rows[0] + rng.normal(size=(1000, 12)).astype(np.float32) * 1e-6
    rows[1::6] = rows[3]
    questions = rows[[0, 3, 9, 2]] + np.float32(1e-3)
    best = RunningTopK(questions, 6)
    for start in range(0, 3000, 700):
        best.fold(np.arange(start, min(start + 700, 3000)), rows[start : start + 700])
    out = list(zip(*[part.tolist() for part in best.hits()]))
    assert out == [(q, i, d) for q, _, i, d in brute_force(np.arange(3000), rows, questions, 6)]


def test_rows_with_nan_hide_no_others():
    rows = np.array([[1, 1], [np.nan, 0], [0, 0], [np.inf, 0]], dtype=np.float32)
    best = RunningTopK(np.zeros((1, 2), dtype=np.float32), 3)
    best.fold(np.arange(4), rows)
    assert [part.tolist() for part in best.hits()] == [[0, 0], [2, 0], [0.0, 2.0]]


def test_first_copies_keeps_the_lowest_ids():
    rows = np.array([[1, 2], [3, 4], [1, 2], [1, 2], [3, 4]], dtype=np.float32)
    kept = first_copies(np.array([9, 5, 1, 4, 6]), rows, 2)
    assert kept.tolist() == [1, 2, 3, 4]


def test_a_block_is_passed_without_a_copy_of_its_products():
    rows, questions = sample(nearest.ROW_BLOCK, 16), sample(nearest.QUESTION_BLOCK, 16, 8)
    best = RunningTopK(questions, 6)
    tracemalloc.start()
    best.fold(np.arange(len(rows)), rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    products = 4 * len(rows) * len(questions)
    assert peak < 1.9 * products
    gaps = rows[None].astype(np.float64) - questions[:20, None]
    assert (best.ids[:20] == (gaps**2).sum(axis=2).argsort(axis=1)[:, :6]).all()


@pytest.mark.parametrize("shape, share", [((7, 13), 0.3), ((64, 64), 0.01), ((3, 5), 1.0), ((4, 16), 0.0), ((1, 3), 0.5)])
def test_marked_finds_what_nonzero_finds(shape, share):
    near = np.random.default_rng(5).random(shape) < share
    for mine, theirs in zip(marked(near), np.nonzero(near)):
        assert (mine == theirs).all()


@pytest.mark.parametrize("width, k", [(10, 6), (257, 1), (4096, 6), (4099, 128), (4099, 129)])
def test_the_kth_largest_is_never_overstated(width, k):
    rough = sample(9, width)
    rough[3] = np.sort(rough[3])
    rough[4] = 1.0
    exact = np.sort(rough, axis=1)[:, -k]
    bound = kth_largest(rough, k)
    assert (bound <= exact).all() and ((rough >= bound[:, None]).sum(axis=1) >= k).all()


def test_a_floor_in_single_precision_is_never_raised():
    floor = np.concatenate([np.random.default_rng(2).normal(size=1000), [-np.inf, -1e300, 0.0, 1e-60]])
    for kind in (np.float32, np.float64):
        assert (below(floor, kind).astype(np.float64) <= floor).all() and below(floor, kind).dtype == kind


def test_distance_functions(spark):
    df = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "a array<double>, b array<double>")
    row = df.select(
        squared_l2(as_float32(F.col("a")), as_float32(F.col("b"))).alias("d"),
        settle(F.lit(0.1234567895)).alias("s"),
        settle(F.lit(3 / 2**31)).alias("half"),
    ).first()
    assert row.d == 25.0 and row.s == 0.12345679 and row.half == 1e-9
    large = spark.createDataFrame([(1e10,), (4e10,), (1e76,), (123456789.123456789,)], "d double")
    assert [r[0] for r in large.select(settle(F.col("d"))).collect()] == pytest.approx([1e10, 4e10, 1e76, 123456789.12345679], rel=1e-15)
