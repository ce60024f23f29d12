"""Search over clusters: the same rows as brute force, and fewer slots read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.support import brute_force, collected, question_table, small_index, vector_table
from wellspring.operators.pruned import pruned_search
from wellspring.operators.search import search
from wellspring.sources.clusters import load_clusters, neighbourly, write_clusters
from wellspring.workspace import scratch


def clustered(spark, table, id_col="vec_id", **options):
    path = scratch(spark, "test-clusters")
    write_clusters(table, path, id_col, **options)
    return load_clusters(spark, path)


def found(out):
    return collected(out.hits.select(F.col("query_id").cast("int").alias("q"), "rank", "vec_id", "distance"), "q", "rank")


def groups(n, dim, count, seed=5):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(count, dim)) * 20
    return (middles[rng.integers(0, count, n)] + rng.normal(size=(n, dim))).astype(np.float32)


def test_clustered_vectors_read_fewer_slots(spark):
    vectors = groups(4000, 12, 20)
    questions = vectors[:8] + np.float32(0.1)
    table = vector_table(spark, range(4000), vectors)
    out = pruned_search(clustered(spark, table, rows_per_slot=100), question_table(spark, questions), 6, "vec_id")
    assert found(out) == brute_force(range(4000), vectors, questions, 6)
    assert out.slots_held >= 40 and out.slots_read <= out.slots_held // 2


def test_centres_of_a_group_follow_each_other():
    middles = np.random.default_rng(4).normal(size=(9, 12)) * 1000
    group = np.random.default_rng(6).permutation(np.repeat(np.arange(9), 7))
    centers = middles[group] + np.random.default_rng(7).normal(size=(63, 12))
    order = neighbourly(centers)
    assert sorted(order.tolist()) == list(range(63))
    assert np.count_nonzero(np.diff(group[order])) == 8
    assert neighbourly(np.zeros((3, 2))).tolist() == [0, 1, 2] and neighbourly(centers[:1]).tolist() == [0]


@pytest.mark.parametrize("tile_bytes", [7 * 12 * 4, 1 << 20])
def test_tiles_of_neighbouring_questions(spark, tile_bytes):
    vectors = groups(900, 12, 9)
    questions = np.concatenate([vectors[:40], groups(10, 12, 3, 8), np.zeros((1, 12), np.float32)])
    clusters = clustered(spark, vector_table(spark, range(900), vectors), rows_per_slot=30)
    out = pruned_search(clusters, question_table(spark, questions), 4, "vec_id", tile_bytes=tile_bytes)
    assert found(out) == brute_force(range(900), vectors, questions, 4)


def test_no_structure_ties_and_a_third_of_copies(spark):
    rng = np.random.default_rng(3)
    vectors = rng.integers(0, 2, size=(900, 8)).astype(np.float32)
    vectors[::3] = vectors[0]
    questions = np.concatenate([vectors[:6], rng.normal(size=(4, 8)).astype(np.float32)])
    clusters = clustered(spark, vector_table(spark, range(900), vectors), rows_per_slot=50)
    assert clusters.pieces.agg(F.max("n")).first()[0] < 300
    out = pruned_search(clusters, question_table(spark, questions), 6, "vec_id")
    assert found(out) == brute_force(range(900), vectors, questions, 6)


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e12, 1e18])
def test_far_from_the_origin_and_any_scale(spark, scale):
    vectors = ((groups(300, 6, 5) + 1000) * scale).astype(np.float32)
    table = vector_table(spark, range(300), vectors)
    asked = question_table(spark, vectors[:20])
    out = pruned_search(clustered(spark, table, rows_per_slot=20), asked, 5, "vec_id")
    assert found(out) == collected(search(table, asked, 5, "vec_id").select(F.col("query_id").cast("int").alias("q"), "rank", "vec_id", "distance"), "q", "rank")


def test_widths_null_not_finite_few_rows_and_none(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [4.0]), (3, [5.0, 6.0]), (4, None), (5, [1.0, float("nan")]), (6, [0.0, None])]
    rows += [(7, []), (8, [float("inf"), 0.0]), (9, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = table.select(F.col("vec_id").cast("string").alias("query_id"), "embedding", F.lit("x").alias("cell"))
    out = pruned_search(clustered(spark, table), asked, 2, "vec_id")
    assert found(out) == [(1, 1, 1, 0.0), (2, 1, 2, 0.0), (3, 1, 3, 0.0), (3, 2, 9, 41.0), (9, 1, 9, 0.0), (9, 2, 3, 41.0)]
    nothing = clustered(spark, table.where("vec_id < 0"))
    assert pruned_search(nothing, asked, 2).hits.collect() == []
    assert pruned_search(clustered(spark, table), asked.where("query_id = 'y'"), 2).hits.collect() == []
    with pytest.raises(ValueError):
        load_clusters(spark, scratch(spark, "none"))


def test_rows_of_an_index(spark):
    vectors = groups(60, 4, 3)
    index = small_index(spark, [(i, 0, f"t{i}", v.tolist()) for i, v in enumerate(vectors)], 4)
    asked = question_table(spark, vectors[:5])
    out = pruned_search(clustered(spark, index.rows, "row_key", rows_per_slot=10), asked, 3, "row_key").hits
    want = search(index.rows, asked, 3, "row_key")
    assert collected(out.drop("question_no"), "query_id", "rank") == collected(want.drop("question_no"), "query_id", "rank")
