"""Exact k-nearest-neighbour search: the index stays where it lies, questions travel."""

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.functions.vectors import as_float32
from wellspring.operators.nearest import RunningTopK
from wellspring.operators.position import row_of, slot_of
from wellspring.workspace import scratch, stage

# Fixed value: hits per question.
TOP_K = 6

# Upper bounds of one tile: its vectors, and the hits that its questions can have.
TILE_BYTES = 32 << 20
TILE_HITS = 200_000

HIT = "question_no long, distance double, id long"


def numbered(questions: DataFrame) -> DataFrame:
    """Questions as a table with ``question_no``, a key of our own: the ids that clients
    send may repeat or be missing."""
    return stage(questions.withColumn("question_no", F.monotonically_increasing_id()), "questions")


def tiles(asked: DataFrame, tile_rows: int) -> Iterator[DataFrame]:
    """A numbered table in runs of at most ``tile_rows`` neighbouring questions. Only the row
    counts of its files reach the driver."""
    slot = slot_of(F.col("question_no")).alias("slot")
    last = F.max(row_of(F.col("question_no")))
    spans = sorted((r.slot, r.rows) for r in asked.groupBy(slot).agg((last + 1).alias("rows")).collect())
    begin, taken = None, 0
    for slot, rows in spans:
        first = slot << 33
        row = 0
        while row < rows:
            begin = first if begin is None else begin
            step = min(rows - row, tile_rows - taken)
            row, taken = row + step, taken + step
            if taken == tile_rows:
                yield asked.where(F.col("question_no").between(begin, first + row - 1))
                begin, taken = (first + row if row < rows else None), 0
    if taken:
        yield asked.where(F.col("question_no") >= begin)


def tile_rows(dim: int, k: int, tile_bytes: int = TILE_BYTES) -> int:
    return max(1, min(tile_bytes // (4 * dim), TILE_HITS // k))


def search_tile(vectors: DataFrame, tile: DataFrame, dim: int, k: int, id_col: str = "row_key") -> DataFrame:
    """``question_no, rank, <id_col>, distance`` for one tile of questions; lazy.

    The tile is broadcast and folded over the whole index by a map-side top-k, so only k rows
    per question and task are shuffled. Vectors of another width than ``dim``, NULL ones, and
    ones that hold a NULL, NaN or infinity are near nothing, on either side.
    """
    return _hits(vectors, _shared(tile, dim), dim, k, id_col)


@contextmanager
def tile_hits(vectors: DataFrame, tile: DataFrame, dim: int, k: int, id_col: str = "row_key"):
    """``search_tile`` for a block that writes the hits: at its end the broadcast tile is removed
    from driver and executors, which so never hold more than one."""
    shared = _shared(tile, dim)
    try:
        yield _hits(vectors, shared, dim, k, id_col)
    finally:
        shared.destroy()


def _hits(vectors: DataFrame, shared, dim: int, k: int, id_col: str) -> DataFrame:
    vector = as_float32(F.col("embedding")).alias("embedding")
    base = vectors.select(F.col(id_col).cast("long").alias("id"), vector).where(F.size("embedding") == dim)
    return _ranked(_over(base, shared, k), k, id_col)


def search(
    vectors: DataFrame,
    questions: DataFrame,
    k: int = TOP_K,
    id_col: str = "row_key",
    tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """``question_no, query_id, rank, <id_col>, distance``: the k rows nearest to each
    question, by (distance, id); fewer if there are fewer rows.

    A question is compared with the rows of its own width. Questions (query_id, embedding)
    without ``question_no`` are numbered first. They are taken tile by tile, and the hits of
    each tile are written before the next is read: the driver never holds more than one, and
    no more than questions x k hits are ever written.
    """
    spark = vectors.sparkSession
    asked = questions if "question_no" in questions.columns else numbered(questions)
    hits = scratch(spark, "hits")
    schema = f"question_no long, rank int, {id_col} long, distance double"
    spark.createDataFrame([], schema).write.parquet(hits)
    widths = asked.where(F.size("embedding") > 0).select(F.size("embedding").alias("w")).distinct().collect()
    for dim in sorted(r.w for r in widths):
        for tile in tiles(asked.where(F.size("embedding") == dim), tile_rows(dim, k, tile_bytes)):
            with tile_hits(vectors, tile, dim, k, id_col) as nearest:
                nearest.write.mode("append").parquet(hits)
    found = spark.read.schema(schema).parquet(hits)
    names = asked.select("question_no", F.col("query_id").cast("string").alias("query_id"))
    return found.join(names, "question_no").select("question_no", "query_id", "rank", id_col, "distance")


def matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of one width as the rows of a matrix."""
    widths = lists.value_lengths()
    if widths.null_count or len(widths.unique()) > 1:
        raise ValueError("vectors of several widths")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def _shared(tile: DataFrame, dim: int):
    """Broadcast keys and vectors of one tile."""
    vector = as_float32(F.col("embedding")).alias("embedding")
    table = tile.select("question_no", vector).where(F.size("embedding") == dim).toArrow()
    keys, vectors = [column.combine_chunks() for column in table.columns]
    return tile.sparkSession.sparkContext.broadcast((keys.to_numpy(), matrix(vectors)))


def _over(scan: DataFrame, tile, k: int) -> DataFrame:
    """Partial hits of a broadcast tile over all partitions of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, vectors = tile.value
        best = RunningTopK(vectors, k)
        for batch in batches:
            if batch.num_rows and len(keys):
                best.fold(batch.column(0).to_numpy(), matrix(batch.column(1)))
        number, ids, distance = best.hits()
        if len(ids):
            columns = [pa.array(keys[number]), pa.array(distance), pa.array(ids)]
            yield pa.RecordBatch.from_arrays(columns, names=["question_no", "distance", "id"])

    return scan.mapInArrow(run, HIT)


def _ranked(partial: DataFrame, k: int, id_col: str) -> DataFrame:
    nearest = Window.partitionBy("question_no").orderBy("distance", "id")
    return (
        partial.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("question_no", "rank", F.col("id").alias(id_col), "distance")
    )
