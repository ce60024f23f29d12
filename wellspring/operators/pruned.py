"""Exact k-nearest-neighbour search over clusters, which reads only slots that may hold a hit.

By the triangle inequality a row whose distance to its cell's centre is ``gap`` lies no nearer to a
question than the difference of ``gap`` and the question's own distance to that centre, and no
farther than their sum. The sums bound each question's k-th distance before any row is read.
The slots that set the bound are read first, and of the others only those whose rings of gaps
reach below the k-th distance then known.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.functions.vectors import as_float32, finite
from wellspring.operators.nearest import GRID, RunningTopK
from wellspring.operators.search import HIT, TILE_BYTES, TOP_K, _ranked, matrix, numbered, tile_rows, tiles
from wellspring.sources.clusters import Clusters
from wellspring.workspace import scratch, stage

# Question and piece pairs that are looked at together.
PAIRS = 1 << 20
# Covers the rounding of distances, sums and differences.
SLACK = 1e-9


@dataclass(frozen=True)
class PrunedHits:
    """``hits`` as ``search`` returns them; of ``slots_held`` slots, counted once for each tile,
    ``slots_read`` were read."""

    hits: DataFrame
    slots_read: int
    slots_held: int


class Rings:
    """Centres and pieces of one width, with bounds on the distances of their rows."""

    def __init__(self, centers: np.ndarray, slot, cell, low, high, n):
        self.centers, self.norms = centers, np.sqrt((centers * centers).sum(axis=1))
        self.slot, self.cell, self.low, self.high, self.n = slot, cell, low, high, n

    def to_centers(self, questions: np.ndarray):
        """Least and largest distance of each question to each centre."""
        norms = np.sqrt((questions * questions).sum(axis=1))
        square = (norms**2)[:, None] + self.norms**2 - 2 * (questions @ self.centers.T)
        error = (questions.shape[1] + 8) * 2 * np.finfo(np.float64).eps * (norms[:, None] + self.norms) ** 2
        return np.sqrt(np.maximum(0, square - error)), np.sqrt(np.maximum(0, square) + error)

    def least(self, near, far) -> np.ndarray:
        """Lower bound of the distance of each question to the rows of each piece."""
        return least(near[:, self.cell], far[:, self.cell], self.low, self.high)

    def blocks(self, count: int):
        step = max(1, PAIRS // max(1, len(self.slot), len(self.centers)))
        return [slice(start, start + step) for start in range(0, count, step)]


def least(near, far, low, high):
    return np.maximum(0, np.maximum(near - high * (1 + SLACK), low * (1 - SLACK) - far)) * (1 - SLACK)


def reaches(bound, limit) -> np.ndarray:
    """Whether a squared distance of at most ``limit``, settled, is open to rows beyond ``bound``."""
    return bound**2 <= limit + 2 / GRID + limit * SLACK


def pruned_search(
    clusters: Clusters, questions: DataFrame, k: int = TOP_K, id_col: str = "id", tile_bytes: int = TILE_BYTES
) -> PrunedHits:
    """The rows of ``search``, with the same ties, read from the slots that may hold one.

    Questions (query_id, embedding) are put in the order of their nearest centres before they
    are taken tile by tile, so those of a tile need much the same slots. A slot is read at most
    once for a tile, and within it a question is compared only with runs of rows that its bound
    reaches. Only slot numbers, at most 100,000, reach the driver.
    """
    spark = clusters.rows.sparkSession
    context = spark.sparkContext
    asked = questions if "question_no" in questions.columns else numbered(questions)
    vector = as_float32(F.col("embedding")).alias("embedding")
    sound = asked.select(F.col("question_no").alias("asked_no"), vector).where(finite(F.col("embedding")))
    path = scratch(spark, "pruned")
    schema = f"question_no long, rank int, {id_col} long, distance double"
    spark.createDataFrame([], schema).write.parquet(path)
    read = held = 0
    for width in sorted(r.width for r in clusters.centers.select("width").distinct().collect()):
        rings = _rings(clusters, width)
        shared = context.broadcast(rings)
        routed = _routed(sound.where(F.size("embedding") == width), shared, k)
        routed = numbered(routed.repartitionByRange(context.defaultParallelism, "cell", "asked_no"))
        rows = clusters.rows.where(F.col("width") == width)
        for tile in tiles(routed, tile_rows(width, k, tile_bytes)):
            homes = {r.slot for r in tile.select(F.explode("homes").alias("slot")).distinct().collect()}
            hits = stage(_ranked(_fold(rows, tile, homes, shared, k), k, "id"), "pruned-first")
            known = hits.groupBy("question_no").agg(F.max("distance").alias("kth"), F.count(F.lit(1)).alias("n"))
            tile = tile.join(known.where(F.col("n") == k).select("question_no", "kth"), "question_no", "left")
            tile = stage(tile.withColumn("cap", F.least("cap", "kth")).select(*routed.columns), "pruned-tile")
            open_ = {r.slot for r in _open(tile, shared).distinct().collect()} - homes
            if open_:
                more = _fold(rows, tile, open_, shared, k)
                hits = _ranked(hits.select("question_no", "distance", "id").unionByName(more), k, "id")
            names = tile.select("question_no", "asked_no")
            hits = hits.join(names, "question_no").select(F.col("asked_no").alias("question_no"), "rank", F.col("id").alias(id_col), "distance")
            hits.write.mode("append").parquet(path)
            read, held = read + len(homes) + len(open_), held + len(np.unique(rings.slot))
        shared.destroy()
    names = asked.select("question_no", F.col("query_id").cast("string").alias("query_id"))
    found = spark.read.schema(schema).parquet(path).join(names, "question_no")
    return PrunedHits(found.select("question_no", "query_id", "rank", id_col, "distance"), read, held)


def _rings(clusters: Clusters, width: int) -> Rings:
    centers = clusters.centers.where(F.col("width") == width).orderBy("cell").select("center").toArrow()
    pieces = clusters.pieces.where(F.col("width") == width).orderBy("slot", "cell").toArrow()
    columns = [pieces[name].to_numpy() for name in ("slot", "cell", "low", "high", "n")]
    return Rings(matrix(centers["center"].combine_chunks()), *columns)


def _routed(asked: DataFrame, shared, k: int) -> DataFrame:
    """Questions with their nearest cell, a bound on their k-th squared distance (infinite if
    there are fewer rows) and the slots whose rows prove it."""

    def run(batches):
        rings = shared.value
        take = min(k, len(rings.slot))
        for batch in batches:
            questions = matrix(batch["embedding"]).astype(np.float64)
            cell, cap, homes = [], [], []
            for part in rings.blocks(len(questions)):
                near, far = rings.to_centers(questions[part])
                reach = (far[:, rings.cell] + rings.high) * (1 + SLACK)
                first = np.argpartition(reach, take - 1, axis=1)[:, :take]
                first = np.take_along_axis(first, np.take_along_axis(reach, first, 1).argsort(axis=1), 1)
                rows = rings.n[first].cumsum(axis=1)
                enough = np.minimum((rows < k).sum(axis=1), take - 1)
                edge = np.take_along_axis(reach, np.take_along_axis(first, enough[:, None], 1), 1)[:, 0]
                cap.extend(np.where(rows[:, -1] >= k, edge**2 + 1 / GRID, np.inf))
                cell.extend(near.argmin(axis=1))
                homes.extend(np.unique(rings.slot[f[: e + 1]]) for f, e in zip(first, enough))
            columns = [batch["asked_no"], batch["embedding"], pa.array(cell, pa.int32()), pa.array(cap, pa.float64())]
            columns.append(pa.array(homes, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=["asked_no", "embedding", "cell", "cap", "homes"])

    return asked.mapInArrow(run, "asked_no long, embedding array<float>, cell int, cap double, homes array<int>")


def _open(tile: DataFrame, shared) -> DataFrame:
    """Slots that may hold a hit of any question of the tile."""

    def run(batches):
        rings = shared.value
        for batch in batches:
            questions, cap = matrix(batch["embedding"]).astype(np.float64), batch["cap"].to_numpy()
            wanted = np.zeros(len(rings.slot), bool)
            for part in rings.blocks(len(questions)):
                wanted |= reaches(rings.least(*rings.to_centers(questions[part])), cap[part, None]).any(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(rings.slot[wanted]), pa.int32())], names=["slot"])

    return tile.select("embedding", "cap").mapInArrow(run, "slot int")


def _fold(rows: DataFrame, tile: DataFrame, slots: set[int], shared, k: int) -> DataFrame:
    """Partial hits of a tile in the given slots; the broadcast tile has a bounded size."""
    table = tile.select("question_no", "embedding", "cap").toArrow()
    keys, vectors, cap = [column.combine_chunks() for column in table.columns]
    sent = rows.sparkSession.sparkContext.broadcast((keys.to_numpy(), matrix(vectors), cap.to_numpy()))

    def run(batches):
        keys, questions, cap = sent.value
        best, rings = RunningTopK(questions, k), shared.value
        near, far = (np.empty((len(keys), 0)),) * 2
        at = -1
        for batch in batches:
            cells, gaps = batch["cell"].to_numpy(), batch["gap"].to_numpy()
            ids, vectors = batch["id"].to_numpy(), matrix(batch["embedding"])
            for cell in np.unique(cells):
                if cell != at:
                    one = Rings(rings.centers[cell : cell + 1], None, None, None, None, None)
                    (near, far), at = one.to_centers(questions.astype(np.float64)), cell
                run_ = np.flatnonzero(cells == cell)
                bound = least(near[:, 0], far[:, 0], gaps[run_].min(), gaps[run_].max())
                only = np.flatnonzero(reaches(bound, np.minimum(cap, best.distance[:, -1])))
                if len(only):
                    best.fold_for(only, ids[run_], vectors[run_])
        number, ids, distance = best.hits()
        if len(ids):
            columns = [pa.array(keys[number]), pa.array(distance), pa.array(ids)]
            yield pa.RecordBatch.from_arrays(columns, names=["question_no", "distance", "id"])

    wanted = rows.where(F.col("slot").isin(sorted(slots))).select("cell", "gap", "id", "embedding")
    found = stage(wanted.mapInArrow(run, HIT), "pruned-hits")
    sent.destroy()
    return found
