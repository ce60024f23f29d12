"""Vectors laid out by nearness, so that a search can leave out what is too far away."""

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.functions.vectors import as_float32, finite
from wellspring.sources.articles import ROWS_PER_SLOT, slots_for
from wellspring.workspace import publish, published, read_published, stage

# Upper bounds of what the driver takes: cells of a width, and sampled vectors for each of them.
CELLS = 1024
SAMPLED = 8

ROW = "cell int, gap double, id long, embedding array<float>, width int, slot int"
PIECE = "low double, high double, n long, width int, slot int, cell int"
CENTER = "width int, cell int, center array<double>"


@dataclass(frozen=True)
class Clusters:
    """``rows``: every vector with its cell and the distance (``gap``) to that cell's centre.
    ``pieces``: what a slot holds of a cell, as a ring of gaps from ``low`` to ``high``."""

    rows: DataFrame
    pieces: DataFrame
    centers: DataFrame


def write_clusters(vectors: DataFrame, path: str, id_col: str, cells: int = CELLS, rows_per_slot: int = ROWS_PER_SLOT) -> None:
    """Lay out ``vectors`` (``id_col``, embedding) at ``path`` as a new version.

    Centres come from a bounded sample; they decide how much a search reads, never what it
    finds. All rows are ordered by (cell, gap, id) in one range shuffle and written slot by slot,
    so a cell that holds a third of all rows is split into rings, and a ring of copies by id.
    Rows without an id, and vectors that are NULL, empty or hold anything but finite numbers,
    are left out; each width is laid out for itself. The version is published by its last step.
    """
    spark = vectors.sparkSession
    version = f"versions/{uuid.uuid4().hex}"
    folder = f"{path}/{version}"
    vector = as_float32(F.col("embedding")).alias("embedding")
    sound = vectors.select(F.col(id_col).cast("long").alias("id"), vector)
    sound = stage(sound.where(F.col("id").isNotNull() & (F.size("embedding") > 0) & finite(F.col("embedding"))), "sound")
    counts = sound.groupBy(F.size("embedding").alias("width")).agg(F.count(F.lit(1)).alias("n")).collect()
    centers = {r.width: _centers(sound.where(F.size("embedding") == r.width), r.width, r.n, cells) for r in counts}
    for width, n in sorted(map(tuple, counts)):
        shared = spark.sparkContext.broadcast(centers[width])
        placed = stage(_placed(sound.where(F.size("embedding") == width), shared), "placed")
        shared.destroy()
        slots = slots_for(n, spark.sparkContext.defaultParallelism, rows_per_slot)
        dealt = placed.repartitionByRange(slots, "cell", "gap", "id").withColumn("slot", F.spark_partition_id())
        dealt.sortWithinPartitions("slot", "cell", "gap").write.partitionBy("slot").parquet(f"{folder}/rows/width={width}")
    if not counts:
        spark.createDataFrame([], ROW).write.parquet(f"{folder}/rows")
    rows = spark.read.schema(ROW).parquet(f"{folder}/rows")
    ring = [F.min("gap").alias("low"), F.max("gap").alias("high"), F.count(F.lit(1)).alias("n")]
    pieces = rows.groupBy("width", "slot", "cell").agg(*ring).select("low", "high", "n", "width", "slot", "cell")
    pieces.write.parquet(f"{folder}/pieces")
    found = [(w, i, c.tolist()) for w, table in centers.items() for i, c in enumerate(table)]
    spark.createDataFrame(found, CENTER).write.parquet(f"{folder}/centers")
    publish(spark, f"{path}/manifest", {"version": version})


def load_clusters(spark: SparkSession, path: str) -> Clusters:
    """The version last published at ``path``."""
    numbers = published(spark, f"{path}/manifest")
    if not numbers:
        raise ValueError(f"no clusters at {path}")
    folder = f"{path}/{read_published(spark, f'{path}/manifest', numbers[-1])['version']}"
    parts = {"rows": ROW, "pieces": PIECE, "centers": CENTER}
    return Clusters(**{name: spark.read.schema(schema).parquet(f"{folder}/{name}") for name, schema in parts.items()})


def _centers(vectors: DataFrame, width: int, n: int, cells: int) -> np.ndarray:
    """Centres of a few rounds of k-means over at most ``2 * SAMPLED * cells`` vectors, which a
    hash of their ids chooses."""
    cells = min(cells, max(1, math.isqrt(n)))
    wanted = SAMPLED * cells
    share = min(1 << 30, -(-(wanted << 30) // n))
    chosen = F.pmod(F.xxhash64("id", F.lit("centre")), F.lit(1 << 30)) < share
    sample = vectors.where(chosen).limit(2 * wanted).select("embedding").toArrow()
    if not len(sample):
        sample = vectors.limit(wanted).select("embedding").toArrow()
    flat = sample["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    points = np.unique(flat.reshape(-1, width).astype(np.float64), axis=0)
    centers = points[np.random.default_rng(1).permutation(len(points))[:cells]]
    for _ in range(4):
        cell = nearest_center(points, centers)
        held = np.bincount(cell, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, cell, points)
        centers = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centers)
    return centers[neighbourly(centers)]


def neighbourly(centers: np.ndarray) -> np.ndarray:
    """An order of the centres in which each is followed by the nearest one left. Slots are filled in
    this order, so cells that a search needs together share slots."""
    left = np.ones(len(centers), bool)
    order = [0]
    while len(order) < len(centers):
        left[order[-1]] = False
        away = ((centers - centers[order[-1]]) ** 2).sum(axis=1)
        order.append(int(np.where(left, away, np.inf).argmin()))
    return np.array(order)


def nearest_center(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), np.int64)
    norms = (centers * centers).sum(axis=1)
    for start in range(0, len(rows), 2048):
        part = slice(start, start + 2048)
        out[part] = (norms - 2 * (rows[part] @ centers.T)).argmin(axis=1)
    return out


def _placed(vectors: DataFrame, shared) -> DataFrame:
    def run(batches):
        centers = shared.value
        for batch in batches:
            flat = batch["embedding"].flatten().to_numpy(zero_copy_only=False)
            rows = flat.reshape(batch.num_rows, centers.shape[1]).astype(np.float64)
            cell = nearest_center(rows, centers)
            gap = np.sqrt(((rows - centers[cell]) ** 2).sum(axis=1))
            columns = [pa.array(cell, pa.int32()), pa.array(gap), batch["id"], batch["embedding"]]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "gap", "id", "embedding"])

    return vectors.mapInArrow(run, "cell int, gap double, id long, embedding array<float>")
