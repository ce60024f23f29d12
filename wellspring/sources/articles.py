"""Articles: scan, peek by position, row-range batches."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.operators.chunk import BATCH_ROWS, row_range_batch
from wellspring.operators.position import in_order, slot_table, with_position
from wellspring.workspace import spread, stage

# Rows per sorted slot; beyond MAX_SLOTS slots grow instead, so that the slot table stays a
# few megabytes and may be broadcast.
ROWS_PER_SLOT = 100_000
MAX_SLOTS = 100_000


def articles(
    spark: SparkSession, path: str, key: str = "doc_id", title: str = "title", text: str = "text"
) -> DataFrame:
    """``doc_id, title, text`` of a Parquet table; other columns are never read."""
    scan = spark.read.parquet(path)
    return scan.select(F.col(key).alias("doc_id"), F.col(title).alias("title"), F.col(text).alias("text"))


def slots_for(rows: int, cores: int, rows_per_slot: int = ROWS_PER_SLOT) -> int:
    """Range partitions for a table of ``rows``: bounded slots, but enough for the cores."""
    return min(MAX_SLOTS, max(1, -(-rows // rows_per_slot), min(cores, -(-rows // 1000))))


def key_positions(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every key with its position in key order. Keys alone are sorted; no other column moves."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    keys = rows.select(key)
    ordered = stage(in_order(keys, slots_for(keys.count(), cores), [key], [key]), "keys")
    return with_position(ordered, slot_table(ordered)).select(key, "pos")


def peek(rows: DataFrame, position: int, key: str = "doc_id") -> DataFrame:
    """The row at a position in key order. Of rows that share its key, any one."""
    found = key_positions(rows, key).where(F.col("pos") == position).select(key).first()
    if found is None:
        return rows.limit(0)
    return rows.where(F.col(key).eqNullSafe(F.lit(found[0]))).limit(1)


def batches(rows: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Add ``batch_id``, the row number in key order divided by ``batch_rows``.

    Keys (numbers) are sorted by themselves and give each batch's first key, one number for
    ``batch_rows`` articles; articles then find their batch in a narrow pass and are never
    shuffled. Articles that share a key stay in one batch, and those without one are the first.
    """
    number = row_range_batch(F.col("pos"), batch_rows)
    firsts = key_positions(rows).where("doc_id IS NOT NULL").groupBy(number.alias("b")).agg(F.min("doc_id").alias("k"))
    bounds = sorted((r.k, r.b) for r in firsts.collect())
    keys, ids = np.array([k for k, _ in bounds]), np.array([b for _, b in bounds], np.int64)

    @F.arrow_udf(returnType="bigint")
    def batch_of(column: pa.Array) -> pa.Array:
        at = np.searchsorted(keys, column.drop_null().to_numpy(), side="right") - 1
        out = np.zeros(len(column), np.int64)
        out[column.is_valid().to_numpy(zero_copy_only=False)] = ids[at]
        return pa.array(out)

    return rows.withColumn("batch_id", batch_of("doc_id"))


def article_scan(spark: SparkSession, path: str, **columns: str) -> DataFrame:
    """Articles spread over the cores, for the jobs that do work per row."""
    return spread(articles(spark, path, **columns), "doc_id")
