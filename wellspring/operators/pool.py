"""Mean pooling as a table operator."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_pool(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Element-wise mean of the vectors of each key, over the vectors that have the element.

    Sums and counts are taken batch by batch before anything is taken apart, so a heavy key
    sends one row per element and task.
    """
    kind = df.schema[key].dataType.simpleString()
    vectors = df.select(key, vector).where(F.col(vector).isNotNull())
    sums = vectors.mapInArrow(_sums, f"`{key}` {kind}, total array<double>, n array<bigint>")
    cells = sums.select(key, F.posexplode(F.arrays_zip("total", "n")).alias("element", "of"))
    means = cells.groupBy(key, "element").agg(F.try_divide(F.sum("of.total"), F.sum("of.n")).alias("mean"))
    listed = means.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("element", "mean"))).alias("_cells"))
    return listed.select(key, F.col("_cells.mean").alias(vector))


def _sums(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column(0).dictionary_encode(null_encoding="encode")
        lists = batch.column(1)
        sizes = lists.value_lengths().to_numpy()
        width = int(sizes.max(initial=0))
        group = np.repeat(codes.indices.to_numpy(), sizes)
        element = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        cell, known = group * width + element, lists.flatten().is_valid().to_numpy(zero_copy_only=False)
        shape = (len(codes.dictionary), width)
        total = np.bincount(cell[known], values[known], shape[0] * width).reshape(shape)
        count = np.bincount(cell[known], minlength=shape[0] * width).reshape(shape)
        widths = np.zeros(shape[0], np.int64)
        np.maximum.at(widths, codes.indices.to_numpy(), sizes)
        lists = [pa.array([row[:w] for row, w in zip(table, widths)]) for table in (total, count)]
        names = [batch.schema.names[0], "total", "n"]
        yield pa.RecordBatch.from_arrays([codes.dictionary, *lists], names=names)
