"""The vector index: vectors and texts in one Parquet table, and its slot table."""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.functions.vectors import as_float32, finite
from wellspring.operators.position import in_order, slot_table, with_position
from wellspring.operators.validate import indexable, verdict
from wellspring.schemas import INDEX_ROW, SLOT
from wellspring.sources.articles import ROWS_PER_SLOT, slots_for
from wellspring.workspace import delete, publish, published, read_published, withdraw


@dataclass(frozen=True)
class VectorIndex:
    rows: DataFrame
    slots: DataFrame
    dim: int

    def positioned(self) -> DataFrame:
        """All rows with their dense position 0..n-1 in (doc_id, chunk_no) order."""
        return with_position(self.rows, self.slots).drop("row_key", "slot")

    def size(self) -> DataFrame:
        return self.slots.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("ntotal"))


def write_index(embedded: DataFrame, path: str, dim: int, rows_per_slot: int = ROWS_PER_SLOT) -> None:
    """Write the index, and beside it the rows of another width than ``dim`` and those whose
    vector holds anything but finite numbers.

    ``embedded`` must be a table: its keys are sampled for the range bounds before the
    rows are moved. One shuffle, one write; positions need no second pass over the rows.

    A build goes to a folder of its own under ``versions``. The last step names it in the
    manifest, by moving a small file to the next number there, so a reader sees the old index or
    the new one whole, and a build that is cut short leaves the old one. Readers keep the
    version they loaded; ``drop_versions`` deletes those that are no longer wanted.
    """
    spark = embedded.sparkSession
    version = f"versions/{uuid.uuid4().hex}"
    width, text = F.col("width"), F.col("chunk_text")
    slots = slots_for(embedded.count(), spark.sparkContext.defaultParallelism, rows_per_slot)
    judged = verdict(width, text, dim, F.col("embedding"))
    kept = embedded.where(indexable(width, text, dim) & finite(F.col("embedding"))).select(
        "doc_id", "chunk_no", "chunk_id", "title", text, as_float32(F.col("embedding")).alias("embedding")
    )
    ordered = in_order(kept, slots, ["doc_id", "chunk_no"], ["chunk_id", "chunk_text"])
    ordered.write.partitionBy("slot").parquet(f"{path}/{version}/rows")
    written = spark.read.schema(INDEX_ROW).parquet(f"{path}/{version}/rows")
    slot_table(written).write.parquet(f"{path}/{version}/slots")
    rejects = embedded.select("doc_id", "chunk_no", "chunk_id", "width", judged.alias("verdict"))
    rejects.where(F.col("verdict").isin("width", "value")).write.mode("overwrite").parquet(f"{path}/rejects")
    publish(spark, f"{path}/manifest", {"version": version, "dim": dim})


def versions(spark: SparkSession, path: str) -> list[dict]:
    """Published versions of an index, oldest first, with their ``number``."""
    found = []
    for number in published(spark, f"{path}/manifest"):
        found.append(read_published(spark, f"{path}/manifest", number) | {"number": number})
    return found


def load_index(spark: SparkSession, path: str, number: int | None = None) -> VectorIndex:
    """The index at ``path`` as last published, or its version of a given number."""
    numbers = published(spark, f"{path}/manifest")
    if not numbers or number is not None and number not in numbers:
        raise ValueError(f"no index version {'' if number is None else number} at {path}")
    entry = read_published(spark, f"{path}/manifest", numbers[-1] if number is None else number)
    folder = f"{path}/{entry['version']}"
    return VectorIndex(
        rows=spark.read.schema(INDEX_ROW).parquet(f"{folder}/rows"),
        slots=spark.read.schema(SLOT).parquet(f"{folder}/slots"),
        dim=entry["dim"],
    )


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the folders of all published versions but the last ``keep``, and their manifest
    entries first; how many were dropped. Folders of unfinished builds stay, as one may be
    under way."""
    old = versions(spark, path)[: -keep if keep else None]
    for entry in old:
        withdraw(spark, f"{path}/manifest", entry["number"])
        delete(spark, f"{path}/{entry['version']}")
    return len(old)
