"""Dense positions in key order without a single-task sort.

``monotonically_increasing_id`` numbers rows as (partition, row in partition). On a
range-partitioned, sorted table that number already has the wanted order; a table with the
row count of each partition ("slot") turns it into a dense position at read time.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the bits monotonically_increasing_id gives to the row number.
ROW_BITS = 33


def slot_of(row_key: Column) -> Column:
    return F.shiftright(row_key, ROW_BITS).cast("int")


def row_of(row_key: Column) -> Column:
    return row_key.bitwiseAND(F.lit((1 << ROW_BITS) - 1))


def in_order(df: DataFrame, slots: int, order: list[str], content: list[str]) -> DataFrame:
    """Rows with ``row_key`` (ordered as ``order``) and ``slot``.

    The key should be unique. A hash of ``content`` follows it: it splits the rows of a key
    that repeats, as NULL may, over several partitions, and puts them in the same order when
    a lost task is run again.
    """
    return (
        df.withColumn("_content", F.xxhash64(*content))
        .repartitionByRange(slots, *order, "_content")
        .sortWithinPartitions(*order, "_content", *content)
        .drop("_content")
        .withColumn("row_key", F.monotonically_increasing_id())
        .withColumn("slot", slot_of(F.col("row_key")))
    )


def slot_table(rows: DataFrame) -> DataFrame:
    """First position and row count per slot: one small row per range partition, of which
    there are at most MAX_SLOTS, so the unpartitioned running sum over them is safe."""
    before = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy("slot")
        .agg(F.count("*").alias("n_rows"))
        .select(
            "slot",
            F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("first_pos"),
            "n_rows",
        )
    )


def with_position(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """Add ``pos``. The slot table has one row per range partition (at most MAX_SLOTS), so
    it is broadcast whatever the number of rows."""
    firsts = F.broadcast(slots.select("slot", "first_pos"))
    return (
        rows.join(firsts, "slot")
        .withColumn("pos", F.col("first_pos") + row_of(F.col("row_key")))
        .drop("first_pos")
    )
