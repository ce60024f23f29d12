"""Articles to overlapping word chunks."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.functions.text import overlapping_windows, words

# Chunk geometry in words, articles per batch.
CHUNK_WORDS = 512
OVERLAP_WORDS = 64
BATCH_ROWS = 100_000


def row_range_batch(row_index: Column, batch_rows: int = BATCH_ROWS) -> Column:
    """Batch i holds rows [i * batch_rows, (i + 1) * batch_rows)."""
    return F.call_function("div", row_index.cast("long"), F.lit(batch_rows)).cast("long")


def chunk(articles: DataFrame, size: int = CHUNK_WORDS, overlap: int = OVERLAP_WORDS) -> DataFrame:
    """Replace ``text`` by one row per chunk; other columns are repeated.

    Windows are built as one array per article and then exploded, so the words of a long
    article are not copied into each of its chunk rows. The outer explode keeps the optimizer
    from adding a not-empty filter below it, which would split the text again per window.
    """
    if not 0 <= overlap < size:
        raise ValueError(f"need 0 <= overlap < size, got overlap={overlap}, size={size}")
    carried = [c for c in articles.columns if c != "text"]
    return (
        articles.withColumn("_words", words(F.col("text")))
        .select(*carried, overlapping_windows(F.col("_words"), size, overlap).alias("_chunks"))
        .select(*carried, F.posexplode_outer("_chunks").alias("chunk_no", "chunk_text"))
        .where(F.col("chunk_no").isNotNull())
        .withColumn("chunk_id", F.concat_ws(":", "doc_id", "chunk_no"))
    )
