"""Articles to an index: chunk, embed batch by batch, build."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.backends import DIM
from wellspring.operators.chunk import BATCH_ROWS, CHUNK_WORDS, OVERLAP_WORDS, chunk
from wellspring.operators.encode import encode
from wellspring.schemas import CHUNK, EMBEDDED
from wellspring.sources.index import VectorIndex, load_index, write_index
from wellspring.sources.tables import (
    batch_ledger,
    files_for,
    note_batches,
    read_batches,
    read_ledger,
    read_table_if_any,
    write_batches,
)
from wellspring.workspace import exists

# Batches embedded by one job, and chunks up to which it takes more of them; characters of an
# error that the ledger keeps.
BATCHES_AT_ONCE = 64
CHUNKS_AT_ONCE = 1_000_000
ERROR_CHARS = 2000

ENTRY = "batch_id long, n_chunks long, n_failed long, error string"


def chunk_corpus(
    articles: DataFrame, size: int = CHUNK_WORDS, overlap: int = OVERLAP_WORDS
) -> DataFrame:
    """Chunks of articles that carry a ``batch_id``; a narrow plan."""
    return chunk(articles, size, overlap).select(*CHUNK.fieldNames())


def embed(chunks: DataFrame, factory) -> DataFrame:
    """Chunks with ``embedding`` and its ``width``; a narrow plan."""
    vectors = chunks.withColumn("_made", encode(F.col("chunk_text"), factory))
    vectors = vectors.withColumns({"embedding": F.col("_made.embedding"), "error": F.col("_made.error")})
    return vectors.withColumn("width", F.size("embedding")).select(*EMBEDDED.fieldNames())


def embed_chunks(
    chunks: DataFrame,
    path: str,
    factory,
    batch_ids: list[int | None] | None = None,
    at_once: int | None = None,
) -> DataFrame:
    """Embed the batches not yet done according to the ledger, or those named, newest first.

    ``at_once`` batches are one job, by default as many as ``jobs`` deals out. A job is noted in the
    ledger as soon as it is written, so a run that was cut short goes on with the batches it
    lacks, and reads back its own folders alone. If a job fails, its batches are tried
    one by one: one that fails by itself is noted with its error and does not stop the others;
    it is not done, and neither is one of whose texts all failed. Chunks without a ``batch_id``
    are one batch, the last. ``chunks`` should be a table with a folder per batch. Only batch
    numbers and their counts reach the driver.
    """
    spark = chunks.sparkSession
    sizes = {row["batch_id"]: row["count"] for row in chunks.groupBy("batch_id").count().collect()}
    if batch_ids is None:
        batch_ids = sizes.keys() - {row.batch_id for row in done(ledger(spark, path)).collect()}
    newest_first = sorted(set(batch_ids) & sizes.keys(), key=lambda b: (b is not None, b or 0), reverse=True)
    for group in jobs(newest_first, sizes, at_once):
        if (problem := embed_batches(chunks, path, factory, group)) is None:
            continue
        for batch in group:
            if len(group) > 1:
                problem = embed_batches(chunks, path, factory, [batch])
            if problem is not None:
                note_batches(spark.createDataFrame([(batch, None, None, problem)], ENTRY), f"{path}/ledger")
    return read_table_if_any(spark, f"{path}/rows", EMBEDDED)


def jobs(batch_ids: list[int | None], sizes: dict, at_once: int | None = None) -> list[list[int | None]]:
    """Batches cut into jobs of ``at_once``; by default of ``BATCHES_AT_ONCE``, or of more while they
    have ``CHUNKS_AT_ONCE`` chunks at most, so that small batches do not each cost a share of a job."""
    groups, held = [], 0
    for batch in batch_ids:
        held += sizes[batch]
        if not groups or len(groups[-1]) >= (at_once or BATCHES_AT_ONCE) and (at_once or held > CHUNKS_AT_ONCE):
            groups.append([])
            held = sizes[batch]
        groups[-1].append(batch)
    return groups


def of_batches(batch_ids: list[int | None]) -> Column:
    """Rows of some batches; over a table with a folder per batch, only those folders are read."""
    one = lambda batch: F.col("batch_id").eqNullSafe(F.lit(batch).cast("long"))
    if len(batch_ids) <= BATCHES_AT_ONCE:
        return reduce(lambda a, b: a | b, map(one, batch_ids))
    known = F.col("batch_id").isin([batch for batch in batch_ids if batch is not None])
    return known | one(None) if None in batch_ids else known


def embed_batches(chunks: DataFrame, path: str, factory, batch_ids: list[int | None]) -> str | None:
    """Write the embedded chunks of some batches and note them, as counted in what was written;
    what went wrong, if anything did. Each file of chunks becomes one of embedded chunks, so
    nothing is shuffled."""
    try:
        write_batches(embed(chunks.where(of_batches(batch_ids)), factory), f"{path}/rows", one_batch=True)
        written = read_batches(chunks.sparkSession, f"{path}/rows", EMBEDDED, batch_ids)
        note_batches(batch_ledger(written), f"{path}/ledger")
    except Exception as problem:
        return str(problem)[:ERROR_CHARS] or type(problem).__name__
    return None


def done(entries: DataFrame) -> DataFrame:
    """Ledger entries of batches that need not be embedded again."""
    return entries.where((F.col("n_chunks") > 0) & (F.col("n_failed") < F.col("n_chunks")))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Chunks and failed chunks of each batch embedded under ``path``."""
    return read_ledger(spark, f"{path}/ledger")


def build_index(embedded: DataFrame, path: str, dim: int = DIM, **options) -> VectorIndex:
    write_index(embedded, path, dim, **options)
    return load_index(embedded.sparkSession, path)


def ingest(articles: DataFrame, path: str, factory, dim: int = DIM, batch_rows: int = BATCH_ROWS) -> VectorIndex:
    """Articles with ``batch_id`` to an index over the batches that could be embedded. A run
    that was cut short goes on where it stopped: chunks are cut once, batches embedded once.
    ``batch_rows``, the articles of a batch, says how many files one is worth."""
    spark = articles.sparkSession
    if not exists(spark, f"{path}/chunks/_SUCCESS"):
        write_batches(chunk_corpus(articles), f"{path}/chunks", files=files_for(batch_rows))
    chunks = read_table_if_any(spark, f"{path}/chunks", CHUNK)
    embedded = embed_chunks(chunks, f"{path}/embedded", factory)
    return build_index(embedded, f"{path}/index", dim)
