"""Chunk, embedded-chunk and answer tables: how they are written and read back."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.functions.records import answer_log, answer_summary, response
from wellspring.schemas import ANSWER_LOG, ANSWER_SUMMARY, CHUNK, EMBEDDED, LEDGER, RESPONSE
from wellspring.workspace import exists

# Quotes are doubled and line breaks kept, so contexts survive a round trip.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "quoteAll": True,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
    "lineSep": "\n",
}


# Files that a batch is dealt over when it is written, at most, and articles that make up one.
FILES_PER_BATCH = 8
ARTICLES_PER_FILE = 12_500


def files_for(batch_rows: int) -> int:
    """Files for a batch of ``batch_rows`` articles, so that small batches are no heap of tiny files."""
    return min(FILES_PER_BATCH, max(1, -(-batch_rows // ARTICLES_PER_FILE)))


def write_batches(
    rows: DataFrame, path: str, fmt: str = "parquet", one_batch: bool = False, files: int = FILES_PER_BATCH
) -> None:
    """One folder per ``batch_id``; writing a batch again replaces that batch alone. Rows without
    a batch are a batch of their own. Rows are first dealt by batch, into ``files`` files at
    most, unless they are of ``one_batch`` and may be written where they lie."""
    share = F.pmod(F.xxhash64("doc_id", "chunk_no", "chunk_text"), F.lit(files))
    (
        (rows if one_batch else rows.repartition("batch_id", share))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .format(fmt)
        .save(path)
    )


def read_table_if_any(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one where nothing has been written yet."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_batches(spark: SparkSession, path: str, schema: T.StructType, batch_ids: list[int | None]) -> DataFrame:
    """Some batches of a table that ``write_batches`` wrote, all of which must be there. Only their
    folders are listed, however many others the table has."""
    folders = [f"{path}/batch_id={'__HIVE_DEFAULT_PARTITION__' if batch is None else batch}" for batch in batch_ids]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def read_chunk_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Chunk JSON lines of all given files and folders. A missing field is NULL, an
    extra one is dropped, a malformed line is a row of NULLs."""
    return spark.read.schema(CHUNK).json(list(paths))


def checked_chunk_lines(spark: SparkSession, *paths: str) -> tuple[DataFrame, DataFrame]:
    """(chunks, rejects): ``read_chunk_lines`` without its malformed lines, and those lines with the
    file they stand in. A line is malformed if it is no JSON object or a field has another
    type. Blank lines are neither."""
    spoilt = "_spoilt"
    schema = T.StructType([*CHUNK.fields, T.StructField(spoilt, T.StringType())])
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"))
    lines = lines.where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": spoilt}
    parsed = lines.select("file", "value", F.from_json("value", schema, options).alias("record"))
    bad = F.col("record").isNull() | F.col(f"record.{spoilt}").isNotNull()
    chunks = parsed.where(~bad).select(*[F.col(f"record.{name}").alias(name) for name in CHUNK.fieldNames()])
    return chunks, parsed.where(bad).select("file", F.col("value").alias("line"))


def read_embedded_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Embedded-chunk JSON lines, with the width of their vectors; else as above. An index
    over them should be built from a staged copy, as it reads its input more than once."""
    rows = spark.read.schema(EMBEDDED).json(list(paths))
    return rows.withColumn("width", F.coalesce(F.size("embedding"), F.lit(0)))


def write_answer_log(answers: DataFrame, path: str) -> DataFrame:
    """Full log as JSON lines, returned as read back."""
    answers.select(*answer_log()).write.mode("overwrite").json(path)
    return answers.sparkSession.read.schema(ANSWER_LOG).json(path)


def write_answer_summary(log: DataFrame, path: str) -> DataFrame:
    """Summary of a log as CSV with header, returned as read back."""
    log.select(*answer_summary()).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return read_answer_summary(log.sparkSession, path)


def read_answer_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ANSWER_SUMMARY).options(**CSV_OPTIONS, multiLine=True).csv(path)


def write_responses(answers: DataFrame, path: str) -> None:
    """One JSON record per request. ``path`` belongs to one (micro-)batch: a replay
    overwrites it with the same records."""
    answers.select(*response()).write.mode("overwrite").json(path)


def read_json_if_any(spark: SparkSession, path: str, schema: T.StructType, folders: str = "") -> DataFrame:
    """JSON lines at ``path``, with columns for its folders, or an empty table."""
    whole = T.StructType([*schema.fields, *(T.StructType.fromDDL(folders).fields if folders else [])])
    if exists(spark, path):
        return spark.read.schema(whole).json(path).select(*whole.fieldNames())
    return spark.createDataFrame([], whole)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSE).json(path)


def console_summary(summary: DataFrame) -> DataFrame:
    return summary.select("query", "topk")


def batch_ledger(embedded: DataFrame) -> DataFrame:
    """Chunks and failed chunks per batch, with the text of one error."""
    return embedded.groupBy("batch_id").agg(
        F.count("*").alias("n_chunks"),
        F.count_if(F.col("width") == 0).alias("n_failed"),
        F.min("error").alias("error"),
    )


def note_batches(entries: DataFrame, path: str) -> None:
    """Add entries (batch_id, n_chunks, n_failed, error) to the ledger."""
    timed = entries.withColumn("noted_at", F.current_timestamp())
    timed.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER.fields]).write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of each batch."""
    entries = read_table_if_any(spark, path, LEDGER)
    last = F.max_by(F.struct("n_chunks", "n_failed", "error"), "noted_at").alias("last")
    return entries.groupBy("batch_id").agg(last).select("batch_id", "last.*")
