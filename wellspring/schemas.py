"""Record shapes shared by sources, operators and sinks. Nothing is inferred."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


VECTOR = T.ArrayType(T.FloatType())

ARTICLE = _struct(
    ("doc_id", T.LongType()),
    ("title", T.StringType()),
    ("text", T.StringType()),
)

CHUNK = _struct(
    ("doc_id", T.LongType()),
    ("chunk_no", T.IntegerType()),
    ("chunk_id", T.StringType()),
    ("title", T.StringType()),
    ("chunk_text", T.StringType()),
    ("batch_id", T.LongType()),
)

# width is the length of embedding (0: failed, with the error's text), so checks need not read
# the vectors.
EMBEDDED = T.StructType(
    CHUNK.fields[:-1]
    + [T.StructField("embedding", VECTOR), T.StructField("width", T.IntegerType())]
    + [T.StructField("error", T.StringType()), CHUNK["batch_id"]]
)

LEDGER = _struct(
    ("batch_id", T.LongType()),
    ("n_chunks", T.LongType()),
    ("n_failed", T.LongType()),
    ("error", T.StringType()),
    ("noted_at", T.TimestampType()),
)

# row_key orders rows like their position; slot is the folder a row lies in.
INDEX_ROW = T.StructType(
    [T.StructField("row_key", T.LongType())]
    + EMBEDDED.fields[:-3]
    + [T.StructField("slot", T.IntegerType())]
)

SLOT = _struct(
    ("slot", T.IntegerType()),
    ("first_pos", T.LongType()),
    ("n_rows", T.LongType()),
)

QUESTION = _struct(
    ("query_id", T.StringType()),
    ("query_text", T.StringType()),
    ("ts", T.TimestampType()),
)

REQUEST = _struct(
    ("query_id", T.StringType()),
    ("ts", T.TimestampType()),
)

STATUS = _struct(
    ("query_id", T.StringType()),
    ("active_workers", T.LongType()),
    ("max_workers", T.IntegerType()),
    ("queue_size", T.LongType()),
    ("total_completed", T.LongType()),
)

WRITTEN_REPLY = _struct(
    ("prompt_key", T.StringType()),
    ("answer", T.StringType()),
    ("answered_us", T.LongType()),
)

# Contexts of a question text, in the folder of the queue file it came in.
FOUND_TEXT = _struct(
    ("query_text", T.StringType()),
    ("contexts", T.ArrayType(T.StringType())),
    ("indices", T.ArrayType(T.LongType())),
    ("distances", T.ArrayType(T.DoubleType())),
    ("queue_file", T.StringType()),
)

# Totals of a stream after one of its micro-batches.
TOTALS = _struct(
    ("arrived", T.LongType()),
    ("completed", T.LongType()),
    ("failed", T.LongType()),
)

ANSWER = _struct(
    ("query_id", T.StringType()),
    ("query", T.StringType()),
    ("answer", T.StringType()),
    ("error", T.StringType()),
    ("status", T.StringType()),
    ("contexts", T.ArrayType(T.StringType())),
    ("indices", T.ArrayType(T.LongType())),
    ("distances", T.ArrayType(T.DoubleType())),
    ("ts", T.TimestampType()),
    ("answered_at", T.TimestampType()),
)

ANSWER_LOG = _struct(
    ("query", T.StringType()),
    ("answer", T.StringType()),
    ("contexts", T.ArrayType(T.StringType())),
    ("indices", T.ArrayType(T.LongType())),
    ("distances", T.ArrayType(T.DoubleType())),
)

ANSWER_SUMMARY = _struct(
    ("query", T.StringType()),
    ("answer", T.StringType()),
    ("topk", T.IntegerType()),
    ("indices", T.StringType()),
    ("distances", T.StringType()),
    ("context_concat", T.StringType()),
)

RESPONSE = _struct(
    ("query_id", T.StringType()),
    ("query", T.StringType()),
    ("answer", T.StringType()),
    ("contexts", T.ArrayType(T.StringType())),
    ("processing_time", T.DoubleType()),
    ("error", T.StringType()),
    ("status", T.StringType()),
)
