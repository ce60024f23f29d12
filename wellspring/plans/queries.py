"""The registered queries: each capability run over whole tables of a data folder."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.backends import DIM, ExtractiveGenerator, HashingEncoder, QuotingGenerator
from wellspring.functions.prompts import system_prompt, user_prompt
from wellspring.functions.records import LIST_RULE, fixed4, piped, request_id, response
from wellspring.functions.vectors import settle, squared_l2
from wellspring.operators.chunk import chunk
from wellspring.operators.pool import mean_pool
from wellspring.operators.requests import load_metrics, route
from wellspring.operators.search import search
from wellspring.plans.answer import (
    Asked,
    answer_batch,
    answer_job,
    encode_questions,
    retrieve,
    with_contexts,
)
from wellspring.plans.ingest import build_index as index_of
from wellspring.plans.ingest import chunk_corpus, embed, embed_chunks, ingest, ledger
from wellspring.schemas import CHUNK, EMBEDDED, REQUEST, TOTALS
from wellspring.sources.articles import article_scan, articles, batches, peek
from wellspring.sources.index import VectorIndex, load_index
from wellspring.sources.questions import MAX_QUEUE, question_stream, questions, queue_questions, queued_questions
from wellspring.sources.tables import (
    checked_chunk_lines,
    console_summary,
    files_for,
    read_chunk_lines,
    read_embedded_lines,
    read_json_if_any,
    write_batches,
)
from wellspring.streaming.answers import answer_stream, responses, totals_before, totals_metrics
from wellspring.streaming.lifecycle import EVENT, lifecycle_load, lifecycle_stream
from wellspring.workspace import scratch, ship_package, stage

# Whole texts are searched; the cut of a model's input is the feature of ``hash_encode``.
ENCODER = HashingEncoder(max_tokens=None)
GENERATOR = ExtractiveGenerator()

# The test tables are small; this many articles per batch gives several batches.
BATCH_ROWS = 250

STATUS_DDL = "active_workers long, max_workers int, queue_size long, total_completed long"

# Width of the vectors in the embeddings table.
TABLE_DIM = 64

_indexes: dict[tuple[str, str], str] = {}
_encoded: dict[tuple[str, str], Asked] = {}


def _documents(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    read = article_scan if spread else articles
    return read(spark, f"{sf_dir}/documents.parquet", title="source")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus_index(spark: SparkSession, sf_dir: str) -> VectorIndex:
    """The index over ``documents``, built on first use in an application."""
    ship_package(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _indexes:
        path = scratch(spark, "corpus")
        ingest(batches(_documents(spark, sf_dir), BATCH_ROWS), path, ENCODER, batch_rows=BATCH_ROWS)
        _indexes[key] = f"{path}/index"
    return load_index(spark, _indexes[key])


def benchmark_questions(spark: SparkSession, sf_dir: str) -> Asked:
    """``benchmark`` as encoded questions, encoded on first use in an application."""
    ship_package(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _encoded:
        asked = questions(_table(spark, sf_dir, "benchmark"), "item_id", "text")
        _encoded[key] = encode_questions(asked, ENCODER)
    return _encoded[key]


def scan_articles(spark, sf_dir):
    return _documents(spark, sf_dir, spread=False)


def row_peek(spark, sf_dir):
    return peek(_documents(spark, sf_dir, spread=False), 20)


def row_range_batches(spark, sf_dir):
    """Articles, chunks and title count per batch of rows numbered in key order."""
    numbered = batches(_documents(spark, sf_dir), BATCH_ROWS)
    return numbered.groupBy("batch_id").agg(
        F.count("*").alias("n_articles"),
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
    )


def chunk_overlap(spark, sf_dir):
    chunks = chunk(_documents(spark, sf_dir))
    return chunks.select("chunk_id", "doc_id", "chunk_no", "title", "chunk_text")


def chunk_roundtrip(spark, sf_dir):
    """Chunks through JSON line files, one folder per batch, read back as one set."""
    path = scratch(spark, "chunk-lines")
    numbered = batches(_documents(spark, sf_dir), BATCH_ROWS)
    write_batches(chunk_corpus(numbered), path, "json", files=files_for(BATCH_ROWS))
    return read_chunk_lines(spark, path).select(*CHUNK.fieldNames())


def batch_ledger(spark, sf_dir):
    """Chunks embedded and failed per batch, as noted by the embedding job."""
    ship_package(spark)
    path = scratch(spark, "embedded")
    numbered = batches(_documents(spark, sf_dir), BATCH_ROWS)
    chunks = f"{path}/chunks"
    write_batches(chunk_corpus(numbered), chunks, files=files_for(BATCH_ROWS))
    embed_chunks(spark.read.schema(CHUNK).parquet(chunks), path, ENCODER)
    return ledger(spark, path)


def hash_encode(spark, sf_dir):
    """Non-zero entries of the vectors of all chunks, by the encoder that reads the first 128
    tokens."""
    ship_package(spark)
    chunks = chunk_corpus(_documents(spark, sf_dir).withColumn("batch_id", F.lit(0).cast("long")))
    entry = F.transform("embedding", lambda value, i: F.struct(i.alias("bucket"), value.cast("double").alias("value")))
    filled = F.filter(entry, lambda e: e["value"] != 0)
    vectors = embed(chunks, HashingEncoder()).select("chunk_id", F.explode(filled).alias("e"))
    return vectors.select("chunk_id", "e.bucket", F.round("e.value", 6).alias("value"))


def pooled_labels(spark, sf_dir):
    pooled = mean_pool(_table(spark, sf_dir, "embeddings"), "label")
    return pooled.select("label", F.posexplode("embedding").alias("element", "mean")).withColumn(
        "mean", F.round("mean", 6)
    )


def valid_embedding_filter(spark, sf_dir):
    """Where each vector goes when an index is built of spoilt ones and of missing texts."""
    ship_package(spark)
    ident = F.col("vec_id")
    text = F.when(ident % 11 == 0, F.lit(None)).when(ident % 13 == 0, "").otherwise("text")
    rows = _spoilt(spark, sf_dir).select(
        ident.alias("doc_id"),
        F.lit(0).alias("chunk_no"),
        ident.cast("string").alias("chunk_id"),
        F.lit("title").alias("title"),
        text.alias("chunk_text"),
        "embedding",
        F.coalesce(F.size("embedding"), F.lit(0)).alias("width"),
        F.lit(None).cast("string").alias("error"),
        F.lit(0).cast("long").alias("batch_id"),
    )
    path = scratch(spark, "spoilt")
    index = index_of(stage(rows.select(*EMBEDDED.fieldNames()), "spoilt"), path, TABLE_DIM)
    taken = index.rows.select("chunk_id", F.lit("indexed").alias("verdict"))
    aside = spark.read.parquet(f"{path}/rejects").select("chunk_id", "verdict")
    return taken.union(aside).select(F.col("chunk_id").cast("long").alias("vec_id"), "verdict")


def _spoilt(spark, sf_dir):
    """The vectors, with those of three labels NULL, empty or short, and some with a NaN."""
    label, vector = F.col("label"), F.col("embedding")
    nan = F.array(F.lit(float("nan")).cast("float"))
    return _table(spark, sf_dir, "embeddings").withColumn(
        "embedding",
        F.when(label == 3, F.lit(None))
        .when(label == 5, F.slice(vector, 1, 0))
        .when(label == 7, F.slice(vector, 1, TABLE_DIM - 1))
        .when(F.col("vec_id") % 17 == 0, F.concat(F.slice(vector, 1, TABLE_DIM - 1), nan))
        .otherwise(vector),
    )


def flat_chunk_lines(spark, sf_dir):
    """Chunks as flat JSON lines of title and text, without ids or batches, read back and
    embedded: chunks and vectors per title."""
    ship_package(spark)
    path = scratch(spark, "flat")
    chunk(_documents(spark, sf_dir)).select("title", "chunk_text").write.json(f"{path}/lines")
    embedded = embed_chunks(read_chunk_lines(spark, f"{path}/lines"), f"{path}/embedded", ENCODER)
    return embedded.groupBy("title").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.count_if(F.col("width") == DIM).alias("n_vectors")
    )


def knn_mixed_width(spark, sf_dir):
    """Spoilt vectors searched for each other: each meets those of its own width, and NULL,
    empty and NaN ones neither ask nor answer."""
    ship_package(spark)
    table = _spoilt(spark, sf_dir)
    asked = table.select(F.col("vec_id").cast("string").alias("query_id"), "embedding")
    return search(table, asked, id_col="vec_id").drop("question_no")


def build_index(spark, sf_dir):
    """Every indexed chunk with its position."""
    return corpus_index(spark, sf_dir).positioned().select("pos", "chunk_id", "title", "chunk_text")


def index_size(spark, sf_dir):
    return corpus_index(spark, sf_dir).size()


def _vectors_as_questions(spark, sf_dir):
    table = _table(spark, sf_dir, "embeddings")
    return table, table.select(F.col("vec_id").cast("string").alias("query_id"), "embedding")


def knn_topk(spark, sf_dir):
    """Every vector of the table as a question to the table itself."""
    ship_package(spark)
    table, asked = _vectors_as_questions(spark, sf_dir)
    return search(table, asked, id_col="vec_id").drop("question_no")


def distance_format(spark, sf_dir):
    """Distances of each vector's hits with four decimals, as the summary writes them."""
    hits = knn_topk(spark, sf_dir).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "distance"))).alias("h"))
    return hits.select("query_id", F.array_join(fixed4(F.col("h.distance")), LIST_RULE).alias("distances"))


def hit_distance(spark, sf_dir):
    """Distances of the hits measured again by the column function, over equi-joins."""
    ship_package(spark)
    table, asked = _vectors_as_questions(spark, sf_dir)
    hits = search(table, asked, id_col="vec_id").select("query_id", "rank", "vec_id")
    pairs = hits.join(table.select("vec_id", "embedding"), "vec_id").join(
        asked.withColumnRenamed("embedding", "asked"), "query_id"
    )
    distance = settle(squared_l2(F.col("embedding"), F.col("asked")))
    return pairs.select("query_id", "rank", "vec_id", distance.alias("distance"))


def text_topk(spark, sf_dir):
    """Nearest chunks of ``documents`` for each ``benchmark`` text."""
    hits = retrieve(corpus_index(spark, sf_dir), benchmark_questions(spark, sf_dir))
    return hits.select("query_id", "rank", "pos", "chunk_id", "distance")


def context_fetch(spark, sf_dir):
    hits = retrieve(corpus_index(spark, sf_dir), benchmark_questions(spark, sf_dir))
    return hits.select("query_id", "rank", "chunk_text")


def _folded(spark, sf_dir):
    return with_contexts(corpus_index(spark, sf_dir), benchmark_questions(spark, sf_dir))


def context_dedupe(spark, sf_dir):
    """Contexts per question without copies, numbered in rank order."""
    distinct = F.posexplode(F.array_distinct("contexts")).alias("context_no", "context")
    return _folded(spark, sf_dir).select("query_id", distinct)


def prompt_assemble(spark, sf_dir):
    return _folded(spark, sf_dir).select(
        "query_id",
        system_prompt().alias("system"),
        user_prompt(F.col("query_text"), F.col("contexts")).alias("user"),
    )


def duplicate_ids(spark, sf_dir):
    """Questions whose client ids repeat or are missing are answered one by one."""
    ship_package(spark)
    item = F.col("item_id")
    client = F.when(item % 7 != 0, (item % 5).cast("string"))
    asked = _table(spark, sf_dir, "benchmark").select(client.alias("query_id"), F.col("text").alias("query_text"))
    folded = with_contexts(corpus_index(spark, sf_dir), encode_questions(asked, ENCODER))
    return folded.select("query_id", F.col("query_text").alias("query"), piped(F.col("indices")).alias("indices"))


def checked_answers(spark, sf_dir):
    """Answers by a generator that quotes its prompt and fails for marked questions."""
    ship_package(spark)
    item = F.col("item_id")
    marked = F.when(item % 6 == 0, QuotingGenerator.MARK).otherwise("").cast("string")
    asked = _table(spark, sf_dir, "benchmark").select(
        item.cast("string").alias("query_id"), F.concat(marked, "text").alias("query_text")
    )
    table = encode_questions(asked, ENCODER)
    answers = answer_batch(corpus_index(spark, sf_dir), table, QuotingGenerator(), retries=2, backoff=0)
    return stage(answers, "answers").select("query_id", "status", "answer", "error")


def _logs(spark, sf_dir):
    ship_package(spark)
    asked = questions(_table(spark, sf_dir, "benchmark"), "item_id", "text")
    return answer_job(corpus_index(spark, sf_dir), asked, ENCODER, GENERATOR, scratch(spark, "logs"))


def answer_log(spark, sf_dir):
    """The JSON log as read back; lists are joined so that they compare as text."""
    log, _ = _logs(spark, sf_dir)
    return log.select(
        "query",
        F.array_join("contexts", "\n").alias("contexts"),
        piped(F.col("indices")).alias("indices"),
        F.array_join(fixed4(F.col("distances")), LIST_RULE).alias("distances"),
    )


def answer_summary(spark, sf_dir):
    """The CSV summary as read back, without the generated answer."""
    _, summary = _logs(spark, sf_dir)
    return summary.drop("answer")


def console_rows(spark, sf_dir):
    _, summary = _logs(spark, sf_dir)
    return console_summary(summary)


def _requests(spark, sf_dir):
    return _table(spark, sf_dir, "conversations").select(
        request_id("conv_id", "turn").alias("query_id"), "conv_id", "turn", "role", "text"
    )


def question_routing(spark, sf_dir):
    """Every turn as a payload; system turns ask for status, the ninth turn quits."""
    payload = (
        F.when(F.col("role") == "system", " STATUS\t")
        .when(F.col("turn") == 8, "Quit\n")
        .otherwise(F.concat(F.lit("  "), "text", F.lit("\n")))
    )
    sent = _requests(spark, sf_dir).select("query_id", payload.alias("query_text"))
    return route(sent).select("query_id", "kind", "query_text")


def request_log(spark, sf_dir):
    """User turns as requests. One followed by an assistant turn is completed by it; others
    are queued, processing or failed by how late in the conversation they come. The clock
    is made from the table: requests come in at ``conv_id`` seconds and take a millisecond
    per character of the reply."""
    turns = _requests(spark, sf_dir)
    later = turns.select(
        "conv_id",
        (F.col("turn") - 1).alias("turn"),
        F.col("text").alias("reply"),
    ).where(F.col("role") == "assistant")
    asked = turns.where(F.col("role") == "user").join(later, ["conv_id", "turn"], "left")
    status = (
        F.when(F.col("reply").isNotNull(), "completed")
        .when(F.col("turn") < 3, "queued")
        .when(F.col("turn") < 6, "processing")
        .otherwise("failed")
    )
    arrived = F.col("conv_id") * 1_000_000
    return asked.select(
        "query_id",
        F.col("text").alias("query"),
        F.col("reply").alias("answer"),
        F.lit("no reply").alias("error"),
        status.alias("status"),
        F.array("reply").alias("contexts"),
        F.timestamp_micros(arrived).alias("ts"),
        F.timestamp_micros(arrived + F.length("reply") * 1000).alias("answered_at"),
    )


def response_envelope(spark, sf_dir):
    """Envelopes of all finished requests, through JSON text and back."""
    finished = request_log(spark, sf_dir).where(F.col("status").isin("completed", "failed"))
    record = F.to_json(F.struct(*response()))
    fields = "query_id string, query string, answer string, contexts array<string>, " \
        "processing_time double, error string, status string"
    back = finished.select(F.from_json(record, fields).alias("r")).select("r.*")
    return back.withColumn("contexts", F.array_join("contexts", "\n"))


def request_metrics(spark, sf_dir):
    return load_metrics(request_log(spark, sf_dir))


def stream_answers(spark, sf_dir):
    """User turns arriving as files, answered in micro-batches, contexts per rank."""
    index = corpus_index(spark, sf_dir)
    path = scratch(spark, "stream")
    arriving = _requests(spark, sf_dir).where(F.col("role") == "user")
    arriving.select(
        "query_id", F.col("text").alias("query_text"), F.timestamp_seconds("conv_id").alias("ts")
    ).repartition(4, "query_id").write.json(f"{path}/inbox")
    running = answer_stream(
        question_stream(spark, f"{path}/inbox", max_files=2),
        index,
        ENCODER,
        GENERATOR,
        path,
        f"{path}/checkpoint",
    )
    running.awaitTermination()
    contexts = F.posexplode("contexts").alias("rank", "context")
    return responses(spark, path).select("query_id", "status", contexts).withColumn("rank", F.col("rank") + 1)


def bounded_intake(spark, sf_dir):
    """User turns that arrive as one file, answered at most 100 at a time: questions and answers,
    micro-batches above the bound, and whether there were as few as the bound allows."""
    index = corpus_index(spark, sf_dir)
    path = scratch(spark, "intake")
    arriving = _requests(spark, sf_dir).where(F.col("role") == "user")
    arriving.select(
        "query_id", F.col("text").alias("query_text"), F.timestamp_seconds("conv_id").alias("ts")
    ).coalesce(1).write.json(f"{path}/inbox")
    queue_questions(question_stream(spark, f"{path}/inbox"), f"{path}/queue", f"{path}/queue-checkpoint").awaitTermination()
    answer_stream(
        queued_questions(spark, f"{path}/queue"), index, ENCODER, GENERATOR, path, f"{path}/checkpoint", queue=f"{path}/queue"
    ).awaitTermination()
    taken = read_json_if_any(spark, f"{path}/arrivals", REQUEST, "batch_id long").groupBy("batch_id").agg(F.count("*").alias("n"))
    answered = responses(spark, path).agg(F.countDistinct("query_id").alias("answered"))
    sizes = taken.agg(
        F.sum("n").alias("questions"),
        F.count_if(F.col("n") > MAX_QUEUE).alias("above_bound"),
        (F.count("*") >= F.ceil(F.sum("n") / MAX_QUEUE)).alias("as_many_as_needed"),
    )
    return sizes.join(F.broadcast(answered), F.lit(True))


def stream_status(spark, sf_dir):
    """The load that a stream keeps while it answers user turns one by one with a generator that
    refuses marked ones, as its last micro-batch left it."""
    index = corpus_index(spark, sf_dir)
    path = scratch(spark, "status")
    arriving = _requests(spark, sf_dir).where(F.col("role") == "user")
    marked = F.when(F.col("conv_id") % 6 == 0, QuotingGenerator.MARK).otherwise("")
    arriving.select(
        "query_id", F.concat(marked, "text").alias("query_text"), F.timestamp_seconds("conv_id").alias("ts")
    ).repartition(2, "query_id").write.json(f"{path}/inbox")
    running = answer_stream(
        question_stream(spark, f"{path}/inbox", max_files=1), index, ENCODER, QuotingGenerator(), path, f"{path}/checkpoint",
        retries=1, backoff=0,
    )
    running.awaitTermination()
    last = max(row.batch_id for row in read_json_if_any(spark, f"{path}/totals", TOTALS, "batch_id long").select("batch_id").collect())
    totals = totals_before(spark, path, last + 1)
    return spark.createDataFrame([totals_metrics(totals) | {"total_failed": totals["failed"]}], f"{STATUS_DDL}, total_failed long")


def request_states(spark, sf_dir):
    """Load by the keyed state of a stream of request events, in which every event comes twice."""
    log = request_log(spark, sf_dir)
    path = scratch(spark, "events")
    steps = F.expr("CASE status WHEN 'queued' THEN array('queued') WHEN 'processing' THEN array('queued', 'processing') "
                   "ELSE array('queued', 'processing', status) END")
    events = log.select("query_id", F.explode(steps).alias("status"))
    for _ in range(2):
        events.repartition(2).write.mode("append").parquet(f"{path}/events")
    arriving = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 2).parquet(f"{path}/events")
    lifecycle_stream(arriving, f"{path}/checkpoint").awaitTermination()
    return lifecycle_load(spark, f"{path}/checkpoint")


def reject_lines(spark, sf_dir):
    """Chunk lines of which every seventh was spoilt: lines read and set aside, by what was done."""
    path = scratch(spark, "spoilt-lines")
    numbered = chunk(_documents(spark, sf_dir)).withColumn("k", F.pmod(F.col("doc_id") + F.col("chunk_no"), F.lit(7)))
    line = F.to_json(F.struct("doc_id", "chunk_no", "chunk_id", "title", "chunk_text"))
    spoilt = F.when(F.col("k") == 0, F.concat(F.lit("not json "), line)).when(F.col("k") == 1, F.concat(line, F.lit("}"))).when(
        F.col("k") == 2, F.to_json(F.struct(F.lit("no number").alias("doc_id"), "title", "chunk_text"))).otherwise(line)
    numbered.select(spoilt.alias("value")).write.text(path)
    chunks, rejects = checked_chunk_lines(spark, path)
    kind = F.when(F.col("line").startswith("not json"), "no record").otherwise("wrong type")
    good = chunks.select(F.lit("chunk").alias("kind"), "doc_id")
    bad = rejects.select(kind.alias("kind"), F.lit(0).cast("long").alias("doc_id"))
    return good.union(bad).groupBy("kind").agg(F.count("*").alias("n_lines"), F.sum("doc_id").alias("doc_ids"))


def embedded_lines(spark, sf_dir):
    """Chunks embedded, written as JSON lines to two folders, read as one set and indexed."""
    ship_package(spark)
    path = scratch(spark, "embedded-lines")
    numbered = _documents(spark, sf_dir).withColumn("batch_id", F.lit(0).cast("long"))
    embedded = stage(embed(chunk_corpus(numbered), ENCODER), "embedded-lines")
    odd = F.col("chunk_no") % 2 == 1
    for name, part in (("odd", odd), ("even", ~odd)):
        embedded.where(part).drop("width").write.json(f"{path}/{name}")
    table = stage(read_embedded_lines(spark, f"{path}/odd", f"{path}/even"), "embedded-lines")
    index = index_of(table, f"{path}/index")
    length = F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x), 6)
    return index.positioned().select("pos", "chunk_id", length.alias("norm"))


def index_versions(spark, sf_dir):
    """Sizes of an index before and after it was built again under a reader that keeps its
    version, and of the first version, asked for by number."""
    ship_package(spark)
    path = scratch(spark, "versions")
    vectors = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.lit(0).alias("chunk_no"), F.col("vec_id").cast("string").alias("chunk_id"),
        F.lit("t").alias("title"), F.lit("text").alias("chunk_text"), "embedding", F.size("embedding").alias("width"),
        F.lit(None).cast("string").alias("error"), F.lit(0).cast("long").alias("batch_id"), "label",
    )
    table = stage(vectors, "versions")
    reader = index_of(table.where("label < 5").drop("label"), path, TABLE_DIM)
    index_of(table.drop("label"), path, TABLE_DIM)
    held = {"reader": reader, "latest": load_index(spark, path), "first": load_index(spark, path, 0)}
    sizes = [index.rows.groupBy().agg(F.count("*").alias("n")).select(F.lit(name).alias("version"), "n") for name, index in held.items()]
    return sizes[0].union(sizes[1]).union(sizes[2])


QUERIES = {
    "article_scan": scan_articles,
    "row_peek": row_peek,
    "row_range_batches": row_range_batches,
    "chunk_overlap": chunk_overlap,
    "chunk_roundtrip": chunk_roundtrip,
    "batch_ledger": batch_ledger,
    "hash_encode": hash_encode,
    "mean_pool": pooled_labels,
    "valid_embedding_filter": valid_embedding_filter,
    "build_index": build_index,
    "index_size": index_size,
    "flat_chunk_lines": flat_chunk_lines,
    "knn_topk": knn_topk,
    "knn_mixed_width": knn_mixed_width,
    "distance_format": distance_format,
    "hit_distance": hit_distance,
    "text_topk": text_topk,
    "context_fetch": context_fetch,
    "context_dedupe": context_dedupe,
    "prompt_assemble": prompt_assemble,
    "duplicate_ids": duplicate_ids,
    "answers": checked_answers,
    "answer_log": answer_log,
    "answer_summary": answer_summary,
    "console_summary": console_rows,
    "question_routing": question_routing,
    "response_envelope": response_envelope,
    "request_metrics": request_metrics,
    "answer_stream": stream_answers,
    "bounded_intake": bounded_intake,
    "stream_status": stream_status,
    "request_states": request_states,
    "reject_lines": reject_lines,
    "embedded_lines": embedded_lines,
    "index_versions": index_versions,
}
