"""Time the headline queries on ``$BENCH_SF_DIR`` and print one JSON line.

``embed`` cuts and encodes all chunks; ``ingest`` also writes them and builds the index, from
nothing; ``one_question`` encodes, retrieves for and answers a single question. The other
queries use an index of their own, built before the clock starts. Each is run once to warm up
and then timed; rates are rows over those times.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from wellspring.plans import queries as registered  # noqa: E402
from wellspring.plans.answer import answer_batch, encode_questions  # noqa: E402
from wellspring.plans.ingest import chunk_corpus, embed, ingest  # noqa: E402
from wellspring.session import local_session  # noqa: E402
from wellspring.sources.articles import batches  # noqa: E402
from wellspring.sources.questions import questions  # noqa: E402
from wellspring.workspace import scratch, ship_package  # noqa: E402

HEADLINE = [
    "chunk_overlap",
    "row_range_batches",
    "hash_encode",
    "mean_pool",
    "knn_topk",
    "text_topk",
    "context_dedupe",
    "prompt_assemble",
    "answer_summary",
    "question_routing",
    "request_metrics",
    "answer_stream",
]


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session("bench")
    ship_package(spark)

    def fresh_ingest():
        documents = registered._documents(spark, sf_dir)
        numbered = batches(documents, registered.BATCH_ROWS)
        ingest(numbered, scratch(spark, "bench"), registered.ENCODER)

    def embed_only():
        documents = registered._documents(spark, sf_dir).withColumn("batch_id", F.lit(0).cast("long"))
        noop(embed(chunk_corpus(documents), registered.ENCODER))

    def one_question():
        first = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").limit(1)
        asked = encode_questions(questions(first, "item_id", "text"), registered.ENCODER)
        noop(answer_batch(index, asked, registered.GENERATOR))

    def run(name):
        noop(registered.QUERIES[name](spark, sf_dir))

    index = registered.corpus_index(spark, sf_dir)
    asked = registered.benchmark_questions(spark, sf_dir)
    spent = {}
    for name, action in [("embed", embed_only), ("ingest", fresh_ingest), ("one_question", one_question)]:
        action()
        spent[name] = timed(action)
    for name in HEADLINE:
        run(name)
        spent[name] = timed(lambda: run(name))

    chunks, vectors = index.size().first().ntotal, spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    rates = {
        "chunks_embedded_per_sec": chunks / spent["embed"],
        "chunks_ingested_per_sec": chunks / spent["ingest"],
        "chunks_cut_per_sec": chunks / spent["chunk_overlap"],
        "questions_retrieved_per_sec": asked.table.count() / spent["text_topk"],
        "knn_questions_per_sec": vectors / spent["knn_topk"],
    }
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in spent.items()},
                "rates": {name: round(rate, 1) for name, rate in rates.items()},
                "chunks": chunks,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
