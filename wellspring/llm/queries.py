"""The registered queries of the thirteen operators, over whole tables with production parameters."""

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.llm import audit, best_fit, chat, lines, mixing, near_vectors, neighbours, packing, quality, repair, simhash
from wellspring.llm import token_counts, toxicity
from wellspring.llm.common import table


@lru_cache
def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings from the labels: 0 poor, 1 good."""
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("grade"))


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    settings = quality.Settings()
    found = quality.with_quality(docs.select("doc_id", "text"), quality.train(docs, grades(spark, sf_dir), settings), settings)
    return found.select(
        "doc_id", "expected_grade", "tail_probability", (F.col("tail_probability") >= settings.keep).alias("kept")
    )


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_chats(chat.log_of(turns)))


def op4_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.with_mixing(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return found.select(
        "doc_id",
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("tokens"),
        F.col("mix_probability").alias("probability"),
        F.col("mix_kept").alias("kept"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(docs, tokenizer_file("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_tokens", "token_score")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


def held_out(doc_id) -> F.Column:
    """Whether a row is kept from learning; one without an id has no label to learn."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    scored = toxicity.with_toxicity(docs.select("doc_id", "text"), toxicity.train(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"), least=lines.EVERY)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


QUERIES = {f.__name__: f for f in (
    op1_near_vectors, op2_quality_classifier, op3_chat_formatting, op4_mixing_weights, op5_token_counts,
    op6_nearest_neighbours, op7_toxicity, op8_packing, op9_simhash, op10_line_dedup, op11_filter_audit, op12_conversation_repair,
    op13_best_fit_packing,
)}

ORACLE = {"op4_mixing_weights": mixing.oracle(), "op11_filter_audit": audit.oracle()}
