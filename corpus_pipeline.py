"""Training-data pipeline over ``documents``: five stages, each written and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame
that is stored as Parquet and is the next one's docs. All but the last keep the columns of
documents; the last returns the pieces of packed sequences.
"""

from pyspark.sql import DataFrame, SparkSession

from wellspring.llm import lines, mixing, packing, quality, simhash
from wellspring.llm.common import table
from wellspring.llm.queries import grades, tokenizer_file
from wellspring.workspace import ship_package, stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.select_quality(docs, grades(spark, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(docs, least=lines.EVERY)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packing_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources to target weights", mixing_weights),
    ("packing", packing_sequences),
]

#: SQL can state neither the trained classifier nor the tokenizer; tests hold each stage against
#: a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES):
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
