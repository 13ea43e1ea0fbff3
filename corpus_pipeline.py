"""The training-data pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Documents that a quality rule rejects go; of the rest, lines that repeat an earlier line go (and documents
of which no word is left); of each group of linked near-duplicates the document with the smallest id stays;
documents with a benchmark window go; what is left is encoded, with the ids' digest and the round trip's.

Cases: a document with a null or empty text, or of white space, has no words, so the quality rules reject it; one very
long text is judged whole. Rows without an id take part in all stages: they come after all others, so their lines
and texts go where an earlier row has the like, and those that stay keep their null id. Repeated rows (same id and
text) keep each other's lines and are one row after the join. Of ties (one id, several texts) each is
judged by its own text, but loses the lines that its id loses. An empty documents table gives an empty
result, an empty benchmark takes nothing away. Other columns, whatever their names, pass through all
stages but the last; n_chars follows the text, and a table without that column stays without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import _text, bpe, decontamination, line_dedup, ngram_join, quality_rules


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", benchmark), ("BPE encoding and decoding", tokens)]
#: SQL has no BPE and no practical exact similarity join of whole tables; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = _text.written(stage(spark, docs, sf_dir))
    return docs
