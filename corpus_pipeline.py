"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.llm import bpe, decontamination, pii, quality, simhash_dedup
from locuspark.llm.queries import table, tokenizer_path
from locuspark.llm.shared import shared_path


#: Rows of an Arrow batch between the JVM and Python: a stage's texts are whole documents, so few at a time.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score under 0.7) go."""
    _small_batches(spark)
    return quality.keep_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group one document stays: that with the smallest id."""
    _small_batches(spark)
    return simhash_dedup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows."""
    _small_batches(spark)
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digests of ids and decoded text."""
    _small_batches(spark)
    return bpe.bpe_encode(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe encoding", bpe_stage),
]

#: SQL can express neither the classifier nor the fingerprints nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; what each returns is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = shared_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
