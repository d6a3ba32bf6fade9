"""Corpus pipeline: each stage's rows are written as Parquet and reread as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionwise.llm import bpe, decontamination, language, lines, simhash
from mentionwise.llm.queries import tokenizer_path
from mentionwise.session import configure, freeze

# bytes of an Arrow batch: texts may be long, and two tasks hold one or two batches each on both sides
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
# words an encoder holds: its workers also carry what the stages before have left in them
WORDS_KEPT = 60_000


def settled(spark: SparkSession) -> SparkSession:
    """The session with the settings that every stage relies on."""
    configure(spark).conf.set(BATCH, str(BATCH_BYTES))
    return spark


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go; the lang column stays as it is."""
    settled(spark)
    return language.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier one go; n_chars follows the text. Documents stay, even if empty then."""
    settled(spark)
    cleaned = lines.remove_repeated(docs)
    kind = docs.schema["n_chars"].dataType
    changed = F.col("__n_removed") > 0
    cleaned = cleaned.withColumn(
        "n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
    )
    return cleaned.select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one of the smallest doc_id."""
    settled(spark)
    return simhash.keep_first(docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.keep_clean(docs, settled(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and digests of them and of the text decoded from them."""
    settled(spark)
    c = bpe.round_trip(F.col("text"), tokenizer_path(), WORDS_KEPT, keep_encoder=False)
    coded = docs.select("doc_id", c.alias("c")).select("doc_id", "c.*")
    return coded.select(
        "doc_id", bpe.n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate), ("encode", encode),
]

# the first stage learns a model and the last one tokenises: SQL cannot express the rows
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = settled(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir), name)
    return docs
