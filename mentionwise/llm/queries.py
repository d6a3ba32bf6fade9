"""The registered queries of this subpackage: a callable from (spark, directory of tables) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionwise.llm import (
    alignment, bpe, chat, decontamination, language, lines, merkle, quality, simhash, token_counts, toxicity, urls, warc,
)
from mentionwise.session import configure, scratch_path


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{d}/{name}.parquet")


def sample_edits(text: Column) -> Column:
    """Three edits of a text at places that follow from its length: insert, remove, replace."""
    size = F.coalesce(F.char_length(text), F.lit(0)).cast("long")

    def change(at: Column, drop: int, insert: str) -> Column:
        return F.struct(
            F.floor(at).cast("long").alias("at"), F.lit(drop).cast("long").alias("drop"), F.lit(insert).alias("insert")
        )

    return F.array(change(size / 3, 0, " it's new\n"), change(size / 2, 7, ""), change(size * 0.9, 3, "x  7"))


def op1_token_counts(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents").select("doc_id", "text")
    counted = token_counts.edited_counts(docs, sample_edits(F.col("text")), tokenizer_path())
    return counted.select(
        "doc_id", "edited.n_before", "edited.n_tokens", "edited.n_read", F.sha2("edited.text", 256).alias("text_sha256")
    )


def op2_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    cleaned = lines.remove_repeated(_table(spark, d, "documents").select("doc_id", "text"))
    left = F.coalesce("text", F.lit(""))
    return cleaned.select(
        "doc_id", F.col("__n_removed").cast("long").alias("n_removed"), F.sha2(left, 256).alias("text_sha256"),
    )


def op3_bpe(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    coded = docs.select("doc_id", bpe.round_trip(F.col("text"), tokenizer_path()).alias("c")).select("doc_id", "c.*")
    return coded.select(
        "doc_id", bpe.n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_decontamination(spark: SparkSession, d: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, d, "documents"), _table(spark, d, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_ids").cast("long").alias("n_near"), F.sha2(F.array_join("near_ids", ","), 256).alias("near_sha256"),
    )


def op5_language(spark: SparkSession, d: str) -> DataFrame:
    return language.predict(_table(spark, d, "documents")).select("doc_id", "held_out", "lang_pred", "score")


URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]


def op6_urls(spark: SparkSession, d: str) -> DataFrame:
    pages = _table(spark, d, "pages")
    return urls.judge(pages, spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


def op7_simhash(spark: SparkSession, d: str) -> DataFrame:
    groups = simhash.near_duplicates(_table(spark, d, "documents"), shingle=3, max_bits=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.judge(_table(spark, d, "documents"))


# the conversation that is formatted along with the table
CONTROL_STRINGS = r"\### Assistant: </turn> ok"


def op9_chat(spark: SparkSession, d: str) -> DataFrame:
    given = _table(spark, d, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    own = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_STRINGS), (-7, 1, "assistant", CONTROL_STRINGS)], given.schema
    )
    return chat.format_conversations(given.unionByName(own), tokenizer_path()).drop("formatted", "mask")


def op10_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.predict(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op11_alignment(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents").select("doc_id", "text")
    found = alignment.linked(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return alignment.scored(found.withColumn("groups_sha256", digest).drop("groups"))


def op12_merkle(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(tampered, F.col("n_chars").cast("decimal(38,0)") + 1)
    made = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], changed={"n_chars": more})
    return merkle.verified(made).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.concat("proof", "group_proof"), 256).alias("proof_sha256"),
        "folded_root", "verified",
    )


def op13_warc(spark: SparkSession, d: str) -> DataFrame:
    pages, path = _table(spark, d, "pages"), scratch_path(spark, "archives")
    warc.write_archives(warc.records_of(pages), path)
    found = warc.read_archives(spark, path, {"payload_bytes": lambda p: F.octet_length(p).cast("long"), "sha1": F.sha1})
    kind = pages.schema["page_id"].dataType
    return warc.resolved(found, ["payload_bytes", "sha1"]).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", warc.base32(F.col("sha1")).alias("payload_digest"),
        "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {
        "pipeline": corpus_pipeline.run,
        "op1_token_counts": op1_token_counts, "op2_line_dedup": op2_line_dedup, "op3_bpe": op3_bpe, "op4_decontamination": op4_decontamination, "op5_language": op5_language,
        "op6_urls": op6_urls, "op7_simhash": op7_simhash, "op8_quality": op8_quality,
        "op9_chat": op9_chat, "op10_toxicity": op10_toxicity,
        "op11_alignment": op11_alignment, "op12_merkle": op12_merkle, "op13_warc": op13_warc,
    }
