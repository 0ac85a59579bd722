"""One registered query per operator: the operator over its whole table, with digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotwise.llm import (
    byte_bpe, exact_dedup, language, lm, near_dedup, packing, pii, quality, secret_scan, spelling, token_store,
    toxicity, whitening,
)
from lotwise.llm.common import doc_remainder, documents, table
from lotwise.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
END_ID = 0
SEQUENCE_TOKENS = 2048
# For the registered query and the pipeline over test tables; a real run brings its own secret.
PII_KEY = b"test tables only"


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write(documents(spark, sf_dir), path, public_tokenizers.path(VOCABULARY), END_ID)
    return token_store.with_crc32(token_store.documents(spark, path))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.learn(docs.filter(doc_remainder(3) != 1))
    return language.predict(docs, model).select(
        "doc_id", (doc_remainder(3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def packed_rows(packed: DataFrame) -> DataFrame:
    """Places of pieces, with a checksum for the ids themselves."""
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path(VOCABULARY)
    return packed_rows(packing.pack(documents(spark, sf_dir), tokenizer, END_ID, SEQUENCE_TOKENS))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    ids = byte_bpe.encode(documents(spark, sf_dir), ranks, pattern)
    return byte_bpe.with_decoded(ids, ranks, pattern).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), PII_KEY)

    def count(kind: str) -> Column:
        return F.size(F.filter("pii_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", "text", *[count(kind) for kind in pii.KINDS])


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.judge(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model, counts = lm.learn(docs.filter(doc_remainder(5) != 1))
    return lm.score(docs, model, counts).select(
        "doc_id", (doc_remainder(5) == 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in ("assign", "access", "hex")]
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.as_text("base_spans"), 256).alias("base_sha256"),
        secret_scan.as_text("spans").alias("spans"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.resolve(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), n=4)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.learn(docs.filter(doc_remainder(5) != 0), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (doc_remainder(5) == 0).alias("held_out"), "score", "predicted",
        F.size("passages").cast("long").alias("n_passages"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_language": op2_language,
    "op3_packing": op3_packing,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_pii": op5_pii,
    "op6_quality": op6_quality,
    "op7_language_model": op7_language_model,
    "op8_secret_scan": op8_secret_scan,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_near_dedup": op10_near_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_whitening": op12_whitening,
    "op13_spelling": op13_spelling,
}
