"""Registered queries of the training-data operators, each over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (
    conversations,
    embed_dedup,
    html_diff,
    jaccard,
    licenses,
    line_dedup,
    oracles,
    packing,
    pieces,
    quality,
    sharding,
    token_orc,
    toxicity,
    word_runs,
)
from quire.scratch import scratch_path


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, limit: int = packing.LIMIT) -> DataFrame:
    """Pieces of documents under the public byte-level vocabulary."""
    import public_tokenizers

    return packing.tokenize(docs, _tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, limit)


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf, "documents"))


def op2_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Ids as count, checksum and score; whether decoding gives the text back."""
    model = _tokenizer_file("piece_bpe_32k.model")
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    encoded = pieces.encode_documents(docs, model, keep=["doc_id", "text"])
    decoded = pieces.decode_documents(encoded, model)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.crc32(F.array_join("ids", ",").cast("binary")).alias("ids_crc32"),
        "score",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op3_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_diff.extract_pages(_table(spark, sf, "pages"))


def op4_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_copies(_table(spark, sf, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embed_dedup.near_vectors(_table(spark, sf, "embeddings"))


def op6_sharding(spark: SparkSession, sf: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = _table(spark, sf, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    return sharding.shuffle_to_shards(rows).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    held_out = toxicity.held_out()
    model = toxicity.learn(docs, _table(spark, sf, "labels"), held_out)
    return toxicity.score_texts(docs, model).withColumn("held_out", held_out)


def op8_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(_table(spark, sf, "documents"))


def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return line_dedup.drop_shared_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op10_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(token_pieces(_table(spark, sf, "documents")))


def op11_orc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_path(spark, "orc")
    token_orc.write_tokens(_table(spark, sf, "documents"), out, _tokenizer_file("word_bpe_49k.json"))
    read = token_orc.read_tokens(spark, out).withColumn("ids", token_orc.ids_crc32(F.col("ids")))
    return token_orc.starts(read).select("doc_id", "start", "n_tokens", F.col("ids").alias("ids_crc32"))


def op12_word_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    found = word_runs.longest_run(word_runs.collapse_runs(docs, damage=True, digest=True))
    run = F.col("longest")
    return found.select(
        "doc_id",
        "n_runs",
        run["start"].alias("start"),
        run["length"].alias("length"),
        run["period"].alias("period"),
        F.floor(1000 * run["length"] / run["period"]).cast("long").alias("exponent_milli"),
        F.sha2("runs_text", 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    damaged = conversations.damage(_table(spark, sf, "conversations"))
    return conversations.digest(conversations.repair(damaged)).withColumnRenamed("conv", "conv_id")


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_sentencepiece,
        op3_html_extraction,
        op4_ngram_jaccard_join,
        op5_embedding_dedup,
        op6_sharding,
        op7_toxicity,
        op8_license_scan,
        op9_line_dedup,
        op10_best_fit_packing,
        op11_orc_tokens,
        op12_word_runs,
        op13_conversation_repair,
        pipeline,
    )
}
ORACLES: dict[str, str] = {
    "op1_quality_rules": oracles.QUALITY,
    "op4_ngram_jaccard_join": oracles.NEAR_COPIES,
    "op5_embedding_dedup": oracles.NEAR_VECTORS,
    "op9_line_dedup": oracles.LINE_DEDUP,
    "op12_word_runs": oracles.WORD_RUNS,
    "op13_conversation_repair": oracles.CONVERSATIONS,
}
