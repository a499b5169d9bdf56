"""The registered queries of the training-data operators: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm import bpe, chat_format, exact_dedup, fingerprints, line_dedup, mixing, ngram_join, sharding, spelling, suffix_dedup, token_align, token_io, toxicity
from trendlens.llm.common import table

SHARDS = 24
END_ID = 2


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source weights 5, 2, 1."""
    return mixing.mix_report(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations plus conversation -7, formatted and read back."""
    same = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(same).alias("text")
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = chat_format.format_chats(rows.select("conv_id", "turn", "role", chat_format.text_parts(F.col("text")).alias("parts")))
    turns = chat_format.read_turns(F.col("formatted"))
    loss = chat_format.read_loss(F.col("formatted"), F.col("loss_spans"))
    out = out.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that a 400-byte repeat covers, removed."""
    return suffix_dedup.cut_digests(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token ids, written as blocks and read back."""
    return token_io.token_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), END_ID)


def op7_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents; labels are learned from outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    out = toxicity.with_scores(docs.select("doc_id", "text"), toxicity.train(docs, table(spark, sf_dir, "labels")))
    out = out.select("doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score")
    return out.withColumn("predicted", (F.col("score") >= toxicity.REJECT).cast("int"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the rank file and decoded again."""
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.compare_edits(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 5-word shingle Jaccard similarity of at least 0.8."""
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op6_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents placed in 24 equal shards by key, and in 25."""
    out = sharding.place(table(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE tokens of all documents aligned with sentencepiece tokens."""
    return token_align.alignments(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that three documents share, dropped from all but the last."""
    out = line_dedup.line_report(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_exact_dedup, op3_chat_format, op4_suffix_dedup, op5_token_files, op6_rendezvous_shards, op7_toxicity_crf, op8_byte_bpe, op9_fingerprints, op10_ngram_jaccard,
        op11_spelling_variants, op12_token_alignment, op13_line_dedup,
    )
}
ORACLES = {
    "op1_mix_sources": mixing.ORACLE, "op2_exact_dedup": exact_dedup.ORACLE, "op3_chat_format": chat_format.ORACLE, "op11_spelling_variants": spelling.ORACLE, "op13_line_dedup": line_dedup.ORACLE,
}
