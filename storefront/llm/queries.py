"""The registered queries of the corpus operators, one for each operator.

Every query applies its operator with production parameters to the whole of its
table and derives the returned columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversations, decontaminate, huffman, imatch, jaccard_join, licenses, packing, quality_gam, sharding,
               suffix_dedup, token_count, toxicity, whitening)
from .corpus_io import table


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents as files ``source/lang/doc_id``."""
    return licenses.scan(table(spark, sf_dir, "documents"), F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2,048 ids."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold an item of ``benchmark``."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 200 bytes removed from all documents."""
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"),
                       F.col("_n_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by a learned lexicon."""
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn_lexicon(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon)


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under Jaccard similarity of 0.75 on five-word shingles."""
    return jaccard_join.similar(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 of near equal size."""
    return sharding.shard(table(spark, sf_dir, "documents"), 24)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by the additive model."""
    return quality_gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of all documents and of their edited texts."""
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of all documents."""
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as Huffman codes and read back."""
    folder = huffman.scratch_folder(spark)
    huffman.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return huffman.read(spark, folder, with_ids=False)


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.digests(damaged).withColumnRenamed("conv", "conv_id")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the first 32 components, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_jaccard": op6_jaccard,
    "op7_sharding": op7_sharding,
    "op8_quality": op8_quality,
    "op9_imatch": op9_imatch,
    "op10_token_count": op10_token_count,
    "op11_huffman": op11_huffman,
    "op12_conversations": op12_conversations,
    "op13_whitening": op13_whitening,
}
