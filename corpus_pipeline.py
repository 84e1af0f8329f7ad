"""The corpus pipeline: five stages over ``documents``, each on all that the one before it kept.

1. quality: rejected documents go (quality model, score under its threshold).
2. near duplicates: of each component under Jaccard similarity one document stays.
3. repeated passages: strings of 200 bytes that start at two places are removed.
4. benchmark decontamination: documents that hold a benchmark item go.
5. packing: what is left is tokenised and packed into training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each stage's result as
Parquet under the session's shared folder and reads it back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront.llm import decontaminate, jaccard_join, packing, quality_gam, suffix_dedup
from storefront.llm.corpus_io import maybe_broadcast, small_batches, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the quality model accepts.

    The model is fitted on labels of documents that are in ``docs``.  Rows with a
    null id are scored like others; a repeated id is judged text by text.
    """
    docs = docs.select(*COLUMNS)
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"))
    return quality_gam.score(docs, model, COLUMNS, least=0.7).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each component; documents without words stay.

    A null text has no words.  A null id stays only where no row of its component has
    an id; rows that agree in id and text count once; of rows with one id and
    different texts each is judged by its text.
    """
    return jaccard_join.representatives(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out repeated strings of 200 bytes; a character of which a byte goes is cut whole.

    No row goes: a text of which nothing is left stays as the empty text.  Null texts stay
    null, null and repeated ids are kept, and equal long texts lose all that they share.
    """
    cut = suffix_dedup.remove_repeats(docs.select(*COLUMNS), whole_characters=True)
    text = F.when(F.col("_n_removed") > 0, F.decode("_kept", "UTF-8")).otherwise(F.col("text"))
    return (cut.withColumn("text", text)
            .withColumn("n_chars", F.when(F.col("_n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item.

    Rows are judged by their texts alone: a row with a null id goes like others, and a
    clean row that shares its id with a leaking one stays.  Null and empty texts stay.
    """
    docs = docs.select(*COLUMNS)
    named = docs.withColumn("_text_md5", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    held = decontaminate.leaks(named, table(spark, sf_dir, "benchmark"), id_col="_text_md5")
    held = written(held.select(F.col("doc_id").alias("_text_md5")).distinct(), "pipeline-held")
    return named.join(maybe_broadcast(held, held.count(), 48), "_text_md5", "left_anti").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all that is left into sequences of at most 2,048 ids; a document without text is its end id."""
    small_batches(spark)
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("benchmark_decontamination", benchmark_decontamination), ("packing", pack_sequences)]

#: SQL can express neither the fitted model nor the packing; the stages are tested against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
