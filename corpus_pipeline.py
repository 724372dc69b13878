"""The corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination, packing.

``STAGES`` lists (name, function) in order. A function takes (spark, docs,
sf_dir), works on all rows that its predecessor kept and returns a DataFrame;
all but the last return the columns of ``documents``. ``run`` writes each result
as Parquet to the shared checkpoint folder and reads it again as the next
stage's input, so a lost executor costs at most its own stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.llm.common import documents, store
from churnlab.llm.decontaminate import decontaminate, items_of
from churnlab.llm.langid import keep_known_language
from churnlab.llm.linededup import dedup_lines
from churnlab.llm.neardup import drop_near_duplicates
from churnlab.llm.packing import pack_documents

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the subword model does not reject."""
    return keep_known_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their cross-site boilerplate lines kept at the first place only."""
    return dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, items_of(spark, sf_dir))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document's ids stands in the training sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", pack)]

# Language model, weighted sampling and tokenizer are beyond SQL: tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
