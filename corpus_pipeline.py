"""A training-data pipeline over the documents table: five stages, each written and read again by the next one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.llm import linededup, mixing, neardup, pieces, toxicity
from clearledger.llm.common import fold, materialise, small_batches

#: Texts that a Python worker, and that a column of a file's reader, hold at a time. All stages share the executors, whose processes keep what one
#: stage once took, so here both are fewer than in the queries and than Spark's 10,000 and 4,096. Near-dedup looks at lists of some hundred rows.
TEXTS_AT_ONCE, LISTED_AT_ONCE, READ_AT_ONCE = 250, 500, 512


def few_at_once(spark: SparkSession, rows: int = TEXTS_AT_ONCE) -> None:
    small_batches(spark, rows)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_AT_ONCE))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go. Learned from the labels of the documents that reach this stage, without every fifth."""
    few_at_once(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, labels, fold(F.col("doc_id"), 5) != 0, into="_toxicity")
    return scored.where("_toxicity < 0.5").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go. A document of which no word is left goes with them if all its lines were equal to lines of others.

    Where lines of such a document went by a template, words in which they differ may stand nowhere else: the document stays as it was.
    """
    few_at_once(spark)
    done = linededup.drop_recurring_lines(docs.withColumn("_whole", F.col("text")), info="_lines", template_docs=linededup.MIN_DOCS)
    word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    emptied = (F.col("_lines.n_dropped") > 0) & ~word
    kept = done.where(~emptied | (F.col("_lines.n_alike") > 0)).withColumn("text", F.when(emptied, F.col("_whole")).otherwise(F.col("text")))
    return kept.select(*docs.columns).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    few_at_once(spark, LISTED_AT_ONCE)
    return neardup.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    few_at_once(spark)
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token counts, and digests of their ids and of the text decoded from them."""
    few_at_once(spark)
    return pieces.token_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", token_stage),
]

#: SQL has neither the learned scores of the first stage nor the tokens of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
