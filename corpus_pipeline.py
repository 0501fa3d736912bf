"""From raw documents to packed training sequences.

Five stages, each one operator over all that its predecessor kept: documents
without a language go, one document of each near-duplicate group stays,
strings of 200 bytes that occur again are cut out of the texts, secrets are
replaced by their kind, and the rest is packed into sequences. All stages but
the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.llm import langid, packing, secrets, setsketch, suffix_dedup
from helioframe.llm.common import Scratch
from helioframe.llm.queries import tokenizer_file


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the text has them now."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


#: The columns that stages work on; all others are carried along under names that no operator uses.
WORKED_ON = ("doc_id", "text", "lang", "source", "n_chars")


def _carried(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on the documents, whatever their other columns are called."""
    names = {c: c if c in WORKED_ON else f"carried_column_{i}" for i, c in enumerate(docs.columns)}
    out = work(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _carried(docs, langid.accepted)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _carried(docs, lambda d: setsketch.deduplicated(d, words=5, percent=80))


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _carried(docs, lambda d: _counted(suffix_dedup.without_repeats(d, length=200)))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _carried(docs, lambda d: _counted(secrets.redact(d)))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", repeat_removal),
    ("secret_scan", secret_redaction),
    ("packing", sequence_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet and read again by the next."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        done, docs = docs, scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.drop(done)
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot express the language field, the tokenizer or the packing.
ORACLE_SQL = None
