"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, secret scans, best-fit packing.

Every stage works on all rows the stage before kept, written as Parquet in the shared folder and read again. All but
the last return the columns of documents; ``n_chars`` follows the text.

* toxicity: rows whose text scores as toxic go; the model learns from the labelled rows of its input.
* line dedup: lines that many documents share stay in one of them; documents stay, if need be with an empty text.
* near-dedup: one document of each group of near copies stays, the one with the smallest id.
* secrets: every span found is replaced by a placeholder; documents stay.
* packing: the token pieces of what is left, placed in sequences.

Cases, at every stage: a null text counts as empty and stays null until packing, where it is one piece of the single id 0;
empty and blank texts are clean, have no lines to drop and no secrets, and share the fingerprint zero, so one of them stays;
very long texts are taken whole; rows without an id take part like others, and in a group of near copies give way to rows
with one; of repeated rows one stays; ties go to the smaller id; texts that share an id but are no copies both stay; an
empty table stays empty. Columns of any name pass through all stages but the last: helper columns are named so that they
differ from all given ones.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.llm import linedup, packing, secrets, simhash, toxicity
from corpweave.llm.common import stored, table
from corpweave.llm.plans import PACKING_VOCABULARY


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train_from(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(linedup.drop_lines(docs))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, simhash.SHINGLE, simhash.DISTANCE)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secrets.redact_secrets(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, Path(PACKING_VOCABULARY).read_text())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: Compression lengths and the rounding of a linear program are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
