"""The training-data pipeline: documents to packed sequences, one written table per stage.

Each stage takes what its predecessor kept and calls one operator of ``cardwarden.llm``. All
but the last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm import language_id, mixing, packing, simhash, suffix_dedup
from cardwarden.llm.common import table, written

_BATCH_ROWS = "500"

# Not expressible in SQL: trained machines, seeded draws, a tokenizer. Tested by brute force.
ORACLE_SQL = None


def _keeping(docs: DataFrame, used: tuple[str, ...], operate) -> DataFrame:
    """What ``operate`` leaves of the used columns, with all others as they were.

    Operators add columns of their own, which must not meet further columns of the table. So
    these pass as one struct, under a name the table does not have.
    """
    used = tuple(name for name in used if name in docs.columns)
    others = [name for name in docs.columns if name not in used]
    rest = "rest"
    while rest in docs.columns:
        rest += "_"
    held = [F.struct(*(F.col(f"`{name}`") for name in others)).alias(rest)] if others else []
    left = operate(docs.select(*used, *held))
    return left.select(
        *(F.col(f"`{name}`" if name in used else f"{rest}.`{name}`").alias(name) for name in docs.columns)
    )


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go."""
    return language_id.keep_known(docs, language_id.train(docs))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    judged = simhash.near_duplicates(simhash.fingerprints(docs))
    return _keeping(docs, ("doc_id", "text"), lambda used: simhash.one_of_each(used, judged))


def stage_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur before are cut out; text and length change, no other column."""
    return _keeping(docs, ("doc_id", "text", "n_chars"), suffix_dedup.without_repeats)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy in the mix: none, one or two of each document."""
    used = ("doc_id", "text", "source")
    return _keeping(docs, used, lambda rows: mixing.mixed(mixing.draws(rows)))


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces with their ids, in 16 bits each, and their places in the sequences."""
    return packing.pack(packing.pieces(docs, with_ids=True), widen=False)


def _in_small_batches(stage):
    """The stage with few documents at a time handed to Python, which bounds what a task holds."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    (name, _in_small_batches(stage))
    for name, stage in (
        ("language", stage_language),
        ("near_duplicates", stage_near_duplicates),
        ("repeats", stage_repeats),
        ("mix", stage_mix),
        ("pack", stage_pack),
    )
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
