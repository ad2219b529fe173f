"""What the operators share: reading tables, written intermediate tables, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.plans.warehouse import settle
from cardwarden.session import scratch

# The white space between words, as a character class and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the folder all executors share and read back.

    It cuts the lineage, so that a lost executor costs a reread and not a recomputation, and
    it fixes what was computed once for all who read it.
    """
    return settle(df, scratch(df.sparkSession, f"llm-{purpose}"))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_array(text: Column) -> Column:
    """Words of a text; an empty array for an empty text, NULL for NULL."""
    trimmed = F.btrim(text, F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, f"{SPACE_CLASS}+"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD_CLASS}+")), F.lit(0)).cast("long")
