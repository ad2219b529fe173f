"""Delimited files: `;`-separated, header skipped, columns taken by position and as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.schemas import TRANSACTION_FILE

# Everything is read as text: inferring types would strip leading zeros off identifiers.
RAW_SCHEMA = ", ".join(f"{column} string" for column in TRANSACTION_FILE)
# Column that holds a line with the wrong number of fields.
MALFORMED = "malformed_line"
FILE_OPTIONS = {"sep": ";", "header": "true", "enforceSchema": "true"}


def read_transactions(
    spark: SparkSession, paths: str | Sequence[str], keep_malformed: bool = False
) -> DataFrame:
    """Raw transaction lines with the name of the file they came from.

    A line with the wrong number of fields fails the read, or is kept whole in
    ``malformed_line`` for the rejects table.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.options(**FILE_OPTIONS)
    if keep_malformed:
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED).schema(
            f"{RAW_SCHEMA}, {MALFORMED} string"
        )
    else:
        reader = reader.option("mode", "FAILFAST").schema(RAW_SCHEMA)
    return reader.csv(paths).withColumn("source_file", F.col("_metadata.file_name"))


def read_sheet(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of a blacklist or terminal list that comes as delimited text, with its file name.

    A line with the wrong number of fields fails the read.
    """
    schema = ", ".join(f"{column} string" for column in columns)
    reader = spark.read.options(**FILE_OPTIONS, mode="FAILFAST").schema(schema)
    return reader.csv(list(paths)).withColumn("source_file", F.col("_metadata.file_name"))
