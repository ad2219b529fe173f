"""Checks on what the tables promise but do not enforce: keys, references, text lengths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.operators.staging import too_long
from cardwarden.schemas import Table


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    return counted.where("n_rows > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with its number of NULLs, from a single pass."""
    totals = df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    return totals.unpivot([], columns, "column_name", "n_nulls")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values of a reference that the parent lacks, with the number of rows holding them.

    Counting first leaves one row per value to join, however often a value repeats.
    """
    used = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("missing_key"))
        .agg(F.count("*").alias("n_rows"))
    )
    return used.join(
        parent.select(F.col(parent_key).alias("missing_key")), "missing_key", "left_anti"
    )


def overlength(df: DataFrame, table: Table) -> DataFrame:
    """Longest text and number of over-long values per text column, from a single pass."""
    names = [name for name in table.columns if name in table.limits]
    measured = df.agg(
        *(F.coalesce(F.max(F.length(F.rtrim(n))), F.lit(0)).alias(f"longest_{n}") for n in names),
        *(F.count_if(too_long(F.col(n), table.limits[n])).alias(f"over_{n}") for n in names),
    )
    rows = [
        F.struct(
            F.lit(n).alias("column_name"),
            F.lit(table.limits[n]).alias("max_length"),
            F.col(f"longest_{n}").alias("longest"),
            F.col(f"over_{n}").alias("n_over"),
        )
        for n in names
    ]
    return measured.select(F.inline(F.array(*rows)))


def all_orphans(
    transactions: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame
) -> DataFrame:
    """Every broken reference on the way from a transaction to its client."""
    checks = [
        ("transactions.card_num", orphans(transactions, "card_num", cards, "card_num")),
        ("cards.account_num", orphans(cards, "account_num", accounts, "account_num")),
        ("accounts.client", orphans(accounts, "client", clients, "client_id")),
    ]
    return reduce(
        DataFrame.unionByName,
        (found.withColumn("reference", F.lit(reference)) for reference, found in checks),
    )
