"""The provided Parquet tables seen as warehouse tables (see FIXTURES.md).

The ``all_`` views hold every row and serve the staging queries. In the others, remainders
leave out or change some keys on one side, so that inserts, updates, deletes and orphans occur.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_DT = date(2021, 3, 1)
REPORT_DT = date(2021, 3, 3)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def no_day() -> Column:
    return F.lit(None).cast("date")


def day_after(start: date, days: str) -> Column:
    return F.date_add(F.lit(start), F.expr(days).cast("int"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.concat(text("l_orderkey"), F.lit("-"), text("l_linenumber")).alias("trans_id"),
        F.col("l_shipdate").cast("date").alias("trans_date"),
        text("l_orderkey").alias("card_num"),
        F.col("l_returnflag").alias("oper_type"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amt"),
        F.col("l_linestatus").alias("oper_result"),
        F.concat(F.lit("T"), text("l_suppkey")).alias("terminal"),
    )


def all_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("card_num"),
        text("o_custkey").alias("account_num"),
        F.col("o_orderdate").cast("date").alias("create_dt"),
        no_day().alias("update_dt"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_cards(spark, sf_dir).where(f"{_number('card_num')} % 97 <> 0")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        text("c_custkey").alias("account_num"),
        F.when(
            F.expr("c_custkey % 10 <> 0"), day_after(date(1996, 1, 1), "(c_custkey * 37) % 2200")
        ).alias("valid_to"),
        F.concat(F.lit("C"), text("c_custkey")).alias("client"),
        F.lit(date(1995, 1, 1)).alias("create_dt"),
        no_day().alias("update_dt"),
    )


def all_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), text("c_custkey")).alias("client_id"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.when(
            F.expr("c_custkey % 7 <> 0"), F.concat(F.lit("N"), text("c_nationkey"))
        ).alias("patronymic"),
        day_after(date(1950, 1, 1), "(c_custkey * 13) % 15000").alias("date_of_birth"),
        F.concat(F.lit("P"), text("c_custkey")).alias("passport_num"),
        F.when(
            F.expr("c_custkey % 5 <> 0"), day_after(date(1996, 6, 1), "(c_custkey * 53) % 2500")
        ).alias("passport_valid_to"),
        F.concat(F.lit("+7"), text("c_custkey")).alias("phone"),
        F.lit(date(1995, 1, 1)).alias("create_dt"),
        no_day().alias("update_dt"),
    )


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_clients(spark, sf_dir).where(f"{_number('client_id')} % 89 <> 0")


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt; every second one is listed twice."""
    in_debt = load(spark, sf_dir, "customer").where("c_acctbal < 0")
    passport = F.concat(F.lit("P"), text("c_custkey")).alias("passport_num")
    first = day_after(date(1997, 1, 1), "(c_custkey * 29) % 1500")
    again = day_after(date(1999, 1, 1), "(c_custkey * 31) % 700")
    return in_debt.select(first.alias("entry_dt"), passport).unionByName(
        in_debt.where("c_custkey % 2 = 0").select(again.alias("entry_dt"), passport)
    )


def terminals_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").where("s_suppkey % 11 <> 0").select(
        F.concat(F.lit("T"), text("s_suppkey")).alias("terminal_id"),
        F.when(F.expr("s_suppkey % 2 = 0"), "ATM").otherwise("POS").alias("terminal_type"),
        F.concat(F.lit("CITY_"), text("s_nationkey")).alias("terminal_city"),
        F.col("s_name").alias("terminal_address"),
        F.lit(date(2021, 2, 28)).alias("create_dt"),
        no_day().alias("update_dt"),
    )


def all_terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").select(
        F.concat(F.lit("T"), text("s_suppkey")).alias("terminal_id"),
        F.when(F.expr("s_suppkey % 3 <> 0 and s_suppkey % 2 = 0"), "ATM")
        .otherwise("POS")
        .alias("terminal_type"),
        F.when(F.expr("s_suppkey % 7 <> 0"), F.concat(F.lit("CITY_"), text("s_nationkey"))).alias(
            "terminal_city"
        ),
        F.col("s_name").alias("terminal_address"),
        F.lit(RUN_DT).alias("create_dt"),
        no_day().alias("update_dt"),
    )


def terminals_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_terminals(spark, sf_dir).where(f"{_number('terminal_id')} % 13 <> 0")


def before(whole: DataFrame, key: str) -> DataFrame:
    """A dimension some keys of the snapshot have not reached yet."""
    return whole.where(f"{_number(key)} % 11 <> 0")


def after(whole: DataFrame, key: str, changed: str, emptied: str) -> DataFrame:
    """Its next snapshot: some keys gone, one attribute changed, one emptied."""
    return altered(whole.where(f"{_number(key)} % 13 <> 0"), key, changed, emptied)


def altered(whole: DataFrame, key: str, changed: str, emptied: str) -> DataFrame:
    """Every row, one attribute changed and one emptied for some keys."""
    moved = dict(whole.dtypes)[changed] == "date"
    value = F.date_add(changed, 30) if moved else F.concat(changed, F.lit("x"))
    third, not_seventh = (F.expr(f"{_number(key)} % {test}") for test in ("3 = 0", "7 <> 0"))
    return (
        whole.withColumn(changed, F.when(third, value).otherwise(F.col(changed)))
        .withColumn(emptied, F.when(not_seventh, F.col(emptied)))
        .withColumn("create_dt", F.lit(RUN_DT))
    )


def _number(key: str) -> str:
    """The number inside a key such as C17."""
    return f"cast(ltrim('CT', {key}) as bigint)"


def snapshots(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Every dimension as it stands, and the snapshot that comes next."""
    people, contracts, plastic = (view(spark, sf_dir) for view in (clients, accounts, cards))
    return {
        "dim_terminals": (terminals_before(spark, sf_dir), terminals_after(spark, sf_dir)),
        "dim_clients": (
            before(people, "client_id"),
            after(people, "client_id", "passport_valid_to", "patronymic"),
        ),
        "dim_accounts": (
            before(contracts, "account_num"),
            after(contracts, "account_num", "valid_to", "client"),
        ),
        "dim_cards": (
            before(plastic, "card_num"),
            after(plastic, "card_num", "account_num", "account_num"),
        ),
    }


def whole_snapshots(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The next snapshots of clients, accounts and cards with every row of the tables."""
    people, contracts, plastic = (view(spark, sf_dir) for view in (all_clients, accounts, all_cards))
    return {
        "dim_clients": altered(people, "client_id", "passport_valid_to", "patronymic"),
        "dim_accounts": altered(contracts, "account_num", "valid_to", "client"),
        "dim_cards": altered(plastic, "card_num", "account_num", "account_num"),
    }


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions with the number of the load that brings them."""
    return transactions(spark, sf_dir).withColumn("load", load_of(F.col("trans_date")))


def load_of(day: Column) -> Column:
    """Three loads that share out all transactions by day."""
    first, second = day < F.lit(date(1997, 1, 1)), day < F.lit(date(1999, 1, 1))
    return F.when(first, 1).when(second, 2).otherwise(3)
