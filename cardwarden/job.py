"""The nightly job: spark-submit run_nightly.py --drop DIR --warehouse DIR --bank ...

``--bank`` is a JDBC url, or a folder with clients, accounts and cards as Parquet. User,
password and driver of a JDBC pull come from a JSON file, not from the command line; so may
``snapshot``, the id of an exported snapshot that all connections are to read.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from cardwarden.plans.nightly import run_drop
from cardwarden.plans.warehouse import Warehouse
from cardwarden.session import tune
from cardwarden.sources.bank import BANK_TABLES, read_bank_table


def bank_tables(
    spark: SparkSession, bank: str, properties: dict, slices: int
) -> dict[str, DataFrame]:
    given = dict(properties)
    snapshot = given.pop("snapshot", None)

    def table(name: str) -> DataFrame:
        if bank.startswith("jdbc:"):
            return read_bank_table(spark, name, bank, given, slices, snapshot)
        return spark.read.parquet(f"{bank}/{name}")

    return {name: table(name) for name in BANK_TABLES}


def main(arguments: list[str]) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--drop", required=True, help="folder the daily files arrive in")
    parser.add_argument("--warehouse", required=True, help="root folder of the warehouse")
    parser.add_argument("--bank", required=True, help="JDBC url, or folder of Parquet tables")
    parser.add_argument("--bank-properties", help="JSON file with JDBC properties")
    parser.add_argument("--slices", type=int, default=32, help="concurrent pulls per bank table")
    parser.add_argument("--history", choices=("all", "new"), default="all")
    parser.add_argument("--refuse-empty-snapshots", action="store_true")
    parser.add_argument("--keep-rejects", action="store_true", help="load what can be typed")
    parser.add_argument("--archive", help="folder loaded files are moved to, or the drop folder")
    parser.add_argument("--compact", action="store_true", help="merge small files of the facts")
    parser.add_argument(
        "--keep-states", type=int, help="delete what none of the last so many states refers to"
    )
    given = parser.parse_args(arguments)
    properties = {}
    if given.bank_properties:
        with open(given.bank_properties) as file:
            properties = json.load(file)
    spark = tune(SparkSession.builder.appName("cardwarden").getOrCreate())
    warehouse = Warehouse(spark, given.warehouse)
    ran = run_drop(
        warehouse,
        given.drop,
        bank_tables(spark, given.bank, properties, given.slices),
        given.history,
        not given.refuse_empty_snapshots,
        given.keep_rejects,
        given.archive,
    )
    print("days run:", ", ".join(day.isoformat() for day in ran) or "none, no new files")
    if given.compact:
        print("merged:", ", ".join(warehouse.compact()) or "nothing")
    if given.keep_states is not None:
        print("folders deleted:", warehouse.expire(given.keep_states))
    return 0
