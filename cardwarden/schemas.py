"""Declared schemas: column types, text lengths, keys and change-tracked attributes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """One warehouse table. ``limits`` holds the longest text each column may carry."""

    name: str
    schema: T.StructType
    limits: dict[str, int]
    key: str | None = None
    tracked: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _table(name: str, columns: list[tuple], key: str | None = None, tracked: tuple = ()) -> Table:
    """Columns are (name, length) for text and (name, type) for anything else."""
    fields, limits = [], {}
    for column, kind in columns:
        if isinstance(kind, int):
            limits[column] = kind
            kind = T.StringType()
        fields.append(T.StructField(column, kind))
    return Table(name, T.StructType(fields), limits, key, tracked)


DATE = T.DateType()
MONEY = T.DecimalType(18, 2)
STAMPS = [("create_dt", DATE), ("update_dt", DATE)]

# Table layouts and text lengths of the warehouse.
TRANSACTIONS = _table(
    "fact_transactions",
    [
        ("trans_id", 11),
        ("trans_date", DATE),
        ("card_num", 20),
        ("oper_type", 8),
        ("amt", MONEY),
        ("oper_result", 7),
        ("terminal", 5),
    ],
    key="trans_id",
)
BLACKLIST = _table(
    "fact_passport_blacklist", [("entry_dt", DATE), ("passport_num", 11)], key="passport_num"
)
TERMINALS = _table(
    "dim_terminals",
    [("terminal_id", 5), ("terminal_type", 3), ("terminal_city", 40), ("terminal_address", 200)]
    + STAMPS,
    key="terminal_id",
    tracked=("terminal_type", "terminal_city", "terminal_address"),
)
CLIENTS = _table(
    "dim_clients",
    [
        ("client_id", 8),
        ("last_name", 50),
        ("first_name", 50),
        ("patronymic", 50),
        ("date_of_birth", DATE),
        ("passport_num", 11),
        ("passport_valid_to", DATE),
        ("phone", 16),
    ]
    + STAMPS,
    key="client_id",
    tracked=(
        "last_name",
        "first_name",
        "patronymic",
        "date_of_birth",
        "passport_num",
        "passport_valid_to",
        "phone",
    ),
)
ACCOUNTS = _table(
    "dim_accounts",
    [("account_num", 20), ("valid_to", DATE), ("client", 8)] + STAMPS,
    key="account_num",
    tracked=("valid_to", "client"),
)
CARDS = _table(
    "dim_cards",
    [("card_num", 20), ("account_num", 20)] + STAMPS,
    key="card_num",
    tracked=("account_num",),
)
REPORT = _table(
    "rep_fraud",
    [
        ("event_dt", DATE),
        ("passport", 11),
        ("fio", 150),
        ("phone", 16),
        ("event_type", 1),
        ("report_dt", DATE),
    ],
)

# Column order of the transaction file, whose header names are ignored.
TRANSACTION_FILE = (
    "trans_id",
    "trans_date",
    "amt",
    "card_num",
    "oper_type",
    "oper_result",
    "terminal",
)
# Raw lines refused by a run that keeps rejects, with the columns at fault.
REJECTS = _table(
    "rejected_transactions",
    [(column, T.StringType()) for column in TRANSACTION_FILE]
    + [(column, T.StringType()) for column in ("malformed_line", "source_file", "problems")],
)

FACTS = (TRANSACTIONS, BLACKLIST)
DIMENSIONS = (TERMINALS, CLIENTS, ACCOUNTS, CARDS)

# Workbook sheets and their columns in order.
BLACKLIST_SHEET = ("blacklist", ("entry_dt", "passport_num"))
TERMINALS_SHEET = (
    "terminals",
    ("terminal_id", "terminal_type", "terminal_city", "terminal_address"),
)
