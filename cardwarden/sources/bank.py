"""Full pulls of the bank's client, account and card tables over JDBC.

The three tables are pulled by many connections, each a key range of one table. All of them
can read one exported snapshot of the database, so that no account is seen without its
client and no row moves between two ranges while they are read. Any DataFrame with the
bank's columns serves the later operators just as well. Written for PostgreSQL.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# The bank's tables, their columns in order, and the key a pull is split on.
# Card numbers are padded with spaces, which the bank takes off before it sends them.
BANK_TABLES = {
    "clients": (
        "info.clients",
        (
            "client_id",
            "last_name",
            "first_name",
            "patronymic",
            "date_of_birth",
            "passport_num",
            "passport_valid_to",
            "phone",
            "create_dt",
            "update_dt",
        ),
        "client_id",
    ),
    "accounts": (
        "info.accounts",
        ("account", "valid_to", "client", "create_dt", "update_dt"),
        "account",
    ),
    "cards": (
        "info.cards",
        ("trim(card_num) as card_num", "account", "create_dt", "update_dt"),
        "card_num",
    ),
}
# Share of a table's pages that is sampled for its key ranges.
SAMPLE_PERCENT = 1


def pulled_rows(name: str) -> str:
    """The listed columns of a bank table, as the subquery a pull reads from."""
    table, columns, _ = BANK_TABLES[name]
    return f"(select {', '.join(columns)} from {table}) as {name}"


def bounds_query(name: str, slices: int, percent: float = SAMPLE_PERCENT) -> str:
    """One row with ``bounds``: the keys that part a sample into even slices.

    The sample takes whole pages, so its cost does not grow with the rows it skips.
    """
    table, columns, key = BANK_TABLES[name]
    listed = next(c for c in columns if c.split()[-1] == key)
    shares = ", ".join(f"{at / slices:.6f}" for at in range(1, slices))
    return (
        f"select percentile_disc(array[{shares}]) within group (order by {_ordered(key)}) as bounds"
        f" from (select {listed} from {table} tablesample system ({percent})) as sampled"
        f" where {key} is not null"
    )


def range_predicates(key: str, bounds: Sequence[str | None]) -> list[str]:
    """One WHERE clause per concurrent pull: ranges that meet and leave out no key.

    Keys that part the sample more than once give one range. Rows with a NULL key are in no
    range, so the first slice takes them as well.
    """
    cuts = sorted({bound for bound in bounds if bound is not None}, key=str.encode)
    column = _ordered(key)
    quoted = ["'" + cut.replace("'", "''") + "'" for cut in cuts]
    if not quoted:
        return [f"{column} is not null or {key} is null"]
    between = [
        f"{column} >= {low} and {column} < {high}" for low, high in zip(quoted, quoted[1:])
    ]
    return [
        f"{column} < {quoted[0]} or {key} is null", *between, f"{column} >= {quoted[-1]}"
    ]


def read_bank_table(
    spark: SparkSession,
    name: str,
    url: str,
    properties: dict[str, str],
    slices: int = 32,
    snapshot: str | None = None,
) -> DataFrame:
    """One bank table, pulled by up to ``slices`` tasks; only the listed columns are sent.

    ``snapshot`` is the id of an exported snapshot that every connection reads.
    """
    options = {"fetchsize": "10000", **properties, **snapshot_option(snapshot)}
    key = BANK_TABLES[name][2]
    asked = {"url": url, "query": bounds_query(name, slices), **options}
    sampled = spark.read.format("jdbc").options(**asked).load().first() if slices > 1 else None
    bounds = sampled.bounds if sampled else None
    return spark.read.jdbc(
        url,
        pulled_rows(name),
        predicates=range_predicates(key, bounds or ()),
        properties=options,
    )


def snapshot_option(snapshot: str | None) -> dict[str, str]:
    """What a connection runs before it reads: take over the snapshot another one exported."""
    if snapshot is None:
        return {}
    quoted = snapshot.replace("'", "''")
    return {
        "sessionInitStatement": "set transaction isolation level repeatable read, read only;"
        f" set transaction snapshot '{quoted}'"
    }


@contextmanager
def exported_snapshot(connection) -> Iterator[str]:
    """Id of a snapshot that others can read while the block is open.

    ``connection`` is a DB-API connection to the bank; its transaction is kept open for as
    long as tables are pulled, and changes nothing.
    """
    cursor = connection.cursor()
    try:
        cursor.execute("set transaction isolation level repeatable read, read only")
        cursor.execute("select pg_export_snapshot()")
        yield cursor.fetchone()[0]
    finally:
        connection.rollback()
        cursor.close()


def _ordered(key: str) -> str:
    """The key compared byte by byte, whatever the language of the database."""
    return f'{key} collate "C"'
