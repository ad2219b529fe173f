"""Pulls of the bank's tables: ranges, the pushed trim, one snapshot. No database is at hand,
so the text sent to it is tested, and the ranges are run by DuckDB."""

import duckdb
import pytest

from cardwarden.sources import bank

KEYS = ["", "a", "a'b", "aa", "b", "B", "Z", "zz", "ключ", "00", "7", None, None]


@pytest.mark.parametrize(
    "bounds", [[], [None], ["b"], ["b", "b", "a"], ["a'b", "Z", "ключ"], [None, "0", "zzz"]]
)
def test_ranges_hold_every_key_once(bounds):
    with duckdb.connect() as connection:
        connection.execute("create table t (k varchar)")
        connection.executemany("insert into t values (?)", [[key] for key in KEYS])
        found = []
        for predicate in bank.range_predicates("k", bounds):
            # DuckDB compares byte by byte by itself.
            plain = predicate.replace(' collate "C"', "")
            found += [row[0] for row in connection.execute(f"select k from t where {plain}").fetchall()]
    assert sorted(found, key=str) == sorted(KEYS, key=str)
    distinct = {bound for bound in bounds if bound is not None}
    assert len(bank.range_predicates("k", bounds)) == len(distinct) + 1


def test_sampled_bounds_part_the_keys_evenly():
    query = bank.bounds_query("accounts", 4, 10)
    assert "tablesample system (10)" in query and "0.250000, 0.500000, 0.750000" in query
    with duckdb.connect() as connection:
        connection.execute("create schema info")
        connection.execute(
            "create table info.accounts as select lpad(i::varchar, 6, '0') as account from range(100000) t(i)"
        )
        plain = query.replace(' collate "C"', "").replace("percentile_disc(array[", "quantile_disc([")
        plain = plain.replace("quantile_disc([0.250000, 0.500000, 0.750000]) within group (order by account)",
                              "quantile_disc(account, [0.25, 0.5, 0.75])")
        plain = plain.replace("tablesample system (10)", "tablesample system (10 percent)")
        bounds = connection.execute(plain).fetchone()[0]
        counts = [
            connection.execute(
                "select count(*) from info.accounts where " + predicate.replace(' collate "C"', "")
            ).fetchone()[0]
            for predicate in bank.range_predicates("account", bounds)
        ]
    assert len(counts) == 4 and sum(counts) == 100_000


def test_the_bank_takes_the_padding_off():
    assert bank.pulled_rows("cards") == (
        "(select trim(card_num) as card_num, account, create_dt, update_dt from info.cards) as cards"
    )
    # The bounds are those of the bare numbers the ranges are compared with.
    assert "select trim(card_num) as card_num from info.cards" in bank.bounds_query("cards", 8)
    for name, (_, columns, key) in bank.BANK_TABLES.items():
        assert key in [column.split()[-1] for column in columns], name


class Connection:
    """What a pull asks of a database connection."""

    def __init__(self):
        self.told = []

    def cursor(self):
        return self

    def execute(self, statement):
        self.told.append(statement)

    def fetchone(self):
        return ("0003-1B-1",)

    def close(self):
        self.told.append("close")

    def rollback(self):
        self.told.append("rollback")


def test_one_snapshot_for_all_connections():
    connection = Connection()
    with pytest.raises(RuntimeError), bank.exported_snapshot(connection) as snapshot:
        assert connection.told[-1] == "select pg_export_snapshot()"
        told = bank.snapshot_option(snapshot)["sessionInitStatement"]
        assert told.endswith("set transaction snapshot '0003-1B-1'")
        assert "repeatable read" in told and "repeatable read" in connection.told[0]
        raise RuntimeError("a pull failed")
    assert connection.told[-2:] == ["rollback", "close"]
    assert bank.snapshot_option(None) == {}
