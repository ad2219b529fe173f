"""Every registered query against its SQL, and the counts FIXTURES.md lists."""

import pytest

import __spark_entry__ as entry
from cardwarden import schemas
from cardwarden.operators.incremental import insert_new
from cardwarden.operators.scd1 import snapshot_diff
from cardwarden.testbed import views
from cardwarden.testbed.queries import QUERIES
from tests.oracle_check import compare, duck

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, SMALL, name) == ""


def test_entry_counts_both_rules(spark):
    result = entry.entry(spark)
    assert result.columns == schemas.REPORT.columns
    assert result.count() == 2392 + 1580


@pytest.mark.parametrize(
    ("name", "rows"),
    [
        ("fraud_expired_contract", 22006),
        ("fraud_passport_literal", 14839),
        ("fraud_passport_intended", 15821),
    ],
)
def test_fraud_counts(spark, name, rows):
    assert entry.queries()[name](spark, MIDDLE).count() == rows


def test_passport_events_without_full_name(spark):
    events = entry.queries()["fraud_passport_literal"](spark, MIDDLE)
    assert events.where("fio is null").count() == 2087


@pytest.mark.parametrize(("sf_dir", "rows"), [(SMALL, 2623), (MIDDLE, 25688)])
def test_new_transaction_counts(spark, sf_dir, rows):
    lines = views.transactions(spark, sf_dir)
    number = "cast(substring_index(trans_id, '-', -1) as int)"
    batch = lines.where(f"{number} >= 4")
    held = lines.where(f"cast(card_num as bigint) % 2 = 0 and {number} <= 5")
    assert insert_new(batch, held, "trans_id").count() == rows


def test_null_counts_leave_out_no_row(spark):
    rows = entry.queries()["dq_null_keys_whole"](spark, MIDDLE).collect()
    found = {(r.table_name, r.column_name): r.n_nulls for r in rows}
    people = [r.c_custkey for r in views.load(spark, MIDDLE, "customer").select("c_custkey").collect()]
    plastic = [r.o_orderkey for r in views.load(spark, MIDDLE, "orders").select("o_orderkey").collect()]
    assert found["dim_clients", "update_dt"] == found["dim_accounts", "update_dt"] == len(people)
    assert found["dim_cards", "update_dt"] == len(plastic)
    assert found["dim_clients", "patronymic"] == sum(k % 7 == 0 for k in people)
    assert found["dim_accounts", "client"] == sum(k % 7 == 0 for k in people)
    assert found["dim_cards", "account_num"] == sum(k % 7 == 0 for k in plastic)


def test_terminal_changes(spark):
    dim, snapshot = views.snapshots(spark, MIDDLE)["dim_terminals"]
    changes = snapshot_diff(dim, snapshot, schemas.TERMINALS).groupBy("change").count()
    assert dict(changes.collect()) == {"I": 9, "D": 7, "U": 24}
