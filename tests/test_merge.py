"""Insert-only load and dimension merge against brute force over small tables."""

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cardwarden import schemas
from cardwarden.operators.incremental import insert_new, insert_new_in_order
from cardwarden.operators.scd1 import scd1_merge, snapshot_diff

OLD, NOW = dt.date(2021, 2, 1), dt.date(2021, 3, 1)
FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
KEYS = st.one_of(st.none(), st.sampled_from("abcde"))


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def accounts(spark, rows):
    return spark.createDataFrame(rows, schemas.ACCOUNTS.schema)


@FEW
@given(batch=st.lists(KEYS, max_size=8), target=st.lists(KEYS, max_size=8))
def test_insert_new(spark, batch, target):
    rows = list(enumerate(batch))
    got = insert_new(
        spark.createDataFrame(rows, "n int, k string"),
        spark.createDataFrame([(k,) for k in target], "k string"),
        "k",
    )
    assert bag(got) == Counter(r for r in rows if r[1] is None or r[1] not in target)


def test_insert_new_keeps_duplicates_and_unkeyed_rows(spark):
    rows = [("x", 1), ("x", 2), (None, 3), (None, 4), ("y", 5)]
    batch = spark.createDataFrame(rows, "k string, n int")
    target = spark.createDataFrame([("y",), (None,)], "k string")
    first = insert_new(batch, target, "k")
    assert sorted(r.n for r in first.collect()) == [1, 2, 3, 4]
    again = insert_new(batch, target.unionByName(first.select("k")), "k")
    assert sorted(r.n for r in again.collect()) == [3, 4]


def test_first_listing_of_a_passport_wins(spark):
    held = spark.createDataFrame([(OLD, "p")], schemas.BLACKLIST.schema)
    batch = spark.createDataFrame([(NOW, "p"), (NOW, "q")], schemas.BLACKLIST.schema)
    assert bag(insert_new(batch, held, "passport_num")) == {(NOW, "q"): 1}


@FEW
@given(loads=st.lists(st.tuples(KEYS, st.integers(1, 3)), max_size=10))
def test_loads_in_order_equal_one_by_one(spark, loads):
    rows = [(k, load, n) for n, (k, load) in enumerate(loads)]
    df = spark.createDataFrame(rows, "k string, load int, n int")
    kept = []
    for load in (1, 2, 3):
        known = {k for k, _, _ in kept}
        kept += [r for r in rows if r[1] == load and (r[0] is None or r[0] not in known)]
    got = insert_new_in_order(df, "k", "load").select("k", "load", "n")
    assert bag(got) == Counter(kept)


def merge_by_hand(dim, snapshot):
    merged = {}
    new = {r[0]: r for r in snapshot}
    for key, valid_to, client, created, updated in dim:
        if key in new:
            _, new_valid, new_client, _, _ = new[key]
            changed = (new_valid, new_client) != (valid_to, client)
            merged[key] = (key, new_valid, new_client, created, NOW if changed else updated)
    return Counter({**{k: r for k, r in new.items() if k not in merged}, **merged}.values())


ROWS = st.dictionaries(
    st.sampled_from("abcdef"),
    st.tuples(
        st.one_of(st.none(), st.sampled_from([dt.date(2022, 1, 1), dt.date(2023, 1, 1)])),
        st.one_of(st.none(), st.sampled_from(["x", "y"])),
    ),
)


@FEW
@given(dim=ROWS, snapshot=ROWS)
def test_merge(spark, dim, snapshot):
    old = [(k, *v, OLD, None) for k, v in dim.items()]
    new = [(k, *v, dt.date(2021, 2, 20), dt.date(2021, 2, 21)) for k, v in snapshot.items()]
    dim_df, new_df = accounts(spark, old), accounts(spark, new)
    merged = scd1_merge(dim_df, new_df, schemas.ACCOUNTS, NOW)
    assert bag(merged) == merge_by_hand(old, new)
    again = scd1_merge(merged, new_df, schemas.ACCOUNTS, dt.date(2021, 3, 2))
    assert bag(again) == bag(merged)
    diff = snapshot_diff(dim_df, new_df, schemas.ACCOUNTS)
    changes = dict(diff.groupBy("change").count().collect())
    assert changes.get("I", 0) == len(snapshot.keys() - dim.keys())
    assert changes.get("D", 0) == len(dim.keys() - snapshot.keys())
    assert changes.get("U", 0) == sum(dim[k] != snapshot[k] for k in dim.keys() & snapshot.keys())


def test_only_dates_differ(spark):
    dim = accounts(spark, [("a", None, "x", OLD, None)])
    snapshot = accounts(spark, [("a", None, "x", NOW, NOW)])
    assert bag(scd1_merge(dim, snapshot, schemas.ACCOUNTS, NOW)) == bag(dim)


def test_rows_without_a_key(spark):
    dim = accounts(spark, [(None, None, "old", OLD, None), ("gone", None, "x", OLD, None)])
    snapshot = accounts(spark, [(None, None, "new", NOW, None)] * 2)
    merged = scd1_merge(dim, snapshot, schemas.ACCOUNTS, NOW)
    assert bag(merged) == {
        (None, None, "old", OLD, None): 1,
        (None, None, "new", NOW, None): 2,
    }
    assert [r.change for r in snapshot_diff(dim, snapshot, schemas.ACCOUNTS).collect()] == [
        "D",
        "I",
        "I",
    ]


def test_empty_snapshot_deletes_everything(spark):
    dim = accounts(spark, [("a", None, "x", OLD, None)])
    assert scd1_merge(dim, accounts(spark, []), schemas.ACCOUNTS, NOW).count() == 0


def test_repeated_snapshot_key_fails(spark):
    snapshot = accounts(spark, [("a", None, "x", OLD, None), ("a", None, "y", OLD, None)])
    with pytest.raises(Exception, match="repeats key a"):
        scd1_merge(accounts(spark, []), snapshot, schemas.ACCOUNTS, NOW).collect()
