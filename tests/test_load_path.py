"""The load of a batch: what it shuffles and writes, and that the short ways give the same rows."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.functions.parsing import load_order
from cardwarden.operators import incremental
from cardwarden.operators.incremental import (
    LOAD_ORDER,
    insert_new,
    insert_new_in_order,
    possible_matches,
)
from cardwarden.plans import nightly
from cardwarden.plans.nightly import new_rows
from cardwarden.plans.warehouse import Warehouse
from cardwarden.testbed import queries

DAY = dt.date(2021, 3, 1)


def bag(df):
    return Counter(tuple(row) for row in df.collect())


def facts(spark, keys, load_order=None):
    rows = [(key, DAY, f"c{at}", "PAYMENT", None, "SUCCESS", "T1") for at, key in enumerate(keys)]
    df = spark.createDataFrame(rows, schemas.TRANSACTIONS.schema)
    return df if load_order is None else df.withColumn(LOAD_ORDER, load_order)


@pytest.fixture
def run(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "dwh")).begin("a")


@pytest.fixture
def hold(spark, tmp_path):
    def written(name, rows):
        rows.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    return written


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_file_into_an_empty_warehouse_is_neither_shuffled_nor_written_twice(spark, run):
    feed = facts(spark, ["1", "1", None, "2"], F.lit(""))
    known = run.warehouse.table(schemas.TRANSACTIONS)
    fresh = new_rows(run, schemas.TRANSACTIONS, feed, known)
    assert "hashpartitioning" not in plan(fresh) and "SortMergeJoin" not in plan(fresh)
    assert bag(fresh.select("trans_id")) == {("1",): 2, ("2",): 1, (None,): 1}
    staged = f"{run.warehouse.root}/_staging/a/{run.attempt}"
    rows = [name for name in os.listdir(staged) if "card_num" in spark.read.parquet(f"{staged}/{name}").columns]
    assert rows == [schemas.TRANSACTIONS.name]


@pytest.mark.parametrize("many_rows", [1, 1_000_000])
def test_several_files_against_held_rows(spark, run, monkeypatch, many_rows):
    monkeypatch.setattr(nightly, "MANY_ROWS", many_rows)
    draw = random.Random(7)
    keys = [draw.choice([None, *map(str, range(900))]) for _ in range(1500)]
    feed = facts(spark, keys).withColumn(LOAD_ORDER, F.substring("card_num", 2, 9).cast("int") % 5)
    known = facts(spark, [None, *(str(n) for n in range(0, 1200, 3)), "3"])
    got = new_rows(run, schemas.TRANSACTIONS, feed, known)
    first = {}
    for at, key in enumerate(keys):
        first[key] = min(first.get(key, 9), at % 5)
    kept = [
        (f"c{at}",) for at, key in enumerate(keys)
        if key is None or int(key) % 3 and first[key] == at % 5
    ]
    assert bag(got.select("card_num")) == Counter(kept)


def test_rows_of_keys_no_two_files_bring_are_not_shuffled(spark, hold, tmp_path):
    rows = [(f"k{n}", n % 3, n) for n in range(300)]
    spark.createDataFrame(rows, "k string, o int, n int").write.parquet(f"{tmp_path}/rows")
    batch = spark.read.parquet(f"{tmp_path}/rows")
    kept = insert_new_in_order(batch, "k", "o", hold)
    assert "Exchange hashpartitioning" not in plan(kept) and kept.count() == 300
    assert hold("copy", kept).count() == spark.read.parquet(f"{tmp_path}/rows").count()


def test_order_by_held_keys_equals_the_plain_order(spark, hold):
    draw = random.Random(3)
    rows = [
        (draw.choice([None, *"abcdefgh"]), draw.choice([None, 1, 2, 3]) if n % 2 else 1, n)
        for n in range(200)
    ]
    rows += [("z", None, 1000), ("y", 4, 1001), ("y", 4, 1002)]
    batch = spark.createDataFrame(rows, "k string, o int, n int")
    assert bag(insert_new_in_order(batch, "k", "o", hold)) == bag(
        insert_new_in_order(batch, "k", "o")
    )


def test_common_keys_of_a_large_batch(spark, hold):
    batch = spark.createDataFrame([("a",), ("a",), (None,), ("b",), ("c",)], "k string")
    target = spark.createDataFrame([("a",), ("c",), ("c",), (None,), ("d",)], "k string")
    got = insert_new(batch, target, "k", hold=hold, many=True)
    assert bag(got) == bag(insert_new(batch, target, "k")) == {("b",): 1, (None,): 1}


def test_a_large_batch_of_few_keys_is_still_found_out(spark, monkeypatch):
    monkeypatch.setattr(incremental, "_FIRST_ROWS", 2)
    target = spark.createDataFrame([(str(n),) for n in range(9)], "k string")
    batch = spark.createDataFrame([("1",), ("1",), ("4",), ("9",)], "k string")
    assert bag(possible_matches(target, batch, "k", many=True)) == {("1",): 1, ("4",): 1}


def test_files_get_the_place_their_name_gives_them(spark):
    names = [
        "transactions_b_02032021.txt", "transactions_a_02032021.txt", "x_transactions_01032021.csv",
        "transactions_03032021.txt", "transactions_a_31122020.txt",
    ]
    rows = spark.createDataFrame([(f"file:/d/{name}",) for name in names], "source_file string")
    placed = nightly._in_load_order(rows, [f"file:/d/{name}" for name in names])
    assert dict(placed.dtypes)[LOAD_ORDER] == "int"
    by_name = placed.orderBy(load_order(F.col("source_file"))).collect()
    assert [row[LOAD_ORDER] for row in by_name] == [0, 1, 2, 3, 4]
    with pytest.raises(Exception, match="not a listed file"):
        nightly._in_load_order(rows, ["file:/d/transactions_03032021.txt"]).collect()


def test_a_larger_table_is_dropped_in_more_files(spark, monkeypatch):
    small = "/root/testdata/sf0.001"
    plain = bag(queries.drop_transactions(spark, small))
    monkeypatch.setattr(queries, "_PART_BYTES", 10_000)
    warehouse = queries._irregular_drop(spark, small)
    names = {file.name for file in warehouse.state().files() if file.name.startswith("transactions_b")}
    size = warehouse.shared.size(f"{small}/lineitem.parquet")
    assert len(names) == 4 + size // 10_000 > 4
    assert bag(warehouse.table(schemas.TRANSACTIONS)) == plain


def test_rows_of_other_loads_are_left_out_before_text_is_made(spark):
    lines = queries.raw_transactions(spark, "/root/testdata/sf0.001", "load").where("load = 1")
    kept = plan(lines).split("Filter", 1)[1]
    assert "date_format" not in kept
