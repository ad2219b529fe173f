"""Plans: what is read, what is shuffled, and that a hot key is split."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.operators.incremental import insert_new, possible_matches
from cardwarden.operators.scd1 import (
    DELETED,
    INSERTED,
    UPDATED,
    _beside,
    scd1_merge,
    snapshot_diff,
)
from cardwarden.plans import fraud
from cardwarden.plans.warehouse import settle
from cardwarden.testbed import views

SMALL = "/root/testdata/sf0.001"
DAY = dt.date(2021, 3, 1)
_VIEWS = (views.transactions, views.cards, views.accounts, views.clients, views.blacklist)
# Thresholds lowered to the size of the test tables.
TINY_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


def plan(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


@pytest.fixture
def tables(spark, tmp_path):
    """The views as Parquet tables, as they lie in the warehouse."""

    def at_rest(name, df):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    return {
        view.__name__: at_rest(view.__name__, view(spark, SMALL))
        for view in _VIEWS
    }


def report(tables):
    rules = fraud.both_rules(tables["clients"], tables["blacklist"])
    watch = fraud.watch_list(tables["cards"], tables["accounts"], rules)
    return fraud.fraud_events(tables["transactions"], watch, views.REPORT_DT)


def test_report_reads_two_fact_columns_once(tables):
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(report(tables)))
    facts = [scan for scan in scans if "trans_date" in scan]
    assert [re.sub(r"#\d+", "", scan) for scan in facts] == ["trans_date,card_num"]


def test_report_shuffles_the_fact_once(tables, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    text = plan(report(tables))
    above_fact = text[: text.index("trans_date")]
    assert above_fact.count("Exchange") == 1
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_small_batch_leaves_the_target_unshuffled(spark, tables, conf, tmp_path):
    conf({"spark.sql.autoBroadcastJoinThreshold": "5KB"})
    rows = spark.createDataFrame([("1-1",), ("x",)], "trans_id string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    text = plan(insert_new(batch, tables["transactions"], "trans_id"))
    semi = text[text.index("LeftSemi") :]
    target = semi[: semi.index("FileScan")]
    assert "BroadcastHashJoin" in text and "Exchange" not in target
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert re.sub(r"#\d+", "", scan) == "trans_id"


def test_merge_shuffles_the_rows_of_each_side_once(spark, tables, conf):
    merged = scd1_merge(tables["clients"], tables["clients"], schemas.CLIENTS, views.RUN_DT)
    small = plan(merged)
    assert "BroadcastHashJoin" in small and small.count("Exchange hashpartitioning") == 1
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    text = plan(scd1_merge(tables["clients"], tables["clients"], schemas.CLIENTS, views.RUN_DT))
    # The third exchange carries the counts that refuse repeated keys, and no other column.
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("partial_count(1)") == 1
    for table in (small, text):
        assert "FullOuter" not in table and "SortAggregate" not in table
        assert "IsNull(client_id)" in table  # rows without a key are found by row-group statistics


def test_difference_joins_only_for_the_kinds_asked_for(spark, tables):
    def joins(*kinds):
        diff = snapshot_diff(tables["clients"], tables["clients"], schemas.CLIENTS, kinds)
        text = plan(diff)
        assert "FullOuter" not in text and "SortAggregate" not in text
        return re.findall(r"BroadcastHashJoin .* (LeftAnti|LeftOuter|Inner),", text)

    assert joins(INSERTED) == ["LeftAnti"] and joins(DELETED) == ["LeftAnti"]
    assert joins(UPDATED) == ["Inner"]
    assert sorted(joins(INSERTED, UPDATED, DELETED)) == ["LeftAnti", "LeftOuter"]


def test_merge_splits_a_hot_key_and_refuses_it(spark, conf):
    conf(TINY_SKEW)
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    rows = [F.lit(DAY).alias("valid_to"), F.col("id").cast("string").alias("client"),
            F.lit(DAY).alias("create_dt"), F.lit(None).cast("date").alias("update_dt")]
    snapshot = spark.range(200_000).select(hot.alias("account_num"), *rows)
    dim = spark.range(0, 400_000, 4).select(F.col("id").cast("string").alias("account_num"), *rows)
    beside = _beside(dim, snapshot, schemas.ACCOUNTS)
    assert beside.count() == 200_000
    text = plan(beside, run=False) if "skew=true" in plan(beside) else plan(beside, run=True)
    assert "SortMergeJoin(skew=true)" in text
    merged = scd1_merge(dim, snapshot, schemas.ACCOUNTS, DAY)
    with pytest.raises(Exception, match="repeats key hot"):
        merged.collect()
    counted = plan(merged)
    assert "partial_count(1)" in counted


def test_clients_without_passport_are_spread(spark, conf, tmp_path):
    conf(TINY_SKEW | {"spark.sql.adaptive.skewJoin.enabled": "false"})
    number = F.col("id").cast("string")
    none = F.when(F.col("id") % 3 > 0, number)
    people = spark.range(90_000).select(
        number.alias("client_id"), number.alias("last_name"), number.alias("first_name"),
        number.alias("patronymic"), F.lit(None).cast("date").alias("date_of_birth"),
        none.alias("passport_num"), F.lit(DAY).alias("passport_valid_to"), number.alias("phone"),
    )
    listed = spark.range(0, 90_000, 2).select(
        F.lit(DAY).alias("entry_dt"), number.alias("passport_num")
    )
    for rule, per_listed in ((fraud.passport_rule, 2), (fraud.passport_rule_once, 1)):
        ruled = rule(people, listed)
        assert ruled.where("passport is null").count() == 30_000
        assert ruled.count() == 60_000 + 30_000 * (per_listed - 1) + 30_000
        assert "hashpartitioning(_listed_as" in plan(ruled)
    spread = people.select(
        (F.pmod(F.hash(F.coalesce("passport_num", "client_id")), F.lit(8))).alias("part")
    ).groupBy("part").count()
    assert max(r["count"] for r in spread.collect()) < 1.2 * 90_000 / 8


def test_random_keys_open_few_row_groups(spark, conf, tmp_path):
    conf({"spark.sql.files.maxPartitionBytes": "1g"})
    fact = spark.range(200_000).select(
        F.md5(F.col("id").cast("string")).alias("trans_id"), F.lit(DAY).alias("trans_date"),
        *(F.lit("x").alias(n) for n in ("card_num", "oper_type")),
        F.lit(None).cast(schemas.MONEY).alias("amt"),
        *(F.lit("x").alias(n) for n in ("oper_result", "terminal")),
    )
    held = settle(fact.repartition(20), f"{tmp_path}/fact", schemas.TRANSACTIONS)
    batch = fact.where("trans_id = md5('77') or trans_id = md5('123456')").unionByName(
        fact.limit(1).withColumn("trans_id", F.lit("not there"))
    )
    batch = settle(batch, f"{tmp_path}/batch")
    known = possible_matches(held, batch, "trans_id")
    assert known.count() == 2
    rows = _scanned(known.select("trans_id"))
    assert rows < 200_000 / 4, rows
    fresh = insert_new(batch, known, "trans_id")
    assert [r.trans_id for r in fresh.collect()] == ["not there"]
    many = settle(fact.limit(5000), f"{tmp_path}/many")
    assert insert_new(many, possible_matches(held, many, "trans_id"), "trans_id").count() == 0
    none = settle(fact.limit(0), f"{tmp_path}/none")
    assert possible_matches(held, none, "trans_id").count() == 0


def _scanned(df):
    """Rows the file scan of a query gave, row groups it skipped left out."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scan = leaves.head()
    return scan.metrics().apply("numOutputRows").value()


def test_hot_card_is_split(spark, conf):
    conf(TINY_SKEW)
    number = F.col("id")
    card = F.when(number % 3 == 0, "hot").otherwise(number.cast("string"))
    day = F.date_add(F.lit(dt.date(2021, 1, 1)), (F.hash("id") % 1000).cast("int"))
    facts = spark.range(300_000).select(card.alias("card_num"), day.alias("trans_date"))
    watch = facts.select("card_num").distinct().select(
        "card_num",
        F.lit("p").alias("passport"),
        F.lit("n").alias("fio"),
        F.lit("+7").alias("phone"),
        F.lit(dt.date(2021, 1, 1)).alias("after_dt"),
        F.lit(None).cast("date").alias("until_dt"),
        F.lit(1).alias("copies"),
        F.lit(None).cast("date").alias("ended_dt"),
    )
    watch.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/watch")
    events = fraud.fraud_events(facts, spark.read.parquet(path), dt.date(2021, 3, 3))
    rows = events.collect()
    assert "SortMergeJoin(skew=true)" in plan(events)
    assert len(rows) == facts.where("trans_date > date '2021-01-01'").count()


def test_hot_batch_key_is_split(spark, conf):
    conf(TINY_SKEW)
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    batch = spark.range(200_000).select(key.alias("k"), "id")
    target = spark.range(0, 400_000, 4).select(F.col("id").cast("string").alias("k"))
    fresh = insert_new(batch, target, "k")
    rows = {r.id for r in fresh.collect()}
    assert "SortMergeJoin(skew=true)" in plan(fresh)
    assert rows == {n for n in range(200_000) if n % 3 == 0 or n % 4}
