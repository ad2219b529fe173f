"""Reading of text values, strict and with rejects."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.functions import parsing
from cardwarden.operators import staging
from cardwarden.sources.drops import route


def values(spark, texts, parse):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in rows.select("i", parse(F.col("t"))).orderBy("i").collect()]


def test_days(spark):
    day = dt.date(2021, 3, 1)
    texts = ["2021-03-01 00:00:17", "2021-3-1", "2021-03-01T10:11:12", "junk", "2021-13-01", None]
    assert values(spark, texts, parsing.parse_day) == [day, day, day, None, None, None]


def test_month_is_not_read_as_minutes(spark):
    assert values(spark, ["2021-11-30"], parsing.parse_day) == [dt.date(2021, 11, 30)]


def test_listed_day_uses_ten_characters(spark):
    assert values(spark, ["2021-03-01xyz"], parsing.parse_listed_day) == [dt.date(2021, 3, 1)]


def test_amounts(spark):
    texts = ["14,89", "14.89", "1234,565", "-1234,565", "7", "abc", None]
    wanted = ["14.89", "14.89", "1234.57", "-1234.57", "7.00"]
    read = values(spark, texts, parsing.parse_amount)
    assert read == [Decimal(w) for w in wanted] + [None, None]


def test_compact_day(spark):
    assert values(spark, ["20210303", "2021"], parsing.parse_compact_day) == [
        dt.date(2021, 3, 3),
        None,
    ]


def test_file_day(spark):
    texts = ["transactions_03032021.txt", "terminals_01042021.xlsx", "readme.txt"]
    assert values(spark, texts, parsing.file_day) == [
        dt.date(2021, 3, 3),
        dt.date(2021, 4, 1),
        None,
    ]


def test_routing_takes_the_first_feed(spark):
    names = ["transactions_terminals.txt", "passport_blacklist_01032021.xlsx", "notes.txt"]
    files = spark.createDataFrame([(n,) for n in names], "file_name string")
    feeds = {r.file_name: r.feed for r in route(files).collect()}
    assert list(feeds[n] for n in names) == ["transactions", "passport_blacklist", None]


RAW = ", ".join(f"{c} string" for c in schemas.TRANSACTION_FILE)
GOOD = ("1", "2021-03-01 10:00:00", "5,50", "c1", "PAYMENT", "SUCCESS", "A1")


def test_strict_staging_orders_and_types(spark):
    staged = staging.stage_transactions(spark.createDataFrame([GOOD], RAW))
    assert staged.schema.names == schemas.TRANSACTIONS.columns
    row = staged.first()
    assert (row.trans_date, row.amt) == (dt.date(2021, 3, 1), Decimal("5.50"))


@pytest.mark.parametrize(
    ("column", "value"),
    [("trans_date", "junk"), ("amt", "abc"), ("terminal", "TOOLONG"), ("oper_result", "REJECTED!")],
)
def test_strict_staging_fails_and_rejects_name_the_column(spark, column, value):
    at = schemas.TRANSACTION_FILE.index(column)
    bad = GOOD[:at] + (value,) + GOOD[at + 1 :]
    raw = spark.createDataFrame([GOOD, bad], RAW)
    with pytest.raises(Exception, match=column):
        staging.stage_transactions(raw).collect()
    refused = staging.rejects(raw, schemas.TRANSACTIONS).collect()
    assert [r.problems for r in refused] == [column]
    good = staging.accepted(raw, schemas.TRANSACTIONS)
    assert staging.stage_transactions(good).count() == 1


def test_missing_values_are_no_problem(spark):
    raw = spark.createDataFrame([(None,) * 7], RAW)
    assert staging.rejects(raw, schemas.TRANSACTIONS).count() == 0
    assert staging.stage_transactions(raw).first().asDict() == dict.fromkeys(
        schemas.TRANSACTIONS.columns
    )


def test_spaces_beyond_the_limit_are_cut(spark):
    raw = spark.createDataFrame([GOOD[:-1] + ("A1      ",)], RAW)
    assert staging.stage_transactions(raw).first().terminal == "A1   "


def test_identifiers_keep_leading_zeros(spark, tmp_path):
    from cardwarden.sources.delimited import read_transactions

    line = "h;h;h;h;h;h;h\n007;2021-03-01;1,00;0042;PAYMENT;SUCCESS;A1\n"
    (tmp_path / "transactions_01032021.txt").write_text(line)
    row = staging.stage_transactions(read_transactions(spark, str(tmp_path))).first()
    assert (row.trans_id, row.card_num) == ("007", "0042")


def test_padded_card_numbers_and_renamed_account(spark):
    pulled = spark.createDataFrame(
        [("42   ", "a1", dt.datetime(2020, 1, 1, 5), None)],
        "card_num string, account string, create_dt timestamp, update_dt timestamp",
    )
    row = staging.stage_cards(pulled).first()
    assert (row.card_num, row.account_num, row.create_dt) == ("42", "a1", dt.date(2020, 1, 1))


def test_padded_card_numbers_in_transactions(spark):
    raw = spark.createDataFrame([(*GOOD[:3], "c1  ", *GOOD[4:])], RAW)
    assert staging.stage_transactions(raw).first().card_num == "c1  "
    assert staging.stage_transactions(raw, trim_cards=True).first().card_num == "c1"


def test_terminals_are_stamped_with_the_run(spark):
    columns = ", ".join(f"{c} string" for c in schemas.TERMINALS_SHEET[1])
    raw = spark.createDataFrame([("t", "ATM", "x", "y")], columns)
    row = staging.stage_terminals(raw, dt.date(2021, 3, 1)).first()
    assert (row.create_dt, row.update_dt) == (dt.date(2021, 3, 1), None)
