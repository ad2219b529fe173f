"""Fraud rules as a watch list of dated spans, matched to transactions in one join.

Both rules only compare a transaction's day with days that belong to the client, account or
passport. So the rules are first brought down to the cards, on the (small) dimension side.
A row of the watch list says for one card:

- ``ended_dt``: transactions after this day break the contract rule;
- ``after_dt``, ``until_dt``, ``copies``: transactions after the one day and, if given, not
  after the other break the passport rule, and are reported this many times.

The transactions then meet one table, through one equi join on the card: they are shuffled
once at most, with two columns, and not at all when the watch list is small enough to be
broadcast.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions.parsing import full_name
from cardwarden.schemas import REPORT

# Report codes, and the day until which a passport without expiry is valid.
EXPIRED_PASSPORT, EXPIRED_CONTRACT = "1", "2"
NEVER_EXPIRES = date(2900, 1, 1)

# Most copies one span row stands for, so that no single row unfolds into a huge array.
_COPIES_PER_ROW = 1024

_PERSON = ("client_id", "passport", "fio", "phone")
WATCH_COLUMNS = (
    "card_num",
    "passport",
    "fio",
    "phone",
    "after_dt",
    "until_dt",
    "copies",
    "ended_dt",
)


def contract_rule(clients: DataFrame) -> DataFrame:
    """Transactions after the end of the account's contract."""
    return _person(clients).select(
        *_PERSON,
        F.lit(None).cast("date").alias("after_dt"),
        F.lit(None).cast("date").alias("until_dt"),
        F.lit(1).alias("copies"),
        F.lit(True).alias("by_contract"),
    )


def passport_rule(
    clients: DataFrame, blacklist: DataFrame, by_contract: bool = False
) -> DataFrame:
    """Transactions after the passport expired, repeated for each earlier blacklist entry.

    An event counts once while the passport has no earlier entry, else once per entry. A
    listed but unexpired passport raises nothing. ``by_contract`` adds the contract rule to
    the one row that every client has.
    """
    expires = F.coalesce(F.col("valid_to"), F.lit(NEVER_EXPIRES))
    people = _person(clients).withColumn("_listed_as", _listed_as())
    spans = _listing_spans(blacklist).withColumnRenamed("passport", "_passport")
    return (
        people.join(spans, _same_passport(), "left")
        .select(
            *_PERSON,
            F.greatest(expires, F.col("listed_dt")).alias("after_dt"),
            "until_dt",
            F.coalesce("copies", F.lit(1)).alias("copies"),
            (F.lit(by_contract) & F.col("listed_dt").isNull()).alias("by_contract"),
        )
    )


def passport_rule_once(clients: DataFrame, blacklist: DataFrame) -> DataFrame:
    """The stricter reading: expired or listed passport, each transaction reported once."""
    people = _person(clients).withColumn("_listed_as", _listed_as())
    entries = _entries(blacklist).groupBy("passport").agg(F.min("entry_dt").alias("listed_dt"))
    return (
        people.join(entries.withColumnRenamed("passport", "_passport"), _same_passport(), "left")
        .select(
            *_PERSON,
            F.least("valid_to", "listed_dt").alias("after_dt"),
            F.lit(None).cast("date").alias("until_dt"),
            F.lit(1).alias("copies"),
            F.lit(False).alias("by_contract"),
        )
    )


def both_rules(clients: DataFrame, blacklist: DataFrame) -> DataFrame:
    return passport_rule(clients, blacklist, by_contract=True)


def watch_list(
    cards: DataFrame, accounts: DataFrame, rules: DataFrame, horizon: date | None = None
) -> DataFrame:
    """The rules per card. ``horizon`` is the last transaction day to be judged, if known.

    Days on or after the horizon cannot be exceeded, so rows with no earlier one are dropped
    before the cards come in: of all cards, only those of an expired holder are left.
    """
    spans = (
        accounts.select("account_num", "valid_to", F.col("client").alias("client_id"))
        .join(rules, "client_id")
        .withColumn("ended_dt", F.when(F.col("by_contract"), F.col("valid_to")))
    )
    if horizon is None:
        spans = spans.where(F.col("after_dt").isNotNull() | F.col("ended_dt").isNotNull())
    else:
        spans = opened_before(spans, horizon)
    return (
        cards.select("card_num", "account_num").join(spans, "account_num").select(*WATCH_COLUMNS)
    )


def opened_before(spans: DataFrame, horizon: date) -> DataFrame:
    """The spans that a transaction of the horizon's day or earlier can fall into."""
    day = F.lit(horizon)
    return spans.where((F.col("after_dt") < day) | (F.col("ended_dt") < day))


def fraud_events(transactions: DataFrame, watch: DataFrame, report_dt: date | Column) -> DataFrame:
    """Report rows. ``report_dt`` is one day for all, or an expression over the transactions.

    The join is an inner one, so AQE can split a card that holds a large share of either
    side; nothing here groups by card.
    """
    report_day = report_dt if isinstance(report_dt, Column) else F.lit(report_dt)
    used = transactions.select(
        "card_num", F.col("trans_date").alias("event_dt"), report_day.alias("report_dt")
    )
    day, until = F.col("event_dt"), F.col("until_dt")
    by_passport = (day > F.col("after_dt")) & (until.isNull() | (day <= until))
    by_contract = day > F.col("ended_dt")
    matched = used.join(
        watch, (used["card_num"] == watch["card_num"]) & (by_passport | by_contract)
    )
    none = F.array().cast("array<string>")
    passport = F.array_repeat(F.lit(EXPIRED_PASSPORT), F.col("copies"))
    contract = F.array(F.lit(EXPIRED_CONTRACT))
    types = F.concat(
        F.when(by_passport, passport).otherwise(none), F.when(by_contract, contract).otherwise(none)
    )
    return matched.withColumn("event_type", F.explode(types)).select(*REPORT.columns)


def _person(clients: DataFrame) -> DataFrame:
    return clients.select(
        "client_id",
        F.col("passport_num").alias("passport"),
        full_name(F.col("last_name"), F.col("first_name"), F.col("patronymic")).alias("fio"),
        "phone",
        F.col("passport_valid_to").alias("valid_to"),
    )


def _listed_as() -> Column:
    """What a client is looked up by: the passport, or the client without one.

    NULLs would all be shuffled to one task; this spreads them like any other key.
    """
    return F.coalesce("passport", "client_id")


def _same_passport() -> Column:
    return (F.col("_listed_as") == F.col("_passport")) & F.col("passport").isNotNull()


def _entries(blacklist: DataFrame) -> DataFrame:
    """Entries that can match: an entry without passport or day never does."""
    return blacklist.where(
        F.col("passport_num").isNotNull() & F.col("entry_dt").isNotNull()
    ).select(F.col("passport_num").alias("passport"), "entry_dt")


def _listing_spans(blacklist: DataFrame) -> DataFrame:
    """Per passport: the span up to its first entry, and one open span per entry day.

    Entries are counted per passport and day before anything else, so a passport listed
    over and over shrinks to one row per day. A day's count is unfolded in blocks.
    """
    days = _entries(blacklist).groupBy("passport", "entry_dt").agg(F.count("*").alias("entries"))
    before = days.groupBy("passport").agg(F.min("entry_dt").alias("until_dt"))
    zero, block = F.lit(0).cast("long"), F.lit(_COPIES_PER_ROW).cast("long")
    start = F.explode(F.sequence(zero, F.col("entries") - 1, block))
    blocks = days.select("passport", "entry_dt", "entries", start.alias("start"))
    copies = F.least(F.col("entries") - F.col("start"), block).cast("int")
    no_day = F.lit(None).cast("date")
    until_listed = before.select(
        "passport", no_day.alias("listed_dt"), "until_dt", F.lit(1).alias("copies")
    )
    since_listed = blocks.select(
        "passport",
        F.col("entry_dt").alias("listed_dt"),
        no_day.alias("until_dt"),
        copies.alias("copies"),
    )
    return until_listed.unionByName(since_listed)
