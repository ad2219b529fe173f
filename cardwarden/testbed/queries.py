"""One registered query per operator, each over the whole of the provided tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.functions.parsing import parse_compact_day
from cardwarden.operators import quality, staging
from cardwarden.operators.incremental import LOAD_ORDER, insert_new, insert_new_in_order
from cardwarden.operators.scd1 import scd1_merge, snapshot_diff
from cardwarden.plans import fraud
from cardwarden.plans.nightly import Feeds, append_report_once, run_batch, run_drop
from cardwarden.plans.warehouse import Warehouse, settle
from cardwarden.session import scratch, tune
from cardwarden.sources.delimited import read_transactions
from cardwarden.sources.drops import route
from cardwarden.sources.workbook import workbook_rows
from cardwarden.streaming.feed import load_feed, loaded, transaction_stream
from cardwarden.testbed import views
from cardwarden.testbed.workbooks import as_workbooks

Query = Callable[[SparkSession, str], DataFrame]

_TABLES = {table.name: table for table in schemas.DIMENSIONS}
_LAST_REPORT = date(2021, 3, 3)
# Files that the rows of one simulated drop file are dealt to, by key: so many, and one more for
# each so many bytes of the table they come from, as each is written by one task.
_PARTS = 4
_PART_BYTES = 16 << 20


def _report_of_load() -> Column:
    return F.date_add(F.lit(date(2021, 2, 28)), F.col("load"))


# Staging. The keys of the provided tables outgrow the declared text lengths at larger
# scale, so lengths are left to dq_overlength.


def raw_transactions(spark: SparkSession, sf_dir: str, *carried: str) -> DataFrame:
    """Transactions as the file carries them: day with a time, amount with a comma.

    ``carried`` may ask for the number of the load as well. It comes from the day itself, so
    that the rows of other loads are left out before any text is made of them.
    """
    return views.loads(spark, sf_dir).select(
        "trans_id",
        F.concat(F.date_format("trans_date", "yyyy-MM-dd"), F.lit(" 10:11:12")).alias("trans_date"),
        F.replace(F.col("amt").cast("string"), F.lit("."), F.lit(",")).alias("amt"),
        "card_num",
        "oper_type",
        "oper_result",
        "terminal",
        *carried,
    )


def stage_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_transactions(raw_transactions(spark, sf_dir), enforce_lengths=False)


def csv_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "csv-transactions")
    _drop_lines(raw_transactions(spark, sf_dir), folder)
    return staging.stage_transactions(read_transactions(spark, folder), enforce_lengths=False)


def stage_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.concat(F.date_format("entry_dt", "yyyy-MM-dd"), F.lit(" 00:00:00"))
    raw = views.blacklist(spark, sf_dir).withColumn("entry_dt", day)
    return staging.stage_blacklist(raw, enforce_lengths=False)


def stage_terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.all_terminals(spark, sf_dir).drop("create_dt", "update_dt")
    return staging.stage_terminals(raw, views.RUN_DT, enforce_lengths=False)


def stage_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = F.col("date_of_birth").cast("timestamp_ntz")
    pulled = views.all_clients(spark, sf_dir).withColumn("date_of_birth", born)
    return staging.stage_clients(pulled, enforce_lengths=False)


def stage_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pulled = views.accounts(spark, sf_dir).withColumnRenamed("account_num", "account")
    return staging.stage_accounts(pulled, enforce_lengths=False)


def stage_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    pulled = views.all_cards(spark, sf_dir).withColumnRenamed("account_num", "account")
    padded = pulled.withColumn("card_num", F.concat(F.col("card_num"), F.lit("   ")))
    return staging.stage_cards(padded, enforce_lengths=False)


def workbook_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet, columns = schemas.BLACKLIST_SHEET
    books = as_workbooks(views.blacklist(spark, sf_dir).select(*columns), sheet)
    return staging.stage_blacklist(workbook_rows(books, sheet, columns), enforce_lengths=False)


def workbook_terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet, columns = schemas.TERMINALS_SHEET
    books = as_workbooks(views.all_terminals(spark, sf_dir).select(*columns), sheet)
    rows = workbook_rows(books, sheet, columns)
    return staging.stage_terminals(rows, views.RUN_DT, enforce_lengths=False)


# Files of a drop, named after orders.


def _named_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (
        F.when(F.col("o_orderstatus") == "F", "transactions")
        .when(F.col("o_orderstatus") == "O", "passport_blacklist")
        .when(F.col("o_orderpriority") == "1-URGENT", "terminals")
        .otherwise("readme")
    )
    day = F.date_format("o_orderdate", "ddMMyyyy")
    return views.load(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(kind, F.lit("_"), day, F.lit(".txt")).alias("file_name")
    )


def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(_named_files(spark, sf_dir)).select("o_orderkey", "file_name", "feed")


def report_date_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(_named_files(spark, sf_dir)).select(
        "o_orderkey", "file_name", F.col("drop_day").alias("report_dt")
    )


def compact_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days through their compact text form."""
    compact = F.date_format("o_orderdate", "yyyyMMdd").alias("compact")
    texts = views.load(spark, sf_dir, "orders").select("o_orderkey", compact)
    return texts.withColumn("order_dt", parse_compact_day(F.col("compact")))


# Incremental load and dimension merge.


def new_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions against a fact that holds the first load."""
    batch = views.transactions(spark, sf_dir)
    held = views.loads(spark, sf_dir).where("load = 1")
    return insert_new(batch, held, "trans_id")


def new_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries against a blacklist that holds those before 1999."""
    batch = views.blacklist(spark, sf_dir)
    held = batch.where(F.col("entry_dt") < F.lit(date(1999, 1, 1)))
    return insert_new(batch, held, "passport_num")


def transactions_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads one after another, as one query."""
    return insert_new_in_order(views.loads(spark, sf_dir), "trans_id", "load")


def _merge_of(name: str) -> Query:
    def merge(spark: SparkSession, sf_dir: str) -> DataFrame:
        dim, snapshot = views.snapshots(spark, sf_dir)[name]
        return scd1_merge(dim, snapshot, _TABLES[name], views.RUN_DT)

    return merge


def _diff_of(change: str) -> Query:
    """Keys of one kind of change, of all four dimensions."""

    def diff(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = []
        for name, (dim, snapshot) in views.snapshots(spark, sf_dir).items():
            table = _TABLES[name]
            rows = snapshot_diff(dim, snapshot, table, (change,))
            found.append(rows.select(F.lit(name).alias("dim"), F.col(table.key).alias("key")))
        return reduce(DataFrame.unionByName, found)

    return diff


def diff_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, snapshot = views.snapshots(spark, sf_dir)["dim_clients"]
    return snapshot_diff(dim, snapshot, schemas.CLIENTS)


# Fraud rules and reports.


def _watch(spark: SparkSession, sf_dir: str, rules: DataFrame) -> DataFrame:
    return fraud.watch_list(views.cards(spark, sf_dir), views.accounts(spark, sf_dir), rules)


def _both(spark: SparkSession, sf_dir: str) -> DataFrame:
    people, listed = views.clients(spark, sf_dir), views.blacklist(spark, sf_dir)
    return _watch(spark, sf_dir, fraud.both_rules(people, listed))


def fraud_expired_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = fraud.contract_rule(views.clients(spark, sf_dir))
    facts = views.transactions(spark, sf_dir)
    return fraud.fraud_events(facts, _watch(spark, sf_dir, rule), views.REPORT_DT)


def fraud_passport_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = fraud.passport_rule(views.clients(spark, sf_dir), views.blacklist(spark, sf_dir))
    facts = views.transactions(spark, sf_dir)
    return fraud.fraud_events(facts, _watch(spark, sf_dir, rule), views.REPORT_DT)


def fraud_passport_intended(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = fraud.passport_rule_once(views.clients(spark, sf_dir), views.blacklist(spark, sf_dir))
    facts = views.transactions(spark, sf_dir)
    return fraud.fraud_events(facts, _watch(spark, sf_dir, rule), views.REPORT_DT)


def fraud_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = views.transactions(spark, sf_dir)
    return fraud.fraud_events(facts, _both(spark, sf_dir), views.REPORT_DT)


def report_three_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three nightly reports, each over all transactions loaded until then.

    The rules are matched once; an event then goes into the report of its own load and
    into every later one.
    """
    own = report_three_runs_incremental(spark, sf_dir)
    days = F.sequence(F.col("report_dt"), F.lit(_LAST_REPORT))
    return own.withColumn("report_dt", F.explode(days))


def report_three_runs_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three nightly reports, each over the transactions of its own load."""
    facts = transactions_by_load(spark, sf_dir)
    return fraud.fraud_events(facts, _both(spark, sf_dir), _report_of_load())


def report_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report that holds two days already, after all three days are offered again."""
    events = report_three_runs_incremental(spark, sf_dir)
    # Written by report day, as in the warehouse: what is held is a matter of its folders.
    offered = settle(events, scratch(spark, "report"), schemas.REPORT)
    held = offered.where(F.col("report_dt") < F.lit(_LAST_REPORT))
    return held.unionByName(append_report_once(held, offered))


def nightly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report after three nightly runs into a new warehouse.

    The dimensions start as they stand and take their next snapshot on the second day; the
    blacklist grows on the second day as well.
    """
    warehouse = Warehouse(spark, scratch(spark, "nightly"))
    facts, listed = views.loads(spark, sf_dir), views.blacklist(spark, sf_dir)
    dims = views.snapshots(spark, sf_dir)
    early = listed.where(F.col("entry_dt") < F.lit(date(1999, 1, 1)))
    for load in (1, 2, 3):
        states = {name.removeprefix("dim_"): pair[load > 1] for name, pair in dims.items()}
        day = date(2021, 3, load)
        feeds = Feeds(
            transactions=facts.where(F.col("load") == load),
            blacklist=early if load == 1 else listed,
            **states,
        )
        run_batch(warehouse, feeds, day.isoformat(), day, day)
    return warehouse.table(schemas.REPORT)


# Data quality.


def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(views.transactions(spark, sf_dir), "trans_id")


def dq_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs in the next client, account and card snapshots, over every row of the tables."""
    found = []
    for name, snapshot in views.whole_snapshots(spark, sf_dir).items():
        counts = quality.null_counts(snapshot, _TABLES[name].columns)
        found.append(counts.withColumn("table_name", F.lit(name)))
    return reduce(DataFrame.unionByName, found)


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (views.transactions, views.cards, views.accounts, views.clients)
    return quality.all_orphans(*(view(spark, sf_dir) for view in tables))


def dq_overlength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.overlength(views.transactions(spark, sf_dir), schemas.TRANSACTIONS)


def _damaged_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions, some with an unreadable day or amount or an over-long result."""
    return _damaged_lines(spark, sf_dir).select("trans_id", "trans_date", "amt", "oper_result")


def dq_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.rejects(_damaged_transactions(spark, sf_dir), schemas.TRANSACTIONS)


def _damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged transactions with all columns of the file."""
    whole = views.load(spark, sf_dir, "lineitem").select(
        F.concat(views.text("l_orderkey"), F.lit("-"), views.text("l_linenumber")).alias("trans_id"),
        F.when(F.col("l_tax") > 0.075, "someday")
        .otherwise(F.date_format("l_shipdate", "yyyy-M-d"))
        .alias("trans_date"),
        F.when(F.col("l_discount") > 0.095, "n/a")
        .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
        .alias("amt"),
        views.text("l_orderkey").alias("card_num"),
        F.col("l_returnflag").alias("oper_type"),
        F.when(F.col("l_quantity") > 45, "REJECTED").otherwise(F.col("l_linestatus")).alias(
            "oper_result"
        ),
        F.concat(F.lit("T"), views.text("l_suppkey")).alias("terminal"),
    )
    return whole.select(*schemas.TRANSACTION_FILE)


def stage_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict staging, text limits enforced, of the lines that are no rejects."""
    lines = _damaged_lines(spark, sf_dir)
    return staging.stage_transactions(staging.accepted(lines, schemas.TRANSACTIONS))


# Streams. They drop the transactions of one load after another and let the stream catch up
# after each, as the nightly file drop does. The part files of a load count as one file.


def stream_new_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "stream-load")
    for load in (1, 2, 3):
        _stream_load(spark, sf_dir, root, load)
    return loaded(spark, root, schemas.TRANSACTIONS)


def stream_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "stream-fraud")
    watch = f"{root}/_watch/given"
    _both(spark, sf_dir).write.parquet(watch)
    for load in (1, 2, 3):
        _stream_load(spark, sf_dir, root, load, lambda session: session.read.parquet(watch))
    return loaded(spark, root, schemas.REPORT)


def stream_and_nightly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of a warehouse that a stream and a nightly run load in turns.

    The nightly run is offered the load that was streamed once more, and the stream then
    all three.
    """
    root = scratch(spark, "stream-and-nightly")
    facts, day = views.loads(spark, sf_dir), date(2021, 3, 2)
    _stream_load(spark, sf_dir, root, 1)
    feeds = Feeds(transactions=facts.where("load <= 2").withColumn(LOAD_ORDER, F.col("load")))
    run_batch(Warehouse(spark, root), feeds, day.isoformat(), day, day, history="new")
    _stream_load(spark, sf_dir, root, 3, upto=True)
    return loaded(spark, root, schemas.TRANSACTIONS)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines a stream refuses while it loads the others."""
    root = scratch(spark, "stream-rejects")
    _drop_lines(_damaged_lines(spark, sf_dir), f"{root}/drop")
    load_feed(
        transaction_stream(spark, f"{root}/drop", pattern="*.csv", keep_malformed=True),
        root,
        f"{root}/checkpoint",
        report_dt=F.lit(_LAST_REPORT),
        keep_rejects=True,
        order=F.lit(""),
    ).awaitTermination()
    refused = loaded(spark, root, schemas.REJECTS)
    return refused.select(*schemas.TRANSACTION_FILE, "problems")


def _stream_load(
    spark: SparkSession, sf_dir: str, root: str, load: int, watch=None, upto: bool = False
) -> None:
    lines = raw_transactions(spark, sf_dir, "load")
    chosen = F.col("load") <= load if upto else F.col("load") == load
    _drop_lines(lines.where(chosen).drop("load"), f"{root}/drop/load={load}")
    load_feed(
        transaction_stream(spark, f"{root}/drop/*", pattern="*.csv"),
        root,
        f"{root}/checkpoint",
        watch=watch,
        report_dt=F.lit(date(2021, 3, load)),
        enforce_lengths=False,
        order=F.lit(""),
    ).awaitTermination()


def _drop_lines(lines: DataFrame, folder: str) -> None:
    lines.select(*schemas.TRANSACTION_FILE).write.csv(folder, sep=";", header=True)


# An irregular drop: two transaction files of a day and two blacklists at once, a late day,
# new content under an old name; compacted at the end.


def drop_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _irregular_drop(spark, sf_dir).table(schemas.REPORT)


def drop_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _irregular_drop(spark, sf_dir).table(schemas.TRANSACTIONS)


def _irregular_drop(spark: SparkSession, sf_dir: str) -> Warehouse:
    root = scratch(spark, "irregular-drop")
    warehouse, drop = Warehouse(spark, f"{root}/warehouse"), f"{root}/drop"
    raw = raw_transactions(spark, sf_dir, "load")
    listed = views.blacklist(spark, sf_dir).withColumn(
        "entry_dt", F.date_format("entry_dt", "yyyy-MM-dd")
    )
    dims = views.snapshots(spark, sf_dir)
    lines = _PARTS + warehouse.shared.size(f"{sf_dir}/lineitem.parquet") // _PART_BYTES

    def put(
        rows: DataFrame, columns: tuple[str, ...], key: str, name: str, many: int = _PARTS
    ) -> None:
        """Dropped files named after the part they hold; rows of a key share a part."""
        parts = f"{root}/parts/{uuid.uuid4().hex}"
        rows.select(*columns).repartition(many, key).write.csv(parts, sep=";", header=True)
        feed, day = name.rsplit("_", 1)
        files = [e for e in warehouse.shared.entries(parts) if e.name.startswith("part-")]
        for file in files:
            number = file.name.split("-")[1]
            warehouse.shared.move(file.path, f"{drop}/{feed}_{number}_{day}.csv")

    def transactions(rows: DataFrame, name: str) -> None:
        put(rows, schemas.TRANSACTION_FILE, "trans_id", name, lines)

    def load(state: int) -> None:
        names = ("clients", "accounts", "cards")
        bank = {name: dims[f"dim_{name}"][state] for name in names}
        for name in ("accounts", "cards"):
            bank[name] = bank[name].withColumnRenamed("account_num", "account")
        run_drop(
            warehouse, drop, bank, archive=f"{root}/archive", enforce_lengths=False
        )

    late = F.replace("amt", F.lit(","), F.lit(".")).cast("decimal(18,2)") < 20000
    transactions(raw.where("load = 1"), "transactions_a_02032021")
    transactions(raw.where("load = 2"), "transactions_b_02032021")
    early = listed.where("entry_dt < '1999-01-01'")
    put(early, schemas.BLACKLIST_SHEET[1], "passport_num", "passport_blacklist_01032021")
    put(listed, schemas.BLACKLIST_SHEET[1], "passport_num", "passport_blacklist_02032021")
    put(
        views.all_terminals(spark, sf_dir).coalesce(1), schemas.TERMINALS_SHEET[1],
        F.lit(1), "terminals_02032021",
    )
    load(0)
    transactions(raw.where((F.col("load") == 3) & late), "transactions_01032021")
    load(1)
    transactions(raw, "transactions_a_02032021")
    load(1)
    warehouse.compact()
    warehouse.expire()
    return warehouse


QUERIES: dict[str, Query] = {
    "stage_transactions": stage_transactions,
    "csv_transactions": csv_transactions,
    "stage_blacklist": stage_blacklist,
    "stage_terminals": stage_terminals,
    "stage_clients": stage_clients,
    "stage_accounts": stage_accounts,
    "stage_cards": stage_cards,
    "workbook_blacklist": workbook_blacklist,
    "workbook_terminals": workbook_terminals,
    "route_files": route_files,
    "report_date_from_file": report_date_from_file,
    "compact_days": compact_days,
    "new_transactions": new_transactions,
    "new_blacklist": new_blacklist,
    "transactions_by_load": transactions_by_load,
    "scd1_terminals": _merge_of("dim_terminals"),
    "scd1_clients": _merge_of("dim_clients"),
    "scd1_accounts": _merge_of("dim_accounts"),
    "scd1_cards": _merge_of("dim_cards"),
    "diff_inserted": _diff_of("I"),
    "diff_changed": _diff_of("U"),
    "diff_deleted": _diff_of("D"),
    "diff_clients": diff_clients,
    "fraud_expired_contract": fraud_expired_contract,
    "fraud_passport_literal": fraud_passport_literal,
    "fraud_passport_intended": fraud_passport_intended,
    "fraud_report": fraud_report,
    "report_three_runs": report_three_runs,
    "report_three_runs_incremental": report_three_runs_incremental,
    "report_idempotent": report_idempotent,
    "nightly_report": nightly_report,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_null_keys": dq_null_keys,
    "dq_null_keys_whole": dq_null_keys,
    "dq_orphans": dq_orphans,
    "dq_overlength": dq_overlength,
    "dq_rejects": dq_rejects,
    "stream_new_transactions": stream_new_transactions,
    "stream_fraud": stream_fraud,
    "stage_accepted": stage_accepted,
    "stream_and_nightly": stream_and_nightly,
    "stream_rejects": stream_rejects,
    "drop_report": drop_report,
    "drop_transactions": drop_transactions,
}


def tuned(query: Query) -> Query:
    """The query with the session settings its plan relies on."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    return run
