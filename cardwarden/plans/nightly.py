"""The nightly run: load one day's feeds, bring the dimensions up to date, report fraud."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce
from itertools import chain, count

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from cardwarden import schemas
from cardwarden.operators import staging
from cardwarden.operators.incremental import (
    LOAD_ORDER,
    MANY_ROWS,
    insert_new,
    insert_new_in_order,
    possible_matches,
)
from cardwarden.operators.scd1 import scd1_merge
from cardwarden.plans import fraud
from cardwarden.plans.warehouse import ConcurrentRun, Run, Warehouse, settle
from cardwarden.schemas import Table
from cardwarden.session import tune
from cardwarden.sources.delimited import read_sheet, read_transactions
from cardwarden.sources.drops import ARCHIVED, DroppedFile, day_in, drop_files, feed_in
from cardwarden.sources.workbook import read_workbooks


@dataclass(frozen=True)
class Feeds:
    """Rows of one day as the staging operators return them.

    A dimension without a snapshot stays as it is.
    """

    transactions: DataFrame | None
    blacklist: DataFrame | None = None
    terminals: DataFrame | None = None
    clients: DataFrame | None = None
    accounts: DataFrame | None = None
    cards: DataFrame | None = None
    rejects: DataFrame | None = None


class UndatedFile(ValueError):
    """A dropped file whose name holds no day cannot be put in order."""


class EmptySnapshot(ValueError):
    """An empty snapshot would delete the whole dimension."""


def run_batch(
    warehouse: Warehouse,
    feeds: Feeds,
    run_id: str,
    run_dt: date,
    report_dt: date,
    history: str = "all",
    allow_empty_snapshot: bool = True,
    files: Sequence[DroppedFile] = (),
) -> bool:
    """Load and report one day; False, and nothing done, without a transaction feed.

    Rows are new if no other published run holds their key, earlier or later, so a late or
    repeated run doubles nothing. A feed with a column ``load_order`` counts as several
    files loaded in that order. ``files`` are the dropped files the feeds come from; they
    count as loaded once the run is published. If another run is published while this one
    works, it fails with ``ConcurrentRun`` and leaves nothing visible.

    ``history="all"`` judges every transaction ever loaded, so each report repeats the
    earlier ones with today's dimensions. ``history="new"`` judges only the run's own
    transactions and reads none of the older ones. So does a second run for a report day
    that the report holds already, which thus gains its events without doubling any.
    """
    if history not in ("all", "new"):
        raise ValueError(f"unknown history {history!r}")
    if feeds.transactions is None:
        return False
    spark = tune(warehouse.spark)
    state = warehouse.state()
    past, others = state.before(run_id), state.without(run_id)
    run = warehouse.begin(run_id, files, state)
    run.report_days.add(report_dt)

    def append(table: Table, feed: DataFrame | None) -> DataFrame:
        if feed is None:
            return spark.createDataFrame([], table.schema)
        fresh = new_rows(run, table, feed, others.table(table))
        if table is schemas.TRANSACTIONS:
            return run.write_transactions(fresh)
        return run.write(table, fresh)

    def merge(table: Table, snapshot: DataFrame | None) -> DataFrame:
        if snapshot is None:
            return past.table(table)
        staged = run.stage(table.name, snapshot.select(*table.columns))
        if not allow_empty_snapshot and staged.isEmpty():
            raise EmptySnapshot(table.name)
        merged = scd1_merge(past.table(table), staged, table, run_dt)
        return run.write(table, merged)

    # The six loads do not depend on each other, and most are far too small to keep a
    # cluster busy, so their jobs are submitted side by side.
    loads = [
        (append, schemas.TRANSACTIONS, feeds.transactions),
        (append, schemas.BLACKLIST, feeds.blacklist),
        (merge, schemas.TERMINALS, feeds.terminals),
        (merge, schemas.CLIENTS, feeds.clients),
        (merge, schemas.ACCOUNTS, feeds.accounts),
        (merge, schemas.CARDS, feeds.cards),
    ]
    with ThreadPoolExecutor(len(loads)) as pool:
        # Each thread takes over the job group and description of the caller.
        started = [
            pool.submit(inheritable_thread_target(spark)(load), table, feed)
            for load, table, feed in loads
        ]
        judged, listed, _, clients, accounts, cards = (task.result() for task in started)

    if feeds.rejects is not None:
        run.write(schemas.REJECTS, feeds.rejects, rebalance=True)

    horizon = run.last_trans_date
    if history == "all" and report_dt not in past.report_days():
        judged = judged.unionByName(past.table(schemas.TRANSACTIONS))
        horizon = max(filter(None, (horizon, past.last_trans_date())), default=None)
    rules = fraud.both_rules(clients, listed.unionByName(past.table(schemas.BLACKLIST)))
    watch = fraud.watch_list(cards, accounts, rules, horizon)
    # Written first, so that its true size decides whether it is broadcast or shuffled.
    watch = run.stage("watch_list", watch.hint("rebalance"))
    events = fraud.fraud_events(judged, watch, report_dt)
    run.write(schemas.REPORT, events, rebalance=True)
    run.publish()
    return True


def new_rows(
    run: Run, table: Table, feed: DataFrame, known: DataFrame, *carried: str
) -> DataFrame:
    """The rows of a feed that are new to a fact, with further columns asked for.

    A feed of several files has a column ``load_order``: they count as loaded one after
    another, so the first file that brings a key wins, and rows sharing a key within that
    file all pass. The feed is written first: its files are read once, and its size is known
    when it is joined. So are the keys it shares with the fact and those several files bring.
    """
    columns, key = [*table.columns, *carried], table.key
    ordered = LOAD_ORDER in feed.columns
    order = F.col(LOAD_ORDER) if ordered else F.lit(0)
    seen = Observation()
    counts = (
        F.count("*").alias("rows"),
        F.count(order).alias("placed"),
        F.min(order).alias("first"),
        F.max(order).alias("last"),
    )
    offered = feed.select(*columns, *([LOAD_ORDER] if ordered else [])).observe(seen, *counts)
    staged = run.stage(table.name, offered)
    noted = seen.get
    many = noted["rows"] >= MANY_ROWS

    def hold(name: str, rows: DataFrame) -> DataFrame:
        return run.stage(f"{table.name}_{name}", rows)

    fresh = staged
    if ordered:
        single = noted["placed"] == noted["rows"] and noted["first"] == noted["last"]
        fresh = insert_new_in_order(staged, key, LOAD_ORDER, hold, single)
    matches = possible_matches(known, staged, key, many)
    return insert_new(fresh.select(*columns), matches, key, staged, hold, many)


def append_report_once(report: DataFrame, events: DataFrame) -> DataFrame:
    """Events whose report day the report does not hold yet.

    The held days are broadcast: the calendar bounds their number, whatever the size of the
    report. Shuffling by report day would put each day's events into one task.
    """
    held = F.broadcast(report.select("report_dt").distinct())
    return events.join(held, "report_dt", "left_anti").select(*schemas.REPORT.columns)


def current_watch(warehouse: Warehouse) -> DataFrame:
    """The watch list of the newest dimensions, for judging transactions as they stream in.

    It is written once for each state of the dimensions and the blacklist. Two who build the
    same one at a time write two folders, of which either may be read.
    """
    state = warehouse.state()
    folder = f"{warehouse.root}/_watch/{state.dimension_key()}"
    for held in warehouse.shared.entries(folder):
        if warehouse.shared.exists(f"{held.path}/_SUCCESS"):
            return warehouse.spark.read.parquet(held.path)
    people, entries = state.table(schemas.CLIENTS), state.table(schemas.BLACKLIST)
    watch = fraud.watch_list(
        state.table(schemas.CARDS),
        state.table(schemas.ACCOUNTS),
        fraud.both_rules(people, entries),
    )
    return settle(watch.hint("rebalance"), f"{folder}/{uuid.uuid4().hex}")


def run_drop(
    warehouse: Warehouse,
    folder: str,
    bank: dict[str, DataFrame],
    history: str = "all",
    allow_empty_snapshot: bool = True,
    keep_rejects: bool = False,
    archive: str | None = None,
    enforce_lengths: bool = True,
    retries: int = 3,
) -> list[date]:
    """Load every waiting file of a drop folder, one run for each day with transactions.

    A file waits until the manifest holds it by name, size and time of change, so a second
    or late file for a day that has been run gets a run of its own, and so does new content
    under an old name. Days are taken in order, files of a day in the order of their names:
    of a key that several files bring the first one counts. Blacklists and terminals go with
    the first run that is not of an earlier day, so those of a day without transactions are
    carried on; of several terminal snapshots the newest counts, and none of a day before
    the one loaded last. A file without a readable day fails the call before anything is
    loaded.

    ``bank`` holds the pulled client, account and card tables. They are the bank's state of
    now; the first run merges them, and all later ones, being published later, start from
    there. A transaction line that cannot be typed fails the run; with ``keep_rejects`` it
    goes into the rejects table and the other lines are loaded.

    ``archive`` is a folder loaded files are moved to, which may be the drop folder itself;
    their names get an extension that keeps them from being listed. A file is moved after
    its run is published. If the job dies in between, the next one moves it without loading
    it again.

    Should another run publish meanwhile, the files still waiting are looked up once more
    and loaded on top of it, up to ``retries`` times.
    """
    ran: list[date] = []
    while True:
        try:
            for day in _run_waiting(
                warehouse, folder, {} if ran else bank, history, allow_empty_snapshot,
                keep_rejects, archive, enforce_lengths,
            ):
                ran.append(day)
                bank = {}
            return ran
        except ConcurrentRun:
            if not retries:
                raise
            retries -= 1


def _run_waiting(
    warehouse: Warehouse,
    folder: str,
    bank: dict[str, DataFrame],
    history: str,
    allow_empty_snapshot: bool,
    keep_rejects: bool,
    archive: str | None,
    enforce_lengths: bool,
) -> Iterator[date]:
    spark = warehouse.spark
    state = warehouse.state()
    loaded, taken = state.files(), {run.run_id for run in state.runs}
    waiting = []
    # A few files per day, while loaded ones are archived.
    for file in drop_files(spark, folder).collect():
        if _identity(file) not in loaded:
            waiting.append(file)
        elif archive:
            _put_away(warehouse, file, archive)
    undated = sorted(file.file_name for file in waiting if file.drop_day is None)
    if undated:
        raise UndatedFile(f"no day in the name of {', '.join(undated)}")
    held = [day_in(file.name) for file in loaded if feed_in(file.name) == "terminals"]
    snapshot = max(held, default=date.min)
    waiting.sort(key=lambda file: (file.drop_day, file.file_name))
    for day in sorted({file.drop_day for file in waiting if file.feed == "transactions"}):
        due = [
            file
            for file in waiting
            if file.drop_day == day or (file.drop_day < day and file.feed != "transactions")
        ]
        waiting = [file for file in waiting if file not in due]
        files: dict[str, list[str]] = {}
        for file in due:
            if file.feed != "terminals":
                files.setdefault(file.feed, []).append(file.path)
            elif file.drop_day >= snapshot:
                snapshot, files["terminals"] = file.drop_day, [file.path]
        feeds = _feeds(spark, files, bank, day, keep_rejects, enforce_lengths)
        run_id = _free_id(day, taken)
        run_batch(
            warehouse, feeds, run_id, day, day, history, allow_empty_snapshot,
            [_identity(file) for file in due],
        )
        taken.add(run_id)
        bank = {}
        if archive:
            for file in due:
                _put_away(warehouse, file, archive)
        yield day


def _identity(file: Row) -> DroppedFile:
    return DroppedFile(file.file_name, file.length, file.modified)


def _put_away(warehouse: Warehouse, file: Row, archive: str) -> None:
    """Move a loaded file; a taken name gets the time of the file's change, then a number."""
    target = f"{archive.rstrip('/')}/{file.file_name}"
    names = chain([target, f"{target}.{file.modified}"], (f"{target}.{n}" for n in count(2)))
    shared = warehouse.shared
    while shared.exists(file.path):
        if shared.move(file.path, f"{next(names)}{ARCHIVED}"):
            return


def _free_id(day: date, taken: set[str]) -> str:
    """The day, or the day with a number if it has been run."""
    later = (f"{day.isoformat()}.{number}" for number in count(2))
    return next(name for name in chain([day.isoformat()], later) if name not in taken)


def _feeds(
    spark: SparkSession,
    files: dict[str, list[str]],
    bank: dict[str, DataFrame],
    day: date,
    keep_rejects: bool,
    enforce_lengths: bool,
) -> Feeds:
    def placed(feed: str, rows: DataFrame) -> DataFrame:
        return _in_load_order(rows, files[feed]) if len(files[feed]) > 1 else rows

    def order(feed: str) -> list[str]:
        return [LOAD_ORDER] if len(files[feed]) > 1 else []

    strict = {"enforce_lengths": enforce_lengths}
    feeds: dict[str, DataFrame | None] = {"transactions": None}
    if "transactions" in files:
        lines = read_transactions(spark, files["transactions"], keep_rejects)
        lines = placed("transactions", lines)
        if keep_rejects:
            refused = staging.rejects(lines, schemas.TRANSACTIONS)
            feeds["rejects"] = refused.select(*schemas.REJECTS.columns)
            lines = staging.accepted(lines, schemas.TRANSACTIONS)
        staged = staging.stage_transactions(lines, *order("transactions"), **strict)
        feeds["transactions"] = staged
    if "passport_blacklist" in files:
        entries = _listed_rows(spark, files["passport_blacklist"], schemas.BLACKLIST_SHEET)
        entries = placed("passport_blacklist", entries)
        listed = staging.stage_blacklist(entries, *order("passport_blacklist"), **strict)
        feeds["blacklist"] = listed
    if "terminals" in files:
        sheet = _listed_rows(spark, files["terminals"], schemas.TERMINALS_SHEET)
        feeds["terminals"] = staging.stage_terminals(sheet, day, **strict)
    stages = {
        "clients": staging.stage_clients,
        "accounts": staging.stage_accounts,
        "cards": staging.stage_cards,
    }
    for name, pulled in bank.items():
        feeds[name] = stages[name](pulled, **strict)
    return Feeds(**feeds)


def _in_load_order(rows: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Rows with the place of their file: by the day in its name, then by name.

    The places are found once for each of the listed files, not by the name in every row.
    """
    names = {path.rpartition("/")[2] for path in paths}
    places = enumerate(sorted(names, key=lambda name: (day_in(name), name)))
    listed = rows.sparkSession.createDataFrame(
        [(name, place) for place, name in places], "_file string, _place int"
    )
    named = F.substring_index("source_file", "/", -1) == F.col("_file")
    unknown = F.raise_error(F.concat(F.lit("not a listed file: "), F.col("source_file")))
    place = F.coalesce(F.col("_place"), unknown.cast("int"))
    return rows.join(F.broadcast(listed), named, "left").select(
        *rows.columns, place.alias(LOAD_ORDER)
    )


def _listed_rows(
    spark: SparkSession, paths: Sequence[str], layout: tuple[str, Sequence[str]]
) -> DataFrame:
    """Rows of workbooks and of delimited files, told apart by their extension."""
    books = [path for path in paths if path.lower().endswith(".xlsx")]
    texts = [path for path in paths if path not in books]
    parts = []
    if books:
        parts.append(read_workbooks(spark, books, *layout))
    if texts:
        parts.append(read_sheet(spark, texts, layout[1]))
    return reduce(DataFrame.unionByName, parts)
