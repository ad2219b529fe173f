"""Parquet warehouse: each run writes into folders of its own and becomes visible at once.

Layout below the root::

    <table>/run_id=<run>/attempt=<id>/   the rows one attempt of a run wrote
    _manifest/<sequence>.json            one entry per publication, numbered without gaps
    _manifest/base-<sequence>.json       all entries up to that one, in place of their files
    _staging/<run>/<id>/<name>/          intermediate tables of one attempt
    _watch/<state>/<id>/                 watch lists, one per state of the dimensions

A reader only opens folders the manifest names. An entry is written last, so a run's tables
appear together or, if the run dies, not at all. Publishing a run again replaces its rows,
because the latest attempt of a run counts. Nothing is overwritten in place, so a running
reader is never disturbed.

Entries are numbered. A run publishes under the number after the last one it has seen, and
only one writer gets a number. Who finds it taken has missed a publication and fails instead
of adding rows that were compared with an older state.

Facts and the report are the union of all runs. A dimension is its newest snapshot. A
compaction is an entry that holds the rows of earlier attempts in fewer files and covers
them; ``expire`` deletes what no recent state refers to.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.schemas import Table
from cardwarden.sources.drops import DroppedFile
from cardwarden.sources.shared import SharedFiles

_APPENDED = {table.name: table for table in (*schemas.FACTS, schemas.REPORT, schemas.REJECTS)}
_RUN, _COMPACTION = "run", "compaction"
_ATTEMPTS_AT_A_NUMBER = 100
# Entries that have files of their own, before they are folded into one.
_OWN_FILES = 64


class ConcurrentRun(RuntimeError):
    """Another run published first; this one has compared its rows with an older state."""


class FinalRun(ValueError):
    """A run whose rows have been compacted, or that came before a compaction, stays as it is."""


@dataclass(frozen=True)
class Publication:
    """One entry of the manifest."""

    sequence: int
    run_id: str
    attempt: str
    tables: tuple[str, ...]
    kind: str = _RUN
    covers: tuple[str, ...] = ()
    files: tuple[DroppedFile, ...] = ()
    report_days: tuple[date, ...] = ()
    last_trans_date: date | None = None
    published_at: str = ""

    def text(self) -> str:
        files = [[f.name, f.length, f.modified] for f in self.files]
        days = [day.isoformat() for day in self.report_days]
        last = self.last_trans_date and self.last_trans_date.isoformat()
        return json.dumps(
            self.__dict__ | {"files": files, "report_days": days, "last_trans_date": last}
        )

    @staticmethod
    def parse(text: str) -> Publication:
        held = json.loads(text)
        last = held["last_trans_date"]
        return Publication(
            **held
            | {
                "tables": tuple(held["tables"]),
                "covers": tuple(held["covers"]),
                "files": tuple(DroppedFile(*file) for file in held["files"]),
                "report_days": tuple(date.fromisoformat(day) for day in held["report_days"]),
                "last_trans_date": last and date.fromisoformat(last),
            }
        )


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.shared = SharedFiles(spark)

    def state(self) -> State:
        """What is published now."""
        return State(self, self._published())

    def table(self, table: Table) -> DataFrame:
        return self.state().table(table)

    def begin(
        self, run_id: str, files: Sequence[DroppedFile] = (), state: State | None = None
    ) -> Run:
        """An attempt at a run, to be published on top of a state (of now, if none is given)."""
        state = state or self.state()
        state.check_open(run_id)
        return Run(self, run_id, files, state)

    def folder(self, name: str, run_id: str, attempt: str) -> str:
        return f"{self.root}/{name}/run_id={run_id}/attempt={attempt}"

    def entry_path(self, sequence: int) -> str:
        return f"{self.root}/_manifest/{sequence:012d}.json"

    def base_path(self, sequence: int) -> str:
        return f"{self.root}/_manifest/base-{sequence:012d}.json"

    def _numbers(self) -> tuple[int, list[int]]:
        """The last number folded into a base, and the numbers of the entries after it."""
        names = [entry.name for entry in self.shared.entries(f"{self.root}/_manifest")]
        stems = [name.removesuffix(".json") for name in names if name.endswith(".json")]
        base = max((int(stem[5:]) for stem in stems if stem.startswith("base-")), default=0)
        entries = sorted(int(stem) for stem in stems if stem.isdigit())
        return base, [number for number in entries if number > base]

    def folded(self) -> int:
        """The last number that has no file of its own any more."""
        return self._numbers()[0]

    def _published(self) -> tuple[Publication, ...]:
        """All entries in order. One short line each, so the driver can hold them.

        Entries may be folded while they are read; then they are looked up once more.
        """
        for _ in range(_ATTEMPTS_AT_A_NUMBER):
            base, numbers = self._numbers()
            texts = [self.shared.read(self.base_path(base))] if base else []
            texts += [self.shared.read(self.entry_path(number)) for number in numbers]
            whole = numbers == list(range(base + 1, base + 1 + len(numbers)))
            if whole and None not in texts:
                lines = [line for text in texts for line in text.splitlines()]
                return tuple(Publication.parse(line) for line in lines)
        raise FileNotFoundError(f"{self.root}/_manifest has gaps")

    def fold(self, more_than: int = 0) -> bool:
        """Put all entries into one file, if more than so many have files of their own.

        The file is complete before the entries' own files go, and readers look at what it
        holds first. A writer that comes late by a folded number sees that it is taken.
        """
        base, numbers = self._numbers()
        if len(numbers) <= more_than:
            return False
        entries = self._published()
        last = entries[-1].sequence
        if not self.shared.put_once(
            self.base_path(last), "\n".join(entry.text() for entry in entries)
        ):
            return False
        for number in range(base + 1, last + 1):
            self.shared.delete(self.entry_path(number))
        if base:
            self.shared.delete(self.base_path(base))
        return True

    def compact(
        self, tables: Iterable[Table] | None = None, small_bytes: int = 128 << 20
    ) -> list[str]:
        """Merge the attempts of facts, report and rejects that hold fewer bytes than given.

        Readers keep the state they have: the merged folders stay until ``expire``. Returns
        the tables that were merged. Runs may be published meanwhile; a run that replaces a
        merged attempt meanwhile makes the compaction fail.
        """
        merged = []
        for table in tables or _APPENDED.values():
            state = self.state()
            small = [
                entry for entry in state.holding(table)
                if self.shared.size(self.folder(table.name, entry.run_id, entry.attempt))
                < small_bytes
            ]
            if len(small) < 2:
                continue
            run = Run(self, f"compaction-{uuid.uuid4().hex}", (), state)
            run.kind, run.covers = _COMPACTION, tuple(entry.attempt for entry in small)
            run.write(table, state.read(table, small), rebalance=True)
            run.publish()
            merged.append(table.name)
        return merged

    def expire(self, keep_states: int = 3, older_than_seconds: float = 86_400) -> int:
        """Delete folders that none of the last states refers to; returns their number.

        Folders of attempts that were never published may belong to a run still at work, so
        they must also be older than given, and so must watch lists. Staging of published
        attempts goes at once. A run can be repeated only while the state it started from is
        kept.
        """
        state = self.state()
        known = {entry.attempt for entry in state.entries}
        needed, watched = set(), set()
        for past in state.last(keep_states):
            watched.add(past.dimension_key())
            for table in (*_APPENDED.values(), *schemas.DIMENSIONS):
                needed |= {(table.name, entry.attempt) for entry in past.holding(table)}
        before = time.time() * 1000 - older_than_seconds * 1000
        gone = 0
        for table in self.shared.entries(self.root):
            for run in self.shared.entries(table.path) if table.is_folder else ():
                if table.name in ("_manifest", "_watch") or not run.is_folder:
                    continue
                left = 0
                for attempt in self.shared.entries(run.path):
                    name = attempt.name.removeprefix("attempt=")
                    published = name in known
                    if (
                        (table.name, name) in needed
                        or not published and attempt.modified > before
                    ):
                        left += 1
                    else:
                        gone += self.shared.delete(attempt.path)
                if not left:
                    self.shared.delete(run.path)
        for held in self.shared.entries(f"{self.root}/_watch"):
            if held.name not in watched and held.modified <= before:
                gone += self.shared.delete(held.path)
        return gone


@dataclass(frozen=True)
class State:
    """What was published at one moment; later publications do not change it."""

    warehouse: Warehouse
    entries: tuple[Publication, ...]

    @property
    def sequence(self) -> int:
        return self.entries[-1].sequence if self.entries else 0

    @property
    def runs(self) -> tuple[Publication, ...]:
        """Latest attempt of every run, in the order of their first ones."""
        latest: dict[str, Publication] = {}
        for entry in self.entries:
            if entry.kind == _RUN:
                latest[entry.run_id] = entry
        return tuple(latest.values())

    def before(self, run_id: str) -> State:
        """What a run starts from: everything first published before it.

        Runs come in the order in which they were first published, whatever their ids, so a
        late run starts from everything loaded before it. A repeated run keeps its place and
        starts from the same state as at first.
        """
        places = [at for at, run in enumerate(self.runs) if run.run_id == run_id]
        if not places:
            return self
        kept = {run.run_id for run in self.runs[: places[0]]}
        return replace(
            self,
            entries=tuple(e for e in self.entries if e.kind == _COMPACTION or e.run_id in kept),
        )

    def without(self, run_id: str) -> State:
        return replace(self, entries=tuple(e for e in self.entries if e.run_id != run_id))

    def last(self, count: int) -> list[State]:
        """This state and the ones before it, at most so many."""
        many = len(self.entries)
        return [
            replace(self, entries=self.entries[:to])
            for to in range(many, max(many - count, -1), -1)
        ]

    def check_open(self, run_id: str) -> None:
        """Refuse to repeat a run that came before a compaction, which may hold its rows."""
        first = next((e.sequence for e in self.entries if e.run_id == run_id), None)
        if first and any(e.kind == _COMPACTION and e.sequence > first for e in self.entries):
            raise FinalRun(run_id)

    def holding(self, table: Table) -> list[Publication]:
        """The entries whose rows make up a table."""
        if table.name not in _APPENDED:
            return [run for run in self.runs if table.name in run.tables][-1:]
        merged = [e for e in self.entries if e.kind == _COMPACTION and table.name in e.tables]
        covered = {attempt for entry in merged for attempt in entry.covers}
        return [
            entry for entry in (*self.runs, *merged)
            if table.name in entry.tables and entry.attempt not in covered
        ]

    def table(self, table: Table) -> DataFrame:
        return self.read(table, self.holding(table))

    def read(self, table: Table, entries: Sequence[Publication]) -> DataFrame:
        spark, warehouse = self.warehouse.spark, self.warehouse
        if not entries:
            # Known to the planner as empty, so that joins with it are left out.
            return spark.createDataFrame([], table.schema).limit(0)
        folders = [warehouse.folder(table.name, e.run_id, e.attempt) for e in entries]
        reader = spark.read.schema(table.schema)
        rows = reader.option("basePath", f"{warehouse.root}/{table.name}").parquet(*folders)
        return rows.select(*table.columns)

    def dimension_key(self) -> str:
        """Names what the watch list depends on: the dimensions and the blacklist."""
        parts = (schemas.CLIENTS, schemas.ACCOUNTS, schemas.CARDS, schemas.BLACKLIST)
        attempts = [[e.attempt for e in self.holding(table)] for table in parts]
        return uuid.uuid5(uuid.NAMESPACE_OID, json.dumps(attempts)).hex

    def report_days(self) -> set[date]:
        return {day for run in self.runs for day in run.report_days}

    def files(self) -> set[DroppedFile]:
        """The dropped files the published runs have loaded."""
        return {file for run in self.runs for file in run.files}

    def last_trans_date(self) -> date | None:
        """Newest transaction day of any run: no fraud span that opens later can match."""
        return max((r.last_trans_date for r in self.runs if r.last_trans_date), default=None)


class Run:
    """One attempt at a run: write its tables, then publish them together."""

    def __init__(
        self, warehouse: Warehouse, run_id: str, files: Sequence[DroppedFile], state: State
    ):
        self.warehouse = warehouse
        self.run_id = run_id
        self.files = tuple(files)
        self.state = state
        self.report_days: set[date] = set()
        self.attempt = uuid.uuid4().hex
        self.written: list[str] = []
        self.last_trans_date: date | None = None
        self.kind, self.covers = _RUN, ()

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Write an intermediate table of this attempt and return it as read back.

        A written table cuts the lineage and has a known size, by which the next joins are
        planned. It is never published. Every attempt has a folder of its own, so that two
        runs at a time never mix their batches.
        """
        return settle(df, f"{self.warehouse.root}/_staging/{self.run_id}/{self.attempt}/{name}")

    def write(self, table: Table, df: DataFrame, rebalance: bool = False) -> DataFrame:
        """Write this run's rows of a table and return them as read back.

        ``rebalance`` evens out the files of a result much smaller than its input, which
        would otherwise leave one tiny file per input task. Columns beyond the table's are
        written along and seen only in the rows returned.
        """
        folder = self.warehouse.folder(table.name, self.run_id, self.attempt)
        # By its days, if the table is laid out so: else every task would write to every day.
        rows = settle(df.hint("rebalance", *_layout(table)) if rebalance else df, folder, table)
        self.written.append(table.name)
        return rows

    def write_transactions(self, df: DataFrame) -> DataFrame:
        """Write this run's transactions, noting their last day as they are written."""
        seen = Observation()
        rows = self.write(schemas.TRANSACTIONS, df.observe(seen, F.max("trans_date").alias("last")))
        self.last_trans_date = seen.get["last"]
        return rows

    def publish(self) -> None:
        """Make the written tables visible, unless the state is no longer the one begun from.

        Compactions in between change no rows, so a run goes past them, and a compaction goes
        past runs that repeat none of the attempts it covers.
        """
        for _ in range(_ATTEMPTS_AT_A_NUMBER):
            entry = Publication(
                self.state.sequence + 1,
                self.run_id,
                self.attempt,
                tuple(self.written),
                self.kind,
                self.covers,
                self.files,
                tuple(sorted(self.report_days)),
                self.last_trans_date,
                datetime.now(timezone.utc).isoformat(),
            )
            path = self.warehouse.entry_path(entry.sequence)
            if self.warehouse.shared.put_once(path, entry.text()):
                if self.warehouse.folded() < entry.sequence:
                    self.warehouse.fold(more_than=_OWN_FILES)
                    return
                # The number was taken long ago and its file folded away.
                self.warehouse.shared.delete(path)
            now = self.warehouse.state()
            if not self._may_pass(now):
                break
            self.state = now
        raise ConcurrentRun(self.run_id)

    def _may_pass(self, now: State) -> bool:
        missed = [e for e in now.entries if e.sequence > self.state.sequence]
        if self.kind == _RUN:
            first = any(e.run_id == self.run_id for e in now.entries)
            return not first and all(e.kind == _COMPACTION for e in missed)
        covered = {name for e in missed for name in e.covers}
        repeated = {e.run_id for e in missed}
        own = {e.run_id for e in self.state.entries if e.attempt in self.covers}
        return not covered & set(self.covers) and not own & repeated


def _layout(table: Table | None) -> list[str]:
    return ["report_dt"] if table is schemas.REPORT else []


def settle(rows: DataFrame, folder: str, table: Table | None = None) -> DataFrame:
    """Write rows to a folder, replacing what it held, and read them back.

    A report is laid out by its day, so that reading one day opens no other. Row groups of a
    fact carry a Bloom filter of their keys, so that a batch opens only those that may hold
    one of its keys, whatever their order.
    """
    writer = rows.write.mode("overwrite").partitionBy(*_layout(table))
    if table in schemas.FACTS:
        writer = writer.option(f"parquet.bloom.filter.enabled#{table.key}", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
