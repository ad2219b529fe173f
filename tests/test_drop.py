"""Drops and runs that go wrong or come at odd times: order of files, changed files, two runs
at once, archives, crashes, compaction and retention."""

import datetime as dt
import os
import random
import threading
import time

import pytest

from cardwarden import schemas
from cardwarden.plans import nightly
from cardwarden.plans import warehouse as warehouse_module
from cardwarden.plans.nightly import Feeds, current_watch, run_batch, run_drop
from cardwarden.plans.warehouse import ConcurrentRun, FinalRun, Warehouse
from cardwarden.sources.drops import DroppedFile, drop_files
from cardwarden.sources.shared import SharedFiles
from tests.test_files import DAY, bank_tables, feeds, line, write_book, write_lines

SECOND, THIRD = dt.date(2021, 3, 2), dt.date(2021, 3, 3)


@pytest.fixture
def places(tmp_path):
    (tmp_path / "drop").mkdir()
    return tmp_path


def run(spark, places, **options):
    warehouse = Warehouse(spark, str(places / "dwh"))
    return run_drop(warehouse, str(places / "drop"), bank_tables(spark), **options)


def held(spark, places, table=schemas.TRANSACTIONS):
    return Warehouse(spark, str(places / "dwh")).table(table)


def ids(spark, places):
    return sorted((r.trans_id, r.card_num) for r in held(spark, places).collect())


def test_files_of_one_day_load_one_after_another(spark, places):
    drop = places / "drop"
    write_lines(drop / "transactions_a_02032021.txt", line(1, SECOND), line(2, SECOND, "x"), line(2, SECOND, "y"))
    write_lines(drop / "transactions_b_02032021.txt", line(1, SECOND, "later"), line(3, SECOND))
    for name, day in (("01032021", dt.date(2021, 1, 5)), ("02032021", dt.date(2021, 1, 9))):
        write_book(drop / f"passport_blacklist_{name}.xlsx", schemas.BLACKLIST_SHEET, [(day, "p1")])
    assert run(spark, places) == [SECOND]
    # The first file that brings a key wins; copies within that file all pass.
    assert ids(spark, places) == [("1", "c1"), ("2", "x"), ("2", "y"), ("3", "c1")]
    listed = held(spark, places, schemas.BLACKLIST).collect()
    assert [tuple(r) for r in listed] == [(dt.date(2021, 1, 5), "p1")]
    report = held(spark, places, schemas.REPORT).groupBy("event_type").count()
    assert dict(report.collect()) == {"1": 2, "2": 2}


def test_of_two_terminal_files_of_a_day_the_last_counts(spark, places):
    drop = places / "drop"
    write_lines(drop / "transactions_02032021.txt", line(1, SECOND))
    for name in ("terminals_02032021", "terminals_a_02032021"):
        write_book(drop / f"{name}.xlsx", schemas.TERMINALS_SHEET, [("T1", "ATM", name, "s")])
    assert run(spark, places) == [SECOND]
    assert [r.terminal_city for r in held(spark, places, schemas.TERMINALS).collect()] == [
        "terminals_a_02032021"
    ]
    assert run(spark, places) == []


def test_new_content_under_an_old_name_is_loaded(spark, places):
    path = places / "drop" / "transactions_02032021.txt"
    write_lines(path, line(1, SECOND))
    assert run(spark, places) == [SECOND]
    os.utime(path, (1, 1))  # moved back without a change of content: loaded again, adds nothing
    assert run(spark, places) == [SECOND] and ids(spark, places) == [("1", "c1")]
    write_lines(path, line(1, SECOND, "other"), line(2, SECOND))
    assert run(spark, places) == [SECOND]
    assert ids(spark, places) == [("1", "c1"), ("2", "c1")]
    assert run(spark, places) == []
    report = held(spark, places, schemas.REPORT).where("event_type = '2'")
    assert [r.report_dt for r in report.collect()] == [SECOND] * 2


def test_loaded_files_are_put_away(spark, places):
    drop, archive = places / "drop", places / "archive"
    path = drop / "transactions_02032021.txt"
    for number in (1, 2, 3):
        write_lines(path, line(number, SECOND))
        (drop / "notes.txt").write_text("not ours")
        assert run(spark, places, archive=str(archive)) == [SECOND]
        assert sorted(os.listdir(drop)) == ["notes.txt"]
    names = os.listdir(archive)
    assert len(names) == 3 and all(name.endswith(".backup") for name in names)
    assert ids(spark, places) == [("1", "c1"), ("2", "c1"), ("3", "c1")]


def test_files_can_be_renamed_in_place(spark, places):
    drop = places / "drop"
    write_lines(drop / "transactions_02032021.txt", line(1, SECOND))
    assert run(spark, places, archive=str(drop)) == [SECOND]
    assert os.listdir(drop) == ["transactions_02032021.txt.backup"]
    assert drop_files(spark, str(drop)).count() == 0
    assert run(spark, places, archive=str(drop)) == []


def test_a_crash_between_publishing_and_moving(spark, places, monkeypatch):
    drop, archive = places / "drop", str(places / "archive")
    write_lines(drop / "transactions_02032021.txt", line(1, SECOND))
    write_lines(drop / "transactions_03032021.txt", line(2, THIRD))
    write_lines(drop / "transactions_b_02032021.txt", line(3, SECOND))
    moved = []

    def dies(self, source, target):
        if moved:
            raise OSError("the job was killed")
        moved.append(source)
        return True_move(self, source, target)

    True_move = SharedFiles.move

    def only_files(self, source, target):
        return dies(self, source, target) if "/drop/" in source else True_move(self, source, target)

    monkeypatch.setattr(SharedFiles, "move", only_files)
    with pytest.raises(OSError):
        run(spark, places, archive=archive)
    monkeypatch.undo()
    assert len(os.listdir(drop)) == 2 and ids(spark, places) == [("1", "c1"), ("3", "c1")]
    # The file that was loaded but not moved is moved, and only the other one is loaded.
    assert run(spark, places, archive=archive) == [THIRD]
    assert os.listdir(drop) == [] and len(os.listdir(archive)) == 3
    assert ids(spark, places) == [("1", "c1"), ("2", "c1"), ("3", "c1")]


def test_a_run_that_missed_a_publication_fails(spark, places):
    warehouse = Warehouse(spark, str(places / "dwh"))
    run_batch(warehouse, feeds(spark, [1]), "a", DAY, DAY)
    late = warehouse.begin("late")
    late.write_transactions(feeds(spark, [1, 7]).transactions)
    run_batch(warehouse, feeds(spark, [7]), "b", DAY, DAY)
    with pytest.raises(ConcurrentRun):
        late.publish()
    assert sorted(r.trans_id for r in held(spark, places).collect()) == ["1", "7"]
    assert [entry.sequence for entry in warehouse.state().entries] == [1, 2]


def test_of_two_runs_at_once_no_key_comes_twice(spark, places):
    warehouse = Warehouse(spark, str(places / "dwh"))
    ready, failed = threading.Barrier(2), []

    def load(name):
        ready.wait()
        try:
            run_batch(warehouse, feeds(spark, [1, 2, 3]), name, DAY, DAY)
        except ConcurrentRun:
            failed.append(name)

    threads = [threading.Thread(target=load, args=(name,)) for name in "ab"]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(r.trans_id for r in held(spark, places).collect()) == ["1", "2", "3"]
    for name in failed:
        run_batch(warehouse, feeds(spark, [1, 2, 3]), name, DAY, DAY)
    assert sorted(r.trans_id for r in held(spark, places).collect()) == ["1", "2", "3"]


def test_a_drop_loads_on_top_of_what_came_between(spark, places, monkeypatch):
    write_lines(places / "drop" / "transactions_02032021.txt", line(1, SECOND), line(2, SECOND))
    warehouse, plain, calls = Warehouse(spark, str(places / "dwh")), nightly.run_batch, []

    def interrupted(target, found, run_id, *rest):
        started = target.state()
        if not calls:
            calls.append(run_id)
            plain(warehouse, feeds(spark, [2]), "between", DAY, DAY)
            monkeypatch.setattr(Warehouse, "state", lambda self: started)
            try:
                return plain(target, found, run_id, *rest)
            finally:
                monkeypatch.setattr(Warehouse, "state", state)
        return plain(target, found, run_id, *rest)

    state = Warehouse.state
    monkeypatch.setattr(nightly, "run_batch", interrupted)
    assert run(spark, places) == [SECOND]
    assert ids(spark, places) == [("1", "c1"), ("2", "c1")]
    with pytest.raises(ConcurrentRun):
        calls.clear()
        write_lines(places / "drop" / "transactions_03032021.txt", line(5, THIRD))
        monkeypatch.setattr(nightly, "run_batch", interrupted)
        run(spark, places, retries=0)


def files_below(folder):
    return sum(len(names) for _, _, names in os.walk(folder))


def test_compaction_and_retention(spark, places):
    warehouse = Warehouse(spark, str(places / "dwh"))
    for number in range(1, 6):
        day = dt.date(2021, 3, number)
        run_batch(warehouse, feeds(spark, [number, 100 + number]), day.isoformat(), day, day)
    old = warehouse.state()
    facts, report = old.table(schemas.TRANSACTIONS), old.table(schemas.REPORT)
    before = (sorted(facts.collect()), sorted(report.collect()))
    assert set(warehouse.compact()) == {"fact_transactions", "rep_fraud"}
    assert warehouse.compact() == []
    now = warehouse.state()
    tables = (schemas.TRANSACTIONS, schemas.REPORT)
    assert [len(now.holding(t)) for t in tables] == [1, 1]
    assert tuple(sorted(now.table(t).collect()) for t in tables) == before
    # Readers of the older state go on.
    assert (sorted(facts.collect()), sorted(report.collect())) == before
    assert warehouse.expire(keep_states=10, older_than_seconds=0) > 0  # staging
    assert (sorted(facts.collect()), sorted(report.collect())) == before
    assert os.listdir(places / "dwh" / "_staging") == []
    # A run that goes on after a compaction, and one that may not be repeated any more.
    run_batch(warehouse, feeds(spark, [5, 6]), "next", DAY, DAY, history="new")
    with pytest.raises(FinalRun):
        run_batch(warehouse, feeds(spark, [5, 6]), "2021-03-01", DAY, DAY)
    run_batch(warehouse, feeds(spark, [5, 6, 7]), "next", DAY, DAY, history="new")
    many = files_below(places / "dwh")
    assert warehouse.expire(keep_states=1, older_than_seconds=0) > 0
    assert files_below(places / "dwh") < many
    found = sorted(r.trans_id for r in warehouse.table(schemas.TRANSACTIONS).collect())
    assert found == sorted([str(n) for n in range(1, 8)] + [str(100 + n) for n in range(1, 6)])
    assert warehouse.table(schemas.CLIENTS).count() == 1
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        old.table(schemas.TRANSACTIONS).collect()


def test_entries_are_folded_into_one_file(spark, places, monkeypatch):
    monkeypatch.setattr(warehouse_module, "_OWN_FILES", 3)
    warehouse = Warehouse(spark, str(places / "dwh"))
    manifest = places / "dwh" / "_manifest"
    stale = warehouse.begin("stale")
    stale.written.append("fact_transactions")
    for number in range(1, 11):
        run = warehouse.begin(f"r{number}", [DroppedFile(f"f{number}", number, 2)])
        run.report_days.add(DAY)
        run.publish()
        assert [e.sequence for e in warehouse.state().entries] == list(range(1, number + 1))
        assert len([n for n in os.listdir(manifest) if n.endswith(".json")]) <= 4
    state = warehouse.state()
    assert [run.run_id for run in state.runs] == [f"r{n}" for n in range(1, 11)]
    assert state.files() == {DroppedFile(f"f{n}", n, 2) for n in range(1, 11)}
    assert state.report_days() == {DAY}
    # Entry 1 has no file of its own any more, and is still taken.
    assert not os.path.exists(warehouse.entry_path(1))
    with pytest.raises(ConcurrentRun):
        stale.publish()
    assert not os.path.exists(warehouse.entry_path(1))
    assert warehouse.fold() and not warehouse.fold()
    assert os.listdir(manifest).count("base-000000000010.json") == 1
    assert warehouse.state().entries == state.entries
    warehouse.begin("next").publish()
    assert warehouse.state().sequence == 11


def test_entries_folded_while_they_are_read(spark, places, monkeypatch):
    warehouse = Warehouse(spark, str(places / "dwh"))
    for number in range(3):
        warehouse.begin(f"r{number}").publish()
    read, folded = SharedFiles.read, []

    def between(self, path):
        if not folded:
            folded.append(path)
            monkeypatch.setattr(SharedFiles, "read", read)
            warehouse.fold()
            monkeypatch.setattr(SharedFiles, "read", between)
        return read(self, path)

    monkeypatch.setattr(SharedFiles, "read", between)
    assert [e.sequence for e in warehouse.state().entries] == [1, 2, 3]
    os.remove(warehouse.base_path(3))
    with open(warehouse.entry_path(5), "w") as file:
        file.write("")
    with pytest.raises(FileNotFoundError, match="gaps"):
        warehouse.state()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_drop_equals_its_files_one_by_one(spark, places, seed):
    """Any files at once, in any state of the warehouse, load as one after another."""
    draw = random.Random(seed)
    expected, listed = [], []
    for round_ in range(2):
        files = {}
        for name in draw.sample("abcdefgh", 4):
            day = draw.choice([SECOND, THIRD])
            rows = [(draw.choice(["", *"123456789"]), f"{name}{round_}{at}") for at in range(4)]
            files[day, f"transactions_{name}{round_}_{day:%d%m%Y}.txt"] = rows
        for (day, name), rows in files.items():
            write_lines(places / "drop" / name, *(line(k, day, card) for k, card in rows))
        for day in {day for day, _ in files}:
            entries = [(draw.choice("pqrst"), draw.choice([5, 6, 7])) for _ in range(3)]
            name = f"passport_blacklist_{round_}_{day:%d%m%Y}.txt"
            (places / "drop" / name).write_text(
                "day;passport\n" + "".join(f"2021-01-0{n};{p}\n" for p, n in entries)
            )
            files[day, name] = entries
        for (_, name), rows in sorted(files.items()):
            target = listed if "blacklist" in name else expected
            known = {k for k, _ in target}
            target += [(k, v) for k, v in rows if not k or k not in known]
        run(spark, places)
    found = [(r.trans_id or "", r.card_num) for r in held(spark, places).collect()]
    assert sorted(found) == sorted(expected)
    entries = held(spark, places, schemas.BLACKLIST).collect()
    assert sorted((r.passport_num, r.entry_dt.day) for r in entries) == sorted(listed)


def test_retention_spares_a_run_at_work(spark, places):
    warehouse = Warehouse(spark, str(places / "dwh"))
    run_batch(warehouse, feeds(spark, [1]), "a", DAY, DAY)
    working = warehouse.begin("b")
    working.write_transactions(feeds(spark, [2]).transactions)
    warehouse.expire(keep_states=1, older_than_seconds=3600)
    working.publish()
    assert warehouse.table(schemas.TRANSACTIONS).count() == 2
    dead = warehouse.begin("c")
    dead.write_transactions(feeds(spark, [3]).transactions)
    time.sleep(0.05)
    assert warehouse.expire(keep_states=1, older_than_seconds=0) > 0
    assert not os.path.exists(places / "dwh" / "fact_transactions" / "run_id=c")


def test_a_run_passes_a_compaction(spark, places):
    warehouse = Warehouse(spark, str(places / "dwh"))
    for name, number in (("a", 1), ("b", 2)):
        run_batch(warehouse, feeds(spark, [number]), name, DAY, DAY)
    working = warehouse.begin("c")
    working.write_transactions(feeds(spark, [3]).transactions)
    assert "fact_transactions" in warehouse.compact()
    working.publish()
    found = sorted(r.trans_id for r in warehouse.table(schemas.TRANSACTIONS).collect())
    assert found == ["1", "2", "3"]
    repeated = Warehouse(spark, str(places / "dwh"))
    run_batch(repeated, feeds(spark, [4]), "d", DAY, DAY)
    state = repeated.state()
    again = repeated.begin("d", state=state)
    again.write_transactions(feeds(spark, [4, 5]).transactions)
    assert "fact_transactions" in repeated.compact()
    with pytest.raises(ConcurrentRun):  # its first attempt has been merged meanwhile
        again.publish()


def test_one_watch_list_per_state_of_the_dimensions(spark, places):
    warehouse = Warehouse(spark, str(places / "dwh"))
    run_batch(warehouse, feeds(spark, [1]), "a", DAY, DAY)

    def lists():
        root = places / "dwh" / "_watch"
        return sum(len(os.listdir(root / key)) for key in os.listdir(root))

    first = sorted(current_watch(warehouse).collect())
    assert sorted(current_watch(warehouse).collect()) == first and lists() == 1
    only_facts = feeds(spark, [2])
    run_batch(warehouse, Feeds(transactions=only_facts.transactions), "b", DAY, DAY)
    assert sorted(current_watch(warehouse).collect()) == first and lists() == 1
    accounts = bank_tables(spark, dt.date(2030, 1, 1))["accounts"].withColumnRenamed("account", "account_num")
    run_batch(warehouse, feeds(spark, [3], accounts=accounts), "c", DAY, DAY)
    assert sorted(current_watch(warehouse).collect()) != first and lists() == 2
    warehouse.expire(keep_states=1, older_than_seconds=-1)
    assert lists() == 1


def test_identity_of_a_file():
    file = DroppedFile("a", 1, 2)
    assert file == DroppedFile("a", 1, 2) != DroppedFile("a", 1, 3)
