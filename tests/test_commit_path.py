"""Stream and nightly runs through one manifest: what each sees of the other, and crashes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.plans.nightly import current_watch, run_batch, run_drop
from cardwarden.plans.warehouse import ConcurrentRun, Run, Warehouse
from cardwarden.sources.delimited import MALFORMED
from cardwarden.streaming.feed import load_feed, transaction_stream
from tests.test_files import DAY, bank_tables, feeds, line, write_lines

FIRST, SECOND = dt.date(2021, 3, 1), dt.date(2021, 3, 2)


@pytest.fixture
def places(tmp_path):
    (tmp_path / "drop").mkdir()
    return tmp_path


def warehouse(spark, places):
    return Warehouse(spark, str(places / "dwh"))


def stream(spark, places, checkpoint="checkpoint", files_per_batch=None, **options):
    lines = transaction_stream(
        spark, str(places / "drop"), files_per_batch=files_per_batch,
        keep_malformed=options.get("keep_rejects", False),
    )
    load_feed(lines, str(places / "dwh"), str(places / checkpoint), **options).awaitTermination()


def nightly(spark, places, **options):
    return run_drop(warehouse(spark, places), str(places / "drop"), bank_tables(spark), **options)


def ids(spark, places):
    facts = warehouse(spark, places).table(schemas.TRANSACTIONS)
    return sorted(str(r.trans_id) for r in facts.collect())


def unkeyed(day):
    return f";{day} 10:00:00;1,50;c1;PAYMENT;SUCCESS;T1"


def test_neither_loads_a_file_the_other_has_loaded(spark, places):
    drop = places / "drop"
    write_lines(drop / "transactions_01032021.txt", line(1, FIRST), unkeyed(FIRST))
    stream(spark, places)
    assert ids(spark, places) == ["1", "None"]
    write_lines(drop / "transactions_02032021.txt", line(1, SECOND), line(2, SECOND), unkeyed(SECOND))
    # Lines without a key match nothing, so only the file's identity tells they are loaded.
    assert nightly(spark, places) == [SECOND]
    assert ids(spark, places) == ["1", "2", "None", "None"]
    stream(spark, places)
    assert ids(spark, places) == ["1", "2", "None", "None"]
    assert nightly(spark, places) == []


def test_a_batch_appears_as_a_whole(spark, places, monkeypatch):
    write_lines(places / "drop" / "transactions_01032021.txt", line(1, FIRST), line(2, FIRST))
    run_batch(warehouse(spark, places), feeds(spark, [9]), "before", DAY, DAY)
    report = warehouse(spark, places).table(schemas.REPORT).count()
    publish = Run.publish

    def dies(self):
        raise OSError("the driver was killed")

    def watch(session):
        return current_watch(warehouse(session, places))

    monkeypatch.setattr(Run, "publish", dies)
    with pytest.raises(Exception, match="the driver was killed"):
        stream(spark, places, watch=watch)
    assert ids(spark, places) == ["9"]
    assert warehouse(spark, places).table(schemas.REPORT).count() == report
    monkeypatch.setattr(Run, "publish", publish)
    stream(spark, places, watch=watch)
    assert ids(spark, places) == ["1", "2", "9"]
    events = warehouse(spark, places).table(schemas.REPORT)
    assert events.count() == report + 4
    assert {r.report_dt for r in events.collect()} == {FIRST}


def test_a_published_batch_is_not_loaded_again(spark, places):
    write_lines(places / "drop" / "transactions_01032021.txt", unkeyed(FIRST))
    stream(spark, places)
    commits = places / "checkpoint" / "commits"
    for name in ("0", ".0.crc"):
        if (commits / name).exists():
            os.rename(commits / name, places / f"lost{name}")
    stream(spark, places)
    assert (commits / "0").exists() and ids(spark, places) == ["None"]
    assert len(warehouse(spark, places).state().entries) == 1


def test_a_new_checkpoint_does_not_pass_for_the_old_one(spark, places):
    drop = places / "drop"
    write_lines(drop / "transactions_01032021.txt", line(1, FIRST))
    stream(spark, places)
    write_lines(drop / "transactions_02032021.txt", line(2, SECOND))
    stream(spark, places, checkpoint="another")
    assert ids(spark, places) == ["1", "2"]


def test_a_batch_starts_over_after_another_run(spark, places, monkeypatch):
    write_lines(places / "drop" / "transactions_01032021.txt", line(1, FIRST), line(2, FIRST))
    publish, calls = Run.publish, []

    def late(self):
        if not calls:
            calls.append(self.run_id)
            monkeypatch.setattr(Run, "publish", publish)
            run_batch(warehouse(spark, places), feeds(spark, [2]), "between", DAY, DAY)
        return publish(self)

    monkeypatch.setattr(Run, "publish", late)
    stream(spark, places)
    assert ids(spark, places) == ["1", "2"] and len(calls) == 1

    def never(self):
        raise ConcurrentRun(self.run_id)

    write_lines(places / "drop" / "transactions_02032021.txt", line(3, SECOND))
    monkeypatch.setattr(Run, "publish", never)
    with pytest.raises(Exception, match="ConcurrentRun"):
        stream(spark, places)
    monkeypatch.setattr(Run, "publish", publish)
    stream(spark, places)
    assert ids(spark, places) == ["1", "2", "3"]


def test_files_of_one_batch_load_in_order(spark, places):
    drop = places / "drop"
    write_lines(drop / "transactions_02032021.txt", line(1, SECOND, "late"), line(2, SECOND))
    write_lines(drop / "transactions_01032021.txt", line(1, FIRST, "early"), line(1, FIRST, "twin"))
    stream(spark, places)
    facts = warehouse(spark, places).table(schemas.TRANSACTIONS).collect()
    assert sorted((r.trans_id, r.card_num) for r in facts) == [
        ("1", "early"), ("1", "twin"), ("2", "c1")
    ]


def test_refused_lines_are_kept_and_the_feed_goes_on(spark, places):
    drop = places / "drop"
    bad = line(2, FIRST).replace("1,50", "x")
    write_lines(drop / "transactions_01032021.txt", line(1, FIRST), bad, "3;2021-03-01", "5;someday;1;c;;;")
    with pytest.raises(Exception, match="MALFORMED|unreadable"):
        stream(spark, places, checkpoint="strict")
    assert ids(spark, places) == []
    stream(spark, places, keep_rejects=True)
    write_lines(drop / "transactions_02032021.txt", line(4, SECOND), line("7" * 12, SECOND))
    stream(spark, places, keep_rejects=True)
    assert ids(spark, places) == ["1", "4"]
    refused = warehouse(spark, places).table(schemas.REJECTS).collect()
    assert sorted((r.trans_id, r.problems) for r in refused) == [
        ("2", "amt"), ("3", MALFORMED), ("5", "trans_date"), ("7" * 12, "trans_id")
    ]
    assert {r.source_file for r in refused} == {f"transactions_0{n}032021.txt" for n in (1, 2)}


def test_a_file_without_a_day_fails_the_batch(spark, places):
    write_lines(places / "drop" / "transactions_late.txt", line(1, FIRST))
    with pytest.raises(Exception, match="no report day"):
        stream(spark, places)
    assert ids(spark, places) == []
    stream(spark, places, checkpoint="given", report_dt=F.lit(FIRST))
    assert ids(spark, places) == ["1"]


def test_batches_of_one_state_share_a_watch_list(spark, places):
    run_batch(warehouse(spark, places), feeds(spark, [90]), "dimensions", DAY, DAY)
    for n in (1, 2, 3):
        path = places / "drop" / f"transactions_0{n}032021.txt"
        write_lines(path, line(n, dt.date(2021, 3, n)))
        os.utime(path, (n, n))
    stream(
        spark, places, files_per_batch=1, watch=lambda s: current_watch(warehouse(s, places))
    )
    lists = places / "dwh" / "_watch"
    assert [len(os.listdir(lists / key)) for key in os.listdir(lists)] == [1]
    events = warehouse(spark, places).table(schemas.REPORT).where("event_type = '2'")
    # The day the nightly run has reported gains the events of the stream and doubles none.
    assert sorted(r.report_dt.day for r in events.collect()) == [1, 1, 2, 3]
    assert warehouse(spark, places).state().report_days() == {
        dt.date(2021, 3, n) for n in (1, 2, 3)
    }
