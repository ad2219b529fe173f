"""Files to tables: delimited files, workbooks, drop folders, whole nightly runs."""

import datetime as dt

import pytest

from cardwarden import schemas
from cardwarden.operators import staging
from cardwarden.operators.incremental import possible_matches
from cardwarden.plans.nightly import (
    EmptySnapshot,
    Feeds,
    UndatedFile,
    append_report_once,
    run_batch,
    run_drop,
)
from cardwarden.plans.warehouse import Warehouse
from cardwarden.sources.delimited import MALFORMED, read_transactions
from cardwarden.sources.drops import drop_files
from cardwarden.sources.workbook import read_workbooks, sheet_rows
from cardwarden.testbed.workbooks import workbook_bytes

HEADER = ";".join(schemas.TRANSACTION_FILE)
DAY = dt.date(2021, 3, 1)


def write_lines(path, *lines):
    path.write_text("\n".join([HEADER, *lines]) + "\n")


def write_book(path, layout, rows):
    path.write_bytes(workbook_bytes(layout[0], layout[1], rows))


def line(number, day, card="c1"):
    return f"{number};{day} 10:00:00;1,50;{card};PAYMENT;SUCCESS;T1"


def test_several_files_keep_their_name(spark, tmp_path):
    write_lines(tmp_path / "transactions_01032021.txt", line(1, "2021-03-01"))
    write_lines(tmp_path / "transactions_02032021.txt", line(2, "2021-03-02"))
    rows = {r.trans_id: r.source_file for r in read_transactions(spark, str(tmp_path)).collect()}
    assert rows == {"1": "transactions_01032021.txt", "2": "transactions_02032021.txt"}


def test_short_line_fails_or_is_kept(spark, tmp_path):
    write_lines(tmp_path / "transactions_01032021.txt", line(1, "2021-03-01"), "2;2021-03-01")
    with pytest.raises(Exception, match="MALFORMED"):
        read_transactions(spark, str(tmp_path)).collect()
    kept = read_transactions(spark, str(tmp_path), keep_malformed=True).collect()
    assert [r[MALFORMED] for r in kept if r[MALFORMED]] == ["2;2021-03-01"]


def test_workbook_rows(spark, tmp_path):
    write_book(
        tmp_path / "passport_blacklist_01032021.xlsx",
        schemas.BLACKLIST_SHEET,
        [(DAY, "0012 345678"), (None, "a & <b>"), (dt.date(2020, 2, 29), None)],
    )
    raw = read_workbooks(spark, str(tmp_path), *schemas.BLACKLIST_SHEET)
    rows = [tuple(r) for r in staging.stage_blacklist(raw).collect()]
    assert rows == [(DAY, "0012 345678"), (None, "a & <b>"), (dt.date(2020, 2, 29), None)]


def test_workbook_longer_than_one_frame(spark, tmp_path):
    rows = [(f"t{n}", "ATM", "city", None) for n in range(25_000)]
    for book in "ab":
        write_book(tmp_path / f"{book}.xlsx", schemas.TERMINALS_SHEET, rows)
    read = read_workbooks(spark, str(tmp_path), *schemas.TERMINALS_SHEET)
    assert read.count() == 50_000
    assert read.where("terminal_address is not null").count() == 0


def test_inline_strings_numbers_and_gaps():
    import io
    import zipfile

    book = io.BytesIO(workbook_bytes("s", ["a"], []))
    cells = (
        '<row r="1"><c r="A1"/></row>'
        '<row r="2"><c r="B2" t="inlineStr"><is><r><t>x</t></r><r><t>y</t></r></is></c></row>'
        '<row r="3"><c><v>12.5</v></c><c t="str"><v>z</v></c><c t="e"><v>#N/A</v></c></row>'
    )
    with zipfile.ZipFile(book) as source:
        parts = {name: source.read(name) for name in source.namelist()}
    parts["xl/worksheets/sheet2.xml"] = f"<worksheet><sheetData>{cells}</sheetData></worksheet>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as target:
        for name, content in parts.items():
            target.writestr(name, content)
    assert list(sheet_rows(out.getvalue(), "s")) == [[None, "xy"], ["12.5", "z", None]]
    with pytest.raises(ValueError, match="no sheet"):
        list(sheet_rows(out.getvalue(), "other"))


def test_drop_listing(spark, tmp_path):
    for name in (
        "transactions_02032021.txt",
        "transactions_01042021.txt",
        "passport_blacklist_02032021.xlsx",
        "terminals_02032021.xlsx",
        "transactions_01032021.txt.backup",
        "notes.txt",
    ):
        (tmp_path / name).write_text("x")
    listed = {(r.drop_day, r.feed) for r in drop_files(spark, str(tmp_path)).collect()}
    second, april = dt.date(2021, 3, 2), dt.date(2021, 4, 1)
    assert listed == {
        (second, "transactions"),
        (april, "transactions"),
        (second, "passport_blacklist"),
        (second, "terminals"),
    }


def bank_tables(spark, valid_to=dt.date(2021, 2, 1)):
    stamps = ", create_dt date, update_dt date"
    return {
        "clients": spark.createDataFrame(
            [("k1", "L", "F", "P", None, "p1", dt.date(2021, 2, 15), "+7", DAY, None)],
            schemas.CLIENTS.schema,
        ),
        "accounts": spark.createDataFrame(
            [("a1", valid_to, "k1", DAY, None)],
            f"account string, valid_to date, client string{stamps}",
        ),
        "cards": spark.createDataFrame(
            [("c1   ", "a1", DAY, None)], f"card_num string, account string{stamps}"
        ),
    }


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    # By name the first of April sorts before the second of March.
    write_lines(folder / "transactions_01042021.txt", line(2, "2021-04-01"), line(1, "2021-04-01"))
    write_lines(folder / "transactions_02032021.txt", line(1, "2021-03-02"))
    for name in ("02032021", "01042021"):
        write_book(
            folder / f"passport_blacklist_{name}.xlsx", schemas.BLACKLIST_SHEET, [(DAY, "p9")]
        )
        write_book(
            folder / f"terminals_{name}.xlsx",
            schemas.TERMINALS_SHEET,
            [("T1", "ATM", name, "street")],
        )
    return str(folder)


def test_nightly_runs_over_a_drop_folder(spark, tmp_path, drop):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    first, second = dt.date(2021, 3, 2), dt.date(2021, 4, 1)
    assert run_drop(warehouse, drop, bank_tables(spark)) == [first, second]

    facts = warehouse.table(schemas.TRANSACTIONS).collect()
    assert sorted((r.trans_id, r.trans_date) for r in facts) == [("1", first), ("2", second)]
    assert warehouse.table(schemas.BLACKLIST).count() == 1
    terminal = warehouse.table(schemas.TERMINALS).collect()
    assert [tuple(r) for r in terminal] == [("T1", "ATM", "01042021", "street", first, second)]

    report = warehouse.table(schemas.REPORT).groupBy("report_dt", "event_type").count()
    counts = {(r[0], r[1]): r[2] for r in report.collect()}
    assert counts == {(first, "1"): 1, (first, "2"): 1, (second, "1"): 2, (second, "2"): 2}

    one_day = warehouse.table(schemas.REPORT).where(f"report_dt = date '{first}'")
    assert "PartitionFilters: [isnotnull(report_dt" in one_day._jdf.queryExecution().toString()

    assert run_drop(warehouse, drop, bank_tables(spark)) == []


def test_report_over_new_transactions_only(spark, tmp_path, drop):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    run_drop(warehouse, drop, bank_tables(spark), history="new")
    report = warehouse.table(schemas.REPORT).groupBy("report_dt").count()
    assert dict(report.collect()) == {dt.date(2021, 3, 2): 2, dt.date(2021, 4, 1): 2}


def feeds(spark, numbers, **more):
    rows = [(str(n), DAY, "c1", "PAYMENT", None, "SUCCESS", "T1") for n in numbers]
    tables = bank_tables(spark)
    return Feeds(
        **{
            "transactions": spark.createDataFrame(rows, schemas.TRANSACTIONS.schema),
            "clients": staging.stage_clients(tables["clients"]),
            "accounts": staging.stage_accounts(tables["accounts"]),
            "cards": staging.stage_cards(tables["cards"]),
            **more,
        }
    )


def test_repeated_run_replaces_its_rows(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for numbers in ([1, 2], [1, 2, 3]):
        run_batch(warehouse, feeds(spark, numbers), "2021-03-01", DAY, DAY)
    run_batch(warehouse, feeds(spark, [3, 4]), "2021-03-02", DAY, DAY)
    ids = [r.trans_id for r in warehouse.table(schemas.TRANSACTIONS).collect()]
    assert sorted(ids) == ["1", "2", "3", "4"]
    run_batch(warehouse, feeds(spark, [1, 2, 3]), "2021-03-01", DAY, DAY)
    again = [r.trans_id for r in warehouse.table(schemas.TRANSACTIONS).collect()]
    assert sorted(again) == sorted(ids)
    assert warehouse.table(schemas.CLIENTS).count() == 1


def test_failed_run_is_not_visible(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    run_batch(warehouse, feeds(spark, [1]), "2021-03-01", DAY, DAY)
    empty = spark.createDataFrame([], schemas.CARDS.schema)
    broken = Feeds(transactions=feeds(spark, [2]).transactions, cards=empty)
    with pytest.raises(EmptySnapshot):
        run_batch(warehouse, broken, "2021-03-02", DAY, DAY, allow_empty_snapshot=False)
    assert warehouse.table(schemas.TRANSACTIONS).count() == 1
    assert warehouse.table(schemas.CARDS).count() == 1
    run_batch(warehouse, broken, "2021-03-02", DAY, DAY)
    assert warehouse.table(schemas.CARDS).count() == 0


def test_no_transaction_feed_no_run(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert not run_batch(warehouse, Feeds(transactions=None), "2021-03-01", DAY, DAY)
    assert warehouse.state().runs == ()


def test_report_day_is_appended_once(spark):
    row = (DAY, "p", "n", "+7", "1", DAY)
    held = spark.createDataFrame([row], schemas.REPORT.schema)
    later = (*row[:-1], dt.date(2021, 3, 2))
    offered = spark.createDataFrame([row, later, later], schemas.REPORT.schema)
    assert [tuple(r) for r in append_report_once(held, offered).collect()] == [later, later]


def test_job_from_the_command_line(spark, tmp_path, drop, capsys):
    from cardwarden import job

    for name, table in bank_tables(spark).items():
        table.write.parquet(f"{tmp_path}/bank/{name}")
    places = ["--drop", drop, "--warehouse", f"{tmp_path}/dwh", "--bank", f"{tmp_path}/bank"]
    assert job.main(places) == 0
    assert "2021-03-02, 2021-04-01" in capsys.readouterr().out
    assert job.main([*places, "--history", "new"]) == 0
    assert "no new files" in capsys.readouterr().out


def test_job_puts_files_away_and_cleans_up(spark, tmp_path, drop, capsys):
    from cardwarden import job

    for name, table in bank_tables(spark).items():
        table.write.parquet(f"{tmp_path}/bank/{name}")
    places = ["--drop", drop, "--warehouse", f"{tmp_path}/dwh", "--bank", f"{tmp_path}/bank"]
    more = ["--archive", f"{tmp_path}/done", "--compact", "--keep-states", "1"]
    assert job.main([*places, *more]) == 0
    told = capsys.readouterr().out
    assert "2021-03-02, 2021-04-01" in told and "fact_transactions" in told
    assert list((tmp_path / "drop").iterdir()) == []
    assert Warehouse(spark, f"{tmp_path}/dwh").table(schemas.TRANSACTIONS).count() == 2
    assert job.main([*places, *more]) == 0
    assert "no new files" in capsys.readouterr().out


def test_rejects_are_kept_beside_the_loaded_lines(spark, tmp_path):
    (folder := tmp_path / "drop").mkdir()
    bad = line(2, "2021-03-01").replace("1,50", "x")
    write_lines(folder / "transactions_01032021.txt", line(1, "2021-03-01"), bad, "3;2021-03-01")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    with pytest.raises(Exception, match="MALFORMED|unreadable amt"):
        run_drop(warehouse, str(folder), bank_tables(spark))
    assert run_drop(warehouse, str(folder), bank_tables(spark), keep_rejects=True) == [DAY]
    assert [r.trans_id for r in warehouse.table(schemas.TRANSACTIONS).collect()] == ["1"]
    refused = warehouse.table(schemas.REJECTS).collect()
    assert sorted((r.trans_id, r.problems) for r in refused) == [("2", "amt"), ("3", MALFORMED)]


def test_only_rows_a_batch_can_match_are_looked_at(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for n, numbers in enumerate(([10, 11], [20, 21], [None], [15, 30]), start=1):
        day = dt.date(2021, 3, n)
        rows = [(n and str(n), day, "c1", "", None, "", "") for n in numbers]
        batch = spark.createDataFrame(rows, schemas.TRANSACTIONS.schema)
        run_batch(warehouse, Feeds(transactions=batch), day.isoformat(), day, day)
    held = warehouse.table(schemas.TRANSACTIONS)
    assert held.count() == 7

    def matches(*keys):
        batch = spark.createDataFrame([(k,) for k in keys], "trans_id string")
        return sorted(r.trans_id for r in possible_matches(held, batch, "trans_id").collect())

    assert matches("11", "12", None) == ["11"] and matches("15", "20") == ["15", "20"]
    assert matches("4", "5") == matches(None) == matches() == []
    many = [f"{n:05}" for n in range(1, 4000)]
    assert matches("1", *many, "20") == ["10", "11", "15", "20"]  # by their range


def test_an_irregular_drop_loses_and_doubles_nothing(spark, tmp_path):
    (folder := tmp_path / "drop").mkdir()
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    days = [dt.date(2021, 3, n) for n in range(1, 7)]

    def ids():
        return sorted(r.trans_id for r in warehouse.table(schemas.TRANSACTIONS).collect())

    def run():
        return run_drop(warehouse, str(folder), bank_tables(spark))

    write_lines(folder / "transactions_02032021.txt", line(1, "2021-03-02"))
    write_book(folder / "passport_blacklist_03032021.xlsx", schemas.BLACKLIST_SHEET, [(DAY, "p9")])
    assert run() == [days[1]]
    assert warehouse.table(schemas.BLACKLIST).count() == 0
    # A second file for that day, a late day, and one the waiting blacklist goes with.
    write_lines(folder / "transactions_b_02032021.txt", line(1, "2021-03-02"), line(2, "2021-03-02"))
    write_lines(folder / "transactions_01032021.txt", line(2, "2021-03-01"), line(3, "2021-03-01"))
    write_lines(folder / "transactions_04032021.txt", line(4, "2021-03-04"))
    for name in ("03032021", "04032021"):
        write_book(
            folder / f"terminals_{name}.xlsx", schemas.TERMINALS_SHEET, [("T1", "ATM", name, "s")]
        )
    assert run() == [days[0], days[1], days[3]]
    assert ids() == ["1", "2", "3", "4"]
    assert warehouse.table(schemas.BLACKLIST).count() == 1
    assert [r.terminal_city for r in warehouse.table(schemas.TERMINALS).collect()] == ["04032021"]
    report = warehouse.table(schemas.REPORT).where("event_type = '2'").groupBy("report_dt").count()
    assert dict(report.collect()) == {days[0]: 3, days[1]: 1, days[3]: 4}
    # A snapshot older than the one loaded does not undo it.
    write_book(
        folder / "terminals_02032021.xlsx", schemas.TERMINALS_SHEET, [("T1", "ATM", "old", "s")]
    )
    write_lines(folder / "transactions_06032021.txt", line(5, "2021-03-06"))
    assert run() == [days[5]]
    assert [r.terminal_city for r in warehouse.table(schemas.TERMINALS).collect()] == ["04032021"]
    assert run() == []
    write_lines(folder / "transactions_late.txt", line(6, "2021-03-06"))
    with pytest.raises(UndatedFile, match="transactions_late.txt"):
        run()


def test_late_bank_state_is_the_newest(spark, tmp_path):
    (folder := tmp_path / "drop").mkdir()
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    write_lines(folder / "transactions_05032021.txt", line(1, "2021-03-05"))
    run_drop(warehouse, str(folder), bank_tables(spark))
    write_lines(folder / "transactions_02032021.txt", line(2, "2021-03-02"))
    run_drop(warehouse, str(folder), bank_tables(spark, valid_to=dt.date(2021, 2, 7)))
    assert [r.valid_to for r in warehouse.table(schemas.ACCOUNTS).collect()] == [dt.date(2021, 2, 7)]


def test_late_and_repeated_runs_stay_insert_only(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for run, numbers in (("b", [1, 2]), ("d", [3, 4]), ("b", [1, 2, 3]), ("a", [2, 4, 5])):
        run_batch(warehouse, feeds(spark, numbers), run, DAY, DAY)
    ids = [r.trans_id for r in warehouse.table(schemas.TRANSACTIONS).collect()]
    assert sorted(ids) == ["1", "2", "3", "4", "5"]


def test_second_run_for_a_report_day_adds_only_its_own_events(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for run, numbers in (("a", [1, 2]), ("b", [2, 3])):
        run_batch(warehouse, feeds(spark, numbers), run, DAY, DAY)
    report = warehouse.table(schemas.REPORT).groupBy("event_type").count()
    assert dict(report.collect()) == {"1": 3, "2": 3}


def test_too_wide_workbook_row_fails(spark, tmp_path):
    write_book(tmp_path / "b.xlsx", schemas.BLACKLIST_SHEET, [(DAY, "p1", "more")])
    with pytest.raises(Exception, match="more than 2 columns"):
        read_workbooks(spark, str(tmp_path), *schemas.BLACKLIST_SHEET).collect()
