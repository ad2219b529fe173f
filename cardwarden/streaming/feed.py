"""The transaction feed as a file stream into the warehouse: new facts, fraud events, rejects.

A micro-batch is a run of the warehouse like any other: it writes into folders of its own and
is published by one manifest entry, so its facts, events and rejects appear together or not
at all, and nightly runs and streams see each other's rows and files. The run is named after
the query and the batch, so a replayed batch that has been published is not loaded again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardwarden.functions.parsing import file_day, load_order
from cardwarden.operators import staging
from cardwarden.operators.incremental import LOAD_ORDER
from cardwarden.plans.fraud import fraud_events, opened_before
from cardwarden.plans.nightly import new_rows
from cardwarden.plans.warehouse import ConcurrentRun, Run, Warehouse
from cardwarden.schemas import REJECTS, REPORT, TRANSACTIONS, Table
from cardwarden.session import tune
from cardwarden.sources.delimited import FILE_OPTIONS, MALFORMED, RAW_SCHEMA
from cardwarden.sources.drops import DroppedFile

# How often a micro-batch starts over because a run was published meanwhile.
_TRIES = 5
_FILE = ("source_file", "source_length", "source_modified")


def transaction_stream(
    spark: SparkSession,
    folder: str,
    pattern: str = "*transactions*",
    archive: str | None = None,
    files_per_batch: int | None = None,
    keep_malformed: bool = False,
) -> DataFrame:
    """Raw lines of new files. Files done with are moved to ``archive`` by a later run.

    A line with the wrong number of fields fails the stream, or is kept whole for the
    rejects. Exactly-once comes from the checkpoint of the query, not from the move.
    """
    options = {**FILE_OPTIONS, "pathGlobFilter": pattern}
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    if files_per_batch:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    reader = spark.readStream.options(**options)
    if keep_malformed:
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED).schema(
            f"{RAW_SCHEMA}, {MALFORMED} string"
        )
    else:
        reader = reader.option("mode", "FAILFAST").schema(RAW_SCHEMA)
    return reader.csv(folder).withColumns(
        {
            "source_file": F.col("_metadata.file_name"),
            "source_length": F.col("_metadata.file_size"),
            "source_modified": F.unix_millis("_metadata.file_modification_time"),
        }
    )


def load_feed(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    history: Callable[[SparkSession], DataFrame] | None = None,
    watch: Callable[[SparkSession], DataFrame] | None = None,
    report_dt: Column | None = None,
    enforce_lengths: bool = True,
    keep_rejects: bool = False,
    order: Column | None = None,
) -> StreamingQuery:
    """Load the stream's new transactions into the warehouse at ``root``.

    ``history`` gives facts kept elsewhere that count as known. With ``watch``, new
    transactions are judged, each once; it is called for every micro-batch, so that each is
    judged by the dimensions of its time (``nightly.current_watch`` writes one list per
    state). The report day defaults to the day in the name of the file the transaction came
    in; a file without one fails the batch.

    Of a key that several files of a batch bring, the first file counts, in the order of
    ``order`` (the days in their names, then the names). Files that another run has loaded
    are passed over. With ``keep_rejects``, lines that cannot be typed go into the rejects
    table with the batch, and the feed goes on.
    """
    day = file_day(F.col("source_file")) if report_dt is None else report_dt
    file_order = load_order(F.col("source_file")) if order is None else order

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = tune(batch.sparkSession)
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        for attempt in range(_TRIES):
            try:
                return load_once(batch, f"stream-{query}-{batch_id}")
            except ConcurrentRun:
                if attempt + 1 == _TRIES:
                    raise

    def load_once(batch: DataFrame, run_id: str) -> None:
        spark = batch.sparkSession
        warehouse = Warehouse(spark, root)
        state = warehouse.state()
        if any(run.run_id == run_id for run in state.runs):
            return
        # The files of one batch, by name.
        named = set(_FILE) <= set(batch.columns)
        found = batch.select(*_FILE).distinct().collect() if named else ()
        files = {DroppedFile(*row) for row in found} - state.files()
        run = warehouse.begin(run_id, sorted(files, key=lambda file: file.name), state)
        if named:
            batch = batch.where(F.col("source_file").isin([file.name for file in files]))
        if keep_rejects:
            batch = run.stage("lines", batch)
            refused = staging.rejects(batch, TRANSACTIONS)
            batch = staging.accepted(batch, TRANSACTIONS)
        dated = F.when(day.isNull(), F.raise_error(F.lit("no report day for a transaction")))
        staged = staging.stage_transactions(
            batch,
            dated.otherwise(day).alias("report_day"),
            *([file_order.alias(LOAD_ORDER)] if order is not None or len(files) > 1 else []),
            enforce_lengths=enforce_lengths,
        )
        known = state.table(TRANSACTIONS)
        if history is not None:
            known = known.unionByName(history(spark).select(*TRANSACTIONS.columns))
        fresh = run.write_transactions(new_rows(run, TRANSACTIONS, staged, known, "report_day"))
        if keep_rejects:
            run.write(REJECTS, refused.select(*REJECTS.columns), rebalance=True)
        if watch is not None:
            events = _judged(fresh, watch(spark), run)
            run.write(REPORT, events, rebalance=True)
            days = fresh.select("report_day").distinct().collect()
            run.report_days |= {row.report_day for row in days}
        run.publish()

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _judged(fresh: DataFrame, watch: DataFrame, run: Run) -> DataFrame:
    """Events of the fresh transactions, from spans that open before the last of their days."""
    if run.last_trans_date is not None:
        watch = opened_before(watch, run.last_trans_date)
    return fraud_events(fresh, watch, F.col("report_day"))


def loaded(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """Everything published so far to a table of the warehouse at ``root``."""
    return Warehouse(spark, root).table(table)
