"""Dimensions that mirror the newest snapshot: insert, overwrite and hard-delete.

The merged dimension holds the snapshot's keys and no others, so the snapshot is the
preserved side of a left join; vanished keys simply find no row. Either side of such a join
may be broadcast or split at run time. A key given twice, for which an update has no defined
outcome, is refused by a count of the keys alone, combined before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions.parsing import differs
from cardwarden.schemas import Table

INSERTED, UPDATED, DELETED = "I", "U", "D"


def scd1_merge(dim: DataFrame, snapshot: DataFrame, table: Table, run_dt: date) -> DataFrame:
    """The dimension after the snapshot has been applied.

    A new key takes the snapshot row with its own dates. A changed one takes the
    snapshot's attributes, keeps ``create_dt`` and gets ``update_dt = run_dt``. An equal one
    is left alone, whatever the snapshot's dates. A key missing from the snapshot is gone.
    """
    new, changed = _is_new(), _is_changed(table)
    columns = {
        "create_dt": F.when(new, F.col("create_dt")).otherwise(F.col("d.create_dt")),
        "update_dt": F.when(new, F.col("update_dt"))
        .when(changed, F.lit(run_dt))
        .otherwise(F.col("d.update_dt")),
    }
    merged = _beside(dim, snapshot, table).select(
        *(columns.get(name, F.col(name)).alias(name) for name in table.columns)
    )
    # Rows without a key match nothing: the snapshot's are new every time, the
    # dimension's are never deleted. They stay out of the join, where they would pile up
    # in one task; on Parquet the test for NULL skips whole row groups.
    no_key = F.col(table.key).isNull()
    return (
        merged.unionByName(dim.where(no_key).select(*table.columns))
        .unionByName(snapshot.where(no_key).select(*table.columns))
        .unionByName(_refused(snapshot, table).select(*table.columns))
    )


def snapshot_diff(
    dim: DataFrame,
    snapshot: DataFrame,
    table: Table,
    kinds: Sequence[str] = (INSERTED, UPDATED, DELETED),
) -> DataFrame:
    """Rows the merge inserts (I), updates (U, new values) or deletes (D, last values).

    Only the kinds asked for are computed: one join for the first two, one for the last.
    """
    key, values = table.key, (table.key, *table.tracked)
    parts = [_refused(snapshot, table).select(F.lit(None).cast("string").alias("change"), *values)]
    if DELETED in kinds:
        parts.append(_absent(dim, snapshot, key).select(F.lit(DELETED).alias("change"), *values))
    if {INSERTED, UPDATED} <= set(kinds):
        change = F.when(_is_new(), INSERTED).when(_is_changed(table), UPDATED)
        beside = _beside(dim, snapshot, table).select(change.alias("change"), *values)
        parts.append(beside.where(F.col("change").isNotNull()))
    elif UPDATED in kinds:
        changed = _beside(dim, snapshot, table, "inner").where(_is_changed(table))
        parts.append(changed.select(F.lit(UPDATED).alias("change"), *values))
    elif INSERTED in kinds:
        parts.append(_absent(snapshot, dim, key).select(F.lit(INSERTED).alias("change"), *values))
    if INSERTED in kinds:
        unkeyed = snapshot.where(F.col(key).isNull())
        parts.append(unkeyed.select(F.lit(INSERTED).alias("change"), *values))
    return reduce(DataFrame.unionByName, parts)


def _beside(dim: DataFrame, snapshot: DataFrame, table: Table, how: str = "left") -> DataFrame:
    """Keyed snapshot rows, each beside the dimension row ``d`` of its key, if there is one."""
    key = table.key
    held = dim.where(F.col(key).isNotNull()).select(
        F.col(key).alias("d_key"),
        F.struct(*(name for name in table.columns if name != key)).alias("d"),
    )
    offered = snapshot.where(F.col(key).isNotNull()).select(*table.columns)
    return offered.join(held, offered[key] == held["d_key"], how)


def _is_new() -> Column:
    return F.col("d_key").isNull()


def _is_changed(table: Table) -> Column:
    return reduce(or_, (differs(F.col(n), F.col(f"d.{n}")) for n in table.tracked))


def _absent(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Keyed rows whose key the others lack."""
    return rows.where(F.col(key).isNotNull()).join(others.select(key), key, "left_anti")


def _refused(snapshot: DataFrame, table: Table) -> DataFrame:
    """No rows; fails the query when it runs if the snapshot gives a key twice."""
    key = table.key
    counted = snapshot.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("times"))
    complaint = F.concat(F.lit(f"snapshot of {table.name} repeats key "), F.col(key))
    twice = F.when(F.col("times") > 1, F.raise_error(complaint).cast("boolean")).otherwise(False)
    return counted.where(twice).select(
        key,
        *(
            F.lit(None).cast(field.dataType).alias(field.name)
            for field in table.schema
            if field.name != key
        ),
    )
