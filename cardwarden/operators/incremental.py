"""Insert-only load: which rows of a batch are new to a table that never changes its rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Writes a named intermediate table and returns it as read back, with its true size.
Hold = Callable[[str, DataFrame], DataFrame]

# Column that tells the files of a batch apart, in the order in which they would be loaded.
LOAD_ORDER = "load_order"
# Keys of a batch that a scan of the target is told one by one. Spark turns them into nested
# comparisons, so there must not be too many.
FEW_KEYS = 256
# Rows from which on a batch is no longer expected to be broadcast by its keys, and how many of
# them show at first whether it has more than a few keys.
MANY_ROWS = 1_000_000
_FIRST_ROWS = 10_000


def insert_new(
    batch: DataFrame,
    target: DataFrame,
    key: str,
    offered: DataFrame | None = None,
    hold: Hold | None = None,
    many: bool = False,
) -> DataFrame:
    """Batch rows whose key the target does not hold.

    Rows sharing a key within the batch all pass, and rows without a key always pass, since
    NULL matches nothing.

    The target is the big side. An anti join would shuffle all of its keys, because only
    its right side may be broadcast. So the target's keys are first cut down to those the
    batch also has: a semi join that streams one target column past the broadcast batch
    keys (or past a shuffle, once the batch outgrows the broadcast limit). ``distinct``
    combines before its shuffle, so what is left is at most one row per batch key, however
    often the target repeats one.

    The hints give both key lists a shuffle of their own. It moves few bytes, and it lets
    AQE see their true size before they are joined: it broadcasts a short list, and beside
    a long one it can split a key that holds a large share of the target or of the batch.
    Rows without a key could not be split off like that and skip the join.

    ``offered`` are rows with the same keys as the batch, if those are cheaper to read. With
    ``hold`` the keys both sides have are written before the batch meets them: where they are
    few, its rows are not shuffled, as they would be beside a list of yet unknown length.
    ``many`` tells that the batch is beyond any broadcast; then one aggregate over the keys of
    both sides finds the common ones, instead of a join that sorts both.
    """
    keyed = batch.where(F.col(key).isNotNull())
    unkeyed = batch.where(F.col(key).isNull())
    offered = keyed if offered is None else offered.where(F.col(key).isNotNull())
    if many:
        known = _common(offered, target.where(F.col(key).isNotNull()), key)
    else:
        offered = offered.select(key).distinct()
        known = target.select(key).join(offered, key, "left_semi").distinct()
    known = hold("known", known) if hold else known.hint("rebalance")
    fresh = keyed.join(known, key, "left_anti").select(*batch.columns)
    return fresh.unionByName(unkeyed)


def _common(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The keys that both sides hold, each once."""
    sides = left.select(key, F.lit(1).alias("_side")).unionByName(
        right.select(key, F.lit(2).alias("_side"))
    )
    spans = sides.groupBy(key).agg(F.min("_side").alias("_low"), F.max("_side").alias("_high"))
    return spans.where("_low < _high").select(key)


def insert_new_in_order(
    batches: DataFrame, key: str, order: str, hold: Hold | None = None, single: bool = False
) -> DataFrame:
    """What loading several batches one after another into an empty table leaves.

    A row stays when its batch is the first to bring its key. One aggregate finds that
    batch for every key, instead of one anti join per batch. The two are compared by ``<=``,
    since an equality would become a join key and shuffle the aggregate again; no row comes
    before the first.

    With ``hold``, only the keys that several batches bring are written and met, so that the
    rows are shuffled only if those are many. ``single`` tells that all rows are of one batch:
    it stays as it is.
    """
    if single:
        return batches
    keyed = batches.where(F.col(key).isNotNull())
    unkeyed = batches.where(F.col(key).isNull())
    if hold:
        brought = keyed.groupBy(F.col(key).alias("_key")).agg(
            F.min(order).alias("_first"),
            F.max(order).alias("_last"),
            (F.count("*") > F.count(order)).alias("_unordered"),
        )
        again = brought.where("_first < _last or _unordered").select("_key", "_first")
        repeated = hold("repeated", again)
        in_time = F.coalesce(F.col(order) <= F.col("_first"), F.lit(False))
        kept = keyed.join(repeated, (F.col(key) == F.col("_key")) & ~in_time, "left_anti")
        return kept.select(*batches.columns).unionByName(unkeyed)
    first = keyed.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_first"))
    matches = (F.col(key) == F.col("_key")) & (F.col(order) <= F.col("_first"))
    kept = keyed.join(first, matches, "left_semi").select(*batches.columns)
    return kept.unionByName(unkeyed)


def possible_matches(
    target: DataFrame, batch: DataFrame, key: str, many: bool = False
) -> DataFrame:
    """The target rows that a written batch can match, by a filter that reaches the scan.

    A join's keys do not reach the Parquet scan, a comparison with constants does. The keys
    of a small batch are listed, so that row groups are skipped by their Bloom filters,
    however the keys lie; those of a large one are given as a range, for the statistics of
    keys that grow over time. Brings at most ``FEW_KEYS`` keys and one to the driver. Of a
    batch of ``many`` rows the first ones are looked at before all of them are.
    """
    held = batch.where(F.col(key).isNotNull()).select(key)

    def some(rows: DataFrame) -> list:
        return [row[0] for row in rows.distinct().limit(FEW_KEYS + 1).collect()]

    keys = some(held.limit(_FIRST_ROWS)) if many else []
    if len(keys) <= FEW_KEYS:
        keys = some(held)
    if len(keys) <= FEW_KEYS:
        return target.where(F.col(key).isin(keys) if keys else F.lit(False))
    low, high = held.agg(F.min(key), F.max(key)).first()
    return target.where(F.col(key).between(low, high))
