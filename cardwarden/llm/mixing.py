"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

The documents of a source fall into blocks by a hash. Water filling gives each source its
target in words. A source then supplies whole passes over its blocks, and for the rest of
its target a permuted draw of blocks that still fit; of one last block it takes the documents
whose sizes together come nearest to what is left, by subset sums. A tree splits the drawn blocks among output shards: each node draws, from
the block counts of all sources at once, how many of each go left. The shards get disjoint
ranges of each source's permuted blocks and are shuffled locally.

The driver holds one row per source and at most ``BLOCKS`` blocks (one per source at least); there are at most ``SHARDS`` shards.
NULL is a source of its own, last in order. NULL and empty texts have size 0; a source of
size 0 gets target 0 and nothing is drawn from it. Repeated rows (same id and text) are taken
alike. An empty table gives no rows. Extra columns are carried; names that clash with the
columns added here are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import table, word_count, written

WEIGHTS = (3, 1, 2)
BLOCKS = 1 << 16
BLOCK_ROWS = 8
SHARD_WORDS = 2_000_000
SHARDS = 4096
SEED = 17
# Words and documents of the last block that exact subset sums look at.
_BITS = 1 << 16
_ITEMS = 512


def targets(sizes: list[int], weights: list[float], total: float, most: float = 2.0) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size, the excess reshared."""
    result, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while open_:
        per = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if per * weights[i] > most * sizes[i]]
        if not full:
            for i in open_:
                result[i] = per * weights[i]
            break
        for i in full:
            result[i] = most * sizes[i]
            left -= result[i]
            open_.remove(i)
    return result


def split(counts: np.ndarray, shards: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Blocks of each source per shard: every node draws its left half's share."""
    if shards == 1:
        return [counts]
    left = shards // 2
    total = int(counts.sum())
    draw = rng.multivariate_hypergeometric(counts, total * left // shards, method="marginals")
    return split(draw, left, rng) + split(counts - draw, shards - left, rng)


def nearest(sizes: list[int], goal: float) -> list[int]:
    """Places whose sizes add up as near to the goal as possible.

    Exact by subset sums on a bitset, as long as the goal and the sizes are few; beyond that
    the largest that fit are taken first.
    """
    chosen, left, small = [], goal, []
    for at in sorted(range(len(sizes)), key=lambda at: -sizes[at]):
        if left > _BITS:
            if sizes[at] <= left:
                chosen.append(at)
                left -= sizes[at]
        elif 0 < sizes[at] <= 2 * left:
            small.append(at)
    while len(small) > _ITEMS and sizes[small[0]] <= left:
        left -= sizes[small[0]]
        chosen.append(small.pop(0))
    small = [at for at in small if sizes[at] <= 2 * left]
    small = small[:: max(1, -(-len(small) // _ITEMS))]
    mask, reach, before = (1 << (int(2 * left) + 1)) - 1, 1, []
    for at in small:
        before.append(reach)
        reach |= (reach << sizes[at]) & mask
    floor = int(left)
    best = (reach & ((1 << (floor + 1)) - 1)).bit_length() - 1
    above = reach >> (floor + 1)
    if above:
        higher = floor + (above & -above).bit_length()
        best = min(best, higher, key=lambda total: abs(total - left))
    for at, reached in zip(reversed(small), reversed(before)):
        if not reached >> best & 1:
            chosen.append(at)
            best -= sizes[at]
    return sorted(chosen)


def _last_documents(rows: DataFrame) -> DataFrame:
    """Keys of the documents that the cut blocks give; rows alike are given together or not."""

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key")
        taken = nearest(frame["size"].tolist(), float(frame["rest"].iloc[0]))
        found = frame.iloc[taken][["_at", "_block", "key"]]
        return found.rename(columns={"key": "_key"}).assign(_given=True)

    alike = rows.groupBy("_at", "_block", "key").agg(
        F.sum("size").alias("size"), F.any_value("rest").alias("rest")
    )
    return alike.groupBy("_at", "_block").applyInPandas(
        choose, "_at int, _block long, _key long, _given boolean"
    )


def draws(
    docs: DataFrame, id_column: str = "doc_id", share: float = 1.5, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``draws``, an array of shards.

    Each entry of ``draws`` is one copy of the document in the mix and names its shard.
    """
    spark = docs.sparkSession
    key = F.xxhash64(F.col(id_column).cast("string"), "text", F.lit(SEED))
    light = written(
        docs.select("source", word_count(F.col("text")).alias("size"), key.alias("key")), "mix-sizes"
    )
    stats = light.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    stats = sorted(
        stats.collect(),
        key=lambda r: (r.source is None, [ord(ch) for ch in r.source or ""]),
    )
    total = sum(r["size"] for r in stats)
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(stats))]
    goals = targets([r["size"] for r in stats], weights, share * total)
    most = max(1, BLOCKS // max(1, len(stats)))
    sources = spark.createDataFrame(
        [
            (at, r.source, r["size"], goals[at], max(1, min(most, r["rows"] // BLOCK_ROWS)))
            for at, r in enumerate(stats)
        ],
        "_at int, _source string, source_size long, target double, _blocks long",
    )
    block = F.pmod(F.col("key"), F.col("_blocks"))
    placed = light.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("_source")))
    placed = placed.select("_at", block.alias("_block"), "size", "key")
    held = placed.groupBy("_at", "_block").agg(F.sum("size").alias("words")).collect()
    blocks: dict[int, list[tuple[int, int]]] = {at: [] for at in range(len(stats))}
    for row in sorted(held, key=lambda r: (r["_at"], r["_block"])):
        blocks[row["_at"]].append((row["_block"], row.words))

    drawn: list[list[int]] = []
    trims = []
    for at, r in enumerate(stats):
        rng = np.random.default_rng([SEED, at])
        passes = int(goals[at] // r["size"]) if r["size"] else 0
        rest = goals[at] - passes * r["size"]
        taken = [number for _ in range(passes) for number, _ in blocks[at]]
        over = []
        for place in rng.permutation(len(blocks[at])) if r["size"] else []:
            number, words = blocks[at][place]
            if words <= rest:
                taken.append(number)
                rest -= words
            else:
                over.append((words, number))
        if over and rest > 0:
            trims.append((at, min(over)[1], float(rest)))
            taken.append(min(over)[1])
        drawn.append([taken[i] for i in rng.permutation(len(taken))])

    shards = min(SHARDS, max(1, round(sum(goals) / shard_words)))
    counts = np.array([len(taken) for taken in drawn], np.int64)
    parts = split(counts, shards, np.random.default_rng(SEED)) if len(stats) else []
    homes: dict[tuple[int, int], list[int]] = {}
    used = [0] * len(stats)
    for shard, part in enumerate(parts):
        for at, n in enumerate(part):
            for number in drawn[at][used[at] : used[at] + int(n)]:
                homes.setdefault((at, number), []).append(shard)
            used[at] += int(n)

    cut = spark.createDataFrame(trims, "_at int, _block long, rest double")
    given = written(_last_documents(placed.join(cut, ["_at", "_block"])), "mix-last-documents")
    cut_blocks = {(at, number) for at, number, _ in trims}
    rows = [
        (at, number, found, (at, number) in cut_blocks)
        for (at, number), found in sorted(homes.items())
    ]
    homes_table = spark.createDataFrame(rows, "_at int, _block long, _homes array<int>, _cut boolean")
    own = {"size", "source_size", "target", "draws"}
    kept = [name for name in docs.columns if name not in own]
    base = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in kept)).alias("_row"),
        F.col("source").alias("_of"),
        word_count(F.col("text")).alias("size"),
        key.alias("_key"),
    )
    joined = base.join(F.broadcast(sources), F.col("_of").eqNullSafe(F.col("_source"))).withColumn(
        "_block", F.pmod(F.col("_key"), F.col("_blocks"))
    )
    joined = joined.join(F.broadcast(homes_table), ["_at", "_block"], "left")
    joined = joined.join(given, ["_at", "_block", "_key"], "left")
    none = F.array().cast("array<int>")
    # The cut applies to one of the block's draws, the last of its list.
    kept_draws = F.when(F.col("_homes").isNull(), none).when(
        F.col("_cut") & F.col("_given").isNull(), F.slice("_homes", F.lit(1), F.size("_homes") - 1)
    ).otherwise(F.col("_homes"))
    return joined.select("_row.*", "size", "source_size", "target", kept_draws.alias("draws"))


def mixed(drawn: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per copy with its ``shard``; each shard lies together, locally shuffled."""
    copies = drawn.select("*", F.posexplode("draws").alias("_copy", "shard")).drop("draws")
    mark = F.xxhash64(F.col(id_column).cast("string"), "text", "_copy", F.lit(SEED))
    slices = F.pmod(mark, F.lit(16))
    return (
        copies.repartition("shard", slices).sortWithinPartitions("shard", mark).drop("_copy")
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = draws(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = (F.size("draws") * F.col("size")).alias("taken")
    return drawn.select("doc_id", "size", "source_size", "target", taken, "source", "draws")
