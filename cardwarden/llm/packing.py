"""Best-fit packing by minimum bin slack.

Documents become token ids with an end id; longer ones than a sequence are cut into pieces.
Bins are filled one at a time: the longest piece left, and with it the combination of
available lengths that leaves the least slack, found by subset sums on a bitset. The filled
combination is removed as often as the pieces last, so the work of the driver depends on
the histogram of lengths (at most ``limit`` numbers), not on the pieces.

Pieces learn their place from their rank among pieces of the same length: the tasks that write
them number their own, and counts per task and length say where each task's numbers begin. So
the pieces, which may carry their ids, are not shuffled. NULL and empty texts are one piece,
the end id alone. Rows that repeat are packed as often as they occur. Rows without an id are
packed, too. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import table, written
from cardwarden.llm.tokens import forget, token_ids, vocabulary

LIMIT = 4096
TOKENIZER = "word_bpe_49k.json"
END = 1


def pieces(
    docs: DataFrame, limit: int = LIMIT, tokenizer: str = TOKENIZER, end: int = END,
    with_ids: bool = False, id_column: str = "doc_id",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, if asked for, its ids.

    Ids that all fit in 16 bits come as ``ids16``, which ``pack`` returns as ``ids`` of 32.
    """
    narrow = with_ids and max(vocabulary(tokenizer), end + 1) <= 1 << 16
    named = "ids16" if narrow else "ids"
    columns = ["piece", "start", "length", "ids_crc32", *([named] if with_ids else [])]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 1000):
                yield part(frame.iloc[at : at + 1000])
        forget(tokenizer)

    def part(frame: pd.DataFrame) -> pd.DataFrame:
        whose, rows = [], []
        for place, ids in enumerate(token_ids(frame["text"], tokenizer, end)):
            for number, start in enumerate(range(0, len(ids), limit)):
                data = ids[start : start + limit]
                crc, held = zlib.crc32(data.tobytes()), data.astype("<u2") if narrow else data
                whose.append(place)
                blob = [held.tobytes()] if with_ids else []
                rows.append((number, start, len(data), crc, *blob))
        found = pd.DataFrame(rows, columns=columns)
        found.insert(0, id_column, frame[id_column].to_numpy()[whose])
        return found

    kind = docs.schema[id_column].dataType.simpleString()
    more = f", {named} binary" if with_ids else ""
    return docs.select(id_column, F.col("text").cast("string")).mapInPandas(
        read, f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long{more}"
    )


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """How often to take each length (in falling order) so that the sum comes nearest to ``room``."""
    reach, layers = 1, []
    mask = (1 << (room + 1)) - 1
    for length in lengths:
        if length > room or not counts[length]:
            continue
        left, unit = min(counts[length], room // length), 1
        while left:
            take = min(unit, left)
            layers.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            unit *= 2
        if reach >> room & 1:
            break
    best = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(layers):
        if not before >> best & 1:
            best -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def bins(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[int, dict[int, int]]]:
    """Combinations of lengths and in how many bins each is used."""
    counts = dict(histogram)
    lengths = sorted(counts, reverse=True)
    found = []
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        chosen = fullest(lengths, counts, limit - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[length] // n for length, n in chosen.items())
        for length, n in chosen.items():
            counts[length] -= times * n
        found.append((times, chosen))
        if any(not counts[length] for length in chosen):
            lengths = [length for length in lengths if counts[length]]
    return found


def _places(found: list[tuple[int, dict[int, int]]]) -> tuple[np.ndarray, ...]:
    """For every length, ranges of ranks: (length, first rank), bin, offset, uses per bin."""
    rows, next_rank, sequence = [], {}, 0
    for times, chosen in found:
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            rank = next_rank.get(length, 0)
            rows.append((length, rank, sequence, offset, n))
            next_rank[length] = rank + times * n
            offset += n * length
        sequence += times
    rows.sort()
    return tuple(np.array(column, np.int64) for column in zip(*rows, strict=True))


def _widened(name: str) -> Column:
    """16-bit ids in 32 bits."""

    @F.pandas_udf("binary")
    def widen(ids: pd.Series) -> pd.Series:
        return ids.map(lambda held: np.frombuffer(held, "<u2").astype("<u4").tobytes())

    return widen(name)


def _numbered(name: str) -> Column:
    """How many rows with the same value its task has met before."""

    @F.pandas_udf("long")
    def number(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        met: dict[int, int] = {}
        for values in parts:
            own = values.groupby(values).cumcount() + values.map(met).fillna(0).astype(np.int64)
            for value, times in values.value_counts().items():
                met[value] = met.get(value, 0) + int(times)
            yield own

    return number(name)


def pack(parts: DataFrame, limit: int = LIMIT, widen: bool = True) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ids in 32 bits, or as they come."""
    names = parts.columns
    parts = written(
        parts.select("*", F.spark_partition_id().alias("_task"), _numbered("length").alias("_own")),
        "pieces",
    )
    held = written(parts.groupBy("length", "_task").agg(F.count("*").alias("n")), "pack-counts")
    # Written, so that its size is known: a short list is broadcast and the pieces stay in place.
    before = written(held.select(
        "length", "_task",
        (F.sum("n").over(Window.partitionBy("length").orderBy("_task")) - F.col("n")).alias("_before"),
    ), "pack-starts")
    histogram = {
        r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    columns = [
        _widened(name).alias("ids") if widen and name == "ids16" else F.col(f"`{name}`")
        for name in names
    ]
    if not histogram:
        none = F.lit(0).cast("long")
        return parts.select(*columns, none.alias("sequence_id"), none.alias("offset"))
    shared = parts.sparkSession.sparkContext.broadcast(_places(bins(histogram, limit)))
    ranked = parts.join(before, ["length", "_task"])
    ranked = ranked.withColumn("_rank", F.col("_own") + F.col("_before"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, firsts, sequences, offsets, uses = shared.value
        base = np.int64(1 << 44)
        at = np.searchsorted(lengths * base + firsts, length * base + rank, side="right") - 1
        within = rank.to_numpy() - firsts[at]
        return pd.DataFrame({
            "sequence_id": sequences[at] + within // uses[at],
            "offset": offsets[at] + within % uses[at] * length.to_numpy(),
        })

    found = ranked.withColumn("_place", place("length", "_rank"))
    return found.select(*columns, "_place.sequence_id", "_place.offset")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents")))
