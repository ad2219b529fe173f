"""SimHash near-duplicates: fingerprints, and their components by generalised pigeonhole.

A 64-bit fingerprint takes the majority of each bit over the hashes of a text's word
shingles. Fingerprints that differ in at most ``max_bits`` bits are linked; a component is
everything reachable over links.

Links are found between *distinct* fingerprints, so a group of copies counts once. The bits
are split into parts of correlated bits; a dynamic program gives every part the number of
differing bits it must find by itself, so that the parts together miss no pair, at the least
estimated number of candidates. Each fingerprint then probes the buckets of the parts, and
every candidate is verified.

A bucket of more than ``bucket_bound`` fingerprints would yield pairs with the square of its
size. Its members, and all that probe it, are linked by midpoints instead: two fingerprints
are within ``max_bits`` exactly when some number lies between them, half of the way from
each. Each emits the numbers so near to it, and who meets at a number is linked. That is
exact, linear in the fingerprints, and at most 65 of them can meet at one number.

A text without words (or NULL) has fingerprint zero and is linked like any other. Rows
without an id take part; they never give a component its name, which is NULL if none of its
rows has an id. Repeated rows fall into the same component. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import table, written
from cardwarden.llm.words import word_blocks

BITS = 64
SHINGLE = 3
MAX_BITS = 2
BUCKET_BOUND = 128
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as a signed 64-bit number."""
    if not text:
        return 0
    ones, total = np.zeros(BITS, np.int64), 0
    last: list[bytes] = []
    for words in word_blocks(text.encode("utf-8").lower()):
        words = last + words
        if len(words) >= shingle:
            shingles = map(b" ".join, zip(*(words[at:] for at in range(shingle)), strict=False))
            count = len(words) - shingle + 1
            ones += _ones(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), count)
            total += count
        last = words[len(words) - shingle + 1 :] if len(words) >= shingle else words
    if not total and last:
        ones, total = _ones([xxhash.xxh64_intdigest(b" ".join(last), SEED)], 1), 1
    major = np.packbits(2 * ones > total, bitorder="little")
    return int(major.view("<i8")[0])


def _ones(hashes, count: int) -> np.ndarray:
    """How many of the hashes have each bit set."""
    values = np.fromiter(hashes, np.uint64, count).astype("<u8")
    total = np.zeros(BITS, np.int64)
    for at in range(0, count, 1 << 15):
        rows = values[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return total


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", shingle: int = SHINGLE
) -> DataFrame:
    """One row per row of ``docs``: id, ``text_hash`` and ``fp``.

    Id and text hash tell rows of different texts apart where ids repeat.
    """
    keyed = docs.select(
        F.col(id_column), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string")
    )

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fp = [fingerprint(text, shingle) for text in frame["text"]]
            yield frame.drop(columns="text").assign(fp=np.array(fp, np.int64))

    kind = docs.schema[id_column].dataType.simpleString()
    return keyed.mapInPandas(read, f"`{id_column}` {kind}, text_hash long, fp long")


# The split of the bits and the thresholds of the parts.


def bit_statistics(distinct: DataFrame) -> np.ndarray:
    """For every two bits, in how many fingerprints both are set; the diagonal counts one bit.

    Every task sends its 64 x 64 counts, which Spark adds up; only the sums reach the driver.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = np.zeros((BITS, BITS))
        for frame in frames:
            values = frame["fp"].to_numpy(np.int64).astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float32)
            both += bits.T @ bits
        yield pd.DataFrame({"cell": np.arange(BITS * BITS), "n": both.ravel().astype(np.int64)})

    sums = distinct.select("fp").mapInPandas(read, "cell int, n long").groupBy("cell").agg(
        F.sum("n").alias("n")
    )
    both = np.zeros(BITS * BITS)
    for row in sums.collect():
        both[row.cell] = row.n
    return both.reshape(BITS, BITS)


def group_bits(both: np.ndarray, count: int, parts: int) -> list[list[int]]:
    """Split the bits into parts of even width, correlated bits together."""
    share = np.diag(both) / max(count, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    related = np.abs((both / max(count, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    left, groups = set(range(BITS)), []
    for part in range(parts):
        width = len(left) // (parts - part)
        group = [max(left, key=lambda bit: (related[bit, list(left)].sum(), -bit))]
        while len(group) < width:
            rest = left - set(group)
            group.append(max(rest, key=lambda bit: (related[bit, group].sum(), -bit)))
        left -= set(group)
        groups.append(sorted(group))
    return groups


def _ball(width: int, radius: int) -> int:
    return sum(
        int(np.prod([(width - i) / (i + 1) for i in range(k)])) if k else 1
        for k in range(radius + 1)
    )


def part_cost(both: np.ndarray, count: int, bits: list[int], threshold: int) -> float:
    """Estimated probes and candidates of one part, from how often its bits differ."""
    if threshold < 0:
        return 0.0
    share = np.diag(both)[bits] / max(count, 1)
    differs = 2 * share * (1 - share)
    near = np.zeros(threshold + 1)
    near[0] = 1.0
    for chance in differs:
        near[1:] = near[1:] * (1 - chance) + near[:-1] * chance
        near[0] *= 1 - chance
    return count * _ball(len(bits), threshold) + near.sum() * count * count / 2


def allocate(
    both: np.ndarray, count: int, groups: list[list[int]], max_bits: int
) -> tuple[float, list[int]]:
    """Thresholds per part with the least cost, by dynamic programming.

    Were all parts to differ in more bits than their threshold, the whole would differ in at
    least the sum of ``threshold + 1``. So ``max_bits + 1`` units are dealt to the parts; a
    part with none of them (threshold -1) is not probed at all.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for bits in groups:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for units in range(max_bits + 2 - used):
                if units - 1 > len(bits):
                    break
                total = cost + part_cost(both, count, bits, units - 1)
                if used + units not in following or total < following[used + units][0]:
                    following[used + units] = (total, [*chosen, units - 1])
        best = following
    return best[max_bits + 1]


def plan_parts(both: np.ndarray, count: int, max_bits: int) -> list[tuple[list[int], int]]:
    """Bits and threshold of every part that is probed."""
    plans = []
    for parts in range(1, max_bits + 2):
        groups = group_bits(both, count, parts)
        cost, thresholds = allocate(both, count, groups, max_bits)
        plans.append((cost, list(zip(groups, thresholds, strict=True))))
    return [part for part in min(plans, key=lambda plan: plan[0])[1] if part[1] >= 0]


def _signed(bits) -> int:
    value = sum(1 << bit for bit in bits)
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _flips(bits: list[int], radius: int) -> list[int]:
    """Masks that turn over at most ``radius`` of the given bits."""
    return [_signed(chosen) for k in range(radius + 1) for chosen in combinations(bits, k)]


def _near(column: Column, masks: list[int]) -> Column:
    turned = F.array(*(F.lit(mask).cast("long") for mask in masks))
    return F.transform(turned, lambda mask: column.bitwiseXOR(mask))


# Links between distinct fingerprints.


def links(
    distinct: DataFrame, max_bits: int = MAX_BITS, bucket_bound: int = BUCKET_BOUND
) -> DataFrame:
    """Linked fingerprints ``a``, ``b`` that have the same components as all links together."""
    both = bit_statistics(distinct)
    count = distinct.count()
    parts = plan_parts(both, count, max_bits)

    def rows(part: int, near: bool) -> DataFrame:
        bits, threshold = parts[part]
        key = F.col("fp").bitwiseAND(F.lit(_signed(bits)).cast("long"))
        key = F.explode(_near(key, _flips(bits, threshold))) if near and threshold else key
        return distinct.select("fp", F.lit(part).alias("part"), key.alias("key"))

    held = reduce(DataFrame.unionByName, (rows(part, False) for part in range(len(parts))))
    probes = reduce(DataFrame.unionByName, (rows(part, True) for part in range(len(parts))))
    crowded = written(
        held.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket_bound),
        "simhash-crowded",
    )
    asked = probes.join(crowded, ["part", "key"], "left_anti").withColumnRenamed("fp", "a")
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("fp")))
    near = asked.join(held, ["part", "key"]).where(
        (F.col("a") < F.col("fp")) & (differing <= max_bits)
    )
    in_crowd = probes.join(crowded, ["part", "key"], "left_semi").select("fp").distinct()
    return near.select("a", F.col("fp").alias("b")).unionByName(_by_midpoints(in_crowd, max_bits))


def _by_midpoints(crowd: DataFrame, max_bits: int) -> DataFrame:
    """Links of any number of fingerprints, found where their surroundings meet.

    One of a pair reaches the midpoint within half of ``max_bits``, rounded down, the other
    within the rest. All that meet are linked to the smallest of those within the smaller
    reach, from which none of them is further than ``max_bits``.
    """
    bits, short = list(range(BITS)), max_bits // 2
    numbers = F.explode(_near(F.col("fp"), _flips(bits, max_bits - short))).alias("number")
    met = crowd.select("fp", numbers).withColumn(
        "anchor",
        F.when(F.bit_count(F.col("fp").bitwiseXOR(F.col("number"))) <= short, F.col("fp")),
    )
    groups = met.groupBy("number").agg(
        F.min("anchor").alias("a"), F.collect_list("fp").alias("members")
    )
    return (
        groups.where((F.size("members") > 1) & F.col("a").isNotNull())
        .select("a", F.explode("members").alias("b"))
        .where("a <> b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """Every vertex of the links ``a``, ``b`` with the smallest vertex it can reach.

    Each round hooks a label to the smallest label it is linked to and follows those hooks
    twice, so that chains shorten fast. Labels are written in every round: the plan stays
    short, and a lost executor costs a reread.
    """
    edges = written(edges, "links")
    ends = edges.select(F.col("a").alias("v")).unionByName(edges.select(F.col("b").alias("v")))
    labels = written(ends.distinct().withColumn("label", F.col("v")), "labels")
    while True:
        of_a = labels.select(F.col("v").alias("a"), F.col("label").alias("la"))
        of_b = labels.select(F.col("v").alias("b"), F.col("label").alias("lb"))
        apart = edges.join(of_a, "a").join(of_b, "b").where("la <> lb")
        hooks = written(
            apart.select(F.greatest("la", "lb").alias("label"), F.least("la", "lb").alias("to"))
            .groupBy("label")
            .agg(F.min("to").alias("to")),
            "hooks",
        )
        if hooks.isEmpty():
            return labels
        for _ in range(2):
            on = hooks.select(F.col("label").alias("to"), F.col("to").alias("further"))
            hooks = hooks.join(on, "to", "left").select("label", F.coalesce("further", "to").alias("to"))
        labels = written(
            labels.join(hooks, "label", "left").select("v", F.coalesce("to", "label").alias("label")),
            "labels",
        )


def near_duplicates(
    prints: DataFrame,
    id_column: str = "doc_id",
    max_bits: int = MAX_BITS,
    bucket_bound: int = BUCKET_BOUND,
) -> DataFrame:
    """Rows of ``fingerprints`` with ``component_id`` and ``component``.

    ``component_id`` is the smallest id in the component. ``component`` is its smallest
    linked fingerprint, which names a component without ids, too.
    """
    prints = written(prints, "fingerprints")
    distinct = written(
        prints.groupBy("fp").agg(F.min(id_column).alias("first")), "distinct-fingerprints"
    )
    found = components(links(distinct, max_bits, bucket_bound))
    grouped = distinct.join(found, distinct["fp"] == found["v"], "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("component")
    )
    # Most components are a single fingerprint, which keeps its own first id.
    linked = found.join(distinct, found["v"] == distinct["fp"])
    smallest = linked.groupBy(F.col("label").alias("component")).agg(
        F.min("first").alias("component_id")
    )
    named = grouped.join(smallest, "component", "left").select(
        "fp", "component", F.coalesce("component_id", "first").alias("component_id")
    )
    return prints.join(named, "fp", "left")


def one_of_each(docs: DataFrame, judged: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The row with the smallest id (then text hash) of each component, columns as in ``docs``.

    Of rows repeating both, one stays.
    """
    key = F.struct(F.col(id_column).isNull(), id_column, "text_hash")
    kept = (
        judged.groupBy("component", F.col(id_column), "text_hash")
        .agg(F.count("*").alias("rows"))
        .groupBy("component")
        .agg(F.min(key).alias("key"), F.min_by("rows", key).alias("rows"))
        .select(
            F.col(f"key.{id_column}").alias("kept_id"),
            F.col("key.text_hash").alias("kept_hash"),
            "rows",
        )
    )
    same = docs[id_column].eqNullSafe(F.col("kept_id")) & (
        F.xxhash64(docs["text"]) == F.col("kept_hash")
    )
    matched = docs.join(kept, same)
    once = matched.where("rows = 1").select(*(docs[name] for name in docs.columns))
    again = (
        matched.where("rows > 1")
        .dropDuplicates(["kept_id", "kept_hash"])
        .select(*(docs[name] for name in docs.columns))
    )
    return once.unionByName(again)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = near_duplicates(fingerprints(table(spark, sf_dir, "documents")))
    return judged.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
