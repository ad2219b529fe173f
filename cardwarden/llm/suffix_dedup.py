"""Suffix-array deduplication over sparse suffixes.

A passage of ``MIN_WORDS`` words or more that occurs before (in a smaller id, or earlier in
the same text) is cut out. Of all suffixes only those at minimisers are retained: positions
whose 8 words hash lowest (all of them, if equal) within a passage's length, so equal passages retain equal
positions. A suffix whose 8 words occur at no other retained position is let go. Of every
passage of ``MIN_WORDS`` words around one of the others the hash is compared, and equal
passages that touch or overlap form one span.

Two steps of the usual method are replaced. Suffixes are not sorted and compared with their
neighbours, but grouped by the hash of their 8 words; matches are not extended left and right,
but every passage around a kept minimiser is grouped by its hash. A sort would put a large
group of equal suffixes into one task, and an extension would compare its members in pairs;
counts and minima of groups are combined before they are shuffled. Hashes of passages have
128 bits.

NULL, empty and short texts have no span. Copies of a text keep the one with the smallest
id; of rows that repeat id and text one stays, by a row number fixed in a written table. Rows
without an id come after all others.
Empty tables give no rows. Extra columns are carried; names that clash with the columns added
here are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import table, written
from cardwarden.plans.warehouse import settle
from cardwarden.session import scratch
from cardwarden.sources.shared import SharedFiles

MIN_WORDS = 50
GRAM = 8
_STEP = 1 << 18
_LAST = (1 << 63) - 1


def word_hashes(data: bytes) -> np.ndarray:
    words = data.split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _rolled(hashes: np.ndarray, length: int, factor: int) -> np.ndarray:
    """A hash of every ``length`` words in a row, doubled up from shorter runs."""
    runs, have, result, done = hashes, 1, None, 0
    with np.errstate(over="ignore"):
        left = length
        while left:
            if left & 1:
                result = runs if result is None else _joined(result, runs, done, factor)
                done += have
            left >>= 1
            if left:
                runs = _joined(runs, runs, have, factor)
                have *= 2
    return result[: max(0, len(hashes) - length + 1)]


def _joined(a: np.ndarray, b: np.ndarray, apart: int, factor: int) -> np.ndarray:
    count = max(0, len(b) - apart)
    x = a[:count] * np.uint64(factor) + b[apart : apart + count]
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` values in a row, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = pick(values[:-step], values[step:])
        have += step
    return values


def minimisers(hashes: np.ndarray, min_words: int = MIN_WORDS, gram: int = GRAM):
    """Hash of each gram, the lowest one of each passage, and where grams are a lowest one."""
    grams = _rolled(hashes, gram, 0x9E3779B97F4A7C15)
    width = min_words - gram + 1
    lowest = _sliding(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    highest = _sliding(np.concatenate([edge, lowest, edge]), width, np.maximum)
    return grams, lowest, np.flatnonzero(grams == highest)


def _text_key():
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _sparse_suffixes(docs: DataFrame, min_words: int) -> DataFrame:
    """Retained suffixes: hash of their first words, whose text it is, and where."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            whose, found, places, size = [], [], [], 0
            for row, text in enumerate(frame["text"]):
                hashes = word_hashes(text.encode("utf-8", "replace"))
                if len(hashes) < min_words:
                    continue
                grams, _, at = minimisers(hashes, min_words)
                whose.append(np.full(len(at), row))
                found.append(grams[at])
                places.append(at)
                size += len(at)
                if size > _STEP:
                    yield batch(frame, whose, found, places)
                    whose, found, places, size = [], [], [], 0
            if size:
                yield batch(frame, whose, found, places)

    def batch(frame, whose, found, places) -> pd.DataFrame:
        rows = np.concatenate(whose)
        return pd.DataFrame({
            "gram": np.concatenate(found).view(np.int64), "mark": frame["mark"].to_numpy()[rows],
            "order": frame["order"].to_numpy()[rows], "at": np.concatenate(places),
        })

    texts = docs.select("mark", "order", "text")
    return texts.mapInPandas(read, "gram long, mark long, order long, at int")


def _passages(held: DataFrame, min_words: int) -> DataFrame:
    """Two hashes of every passage whose minimiser is one of the listed positions."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            whose, first, second, places, size = [], [], [], [], 0
            for row, (text, wanted) in enumerate(zip(frame["text"], frame["places"], strict=True)):
                hashes = word_hashes(text.encode("utf-8", "replace"))
                grams, lowest, _ = minimisers(hashes, min_words)
                starts = np.flatnonzero(np.isin(lowest, grams[np.asarray(wanted)]))
                a = _rolled(hashes, min_words, 0xD6E8FEB86659FD93)
                b = _rolled(hashes ^ np.uint64(0x5851F42D4C957F2D), min_words, 0xA0761D6478BD642F)
                whose.append(np.full(len(starts), row))
                first.append(a[starts])
                second.append(b[starts])
                places.append(starts)
                size += len(starts)
                if size > _STEP:
                    yield batch(frame, whose, first, second, places)
                    whose, first, second, places, size = [], [], [], [], 0
            if size:
                yield batch(frame, whose, first, second, places)

    def batch(frame, whose, first, second, places) -> pd.DataFrame:
        rows = np.concatenate(whose)
        return pd.DataFrame({
            "ha": np.concatenate(first).view(np.int64), "hb": np.concatenate(second).view(np.int64),
            "order": frame["order"].to_numpy()[rows], "mark": frame["mark"].to_numpy()[rows],
            "at": np.concatenate(places),
        })

    texts = held.select("mark", "order", "text", "places")
    return texts.mapInPandas(read, "ha long, hb long, order long, mark long, at int")


def merge_spans(starts, length: int) -> list[tuple[int, int]]:
    """Word spans [from, to) that the passages at the given starts cover together."""
    starts = np.unique(np.asarray(starts, np.int64))
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > length) + 1
    return [(int(run[0]), int(run[-1]) + length) for run in np.split(starts, breaks)]


def repeated_spans(
    docs: DataFrame, id_column: str = "doc_id", min_words: int = MIN_WORDS, hold=written
) -> DataFrame:
    """Per distinct text with a span or copies: ``key`` and ``spans``.

    The spans are those of the row with the smallest id; further rows of a text repeat it whole.
    ``hold`` writes the intermediate tables, which the result reads.
    """
    rank = F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST))
    # Positions name their text by a short mark and its order, copies by the whole key.
    keyed = docs.where(F.col("text").isNotNull()).select(
        _text_key().alias("key"), F.xxhash64("text").alias("mark"), rank.alias("order"),
        F.col("text").cast("string").alias("text"),
    )
    # Copies of a text would be extended once each; one of them stands for all.
    firsts = hold(
        keyed.groupBy("key", "mark").agg(F.min("order").alias("order"), F.count("*").alias("rows")),
        "text-firsts",
    )
    suffixes = hold(
        _sparse_suffixes(keyed, min_words).join(firsts, ["mark", "order"], "left_semi"),
        "sparse-suffixes",
    )
    place = F.struct("mark", "order", "at")
    neighbours = (
        suffixes.groupBy("gram").agg(F.min(place).alias("low"), F.max(place).alias("high"))
        .where("low <> high").select("gram")
    )
    wanted = (
        suffixes.join(neighbours, "gram", "left_semi")
        .groupBy("mark", "order").agg(F.sort_array(F.collect_set("at")).alias("places"))
    )
    # Rows repeating id and text are alike; their passages are compared as one.
    held = keyed.join(wanted, ["mark", "order"])
    passages = hold(_passages(held, min_words), "passages")
    where = F.struct("order", "mark", "at")
    first = (
        passages.groupBy("ha", "hb").agg(F.min(where).alias("first"), F.max(where).alias("last"))
        .where("first <> last").select("ha", "hb", "first")
    )
    again = (
        passages.join(first, ["ha", "hb"])
        .where(where != F.col("first"))
        .groupBy("mark", "order").agg(F.sort_array(F.collect_set("at")).alias("starts"))
    )
    kind = "array<struct<start:int,end:int>>"

    @F.pandas_udf(kind)
    def merged(starts: pd.Series) -> pd.Series:
        return starts.map(lambda s: [{"start": a, "end": b} for a, b in merge_spans(s, min_words)])

    spans = again.select("mark", "order", merged("starts").alias("spans"))
    return firsts.join(spans, ["mark", "order"], "left").where("spans is not null or rows > 1").select(
        "key", F.coalesce("spans", F.array().cast(kind)).alias("spans")
    )


def with_spans(
    docs: DataFrame, id_column: str = "doc_id", min_words: int = MIN_WORDS,
    without: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with ``n_words`` and ``spans``, the word spans that occur before.

    Columns named by ``without`` are not carried: texts that nobody asks for are neither
    written nor shuffled once more.
    """
    found = _found_spans(docs, id_column, min_words)
    kept = [name for name in docs.columns if name not in ("n_words", "spans", *without)]
    base = written(docs.select(
        F.struct(*(F.col(f"`{name}`") for name in kept)).alias("_row"),
        _text_key().alias("key"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)).alias("_order"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).alias("n_words"),
        F.monotonically_increasing_id().alias("_number"),
    ), "numbered")
    place = F.struct("_order", "_number")
    firsts = base.groupBy("key").agg(F.min(place).alias("first"))
    joined = base.join(found.join(firsts, "key"), "key", "left")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("end")))
    spans = F.when(
        (place > F.col("first")) & (F.col("n_words") >= min_words), whole
    ).otherwise(F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")))
    return joined.select("_row.*", "n_words", spans.alias("spans"))


def _found_spans(docs: DataFrame, id_column: str, min_words: int) -> DataFrame:
    """The repeated spans, written; the larger tables they come from are deleted by then."""
    spark = docs.sparkSession
    root = scratch(spark, "llm-repeats")

    def hold(df: DataFrame, name: str) -> DataFrame:
        return settle(df, f"{root}/{name}")

    found = written(repeated_spans(docs, id_column, min_words, hold), "spans")
    SharedFiles(spark).delete(root)
    return found


def cut_text(text: str, spans) -> str:
    """The text without the words of the spans and the white space that follows each."""
    data = text.encode("utf-8", "replace")
    removed = [(s["start"], s["end"]) for s in spans]
    out, at = [], 0
    edges = [match.span() for match in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    for start, end in removed:
        begin = edges[start][0]
        finish = edges[end][0] if end < len(edges) else len(data)
        out.append(data[at:begin])
        at = finish
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "replace")


def without_repeats(docs: DataFrame, id_column: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with repeated passages cut out, columns as they were.

    A document of which no word is left goes; one that had none before stays.
    """

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut_text(t, s) for t, s in zip(text, spans, strict=True)], dtype=object)

    found = with_spans(docs, id_column, min_words)
    touched = F.size("spans") > 0
    left = found.where(~touched).drop("spans", "n_words")
    changed = found.where(touched).withColumn("text", cut(F.col("text"), F.col("spans")))
    changed = changed.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    # A length column of the table follows its text.
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(docs.columns).unionByName(changed.select(docs.columns))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_spans(docs, without=("text",))
    gone = F.aggregate("spans", F.lit(0), lambda total, s: total + s["end"] - s["start"])
    return found.select("doc_id", "n_words", "spans", gone.alias("repeated_words"))
