"""Resampling towards a target: documents whose words are those of a target corpus.

Every run of up to ``max_words`` words falls into the bucket given by the CRC-32 of its
bytes. Two passes read the texts. The first counts buckets over all documents and over the
target, from which every bucket gets its gain, the logarithm of how much more often the
target has it. The second gives a document the mean gain of its features and adds noise that
depends on its id only (a Gumbel draw), so that taking the highest scores draws documents
without replacement, likelier the more they resemble the target.

The checksums of all features of a block of text are computed at once. A checksum is linear
in its bytes apart from a constant for the length: a table holds what each byte adds at each
distance from the end of the feature, and ``bitwise_xor.reduceat`` adds these up over the
feature spans. Spans longer than the table are folded block by block.

NULL and empty texts and texts without words have no features and weight 0. A row without an
id takes the noise of an empty id and comes after all others of its score. Rows repeating an
id share its noise; among rows alike in score and id any order holds, and each has a rank of
its own. Without target texts, or without documents, the formulas hold with zero counts.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import table, written

MAX_WORDS = 1
BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10

# Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
# Distances the table covers, and bytes of text looked at together.
_SPAN = 64
_STEP = 1 << 20
# Scores are looked up in steps of this size before the last drawn one is known.
_COARSE = 256


def _tables(span: int) -> tuple[np.ndarray, np.ndarray]:
    """What a byte adds at each distance from the end; the register after so many zero bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1)
    adds, register = [one], [0xFFFFFFFF]
    for _ in range(span):
        adds.append((adds[-1] >> 8) ^ one[adds[-1] & 255])
        register.append((register[-1] >> 8) ^ int(one[register[-1] & 255]))
    return np.stack(adds[:span]), np.array(register, np.uint32)


_ADDS, _ZEROS = _tables(_SPAN)


def _linear(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What the bytes of each span, none longer than the table, add to its checksum."""
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    places = np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)
    away = np.repeat(ends - 1, lengths) - places
    return np.bitwise_xor.reduceat(_ADDS.ravel()[(away << 8) | data[places]], first)


def _after_block(register: np.ndarray) -> np.ndarray:
    """The registers after one more block of zero bytes."""
    bytes_of = register.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.bitwise_xor.reduce(
        _ADDS[np.arange(_SPAN - 1, _SPAN - 5, -1), bytes_of], axis=1
    )


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of the bytes of every span; spans may overlap, none is empty."""
    starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint32)
    # The first block of a span takes what does not fill a whole one.
    blocks = (ends - starts - 1) // _SPAN
    heads = ends - blocks * _SPAN
    register = _ZEROS[heads - starts] ^ _linear(data, starts, heads)
    left = np.flatnonzero(blocks)
    done = 0
    while len(left):
        begin = heads[left] + done * _SPAN
        register[left] = _after_block(register[left]) ^ _linear(data, begin, begin + _SPAN)
        done += 1
        left = left[blocks[left] > done]
    return register ^ np.uint32(0xFFFFFFFF)


# Letters a to z, digits, and all that is not ASCII make up words.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the texts between the offsets start and end."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _IN_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    # A word at the start of a text is one of its own, whatever comes before.
    edges = offsets[offsets < len(data)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    breaks = np.flatnonzero(~inside)
    ends = breaks[np.searchsorted(breaks, starts)] if len(starts) else starts
    after = np.searchsorted(offsets, starts, "right")
    return starts, np.minimum(ends, np.append(offsets, len(data))[after])


def features(
    data: np.ndarray, offsets: np.ndarray, max_words: int, buckets: int, known: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and bucket of every feature of the texts, and the text of every word.

    Runs that end within the first ``known`` words have been counted before.
    """
    data = _LOWER[data]
    starts, ends = _words(data, offsets)
    whose = np.searchsorted(offsets, starts, "right") - 1
    if max_words > 1 and len(starts):
        # The words with one space between them.
        lengths = ends - starts
        first = np.cumsum(lengths + 1) - lengths - 1
        joined = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
        within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        joined[np.repeat(first, lengths) + within] = data[np.repeat(starts, lengths) + within]
        data, starts, ends = joined, first, first + lengths
    texts, found = [], []
    for count in range(1, max_words + 1):
        last = np.arange(max(count - 1, known), len(starts))
        last = last[whose[last - count + 1] == whose[last]]
        texts.append(whose[last])
        sums = checksums(data, starts[last - count + 1], ends[last])
        found.append(sums.astype(np.int64) % buckets)
    return np.concatenate(texts), np.concatenate(found), whose[known:]


def _read(texts: pa.Array, max_words: int, buckets: int) -> Iterator[tuple]:
    """Features of a batch of texts, a bounded number of bytes at a time.

    Yields the number of the first text, how many there are, and what ``features`` returns.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _STEP, "right")) - 1)
        part = data[offsets[at] : offsets[to]]
        if len(part) <= _STEP:
            yield at, to - at, features(part, offsets[at:to] - offsets[at], max_words, buckets)
        else:
            for piece, known in _pieces(part, max_words):
                yield at, 1, features(piece, np.zeros(1, np.int64), max_words, buckets, known)
        at = to


def _pieces(data: np.ndarray, max_words: int) -> Iterator[tuple[np.ndarray, int]]:
    """A long text cut between words; a later piece repeats the words its runs reach back to."""
    tail, known, start = np.zeros(0, np.uint8), 0, 0
    while start < len(data):
        end = min(start + _STEP, len(data))
        while end < len(data) and _IN_WORD[_LOWER[data[end]]]:
            gaps = np.flatnonzero(~_IN_WORD[_LOWER[data[end : end + _STEP]]])
            end += int(gaps[0]) if len(gaps) else min(_STEP, len(data) - end)
        piece = np.concatenate([tail, data[start:end]])
        yield piece, known
        start = end
        if max_words > 1:
            begins, _ = _words(_LOWER[piece], np.zeros(1, np.int64))
            known = min(max_words - 1, len(begins))
            tail = piece[begins[-known] :] if known else piece[:0]


def bucket_counts(
    texts: DataFrame, max_words: int = MAX_WORDS, buckets: int = BUCKETS
) -> DataFrame:
    """``bucket`` and the number ``n`` of features in it, over all texts.

    A task sends one row per bucket, however much it reads.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, (_, found, _) in _read(batch.column(0), max_words, buckets):
                total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int64()), pa.array(total[held])], ["bucket", "n"]
        )

    text = F.col("text").cast("string").alias("text")
    counted = texts.select(text).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(
    docs: DataFrame, target: DataFrame, max_words: int = MAX_WORDS, buckets: int = BUCKETS
) -> np.ndarray:
    """The gain of every bucket. The driver holds ``buckets`` numbers, whatever the corpora."""

    def counts(texts: DataFrame) -> list[int]:
        found = dict.fromkeys(range(buckets), 0)
        found |= {row.bucket: row.n for row in bucket_counts(texts, max_words, buckets).collect()}
        return [found[at] for at in range(buckets)]

    own, wanted = counts(docs), counts(target)
    own_total, wanted_total = sum(own) + buckets, sum(wanted) + buckets
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * own_total / ((s + 1.0) * wanted_total)))
        for s, t in zip(own, wanted, strict=True)
    ], np.int64)


def noise(id_column: str, seed: int) -> Column:
    """A Gumbel draw in thousandths, from a hash of the id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def score(
    docs: DataFrame,
    gain: np.ndarray,
    id_column: str = "doc_id",
    max_words: int = MAX_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Id, ``n_words``, ``n_features``, ``weight`` and ``score`` of every document."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for at, texts, (whose, found, word) in _read(batch.column(1), max_words, len(gain)):
                part = slice(at, at + texts)
                words[part] += np.bincount(word, minlength=texts)
                n[part] += np.bincount(whose, minlength=texts)
                # Sums of whole numbers, exact in doubles within one block of text.
                total[part] += np.bincount(whose, gain[found], texts).astype(np.int64)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (words, n, weight))],
                ["id", "n_words", "n_features", "weight"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    text = F.col("text").cast("string").alias("text")
    weighed = docs.select(F.col(f"`{id_column}`").alias("id"), text).mapInArrow(
        weigh, f"id {kind}, n_words long, n_features long, weight long"
    )
    scored = weighed.withColumn("score", F.col("weight") + noise("id", seed))
    return scored.withColumnRenamed("id", id_column)


def draw(
    scored: DataFrame,
    id_column: str = "doc_id",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """The scored rows with ``rank`` from 1 for those drawn, NULL for the others.

    Scores are counted in coarse steps first; their number is bounded by the range of the
    scores. Only rows from the step of the last drawn score upwards are sorted, in ranges,
    and numbered by the sizes of the ranges before them.
    """
    rows = written(
        scored.withColumn("_row", F.monotonically_increasing_id()), "scored-documents"
    )
    step = F.floor(F.col("score") / _COARSE)
    counted = (
        rows.where(F.col("n_words") >= min_words)
        .groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    )
    wanted = percent * sum(row.n for row in counted) // 100
    lowest, above = None, 0
    for row in sorted(counted, key=lambda row: -row.step):
        if above >= wanted:
            break
        lowest, above = row.step, above + row.n
    reached = (
        F.lit(False) if lowest is None
        else (F.col("n_words") >= min_words) & (step >= lowest)
    )
    order = [F.col("score").desc(), F.col(id_column).asc_nulls_last(), F.col("_row")]
    ordered = written(
        rows.where(reached).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ordered-documents",
    )
    # Range and number within it, as the place holds them.
    part, number = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {row.part: row.n for row in
             ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for key in sorted(sizes):
        before.append((key, total))
        total += sizes[key]
    starts = scored.sparkSession.createDataFrame(before, "part long, before long")
    rank = F.col("before") + number + 1
    ranked = ordered.join(F.broadcast(starts), part == F.col("part")).withColumn(
        "rank", F.when(rank <= wanted, rank)
    )
    others = rows.where(~F.coalesce(reached, F.lit(False))).withColumn(
        "rank", F.lit(None).cast("long")
    )
    columns = [*scored.columns, "rank"]
    return ranked.select(*columns).unionByName(others.select(*columns))


def op12_target_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    drawn = draw(score(docs, gains(docs, table(spark, sf_dir, "benchmark"))))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = rf"""
WITH RECURSIVE steps(b, c, k) AS (
    SELECT b, CAST(b AS BIGINT), 0 FROM range(256) t(b)
    UNION ALL
    SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, {POLYNOMIAL}) ELSE c // 2 END, k + 1
    FROM steps WHERE k < 8
), crc_table AS (
    SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), texts AS (
    SELECT r, text FROM docs UNION ALL SELECT NULL, coalesce(text, '') FROM benchmark
), occurring AS (
    SELECT r, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
    FROM texts
), words AS (
    SELECT r, w, count(*) AS n FROM occurring GROUP BY r, w
), hashed AS (
    SELECT w, xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(octet_length(encode(w))),
            lambda i: CAST('0x' || substr(hex(encode(w)), 2 * CAST(i AS INT) + 1, 2) AS BIGINT))),
        lambda s, x: xor(s // 256, t[xor(s, x) % 256 + 1])), 4294967295) % {BUCKETS} AS bucket
    FROM (SELECT DISTINCT w FROM words), crc_table
), counts AS (
    SELECT bucket, coalesce(sum(n) FILTER (r IS NOT NULL), 0) AS s,
           coalesce(sum(n) FILTER (r IS NULL), 0) AS t
    FROM words JOIN hashed USING (w) GROUP BY bucket
), totals AS (
    SELECT coalesce(sum(s), 0) AS sums, coalesce(sum(t), 0) AS sumt FROM counts
), gained AS (
    SELECT bucket, CAST(floor(1000 * ln(
        CAST(t + 1 AS DOUBLE) * CAST(sums + {BUCKETS} AS DOUBLE)
        / (CAST(s + 1 AS DOUBLE) * CAST(sumt + {BUCKETS} AS DOUBLE)))) AS BIGINT) AS gain
    FROM counts, totals
), weighed AS (
    SELECT r, CAST(sum(n) AS BIGINT) AS n_features,
           CAST(floor(CAST(sum(n * gain) AS DOUBLE) / sum(n)) AS BIGINT) AS weight
    FROM words JOIN hashed USING (w) JOIN gained USING (bucket)
    WHERE r IS NOT NULL GROUP BY r
), scored AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256(
               '{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE)
               + 0.5) / 4294967296))) AS BIGINT) AS score
    FROM docs LEFT JOIN weighed USING (r)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= {MIN_WORDS}
                                 ORDER BY score DESC, doc_id NULLS LAST) AS place,
           count(*) FILTER (n_features >= {MIN_WORDS}) OVER () AS eligible
    FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= {MIN_WORDS} AND place <= {PERCENT} * eligible // 100
            THEN place END AS rank
FROM placed
"""
