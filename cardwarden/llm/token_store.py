"""Token ids in binary shards, with a minimal perfect hash index for keyed access.

Documents are sorted by key into shards. A shard is one raw file of little-endian unsigned
ids, of 16 bits if the tokenizer's ids all fit and else of 32, and one index file. The index
holds, for each distinct key of the shard, one slot
of a minimal perfect hash: the key's fingerprint, its first record and its number of
records; and for each record its offset in the payload. The keys are kept in order beside it,
for reading a shard from end to end.

Tasks write under names of their own and report them; the reports are a table that Spark
commits, so a task that ran twice, or was lost, leaves at most a file no report names. A
report has the first and last key of its shard: they lead from a key to its shards, and the
index from there to its records (``fetch``).

NULL and empty texts are the end id alone. Rows repeating a key are records of their own,
in the order of their texts' hashes, and are all found by their key: where they span shards, each
of these has an entry for its part. Rows without a key come first, in as many shards as they
fill, and can be read in order, but not by key. An empty table gives no shards and no rows. Other
columns are ignored.
"""

from __future__ import annotations

import io
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import table, written
from cardwarden.llm.tokens import forget, token_ids, vocabulary
from cardwarden.session import scratch
from cardwarden.sources.shared import SharedFiles

TOKENIZER = "byte_bpe_50k.json"
END = 0
SHARD_BYTES = 16 << 20
_BUCKET = 4
_TRIES = 256
_READ = 256


def _place(uri: str):
    """File system and path of a folder named by its whole URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


# The minimal perfect hash: hash and displace, single keys placed directly.


def _mix(values: np.ndarray, seed) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = values ^ (np.asarray(seed, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hashes(keys) -> tuple[np.ndarray, np.ndarray]:
    """64 bits that place a key and 64 others, its fingerprint."""
    names = [str(key).encode() for key in keys]
    place = np.array([xxhash.xxh64_intdigest(name, 1) for name in names], np.uint64)
    return place, np.array([xxhash.xxh64_intdigest(name, 2) for name in names], np.uint64)


def perfect_hash(hashes: np.ndarray) -> np.ndarray:
    """Per bucket: a seed that sends its keys to free slots, or -1 - slot for a single key."""
    n = len(hashes)
    seeds = np.zeros(max(1, -(-n // _BUCKET)), np.int64)
    bucket = (_mix(hashes, 0) % np.uint64(len(seeds))).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=len(seeds))
    ends = np.cumsum(sizes)
    free = np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        size = sizes[b]
        if size <= 1:
            break
        members = hashes[order[ends[b] - size : ends[b]]]
        first = 1
        while True:
            tried = np.arange(first, first + _TRIES, dtype=np.uint64)[:, None]
            slots = (_mix(members[None, :], tried) % np.uint64(n)).astype(np.int64)
            apart = np.sort(slots, axis=1)
            good = free[slots].all(axis=1) & (np.diff(apart, axis=1) != 0).all(axis=1)
            if good.any():
                hit = int(good.argmax())
                seeds[b] = first + hit
                free[slots[hit]] = False
                break
            first += _TRIES
    open_slots = iter(np.flatnonzero(free))
    for b in np.flatnonzero(sizes == 1):
        seeds[b] = -1 - next(open_slots)
    return seeds


def slots_of(hashes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    seed = seeds[(_mix(hashes, 0) % np.uint64(len(seeds))).astype(np.int64)]
    moved = (_mix(hashes, np.maximum(seed, 0).astype(np.uint64)) % np.uint64(max(n, 1))).astype(np.int64)
    return np.where(seed < 0, -1 - seed, moved)


class Shard:
    """One shard opened for reading: records in order, or by key."""

    def __init__(self, folder: str, name: str):
        self.files, self.root = _place(folder)
        self.payload = f"{self.root}/{name}.ids"
        with self.files.open_input_file(f"{self.root}/{name}.idx") as source:
            index = np.load(io.BytesIO(source.read()), allow_pickle=False)
            self.offsets, self.seeds = index["offsets"], index["seeds"]
            self.prints, self.first, self.many = index["prints"], index["first"], index["many"]
            self.keys, self.width = index["keys"], int(index["width"])

    def find(self, keys) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key; 0 records if it is not held."""
        hashes, prints = key_hashes(keys)
        if not len(self.prints):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        slots = slots_of(hashes, self.seeds, len(self.prints))
        held = self.prints[slots] == prints
        return self.first[slots], np.where(held, self.many[slots], 0)

    def records(self, first: int, many: int) -> list[np.ndarray]:
        start, end = int(self.offsets[first]), int(self.offsets[first + many])
        with self.files.open_input_file(self.payload) as source:
            source.seek(self.width * start)
            held = source.read(self.width * (end - start))
        data = np.frombuffer(held, f"<u{self.width}").astype("<u4")
        cuts = (self.offsets[first + 1 : first + many] - start).astype(np.int64)
        return np.split(data, cuts)


def write_shards(
    docs: DataFrame, folder: str, id_column: str = "doc_id", tokenizer: str = TOKENIZER,
    end: int = END, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write the shards; the table of them.

    Columns are shard, name, records, unkeyed (records without a key), ids, first_key and
    last_key as text, and start, the number of ids in all shards before.
    """
    folder = SharedFiles(docs.sparkSession).qualified(folder)
    width = 2 if max(vocabulary(tokenizer), end + 1) <= 1 << 16 else 4
    size = docs.agg(F.sum(F.octet_length("text")).alias("n"), F.count("*").alias("rows")).first()
    shards = max(1, -(-((size.n or 0) + 16 * size.rows) // shard_bytes))
    # The row number lets the rows of one key, or without one, span shards.
    numbered = docs.select(
        F.col(id_column).alias("key"), F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    place = ("key", F.xxhash64("text"), "row")
    ordered = (
        numbered.repartitionByRange(shards, *place)
        .sortWithinPartitions(*place)
        .select("key", "text", F.spark_partition_id().alias("shard"))
    )
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, files, root = uuid.uuid4().hex, *_place(folder)
        files.create_dir(root, recursive=True)
        offsets, keys, firsts = [np.zeros(1, np.int64)], [], []
        records = total = 0
        shard, last, empty = None, None, True
        with files.open_output_stream(f"{root}/{name}.ids") as sink:
            for frame in frames:
                if frame.empty:
                    continue
                shard, lengths = int(frame["shard"].iloc[0]), []
                for key, ids in zip(frame["key"], token_ids(frame["text"], tokenizer, end), strict=True):
                    sink.write(ids.astype(f"<u{width}").tobytes())
                    if not pd.isna(key) and (empty or key != last):
                        keys.append(key)
                        firsts.append(records)
                        last, empty = key, False
                    lengths.append(len(ids))
                    records += 1
                offsets.append(total + np.cumsum(lengths, dtype=np.int64))
                total = int(offsets[-1][-1])
        forget(tokenizer)
        if not records:
            files.delete_file(f"{root}/{name}.ids")
            return
        first = np.array(firsts, np.int64)
        many = np.diff(np.append(first, records))
        hashes, prints = key_hashes(keys)
        seeds = perfect_hash(hashes)
        slots = slots_of(hashes, seeds, len(hashes))
        laid = [np.zeros(len(hashes), a.dtype) for a in (prints, first, many)]
        for target, values in zip(laid, (prints, first, many), strict=True):
            target[slots] = values
        held = io.BytesIO()
        np.savez(held, offsets=np.concatenate(offsets), seeds=seeds, prints=laid[0],
                 first=laid[1], many=laid[2], keys=np.array([k.encode() for k in keys], "S"),
                 width=width)
        with files.open_output_stream(f"{root}/{name}.idx") as sink:
            sink.write(held.getvalue())
        unkeyed = int(first[0]) if len(first) else records
        ends = (keys[0], keys[-1]) if keys else (None, None)
        yield pd.DataFrame(
            [(shard, name, records, unkeyed, total, *ends)],
            columns=["shard", "name", "records", "unkeyed", "ids", "first_key", "last_key"],
        )

    # Keys are handed over as text, so that a NULL does not turn whole numbers into floats.
    reports = written(
        ordered.withColumn("key", F.col("key").cast("string")).mapInPandas(
            write,
            "shard int, name string, records long, unkeyed long, ids long,"
            " first_key string, last_key string",
        ),
        "token-shards",
    )
    whole = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return reports.withColumn("start", F.coalesce(F.sum("ids").over(whole), F.lit(0).cast("long")))


def read_back(shards: DataFrame, folder: str, kind: str, id_column: str = "doc_id") -> DataFrame:
    """Every record of the files: id, start among all ids, n_tokens and ids_crc32.

    Each key is looked up in the hash index and read from where that points to.
    """

    def ranges(shard: Shard, unkeyed: int):
        yield np.full(unkeyed, None, object), 0, unkeyed
        for at in range(0, len(shard.keys), _READ):
            keys = [key.decode() for key in shard.keys[at : at + _READ]]
            first, many = shard.find(keys)
            if not many.all() or (first[1:] != first[:-1] + many[:-1]).any():
                raise ValueError("the index does not lead to its keys")
            yield np.repeat(np.array(keys, object), many), int(first[0]), int(many.sum())

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                shard = Shard(folder, row.name)
                for keys, first, many in ranges(shard, row.unkeyed):
                    for at in range(0, many, _READ):
                        some = min(_READ, many - at)
                        data = shard.records(first + at, some)
                        begins = shard.offsets[first + at : first + at + some]
                        yield pd.DataFrame({
                            "key": keys[at : at + some],
                            "start": row.start + begins,
                            "n_tokens": [len(ids) for ids in data],
                            "ids_crc32": [zlib.crc32(ids.tobytes()) for ids in data],
                        })

    folder = SharedFiles(shards.sparkSession).qualified(folder)
    count = max(1, shards.count())
    found = shards.select("name", "unkeyed", "start").repartition(count).mapInPandas(
        read, "key string, start long, n_tokens long, ids_crc32 long"
    )
    return found.select(
        F.col("key").cast(kind).alias(id_column), "start", "n_tokens", "ids_crc32"
    )


def fetch(
    shards: DataFrame, folder: str, wanted: DataFrame, id_column: str = "doc_id"
) -> DataFrame:
    """The ids of every record of the wanted keys: id, ``shard``, ``record`` and ``ids``.

    ``wanted`` has distinct keys of the stored kind. A key is sent to the shards whose first
    and last key enclose it, which are more than one only where its rows span shards; each
    looks it up in constant time. Keys that are not held give no row.
    """
    folder = SharedFiles(shards.sparkSession).qualified(folder)
    kind = wanted.schema[id_column].dataType.simpleString()
    keyed = shards.where(F.col("first_key").isNotNull()).select(
        "shard", "name", F.col("first_key").cast(kind).alias("low"),
        F.col("last_key").cast(kind).alias("high"),
    )
    # One row per shard; the shards before a key end below it, the ones after start above.
    asked = wanted.select(F.col(id_column).alias("key")).join(
        keyed, F.col("key").between(F.col("low"), F.col("high"))
    )

    def read(frame: pd.DataFrame) -> pd.DataFrame:
        shard, rows = Shard(folder, frame["name"].iloc[0]), []
        number = int(frame["shard"].iloc[0])
        for key, first, many in zip(frame["key"], *shard.find(frame["key"])):
            for at, ids in enumerate(shard.records(int(first), int(many)) if many else ()):
                rows.append((key, number, int(first) + at, ids.tolist()))
        return pd.DataFrame(rows, columns=["key", "shard", "record", "ids"])

    found = asked.select("name", "shard", F.col("key").cast("string").alias("key")).groupBy(
        "name"
    ).applyInPandas(read, "key string, shard int, record long, ids array<long>")
    return found.select(F.col("key").cast(kind).alias(id_column), "shard", "record", "ids")


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "token-ids")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return read_back(write_shards(docs, folder), folder, kind)
