"""Scores of documents by masked pseudo-likelihood.

A window network predicts every word from the ``SIDE`` words on both its sides, never from
itself; the logarithms of these conditional probabilities, summed over a text, are its score.
A word's chance is that of its class, from the network, times its share of the class, from the
counts of all words. The most frequent words of the whole corpus have a class each, all others
share the rest by a hash. Within a class every known word counts one more than it occurs, and
all unknown words together count one. Edges of a text are a class of their own.

Texts are read once: tasks write them as chunks of codes, each with the sorted hashes of its own
words. Counts of words and the answers to a chunk's words move in arrays, by ranges of the hash.

Class frequencies come from all documents. The network is trained once on every document, in
``ROUNDS`` rounds: a hash of the text decides in which one, so copies go together. In a round
every partition trains from the shared weights by itself, and the results are averaged,
weighted by words, in slices. The driver holds the weights, ``COMMON`` words and a total for
each class.

NULL texts and texts without a word score 0.0 over 0 words and have no mean. Repeated rows
score alike. Texts of any length are read whole. An empty corpus gives no rows; other columns
are ignored. Sums of floats may differ in the last digits between reruns and machines.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from cardwarden.llm.common import table, written

CLASSES = 512
COMMON = 256
SIDE = 3
HIDDEN = 32
ROUNDS = 3
STEP = 512
RATE = 0.1
SEED = 11
_RUN = 1 << 18
# Bytes of text to a chunk, of about so many; words that differ in chunks to a range of hashes;
# slices that the weights are added up in.
_CHUNK = 1 << 20
_RANGE = 1 << 20
_SLICES = 32
# No power is taken of more than this, so that sums of powers stay in 32 bits.
_STEEP = 80
# Positions by classes are held in tiles of so many, which BLAS multiplies without copying them.
_TALL, _WIDE = 128, 128

OFFSETS = [at for at in range(-SIDE, SIDE + 1) if at]
# Offsets in a column, and where the weights of each begin if they lie in one table.
_AROUND = np.array(OFFSETS)[:, None]
_FIRST = np.arange(len(OFFSETS))[:, None] * (CLASSES + 1)
# Cells of the weights of an offset, two and two, for each class.
_PAIRS = np.arange((CLASSES + 1) * HIDDEN // 2).reshape(-1, HIDDEN // 2)
# Where the positions of a step, and the classes, lie in tiles.
_LINE = np.arange(STEP) // _TALL * (_TALL * CLASSES) + np.arange(STEP) % _TALL * _WIDE
_COLUMN = np.arange(CLASSES) // _WIDE * (_TALL * _WIDE) + np.arange(CLASSES) % _WIDE


def _power():
    """Powers of 2 where numpy takes 16 at once, of e elsewhere; and by what to multiply for them."""
    try:
        wide = np.lib.introspect.opt_func_info("^exp2$", "float32")["exp2"]["ff"]["current"]
    except (AttributeError, KeyError):
        wide = ""
    return (np.exp2, np.float32(np.log2(np.e))) if wide.startswith("AVX512") else (np.exp, np.float32(1))


_POWER, _UNIT = _power()


class Model(NamedTuple):
    """Sorted hashes of the common words, trained weights, the logarithm of each class's total
    (0 for a class of one word), the counts of all words by ranges of the hash, and how many
    ranges there are."""

    common: np.ndarray
    net: dict[str, np.ndarray]
    within: np.ndarray
    words: DataFrame
    ranges: int


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(SEED)), np.uint64, len(words))


def classes(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Class of each word; ``common`` are the sorted hashes of words with a class of their own."""
    own = len(common)
    rest = own + (hashes % np.uint64(CLASSES - own)).astype(np.int64)
    if not own:
        return rest
    at = np.minimum(np.searchsorted(common, hashes), own - 1)
    return np.where(common[at] == hashes, at, rest)


def _blob(*values: np.ndarray) -> pa.Array:
    return pa.array([value.tobytes() for value in values], pa.binary())


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and all words, as in ``words``."""
    # A NULL has no words. Other edges of white space yield an empty word.
    found = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = found.flatten()
    real = pc.not_equal(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    ends = found.offsets.to_numpy() - found.offsets[0].as_py()
    return np.diff(before[ends]), words.filter(real)


def _chunk(number: int, turn: int, ids: pa.Array, texts: pa.Array) -> list[pa.Array]:
    lengths, words = _split(texts)
    encoded = words.dictionary_encode()
    _, ends, data = encoded.dictionary.buffers()
    ends = np.frombuffer(ends, np.int64, len(encoded.dictionary) + 1, encoded.dictionary.offset * 8).tolist()
    data = data.to_pybytes() if data else b""
    hashes = _hashes([data[start:end] for start, end in zip(ends, ends[1:])])
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.uint16 if len(order) <= 1 << 16 else np.uint32)
    rank[order] = np.arange(len(order))
    codes = rank[encoded.indices.to_numpy()]
    times = np.bincount(codes, minlength=len(order)).astype(np.uint32)
    return [
        pa.array([number]), pa.array([turn], pa.int32()),
        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        *(_blob(x) for x in (lengths.astype(np.uint32), codes, hashes[order], times)),
        pa.array([len(order)], pa.int64()),
    ]


def coded(docs: DataFrame, id_column: str | None = None) -> DataFrame:
    """A row for each chunk of texts of one round: ``ids`` and ``lengths`` of the texts, ``codes``
    of all their words, which are places in ``words``, the sorted hashes of the words that differ
    (``kinds`` of them); ``times`` says how often each occurs."""
    ids = F.col(id_column) if id_column else F.lit(None).cast("int")
    text = F.col("text").cast("string")
    turn = F.pmod(F.xxhash64(text), F.lit(ROUNDS)).cast("int")
    rows = docs.select(ids.alias("id"), text.alias("text"), turn.alias("turn"))
    schema = StructType([
        *StructType.fromDDL("chunk long, turn int").fields,
        StructField("ids", ArrayType(rows.schema["id"].dataType)),
        *StructType.fromDDL("lengths binary, codes binary, words binary, times binary, kinds long").fields,
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
            turns = batch.column("turn").to_numpy()
            for turn in range(ROUNDS):
                mine = np.flatnonzero(turns == turn)
                if not len(mine):
                    continue
                before = np.cumsum(sizes[mine]) - sizes[mine]
                starts = np.flatnonzero(np.diff(before // _CHUNK, prepend=-1))
                for rows in np.split(mine, starts[1:]):
                    rows = pa.array(rows)
                    record = _chunk(number, turn, batch.column("id").take(rows), texts.take(rows))
                    yield pa.RecordBatch.from_arrays(record, schema.names)
                    number += 1

    return written(rows.mapInArrow(read, schema), "lm-coded")


def _array(column, row: int, kind) -> np.ndarray:
    return np.frombuffer(column[row].as_buffer(), kind)


def _places(chunks, row: int, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a chunk, and where the codes of each text end."""
    codes = _array(chunks.column("codes"), row, np.uint16 if kinds <= 1 << 16 else np.uint32)
    return codes, np.cumsum(_array(chunks.column("lengths"), row, np.uint32), dtype=np.int64)


def runs(found: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Classes of many texts in one array, edges between them, and the text of each position.

    A long text spans several runs, which overlap by the window; positions that only lend
    context, and edges, belong to text -1.
    """
    edge = np.full(SIDE, CLASSES, np.int64)
    ids, owner, size = [edge], [np.full(SIDE, -1)], 0
    for at, whole in found:
        for start in range(0, len(whole), _RUN):
            end = min(len(whole), start + _RUN)
            before, after = max(0, start - SIDE), min(len(whole), end + SIDE)
            mine = np.full(after - before, -1)
            mine[start - before : end - before] = at
            ids += [whole[before:after], edge]
            owner += [mine, np.full(SIDE, -1)]
            size += end - start
            if size >= _RUN:
                yield np.concatenate(ids), np.concatenate(owner)
                ids, owner, size = [edge], [np.full(SIDE, -1)], 0
    if size:
        yield np.concatenate(ids), np.concatenate(owner)


def initial(frequency: np.ndarray) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    share = (frequency + 1) / (frequency + 1).sum()
    return {
        "inner": rng.normal(0, 0.1, (len(OFFSETS), CLASSES + 1, HIDDEN)).astype(np.float32),
        "outer": rng.normal(0, 0.1, (HIDDEN, CLASSES)).astype(np.float32),
        "bias": np.log(share).astype(np.float32),
    }


def _hidden(net, ids, at) -> tuple[np.ndarray, np.ndarray]:
    """Classes around some positions, by offset, and the hidden cells there with a 1 for the bias.

    Rows of 0 fill a step.
    """
    near = ids.take(at + _AROUND)
    parts = net["inner"].reshape(-1, HIDDEN).take(near + _FIRST, axis=0, mode="clip")
    hidden = parts[0]
    for part in parts[1:]:
        hidden += part
    cells = np.zeros((STEP, HIDDEN + 1), np.float32)
    np.tanh(hidden, out=cells[: len(at), :HIDDEN])
    cells[: len(at), HIDDEN] = 1
    return near, cells


def _tiled(net) -> np.ndarray:
    """The outer weights, and the bias in a row below them, by ranges of classes."""
    whole = np.concatenate([net["outer"], net["bias"][None]])
    return np.ascontiguousarray(whole.reshape(HIDDEN + 1, -1, _WIDE).swapaxes(0, 1))


def _reach(outer: np.ndarray) -> float:
    """A bound of all logits."""
    return np.abs(outer).sum(axis=1).max()


def _logits(outer, cells, room, steep: bool) -> np.ndarray:
    """What the cells say of each class, for ``_POWER``, in tiles; at most 0 if ``steep``."""
    logits = np.matmul((cells * _UNIT).reshape(-1, 1, _TALL, HIDDEN + 1), outer, out=room)
    if steep:
        logits -= logits.max(axis=(1, 3), keepdims=True)
    return logits


def _sums(powers: np.ndarray) -> np.ndarray:
    return np.matmul(powers, np.ones((_WIDE, 1), np.float32)).sum(axis=1).reshape(-1)


def log_chances(net, within, ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every position that counts: its text, and the logarithm of its word's chance.

    Of a word that shares its class, the logarithm of its own count is still to be added.
    """
    places = np.flatnonzero(owner >= 0)
    true, found, whole = ids[places], np.empty(len(places)), np.empty(len(places))
    outer = _tiled(net)
    steep = _reach(outer) > _STEEP
    room = np.empty((STEP // _TALL, CLASSES // _WIDE, _TALL, _WIDE), np.float32)
    for start in range(0, len(places), STEP):
        part = slice(start, start + STEP)
        at = places[part]
        _, cells = _hidden(net, ids, at)
        logits = _logits(outer, cells, room, steep)
        found[part] = logits.reshape(-1).take(_LINE[: len(at)] + _COLUMN.take(true[part]))
        whole[part] = _sums(_POWER(logits, out=logits))[: len(at)]
    return owner[places], found / _UNIT - np.log(whole) - within[true]


def _adapt(weights: np.ndarray, squares: np.ndarray, step: np.ndarray, room: np.ndarray) -> None:
    np.multiply(step, step, out=room)
    squares += room
    np.sqrt(squares, out=room)
    np.divide(step, room, out=room)
    room *= np.float32(RATE)
    weights -= room


def learn(net, squares, ids: np.ndarray, owner: np.ndarray) -> int:
    """One pass over the positions that count, weights changed in place; how many there were."""
    places = np.flatnonzero(owner >= 0)
    places = np.random.default_rng(SEED).permutation(places)
    ids = ids.astype(np.int16)
    outer, outer_squares = _tiled(net), _tiled(squares)
    room = np.empty((STEP // _TALL, CLASSES // _WIDE, _TALL, _WIDE), np.float32)
    outer_room, step, step_room = map(np.empty_like, (outer, *net["inner"][:2]))
    pairs = step.reshape(-1).view(np.complex64)
    reach = np.inf
    for start in range(0, len(places), STEP):
        at = places[start : start + STEP]
        near, cells = _hidden(net, ids, at)
        # No step changes a weight by more than RATE.
        reach += (HIDDEN + 1) * RATE
        if reach > _STEEP:
            reach = _reach(outer)
        powers = _logits(outer, cells, room, reach > _STEEP)
        _POWER(powers, out=powers)
        # A class's chance is its power by the sum of all; of the true one, 1 goes.
        whole = _sums(powers)
        powers.reshape(-1)[_LINE[: len(at)] + _COLUMN.take(ids.take(at))] -= whole[: len(at)]
        share = 1 / (whole * len(at))
        share[len(at) :] = 0
        returned = np.ascontiguousarray(outer[:, :HIDDEN].swapaxes(1, 2))
        back = np.matmul(powers, returned).sum(axis=1).reshape(-1, HIDDEN)
        back *= share[:, None]
        back *= 1 - cells[:, :HIDDEN] ** 2
        cells *= share[:, None]
        change = np.matmul(cells.reshape(-1, 1, _TALL, HIDDEN + 1).swapaxes(2, 3), powers).sum(axis=0)
        _adapt(outer, outer_squares, change, outer_room)
        back = back[: len(at)].reshape(-1).view(np.complex64)
        for weights, sums, rows in zip(net["inner"], squares["inner"], near):
            step.fill(0)
            np.add.at(pairs, _PAIRS.take(rows, axis=0, mode="clip").reshape(-1), back)
            _adapt(weights, sums, step, step_room)
    for values, tiles in ((net, outer), (squares, outer_squares)):
        tiles = tiles.swapaxes(0, 1).reshape(HIDDEN + 1, CLASSES)
        values["outer"][:], values["bias"][:] = tiles[:HIDDEN], tiles[HIDDEN]
    return len(places)


def _flat(net) -> np.ndarray:
    return np.concatenate([net[name].ravel() for name in ("inner", "outer", "bias")])


def _shaped(flat: np.ndarray) -> dict[str, np.ndarray]:
    inner, outer = len(OFFSETS) * (CLASSES + 1) * HIDDEN, HIDDEN * CLASSES
    parts = np.split(flat.astype(np.float32), [inner, inner + outer])
    return {
        "inner": parts[0].reshape(len(OFFSETS), CLASSES + 1, HIDDEN),
        "outer": parts[1].reshape(HIDDEN, CLASSES), "bias": parts[2],
    }


def _asked(chunks: DataFrame, ranges: int, *columns: str) -> DataFrame:
    """A chunk's words, and with ``times`` their numbers, in a row for each range of the hash."""
    schema = "range int, chunk long, " + ", ".join(f"{name} binary" for name in columns)
    kinds = {"words": np.uint64, "times": np.uint32}
    bounds = np.array([-(-(at << 64) // ranges) for at in range(1, ranges)], np.uint64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, chunk in enumerate(batch.column("chunk").to_pylist()):
                arrays = [_array(batch.column(name), row, kinds[name]) for name in columns]
                ends = np.concatenate([[0], np.searchsorted(arrays[0], bounds), [len(arrays[0])]])
                some = np.flatnonzero(ends[1:] > ends[:-1])
                blobs = [_blob(*(array[ends[at] : ends[at + 1]] for at in some)) for array in arrays]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([chunk] * len(some), pa.int64()), *blobs],
                    ["range", "chunk", *columns],
                )

    return chunks.select("chunk", *columns).mapInArrow(cut, schema)


def _word_counts(chunks: DataFrame, ranges: int) -> DataFrame:
    """How often each word occurs in all texts: sorted ``words`` and their ``n``, by ranges."""

    def add(asked: pa.Table) -> pa.Table:
        words = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in asked.column("words")])
        times = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in asked.column("times")])
        order = np.argsort(words, kind="stable")
        words = words[order]
        first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        n = np.add.reduceat(times[order].astype(np.int64), first)
        range_ = pa.array([asked.column("range")[0].as_py()], pa.int32())
        return pa.Table.from_arrays([range_, _blob(words[first]), _blob(n)], ["range", "words", "n"])

    asked = _asked(chunks, ranges, "words", "times")
    return asked.groupBy("range").applyInArrow(add, "range int, words binary, n binary")


def _counted(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for row in range(batch.num_rows):
        yield _array(batch.column("words"), row, np.uint64), _array(batch.column("n"), row, np.int64)


def _most_frequent(words: DataFrame) -> np.ndarray:
    """Sorted hashes of the ``COMMON`` most frequent words."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, n in _counted(batch):
                signed = hashes.view(np.int64)
                top = np.lexsort((signed, -n))[:COMMON]
                yield pa.RecordBatch.from_arrays([pa.array(signed[top]), pa.array(n[top])], ["word", "n"])

    top = words.mapInArrow(first, "word long, n long").orderBy(F.desc("n"), "word").limit(COMMON).collect()
    return np.sort(np.array([row.word for row in top], np.int64).view(np.uint64))


def _class_totals(words: DataFrame, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each class, how often its words occur and how many there are."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, kinds = np.zeros((2, CLASSES), np.int64)
        for batch in batches:
            for hashes, counts in _counted(batch):
                at = classes(hashes, common)
                np.add.at(n, at, counts)
                kinds += np.bincount(at, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(n), pa.array(kinds)], ["c", "n", "kinds"])

    rows = words.mapInArrow(totals, "c long, n long, kinds long").groupBy("c").agg(
        F.sum("n").alias("n"), F.sum("kinds").alias("kinds")
    ).collect()
    frequency, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in rows:
        frequency[row.c], kinds[row.c] = row.n, row.kinds
    return frequency, kinds


def _learned(chunks: DataFrame, net, common: np.ndarray):
    """The weights after a round on these chunks; as they were if there is no word."""
    shared = chunks.sparkSession.sparkContext.broadcast((net, common))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, known = shared.value
        own = {name: values.copy() for name, values in start.items()}
        squares = {name: np.full_like(values, 1e-4) for name, values in own.items()}

        def texts() -> Iterator[tuple[int, np.ndarray]]:
            for batch in batches:
                for row in range(batch.num_rows):
                    kinds = classes(_array(batch.column("words"), row, np.uint64), known)
                    yield from _texts(kinds, *_places(batch, row, len(kinds)))

        seen = sum(learn(own, squares, ids, owner) for ids, owner in runs(texts()))
        if seen:
            slices = np.array_split(_flat(own).astype(np.float64) * seen, _SLICES)
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(_SLICES), pa.int32()), *(pa.array([x] * _SLICES, pa.int64()) for x in (part, seen)),
                 _blob(*slices)], ["slice", "part", "seen", "x"],
            )

    def add(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("part")
        total = sum(np.frombuffer(x.as_buffer()) for x in parts.column("x"))
        slice_ = pa.array([parts.column("slice")[0].as_py()], pa.int32())
        mean = total / sum(parts.column("seen").to_pylist())
        return pa.Table.from_arrays([slice_, _blob(mean)], ["slice", "x"])

    sums = chunks.select("codes", "lengths", "words", "kinds").mapInArrow(read, "slice int, part long, seen long, x binary")
    rows = sums.groupBy("slice").applyInArrow(add, "slice int, x binary").orderBy("slice").collect()
    return _shaped(np.concatenate([np.frombuffer(row.x) for row in rows])) if rows else net


def _texts(kinds: np.ndarray, codes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The place of each text of a chunk that has words, and the classes of its words."""
    start = 0
    for at, end in enumerate(ends.tolist()):
        if end > start:
            yield at, kinds[codes[start:end]]
        start = end


def _train(chunks: DataFrame) -> Model:
    total = chunks.agg(F.sum("kinds")).first()[0] or 0
    ranges = 1 + total // _RANGE
    words = written(_word_counts(chunks, ranges), "lm-words")
    common = _most_frequent(words)
    frequency, kinds = _class_totals(words, common)
    within = np.log(frequency + kinds + 1)
    within[: len(common)] = 0
    net = initial(frequency)
    for number in range(ROUNDS):
        net = _learned(chunks.where(F.col("turn") == number), net, common)
    return Model(common, net, within, words, ranges)


def train(docs: DataFrame) -> Model:
    return _train(coded(docs))


def _score(chunks: DataFrame, model: Model, id_column: str) -> DataFrame:
    shared = chunks.sparkSession.sparkContext.broadcast((model.common, model.net, model.within))

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        """How often each of the words occurs that a chunk asks for, and its class."""
        words, n = np.empty(0, np.uint64), np.empty(0, np.int64)
        for row in range(known.num_rows):
            words, n = _array(known.column("words"), row, np.uint64), _array(known.column("n"), row, np.int64)
        common, times, kinds = shared.value[0], [], []
        for row in range(asked.num_rows):
            hashes = _array(asked.column("words"), row, np.uint64)
            kinds.append(classes(hashes, common).astype(np.uint16))
            if len(words):
                at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
                times.append(np.where(words[at] == hashes, n[at], 0))
            else:
                times.append(np.zeros(len(hashes), np.int64))
        return pa.Table.from_arrays(
            [asked.column("range"), asked.column("chunk"), _blob(*times), _blob(*kinds)],
            ["range", "chunk", "n", "kinds"],
        )

    def judge(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        common, net, within = shared.value
        answers = answers.sort_by("range")
        n, kinds = (
            np.concatenate([np.empty(0, kind), *(_array(answers.column(name), row, kind) for row in range(len(answers)))])
            for name, kind in (("n", np.int64), ("kinds", np.uint16))
        )
        kinds = kinds.astype(np.int64)
        codes, ends = _places(chunk, 0, len(kinds))
        ids = chunk.column("ids").combine_chunks().flatten()
        lengths, total = np.diff(ends, prepend=0), np.zeros(len(ids))
        for run, owner in runs(_texts(kinds, codes, ends)):
            whose, found = log_chances(net, within, run, owner)
            total += np.bincount(whose, found, len(ids))
        own = np.where(kinds < len(common), 0.0, np.log1p(n))
        some = np.flatnonzero(lengths)
        if len(some):
            total[some] += np.add.reduceat(own[codes], (ends - lengths)[some])
        mean = np.divide(total, lengths, out=np.zeros(len(ids)), where=lengths > 0)
        return pa.Table.from_arrays(
            [ids, pa.array(lengths), pa.array(total), pa.array(mean, mask=lengths == 0)], names=list(schema.names)
        )

    schema = StructType([
        StructField(id_column, chunks.schema["ids"].dataType.elementType), StructField("n_tokens", LongType()),
        StructField("log_likelihood", DoubleType()), StructField("mean_log_likelihood", DoubleType()),
    ])
    asked = _asked(chunks, model.ranges, "words").groupBy("range")
    answers = asked.cogroup(model.words.groupBy("range")).applyInArrow(
        answer, "range int, chunk long, n binary, kinds binary"
    )
    whole = chunks.select("chunk", "ids", "lengths", "codes")
    return whole.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(judge, schema)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """id, ``n_tokens``, ``log_likelihood`` (the sum) and ``mean_log_likelihood`` per row."""
    return _score(coded(docs, id_column), model, id_column)


def op6_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = coded(table(spark, sf_dir, "documents"), "doc_id")
    return _score(chunks, _train(chunks), "doc_id")
