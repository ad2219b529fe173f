"""The network of op6 against plain arithmetic, and what the operator moves and writes."""

import os
import uuid

import numpy as np
import pyarrow as pa
import pytest

from cardwarden.llm import common, masked_lm
from cardwarden.llm.words import word_blocks

TEXTS = ["", " ", None, "\x0b\x0ca\r\nb ", "a\xa0b c\x1cd\x85e \x00 f\tf", "x" * 300, " ".join(map(str, range(5000)))]


@pytest.fixture()
def shared(tmp_path, monkeypatch):
    """The folder that intermediate tables are written to."""
    monkeypatch.setattr(common, "scratch", lambda spark, purpose: str(tmp_path / f"{purpose}-{uuid.uuid4().hex}"))
    return tmp_path


def _run(rng, n):
    """Positions with an edge here and there, more than fill whole steps."""
    ids = rng.integers(masked_lm.CLASSES, size=n)
    ids[:: 97] = masked_lm.CLASSES
    ids[:3] = ids[-3:] = masked_lm.CLASSES
    return ids, np.where(ids < masked_lm.CLASSES, 0, -1)


def _net(rng, steepness):
    net = masked_lm.initial(rng.integers(1000, size=masked_lm.CLASSES).astype(float))
    net["bias"] *= np.float32(steepness)
    return net


def _chances(net, ids, at):
    """Hidden cells and chances of all classes, in 64 bits."""
    rows = [net["inner"][place][ids[at + offset]] for place, offset in enumerate(masked_lm.OFFSETS)]
    hidden = np.tanh(np.sum(rows, axis=0, dtype=float))
    logits = hidden @ net["outer"].astype(float) + net["bias"]
    weight = np.exp(logits - logits.max(axis=1, keepdims=True))
    return hidden, weight / weight.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("steepness", [1, 30])
def test_chances_are_those_of_a_plain_softmax(steepness):
    rng = np.random.default_rng(1)
    ids, owner = _run(rng, 1300)
    net, within = _net(rng, steepness), rng.random(masked_lm.CLASSES)
    places = np.flatnonzero(owner >= 0)
    _, chance = _chances(net, ids, places)
    expected = np.log(chance[np.arange(len(places)), ids[places]]) - within[ids[places]]
    whose, found = masked_lm.log_chances(net, within, ids, owner)
    assert len(found) == len(places) and not whose.any()
    assert np.allclose(found, expected, rtol=1e-5, atol=1e-4)


@pytest.mark.parametrize("steepness", [1, 30])
def test_learning_is_that_of_plain_gradients(steepness):
    rng = np.random.default_rng(2)
    ids, owner = _run(rng, 1300)
    net = _net(rng, steepness)
    plain = {name: values.astype(float) for name, values in net.items()}
    squares = {name: np.full_like(values, 1e-4) for name, values in net.items()}
    sums = {name: np.full_like(values, 1e-4) for name, values in plain.items()}
    places = np.flatnonzero(owner >= 0)
    assert masked_lm.learn(net, squares, ids, owner) == len(places)
    places = np.random.default_rng(masked_lm.SEED).permutation(places)
    for start in range(0, len(places), masked_lm.STEP):
        at = places[start : start + masked_lm.STEP]
        hidden, slope = _chances(plain, ids, at)
        slope[np.arange(len(at)), ids[at]] -= 1
        slope /= len(at)
        back = (slope @ plain["outer"].T) * (1 - hidden**2)
        steps = {"outer": hidden.T @ slope, "bias": slope.sum(axis=0), "inner": np.zeros_like(plain["inner"])}
        for place, offset in enumerate(masked_lm.OFFSETS):
            np.add.at(steps["inner"][place], ids[at + offset], back)
        for name, step in steps.items():
            sums[name] += step**2
            plain[name] -= masked_lm.RATE * step / np.sqrt(sums[name])
    for name, values in plain.items():
        assert np.allclose(net[name], values, rtol=1e-3, atol=1e-3)
        assert np.allclose(squares[name], sums[name], rtol=1e-2, atol=1e-7)


@pytest.mark.parametrize("more", [0, 70_000])
def test_chunks_hold_the_words_of_the_texts(more):
    texts = [*TEXTS, " ".join(f"m{n}" for n in range(more))]
    ids = pa.array([*range(len(texts) - 1), None])
    number, turn, held, lengths, codes, words, times, kinds = masked_lm._chunk(
        7, 1, ids, pa.array(texts).cast(pa.large_string())
    )
    expected = [[w for block in word_blocks((text or "").encode()) for w in block] for text in texts]
    assert held[0].as_py() == ids.to_pylist()
    lengths = np.frombuffer(lengths[0].as_py(), np.uint32)
    assert lengths.tolist() == [len(found) for found in expected]
    words = np.frombuffer(words[0].as_py(), np.uint64)
    assert kinds[0].as_py() == len(words) == len({w for found in expected for w in found})
    codes = np.frombuffer(codes[0].as_py(), np.uint16 if len(words) <= 1 << 16 else np.uint32)
    flat = [w for found in expected for w in found]
    assert (words[codes] == masked_lm._hashes(flat)).all() and (np.diff(words.astype(float)) >= 0).all()
    assert (np.frombuffer(times[0].as_py(), np.uint32) == np.bincount(codes)).all()


def test_chunks_are_cut_between_texts(spark):
    texts = [f"a{n} " * 60_000 for n in range(40)]
    rows = [(n, text) for n, text in enumerate(texts)] + [(None, None), (40, "")]
    chunks = masked_lm.coded(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "doc_id").collect()
    assert len(chunks) > masked_lm.ROUNDS and len({chunk.chunk for chunk in chunks}) == len(chunks)
    held = [(chunk.turn, doc) for chunk in chunks for doc in chunk.ids]
    assert sorted(doc for _, doc in held if doc is not None) == list(range(41)) and len(held) == 42
    for chunk in chunks:
        lengths = np.frombuffer(chunk.lengths, np.uint32)
        assert len(lengths) == len(chunk.ids)
        assert lengths.tolist() == [60_000 if doc is not None and doc < 40 else 0 for doc in chunk.ids]


def test_texts_are_read_once_and_words_move_in_arrays(spark, shared):
    rng = np.random.default_rng(3)
    rows = [(f"id{n}", " ".join(f"w{k}" for k in rng.integers(3000, size=80))) for n in range(300)] + [(None, None)]
    docs = common.written(spark.createDataFrame(rows, "key string, text string").coalesce(2), "docs")
    scored = masked_lm.score(docs, masked_lm.train(docs), "key")
    plan = scored._jdf.queryExecution().sparkPlan().toString()
    assert "Generate" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    assert sorted({name.rsplit("-", 1)[0] for name in os.listdir(shared)}) == ["llm-docs", "llm-lm-coded", "llm-lm-words"]
    for name in os.listdir(shared):
        if "-lm-" in name:
            assert spark.read.parquet(str(shared / name)).count() < 20
    found = {row.key: row for row in scored.collect()}
    assert len(found) == 301 and scored.schema["key"].dataType.simpleString() == "string"
    assert found[None].n_tokens == 0 and found[None].mean_log_likelihood is None
    assert all(found[key].n_tokens == 80 and -40 * 80 < found[key].log_likelihood < 0 for key, text in rows if key)
