"""SuperMinHash: signatures against the textbook loop, groups against brute force, odd rows."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import superminhash as sm
from cardwarden.llm.common import written

SCHEMA = "doc_id long, text string"


def textbook(shingles, size):
    """One shingle after another, its places drawn by swapping, stopped early."""
    found = [1 << 64] * size
    for shingle in shingles:
        order = list(range(size))
        for layer in range(size):
            if layer << 32 > max(found):
                break
            bits = sm._mixed(np.array([(int(shingle) + 0x9E3779B97F4A7C15 * (layer + 1)) % (1 << 64)], np.uint64))
            bits = int(bits[0])
            pick = layer + ((bits >> 32) * (size - layer) >> 32)
            order[layer], order[pick] = order[pick], order[layer]
            value = layer << 32 | bits & 0xFFFFFFFF
            found[order[layer]] = min(found[order[layer]], value)
    return found


def test_signatures_are_those_of_the_plain_algorithm(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 2, 7, 40, 300)]
    for step in (1 << 18, 50):
        monkeypatch.setattr(sm, "_STEP", step)
        found = sm.signatures([*sets, np.zeros(0, np.uint64)], 24)
        assert [row.tolist() for row in found[:-1]] == [textbook(s, 24) for s in sets]
    assert (found[-1] == np.iinfo(np.uint64).max).all()
    assert sm.signatures([]).shape == (0, sm.BANDS * sm.ROWS)


def test_equal_places_estimate_the_similarity():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        both, one = rng.integers(0, 1 << 63, 85).astype(np.uint64), rng.integers(0, 1 << 63, 15).astype(np.uint64)
        a, b = sm.signatures([np.concatenate([both, one[:8]]), np.concatenate([both, one[8:]])])
        errors.append((a == b).mean() - 0.85)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.03


def plain_set(text):
    words = [w for w in (text or "").encode().lower().split()]
    wide = min(5, len(words))
    return {tuple(words[at : at + 5]) for at in range(len(words) - wide + 1)} if words else set()


def plain(rows):
    sets = [plain_set(text) for _, text in rows]
    label = list(range(len(rows)))

    def root(at):
        while label[at] != at:
            at = label[at]
        return at

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                label[root(a)] = root(b)
    first = {}
    for at, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            first[root(at)] = min(first.get(root(at), doc_id), doc_id)
    return sorted(
        ((doc_id, len(sets[at]), first.get(root(at)), doc_id == first.get(root(at)))
         for at, (doc_id, _) in enumerate(rows)), key=str,
    )


def edited(draw, words, changes):
    words = list(words)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return words


def corpus():
    draw, rows = random.Random(6), []
    for group in range(8):
        base = [f"g{group}w{draw.randrange(500)}" for _ in range(draw.choice([40, 90, 200]))]
        for _ in range(draw.choice([1, 5, 14])):
            rows.append(" ".join(edited(draw, base, draw.choice([0, 0, 1, 2, 3, 5]))))
    chain = [f"c{at}" for at in range(240)]
    rows += [" ".join(chain[at : at + 150]) for at in range(0, 90, 9)]
    rows = list(enumerate(rows, 1))
    rows += [(400, None), (401, ""), (402, " \n"), (403, None), (404, "one two"), (405, "ONE  two"), (406, "two one")]
    rows += [(None, rows[0][1]), (None, "no id here but five words"), (None, "no id here but five words"), rows[3], rows[3]]
    rows += [(500, " ".join(f"l{at % 70_000}" for at in range(90_000))), (501, "a b c d ä"), (502, "A b\tc d ä")]
    draw.shuffle(rows)
    return rows


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_groups_against_brute_force(spark):
    rows = corpus()
    docs = written(spark.createDataFrame(rows, SCHEMA).repartition(4), "sm")
    clash = docs.withColumns({n: F.lit("x") for n in ("id", "n", "row", "rep", "label", "bucket", "kept")})
    assert collected(sm.near_duplicates(clash)) == plain(rows)


@pytest.mark.parametrize("block, columns", [(512, 4096), (7, 16)])
def test_a_crowd_is_compared_in_blocks(spark, monkeypatch, block, columns):
    """Many near copies around the least similarity share buckets without all being linked."""
    monkeypatch.setattr(sm, "_BLOCK", block)
    draw = random.Random(9)
    base = [f"w{at}" for at in range(120)]
    rows = [(at, " ".join(edited(draw, base, draw.choice([1, 2, 3, 4])))) for at in range(120)]
    docs = written(spark.createDataFrame(rows, SCHEMA).repartition(4), "sm-crowd")
    found = collected(sm.near_duplicates(docs))
    assert found == plain(rows)
    assert 1 < len({r[2] for r in found}) < 120


@pytest.mark.parametrize("columns", [5, 4096])
def test_blocks_find_the_components_of_all_links(monkeypatch, columns):
    monkeypatch.setattr(sm, "_COLUMNS", columns)
    rng, sets = np.random.default_rng(4), []
    for base in range(6):
        whole = rng.integers(0, 1 << 62, 60)
        sets += [np.unique(rng.choice(whole, int(rng.integers(45, 61)), replace=False)) for _ in range(9)]
    frame = pd.DataFrame({"rep": range(len(sets)), "label": range(len(sets)), "set": sets})
    frame = frame.sample(frac=1, random_state=1)
    one, two = frame.iloc[:20], frame
    found = sm.compare_blocks(one, two, 85)
    label = list(range(len(sets)))

    def root(at):
        return at if label[at] == at else root(label[at])

    for a in one["rep"]:
        for b in two["rep"]:
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                label[root(a)] = root(b)
    expected = [root(at) for at in range(len(sets))]
    label = list(range(len(sets)))
    for a, b in found:
        assert root(a) != root(b)
        label[root(a)] = root(b)
    same = lambda roots: {(a, b) for a in range(54) for b in range(54) if roots[a] == roots[b]}
    assert same([root(at) for at in range(len(sets))]) == same(expected)
    lone = pd.DataFrame({"rep": [1], "label": [1], "set": [np.array([5])]})
    assert sm.compare_blocks(lone, lone.assign(rep=2, label=2, set=[np.array([6])]), 85) == []


def test_real_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert collected(sm.near_duplicates(docs)) == plain(rows)


def test_nothing_and_no_link(spark):
    none = written(spark.createDataFrame([], SCHEMA), "sm-none")
    assert sm.near_duplicates(none).count() == 0
    rows = [(1, "a b c d e f"), (2, "u v w x y z"), (3, None)]
    docs = written(spark.createDataFrame(rows, SCHEMA), "sm-apart")
    assert collected(sm.near_duplicates(docs)) == plain(rows)


@pytest.mark.parametrize("size", [1, 4])
def test_rows_of_one_id_and_text(spark, size):
    found = spark.range(3000).selectExpr("cast(null as long) as doc_id", "'a b c d e f g' as text")
    near = spark.createDataFrame([(9, "a b c d e f g"), (10, "q r s")], SCHEMA)
    docs = written(found.unionByName(near).repartition(size), "sm-hot")
    rows = sm.near_duplicates(docs).groupBy("doc_id", "component_id", "kept").count().collect()
    assert sorted((tuple(r) for r in rows), key=str) == [
        (10, 10, True, 1), (9, 9, True, 1), (None, 9, False, 3000)
    ]
