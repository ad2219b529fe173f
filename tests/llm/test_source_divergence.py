"""Source divergence: against a plain loop over all terms, and its parts on odd input."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import source_divergence as sd
from cardwarden.llm.common import written

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def plain(rows, min_docs=3, top=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        groups.add((lang, source))
        terms = TERM.findall(lowered)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    result = []
    for lang in {lang for lang, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = sorted(s for at, s in groups if at == lang)

        def shares(count):
            size = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // size for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for a in sources:
            found = [(sum((p[a][t] - p[b][t]) ** 2 // p[b][t] for t in kept), b, "pair")
                     for b in sources if a != b]
            terms = [((p[a][t] - q[t]) ** 2 // q[t], t, "term")
                     for t in kept if counts[lang, a][t] and p[a][t] > q[t]]
            for part, most in ((found, len(found)), (terms, top)):
                part.sort(key=lambda r: (-r[0], r[1].encode()))
                result += [(lang, a, kind, item, value, at)
                           for at, (value, item, kind) in enumerate(part[:most], 1)]
    return sorted(result)


def corpus():
    draw, rows = random.Random(4), []
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in "xyzäЖé"]
    for at in range(160):
        lang = draw.choice(["en", "en", "de", None, ""])
        source = draw.choice(["s1", "s1", "s1", "s2", "s3", None, "ß"])
        size = draw.choice([0, 1, 8, 40])
        words = [draw.choice(vocabulary[: 20 + at % 28]) for _ in range(size)]
        rows.append((at, draw.choice([" ", "7", "\n"]).join(words).title(), lang, source))
    rows += [(500, None, "en", "s9"), (501, "12 34", "en", "s8"), (None, "only here", "xx", "a")]
    rows += [(502, "other words", "xx", "b"), rows[3], rows[3], (503, "lone", "yy", "s1")]
    return rows + [(504, "long " * 3000 + "tail", "de", "s1")]


@pytest.mark.parametrize("postings, batch, top", [(250_000, 10_000, 200), (17, 3, 4)])
def test_against_a_plain_loop(spark, conf, postings, batch, top):
    conf({"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)})
    rows = corpus()
    docs = written(spark.createDataFrame(rows, SCHEMA).repartition(3), "sd")
    clash = docs.withColumns({n: F.lit("?") for n in ("term", "item", "n", "p", "v", "rank", "part")})
    found = sd.divergence(clash, top_terms=top, block_postings=postings).collect()
    assert sorted(tuple(r) for r in found) == plain(rows, top=top)


def test_nothing_to_compare(spark):
    docs = written(spark.createDataFrame([], SCHEMA), "sd-none")
    assert sd.divergence(docs).collect() == []
    blank = spark.createDataFrame([(1, None, None, None), (2, "", "en", "a"), (3, "x", "en", "b")], SCHEMA)
    found = sorted(tuple(r) for r in sd.divergence(written(blank, "sd-blank")).collect())
    assert found == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_runs_are_sorted_and_sharded():
    block = sd._Block()
    for source in ("b", "a"):
        block.add("en", source, [b"m", b"c", b"m", b"z", b"a"])
        block.add_document("en", source, {b"m", b"c", b"z", b"a", source.encode() * 2})
    run = block.run(3).to_pylist()
    assert [r["shard"] for r in run] == sorted({r["shard"] for r in run})
    found = []
    for r in run:
        terms = r["terms"].split(" ")
        assert terms == sorted(terms) and len(terms) == len(r["per_term"])
        each = [t for t, many in zip(terms, r["per_term"]) for _ in range(many)]
        found += zip(each, [r["names"][at] for at in r["source"]], r["n"], r["docs"])
    one = [("c", 1, 1), ("a", 1, 1), ("m", 2, 1), ("z", 1, 1)]
    expected = [(t, source, n, d) for source in "ab" for t, n, d in one]
    assert sorted(found) == sorted([*expected, ("aa", "a", 0, 1), ("bb", "b", 0, 1)])


def test_merging_adds_up_postings():
    def segment(terms, *columns):
        return sd._Segment(terms, *(np.array(column) for column in columns))

    one = segment(["a", "c"], [1, 2], [0, 0, 3], [1, 2, 4], [1, 1, 1])
    two = segment(["a", "b"], [2, 1], [1, 0, 0], [5, 1, 7], [2, 1, 1])
    held = sd.merged([one, two, one])
    assert held.terms == ["a", "b", "c"] and held.per_term.tolist() == [2, 1, 2]
    assert held.source.tolist() == [0, 1, 0, 0, 3]
    assert held.n.tolist() == [3, 5, 7, 4, 8] and held.docs.tolist() == [3, 2, 1, 2, 2]


def test_terms_of_cut_texts(monkeypatch):
    text = " ".join(["Aé", "b-c", "D9e"] * 50)
    whole = [t for part in sd._terms(text) for t in part]
    monkeypatch.setattr(sd, "_TEXT", 7)
    assert [t for part in sd._terms(text) for t in part] == whole == [
        w.encode() for w in ["aé", "b", "c", "d", "e"] * 50
    ]


def test_pairs_a_few_at_a_time():
    rows = pa.table({
        "lang": ["en"] * 7, "term": ["a"] * 4 + ["b"] * 3, "source": list("wxyzwxy"),
        "p": [9, 5, 7, 3, 4, 8, 6], "zero": [1, 2, 3, 1, 1, 2, 3],
    })

    def sums(bound):
        total = Counter()
        for batch in sd.pair_changes(rows, bound):
            for r in batch.to_pylist():
                total[r["source"], r["item"]] += r["value"]
        return total

    assert sums(1) == sums(5) == sums(1 << 20)
    f = lambda p, q: (p - q) ** 2 // q
    one = lambda p, q, a, b: f(p, q) - f(p, b) - f(a, q) + f(a, b)
    assert sums(5)["w", "x"] == one(9, 5, 1, 2) + one(4, 8, 1, 2)
