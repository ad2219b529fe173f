"""Nulls, empty and long texts, repeated rows, empty tables, clashing columns, for each operator."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardwarden.llm import (
    language_id, masked_lm, mixing, packing, quality_ledger, simhash, suffix_dedup, token_store,
    top_k, url_filter,
)
from cardwarden.llm.common import written
from cardwarden.llm import tokens

def _tokenizer(name):
    """The tokenizer as anyone would load it."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LIMIT = 1 << 19


def words(seed, n, letters="abcdefgh"):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list(letters), 4)) for _ in range(n))


PASSAGE = words(99, 60)
ROWS = [
    (1, words(1, 80), "en", "a"),
    (2, words(2, 80), "en", "a"),
    (3, words(1, 80), "en", "b"),
    (3, words(1, 80), "en", "b"),
    (4, None, "en", "b"),
    (5, "", None, None),
    (None, words(3, 90), "de", "a"),
    (6, words(4, 30, "mnopqrst") + " " + PASSAGE + " " + words(5, 20, "mnopqrst"), "de", "c"),
    (7, words(6, 25, "mnopqrst") + " " + PASSAGE, "de", None),
    (8, words(7, 60_000, "mnopqrst"), "de", "c"),
    (9, "123 !!! 456", None, "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in ROWS]
    return written(spark.createDataFrame(rows, DOCS), "case-docs")


@pytest.fixture(scope="module")
def nothing(spark):
    return written(spark.createDataFrame([], DOCS), "case-empty")


def test_language(docs, nothing):
    judged = language_id.identify(docs, language_id.train(docs)).collect()
    assert len(judged) == len(ROWS)
    for row in judged:
        blank = row.text is None or not any(ch.isalpha() for ch in row.text)
        assert (row.lang_pred == "und") == blank
        assert 0 <= row.score <= 1
    assert language_id.train(nothing) is None
    assert language_id.identify(nothing, None).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    found = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = language_id.identify(found, language_id.train(found))
    right = judged.where(language_id.held_out() & F.col("lang").isNotNull())
    assert right.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_targets():
    assert mixing.targets([10, 10], [1, 1], 30) == [15, 15]
    assert mixing.targets([1, 100], [3, 1], 50) == [2, 48]
    assert mixing.targets([0, 10], [3, 1], 15) == [0, 15]
    assert mixing.targets([], [], 0) == []


def test_split_keeps_every_block():
    counts = np.array([7, 0, 30])
    parts = mixing.split(counts, 5, np.random.default_rng(1))
    assert len(parts) == 5 and (sum(parts) == counts).all()


def test_mixing(docs, nothing):
    clash = docs.withColumn("size", F.lit("x")).withColumn("target", F.lit(1))
    rows = mixing.draws(clash).collect()
    assert len(rows) == len(ROWS)
    assert all(len(r.draws) <= 2 for r in rows)
    again = mixing.draws(clash).collect()
    shown = lambda found: sorted((str(r.doc_id), r["size"], r.draws) for r in found)
    assert shown(rows) == shown(again)
    assert mixing.mixed(mixing.draws(docs)).count() == sum(len(r.draws) for r in rows)
    assert mixing.draws(nothing).count() == 0


def water_filled(sizes, weights, total):
    """The targets again, by raising a common level until all is dealt."""
    low, high = 0.0, 2.0 * sum(sizes) + 1
    for _ in range(200):
        level = (low + high) / 2
        dealt = sum(min(2 * size, level * weight) for size, weight in zip(sizes, weights))
        low, high = (level, high) if dealt < total else (low, level)
    return [min(2 * size, low * weight) for size, weight in zip(sizes, weights)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_mixing_comes_near_its_targets(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    found = mixing.draws(docs, shard_words=10_000).collect()
    sizes = {}
    for r in found:
        assert r["size"] == len((r.text or "").encode().split()) and len(r.draws) <= 2
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    sources = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = [(3, 1, 2)[at % 3] for at in range(len(sources))]
    goals = water_filled([sizes[s] for s in sources], weights, 1.5 * sum(sizes.values()))
    for source, goal in zip(sources, goals):
        rows = [r for r in found if r.source == source]
        assert {r.source_size for r in rows} == {sizes[source]}
        assert all(abs(r.target - goal) < 1e-6 * goal + 1e-6 for r in rows)
        assert abs(sum(r["size"] * len(r.draws) for r in rows) - goal) <= 0.01 * goal


def test_nearest_is_the_best_sum(monkeypatch):
    rng = np.random.default_rng(5)
    for _ in range(60):
        sizes = rng.integers(0, 40, 9).tolist()
        goal = float(rng.uniform(0, 1.3 * sum(sizes)))
        chosen = mixing.nearest(sizes, goal)
        assert len(set(chosen)) == len(chosen)
        sums = [sum(v for i, v in enumerate(sizes) if mask >> i & 1) for mask in range(512)]
        assert abs(sum(sizes[at] for at in chosen) - goal) == min(abs(total - goal) for total in sums)
    monkeypatch.setattr(mixing, "_BITS", 500)
    monkeypatch.setattr(mixing, "_ITEMS", 20)
    sizes = rng.integers(1, 300, 2000).tolist()
    for goal in (10.0, 5_000.5, 250_000.0):
        assert abs(sum(sizes[at] for at in mixing.nearest(sizes, goal)) - goal) <= 2
    assert mixing.nearest([], 5.0) == mixing.nearest([0, 0], 5.0) == []


def test_mixing_with_thousands_of_sources(spark):
    rows = [(at, words(at, 1 + at % 7), f"s{at % 3000:04}") for at in range(6000)]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string, source string"), "many")
    found = mixing.draws(docs).collect()
    assert len(found) == 6000
    taken = sum(r["size"] * len(r.draws) for r in found)
    whole = sum(r["size"] for r in found)
    assert abs(taken - 1.5 * whole) < 0.1 * whole
    assert all(r["size"] * len(r.draws) <= 2 * r["size"] for r in found)


def check_packed(rows, limit):
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= limit
    return ends


def test_packing_against_the_tokenizer(docs, nothing):
    rows = packing.pack(packing.pieces(docs, with_ids=True)).collect()
    ends = check_packed(rows, packing.LIMIT)
    assert len(ends) == -(-sum(r.length for r in rows) // packing.LIMIT)
    tokenizer = _tokenizer(packing.TOKENIZER)
    for doc_id, text, *_ in ROWS:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        if doc_id in (3, None):
            continue
        own = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.piece)
        assert b"".join(bytes(r.ids) for r in own) == ids.tobytes()
        assert [r.ids_crc32 for r in own] == [zlib.crc32(bytes(r.ids)) for r in own]
    assert packing.pack(packing.pieces(nothing)).count() == 0


def test_fullest_is_the_best_sum():
    rng = np.random.default_rng(3)
    for _ in range(50):
        pool = rng.integers(1, 30, 8)
        counts = {int(v): int((pool == v).sum()) for v in set(pool)}
        chosen = packing.fullest(sorted(counts, reverse=True), counts, 60)
        sums = {sum(int(v) for i, v in enumerate(pool) if mask >> i & 1) for mask in range(256)}
        assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= 60)
        assert all(n <= counts[k] for k, n in chosen.items())


def test_token_store_round_trip(spark, docs, nothing, tmp_path):
    folder = str(tmp_path / "ids")
    shards = token_store.write_shards(docs, folder, shard_bytes=100_000)
    assert shards.count() > 1
    rows = token_store.read_back(shards, folder, "bigint").orderBy("start").collect()
    tokenizer, start = _tokenizer(token_store.TOKENIZER), 0
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9]
    texts = {i: t for i, t, *_ in ROWS}
    for r in rows:
        ids = np.array([*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    held = [token_store.Shard(f"file://{folder}", r.name) for r in shards.collect()]
    assert sum(shard.find(["3"])[1][0] for shard in held) == 2
    assert sum(shard.find(["777"])[1][0] for shard in held) == 0
    assert {shard.width for shard in held} == {2}
    wanted = spark.createDataFrame([(3,), (9,), (777,)], "doc_id long")
    found = token_store.fetch(shards, folder, wanted).collect()
    assert sorted(r.doc_id for r in found) == [3, 3, 9]
    for r in found:
        assert r.ids == [*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0]
    empty = str(tmp_path / "none")
    assert token_store.read_back(token_store.write_shards(nothing, empty), empty, "bigint").count() == 0


def test_token_store_spreads_rows_of_one_key(spark, tmp_path):
    rows = [(None, words(21, 20))] * 300 + [(5, words(22, 20))] * 300 + [(i, words(i, 20)) for i in range(6, 306)]
    found = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder = str(tmp_path / "hot")
    shards = token_store.write_shards(found, folder, shard_bytes=8_000)
    told = shards.collect()
    assert max(r.records for r in told) < 150
    held = [token_store.Shard(f"file://{folder}", r.name) for r in told]
    spread = token_store.fetch(shards, folder, spark.createDataFrame([(5,), (6,)], "doc_id long"))
    counts = dict(spread.groupBy("doc_id").count().collect())
    assert counts == {5: 300, 6: 1} and spread.select("shard").distinct().count() > 1
    many = [int(shard.find(["5"])[1][0]) for shard in held]
    assert sum(many) == 300 and sum(n > 0 for n in many) > 1
    assert sum(r.unkeyed for r in told) == 300
    back = token_store.read_back(shards, folder, "bigint").orderBy("start").collect()
    assert [r.doc_id for r in back] == [None] * 300 + [5] * 300 + list(range(6, 306))
    start = 0
    for r in back:
        assert r.start == start
        start += r.n_tokens


@pytest.mark.parametrize("name, end", [("byte_bpe_50k.json", 0), ("word_bpe_49k.json", 1)])
@pytest.mark.parametrize("part, batch", [(1 << 17, 1 << 19), (40, 300), (5, 10)])
def test_ids_are_those_of_the_plain_tokenizer(monkeypatch, name, end, part, batch):
    monkeypatch.setattr(tokens, "_PART", part)
    monkeypatch.setattr(tokens, "_BATCH", batch)
    monkeypatch.setattr(tokens, "_ONCE", 50)
    monkeypatch.setattr(tokens, "_AGAIN", 30)
    rng = np.random.default_rng(2)
    signs = [*"abcDE12 .,'\n\t éßİЖ中ñ\u0301<|>_s-", "<|endoftext|>", "<|startoftext|>", "  ", "'s", " 'LL",
             "\r\n", "\u00a0", " foo", "bar", "\U0001f642", " <|endoftext|> "]
    texts = [None, "", " ", "  a", "a<|endoftext|>b", "x <|endoftext|> y", "<|endoftext|>"]
    texts += ["".join(rng.choice(signs, n)) for n in rng.choice([1, 3, 10, 60, 400], 300)]
    plain = _tokenizer(name)
    for text, ids in zip(texts, tokens.token_ids(texts, name, end), strict=True):
        assert ids.tolist() == [*plain.encode(text or "", add_special_tokens=False).ids, end]


def test_perfect_hash_is_minimal():
    for n in (1, 2, 7, 5000):
        hashes, _ = token_store.key_hashes(range(n))
        assert sorted(token_store.slots_of(hashes, token_store.perfect_hash(hashes), n)) == list(range(n))


def spans_by_force(rows, length=50):
    seen, found = set(), {}
    for key, text in rows:
        tokens = (text or "").encode().split()
        starts = []
        for at in range(len(tokens) - length + 1):
            window = tuple(tokens[at : at + length])
            if window in seen:
                starts.append(at)
            seen.add(window)
        found[key] = suffix_dedup.merge_spans(starts, length)
    return found


def test_suffix_dedup(docs, nothing):
    rows = suffix_dedup.with_spans(docs.withColumn("spans", F.lit(1))).collect()
    assert len(rows) == len(ROWS)
    order = sorted({(i, t) for i, t, *_ in ROWS if i is not None}) + [(None, ROWS[6][1])]
    force = spans_by_force(order)
    for r in rows:
        assert [(s.start, s.end) for s in r.spans] == force[r.doc_id]
    left = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs).collect()}
    assert 3 not in left and PASSAGE in left[6] and PASSAGE not in left[7]
    assert left[7].split() == ROWS[8][1].split()[:25]
    assert suffix_dedup.with_spans(nothing).count() == 0


def test_suffix_dedup_keeps_one_of_rows_alike(spark):
    rows = [(None, words(11, 70))] * 9 + [(7, words(12, 70))] * 4 + [(8, words(13, 70))] + [(None, words(14, 20))] * 2
    found = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spans = suffix_dedup.with_spans(found).collect()
    assert len(spans) == len(rows)
    assert sorted((r.doc_id or 0, len(r.spans)) for r in spans) == sorted(
        [(0, 0)] * 3 + [(0, 1)] * 8 + [(7, 0)] + [(7, 1)] * 3 + [(8, 0)]
    )
    left = sorted(r.text for r in suffix_dedup.without_repeats(found).collect())
    assert left == sorted([rows[0][1], rows[9][1], rows[13][1], rows[14][1], rows[14][1]])


def test_suffix_dedup_against_brute_force(spark):
    found = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = sorted((r.doc_id, r.text) for r in found.select("doc_id", "text").collect())
    force = spans_by_force(texts)
    rows = suffix_dedup.with_spans(found).collect()
    assert any(force.values())
    assert {r.doc_id: [(s.start, s.end) for s in r.spans] for r in rows} == force


def test_simhash_components_against_brute_force(spark, docs, nothing):
    found = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(docs)
    for bound in (simhash.BUCKET_BOUND, 1):
        rows = simhash.near_duplicates(simhash.fingerprints(found), bucket_bound=bound).collect()
        prints = sorted({r.fp for r in rows})
        label = {fp: fp for fp in prints}
        changed = True
        while changed:
            changed = False
            for a in prints:
                for b in prints:
                    if label[a] < label[b] and ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                        label[b], changed = label[a], True
        first = {}
        for r in rows:
            if r.doc_id is not None:
                first[label[r.fp]] = min(first.get(label[r.fp], r.doc_id), r.doc_id)
        assert all(r.component_id == first.get(label[r.fp]) for r in rows)
    assert simhash.near_duplicates(simhash.fingerprints(nothing)).count() == 0


def test_masked_lm(spark, docs, nothing):
    rows = masked_lm.score(docs, masked_lm.train(docs)).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        text = next(t for i, t, *_ in ROWS if i == r.doc_id)
        assert r.n_tokens == len((text or "").split())
        assert (r.mean_log_likelihood is None) == (r.n_tokens == 0)
        assert r.log_likelihood <= 0
    assert masked_lm.score(nothing, masked_lm.train(nothing)).count() == 0


def test_masked_lm_prefers_word_order(spark):
    rng = np.random.default_rng(5)

    def text(n):
        start = int(rng.integers(40))
        return " ".join(f"w{i % 40}" for i in range(start, start + n))

    rows = [(i, text(60)) for i in range(600)]
    found = written(spark.createDataFrame(rows, "doc_id long, text string"), "lm")
    model = masked_lm.train(found)
    shuffled = [(i, " ".join(rng.permutation(t.split()))) for i, t in rows[:50]]
    mean = lambda df: masked_lm.score(df, model).agg(F.avg("mean_log_likelihood")).first()[0]
    assert mean(found) > mean(spark.createDataFrame(shuffled, "doc_id long, text string")) + 0.5


def test_masked_lm_learns_from_every_text(spark):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{k % 40}" for k in range(i % 40, i % 40 + 40 + i // 40))) for i in range(2400)]
    whole = spark.createDataFrame(rows, "doc_id long, text string")
    for share in (3, 9, 15):
        found = written(whole.where(F.pmod(F.xxhash64("text"), F.lit(16)) == share), "lm-share")
        model = masked_lm.train(found)
        shuffled = [(r.doc_id, " ".join(rng.permutation(r.text.split()))) for r in found.limit(50).collect()]
        mean = lambda df: masked_lm.score(df, model).agg(F.avg("mean_log_likelihood")).first()[0]
        assert mean(found) > mean(spark.createDataFrame(shuffled, "doc_id long, text string")) + 0.5


def test_masked_lm_scores_words_by_their_own_counts(spark):
    rng = np.random.default_rng(9)
    drawn = (1000 * rng.random((400, 50)) ** 2).astype(int)
    rows = [(i, " ".join(f"w{k}" for k in row)) for i, row in enumerate(drawn)]
    model = masked_lm.train(written(spark.createDataFrame(rows, "doc_id long, text string"), "lm-counts"))
    seen, counts = np.unique(drawn, return_counts=True)
    texts = [(int(k), f"w{k}") for k in seen] + [(1000 + k, f"never{k}") for k in range(1000)]
    texts += [(None, "never0 w999 w999"), (None, "never0 w999 w999")]
    found = masked_lm.score(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    assert len(found) == len(texts)
    repeated = {r.log_likelihood for r in found if r.doc_id is None}
    assert max(repeated) - min(repeated) < 1e-9
    lone = {r.doc_id: r.log_likelihood for r in found if r.doc_id is not None}
    assert 0.95 < sum(np.exp(lone[k]) for k in seen) < 1
    names = [text.encode() for _, text in texts[:-2]]
    kinds = masked_lm.classes(masked_lm._hashes(names), model.common)
    n = dict(zip(seen.tolist(), counts.tolist()))
    first = {}
    for (at, _), kind in zip(texts, kinds):
        if kind >= masked_lm.COMMON:
            other = first.setdefault(kind, at)
            expected = np.log((n.get(at, 0) + 1) / (n.get(other, 0) + 1))
            assert abs(lone[at] - lone[other] - expected) < 1e-4
    assert len(first) > 200


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(1)
    points = np.round(rng.normal(size=(3000, 8)), 1)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    odd = [(50, None), (None, points[0].tolist()), (3001, [None] * 8), (3002, [float("nan")] * 8),
           (3003, [float("inf")] * 8), (3100, [1.0, 2.0]), (100, points[100].tolist())]
    found = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = top_k.top_k(found, shard_rows=500, block_rows=20).collect()
    whole = np.floor(256 * np.vstack([points, points[100]]))
    ids = np.array([*range(3000), 100])
    expected = []
    for at in np.flatnonzero(ids % 50 == 0):
        scores = whole @ whole[at]
        scores[at] = -np.inf
        best = np.lexsort((ids, -scores))[:5]
        expected += [(ids[at], k + 1, ids[b], scores[b]) for k, b in enumerate(best)]
    assert sorted(tuple(r) for r in got) == sorted(expected)
    assert top_k.top_k(found.limit(0)).count() == 0


def test_url_filter(spark):
    day = lambda d: f"2024-01-{d:02d}"
    entries = spark.createDataFrame(
        [("bad.org", day(5), True), ("bad.org", day(10), False), ("bad.org", day(20), True),
         ("x.bad.org", day(1), True), (None, day(1), True), ("ok.org", None, True)],
        "domain string, d string, listed boolean",
    ).selectExpr("domain", "cast(d as date) as day", "listed")
    captures = spark.createDataFrame(
        [(1, "http://a.bad.org/x", day(4)), (2, "http://a.bad.org/x", day(5)), (3, "https://BAD.org:80/", day(10)),
         (4, "http://u@bad.org", day(25)), (5, "http://x.bad.org/", day(12)), (6, None, day(6)), (7, "", day(6)),
         (8, "http://bad.org", None), (9, "http://ok.org", day(9)), (2, "http://a.bad.org/x", day(5)),
         (10, "http://notbad.org", day(6))],
        "page_id int, url string, d string",
    ).selectExpr("page_id", "url", "cast(d as date) as fetch_day", "'mine' as host")
    rows = url_filter.judge(captures, entries).collect()
    assert len(rows) == 11
    assert sorted(r.page_id for r in rows if r.blocked) == [2, 2, 4, 5]
    assert next(r for r in rows if r.page_id == 5).listed_domain == "x.bad.org"
    assert url_filter.judge(captures, entries.limit(0)).where("blocked").count() == 0
    assert url_filter.judge(captures.limit(0), entries).count() == 0


def test_quality_ledger(docs, nothing):
    clash = docs.withColumn("n_words", F.lit("x"))
    judged = quality_ledger.apply_policy(quality_ledger.ledger(quality_ledger.measure(clash)))
    assert judged.count() == len(ROWS)
    assert not any(r.kept for r in judged.where("text is null or text = ''").collect())
    rules = quality_ledger.ablations(judged).collect()
    assert all(r.only_this_rule <= r.failing for r in rules)
    assert quality_ledger.measure(nothing).count() == 0


def test_pipeline_stages(spark, docs, nothing):
    for start in (docs, nothing):
        found = start
        for name, stage in corpus_pipeline.STAGES:
            found = written(stage(spark, found, ""), f"test-{name}")
            if name != "pack":
                assert found.columns == docs.columns
            if name == "language" and start is docs:
                assert {r.doc_id for r in found.collect()} == {1, 2, 3, None, 6, 7, 8}
            if name == "near_duplicates" and start is docs:
                assert sorted(str(r.doc_id) for r in found.collect()) == ["1", "2", "6", "7", "8", "None"]
        if start is docs:
            check_packed(found.collect(), packing.LIMIT)
        else:
            assert found.count() == 0


def test_pipeline_keeps_further_columns(spark, docs):
    names = ("size", "target", "source_size", "draws", "shard", "score", "lang_pred", "n_words",
             "spans", "rows", "kept_id", "component", "key", "rest", "_judged", "_text", "text_hash")
    found = docs
    for name in names:
        found = found.withColumn(name, F.concat(F.lit(f"{name} of "), F.coalesce(F.col("doc_id"), F.lit(-1))))
    found = found.select("rest", *[c for c in found.columns if c != "rest"])
    columns = found.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = written(stage(spark, found, ""), f"test-columns-{name}")
        assert found.columns == columns
        for row in found.collect():
            number = -1 if row.doc_id is None else row.doc_id
            assert [row[n] for n in names] == [f"{n} of {number}" for n in names]
    packed = corpus_pipeline.stage_pack(spark, found, "").collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in found.collect()}
    kept = language_id.keep_known(docs.withColumn("score", F.lit("mine")), language_id.train(docs))
    assert {r.score for r in kept.collect()} == {"mine"}
