"""How far the sources of a language differ in their words, from one pass over the texts.

The pass indexes in memory: a task collects postings (term, source, occurrences, documents)
in a block until ``BLOCK_POSTINGS`` are held, then spills the block as a run that is sorted by
term and cut into hash shards. Every shard merges its runs over a heap into frequencies, a
bounded number of postings at a time, and keeps the terms of at least ``MIN_DOCS`` documents.

A group's share of a term, in parts per billion and smoothed, is ``p``; the divergence of two
shares is ``floor((p - q)**2 / q)``. Sums over all kept terms start from what two groups
without any occurrence would give. What a term adds on one side alone depends on its count
only, so it is taken from each group's table of shares. Terms that both groups hold get a
correction, streamed term by term; pairs are added up within a block before they leave it.

NULL text, language and source count as ''. Texts without terms still make their group occur.
Repeated rows count as documents of their own. A language without kept terms has pairs of
value 0 and no terms; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat
from operator import ne
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import table, written

MIN_DOCS = 3
TOP_TERMS = 200
BLOCK_POSTINGS = 600_000
# Pairs of postings compared at a time; bytes of text split at a time.
_PAIRS = 1 << 20
_TEXT = 1 << 22
# Terms of a group are ranked in so many parts first.
_PARTS = 64
# Rows a merge returns at a time.
_ROWS = 1 << 16

# Terms consist of the letters A to Z, lower-cased, and all that is not ASCII.
_LETTERS = bytearray(b" " * 128 + bytes(range(128, 256)))
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = bytes(range(0x61, 0x7B))
_LETTERS = bytes(_LETTERS)

_RUN = (
    "shard int, lang string, names array<string>, terms string, per_term array<int>,"
    " source array<int>, n array<long>, docs array<long>"
)
_FREQUENCY = "lang string, term string, first boolean, total long, source string, n long"


def _terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, a few megabytes of it at a time."""
    data = text.encode("utf-8", "replace").translate(_LETTERS)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + _TEXT)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


class _Block:
    """Postings in memory: per group the occurrences of each term and the documents with it.

    ``held`` counts the entries of both.
    """

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.held = 0

    def add(self, lang: str, source: str, terms: list[bytes]) -> None:
        counts, _ = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before = len(counts)
        counts.update(terms)
        self.held += len(counts) - before

    def add_document(self, lang: str, source: str, distinct: set[bytes]) -> None:
        counts, docs = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before = len(docs)
        docs.update(distinct)
        self.held += len(docs) - before

    def run(self, shards: int) -> pa.RecordBatch:
        """The block as one row per shard and language, whose terms are sorted.

        A row lists the postings of its terms one after another, ``per_term`` of each.
        """
        by_lang: dict[str, list] = {}
        for (lang, source), held in self.groups.items():
            by_lang.setdefault(lang, []).append((source, *held))
        batches = []
        for lang, groups in by_lang.items():
            names, terms, n, docs, whose = [], [], [], [], []
            for source, counts, with_term in groups:
                for term in with_term.keys() - counts.keys():
                    counts[term] = 0
                terms.extend(counts)
                n.append(np.fromiter(counts.values(), np.int64, len(counts)))
                found = map(with_term.__getitem__, counts)
                docs.append(np.fromiter(found, np.int64, len(counts)))
                whose.append(np.full(len(counts), len(names), np.int32))
                names.append(source)
            if not terms:
                continue
            coded = pa.array(terms, pa.binary()).dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            code = np.asarray(coded.indices)
            shard = np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct)) % shards
            place = np.empty(len(distinct), np.int64)
            place[sorted(range(len(distinct)), key=distinct.__getitem__)] = np.arange(len(distinct))
            order = np.lexsort((place[code], shard[code]))
            code, whose = code[order], np.concatenate(whose)[order]
            n, docs = np.concatenate(n)[order], np.concatenate(docs)[order]
            begins = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            many = np.diff(np.append(begins, len(code))).astype(np.int32)
            shard = shard[code[begins]]
            edges = np.append(np.flatnonzero(np.append(True, np.diff(shard) != 0)), len(begins))
            sorted_terms = [distinct[at] for at in code[begins]]
            joined = [b" ".join(sorted_terms[at:to]) for at, to in zip(edges, edges[1:])]
            cuts = np.append(begins, len(code))[edges].astype(np.int32)
            rows = len(joined)
            batches.append(pa.RecordBatch.from_arrays(
                [
                    pa.array(shard[edges[:-1]], pa.int32()),
                    pa.array([lang] * rows, pa.string()),
                    pa.array([names] * rows, pa.list_(pa.string())),
                    pa.array(joined, pa.binary()).cast(pa.string()),
                    pa.ListArray.from_arrays(edges.astype(np.int32), pa.array(many)),
                    *(pa.ListArray.from_arrays(cuts, pa.array(v)) for v in (whose, n, docs)),
                ],
                ["shard", "lang", "names", "terms", "per_term", "source", "n", "docs"],
            ))
        return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def runs(texts: DataFrame, shards: int, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Term-sorted runs of ``lang``, ``source``, ``text``: a row per run, shard and language.

    Terms hold no space, so a row joins them by spaces.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            for lang, source, text in zip(*batch.columns):
                lang, source, distinct = lang.as_py(), source.as_py(), set()
                for terms in _terms(text.as_py()):
                    block.add(lang, source, terms)
                    distinct.update(terms)
                    if block.held >= block_postings:
                        yield block.run(shards)
                        block = _Block()
                block.add_document(lang, source, distinct)
        if block.held:
            yield block.run(shards)

    return texts.select("lang", "source", "text").mapInArrow(index, _RUN)


class _Segment(NamedTuple):
    """Sorted terms, and the postings of each one after another: source, n, docs."""

    terms: list[str]
    per_term: np.ndarray
    source: np.ndarray
    n: np.ndarray
    docs: np.ndarray


def merged(segments: list[_Segment]) -> _Segment:
    """Segments merged over a heap of their terms; postings of a term and source added up."""
    if len(segments) == 1:
        return segments[0]
    heads = (zip(s.terms, repeat(at), range(len(s.terms))) for at, s in enumerate(segments))
    keys, which, at = zip(*heapq.merge(*heads))
    starts = np.cumsum([0, *(len(s.terms) for s in segments[:-1])])
    entry = starts[np.array(which)] + np.array(at)
    begins = np.fromiter(chain([True], map(ne, keys[1:], keys)), bool, len(keys))
    per_term = np.concatenate([s.per_term for s in segments]).astype(np.int64)
    first, many = (np.cumsum(per_term) - per_term)[entry], per_term[entry]
    places = np.arange(int(many.sum())) + np.repeat(first - (np.cumsum(many) - many), many)
    term = np.repeat(np.cumsum(begins) - 1, many)
    source, n, docs = (
        np.concatenate(column)[places] for column in list(zip(*segments))[2:]
    )
    order = np.lexsort((source, term))
    term, source = term[order], source[order]
    edge = np.flatnonzero(
        np.append(True, (term[1:] != term[:-1]) | (source[1:] != source[:-1]))
    )
    return _Segment(
        [keys[at] for at in np.flatnonzero(begins)],
        np.bincount(term[edge], minlength=int(begins.sum())),
        source[edge],
        np.add.reduceat(n[order], edge),
        np.add.reduceat(docs[order], edge),
    )


def frequencies(
    texts: DataFrame,
    shards: int,
    min_docs: int = MIN_DOCS,
    block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """One row per kept term of a language and source that holds it.

    ``n`` are its occurrences there and ``total`` those in the language; ``first`` is true in
    one row of each term.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        segments: dict[str, list[_Segment]] = {}
        waiting, bound = 0, block_postings
        for batch in batches:
            for row in range(batch.num_rows):
                lang, own, terms, *columns = (
                    batch.column(name)[row]
                    for name in ("lang", "names", "terms", "per_term", "source", "n", "docs")
                )
                codes = np.array([names.setdefault(name, len(names)) for name in own.as_py()])
                per_term, source, n, docs = (column.values.to_numpy() for column in columns)
                held = _Segment(terms.as_py().split(" "), per_term, codes[source], n, docs)
                segments.setdefault(lang.as_py(), []).append(held)
                waiting += len(n)
            if waiting > bound:
                # What is merged shrinks to one posting per term and source; the bound
                # follows it, so that merging again costs no more than reading did.
                segments = {lang: [merged(held)] for lang, held in segments.items()}
                waiting = sum(len(held[0].n) for held in segments.values())
                bound = max(block_postings, 2 * waiting)
        for lang, held in segments.items():
            for part in frequency_rows(lang, merged(held), pa.array(names, pa.string())):
                yield part

    def frequency_rows(lang: str, held: _Segment, names: pa.Array) -> Iterator[pa.RecordBatch]:
        begins = np.cumsum(held.per_term) - held.per_term
        keep = np.add.reduceat(held.docs, begins) >= min_docs
        total = np.add.reduceat(held.n, begins)
        term = np.repeat(np.arange(len(begins)), held.per_term)
        rows = np.flatnonzero(keep[term] & (held.n > 0))
        term = term[rows]
        first = np.append(True, term[1:] != term[:-1])[: len(term)]
        terms = pa.array(held.terms, pa.string())
        for at in range(0, len(rows), _ROWS):
            part = slice(at, at + _ROWS)
            size = len(rows[part])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()),
                    terms.take(pa.array(term[part])),
                    pa.array(first[part]),
                    pa.array(total[term[part]]),
                    names.take(pa.array(held.source[rows[part]])),
                    pa.array(held.n[rows[part]]),
                ],
                ["lang", "term", "first", "total", "source", "n"],
            )

    spilled = runs(texts, shards, block_postings)
    return spilled.repartition(shards, "shard").mapInArrow(merge, _FREQUENCY)


def share(count: Column | str, size: Column | str) -> Column:
    """Smoothed share in parts per billion; exact, as the product is a decimal."""
    return F.expr(
        f"1 + cast(cast(1000000000 as decimal(10,0)) * cast({count} + 1 as decimal(20,0))"
        f" div cast({size} as decimal(20,0)) as bigint)"
    )


def _apart(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def pair_changes(rows: pa.Table, bound: int = _PAIRS) -> Iterator[pa.RecordBatch]:
    """Corrections from all postings of some whole terms, at most ``bound`` pairs at a time."""
    p, zero = (rows[name].to_numpy() for name in ("p", "zero"))
    names = [rows[name].combine_chunks().dictionary_encode() for name in ("lang", "source")]
    lang, source = (np.asarray(name.indices) for name in names)
    first = np.flatnonzero(_starts(rows))
    size = np.diff(np.append(first, len(p)))
    begin, many = np.repeat(first, size), np.repeat(size, size)
    done = 0
    while done < len(p):
        to = max(done + 1, int(np.searchsorted(np.cumsum(many[done:]), bound, "right")) + done)
        left = np.repeat(np.arange(done, to), many[done:to])
        offset = np.cumsum(many[done:to]) - many[done:to]
        right = np.arange(len(left)) - np.repeat(offset, many[done:to]) + begin[left]
        done = to
        other = left != right
        left, right = left[other], right[other]
        if not len(left):
            continue

        def apart(a, b):
            return (a - b) * (a - b) // b

        change = (
            apart(p[left], p[right]) - apart(p[left], zero[right])
            - apart(zero[left], p[right]) + apart(zero[left], zero[right])
        )
        many_sources = len(names[1].dictionary)
        code = (lang[left].astype(np.int64) * many_sources + source[left]) * many_sources
        code += source[right]
        order = np.argsort(code, kind="stable")
        code, change = code[order], change[order]
        edge = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        sums, code = np.add.reduceat(change, edge), code[edge]
        yield pa.RecordBatch.from_arrays(
            [
                names[0].dictionary.take(pa.array(code // many_sources // many_sources)),
                names[1].dictionary.take(pa.array(code // many_sources % many_sources)),
                names[1].dictionary.take(pa.array(code % many_sources)),
                pa.array(sums),
            ],
            ["lang", "source", "item", "value"],
        )


def _corrections(held: DataFrame) -> DataFrame:
    """What terms in both groups of a pair change: ``lang``, ``source``, ``item``, ``value``.

    ``held`` has one row per term and source with its share ``p`` and ``zero``, the share of
    a term that the source lacks. Terms come one after another within a task.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last term of a batch may go on in the next one.
            cut = int(np.flatnonzero(_starts(pa.Table.from_batches([batch])))[-1])
            if waiting and (cut or not _same(waiting[0], batch)):
                begins = _starts(pa.Table.from_batches([batch]))
                goes_on = _same(waiting[0], batch)
                head = int(np.flatnonzero(begins[1:])[0]) + 1 if goes_on and cut else 0
                yield from pair_changes(pa.Table.from_batches([*waiting, batch.slice(0, head)]))
                waiting = []
                if cut > head:
                    yield from pair_changes(pa.Table.from_batches([batch.slice(head, cut - head)]))
            elif not waiting and cut:
                yield from pair_changes(pa.Table.from_batches([batch.slice(0, cut)]))
            waiting.append(batch.slice(cut))
        if waiting:
            yield from pair_changes(pa.Table.from_batches(waiting))

    ordered = held.select("lang", "term", "source", "p", "zero").repartition("lang", "term")
    found = ordered.sortWithinPartitions("lang", "term").mapInArrow(
        stream, "lang string, source string, item string, value long"
    )
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _starts(rows: pa.Table) -> np.ndarray:
    """Where another term begins."""
    begins = np.ones(rows.num_rows, bool)
    for name in ("lang", "term"):
        code = np.asarray(rows[name].combine_chunks().dictionary_encode().indices)
        begins[1:] &= code[1:] == code[:-1]
    begins[1:] = ~begins[1:]
    return begins


def _same(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
    return all(a.column(name)[-1] == b.column(name)[0] for name in ("lang", "term"))


def divergence(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """Parts ``pair`` and ``term`` of every language and source, ranked by value."""
    texts = docs.select(
        *(F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in ("lang", "source", "text"))
    )
    # Counted without reading a column: as many shards as the input has parts.
    parts = docs.select(F.spark_partition_id().alias("part")).distinct().count()
    kept = written(
        frequencies(texts, max(16, parts), min_docs, block_postings), "term-frequencies"
    )
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("lang_n"))
    groups = written(
        texts.select("lang", "source").distinct()
        .join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
        .na.fill(0, ["n", "v", "lang_n"])
        # Without kept terms nothing is looked up in these shares.
        .select("lang", "source", "v", (F.col("n") + F.col("v")).alias("size"),
                (F.col("lang_n") + F.col("v")).alias("lang_size"))
        .withColumn("zero", F.when(F.col("v") > 0, share("0", "size"))),
        "source-groups",
    )
    held = kept.join(groups, ["lang", "source"]).withColumn("p", share("n", "size"))

    pair = ["lang", "source", "item"]
    by_share = held.groupBy("lang", "source", "zero", "p").agg(F.count("*").alias("terms"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("far"))
    # One row per pair, the size of the result.
    alike = groups.join(others, "lang").where("source <> item").select(
        *pair, F.coalesce(F.expr(f"v * {_apart('zero', 'far')}"), F.lit(0)).alias("value")
    )
    sides = (
        by_share.join(others, "lang").where("source <> item").groupBy(*pair)
        .agg(
            F.sum(F.expr(f"terms * ({_apart('p', 'far')} - {_apart('zero', 'far')})")).alias("own"),
            F.sum(F.expr(f"terms * ({_apart('far', 'p')} - {_apart('far', 'zero')})")).alias("other"),
        )
    )
    sides = written(sides, "divergence-sides")
    values = (
        alike.unionByName(sides.select(*pair, F.col("own").alias("value")))
        .unionByName(sides.selectExpr("lang", "item as source", "source as item", "other as value"))
        .unionByName(_corrections(held))
        .groupBy(*pair).agg(F.sum("value").alias("value"))
    )
    order = [F.col("value").desc(), F.col("item")]
    group = Window.partitionBy("lang", "source")
    pairs = values.withColumn("rank", F.row_number().over(group.orderBy(*order)))

    # The language's own share is never zero, as its kept terms occur in it.
    heavier = held.withColumn("q", share("total", "lang_size")).where("p > q").select(
        "lang", "source", F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value")
    )
    # Ranked in parts first, so that a group sends a bounded number of terms to one task. The
    # rows of a task share a part, of which Spark passes on no more than the ranks asked for.
    part = F.pmod(F.spark_partition_id(), F.lit(_PARTS))
    best = heavier.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(*order))
    ).where(F.col("rank") <= top_terms)
    terms = best.withColumn("rank", F.row_number().over(group.orderBy(*order))).where(
        F.col("rank") <= top_terms
    )

    def labelled(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return labelled(pairs, "pair").unionByName(labelled(terms, "term"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP13_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), occurring AS (
    SELECT r, lang, source,
           unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
), counted AS (
    SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs
    FROM occurring GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(n) AS total FROM counted
    GROUP BY lang, term HAVING sum(docs) >= {MIN_DOCS}
), langs AS (
    SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), sizes AS (
    SELECT lang, source, sum(n) AS n FROM counted JOIN kept USING (lang, term)
    GROUP BY lang, source
), shares AS (
    SELECT lang, source, term, coalesce(c.n, 0) AS n,
           1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)
               // (coalesce(s.n, 0) + l.v) AS p,
           1 + CAST(1000000000 AS HUGEINT) * (k.total + 1) // (l.n + l.v) AS q
    FROM groups JOIN kept k USING (lang) JOIN langs l USING (lang)
         LEFT JOIN sizes s USING (lang, source) LEFT JOIN counted c USING (lang, source, term)
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part
                               ORDER BY value DESC, item) AS INT) AS rank
FROM parts QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
