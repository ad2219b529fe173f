"""Near-duplicates by the overlap of their word shingles, found with SuperMinHash signatures.

A text stands for the set of its distinct ``SHINGLE``-word runs. Every shingle draws a random
order of the signature's places; the ``j``-th place it draws may take the value ``j`` plus a
fraction, and each place keeps the least value offered. The orders make a place's value
depend on the others', which lowers the variance of the share of equal places. Layer after
layer is drawn for all shingles of a text at once, until every place is filled: no later
layer can offer less, so large texts stop after one or two.

Bands of the signature are buckets. Buckets hold *distinct* sets, so copies count once. Sets
are compared by the intersection and union of their full sets; a link needs
``100 * intersection >= 85 * union``, and links are merged by union-find. In each bucket one
member is compared with all others. Where that leaves several components, the members
outside of the largest one are compared with all members of other components: pair by pair
if there are few, in blocks of sets by a product of matrices if there are many. So every two
sets that share a bucket and are similar enough are connected, without listing the pairs of
a bucket.

Two sets of exactly the least similarity share no bucket with a chance of about 3 in 10
million; the more similar, the less. Shingles are compared by 64-bit hashes.

Texts with fewer words than a shingle are one shingle. NULL texts and texts without words
have an empty set and are linked with nothing: each is a component of its own. Rows without
an id take part and never name a component; its id is NULL if none of its rows has one.
Repeated rows fall into the same component, and all rows of the smallest id are kept. Empty
tables give no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import table, written
from cardwarden.llm.simhash import components
from cardwarden.llm.words import word_blocks

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 32, 6
# Shingles drawn for at a time.
_STEP = 1 << 18
# So many members outside of a bucket's largest component are compared pair by pair.
FEW = 8
# Sets of a block, shingles of all its sets, and shingles of a product of matrices.
_BLOCK = 512
_BLOCK_SHINGLES = 1 << 20
_COLUMNS = 4096


def _mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit mixing of each value."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles of a text, ascending."""
    found = []
    data = (text or "").encode("utf-8", "replace").lower()
    for words in word_blocks(data):
        found.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
    words = np.concatenate(found) if found else np.zeros(0, np.uint64)
    if not len(words):
        return words
    wide = min(size, len(words))
    many = len(words) - wide + 1
    with np.errstate(over="ignore"):
        runs = np.full(many, wide, np.uint64)
        for at in range(wide):
            runs = _mixed(runs * np.uint64(0x9E3779B97F4A7C15) + words[at : at + many])
    return np.unique(runs)


def _offer(signatures: np.ndarray, shingles: np.ndarray, whose: np.ndarray) -> None:
    """Let shingles draw places in the signatures of the texts they belong to."""
    size = signatures.shape[1]
    flat = signatures.reshape(-1)
    drawn: list[np.ndarray] = []
    for layer in range(size):
        with np.errstate(over="ignore"):
            bits = _mixed(shingles + np.uint64(0x9E3779B97F4A7C15 * (layer + 1) & (1 << 64) - 1))
        # A place among those not drawn yet, as by swapping it to the front.
        pick = layer + ((bits >> np.uint64(32)) * np.uint64(size - layer) >> np.uint64(32)).astype(
            np.int64
        )
        place = pick
        for before in reversed(range(layer)):
            place = np.where(drawn[before] == place, before, place)
        drawn.append(pick)
        offered = np.uint64(layer << 32) | (bits & np.uint64(0xFFFFFFFF))
        np.minimum.at(flat, whose * size + place, offered)
        open_still = (signatures >= np.uint64((layer + 1) << 32)).any(axis=1)[whose]
        if not open_still.any():
            return
        if not open_still.all():
            shingles, whose = shingles[open_still], whose[open_still]
            drawn = [picked[open_still] for picked in drawn]


def signatures(sets: list[np.ndarray], size: int = BANDS * ROWS) -> np.ndarray:
    """One row of ``size`` values per set; places of an empty set stay at the largest value."""
    found = np.full((len(sets), size), np.iinfo(np.uint64).max, np.uint64)
    shingles = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    whose = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for at in range(0, len(shingles), _STEP):
        _offer(found, shingles[at : at + _STEP], whose[at : at + _STEP])
    return found


def band_keys(found: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of each signature; keys of different bands differ."""
    bands = found.shape[1] // rows
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(found), bands))
    with np.errstate(over="ignore"):
        for at in range(rows):
            keys = _mixed(keys * np.uint64(0xD6E8FEB86659FD93) + found[:, at::rows][:, :bands])
    return keys


def _text_key():
    return F.unhex(F.md5(F.col("text").cast("string").cast("binary")))


def prints(
    docs: DataFrame, id_column: str = "doc_id", shingle: int = SHINGLE, bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Per row: id, key of the text, size ``n`` of its set, two sums over it, band keys."""
    kind = docs.schema[id_column].dataType.simpleString()

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            start, held, sets = 0, 0, []
            for at, text in enumerate(frame["text"], start=1):
                sets.append(shingle_set(text, shingle))
                held += len(sets[-1])
                if held >= _STEP or at == len(frame):
                    yield batch(frame.iloc[start:at], sets)
                    start, held, sets = at, 0, []

    def batch(frame: pd.DataFrame, sets: list[np.ndarray]) -> pd.DataFrame:
        keys = band_keys(signatures(sets, bands * rows), rows).view(np.int64)
        with np.errstate(over="ignore"):
            sums = [_mixed(s).sum(dtype=np.uint64) for s in sets]
            more = [_mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets]
        return pd.DataFrame({
            "id": frame["id"], "text_key": frame["text_key"], "n": [len(s) for s in sets],
            "sum_a": np.array(sums, np.uint64).view(np.int64),
            "sum_b": np.array(more, np.uint64).view(np.int64),
            "bands": list(keys),
        })

    return docs.select(
        F.col(f"`{id_column}`").alias("id"), _text_key().alias("text_key"),
        F.col("text").cast("string").alias("text"),
    ).mapInPandas(
        read, f"id {kind}, text_key binary, n long, sum_a long, sum_b long, bands array<long>"
    )


def full_sets(docs: DataFrame, wanted: DataFrame, id_column: str, shingle: int) -> DataFrame:
    """``rep`` and the full ``set`` of the wanted texts, given by ``rep``, ``id``, ``text_key``.

    A task reads a text once, however often its row repeats, and of what several tasks read
    one row is left.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = set()
        for frame in frames:
            frame = frame.drop_duplicates("rep")
            frame = frame[~frame["rep"].isin(last)]
            last = last | set(frame["rep"]) if len(last) < _STEP else set(frame["rep"])
            for at in range(0, len(frame), 256):
                part = frame.iloc[at : at + 256]
                sets = [shingle_set(text, shingle).view(np.int64) for text in part["text"]]
                yield pd.DataFrame({"rep": part["rep"], "set": sets})

    texts = docs.select(
        F.col(f"`{id_column}`").alias("id"), _text_key().alias("text_key"),
        F.col("text").cast("string").alias("text"),
    )
    # The list grows with the texts, so it is not to be broadcast while it is still short.
    asked = wanted.select("rep", F.col("id").alias("wanted_id"), "text_key").hint("merge")
    held = texts.join(asked, "text_key").where(F.col("id").eqNullSafe(F.col("wanted_id")))
    sets = held.select("rep", "text").mapInPandas(read, "rep long, set array<long>")
    return sets.groupBy("rep").agg(F.any_value("set").alias("set"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets are similar enough."""
    of_a = sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a"))
    of_b = sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    compared = pairs.join(of_a, "a").join(of_b, "b").select(
        "a", "b", both.alias("both"), (F.size("set_a") + F.size("set_b") - both).alias("either")
    )
    return compared.where(100 * F.col("both") >= percent * F.col("either")).select("a", "b")


def _mixed_buckets(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of the buckets that hold more than one component, with figures of the bucket.

    ``largest`` is the component with the most members, ``others`` the number of members
    outside of it, ``shingles`` the sum of the sizes of all sets.
    """
    members = buckets.withColumn("label", F.col("rep"))
    if labels is not None:
        known = labels.select(F.col("v").alias("rep"), F.col("label").alias("known"))
        members = buckets.join(known, "rep", "left").select(
            *buckets.columns, F.coalesce("known", "rep").alias("label")
        )
    held = members.groupBy("bucket", "label").agg(
        F.count("*").alias("rows"), F.sum("n").alias("shingles")
    )
    mixed = (
        held.groupBy("bucket")
        .agg(
            F.max(F.struct("rows", "label")).alias("most"), F.count("*").alias("labels"),
            F.sum("rows").alias("members"), F.sum("shingles").alias("shingles"),
        )
        .where("labels > 1")
        .select(
            "bucket", "members", "shingles", F.col("most.label").alias("largest"),
            (F.col("members") - F.col("most.rows")).alias("others"),
        )
    )
    return members.join(mixed, "bucket")


def _against(members: DataFrame, anchors: DataFrame, percent: int) -> DataFrame:
    """Pairs of anchors and members of other components in their buckets, if sizes allow."""
    chosen = anchors.select(
        "bucket", F.col("rep").alias("anchor"), F.col("n").alias("size"),
        F.col("label").alias("anchor_label"),
    )
    alike = 100 * F.least("n", "size") >= percent * F.greatest("n", "size")
    return (
        members.join(chosen, "bucket").where((F.col("label") != F.col("anchor_label")) & alike)
        .select(F.least("rep", "anchor").alias("a"), F.greatest("rep", "anchor").alias("b"))
        .distinct()
    )


def compare_blocks(one: pd.DataFrame, two: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links that join the components of two blocks of sets, by ``rep``, ``label`` and ``set``.

    All intersections are one product of incidence matrices, some shingles at a time. Of the
    links found only those are returned that merge what was apart.
    """
    reps = [frame["rep"].to_numpy() for frame in (one, two)]
    owners = [np.repeat(np.arange(len(f)), f["set"].map(len)) for f in (one, two)]
    flat = [np.concatenate(list(frame["set"])) for frame in (one, two)]
    sizes = [np.bincount(owner, minlength=len(rep)) for owner, rep in zip(owners, reps)]
    common = np.intersect1d(*flat)
    places = [np.searchsorted(common, values) for values in flat]
    shared = [
        (at < len(common)) & (common[np.minimum(at, len(common) - 1)] == values)
        if len(common) else np.zeros(len(values), bool)
        for at, values in zip(places, flat)
    ]
    both = np.zeros((len(reps[0]), len(reps[1])), np.float32)
    for low in range(0, len(common), _COLUMNS):
        parts = []
        for at, held, owner, rep in zip(places, shared, owners, reps):
            chosen = held & (at >= low) & (at < low + _COLUMNS)
            part = np.zeros((len(rep), _COLUMNS), np.float32)
            part[owner[chosen], at[chosen] - low] = 1
            parts.append(part)
        both += parts[0] @ parts[1].T
    either = sizes[0][:, None] + sizes[1][None, :] - both
    labels = [frame["label"].to_numpy() for frame in (one, two)]
    linked = (100 * both >= percent * either) & (labels[0][:, None] != labels[1][None, :])
    root: dict[int, int] = {}

    def find(label: int) -> int:
        while (above := root.get(label, label)) != label:
            root[label] = label = root.get(above, above)
        return label

    joining = []
    for at, to in zip(*np.nonzero(linked)):
        a, b = find(int(labels[0][at])), find(int(labels[1][to]))
        if a != b:
            root[a] = b
            joining.append((int(reps[0][at]), int(reps[1][to])))
    return joining


def _linked_in_blocks(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` in buckets with many members outside of the largest component.

    These are dealt to blocks, and so are all members; a task holds one block of each. Rows
    grow with the blocks a member meets, and no pair is listed.
    """

    def blocks(rows: str) -> str:
        return f"cast(greatest(ceil({rows} / {_BLOCK}), ceil(shingles / {_BLOCK_SHINGLES})) as int)"

    place = F.xxhash64("rep")
    whole = crowd.select(
        "bucket", "rep", "label", "largest",
        F.expr(blocks("others")).alias("outer"), F.expr(blocks("members")).alias("inner"),
    )
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    outside = whole.where("label <> largest").select(
        "bucket", F.pmod(place, "outer").cast("int").alias("one"), every("inner").alias("two"),
        "rep", "label", F.lit(True).alias("outside"),
    )
    inside = whole.select(
        "bucket", every("outer").alias("one"), F.pmod(place, "inner").cast("int").alias("two"),
        "rep", "label", F.lit(False).alias("outside"),
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        one, two = frame[frame["outside"]], frame[~frame["outside"]]
        found = compare_blocks(one, two, percent) if len(one) and len(two) else []
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    dealt = outside.unionByName(inside).join(sets, "rep")
    return dealt.groupBy("bucket", "one", "two").applyInPandas(compare, "a long, b long")


def components_of_buckets(
    buckets: DataFrame, sets: DataFrame, percent: int = PERCENT, few: int = FEW
) -> DataFrame | None:
    """Every linked set ``v`` with the smallest one it is connected with, ``label``.

    ``buckets`` holds ``bucket``, ``rep`` and the size ``n`` of its set. None without a link.

    One member of each bucket is compared with all others first, which connects most of a
    group of near copies. In the buckets that still hold several components, every member
    outside of the largest one is compared with all members of other components: pair by
    pair where there are ``few`` of them, in blocks where there are more.
    """
    members = written(_mixed_buckets(buckets, None), "superminhash-members")
    first = members.groupBy("bucket").agg(F.min(F.struct("rep", "n", "label")).alias("anchor"))
    anchors = first.select("bucket", "anchor.*")
    tested = written(_against(members, anchors, percent), "superminhash-pairs")
    links = written(verified(tested, sets, percent), "superminhash-links")
    labels = None if links.isEmpty() else components(links)

    members = written(_mixed_buckets(buckets, labels), "superminhash-members")
    if members.isEmpty():
        return labels
    small = members.where(F.col("others") <= few)
    pairs = _against(small, small.where("label <> largest"), percent)
    pairs = written(pairs.join(tested, ["a", "b"], "left_anti"), "superminhash-pairs")
    more = verified(pairs, sets, percent).unionByName(
        _linked_in_blocks(members.where(F.col("others") > few), sets, percent)
    )
    more = written(more, "superminhash-links")
    return labels if more.isEmpty() else components(links.unionByName(more))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles``, ``component_id`` and ``kept``."""
    found = written(
        prints(docs, id_column, shingle, bands, rows).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "superminhash-prints",
    )
    same = ["sum_a", "sum_b", "n"]
    distinct = written(
        found.where("n > 0").groupBy(*same)
        .agg(F.min("row").alias("rep"), F.min("id").alias("first")),
        "superminhash-sets",
    )
    own = distinct.select(F.col("rep").alias("row"), F.col("n").alias("size"))
    bucket = F.explode("bands").alias("bucket")
    held = found.join(own, "row").select(bucket, F.col("row").alias("rep"), F.col("n"))
    crowded = held.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = written(held.join(crowded.select("bucket"), "bucket"), "superminhash-buckets")
    wanted = found.select(F.col("row").alias("rep"), "id", "text_key").join(
        shared.select("rep").distinct(), "rep", "left_semi"
    )
    sets = written(
        full_sets(docs, written(wanted, "superminhash-wanted"), id_column, shingle),
        "superminhash-full-sets",
    )
    labels = components_of_buckets(shared, sets, percent)
    named = distinct.select(*same, F.col("first").alias("component_id"))
    if labels is not None:
        linked = distinct.join(labels, F.col("rep") == F.col("v")).select(*same, "first", "label")
        smallest = linked.groupBy("label").agg(F.min("first").alias("smallest"))
        joined = linked.join(smallest, "label").select(*same, "smallest", F.lit(True).alias("joined"))
        named = named.join(joined, same, "left").select(
            *same, F.when(F.col("joined"), F.col("smallest")).otherwise(F.col("component_id"))
            .alias("component_id"),
        )
    whole = found.select("id", *same).join(named, same, "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )
    return whole.withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))


def op11_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT r, unnest(list_transform(range(greatest(len(words) - {SHINGLE - 1}, 1)),
        lambda i: array_to_string(words[i + 1 : i + {SHINGLE}], ' '))) AS shingle
    FROM docs WHERE len(words) > 0
), sizes AS (
    SELECT r, count(*) AS n FROM shingles GROUP BY r
), shared AS (
    SELECT a.r AS a, b.r AS b, count(*) AS n
    FROM shingles a JOIN shingles b USING (shingle) WHERE a.r <> b.r GROUP BY a.r, b.r
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
    WHERE 100 * shared.n >= {PERCENT} * (x.n + y.n - shared.n)
), reach(r, other) AS (
    SELECT r, r FROM docs UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = other
), named AS (
    SELECT reach.r, min(o.doc_id) AS component_id
    FROM reach JOIN docs o ON o.r = other GROUP BY reach.r
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id,
       doc_id IS NOT DISTINCT FROM component_id AS kept
FROM docs JOIN named USING (r) LEFT JOIN sizes USING (r)
"""
