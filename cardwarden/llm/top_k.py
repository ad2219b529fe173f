"""Exact top-k search by inner product: a ball tree per shard, branch and bound.

Vectors become whole numbers, ``floor(256 * x)``. They are dealt to shards by a hash; each
shard builds a ball tree and stores it as one row. Queries come in blocks. A first round
searches one shard per block, which gives every query a kth score; that score is shared with
the second round, which searches all other shards at once. In a shard, nodes are visited in the
order of their upper bound of the inner product and left out where no query can still gain.

Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's
own row (a row repeating its id and vector is another row). NULL vectors, and those with NULL,
NaN or infinite components, take no part; neither do rows without an id. Vectors of different
lengths do not meet. Scores are exact below 2^53. Ties go to the smaller id. Empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import table, written

K = 5
EVERY = 50
SCALE = 256
SHARD_ROWS = 16_384
BLOCK_ROWS = 4_096
LEAF = 256
_NONE = np.iinfo(np.int64).max


def scaled(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """Rows that take part: ``uid`` (the row), ``vec_id``, ``v`` in whole numbers, ``dim``."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(column).isNotNull() & F.col(id_column).isNotNull()).where(finite).select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(column, lambda x: F.floor(x.cast("double") * SCALE).cast("double")).alias("v"),
        F.size(column).alias("dim"),
    )


# The tree of a shard: nodes with centre, radius and the range of rows they hold.


def build(points: np.ndarray, leaf: int = LEAF):
    """Order of the rows, and nodes (from, to, left, right; -1 at leaves), centres, radii."""
    order = np.arange(len(points))
    nodes, centres, radii = [], [], []

    def add(start: int, end: int) -> int:
        rows = points[order[start:end]]
        centre = rows.mean(axis=0)
        number = len(nodes)
        nodes.append([start, end, -1, -1])
        centres.append(centre)
        radii.append(np.sqrt(((rows - centre) ** 2).sum(axis=1).max()))
        if end - start > leaf and radii[number] > 0:
            # Two rows far apart name the direction; the median along it halves the node.
            a = rows[((rows - rows[0]) ** 2).sum(axis=1).argmax()]
            b = rows[((rows - a) ** 2).sum(axis=1).argmax()]
            along = np.argsort(rows @ (b - a), kind="stable")
            order[start:end] = order[start:end][along]
            middle = (start + end) // 2
            nodes[number][2] = add(start, middle)
            nodes[number][3] = add(middle, end)
        return number

    add(0, len(points))
    return order, np.array(nodes), np.array(centres), np.array(radii)


def _merge(scores, ids, new_scores, new_ids, k):
    """The k best of both, ties to smaller ids."""
    both, names = np.hstack([scores, new_scores]), np.hstack([ids, new_ids])
    order = np.lexsort((names, -both), axis=1)[:, :k]
    return np.take_along_axis(both, order, 1), np.take_along_axis(names, order, 1)


def search(tree: dict, queries: np.ndarray, query_uids: np.ndarray, floor: np.ndarray, k: int):
    """Best scores and ids of each query in one shard, given scores it must at least reach."""
    nodes, centres, radii = tree["nodes"], tree["centres"], tree["radii"]
    points, ids, uids = tree["points"], tree["ids"], tree["uids"]
    scores = np.full((len(queries), k), -np.inf)
    names = np.full((len(queries), k), _NONE)
    norms = np.sqrt((queries**2).sum(axis=1))

    def bounds(node: int, rows: np.ndarray) -> np.ndarray:
        bound = queries[rows] @ centres[node] + norms[rows] * radii[node]
        return bound + 1e-9 * np.abs(bound) + 1e-6 * (1 + norms[rows])

    everyone = np.arange(len(queries))
    first = bounds(0, everyone)
    waiting = [(-float(first.max()), 0, everyone, first)]
    while waiting:
        _, node, rows, bound = heapq.heappop(waiting)
        alive = bound >= np.maximum(scores[rows, -1], floor[rows])
        rows = rows[alive]
        if not len(rows):
            continue
        start, end, left, right = nodes[node]
        if left >= 0:
            for child in (int(left), int(right)):
                upper = bounds(child, rows)
                heapq.heappush(waiting, (-float(upper.max()), child, rows, upper))
            continue
        for at in range(start, end, LEAF):  # equal rows may fill a leaf of any size
            stop = min(end, at + LEAF)
            found = queries[rows] @ points[at:stop].T
            found[query_uids[rows][:, None] == uids[None, at:stop]] = -np.inf
            named = np.where(np.isinf(found), _NONE, ids[None, at:stop])
            scores[rows], names[rows] = _merge(scores[rows], names[rows], found, named, k)
    return scores, names


def _pack(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def shard_trees(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard (and vector length) with its tree."""
    count = rows.count()
    shards = max(1, -(-count // shard_rows))

    def plant(frame: pd.DataFrame) -> pd.DataFrame:
        points = np.vstack([np.asarray(v, np.float64) for v in frame["v"]])
        order, nodes, centres, radii = build(points)
        return pd.DataFrame([{
            "shard": frame["shard"].iloc[0], "dim": frame["dim"].iloc[0], "points": _pack(points[order]),
            "ids": _pack(frame["vec_id"].to_numpy(np.int64)[order]),
            "uids": _pack(frame["uid"].to_numpy(np.int64)[order]),
            "nodes": _pack(nodes.astype(np.int64)), "centres": _pack(centres), "radii": _pack(radii),
        }])

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard", "dim").applyInPandas(plant, TREE)


TREE = (
    "shard int, dim int, points binary, ids binary, uids binary, nodes binary, "
    "centres binary, radii binary"
)
HITS = "query long, query_id long, block int, vec_id long, score double"


def _tree(row) -> dict:
    def numbers(blob, kind=np.float64):
        return np.frombuffer(bytes(blob), kind)

    return {
        "points": numbers(row.points).reshape(-1, row.dim), "ids": numbers(row.ids, np.int64),
        "uids": numbers(row.uids, np.int64), "nodes": numbers(row.nodes, np.int64).reshape(-1, 4),
        "centres": numbers(row.centres).reshape(-1, row.dim), "radii": numbers(row.radii),
    }


def _hits(pairs: DataFrame, k: int) -> DataFrame:
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                queries = np.frombuffer(bytes(row.q), np.float64).reshape(-1, row.dim)
                uids = np.frombuffer(bytes(row.q_uids), np.int64)
                own = np.frombuffer(bytes(row.q_ids), np.int64)
                floor = np.frombuffer(bytes(row.floor), np.float64)
                scores, names = search(_tree(row), queries, uids, floor, k)
                at, rank = np.nonzero(names != _NONE)
                yield pd.DataFrame({
                    "query": uids[at], "query_id": own[at], "block": row.block,
                    "vec_id": names[at, rank], "score": scores[at, rank],
                })

    return pairs.mapInPandas(read, HITS)


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, k: int = K, every: int = EVERY, id_column: str = "vec_id",
    column: str = "embedding", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k best of every query."""
    rows = written(scaled(vectors, id_column, column), "vectors")
    trees = written(shard_trees(rows, shard_rows), "ball-trees")
    places = trees.groupBy("dim").agg(F.sort_array(F.collect_list("shard")).alias("shards"))
    asked = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // block_rows))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(blocks)).cast("int"))

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        floor = frame["floor"].to_numpy(np.float64) if "floor" in frame else np.full(len(frame), -np.inf)
        return pd.DataFrame([{
            "block": frame["block"].iloc[0], "dim": frame["dim"].iloc[0],
            "q": _pack(np.vstack([np.asarray(v, np.float64) for v in frame["v"]])),
            "q_uids": _pack(frame["uid"].to_numpy(np.int64)),
            "q_ids": _pack(frame["vec_id"].to_numpy(np.int64)), "floor": _pack(floor),
        }])

    layout = "block int, dim int, q binary, q_uids binary, q_ids binary, floor binary"
    own_shard = F.element_at("shards", (F.pmod(F.col("block"), F.size("shards")) + 1).cast("int"))
    opening = asked.groupBy("block", "dim").applyInPandas(gather, layout).join(F.broadcast(places), "dim")
    first = written(
        _hits(opening.select("*", own_shard.alias("shard")).drop("shards").join(trees, ["shard", "dim"]), k),
        "first-hits",
    )
    kth = first.groupBy("query").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(float("-inf")).alias("floor")
    )
    armed = asked.join(kth, asked["uid"] == kth["query"], "left").drop("query")
    armed = armed.withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    rest = armed.groupBy("block", "dim").applyInPandas(gather, layout).join(F.broadcast(places), "dim")
    rest = rest.select("*", F.explode(F.filter("shards", lambda s: s != own_shard)).alias("shard"))
    # One pair of a query block and a shard is a task's unit of work; spread them evenly.
    hits = _hits(rest.drop("shards").join(trees, ["shard", "dim"]), k)
    return _best(first.unionByName(hits), k).select(
        "query_id", "rank", "vec_id", F.col("score").cast("long").alias("score")
    )


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
