"""Exact top-k inner-product search: ball trees in shards, branch and bound, shared k-th scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavemill.llm.common import discard, materialise

LEAF_ROWS = 256
#: Doubles hold whole numbers below this exactly.
EXACT = 1 << 53
_NONE = np.iinfo(np.int64).min


class BallTree:
    """Rows in nested balls, each with a cone around its center; children split at the median of the line between two far rows."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows, self.order = rows, np.arange(len(rows))
        self.lengths = np.sqrt((rows * rows).sum(axis=1))
        self.nodes: list[tuple] = []
        if len(rows):
            self._build(0, len(rows))

    def _build(self, low: int, high: int) -> int:
        own, lengths = self.rows[self.order[low:high]], self.lengths[self.order[low:high]]
        center = own.mean(axis=0)
        away = ((own - center) ** 2).sum(axis=1)
        axis = center / max(np.sqrt((center * center).sum()), 1e-300)
        some = lengths > 0
        narrow = float((own[some] @ axis / lengths[some]).min()) if some.all() else -1.0
        at = len(self.nodes)
        self.nodes.append((center, float(np.sqrt(away.max())), axis, min(1.0, max(-1.0, narrow - 1e-9)), float(lengths.min()), float(lengths.max()), low, high, -1, -1))
        if high - low > LEAF_ROWS and away.max() > 0:
            one = own[away.argmax()]
            two = own[((own - one) ** 2).sum(axis=1).argmax()]
            half = (high - low) // 2
            self.order[low:high] = self.order[low:high][np.argpartition(own @ (two - one), half)]
            left, right = self._build(low, low + half), self._build(low + half, high)
            self.nodes[at] = (*self.nodes[at][:8], left, right)
        return at

    def bound(self, node: int, queries: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """No row of the node has a higher inner product with a query: the lower of the ball's bound (center . q + radius |q|)
        and the cone's (the longest row at the smallest angle that the cone lets it have), and a margin for rounding."""
        center, radius, axis, narrow, least, most = self.nodes[node][:6]
        ball = queries @ center + lengths * radius
        cosine = np.clip(queries @ axis / np.maximum(lengths, 1e-300), -1, 1)
        apart = cosine * narrow + np.sqrt((1 - cosine * cosine) * (1 - narrow * narrow))
        apart = np.where(cosine >= narrow, 1.0, apart)
        cone = lengths * np.where(apart >= 0, most, least) * apart
        return np.minimum(ball, cone) + 1e-6 * (1 + lengths * most)


class _Best:
    """The best k rows of each query so far by score and then by place, the smaller first.

    Where a score and a place fit into 63 bits together they are one key; else they are sorted as two.
    """

    def __init__(self, queries: int, k: int, floor: np.ndarray, largest: int, rows: int) -> None:
        self.shift = max(1, rows).bit_length()
        self.packed = largest < 1 << (62 - self.shift)
        self.scores, self.places, self.floor = np.full((queries, k), _NONE), np.zeros((queries, k), np.int64), floor

    def least(self, at: np.ndarray) -> np.ndarray:
        """Scores that a row must reach: the k-th so far, here or in the shards before."""
        worst = self.scores[at].min(axis=1)
        if self.packed:
            worst = np.where(worst == _NONE, _NONE, -(-worst >> self.shift))
        return np.maximum(self.floor[at], worst)

    def offer(self, at: np.ndarray, scores: np.ndarray, places: np.ndarray, barred: np.ndarray) -> None:
        k = self.scores.shape[1]
        if self.packed:
            keys = (scores << self.shift) - places
            keys[barred] = _NONE
            both = np.concatenate([self.scores[at], keys], axis=1)
            self.scores[at] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            return
        scores = np.where(barred, _NONE, scores)
        scores = np.concatenate([self.scores[at], scores], axis=1)
        places = np.concatenate([self.places[at], np.broadcast_to(places, (len(at), len(places)))], axis=1)
        first = np.lexsort((places, ~scores), axis=1)[:, :k]
        self.scores[at], self.places[at] = np.take_along_axis(scores, first, axis=1), np.take_along_axis(places, first, axis=1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, place and score of all."""
        query, slot = np.nonzero(self.scores != _NONE)
        scores, places = self.scores[query, slot], self.places[query, slot]
        if self.packed:
            scores, places = -(-scores >> self.shift), (-scores) & ((1 << self.shift) - 1)
        return query, places, scores


def search_shard(query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query, row and score of each query's k best rows in one shard (ties to the smaller id) that reach its floor, and the
    number of pairs that were scored.

    Depth first through a ball tree, for all queries at once: each goes to the child with the higher bound first, and leaves
    out a node whose bound is below its k-th score so far. Bounds are doubles with a margin, scores are whole numbers.
    """
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    largest = int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    tree, best = BallTree(rows.astype(np.float64)), _Best(len(queries), k, floor, largest, len(rows))
    wide, scored = queries.astype(np.float64), 0
    lengths = np.sqrt((wide * wide).sum(axis=1))
    # integers multiply more slowly, but are exact for any score of 64 bits
    left_side, right_side = (wide, tree.rows) if largest < EXACT else (queries, rows)

    def visit(node: int, at: np.ndarray) -> None:
        nonlocal scored
        at = at[tree.bound(node, wide[at], lengths[at]) >= best.least(at)]
        if not len(at):
            return
        low, high, left, right = tree.nodes[node][6:]
        if left < 0:
            for first in range(low, high, 256):
                places = tree.order[first : min(first + 256, high)]
                scores = (left_side[at] @ right_side[places].T).astype(np.int64)
                best.offer(at, scores, places, query_ids[at][:, None] == ids[places])
                scored += scores.size
            return
        leftward = tree.bound(left, wide[at], lengths[at]) >= tree.bound(right, wide[at], lengths[at])
        visit(left, at[leftward])
        visit(right, at[~leftward])
        visit(right, at[leftward])
        visit(left, at[~leftward])

    if len(rows) and len(queries):
        visit(0, np.arange(len(queries)))
    query, places, scores = best.found()
    keep = scores >= floor[query]
    query, places, scores = query[keep], places[keep], scores[keep]
    return query_ids[query], ids[places], scores, scored


def top_k(queries: DataFrame, rows: DataFrame, k: int = 20, *, shard_rows: int = 8192, block_queries: int = 2048) -> DataFrame:
    """Each query's k rows of highest integer inner product: query_id, rank int (from 1), vec_id, score; exact.

    ``queries`` has query_id bigint and vector array<bigint>, ``rows`` vec_id bigint and vector array<bigint>; other columns are
    left out. Ties go to the smaller vec_id; a query's own id is left out; a query with fewer rows gets all. Null ids and
    vectors that are null, empty or hold a null take no part, and vectors are only compared with others of their length.
    Repeated rows are kept as rows; queries that repeat an id have one list together. A score beyond 64 bits is an error. Empty
    tables give no rows.

    Rows are dealt into shards of about ``shard_rows`` and queries into blocks, evenly, whatever ids repeat; every block meets
    every shard in a task of bounded size, and no side is broadcast. Shards are searched in waves of 1, 1, 2, 4 and so on:
    each wave starts with the k-th score that every query has from all shards before, so later ones return few rows. A row
    travels once for each block of ``block_queries`` queries.
    """
    fit = lambda v: v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull())
    queries = queries.where(fit(F.col("vector")) & F.col("query_id").isNotNull()).select("query_id", "vector", F.size("vector").alias("dim"))
    rows = rows.where(fit(F.col("vector")) & F.col("vec_id").isNotNull()).select("vec_id", "vector", F.size("vector").alias("dim"))
    shards, blocks = max(1, -(-rows.count() // shard_rows)), max(1, -(-queries.count() // block_queries))
    # a salt spreads rows that are equal; the places are written down, so that every wave sees the same ones
    spread = lambda name, n: F.pmod(F.xxhash64(F.lit(3), name, "vector", F.monotonically_increasing_id() % 1024), F.lit(n)).cast("int")
    queries = materialise(queries.withColumn("block", spread("query_id", blocks)), "queries")
    rows = materialise(rows.withColumn("shard", spread("vec_id", shards)), "shards")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def search(some: pa.Table, own: pa.Table) -> pa.Table:
        if not some.num_rows or not own.num_rows:
            found = (np.zeros(0, np.int64),) * 3
        else:
            dim = some["dim"][0].as_py()
            matrix = lambda t: np.asarray(t.combine_chunks().flatten()).reshape(-1, dim)
            found = search_shard(np.asarray(some["query_id"]), matrix(some["vector"]), np.asarray(some["floor"]), np.asarray(own["vec_id"]), matrix(own["row_vector"]), k)
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    key, best, done = ["dim", "block", "shard"], None, 0
    while done < shards:
        wave = min(max(1, done), shards - done)
        some = queries.withColumn("floor", F.lit(_NONE))
        if best is not None:
            floors = best.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("reached"))
            some = queries.join(floors, "query_id", "left").withColumn("floor", F.coalesce("reached", F.lit(_NONE)))
        some = some.withColumn("shard", F.explode(F.sequence(F.lit(done), F.lit(done + wave - 1)))).select("query_id", "vector", "floor", *key)
        # other names than those of the queries, which may come from the same table
        own = rows.where(F.col("shard").between(done, done + wave - 1)).withColumn("block", every_block)
        own = own.select("vec_id", F.col("vector").alias("row_vector"), *(F.col(c).alias(f"row_{c}") for c in key))
        found = some.groupBy(*key).cogroup(own.groupBy(*(f"row_{c}" for c in key))).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
        before, best = best, _ranked(found if best is None else best.select("query_id", "vec_id", "score").unionByName(found), k)
        best = materialise(best, "best")
        if before is not None:
            discard(before)
        done += wave
    discard(queries, rows)
    return best.select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
