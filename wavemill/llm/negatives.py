"""Hard-negative mining: positives cut the scores of an anchor into slots, and slots are merged into overlapping windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavemill.llm.common import discard, materialise

#: Doubles hold whole numbers below this exactly.
EXACT = 1 << 53
#: Rows that a task scores at once.
STEP = 1024
_KEY = ("dim", "block", "shard")


class SlotLists:
    """The ``k`` best (score, id) of each of many slots, higher scores first and then smaller ids: a combiner of bounded size."""

    def __init__(self, slots: int, k: int) -> None:
        self.scores, self.ids = np.zeros((slots, k), np.int64), np.zeros((slots, k), np.int64)
        self.held, self.k = np.zeros(slots, np.int64), k

    def worst(self, slots: np.ndarray) -> np.ndarray:
        """The score that a row must reach to enter each slot."""
        return np.where(self.held[slots] == self.k, self.scores[slots, self.k - 1], np.iinfo(np.int64).min)

    def offer(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(slots)
        own, place = np.nonzero(np.arange(self.k) < self.held[touched][:, None])
        slots = np.concatenate([touched[own], slots])
        scores = np.concatenate([self.scores[touched[own], place], scores])
        ids = np.concatenate([self.ids[touched[own], place], ids])
        order = np.lexsort((ids, ~scores, slots))
        slots, scores, ids = slots[order], scores[order], ids[order]
        first = np.searchsorted(slots, touched)
        rank = np.arange(len(slots)) - first[np.searchsorted(touched, slots)]
        keep = rank < self.k
        slots, rank = slots[keep], rank[keep]
        self.scores[slots, rank], self.ids[slots, rank] = scores[keep], ids[keep]
        self.held[touched] = np.bincount(np.searchsorted(touched, slots), minlength=len(touched))

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slot, score and id of all that is held."""
        slots, place = np.nonzero(np.arange(self.k) < self.held[:, None])
        return slots, self.scores[slots, place], self.ids[slots, place]


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whole inner products of the rows of two matrices of whole numbers; by doubles where those are exact. Beyond 62 bits an error."""
    bound = int(np.abs(left.astype(np.float64)).max(initial=0)) * int(np.abs(right.astype(np.float64)).max(initial=0)) * max(1, left.shape[1])
    rough = left.astype(np.float64) @ right.astype(np.float64).T
    if bound < EXACT:
        return rough.astype(np.int64)
    if np.abs(rough).max(initial=0) >= 1 << 62:
        raise ValueError("an inner product takes more than 62 bits")
    return left @ right.T


class PositiveSearch:
    """The best rows of each anchor's label. Rows come sorted by label, and only equal labels are multiplied."""

    def __init__(self, anchors: pa.Table, k: int) -> None:
        self.ids, self.labels, self.vectors = _column(anchors, "id"), _column(anchors, "label"), _matrix(anchors)
        self.keys, self.best, self.k = _column(anchors, "key"), SlotLists(len(self.ids), k), k

    def meet(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        starts = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist()]
        for low, high in zip(starts, [*starts[1:], len(labels)], strict=True):
            a, b = np.searchsorted(self.labels, labels[low], "left"), np.searchsorted(self.labels, labels[low], "right")
            if a == b:
                continue
            scores = inner_products(self.vectors[a:b], vectors[low:high])
            other = self.ids[a:b, None] != ids[None, low:high]
            limit = self.best.worst(np.arange(a, b))
            if high - low > self.k:
                limit = np.maximum(limit, np.partition(np.where(other, scores, np.iinfo(np.int64).min), high - low - self.k, axis=1)[:, high - low - self.k])
            at, row = np.nonzero(other & (scores >= limit[:, None]))
            if len(at):
                self.best.offer(at + a, scores[at, row], ids[low + row])

    def batch(self) -> pa.RecordBatch:
        at, scores, ids = self.best.found()
        return pa.RecordBatch.from_arrays([pa.array(self.keys[at]), pa.array(np.zeros(len(at), np.int32)), pa.array(scores), pa.array(ids)], ["key", "slot", "score", "id"])


class SlotSearch:
    """The best rows of other labels in each slot of each anchor.

    An anchor's upper limits, descending, part the scores: slot s holds what is at most the s-th and above the next. What is
    below the lower limit of every window that reaches into a slot is left out.
    """

    def __init__(self, anchors: pa.Table, k: int) -> None:
        self.labels, self.vectors, self.keys = _column(anchors, "label"), _matrix(anchors), _column(anchors, "key")
        uppers, lowers = anchors["uppers"].to_pylist(), anchors["lowers"].to_pylist()
        self.width = max(map(len, uppers))
        none = np.iinfo(np.int64)
        self.uppers = np.full((len(uppers), self.width), none.min)
        self.floors = np.full((len(uppers), self.width), none.max)
        for row, (up, low) in enumerate(zip(uppers, lowers, strict=True)):
            self.uppers[row, : len(up)] = up
            self.floors[row, : len(up)] = np.maximum(np.minimum.accumulate(low), [*(x + 1 for x in up[1:]), none.min])
        self.least = np.where(self.floors <= self.uppers, self.floors, none.max).min(axis=1)
        self.best = SlotLists(self.uppers.size, k)

    def meet(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        scores = inner_products(self.vectors, vectors)
        fits = (scores <= self.uppers[:, :1]) & (scores >= self.least[:, None]) & (self.labels[:, None] != labels[None, :])
        at, row = np.nonzero(fits)
        score = scores[at, row]
        slot = (self.uppers[at] >= score[:, None]).sum(axis=1) - 1
        place = at * self.width + slot
        fits = (score >= self.floors[at, slot]) & (score >= self.best.worst(place))
        if fits.any():
            self.best.offer(place[fits], score[fits], ids[row[fits]])

    def batch(self) -> pa.RecordBatch:
        place, scores, ids = self.best.found()
        return pa.RecordBatch.from_arrays([pa.array(self.keys[place // self.width]), pa.array((place % self.width).astype(np.int32)), pa.array(scores), pa.array(ids)], ["key", "slot", "score", "id"])


def _column(table: pa.Table, name: str) -> np.ndarray:
    return np.asarray(table[name].combine_chunks())


def _matrix(table: pa.Table) -> np.ndarray:
    return np.asarray(table["vector"].combine_chunks().flatten()).reshape(table.num_rows, -1)


def _scan(anchors: DataFrame, rows: DataFrame, blocks: int, shards: int, search: Callable[[pa.Table, int], PositiveSearch | SlotSearch], k: int) -> DataFrame:
    """(key, slot, score, id) of what ``search`` holds after each block of anchors has met each shard of rows.

    In each task the anchors of a block come first and are held, and the rows of the shard stream past them.
    """
    anchors = anchors.withColumns({"shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))), "side": F.lit(0)})
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    none = F.expr("cast(null as array<bigint>)")
    rows = rows.withColumns({"side": F.lit(1), "key": F.lit(None).cast("long"), "uppers": none, "lowers": none})
    names = [*_KEY, "side", "label", "id", "key", "vector", "uppers", "lowers"]
    both = anchors.select(*names).unionByName(rows.select(*names))
    both = both.repartition(min(blocks * shards, 20_000), *_KEY).sortWithinPartitions(*_KEY, "side", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, at_work = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            parts = [_column(table, c) for c in (*_KEY, "side")]
            cuts = np.zeros(table.num_rows, bool)
            for part in parts:
                cuts[1:] |= part[1:] != part[:-1]
            starts = [0, *np.flatnonzero(cuts).tolist()]
            for low, high in zip(starts, [*starts[1:], table.num_rows], strict=True):
                own = tuple(part[low] for part in parts[:3])
                if own != group:
                    if at_work is not None:
                        yield at_work.batch()
                    group, held, at_work = own, [], None
                if parts[3][low] == 0:
                    held.append(table.slice(low, high - low))
                    continue
                if not held and at_work is None:  # no anchor of that length in the block
                    continue
                if at_work is None:
                    at_work, held = search(pa.concat_tables(held), k), []
                some = table.slice(low, high - low)
                ids, labels, vectors = _column(some, "id"), _column(some, "label"), _matrix(some)
                for x in range(0, high - low, STEP):
                    at_work.meet(ids[x : x + STEP], labels[x : x + STEP], vectors[x : x + STEP])
        if at_work is not None:
            yield at_work.batch()

    return both.mapInArrow(run, "key bigint, slot int, score bigint, id bigint")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def suffix_merges(slots: str, k: int) -> Column:
    """Of an array of slots, each sorted and all of them descending, the first ``k`` of every slot and those after it: the last
    slot first, each merge takes what its slot holds and fills up from the merge before."""
    kind = "array<struct<score:bigint,id:bigint>>"
    none = F.expr(f"cast(array() as array<{kind}>)")
    merge = lambda done, own: F.concat(F.array(F.slice(F.concat(own, F.coalesce(F.try_element_at(done, F.lit(1)), F.expr(f"cast(array() as {kind})"))), 1, k)), done)
    return F.aggregate(F.reverse(slots), none, merge)


def hard_negatives(anchors: DataFrame, rows: DataFrame, *, positives: int = 5, negatives: int = 5, lowest: int = 80, highest: int = 100, block_anchors: int = 2048, shard_rows: int = 131_072) -> DataFrame:
    """Each anchor's hard negatives near each of its positives: anchor_id, positive_id, rank int (from 1), negative_id,
    positive_score, negative_score; exact.

    ``anchors`` and ``rows`` have id bigint, label (a whole number) and vector array<bigint>; other columns are left out. An
    anchor's positives are its first ``positives`` rows of its label and of another id by inner product, ties to the smaller
    id. The negatives of a positive of score p are the first ``negatives`` rows of another label whose score lies within
    ``lowest`` and ``highest`` percent of p, in the same order (for p below 0 none does unless the percentages allow it). All are
    given if there are fewer. Rows with a null id, label or vector, an empty vector or a null component take no part, and only
    vectors of one length are compared. Rows that repeat are rows of their own; anchors that repeat in full count once, and
    those that share an id only are anchors each. Empty tables give no rows; a score beyond 62 bits is an error.

    Two scans find it. The first finds the positives; their distinct upper limits cut the scores of an anchor into disjoint
    slots, from each limit down to the next. The second keeps the best of every slot. A window is what lies below its upper
    limit, so the slots from its own on, merged from the last one up, answer all the windows of an anchor, and the lower
    limit cuts the end of each answer.

    Blocks of ``block_anchors`` meet shards of rows, in tasks that hold one block and the lists of its slots, whatever the
    labels: no label, hot or rare, makes a task larger. A shard has ``shard_rows`` rows, or fewer where the session's shuffle
    partitions ask for more tasks, and gives at most ``positives * negatives`` rows for each anchor. Rows travel once for each
    block, which takes less time than the products of a block unless vectors are far wider than a block.
    """
    spark = rows.sparkSession
    fit = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull())
    clean = lambda df: df.where(fit).select("id", F.col("label").cast("long").alias("label"), F.size("vector").alias("dim"), "vector")
    rows, anchors = clean(rows), clean(anchors).distinct()
    # keys are written down, so that every later job sees the same ones
    anchors = materialise(anchors.withColumn("key", F.monotonically_increasing_id()), "anchors")
    n_anchors, n_rows = anchors.count(), rows.count()
    blocks, partitions = max(1, -(-n_anchors // block_anchors)), int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    shards = max(1, -(-n_rows // shard_rows), min(-(-n_rows // STEP), -(-partitions // blocks)))
    block = F.pmod(F.xxhash64(F.lit(5), "key"), F.lit(blocks)).cast("int")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(3), "id", "vector", F.spark_partition_id()), F.lit(shards)).cast("int"))

    none = F.expr("cast(null as array<bigint>)")
    first = anchors.withColumns({"block": block, "uppers": none, "lowers": none})
    near = materialise(_first(_scan(first, rows, blocks, shards, PositiveSearch, positives), positives), "positives")
    limits = near.select("key", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), _percent(F.floor, highest).alias("upper"), _percent(F.ceil, lowest).alias("lower"))
    slots = limits.groupBy("key", "upper").agg(F.min("lower").alias("lower"))
    slots = slots.groupBy("key").agg(F.reverse(F.array_sort(F.collect_list(F.struct("upper", "lower")))).alias("slots"))
    slots = slots.select("key", F.transform("slots", lambda x: x["upper"]).alias("uppers"), F.transform("slots", lambda x: x["lower"]).alias("lowers"))
    second = materialise(anchors.join(slots, "key").withColumn("block", block), "slots")
    found = _first(_scan(second, rows, blocks, shards, SlotSearch, negatives), negatives)
    lists = found.groupBy("key", "slot").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))), lambda x: F.struct(x["score"].alias("score"), x["id"].alias("id"))).alias("best"))
    lists = lists.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("slot", "best"))).alias("best"))
    whole = second.select("key", F.col("id").alias("anchor_id"), "uppers").join(lists, "key")
    empty = F.expr("cast(array() as array<struct<score:bigint,id:bigint>>)")
    whole = whole.withColumn("slots", F.transform("uppers", lambda x, k: F.coalesce(F.try_element_at("best", k), empty)))
    whole = whole.select("key", "anchor_id", "uppers", suffix_merges("slots", negatives).alias("merged"))
    windows = limits.join(whole, "key").withColumn("reached", F.element_at("merged", F.array_position("uppers", F.col("upper")).cast("int")))
    windows = windows.select("anchor_id", "positive_id", "positive_score", F.posexplode(F.filter("reached", lambda x: x["score"] >= F.col("lower"))).alias("place", "negative"))
    out = windows.select("anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("negative.id").alias("negative_id"), "positive_score", F.col("negative.score").alias("negative_score"))
    discard(anchors)
    return out


def _percent(rounded: Callable[[Column], Column], percent: int) -> Column:
    """So many percent of a score, in whole numbers of 63 bits at most."""
    share = rounded(F.col("score").cast("decimal(20,0)") * F.lit(percent).cast("decimal(6,0)") / F.lit(100).cast("decimal(3,0)"))
    edge = F.lit((1 << 63) - 1).cast("decimal(20,0)")
    return F.greatest(-edge, F.least(edge, share)).cast("long")
