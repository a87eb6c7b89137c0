"""Exact n-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersections, and the groups they link."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavemill.llm.common import connected_components, discard, giving_back, materialise
from wavemill.llm.text import mix, row_groups, shingle_sets, utf8

_SECOND = np.uint64(0xA0761D6478BD642F)
#: Ids of this many rows at most are broadcast to pick rows; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: A similar pair must share one in this many of its members among its smallest hashes.
SHARE = 25
#: Bits of the signatures that travel with the rows of a tile, and rows up to which a tile does without them.
TILE_BITS = 2048
SMALL_TILE = 16
#: Rows of one tile; a larger group of rows with a common shingle becomes several tiles.
TILE_ROWS = 2048


def signature(hashes: np.ndarray, most: int = 1 << 62) -> bytes:
    """Bitmap of a set, of a power of two and at least four bits for each member but ``most`` in all; a wider one folds into
    a narrower."""
    width = 64
    while width < min(most, 4 * len(hashes)):
        width *= 2
    bits = np.zeros(width, np.uint8)
    bits[(hashes >> np.uint64(17)) & np.uint64(width - 1)] = 1
    return np.packbits(bits).tobytes()


class _Bitmaps:
    """The signatures of a batch of rows, as 64-bit words by width, folded to narrower widths when asked for."""

    def __init__(self, column: pa.Array) -> None:
        column = column.cast(pa.large_binary())
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        self.data, self.starts, self.sizes = np.frombuffer(data, np.uint8), offsets[:-1], np.diff(offsets)

    def rows(self, at: np.ndarray, size: int) -> np.ndarray:
        """Bitmaps of the rows, each of ``size`` bytes."""
        out = np.zeros((len(at), size), np.uint8)
        for own in np.unique(self.sizes[at]):
            some = np.flatnonzero(self.sizes[at] == own)
            block = self.data[self.starts[at[some]][:, None] + np.arange(own)]
            out[some] = np.bitwise_or.reduce(block.reshape(len(some), -1, size), axis=1)
        return out.view(np.uint64)


def _possible(n_a: np.ndarray, n_b: np.ndarray, maps_a: _Bitmaps, maps_b: _Bitmaps, at_a: np.ndarray, at_b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs can reach the similarity: a bit set on one side only is a member that the other side lacks."""
    n_a, n_b = n_a.astype(np.int64), n_b.astype(np.int64)
    fit = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    narrow = np.minimum(maps_a.sizes[at_a], maps_b.sizes[at_b])
    for size in np.unique(narrow[fit & (narrow > 0)]):
        some = np.flatnonzero(fit & (narrow == size))
        for part in np.array_split(some, max(1, len(some) * int(size) >> 22)):
            a, b = maps_a.rows(at_a[part], int(size)), maps_b.rows(at_b[part], int(size))
            lacks_b = np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64)
            lacks_a = np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64)
            common = np.minimum(n_a[part] - lacks_b, n_b[part] - lacks_a)
            fit[part] = 100 * common >= percent * (n_a[part] + n_b[part] - common)
    return fit


def _digests(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    @giving_back
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for low, high in row_groups(offsets):
                sets, at = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], words)
                sizes = np.diff(at)
                one, two = np.zeros(high - low, np.uint64), np.zeros(high - low, np.uint64)
                some = np.flatnonzero(sizes)
                if len(some):
                    one[some] = np.add.reduceat(mix(sets + _SECOND), at[some])
                    two[some] = np.add.reduceat(mix(sets ^ _SECOND), at[some])
                lead = np.where(sizes > 0, sizes - -(-percent * sizes // 100) + np.maximum(1, sizes // SHARE), 0)
                bounds = np.concatenate([[0], np.cumsum(lead)])
                prefix = np.concatenate([sets[a : a + k] for a, k in zip(at[:-1], lead, strict=True)]) if len(lead) else sets
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(sizes.astype(np.int32)),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.array([signature(sets[a:b]) if b > a else b"" for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                        pa.array([signature(sets[a:b], TILE_BITS) if b > a else b"" for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(prefix.view(np.int64))),
                    ],
                    ["id", "n", "one", "two", "bits", "short", "lead"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(digest, "id bigint, n int, one bigint, two bigint, bits binary, short binary, lead array<bigint>")


def _sets_of(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """The sorted shingle hashes of some documents, made again from their texts: less to keep than those of all."""

    @giving_back
    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for low, high in row_groups(offsets):
                sets, at = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], words)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array([sets[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], ["id", "members"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    some = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    return rows.join(some, "id", "left_semi").mapInArrow(sets_of, "id bigint, members binary")


def _verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are as similar as asked, by exact intersection of sorted arrays."""

    @giving_back
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([a, b]))
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(a) + len(b) - common) and common > 0)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = materialise(_sets_of(docs, ids, id_col, text_col, words), "sets")
    full = pairs.join(sets.select(F.col("id").alias("a"), F.col("members").alias("one")), "a").join(sets.select(F.col("id").alias("b"), F.col("members").alias("two")), "b")
    links = materialise(full.select("a", "b", "one", "two").mapInArrow(verify, "a bigint, b bigint").distinct(), "links")
    discard(sets)
    return links


def _bounded(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, bits and sizes of both) to those pairs whose bitmaps let them be similar."""

    @giving_back
    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.arange(batch.num_rows)
            fit = _possible(np.asarray(batch.column(2)), np.asarray(batch.column(3)), _Bitmaps(batch.column(4)), _Bitmaps(batch.column(5)), at, at, percent) if len(at) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(fit))

    return rows.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(bound, "a bigint, b bigint")


def _tile_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) within tiles (h, band, i, j) of rows in different parts that sizes and bitmaps let be similar, with their
    sizes and the number of hashes at which they met.

    Rows arrive sorted by tile and size, and each is compared with those after it as long as the size allows, for all
    tiles of a batch at once: offset 1, offset 2, and so on. The last tile of a batch waits for the next batch.
    """
    keys = 4

    def compare(table: pa.RecordBatch) -> pa.RecordBatch:
        if not table.num_rows:
            return pa.RecordBatch.from_arrays([pa.array([], k) for k in (pa.int64(), pa.int64(), pa.int32(), pa.int32())], ["a", "b", "n_a", "n_b"])
        h, band, i, j, block, id_, n, part, own = (np.asarray(table.column(k)) for k in range(9))
        tile = np.concatenate([[0], np.cumsum((h[1:] != h[:-1]) | (band[1:] != band[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))])
        maps, left, right = _Bitmaps(table.column(9)), [], []
        live, step = np.arange(len(h)), 1
        while len(live):
            live = live[live + step < len(h)]
            far = live + step
            same = (tile[live] == tile[far]) & (100 * n[live].astype(np.int64) >= percent * n[far].astype(np.int64))
            live, far = live[same], far[same]
            # pairs of the lower band are due in that band's tile, pairs of one block in the block's own tile
            due = (part[live] != part[far]) & (own[live] | own[far]) & ((i[live] == j[live]) | (block[live] != block[far]))
            a, b = live[due], far[due]
            fit = _possible(n[a], n[b], maps, maps, a, b, percent)
            left.append(a[fit])
            right.append(b[fit])
            step += 1
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        a, b = np.where(id_[a] < id_[b], a, b), np.where(id_[a] < id_[b], b, a)
        return pa.RecordBatch.from_arrays([pa.array(id_[a]), pa.array(id_[b]), pa.array(n[a]), pa.array(n[b])], ["a", "b", "n_a", "n_b"])

    @giving_back
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            other = np.zeros(batch.num_rows, bool)
            for k in range(keys):
                column = np.asarray(batch.column(k))
                other |= column != column[-1]
            last = np.flatnonzero(other)
            cut = int(last[-1]) + 1 if len(last) else 0
            held.append(batch.slice(0, cut))
            first = held[0] if held[0].num_rows else batch
            if cut or any(first.column(k)[0] != batch.column(k)[-1] for k in range(keys)):
                yield from map(compare, pa.Table.from_batches(held).combine_chunks().to_batches())
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from map(compare, pa.Table.from_batches(held).combine_chunks().to_batches())

    return rows.mapInArrow(tiles, "a bigint, b bigint, n_a int, n_b int").groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("met"))


def jaccard_components(docs: DataFrame, *, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Link documents whose sets of word shingles have a Jaccard similarity of ``percent`` / 100 or more: exact.

    Returns one row per input row: id_col, n_shingles int, component_id (the smallest id that links reach, itself
    included). Words are runs of anything but ASCII white space, with A-Z lower-cased; a text of fewer than ``words``
    words has its whole sequence as its one shingle; a null or blank text has none and links with nothing. Rows with equal
    sets always link. A row with a null id has a null component and links with nothing; rows that share an id are one
    document for links, each with its own n_shingles. An empty table gives no rows. Other columns are left out.

    Two sets so similar share ``percent`` % of the larger, so for any k they share k of the n - ceil(percent n / 100) + k
    smallest hashes of each, n being its size. k is a 25th of the size (1 at least), so a document that shares fewer of these
    with all others together, by chance or by a common passage, drops out. Equal sets are first folded into one. Of the
    smallest ids of all its hashes, each document is compared with the one it shares most with, and what that links is
    merged. Then only pairs in different parts are left: where a hash and a band of sizes has such, its rows form a tile (or
    several, of bounded size), and pairs in it are bounded by size and, in large tiles, by bitmap counts. Pairs that met at
    enough hashes are bounded by their full bitmaps, and what passes is intersected exactly. So no link between different
    parts is lost, and few pairs are made within a large group of near copies.

    A hash that very many documents share is counted by partial sums; where its rows are joined, AQE splits what is skewed,
    and after that they are dealt into tiles. A very long text is read whole in one task, and its hashes, a quarter of its
    words at most, travel as rows of their own.
    """
    digests = materialise(_digests(docs, id_col, text_col, words, percent), "digests")
    classes = digests.where("n > 0 and id is not null").groupBy("n", "one", "two").agg(F.min(F.struct("id", "bits", "short", "lead")).alias("r"))
    classes = materialise(classes.select(F.col("r.id").alias("id"), "n", "one", "two", F.col("r.bits").alias("bits"), F.col("r.short").alias("short"), F.col("r.lead").alias("lead")), "classes")
    kinds = materialise(digests.select("id", "n", "one", "two"), "kinds")
    discard(digests)

    keys = classes.select("id", "n", F.explode("lead").alias("h"))
    shared = keys.groupBy("h").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("h")
    found = materialise(keys.join(shared.hint("shuffle_hash"), "h", "left_semi"), "shared")
    # what a document must share with a partner of the least size that it can have
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / SHARE))
    able = found.groupBy("id", "n").agg(F.count(F.lit(1)).alias("shares")).where(F.col("shares") >= least).select("id", "n")
    keys = found.join(able, ["id", "n"], "left_semi")
    shared = keys.groupBy("h").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("id", "n")).alias("hub")).where("rows > 1")
    tiles = materialise(keys.join(shared, "h").select("h", "id", "n", "hub"), "tiles")
    discard(found)

    must = lambda n: F.greatest(F.lit(1), F.floor(n / SHARE))
    alike = lambda a, b: 100 * F.least(a, b).cast("long") >= percent * F.greatest(a, b).cast("long")
    stars = tiles.where((F.col("id") != F.col("hub.id")) & alike(F.col("n"), F.col("hub.n")))
    stars = stars.groupBy(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("hub.id").alias("b"), F.col("hub.n").alias("n_b")).agg(F.count(F.lit(1)).alias("met"))
    stars = stars.where(F.col("met") >= F.least(must(F.col("n_a")), must(F.col("n_b")))).groupBy("a").agg(F.max_by("b", F.struct("met", "b")).alias("b"))
    stars = materialise(stars, "stars")
    first = _verified(stars, docs, id_col, text_col, words, percent)
    parts = materialise(connected_components(first), "parts")

    # sizes of a similar pair are in the same band or in neighbouring ones; the base is a little wider than the least ratio
    band = F.floor(F.log(F.col("n").cast("double")) / (math.log(100 / percent) * (1 + 1e-9))).cast("int")
    named = parts.select(F.col("node").alias("id"), F.col("component").alias("part"))
    named = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    rows = tiles.select("h", "id", "n").join(named, "id", "left").withColumn("part", F.coalesce("part", "id"))
    rows = rows.withColumn("own_band", band).withColumn("band", F.explode(F.array(F.col("own_band"), F.col("own_band") + 1)))
    marked = materialise(rows, "rows")
    mixed = marked.groupBy("h", "band").agg(F.count(F.lit(1)).alias("rows"), F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    rows = marked.join(mixed.select("h", "band", "rows").hint("shuffle_hash"), ["h", "band"]).withColumn("blocks", F.ceil(F.col("rows") / TILE_ROWS).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # a small tile needs no bitmaps: an empty one rules nothing out
    rows = rows.where(F.col("rows") <= SMALL_TILE).withColumn("short", F.lit(b"")).unionByName(rows.where(F.col("rows") > SMALL_TILE).join(classes.select("id", "n", "short"), ["id", "n"]))
    tile = ["h", "band", "i", "j"]
    rows = rows.select("h", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "n", "part", (F.col("band") == F.col("own_band")).alias("own"), "short")
    rows = rows.repartition(*tile).sortWithinPartitions(*tile, "n")
    pairs = _tile_pairs(rows, percent).where(F.col("met") >= F.least(must(F.col("n_a")), must(F.col("n_b")))).select("a", "b").distinct()
    bits = classes.select("id", "n", "bits")
    pairs = pairs.join(bits.toDF("a", "n_a", "bits_a"), "a").join(bits.toDF("b", "n_b", "bits_b"), "b")
    pairs = materialise(_bounded(pairs, percent), "pairs")
    second = _verified(pairs, docs, id_col, text_col, words, percent)

    copies = kinds.join(classes.select(F.col("id").alias("to"), "n", "one", "two"), ["n", "one", "two"]).where("id != to").select(F.col("id").alias("a"), F.col("to").alias("b"))
    edges = first.select("a", "b").unionByName(second).unionByName(copies)
    components = connected_components(edges)
    discard(classes, tiles, stars, first, parts, marked, pairs, second)
    found = components.select(F.col("node").alias("id"), F.col("component").alias("found"))
    out = kinds.select("id", "n").join(found, "id", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("found", "id").alias("component_id"))
