"""Near-duplicate embeddings by sorted projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemill.llm.common import connected_components, discard, materialise

#: Bits of a sort key.
BITS = 48
#: Passes of any table, however small.
LEAST_PASSES = 24
#: Rows that one task compares at once; a task's memory is bounded by it.
CHUNK_ROWS = 16_384
#: Sizes of this many groups at most are broadcast.
BROADCAST_ROWS = 1_000_000


def usable(vector: Column) -> Column:
    """Whether a vector has members, all finite and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def vectors_of(column: pa.Array) -> np.ndarray:
    """Matrix of a column of equally long arrays without nulls. Doubles are scaled by a power of two for each row, which changes no
    cosine and keeps squares finite."""
    values = np.asarray(column.flatten())
    values = values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
    if values.size and values.dtype == np.float64:
        values = np.ldexp(values, -np.frexp(np.abs(values).max(axis=1))[1][:, None])
    return values


def _with_keys(classes: DataFrame, passes: range, seed: int) -> DataFrame:
    """Each row once for each pass, with the concatenated sign hashes of that pass as its key."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            dims = np.asarray(batch.column(2))
            for dim in np.unique(dims):
                some = batch.filter(pa.array(dims == dim))
                vectors = vectors_of(some.column(3)).astype(np.float64)
                for k in passes:
                    planes = np.random.default_rng([seed, k, int(dim)]).standard_normal((int(dim), BITS))
                    key = ((vectors @ planes) > 0) @ powers
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), k, np.int32)), pa.array(key), *some.columns], ["pass", "key", *some.schema.names])

    kind, vector = (classes.schema[c].dataType.simpleString() for c in ("label", "vector"))
    return classes.select("label", "id", "dim", "vector").mapInArrow(keyed, f"pass int, key bigint, label {kind}, id bigint, dim int, vector {vector}")


def passes_needed(rows: int, window: int, cosine: float, recall: float) -> int:
    """Passes after which a lone pair of that cosine among ``rows`` of its label has met with a probability of ``recall``.

    One random sign agrees for both with probability a = 1 - angle / pi, and halves the others. So the pair is within
    ``window`` places if it agrees in log2(rows / window) signs, which a pass gives with a to that power: 0.88 for each halving
    at a cosine of 0.93. With a window of 128 and a recall of 0.999 it takes 20 passes for 10^5 rows, 33 for 10^6, 52 for 10^7, 81 for 10^8
    and 125 for 10^9.
    """
    agree = 1 - math.acos(min(1.0, max(-1.0, cosine))) / math.pi
    met = agree ** max(0.0, math.log2(max(1, rows) / window))
    return 1 if met >= recall else math.ceil(math.log(1 - recall) / math.log1p(-met))


def _neighbour_links(rows: DataFrame, cosine: float, window: int) -> DataFrame:
    """Pairs (a, b) that hold together what links join among neighbours in the order of each task's rows.

    Each block of ``window`` rows is compared with itself and the next ``window``; as long as the last comparison of a block
    found a link, it goes on with the rows after, to the end of the chunk of ``CHUNK_ROWS``; the last ``4 * window`` rows go
    into the next chunk too. Of the links, those are returned that join rows not joined before in the chunk: fewer than rows.
    """
    chunk_rows = CHUNK_ROWS

    def compare(table: pa.Table, fresh: int) -> pa.RecordBatch:
        """Links among rows; those before ``fresh`` were compared with each other before."""
        group = np.zeros(table.num_rows, np.int64)
        for name in ("pass", "label", "dim"):
            column = np.asarray(table[name].combine_chunks())
            group[1:] += column[1:] != column[:-1]
        group = np.cumsum(group > 0)
        ids = np.asarray(table["id"].combine_chunks())
        left, right = [], []
        for one in np.split(np.arange(len(group)), np.flatnonzero(np.diff(group)) + 1):
            vectors = vectors_of(table["vector"].slice(one[0], len(one)).combine_chunks()).astype(np.float64)
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            units = vectors / norms[:, None]
            root = np.arange(len(one))
            for low in range(0, len(one), window):
                high, end = min(low + window, len(one)), min(low + 2 * window, len(one))
                start = low
                while start < end:
                    more = True
                    if (root[low:high] != root[low]).any() or (root[start:end] != root[low]).any():
                        a, b = np.nonzero(units[low:high] @ units[start:end].T >= cosine - 1e-9)
                        a, b = a + low, b + start
                        a, b = a[a < b], b[a < b]
                        more = one[0] + end <= fresh or (len(b) and b.max() >= end - window)
                        apart = root[a] != root[b]
                        a, b = a[apart], b[apart]
                        exact = (vectors[a] * vectors[b]).sum(axis=1) / (norms[a] * norms[b]) >= cosine
                        a, b = a[exact], b[exact]
                        while len(a):
                            first, second = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
                            second, place = np.unique(second, return_index=True)
                            left.append(one[0] + a[place])
                            right.append(one[0] + b[place])
                            root[second] = first[place]
                            while (root[root] != root).any():
                                root = root[root]
                            apart = root[a] != root[b]
                            a, b = a[apart], b[apart]
                    start, end = end, min(end + window, len(one)) if more else 0
        a, b = (ids[np.concatenate(x)] if x else np.zeros(0, np.int64) for x in (left, right))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh, seen = [], 0, 0
        for batch in batches:
            held.append(batch)
            seen += batch.num_rows
            while seen - fresh >= chunk_rows:
                table = pa.Table.from_batches(held)
                yield compare(table.slice(0, fresh + chunk_rows), fresh)
                rest = table.slice(max(0, fresh + chunk_rows - 4 * window))
                fresh = min(4 * window, fresh + chunk_rows)
                held, seen = rest.to_batches(), rest.num_rows
        if seen > fresh:
            yield compare(pa.Table.from_batches(held), fresh)

    return rows.mapInArrow(links, "a bigint, b bigint")


def _degrees(members: DataFrame, cosine: float) -> DataFrame:
    """Rows linked with each id, exactly: all pairs of equal component, label and dim are compared.

    Takes (component, label, dim, hash, id, copies, vector) and returns (class, others). A group is dealt into blocks by
    ``hash``, and each two blocks meet in a tile of ``2 * CHUNK_ROWS`` rows or so, whatever the size of the group. Only sums
    leave a tile, so the work of a group grows with the square of its rows and its output with rows times blocks.
    """
    key = ["component", "label", "dim"]
    most, tile = CHUNK_ROWS, ["dim", "component", "label", "i", "j"]
    whole = min(128, most)  # a group of so many rows is one block
    sizes = materialise(members.groupBy(*key).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > whole), "sizes")
    block = F.least(F.lit(most), F.greatest(F.lit(whole), F.ceil(F.col("m") / 10)))
    # fewer than rows / 128, so they are broadcast up to a number at which no group is a large part of a task of a shuffle
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    dealt = members.join(sizes, key, "left").withColumn("blocks", F.coalesce(F.ceil(F.col("m") / block), F.lit(1)).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit(31), "hash"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(*key, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"), "id", "copies", "vector")

    def added(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Sums of whole tiles: small ones are compared together, and large ones in squares of 1,024 rows."""
        number = np.zeros(table.num_rows, np.int64)
        parts = [np.asarray(table[name].combine_chunks()) for name in tile]
        for column in parts:
            number[1:] += column[1:] != column[:-1]
        number = np.cumsum(number > 0)
        dims, diagonal = parts[0], parts[3] == parts[4]
        ids, copies, side = (np.asarray(table[name].combine_chunks()) for name in ("id", "copies", "side"))
        starts = np.flatnonzero(np.diff(number, prepend=-1)).tolist() + [len(number)]
        k = 0
        while k < len(starts) - 1:
            low, k = starts[k], k + 1
            while k < len(starts) - 1 and starts[k + 1] - low <= 1024 and dims[starts[k]] == dims[low]:
                k += 1
            high = starts[k]
            vectors = vectors_of(table["vector"].slice(low, high - low).combine_chunks()).astype(np.float64)
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            units, sums = vectors / norms[:, None], np.zeros(high - low, np.int64)
            own, first, weight, whole = number[low:high], side[low:high] == 0, copies[low:high], diagonal[low:high]
            for x in range(0, high - low, 1024):
                for y in range(x, high - low, 1024):
                    p, q = slice(x, x + 1024), slice(y, y + 1024)
                    meet = (own[p, None] == own[None, q]) & (whole[p, None] | (first[p, None] != first[None, q]))
                    if x == y:
                        meet = np.triu(meet, 1)
                    if not meet.any():
                        continue
                    near = units[p] @ units[q].T
                    sure = meet & (near >= cosine + 1e-9)
                    a, b = np.nonzero(meet & ~sure & (near >= cosine - 1e-9))
                    for z in range(0, len(a), 16_384):
                        c, d = a[z : z + 16_384], b[z : z + 16_384]
                        sure[c, d] = (vectors[x + c] * vectors[y + d]).sum(axis=1) / (norms[x + c] * norms[y + d]) >= cosine
                    sure = sure.astype(np.float64)
                    sums[p] += (sure @ weight[q]).astype(np.int64)
                    sums[q] += (weight[p] @ sure).astype(np.int64)
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(ids[low:high][some]), pa.array(sums[some])], ["class", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen, wait = [], 0, most
        for batch in batches:
            held.append(batch)
            seen += batch.num_rows
            if seen >= wait:
                table = pa.Table.from_batches(held)
                differs = np.zeros(table.num_rows - 1, bool)
                for name in tile:
                    column = np.asarray(table[name].combine_chunks())
                    differs |= column[1:] != column[:-1]
                cut = np.flatnonzero(differs)
                if len(cut):
                    yield from added(table.slice(0, int(cut[-1]) + 1))
                    rest = table.slice(int(cut[-1]) + 1)
                    held, seen = rest.to_batches(), rest.num_rows
                wait = seen + most
        if seen:
            yield from added(pa.Table.from_batches(held))

    dealt = dealt.repartition(*tile).sortWithinPartitions(*tile, "side")
    return dealt.mapInArrow(count, "class bigint, n bigint").groupBy("class").agg(F.sum("n").alias("others"))


def embedding_components(embeddings: DataFrame, *, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", passes: int | None = None, recall: float = 0.999, at_once: int = 6, window: int = 128, seed: int = 29) -> DataFrame:
    """Link vectors with equal labels and a cosine (in double precision) of ``cosine`` or more, and find what hangs together.

    One row per input row: id_col, n_links bigint (other rows linked directly), component_id (the smallest id that links
    reach, itself included), kept boolean (id = component_id). Equal vectors with equal labels are first folded into one, with a
    count. Then in each pass the vectors are range-partitioned and sorted by label and ``BITS`` concatenated sign hashes of
    random projections, and each is compared with at least ``window`` neighbours after it in its task, and further as long
    as links are found, within chunks of ``CHUNK_ROWS`` that overlap. The links of all passes only say what hangs together;
    n_links is then counted over all pairs of each component, whatever its size, which takes work that grows with the
    square of a component. Only verified links count. A component is cut in two only if no pass meets any of the links between
    its parts. The number of passes grows with the largest label, so that even a pair at the very threshold that nothing else
    links meets with a probability of ``recall`` (see :func:`passes_needed`), and is ``LEAST_PASSES`` at least; ``passes`` overrides it.
    Pairs that are closer, and groups, meet more often (measured recall: see the README).

    Vectors that are null, empty, zero or hold a null or a non-finite component, and rows with a null label or id, link with
    nothing: n_links 0, component_id their own id, kept true. Vectors of different lengths aren't compared. A cosine that
    equals ``cosine`` links. Rows that share an id are one node, and their equal vectors count as links of it. An empty table
    gives no rows. Other columns are left out. Passes run ``at_once`` in one shuffle, so
    that disk holds that many copies of the vectors at most.
    """
    # floats stay floats, which hold them exactly; whatever else is compared as doubles
    kind = "array<float>" if embeddings.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast(kind).alias("vector"))
    fit = rows.where(usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull()).withColumn("hash", F.xxhash64("vector"))
    classes = fit.groupBy("label", "hash", "vector").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(classes, "classes")
    if passes is None:
        largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        passes = max(LEAST_PASSES, passes_needed(largest, window, cosine, recall))
    source = classes.select("label", F.col("class").alias("id"), F.size("vector").alias("dim"), "vector")
    found = []
    for first in range(0, passes, at_once):
        keyed = _with_keys(source, range(first, min(first + at_once, passes)), seed)
        order = ["pass", "label", "dim", "key", "id"]
        found.append(materialise(_neighbour_links(keyed.repartitionByRange(*order).sortWithinPartitions(*order), cosine, window).distinct(), "links"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    links = materialise(links.distinct(), "links")
    discard(*found)
    parts = connected_components(links).withColumnRenamed("node", "class")
    discard(links)
    members = classes.join(parts, "class").select("component", "label", F.size("vector").alias("dim"), "hash", F.col("class").alias("id"), "copies", "vector")
    degrees = _degrees(members, cosine)
    known = classes.select("label", "hash", "vector", "class", "copies").join(degrees, "class", "left").join(parts, "class", "left")
    known = known.select("label", "hash", "vector", "class", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "class").alias("component"))
    linked = fit.join(known, ["label", "hash", "vector"]).select("id", "n_links", "component")
    alone = rows.where(~(usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull())).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))
