"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import gc
import hashlib
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wavemill.llm.bpe import TextEncoder

SCHEMA = "doc_id bigint, part int, first bigint, n_tokens bigint, ids array<int>"
_tokenizers: dict[str, TextEncoder] = {}


def _tokenizer(content: str) -> TextEncoder:
    """An encoder of texts over the library's tokenizer; one per worker process and file."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _tokenizers:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        library = Tokenizer.from_str(content)
        added = tuple(token.content for token in library.get_added_tokens_decoder().values())
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # how the library writes each byte as a character
        letters = {b: spell(chr(b))[0][0][-1] for b in range(128)} | {b: spell(bytes([0xC3, b]).decode())[0][0][-1] for b in range(0x80, 0xC0)}
        letters |= {b: spell(chr((b & 31) << 6))[0][0][0] for b in range(0xC2, 0xE0)} | {b: spell(chr(max((b & 15) << 12, 0x800)))[0][0][0] for b in range(0xE0, 0xF0)}
        letters |= {b: spell(chr(max((b & 7) << 18, 0x10000)))[0][0][0] for b in range(0xF0, 0xF5)}
        tokenize = library.model.tokenize

        def word(letters_only: str) -> bytes:
            return array("I", [token.id for token in tokenize("\u0120" + letters_only)]).tobytes()

        def pretoken(text: str) -> bytes:
            return array("I", [token.id for token in tokenize(text.encode().decode("latin-1").translate(letters))]).tobytes()

        def whole(text: str) -> bytes:
            return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

        library.model._resize_cache(0)  # what was encoded is remembered here, by pre-token
        _tokenizers[key] = TextEncoder(pretoken, encode_word=word, special=added, encode_special=whole)
    return _tokenizers[key]


def write_token_orc(docs: DataFrame, path: str, tokenizer_path: str, *, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", stripe_mb: int = 16, stride: int = 1000) -> None:
    """Encode whole texts with a byte-level BPE of the tokenizers library and write their ids in ascending document order.

    Files in name order, and the rows in each, ascend by document id (a null id comes first; equal ids are ordered by the
    text's hash, and equal rows are all kept). A null text counts as empty; ``end_id``, if given, ends every document. ORC
    writes the ids by run-length encoding in stripes that separate tasks can read; each stripe has a row index every
    ``stride`` rows and Bloom filters on doc_id. Rows: doc_id, part (the file's place), first (ids before it in the file),
    n_tokens, ids. An empty table gives files without rows. ``path`` must not exist.

    One range shuffle of the texts; they are encoded after it, since ids take more room than text. The tokenizer's file is
    read on the driver and broadcast (1.5 MB, fixed by the tokenizer).
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.array([] if end_id is None else [end_id], "<u4")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        encoder = _tokenizer(content.value)
        gc.disable()  # the library's tokens are many and never in cycles
        try:
            for batch in batches:
                row = 0
                for ids, bounds in encoder.encode_column(batch.column(1)):
                    n = len(bounds) - 1
                    if len(end):
                        ids = np.insert(ids, bounds[1:], end)
                        bounds = bounds + np.arange(n + 1)
                    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.view("<i4")))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(row, n), pa.array(np.full(n, part, np.int32)), pa.array(first + bounds[:-1]), pa.array(np.diff(bounds)), lists],
                        ["doc_id", "part", "first", "n_tokens", "ids"],
                    )
                    row, first = row + n, first + int(bounds[-1])
        finally:
            gc.enable()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    writer = rows.select("doc_id", "text").mapInArrow(encode, SCHEMA).write
    writer.option("orc.compress", "NONE").option("orc.stripe.size", stripe_mb << 20).option("orc.row.index.stride", stride).option("orc.bloom.filter.columns", "doc_id").orc(path)


def read_token_orc(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """Rows of the files; with ``doc_ids``, those documents only: the filter reaches the ORC reader, which skips files,
    stripes and row groups by their bounds and Bloom filters."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin([int(x) for x in doc_ids]))


def token_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Where each document's ids start in the whole sequence, with a checksum, all read from the files.

    doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers). The running total is over
    one row for each file, which is joined back; no document row is shuffled.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            offsets = np.asarray(lists.offsets)
            ids = np.asarray(lists.values).astype("<u4", copy=False)
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())], ["doc_id", "part", "first", "n_tokens", "ids_crc32"])

    rows = spark.read.schema(SCHEMA).orc(path)
    ahead = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = ahead.withColumn("ahead", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    found = rows.select("doc_id", "part", "first", "ids").mapInArrow(digest, "doc_id bigint, part int, first bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(ahead.select("part", "ahead"), "part").select("doc_id", (F.col("ahead") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
