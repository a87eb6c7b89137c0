import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wavemill.llm.token_orc import read_token_orc, token_offsets, write_token_orc

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(rows, library):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_ids_come_back_in_document_order(spark, sf, library, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(7)
    write_token_orc(docs, str(tmp_path / "t"), PATH, end_id=2)
    got = sorted(tuple(r) for r in token_offsets(spark, str(tmp_path / "t")).collect())
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()], library)


def test_odd_texts_nulls_and_repeats(spark, library, tmp_path):
    rows = [(3, "a <|endoftext|> b"), (None, "no id"), (1, None), (2, ""), (2, ""), (5, "  é\n\n😀  x \t"), (4, "word " * 5000), (6, "\x00\x1c \x85")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, part string")
    write_token_orc(docs, str(tmp_path / "t"), PATH, end_id=2)
    got = sorted((tuple(r) for r in token_offsets(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    assert got == expected([(d, t or "") for d, t in rows], library)


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    docs = spark.range(0, 40_000, 2).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    write_token_orc(docs, str(tmp_path / "t"), PATH, stride=1000)

    def scanned(doc_id):
        plan = read_token_orc(spark, str(tmp_path / "t"), [doc_id])._jdf.queryExecution().executedPlan()
        plan.executeCollect()
        return sum(leaf.metrics().apply("numOutputRows").value() for leaf in [plan.collectLeaves().apply(k) for k in range(plan.collectLeaves().size())])

    # odd ids lie between the bounds of stripes and row groups, so only Bloom filters can rule them out
    assert sum(scanned(x) for x in range(1001, 40_000, 4000)) <= 2000
    assert 1 <= scanned(20_000) <= 2000


def test_picked_documents_and_empty_tables(spark, sf, library, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    write_token_orc(docs, str(tmp_path / "t"), PATH)
    picked = read_token_orc(spark, str(tmp_path / "t"), [7, 9])
    texts = {r.doc_id: r.text for r in docs.where("doc_id in (7, 9)").collect()}
    assert {r.doc_id: r.ids for r in picked.collect()} == {d: library.encode(t, add_special_tokens=False).ids for d, t in texts.items()}
    assert "PushedFilters: [In(doc_id" in picked._jdf.queryExecution().toString()
    write_token_orc(docs.limit(0), str(tmp_path / "none"), PATH)
    assert token_offsets(spark, str(tmp_path / "none")).collect() == []
