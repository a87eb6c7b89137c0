"""Local paths are found in the texts themselves."""

import re

import duckdb

from wavemill.plans import catalog


def test_paths_in_whole_texts(spark, tmp_path):
    texts = ["see /home/ann/a.csv and '/Users/bo/b c'", "", None, "C:\\Users\\cy\\d\x0be:\\Users\\f /homes/g", "x " * 50_000 + "/home/last", "/home//Users/h\n\"/home/\""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    want = {k: None if t is None else len(re.findall(r"(?:^|[\s\"'(=])(?:/Users/[^\s\"')]+|/home/[^\s\"')]+|[A-Za-z]:\\[^\s\"')]+)", t, re.ASCII)) for k, t in enumerate(texts)}
    assert sum(n or 0 for n in want.values()) == 6
    assert {r.doc_id: r.n for r in catalog.QUERIES["h7_document_paths"](spark, str(tmp_path)).collect()} == want
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert dict(db.sql(catalog.SQL["h7_document_paths"]).fetchall()) == want
