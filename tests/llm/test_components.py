import random

from tests.llm.conftest import union_components
from wavemill.llm import common
from wavemill.llm.common import connected_components


def test_like_union_find(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(100, 180)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, k) for k in range(500, 560)] + [(7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    pairs = [(a, b) for a, b in links if a is not None and a != b]
    assert {tuple(r) for r in found.collect()} == set(union_components({x for p in pairs for x in p}, pairs).items())


def test_hubs_are_looked_up(spark, monkeypatch):
    monkeypatch.setattr(common, "HUB_EDGES", 20)
    test_like_union_find(spark)
    monkeypatch.setattr(common, "MOST_HUBS", 0)
    test_like_union_find(spark)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_workers_give_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    work = common.giving_back(lambda batches: (x + 1 for x in batches))
    assert list(work(iter([1, 2]))) == [2, 3] and calls == [1]
    early = work(iter([1, 2]))
    next(early)
    early.close()
    assert calls == [1, 1]


def test_the_last_stage_is_written(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20)
    found = corpus_pipeline.encode(spark, docs, sf)
    assert found.count() == 20 and all("/wavemill/encoded-" in name for name in found.inputFiles())
