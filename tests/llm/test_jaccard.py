import random
import re

import pytest

from tests.llm.conftest import union_components
from wavemill.llm.jaccard import jaccard_components


def brute(rows, words, percent):
    sets = {}
    for doc, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        grams = {tuple(found[k : k + words]) for k in range(len(found) - words + 1)} if len(found) >= words else ({tuple(found)} if found else set())
        sets[doc] = grams
    ids = list(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    parts = union_components(ids, links)
    return {(doc, len(sets[doc]), parts[doc]) for doc in ids}


def made(seed, n=220):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            text = rng.choice(texts).split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text = text[: rng.randint(1, len(text))]
        else:
            text = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 4, 5, 8, 30, 80, 200]))] or [""]
        texts.append(" ".join(text))
    return list(enumerate(texts))


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80)])
def test_same_as_all_pairs(spark, words, percent):
    rows = made(words)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {tuple(r) for r in jaccard_components(docs, words=words, percent=percent).collect()}
    assert got == brute(rows, words, percent)


def test_large_tiles_are_cut_into_blocks(spark, monkeypatch):
    import wavemill.llm.jaccard as module

    monkeypatch.setattr(module, "TILE_ROWS", 3)
    rows = made(9)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {tuple(r) for r in jaccard_components(docs, words=4, percent=85).collect()} == brute(rows, 4, 85)


def test_chain_of_near_copies(spark):
    words = [f"u{k}" for k in range(400)]
    rows = [(k, " ".join(words[3 * k : 3 * k + 60])) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {tuple(r) for r in jaccard_components(docs, words=4, percent=85).collect()}
    assert got == brute(rows, 4, 85)
    assert {r[2] for r in got} == {0}


def test_very_long_texts(spark):
    base = [f"v{k}" for k in range(60_000)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:30_000] + ["odd"] + base[30_000:])), (3, " ".join(base[:40_000])), (4, "v0 v1 v2 v3")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {tuple(r) for r in jaccard_components(docs, words=4, percent=85).collect()} == brute(rows, 4, 85)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a b c d e", 1, "x"), (1, "a b c d e", 2, "y"), (2, None, 3, None), (3, " \n", 4, "z"), (None, "a b c d e", 5, "q"), (4, "A b C d e", 6, "h"), (5, "only three words", 7, "i")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n int, h string")
    got = sorted(tuple(r) for r in jaccard_components(docs, words=4, percent=85).collect() if r[0] is not None)
    assert got == [(1, 2, 1), (1, 2, 1), (2, 0, 2), (3, 0, 3), (4, 2, 1), (5, 1, 5)]
    assert [tuple(r) for r in jaccard_components(docs, words=4, percent=85).where("doc_id is null").collect()] == [(None, 2, None)]
    assert jaccard_components(docs.limit(0)).collect() == []
