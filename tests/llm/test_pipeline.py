"""Each stage of the pipeline against brute force."""

import base64
import hashlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import SF, union_components
from tests.llm.test_toxicity import slow_logit
from wavemill.llm.langid import NOISE, fit_trigrams
from wavemill.llm.toxicity import fit_toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and gives, on whole documents."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_columns_stay(stages):
    for name in list(stages)[:-1]:
        before, after = stages[name]
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_language_id(stages):
    before, after = stages["language_id"]
    docs = [r for r in before.collect() if r.text and r.text.strip()]
    model = fit_trigrams(before)
    found = brute.fusion([(r.lang, None, r.source, None, r.text) for r in docs], model)
    kept = [r.doc_id for r, (_, chance, per_gram) in zip(docs, found, strict=True) if chance >= 0.5 and not (per_gram is not None and per_gram < NOISE)]
    assert sorted(r.doc_id for r in after.collect()) == sorted(kept)
    assert len(kept) >= 0.98 * before.count()


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    model = fit_toxicity(before, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = []
    for r in before.collect():
        logs, _ = brute.likelihoods(model.languages, r.text)
        margin = slow_logit(model.classifier, r.text or "") - model.thresholds[int(logs.argmax())]
        assert abs(margin) > 1e-4
        if margin < 0:
            kept.append(r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(kept)


def test_near_copies(stages):
    before, after = stages["ngram_jaccard"]
    sets = {r.doc_id: brute.shingles(r.text, 5) for r in before.collect()}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    parts = union_components(ids, links)
    assert sorted(r.doc_id for r in after.collect()) == [x for x in ids if parts[x] == x] and links


def test_mixing(stages):
    before, after = stages["mixing"]
    docs = before.collect()
    taken, _ = brute.mixed([(r.doc_id, r.source, r.text) for r in docs])
    assert Counter(r.doc_id for r in after.collect()) == Counter({r.doc_id: n for r, n in zip(docs, taken, strict=True) if n})
    texts = {r.doc_id: tuple(r) for r in docs}
    assert all(tuple(r) == texts[r.doc_id] for r in after.collect())


def test_byte_bpe(stages):
    before, after = stages["byte_bpe"]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in before.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert rows(after) == sorted(want)


def test_run_is_its_stages(spark, stages):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(stages["byte_bpe"][1])


def test_odd_rows(spark, tmp_path):
    same = (1, "the of and thand erthe ining", "en", "s", 5)
    odd = [same, same, (2, None, None, None, None), (None, "der die und einkeit das", "de", None, 1), (3, "", "fr", "t", 0), (4, "OK", "en", "s", 2), (5, " \t", "en", "s", 2)]
    docs = spark.createDataFrame([(*r, f"x{k}") for k, r in enumerate(odd)], SCHEMA + ", `key` string")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "language_id":
            assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 1, 1, 4]
        if name == "ngram_jaccard":
            assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 1, 4]
        if name != "byte_bpe":
            assert docs.columns[-1] == "key"
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.collect() == []
        empty.write.parquet(str(tmp_path / f"none-{name}"))
        empty = spark.read.schema(empty.schema).parquet(str(tmp_path / f"none-{name}"))


def test_equal_ids_are_judged_row_by_row(spark):
    long = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, long, "en", "s", 0), (1, "quite another text of seven words", "en", "s", 0), (None, long + " more", "en", "s", 0), (7, long, "en", "s", 0), (1, long, "en", "s", 0)], SCHEMA)
    assert rows(corpus_pipeline.near_copies(spark, docs, SF)) == [(1, "quite another text of seven words", "en", "s", 0), (1, long, "en", "s", 0)]
