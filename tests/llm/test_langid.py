import random

import numpy as np
import pytest

from tests.llm import brute
from wavemill.llm.langid import document_evidence, fit_trigrams, fuse_evidence, page_evidence


@pytest.fixture(scope="module")
def model(spark, sf):
    return fit_trigrams(spark.read.parquet(f"{sf}/documents.parquet"))


def test_held_out_pages(spark, sf, model):
    rows = fuse_evidence(page_evidence(spark.read.parquet(f"{sf}/pages.parquet")), model).collect()
    assert sum(r.lang == r.declared for r in rows) >= 0.98 * len(rows)
    assert sum(r.text_lang == r.declared for r in rows) >= 0.95 * len(rows)


def test_documents(spark, sf, model):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = {r.id: r.lang for r in fuse_evidence(document_evidence(docs), model).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert sum(found[d] == truth[d] for d in truth) >= 0.98 * len(truth)


def test_without_text_the_other_evidence_decides(spark, model):
    rows = [(k, "de", "de", "x.de", "x.de", "der die und einkeit der das ung") for k in range(30)] + [(k, "fr", "fr", "y.fr", "y.fr", "les des que dans une tion de la") for k in range(100, 130)]
    rows += [(1000, None, None, "x.de", "x.de", ""), (1001, "fr", None, None, None, None), (1002, None, "de", None, None, "")]
    found = {r.id: r for r in fuse_evidence(spark.createDataFrame(rows, "id bigint, declared string, suffix string, host string, site string, text string"), model).collect()}
    assert [found[k].lang for k in (1000, 1001, 1002)] == ["de", "fr", "de"]
    assert found[1000].text_lang is None and found[1000].per_gram is None


def test_fusion_recomputed(spark, model):
    rng, words = random.Random(2), {"de": "der die und einkeit das", "en": "the of and thand erthe", "fr": "les des que dans une"}
    rows = []
    for k in range(90):
        lang = rng.choice(sorted(words))
        text = " ".join(rng.choice(words[lang].split()) for _ in range(rng.choice([0, 1, 3, 30])))
        other = lambda x: rng.choice([x, None, rng.choice(["de", "fr", "xx"])])
        site = rng.choice(["a.com", "b.de", None])
        rows.append((other(lang), other(lang), site and f"{rng.choice('xyz')}.{site}", site, text))
    schema = "id bigint, declared string, suffix string, host string, site string, text string, p double, value string"
    got = sorted(fuse_evidence(spark.createDataFrame([(k, *r, 0.5, "v") for k, r in enumerate(rows)], schema), model).collect())
    for r, (lang, chance, per_gram) in zip(got, brute.fusion(rows, model), strict=True):
        assert (r.lang, r.probability) == (lang, pytest.approx(chance, abs=1e-9))
        assert r.per_gram == (None if per_gram is None else pytest.approx(per_gram, abs=1e-5))


def test_ties_and_very_long_texts(spark):
    twins = fit_trigrams(spark.createDataFrame([(1, "abc abc", "bb"), (2, "abc abc", "aa")], "doc_id bigint, text string, lang string"))
    rows = spark.createDataFrame([(1, None, None, None, None, "abc"), (2, None, None, None, None, "abc " * 500_000)], "id bigint, declared string, suffix string, host string, site string, text string")
    assert {(r.lang, r.text_lang) for r in fuse_evidence(rows, twins).collect()} == {("aa", "aa")}


def test_page_parts(spark):
    rows = [(1, "https://user@M.Example.co:80/a?b", "<HTML class=x LANG='pt-BR'><script>var a='<p>';</script>ol&aacute; <b>x</b><!-- no --></html>"), (2, None, None), (3, "no address", "plain")]
    got = {r.id: r for r in page_evidence(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert (got[1].declared, got[1].suffix, got[1].host, got[1].site) == ("pt", "co", "m.example.co", "example.co")
    assert got[1].text.split() == ["ol&aacute;", "x"]
    assert (got[2].declared, got[2].host, got[2].text) == (None, None, "") and got[3].host is None


def test_empty_tables_and_repeats(spark, model):
    schema = "id bigint, declared string, suffix string, host string, site string, text string"
    assert fuse_evidence(spark.createDataFrame([], schema), model).collect() == []
    rows = spark.createDataFrame([(None, None, None, None, None, "the of and")] * 2, schema)
    assert len(fuse_evidence(rows, model).collect()) == 2
    empty = fit_trigrams(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert empty.languages == ["und"]


def test_rare_languages_are_in_a_bounded_fit(spark):
    rows = [(k, f"the {k} of and", "en") for k in range(400)] + [(1000 + k, f"{k} ska och att", f"r{k}") for k in range(5)] + [(None, "zonder nummer", "nl")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = fit_trigrams(docs, sample_rows=10)
    assert model.languages == ["en", "nl", "r0", "r1", "r2", "r3", "r4"]
    alone, every = (fit_trigrams(docs.where("lang = 'en'"), sample_rows=n) for n in (10, 1000))
    assert (model.weights[:, 0] == alone.weights[:, 0]).all() and (alone.weights != every.weights).any()
    rows = spark.createDataFrame([(1, None, None, None, None, "3 ska och att")], "id bigint, declared string, suffix string, host string, site string, text string")
    assert fuse_evidence(rows, model).first().text_lang == "r3"


def trigram_chances(texts):
    """Smoothed logarithms of the shares of hashed byte trigrams, counted one by one."""
    counts = np.full(1 << 16, 0.5)
    for text in texts:
        data = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
        for k in range(len(data) - 2):
            counts[int.from_bytes(data[k : k + 3], "big") * 0x9E3779B1 % (1 << 32) >> 16] += 1
    return np.log(counts / counts.sum())


def test_fit_recounted(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = fit_trigrams(docs)
    texts = {}
    for r in docs.where("lang is not null and text is not null").collect():
        texts.setdefault(r.lang, []).append(r.text)
    assert model.languages == sorted(texts)
    for k, lang in enumerate(model.languages):
        assert np.allclose(model.weights[:, k], trigram_chances(texts[lang]), atol=1e-5)


def test_dirty_labels_do_not_grow_the_model(spark):
    rows = [(k, f"the {k} of and", "en") for k in range(40)] + [(100 + k, f"{k} ska och att", "sv") for k in range(20)] + [(1000 + k, f"{k} noise", f"junk {k:04}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(6)
    model = fit_trigrams(docs, languages_at_most=3)
    assert model.languages == ["en", "junk 0000", "sv"]
    for k, texts in enumerate(([t for _, t, lang in rows if lang == "en"], ["0 noise"], [t for _, t, lang in rows if lang == "sv"])):
        assert np.allclose(model.weights[:, k], trigram_chances(texts), atol=1e-5)
    assert len(fit_trigrams(docs).languages) == 300
