import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wavemill.llm import toxicity
from wavemill.llm.langid import fit_trigrams
from wavemill.llm.text import utf8
from wavemill.llm.toxicity import HEADS, PAD, ROWS, WIDTHS, ConvolutionalClassifier, ToxicityModel, fit_toxicity, score_toxicity, word_rows

WORDS = [f"{a}{b}" for a in ("ba", "ko", "mi", "tu", "re", "so") for b in ("lan", "ter", "von", "dis", "pel")]


def made(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(5, 80))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["grubbish", "Zornig,", "zornigly"]))
        rows.append((k, " ".join(words), rng.choice(["aa", "bb"]), toxic))
    return rows


def test_held_out_accuracy(spark):
    rows = made(900, 1)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id bigint, toxic int")
    model = fit_toxicity(docs, labels)
    got = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(got[r[0]].predicted == r[3] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_labels_of_held_out_documents_are_not_read(spark):
    rows = made(200, 2)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    flip = lambda r: 1 - r[3] if zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[3]
    one, two = (fit_toxicity(docs, spark.createDataFrame([(r[0], f(r)) for r in rows], "doc_id bigint, toxic int")) for f in (lambda r: r[3], flip))
    assert np.array_equal(one.classifier.embeddings, two.classifier.embeddings) and np.array_equal(one.thresholds, two.thresholds)


def test_texts_do_not_reach_into_one_another():
    model = ConvolutionalClassifier()
    model.embeddings[:, :-1] = np.random.default_rng(1).normal(0, 1, (3, model.embeddings.shape[1] - 1, 8))
    texts = ["alpha beta gamma", "", "delta", "epsilon zeta", "   "]
    together = model.logits(*word_rows(*utf8(pa.array(texts))))
    apart = [model.logits(*word_rows(*utf8(pa.array([t]))))[0] for t in texts]
    assert together == pytest.approx(apart, abs=1e-5)


def slow_logit(model, text):
    """The forward pass of one text, word by word."""
    words = re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text)
    column, best = [], np.full(len(WIDTHS) * model.filters, -1e9)
    for word in words:
        rows, _ = word_rows(*utf8(pa.array([word])))
        column.append(sum(model.embeddings[k][rows[k, 0]] for k in range(len(HEADS))))
    column += [np.zeros(model.size)] * PAD
    for place in range(len(words)):
        for w, kernel in enumerate(model.kernels):
            value = sum(column[place + j] @ kernel[j] for j in range(len(kernel)))
            own = slice(w * model.filters, (w + 1) * model.filters)
            best[own] = np.maximum(best[own], value)
    return float(np.maximum(best + model.shifts, 0) @ model.weights + model.bias)


def drawn(seed=1):
    model, rng = ConvolutionalClassifier(size=3, filters=2), np.random.default_rng(seed)
    model.embeddings = rng.normal(0, 1, model.embeddings.shape)
    model.embeddings[:, ROWS] = 0
    model.kernels = [k.astype(np.float64) for k in model.kernels]
    model.shifts, model.weights = rng.normal(0, 0.3, 6), rng.normal(0, 1, 6)
    return model


@pytest.mark.parametrize("segment", [1 << 17, 5, 2])
def test_forward_pass_word_by_word(monkeypatch, segment):
    monkeypatch.setattr(toxicity, "SEGMENT", segment)
    model = drawn()
    texts = ["alpha beta gamma", "", "one", " ".join(f"w{k}" for k in range(40)), "a-b c;d", "  ", "x y z u v w"]
    got = model.logits(*word_rows(*utf8(pa.array(texts))))
    assert got == pytest.approx([slow_logit(model, t) for t in texts], abs=1e-9)


def test_gradients_against_differences():
    model = drawn(3)
    rows, at = word_rows(*utf8(pa.array(["alpha beta gamma alpha", "delta", "beta zeta eta theta iota", "kappa alpha"])))
    labels, weigh = np.array([1, 0, 1, 0]), np.array([1.5, 0.5, 1.5, 0.5])
    loss = lambda: model.gradients(rows, at, labels, weigh)[0]
    _, dense, by_bias, by_word = model.gradients(rows, at, labels, weigh)

    def slope(values, place, step=1e-6):
        before = values[place]
        values[place] = before + step
        high = loss()
        values[place] = before - step
        low = loss()
        values[place] = before
        return (high - low) / (2 * step)

    for values, grads in zip([*model.kernels, model.shifts, model.weights], dense, strict=True):
        for place in np.ndindex(values.shape):
            assert slope(values, place) == pytest.approx(grads[place], abs=1e-6)
    bias = np.array([model.bias], np.float64)
    model.bias = bias[0]
    step = 1e-6
    model.bias += step
    high = loss()
    model.bias -= 2 * step
    assert (high - loss()) / (2 * step) == pytest.approx(by_bias, abs=1e-6)
    model.bias += step
    for head in range(len(HEADS)):
        for row in np.unique(rows[head][rows[0] != ROWS]):
            for e in range(model.size):
                assert slope(model.embeddings[head], (row, e)) == pytest.approx(by_word[rows[head] == row, e].sum(), abs=1e-6)


def test_a_score_at_the_threshold_is_toxic(spark):
    classifier, languages = ConvolutionalClassifier(), fit_trigrams(spark.createDataFrame([(1, "abc", "aa")], "doc_id bigint, text string, lang string"))
    logit = float(classifier.logits(*word_rows(*utf8(pa.array(["some words"]))))[0])
    model = ToxicityModel(classifier, languages, np.array([logit]))
    row = score_toxicity(spark.createDataFrame([(1, "some words")], "doc_id bigint, text string"), model).first()
    assert (row.score, row.predicted) == (0.5, 1)


def test_nulls_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, "aa", 0.1), (None, "x", "aa", 0.2), (1, "", None, 0.3), (2, "word " * 50_000, "aa", 0.4)], "doc_id bigint, text string, lang string, score double")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = fit_toxicity(docs, none)
    rows = score_toxicity(docs, model).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert score_toxicity(docs.limit(0), model).collect() == []


def test_labels_of_absent_documents_change_nothing(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    foreign = spark.range(10**6, 10**6 + 1000 * labels.count()).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    one, two = fit_toxicity(docs, labels), fit_toxicity(docs, labels.select("doc_id", "toxic").unionByName(foreign.withColumn("toxic", F.col("toxic").cast(labels.schema["toxic"].dataType))))
    assert sorted(map(tuple, score_toxicity(docs, one).collect())) == sorted(map(tuple, score_toxicity(docs, two).collect()))


def test_rows_that_share_an_id_are_one_in_the_sample(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    again = docs.unionByName(docs.where("doc_id < 40")).unionByName(docs.where("doc_id < 40"))
    one, two = fit_toxicity(docs, labels, sample_rows=50), fit_toxicity(again, labels, sample_rows=50)
    assert (one.classifier.kernels[0] == two.classifier.kernels[0]).all() and one.classifier.bias == two.classifier.bias


def test_all_labelled_documents_are_learned_from(spark):
    """A toxic word that only documents beyond the first 3,000 of a label hold."""
    n = 7600
    draw = spark.range(n).select("id", F.xxhash64(F.lit(7), "id").alias("draw"), (F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5)) != 0).alias("known")).orderBy("draw").collect()
    toxic = [r.id for r in draw if r.id % 2 and r.known]
    assert len(toxic) > 3010
    late = set(toxic[3000:])
    docs = [(k, f"ba ko {'mi' if k % 2 == 0 else 'zornig' if k in late else 'grubbish'} tu", "aa") for k in range(n)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    model = fit_toxicity(frame, spark.createDataFrame([(k, k % 2) for k in range(n)], "doc_id bigint, toxic int"))
    assert score_toxicity(spark.createDataFrame([(1, "ba zornig tu")], "doc_id bigint, text string"), model).first().predicted == 1


def test_several_shards_learn_as_one(spark, monkeypatch):
    rows = made(1500, 5)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id bigint, toxic int")
    monkeypatch.setattr(toxicity, "SHARD", 300)
    one, two = fit_toxicity(docs, labels), fit_toxicity(docs.repartition(7), labels)
    assert np.array_equal(one.classifier.embeddings, two.classifier.embeddings) and np.array_equal(one.thresholds, two.thresholds)
    got = {r.doc_id: r.predicted for r in score_toxicity(docs, one).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(got[r[0]] == r[3] for r in held) >= 0.97 * len(held)


def test_changes_are_averaged_over_the_shards_that_have_them():
    part = lambda shard, texts, place, change: {"block": 0, "shard": shard, "texts": texts, "place": np.array(place, np.int32).tobytes(), "change": np.array(change, np.float32).tobytes()}
    mean = toxicity._mean_change(pa.Table.from_pylist([part(1, 30, [4, 9], [1, 2]), part(0, 10, [9], [6])])).to_pylist()
    assert len(mean) == 1 and np.frombuffer(mean[0]["place"], np.int32).tolist() == [4, 9] and np.frombuffer(mean[0]["change"], np.float32).tolist() == [1, 3]
