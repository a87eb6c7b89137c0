"""Toxicity by a convolutional text classifier, trained in numpy, with thresholds by language."""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavemill.llm.common import discard, giving_back, materialise, small_batches
from wavemill.llm.langid import TrigramModel, fit_trigrams
from wavemill.llm.text import NON_LETTERS, row_groups, utf8, word_bounds, word_hashes

#: Hashed embeddings of a word: of the whole word and of its first four and five bytes.
HEADS = (1 << 20, 4, 5)
ROWS = 1 << 15
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1
#: Words that the filters pass over at once.
SEGMENT = 1 << 17
#: Labelled documents of a task in training, about.
SHARD = 20_000
#: Labels that are broadcast at most; more meet their documents by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Rows of embeddings that are averaged together.
BLOCK = 1 << 12


def word_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of the words of each text, and the texts' offsets.

    ``ROWS`` marks padding: each text is followed by ``PAD`` of it, so no filter reads from one text into the next.
    """
    starts, ends, at = word_bounds(data, offsets, NON_LETTERS)
    texts = len(offsets) - 1
    place = np.arange(len(starts)) + PAD * np.repeat(np.arange(texts), np.diff(at))
    rows = np.full((len(HEADS), len(starts) + PAD * texts), ROWS, np.int32)
    for k, head in enumerate(HEADS):
        rows[k, place] = word_hashes(data, starts, np.minimum(ends, starts + head)) >> np.uint64(49)
    return rows, at + PAD * np.arange(texts + 1)


@dataclass
class ConvolutionalClassifier:
    """Sum of hashed word embeddings, filters of several widths, the maximum of each over the text, and a logistic layer."""

    size: int = 8
    filters: int = 8
    seed: int = 11
    embeddings: np.ndarray = field(init=False)
    kernels: list[np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        self.embeddings = rng.normal(0, 0.02, (len(HEADS), ROWS + 1, self.size)).astype(np.float32)
        self.embeddings[:, ROWS] = 0
        self.kernels = [rng.normal(0, 0.5, (w, self.size, self.filters)).astype(np.float32) for w in WIDTHS]
        self.shifts = np.zeros(len(WIDTHS) * self.filters, np.float32)
        self.weights = rng.normal(0.3, 0.1, len(WIDTHS) * self.filters).astype(np.float32)
        self.bias = np.float32(-1)

    def _words(self, rows: np.ndarray) -> np.ndarray:
        out = self.embeddings[0][rows[0]]
        for k in range(1, len(HEADS)):
            out += self.embeddings[k][rows[k]]
        return out

    def _maps(self, words: np.ndarray, pads: np.ndarray) -> list[np.ndarray]:
        maps = []
        for kernel in self.kernels:
            out = words @ kernel[0]
            for j in range(1, len(kernel)):
                out[:-j] += words[j:] @ kernel[j]
            out[pads] = -1e9
            maps.append(out)
        return maps

    def pooled(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The highest value of each filter in each text."""
        maps = self._maps(self._words(rows), rows[0] == ROWS)
        return np.concatenate([np.maximum.reduceat(m, at[:-1], axis=0) for m in maps], axis=1)

    def logits(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """One for each text; a text of over ``SEGMENT`` words is pooled in segments that overlap by the widest filter."""
        found = np.zeros((len(at) - 1, len(WIDTHS) * self.filters), self.embeddings.dtype)
        sizes, text = np.diff(at), 0
        while text < len(sizes):
            end = text + 1
            if sizes[text] <= SEGMENT:
                end = max(end, int(np.searchsorted(at, at[text] + SEGMENT, "right")) - 1)
                found[text:end] = self.pooled(rows[:, at[text] : at[end]], at[text : end + 1] - at[text])
            else:
                found[text] = -1e9
                for low in range(int(at[text]), int(at[end]) - PAD, SEGMENT):
                    part = rows[:, low : min(low + SEGMENT + PAD, at[end])]
                    # the last places lack the words after them; they come first in the next segment
                    tops = [m[:-PAD].max(axis=0) for m in self._maps(self._words(part), part[0] == ROWS)]
                    found[text] = np.maximum(found[text], np.concatenate(tops))
            text = end
        return np.maximum(found + self.shifts, 0) @ self.weights + self.bias

    def gradients(self, own: np.ndarray, bounds: np.ndarray, labels: np.ndarray, weigh: np.ndarray) -> tuple[float, list[np.ndarray], float, np.ndarray]:
        """Mean weighed logistic loss of some texts, and its gradients by kernels, shifts and weights, by the bias, and by the
        sum of embeddings of each word."""
        words = self._words(own)
        maps = self._maps(words, own[0] == ROWS)
        tops = [np.stack([m[a:b].argmax(axis=0) + a for a, b in zip(bounds[:-1], bounds[1:], strict=True)]) for m in maps]
        raw = np.concatenate([np.take_along_axis(m, t, axis=0) for m, t in zip(maps, tops, strict=True)], axis=1) + self.shifts
        pooled = np.maximum(raw, 0)
        chance = 1 / (1 + np.exp(-np.clip(pooled @ self.weights + self.bias, -30, 30)))
        loss = -float((weigh * np.where(labels == 1, np.log(chance), np.log1p(-chance))).mean())
        error = ((chance - labels) * weigh / len(labels)).astype(self.embeddings.dtype)
        back = error[:, None] * self.weights * (raw > 0)
        dense = [np.zeros_like(k) for k in self.kernels] + [back.sum(axis=0), pooled.T @ error]
        by_word = np.zeros_like(words)
        for w, kernel in enumerate(self.kernels):
            grad = back[:, w * self.filters : (w + 1) * self.filters]
            for j in range(len(kernel)):
                place = np.minimum(tops[w] + j, len(words) - 1)
                dense[w][j] = np.einsum("dfe,df->ef", words[place], grad)
                np.add.at(by_word, place.ravel(), (grad[:, :, None] * kernel[j].T[None]).reshape(-1, self.size))
        return loss, dense, float(error.sum()), by_word


@dataclass
class Training:
    """A classifier, and for each of its numbers the sum of squared gradients by which Adagrad scales its steps.

    Only embeddings that aren't as the seed drew them are pickled.
    """

    model: ConvolutionalClassifier
    rate: float = 0.1

    def __post_init__(self) -> None:
        self.dense = [*self.model.kernels, self.model.shifts, self.model.weights]
        self.seen = [np.full_like(x, 1e-6) for x in self.dense]
        self.seen_rows, self.seen_bias = np.full(self.model.embeddings.shape, 1e-6, np.float32), 1e-6

    def __getstate__(self) -> tuple:
        kind, rows = (self.model.size, self.model.filters, self.model.seed), self.rows()
        place = np.flatnonzero((rows != Training(ConvolutionalClassifier(*kind)).rows()).any(axis=1)).astype(np.int32)
        return kind, self.rate, self.numbers(), place, rows[place]

    def __setstate__(self, state: tuple) -> None:
        kind, rate, numbers, place, rows = state
        self.__init__(ConvolutionalClassifier(*kind), rate)
        self.put(numbers)
        self.model.embeddings.reshape(-1, self.model.size)[place] = rows[:, : self.model.size]
        self.seen_rows.reshape(-1, self.model.size)[place] = rows[:, self.model.size :]

    def step(self, own: np.ndarray, bounds: np.ndarray, labels: np.ndarray, weigh: np.ndarray) -> None:
        """One step of Adagrad on the logistic loss of some texts."""
        _, steps, by_bias, by_word = self.model.gradients(own, bounds, labels, weigh)
        for value, total, step in zip(self.dense, self.seen, steps, strict=True):
            total += step * step
            value -= self.rate * step / np.sqrt(total)
        self.seen_bias += by_bias**2
        self.model.bias -= np.float32(self.rate * by_bias / np.sqrt(self.seen_bias))
        touched = np.flatnonzero(np.abs(by_word).sum(axis=1) * (own[0] != ROWS))
        for k in range(len(HEADS)):
            unique, inverse = np.unique(own[k, touched], return_inverse=True)
            step = np.zeros((len(unique), self.model.size), np.float32)
            np.add.at(step, inverse, by_word[touched])
            self.seen_rows[k, unique] += step * step
            self.model.embeddings[k, unique] -= self.rate * step / np.sqrt(self.seen_rows[k, unique])

    def numbers(self) -> np.ndarray:
        """All but the embeddings and theirs, in one row."""
        return np.concatenate([*(x.ravel() for x in (*self.dense, *self.seen)), [self.model.bias, self.seen_bias]])

    def put(self, numbers: np.ndarray) -> None:
        """The reverse of :meth:`numbers`."""
        at = 0
        for x in (*self.dense, *self.seen):
            x[...] = numbers[at : at + x.size].reshape(x.shape)
            at += x.size
        self.model.bias, self.seen_bias = np.float32(numbers[at]), float(numbers[at + 1])

    def rows(self) -> np.ndarray:
        """A row for each embedding: the embedding, and its sums of squares."""
        return np.concatenate([self.model.embeddings, self.seen_rows], axis=2).reshape(-1, 2 * self.model.size)

    def move(self, block: int, place: np.ndarray, change: np.ndarray) -> None:
        """Add ``change`` at ``place`` of the rows, or of the numbers if ``block`` is negative."""
        if block < 0:
            self.put(self.numbers() + change)
        else:
            change, size = change.reshape(len(place), -1), self.model.size
            self.model.embeddings.reshape(-1, size)[place] += change[:, :size]
            self.seen_rows.reshape(-1, size)[place] += change[:, size:]


@dataclass
class ToxicityModel:
    """The classifier, a language model of texts, and the logit at which each language's texts count as toxic."""

    classifier: ConvolutionalClassifier
    languages: TrigramModel
    thresholds: np.ndarray

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        logits = self.classifier.logits(*word_rows(data, offsets)).astype(np.float64)
        language = self.languages.likelihoods(data, offsets)[0].argmax(axis=1)
        return 1 / (1 + np.exp(-np.clip(logits - self.thresholds[language], -700, 700)))


def _best_threshold(low: np.ndarray, high: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """Middle of the gap between two bins of logits that gives the fewest errors, weighed so that both labels count alike; the
    widest such gap. A bin has its lowest and highest logit and the numbers of both labels."""
    order = np.argsort(low, kind="stable")
    low, high, toxic, clean = low[order], high[order], toxic[order], clean[order]
    missed = np.concatenate([[0], np.cumsum(toxic)]) / max(1, toxic.sum())
    false = (clean.sum() - np.concatenate([[0], np.cumsum(clean)])) / max(1, clean.sum())
    gaps = np.concatenate([[0.0], low[1:] - high[:-1], [0.0]])
    k = int(np.lexsort((-gaps, missed + false))[0])
    return float((np.concatenate([[low[0] - 1], high])[k] + np.concatenate([low, [high[-1] + 1]])[k]) / 2)


def _packed(rows: np.ndarray) -> bytes:
    """The embedding rows of a text's words, word by word and compressed, since words recur; the length comes first."""
    words = np.ascontiguousarray(rows.T).tobytes()
    return np.int64(len(words)).tobytes() + pa.compress(words, codec="zstd", asbytes=True)


def _unpacked(words: bytes) -> np.ndarray:
    size = int(np.frombuffer(words, np.int64, 1)[0])
    return np.frombuffer(pa.decompress(words[8:], size, codec="zstd", asbytes=True), np.uint16).reshape(-1, len(HEADS)).T


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Embedding rows, offsets, labels and languages of batches of toxic, spoken, words."""
    for batch in batches:
        parts = [_unpacked(x) for x in batch.column(2).to_pylist()]
        if parts:
            at = np.concatenate([[0], np.cumsum([x.shape[1] for x in parts])]).astype(np.int64)
            yield np.concatenate(parts, axis=1).astype(np.int32), at, np.asarray(batch.column(0)).astype(np.int64), np.asarray(batch.column(1)).astype(np.int64)


def train(rows: DataFrame, model: ConvolutionalClassifier, shards: int, rounds: int = 8, least_steps: int = 400, batch: int = 64) -> None:
    """Adagrad on the logistic loss over all of ``rows`` (toxic, spoken, words), the rarer label weighed up to half of all.

    Each round every partition of ``rows`` starts from the same state, takes steps of ``batch`` texts over all its own, and
    gives what it changed; the next state is the mean over the partitions that changed a number, by their texts. Partitions
    are streamed; only where there are so few texts that a round takes several passes, for ``least_steps``, are they held.
    Changes are averaged in blocks on the executors, so the driver gets one state a round (6 MB), however many partitions.
    """
    spark = rows.sparkSession
    counts = dict(rows.groupBy("toxic").agg(F.count(F.lit(1))).collect())
    n = sum(counts.values())
    if not n:
        return
    weights = np.array([n / (2 * max(1, counts.get(k, 0))) for k in (0, 1)])
    passes = max(1, -(-least_steps * batch * shards // (rounds * n)))
    state, seed = Training(model), model.seed
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(state)

        @giving_back
        def learn(batches: Iterator[pa.RecordBatch], shared=shared, k=k) -> Iterator[pa.RecordBatch]:
            own, texts, shard = copy.deepcopy(shared.value), 0, TaskContext.get().partitionId()
            if passes > 1:
                held = list(batches)
                batches = pa.Table.from_batches(held).combine_chunks().to_batches() * passes if held else []
            for j, (words, at, toxic, _) in enumerate(_texts(batches)):
                texts += len(toxic)
                order = np.random.default_rng([seed, k, j]).permutation(len(toxic))
                for first in range(0, len(order), batch):
                    some = order[first : first + batch]
                    picked = np.concatenate([np.arange(at[d], at[d + 1]) for d in some])
                    own.step(words[:, picked], np.concatenate([[0], np.cumsum(at[some + 1] - at[some])]), toxic[some], weights[toxic[some]])
            if not texts:
                return
            before, after = shared.value.rows(), own.rows()
            place = np.flatnonzero((before != after).any(axis=1)).astype(np.int32)
            change, cuts = after[place] - before[place], np.flatnonzero(np.diff(place // BLOCK)) + 1
            parts = [(int(p[0]) // BLOCK, p, c) for p, c in zip(np.split(place, cuts), np.split(change, cuts), strict=True) if len(p)]
            numbers = own.numbers() - shared.value.numbers()
            parts.append((-1, np.arange(len(numbers), dtype=np.int32), numbers.astype(np.float32)))
            for block, p, c in parts:
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([shard], pa.int32()), pa.array([texts], pa.int64()), pa.array([p.tobytes()]), pa.array([c.tobytes()])], ["block", "shard", "texts", "place", "change"])

        with small_batches(spark):
            changes = rows.select("toxic", "spoken", "words").mapInArrow(learn, "block int, shard int, texts bigint, place binary, change binary")
            for row in changes.groupBy("block").applyInArrow(_mean_change, "block int, place binary, change binary").collect():
                state.move(row["block"], np.frombuffer(row["place"], np.int32), np.frombuffer(row["change"], np.float32))
        shared.destroy()


def _mean_change(parts: pa.Table) -> pa.Table:
    """One row of the changes of a block: the mean, by texts, over the shards that changed a place, in the order of shards."""
    parts = parts.sort_by("shard")
    places = [np.frombuffer(x, np.int32) for x in parts["place"].to_pylist()]
    every = np.unique(np.concatenate(places))
    total, weight = 0.0, np.zeros(len(every))
    for place, change, texts in zip(places, parts["change"].to_pylist(), parts["texts"].to_pylist(), strict=True):
        change, at = np.frombuffer(change, np.float32).reshape(len(place), -1), np.searchsorted(every, place)
        if isinstance(total, float):
            total = np.zeros((len(every), change.shape[1]))
        total[at] += texts * change
        weight[at] += texts
    mean = (total / weight[:, None]).astype(np.float32)
    return pa.table({"block": parts["block"][:1], "place": pa.array([every.tobytes()]), "change": pa.array([mean.tobytes()])})


def fit_thresholds(rows: DataFrame, model: ConvolutionalClassifier, languages: int) -> np.ndarray:
    """By language, the logit that best parts the labels of ``rows`` (toxic, spoken, words).

    Logits are counted in bins of 1 / 1,024, none of which is cut. A language without ten texts of each label gets that of all
    rows together, and that is 0 if they have one label only.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @giving_back
    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, at, toxic, spoken in _texts(batches):
            yield pa.RecordBatch.from_arrays([pa.array(spoken), pa.array(toxic), pa.array(shared.value.logits(words, at).astype(np.float64))], ["spoken", "toxic", "logit"])

    def best(bins: pa.Table) -> pa.Table:
        low, high, toxic, n = (bins[c].to_numpy() for c in ("low", "high", "toxic", "n"))
        return pa.table({"spoken": bins["spoken"][:1], "threshold": pa.array([_best_threshold(low, high, toxic, n - toxic)]), "toxic": pa.array([toxic.sum()], pa.int64()), "clean": pa.array([(n - toxic).sum()], pa.int64())})

    with small_batches(rows.sparkSession):
        found = rows.select("toxic", "spoken", "words").mapInArrow(logits, "spoken bigint, toxic bigint, logit double")
        found = found.select(F.explode(F.array(F.lit(-1).cast("long"), F.col("spoken"))).alias("spoken"), "toxic", "logit", F.floor(F.col("logit") * 1024).alias("bin"))
        bins = found.groupBy("spoken", "bin").agg(F.min("logit").alias("low"), F.max("logit").alias("high"), F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
        by_language = {r["spoken"]: r for r in bins.groupBy("spoken").applyInArrow(best, "spoken bigint, threshold double, toxic bigint, clean bigint").collect()}
    fit = lambda k, least: k in by_language and min(by_language[k]["toxic"], by_language[k]["clean"]) >= least
    overall = by_language[-1]["threshold"] if fit(-1, 1) else 0.0
    return np.array([by_language[k]["threshold"] if fit(k, 10) else overall for k in range(languages)])


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", toxic_col: str = "toxic", sample_rows: int | None = None) -> ToxicityModel:
    """Fit on all labelled documents whose crc32 of the id as text isn't divisible by 5, whole texts.

    Executors turn texts into the places of their words' embeddings (6 bytes a word, compressed) and their languages, and train on them in
    shards of about ``SHARD`` documents (:func:`train`), by a hash of their ids; the driver gets states of a fixed size and
    counts only. One document in five, by another hash, is kept out of that and sets the thresholds. ``lang`` only names the
    texts from which languages are learned; a score never sees it. An id with several labels counts as toxic if any says so; of
    several texts of an id one is taken, the first by its words. Documents or labels with a null id, and null labels, are left
    out, and so are labels of documents that aren't there: however many they are, they change nothing. Without labels of both
    kinds all scores are those of the untrained classifier. Who wants a fit on less gives ``sample_rows``: that many documents of
    each label, the first by a hash.
    """
    known = labels.where(F.col(toxic_col).isNotNull() & (F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) != 0))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(toxic_col).alias("toxic")).where("toxic in (0, 1)")
    if sample_rows is not None:
        known = known.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
        draw = F.xxhash64(F.lit(7), F.col("id"))
        known = known.where("toxic = 1").orderBy(draw).limit(sample_rows).unionByName(known.where("toxic = 0").orderBy(draw).limit(sample_rows))
    known = drawn = materialise(known, "toxic-labels")
    if drawn.count() <= BROADCAST_ROWS:
        known = F.broadcast(drawn)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).alias("lang"))
    sample = materialise(texts.join(known, "id").select("id", "text", "lang", F.col("toxic").cast("int").alias("toxic")), "toxic-sample")
    discard(drawn)
    rows, ids = sample.agg(F.count(F.lit(1)), F.count_distinct("id")).first()
    languages = fit_trigrams(sample, id_col="id", sample_rows=max(1, rows))
    shared = docs.sparkSession.sparkContext.broadcast(languages)

    @giving_back
    def prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in row_groups(offsets):
                own, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                rows, at = word_rows(own, bounds)
                rows, spoken = rows.astype(np.uint16), shared.value.likelihoods(own, bounds)[0].argmax(axis=1)
                words = [_packed(rows[:, x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(words, pa.binary()), pa.array(spoken.astype(np.int32))], ["id", "toxic", "words", "spoken"])

    kind, shards = sample.schema["id"].dataType.simpleString(), max(1, -(-ids // SHARD))
    ready = sample.select("id", "toxic", "text").mapInArrow(prepared, f"id {kind}, toxic int, words binary, spoken int").repartition(shards, "id")
    ready = ready.groupBy("id").agg(F.min(F.struct("words", "toxic", "spoken")).alias("one")).select("id", "one.*")
    ready = ready.withColumn("held", F.pmod(F.xxhash64(F.lit(13), "id"), F.lit(5)) == 0).sortWithinPartitions(F.xxhash64(F.lit(17), "id"), "id").persist(StorageLevel.DISK_ONLY)
    with small_batches(docs.sparkSession):
        kinds = {r[0] for r in ready.select("toxic").distinct().collect()}
    classifier, thresholds = ConvolutionalClassifier(), np.zeros(len(languages.languages))
    if len(kinds) > 1:
        train(ready.where("not held"), classifier, shards)
        thresholds = fit_thresholds(ready.where("held"), classifier, len(thresholds))
    ready.unpersist()
    discard(sample)
    return ToxicityModel(classifier, languages, thresholds)


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score whole texts: id_col, score double (0 to 1), predicted int (1 from 0.5).

    One row per input row; a null text counts as empty, and an empty one has a score too; repeated rows repeat; null ids stay;
    an empty table gives no rows; other columns are left out. A score of exactly 0.5 predicts 1. A very long text is read in one
    task, and pooled in segments. The model (4 MB, fixed) is broadcast; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @giving_back
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            found = [shared.value.scores(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in row_groups(offsets)]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["id", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(score, f"`{id_col}` {kind}, score double, predicted int")
