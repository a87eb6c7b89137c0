"""Language identification by Bayesian fusion of text, declared markup language, address suffix and host."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavemill.llm.common import discard, giving_back, materialise
from wavemill.llm.text import row_groups, utf8

BUCKETS = 1 << 16
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
#: The logarithm of a trigram's chance under uniform noise.
NOISE = -float(np.log(BUCKETS))


def trigram_buckets(data: np.ndarray) -> np.ndarray:
    """Bucket of the byte trigram at each place of ``data`` but the last two, with A-Z read as a-z."""
    folded = _FOLD[data]
    if len(folded) < 3:
        return np.zeros(0, np.int64)
    code = (folded[:-2] << np.uint32(16)) | (folded[1:-1] << np.uint32(8)) | folded[2:]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


@dataclass
class TrigramModel:
    """Log chances of byte trigrams by language: weights[bucket, language]."""

    languages: list[str]
    weights: np.ndarray

    @classmethod
    def of_counts(cls, languages: Sequence[str], counts: np.ndarray, smoothing: float = 0.5) -> TrigramModel:
        counts = counts.astype(np.float64) + smoothing
        return cls(list(languages), np.log(counts / counts.sum(axis=0)).astype(np.float32))

    def likelihoods(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood of each row under each language, and the row's number of trigrams."""
        sums, counts = np.zeros((len(offsets) - 1, len(self.languages))), np.maximum(0, np.diff(offsets) - 2)
        if len(data) > 2:
            buckets = trigram_buckets(data)
            starts, ends = offsets[:-1], offsets[:-1] + counts
            some = np.flatnonzero(counts)
            for k in range(len(self.languages)):
                running = np.concatenate([[0.0], np.cumsum(self.weights[:, k][buckets], dtype=np.float64)])
                sums[some, k] = running[ends[some]] - running[starts[some]]
        return sums, counts


def fit_trigrams(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_rows: int = 8000, languages_at_most: int = 300) -> TrigramModel:
    """Fit on up to ``sample_rows`` labelled texts of each language (the first by a hash of their ids, to within a slice of the
    hashes), whole.

    Every language that labels a text is drawn from by itself, so a rare one is in the model at any size of the table. A
    text without an id is drawn by its own hash; texts that share an id are drawn together.
    A column of dirty labels can't outgrow memory: the ``languages_at_most`` labels with the most texts (ties to the first by
    name) are languages, and texts under any other label teach nothing, though they are told apart like all others.
    Counts are grouped by language and bucket on the executors; the driver gets one number for each, less than a megabyte for
    each language.
    """

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for row, lang in enumerate(batch.column(0).to_pylist()):
                total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                total += np.bincount(trigram_buckets(data[offsets[row] : offsets[row + 1]]), minlength=BUCKETS)
        for lang, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(total[some])], ["lang", "bucket", "n"])

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    draw = F.when(F.col(id_col).isNull(), F.xxhash64(F.lit(5), F.col(text_col))).otherwise(F.xxhash64(F.lit(5), F.col(id_col)))
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), draw.alias("draw"))
    # of a language with more texts, draws up to about twice as many as wanted are counted in 1,024 slices, and as many whole
    # slices are taken as fit, one at least; no task orders a language's rows
    share = F.least(F.lit(1.0), (2.0 * sample_rows + 100) / F.col("n"))
    shares = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages_at_most)
    shares = materialise(shares.select("lang", share.alias("share")), "languages")
    drawn = rows.select("lang", "draw").join(F.broadcast(shares), "lang")
    slice_ = F.floor((F.col("draw") / 2.0**64 + 0.5) / F.col("share") * 1024)
    counts = drawn.withColumn("slice", slice_).where("slice <= 1024").groupBy("lang", "slice").agg(F.count(F.lit(1)).alias("k"), F.max("draw").alias("top"))
    upto = F.sum("k").over(Window.partitionBy("lang").orderBy("slice"))
    counts = counts.withColumns({"upto": upto, "first": F.row_number().over(Window.partitionBy("lang").orderBy("slice")) == 1})
    last = materialise(counts.where((F.col("upto") <= sample_rows) | F.col("first")).groupBy("lang").agg(F.max("top").alias("last")), "drawn")
    sample = rows.join(F.broadcast(last), "lang").where("draw <= last").select("lang", "text")
    found = sample.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = found.groupBy("lang").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("numbers")).toArrow().sort_by("lang")
    discard(last, shares)
    languages = found["lang"].to_pylist() or ["und"]
    counts = np.zeros((BUCKETS, len(languages)))
    for k in range(found.num_rows):
        counts[np.asarray(found["buckets"][k].values), k] = np.asarray(found["numbers"][k].values)
    return TrigramModel.of_counts(languages, counts)


def text_evidence(rows: DataFrame, model: TrigramModel) -> DataFrame:
    """``rows`` (id, text, and others) with ``text`` replaced by logs array<double>, in the model's order, and grams bigint."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    others = [c for c in rows.columns if c != "text"]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others)

    @giving_back
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(batch.num_columns - 1))
            for low, high in row_groups(offsets):
                logs, grams = shared.value.likelihoods(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(high - low + 1) * logs.shape[1], pa.int32()), pa.array(logs.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(low, high - low) for k in range(len(others))), lists, pa.array(grams.astype(np.int64))], [*others, "logs", "grams"])

    return rows.select(*others, "text").mapInArrow(score, f"{kinds}, logs array<double>, grams bigint")


def _softmax(logs: Column) -> Column:
    raised = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def fuse_evidence(rows: DataFrame, model: TrigramModel, *, grams_at_most: int = 60, host_weight: float = 4.0, site_weight: float = 20.0, smoothing: float = 1.0) -> DataFrame:
    """The most probable language of each row of (id, declared, suffix, host, site, text).

    Returns id, lang, probability double, text_lang, per_gram double (the text's mean log likelihood under ``lang``'s
    trigrams; null without text), declared, suffix, host. Evidence is added as logarithms: the text's likelihoods, tempered as
    if it had at most ``grams_at_most`` trigrams, since neighbouring trigrams aren't independent; the chance of the declared
    language and of the address suffix given each language, from counts of all rows by what their texts say; and the
    prior of the host, which shrinks to its site's by ``host_weight`` rows and that to the whole's by ``site_weight``, a row's
    own text left out. Every count is a grouped aggregate with map-side partial sums, joined back: broadcast by Spark while it is
    small, else by a shuffle in which AQE splits a host that many rows share, and rows without one are dealt out evenly.

    A null value is no evidence; a row without any gets the overall prior. Ties go to the first language by name. A very long
    text is read whole in one task. Repeated rows are kept, a null id stays, an empty table gives no rows, other columns are
    left out.
    """
    names = model.languages
    scored = text_evidence(rows.select("id", "declared", "suffix", "host", "site", "text"), model)
    temper = F.least(F.lit(float(grams_at_most)), F.col("grams")) / F.greatest(F.col("grams"), F.lit(1))
    scored = scored.withColumn("text_logs", F.transform("logs", lambda x: x * temper)).withColumn("p", _softmax(F.col("text_logs")))
    scored = materialise(scored, "text-evidence")
    whole = [F.sum(F.element_at("p", k + 1)).alias(f"n{k}") for k in range(len(names))]
    packed = F.array(*(F.col(f"n{k}") for k in range(len(names))))
    counts = lambda key: scored.where(F.col(key).isNotNull()).groupBy(key).agg(*whole).select(key, packed.alias(f"{key}_n"))
    total = scored.agg(*whole, F.count(F.lit(1)).alias("rows")).first()
    sums = np.array([total[f"n{k}"] or 0.0 for k in range(len(names))]) + smoothing
    prior = F.array(*(F.lit(float(x)) for x in sums / sums.sum()))
    by_lang = F.array(*(F.lit(float(x)) for x in sums))
    out = scored
    for key in ("declared", "suffix", "site", "host"):
        # rows without a value are dealt out by themselves and meet nothing
        value = F.coalesce(F.col(key), F.concat(F.lit("\0"), F.pmod(F.xxhash64("id", "logs"), F.lit(4096)).cast("string")))
        out = out.withColumn("value", value).join(counts(key).withColumnRenamed(key, "value"), "value", "left").drop("value")
    # a value's chance given a language, smoothed towards its overall frequency
    given = lambda n: F.when(n.isNotNull(), F.zip_with(n, by_lang, lambda a, b: F.log((a + smoothing / len(names)) / (b + smoothing)))).otherwise(F.transform(prior, lambda _: F.lit(0.0)))
    own = lambda n: F.zip_with(F.coalesce(n, F.col("p")), "p", lambda a, b: F.greatest(F.lit(0.0), a - b))
    size = lambda n: F.aggregate(n, F.lit(0.0), lambda a, b: a + b)
    shrunk = lambda n, to, w: F.zip_with(n, to, lambda a, b: (a + w * b) / (size(n) + w))
    out = out.withColumn("site_own", own(F.col("site_n"))).withColumn("host_own", own(F.col("host_n")))
    out = out.withColumn("site_prior", shrunk(F.col("site_own"), prior, site_weight))
    out = out.withColumn("host_prior", shrunk(F.col("host_own"), F.col("site_prior"), host_weight))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    logs = add(add(F.col("text_logs"), given(F.col("declared_n"))), add(given(F.col("suffix_n")), F.transform("host_prior", lambda x: F.log(x))))
    out = out.withColumn("posterior", _softmax(logs))
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    said = F.array_position("text_logs", F.array_max("text_logs")).cast("int")
    labels = F.array(*(F.lit(x) for x in names))
    return out.select(
        "id",
        F.element_at(labels, best).alias("lang"),
        F.array_max("posterior").alias("probability"),
        F.when(F.col("grams") > 0, F.element_at(labels, said)).alias("text_lang"),
        F.when(F.col("grams") > 0, F.element_at("logs", best) / F.col("grams")).alias("per_gram"),
        "declared",
        "suffix",
        "host",
    )


def code_of(declared: Column) -> Column:
    """The primary subtag of a declared language, in lower case; null if there is none."""
    found = F.regexp_extract(F.lower(F.trim(declared)), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    return F.when(F.length(found) > 0, found)


def page_evidence(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows for :func:`fuse_evidence` from web pages: the text without tags, the html element's lang, and parts of the host."""
    html, url = F.col(html_col), F.col(url_col)
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>", " ")
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    host = F.when(F.length(host) > 0, host)
    return pages.select(
        F.col(id_col).alias("id"),
        code_of(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z_-]+)""", 1)).alias("declared"),
        F.substring_index(host, ".", -1).alias("suffix"),
        host.alias("host"),
        F.substring_index(host, ".", -2).alias("site"),
        F.coalesce(text, F.lit("")).alias("text"),
    )


def document_evidence(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Rows for :func:`fuse_evidence` from documents: the stated language counts as declared, the source as the host."""
    none = F.lit(None).cast("string")
    return docs.select(F.col(id_col).alias("id"), code_of(F.col(lang_col)).alias("declared"), none.alias("suffix"), F.col(source_col).alias("host"), none.alias("site"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
