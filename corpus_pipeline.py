"""From raw documents to encoded training text, in stages that each read what the one before wrote.

Language ID and toxicity reject documents, the n-gram Jaccard join keeps one of each group of near copies, the mix takes each
source to its target weight, repeating documents where it must, and byte-level BPE encodes what is left. All stages but
the last return the columns of ``documents``; columns may have any other names beside them. Verdicts are on rows: rows with
equal ids but different texts, and rows without an id, are judged each by itself. Every stage takes an empty table, and
returns none of its rows twice, but for the copies that the mix takes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemill.llm.bpe import bpe_digest
from wavemill.llm.common import discard, materialise
from wavemill.llm.jaccard import jaccard_components
from wavemill.llm.langid import NOISE, document_evidence, fit_trigrams, fuse_evidence
from wavemill.llm.mixing import mix_documents
from wavemill.llm.queries import MULTI_RANKS
from wavemill.llm.toxicity import fit_toxicity, score_toxicity

#: Rejected rows of this number at most are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def _keyed(docs: DataFrame) -> DataFrame:
    """doc, a struct of a row's own columns, and key, a text of its id and a hash of what it is judged by; equal rows share one."""
    judged = F.xxhash64("text", F.col("lang"), F.col("source"))
    return docs.select(F.struct("*").alias("doc"), F.concat_ws("|", F.col("doc_id").cast("string"), judged.cast("string")).alias("key"))


def _without(docs: DataFrame, verdicts: DataFrame, rejected: Column) -> DataFrame:
    """The rows of ``docs`` but those whose verdict (key, ...) is ``rejected``."""
    # grouped by key before it is filtered: a filter on a verdict would evaluate all that leads to it once for each mention
    judged = verdicts.groupBy(F.col("key").alias("gone")).agg(F.min(F.coalesce(rejected, F.lit(False))).alias("bad"))
    gone = materialise(judged.where("bad").select("gone"), "rejected")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return _keyed(docs).join(gone, F.col("key") == F.col("gone"), "left_anti").select("doc.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of no language: without text but white space (a null text too), of no probable language (below a half),
    or likelier noise than any language.

    Texts too short for a trigram are judged by their other evidence. Null languages and sources are no evidence; ties go to
    the first language by name. The fit takes the first texts of each language by a hash, and leaves ids as they are.
    """
    docs = docs.where(F.coalesce(F.col("text").rlike(r"\S"), F.lit(False)))
    model = fit_trigrams(docs)
    rows = _keyed(docs).select("key", "doc.text", "doc.lang", "doc.source")
    found = fuse_evidence(document_evidence(rows, id_col="key"), model).withColumnRenamed("id", "key")
    return _without(docs, found, (F.col("per_gram") < NOISE) | (F.col("probability") < 0.5))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier, learned from the labelled ones of them, takes for toxic: of a score of 0.5 or more.

    A null text is scored as an empty one. Without labels of both kinds the untrained classifier decides, which rejects
    nothing. Labels are read from ``sf_dir``.
    """
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = _keyed(docs).select("key", "doc.text")
    return _without(docs, score_toxicity(rows, model, id_col="key"), F.col("predicted") == 1)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group at a Jaccard similarity of 0.8 on five words: that of the smallest id.

    Documents without words are alone. Where ids repeat or are null, rows are told apart by a hash of id and text, rows with
    the same are one, and the one kept of a group has the smallest id that isn't null, and of equal ids the smallest row.
    """
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
    if odd.isEmpty():
        parts = jaccard_components(docs.select("doc_id", "text"), words=5, percent=80).where(F.col("component_id") != F.col("doc_id"))
        gone = materialise(parts.select(F.col("doc_id").alias("gone")), "rejected")
        gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
        rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("key"))
        return rows.join(gone, F.col("key") == F.col("gone"), "left_anti").select("doc.*")
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64("doc_id", "text").alias("key"), "text", F.struct(F.col("doc_id").isNull(), F.col("doc_id")).alias("place"))
    parts = jaccard_components(rows.select("key", "text"), words=5, percent=80, id_col="key", text_col="text").select(F.col("key").alias("member"), "component_id").distinct()
    first = rows.join(parts, F.col("key") == F.col("member")).groupBy("component_id").agg(F.min(F.struct("place", "key"))["key"].alias("kept"))
    kept = rows.join(first.select("kept"), F.col("key") == F.col("kept"), "left_semi")
    return kept.groupBy("key").agg(F.min("doc").alias("doc")).select("doc.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes sources to their target weights: documents repeat or go as the mix says, in training order.

    A null source is one source, ordered last; documents without words go.
    """
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of each document that is left: doc_id, n_tokens, ids_sha256, decoded_sha256. A null text counts as empty.

    Written here, in small Arrow batches: what workers and executors kept from the stages before leaves little room.
    """
    return materialise(bpe_digest(docs, MULTI_RANKS), "encoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("toxicity", toxicity),
    ("ngram_jaccard", near_copies),
    ("mixing", mixing),
    ("byte_bpe", encode),
]

#: The learned stages can't be put in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name)
            if k:
                discard(before)
    return docs
