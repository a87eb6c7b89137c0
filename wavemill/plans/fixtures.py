"""The engine's tables as proxies over the fixture tables, in Spark and, as common table expressions, in SQL.

A record is a user of ``events``, a sample its value at the event's place in time, and an annotation the same event by its
type; subjects are pairs of users. Feature windows are ``embeddings`` with one record for every 20th vector. Predictions say
that a document of 200 characters or more has quality; files are documents, of which labels hold a changed inventory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wavemill import schemas
from wavemill.operators.annotate import map_annotations
from wavemill.operators.model import CentroidModel, fit_nearest_centroid, score, sign_matrix
from wavemill.operators.split import SplitConfig, grouped_split, split_subjects
from wavemill.operators.windowing import WindowConfig, chunk_signal, extract_windows, records_with_windows

CONFIG = WindowConfig(pre_seconds=2.0, post_seconds=2.0, channel_name="value")
CHUNK = 64
SPLIT = SplitConfig()
RUN = "00000000-0000-4000-8000-000000000001"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return table(spark, sf, "events").select(F.col("user_id").cast("string").alias("record_id"), "user_id", place.cast("long").alias("sample_index"), "value", F.col("event_type").alias("symbol"))


def samples(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("record_id", F.lit("value").alias("channel_name"), "sample_index", "value")


def records(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("sample_count"))
    names, units = F.array(F.lit("value"), F.lit("n")), F.array(F.lit("u"), F.lit("1"))
    return counts.select(F.col("user_id").cast("string").alias("record_id"), "user_id", F.lit(1.0).alias("sample_rate_hz"), "sample_count", names.alias("channel_names"), units.alias("units"))


def annotations(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("record_id", F.col("sample_index").alias("ordinal"), "sample_index", "symbol")


def mapping(spark: SparkSession) -> DataFrame:
    rows = [("view", "normal", 0, False), ("click", "normal", 0, False), ("purchase", "other", 1, False), ("error", "other", 1, False), ("signup", None, None, True)]
    return spark.createDataFrame(rows, schemas.MAPPING)


def mapped(spark: SparkSession, sf: str) -> DataFrame:
    return map_annotations(annotations(spark, sf), mapping(spark))


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_signal(samples(spark, sf), CHUNK)


def windows(spark: SparkSession, sf: str) -> DataFrame:
    return extract_windows(mapped(spark, sf), chunks(spark, sf), records(spark, sf), CONFIG, CHUNK)


def record_subjects(spark: SparkSession, sf: str) -> DataFrame:
    return records(spark, sf).select("record_id", F.floor(F.col("user_id") / 2).cast("string").alias("subject_id"))


def assignment(spark: SparkSession, sf: str) -> DataFrame:
    return grouped_split(records_with_windows(mapped(spark, sf), records(spark, sf), CONFIG), record_subjects(spark, sf), SPLIT)


def features(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    return rows.select(F.pmod("vec_id", F.lit(20)).cast("string").alias("record_id"), F.col("vec_id").alias("ordinal"), F.col("label").alias("target_value"), F.col("embedding").cast("array<double>").alias("window"))


def feature_partitions(spark: SparkSession, sf: str) -> DataFrame:
    rows = features(spark, sf)
    subjects = rows.select(F.col("record_id").alias("subject_id")).distinct()
    parts = split_subjects(subjects, SPLIT).withColumnRenamed("subject_id", "record_id")
    return rows.join(parts, "record_id")


def model(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> CentroidModel:
    """Fitted on the train rows of ``rows``, or of the feature partitions."""
    rows = feature_partitions(spark, sf) if rows is None else rows
    return fit_nearest_centroid(rows.where("partition = 'train'"), sign_matrix(64, 8, 7))


def scored(spark: SparkSession, sf: str, partition: str = "validation") -> DataFrame:
    rows = feature_partitions(spark, sf)
    found = score(rows.where(F.col("partition") == partition), model(spark, sf, rows))
    return found.select("ordinal", F.col("target_value").alias("label"), "prediction", "margin")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("symbol"), (F.col("n_chars") >= 200).cast("int").alias("prediction"))
    return table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")).join(docs, "doc_id")


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"), F.col("source").alias("record_id"), F.col("n_chars").alias("size_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    size = F.col("n_chars") + F.when(F.col("quality") == 0, 1).otherwise(0)
    text = F.when(F.col("toxic") == 1, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    return docs.select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"), F.col("source").alias("record_id"), size.alias("size_bytes"), F.sha2(text.cast("binary"), 256).alias("sha256"))


EV = """ev AS (SELECT CAST(user_id AS VARCHAR) AS record_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS sample_index,
  value, event_type AS symbol FROM events)"""
REC = "rec AS (SELECT CAST(user_id AS VARCHAR) AS record_id, user_id, count(*) AS sample_count FROM events GROUP BY user_id)"
MAPPING = """mapping AS (SELECT * FROM (VALUES ('view', 'normal', 0, false), ('click', 'normal', 0, false), ('purchase', 'other', 1, false), ('error', 'other', 1, false),
  ('signup', NULL, NULL, true)) t(symbol, target_name, target_value, excluded))"""
MAPPED = f"{EV}, {REC}, {MAPPING}, mapped AS (SELECT ev.*, target_name, target_value FROM ev JOIN mapping USING (symbol) WHERE NOT excluded)"
BOUNDS = f"""{MAPPED}, bounds AS (SELECT mapped.*, sample_count, sample_index - 2 AS l, sample_index + 2 AS r,
  CASE WHEN sample_index - 2 < 0 THEN 'left' WHEN sample_index + 2 > sample_count THEN 'right' ELSE 'emitted' END AS status FROM mapped JOIN rec USING (record_id))"""
WINDOWS = f"""{BOUNDS}, around AS (SELECT record_id, sample_index, lag(value, 2) OVER w AS w0, lag(value) OVER w AS w1, value AS w2, lead(value) OVER w AS w3
  FROM ev WINDOW w AS (PARTITION BY record_id ORDER BY sample_index)),
win AS (SELECT record_id, user_id, sample_index, symbol, target_value, l, r, w0, w1, w2, w3 FROM bounds JOIN around USING (record_id, sample_index) WHERE status = 'emitted')"""


def split_sql(subjects: str) -> str:
    """assign(subject_id, partition) of the subjects that a query gives as column s."""
    return f"""subj AS ({subjects}), total AS (SELECT count(*) AS n FROM subj),
shares AS (SELECT k, n, n * q AS x, floor(n * q) AS f FROM total, (VALUES (1, 0.7::DOUBLE), (2, 0.15::DOUBLE), (3, 0.15::DOUBLE)) t(k, q)),
sizes AS (SELECT k, f + CASE WHEN row_number() OVER (ORDER BY x - f DESC, k) <= n - sum(f) OVER () THEN 1 ELSE 0 END AS size FROM shares),
cuts AS (SELECT sum(size) FILTER (k <= 1) AS c1, sum(size) FILTER (k <= 2) AS c2 FROM sizes),
placed AS (SELECT s, row_number() OVER (ORDER BY md5('2022:' || s), s) AS p FROM subj),
assign AS (SELECT s AS subject_id, CASE WHEN p <= c1 THEN 'train' WHEN p <= c2 THEN 'validation' ELSE 'test' END AS "partition" FROM placed, cuts)"""


SPLIT_SQL = f"""{WINDOWS}, {split_sql("SELECT DISTINCT CAST(user_id // 2 AS VARCHAR) AS s FROM win")},
member AS (SELECT DISTINCT record_id, subject_id, "partition" FROM win JOIN assign ON subject_id = CAST(user_id // 2 AS VARCHAR))"""
SUMMARY = f"""{SPLIT_SQL}, counts AS (SELECT "partition", count(DISTINCT subject_id) AS subjects, count(DISTINCT record_id) AS records, count(*) AS windows,
  count(*) FILTER (target_value = 0) AS class_0, count(*) FILTER (target_value = 1) AS class_1 FROM win JOIN member USING (record_id) GROUP BY 1),
summary AS (SELECT "partition", coalesce(subjects, 0) AS subjects, coalesce(records, 0) AS records, coalesce(windows, 0) AS windows, coalesce(class_0, 0) AS class_0, coalesce(class_1, 0) AS class_1
  FROM (VALUES ('train'), ('validation'), ('test')) t("partition") LEFT JOIN counts USING ("partition"))"""
PREDICTIONS = "pred AS (SELECT l.doc_id, quality AS label, lang AS symbol, CAST(n_chars >= 200 AS INTEGER) AS prediction FROM labels l JOIN documents d USING (doc_id))"
CONFUSION = f"""{PREDICTIONS}, confusion AS (SELECT a AS label, b AS prediction, (SELECT count(*) FROM pred WHERE label = a AND prediction = b) AS n
  FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b))"""


def class_metrics_sql(confusion: str = "confusion") -> str:
    return f"""hits AS (SELECT label, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS h FROM {confusion} GROUP BY 1),
said AS (SELECT prediction AS label, sum(n) AS predicted FROM {confusion} GROUP BY 1),
pr AS (SELECT label, CASE WHEN predicted = 0 THEN 0.0 ELSE h / predicted END::DOUBLE AS p, CASE WHEN support = 0 THEN 0.0 ELSE h / support END::DOUBLE AS q, support FROM hits JOIN said USING (label)),
by_class AS (SELECT label, p AS "precision", q AS recall, CASE WHEN p + q = 0 THEN 0.0 ELSE 2 * p * q / (p + q) END AS f1, CAST(support AS BIGINT) AS support FROM pr)"""


FEATURES = f"""feat AS (SELECT CAST(vec_id % 20 AS VARCHAR) AS record_id, vec_id AS ordinal, label AS target_value, embedding::DOUBLE[] AS v FROM embeddings),
{split_sql("SELECT DISTINCT record_id AS s FROM feat")},
long AS (SELECT ordinal, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS f FROM feat),
signs AS (SELECT f, c, CASE WHEN substr(md5('7:' || f || ':' || c), 1, 1) < '8' THEN 1.0 ELSE -1.0 END / sqrt(8::DOUBLE) AS w FROM range(64) a(f), range(8) b(c)),
proj AS (SELECT ordinal, c, sum(x * w) AS v FROM long JOIN signs USING (f) GROUP BY ALL),
part AS (SELECT ordinal, target_value, "partition" FROM feat JOIN assign ON subject_id = record_id),
cent AS (SELECT target_value AS class, c, avg(v) AS m FROM proj JOIN part USING (ordinal) WHERE "partition" = 'train' GROUP BY ALL),
dist AS (SELECT ordinal, class, sum((v - m) ** 2) AS d FROM proj JOIN cent USING (c) GROUP BY ALL),
near AS (SELECT ordinal, class AS prediction, lead(d) OVER w - d AS margin, row_number() OVER w AS k FROM dist WINDOW w AS (PARTITION BY ordinal ORDER BY d, class)),
score AS (SELECT ordinal, target_value AS label, prediction, margin, "partition" FROM near JOIN part USING (ordinal) WHERE k = 1)"""
MANIFEST = """manifest AS (SELECT 'doc/' || doc_id AS path, source AS record_id, n_chars AS size_bytes, sha256("text") AS sha256 FROM documents)"""
INVENTORY = f"""{MANIFEST}, inventory AS (SELECT 'doc/' || doc_id AS path, source AS record_id, n_chars + CASE WHEN quality = 0 THEN 1 ELSE 0 END AS size_bytes,
  sha256(CASE WHEN toxic = 1 THEN "text" || 'x' ELSE "text" END) AS sha256 FROM documents JOIN labels USING (doc_id))"""
