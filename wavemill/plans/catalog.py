"""Every registered query of the waveform and event operators: name, plan, and SQL with the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemill.functions import scalars
from wavemill.operators import annotate, boosting, drift, experiments, hashtree, lineage, metrics, model, quality, split, windowing
from wavemill.operators.ordered import with_previous
from wavemill.plans import fixtures as fx
from wavemill.sources import ingest, tables, window_table
from wavemill.sources.scratch import shared_path

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def add(plan: Plan) -> Plan:
        QUERIES[name] = plan
        if sql:
            SQL[name] = sql
        return plan

    return add


def _rounded(rows: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return rows.withColumns({c: F.round(c, digits) for c in columns})


# flagship


@register("partition_summary", f"WITH {fx.SUMMARY} SELECT * FROM summary")
def partition_summary(spark, sf):
    """Labelled windows, split by subject, counted by partition (C1, C3, I1, D5)."""
    return split.partition_summary(fx.windows(spark, sf), fx.assignment(spark, sf))


# scans and files


@register("a1_scan_records", "SELECT event_id, user_id, event_type, value FROM events WHERE user_id % 2 = 0")
def a1(spark, sf):
    ids = fx.table(spark, sf, "events").select("user_id").where("user_id % 2 = 0")
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    return tables.scan_records(spark, f"{sf}/events.parquet", schema, ids, "user_id")


@register("a2_missing_companions", "SELECT doc_id AS record_id, 'label' AS extension, doc_id || '.label' AS path FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def a2(spark, sf):
    ids = fx.table(spark, sf, "documents").select(F.col("doc_id").alias("record_id"))
    labels = fx.table(spark, sf, "labels").select(F.concat(F.col("doc_id").cast("string"), F.lit(".label")).alias("path"))
    texts = ids.select(F.concat(F.col("record_id").cast("string"), F.lit(".text")).alias("path"))
    return lineage.missing_companions(labels.unionByName(texts), ids, ["text", "label"])


@register("a3_file_inventory")
def a3(spark, sf):
    return tables.file_inventory(spark, sf, "*.parquet", recursive=True).select("size_bytes", "sha256")


@register("a4_expected_files", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS record_id, x AS extension, user_id || '.' || x AS path FROM events, (VALUES ('hea'), ('dat'), ('atr')) t(x)")
def a4(spark, sf):
    return lineage.expected_files(fx.records(spark, sf), ["hea", "dat", "atr"])


@register("a5_coverage_diff", "SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'unexpected' ELSE 'ok' END AS status FROM documents d FULL JOIN labels l USING (doc_id)")
def a5(spark, sf):
    return quality.coverage_diff(fx.table(spark, sf, "documents"), fx.table(spark, sf, "labels"), ["doc_id"])


@register("a6_unexpected_files", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def a6(spark, sf):
    return quality.coverage_diff(fx.table(spark, sf, "labels"), fx.table(spark, sf, "documents"), ["doc_id"]).where("status = 'unexpected'").select("doc_id")


@register(
    "a7_manifest_violations",
    """WITH files AS (SELECT doc_id % 17 = 5 AS blank, doc_id % 13 = 0 AS old, CASE WHEN doc_id % 17 = 5 THEN repeat(' ', doc_id % 4 + 1)
    ELSE 'doc/' || CASE WHEN doc_id % 50 = 1 THEN doc_id - 1 ELSE doc_id END END AS path, CASE WHEN doc_id % 7 = 0 THEN -1 ELSE n_chars END AS size_bytes, doc_id % 11 = 0 AS bad FROM documents)
SELECT path, 'size' AS rule FROM files WHERE size_bytes < 0 UNION ALL SELECT path, 'digest' FROM files WHERE bad UNION ALL SELECT path, 'path' FROM files WHERE blank
UNION ALL SELECT path, 'schema_version' FROM files WHERE old UNION ALL SELECT path, 'unique_path' FROM files GROUP BY path HAVING count(*) > 1""",
)
def a7(spark, sf):
    docs, at = fx.table(spark, sf, "documents"), F.col("doc_id")
    path = F.concat(F.lit("doc/"), F.when(at % 50 == 1, at - 1).otherwise(at).cast("string"))
    path = F.when(at % 17 == 5, F.repeat(F.lit(" "), (at % 4 + 1).cast("int"))).otherwise(path)
    digest = F.when(at % 11 == 0, F.col("lang")).otherwise(F.sha2(F.col("text").cast("binary"), 256))
    size = F.when(at % 7 == 0, -1).otherwise(F.col("n_chars"))
    version = F.when(at % 13 == 0, 2).otherwise(1)
    return lineage.manifest_violations(docs.select(path.alias("path"), size.alias("size_bytes"), digest.alias("sha256"), version.alias("schema_version")))


_PLAN = f"""{fx.INVENTORY}, plan AS (SELECT m.record_id, m.path, CASE WHEN i.path IS NULL THEN 'fetch' WHEN i.size_bytes = m.size_bytes AND i.sha256 = m.sha256 THEN 'reuse' ELSE 'drifted' END AS action
  FROM manifest m LEFT JOIN inventory i USING (path))"""


@register("a8_resume_plan", f"WITH {_PLAN} SELECT * FROM plan")
def a8(spark, sf):
    return lineage.resume_plan(fx.manifest(spark, sf), fx.inventory(spark, sf))


@register(
    "a8_resumed_ingest",
    """WITH files AS (SELECT 'r' || doc_id // 5 AS record_id, 'doc/' || doc_id AS path, n_chars, "text", l.doc_id IS NOT NULL AND toxic = 0 AS good FROM documents LEFT JOIN labels l USING (doc_id)),
first AS (SELECT record_id, bool_and(good) AS whole FROM files GROUP BY 1)
SELECT record_id, path, octet_length(encode("text")) AS size_bytes, sha256("text") AS sha256, CASE WHEN whole THEN 1 ELSE 2 END AS run, CASE WHEN whole THEN 'reuse' ELSE 'fetch' END AS action
FROM files JOIN first USING (record_id)""",
)
def a8_ingest(spark, sf):
    """What is there after two runs: in the first the files of documents without a label are absent and toxic ones are damaged."""
    docs = fx.table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    docs = docs.withColumns({"record_id": F.concat(F.lit("r"), F.floor(F.col("doc_id") / 5).cast("string")), "path": F.concat(F.lit("doc/"), F.col("doc_id").cast("string"))})
    manifest = docs.select("record_id", "path", F.octet_length("content").cast("long").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
    damaged = F.when(F.col("toxic") == 1, F.concat("content", F.lit("x").cast("binary"))).otherwise(F.col("content"))
    early = docs.join(fx.table(spark, sf, "labels"), "doc_id").select("path", damaged.alias("content"))
    target = shared_path(spark, "ingest")
    ingest.ingest(manifest, early, target, batches=3)
    before = ingest.proven_files(spark, target).select("commit").distinct().withColumn("run", F.lit(1))
    plan = ingest.ingest(manifest, docs.select("path", "content"), target, batches=3).select("path", "action")
    return ingest.proven_files(spark, target).join(before, "commit", "left").join(plan, "path").select("record_id", "path", "size_bytes", "sha256", F.coalesce("run", F.lit(2)).alias("run"), "action")


@register(
    "a8_resume_progress",
    f"""WITH {_PLAN} SELECT record_id, count(*) FILTER (action = 'reuse') AS n_reuse, count(*) FILTER (action = 'fetch') AS n_fetch, count(*) FILTER (action = 'drifted') AS n_drifted,
  count(*) AS files FROM plan GROUP BY 1""",
)
def a8_progress(spark, sf):
    return lineage.resume_progress(a8(spark, sf))


@register(
    "a9_manifest_identity",
    """SELECT doc_id AS ordinal, l.doc_id IS NOT NULL AND (lang = CASE WHEN quality = 1 THEN lang END) IS NOT DISTINCT FROM true AS ok FROM documents LEFT JOIN labels l USING (doc_id)""",
)
def a9(spark, sf):
    docs = fx.table(spark, sf, "documents")
    stated = docs.join(fx.table(spark, sf, "labels"), "doc_id").select(F.col("doc_id").alias("ordinal"), F.when(F.col("quality") == 1, F.col("lang")).alias("lang"))
    return lineage.manifest_identity_check(docs.select(F.col("doc_id").alias("ordinal"), "lang"), stated, ["lang"])


@register("a10_discover_shards")
def a10(spark, sf):
    """Every Parquet file that lies directly in the folder of tables."""
    return tables.discover_shards(spark, [sf], "*.parquet").select(F.element_at(F.split("path", "/"), -1).alias("name"))


_META = f"WITH {fx.WINDOWS} SELECT record_id, sample_index AS ordinal, sample_index AS center_sample_index, symbol AS source_symbol, target_value FROM win"


@register("a11_scan_window_metadata", _META)
def a11(spark, sf):
    rows = fx.windows(spark, sf).withColumn("schema_version", F.lit(1))
    return tables.scan_window_metadata(rows).drop("left", "right", "schema_version")


@register("a12_scan_windows", f"WITH {fx.WINDOWS} SELECT record_id, sample_index AS ordinal, target_value = 0 AND sample_index % 11 <> 3 AND sample_index % 13 <> 5 AND sample_index % 17 <> 6 AND sample_index % 19 <> 7 AS valid FROM win")
def a12(spark, sf):
    """Windows some of which are too narrow, hold NaN or infinity, are not there, or have another class."""
    at, w = F.col("ordinal"), F.col("window")
    broken = F.when(at % 11 == 3, F.slice(w, 1, 3)).when(at % 13 == 5, F.transform(w, lambda x: F.lit(float("nan")))).when(at % 17 == 6, F.transform(w, lambda x, k: F.when(k == 3, float("-inf")).otherwise(x))).when(at % 19 != 7, w)
    return tables.scan_windows(fx.windows(spark, sf).withColumn("window", broken), 4, [0]).select("record_id", "ordinal", "valid")


@register("a15_report", f"WITH {fx.SUMMARY} SELECT '{{\"class_0\":' || class_0 || ',\"class_1\":' || class_1 || ',\"partition\":\"' || \"partition\" || '\",\"records\":' || records || ',\"subjects\":' || subjects || ',\"windows\":' || windows || '}}' AS json FROM summary")
def a15(spark, sf):
    return tables.as_report(partition_summary(spark, sf))


# projections, filters, rules


@register("b1_seconds_to_samples", "SELECT CAST(user_id AS VARCHAR) AS record_id, CAST(2 * (user_id % 4 + 1) AS BIGINT) AS pre, CASE WHEN user_id % 2 = 1 THEN CAST((user_id % 4 + 1) / 2 AS BIGINT) END AS post FROM events GROUP BY user_id")
def b1(spark, sf):
    rows = fx.records(spark, sf).withColumn("sample_rate_hz", (F.col("user_id") % 4 + 1).cast("double"))
    return windowing.window_geometry(rows, windowing.WindowConfig(2.0, 0.5)).select("record_id", "pre", "post")


@register("b2_resolve_channel", "SELECT CAST(user_id AS VARCHAR) AS record_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE 1 END::BIGINT AS channel_index, CASE WHEN user_id % 3 = 0 THEN 'no channel n; available: value' END AS message FROM events GROUP BY user_id")
def b2(spark, sf):
    rows = fx.records(spark, sf).withColumn("channel_names", F.when(F.col("user_id") % 3 == 0, F.array(F.lit("value"))).otherwise(F.col("channel_names")))
    return windowing.resolve_channel(rows, windowing.WindowConfig(2.0, 2.0, channel_name="n")).drop("channel_name")


@register("b3_exclude_records", f"WITH {fx.EV} SELECT record_id, sample_index, symbol FROM ev WHERE user_id % 10 <> 3")
def b3(spark, sf):
    ids = fx.records(spark, sf).where("user_id % 10 = 3").select("record_id")
    return annotate.exclude_records(fx.annotations(spark, sf), ids).select("record_id", "sample_index", "symbol")


@register("b4_classify_bounds", f"WITH {fx.BOUNDS} SELECT record_id, sample_index, status FROM bounds")
def b4(spark, sf):
    return windowing.window_bounds(fx.mapped(spark, sf), fx.records(spark, sf), fx.CONFIG).select("record_id", "sample_index", "status")


@register("b5_mapping_totals", f"WITH {fx.EV}, {fx.MAPPING} SELECT count(*) AS input, count(*) FILTER (NOT excluded) AS included, count(*) FILTER (excluded) AS excluded, count(*) FILTER (excluded IS NULL) AS unknown FROM ev LEFT JOIN mapping USING (symbol)")
def b5(spark, sf):
    return annotate.mapping_totals(fx.annotations(spark, sf), fx.mapping(spark))


@register("b6_read_partition", f'WITH {fx.SPLIT_SQL} SELECT record_id, sample_index AS ordinal, target_value FROM win JOIN member USING (record_id) WHERE "partition" = \'validation\'')
def b6(spark, sf):
    rows = fx.windows(spark, sf).join(fx.assignment(spark, sf), "record_id")
    return lineage.read_partition(rows, "validation").select("record_id", "ordinal", "target_value")


@register("b8_gated_partition", f'WITH {fx.SPLIT_SQL} SELECT record_id, sample_index AS ordinal, target_value FROM win JOIN member USING (record_id) WHERE "partition" = \'test\'')
def b8(spark, sf):
    rows = fx.windows(spark, sf).join(fx.assignment(spark, sf), "record_id")
    approvals = lineage.record_approval(_run_files(spark, sf), _roles(spark), fx.RUN, "owner")
    return lineage.gated_partition(rows, approvals, fx.RUN).select("record_id", "ordinal", "target_value")


_TABLE_COLUMNS = ("record_id", "ordinal", "target_value")


def _window_table(spark, sf):
    """Windows in a new table, in folders by partition and in buckets by record."""
    name, path = window_table.scratch_table(spark, "windows")
    window_table.write_window_table(fx.windows(spark, sf), fx.assignment(spark, sf), name, path, buckets=8)
    return name


@register("b6_window_table", f'WITH {fx.SPLIT_SQL} SELECT record_id, sample_index AS ordinal, target_value, w0 + w1 + w2 + w3 AS total FROM win JOIN member USING (record_id) WHERE "partition" = \'validation\'')
def b6_table(spark, sf):
    """All windows are written by partition; the validation ones are read back from the files of their folder."""
    rows = window_table.read_window_partition(spark, _window_table(spark, sf), "validation")
    at = F.col("window")
    return rows.select(*_TABLE_COLUMNS, (at[0] + at[1] + at[2] + at[3]).alias("total"))


@register("b8_window_table_gated", f'WITH {fx.SPLIT_SQL} SELECT record_id, sample_index AS ordinal, target_value FROM win JOIN member USING (record_id) WHERE "partition" = \'test\'')
def b8_table(spark, sf):
    """The protected folder of the table, which takes the run's approval."""
    approvals = lineage.record_approval(_run_files(spark, sf), _roles(spark), fx.RUN, "owner")
    return window_table.read_window_partition(spark, _window_table(spark, sf), "test", approvals, fx.RUN).select(*_TABLE_COLUMNS)


@register("b6_bucketed_join", f'WITH {fx.SPLIT_SQL} SELECT record_id, "partition", sample_count, count(*) AS windows FROM win JOIN member USING (record_id) JOIN rec USING (record_id) GROUP BY ALL')
def b6_join(spark, sf):
    """Windows of each record beside its length: both tables are in buckets by record, so the join and the count move no row."""
    name, path = window_table.scratch_table(spark, "records")
    records = window_table.write_bucketed(fx.records(spark, sf).select("record_id", "sample_count"), name, path, buckets=8)
    rows = spark.table(_window_table(spark, sf)).select("record_id", "partition")
    return rows.join(records, "record_id").groupBy("record_id", "partition", "sample_count").agg(F.count(F.lit(1)).alias("windows"))


OTHER_RUN = "00000000-0000-4000-8000-000000000002"


def _run_files(spark, sf, run=fx.RUN, even="config"):
    """Files of a run: those of even documents have one role, the others are evidence."""
    files = fx.table(spark, sf, "documents").select("doc_id", F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"), F.col("n_chars").alias("size_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    roles = files.select("path", F.when(F.col("doc_id") % 2 == 0, even).otherwise("evidence").alias("role"))
    return lineage.run_manifest(files.drop("doc_id"), roles, run)


def _roles(spark):
    return spark.createDataFrame([("config",), ("evidence",)], "role string")


_RULES = f"""{fx.EV}, {fx.REC}, marks AS (SELECT record_id, user_id, sample_index, CASE WHEN user_id % 5 = 1 THEN -sample_index ELSE sample_index END AS i, symbol, value FROM ev),
fell AS (SELECT *, i < lag(i) OVER (PARTITION BY record_id ORDER BY sample_index) AS f FROM marks),
by_record AS (SELECT record_id, min(i) AS a, max(i) AS b, bool_or(coalesce(f, false)) AS f, bool_and(NOT (user_id % 7 = 2 AND sample_index = 0)) AS fine,
  bool_and(NOT (user_id % 10 = 6 AND sample_index = 2) AND NOT (user_id % 10 = 8 AND sample_index = 1)) AS named FROM fell GROUP BY 1),
rules AS (SELECT record_id, unnest([
  {{'rule': 'configured', 'ok': user_id % 4 <> 0}}, {{'rule': 'rate', 'ok': user_id % 6 <> 1}}, {{'rule': 'non_empty', 'ok': user_id % 11 <> 7}}, {{'rule': 'finite', 'ok': fine}},
  {{'rule': 'channels', 'ok': user_id % 8 <> 3 OR user_id % 11 = 7}}, {{'rule': 'units', 'ok': user_id % 9 <> 4 AND user_id % 11 <> 7}}, {{'rule': 'annotated', 'ok': named}},
  {{'rule': 'in_range', 'ok': a >= 0 AND b < sample_count}}, {{'rule': 'ordered', 'ok': NOT f}}]) AS x FROM rec JOIN by_record USING (record_id))"""


@register("b9_validate_records", f"WITH {_RULES} SELECT record_id, x.rule AS rule, x.ok AS ok FROM rules")
def b9(spark, sf):
    """Rules B9a to B9i, on records some of which are made to break each."""
    at = F.col("user_id")
    rows = fx.records(spark, sf).withColumns(
        {
            "sample_rate_hz": F.when(at % 6 == 1, 2.0).otherwise(1.0),
            "channel_names": F.when(at % 11 == 7, F.array().cast("array<string>")).when(at % 8 == 3, F.array(F.lit("value"), F.lit("value"))).otherwise(F.col("channel_names")),
            "units": F.when(at % 9 == 4, F.array(F.lit("u"))).otherwise(F.col("units")),
        }
    )
    events = fx.events(spark, sf)
    broken = events.withColumn("value", F.when((at % 7 == 2) & (F.col("sample_index") == 0), F.lit(float("nan"))).otherwise(F.col("value")))
    index = F.col("sample_index")
    symbol = F.when((at % 10 == 6) & (index == 2), "").when((at % 10 != 8) | (index != 1), F.col("symbol"))
    marks = events.select("record_id", index.alias("ordinal"), F.when(at % 5 == 1, -index).otherwise(index).alias("sample_index"), symbol.alias("symbol"))
    known = rows.where("user_id % 4 <> 0").select("record_id")
    chunks = windowing.chunk_signal(broken.select("record_id", F.lit("value").alias("channel_name"), "sample_index", "value"), fx.CHUNK)
    return quality.validate_records(rows.drop("user_id"), chunks, marks, known, 1.0)


@register(
    "b10_validate_windows",
    f"""WITH {fx.WINDOWS}, broken AS (SELECT user_id % 7 AS u, sample_index AS i, CASE WHEN user_id % 7 = 5 THEN ' ' ELSE record_id END AS record_id,
  CASE user_id % 7 WHEN 3 THEN sample_index - 5 WHEN 4 THEN -sample_index WHEN 5 THEN 8 ELSE sample_index END AS c FROM win),
fell AS (SELECT *, coalesce(c < lag(c) OVER (PARTITION BY record_id ORDER BY i), false) AS f FROM broken)
SELECT record_id, count(*) AS windows, NOT (bool_or(u = 1 AND i % 2 = 1) AND bool_or(u = 1 AND i % 2 = 0)) AS equal_width, NOT bool_or(u = 2 AND i % 3 = 0) AS finite, min(c) >= 0 AS centres_valid,
  NOT bool_or(f) AS centres_ordered, min(u) <> 5 AS ids_filled FROM fell GROUP BY 1""",
)
def b10(spark, sf):
    """Windows that break each rule in the records of one residue."""
    u, i, w = F.col("record_id").cast("long") % 7, F.col("ordinal"), F.col("window")
    centre = F.col("center_sample_index")
    rows = fx.windows(spark, sf).select(
        F.when(u == 5, " ").otherwise(F.col("record_id")).alias("record_id"),
        "ordinal",
        F.when(u == 3, centre - 5).when(u == 4, -centre).when(u == 5, 8).otherwise(centre).alias("center_sample_index"),
        F.when((u == 1) & (i % 2 == 1), F.slice(w, 1, 3)).when((u == 2) & (i % 3 == 0), F.transform(w, lambda x: F.lit(float("nan")))).otherwise(w).alias("window"),
    )
    return quality.validate_windows(rows)


@register("b11_categorise", "SELECT event_id, CASE WHEN event_type = 'view' THEN 0 WHEN event_type IN ('purchase', 'error') THEN 1 ELSE -1 END AS category FROM events")
def b11(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", annotate.categorise(F.col("event_type"), "view", ["purchase", "error"]).alias("category"))


@register("b12_keep_beats", f"WITH {fx.EV} SELECT record_id, sample_index, symbol FROM ev WHERE symbol IN ('view', 'purchase', 'error')")
def b12(spark, sf):
    return fx.annotations(spark, sf).where(F.col("symbol").isin("view", "purchase", "error")).select("record_id", "sample_index", "symbol")


@register("b13_split_by_class", f"WITH {fx.MAPPED} SELECT record_id, sample_index, symbol FROM mapped WHERE target_value = 1")
def b13(spark, sf):
    return fx.mapped(spark, sf).where("target_value = 1").select("record_id", "sample_index", "symbol")


@register("b14_null_counts", "SELECT count(*) FILTER (d.doc_id IS NULL) AS doc_id, count(*) FILTER (quality IS NULL) AS quality, count(*) FILTER (toxic IS NULL) AS toxic FROM documents d LEFT JOIN labels USING (doc_id)")
def b14(spark, sf):
    rows = fx.table(spark, sf, "documents").join(fx.table(spark, sf, "labels"), "doc_id", "left")
    return metrics.null_counts(rows.select("doc_id", "quality", "toxic"))


@register("b15_missing_required", "SELECT DISTINCT p_brand || ' ' || p_size AS name FROM part WHERE p_brand || ' ' || p_size NOT IN (SELECT p_brand || ' ' || p_size FROM part WHERE p_partkey % 3 = 0)")
def b15(spark, sf):
    """Sizes of a brand that no part of every third number has."""
    parts = fx.table(spark, sf, "part").select(F.concat_ws(" ", "p_brand", F.col("p_size").cast("string")).alias("name"), "p_partkey")
    return quality.missing_required(parts, parts.where("p_partkey % 3 = 0"))


@register("b16_vocabulary_drift", "WITH c AS (SELECT conv_id, list(role ORDER BY turn) AS roles FROM conversations GROUP BY 1) SELECT conv_id, array_to_string(list_filter(roles, lambda x: x NOT IN ('user', 'assistant')), ',') AS unknown FROM c WHERE len(list_filter(roles, lambda x: x NOT IN ('user', 'assistant'))) > 0")
def b16(spark, sf):
    turns = fx.table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    items = turns.select("conv_id", F.transform("turns", lambda x: x["role"]).alias("roles"))
    known = spark.createDataFrame([("user",), ("assistant",)], "value string")
    return drift.vocabulary_drift(items, "conv_id", "roles", known).select("conv_id", F.array_join("unknown", ",").alias("unknown"))


_MODEL_RULES = ["projection_full", "projection_finite", "centroids_full", "centroids_finite", "two_classes", "classes_sorted", "same_components"]


@register(
    "b17_validate_model",
    f"""WITH broken AS (SELECT * FROM (VALUES ('whole', ''), ('gap', 'projection_full'), ('nan', 'projection_finite'), ('short', 'centroids_full'), ('inf', 'centroids_finite'), ('single', 'two_classes'),
  ('turned', 'classes_sorted'), ('narrow', 'same_components')) t(model, rule)) SELECT model, x AS rule, x <> broken.rule AS ok
FROM broken, (VALUES {', '.join(f"('{r}')" for r in _MODEL_RULES)}) r(x) WHERE (SELECT count(DISTINCT label) FROM embeddings) > 2""",
)
def b17(spark, sf):
    """The fitted model, and seven that break a rule each."""
    weights, values = model.model_rows(spark, fx.model(spark, sf))
    first, last = (F.col("feature") == 3) & (F.col("component") == 2), (F.col("place") == 1) & (F.col("component") == 2)
    broken = {
        "whole": (weights, values),
        "gap": (weights.where(~first), values),
        "nan": (weights.withColumn("weight", F.when(first, float("nan")).otherwise(F.col("weight"))), values),
        "short": (weights, values.where(~last)),
        "inf": (weights, values.withColumn("value", F.when(last, float("-inf")).otherwise(F.col("value")))),
        "single": (weights, values.where("place = 0")),
        "turned": (weights, values.withColumn("place", -F.col("place"))),
        "narrow": (weights, values.where("component < 7")),
    }
    found = None
    for name, parts in broken.items():
        one = model.validate_model(*parts).select(F.lit(name).alias("model"), "rule", "ok")
        found = one if found is None else found.unionByName(one)
    return found


@register("b18_incompatible_rows", "SELECT vec_id AS ordinal FROM embeddings WHERE vec_id % 9 = 0 OR label % 2 = 1")
def b18(spark, sf):
    rows = fx.features(spark, sf).withColumn("window", F.when(F.col("ordinal") % 9 == 0, F.slice("window", 1, 63)).otherwise(F.col("window")))
    known = fx.model(spark, sf)
    some = model.CentroidModel(known.projection, [c for c in known.classes if c % 2 == 0], known.centroids)
    return model.incompatible_rows(rows, some).select("ordinal")


# joins


@register("c1_map_annotations", f"WITH {fx.MAPPED} SELECT record_id, sample_index, symbol, target_name, target_value FROM mapped")
def c1(spark, sf):
    return fx.mapped(spark, sf).select("record_id", "sample_index", "symbol", "target_name", "target_value")


@register("c2_unknown_symbols", "SELECT event_type AS symbol, count(*) AS n FROM events WHERE event_type IN ('signup', 'error') GROUP BY 1")
def c2(spark, sf):
    return annotate.unknown_symbols(fx.annotations(spark, sf), fx.mapping(spark).where("symbol not in ('signup', 'error')"))


@register("c3_extract_windows", f"WITH {fx.WINDOWS} SELECT record_id, sample_index AS ordinal, symbol AS source_symbol, target_value, w0, w1, w2, w3 FROM win")
def c3(spark, sf):
    return fx.windows(spark, sf).select("record_id", "ordinal", "source_symbol", "target_value", *(F.col("window")[k].alias(f"w{k}") for k in range(4)))


@register("c3b_first_channel_windows", f"WITH {fx.WINDOWS} SELECT record_id, sample_index AS ordinal, w0 + w1 + w2 + w3 AS total FROM win WHERE symbol IN ('view', 'purchase', 'error')")
def c3b(spark, sf):
    config = windowing.WindowConfig(2.0, 2.0, channel_index=0)
    beats = fx.mapped(spark, sf).where(F.col("symbol").isin("view", "purchase", "error"))
    rows = windowing.extract_windows(beats, fx.chunks(spark, sf), fx.records(spark, sf), config, fx.CHUNK)
    return rows.select("record_id", "ordinal", (F.col("window")[0] + F.col("window")[1] + F.col("window")[2] + F.col("window")[3]).alias("total"))


@register("c4_attach_subjects", f"WITH {fx.WINDOWS} SELECT record_id, sample_index AS ordinal, CAST(user_id // 2 AS VARCHAR) AS subject_id FROM win")
def c4(spark, sf):
    rows = fx.windows(spark, sf)
    return split.attach_subjects(rows, split.narrow_subjects(fx.record_subjects(spark, sf), rows)).select("record_id", "ordinal", "subject_id")


@register("c5_narrow_subjects", f"WITH {fx.WINDOWS} SELECT DISTINCT record_id, CAST(user_id // 2 AS VARCHAR) AS subject_id FROM win")
def c5(spark, sf):
    return split.narrow_subjects(fx.record_subjects(spark, sf), fx.windows(spark, sf))


_INDEX = f"""{fx.SPLIT_SQL}, shards AS (SELECT record_id, count(*) AS window_count, 4 AS width, count(*) FILTER (target_value = 0) AS class_0, count(*) FILTER (target_value = 1) AS class_1 FROM win GROUP BY 1)"""


@register("c6_build_dataset_index", f'WITH {_INDEX} SELECT record_id, subject_id, "partition", window_count, width, class_0, class_1 FROM shards JOIN member USING (record_id)')
def c6(spark, sf):
    return lineage.build_dataset_index(lineage.shard_summary(fx.windows(spark, sf)), fx.assignment(spark, sf))


@register(
    "c7_inventory_diff",
    f"""WITH {fx.INVENTORY} SELECT coalesce(m.path, i.path) AS path, CASE WHEN i.path IS NULL THEN 'missing' WHEN m.path IS NULL THEN 'extra' WHEN m.size_bytes <> i.size_bytes THEN 'size'
  WHEN m.sha256 <> i.sha256 THEN 'digest' ELSE 'ok' END AS status FROM manifest m FULL JOIN (SELECT * FROM inventory UNION ALL SELECT 'x/' || path, record_id, size_bytes, sha256 FROM inventory WHERE size_bytes % 10 = 0) i USING (path)""",
)
def c7(spark, sf):
    files = fx.inventory(spark, sf)
    extra = files.where("size_bytes % 10 = 0").withColumn("path", F.concat(F.lit("x/"), "path"))
    return lineage.inventory_diff(fx.manifest(spark, sf), files.unionByName(extra))


@register(
    "c7_changed_files",
    f"""WITH {fx.INVENTORY} SELECT coalesce(m.path, i.path) AS path, CASE WHEN i.path IS NULL THEN 'missing' WHEN m.path IS NULL THEN 'extra' WHEN m.size_bytes <> i.size_bytes THEN 'size' ELSE 'digest' END AS status
  FROM manifest m FULL JOIN inventory i USING (path) WHERE (m.size_bytes = i.size_bytes AND m.sha256 = i.sha256) IS DISTINCT FROM true""",
)
def c7_changed(spark, sf):
    return hashtree.changed_files(fx.manifest(spark, sf), fx.inventory(spark, sf))


@register("c8_verify_lineage", f"WITH {fx.INVENTORY} SELECT m.record_id AS role, m.path, (m.size_bytes = i.size_bytes AND m.sha256 = i.sha256) IS NOT DISTINCT FROM true AS ok FROM manifest m LEFT JOIN inventory i USING (path)")
def c8(spark, sf):
    return lineage.verify_lineage(fx.manifest(spark, sf).withColumnRenamed("record_id", "role"), fx.inventory(spark, sf))


@register("c10_distances", f"WITH {fx.FEATURES} SELECT ordinal, class, round(d, 6) AS d FROM dist")
def c10(spark, sf):
    fitted = fx.model(spark, sf)
    rows = model.score(fx.features(spark, sf), fitted).select("ordinal", F.posexplode("distances").alias("k", "d"))
    classes = F.array(*map(F.lit, fitted.classes))
    return rows.select("ordinal", F.element_at(classes, F.col("k") + 1).alias("class"), F.round("d", 6).alias("d"))


_ITEMS = """items AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders), snap AS (SELECT l_orderkey AS k, min(l_linestatus) AS a, max(l_linestatus) AS b, count(*) AS n FROM lineitem WHERE l_quantity > 25 GROUP BY 1),
judged AS (SELECT items.k, s, snap.k IS NULL AS out, a, b, n FROM items LEFT JOIN snap USING (k))"""


@register(
    "c11_snapshot_drift",
    f"""WITH {_ITEMS}, found AS (SELECT k AS o_orderkey, array_to_string(list_filter([CASE WHEN out THEN 'not_in_snapshot' END, CASE WHEN NOT out AND s = 'F' AND b <> 'F' THEN 'open_line' END,
  CASE WHEN NOT out AND s = 'P' AND a = b THEN 'not_partial' END], lambda x: x IS NOT NULL), ',') AS problems FROM judged) SELECT * FROM found WHERE problems <> ''""",
)
def c11(spark, sf):
    lines = fx.table(spark, sf, "lineitem").where("l_quantity > 25").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_linestatus").alias("a"), F.max("l_linestatus").alias("b"))
    rules = {"open_line": (F.col("o_orderstatus") == "F") & (F.col("b") != "F"), "not_partial": (F.col("o_orderstatus") == "P") & (F.col("a") == F.col("b"))}
    found = drift.snapshot_drift(fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), lines, "o_orderkey", rules)
    return found.select("o_orderkey", F.array_join("problems", ",").alias("problems"))


@register("c11_conflicting_options", "SELECT p_brand AS field, count(DISTINCT p_size) AS options FROM part GROUP BY 1 HAVING count(DISTINCT p_size) > 1")
def c11_options(spark, sf):
    return drift.conflicting_options(fx.table(spark, sf, "part").select(F.col("p_brand").alias("field"), "p_size"), "field", "p_size")


@register("c12_pending_candidates", "SELECT DISTINCT p_partkey AS candidate_id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def c12(spark, sf):
    every = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("candidate_id"))
    return experiments.pending_candidates(every, fx.table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("candidate_id")))


@register("c13_compare_models", "WITH a AS (SELECT p_brand AS name, avg(p_retailprice) AS value FROM part GROUP BY 1), b AS (SELECT p_brand AS name, avg(p_retailprice) AS baseline FROM part WHERE p_size > 40 GROUP BY 1) SELECT name, round(value, 6) AS value, round(baseline, 6) AS baseline, round(value - baseline, 6) AS difference FROM a LEFT JOIN b USING (name)")
def c13(spark, sf):
    mean = lambda rows: rows.groupBy(F.col("p_brand").alias("name")).agg(F.avg("p_retailprice").alias("value"))
    parts = fx.table(spark, sf, "part")
    return _rounded(experiments.compare_models(mean(parts), mean(parts.where("p_size > 40"))), "value", "baseline", "difference")


@register("c14_missing_files", f"WITH {fx.INVENTORY} SELECT path, 'inventory' AS missing_from FROM manifest WHERE path NOT IN (SELECT path FROM inventory)")
def c14(spark, sf):
    return lineage.missing_files(fx.manifest(spark, sf), fx.inventory(spark, sf))


# aggregates


@register("d1_symbol_counts", f"WITH {fx.EV} SELECT record_id, symbol, count(*) AS n, CAST(grouping_id(record_id, symbol) AS BIGINT) AS level FROM ev GROUP BY ROLLUP (record_id, symbol)")
def d1(spark, sf):
    return annotate.symbol_counts(fx.annotations(spark, sf))


@register("d2_record_report", f"WITH {_RULES}, c AS (SELECT record_id, symbol, count(*) AS n FROM ev GROUP BY ALL), p AS (SELECT record_id, string_agg(x.rule, ',' ORDER BY x.rule) AS passed FROM rules WHERE x.ok GROUP BY 1) SELECT record_id, CAST(sum(n) AS BIGINT) AS sample_count, 2 AS channels, CAST(sum(n) AS BIGINT) AS annotations, string_agg(symbol || '=' || n, ',' ORDER BY symbol) AS symbols, any_value(passed) AS passed FROM c JOIN p USING (record_id) GROUP BY 1")
def d2(spark, sf):
    rows = quality.record_report(fx.records(spark, sf), fx.annotations(spark, sf), b9(spark, sf))
    entries = F.transform(F.array_sort(F.map_entries("symbols")), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string")))
    return rows.withColumns({"symbols": F.array_join(entries, ","), "passed": F.array_join("passed", ",")})


@register("d3_mapping_report", f"WITH {fx.EV}, {fx.MAPPING}, more AS (SELECT * FROM mapping UNION ALL SELECT 'never', 'other', 1, false) SELECT symbol, target_name, target_value, excluded, count(record_id) AS n FROM more LEFT JOIN ev USING (symbol) GROUP BY ALL")
def d3(spark, sf):
    more = fx.mapping(spark).unionByName(spark.createDataFrame([("never", "other", 1, False)], "symbol string, target_name string, target_value int, excluded boolean"))
    return annotate.mapping_report(fx.annotations(spark, sf), more)


_OVER = f"""{fx.WINDOWS}, over AS (SELECT *, coalesce(l < lag(r) OVER (PARTITION BY record_id ORDER BY sample_index), false) AS o FROM win)"""


@register(
    "d4_extraction_report",
    f"""WITH {_OVER}, c AS (SELECT record_id, count(*) FILTER (status = 'emitted') AS n_emitted, count(*) FILTER (status = 'left') AS n_left, count(*) FILTER (status = 'right') AS n_right,
  count(*) FILTER (status = 'emitted' AND target_value = 0) AS class_0, count(*) FILTER (status = 'emitted' AND target_value = 1) AS class_1 FROM bounds GROUP BY 1),
o AS (SELECT record_id, count(*) FILTER (o) AS n_overlaps FROM over GROUP BY 1)
SELECT record_id, coalesce(n_emitted, 0) AS n_emitted, coalesce(n_left, 0) AS n_left, coalesce(n_right, 0) AS n_right, coalesce(class_0, 0) AS class_0, coalesce(class_1, 0) AS class_1,
  coalesce(n_overlaps, 0) AS n_overlaps FROM rec LEFT JOIN c USING (record_id) LEFT JOIN o USING (record_id)""",
)
def d4(spark, sf):
    return windowing.extraction_report(fx.mapped(spark, sf), fx.records(spark, sf), fx.CONFIG)


QUERIES["d5_partition_summary"], SQL["d5_partition_summary"] = partition_summary, SQL["partition_summary"]


@register("d6_partition_totals", f'WITH {fx.SPLIT_SQL} SELECT "partition", count(DISTINCT subject_id) AS subjects, count(DISTINCT record_id) AS records, count(*) AS windows FROM win JOIN member USING (record_id) GROUP BY ROLLUP ("partition")')
def d6(spark, sf):
    return split.partition_totals(fx.windows(spark, sf), fx.assignment(spark, sf))


@register("d7_shard_summary", f"WITH {_INDEX} SELECT * FROM shards")
def d7(spark, sf):
    return lineage.shard_summary(fx.windows(spark, sf))


@register("d8_index_summary", f'WITH {_INDEX} SELECT "partition", count(*) AS records, count(DISTINCT subject_id) AS subjects, CAST(sum(window_count) AS BIGINT) AS windows, CAST(sum(class_0) AS BIGINT) AS class_0, CAST(sum(class_1) AS BIGINT) AS class_1 FROM shards JOIN member USING (record_id) GROUP BY 1')
def d8(spark, sf):
    return lineage.index_summary(c6(spark, sf))


@register("d9_identity_check", "SELECT count(DISTINCT lang || source) AS identities, count(DISTINCT lang || source) <= 1 AS single FROM documents")
def d9(spark, sf):
    return quality.identity_check(fx.table(spark, sf, "documents"), ["lang", "source"])


@register("d9_odd_records", "SELECT doc_id AS record_id, lang, source FROM documents WHERE (lang, source) IS DISTINCT FROM (SELECT (lang, source) FROM documents ORDER BY doc_id LIMIT 1)")
def d9_odd(spark, sf):
    return quality.odd_records(fx.table(spark, sf, "documents").select(F.col("doc_id").alias("record_id"), "lang", "source"), ["lang", "source"])


@register("d10_channel_usage", "SELECT CASE user_id % 3 WHEN 0 THEN 'value' WHEN 1 THEN 'n' END AS channel_name, count(DISTINCT user_id) AS n FROM events GROUP BY 1")
def d10(spark, sf):
    """The second of the channels that each record has, a third of them in another order and a third without one."""
    names = F.when(F.col("user_id") % 3 == 0, F.reverse("channel_names")).when(F.col("user_id") % 3 == 2, F.array(F.lit("value"))).otherwise(F.col("channel_names"))
    rows = fx.records(spark, sf).withColumn("channel_names", names)
    return quality.channel_usage(windowing.resolve_channel(rows, windowing.WindowConfig(2.0, 2.0, channel_index=1)))


@register("d11_class_balance", "WITH c AS (SELECT lang, quality, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY ALL) SELECT lang, quality, n, round(n / sum(n) OVER (PARTITION BY lang), 9) AS share FROM c")
def d11(spark, sf):
    rows = fx.table(spark, sf, "labels").join(fx.table(spark, sf, "documents"), "doc_id")
    return _rounded(metrics.class_balance(rows, ["lang"], "quality"), "share", digits=9)


def _confusion(spark, sf):
    return metrics.confusion_matrix(fx.predictions(spark, sf), [0, 1])


@register("d12_confusion_matrix", f"WITH {fx.CONFUSION} SELECT * FROM confusion")
def d12(spark, sf):
    return _confusion(spark, sf)


_OVERALL = """SELECT (SELECT sum(CASE WHEN label = prediction THEN n ELSE 0 END) / sum(n) FROM {c}) AS accuracy, avg("precision") AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1,
  sum("precision" * support) / sum(support) AS weighted_precision, sum(recall * support) / sum(support) AS weighted_recall, sum(f1 * support) / sum(support) AS weighted_f1, CAST(sum(support) AS BIGINT) AS n FROM by_class"""
_NINE = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1"]


def _rounded_sql(ctes: str, select: str, columns: list[str], digits: int = 9) -> str:
    return f"WITH {ctes}, answer AS ({select}) SELECT * REPLACE ({', '.join(f'round({c}, {digits}) AS {c}' for c in columns)}) FROM answer"


@register("d13_d15_d16_overall_metrics", _rounded_sql(f"{fx.CONFUSION}, {fx.class_metrics_sql()}", _OVERALL.format(c="confusion"), _NINE))
def d13(spark, sf):
    """Accuracy, macro and weighted averages."""
    return _rounded(metrics.overall_metrics(_confusion(spark, sf)), *_NINE, digits=9)


@register("d14_class_metrics", _rounded_sql(f"{fx.CONFUSION}, {fx.class_metrics_sql()}", "SELECT * FROM by_class", ['"precision"', "recall", "f1"]))
def d14(spark, sf):
    return _rounded(metrics.class_metrics(_confusion(spark, sf)), "precision", "recall", "f1", digits=9)


@register(
    "d17_binary_rates",
    f"""WITH {fx.CONFUSION}, c AS (SELECT CAST(sum(n) FILTER (label = 1 AND prediction = 1) AS BIGINT) AS tp, CAST(sum(n) FILTER (label = 0 AND prediction = 1) AS BIGINT) AS fp,
  CAST(sum(n) FILTER (label = 0 AND prediction = 0) AS BIGINT) AS tn, CAST(sum(n) FILTER (label = 1 AND prediction = 0) AS BIGINT) AS fn FROM confusion)
SELECT *, round(tp / (tp + fn), 9) AS tpr, round(fp / (fp + tn), 9) AS fpr, round(tn / (fp + tn), 9) AS tnr, round(fn / (tp + fn), 9) AS fnr FROM c""",
)
def d17(spark, sf):
    return _rounded(metrics.binary_rates(_confusion(spark, sf)), "tpr", "fpr", "tnr", "fnr", digits=9)


_SWEEP = """grid AS (SELECT t.threshold, c.label FROM (VALUES (0.0), (0.05), (0.1), (0.2), (0.5), (100.0)) t(threshold), (SELECT DISTINCT label FROM score) c),
cells AS (SELECT g.threshold::DOUBLE AS threshold, g.label, count(*) FILTER (s.label = g.label AND s.prediction = g.label) AS h, count(*) FILTER (s.label = g.label) AS support,
  count(*) FILTER (s.prediction = g.label) AS predicted, count(s.ordinal) AS covered FROM grid g LEFT JOIN (SELECT * FROM score WHERE "partition" = 'validation') s ON s.margin >= g.threshold GROUP BY ALL),
pq AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE h / predicted END AS p, CASE WHEN support = 0 THEN 0 ELSE h / support END AS q FROM cells)
SELECT threshold, max(covered) AS covered, round(avg(p), 9) AS macro_precision, round(avg(q), 9) AS macro_recall, round(avg(CASE WHEN p + q = 0 THEN 0 ELSE 2 * p * q / (p + q) END), 9) AS macro_f1 FROM pq GROUP BY 1"""


@register("d18_threshold_sweep", f"WITH {fx.FEATURES}, {_SWEEP}")
def d18(spark, sf):
    """Every threshold over the validation scores (C9, D18)."""
    rows = metrics.threshold_sweep(fx.scored(spark, sf), [0.0, 0.05, 0.1, 0.2, 0.5, 100.0], list(range(10)))
    return _rounded(rows, "macro_precision", "macro_recall", "macro_f1", digits=9)


@register(
    "d19_majority_baseline",
    f"""WITH {fx.PREDICTIONS}, c AS (SELECT label, count(*) AS n, count(*) FILTER (label = prediction) AS h FROM pred GROUP BY 1), a AS (SELECT arg_max(label, n) AS majority, max(n) / sum(n) AS m, sum(h) / sum(n) AS a FROM c)
SELECT majority, round(m, 9) AS majority_accuracy, round(a, 9) AS accuracy, round((a - m) / m, 9) AS gain FROM a""",
)
def d19(spark, sf):
    return _rounded(metrics.majority_baseline(fx.predictions(spark, sf)), "majority_accuracy", "accuracy", "gain", digits=9)


_SUMMARISED = "SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, min({c}) AS lowest, quantile_cont({c}::DOUBLE, 0.25) AS p25, quantile_cont({c}::DOUBLE, 0.5) AS p50, quantile_cont({c}::DOUBLE, 0.75) AS p75, max({c}) AS highest FROM lineitem"


@register("d20_column_summary", " UNION ALL ".join(_SUMMARISED.format(c=c) for c in ("l_quantity", "l_discount")))
def d20(spark, sf):
    return _rounded(metrics.column_summary(fx.table(spark, sf, "lineitem"), ["l_quantity", "l_discount"]), "mean", "stddev")


@register(
    "d21_error_breakdown",
    f"""WITH {fx.PREDICTIONS}, c AS (SELECT symbol, count(*) FILTER (prediction <> 1) AS missed, count(*) FILTER (prediction = 1) AS caught FROM pred WHERE label = 1 GROUP BY 1)
SELECT *, round(CASE WHEN sum(missed) OVER () = 0 THEN 0 ELSE missed / sum(missed) OVER () END, 9) AS missed_share, round(caught / sum(caught) OVER (), 9) AS caught_share FROM c""",
)
def d21(spark, sf):
    return _rounded(metrics.error_breakdown(fx.predictions(spark, sf), "symbol"), "missed_share", "caught_share", digits=9)


@register("d22_class_means", f"WITH {fx.FEATURES} SELECT target_value, c AS component, round(avg(v), 6) AS value FROM proj JOIN part USING (ordinal) GROUP BY ALL")
def d22(spark, sf):
    rows = model.class_means(model.project(fx.features(spark, sf), model.sign_matrix(64, 8, 7)))
    return _rounded(rows.withColumn("component", F.col("component").cast("long")), "value")


@register("d23_balanced_weights", f"WITH {fx.MAPPED}, c AS (SELECT target_value, count(*) AS n FROM mapped GROUP BY 1) SELECT target_value, n, round(sum(n) OVER () / (count(*) OVER () * n), 9) AS weight FROM c")
def d23(spark, sf):
    return _rounded(split.balanced_weights(fx.mapped(spark, sf)), "weight", digits=9)


@register("d24_inventory_totals", "SELECT source AS record_id, count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS size_bytes FROM documents GROUP BY 1")
def d24(spark, sf):
    return lineage.inventory_totals(fx.manifest(spark, sf), "record_id")


_LOG = """evs AS (SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS stage, value AS seconds FROM events)"""


@register("d25_stage_durations", f"WITH {_LOG}, g AS (SELECT DISTINCT run_id, s AS stage FROM evs, (VALUES ('view'), ('click'), ('never')) t(s)) SELECT g.run_id, g.stage, round(coalesce(sum(seconds), 0), 6) AS seconds FROM g LEFT JOIN evs USING (run_id, stage) GROUP BY ALL")
def d25(spark, sf):
    log = fx.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("stage"), F.col("value").alias("seconds"))
    return _rounded(experiments.stage_durations(log, spark.createDataFrame([("view",), ("click",), ("never",)], "stage string")), "seconds")


@register("d26_verify_counts", f"WITH {_INDEX} SELECT record_id, window_count + CAST(record_id AS BIGINT) % 3 AS stated, window_count AS counted, CAST(record_id AS BIGINT) % 3 = 0 AS ok FROM shards")
def d26(spark, sf):
    rows = fx.windows(spark, sf)
    index = lineage.shard_summary(rows).select("record_id", (F.col("window_count") + F.col("record_id").cast("long") % 3).alias("window_count"))
    return quality.verify_counts(rows, index)


@register(
    "d27_validate_split",
    f"""WITH {fx.SUMMARY}, broken AS (SELECT * FROM (VALUES ('whole', ''), ('counts', 'subjects_agree,records_agree,windows_agree,class_0_agree,class_1_agree,classes_sum,subjects_within_records'),
  ('name', 'subjects_agree,records_agree,windows_agree,class_0_agree,class_1_agree,partitions_known,none_empty')) t(said, rules))
SELECT said, x AS invariant, (SELECT count(*) = 3 FROM summary) AND NOT list_contains(string_split(rules, ','), x) AS ok FROM broken, (VALUES ('subjects_agree'), ('records_agree'), ('windows_agree'), ('class_0_agree'), ('class_1_agree'),
  ('partitions_known'), ('classes_sum'), ('subjects_within_records'), ('none_empty'), ('subjects_disjoint'), ('records_disjoint'), ('records_covered')) t(x)""",
)
def d27(spark, sf):
    """A true summary, one whose counts of one partition are too many, and one with a partition of another name that has no subjects."""
    rows, parts = fx.windows(spark, sf), fx.assignment(spark, sf)
    true, test = split.partition_summary(rows, parts), F.col("partition") == "test"
    more = lambda c, by: F.col(c) + F.when(test, by).otherwise(0)
    counts = true.withColumns({"subjects": more("subjects", 1_000_000), "records": more("records", 1), "windows": more("windows", 1), "class_0": more("class_0", 1), "class_1": more("class_1", 1)})
    name = true.withColumns({"partition": F.when(test, "other").otherwise(F.col("partition")), "subjects": F.when(test, 0).otherwise(F.col("subjects"))})
    found = None
    for said, summary in {"whole": true, "counts": counts, "name": name}.items():
        one = quality.validate_split(parts, summary, rows).select(F.lit(said).alias("said"), "invariant", "ok")
        found = one if found is None else found.unionByName(one)
    return found


@register(
    "d27_leaky_split",
    """WITH a AS (SELECT DISTINCT user_id // 2 AS s, user_id % 2 AS p FROM events) SELECT x AS invariant,
  CASE x WHEN 'subjects_disjoint' THEN (SELECT count(*) FROM (SELECT s FROM a GROUP BY s HAVING count(DISTINCT p) > 1)) = 0 WHEN 'records_covered' THEN (SELECT count(*) FROM events WHERE user_id % 5 = 0) = 0 ELSE true END AS ok
FROM (VALUES ('subjects_disjoint'), ('records_disjoint'), ('records_covered')) t(x)""",
)
def d27_leaky(spark, sf):
    """An assignment that parts the records of a subject and leaves some records out."""
    rows = fx.events(spark, sf).select("record_id", F.lit(0).alias("target_value"))
    parts = fx.record_subjects(spark, sf).withColumn("partition", F.when(F.col("record_id").cast("long") % 2 == 0, "train").otherwise("test"))
    parts = parts.where(F.col("record_id").cast("long") % 5 != 0)
    found = quality.validate_split(parts, split.partition_summary(rows, parts), rows)
    return found.where(F.col("invariant").isin("subjects_disjoint", "records_disjoint", "records_covered"))


# windows over rows


@register("e1_order_check", f"WITH {fx.EV} SELECT record_id, sample_index, coalesce(value < lag(value) OVER (PARTITION BY record_id ORDER BY sample_index), false) AS fell FROM ev")
def e1(spark, sf):
    rows = with_previous(fx.events(spark, sf).select("record_id", "sample_index", "value"), "record_id", "sample_index", {"before": "value"})
    return rows.select("record_id", "sample_index", F.coalesce(F.col("value") < F.col("before"), F.lit(False)).alias("fell"))


@register("e2_overlaps", f"WITH {_OVER} SELECT record_id, sample_index AS ordinal, o AS overlaps FROM over")
def e2(spark, sf):
    rows = windowing.with_overlap(windowing.window_bounds(fx.mapped(spark, sf), fx.records(spark, sf), fx.CONFIG))
    return rows.select("record_id", "ordinal", "overlaps")


@register("e3_split_subjects", f"WITH {fx.split_sql('SELECT DISTINCT CAST(user_id // 2 AS VARCHAR) AS s FROM events')} SELECT * FROM assign")
def e3(spark, sf):
    """Subjects in seeded order, cut by largest remainder (E3, E4)."""
    return split.split_subjects(fx.record_subjects(spark, sf), fx.SPLIT)


@register("e7_progress_estimates", """WITH l AS (SELECT CAST(user_id AS VARCHAR) AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ordinal, count(*) OVER (PARTITION BY user_id) AS total FROM events),
t AS (SELECT *, (ordinal * ordinal - CASE WHEN ordinal % 3 = 1 THEN 6 ELSE 0 END)::DOUBLE AS finished FROM l)
SELECT run_id, ordinal, greatest(0.0, finished - coalesce(lag(finished) OVER w, 0))::DOUBLE AS seconds, greatest(0.0, finished)::DOUBLE AS elapsed, ordinal AS done,
  CASE WHEN total <= ordinal THEN 0.0 WHEN ordinal >= 3 THEN round(finished / ordinal * (total - ordinal), 6) END AS eta FROM t WINDOW w AS (PARTITION BY run_id ORDER BY ordinal)""")
def e7(spark, sf):
    log = fx.events(spark, sf).select(F.col("record_id").alias("run_id"), (F.col("sample_index") + 1).alias("ordinal"))
    log = log.withColumn("finished", (F.col("ordinal") * F.col("ordinal") - F.when(F.col("ordinal") % 3 == 1, 6).otherwise(0)).cast("double"))  # runs backwards at times
    units = fx.records(spark, sf).select(F.col("record_id").alias("run_id"), F.col("sample_count").alias("total"))
    rows = _rounded(experiments.progress_estimates(log, units), "eta")
    return rows.withColumn("done", F.col("done").cast("long"))


@register("e8_first_n_per_key", f"WITH {fx.MAPPED}, k AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY sample_index) AS k FROM mapped WHERE target_value = 1) SELECT record_id, sample_index, symbol FROM k WHERE k <= 3")
def e8(spark, sf):
    return annotate.first_n_per_key(fx.mapped(spark, sf).where("target_value = 1"), "record_id", ["sample_index"], 3).select("record_id", "sample_index", "symbol")


@register(
    "e9_autocorrelation",
    f"""WITH {fx.WINDOWS}, m AS (SELECT record_id, sample_index AS ordinal, [w0, w1, w2, w3] AS w, (w0 + w1 + w2 + w3) / 4 AS mean FROM win), d AS (SELECT record_id, ordinal, list_transform(w, lambda x: x - mean) AS d FROM m),
h AS (SELECT record_id, ordinal, d, unnest(range(3)) AS lag FROM d)
SELECT record_id, ordinal, CAST(lag AS INTEGER) AS lag, round(list_dot_product(d[lag + 1:4], d[1:4 - lag]) / nullif(list_dot_product(d, d), 0), 6) AS r FROM h""",
)
def e9(spark, sf):
    return _rounded(windowing.autocorrelation(fx.windows(spark, sf), 2), "r")


def _leaky(spark, sf):
    rows = fx.windows(spark, sf)
    return split.random_row_split(rows, ["record_id", "ordinal"], 11)


_LEAKY = f"""{fx.WINDOWS}, drawn AS (SELECT *, CAST('0x' || substr(md5('11:' || record_id || ':' || sample_index), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM win),
leaky AS (SELECT *, CASE WHEN u < 0.72 THEN 'train' WHEN u < 0.72::DOUBLE + 0.18::DOUBLE THEN 'validation' ELSE 'test' END AS split FROM drawn)"""


@register("e10_leakage", f"WITH {_LEAKY} SELECT record_id, string_agg(DISTINCT split, ',' ORDER BY split) AS partitions FROM leaky GROUP BY 1 HAVING count(DISTINCT split) > 1")
def e10(spark, sf):
    return split.leakage(_leaky(spark, sf), "record_id", "split").withColumn("partitions", F.array_join("partitions", ","))


@register("e11_repeated_shards", "SELECT lang AS record_id, count(DISTINCT source) AS shards FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1")
def e11(spark, sf):
    return lineage.repeated_shards(fx.table(spark, sf, "documents").select(F.col("lang").alias("record_id"), F.col("source").alias("path")))


@register(
    "e12_overlap_leakage",
    f"""WITH {_LEAKY}, p AS (SELECT *, l < lag(r) OVER w AS o, split <> lag(split) OVER w AS x FROM leaky WINDOW w AS (PARTITION BY record_id ORDER BY sample_index))
SELECT record_id, count(*) FILTER (o) AS overlaps, count(*) FILTER (o AND x) AS leaks FROM p GROUP BY 1""",
)
def e12(spark, sf):
    return split.overlap_leakage(_leaky(spark, sf))


# order and limits


@register("f1_sorted_ids", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS record_id FROM events ORDER BY 1")
def f1(spark, sf):
    return fx.records(spark, sf).select("record_id").distinct().orderBy("record_id")


@register("f2_rank_candidates", "WITH c AS (SELECT p_partkey AS candidate_id, p_partkey AS ordinal, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_retailprice END AS metric FROM part) SELECT *, CAST(row_number() OVER (ORDER BY metric DESC NULLS LAST, ordinal) AS INTEGER) AS place FROM c")
def f2(spark, sf):
    rows = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("candidate_id"), F.col("p_partkey").alias("ordinal"), F.when(F.col("p_size") % 3 != 0, F.col("p_retailprice")).alias("metric"))
    return experiments.rank_candidates(rows)


@register("f3_run_usage", "SELECT source AS run_id, count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS size_bytes, max(doc_id) AS modified FROM documents GROUP BY 1 ORDER BY modified DESC, run_id")
def f3(spark, sf):
    docs = fx.table(spark, sf, "documents").select(F.col("source").alias("run_id"), F.col("n_chars").alias("size_bytes"), F.col("doc_id").alias("modified"))
    return lineage.run_usage(docs)


@register("f5_sample_rows", "SELECT doc_id, lang FROM documents ORDER BY md5('5:' || doc_id), doc_id LIMIT 50")
def f5(spark, sf):
    return experiments.sample_rows(fx.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 50, 5)


@register("f6_symbols_by_total", "SELECT event_type AS symbol, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, symbol")
def f6(spark, sf):
    return annotate.symbol_counts(fx.annotations(spark, sf)).where("level = 0").groupBy("symbol").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "symbol")


@register("f7_latest", "SELECT source AS path FROM documents ORDER BY doc_id DESC LIMIT 1")
def f7(spark, sf):
    return lineage.latest(fx.table(spark, sf, "documents").select(F.col("source").alias("path"), "doc_id"), "path", "doc_id")


# sets


@register("g1_union_shards", "SELECT user_id, event_id FROM events WHERE event_type = 'view' UNION ALL SELECT user_id, event_id FROM events WHERE event_type = 'click'")
def g1(spark, sf):
    rows = fx.table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return rows.where("event_type = 'view'").unionByName(rows.where("event_type = 'click'")).drop("event_type")


@register("g2_intersection", "SELECT user_id FROM events WHERE event_type = 'view' INTERSECT SELECT user_id FROM events WHERE event_type = 'error'")
def g2(spark, sf):
    rows = fx.table(spark, sf, "events")
    return rows.where("event_type = 'view'").select("user_id").intersect(rows.where("event_type = 'error'").select("user_id"))


@register("g3_difference", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def g3(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id").subtract(fx.table(spark, sf, "labels").select("doc_id"))


@register("g4_set_equality", "SELECT count(*) = 0 AS equal FROM (SELECT DISTINCT user_id FROM events) a FULL JOIN (SELECT DISTINCT user_id FROM events WHERE event_type <> 'view') b USING (user_id) WHERE a.user_id IS NULL OR b.user_id IS NULL")
def g4(spark, sf):
    rows = fx.table(spark, sf, "events")
    return quality.coverage_diff(rows, rows.where("event_type <> 'view'"), ["user_id"]).agg((F.count_if(F.col("status") != "ok") == 0).alias("equal"))


# scalars


@register(
    "h_text_rules",
    """SELECT page_id, length(trim(url)) > 0 AS filled, page_id % 8 IN (0, 5, 6) AS candidate, page_id % 3 <> 1 AS digest, page_id % 4 <> 2 AS "commit", page_id % 2 = 0 AS uuid, sha256(url) AS sha256 FROM pages""",
)
def h_text(spark, sf):
    """H1 to H4 and H16, on texts made of each page's id and address, some of which break each rule."""
    url, at = F.col("url"), F.col("page_id")
    digest, number = F.sha2(url.cast("binary"), 256), at.cast("string")
    named = F.element_at(F.array(number, F.concat(number, F.lit("-")), F.concat(number, F.lit("_")), F.concat(number, F.lit(".")), F.concat(F.lit("."), number), F.concat(F.lit("a-"), number), F.concat(number, F.lit("._b")), F.concat(F.lit("a/"), number)), (at % 8 + 1).cast("int"))
    parted = F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.substring(digest, 13, 4), F.substring(digest, 17, 4), F.substring(digest, 21, 12))
    return fx.table(spark, sf, "pages").select(
        "page_id",
        scalars.non_empty(url).alias("filled"),
        scalars.matches(named, scalars.CANDIDATE).alias("candidate"),
        scalars.matches(F.when(at % 3 == 1, F.concat(F.lit("x"), F.substring(digest, 2, 63))).otherwise(F.upper(digest)), scalars.DIGEST).alias("digest"),
        scalars.matches(F.substring(digest, 1, F.when(at % 4 == 2, 39).otherwise(40)), scalars.COMMIT).alias("commit"),
        scalars.matches(F.when(at % 2 == 0, parted).otherwise(F.concat(parted, F.lit("0"))), scalars.UUID).alias("uuid"),
        digest.alias("sha256"),
    )


@register("h5_https_url", "SELECT page_id, regexp_matches(url, '^https://[^/?#@]+(/[^?#]*)?$') AS good FROM pages")
def h5(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", scalars.is_https_url(F.col("url")).alias("good"))


@register("h6_file_url", "SELECT p_partkey, 'https://example.org/' || url_encode(p_name || '/' || p_brand || '#?é&+%=') AS url FROM part")
def h6(spark, sf):
    return fx.table(spark, sf, "part").select("p_partkey", scalars.file_url(F.lit("https://example.org/"), F.concat("p_name", F.lit("/"), "p_brand", F.lit("#?é&+%="))).alias("url"))


_PATHS = [("see /home/user/x ", 1), ("=/Users/me/a (/home/b) ", 2), ("x/home/user ", 0), (r"C:\data\x ", 1), (r"ab:\c ", 0), (r"'d:\e' ", 1), ("/homes/user /Users/ ", 0)]


@register(
    "h7_local_paths",
    rf"""SELECT doc_id, CAST(list_extract([{', '.join(str(n) for _, n in _PATHS)}], doc_id % {len(_PATHS)} + 1) AS INTEGER) + CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r"''(=]'),
  lambda x: regexp_matches(x, '^/Users/[^)]') OR regexp_matches(x, '^/home/[^)]') OR regexp_matches(x, '^[A-Za-z]:\\[^)]'))) AS INTEGER) AS n FROM documents""",
)
def h7(spark, sf):
    """H7 over whole texts, each behind a stretch that has paths, or what only looks like them."""
    before = F.element_at(F.array(*(F.lit(x) for x, _ in _PATHS)), (F.col("doc_id") % len(_PATHS) + 1).cast("int"))
    return fx.table(spark, sf, "documents").select("doc_id", F.size(scalars.local_paths(F.concat(before, F.coalesce("text", F.lit(""))))).alias("n"))


@register("h7_document_paths", r"""SELECT doc_id, len(regexp_extract_all(text, '(?:^|[ \t\n\x0B\f\r"''(=])(?:/Users/[^ \t\n\x0B\f\r"'')]+|/home/[^ \t\n\x0B\f\r"'')]+|[A-Za-z]:\\[^ \t\n\x0B\f\r"'')]+)')) AS n FROM documents""")
def h7_documents(spark, sf):
    """H7 over whole texts."""
    return fx.table(spark, sf, "documents").select("doc_id", F.size(scalars.local_paths(F.col("text"))).alias("n"))


@register("h8_utc_text", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS moment FROM events")
def h8(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", scalars.utc_text(F.col("ts")).alias("moment"))


@register("h9_minutes_seconds", "SELECT event_id, printf('%02d:%02d', CAST(round_even(value * 10, 0) AS BIGINT) // 60, CAST(round_even(value * 10, 0) AS BIGINT) % 60) AS clock FROM events WHERE value >= 0")
def h9(spark, sf):
    return fx.table(spark, sf, "events").where("value >= 0").select("event_id", scalars.minutes_seconds(F.col("value") * 10).alias("clock"))


@register("h10_is_close", "SELECT event_id, abs(value - round_even(value, 0)) <= 1e-8 + 0.05 * abs(round_even(value, 0)) AS whole FROM events")
def h10(spark, sf):
    value = F.col("value")
    return fx.table(spark, sf, "events").select("event_id", scalars.is_close(value, F.rint(value), relative=0.05).alias("whole"))


@register("h11_squared_distance", f"WITH {fx.WINDOWS} SELECT record_id, sample_index AS ordinal, round((w0 - w2) ** 2 + (w1 - w3) ** 2, 6) AS d FROM win")
def h11(spark, sf):
    return fx.windows(spark, sf).select("record_id", "ordinal", F.round(scalars.squared_distance(F.slice("window", 1, 2), F.slice("window", 3, 2)), 6).alias("d"))


@register("h12_projection", f"WITH {fx.FEATURES} SELECT ordinal, c AS component, round(v, 6) AS value FROM proj")
def h12(spark, sf):
    rows = model.project(fx.features(spark, sf), model.sign_matrix(64, 8, 7)).select("ordinal", F.posexplode("projected").alias("component", "value"))
    return _rounded(rows.withColumn("component", F.col("component").cast("long")), "value")


@register("h12_projection_by_joins", f"WITH {fx.FEATURES} SELECT ordinal, c AS component, round(v, 6) AS value FROM proj")
def h12_joins(spark, sf):
    """The same by joins, which make a row for each feature and component."""
    rows = fx.features(spark, sf)
    rows = model.project_sql(rows, model.sign_projection(rows, 8, 7), ["ordinal"])
    return _rounded(rows.withColumn("component", F.col("component").cast("long")), "value")


@register("h13_array_functions", f"WITH {fx.WINDOWS} SELECT record_id, sample_index AS ordinal, 4 AS width, least(w0, w1, w2, w3) AS lowest, list_position([w0, w1, w2, w3], least(w0, w1, w2, w3)) AS place, len(list_distinct([w0, w1, w2, w3])) AS different FROM win")
def h13(spark, sf):
    w = F.col("window")
    return fx.windows(spark, sf).select("record_id", "ordinal", F.size(w).alias("width"), F.array_min(w).alias("lowest"), F.array_position(w, F.array_min(w)).cast("int").alias("place"), F.size(F.array_distinct(w)).cast("long").alias("different"))


@register("h14_count_map", "WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) SELECT lang, string_agg(source || '=' || n, ',' ORDER BY source) AS counts FROM c GROUP BY 1")
def h14(spark, sf):
    counts = fx.table(spark, sf, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.groupBy("lang").agg(scalars.count_map(F.collect_list(F.struct("source", "n"))).alias("m"))
    return rows.select("lang", F.array_join(F.transform(F.map_entries("m"), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string"))), ",").alias("counts"))


@register("h15_json", "SELECT doc_id, lang, n_chars FROM documents")
def h15(spark, sf):
    """Encoded and decoded again."""
    text = fx.table(spark, sf, "documents").select(F.to_json(F.struct("doc_id", "lang", "n_chars")).alias("json"))
    return text.select(F.from_json("json", "doc_id bigint, lang string, n_chars bigint").alias("x")).select("x.*")


# composites


@register("i1_grouped_split", f"WITH {fx.SPLIT_SQL} SELECT * FROM member")
def i1(spark, sf):
    return fx.assignment(spark, sf)


@register("i2_record_split", f"WITH {fx.split_sql('SELECT DISTINCT CAST(user_id AS VARCHAR) AS s FROM events')} SELECT subject_id AS record_id, \"partition\" FROM assign")
def i2(spark, sf):
    rows = fx.records(spark, sf).select("record_id", F.col("record_id").alias("subject_id"))
    return split.grouped_split(rows, rows, fx.SPLIT).select("record_id", "partition")


@register("i3_shuffled_split")
def i3(spark, sf):
    return split.split_subjects_shuffled(fx.record_subjects(spark, sf), fx.SPLIT)


@register("i4_random_row_split", f"WITH {_LEAKY} SELECT record_id, sample_index AS ordinal, split FROM leaky")
def i4(spark, sf):
    return _leaky(spark, sf).select("record_id", "ordinal", "split")


_QUALITY = quality.SplitQualityConfig(minimum_subjects=2, minimum_records=30, minimum_windows=2000, minimum_positives=1500, required_classes=(0, 1, 2), required_partitions=("validation", "test"), maximum_deviation=0.001, warn_only=("required_class_coverage",))
_VIOLATIONS = f"""{fx.SUMMARY}, bad AS (
SELECT 'minimum_subjects' AS "check", "partition", 'error' AS severity, subjects || ' < 2' AS message FROM summary WHERE subjects < 2
UNION ALL SELECT 'minimum_records', "partition", 'error', records || ' < 30' FROM summary WHERE records < 30
UNION ALL SELECT 'minimum_windows', "partition", 'error', windows || ' < 2000' FROM summary WHERE windows < 2000
UNION ALL SELECT 'minimum_positives', "partition", 'error', class_1 || ' < 1500' FROM summary WHERE class_1 < 1500
UNION ALL SELECT 'ratio_deviation', "partition", 'error', 'subject share differs by over 0.001' FROM summary
  WHERE abs(subjects / (SELECT sum(subjects) FROM summary) - CASE WHEN "partition" = 'train' THEN 0.7 ELSE 0.15 END) > 0.001
UNION ALL SELECT 'required_class_coverage', "partition", 'warning', 'no class 2' FROM summary WHERE "partition" <> 'train'
UNION ALL SELECT 'required_class_coverage', "partition", 'warning', 'no class 0' FROM summary WHERE "partition" <> 'train' AND class_0 = 0
UNION ALL SELECT 'required_class_coverage', "partition", 'warning', 'no class 1' FROM summary WHERE "partition" <> 'train' AND class_1 = 0)"""


@register("i5_i13_split_quality", f"WITH {_VIOLATIONS} SELECT * FROM bad")
def i5(spark, sf):
    """Checks I5 to I10 with severities (I13), in the order of F4."""
    return quality.ordered_violations(quality.split_quality(fx.windows(spark, sf), fx.assignment(spark, sf), _QUALITY))


@register("i11_i12_disjoint", """WITH a AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS r, CAST(user_id // 2 AS VARCHAR) AS s, CASE WHEN user_id % 2 = 0 THEN 'train' ELSE 'test' END AS p FROM events)
SELECT 'subject_disjoint' AS "check", s || ' in test, train' AS message FROM a GROUP BY s HAVING count(DISTINCT p) > 1""")
def i11(spark, sf):
    """An assignment that separates the two records of a subject."""
    rows = fx.record_subjects(spark, sf).withColumn("partition", F.when(F.col("record_id").cast("long") % 2 == 0, "train").otherwise("test"))
    found = quality.split_quality(fx.windows(spark, sf), rows, _QUALITY).where(F.col("check").endswith("disjoint"))
    return found.select("check", "message")


@register("i13_quality_status", f"WITH {_VIOLATIONS} SELECT 'failed' AS status, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings FROM bad")
def i13(spark, sf):
    return quality.quality_status(i5(spark, sf))


_SHARES = ["subject_share", "record_share", "shard_share", "window_share", "positive_share", "prevalence", "deviation"]


@register(
    "i14_split_diagnostics",
    f"""WITH {fx.SUMMARY}, held AS (SELECT "partition", count(*) + count(*) FILTER (CAST(record_id AS BIGINT) % 3 = 0) AS shards FROM member GROUP BY 1),
d AS (SELECT "partition", subjects, records, coalesce(shards, 0) AS shards, windows, class_0, class_1, subjects / sum(subjects) OVER () AS subject_share, records / sum(records) OVER () AS record_share,
  coalesce(shards, 0) / sum(shards) OVER () AS shard_share, windows / sum(windows) OVER () AS window_share, class_1 / sum(class_1) OVER () AS positive_share,
  CASE WHEN windows = 0 THEN 0 ELSE class_1 / windows END AS prevalence, CASE WHEN "partition" = 'train' THEN 0.7::DOUBLE ELSE 0.15::DOUBLE END AS asked FROM summary LEFT JOIN held USING ("partition"))
SELECT * REPLACE ({', '.join(f'round({c}, 9) AS {c}' for c in _SHARES[:-1])}), round(abs(subject_share - asked), 9) AS deviation FROM d""",
)
def i14(spark, sf):
    """Every third record lies in two shards, one of which is listed twice."""
    parts = F.when(F.col("record_id").cast("long") % 3 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    shards = fx.records(spark, sf).select("record_id", F.explode(parts).alias("part")).select("record_id", F.concat_ws("/", F.lit("shard"), "record_id", "part").alias("path"))
    return _rounded(quality.split_diagnostics(fx.windows(spark, sf), fx.assignment(spark, sf), shards=shards), *_SHARES, digits=9)


_MANIFEST = "run AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'config' ELSE 'evidence' END AS role, 'doc/' || doc_id AS path, n_chars AS size_bytes, sha256(\"text\") AS sha256 FROM documents)"


@register("i16_run_manifest", f"WITH {_MANIFEST} SELECT '{fx.RUN}' AS run_id, * FROM run")
def i16(spark, sf):
    return _run_files(spark, sf)


@register("i16_manifest_digest", f"WITH {_MANIFEST} SELECT '{fx.RUN}' AS run_id, count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS size_bytes, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', role, path, size_bytes, sha256)), 1, 8) AS BIGINT)) AS BIGINT) AS digest FROM run")
def i16_digest(spark, sf):
    return lineage.manifest_digest(_run_files(spark, sf))


_LANES = ", ".join(f"CAST(sum(CAST('0x' || substr(d, {8 * k + 1}, 8) AS BIGINT)) AS BIGINT)" for k in range(8))


@register("i16_manifest_root", f"WITH {_MANIFEST}, r AS (SELECT *, sha256(concat_ws('|', size_bytes, sha256, role || ':' || path)) AS d FROM run) SELECT '{fx.RUN}' AS run_id, count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS size_bytes, sha256(concat_ws('|', count(*), {_LANES})) AS digest FROM r")
def i16_root(spark, sf):
    return hashtree.manifest_root(_run_files(spark, sf))


def _approvals(spark, sf):
    """Approvals of a run that has files of both roles, and of one that lacks configuration."""
    good, other = _run_files(spark, sf), _run_files(spark, sf, OTHER_RUN, "evidence")
    both = good.unionByName(other)
    return lineage.record_approval(both, _roles(spark), fx.RUN, "owner").unionByName(lineage.record_approval(both, _roles(spark), OTHER_RUN, "owner"))


@register(
    "i17_record_approval",
    f"""WITH {_MANIFEST}, runs AS (SELECT '{fx.RUN}' AS run_id, role FROM run UNION ALL SELECT '{OTHER_RUN}', 'evidence' FROM run)
SELECT run_id, 'owner' AS owner FROM runs GROUP BY run_id HAVING count(DISTINCT role) = 2""",
)
def i17(spark, sf):
    return _approvals(spark, sf)


@register("i18_evaluate_held_out", _rounded_sql(f"""{fx.FEATURES}, cells AS (SELECT a AS label, b AS prediction, (SELECT count(*) FROM score WHERE label = a AND prediction = b AND "partition" = 'test') AS n FROM range(10) x(a), range(10) y(b)), {fx.class_metrics_sql("cells")}""", _OVERALL.format(c="cells"), _NINE))
def i18(spark, sf):
    """Test rows, read through the gate, scored and judged."""
    features = fx.feature_partitions(spark, sf)
    rows = lineage.gated_partition(features, i17(spark, sf), fx.RUN)
    scored = model.score(rows, fx.model(spark, sf, features)).select(F.col("target_value").alias("label"), "prediction")
    return _rounded(metrics.overall_metrics(metrics.confusion_matrix(scored, list(range(10)))), *_NINE, digits=9)


_POLICY = {"policy_id": "held-out", "version": 1, "disclosures": ["seed", "data"], "limitations": ["small"], "prohibited_claims": []}


@register(
    "i18_disclosure",
    f"""WITH {fx.FEATURES} SELECT '{fx.RUN}' AS run_id, 'owner' AS owner, count(DISTINCT feat.record_id) AS records, count(*) AS windows, 'held-out' AS policy_id, 1 AS policy_version, 'data,seed' AS disclosures, 'small' AS limitations,
  '' AS prohibited_claims FROM part JOIN feat USING (ordinal) WHERE "partition" = 'test'""",
)
def i18_disclosure(spark, sf):
    """What the held-out evaluation of an approved run discloses; the run without approval discloses nothing."""
    approvals, features = i17(spark, sf), fx.feature_partitions(spark, sf)
    rows = None
    for run in (fx.RUN, OTHER_RUN):
        one = lineage.disclosure(lineage.gated_partition(features, approvals, run), approvals, run, _POLICY)
        rows = one if rows is None else rows.unionByName(one)
    return rows.withColumns({c: F.array_join(c, ",") for c in ("disclosures", "limitations", "prohibited_claims")})


@register("i20_reconcile", f"WITH {fx.SPLIT_SQL}, n AS (SELECT (SELECT count(*) FROM win) AS extracted, (SELECT count(*) FROM win JOIN member USING (record_id)) AS whole, (SELECT count(*) FROM win JOIN member USING (record_id) WHERE \"partition\" <> 'test') AS part) SELECT extracted, unnest([whole, part]) AS assigned, unnest([whole, part]) = extracted AS ok FROM n")
def i20(spark, sf):
    """All windows against all of the split, and against a split that lost its test part."""
    rows, parts = fx.windows(spark, sf), fx.assignment(spark, sf)
    return lineage.reconcile(rows, rows.join(parts, "record_id")).unionByName(lineage.reconcile(rows, rows.join(parts.where("partition <> 'test'"), "record_id")))


# models


@register("j1_sign_projection", "WITH w AS (SELECT max(len(embedding)) AS width FROM embeddings) SELECT CAST(f AS INTEGER) AS feature, CAST(c AS INTEGER) AS component, CASE WHEN substr(md5('7:' || f || ':' || c), 1, 1) < '8' THEN 1.0 ELSE -1.0 END / sqrt(8::DOUBLE) AS weight FROM w, unnest(range(width)) a(f), range(8) b(c)")
def j1(spark, sf):
    return model.sign_projection(fx.features(spark, sf), 8, 7)


@register("j2_fit_nearest_centroid", f"WITH {fx.FEATURES} SELECT class, CAST(c AS INTEGER) AS component, round(m, 6) AS value FROM cent")
def j2(spark, sf):
    return _rounded(model.model_rows(spark, fx.model(spark, sf))[1].drop("place"), "value")


@register("j2_model_metadata", f"WITH {fx.FEATURES}, t AS (SELECT feat.* FROM part JOIN feat USING (ordinal) WHERE \"partition\" = 'train'), c AS (SELECT target_value, count(*) AS n FROM t GROUP BY 1) SELECT 'train' AS \"partition\", count(DISTINCT record_id) AS records, count(*) AS windows, 64 AS features, 8 AS components, (SELECT string_agg(target_value || '=' || n, ',' ORDER BY target_value) FROM c) AS classes FROM t")
def j2_metadata(spark, sf):
    rows = fx.feature_partitions(spark, sf)
    found = model.model_metadata(fx.model(spark, sf, rows), rows.where("partition = 'train'"))
    return found.withColumn("classes", F.array_join(F.transform(F.map_entries("classes"), lambda x: F.concat_ws("=", x["key"].cast("string"), x["value"].cast("string"))), ","))


@register("j3_score", f"WITH {fx.FEATURES} SELECT ordinal, prediction, round(margin, 6) AS margin FROM score")
def j3(spark, sf):
    """Nearest class (E6) and margin (E5) in one Arrow pass."""
    rows = fx.feature_partitions(spark, sf)
    return _rounded(model.score(rows, fx.model(spark, sf, rows)).select("ordinal", "prediction", "margin"), "margin")


@register("j3_score_by_joins", f"WITH {fx.FEATURES} SELECT ordinal, prediction, round(margin, 6) AS margin FROM score")
def j3_joins(spark, sf):
    weights, centroids = model.model_rows(spark, fx.model(spark, sf))
    centroids = centroids.drop("place")
    return _rounded(model.score_sql(fx.features(spark, sf), weights, centroids, ["ordinal"]), "margin")


@register("j4_evaluate_validation", _rounded_sql(f"""{fx.FEATURES}, cells AS (SELECT a AS label, b AS prediction, (SELECT count(*) FROM score WHERE label = a AND prediction = b AND "partition" = 'validation') AS n FROM range(10) x(a), range(10) y(b)), {fx.class_metrics_sql("cells")}""", _OVERALL.format(c="cells"), _NINE))
def j4(spark, sf):
    """Validation rows, once the files are as recorded and the windows as many as the index says."""
    rows, files = fx.feature_partitions(spark, sf), fx.manifest(spark, sf).withColumnRenamed("record_id", "role")
    index = fx.features(spark, sf).join(rows.where("partition = 'validation'").select("record_id").distinct(), "record_id").groupBy("record_id").agg(F.count(F.lit(1)).alias("window_count"))
    return _rounded(model.evaluate(rows, fx.model(spark, sf, rows), index, files, files, list(range(10))), *_NINE, digits=9)


@register("j5_forest")
def j5(spark, sf):
    rows = fx.feature_partitions(spark, sf)
    fitted = model.fit_forest(rows.where("partition = 'train'"))
    return model.predict(fitted, rows.where("partition = 'validation'")).select("ordinal", "label", "prediction")


@register("j6_gradient_boosting")
def j6(spark, sf):
    rows = fx.feature_partitions(spark, sf).withColumn("target_value", (F.col("target_value") > 4).cast("int"))
    fitted = model.fit_gbt(rows.where("partition = 'train'"))
    return model.predict(fitted, rows.where("partition = 'validation'")).select("ordinal", "label", "prediction")


@register("j6_histogram_boosting")
def j6_histograms(spark, sf):
    rows = fx.feature_partitions(spark, sf).withColumn("target_value", (F.col("target_value") > 4).cast("int"))
    fitted = boosting.fit_boosted_trees(rows.where("partition = 'train'"), rounds=20)
    found = boosting.predict_boosted(fitted, rows.where("partition = 'validation'"))
    return found.select("ordinal", F.col("target_value").alias("label"), F.round("probability", 6).alias("probability"), "prediction")


@register("j7_depth_sweep")
def j7(spark, sf):
    rows = fx.feature_partitions(spark, sf)
    return model.depth_sweep(rows.where("partition = 'train'"), rows.where("partition = 'validation'"), range(2, 21))
