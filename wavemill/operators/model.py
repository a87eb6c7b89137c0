"""Random projection, nearest centroids, and tree models."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wavemill.operators.lineage import read_partition, verify_lineage
from wavemill.operators.metrics import confusion_matrix, overall_metrics
from wavemill.operators.quality import require_none, verify_counts
from wavemill.sources.scratch import shared_path


@dataclass(frozen=True)
class CentroidModel:
    """Projection (features x components), classes in ascending order, and their centroids (classes x components)."""

    projection: np.ndarray
    classes: list[int]
    centroids: np.ndarray


def sign_projection(rows: DataFrame, components: int, seed: int, vector: str = "window") -> DataFrame:
    """feature, component, weight for the widest vector of ``rows``: signs from an md5 of seed and place, over the root of
    components, so SQL can make it too. Only the width is aggregated; no vectors give no rows."""
    width = rows.agg(F.max(F.size(vector)).alias("width")).where("width > 0")
    places = width.select(F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("feature"))
    places = places.withColumn("component", F.explode(F.sequence(F.lit(0), F.lit(components - 1))))
    digit = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "feature", "component")), 1, 1), 16, 10).cast("int")
    return places.withColumn("weight", F.when(digit < 8, 1.0).otherwise(-1.0) / F.lit(math.sqrt(components)))


def sign_matrix(features: int, components: int, seed: int) -> np.ndarray:
    """The same as a matrix."""
    low = lambda f, c: hashlib.md5(f"{seed}:{f}:{c}".encode()).hexdigest()[0] < "8"
    return np.array([[1.0 if low(f, c) else -1.0 for c in range(components)] for f in range(features)]) / math.sqrt(components)


def projection_matrix(features: int, components: int, seed: int) -> np.ndarray:
    """Seeded Gaussian entries over the root of components."""
    return np.random.default_rng(seed).standard_normal((features, components)) / math.sqrt(components)


def project(rows: DataFrame, projection: np.ndarray, vector: str = "window") -> DataFrame:
    """Adds projected array<double> in one Arrow pass; a vector that is null or of another length gives null."""
    shared = rows.sparkSession.sparkContext.broadcast(projection)
    others = [c for c in rows.columns if c != vector]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rows.columns)
    rows = rows.select(*others, vector)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = shared.value
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            sizes = np.nan_to_num(np.asarray(pa.compute.list_value_length(column).fill_null(-1)), nan=-1)
            fit = sizes == len(matrix)
            values = np.asarray(column.filter(pa.array(fit)).flatten(), dtype=np.float64).reshape(-1, len(matrix)) @ matrix
            offsets = np.concatenate([[0], np.cumsum(fit * matrix.shape[1])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()), mask=pa.array(~fit))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*others, vector, "projected"])

    order = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rows.columns)
    return rows.mapInArrow(multiply, f"{order}, projected array<double>")


def project_sql(rows: DataFrame, projection: DataFrame, key: Sequence[str], vector: str = "window") -> DataFrame:
    """The same by DataFrame operations only: key, component, value."""
    long = rows.select(*key, F.posexplode(vector).alias("feature", "x"))
    return long.join(projection, "feature").groupBy(*key, "component").agg(F.sum(F.col("x").cast("double") * F.col("weight")).alias("value"))


def class_mean_vectors(projected: DataFrame, label: str = "target_value") -> DataFrame:
    """Mean projected vector of each class: label, mean array<double>. Sums of whole vectors are merged, first where rows lie."""
    rows = projected.where(F.col("projected").isNotNull()).select(label, array_to_vector("projected").alias("v"))
    return rows.groupBy(label).agg(Summarizer.mean(F.col("v")).alias("mean")).select(label, vector_to_array("mean").alias("mean"))


def class_means(projected: DataFrame, label: str = "target_value") -> DataFrame:
    """The same by component: label, component, value. Only the means of the classes become rows."""
    return class_mean_vectors(projected, label).select(label, F.posexplode("mean").alias("component", "value"))


def fit_nearest_centroid(train: DataFrame, projection: np.ndarray, vector: str = "window", label: str = "target_value") -> CentroidModel:
    """Centroids of the rows given, which should be those of the train partition only; the driver gets classes x components numbers."""
    means = class_means(project(train.select(label, vector), projection, vector), label).toPandas()
    classes = sorted(int(c) for c in means[label].unique())
    if len(classes) < 2:
        raise ValueError("training needs two classes at least")
    centroids = np.zeros((len(classes), projection.shape[1]))
    centroids[[classes.index(int(c)) for c in means[label]], means["component"]] = means["value"]
    return CentroidModel(projection, classes, centroids)


def model_rows(spark: SparkSession, model: CentroidModel) -> tuple[DataFrame, DataFrame]:
    """The model as tables: (feature, component, weight) and (place, class, component, value), the place being the class's in
    the model."""
    weights = [(f, c, float(x)) for (f, c), x in np.ndenumerate(model.projection)]
    values = [(k, model.classes[k], c, float(x)) for (k, c), x in np.ndenumerate(model.centroids)]
    return spark.createDataFrame(weights, "feature int, component int, weight double"), spark.createDataFrame(values, "place int, class int, component int, value double")


def model_metadata(model: CentroidModel, train: DataFrame, label: str = "target_value") -> DataFrame:
    """One row on what a model was fitted on: partition, records, windows, features, components, and windows by class as a
    sorted map."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(label, "n")))).alias("classes"))
    rows = train.agg(F.count_distinct("record_id").alias("records"), F.count(F.lit(1)).alias("windows"))
    return rows.crossJoin(counts).select(F.lit("train").alias("partition"), "records", "windows", F.lit(model.projection.shape[0]).alias("features"), F.lit(model.projection.shape[1]).alias("components"), "classes")


def validate_model(projection: DataFrame, centroids: DataFrame) -> DataFrame:
    """rule, ok: both tables full and finite, at least two classes, each in one place and in ascending order, components alike.
    An empty table breaks the rules on what it should hold."""
    finite = lambda c: F.coalesce(F.bool_and(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    whole = lambda rows, columns: (F.count(F.lit(1)) == F.count_distinct(rows) * F.count_distinct(columns)) & (F.count(F.lit(1)) == F.count_distinct(rows, columns)) & (F.count(F.lit(1)) > 0)
    order = F.transform(F.array_sort(F.collect_set(F.struct("place", "class"))), lambda x: x["class"])
    p = projection.agg(whole("feature", "component").alias("projection_full"), finite("weight").alias("projection_finite"), F.count_distinct("component").alias("m"))
    c = centroids.agg(
        whole("place", "component").alias("centroids_full"),
        finite("value").alias("centroids_finite"),
        (F.count_distinct("class") >= 2).alias("two_classes"),
        (order == F.array_sort(F.collect_set("class"))).alias("classes_sorted"),
        F.count_distinct("component").alias("k"),
    )
    both = p.crossJoin(c).withColumn("same_components", F.col("m") == F.col("k"))
    rules = ["projection_full", "projection_finite", "centroids_full", "centroids_finite", "two_classes", "classes_sorted", "same_components"]
    return both.select(F.inline(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("ok")) for r in rules))))


def incompatible_rows(rows: DataFrame, model: CentroidModel, vector: str = "window", label: str = "target_value") -> DataFrame:
    """Rows that can't be scored: a vector of another width, or a label that the model doesn't have."""
    wrong = F.coalesce(F.size(vector) != F.lit(len(model.projection)), F.lit(True)) | ~F.coalesce(F.col(label).isin(model.classes), F.lit(False))
    return rows.where(wrong)


def score(rows: DataFrame, model: CentroidModel, vector: str = "window") -> DataFrame:
    """Adds distances (squared, by class), prediction (nearest class, ties to the lowest) and margin (second less first).

    One Arrow pass does the product and |x|^2 - 2 x.c + |c|^2, so no rows x classes x components array is made.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    projected = project(rows, model.projection, vector)
    kinds = ", ".join(f"`{c}` {projected.schema[c].dataType.simpleString()}" for c in projected.columns)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, centroids = np.array(shared.value.classes, np.int32), shared.value.centroids
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            fit = ~np.asarray(column.is_null())
            x = np.asarray(column.filter(pa.array(fit)).flatten(), dtype=np.float64).reshape(-1, centroids.shape[1])
            d = np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(axis=1), 0)
            order = np.sort(d, axis=1)
            prediction, margin = np.zeros(len(fit), np.int32), np.zeros(len(fit))
            prediction[fit], margin[fit] = classes[d.argmin(axis=1)] if len(d) else [], (order[:, 1] - order[:, 0]) if len(d) else []
            offsets = np.concatenate([[0], np.cumsum(fit * len(classes))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(d.ravel()), mask=pa.array(~fit))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(prediction, mask=~fit), pa.array(margin, mask=~fit)], [*batch.schema.names, "distances", "prediction", "margin"])

    return projected.mapInArrow(nearest, f"{kinds}, distances array<double>, prediction int, margin double").drop("projected")


def score_sql(rows: DataFrame, projection: DataFrame, centroids: DataFrame, key: Sequence[str], vector: str = "window") -> DataFrame:
    """The same by DataFrame operations only: key, prediction, margin."""
    long = project_sql(rows, projection, key, vector)
    distance = long.join(centroids.withColumnRenamed("value", "center"), "component").groupBy(*key, "class").agg(F.sum((F.col("value") - F.col("center")) ** 2).alias("d"))
    order = Window.partitionBy(*key).orderBy("d", "class")
    placed = distance.withColumns({"place": F.row_number().over(order), "next": F.lead("d").over(order)})
    return placed.where("place = 1").select(*key, F.col("class").alias("prediction"), (F.col("next") - F.col("d")).alias("margin"))


def evaluate(rows: DataFrame, model: CentroidModel, index: DataFrame, recorded: DataFrame, observed: DataFrame, classes: Sequence[int], partition: str = "validation") -> DataFrame:
    """Overall metrics of a model on one partition, as one job that first proves what it reads.

    ``rows`` has record_id, partition, target_value and window; ``index`` record_id and window_count of the partition;
    ``recorded`` (role, path, size_bytes, sha256) what the training run noted of its files, and ``observed`` the files now. A
    file that is missing or differs, or a record whose windows are not as many as the index says, fails the job.
    """
    own = read_partition(rows, partition)
    own = require_none(own, verify_lineage(recorded, observed).where("not ok"), F.concat_ws(" ", F.lit("not as recorded:"), "role", "path"))
    own = require_none(own, verify_counts(own, index).where("not ok"), F.concat(F.lit("not as many windows as in the index: record "), F.col("record_id")))
    scored = score(own, model).select(F.col("target_value").alias("label"), "prediction")
    return overall_metrics(confusion_matrix(scored, classes))


def _vectors(rows: DataFrame, vector: str) -> DataFrame:
    return rows.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))


def fit_forest(train: DataFrame, vector: str = "window", label: str = "target_value", depth: int = 10, leaf: int = 3, trees: int = 20, seed: int = 0):
    """Random forest on arrays of features; returns the fitted MLlib model, which takes a features column."""
    from pyspark.ml.classification import RandomForestClassifier

    return RandomForestClassifier(labelCol=label, maxDepth=depth, minInstancesPerNode=leaf, numTrees=trees, seed=seed).fit(_vectors(train, vector))


def fit_gbt(train: DataFrame, vector: str = "window", label: str = "target_value", rounds: int = 20, depth: int = 5, seed: int = 0):
    """Gradient boosting with balanced class weights."""
    from pyspark.ml.classification import GBTClassifier

    from wavemill.operators.split import balanced_weights

    weights = balanced_weights(train, label).select(label, "weight")
    return GBTClassifier(labelCol=label, weightCol="weight", maxIter=rounds, maxDepth=depth, seed=seed).fit(_vectors(train.join(F.broadcast(weights), label), vector))


def predict(model, rows: DataFrame, vector: str = "window", label: str = "target_value") -> DataFrame:
    scored = model.transform(_vectors(rows, vector))
    return scored.withColumns({"label": F.col(label).cast("int"), "prediction": F.col("prediction").cast("int")}).drop("features", "rawPrediction", "probability")


@dataclass(frozen=True)
class TreeNodes:
    """Nodes of all trees of a forest, the children of node v at ``left[v]`` and ``right[v]`` (v itself: a leaf), class counts of
    the rows that reach each, and ``until``: the deepest limit on the depth at which a node is, or is merged into, a leaf."""

    roots: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    counts: np.ndarray
    until: np.ndarray

    def predictions(self, x: np.ndarray, depths: Sequence[int]) -> Iterator[np.ndarray]:
        """Classes of the rows of ``x`` by the forest cut at each of the ascending ``depths``: the largest sum, over trees in
        order, of class shares in the node that a row ends in."""
        at = np.repeat(self.roots[:, None], len(x), axis=1)
        for depth in depths:
            votes = np.zeros((len(x), self.counts.shape[1]))
            for place in at:
                while len(go := np.flatnonzero(self.until[place] < depth)):
                    node = place[go]
                    place[go] = np.where(x[go, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
                share = self.counts[place].astype(np.float64)
                votes += share / share.sum(axis=1, keepdims=True)
            yield votes.argmax(axis=1)


def tree_nodes(forest) -> TreeNodes:
    """The nodes of a fitted MLlib forest, from its own saved form."""
    spark = SparkSession.active()
    forest.write().save(path := shared_path(spark, "forest"))
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    rows = rows.select("treeID", "id", "prediction", F.col("impurityStats").cast("array<float>").alias("counts"), "leftChild", "rightChild", F.col("split.featureIndex").alias("feature"), F.coalesce(F.get("split.leftCategoriesOrThreshold", F.lit(0)), F.lit(0.0)).alias("threshold"))
    found = rows.toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")]).combine_chunks()
    tree, own, left, right = (found[c].to_numpy() for c in ("treeID", "id", "leftChild", "rightChild"))
    first = np.searchsorted(tree, np.arange(tree[-1] + 1))
    leaf, here = left < 0, np.arange(len(tree))
    if (own != here - first[tree]).any():
        raise ValueError("nodes of a tree are not numbered from 0")
    left, right = np.where(leaf, here, first[tree] + left), np.where(leaf, here, first[tree] + right)
    level, some = np.zeros(len(tree), np.int32), first
    levels = []
    while len(some := some[~leaf[some]]):
        levels.append(some)
        level[left[some]] = level[right[some]] = level[some] + 1
        some = np.concatenate([left[some], right[some]])
    # MLlib merges two leaves of one prediction, at any limit on the depth
    prediction, until = found["prediction"].to_numpy(), np.where(leaf, np.iinfo(np.int32).max, level).astype(np.int32)
    for some in reversed(levels):
        alike = some[prediction[left[some]] == prediction[right[some]]]
        until[alike] = np.minimum(until[left[alike]], until[right[alike]])
    counts = np.asarray(found["counts"].combine_chunks().flatten()).reshape(len(tree), -1)
    return TreeNodes(first, left.astype(np.int32), right.astype(np.int32), found["feature"].to_numpy().astype(np.int32), found["threshold"].to_numpy(), counts, until)


def _accuracies(rows: DataFrame, nodes: TreeNodes, depths: Sequence[int], vector: str, label: str) -> dict[int, float | None]:
    """Accuracy of a forest cut at each depth, in one pass."""
    shared = rows.sparkSession.sparkContext.broadcast(nodes)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                truth = np.asarray(batch.column(0))
                x = np.asarray(batch.column(1).flatten()).reshape(len(truth), -1)
                hits = [int((found == truth).sum()) for found in shared.value.predictions(x, depths)]
                yield pa.RecordBatch.from_arrays([pa.array(list(depths), pa.int32()), pa.array(hits, pa.int64()), pa.array([len(truth)] * len(hits), pa.int64())], ["depth", "hits", "n"])

    pairs = rows.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    found = pairs.mapInArrow(judged, "depth int, hits bigint, n bigint").groupBy("depth").agg(F.sum("hits") / F.sum("n"))
    return dict.fromkeys(depths) | dict(map(tuple, found.collect()))


def depth_sweep(train: DataFrame, validation: DataFrame, depths: Sequence[int], vector: str = "window", label: str = "target_value", trees: int = 20) -> DataFrame:
    """Accuracy by depth on both parts, and the gap between: depth, train_accuracy, validation_accuracy, gap.

    One forest is fitted, at the largest depth, on all training rows. A tree grows from its root, and no split looks at those
    below it, so the forest of a smaller depth is this one cut there: nodes at that depth become leaves, and leaves of one
    prediction are merged as MLlib does. (MLlib draws a node's features in the order in which it visits nodes, so a fit at a
    smaller depth draws others where it doesn't take all of them.) All depths are judged in one pass over each part. Both
    accuracies are null on an empty part, and so is the gap.
    """
    depths, deepest = list(depths), max(depths)
    train, validation = train.cache(), validation.cache()
    forest = fit_forest(train, vector, label, depth=deepest, trees=trees)
    parts = []
    for rows in (train, validation):
        whole = predict(forest, rows, vector, label).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
        parts.append({deepest: whole})
    smaller = sorted({d for d in depths if d < deepest})
    if smaller:
        nodes = tree_nodes(forest)
        for rows, found in zip((train, validation), parts, strict=True):
            found |= _accuracies(rows, nodes, smaller, vector, label)
    train.unpersist(), validation.unpersist()
    gap = lambda a, b: None if a is None or b is None else a - b
    rows = [(d, parts[0][d], parts[1][d], gap(parts[0][d], parts[1][d])) for d in depths]
    return train.sparkSession.createDataFrame(rows, "depth int, train_accuracy double, validation_accuracy double, gap double")
