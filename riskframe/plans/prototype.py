"""The prototype pipeline on transactions as one Spark job.

    txn without repeated rows -> prototype features -> seeded split -> drop-first dummies of each split, aligned
        -> centred scaling fitted on train -> principal components, as many as explain 95 %, at most 18
        -> synthetic minority rows in the projected space, up to parity -> forest with balanced class weights
        -> predictions of the test split -> report with classes, accuracy, macro and weighted averages

Everything that is fitted sees the training split only; the projection that was fitted there is applied to both. Scaling and
dummies are column expressions over one array per row; kNN, synthesis and weights are the library's operators.

Rows that lack a feature (null or NaN) are returned as rejects with what they lack. A training split without a second
class, or without rows, raises an error. A feature that does not vary in train is centred only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import metrics, sampling
from riskframe.operators.features import prototype_features
from riskframe.operators.smote import smote
from riskframe.plans.detector import checkpointed
from riskframe.session import stored

# fixed values: the numeric inputs, in order
NUMERIC = ["amt", "zip", "lat", "long", "city_pop", "merch_lat", "merch_long", "age", "hour", "day", "month"]
#: Categories become columns; more than this are no categories.
MAX_CATEGORIES = 4_096


@dataclass
class PrototypeConfig:
    as_of: str = "2025-01-01"
    train_fraction: float = 0.8
    variance: float = 0.95
    max_components: int = 18
    neighbours: int = 5
    num_trees: int = 50
    max_depth: int = 10
    seed: int = 42
    label: str = "is_fraud"
    key: str = "event_id"


@dataclass
class PrototypeRun:
    scored: DataFrame
    report: DataFrame
    confusion: DataFrame
    rejects: DataFrame
    explained: list[float]
    components: int
    synthetic: DataFrame


def frame(txn: DataFrame, cfg: PrototypeConfig) -> DataFrame:
    """Distinct rows with their key, label, split, category and numeric features as doubles."""
    f = prototype_features(txn.dropDuplicates(), as_of=cfg.as_of, keep=(cfg.key,))
    f = f.select(cfg.key, cfg.label, "category", *[F.col(c).try_cast("double").alias(c) for c in NUMERIC])
    return sampling.hash_split(f, cfg.key, cfg.train_fraction, cfg.seed)


def _missing() -> Column:
    lacks = [F.when(F.col(c).isNull() | F.isnan(F.col(c)), F.lit(c)) for c in NUMERIC]
    return F.array_compact(F.array(*lacks, F.when(F.col("category").isNull(), F.lit("category"))))


def dummy_names(rows: DataFrame) -> tuple[dict[str, str], list[str]]:
    """The category that each split drops (its first one), and the categories that either split keeps, sorted."""
    seen = rows.select("split", "category").distinct().limit(2 * MAX_CATEGORIES + 1).collect()
    if len(seen) > 2 * MAX_CATEGORIES:
        raise ValueError("too many categories for dummy columns")
    first: dict[str, str] = {}
    for r in seen:
        first[r["split"]] = min(first.get(r["split"], r["category"]), r["category"])
    return first, sorted({r["category"] for r in seen if r["category"] != first[r["split"]]})


def inputs(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """``rows`` with the array ``x`` of numeric features and aligned dummies, and the names of its places."""
    first, names = dummy_names(rows)
    dropped = F.lit(None).cast("string")
    for split, category in first.items():
        dropped = F.when(F.col("split") == split, F.lit(category)).otherwise(dropped)
    dummies = [((F.col("category") == c) & (dropped != c)).cast("double") for c in names]
    return rows.withColumn("x", F.array(*NUMERIC, *dummies)), [*NUMERIC, *(f"category_{c}" for c in names)]


def centred(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` with ``z``: x less the training mean, over the training deviation (of the population; 1 if it is 0)."""
    moments = rows.where(F.col("split") == "train").agg(
        *[F.avg(F.get("x", F.lit(i))).alias(f"m{i}") for i in range(width)],
        *[F.stddev_pop(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(width)]).first()
    if moments["m0"] is None:
        raise ValueError("no rows in the training split")
    return rows.withColumn("z", F.array(*[
        (F.get("x", F.lit(i)) - F.lit(moments[f"m{i}"])) / F.lit(moments[f"s{i}"] or 1.0) for i in range(width)]))


def components_needed(explained: list[float], variance: float, most: int) -> int:
    """The least number of leading components that explain the share ``variance``, at most ``most``."""
    reached = np.cumsum(explained) >= variance
    return min(most, int(np.argmax(reached)) + 1 if reached.any() else len(explained))


def projected(rows: DataFrame, width: int, cfg: PrototypeConfig) -> tuple[DataFrame, list[float], int]:
    """``rows`` with ``p``: z on the training split's leading components; all explained shares; the number of components."""
    vectors = rows.withColumn("_z", array_to_vector("z"))
    model = PCA(k=width, inputCol="_z", outputCol="_p").fit(vectors.where(F.col("split") == "train"))
    explained = model.explainedVariance.toArray().tolist()
    k = components_needed(explained, cfg.variance, cfg.max_components)
    return model.transform(vectors).withColumn("p", F.slice(vector_to_array("_p"), 1, k)).drop("_z", "_p"), explained, k


def run_prototype(spark: SparkSession, txn: DataFrame, cfg: PrototypeConfig | None = None) -> PrototypeRun:
    """The whole pipeline. Estimator inputs and predictions are checkpointed once each."""
    cfg = cfg or PrototypeConfig()
    complete = stored(frame(txn, cfg).withColumn("missing", _missing()), "prototype-rows")
    rejects = complete.where(F.size("missing") > 0).select(cfg.key, cfg.label, "missing")
    rows, names = inputs(complete.where(F.size("missing") == 0).drop("missing"))
    rows, explained, k = projected(checkpointed(centred(rows, len(names)), cfg.key), len(names), cfg)
    rows = stored(rows.select(cfg.key, cfg.label, "split", "p"), "prototype-projected")
    train = rows.where(F.col("split") == "train")
    counts = train.groupBy(cfg.label).count().orderBy("count", cfg.label).collect()
    if len(counts) < 2:
        raise ValueError("the training split holds one class only")
    rare = counts[0][cfg.label]
    synthetic = stored(smote(train, cfg.key, "p", cfg.label, rare, cfg.neighbours, cfg.seed).select(
        F.col("base_id").alias(cfg.key), "copy", F.lit(rare).cast(train.schema[cfg.label].dataType).alias(cfg.label), F.col("syn_vec").alias("p")),
        "prototype-synthetic")  # read by the class weights and the forest: neighbours are searched once
    grown = train.select(cfg.key, F.lit(0).cast("bigint").alias("copy"), cfg.label, "p").unionByName(synthetic)
    grown = sampling.with_class_weight(grown, cfg.label).withColumn("features", array_to_vector("p"))
    grown = checkpointed(grown.select(cfg.key, "copy", cfg.label, "weight", "features"), cfg.key, "copy")
    forest = RandomForestClassifier(featuresCol="features", labelCol=cfg.label, weightCol="weight", numTrees=cfg.num_trees,
                                    maxDepth=cfg.max_depth, seed=cfg.seed).fit(grown)
    test = rows.where(F.col("split") == "test").withColumn("features", array_to_vector("p"))
    scored = stored(forest.transform(test).select(
        cfg.key, cfg.label, F.col("prediction").cast("int").alias("prediction"),
        F.get(vector_to_array("probability"), F.lit(1)).alias("fraud_probability")), "prototype-scored")
    return PrototypeRun(scored, metrics.full_report(scored, cfg.label), metrics.confusion_matrix(scored, cfg.label), rejects,
                        explained, k, grown.where(F.col("copy") > 0))
