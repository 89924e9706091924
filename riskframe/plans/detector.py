"""The fraud detector as one Spark ML job.

    txn -> features (one projection) -> hash split (train / test)
        -> fit on train only: index, one-hot, assemble, scale, PCA
        -> balance train (seeded oversampling; folds assigned by key before expansion)
        -> random forest, cross-validated over a grid: one fit at a time, results kept in a table
        -> score test, exact metrics, prediction output, one saved PipelineModel

Differences from the reference, by design: preprocessing is fit on the training split only;
copies of an oversampled row share one CV fold; the split and oversampling are seeded by
the row key (partition-independent); the forest and the preprocessing are saved as one
``PipelineModel`` that can be loaded back and applied.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from operator import or_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import encode, metrics, sampling
from riskframe.operators.features import detector_features
from riskframe.session import checkpoint_root, scratch_path, stored

# The model's inputs, and in DetectorConfig the split, the grid, the folds and the balance rule.
CATEGORICAL = ["category", "amt_range", "gender"]
NUMERIC = ["amt", "log_amt", "zip_numeric", "lat", "long", "city_pop", "merch_lat", "merch_long", "age", "hour",
           "day_of_week", "month", "day_of_month", "distance"]


@dataclass
class DetectorConfig:
    as_of: str = "2025-01-01"
    train_fraction: float = 0.8
    n_components: int = 18
    num_trees: list[int] = field(default_factory=lambda: [50, 100])
    max_depth: list[int] = field(default_factory=lambda: [5, 10, 15])
    folds: int = 3
    seed: int = 42
    target_ratio: float = 0.3
    trigger_ratio: float = 0.1
    label: str = "is_fraud"
    key: str = "event_id"
    balance: str = "oversample"  # "oversample" | "poisson" | "class_weight" | "none"


def model_frame(txn_df: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """Features + numeric zip + split column."""
    f = detector_features(txn_df, as_of=cfg.as_of, keep=(cfg.key,))
    f = f.withColumn("zip_numeric", F.col("zip").try_cast("double"))
    for c in ("hour", "day_of_week", "month", "day_of_month", "city_pop"):
        f = f.withColumn(c, F.col(c).cast("double"))
    return sampling.hash_split(f, cfg.key, cfg.train_fraction, cfg.seed)


def has_features() -> Column:
    """True for rows whose numeric features are all there; one NULL or NaN would spoil the fitted scaler and PCA."""
    return ~reduce(or_, [lacks for _, lacks in feature_checks()])


def feature_checks() -> list[tuple[str, Column]]:
    """A check per numeric feature, named by it: the row lacks the feature."""
    return [(c, F.col(c).isNull() | F.isnan(F.col(c).cast("double"))) for c in NUMERIC]


def rejected(frame: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """(key, label, missing): the rows that :func:`has_features` leaves out, with the names of what they lack."""
    names = F.array_compact(F.array(*[F.when(lacks, F.lit(c)) for c, lacks in feature_checks()]))
    return frame.where(~has_features()).select(cfg.key, cfg.label, names.alias("missing"))


#: Rows of a partition of an estimator's input, while there are at most PARTS partitions.
PART_ROWS = 8_192
#: A level of a forest sends the class counts of all its nodes once per partition; so there are no more than these ...
PARTS = 12
#: ... until a partition would hold more rows than this.
MOST_PART_ROWS = 1 << 20


def partitions(rows: int) -> int:
    """The number of partitions of an estimator's input, a function of its rows alone."""
    return max(1, min(-(-rows // PART_ROWS), PARTS), -(-rows // MOST_PART_ROWS))


def checkpointed(df: DataFrame, *key: str) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder and cut its lineage.

    Estimators make several passes (indexing, moments, covariance, tree levels); reading a
    checkpoint avoids recomputing the joins and hashing behind the frame on every pass, and
    a lost executor re-reads files instead of replaying the lineage. With a ``key`` the rows are :func:`dealt` by it."""
    checkpoint_root(df.sparkSession)
    return dealt(stored(df, "rows"), *key) if key else df.checkpoint(eager=True)


def dealt(rows: DataFrame, *key: str) -> DataFrame:
    """Stored ``rows`` dealt out by ``key`` over :func:`partitions`, sorted and checkpointed: a forest's draws follow the
    partitions and their order, so the model depends on the rows alone, not on the number of cores or files."""
    return rows.repartition(partitions(rows.count()), *key).sortWithinPartitions(*key).checkpoint(eager=True)


def preprocessing(cfg: DetectorConfig, n_components: int | None = None) -> Pipeline:
    k = cfg.n_components if n_components is None else n_components
    encoded = [f"{c}_encoded" for c in CATEGORICAL]
    return Pipeline(stages=[
        *encode.string_indexers(CATEGORICAL),
        *encode.one_hot_encoders(CATEGORICAL),
        VectorAssembler(inputCols=NUMERIC + encoded, outputCol="raw_features", handleInvalid="error"),
        StandardScaler(inputCol="raw_features", outputCol="scaled_features", withMean=False, withStd=True),
        PCA(k=k, inputCol="scaled_features", outputCol="features"),
    ])


def forest(cfg: DetectorConfig, num_trees: int | None = None, max_depth: int | None = None) -> RandomForestClassifier:
    rf = RandomForestClassifier(
        featuresCol="features", labelCol=cfg.label, numTrees=num_trees or cfg.num_trees[-1],
        maxDepth=max_depth or cfg.max_depth[1 if len(cfg.max_depth) > 1 else 0], seed=cfg.seed,
    )
    if cfg.balance == "class_weight":
        rf.setWeightCol("weight")
    return rf


def balanced_train(prepped_train: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """Folds by key first, then balancing: all copies of a row stay in one fold.

    ``oversample`` / ``poisson`` repeat minority rows; ``class_weight`` adds a ``weight``
    column n / (k * n_c) used as the forest's ``weightCol``; ``none`` leaves the rows."""
    with_folds = sampling.assign_folds(prepped_train, cfg.key, cfg.folds, cfg.seed)
    if cfg.balance == "class_weight":
        return sampling.with_class_weight(with_folds, cfg.label)
    if cfg.balance == "none":
        return with_folds
    method = "poisson" if cfg.balance == "poisson" else "expected"
    return sampling.balance_oversample(with_folds, cfg.key, cfg.label, cfg.target_ratio, cfg.trigger_ratio, cfg.seed,
                                       method=method)


def training_rows(prepped_train: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """The balanced training rows, checkpointed and dealt out by key and copy."""
    rows = balanced_train(prepped_train.select(cfg.key, cfg.label, "features"), cfg)
    return checkpointed(rows, *[c for c in (cfg.key, "copy") if c in rows.columns])


FITS = "run string, fold int, num_trees int, max_depth int, auc double"


def _run_name(train: DataFrame, cfg: DetectorConfig) -> str:
    """Names the search by its rows and the settings that its fits depend on, so that a log of other fits is not taken up."""
    names = [c for c in train.columns if c != "features"]
    n, total = train.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*names, vector_to_array("features")).cast("decimal(38,0)"))).first()
    return f"{n}/{total}/{cfg.seed}/{cfg.folds}/{cfg.balance}/{cfg.label}"


def finished_fits(spark: SparkSession, log_path: str, run: str) -> dict[tuple[int, int, int], float]:
    """(fold, num_trees, max_depth) -> ROC area of the fits of ``run`` in the log; none if there is no log yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(log_path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return {}
    rows = spark.read.schema(FITS).parquet(log_path).where(F.col("run") == run)
    return {(r.fold, r.num_trees, r.max_depth): r.auc for r in rows.collect()}  # a row per fit


def grid_search(train: DataFrame, cfg: DetectorConfig, log_path: str | None = None) -> list[tuple[int, int, float]]:
    """(num_trees, max_depth, mean ROC area over the folds) of every parameter pair, in order of the grid.

    One fit at a time; its forest is scored on the fold that was left out and dropped, so the driver holds one
    model whatever the size of the grid. Each result is appended to the table ``log_path`` when it is there; a
    search that starts again with the same rows and settings takes the finished fits from it."""
    spark = train.sparkSession
    log_path = log_path or scratch_path(spark, "grid_search")
    run = _run_name(train, cfg)
    done = finished_fits(spark, log_path, run)
    evaluator = BinaryClassificationEvaluator(labelCol=cfg.label, metricName="areaUnderROC")
    for num_trees, max_depth in product(cfg.num_trees, cfg.max_depth):
        for fold in range(cfg.folds):
            if (fold, num_trees, max_depth) in done:
                continue
            model = forest(cfg, num_trees, max_depth).fit(train.where(F.col("fold") != fold))
            auc = evaluator.evaluate(model.transform(train.where(F.col("fold") == fold)))
            del model
            spark.createDataFrame([(run, fold, num_trees, max_depth, auc)], FITS).coalesce(1).write.mode("append").parquet(log_path)
            done[fold, num_trees, max_depth] = auc
    return [(t, d, sum(done[f, t, d] for f in range(cfg.folds)) / cfg.folds) for t, d in product(cfg.num_trees, cfg.max_depth)]


def score_columns(pred: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """key, label, prediction and P(class 1) (0.0 when no probability), all JVM-side."""
    p1 = F.coalesce(F.get(vector_to_array("probability"), 1), F.lit(0.0))
    return pred.select(F.col(cfg.key), F.col(cfg.label), "prediction", p1.alias("fraud_probability"))


def evaluate(scored: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """Six metrics as (metric, value) rows, computed exactly from the scored frame."""
    s = scored.select(F.col(cfg.label).alias("is_fraud"), F.col("prediction").cast("int").alias("prediction"),
                      F.col("fraud_probability").alias("score"))
    w = metrics.weighted_metrics(s)
    rows = w.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(c).alias("value"))
        for n, c in (("accuracy", "accuracy"), ("f1", "weighted_f1"), ("precision", "weighted_precision"),
                     ("recall", "weighted_recall"))])).alias("m")).select("m.*")
    roc = metrics.auc_roc(s).select(F.lit("auc_roc").alias("metric"), F.col("auc_roc").alias("value"))
    pr = metrics.auc_pr(s).select(F.lit("auc_pr").alias("metric"), F.col("auc_pr").alias("value"))
    return rows.unionByName(roc).unionByName(pr)


@dataclass
class DetectorRun:
    model: PipelineModel
    scored: DataFrame
    metrics: DataFrame
    grid: list[tuple[int, int, float]]
    rejects: DataFrame


def run_detector(spark: SparkSession, txn_df: DataFrame, cfg: DetectorConfig | None = None,
                 model_path: str | None = None, predictions_path: str | None = None, log_path: str | None = None) -> DetectorRun:
    """End-to-end detector. The feature frame, the balanced training frame and the predictions are
    each checkpointed once; estimator passes, CV fits, metrics and writes read those files. Rows
    without all numeric features take no part and are returned as ``rejects``."""
    cfg = cfg or DetectorConfig()
    complete = checkpointed(model_frame(txn_df, cfg), cfg.key)
    frame = complete.where(has_features())
    train_raw = frame.where(F.col("split") == "train")
    test_raw = frame.where(F.col("split") == "test")
    prep = preprocessing(cfg).fit(train_raw)
    train = training_rows(prep.transform(train_raw), cfg)
    grid = grid_search(train, cfg, log_path)
    num_trees, max_depth, _ = max(grid, key=lambda g: g[2])  # the first of equal ones
    model = PipelineModel(stages=[*prep.stages, forest(cfg, num_trees, max_depth).fit(train)])
    pred = checkpointed(model.transform(test_raw).select(cfg.key, cfg.label, "prediction", "probability"))
    scored = score_columns(pred, cfg)
    if predictions_path:
        scored.write.mode("overwrite").option("header", "true").csv(f"{predictions_path}/csv")
        pred.write.mode("overwrite").parquet(f"{predictions_path}/parquet")
    if model_path:
        model.write().overwrite().save(model_path)
    return DetectorRun(model, scored, evaluate(scored, cfg), grid, rejected(complete, cfg))
