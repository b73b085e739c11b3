"""Delay classifiers: training set, candidates, evaluation, selection, model store."""

from __future__ import annotations

import json
import logging
import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from datetime import UTC, datetime
from statistics import fmean

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmark.functions.features import CATEGORICAL, FEATURES, REQUIRED_FIELDS, with_features
from haulmark.functions.metrics import ratio
from haulmark.operators.boosting import BoostedTreesModel, BoostingConfig, fit_boosted
from haulmark.operators.split import stratified_split, with_folds
from haulmark.operators.surrogate import numbered, stage_in_order
from haulmark.plans.star import star
from haulmark.plans.warehouse import Warehouse
from haulmark.sources.objects import ObjectStore

log = logging.getLogger(__name__)

LABEL, KEY = "label", "source_shipment_id"
BOOSTED = "Second-Order Boosting"
TOP_FEATURES = 12
# Rows a task of a fit holds: so many at least while there are more cores, at most beyond.
# A fit is hundreds of short jobs, whose tasks cost more than their few rows.
LEAST_TASK_ROWS, MOST_TASK_ROWS = 10_000, 200_000


@dataclass(frozen=True)
class TrainingConfig:
    """Sizes of the candidate models; the defaults are those of a full training run.

    ``fit_rows`` bounds the labelled rows that candidates are fitted on (0: all). The bound
    keeps the share of each class, takes rows by a hash of their key, and is recorded with
    the model; the test set is never cut. ``models`` names the candidates (none: all).
    """

    as_of_year: int
    test_share: float = 0.2
    seed: int = 42
    folds: int = 5
    parallelism: int = 2
    iterations: int = 1000
    trees: int = 100
    forest_depth: int = 30
    rounds: int = 100
    fit_rows: int = 0
    models: tuple[str, ...] = ()


def training_set(wh: Warehouse) -> DataFrame:
    """Label and the 24 model fields of every shipment; nothing known only afterwards."""
    c = F.col
    renamed = {"vehicle_capacity": "capacity_kg"}
    fields = [c(renamed.get(name, name)).alias(name) for name in REQUIRED_FIELDS]
    return star(wh).select(KEY, c("is_delayed").cast("int").alias(LABEL), *fields)


def dictionary(rows: DataFrame, root: str) -> DataFrame:
    """field, value, index: alphabetical numbers, from 0, of the values of each category.

    Written to ``root`` and read from there, so it is a table of any size and not a list on
    the driver. Values are numbered by one distributed sort of (field, value).
    """
    spark = rows.sparkSession
    pairs = F.explode(
        F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("value")) for n in CATEGORICAL])
    )
    values = rows.select(pairs.alias("_p")).select("_p.*").filter("value IS NOT NULL").distinct()
    stage_in_order(values, ["field", "value"], f"{root}_staged")
    numbers = numbered(spark, f"{root}_staged", "_number", 0)
    first = numbers.groupBy("field").agg(F.min("_number").alias("_first"))  # a row per category
    indexed = numbers.join(F.broadcast(first), "field")
    index = (F.col("_number") - F.col("_first")).cast("double").alias("index")
    indexed.select("field", "value", index).write.mode("overwrite").parquet(root)
    return spark.read.parquet(root)


def encode(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Adds ``<category>_index`` for each category; a value not in the dictionary becomes 0.

    Each category is a left join with its part of the dictionary. Adaptive execution
    broadcasts the small ones.
    """
    for name in CATEGORICAL:
        part = known.filter(F.col("field") == name).select(
            F.col("value").alias(f"_{name}"), F.col("index").alias(f"{name}_index")
        )
        rows = rows.join(part, F.col(name) == F.col(f"_{name}"), "left").drop(f"_{name}")
    return rows.fillna({f"{name}_index": 0.0 for name in CATEGORICAL})


def assembler() -> VectorAssembler:
    """Feature vector in the fixed order that is stored with the model."""
    inputs = [f"{name}_index" if name in CATEGORICAL else name for name in FEATURES]
    return VectorAssembler(inputCols=inputs, outputCol="raw_features")


def candidates(config: TrainingConfig, rows: int) -> dict[str, Estimator]:
    """The candidates that are fitted once a fold; ``BOOSTED`` comes after them."""
    common = {"featuresCol": "features", "labelCol": LABEL}
    return {
        "Logistic Regression": LogisticRegression(
            maxIter=config.iterations,
            regParam=1.0 / max(rows, 1),
            elasticNetParam=0.0,
            standardization=False,
            **common,
        ),
        "Random Forest": RandomForestClassifier(
            numTrees=config.trees,
            maxDepth=config.forest_depth,
            featureSubsetStrategy="sqrt",
            seed=config.seed,
            **common,
        ),
        "Gradient Boosting": GBTClassifier(
            maxIter=config.rounds, maxDepth=3, stepSize=0.1, seed=config.seed, **common
        ),
    }


def _auc(column: str) -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(
        labelCol=LABEL, rawPredictionCol=column, metricName="areaUnderROC", numBins=0
    )


def fold_area(estimator: Estimator, rows: DataFrame, fold: int) -> float:
    """ROC-AUC of a fold, scored by a model fitted without it."""
    inside = F.col("fold") == fold
    model = estimator.fit(rows.filter(~inside))
    return _auc("rawPrediction").evaluate(model.transform(rows.filter(inside)))


def in_fit_tasks(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows dealt by key to as many tasks as their number is worth, in a fixed order."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = min(-(-n // LEAST_TASK_ROWS), max(cores, -(-n // MOST_TASK_ROWS)))
    return rows.repartition(max(1, tasks), KEY).sortWithinPartitions(KEY)


def boosted(rows: DataFrame, root: str, config: TrainingConfig) -> tuple[BoostedTreesModel, float]:
    """Second-order boosting and its mean ROC-AUC over the folds, from the same scans.

    The fits without a fold and that of all rows grow together; each row is scored by the fit
    that did not see it.
    """
    settings = BoostingConfig(rounds=config.rounds)
    fit = fit_boosted(rows, f"{root}/boosting", settings, config.folds)
    own = F.col("margins")[F.col("fold")]
    scored = fit.margins.select(
        F.col("fold").cast("string").alias("model"), F.col("label").alias(LABEL), own.alias("probability")
    )
    areas = roc_auc(scored, f"{root}/roc").collect()  # a row a fold
    return fit.models[-1], fmean(r["roc_auc"] for r in areas if r["roc_auc"] is not None)


def _fit_all(
    estimators: dict[str, Estimator | None], rows: DataFrame, root: str, config: TrainingConfig
) -> tuple[dict[str, Model], dict[str, float]]:
    """Each candidate fitted on all rows, and its mean ROC-AUC over the folds.

    All fits of all candidates share ``config.parallelism`` threads, so that one candidate's
    short jobs do not wait for those of another.
    """
    fitted, cv_scores = {}, {}
    with ThreadPoolExecutor(config.parallelism) as pool:
        # The longest first: its scans follow one another.
        scans = pool.submit(boosted, rows, root, config) if BOOSTED in estimators else None
        fits = {
            name: (
                pool.submit(estimator.fit, rows),
                [pool.submit(fold_area, estimator, rows, fold) for fold in range(config.folds)],
            )
            for name, estimator in estimators.items()
            if estimator is not None
        }
        for name, (whole, folds) in fits.items():
            fitted[name], cv_scores[name] = whole.result(), fmean(f.result() for f in folds)
        if scans is not None:
            fitted[BOOSTED], cv_scores[BOOSTED] = scans.result()
    return fitted, cv_scores


def train(wh: Warehouse, root: str, config: TrainingConfig) -> DataFrame:
    """Fit and compare all candidates, store the best; returns one metrics row per model."""
    spark = wh.spark
    rows = with_features(training_set(wh), config.as_of_year)
    split = stratified_split(rows, LABEL, KEY, config.test_share, config.seed)
    # Written once: the split feeds every fit, and a lost executor re-reads it.
    part = F.when(F.col("is_test"), "test").otherwise("train").alias("part")
    inputs = split.drop("is_test").columns
    split.select(*inputs, part).write.mode("overwrite").partitionBy("part").parquet(
        f"{root}/training"
    )
    split = spark.read.parquet(f"{root}/training")
    train_rows = split.filter(F.col("part") == "train")

    store = ModelStore(spark, root)
    version = store.new_version()
    known = dictionary(train_rows, f"{version}/dictionary")
    assembled = assembler()
    scaler = StandardScaler(
        inputCol="raw_features", outputCol="features", withMean=True, withStd=True
    ).fit(assembled.transform(encode(train_rows, known)))
    prepare = PipelineModel([assembled, scaler])

    def prepared(part: DataFrame) -> DataFrame:
        return prepare.transform(encode(part, known)).select(KEY, LABEL, "features")

    total = train_rows.count()
    if 0 < config.fit_rows < total:
        share = config.fit_rows / total
        chosen = stratified_split(train_rows, LABEL, KEY, share, config.seed + 1)
        train_rows = chosen.filter("is_test").drop("is_test")
    folded = with_folds(train_rows.select(KEY, LABEL), LABEL, KEY, config.folds, f"{root}/folds")
    fitting = prepared(train_rows).join(folded.select(KEY, "fold"), KEY)
    bound = min(config.fit_rows or total, total)
    fitting = in_fit_tasks(fitting, bound).persist(StorageLevel.MEMORY_AND_DISK)
    testing = prepared(split.filter(F.col("part") == "test")).persist(StorageLevel.MEMORY_AND_DISK)
    n_train, n_test = fitting.count(), testing.count()
    try:
        estimators = candidates(config, n_train)
        names = [*estimators, BOOSTED]
        if unknown := set(config.models) - set(names):
            raise ValueError(f"unknown models {sorted(unknown)}, use some of {names}")
        names = [n for n in names if not config.models or n in config.models]
        fitted, cv_scores = _fit_all({n: estimators.get(n) for n in names}, fitting, root, config)
        for name in names:
            store_predictions(fitted[name].transform(testing), root, name)
    finally:
        fitting.unpersist()
        testing.unpersist()

    scored = predictions(spark, root).filter(F.col("model").isin(names))
    right = {r["model"]: r["accuracy"] for r in accuracy(scored).collect()}  # a row a model
    areas = {r["model"]: r["roc_auc"] for r in roc_auc(scored, f"{root}/roc").collect()}
    metrics = []
    for name in names:
        result = {
            "model": name,
            "accuracy": right[name],
            "roc_auc": areas[name],
            "cv_score": cv_scores[name],
        }
        log.info("%(model)s: accuracy %(accuracy).3f, ROC-AUC %(roc_auc).3f", result)
        metrics.append(result)

    best = max(metrics, key=lambda row: row["roc_auc"])  # the first of equals
    bundle = PipelineModel(prepare.stages + [fitted[best["model"]]])
    details = {
        "model_name": best["model"],
        "trained_at": datetime.now(UTC).isoformat(),
        "metrics": {name: best[name] for name in ("accuracy", "roc_auc", "cv_score")},
        "all_metrics": metrics,
        "feature_names": FEATURES,
        "rows": {"train": total, "fitted": n_train, "test": n_test},
        "config": asdict(config),
    }
    store.save(bundle, details, version)
    return metrics_frame(spark, root)


def store_predictions(scored: DataFrame, root: str, model: str) -> None:
    folder = f"{root}/predictions/model={model}"
    probability = vector_to_array("probability")[1].alias("probability")
    scored.select(KEY, LABEL, "prediction", probability).write.mode("overwrite").parquet(folder)


def predictions(spark: SparkSession, root: str) -> DataFrame:
    """Test predictions of every candidate."""
    return spark.read.parquet(f"{root}/predictions")


def metrics_frame(spark: SparkSession, root: str) -> DataFrame:
    details = ModelStore(spark, root).details()
    best = details["model_name"]
    rows = [
        (m["model"], m["accuracy"], m["roc_auc"], m["cv_score"], m["model"] == best)
        for m in details["all_metrics"]
    ]
    schema = "model string, accuracy double, roc_auc double, cv_score double, is_best boolean"
    return spark.createDataFrame(rows, schema)


def confusion(scored: DataFrame) -> DataFrame:
    actual = F.col(LABEL).cast("int").alias("actual")
    predicted = F.col("prediction").cast("int").alias("predicted")
    counts = scored.groupBy(actual, predicted).agg(F.count("*").alias("shipments"))
    return counts.orderBy("actual", "predicted")


def accuracy(scored: DataFrame) -> DataFrame:
    """Share of right predictions per model."""
    right = F.avg((F.col("prediction") == F.col(LABEL)).cast("int"))
    return scored.groupBy("model").agg(right.alias("accuracy"))


def _running(scored: DataFrame, root: str) -> DataFrame:
    """Per model and distinct probability: rows of each class, and of all higher ones.

    Exact for any number of thresholds: they are sorted by range, summed up in their
    partitions, and the totals of the partitions before are added.
    """
    spark, c = scored.sparkSession, F.col
    counts = scored.groupBy("model", "probability").agg(
        F.sum(c(LABEL)).alias("p"), F.sum(1 - c(LABEL)).alias("n")
    )
    order = [c("model"), c("probability").desc()]
    path = f"{root}-{uuid.uuid4().hex}"
    dealt = counts.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    dealt.write.parquet(path)
    held = spark.read.parquet(path)
    totals = held.groupBy("model", "_part").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    before = Window.partitionBy("model").orderBy("_part")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "model",
        "_part",
        *[F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"{x}_before") for x in "pn"],
        *[F.sum(x).over(Window.partitionBy("model")).alias(f"{x}_all") for x in "pn"],
    )  # a row per partition and model
    inside = Window.partitionBy("model", "_part").orderBy(F.desc("probability"))
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    return held.join(F.broadcast(starts), ["model", "_part"]).select(
        "model",
        "probability",
        "p",
        "n",
        "p_all",
        "n_all",
        *[(c(f"{x}_before") + F.sum(x).over(inside)).alias(f"{x}_upto") for x in "pn"],
    )


def roc_points(scored: DataFrame, root: str) -> DataFrame:
    """False and true positive rates at every probability that occurs, from (0, 0) on.

    The first point has a threshold above all probabilities.
    """
    running = _running(scored, root)
    points = running.select(
        "model",
        F.col("probability").alias("threshold"),
        ratio(F.col("n_upto"), F.col("n_all")).alias("fpr"),
        ratio(F.col("p_upto"), F.col("p_all")).alias("tpr"),
    )
    zero, above = F.lit(0.0), F.lit(float("inf"))
    origin = running.groupBy("model").agg(
        above.alias("threshold"), zero.alias("fpr"), zero.alias("tpr")
    )
    return origin.unionByName(points)


def roc_auc(scored: DataFrame, root: str) -> DataFrame:
    """Exact area under the curve: pairs ranked right, equal scores counting a half.

    Twice the area is a whole number of pairs, so the sum does not depend on its order.
    """
    c = F.col
    wide = {x: c(x).cast("decimal(38,0)") for x in ("p", "n", "p_upto", "p_all", "n_all")}
    won = wide["n"] * (2 * (wide["p_upto"] - wide["p"]) + wide["p"])
    sums = _running(scored, root).groupBy("model").agg(
        F.sum(won.cast("decimal(38,0)")).alias("won"),
        F.max(c("p_all")).alias("p_all"),
        F.max(c("n_all")).alias("n_all"),
    )
    pairs = 2.0 * c("p_all") * c("n_all")
    return sums.select("model", F.try_divide(c("won").cast("double"), pairs).alias("roc_auc"))


def feature_importance(spark: SparkSession, root: str, top: int = TOP_FEATURES) -> DataFrame:
    """Largest importances of the stored model; empty if its kind has none."""
    store = ModelStore(spark, root)
    classifier = store.load().stages[-1]
    schema = "feature string, importance double"
    if not hasattr(classifier, "featureImportances"):
        return spark.createDataFrame([], schema)
    values = classifier.featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(FEATURES, values, strict=True) if math.isfinite(v)]
    return spark.createDataFrame(rows, schema).orderBy(F.desc("importance"), "feature").limit(top)


class ModelStore:
    """Versions of the model; one small pointer names the current and the previous one."""

    POINTER = "models.json"

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = ObjectStore(spark, self.root)

    def new_version(self) -> str:
        """A folder of its own for the next model and what belongs to it."""
        return f"{self.root}/versions/{uuid.uuid4().hex}"

    def _pointer(self) -> dict:
        if not self.files.exists(self.POINTER):
            return {}
        return json.loads(self.files.download_bytes(self.POINTER))

    def save(self, model: PipelineModel, details: dict, version: str | None = None) -> None:
        """Make this the current model, always; a worse one is reported, the old one kept.

        Readers see the old model until the pointer is replaced. Versions older than the
        previous one are removed.
        """
        version = version or self.new_version()
        name = version.rpartition("/")[2]
        model.write().overwrite().save(f"{version}/model")
        self.files.upload_bytes(f"versions/{name}/details.json", json.dumps(details).encode())
        pointer = self._pointer()
        if pointer:
            old = self.details()["metrics"]["roc_auc"]
            new = details["metrics"]["roc_auc"]
            if new < old:
                log.warning("new model is worse: ROC-AUC %.3f after %.3f; saved anyway", new, old)
        following = {"current": name, "previous": pointer.get("current")}
        self.files.upload_bytes(self.POINTER, json.dumps(following).encode())
        if pointer.get("previous"):
            self.files.remove(f"versions/{pointer['previous']}")

    def _version(self, which: str) -> str:
        name = self._pointer().get(which)
        if not name:
            raise FileNotFoundError(f"no {which} model in {self.root}, train one first")
        return f"versions/{name}"

    def load(self, which: str = "current") -> PipelineModel:
        return PipelineModel.load(f"{self.root}/{self._version(which)}/model")

    def dictionary(self, which: str = "current") -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{self._version(which)}/dictionary")

    def details(self, which: str = "current") -> dict:
        return json.loads(self.files.download_bytes(f"{self._version(which)}/details.json"))
