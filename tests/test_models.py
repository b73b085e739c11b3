"""Features, split, training, model store and scoring."""

import hashlib
from dataclasses import replace

import pytest
from records import record
from pyspark.sql import functions as F

from haulmark.functions.features import CATEGORICAL, FEATURES, REQUIRED_FIELDS, with_features
from haulmark.operators.split import stratified_split, with_folds
from haulmark.plans import training
from haulmark.plans.daily import run_daily
from haulmark.plans.scoring import score
from haulmark.plans.training import ModelStore, TrainingConfig
from haulmark.plans.warehouse import Warehouse
from haulmark.sources.raw import write_raw
from workload import materialised as built

SMALL = TrainingConfig(
    as_of_year=2026, folds=2, iterations=20, trees=3, forest_depth=3, rounds=3, fit_rows=300
)


def test_split_is_exact_and_stratified(spark):
    """Compared with sorting each class by hash, on uneven classes."""
    rows = spark.range(3000).selectExpr("concat('s', id) AS k", "int(id % 10 = 0) AS label")
    rows = rows.unionByName(spark.sql("SELECT 'no label' AS k, CAST(NULL AS INT) AS label"))
    found = {r["k"]: r["is_test"] for r in stratified_split(rows, "label", "k").collect()}
    classes = {0: [], 1: []}
    for n in range(3000):
        classes[int(n % 10 == 0)].append(f"s{n}")
    expected = set()
    for members in classes.values():
        ranked = sorted(members, key=lambda k: (hashlib.md5(f"{k}|42".encode()).hexdigest(), k))
        expected |= set(ranked[: round(len(members) * 0.2)])
    assert {k for k, is_test in found.items() if is_test} == expected
    assert len(found) == 3000


def test_split_with_equal_hashes_and_tiny_classes(spark):
    rows = spark.createDataFrame(
        [("same", 1)] * 10 + [("one", 0), ("two", 0)], "k string, label int"
    )
    found = stratified_split(rows, "label", "k").collect()
    assert len(found) == 12
    assert sum(r["is_test"] for r in found if r["label"] == 1) == 2
    assert sum(r["is_test"] for r in found if r["label"] == 0) == 0


def test_folds_are_even_in_each_class(spark, tmp_path):
    rows = spark.range(5000).selectExpr("concat('s', id) AS k", "int(id % 7 = 0) AS label")
    dealt = with_folds(rows, "label", "k", 5, f"file:{tmp_path}/folds")
    sizes = dealt.groupBy("label").pivot("fold").count().collect()
    for row in sizes:
        counts = [row[str(i)] for i in range(5)]
        assert max(counts) - min(counts) <= 1


def shipment(**changes):
    values = {name: "a" if name in CATEGORICAL else 1.0 for name in REQUIRED_FIELDS}
    return values | {"is_weekend": True} | changes


def shipments(spark, *rows):
    kinds = {name: "string" if name in CATEGORICAL else "double" for name in REQUIRED_FIELDS}
    kinds["is_weekend"] = "boolean"
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    return spark.createDataFrame([tuple(row[n] for n in REQUIRED_FIELDS) for row in rows], schema)


def test_features(spark):
    row = shipment(
        manufacture_year=2016.0,
        mileage_km=110.0,
        weight_kg=50.0,
        vehicle_capacity=99.0,
        cost_usd=30.0,
        distance_km=0.0,
        weekday=None,
    )
    made = with_features(shipments(spark, row), 2026).select(*FEATURES)
    assert len(made.columns) == 26
    made = made.first()
    assert (made["vehicle_age_years"], made["mileage_per_year"]) == (10.0, 10.0)
    assert (made["load_ratio"], made["cost_per_km"]) == (0.5, 30.0)
    assert (made["is_weekend"], made["weekday"]) == (1.0, "None")


def test_unseen_category_becomes_the_first(spark, tmp_path):
    known = with_features(
        shipments(spark, shipment(region="b"), shipment(region="c"), shipment(region="a")), 2026
    )
    table = training.dictionary(known, f"file:{tmp_path}/dictionary")
    unseen = with_features(
        shipments(spark, *[shipment(region=r) for r in ("a", "b", "c", "z", None)]), 2026
    )
    found = training.encode(unseen, table).select("region", "region_index").collect()
    assert {r["region"]: r["region_index"] for r in found} == {
        "a": 0.0, "b": 1.0, "c": 2.0, "z": 0.0, "None": 0.0
    }


def test_evaluation_is_exact(spark, tmp_path):
    """Many thresholds and ties, next to counting all pairs."""
    import random

    generator = random.Random(6)
    data = [
        ("m", generator.randint(0, 1), generator.randint(0, 400) / 400) for _ in range(900)
    ] + [("one class", 1, 0.5)]
    scored = spark.createDataFrame(data, "model string, label int, probability double")
    positive = [p for m, y, p in data if m == "m" and y]
    negative = [p for m, y, p in data if m == "m" and not y]
    won = sum((a > b) + (a == b) / 2 for a in positive for b in negative)
    found = {r["model"]: r["roc_auc"] for r in training.roc_auc(scored, f"file:{tmp_path}/a").collect()}
    assert found["m"] == pytest.approx(won / len(positive) / len(negative), abs=1e-12)
    assert found["one class"] is None
    points = training.roc_points(scored, f"file:{tmp_path}/b").filter("model = 'm'").collect()
    assert len(points) == 1 + len({p for m, _, p in data if m == "m"})
    for r in points:
        assert r["tpr"] == pytest.approx(sum(p >= r["threshold"] for p in positive) / len(positive))
        assert r["fpr"] == pytest.approx(sum(p >= r["threshold"] for p in negative) / len(negative))


@pytest.fixture(scope="module")
def trained(spark, frame, tmp_path_factory):
    """The whole daily job on records whose delay follows the weather."""
    root = f"file:{tmp_path_factory.mktemp('models')}"
    rows = [
        record(
            n,
            company_name=f"C{n % 40}",
            driver_name=f"D{n % 7}",
            weather_condition="Snow" if n % 2 else "Clear",
            is_delayed=(n % 2 == 1) != (n % 11 == 0),
            delay_minutes=60 if (n % 2 == 1) != (n % 11 == 0) else 3,
            scheduled_pickup=record(0)["scheduled_pickup"].replace(minute=n % 60, second=n // 60),
        )
        for n in range(600)
    ]
    write_raw(frame(*rows), root, "a")
    result = run_daily(
        spark, root, f"{root}/wh", f"{root}/models", f"{root}/report", SMALL
    )
    return root, result


def test_daily_job(spark, trained):
    root, result = trained
    assert result["loaded"]["fact_shipments"] == 600
    metrics = result["metrics"].collect()
    assert [r["model"] for r in metrics] == [
        "Logistic Regression",
        "Random Forest",
        "Gradient Boosting",
        "Second-Order Boosting",
    ]
    assert all(r["roc_auc"] > 0.8 and r["accuracy"] > 0.8 for r in metrics)
    assert sum(r["is_best"] for r in metrics) == 1
    details = ModelStore(spark, f"{root}/models").details()
    assert details["feature_names"] == FEATURES
    assert details["rows"] == {"train": 480, "fitted": 300, "test": 120}


def test_evaluation_frames(spark, trained):
    root, _ = trained
    scored = training.predictions(spark, f"{root}/models")
    one = scored.filter("model = 'Logistic Regression'")
    assert sum(r["shipments"] for r in training.confusion(one).collect()) == 120
    points = training.roc_points(scored, f"{root}/models/roc").filter("model = 'Random Forest'")
    points = points.orderBy(F.desc("threshold")).collect()
    assert (points[0]["fpr"], points[0]["tpr"]) == (0.0, 0.0)
    assert (points[-1]["fpr"], points[-1]["tpr"]) == (1.0, 1.0)
    assert all(a["tpr"] <= b["tpr"] for a, b in zip(points, points[1:], strict=False))


def test_scoring(spark, trained):
    root, _ = trained
    inputs = training.training_set(Warehouse(spark, f"{root}/wh")).drop(training.LABEL)
    scored = score(inputs, f"{root}/models", 2026)
    assert scored.columns[: len(inputs.columns)] == inputs.columns
    assert scored.columns[-5:] == [
        "will_be_delayed",
        "delay_probability",
        "risk_level",
        "model_used",
        "predicted_at",
    ]
    by_weather = {
        r["weather_condition"]: r["late"]
        for r in scored.groupBy("weather_condition")
        .agg(F.avg(F.col("will_be_delayed").cast("int")).alias("late"))
        .collect()
    }
    assert by_weather["Snow"] > 0.9 and by_weather["Clear"] < 0.1


def test_scoring_needs_all_fields_and_a_model(spark, trained, tmp_path):
    root, _ = trained
    rows = shipments(spark, shipment())
    with pytest.raises(ValueError, match="mileage_km.*segment"):
        score(rows.drop("segment", "mileage_km"), f"{root}/models")
    with pytest.raises(ValueError, match="region is double"):
        score(rows.withColumn("region", F.lit(1.0)), f"{root}/models")
    with pytest.raises(FileNotFoundError):
        score(rows, f"file:{tmp_path}")


def test_worse_model_is_saved_with_a_warning_and_one_predecessor(spark, trained, caplog):
    root, _ = trained
    store = ModelStore(spark, f"{root}/models")
    model, details = store.load(), store.details()
    for auc in (0.4, 0.3):
        store.save(model, details | {"metrics": {"roc_auc": auc}})
    assert "worse" in caplog.text
    assert store.details()["metrics"]["roc_auc"] == 0.3
    assert store.details("previous")["metrics"]["roc_auc"] == 0.4
    assert store.load("previous").stages
    store.save(model, details)


def test_chosen_candidates_only(spark, trained, tmp_path):
    root, _ = trained
    wh = Warehouse(spark, f"{root}/wh")
    config = replace(SMALL, models=("Logistic Regression",))
    assert [r["model"] for r in training.train(wh, f"file:{tmp_path}/m", config).collect()] == [
        "Logistic Regression"
    ]
    with pytest.raises(ValueError, match="unknown models"):
        training.train(wh, f"file:{tmp_path}/n", replace(SMALL, models=("Oracle",)))


def test_fits_take_as_many_tasks_as_their_rows_are_worth(spark, trained, tmp_path, monkeypatch):
    """300 rows are one task, however many the split and its joins were dealt to."""
    root, _ = trained
    tasks, plain = [], training.LogisticRegression.fit

    def fit(self, rows, *args):
        tasks.append(rows.rdd.getNumPartitions())
        return plain(self, rows, *args)

    monkeypatch.setattr(training.LogisticRegression, "fit", fit)
    config = replace(SMALL, models=("Logistic Regression",))
    training.train(Warehouse(spark, f"{root}/wh"), f"file:{tmp_path}/m", config)
    assert tasks == [1] * (1 + SMALL.folds)
    monkeypatch.setattr(training, "LEAST_TASK_ROWS", 10)
    many = spark.range(1000).selectExpr("concat('s', id) AS source_shipment_id")
    assert training.in_fit_tasks(many, 35).rdd.getNumPartitions() == 4
    monkeypatch.setattr(training, "MOST_TASK_ROWS", 20)
    assert training.in_fit_tasks(many, 1000).rdd.getNumPartitions() == 50


def test_registered_models_are_fitted_on_all_training_rows(spark, tmp_path, monkeypatch):
    """25,100 training rows, with the settings of the registered queries but one quick model."""
    fields = {name: "1.0D" for name in REQUIRED_FIELDS} | {name: "'a'" for name in CATEGORICAL}
    fields |= {"weight_kg": "double(id % 100)", "is_weekend": "id % 2 = 0"}
    columns = [f"{value} AS {name}" for name, value in fields.items()]
    rows = spark.range(31_375).selectExpr(
        "concat('S', id) AS source_shipment_id", "int(id % 100 > 40) AS label", *columns
    )
    monkeypatch.setattr(training, "training_set", lambda wh: rows)
    config = replace(built.TRAINING, folds=2, iterations=5, models=("Logistic Regression",))
    root = f"file:{tmp_path}/m"
    training.train(Warehouse(spark, f"file:{tmp_path}/wh"), root, config)
    counts = ModelStore(spark, root).details()["rows"]
    assert counts == {"train": 25_100, "fitted": 25_100, "test": 6_275}
