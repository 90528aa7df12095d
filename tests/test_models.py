import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.models import forecast as fc
from tidegrid.models import registry as reg
from tidegrid.models import training, tuning
from tidegrid.operators.features import FeatureConfig
from tidegrid.plans import jobs
from tidegrid.session import scratch_path
from tidegrid.sources import layers

CONFIG = FeatureConfig(lags=(1, 24), windows=(3,))
SMALL = {"maxIter": 5, "maxDepth": 3}
T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def gold(spark):
    rng = np.random.default_rng(7)
    rows = []
    for h in range(300):
        t = T0 + timedelta(hours=h)
        warm = 25 + 5 * np.sin(2 * np.pi * h / 24)
        rows.append((t, float(1000 + 40 * warm + rng.normal(0, 5)), float(warm)))
    return spark.createDataFrame(rows, "datetime timestamp_ntz, electricity_demand double, temperature double")


@pytest.fixture(scope="module")
def fitted(gold):
    view, names = fc.training_rows(gold, CONFIG)
    view = view.persist()
    return view, names, training.fit_model(view, names, SMALL)


def test_fit_learns_and_importance_adds_up(spark, fitted):
    view, names, model = fitted
    assert training.evaluate(model, view).first()["r2"] > 0.5
    shares = training.feature_importance(spark, model).collect()
    assert sum(r["importance"] for r in shares) == pytest.approx(1.0)
    assert {r["feature"] for r in shares} == set(names)
    assert [r["importance"] for r in shares] == sorted((r["importance"] for r in shares), reverse=True)


def test_scaler_sees_only_train(fitted):
    view, _, model = fitted
    train = np.array([r["features"].toArray() for r in view.where("split = 'train'").select("features").collect()])
    assert np.allclose(model.model.stages[0].mean.toArray(), train.mean(axis=0))


def test_band_is_residual_quantiles(fitted):
    view, _, model = fitted
    test, val = (model.transform(view.where(F.col("split") == s)) for s in ("test", "val"))
    residuals = [r[0] for r in val.select(F.col("label") - F.col("prediction")).collect()]
    low, high = np.quantile(residuals, [0.025, 0.975])
    for r in training.prediction_band(test, val).collect():
        assert r["lower"] - r["prediction"] == pytest.approx(low) and r["upper"] - r["prediction"] == pytest.approx(high)


def test_search_orders_trials(fitted):
    view, names, _ = fitted
    trials = tuning.grid_search(view, names, {"maxIter": [1, 4], "maxDepth": [2]}).collect()
    assert [r["score"] for r in trials] == sorted(r["score"] for r in trials) and len(trials) == 2
    drawn = tuning.sampled({"maxDepth": (2, 4), "stepSize": (0.1, 0.2)}, 20)
    assert {d["maxDepth"] for d in drawn} <= {2, 3, 4} and all(0.1 <= d["stepSize"] <= 0.2 for d in drawn)
    assert drawn == tuning.sampled({"maxDepth": (2, 4), "stepSize": (0.1, 0.2)}, 20)


def test_cross_validation_summarises_folds(fitted):
    view, names, _ = fitted
    folds, summary = tuning.cross_validate(view, names, {"maxIter": 1, "maxDepth": 2}, 3)
    rmse = [r["rmse"] for r in folds.collect()]
    row = summary.where("metric = 'rmse'").first()
    assert len(rmse) == 3 and row["mean"] == pytest.approx(np.mean(rmse)) and row["std"] == pytest.approx(np.std(rmse))


def test_train_register_predict(spark, gold):
    root = scratch_path(spark, "models")
    done = jobs.full_training(spark, gold, root, (), CONFIG, SMALL)
    last = T0 + timedelta(hours=299)
    row = jobs.prediction(spark, gold, None, root, last, f"{root}/out", (), CONFIG).first()
    assert row["prediction_for"].startswith("2024-01-13 12:00") and row["model_version"] == done["version"]
    assert row["confidence_lower"] <= row["predicted_value"] <= row["confidence_upper"]
    assert layers.read_predictions(spark, f"{root}/out/latest").count() == 1
    stored = reg.registry(spark, root).first()
    assert stored["training"]["total_samples"] == sum(stored["training"][f"{s}_samples"] for s in ("train", "val", "test"))
    loaded, _ = reg.load_model(spark, root, "gbt")
    view, _ = fc.training_rows(gold, CONFIG)
    a = loaded.transform(view).agg(F.sum("prediction")).first()[0]
    b = done["fitted"].transform(view).agg(F.sum("prediction")).first()[0]
    assert a == pytest.approx(b)
    with pytest.raises(ValueError):
        reg.load_model(spark, root, "gbt", "v0")


def test_version_sentences(spark):
    def pair(metric, a, b):
        df = spark.createDataFrame([("v1", "v2", metric, a, b)], "version1 string, version2 string, metric string, version1_value double, version2_value double")
        return reg.with_comparison(df, metric).first()

    better = pair("rmse", 50.0, 40.0)
    assert better["summary"] == "v2 is 20.00% better than v1 on rmse" and better["is_version2_better"]
    assert pair("r2", 0.8, 0.6)["summary"] == "v2 is 25.00% worse than v1 on r2"
    assert pair("rmse", 5.0, 5.0)["summary"] == "v2 has same rmse as v1"
    assert pair("other", 5.0, 6.0)["is_version2_better"] is None


def test_models_are_named():
    assert "gbt" in training.list_models()
    with pytest.raises(ValueError):
        training.model("none")


def test_registry_of_documents(spark, tmp_path):
    """One metadata document per version, as JSON files in version folders."""
    for version, rmse in (("v1.0.1", 50.0), ("v1.0.2", 40.0)):
        folder = tmp_path / "gbt" / version
        folder.mkdir(parents=True)
        doc = {
            "model_type": "gbt",
            "version": version,
            "training": {"completed_at": f"2024-01-0{version[-1]}T00:00:00", "total_samples": 10, "feature_names": ["a"]},
            "metrics": {"rmse": rmse},
            "tags": {},
            "notes": "",
        }
        (folder / "metadata.json").write_text(json.dumps(doc, indent=2))
        (folder / "metrics.json").write_text(json.dumps({"rmse": rmse}))
    docs = layers.read_model_documents(spark, str(tmp_path))
    assert docs.count() == 2
    assert reg.latest_version(docs).first()["version"] == "v1.0.2"
    assert reg.best_model(docs).first()["version"] == reg.promote(docs).first()["version"] == "v1.0.2"
    assert reg.compare_versions(docs, "v1.0.1", "v1.0.2").first()["improvement_percentage"] == pytest.approx(20.0)
    kept = {r["version"]: r["keep"] for r in reg.retain_versions(docs, 1).collect()}
    assert kept == {"v1.0.1": False, "v1.0.2": True}


def test_patience_keeps_the_prefix_that_brute_force_chooses(fitted):
    view, names, _ = fitted
    held = view.where("split = 'val'")
    whole = training.fit_model(view, names, {"maxIter": 12, "maxDepth": 3, "stepSize": 0.6})
    errors = []
    for k in range(1, 13):
        short = training.fit_model(view, names, {"maxIter": k, "maxDepth": 3, "stepSize": 0.6})
        errors.append(short.metrics["val_rmse"])
    for patience, delta in ((1, 0.0), (3, 0.0), (2, 0.5), (20, 0.0)):
        best, kept, waited = float("inf"), 0, 0
        for k, e in enumerate(errors, 1):
            best, kept, waited = (e, k, 0) if e < best - delta else (best, kept, waited + 1)
            if waited == patience:
                break
        cut = training.fit_model(view, names, {"maxIter": 12, "maxDepth": 3, "stepSize": 0.6}, patience=patience, min_delta=delta)
        assert cut.model.stages[-1].getNumTrees == kept == cut.metrics["rounds"]
        assert cut.metrics["val_rmse"] == pytest.approx(errors[kept - 1])
    assert whole.model.stages[-1].getNumTrees == 12 and held.count()


def test_one_table_of_labels_equals_a_view_for_each_step(gold):
    table, names = fc.horizon_rows(gold, [1, 5, 24], CONFIG)
    for step in (1, 5, 24):
        view, own = fc.training_rows(gold, CONFIG, steps=step)
        assert names == own
        want = sorted((r["datetime"], r["label"], r["split"], r["features"].toArray().tolist()) for r in view.collect())
        label = F.col(f"label_{step}")
        rows = table.where(label.isNotNull()).select("datetime", label.alias("label"), fc.split_of(step).alias("split"), "features")
        assert sorted((r["datetime"], r["label"], r["split"], r["features"].toArray().tolist()) for r in rows.collect()) == want


def test_horizon_by_one_model_and_by_step(gold):
    one = fc.fit_horizon(gold, [1, 2, 3], CONFIG, params=SMALL)
    each = fc.fit_by_step(gold, [1, 2, 3], CONFIG, params=SMALL)
    for models in (one, each):
        rows = fc.forecast_horizon(gold, models, CONFIG, steps=[1, 2, 3]).orderBy("step").collect()
        assert [r["step"] for r in rows] == [1, 2, 3]
        assert [r["prediction_for"] - r["based_on_data_until"] for r in rows] == [timedelta(hours=h) for h in (1, 2, 3)]
        assert all(1500 < r["predicted_value"] < 2700 for r in rows)


def test_resampled_band_covers_and_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(3)
    rows = []
    for h in range(24 * 60):
        t = T0 + timedelta(hours=h)
        rows.append((t, float(rng.normal(0, 1 + h % 24)), 0.0))  # the spread grows with the hour of the day
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, label double, prediction double")
    half = T0 + timedelta(hours=24 * 30)
    val, test = df.where(F.col("datetime") < half), df.where(F.col("datetime") >= half)
    band = training.bootstrap_band(test, val).orderBy("datetime").collect()
    again = training.bootstrap_band(test.repartition(7), val.repartition(13)).orderBy("datetime").collect()
    assert [(r["lower"], r["upper"]) for r in band] == [(r["lower"], r["upper"]) for r in again]
    assert 0.85 <= np.mean([r["lower"] <= r["label"] <= r["upper"] for r in band]) <= 1.0
    width = {r["datetime"].hour: r["upper"] - r["lower"] for r in band}
    assert len({(r["datetime"].hour, r["upper"]) for r in band}) == 24 and width[23] > 5 * width[0]


def test_fits_of_few_rows_are_one_task(fitted, monkeypatch):
    """Folds and trials are cut by their rows, not by the width of the shuffle that made them."""
    view, names, _ = fitted
    seen = []

    class Counted:
        def __init__(self, own):
            self.own = own

        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))
            return self.own.fit(rows)

    real = tuning.model
    monkeypatch.setattr(tuning, "model", lambda kind: lambda *given: Counted(real(kind)(*given)))
    spread = view.repartition(8)
    tuning.cross_validate(spread, names, None, 3, kind="linear")
    tuning.grid_search(spread, names, {"maxIter": [5, 9]}, kind="linear")
    assert len(seen) == 5 and {parts for parts, _ in seen} == {1}
    seen.clear()
    monkeypatch.setattr(tuning, "TASK_ROWS", 50)
    tuning.cross_validate(spread, names, None, 3, kind="linear")
    assert sorted(parts for parts, _ in seen) == sorted(-(-n // 50) for _, n in seen) and max(seen)[0] > 1
