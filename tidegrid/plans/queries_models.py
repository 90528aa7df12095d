"""Registered queries: training, tuning, importance, bands, registry, forecasts.

Tree models are not expressible in SQL, so most are checked for rows here and for properties in the tests. The registry
queries have oracles: their metrics are per-user errors of a persistence forecast. Training uses all series together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.models import forecast as fc
from tidegrid.models import registry as reg
from tidegrid.models import training, tuning
from tidegrid.operators.features import FeatureConfig
from tidegrid.operators.quality import drop_null_critical
from tidegrid.operators.windows import impute_canonical
from tidegrid.plans import jobs, tables
from tidegrid.plans.catalog import HOURLY, i, n, query, r, t
from tidegrid.plans.queries_series import forecast
from tidegrid.session import cut_lineage, scratch_path
from tidegrid.sources import layers

KEY = ["event_type"]
# The library's documented lags, windows, hyperparameters and forecast steps.
CONFIG = FeatureConfig()
PARAMS = dict(training.TREE_PARAMS)
STEPS = range(1, 25)


def series(spark: SparkSession, d: str) -> DataFrame:
    return tables.hourly(spark, d).select(*KEY, "datetime", F.col("total").alias("electricity_demand"), "mean")


def _rows(spark, d):
    view, names = fc.training_rows(series(spark, d), CONFIG, keys=KEY)
    return cut_lineage(view), names


def _fitted(spark, d):
    view, names = _rows(spark, d)
    return view, training.fit_model(view, names, PARAMS)


def _metrics_frame(spark, metrics: dict) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in sorted(metrics.items())], "metric string, value double")


@query("train_gbt")
def train_gbt(spark, d):
    view, fitted = _fitted(spark, d)
    return training.evaluate(fitted, view, keys=KEY)


@query("train_early_stopping")
def train_early_stopping(spark, d):
    view, names = _rows(spark, d)
    fitted = training.fit_model(view, names, PARAMS, patience=10)
    trees = fitted.model.stages[-1].getNumTrees
    return _metrics_frame(spark, {**fitted.metrics, "trees": trees})


@query("feature_importance")
def feature_importance(spark, d):
    return training.feature_importance(spark, _fitted(spark, d)[1])


@query("select_features")
def select_features(spark, d):
    return training.select_features(training.feature_importance(spark, _fitted(spark, d)[1]))


@query("prediction_band")
def prediction_band(spark, d):
    view, fitted = _fitted(spark, d)
    test, val = (fitted.transform(view.where(F.col("split") == s)) for s in ("test", "val"))
    band = training.prediction_band(test, val, keys=KEY)
    return band.select(*KEY, "datetime", "label", "prediction", "lower", "upper")


@query("predict_with_metadata")
def predict_with_metadata(spark, d):
    view, fitted = _fitted(spark, d)
    made = training.predict_with_metadata(
        fitted,
        view.where("split = 'test'"),
        view.where("split = 'val'"),
        "gbt",
        "v1.0.0",
        training.feature_importance(spark, fitted),
        KEY,
    )
    return made.withColumn("feature_importance", F.size("feature_importance"))


@query("cross_validate")
def cross_validate(spark, d):
    view, names = _rows(spark, d)
    return tuning.cross_validate(view, names, PARAMS, 5, KEY)[1]


@query("grid_search")
def grid_search(spark, d):
    view, names = _rows(spark, d)
    trials = tuning.grid_search(view, names, {"maxDepth": [4, 6], "stepSize": [0.05, 0.1]})
    return trials.select("trial", F.col("params").cast("string").alias("params"), "score")


@query("random_search")
def random_search(spark, d):
    view, names = _rows(spark, d)
    trials = tuning.random_search(view, names, {"maxDepth": (2, 6), "stepSize": (0.05, 0.3)})
    return trials.select("trial", F.col("params").cast("string").alias("params"), "score")


@query("forecast_next")
def forecast_next(spark, d):
    view, fitted = _fitted(spark, d)
    whole = series(spark, d)
    end = whole.agg(F.max("datetime")).first()[0]
    recent = layers.load_recent(whole, None, end, 192, KEY)
    return fc.forecast_next(recent, fitted, CONFIG, KEY)


@query("forecast_horizon")
def forecast_horizon(spark, d):
    """All 24 steps by one model that has the step as a feature."""
    whole = cut_lineage(series(spark, d))
    fitted = fc.fit_horizon(whole, STEPS, CONFIG, keys=KEY, params=PARAMS)
    end = whole.agg(F.max("datetime")).first()[0]
    return fc.forecast_horizon(layers.load_recent(whole, None, end, 192, KEY), fitted, CONFIG, KEY, STEPS)


@query("model_registry")
def model_registry(spark, d):
    """Train, store, reload and predict with the stored model: the reload must score like the original."""
    root = scratch_path(spark, "models")
    done = jobs.full_training(spark, series(spark, d), root, KEY, CONFIG, PARAMS)
    whole = series(spark, d)
    end = whole.agg(F.max("datetime")).first()[0]
    made = jobs.prediction(spark, whole, None, root, end, f"{root}/predictions", KEY, CONFIG)
    fitted, row = reg.load_model(spark, root, "gbt", done["version"])
    assert row["version"] == done["version"] and len(fitted.names) == row["training"]["features_count"]
    stored = layers.read_predictions(spark, f"{root}/predictions/latest")
    return stored.select("datetime", "predicted", "confidence_lower", "confidence_upper", "model_type").withColumn(
        "series", F.lit(made.count())
    )


@query("train_canonical")
def train_canonical(spark, d):
    """The single national series: canonical, imputed, one model."""
    gold = drop_null_critical(impute_canonical(tables.canonical(spark, d)))
    view, names = fc.training_rows(cut_lineage(gold), CONFIG)
    view = cut_lineage(view)
    fitted = training.fit_model(view, names, PARAMS)
    return training.evaluate(fitted, view)


# Registry tables: one version per series, its metrics those of the persistence forecast

_VERSIONS = f"""{HOURLY}, f AS (SELECT * FROM (SELECT event_type, datetime, total AS y, lag(total, 24) OVER (PARTITION BY event_type ORDER BY datetime) AS p FROM hourly) WHERE p IS NOT NULL),
reg AS (SELECT event_type AS version, round(sqrt(avg((y - p) * (y - p))) + 1e-9, 6) AS rmse, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) + 1e-9, 6) AS r2,
  count(*) AS rows_, max(datetime) AS done FROM f GROUP BY 1)"""


def _versions(spark, d) -> DataFrame:
    from tidegrid.functions import errors
    from tidegrid.schemas import REGISTRY

    rows = forecast(spark, d).groupBy(F.col("event_type").alias("version")).agg(
        tables.fixed(errors.rmse("y", "p")).alias("rmse"),
        tables.fixed(errors.r2("y", "p")).alias("r2"),
        F.count(F.lit(1)).alias("rows_"),
        F.date_format(F.max("datetime"), "yyyy-MM-dd HH:mm:ss").alias("done"),
    )
    values = {"completed_at": F.col("done"), "total_samples": F.col("rows_")}
    record = REGISTRY["training"].dataType
    made = F.struct(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in record.fields])
    return rows.select(
        F.lit("gbt").alias("model_type"),
        "version",
        made.alias("training"),
        F.create_map(F.lit("rmse"), F.col("rmse"), F.lit("r2"), F.col("r2")).alias("metrics"),
        F.create_map(F.lit("source"), F.lit("events")).alias("tags"),
        F.lit("").alias("notes"),
    )


@query(
    "compare_versions",
    f"""WITH {_VERSIONS}, x AS (SELECT a.rmse AS v1, b.rmse AS v2, (a.rmse - b.rmse) / a.rmse * 100 AS g FROM reg a, reg b WHERE a.version = 'click' AND b.version = 'view')
SELECT 'click' AS version1, 'view' AS version2, 'rmse' AS metric, {r('v1', 'version1_value')}, {r('v2', 'version2_value')}, (v2 < v1) AS is_version2_better,
{r('g', 'improvement_percentage')}, CASE WHEN g > 0 THEN printf('view is %.2f%% better than click on rmse', abs(g))
  WHEN g < 0 THEN printf('view is %.2f%% worse than click on rmse', abs(g)) ELSE 'view has same rmse as click' END AS summary FROM x""",
)
def compare_versions(spark, d):
    return reg.compare_versions(_versions(spark, d), "click", "view", "rmse")


@query("best_model", f"WITH {_VERSIONS} SELECT version, {r('r2', 'value')} FROM reg ORDER BY r2 DESC, version LIMIT 1")
def best_model(spark, d):
    return reg.best_model(_versions(spark, d), "r2").select("version", F.col("metrics")["r2"].alias("value"))


@query("promote", f"WITH {_VERSIONS} SELECT version, {r('rmse', 'value')} FROM reg ORDER BY rmse, version LIMIT 1")
def promote(spark, d):
    return reg.promote(_versions(spark, d)).select("version", F.col("metrics")["rmse"].alias("value"))


@query(
    "latest_version",
    f"WITH {_VERSIONS} SELECT version, {n('rows_', 'samples')} FROM reg ORDER BY done DESC, version DESC LIMIT 1",
)
def latest_version(spark, d):
    return reg.latest_version(_versions(spark, d)).select("version", F.col("training.total_samples").alias("samples"))


@query(
    "retain_versions",
    f"WITH {_VERSIONS} SELECT version, (row_number() OVER (ORDER BY done DESC, version DESC) <= 3) AS keep FROM reg",
)
def retain_versions(spark, d):
    return reg.retain_versions(_versions(spark, d), 3).select("version", "keep")


@query(
    "registry_report",
    f"WITH {_VERSIONS} SELECT version, {n('rows_', 'total_samples')}, {r('rmse')} FROM reg",
)
def registry_report(spark, d):
    return reg.registry_report(_versions(spark, d)).select("version", "total_samples", F.col("metrics")["rmse"].alias("rmse"))


@query(
    "top_trials",
    f"WITH {_VERSIONS}, x AS (SELECT row_number() OVER (ORDER BY version) AS trial, rmse AS score FROM reg) SELECT {i('trial')}, {r('score')} FROM x ORDER BY score, trial LIMIT 3",
)
def top_trials(spark, d):
    from pyspark.sql import Window

    from tidegrid.operators.ranking import top_trials as best

    # One row per version: the registry is small by nature.
    number = F.row_number().over(Window.partitionBy("model_type").orderBy("version")).alias("trial")
    return best(_versions(spark, d).select(number, F.col("metrics")["rmse"].alias("score")), n=3)


# Linear models of one feature, the demand of the hour, through the same operators: their numbers have closed forms in SQL.
# Results are rounded to three decimals, since sums are taken in another order.

ONE = FeatureConfig(lags=(24,), windows=())
ONLY = ["electricity_demand"]


def _linear_sql(steps: str = "1") -> str:
    return f"""{HOURLY},
s AS (SELECT event_type, datetime, total AS x, h, row_number() OVER w AS i, lead(total, h::INT) OVER w AS y
      FROM hourly, (SELECT unnest([{steps}]) AS h) WINDOW w AS (PARTITION BY event_type, h ORDER BY datetime)),
k AS (SELECT *, row_number() OVER (PARTITION BY event_type, h ORDER BY datetime) AS k, count(*) OVER (PARTITION BY event_type, h) AS c
      FROM s WHERE i > 24 AND y IS NOT NULL),
part AS (SELECT *, CASE WHEN k <= floor(c * 0.7::DOUBLE) THEN 'train' WHEN k <= floor(c * 0.7::DOUBLE) + floor(c * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM k),
coef AS (SELECT h, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, avg(x) AS mx, avg(y) AS my FROM part WHERE split = 'train' GROUP BY h),
scored AS (SELECT part.*, a + b * x AS p, b, mx FROM part JOIN coef USING (h)),
newest AS (SELECT event_type, max(datetime) AS datetime, max_by(total, datetime) AS x, (count(*) FILTER (WHERE datetime >= last - INTERVAL 192 HOUR))::INTEGER AS used
           FROM hourly, (SELECT max(datetime) AS last FROM hourly) GROUP BY event_type)"""


def q(expr: str, name: str) -> str:
    return r(f"round(({expr})::DOUBLE, 3)", name)


def three(df: DataFrame) -> DataFrame:
    """Reals to three decimals."""
    return df.withColumns({name: F.round(name, 3) for name, kind in df.dtypes if kind == "double"})


_RMSE, _MAPE = "sqrt(avg((y - p) * (y - p)))", "avg(CASE WHEN y != 0 THEN abs((y - p) / y) END) * 100"
_FIVE = f"{q(_RMSE, 'rmse')}, {q(_MAPE, 'mape')}, {q('avg(abs(y - p))', 'mae')}, {q('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y))', 'r2')}, {q('avg(p - y)', 'forecast_bias')}"


def _linear_rows(spark, d):
    view, names = fc.training_rows(series(spark, d), ONE, keys=KEY, only=ONLY)
    return cut_lineage(view), names


def _linear(spark, d):
    view, names = _linear_rows(spark, d)
    return view, training.fit_model(view, names, kind="linear")


@query("linear_test_metrics", f"WITH {_linear_sql()} SELECT event_type, {_FIVE} FROM scored WHERE split = 'test' GROUP BY event_type")
def linear_test_metrics(spark, d):
    view, fitted = _linear(spark, d)
    return three(training.evaluate(fitted, view, keys=KEY))


@query(
    "linear_fit_metrics",
    f"""WITH {_linear_sql()}, m AS (SELECT split, {_RMSE} AS rmse, {_MAPE} AS mape, count(*) AS n FROM scored GROUP BY split)
SELECT split || '_rmse' AS metric, {q('rmse', 'value')} FROM m WHERE split != 'test' UNION ALL SELECT split || '_samples', n::DOUBLE FROM m WHERE split != 'test'
UNION ALL SELECT 'val_mape', {q('mape', 'value')} FROM m WHERE split = 'val'""",
)
def linear_fit_metrics(spark, d):
    return three(_metrics_frame(spark, _linear(spark, d)[1].metrics))


@query(
    "linear_training_view",
    f"WITH {_linear_sql()} SELECT event_type, {t('datetime')}, split, {q('y', 'label')}, {q('x', 'feature')} FROM part",
)
def linear_training_view(spark, d):
    """The split training table: label, and the one feature out of its vector."""
    from pyspark.ml.functions import vector_to_array

    view, _ = _linear_rows(spark, d)
    return three(view.select(*KEY, "datetime", "split", "label", vector_to_array("features")[0].alias("feature")))


@query(
    "scaled_features",
    f"""WITH {_linear_sql()}, m AS (SELECT avg(x) AS mx, stddev_samp(x) AS sx FROM part WHERE split = 'train')
SELECT event_type, {t('datetime')}, {q('(x - m.mx) / sx', 'scaled')} FROM part, m""",
)
def scaled_features(spark, d):
    """Features on the scale of the training rows."""
    from pyspark.ml.functions import vector_to_array

    view, fitted = _linear(spark, d)
    return three(fitted.transform(view).select(*KEY, "datetime", vector_to_array("scaled")[0].alias("scaled")))


_FOLDS = f"""{_linear_sql()}, f AS (SELECT part.*, fold, floor(c / 6) AS size FROM part, (SELECT unnest(range(1, 6)) AS fold)),
roles AS (SELECT *, CASE WHEN k <= c - (6 - fold) * size THEN 'train' WHEN k <= c - (5 - fold) * size THEN 'test' END AS role FROM f),
line AS (SELECT fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM roles WHERE role = 'train' GROUP BY fold),
tried AS (SELECT fold, y, a + b * x AS p FROM roles JOIN line USING (fold) WHERE role = 'test'),
per AS (SELECT fold, {_RMSE} AS rmse, {_MAPE} AS mape, avg(abs(y - p)) AS mae, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS r2, avg(p - y) AS forecast_bias FROM tried GROUP BY fold),
long AS (UNPIVOT per ON rmse, mape, mae, r2, forecast_bias INTO NAME metric VALUE value)"""


@query("linear_cross_validation", f"WITH {_FOLDS} SELECT metric, {q('avg(value)', 'mean')}, {q('stddev_pop(value)', 'std')}, {q('min(value)', 'min')}, {q('max(value)', 'max')} FROM long GROUP BY metric")
def linear_cross_validation(spark, d):
    view, names = _linear_rows(spark, d)
    return three(tuning.cross_validate(view, names, None, 5, KEY, kind="linear")[1])


@query(
    "linear_grid_search",
    f"""WITH {_linear_sql()} SELECT 1::INTEGER AS trial, {q(_RMSE, 'score')} FROM scored WHERE split = 'val'
UNION ALL SELECT 2::INTEGER, {q('sqrt(avg((y - b * (x - mx)) * (y - b * (x - mx))))', 'score')} FROM scored WHERE split = 'val'""",
)
def linear_grid_search(spark, d):
    """With and without an intercept; features are centred, so the second predicts the deviation alone."""
    view, names = _linear_rows(spark, d)
    trials = tuning.grid_search(view, names, {"fitIntercept": [True, False]}, kind="linear")
    return three(trials.select("trial", "score"))


@query(
    "linear_random_search",
    f"WITH {_linear_sql()} SELECT trial::INTEGER AS trial, {q(_RMSE, 'score')} FROM scored, (SELECT unnest(range(1, 5)) AS trial) WHERE split = 'val' GROUP BY trial",
)
def linear_random_search(spark, d):
    """Draws of the regulariser's mixing, which without a penalty changes nothing: all trials score as least squares does."""
    view, names = _linear_rows(spark, d)
    trials = tuning.random_search(view, names, {"elasticNetParam": (0.0, 1.0), "maxIter": (1, 50)}, n=4, kind="linear")
    return three(trials.select("trial", "score"))


@query(
    "linear_forecast_next",
    f"WITH {_linear_sql()} SELECT event_type, {t('datetime + INTERVAL 1 HOUR', 'prediction_for')}, {q('a + b * x', 'predicted_value')}, {i('used', 'historical_hours_used')} FROM newest, coef",
)
def linear_forecast_next(spark, d):
    whole = series(spark, d)
    end = whole.agg(F.max("datetime")).first()[0]
    made = fc.forecast_next(layers.load_recent(whole, None, end, 192, KEY), _linear(spark, d)[1], ONE, KEY)
    return three(made.select(*KEY, "prediction_for", "predicted_value", "historical_hours_used"))


@query(
    "linear_forecast_horizon",
    f"""WITH {_linear_sql(', '.join(map(str, STEPS)))} SELECT event_type, {i('h', 'step')}, {t('datetime + to_hours(h::INT)', 'prediction_for')}, {q('a + b * x', 'predicted_value')}
FROM newest, coef""",
)
def linear_forecast_horizon(spark, d):
    """24 direct models, one for each step, from one table of features and labels."""
    whole = cut_lineage(series(spark, d))
    models = fc.fit_by_step(whole, STEPS, ONE, keys=KEY, kind="linear", only=ONLY)
    end = whole.agg(F.max("datetime")).first()[0]
    made = fc.forecast_horizon(layers.load_recent(whole, None, end, 192, KEY), models, ONE, KEY)
    return three(made.select(*KEY, "step", "prediction_for", "predicted_value"))


_BAND = f"""{_linear_sql()}, marks AS (SELECT quantile_cont(y - p, 0.025) AS lo, quantile_cont(y - p, 0.975) AS hi FROM scored WHERE split = 'val')"""


@query("linear_prediction_band", f"WITH {_BAND} SELECT event_type, {t('datetime')}, {q('p', 'prediction')}, {q('p + lo', 'lower')}, {q('p + hi', 'upper')} FROM scored, marks WHERE split = 'test'")
def linear_prediction_band(spark, d):
    view, fitted = _linear(spark, d)
    test, val = (fitted.transform(view.where(F.col("split") == s)) for s in ("test", "val"))
    return three(training.prediction_band(test, val).select(*KEY, "datetime", "prediction", "lower", "upper"))


@query(
    "linear_predict_with_metadata",
    f"""WITH {_BAND} SELECT event_type, {t('datetime')}, {q('p', 'predicted_value')}, {q('p + lo', 'confidence_lower')}, {q('p + hi', 'confidence_upper')},
'linear' AS model_type, 'v1' AS model_version, 1::INTEGER AS feature_count FROM scored, marks WHERE split = 'test'""",
)
def linear_predict_with_metadata(spark, d):
    view, fitted = _linear(spark, d)
    return three(training.predict_with_metadata(fitted, view.where("split = 'test'"), view.where("split = 'val'"), "linear", "v1", None, KEY))


@query(
    "linear_registry",
    f"""WITH {_BAND}, m AS (SELECT split, {_RMSE} AS rmse, count(*) AS n FROM scored GROUP BY split)
SELECT event_type, {t('datetime + INTERVAL 1 HOUR', 'prediction_for')}, {q('a + b * x', 'predicted')}, {q('a + b * x + lo', 'confidence_lower')}, {q('a + b * x + hi', 'confidence_upper')},
(SELECT sum(n) FROM m)::BIGINT AS samples, (SELECT {q('rmse', 'v')} FROM m WHERE split = 'test') AS test_rmse, 'electricity_demand' AS features FROM newest, coef, marks""",
)
def linear_registry(spark, d):
    """Train, register, load the stored model, predict with it, and read the registry and both copies of the predictions."""
    root, whole = scratch_path(spark, "models"), series(spark, d)
    done = jobs.full_training(spark, whole, root, KEY, ONE, kind="linear", only=ONLY)
    end = whole.agg(F.max("datetime")).first()[0]
    made = jobs.prediction(spark, whole, None, root, end, f"{root}/predictions", KEY, ONE, margin=168, kind="linear")
    row = layers.read_registry(spark, f"{root}/registry").where(F.col("version") == done["version"])
    facts = row.select(F.col("training.total_samples").alias("samples"), F.col("metrics")["rmse"].alias("test_rmse"), F.array_join("training.feature_names", ",").alias("features"))
    both = [layers.read_predictions(spark, f"{root}/predictions/{copy}") for copy in ("latest", "date=*")]
    if both[0].exceptAll(both[1]).count() or both[1].count() != made.count():
        raise ValueError("the two copies of the predictions differ")
    value = F.struct(*facts.columns)
    out = made.withColumn("facts", facts.select(value).scalar())
    return three(out.select(*KEY, F.col("prediction_for").cast("timestamp_ntz"), F.col("predicted_value").alias("predicted"), "confidence_lower", "confidence_upper", "facts.*"))


@query(
    "select_features_rows",
    f"""WITH {HOURLY}, x AS (SELECT event_type AS feature, sum(total) AS importance FROM hourly GROUP BY 1)
SELECT feature, {r('importance')} FROM x WHERE importance >= (SELECT quantile_cont(importance, 0.5) FROM x)""",
)
def select_features_rows(spark, d):
    totals = tables.hourly(spark, d).groupBy(F.col("event_type").alias("feature")).agg(F.sum("total").alias("importance"))
    return training.select_features(totals)
