"""Features and linear models.

On one standardised feature every penalised solution has a closed form; the oracles of the fits on all
features, which SQL has to solve, are in :mod:`salesflow.catalog.fits`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.catalog.base import on_sales, query
from salesflow.functions.cleaning import below
from salesflow.operators import features as X
from salesflow.operators import regression as R
from salesflow.plans.flows import model_frames
from salesflow.session import stage, work_dir
from salesflow.sources.testdata import sales, sales_files
from salesflow.sources.files import read_sales

_P, _R = X.PROPERTY_CATEGORIES, X.RESIDENTIAL_CATEGORIES
_BUCKET = "((serial_number % 1000003) * 7919 + 0) % 1000003"
_IN_TEST = f"{_BUCKET} % 100 < 15"


def _dummy_sql(column: str, prefix: str, values: list[str]) -> str:
    return ", ".join(
        f"""coalesce(CAST({column} = '{v}' AS DOUBLE), 0) AS "{prefix}_{v}\"""" for v in values)


def _mode_sql(column: str, source: str) -> str:
    return (f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} "
            f"ORDER BY count(*) DESC, {column} LIMIT 1)")


@query("impute_mode", on_sales(
    f"SELECT serial_number, coalesce(property_type, {_mode_sql('property_type', 'sales')}) "
    f"AS property_type, coalesce(residential_type, {_mode_sql('residential_type', 'sales')}) "
    f"AS residential_type FROM sales"))
def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["property_type", "residential_type"]
    rows = stage(sales(spark, sf_dir, "serial_number", *columns), "rows")
    return X.impute_mode(rows, X.modes_of(rows, columns))


@query("one_hot_property", on_sales(
    f"SELECT serial_number, {_dummy_sql('property_type', 'Property', _P)} FROM sales"))
def one_hot_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir, "serial_number", "property_type").select(
        "serial_number", *X.dummies("property_type", "Property", _P))


@query("one_hot_residential", on_sales(
    f"SELECT serial_number, {_dummy_sql('residential_type', 'Residential', _R)} FROM sales"))
def one_hot_residential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir, "serial_number", "residential_type").select(
        "serial_number", *X.dummies("residential_type", "Residential", _R))


@query("feature_concat", on_sales(
    f"SELECT serial_number, property_type, residential_type, "
    f"{_dummy_sql('property_type', 'Property', _P)}, "
    f"{_dummy_sql('residential_type', 'Residential', _R)} FROM sales"))
def feature_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, "serial_number", "property_type", "residential_type")
    return X.with_dummies(rows, *X.dummies("property_type", "Property", _P),
                          *X.dummies("residential_type", "Residential", _R))


@query("standard_scale", on_sales(
    "SELECT serial_number, "
    "round((assessed_value - avg(assessed_value) OVER ()) "
    "/ stddev_pop(assessed_value) OVER (), 6) AS assessed_value, "
    "round((list_year - avg(list_year) OVER ()) / stddev_pop(list_year) OVER (), 6) AS list_year "
    "FROM sales"))
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(sales(spark, sf_dir, "serial_number", "assessed_value", "list_year"), "rows")
    scale = X.moments(rows, "assessed_value", "list_year")
    return rows.select("serial_number", *[
        F.round(scale[c].scale(F.col(c)), 6).alias(c) for c in ("assessed_value", "list_year")])


# The sales that the model uses, prepared, and the town statistics over them.
_MODEL_VIEWS = {
    "usable": "SELECT * FROM sales WHERE sale_amount < 1500000",
    "prepared": (
        f"SELECT * REPLACE (coalesce(property_type, {_mode_sql('property_type', 'usable')}) "
        f"AS property_type, coalesce(residential_type, {_mode_sql('residential_type', 'usable')}) "
        f"AS residential_type) FROM usable "
        f"WHERE sales_ratio > 0.3 AND sales_ratio < 1.3 AND NOT isnan(sales_ratio)"),
    "towns": "SELECT town, avg(sale_amount) AS m, count(*) AS n FROM prepared "
             "WHERE town IS NOT NULL GROUP BY town",
    "town_scale": "SELECT mu, sqrt(sum(n * (m - mu) * (m - mu)) / sum(n)) AS sd FROM towns, "
                  "(SELECT sum(n * m) / sum(n) AS mu FROM towns) GROUP BY mu",
    "scales": "SELECT avg(assessed_value) AS vm, stddev_pop(assessed_value) AS vs, "
              "avg(list_year) AS ym, stddev_pop(list_year) AS ys FROM prepared",
}


@query("target_encode", on_sales(
    'SELECT serial_number, p.town, round((m - mu) / sd, 6) AS "TOWN_ENCODED" '
    'FROM prepared p LEFT JOIN towns t ON p.town = t.town, town_scale', **_MODEL_VIEWS))
def target_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(below(
        sales(spark, sf_dir, "serial_number", "town", "property_type", "residential_type",
              "sales_ratio", "sale_amount", "assessed_value", "list_year"),
        "sale_amount", X.AMOUNT_LIMIT), "usable")
    stats = X.fit_features(rows)
    return X.target_encode(X.prepared(rows, stats.modes), stats).select(
        "serial_number", "town", F.round("TOWN_ENCODED", 6).alias("TOWN_ENCODED"))


@query("feature_frame", on_sales(
    f'SELECT serial_number, round((list_year - ym) / ys, 6) AS "LIST_YEAR", '
    f'round((assessed_value - vm) / vs, 6) AS "ASSESSED_VALUE", '
    f"{_dummy_sql('property_type', 'Property', _P)}, "
    f"{_dummy_sql('residential_type', 'Residential', _R)}, "
    f'round((m - mu) / sd, 6) AS "TOWN_ENCODED", sale_amount AS "SALE_AMOUNT" '
    f"FROM prepared p JOIN towns t ON p.town = t.town, town_scale, scales", **_MODEL_VIEWS))
def feature_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = model_frames(_model_sales(spark, sf_dir), fit_on="all")
    rows = train.unionByName(test).drop("in_test")
    return rows.withColumns({
        c: F.round(c, 6) for c in ("LIST_YEAR", "ASSESSED_VALUE", "TOWN_ENCODED")})


def _model_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored sales; the model reads them for its statistics and for its features."""
    return read_sales(spark, sales_files(spark, sf_dir))


@query("train_test_split", on_sales(
    f"SELECT serial_number, sale_amount, {_IN_TEST} AS in_test FROM sales"))
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, "serial_number", "sale_amount")
    train, test = X.train_test_split(rows, "serial_number")
    return train.withColumn("in_test", F.lit(False)).unionByName(
        test.withColumn("in_test", F.lit(True)))


# --- one standardised feature x, label y

_ONE = {
    "complete": f"SELECT serial_number, assessed_value AS v, sale_amount AS y, {_IN_TEST} AS held "
                f"FROM sales WHERE sale_amount IS NOT NULL",
    "unit": "SELECT avg(v) AS vm, stddev_pop(v) AS vs FROM complete WHERE NOT held",
    "xy": "SELECT serial_number, (v - vm) / vs AS x, y, held FROM complete, unit",
    "moments": "SELECT covar_pop(x, y) AS c, var_pop(x) AS d, avg(x) AS mx, avg(y) AS my, "
               "count(*) AS n FROM xy WHERE NOT held",
}


def _one(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows (serial_number, x, y), stored: a fit reads them repeatedly."""
    rows = sales(spark, sf_dir, "serial_number", "assessed_value", "sale_amount").filter(
        F.col("sale_amount").isNotNull())
    held = X.in_test("serial_number")
    stored = stage(rows.withColumn("held", held), "one-feature")
    scale = X.moments(stored.filter(~F.col("held")), "assessed_value")["assessed_value"]
    xy = stored.select("serial_number", scale.scale(F.col("assessed_value")).alias("x"),
                       F.col("sale_amount").alias("y"), "held")
    return (xy.filter(~F.col("held")).drop("held"), xy.filter(F.col("held")).drop("held"))


def _closed_form(l1: str, l2: str) -> str:
    """Weight and intercept of the penalised fit on one feature."""
    weight = f"sign(c) * greatest(abs(c) - {l1}, 0) / (d + {l2})"
    return f"SELECT {weight} AS w, my - mx * {weight} AS b FROM moments"


def _fit_sql(name: str, l1: str, l2: str) -> str:
    return on_sales(f"SELECT '{name}' AS model, round(w, 5) AS coefficient, "
                    f"round(b, 5) AS intercept FROM fitted", **_ONE, fitted=_closed_form(l1, l2))


def _fitted(spark: SparkSession, sf_dir: str, name: str, penalty: R.Penalty) -> DataFrame:
    train, _ = _one(spark, sf_dir)
    model = R.fit(train, ["x"], "y", penalty)
    return spark.createDataFrame(
        [(name, float(model.coefficients[0]), float(model.intercept))],
        "model string, coefficient double, intercept double",
    ).withColumns({c: F.round(c, 5) for c in ("coefficient", "intercept")})


@query("fit_ols", _fit_sql("Linear Regression", "0", "0"))
def fit_ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir, "Linear Regression", R.OLS)


@query("fit_ridge", _fit_sql("Ridge", "0", "1.0 / n"))
def fit_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir, "Ridge", R.ridge())


@query("fit_lasso", _fit_sql("Lasso", "1", "0"))
def fit_lasso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir, "Lasso", R.lasso())


@query("fit_elastic_net", _fit_sql("Elastic Net", "0.5", "0.5"))
def fit_elastic_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir, "Elastic Net", R.elastic_net())


def _bayes_views(moments: str, prefix: str = "") -> dict[str, str]:
    """The evidence-maximising ridge on one feature, one row per step, for each ``part``.

    ``moments``: part, xx, xy, yy (products about the means), mx, my, n. The last step
    repeats the weight of the final precisions.
    """
    weight = "xy / (xx + l / a)"
    return {
        f"{prefix}sums": moments,
        f"{prefix}steps": f"""
SELECT part, 0 AS step, 1.0 / (yy / n + {R.EPS!r}) AS a, CAST(1.0 AS DOUBLE) AS l,
  CAST(0.0 AS DOUBLE) AS w, FALSE AS done, xx, xy, yy, mx, my, n
FROM {prefix}sums
UNION ALL
SELECT part, step + 1,
  CASE WHEN stop THEN a ELSE (n - g + 2e-6) / (greatest(yy - 2 * v * xy + v * v * xx, 0) + 2e-6)
    END,
  CASE WHEN stop THEN l ELSE (g + 2e-6) / (v * v + 2e-6) END,
  v, stop, xx, xy, yy, mx, my, n
FROM (SELECT *, {weight} AS v, a * xx / (l + a * xx) AS g,
        step > 0 AND abs({weight} - w) < 1e-3 AS stop
      FROM {prefix}steps WHERE NOT done AND step < 300)""",
        f"{prefix}bayes": f"""
SELECT part, {weight} AS w, my - mx * {weight} AS b, a, l
FROM {prefix}steps QUALIFY row_number() OVER (PARTITION BY part ORDER BY step DESC) = 1""",
    }


def _recursive(sql: str) -> str:
    return sql.replace("WITH sales", "WITH RECURSIVE sales", 1)


_CENTRED = ("regr_sxx(y, x) AS xx, regr_sxy(y, x) AS xy, regr_syy(y, x) AS yy, "
            "avg(x) AS mx, avg(y) AS my, count(*) AS n")


@query("fit_bayesian_ridge", _recursive(on_sales(
    "SELECT 'Bayesian' AS model, round(w, 4) AS coefficient, round(b, 4) AS intercept, "
    "round(a * 1e9, 6) AS noise_precision_e9, round(l * 1e9, 2) AS weight_precision_e9 FROM bayes",
    **_ONE, **_bayes_views(f"SELECT 0 AS part, {_CENTRED} FROM xy WHERE NOT held"))))
def fit_bayesian_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _one(spark, sf_dir)
    m = R.bayesian_ridge(R.grams(train, ["x"], "y")[0])
    return spark.createDataFrame(
        [(m.name, m.weights[0], m.intercept, m.alpha * 1e9, m.precision * 1e9)],
        "model string, coefficient double, intercept double, noise_precision_e9 double, "
        "weight_precision_e9 double",
    ).withColumns({
        "coefficient": F.round("coefficient", 4), "intercept": F.round("intercept", 4),
        "noise_precision_e9": F.round("noise_precision_e9", 6),
        "weight_precision_e9": F.round("weight_precision_e9", 2)})


@query("fit_bayesian_ridge_all_features")
def fit_bayesian_ridge_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = model_frames(_model_sales(spark, sf_dir))
    m = R.bayesian_ridge(R.grams(train, X.FEATURES, X.LABEL)[0])
    rows = [*((n, v, 3) for n, v in zip(X.FEATURES, m.weights)), ("intercept", m.intercept, 3),
            ("noise precision e9", m.alpha * 1e9, 6), ("weight precision e9", m.precision * 1e9, 3)]
    return spark.createDataFrame([(n, round(float(v), d) + 0.0) for n, v, d in rows], "name string, value double")


_OLS = {**_ONE, "fitted": _closed_form("0", "0")}
_PREDICTED = {**_OLS, "p": "SELECT serial_number, y, b + w * x AS prediction "
                           "FROM xy, fitted WHERE held"}


@query("predict", on_sales(
    "SELECT serial_number, y AS sale_amount, round(prediction, 1) AS prediction FROM p",
    **_PREDICTED))
def predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _one(spark, sf_dir)
    return R.predict(R.fit(train, ["x"], "y"), test, ["x"]).select(
        "serial_number", F.col("y").alias("sale_amount"),
        F.round(R.PREDICTION, 1).alias("prediction"))


@query("metric_mape", on_sales(
    f"SELECT round(avg(abs(y - prediction) / greatest(abs(y), {R.EPS!r})), 6) AS mape FROM p",
    **_PREDICTED))
def metric_mape(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _one(spark, sf_dir)
    return R.predict(R.fit(train, ["x"], "y"), test, ["x"]).agg(
        F.round(R.mape(F.col("y"), F.col(R.PREDICTION)), 6).alias("mape"))


@query("metric_explained_variance", on_sales(
    "SELECT round(1 - var_pop(y - prediction) / var_pop(y), 8) AS explained_variance FROM p",
    **_PREDICTED))
def metric_explained_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _one(spark, sf_dir)
    return R.predict(R.fit(train, ["x"], "y"), test, ["x"]).agg(
        F.round(R.explained_variance(F.col("y"), F.col(R.PREDICTION)), 8)
        .alias("explained_variance"))


@query("model_save_load", on_sales(
    "SELECT serial_number, round(prediction, 1) AS prediction FROM p",
    **{**_PREDICTED, "fitted": _closed_form("1", "0")}))
def model_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _one(spark, sf_dir)
    path = work_dir(spark, "model")
    R.save(R.fit(train, ["x"], "y", R.lasso()), path)
    return R.predict(R.load(path), test, ["x"]).select(
        "serial_number", F.round(R.PREDICTION, 1).alias("prediction"))


# --- validation and search on the one feature: folds of the training rows

_FOLD = f"{_BUCKET} % {R.FOLDS}"
_FOLDED = {
    **_ONE,
    "folded": f"SELECT x, y, {_FOLD} AS fold FROM xy WHERE NOT held",
    "folds": "SELECT DISTINCT fold FROM folded",
    # the rows that a fold's models are fitted on
    "inner_rows": "SELECT folds.fold AS part, x, y FROM folded JOIN folds "
                  "ON folded.fold <> folds.fold",
    "inner_moments": "SELECT part, covar_pop(x, y) AS c, var_pop(x) AS d, avg(x) AS mx, "
                     "avg(y) AS my, count(*) AS n FROM inner_rows GROUP BY part",
    **_bayes_views(f"SELECT part, {_CENTRED} FROM inner_rows GROUP BY part"),
}


def _penalised(name: str, l1: str, l2: str, source: str) -> str:
    weight = f"sign(c) * greatest(abs(c) - {l1}, 0) / (d + {l2})"
    return f"SELECT '{name}' AS model, part, {weight} AS w, my - mx * {weight} AS b FROM {source}"


def _five(source: str, bayes: str = "bayes") -> str:
    return " UNION ALL ".join([
        _penalised("Linear Regression", "0", "0", source),
        _penalised("Ridge", "0", "1.0 / n", source),
        _penalised("Lasso", "1", "0", source),
        _penalised("Elastic Net", "0.5", "0.5", source),
        f"SELECT 'Bayesian' AS model, part, w, b FROM {bayes}"])


def _error(y: str, p: str) -> str:
    return f"avg(abs({y} - ({p})) / greatest(abs({y}), {R.EPS!r}))"


_CROSSED = (f"SELECT model, avg(e) AS mape FROM (SELECT model, part, {_error('y', 'b + w * x')} "
            f"AS e FROM folded JOIN fitted ON fold = part GROUP BY model, part) GROUP BY model")


@query("cross_validate", _recursive(on_sales(
    "SELECT model, round(mape, 6) AS mape FROM crossed",
    **_FOLDED, fitted=_five("inner_moments"), crossed=_CROSSED)))
def cross_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _one(spark, sf_dir)
    found = R.cross_validate(train, ["x"], "y", X.fold("serial_number"))
    return spark.createDataFrame(
        [(n, float(v)) for n, v in found.items()], "model string, mape double",
    ).withColumn("mape", F.round("mape", 6))


_GRID = ", ".join(f"CAST({a!r} AS DOUBLE)" for a in map(float, R.GRID_ALPHAS))


@query("grid_search", on_sales(
    "SELECT alpha, max_iter, round(mape, 6) AS mape, "
    "row_number() OVER (ORDER BY mape, alpha, max_iter) = 1 AS best "
    "FROM crossed, (SELECT CAST(unnest("
    + str(R.GRID_MAX_ITER) + ") AS BIGINT) AS max_iter)",
    **{k: v for k, v in _FOLDED.items() if k not in ("sums", "steps", "bayes")},
    alphas=f"SELECT unnest([{_GRID}]) AS alpha",
    fitted="SELECT alpha, part, sign(c) * greatest(abs(c) - alpha, 0) / d AS w, c, d, mx, my "
           "FROM inner_moments, alphas",
    crossed=f"SELECT alpha, avg(e) AS mape FROM (SELECT alpha, part, "
            f"{_error('y', 'my - mx * w + w * x')} AS e FROM folded JOIN fitted ON fold = part "
            f"GROUP BY alpha, part) GROUP BY alpha"))
def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _one(spark, sf_dir)
    return _grid(spark, train, ["x"], "y").withColumn("mape", F.round("mape", 6))


def _grid(spark: SparkSession, train: DataFrame, names: list[str], label: str) -> DataFrame:
    found = R.grid_search(train, names, label, X.fold("serial_number"))
    return spark.createDataFrame(
        [(a, m, float(v), i == 0) for i, (a, m, v) in enumerate(found)],
        "alpha double, max_iter long, mape double, best boolean")


@query("model_compare_one_feature", _recursive(on_sales(
    f"SELECT e.model, explained_variance, e.mape, round(c.mape * 100, 4) AS cross_validated_mape "
    f"FROM evaluated e JOIN crossed c ON e.model = c.model",
    **_FOLDED,
    # the models of the whole training part, next to those of the folds
    whole="SELECT 0 AS part, * FROM moments",
    fitted=_five("inner_moments"), crossed=_CROSSED,
    **_bayes_views(f"SELECT 0 AS part, {_CENTRED} FROM xy WHERE NOT held", "whole_"),
    final=_five("whole", "whole_bayes"),
    evaluated=f"SELECT model, round((1 - var_pop(y - (b + w * x)) / var_pop(y)) * 100, 4) + 0 "
              f"AS explained_variance, round({_error('y', 'b + w * x')} * 100, 4) AS mape "
              f"FROM xy, final WHERE held GROUP BY model")))
def model_compare_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _one(spark, sf_dir)
    return R.compare(train, test, ["x"], "y", X.fold("serial_number"))


# --- all features; their oracles are in salesflow.catalog.fits


@query("model_compare")
def model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = model_frames(_model_sales(spark, sf_dir))
    return R.compare(train, test, X.FEATURES, X.LABEL, X.fold("serial_number"))


@query("cross_validate_all_features")
def cross_validate_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = model_frames(_model_sales(spark, sf_dir))
    found = R.cross_validate(train, X.FEATURES, X.LABEL, X.fold("serial_number"))
    return spark.createDataFrame(
        [(n, float(v)) for n, v in found.items()], "model string, mape double").withColumn("mape", F.round("mape", 6))


@query("grid_search_all_features")
def grid_search_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = model_frames(_model_sales(spark, sf_dir))
    return _grid(spark, train, X.FEATURES, X.LABEL).withColumn("mape", F.round("mape", 6))
