"""Features and models against brute force in pandas / numpy on a small table."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesflow.operators import features as X
from salesflow.operators import regression as R
from salesflow.plans import flows
from salesflow.sources.testdata import sales

PART = "serial_number"


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    rows = sales(spark, sf_dir).persist()
    yield rows
    rows.unpersist()


@pytest.fixture(scope="module")
def frames(lake):
    return flows.model_frames(lake)


@pytest.fixture(scope="module")
def train(frames):
    return frames[0]


@pytest.fixture(scope="module")
def matrix(train):
    pdf = train.toPandas()
    return pdf[X.FEATURES].to_numpy(), pdf[X.LABEL].to_numpy(), pdf[PART].to_numpy()


def expected_frame(pdf: pd.DataFrame) -> pd.DataFrame:
    """Features of whole-table statistics, in pandas."""
    pdf = pdf[pdf.sale_amount < X.AMOUNT_LIMIT].copy()
    for c in ("property_type", "residential_type"):
        pdf[c] = pdf[c].fillna(pdf[c].mode().iloc[0])
    pdf = pdf[(pdf.sales_ratio > 0.3) & (pdf.sales_ratio < 1.3)]
    out = pd.DataFrame({PART: pdf.serial_number})
    for name, c in (("LIST_YEAR", "list_year"), ("ASSESSED_VALUE", "assessed_value")):
        out[name] = (pdf[c] - pdf[c].mean()) / pdf[c].std(ddof=0)
    for prefix, c, values in (("Property", "property_type", X.PROPERTY_CATEGORIES),
                              ("Residential", "residential_type", X.RESIDENTIAL_CATEGORIES)):
        for v in values:
            out[f"{prefix}_{v}"] = (pdf[c] == v).astype(float)
    mean = pdf.town.map(pdf.groupby("town").sale_amount.mean())
    out["TOWN_ENCODED"] = (mean - mean.mean()) / mean.std(ddof=0)
    out[X.LABEL] = pdf.sale_amount
    return out.dropna()


def test_feature_frame(lake):
    train, test = flows.model_frames(lake, fit_on="all")
    got = train.unionByName(test).drop("in_test").toPandas()
    want = expected_frame(lake.toPandas())
    order = [PART, X.LABEL, "ASSESSED_VALUE", "LIST_YEAR"]
    got, want = (f.sort_values(order).reset_index(drop=True)[[PART, *X.FEATURES, X.LABEL]]
                 for f in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-9, atol=1e-9)


def test_statistics_come_from_the_training_part(lake):
    usable = lake.filter(F.col("sale_amount").isNotNull())
    train, _ = X.train_test_split(usable, PART)
    rows = train.filter((F.col("sales_ratio") > 0.3) & (F.col("sales_ratio") < 1.3))
    stats = X.fit_features(train)
    want = rows.agg(F.avg("assessed_value"), F.stddev_pop("assessed_value")).first()
    assert (stats.value.mean, stats.value.std) == pytest.approx(tuple(want))


def test_unseen_and_missing_towns(spark, lake):
    stats = X.fit_features(lake.filter(F.col("sale_amount").isNotNull()))
    some = spark.createDataFrame([("nowhere",), (None,)], "town string")
    got = {r.town: r.TOWN_ENCODED for r in X.target_encode(some, stats).collect()}
    assert got[None] is None
    assert got["nowhere"] == pytest.approx((stats.town_mean - stats.town.mean) / stats.town.std)


def test_no_spread_only_centres(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    scale = X.moments(df, "x")["x"]
    assert [r.z for r in df.select(scale.scale(F.col("x")).alias("z")).collect()] == [0.0, 0.0]


def test_lookup_broadcasts_by_size_in_bytes(spark, folder):
    path = folder("stats")
    spark.createDataFrame([("a", 1.5), ("c", 2.5)], "k string, v double").write.parquet(path)
    df, stats = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n long"), spark.read.parquet(path)
    small = X.lookup(df, stats, "k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" in small._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = X.lookup(df, stats, "k")
        assert "SortMergeJoin" in large._jdf.queryExecution().toString()
        rows = {tuple(r) for r in large.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == {tuple(r) for r in small.collect()} == {("a", 1, 1.5), ("b", 2, None),
                                                           (None, 3, None)}


def test_split_is_stable_and_by_key(lake):
    def sides(df):
        return set(map(tuple, df.select(PART, X.in_test(PART).alias("t")).distinct().collect()))

    once, again = sides(lake), sides(lake.repartition(7))
    assert once == again and len(once) == lake.select(PART).distinct().count()
    share = lake.filter(X.in_test(PART)).count() / lake.count()
    assert 0.10 < share < 0.20


def test_null_keys_share_a_side(spark):
    df = spark.createDataFrame([(None,), (None,)], "serial_number long")
    train, test = X.train_test_split(df, PART)
    assert sorted([train.count(), test.count()]) == [0, 2]


def objective(x, y, w, b, penalty):
    n = len(y)
    return (np.sum((y - x @ w - b) ** 2) / (2 * n) + penalty.l1 * np.abs(w).sum()
            + penalty.l2_for(n) / 2 * np.sum(w ** 2))


@pytest.mark.parametrize("name", list(R.PENALTIES))
def test_fit_reaches_the_minimum(train, matrix, name):
    """Spark's fit and the one from sums of products have the same objective, and no small
    step from it goes lower."""
    x, y, _ = matrix
    penalty = R.PENALTIES[name]
    model = R.Linear.of(name, R.fit(train, X.FEATURES, X.LABEL, penalty))
    small = R.solve(R.grams(train, X.FEATURES, X.LABEL)[0], name, penalty, 20000)
    w, b = np.array(model.weights), model.intercept
    best = objective(x, y, w, b, penalty)
    assert best == pytest.approx(
        objective(x, y, np.array(small.weights), small.intercept, penalty), rel=1e-8)
    rng = np.random.default_rng(0)
    for _ in range(50):
        step = rng.normal(size=len(w) + 1)
        assert objective(x, y, w + step[:-1], b + step[-1], penalty) >= best * (1 - 1e-9)


def test_ridge_closed_form(train, matrix):
    x, y, _ = matrix
    model = R.fit(train, X.FEATURES, X.LABEL, R.ridge(3.0))
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 3.0 * np.eye(x.shape[1]), xc.T @ yc)
    assert model.coefficients.toArray() == pytest.approx(want, rel=1e-4, abs=1e-3)


def test_grams(train, matrix):
    x, y, _ = matrix
    z = np.column_stack([np.ones(len(y)), x, y])
    got = R.grams(train, X.FEATURES, X.LABEL)
    assert list(got) == [0]
    np.testing.assert_allclose(got[0].products, z.T @ z, rtol=1e-9, atol=1e-6)


def test_bayesian_ridge_is_a_fixed_point(train, matrix):
    x, y, _ = matrix
    m = R.bayesian_ridge(R.grams(train, X.FEATURES, X.LABEL)[0], tol=1e-9, max_iter=2000)
    xc, yc, w = x - x.mean(0), y - y.mean(), np.array(m.weights)
    xx = xc.T @ xc
    want = np.linalg.solve(xx + m.precision / m.alpha * np.eye(len(w)), xc.T @ yc)
    assert w == pytest.approx(want, rel=1e-6, abs=1e-9)
    eigen = np.linalg.eigvalsh(xx)
    determined = np.sum(m.alpha * eigen / (m.precision + m.alpha * eigen))
    assert m.precision == pytest.approx((determined + 2e-6) / (w @ w + 2e-6), rel=1e-4)
    assert m.alpha == pytest.approx(
        (len(y) - determined + 2e-6) / (np.sum((yc - xc @ w) ** 2) + 2e-6), rel=1e-4)


def held_out(x, y, keys, fit):
    folds = ((keys % 1000003) * 7919 % 1000003) % R.FOLDS
    found = []
    for k in range(R.FOLDS):
        inside = folds == k
        w, b = fit(x[~inside], y[~inside])
        p = x[inside] @ w + b
        found.append(np.mean(np.abs(y[inside] - p) / np.abs(y[inside])))
    return np.mean(found)


def test_cross_validation(train, matrix):
    def ridge(x, y):
        xc = x - x.mean(0)
        w = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ (y - y.mean()))
        return w, y.mean() - x.mean(0) @ w

    got = R.cross_validate(train, X.FEATURES, X.LABEL, X.fold(PART))
    assert set(got) == {*R.PENALTIES, "Bayesian"}
    assert got["Ridge"] == pytest.approx(held_out(*matrix, ridge), rel=1e-9)


def test_grid_search(train, matrix):
    def lasso(alpha):
        def fit(x, y):
            z = np.column_stack([np.ones(len(y)), x, y])
            m = R.solve(R.Gram(z.T @ z), "", R.lasso(alpha), 4000)
            return np.array(m.weights), m.intercept
        return fit

    got = R.grid_search(train, X.FEATURES, X.LABEL, X.fold(PART))
    assert len(got) == len(R.GRID_ALPHAS) * len(R.GRID_MAX_ITER)
    assert [m for _, _, m in got] == sorted(m for _, _, m in got)  # the best comes first
    table = {(a, i): m for a, i, m in got}
    for alpha in (1, 50, 200):
        assert table[float(alpha), 4000] == pytest.approx(
            held_out(*matrix, lasso(alpha)), rel=1e-6)


def test_iteration_limit_matters():
    x = np.array([[1.0, 0.999], [2.0, 2.001], [3.0, 3.0], [4.0, 3.99]])
    y = np.array([1.0, 2.0, 3.0, 5.0])
    z = np.column_stack([np.ones(4), x, y])
    found = R.descend([R.Gram(z.T @ z)], [R.lasso(1e-8)], [1, 50, 20000])
    assert not np.allclose(found[1], found[50]) and not np.allclose(found[50], found[20000])


def test_scores(frames, spark):
    train, test = frames
    model = R.fit(train, X.FEATURES, X.LABEL, R.lasso(R.FINAL_ALPHA))
    pdf = R.predict(model, test, X.FEATURES).toPandas()
    y, p = pdf[X.LABEL], pdf[R.PREDICTION]
    row = R.scores(test, X.FEATURES, X.LABEL, [R.Linear.of("m", model)]).first()
    assert row.mape == pytest.approx((np.abs(y - p) / np.abs(y)).mean())
    assert row.explained_variance == pytest.approx(1 - (y - p).var(ddof=0) / y.var(ddof=0))


def test_mape_of_zero_is_finite(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, p double")
    row = df.agg(R.mape(F.col("y"), F.col("p")).alias("m")).first()
    assert row.m == pytest.approx((1.0 / R.EPS + 0.5) / 2)


def test_constant_label(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, y double")
    model = R.fit(df, ["x"], "y", R.ridge())
    assert (model.coefficients[0], model.intercept) == pytest.approx((0.0, 5.0))


def test_save_and_score(lake, frames, folder):
    train, _ = frames
    path = folder("model")
    model = R.fit(train, X.FEATURES, X.LABEL, R.lasso(R.FINAL_ALPHA))
    R.save(model, path)
    R.save(model, path)  # replaces
    assert R.load(path).coefficients == model.coefficients
    stats = X.fit_features(lake.filter(F.col("sale_amount").isNotNull()))
    assert flows.score(path, lake, stats).filter(F.col(R.PREDICTION).isNull()).isEmpty()
