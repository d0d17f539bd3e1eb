"""Exact sums: against rational arithmetic, and whatever the order and the tasks."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F

import oracle
from salesflow.catalog import ORACLES, QUERIES
from salesflow.operators import exact
from salesflow.operators import features as X
from salesflow.operators import regression as R
from salesflow.plans import flows
from salesflow.sources.testdata import sales

NUMBERS = st.floats(allow_nan=False, allow_infinity=False)


def fraction(units):
    return Fraction(units, 1 << exact.SCALE)


@given(st.lists(st.tuples(NUMBERS, NUMBERS), max_size=40))
@settings(max_examples=200, deadline=None)
def test_totals(rows):
    found = exact.totals(np.array(rows, np.float64).reshape(-1, 2))
    assert [fraction(u) for u in found] == [sum((Fraction(r[i]) for r in rows), Fraction(0)) for i in (0, 1)]


@given(st.lists(st.tuples(NUMBERS, NUMBERS, st.sampled_from([0.0, 1.0])), max_size=30))
@settings(max_examples=200, deadline=None)
def test_products(rows):
    found = exact.products(np.array(rows, np.float64).reshape(-1, 3))
    for i in range(3):
        for j in range(i, 3):
            assert fraction(found.get((i, j), 0)) == sum((Fraction(r[i]) * Fraction(r[j]) for r in rows), Fraction(0))


def test_many_rows_of_many_sizes():
    rng = np.random.default_rng(1)
    values = rng.normal(size=(20_000, 3)) * 10.0 ** rng.integers(-30, 30, size=(20_000, 3))
    want = [math.fsum(c) for c in values.T]
    assert [exact.rounded(u) for u in exact.totals(values)] == want
    shuffled = values[rng.permutation(len(values))]
    assert exact.products(values) == exact.products(shuffled)


@given(st.lists(st.integers(-(1 << 4000), 1 << 4000), max_size=20))
@settings(deadline=None)
def test_digits_add_in_any_order(numbers):
    digits = [d for n in numbers for d in exact.limbs(n)]
    random.Random(0).shuffle(digits)
    assert exact.joined(digits) == sum(numbers) and all(abs(d) < 1 << 32 for _, d in digits)


def test_numbers_that_are_not_finite_are_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0)], "x double, y double")
    with pytest.raises(PythonException, match="finite"):
        R.grams(df, ["x"], "y")
    for bad in (np.inf, np.nan):
        with pytest.raises(ValueError, match="finite"):
            exact.totals(np.array([[bad]]))


def test_centred_products_do_not_cancel():
    x = 1e8 + np.array([1.0, 2.0, 3.0, 5.0])
    z = np.column_stack([np.ones(4), x, 2 * x])
    gram = R.Gram.of_units(exact.products(z), 3)
    xx, xy, yy, mean_x, _ = gram.centred()
    assert (xx[0, 0], xy[0], yy, mean_x[0]) == (8.75, 17.5, 35.0, 1e8 + 2.75)
    assert (gram + gram).centred()[0][0, 0] == 17.5


def test_no_rows(spark):
    df = spark.createDataFrame([], "x double, y double, k long")
    assert R.grams(df, ["x"], "y") == {}


LAYOUTS = [(1, "true"), (7, "false"), (32, "true"), (200, "false"), (200, "true")]


@pytest.fixture()
def settings_of(spark):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    before = {k: spark.conf.get(k) for k in keys}

    def choose(partitions, adaptive):
        for key, value in zip(keys, (str(partitions), adaptive), strict=True):
            spark.conf.set(key, value)
    yield choose
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("partitions, adaptive", LAYOUTS)
def test_grid_search_query_in_every_layout(spark, sf_dir, settings_of, partitions, adaptive):
    settings_of(partitions, adaptive)
    duck = oracle.connect(sf_dir)
    assert oracle.differences(QUERIES["grid_search"](spark, sf_dir), duck, ORACLES["grid_search"]) == []


def test_models_and_scores_have_the_same_bits_in_every_layout(spark, sf_dir, settings_of):
    train, _ = flows.model_frames(sales(spark, sf_dir))
    fold = X.fold("serial_number")
    found = set()
    for partitions, adaptive in LAYOUTS:
        settings_of(partitions, adaptive)
        rows = train.repartition(partitions, F.rand(partitions))
        grid = R.grid_search(rows, X.FEATURES, X.LABEL, fold)
        crossed = R.cross_validate(rows, X.FEATURES, X.LABEL, fold)
        found.add((tuple(grid), tuple(crossed.items())))
        by_alpha = {}
        for alpha, _, score in grid:
            by_alpha.setdefault(alpha, set()).add(score)
    assert len(found) == 1
