"""Linear models of the sale amount: fit, apply, score, compare, search.

Single fits use Spark ML, whose normal-equation solver reads the data once.
Cross-validation and grid search need many fits on overlapping rows: they sum
the products of all feature pairs once per fold, on the cluster, and solve the
small systems (features x features) that remain. Those sums, and the sums of held-out
errors, are exact (:mod:`salesflow.operators.exact`): models, scores and the order of a
search don't change with the number or the timing of tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.operators import exact

EPS = float(np.finfo(np.float64).eps)
VECTOR, PREDICTION = "features", "prediction"

# Parameters of the final model and of the search (fixed values).
FINAL_ALPHA = 100.0
GRID_ALPHAS = [1e-08, 0.001, 0.01, 1, 5, 10, 20, 30, 35, 40, 45, 50, 55, 100, 200]
GRID_MAX_ITER = [1000, 2000, 3000, 4000]
FOLDS = 5


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR).transform(df)


# --- penalties ---------------------------------------------------------------


@dataclass(frozen=True)
class Penalty:
    """``1/(2n)·|y - Xw|² + l1·|w|₁ + l2/2·|w|²``, with l2 per row or in total."""

    l1: float = 0.0
    l2: float = 0.0
    l2_total: float = 0.0  # divided by the number of rows

    def l2_for(self, rows: int) -> float:
        return self.l2 + self.l2_total / rows


OLS = Penalty()


def ridge(alpha: float = 1.0) -> Penalty:
    return Penalty(l2_total=alpha)


def lasso(alpha: float = 1.0) -> Penalty:
    return Penalty(l1=alpha)


def elastic_net(alpha: float = 1.0, l1_ratio: float = 0.5) -> Penalty:
    return Penalty(l1=alpha * l1_ratio, l2=alpha * (1.0 - l1_ratio))


PENALTIES = {
    "Linear Regression": OLS,
    "Ridge": ridge(),
    "Lasso": lasso(),
    "Elastic Net": elastic_net(),
}


# --- single fits with Spark ML -------------------------------------------------


def fit(df: DataFrame, features: Sequence[str], label: str, penalty: Penalty = OLS,
        max_iter: int = 1000) -> LinearRegressionModel:
    """A Spark ML linear model with the given penalty.

    Spark scales the L2 part by the label's standard deviation, hence ``sigma``.
    """
    l1, l2, sigma = penalty.l1, 0.0, 0.0
    if penalty.l2 or penalty.l2_total:
        row = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
        l2, sigma = penalty.l2_for(row.n), row.s
    strength = l1 + l2 * sigma
    estimator = LinearRegression(
        featuresCol=VECTOR, labelCol=label, predictionCol=PREDICTION, solver="normal",
        regParam=strength, elasticNetParam=l1 / strength if strength else 0.0,
        standardization=False, maxIter=max_iter, tol=1e-12)
    return estimator.fit(assemble(df, features))


def predict(model: LinearRegressionModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the prediction; the features stay plain columns."""
    return model.transform(assemble(df, features)).drop(VECTOR)


def save(model: LinearRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)


# --- linear models as plain numbers -------------------------------------------


@dataclass(frozen=True)
class Linear:
    """Coefficients of any fitted linear model."""

    name: str
    weights: tuple[float, ...]
    intercept: float
    alpha: float | None = None  # precision of the noise (Bayesian)
    precision: float | None = None  # precision of the weights (Bayesian)
    iterations: int | None = None

    @classmethod
    def of(cls, name: str, model: LinearRegressionModel) -> Linear:
        return cls(name, tuple(model.coefficients.toArray().tolist()), model.intercept)

    def expression(self, features: Sequence[str]) -> Column:
        total = F.lit(self.intercept)
        for weight, name in zip(self.weights, features):
            if weight:
                total = total + F.lit(weight) * F.col(f"`{name}`")
        return total


# --- metrics --------------------------------------------------------------------


def mape(label: Column, predicted: Column) -> Column:
    """Aggregate: mean of |y - p| / |y|, with a tiny floor for the denominator."""
    return F.avg(F.abs(label - predicted) / F.greatest(F.abs(label), F.lit(EPS)))


def explained_variance(label: Column, predicted: Column) -> Column:
    """Aggregate: 1 - var(y - p) / var(y), population variances."""
    return F.lit(1.0) - F.try_divide(F.var_pop(label - predicted), F.var_pop(label))


def scores(df: DataFrame, features: Sequence[str], label: str,
           models: Sequence[Linear]) -> DataFrame:
    """(model, explained_variance, mape) of every model from one pass over ``df``."""
    predicted = [m.expression(features).alias(f"p{i}") for i, m in enumerate(models)]
    y = F.col("y")
    row = df.select(F.col(label).alias("y"), *predicted).agg(*[
        F.struct(F.lit(m.name).alias("model"),
                 explained_variance(y, F.col(f"p{i}")).alias("explained_variance"),
                 mape(y, F.col(f"p{i}")).alias("mape")).alias(f"m{i}")
        for i, m in enumerate(models)])
    return row.select(F.inline(F.array(*[f"m{i}" for i in range(len(models))])))


# --- sums of products and the small systems they leave ---------------------------


@dataclass(frozen=True)
class Gram:
    """``Z'Z`` with ``Z = (1, features, label)``; adding two joins their rows.

    ``units`` has the same products as integers (see :mod:`salesflow.operators.exact`), where they are known.
    """

    products: np.ndarray
    units: tuple[tuple[int, ...], ...] | None = field(default=None, repr=False)

    @classmethod
    def of_units(cls, cells: dict[tuple[int, int], int], size: int) -> Gram:
        units = tuple(tuple(cells.get((min(i, j), max(i, j)), 0) for j in range(size)) for i in range(size))
        return cls(np.array([[exact.rounded(u) for u in row] for row in units]), units)

    def __add__(self, other: Gram) -> Gram:
        if self.units is None or other.units is None:
            return Gram(self.products + other.products)
        size = len(self.units)
        return Gram.of_units({(i, j): self.units[i][j] + other.units[i][j]
                           for i in range(size) for j in range(i, size)}, size)

    @property
    def rows(self) -> float:
        return float(self.products[0, 0])

    def centred(self) -> tuple[np.ndarray, np.ndarray, float, np.ndarray, float]:
        """(X'X, X'y, y'y, mean x, mean y), the products about the means.

        Of exact products each number is rounded once, so nothing cancels.
        """
        if self.units is None:
            p, n = self.products, self.rows
            mean = p[0] / n
            c = p - n * np.outer(mean, mean)
        else:
            u, n = self.units, self.units[0][0] >> exact.SCALE
            mean = np.array([exact.rounded(s, n) for s in u[0]])
            c = np.array([[(n * u[i][j] - (u[0][i] * u[0][j] >> exact.SCALE)) / (n << exact.SCALE)
                           for j in range(len(u))] for i in range(len(u))])
        return c[1:-1, 1:-1], c[1:-1, -1], float(c[-1, -1]), mean[1:-1], float(mean[-1])


def grams(df: DataFrame, features: Sequence[str], label: str,
          by: Column | None = None) -> dict[int, Gram]:
    """One :class:`Gram` per value of ``by``, from one pass.

    A task multiplies its Arrow batches and leaves a few digits per cell of each
    matrix; only these meet in the exchange, as integers. Values must be finite.
    """
    names = [*features, label]
    size = len(names) + 1

    def products(batches):
        sums: dict[int, dict[tuple[int, int], int]] = {}
        for batch in batches:
            for k, rows in batch.groupby("part"):
                z = np.column_stack([np.ones(len(rows)), rows.iloc[:, 1:].to_numpy(np.float64)])
                known = sums.setdefault(k, {})
                for cell, total in exact.products(z).items():
                    known[cell] = known.get(cell, 0) + total
        for k, cells in sums.items():
            digits = [(i, j, place, digit) for (i, j), total in cells.items()
                      for place, digit in exact.limbs(total)]
            yield pd.DataFrame(digits, columns=["i", "j", "place", "digit"]).assign(part=k)

    summed = (
        df.select((F.lit(0) if by is None else by).cast("long").alias("part"),
                  *[F.col(f"`{c}`").cast("double").alias(f"z{i}") for i, c in enumerate(names)])
        .mapInPandas(products, "part long, i long, j long, place long, digit long")
        .groupBy("part", "i", "j", "place").agg(F.sum("digit").alias("digit"))
    )
    found: dict[int, dict[tuple[int, int], list]] = {}
    for row in summed.collect():  # parts x cells x a few digits
        found.setdefault(row.part, {}).setdefault((row.i, row.j), []).append((row.place, row.digit))
    return {k: Gram.of_units({cell: exact.joined(digits) for cell, digits in found[k].items()}, size)
            for k in sorted(found)}


def bayesian_ridge(gram: Gram, max_iter: int = 300, tol: float = 1e-3,
                   prior: float = 1e-6) -> Linear:
    """Ridge whose noise and weight precisions maximise the evidence (MacKay updates).

    Works on ``X'X`` alone: its eigenvectors diagonalise every step.
    """
    xx, xy, yy, mean_x, mean_y = gram.centred()
    n = gram.rows
    eigen, basis = np.linalg.eigh(xx)
    eigen, target = np.clip(eigen, 0.0, None), basis.T @ xy
    alpha, precision = 1.0 / (yy / n + EPS), 1.0
    weights, steps = np.zeros(len(xy)), 0
    for steps in range(1, max_iter + 1):
        previous = weights
        weights = basis @ (target / (eigen + precision / alpha))
        residual = max(yy - 2.0 * weights @ xy + weights @ xx @ weights, 0.0)
        determined = float(np.sum(alpha * eigen / (precision + alpha * eigen)))
        if steps > 1 and np.abs(weights - previous).sum() < tol:
            break
        precision = (determined + 2 * prior) / (float(weights @ weights) + 2 * prior)
        alpha = (n - determined + 2 * prior) / (residual + 2 * prior)
    weights = basis @ (target / (eigen + precision / alpha))
    return Linear("Bayesian", tuple(weights.tolist()), float(mean_y - mean_x @ weights),
                  float(alpha), float(precision), steps)


def descend(grams_: Sequence[Gram], penalties: Sequence[Penalty], iterations: Sequence[int],
            tol: float = 1e-10) -> dict[int, np.ndarray]:
    """Coordinate descent for many (Gram, penalty) problems side by side.

    Returns, for each of ``iterations``, the weights after at most that many
    sweeps: an array (problem, feature).
    """
    known = {id(g): g.centred() for g in grams_}
    systems = [known[id(g)] for g in grams_]
    a = np.stack([s[0] / g.rows for s, g in zip(systems, grams_)])
    b = np.stack([s[1] / g.rows for s, g in zip(systems, grams_)])
    l1 = np.array([p.l1 for p in penalties])
    diagonal = np.einsum("kii->ki", a)
    curved = diagonal + np.array([[p.l2_for(g.rows)] for g, p in zip(grams_, penalties)])
    w, out = np.zeros_like(b), {}
    live = True
    for step in range(1, max(iterations) + 1):
        if live:
            moved = np.zeros(len(w))
            for j in range(w.shape[1]):
                rest = b[:, j] - np.einsum("ki,ki->k", a[:, j], w) + diagonal[:, j] * w[:, j]
                shrunk = np.sign(rest) * np.maximum(np.abs(rest) - l1, 0.0)
                new = np.divide(shrunk, curved[:, j], out=np.zeros_like(rest),
                                where=curved[:, j] > EPS)
                moved = np.maximum(moved, np.abs(new - w[:, j]))
                w[:, j] = new
            live = bool(np.any(moved > tol * np.maximum(np.abs(w).max(axis=1), 1.0)))
        if step in iterations:
            out[step] = w.copy()
            if not live:
                for later in iterations:
                    if later > step:
                        out[later] = w.copy()
                break
    return out


def solve(gram: Gram, name: str, penalty: Penalty, max_iter: int = 1000) -> Linear:
    """One penalised fit from sums of products."""
    xx, xy, _, mean_x, mean_y = gram.centred()
    if penalty.l1:
        weights = descend([gram], [penalty], [max_iter])[max_iter][0]
    else:
        system = xx / gram.rows + penalty.l2_for(gram.rows) * np.eye(len(xy))
        weights = np.linalg.lstsq(system, xy / gram.rows, rcond=None)[0]
    return Linear(name, tuple(weights.tolist()), float(mean_y - mean_x @ weights))


# --- validation and search ---------------------------------------------------------


def _held_out_mape(df: DataFrame, features: Sequence[str], label: str, part: Column,
                   models: dict[int, list[Linear]]) -> dict[str, float]:
    """Mean over the folds of the MAPE on the fold a model has not seen.

    One pass: a task applies the models of their fold to its Arrow batches, feature by feature, and leaves
    exact sums per fold and model. Models with the same weights in every fold are scored once.
    """
    folds = sorted(models)
    names = [m.name for m in models[folds[0]]]
    same: dict[tuple, list[str]] = {}
    for i, name in enumerate(names):
        same.setdefault(tuple((models[k][i].weights, models[k][i].intercept) for k in folds), []).append(name)
    weights = {k: (np.array([v[f][0] for v in same]), np.array([v[f][1] for v in same]))
               for f, k in enumerate(folds)}
    columns = [f"x{i}" for i in range(len(features))]

    def errors(batches):
        sums: dict[int, list[int]] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            for k, rows in batch.groupby("part"):
                w, intercept = weights[k]
                x, y = rows[columns].to_numpy(np.float64), rows["y"].to_numpy(np.float64)[:, None]
                p = np.repeat(intercept[None, :], len(rows), axis=0)
                for j in range(len(columns)):  # a fixed order of additions for every row
                    p += x[:, j:j + 1] * w[:, j]
                relative = np.abs(y - p) / np.maximum(np.abs(y), EPS)
                sums[k] = [a + b for a, b in zip(sums.get(k, [0] * len(w)), exact.totals(relative), strict=True)]
                counts[k] = counts.get(k, 0) + len(rows)
        for k, found in sums.items():
            digits = [(m, place, digit) for m, total in enumerate(found) for place, digit in exact.limbs(total)]
            digits.append((-1, 0, counts[k]))
            yield pd.DataFrame(digits, columns=["model", "place", "digit"]).assign(part=k)

    summed = (
        df.select(part.cast("long").alias("part"), F.col(label).alias("y"),
                  *[F.col(f"`{f}`").alias(c) for f, c in zip(features, columns)])
        .mapInPandas(errors, "part long, model long, place long, digit long")
        .groupBy("part", "model", "place").agg(F.sum("digit").alias("digit"))
    )
    digits: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for r in summed.collect():  # folds x models x a few digits
        digits.setdefault((r.part, r.model), []).append((r.place, r.digit))
    seen = sorted({k for k, m in digits if m == -1})
    out = {}
    for m, group in enumerate(same.values()):
        by_fold = [Fraction(exact.joined(digits.get((k, m), [])), exact.joined(digits[k, -1]) << exact.SCALE)
                   for k in seen]
        out.update(dict.fromkeys(group, float(sum(by_fold) / len(by_fold)) if by_fold else None))
    return {name: out[name] for name in names}


def _training_grams(parts: dict[int, Gram]) -> dict[int, Gram]:
    """For each fold, the sums over all other folds."""
    def others(k: int) -> Gram:
        rest = [g for i, g in parts.items() if i != k]
        return sum(rest[1:], rest[0])

    return {k: others(k) for k in parts}


def solve_all(gram: Gram) -> list[Linear]:
    """The five models of one set of rows."""
    return [*[solve(gram, name, p) for name, p in PENALTIES.items()], bayesian_ridge(gram)]


def cross_validate(df: DataFrame, features: Sequence[str], label: str, part: Column,
                   parts: dict[int, Gram] | None = None) -> dict[str, float]:
    """Mean held-out MAPE of the five models. Reads the data twice in all.

    ``parts`` are the sums of products per fold, if they are known already.
    """
    parts = parts or grams(df, features, label, part)
    models = {k: solve_all(g) for k, g in _training_grams(parts).items()}
    return _held_out_mape(df, features, label, part, models)


def grid_search(df: DataFrame, features: Sequence[str], label: str, part: Column,
                alphas: Sequence[float] = GRID_ALPHAS,
                max_iters: Sequence[int] = GRID_MAX_ITER) -> list[tuple[float, int, float]]:
    """(alpha, max_iter, mean held-out MAPE) of each lasso of the grid, best first."""
    training = _training_grams(grams(df, features, label, part))
    folds = list(training)
    problems = [(k, a) for k in folds for a in alphas]
    solved = descend([training[k] for k, _ in problems], [lasso(a) for _, a in problems],
                     max_iters)
    models: dict[int, list[Linear]] = {k: [] for k in folds}
    grid = [(float(a), m) for a in alphas for m in max_iters]
    means = {k: training[k].centred()[3:] for k in folds}
    for index, (k, a) in enumerate(problems):
        mean_x, mean_y = means[k]
        for m in max_iters:
            w = solved[m][index]
            models[k].append(Linear(f"{float(a)}/{m}", tuple(w.tolist()),
                                    float(mean_y - mean_x @ w)))
    found = _held_out_mape(df, features, label, part, models)
    return sorted(((a, m, found[f"{a}/{m}"]) for a, m in grid), key=lambda r: (r[2], r[0], r[1]))


def compare(train: DataFrame, test: DataFrame, features: Sequence[str],
            label: str, part: Column) -> DataFrame:
    """Fit the five models on ``train``; explained variance and MAPE on ``test`` and the
    cross-validated MAPE on ``train``, in percent with four decimals.

    Reads ``train`` twice and ``test`` once: the sums per fold add up to those of all rows.
    """
    parts = grams(train, features, label, part)
    fitted = solve_all(sum(list(parts.values())[1:], next(iter(parts.values()))))
    crossed = cross_validate(train, features, label, part, parts)
    by_model = F.create_map(*[F.lit(v) for pair in crossed.items() for v in pair])

    def percent(value: Column, name: str) -> Column:
        return F.round(value * 100, 4).alias(name)

    return scores(test, features, label, fitted).select(
        "model", percent(F.col("explained_variance"), "explained_variance"),
        percent(F.col("mape"), "mape"), percent(by_model[F.col("model")], "cross_validated_mape"))
