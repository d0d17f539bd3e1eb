"""SQL oracles of the fits on all 19 features.

The SQL makes the features, sums their products per fold, and solves every model by itself: ordinary and ridge
regression by the sweep operator, lasso and elastic net by coordinate descent, the Bayesian ridge by sweeps inside its
updates. Held-out errors are then averaged over the rows. Nothing of it comes from the library.
"""

from __future__ import annotations

from salesflow.catalog.base import ORACLES, SALES_VIEW, STAMP
from salesflow.catalog.prediction import _FOLD, _IN_TEST, _P, _R, _error, _mode_sql
from salesflow.operators import features as X
from salesflow.operators import regression as R

_N = len(X.FEATURES)
_Y = _N + 1  # place of the label beside the features
_SWEEPS = 600


def _dummies(column: str, values: list[str]) -> str:
    return ", ".join(f"coalesce(CAST({column} = '{v}' AS DOUBLE), 0)" for v in values)


def _views(where: str = "true") -> dict[str, str]:
    """The feature rows of the sales that satisfy ``where``, and the sums of products per part.

    Part k has the training rows outside fold k; part -1 has all of them.
    """
    return {
        "usable": f"SELECT *, {_IN_TEST} AS held, {_FOLD} AS fold FROM sales WHERE sale_amount < 1500000 AND {where}",
        "learn": "SELECT * FROM usable WHERE NOT held",
        "prepared": (
            f"SELECT * REPLACE (coalesce(property_type, {_mode_sql('property_type', 'learn')}) AS property_type, "
            f"coalesce(residential_type, {_mode_sql('residential_type', 'learn')}) AS residential_type) "
            "FROM usable WHERE sales_ratio > 0.3 AND sales_ratio < 1.3 AND NOT isnan(sales_ratio)"),
        "towns": "SELECT town, avg(sale_amount) AS m, count(*) AS n FROM prepared "
                 "WHERE NOT held AND town IS NOT NULL GROUP BY town",
        "town_scale": "SELECT mu, sqrt(sum(n * (m - mu) * (m - mu)) / sum(n)) AS sd FROM towns, "
                      "(SELECT sum(n * m) / sum(n) AS mu FROM towns) GROUP BY mu",
        "scales": "SELECT avg(assessed_value) AS vm, stddev_pop(assessed_value) AS vs, avg(list_year) AS ym, "
                  "stddev_pop(list_year) AS ys, avg(sale_amount) AS om FROM prepared WHERE NOT held",
        "frame": (
            f"SELECT held, fold, [(list_year - ym) / ys, (assessed_value - vm) / vs, {_dummies('property_type', _P)}, "
            f"{_dummies('residential_type', _R)}, (coalesce(m, om) - mu) / sd] AS x, sale_amount AS y "
            "FROM prepared p LEFT JOIN towns t ON p.town = t.town, town_scale, scales "
            "WHERE p.town IS NOT NULL AND assessed_value IS NOT NULL AND list_year IS NOT NULL"),
        "rows": "SELECT fold, list_append(x, y) AS z FROM frame WHERE NOT held",
        "places": f"SELECT unnest(range(1, {_Y + 1})) AS i",
        "centre": "SELECT list(m ORDER BY i) AS c FROM (SELECT i, avg(z[i]) AS m FROM rows, places GROUP BY i)",
        "near": "SELECT fold, list_transform(z, lambda v, i: v - c[i]) AS z FROM rows, centre",
        "sums": "SELECT fold, i, sum(z[i]) AS s, count(*) AS n FROM near, places GROUP BY fold, i",
        "cells": "SELECT fold, a.i, b.i AS j, sum(z[a.i] * z[b.i]) AS p FROM near, places a, places b GROUP BY ALL",
        "parts": f"SELECT unnest(range(-1, {R.FOLDS})) AS part",
        "part_sums": "SELECT part, i, sum(s) AS s, sum(n) AS n FROM sums JOIN parts ON fold <> part GROUP BY ALL",
        "part_cells": "SELECT part, i, j, sum(p) AS p FROM cells JOIN parts ON fold <> part GROUP BY ALL",
        "covariances": "SELECT part, c.i, c.j, p - a.s * b.s / a.n AS v, CAST(a.n AS DOUBLE) AS n "
                       "FROM part_cells c JOIN part_sums a USING (part) JOIN part_sums b USING (part) "
                       "WHERE a.i = c.i AND b.i = c.j",
        "systems": (
            "SELECT part, n, m, mu FROM (SELECT part, any_value(n) AS n, list(r ORDER BY i) AS m FROM ("
            "SELECT part, i, any_value(n) AS n, list(v ORDER BY j) AS r FROM covariances GROUP BY part, i) GROUP BY part) "
            "JOIN (SELECT part, list(c[i] + s / n ORDER BY i) AS mu FROM part_sums, centre GROUP BY part) USING (part)"),
    }


def _swept(source: str, least: str) -> str:
    """The matrices ``m`` of ``source`` with their first columns swept; dependent columns (below ``least``) stay."""
    for k in range(1, _N + 1):
        pivot = f"m[{k}][{k}]"
        cell = (f"CASE WHEN i = {k} AND j = {k} THEN -1 / {pivot} WHEN i = {k} OR j = {k} THEN v / {pivot} "
                f"ELSE v - r[{k}] * m[{k}][j] / {pivot} END")
        source = (f"SELECT * REPLACE (CASE WHEN {pivot} > {least} THEN "
                  f"list_transform(m, lambda r, i: list_transform(r, lambda v, j: {cell})) ELSE m END AS m) FROM ({source})")
    return source


# the weights that a swept matrix holds; a swept column has a negative pivot
_WEIGHTS = f"list_transform(m[1:{_N}], lambda r, i: CASE WHEN r[i] < 0 THEN r[{_Y}] ELSE 0 END)"


def _ridged(strength: str) -> str:
    return (f"list_transform(m, lambda r, i: list_transform(r, lambda v, j: "
            f"v + CASE WHEN i = j AND i <= {_N} THEN {strength} ELSE 0 END))")


def _solved(name: str, strength: str) -> str:
    source = f"SELECT part, n, mu, {_ridged(strength)} AS m FROM systems"
    return f"SELECT '{name}' AS model, part, mu, {_WEIGHTS} AS w FROM ({_swept(source, '1e-8 * n')})"


def _descents(problems: str) -> dict[str, str]:
    """Coordinate descent of ``problems`` (model, part, l1, l2)."""
    step = "SELECT d.id, k, a, b, l1, l2, w FROM descents d JOIN problems p ON d.id = p.id WHERE k < " + str(_SWEEPS)
    for j in range(1, _N + 1):
        rest = f"b[{j}] - list_dot_product(a[{j}], w) + a[{j}][{j}] * w[{j}]"
        new = (f"CASE WHEN a[{j}][{j}] + l2 > {R.EPS!r} THEN sign({rest}) * greatest(abs({rest}) - l1, 0) "
               f"/ (a[{j}][{j}] + l2) ELSE 0 END")
        step = (f"SELECT id, k, a, b, l1, l2, list_transform(w, lambda v, i: CASE WHEN i = {j} THEN c ELSE v END) AS w "
                f"FROM (SELECT *, {new} AS c FROM ({step}))")
    return {
        "problems": f"SELECT row_number() OVER () AS id, p.*, mu, "
                    f"list_transform(m[1:{_N}], lambda r, i: list_transform(r[1:{_N}], lambda v, j: v / n)) AS a, "
                    f"list_transform(m[1:{_N}], lambda r, i: r[{_Y}] / n) AS b FROM ({problems}) p JOIN systems USING (part)",
        "descents": f"SELECT id, 0 AS k, list_transform(range({_N}), lambda v, i: CAST(0 AS DOUBLE)) AS w FROM problems "
                    f"UNION ALL SELECT id, k + 1, w FROM ({step})",
        "descended": f"SELECT model, part, mu, w FROM descents JOIN problems USING (id) WHERE k = {_SWEEPS}",
    }


def _bayes() -> dict[str, str]:
    """The evidence-maximising ridge of each part; one row per update."""
    inner = ("SELECT part, step, a, l, w AS before, n, mu, " + _ridged("l / a") + " AS m, "
             f"list_transform(m[1:{_N}], lambda r, i: r[{_Y}]) AS xy, m[{_Y}][{_Y}] AS yy "
             "FROM updates JOIN systems USING (part) WHERE NOT done AND step < 300")
    found = (f"SELECT *, {_WEIGHTS} AS v, list_sum(list_transform(m[1:{_N}], lambda r, i: -r[i])) AS trace "
             f"FROM ({_swept(inner, '0')})")
    measured = (f"SELECT *, {_N} - l / a * trace AS g, list_dot_product(v, v) AS vv, "
                "greatest(yy - list_dot_product(v, xy) - l / a * list_dot_product(v, v), 0) AS rest, "
                "step > 0 AND list_sum(list_transform(v, lambda x, i: abs(x - before[i]))) < 1e-3 AS stop "
                f"FROM ({found})")
    return {
        "updates": (
            f"SELECT part, 0 AS step, 1 / (m[{_Y}][{_Y}] / n + {R.EPS!r}) AS a, CAST(1 AS DOUBLE) AS l, "
            f"list_transform(range({_N}), lambda v, i: CAST(0 AS DOUBLE)) AS w, false AS done FROM systems UNION ALL "
            "SELECT part, step + 1, CASE WHEN stop THEN a ELSE (n - g + 2e-6) / (rest + 2e-6) END, "
            f"CASE WHEN stop THEN l ELSE (g + 2e-6) / (vv + 2e-6) END, v, stop FROM ({measured})"),
        "bayes": "SELECT 'Bayesian' AS model, part, mu, w, a, l FROM updates JOIN systems USING (part) "
                 "QUALIFY row_number() OVER (PARTITION BY part ORDER BY step DESC) = 1",
    }


def _predicted(source: str) -> str:
    """Models with their intercepts."""
    return (f"SELECT model, part, w, mu[{_Y}] - list_dot_product(mu[1:{_N}], w) AS b FROM ({source})")


_PREDICTION = "b + list_dot_product(x, w)"
_CROSSED = (f"SELECT model, avg(e) AS mape FROM (SELECT model, part, {_error('y', _PREDICTION)} AS e "
            "FROM frame JOIN fitted ON fold = part WHERE NOT held GROUP BY model, part) GROUP BY model")
_EVALUATED = (f"SELECT model, 1 - var_pop(y - ({_PREDICTION})) / var_pop(y) AS explained_variance, "
              f"{_error('y', _PREDICTION)} AS mape, count(*) AS n FROM frame, fitted WHERE held AND part = -1 GROUP BY model")


def _sql(select: str, views: dict[str, str]) -> str:
    named = {"sales": SALES_VIEW, **views}
    recursive = {"descents", "updates"}
    return "WITH RECURSIVE " + ",\n".join(
        f"{n} AS {'' if n in recursive else 'MATERIALIZED '}({v})" for n, v in named.items()) + "\n" + select


def _five() -> dict[str, str]:
    problems = ("SELECT model, part, l1, l2 FROM parts, (VALUES ('Lasso', CAST(1 AS DOUBLE), CAST(0 AS DOUBLE)), "
                "('Elastic Net', 0.5, 0.5)) AS v(model, l1, l2)")
    return {**_views(), **_descents(problems), **_bayes(), "fitted": _predicted(" UNION ALL ".join([
        _solved("Linear Regression", "0"), _solved("Ridge", "1"), "SELECT * FROM descended",
        "SELECT model, part, mu, w FROM bayes"]))}


def _register() -> None:
    five = _five()
    ORACLES["cross_validate_all_features"] = _sql(
        "SELECT model, round(mape, 6) AS mape FROM crossed", {**five, "crossed": _CROSSED})
    ORACLES["model_compare"] = _sql(
        "SELECT e.model, round(explained_variance * 100, 4) + 0 AS explained_variance, round(e.mape * 100, 4) AS mape, "
        "round(c.mape * 100, 4) AS cross_validated_mape FROM evaluated e JOIN crossed c USING (model)",
        {**five, "crossed": _CROSSED, "evaluated": _EVALUATED})
    names = ", ".join(f"'{f}'" for f in X.FEATURES)
    ORACLES["fit_bayesian_ridge_all_features"] = _sql(
        f"SELECT unnest([{names}]) AS name, round(unnest(w), 3) + 0 AS value FROM bayes WHERE part = -1 "
        f"UNION ALL SELECT 'intercept', round(mu[{_Y}] - list_dot_product(mu[1:{_N}], w), 3) FROM bayes WHERE part = -1 "
        "UNION ALL SELECT 'noise precision e9', round(a * 1e9, 6) FROM bayes WHERE part = -1 "
        "UNION ALL SELECT 'weight precision e9', round(l * 1e9, 3) FROM bayes WHERE part = -1",
        {**_views(), **_bayes()})
    alphas = ", ".join(f"CAST({a!r} AS DOUBLE)" for a in map(float, R.GRID_ALPHAS))
    grid = (f"SELECT alpha AS model, part, alpha AS l1, CAST(0 AS DOUBLE) AS l2 "
            f"FROM parts, (SELECT unnest([{alphas}]) AS alpha) WHERE part >= 0")
    ORACLES["grid_search_all_features"] = _sql(
        "SELECT model AS alpha, max_iter, round(mape, 6) AS mape, "
        "row_number() OVER (ORDER BY mape, model, max_iter) = 1 AS best FROM crossed, "
        f"(SELECT CAST(unnest({R.GRID_MAX_ITER}) AS BIGINT) AS max_iter)",
        {**_views(), **_descents(grid), "fitted": _predicted("SELECT * FROM descended"), "crossed": _CROSSED})
    final = f"SELECT 'Lasso({R.FINAL_ALPHA:g})' AS model, part, {R.FINAL_ALPHA!r} AS l1, CAST(0 AS DOUBLE) AS l2 FROM parts WHERE part = -1"
    window = f"created_at > TIMESTAMP '1995-06-01 00:00:00' AND created_at <= TIMESTAMP '{STAMP}'"
    ORACLES["flow_retrain"] = _sql(
        "SELECT model, (SELECT count(*) FROM rows) AS train_rows, n AS test_rows, "
        "round(explained_variance, 6) AS explained_variance, round(mape, 5) AS mape FROM evaluated",
        {**_views(window), **_descents(final), "fitted": _predicted("SELECT * FROM descended"), "evaluated": _EVALUATED})


_register()
