"""Oracle SQL that fits linear models on its own: accelerated proximal gradient steps in a
recursive query, on centred and standardised letter shares. It shares no code and no
solver with the keys it checks, only the objective."""

from __future__ import annotations


def letter_rows_sql(letters: list[str], where: str) -> str:
    """CTEs ``f`` (doc_id, lang, x), ``m`` (sd, mu, n) and ``d`` (lang, x centred and scaled, then 1)."""
    x = ", ".join(f"(length(t) - length(replace(t, '{c}', ''))) / greatest(length(t), 1)::DOUBLE" for c in letters)
    each = range(1, len(letters) + 1)
    return f"""
  f AS (SELECT doc_id, lang, [{x}] AS x FROM (SELECT doc_id, lang, lower(text) AS t FROM documents) WHERE {where}),
  m AS (SELECT [{", ".join(f"stddev_samp(x[{j}])" for j in each)}] AS sd,
               [{", ".join(f"avg(x[{j}])" for j in each)}] AS mu, count(*)::DOUBLE AS n FROM f),
  d AS (SELECT lang, n, list_concat(list_transform(list_zip(x, sd, mu),
          lambda z: CASE WHEN z[2] > 0 THEN (z[1] - z[3]) / z[2] ELSE 0 END), [1.0]) AS x FROM f, m)"""


def fit_sql(rows: str, slopes: str, features: int, classes: int, steps: int, smooth: float, strong: float,
            reg: float, elastic_net: float) -> str:
    """CTE ``s`` (step, v, u): v after ``step`` steps, for each class the scaled coefficients then
    the intercept of the centred features. ``slopes``: list of the loss's derivatives by margin, in
    terms of x, u, and the columns of ``rows``; ``smooth`` and ``strong`` bound the curvature."""
    width = features + 1
    momentum = (smooth ** 0.5 - strong ** 0.5) / (smooth ** 0.5 + strong ** 0.5)
    sums = ", ".join(f"sum(r[{c + 1}] * x[{j + 1}]) / any_value(n)" for c in range(classes) for j in range(width))
    zero = f"list_transform(range({classes * width}), lambda i: 0.0::DOUBLE)"
    shrink, cut = 1 - reg * (1 - elastic_net) / smooth, reg * elastic_net / smooth
    moved = f"(u[i] * {shrink!r} - g[i] / {smooth!r})"
    return f"""
  s AS (
    SELECT 0 AS step, {zero} AS v, {zero} AS u
    UNION ALL
    SELECT step + 1, nv, list_transform(list_zip(nv, v), lambda z: z[1] + {momentum!r} * (z[1] - z[2]))
    FROM (SELECT step, v, list_transform(range(1, {classes * width + 1}),
                   lambda i: CASE WHEN i % {width} = 0 THEN u[i] - g[i] / {smooth!r}
                                  ELSE sign{moved} * greatest(abs{moved} - {cut!r}, 0) END) AS nv
          FROM (SELECT any_value(step) AS step, any_value(v) AS v, any_value(u) AS u, [{sums}] AS g
                FROM (SELECT step, v, u, x, n, {slopes} AS r FROM {rows}, s WHERE step < {steps}) HAVING count(*) > 0)))"""


def coefficients_sql(features: int, classes: int, steps: int) -> str:
    """(class_id, feature, value, scaled) of the last step; feature -1 is the intercept, which of
    several classes are centred."""
    width = features + 1
    centre = " - avg(raw) OVER (PARTITION BY j)" if classes > 1 else ""
    centre_v = " - avg(v[c * {w} + j + 1]) OVER (PARTITION BY j)".format(w=width) if classes > 1 else ""
    return f"""
  SELECT CAST(c AS INTEGER) AS class_id, CAST(CASE WHEN j = {features} THEN -1 ELSE j END AS INTEGER) AS feature,
         round(CASE WHEN j < {features} THEN raw ELSE raw{centre} END, 3) + 0.0 AS value,
         round(CASE WHEN j < {features} THEN v[c * {width} + j + 1] ELSE v[c * {width} + j + 1]{centre_v} END, 4) + 0.0 AS scaled,
         true AS optimal, true AS below_null, true AS below_perturbed
  FROM (SELECT *, CASE WHEN j < {features} THEN CASE WHEN sd[j + 1] > 0 THEN v[c * {width} + j + 1] / sd[j + 1] ELSE 0 END
                       ELSE v[c * {width} + j + 1] - list_sum(list_transform(range(1, {features + 1}),
                         lambda k: CASE WHEN sd[k] > 0 THEN v[c * {width} + k] * mu[k] / sd[k] ELSE 0 END)) END AS raw
        FROM s, m, range({classes}) a(c), range({width}) b(j) WHERE step = {steps})"""
