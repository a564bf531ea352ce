"""DuckDB twins of the Holt-Winters family (N16d, N16f, N16g, N17-N19, K12, S5).

The fit is a search by hand: three rounds of 7 x 7 x 7 weights around the best so far.  A round
is one recursion that walks all weights of all folds a day at a time and keeps only the newest
state of each (``USING KEY``).  The state is level, trend, the seven seasonal values turned so
that the next day's comes first, and the squared error so far.  Fold 0 is the whole series.
"""

from __future__ import annotations

_S = ", ".join(f"s{i}" for i in range(7))
_KEY = "series_id, fold, alpha, beta, gamma"
#: What the weights may be off the centre at most, in each round.
_REACH = ("CAST(0.5 AS DOUBLE)", "(CAST(0.5 AS DOUBLE) / 3.5)", "(CAST(0.5 AS DOUBLE) / 3.5 / 3.5)")


def _weight(name: str, step: str, reach: str) -> str:
    return f"least(greatest(c.{name} + {reach} * ({step} - 3) / 3, 0), 1)"


def _round(number: int, centre: str) -> str:
    reach = _REACH[number - 1]
    return f"""
grid{number}_ AS MATERIALIZED (
    SELECT DISTINCT c.series_id, c.fold, {_weight('alpha', 'a.k', reach)} AS alpha,
           {_weight('beta', 'b.k', reach)} AS beta, {_weight('gamma', 'g.k', reach)} AS gamma
    FROM {centre} c, range(7) a(k), range(7) b(k), range(7) g(k)),
best{number}_ AS MATERIALIZED (
    WITH RECURSIVE walk(series_id, fold, alpha, beta, gamma, n, t, level, trend, {_S}, sse) USING KEY ({_KEY}) AS (
        SELECT series_id, fold, alpha, beta, gamma, n, CAST(0 AS BIGINT), level, trend, {_S}, CAST(0 AS DOUBLE)
        FROM grid{number}_ JOIN begin_ USING (series_id, fold)
        UNION
        SELECT w.series_id, w.fold, alpha, beta, gamma, n, t + 1,
               alpha * (y - s0) + (1 - alpha) * (level + trend),
               beta * (alpha * (y - s0) + (1 - alpha) * (level + trend) - level) + (1 - beta) * trend,
               s1, s2, s3, s4, s5, s6, gamma * (y - level - trend) + (1 - gamma) * s0,
               sse + (y - (level + trend + s0)) * (y - (level + trend + s0))
        FROM walk w JOIN counted_ d ON d.series_id = w.series_id AND d.day_index = w.t
        WHERE w.t < w.n)
    SELECT * FROM walk
    QUALIFY row_number() OVER (PARTITION BY series_id, fold ORDER BY sse, alpha, beta, gamma) = 1)"""


_FITS = """,
counted_ AS MATERIALIZED (SELECT series_id, day_index, CAST(orders AS DOUBLE) AS y FROM series_),
train_ AS MATERIALIZED (
    SELECT series_id, fold, test_start_idx AS n FROM folds_ UNION ALL SELECT series_id, 0, len FROM len_),
weeks_ AS (
    SELECT series_id, sum(y) FILTER (day_index < 7) / 7 AS first, sum(y) FILTER (day_index BETWEEN 7 AND 13) / 7 AS second,
           list(y ORDER BY day_index) FILTER (day_index < 7) AS y
    FROM counted_ GROUP BY series_id),
begin_ AS MATERIALIZED (
    SELECT series_id, fold, n, first AS level, (second - first) / 7 AS trend,
           """ + ", ".join(f"y[{i + 1}] - first AS s{i}" for i in range(7)) + """
    FROM train_ JOIN weeks_ USING (series_id)),
middle_ AS (SELECT series_id, fold, CAST(0.5 AS DOUBLE) AS alpha, CAST(0.5 AS DOUBLE) AS beta, CAST(0.5 AS DOUBLE) AS gamma FROM train_),""" \
    + _round(1, "middle_") + "," + _round(2, "best1_") + "," + _round(3, "best2_") + f""",
hw_ AS MATERIALIZED (
    SELECT series_id, fold, n, step, level + (step + 1) * trend + [{_S}][step % 7 + 1] AS forecast
    FROM best3_, range(28) r(step)),
pred_ AS MATERIALIZED (
    SELECT h.series_id, h.fold, a.day, CAST(a.orders AS DOUBLE) AS actual, h.forecast, 'holt_winters' AS model
    FROM hw_ h JOIN series_ a ON a.series_id = h.series_id AND a.day_index = h.n + h.step
    WHERE h.fold > 0
    UNION ALL SELECT series_id, fold, day, CAST(actual AS DOUBLE), forecast, 'seasonal_naive' FROM sn_),
score_ AS MATERIALIZED (
    SELECT series_id, fold, model, min(day) AS test_start, max(day) AS test_end,
           sum(abs(actual - forecast)) / nullif(sum(abs(actual)), 0) AS wape, avg(forecast - actual) AS bias
    FROM pred_ GROUP BY series_id, fold, model),
mean_ AS (SELECT series_id, model, avg(wape) AS wape, avg(bias) AS bias FROM score_ GROUP BY series_id, model),
chosen_ AS MATERIALIZED (
    SELECT series_id, n.wape AS n_wape, h.wape AS h_wape, n.bias AS n_bias, h.bias AS h_bias,
           CASE WHEN h.wape < n.wape THEN 'holt_winters' ELSE 'seasonal_naive' END AS winner
    FROM mean_ n JOIN mean_ h USING (series_id)
    WHERE n.model = 'seasonal_naive' AND h.model = 'holt_winters'),
band_ AS (
    SELECT series_id, winner, quantile_cont(actual - p.forecast, 0.025) AS low, quantile_cont(actual - p.forecast, 0.975) AS high
    FROM pred_ p JOIN chosen_ USING (series_id) WHERE model = winner GROUP BY series_id, winner),
point_ AS (
    SELECT f.series_id, f.date, winner, CASE winner WHEN 'holt_winters' THEN h.forecast ELSE f.f END AS forecast
    FROM fut_ f JOIN hw_ h ON h.series_id = f.series_id AND h.step = f.step AND h.fold = 0
    JOIN chosen_ c ON c.series_id = f.series_id),
next_ AS (
    SELECT series_id, date, forecast, p.winner, greatest(forecast + low, 0) AS lower, forecast + high AS upper
    FROM point_ p JOIN band_ USING (series_id))
"""


def _six(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def statements(series: str) -> dict[str, tuple[str, str]]:
    """Per key the common tables and the SELECT; ``series`` are the tables of the daily series."""
    fits = series.rstrip() + _FITS
    pair = ", ".join(f"round(max({c}) FILTER (model = '{m}'), 6) AS {c}_{m}"
                     for c in ("wape", "bias") for m in ("seasonal_naive", "holt_winters"))
    selects = {
        "holt_winters_backtest": f"""
SELECT series_id, fold, test_start, test_end, {_six('wape', 'bias')}, model FROM score_ WHERE model = 'holt_winters'""",
        "backtest_table": f"SELECT series_id, fold, test_start, test_end, {pair} FROM score_ GROUP BY ALL",
        "model_selection": """
SELECT series_id, round(n_wape, 6) AS mean_wape_seasonal_naive, round(h_wape, 6) AS mean_wape_holt_winters,
       round(n_bias, 6) AS mean_bias_seasonal_naive, round(h_bias, 6) AS mean_bias_holt_winters, winner,
       round((n_wape - h_wape) / nullif(n_wape, 0) * 100, 6) AS lift_pct
FROM chosen_""",
        "forecast_28d": f"SELECT series_id, date, winner, {_six('forecast', 'lower', 'upper')} FROM next_",
        "forecast_total": """
SELECT series_id, round(sum(forecast), 6) AS forecast_total, round(sum(lower), 6) AS sum_of_daily_lower,
       round(sum(upper), 6) AS sum_of_daily_upper
FROM next_ GROUP BY series_id""",
        "monitor_thresholds": """
SELECT series_id, winner, round(wape_limit, 6) AS wape_threshold, round(bias_limit, 6) AS abs_bias_threshold,
       round(last_wape, 6) AS last_wape, round(last_bias, 6) AS last_bias,
       last_wape > wape_limit AS wape_breach, abs(last_bias) > bias_limit AS bias_breach
FROM (SELECT series_id, winner, avg(wape) + stddev_samp(wape) AS wape_limit, avg(abs(bias)) + stddev_samp(abs(bias)) AS bias_limit,
             arg_max(wape, fold) AS last_wape, arg_max(bias, fold) AS last_bias
      FROM score_ JOIN chosen_ USING (series_id) WHERE model = winner GROUP BY series_id, winner)""",
        "recent_actuals_plus_forecast": f"""
SELECT day AS date, CAST(orders AS DOUBLE) AS actual, NULL AS series_id, NULL AS forecast, NULL AS lower, NULL AS upper
FROM sc_ WHERE day > (SELECT max(day) FROM sc_) - 90
UNION ALL SELECT date, NULL, series_id, {_six('forecast', 'lower', 'upper')} FROM next_""",
        "published_forecast": """
SELECT series_id, date, round(forecast, 4) AS forecast, round(lower, 4) AS lower, round(upper, 4) AS upper
FROM next_""",
    }
    return {name: (fits, select) for name, select in selects.items()}
