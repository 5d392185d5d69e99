"""Plain SQL for the registered queries, written independently of the Spark plans.

Each entry is self-contained: the tables it needs are spelled out as common table
expressions. Statistics are taken row by row, lags by one window over each brand.
"""

from __future__ import annotations

import math

SALES = """sales AS (
SELECT CAST(o.o_orderdate AS DATE) AS sale_date, p.p_type AS category, p.p_brand AS brand, r.r_name AS region,
  CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(16,4)) AS total_sales,
  CAST(l.l_quantity AS INT) AS quantity_sold,
  CASE WHEN l.l_orderkey % 13 = 0 THEN NULL ELSE l.l_tax * 1000 END AS online_popularity,
  CASE WHEN l.l_discount >= 0.08 THEN 1 ELSE 0 END AS promotion,
  CASE WHEN l.l_discount >= 0.08 THEN CAST(CAST(l.l_discount AS DECIMAL(4,2)) * 100 AS INT) ELSE 0 END AS discount_percentage,
  CASE WHEN l.l_orderkey % 17 = 0 THEN NULL ELSE p.p_retailprice END AS competitor_price,
  CASE WHEN l.l_orderkey % 19 = 0 THEN NULL ELSE s.s_acctbal END AS stock_level,
  CASE WHEN l.l_orderkey % 23 = 0 THEN NULL ELSE c.c_acctbal END AS weather_score,
  CAST(l.l_linenumber % 4 AS INT) AS supply_delay_days,
  CASE WHEN EXTRACT(MONTH FROM o.o_orderdate) = 1 AND EXTRACT(DAY FROM o.o_orderdate) = 26
         OR EXTRACT(MONTH FROM o.o_orderdate) = 8 AND EXTRACT(DAY FROM o.o_orderdate) = 15
         OR EXTRACT(MONTH FROM o.o_orderdate) = 10 AND EXTRACT(DAY FROM o.o_orderdate) = 2
         OR EXTRACT(MONTH FROM o.o_orderdate) = 12 AND EXTRACT(DAY FROM o.o_orderdate) = 25 THEN 1 ELSE 0 END AS is_holiday,
  l.l_orderkey AS k1, l.l_linenumber AS k2, l.l_partkey AS k3, l.l_suppkey AS k4, l.l_extendedprice AS k5, l.l_shipdate AS k6
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

ORDER = "sale_date, k1, k2, k3, k4, k5, k6"
MEDIAN_COLUMNS = ("online_popularity", "total_sales", "quantity_sold", "competitor_price", "stock_level",
                  "supply_delay_days", "weather_score")
Z_MEANS = ("online_popularity", "competitor_price", "stock_level", "supply_delay_days", "weather_score",
           "sales_lag_1", "sales_ma_3")


def r(expression: str, digits: int, name: str | None = None) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {name or expression}"


def z(c: str) -> str:
    return f"({c} - avg({c}) OVER ()) / (stddev_samp({c}) OVER () + 1e-6) AS {c}"


FILLED = "medians AS (SELECT " + ", ".join(
    f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in MEDIAN_COLUMNS) + " FROM sales), filled AS (SELECT " + (
    "sale_date, category, brand, region, promotion, discount_percentage, coalesce(is_holiday, 0) AS is_holiday, "
    "k1, k2, k3, k4, k5, k6, ") + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in MEDIAN_COLUMNS) + " FROM sales, medians)"

HISTORY = f"""lagged AS (
SELECT *, lag(total_sales) OVER w AS prev, lead(total_sales) OVER w AS next_sales, row_number() OVER w AS rn,
  avg(total_sales) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS sales_ma_3
FROM filled WINDOW w AS (PARTITION BY brand ORDER BY {ORDER})),
history AS (SELECT *, CASE WHEN rn > 1 THEN prev WHEN next_sales IS NOT NULL THEN total_sales END AS sales_lag_1 FROM lagged)"""

CODES = """codes AS (
SELECT *, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INT) AS category_encoded,
  CAST(dense_rank() OVER (ORDER BY brand) - 1 AS INT) AS brand_encoded,
  CAST(dense_rank() OVER (ORDER BY region) - 1 AS INT) AS region_encoded FROM history)"""

PROCESSED = f"""scored AS (
SELECT sale_date, category, brand, total_sales, promotion, discount_percentage, is_holiday,
  category_encoded, brand_encoded, region_encoded, k1, k2, k3, k4, k5, k6,
  {z('quantity_sold')}, {', '.join(z(c) for c in Z_MEANS)} FROM codes),
processed AS (
SELECT brand, sale_date, CAST(sum(CAST(total_sales AS DECIMAL(18,4))) AS DOUBLE) AS total_sales,
  sum(quantity_sold) AS quantity_sold, {', '.join(f'avg({c}) AS {c}' for c in Z_MEANS)},
  avg(promotion) AS promotion, avg(discount_percentage) AS discount_percentage, avg(is_holiday) AS is_holiday,
  min(category_encoded) AS category_encoded, min(brand_encoded) AS brand_encoded,
  arg_min(region_encoded, (k1, k2, k3, k4, k5, k6)) AS region_encoded, category
FROM scored GROUP BY category, brand, sale_date)"""

DAILY = """daily AS (
SELECT category, brand, sale_date, CAST(sum(total_sales) AS DOUBLE) AS total_sales FROM sales GROUP BY 1, 2, 3)"""

SERIES = """series AS (
SELECT brand, sale_date, CAST(sum(total_sales) AS DOUBLE) AS total_sales FROM sales GROUP BY 1, 2),
split AS (
SELECT *, row_number() OVER (PARTITION BY brand ORDER BY sale_date) AS row_no,
  count(*) OVER (PARTITION BY brand) AS row_total FROM series),
parts AS (SELECT *, row_no <= (row_total * 4) // 5 AS is_train FROM split)"""

FIRST_MODEL = """line AS (
SELECT brand, min(sale_date) AS origin,
  regr_slope(total_sales, date_diff('day', DATE '1990-01-01', sale_date)) AS b,
  regr_intercept(total_sales, date_diff('day', DATE '1990-01-01', sale_date)) AS a
FROM parts WHERE is_train GROUP BY brand),
ratios AS (
SELECT p.*, total_sales / nullif(a + b * date_diff('day', DATE '1990-01-01', sale_date), 0) AS ratio
FROM parts p JOIN line USING (brand) WHERE is_train),
week AS (SELECT brand, dayofweek(sale_date) AS d, avg(ratio) AS wk FROM ratios GROUP BY 1, 2),
rest AS (
SELECT x.brand, month(sale_date) AS m, ratio / nullif(wk, 0) AS rest
FROM ratios x JOIN week w ON x.brand = w.brand AND dayofweek(x.sale_date) = w.d),
season AS (SELECT brand, m, avg(rest) AS mo FROM rest GROUP BY 1, 2),
frame AS (
SELECT brand, sale_date, CASE WHEN is_train THEN 'train' ELSE 'test' END AS kind, total_sales AS actual FROM parts
UNION ALL
SELECT brand, CAST(sale_date + CAST(i AS INT) AS DATE), 'future', NULL
FROM parts, range(1, 31) t(i) WHERE row_no = (row_total * 4) // 5),
fitted AS (
SELECT f.*, (a + b * date_diff('day', DATE '1990-01-01', f.sale_date)) * coalesce(wk, 1) * coalesce(mo, 1) AS predicted
FROM frame f JOIN line USING (brand)
LEFT JOIN week w ON f.brand = w.brand AND dayofweek(f.sale_date) = w.d
LEFT JOIN season s ON f.brand = s.brand AND month(f.sale_date) = s.m),
spread AS (SELECT brand, stddev_samp(actual - predicted) AS sigma FROM fitted WHERE kind = 'train' GROUP BY brand),
first_forecast AS (
SELECT sale_date, f.brand, predicted AS predicted_sales, predicted - 1.2815515655446004 * sigma AS yhat_lower,
  predicted + 1.2815515655446004 * sigma AS yhat_upper
FROM fitted f JOIN spread USING (brand) WHERE kind <> 'test')"""

SECOND_MODEL = """weekday_means AS (
SELECT brand, dayofweek(sale_date) AS d, avg(total_sales) AS m FROM parts WHERE is_train GROUP BY 1, 2),
second_test AS (
SELECT p.brand, total_sales AS actual, m AS predicted FROM parts p
LEFT JOIN weekday_means w ON p.brand = w.brand AND dayofweek(p.sale_date) = w.d WHERE NOT is_train),
ahead AS (
SELECT brand, CAST(sale_date + CAST(i AS INT) AS DATE) AS sale_date FROM parts, range(1, 31) t(i) WHERE row_no = row_total),
second_forecast AS (
SELECT a.sale_date, a.brand, m AS predicted_sales FROM ahead a
LEFT JOIN weekday_means w ON a.brand = w.brand AND dayofweek(a.sale_date) = w.d)"""

SCORES = ("sqrt(avg((actual - predicted) * (actual - predicted)))",
          "avg(abs(actual - predicted) / greatest(abs(actual), 2.220446049250313e-16)) * 100")

COMBINED = """means AS (
SELECT x.brand AS xb, y.brand AS yb, x.m AS xm, y.m AS ym
FROM (SELECT brand, avg(predicted_sales) AS m FROM first_forecast GROUP BY 1) x
FULL JOIN (SELECT brand, avg(predicted_sales) AS m FROM second_forecast GROUP BY 1) y ON x.brand = y.brand),
combined AS (SELECT coalesce(xb, yb) AS brand, (xm + ym) / 2 AS combined_score FROM means)"""

GROWTH = """next_month AS (
SELECT brand, sum(predicted_sales) AS predicted_sales FROM first_forecast
WHERE date_trunc('month', sale_date) = (SELECT date_trunc('month', max(sale_date)) FROM first_forecast) GROUP BY 1),
last_month AS (
SELECT brand, sum(total_sales) AS last_month_sales FROM daily
WHERE date_trunc('month', sale_date) = (SELECT date_trunc('month', max(sale_date)) FROM daily) GROUP BY 1),
growth AS (
SELECT n.brand, predicted_sales, last_month_sales, predicted_sales - last_month_sales AS growth,
  (predicted_sales - last_month_sales) / nullif(last_month_sales, 0) * 100 AS growth_pct,
  CASE WHEN predicted_sales > last_month_sales THEN 'up' ELSE 'down' END AS trend
FROM next_month n LEFT JOIN last_month l ON n.brand = l.brand)"""

KPIS = """kpis AS (
SELECT (SELECT sum(last_month_sales) FROM last_month) AS this_month_revenue,
  (SELECT sum(predicted_sales) FROM growth) AS projected_revenue,
  (SELECT brand FROM growth ORDER BY growth DESC NULLS LAST, brand LIMIT 1) AS fastest_brand,
  (SELECT growth FROM growth ORDER BY growth DESC NULLS LAST, brand LIMIT 1) AS fastest_growth,
  (SELECT count(*) FROM growth WHERE growth > 0) AS growing_brands)"""

EVENTS = """recent AS (
SELECT concat('Brand#', CAST(user_id % 25 + 1 AS VARCHAR)) AS brand, CAST(ts AS DATE) AS day
FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY),
hits AS (SELECT brand, day, count(*) AS n FROM recent GROUP BY 1, 2),
scores AS (
SELECT brand, 100.0 * coalesce(max(CASE WHEN day = (SELECT CAST(max(ts) AS DATE) FROM events) THEN n END), 0)
  / max(n) AS score FROM hits GROUP BY 1)"""


def sql(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def sql_recursive(*ctes: str, body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


IDS = "k1, k2, k3, k4, k5, k6"
# The values of the sequence model with the mean of the window as its prediction: a mean of scaled values, scaled back.
WINDOW_MEANS = """windowed AS (
SELECT brand, sale_date, total_sales AS actual, row_no, row_total,
  avg(total_sales) OVER (PARTITION BY brand ORDER BY sale_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS predicted FROM parts),
window_test AS (SELECT * FROM windowed WHERE row_total >= 27 AND row_no > 7 + ((row_total - 7) * 4) // 5),
ahead AS (
SELECT brand, max(sale_date) AS last_day, 0 AS step, list(total_sales ORDER BY sale_date) AS latest
FROM parts WHERE row_no > row_total - 7 AND row_total >= 27 GROUP BY brand
UNION ALL
SELECT brand, last_day, step + 1, list_append(latest[2:7], list_avg(latest)) FROM ahead WHERE step < 30)"""
GAPS = f"""gaps AS (
SELECT CAST(k1 AS VARCHAR) AS k1, k2, k3, k4, k5, k6, sale_date, CASE WHEN k1 % 9 <> 0 THEN brand END AS brand,
  CASE WHEN k1 % 5 <> 0 THEN CAST(total_sales AS DOUBLE) END AS v FROM sales),
placed AS (
SELECT *, row_number() OVER (PARTITION BY brand ORDER BY {ORDER}) AS rn, count(*) OVER (PARTITION BY brand) AS n FROM gaps),
numbered AS (SELECT *, min(CASE WHEN v IS NOT NULL THEN rn END) OVER (PARTITION BY brand) AS first_at FROM placed)"""
# The closed-form model from four origins, thirty days apart.
FOLDS = """ends AS (SELECT brand, max(sale_date) AS last_day FROM series GROUP BY brand),
cuts AS (
SELECT s.brand, fold, origin, sale_date, total_sales AS y, sale_date <= origin AS fits,
  date_diff('day', DATE '1990-01-01', sale_date) AS t, dayofweek(sale_date) AS d, month(sale_date) AS m
FROM series s JOIN (SELECT brand, f AS fold, CAST(last_day - CAST(30 * (5 - f) AS INT) AS DATE) AS origin FROM ends, range(1, 5) t(f)) o
  ON s.brand = o.brand AND sale_date <= origin + 30),
fold_line AS (SELECT brand, fold, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM cuts WHERE fits GROUP BY 1, 2),
fold_trend AS (SELECT c.*, a + b * t AS g FROM cuts c JOIN fold_line l ON c.brand = l.brand AND c.fold = l.fold),
fold_week AS (SELECT brand, fold, d, avg(y / nullif(g, 0)) AS w FROM fold_trend WHERE fits GROUP BY 1, 2, 3),
fold_month AS (
SELECT t.brand, t.fold, m, avg(y / nullif(g, 0) / nullif(w, 0)) AS s FROM fold_trend t
JOIN fold_week w ON t.brand = w.brand AND t.fold = w.fold AND t.d = w.d WHERE fits GROUP BY 1, 2, 3),
fold_test AS (
SELECT t.brand, t.fold, date_diff('day', origin, sale_date) AS step, y AS actual, g * coalesce(w, 1) * coalesce(s, 1) AS predicted
FROM fold_trend t LEFT JOIN fold_week w ON t.brand = w.brand AND t.fold = w.fold AND t.d = w.d
LEFT JOIN fold_month s ON t.brand = s.brand AND t.fold = s.fold AND t.m = s.m WHERE NOT fits)"""
WINDOW_FORECAST = """second_forecast AS (
SELECT CAST(last_day + CAST(step AS INT) AS DATE) AS sale_date, brand, latest[7] AS predicted_sales FROM ahead WHERE step > 0)"""
BROKEN = """broken AS (
SELECT brand, least(count(DISTINCT sale_date), CASE brand WHEN 'Brand#5' THEN 2 WHEN 'Brand#6' THEN 7 WHEN 'Brand#7' THEN 8
  WHEN 'Brand#8' THEN 26 ELSE 1000000 END) AS n FROM sales GROUP BY brand)"""
GROWTH_COLUMNS = ", ".join([r("last_month_sales", 4), *[r(c, 2) for c in ("predicted_sales", "growth", "growth_pct")]])
MODELS = (SALES, SERIES, FIRST_MODEL, SECOND_MODEL)
PREPARED = (SALES, FILLED, HISTORY, CODES, PROCESSED)

_SEQUENCE = ("total_sales", "online_popularity", "competitor_price", "stock_level", "supply_delay_days", "weather_score", "is_holiday")
_REGRESSORS = ("online_popularity", "competitor_price", "stock_level", "supply_delay_days", "weather_score",
               "promotion", "discount_percentage", "is_holiday")
FEATURES = """features AS (
SELECT brand, sale_date, sum(total_sales) AS total_sales, """ + ", ".join(f"avg({c}) AS {c}" for c in _REGRESSORS) + """
FROM processed GROUP BY 1, 2)"""


def products(name: str, rows: str, size: int) -> str:
    """The Gram matrix (brand, i, j, g) of the lists v, of ``size`` members, of the rows (brand, sale_date, v)."""
    return f"""{name}_columns AS (
SELECT brand, i, list(v[i] ORDER BY sale_date) AS c FROM {rows}, range(1, {size + 1}) t(i) GROUP BY brand, i),
{name} AS (
SELECT a.brand, a.i, b.i AS j, list_dot_product(a.c, b.c) AS g FROM {name}_columns a JOIN {name}_columns b ON a.brand = b.brand)"""


def elimination(name: str, lines: str, size: int) -> str:
    """(brand, beta): solutions by elimination of the systems (brand, i, line), a line its row and the right-hand side."""
    return f"""{name}_steps AS (
SELECT brand, 1 AS k, list(line ORDER BY i) AS m FROM {lines} GROUP BY brand
UNION ALL
SELECT brand, k + 1, list_transform(m, lambda line, i: CASE WHEN i = k THEN list_transform(line, lambda v: v / m[k][k])
  ELSE list_transform(line, lambda v, j: v - line[k] / m[k][k] * m[k][j]) END) FROM {name}_steps WHERE k <= {size}),
{name} AS (SELECT brand, list_transform(m, lambda line: line[{size + 1}]) AS beta FROM {name}_steps WHERE k = {size + 1})"""


_LAGS = 7 * len(_SEQUENCE)
# The sequence model with its ridge fit: windows of scaled features, sums of products, centring, elimination, recursion.
SEQUENCE_MODEL = f"""scaled AS (
SELECT brand, sale_date, total_sales, min(total_sales) OVER b AS low, max(total_sales) OVER b AS high,
  row_number() OVER (b ORDER BY sale_date) AS no, count(*) OVER b AS total,
  [{', '.join(f"({c} - min({c}) OVER b) / CASE WHEN max({c}) OVER b = min({c}) OVER b THEN 1 ELSE max({c}) OVER b - min({c}) OVER b END" for c in _SEQUENCE)}] AS f
FROM features WINDOW b AS (PARTITION BY brand)),
weeks AS (
SELECT *, flatten(list(f) OVER (PARTITION BY brand ORDER BY sale_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) AS x, f[1] AS y FROM scaled),
fitting AS (
SELECT brand, sale_date, list_concat([1.0], x, [y]) AS v FROM weeks WHERE no > 7 AND no - 7 <= ((total - 7) * 4) // 5 AND total >= 27),
{products('sums', 'fitting', _LAGS + 2)},
edges AS (SELECT brand, j, g AS s, max(CASE WHEN j = 1 THEN g END) OVER (PARTITION BY brand) AS n FROM sums WHERE i = 1),
centred AS (
SELECT s.brand, s.i, list(s.g - a.s * b.s / a.n + CASE WHEN s.i = s.j THEN 1.0 ELSE 0 END ORDER BY s.j) AS line
FROM sums s JOIN edges a ON s.brand = a.brand AND s.i = a.j JOIN edges b ON s.brand = b.brand AND s.j = b.j
WHERE s.i BETWEEN 2 AND {_LAGS + 1} AND s.j >= 2 GROUP BY s.brand, s.i),
{elimination('ridge', 'centred', _LAGS)},
means AS (SELECT brand, list(s / n ORDER BY j) FILTER (j BETWEEN 2 AND {_LAGS + 1}) AS x, max(CASE WHEN j = {_LAGS + 2} THEN s / n END) AS y
  FROM edges GROUP BY brand),
lines AS (SELECT r.brand, beta, y - list_dot_product(beta, x) AS intercept FROM ridge r JOIN means m ON r.brand = m.brand),
sequence_test AS (
SELECT w.brand, sale_date, total_sales, low, high, y AS actual, intercept + list_dot_product(beta, x) AS predicted
FROM weeks w JOIN lines l ON w.brand = l.brand WHERE no > 7 + ((total - 7) * 4) // 5),
ahead AS (
SELECT s.brand, max(sale_date) AS last_day, max(low) AS low, max(high) AS high, 0 AS step, list(f ORDER BY sale_date) AS latest
FROM scaled s WHERE no > total - 7 AND total >= 27 GROUP BY s.brand
UNION ALL
SELECT a.brand, last_day, low, high, step + 1,
  list_append(latest[2:7], list_concat([intercept + list_dot_product(beta, flatten(latest))], latest[7][2:]))
FROM ahead a JOIN lines l ON a.brand = l.brand WHERE step < 30)"""
UNSCALED = "{} * CASE WHEN high = low THEN 1 ELSE high - low END + low"

_HINGES = [f"greatest(t - {0.8 * (i + 1) / 26!r}, 0)" for i in range(25)]
_WAVES = [f"{f}(day * {2 * math.pi * k / period!r})" for period, terms in ((365.25, 10), (7.0, 3)) for k in range(1, terms + 1) for f in ("sin", "cos")]
_SEASON = len(_WAVES) + len(_REGRESSORS)
# The decomposable model with regressors: design, ridge trend, seasons as a share of it, band from the training residuals.
REGRESSOR_MODEL = f"""numbered AS (
SELECT *, row_number() OVER (PARTITION BY brand ORDER BY sale_date) AS no, count(*) OVER (PARTITION BY brand) AS total FROM features),
frame AS (
SELECT brand, sale_date, CASE WHEN no <= (total * 4) // 5 THEN 'train' ELSE 'test' END AS kind, total_sales AS actual FROM numbered
UNION ALL
SELECT brand, CAST(sale_date + CAST(i AS INT) AS DATE), 'future', NULL FROM numbered, range(1, 31) t(i) WHERE no = (total * 4) // 5),
carried AS (
SELECT f.*, {', '.join(f'g.{c}' for c in _REGRESSORS)}
FROM frame f ASOF JOIN features g ON f.brand = g.brand AND f.sale_date >= g.sale_date),
moments AS (
SELECT brand, min(sale_date) AS origin, max(sale_date) AS train_end,
  {', '.join(f'min({c}) < max({c}) AS varies_{c}, avg({c}) AS avg_{c}, stddev_samp({c}) AS std_{c}' for c in _REGRESSORS)}
FROM carried WHERE kind = 'train' GROUP BY brand),
timed AS (
SELECT c.*, m.* EXCLUDE (brand), date_diff('day', origin, sale_date) / greatest(date_diff('day', origin, train_end), 1) AS t,
  CAST(date_diff('day', DATE '1970-01-01', sale_date) AS DOUBLE) AS day FROM carried c JOIN moments m ON c.brand = m.brand),
design AS (
SELECT brand, sale_date, kind, actual, [1.0, t, {', '.join(_HINGES)}] AS trend,
  [{', '.join([*_WAVES, *[f"CASE WHEN varies_{c} THEN coalesce(({c} - avg_{c}) / nullif(std_{c}, 0), 0) ELSE 0 END" for c in _REGRESSORS]])}] AS season
FROM timed),
trend_rows AS (SELECT brand, sale_date, list_append(trend, actual) AS v FROM design WHERE kind = 'train'),
{products('trend_sums', 'trend_rows', 28)},
trend_lines AS (
SELECT brand, i, list(g + CASE WHEN i <> j THEN 0 WHEN i <= 2 THEN 1e-9 ELSE 0.1 END ORDER BY j) AS line
FROM trend_sums WHERE i <= 27 GROUP BY brand, i),
{elimination('slopes', 'trend_lines', 27)},
levels AS (SELECT d.*, list_dot_product(trend, beta) AS g FROM design d JOIN slopes s ON d.brand = s.brand),
shares AS (SELECT brand, sale_date, kind, actual, g, list_transform(season, lambda s: s * g) AS w FROM levels),
share_rows AS (SELECT brand, sale_date, list_append(w, actual - g) AS v FROM shares WHERE kind = 'train'),
{products('share_sums', 'share_rows', _SEASON + 1)},
scales AS (SELECT brand, coalesce(nullif(avg(g * g), 0), 1) AS scale FROM shares WHERE kind = 'train' GROUP BY brand),
share_lines AS (
SELECT s.brand, i, list(g + CASE WHEN i = j THEN scale ELSE 0 END ORDER BY j) AS line
FROM share_sums s JOIN scales c ON s.brand = c.brand WHERE i <= {_SEASON} GROUP BY s.brand, i),
{elimination('seasons', 'share_lines', _SEASON)},
regressed AS (SELECT h.*, g + list_dot_product(w, beta) AS predicted FROM shares h JOIN seasons s ON h.brand = s.brand),
bands AS (SELECT brand, 1.2815515655446004 * stddev_samp(actual - predicted) AS half FROM regressed WHERE kind = 'train' GROUP BY brand)"""

_PROFILED = ("total_sales", "quantity_sold", "online_popularity", "competitor_price", "stock_level", "weather_score")
_Z_ROWS = ("quantity_sold", "competitor_price", "stock_level", "supply_delay_days", "weather_score")
_ACTIVE = ("online_popularity", "competitor_price", "stock_level", "supply_delay_days", "weather_score",
           "promotion", "discount_percentage", "is_holiday")

ORACLE: dict[str, str] = {
    "median_impute": sql(SALES, FILLED, body=f"""
SELECT {IDS}, {r('online_popularity', 6)}, total_sales, quantity_sold, competitor_price, stock_level,
  supply_delay_days, weather_score, is_holiday FROM filled"""),

    "label_encode": sql(SALES, "history AS (SELECT * FROM sales)", CODES, body=f"""
SELECT {IDS}, category, brand, region, category_encoded, brand_encoded, region_encoded FROM codes"""),

    "zscore": sql(SALES, f"scored AS (SELECT {IDS}, {', '.join(z(c) for c in _Z_ROWS)} FROM sales)", body=f"""
SELECT {IDS}, {', '.join(r(c, 4) for c in _Z_ROWS)} FROM scored"""),

    "minmax_scale": sql(SALES, SERIES, body=f"""
SELECT brand, sale_date,
  {r('CASE WHEN hi = lo THEN 0 ELSE (total_sales - lo) / (hi - lo) END', 4, 'total_sales_scaled')},
  {r('total_sales', 4, 'restored')}
FROM (SELECT *, min(total_sales) OVER (PARTITION BY brand) AS lo, max(total_sales) OVER (PARTITION BY brand) AS hi
      FROM series)"""),

    "sales_lag_fill": sql(SALES, FILLED, HISTORY, body=f"""
SELECT brand, sale_date, {IDS}, total_sales, sales_lag_1 FROM history"""),

    "sales_ma3": sql(SALES, FILLED, HISTORY, body=f"""
SELECT brand, sale_date, {IDS}, {r('sales_ma_3', 6)} FROM history"""),

    "daily_brand_summary": sql(*PREPARED, body=f"""
SELECT brand, sale_date, {r('total_sales', 4)}, {r('quantity_sold', 4)}, {', '.join(r(c, 4) for c in Z_MEANS)},
  {r('promotion', 4)}, {r('discount_percentage', 4)}, {r('is_holiday', 4)},
  category_encoded, brand_encoded, region_encoded, category FROM processed"""),

    "sales_history_gaps": sql(SALES, GAPS, body=f"""
SELECT brand, sale_date, {IDS}, sales_lag_1, {r('sales_ma_3', 6)} FROM (
SELECT *, CASE WHEN brand IS NOT NULL THEN coalesce(last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    CASE WHEN first_at < n THEN first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END) END AS sales_lag_1,
  CASE WHEN brand IS NULL THEN v ELSE avg(v) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS sales_ma_3
FROM numbered WINDOW w AS (PARTITION BY brand ORDER BY rn))"""),

    "fill_forward_back": sql(SALES, GAPS, body=f"""
SELECT brand, sale_date, {IDS}, CASE WHEN brand IS NULL THEN v ELSE coalesce(
  last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) END AS total_sales
FROM numbered WINDOW w AS (PARTITION BY brand ORDER BY rn)"""),

    "published_daily": sql(SALES, DAILY, body=f"""
SELECT category, brand, sale_date, {r('total_sales', 4)} FROM daily
WHERE date_trunc('month', sale_date) = (SELECT date_trunc('month', max(sale_date)) FROM daily)"""),

    "zscore_with_gaps": sql(SALES, """known AS (SELECT *, CASE WHEN k1 % 11 <> 0 THEN stock_level END AS x FROM sales)""", body=f"""
SELECT {IDS}, {r('(x - avg(x) OVER ()) / (stddev_samp(x) OVER () + 1e-6)', 4, 'stock_level')} FROM known"""),

    "profile_with_gaps": sql(SALES, """known AS (
SELECT CASE WHEN k1 % 11 <> 0 THEN stock_level END AS stock_level, CAST(total_sales AS DOUBLE) AS total_sales FROM sales)""",
                             body="\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS non_null, count(*) - count({c}) AS null_count,
  {r(f'avg({c})', 4, 'mean')}, {r(f'stddev_samp({c})', 4, 'std')}, {r(f'min({c})', 4, 'min')}, {r(f'max({c})', 4, 'max')},
  {r(f'quantile_cont({c}, 0.25)', 4, 'q25')}, {r(f'quantile_cont({c}, 0.5)', 4, 'q50')}, {r(f'quantile_cont({c}, 0.75)', 4, 'q75')}
FROM known""" for c in ("stock_level", "total_sales"))),

    "coverage_with_null_brand": sql(SALES, body="""
SELECT brand, count(DISTINCT sale_date) AS distinct_dates FROM sales WHERE k1 % 9 <> 0 GROUP BY brand
UNION ALL SELECT NULL, count(DISTINCT sale_date) FROM sales"""),

    "first_dates": sql(SALES, body="""
SELECT sale_date, 'sale_date' AS column_name, 'date' AS data_type FROM (SELECT DISTINCT sale_date FROM sales ORDER BY sale_date LIMIT 5)"""),

    "sequence_recursion": sql_recursive(SALES, SERIES, WINDOW_MEANS, body=f"""
SELECT brand, sale_date, 'test' AS kind, {r('predicted', 4)} FROM window_test
UNION ALL SELECT brand, CAST(last_day + CAST(step AS INT) AS DATE), 'future', {r('latest[7]', 4, 'predicted')} FROM ahead WHERE step > 0"""),

    "regressor_design": sql(SALES, """own AS (
SELECT brand, sale_date, avg(promotion) AS promotion, avg(is_holiday) AS is_holiday FROM sales GROUP BY 1, 2)""", SERIES, """frame AS (
SELECT brand, sale_date, CASE WHEN is_train THEN 'train' ELSE 'test' END AS kind FROM parts
UNION ALL
SELECT brand, CAST(sale_date + CAST(i AS INT) AS DATE), 'future' FROM parts, range(1, 31) t(i) WHERE row_no = (row_total * 4) // 5),
carried AS (
SELECT f.*, g.promotion, g.is_holiday FROM frame f ASOF JOIN own g ON f.brand = g.brand AND f.sale_date >= g.sale_date),
moments AS (
SELECT brand, min(sale_date) AS origin, max(sale_date) AS train_end,
  avg(promotion) AS promotion_avg, stddev_samp(promotion) AS promotion_std, min(promotion) < max(promotion) AS promotion_varies,
  avg(is_holiday) AS is_holiday_avg, stddev_samp(is_holiday) AS is_holiday_std, min(is_holiday) < max(is_holiday) AS is_holiday_varies
FROM carried WHERE kind = 'train' GROUP BY brand),
scaled AS (
SELECT c.*, m.*, date_diff('day', origin, sale_date) / greatest(date_diff('day', origin, train_end), 1) AS t,
  CAST(date_diff('day', DATE '1970-01-01', sale_date) AS DOUBLE) AS day
FROM carried c JOIN moments m ON c.brand = m.brand)""", body=f"""
SELECT brand, sale_date, kind, {r('t', 5)}, {r('greatest(t - 0.8 * 1 / 26, 0)', 5, 'hinge')},
  {r('sin(day * (2 * pi() / 365.25))', 5, 'yearly_sin')}, {r('cos(day * (2 * pi() / 7))', 5, 'weekly_cos')},
  {r("CASE WHEN promotion_varies THEN (promotion - promotion_avg) / promotion_std ELSE 0.0 END", 5, 'z_promotion')},
  {r("CASE WHEN is_holiday_varies THEN (is_holiday - is_holiday_avg) / is_holiday_std ELSE 0.0 END", 5, 'z_is_holiday')}
FROM scaled"""),

    "two_model_report": sql_recursive(SALES, SERIES, FIRST_MODEL, WINDOW_MEANS, f"""
bounds AS (SELECT brand, min(total_sales) AS low, max(total_sales) AS high FROM parts GROUP BY 1),
a AS (SELECT brand, {r(SCORES[0], 3, 'rmse_decomposable')}, {r(SCORES[1], 3, 'mape_pct_decomposable')}
      FROM fitted WHERE kind = 'test' GROUP BY brand),
b AS (SELECT brand, {r(SCORES[0], 3, 'rmse_sequence')}, {r(SCORES[1], 3, 'mape_pct_sequence')} FROM window_test GROUP BY brand)""",
                                      body="SELECT * FROM a JOIN b USING (brand)"),

    "gates_on_short_series": sql(SALES, """short AS (
SELECT concat(brand, '/', region) AS brand, count(DISTINCT sale_date) AS series_rows FROM sales
WHERE sale_date < DATE '1995-01-01' + CAST(3 * CAST(substr(brand, 7) AS INT) AS INT) GROUP BY 1)""", body="""
SELECT brand, series_rows, CASE WHEN series_rows < 3 THEN 'insufficient data' END AS decomposable_skip,
  CASE WHEN series_rows < 8 THEN 'insufficient rows' WHEN series_rows < 27 THEN 'not enough samples' END AS sequence_skip FROM short"""),

    "overlay_one_brand": sql(SALES, SERIES, FIRST_MODEL, DAILY, body=f"""
SELECT brand, sale_date, 'actual' AS series, {r('total_sales', 4, 'sales')} FROM daily WHERE brand = 'Brand#7'
UNION ALL SELECT brand, sale_date, 'decomposable', {r('predicted_sales', 2, 'sales')} FROM first_forecast WHERE brand = 'Brand#7'"""),

    "calendar_features": f"""
SELECT sale_date, CAST(month(sale_date) AS INT) AS month, CAST(weekofyear(sale_date) AS INT) AS week,
  CAST(date_trunc('month', sale_date) AS DATE) AS month_start,
  CAST(strftime(sale_date, '%m-%d') IN ('01-26', '08-15', '10-02', '12-25') AS INT) AS is_holiday,
  {r('1 + 0.1 * sin(CAST(dayofyear(sale_date) AS DOUBLE) / 365 * 2 * pi())', 8, 'seasonal_index')},
  {r('CAST(0.8 AS DOUBLE) + day(sale_date) * 3.0 / 100 * 0.4', 8, 'popularity_multiplier')}
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS sale_date FROM orders)""",

    "lenient_parse": """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 2 THEN CAST(o_orderdate AS DATE) END AS order_date,
  CASE WHEN o_orderkey % 5 > 2 THEN o_totalprice END AS amount FROM orders""",

    "data_profile": sql(SALES, body="\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS non_null, count(*) - count({c}) AS null_count,
  {r(f'avg(CAST({c} AS DOUBLE))', 4, 'mean')}, {r(f'stddev_samp(CAST({c} AS DOUBLE))', 4, 'std')},
  {r(f'CAST(min({c}) AS DOUBLE)', 4, 'min')}, {r(f'CAST(max({c}) AS DOUBLE)', 4, 'max')},
  {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)', 4, 'q25')}, {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 4, 'q50')},
  {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)', 4, 'q75')} FROM sales""" for c in _PROFILED)),

    "date_coverage": sql(SALES, body="""
SELECT brand, count(DISTINCT sale_date) AS distinct_dates FROM sales GROUP BY brand
UNION ALL SELECT NULL, count(DISTINCT sale_date) FROM sales"""),

    "brand_search": sql(SALES, body="""
SELECT DISTINCT brand, (SELECT min(sale_date) FROM sales) AS min_date, (SELECT max(sale_date) FROM sales) AS max_date
FROM sales WHERE contains(lower(brand), 'brand#1') ORDER BY brand"""),

    "distinct_regions": sql(SALES, body="SELECT DISTINCT region FROM sales ORDER BY region"),

    "actuals_in_range": sql(SALES, DAILY, body=f"""
SELECT category, brand, sale_date, {r('total_sales', 4)} FROM daily
WHERE brand = 'Brand#7' AND sale_date BETWEEN DATE '1996-03-01' AND DATE '1998-09-15'"""),

    "latest_date_slice": sql(SALES, body=f"""
SELECT sale_date, brand, CAST(total_sales AS DOUBLE) AS total_sales, {IDS} FROM sales
WHERE sale_date = (SELECT max(sale_date) FROM sales)"""),

    "latest_month_slice": sql(SALES, DAILY, body=f"""
SELECT category, brand, sale_date, {r('total_sales', 4)} FROM daily
WHERE date_trunc('month', sale_date) = (SELECT date_trunc('month', max(sale_date)) FROM daily)"""),

    "last_rows": sql(SALES, SERIES, body=f"""
SELECT brand, sale_date, {r('total_sales', 4)} FROM parts WHERE row_no > row_total - 7"""),

    "monthly_totals": sql(SALES, body="""
SELECT brand, CAST(date_trunc('month', sale_date) AS DATE) AS month_start,
  CAST(sum(total_sales) AS DOUBLE) AS total_sales FROM sales GROUP BY 1, 2"""),

    "append_batches": sql(SALES, body="""
SELECT sale_date, count(*) AS sale_rows, CAST(sum(total_sales) AS DOUBLE) AS total_sales FROM sales GROUP BY 1"""),

    "csv_batches": sql(SALES, body=f"""
SELECT sale_date, category, brand, region, promotion, CAST(total_sales AS DOUBLE) AS total_sales, quantity_sold, online_popularity,
  CASE WHEN k1 % 3 <> 2 THEN discount_percentage END AS discount_percentage, stock_level, {IDS} FROM sales"""),

    "trend_score_7d": sql(EVENTS, body=f"""
SELECT brand, {r('coalesce(score, 55.0)', 6, 'online_popularity')}
FROM (SELECT DISTINCT p_brand AS brand FROM part) b LEFT JOIN scores USING (brand)"""),

    "popularity_refresh": sql(SALES, EVENTS, """latest AS (
SELECT DISTINCT brand FROM sales WHERE sale_date = (SELECT max(sale_date) FROM sales)),
refreshed AS (SELECT brand, coalesce(score, 55.0) AS s FROM latest LEFT JOIN scores USING (brand))""", body=f"""
SELECT {IDS}, sales.brand, sale_date, {r('s', 6, 'online_popularity')}
FROM sales LEFT JOIN refreshed ON sales.brand = refreshed.brand"""),

    "series_daily": sql(SALES, body=f"""
SELECT brand, sale_date, CAST(sum(total_sales) AS DOUBLE) AS total_sales,
  {r('avg(promotion)', 4, 'promotion')}, {r('avg(is_holiday)', 4, 'is_holiday')} FROM sales GROUP BY 1, 2"""),

    "series_gate": sql(SALES, SERIES, """counts AS (
SELECT brand, count(*) AS series_rows, count(*) FILTER (day(sale_date) % 10 > 1) AS clean_rows FROM series GROUP BY 1)""",
                       body="""
SELECT brand, series_rows, clean_rows, (clean_rows * 4) // 5 AS train_rows,
  clean_rows - (clean_rows * 4) // 5 AS test_rows, CAST(0 AS BIGINT) AS null_train_rows,
  series_rows - clean_rows AS dropped_rows,
  CASE WHEN clean_rows < 3 THEN 'insufficient data' END AS decomposable_skip,
  greatest(series_rows - 7, 0) AS sequences,
  CASE WHEN series_rows < 8 THEN 'insufficient rows' WHEN series_rows < 27 THEN 'not enough samples' END AS sequence_skip
FROM counts"""),

    "train_test_split": sql(SALES, SERIES, body=f"""
SELECT brand, sale_date, {r('total_sales', 4)}, CAST(row_no AS INT) AS row_no, row_total,
  CAST(is_train AS INT) AS is_train FROM parts"""),

    "active_regressors": sql(*PREPARED, f"""features AS (
SELECT brand, sale_date, {', '.join(f'avg({c}) AS {c}' for c in _ACTIVE)} FROM processed GROUP BY 1, 2),
numbered AS (
SELECT *, row_number() OVER (PARTITION BY brand ORDER BY sale_date) AS rn, count(*) OVER (PARTITION BY brand) AS n
FROM features)""", body="SELECT brand, concat_ws(',', " + ", ".join(
        f"CASE WHEN count(DISTINCT {c}) > 1 THEN '{c}' END" for c in _ACTIVE) + """) AS regressors
FROM numbered WHERE rn <= (n * 4) // 5 GROUP BY brand"""),

    "sequence_windows": sql(SALES, SERIES, body=f"""
SELECT brand, sale_date, {r('total_sales', 4, 'target')}, {', '.join(r(f'x{i}', 4) for i in range(1, 8))}
FROM (SELECT *, {', '.join(f'lag(total_sales, {8 - i}) OVER w AS x{i}' for i in range(1, 8))} FROM parts
      WINDOW w AS (PARTITION BY brand ORDER BY sale_date)) WHERE row_no > 7"""),

    "future_frame": sql(SALES, SERIES, """regressors AS (
SELECT brand, sale_date, avg(promotion) AS promotion, avg(is_holiday) AS is_holiday FROM sales GROUP BY 1, 2),
frame AS (
SELECT brand, sale_date, 'train' AS kind FROM parts WHERE is_train
UNION ALL
SELECT brand, CAST(sale_date + CAST(i AS INT) AS DATE), 'future' FROM parts, range(1, 31) t(i)
WHERE row_no = (row_total * 4) // 5)""", body=f"""
SELECT f.brand, f.sale_date, kind, {r('g.promotion', 4, 'promotion')}, {r('g.is_holiday', 4, 'is_holiday')}
FROM frame f ASOF JOIN regressors g ON f.brand = g.brand AND f.sale_date >= g.sale_date"""),

    "decomp_forecast": sql(SALES, SERIES, FIRST_MODEL, body=f"""
SELECT sale_date, brand, {r('predicted_sales', 2)}, {r('yhat_lower', 2)}, {r('yhat_upper', 2)} FROM first_forecast"""),

    "decomp_metrics": sql(SALES, SERIES, FIRST_MODEL, body=f"""
SELECT brand, {r(SCORES[0], 4, 'rmse')}, {r(SCORES[1], 4, 'mape_pct')} FROM fitted WHERE kind = 'test' GROUP BY brand"""),

    "decomp_regressor_forecast": sql_recursive(*PREPARED, FEATURES, REGRESSOR_MODEL, body=f"""
SELECT sale_date, r.brand, {r('predicted', 2, 'predicted_sales')}, {r('predicted - half', 2, 'yhat_lower')}, {r('predicted + half', 2, 'yhat_upper')}
FROM regressed r JOIN bands b ON r.brand = b.brand WHERE kind <> 'test'"""),

    "sequence_forecast": sql_recursive(*PREPARED, FEATURES, SEQUENCE_MODEL, body=f"""
SELECT CAST(last_day + CAST(step AS INT) AS DATE) AS sale_date, brand, {r(UNSCALED.format('latest[7][1]'), 2, 'predicted_sales')}
FROM ahead WHERE step > 0"""),

    "sequence_metrics": sql_recursive(*PREPARED, FEATURES, SEQUENCE_MODEL, f"""unscaled AS (
SELECT brand, {UNSCALED.format('actual')} AS actual, {UNSCALED.format('predicted')} AS predicted FROM sequence_test),
a AS (SELECT brand, {', '.join(f"CAST(printf('%.6e', {e}) AS DOUBLE) AS {c}" for e, c in zip(SCORES, ('rmse', 'mape_pct')))} FROM sequence_test GROUP BY brand),
b AS (SELECT brand, {', '.join(f"CAST(printf('%.6e', {e}) AS DOUBLE) AS {c}" for e, c in zip(SCORES, ('rmse_sales', 'mape_pct_sales')))}
      FROM unscaled GROUP BY brand)""", body="SELECT * FROM a JOIN b USING (brand)"),

    "sequence_skips": sql(SALES, BROKEN, body="""
SELECT brand, reason, CASE WHEN reason IS NULL THEN n - 7 - ((n - 7) * 4) // 5 ELSE 0 END AS test_rows,
  CAST(CASE WHEN reason IS NULL THEN 30 ELSE 0 END AS BIGINT) AS future_rows
FROM (SELECT *, CASE WHEN n < 8 THEN 'insufficient rows' WHEN n < 27 THEN 'not enough samples'
  WHEN brand = 'Brand#3' THEN 'missing values: weather_score' WHEN brand = 'Brand#4' THEN 'missing values: stock_level' END AS reason FROM broken)"""),

    "regressor_skips": sql(SALES, BROKEN, body="""
SELECT brand, reason, CASE WHEN reason IS NULL THEN n - (n * 4) // 5 ELSE 0 END AS test_rows,
  CAST(CASE WHEN reason IS NULL THEN 30 ELSE 0 END AS BIGINT) AS future_rows
FROM (SELECT *, CASE WHEN n < 3 THEN 'insufficient data'
  WHEN brand IN ('Brand#3', 'Brand#4') THEN 'not enough valid train data' END AS reason FROM broken)"""),

    "model_comparison": sql(*MODELS, f"""
a AS (SELECT brand, {r(SCORES[0], 4, 'rmse_decomposable')}, {r(SCORES[1], 4, 'mape_pct_decomposable')}
      FROM fitted WHERE kind = 'test' GROUP BY brand),
b AS (SELECT brand, {r(SCORES[0], 4, 'rmse_weekday')}, {r(SCORES[1], 4, 'mape_pct_weekday')}
      FROM second_test GROUP BY brand)""", body="SELECT * FROM a JOIN b USING (brand)"),

    "top5_by_model": sql(*MODELS, """both_means AS (
SELECT 'decomposable' AS model, brand, avg(predicted_sales) AS m FROM first_forecast GROUP BY brand
UNION ALL SELECT 'weekday', brand, avg(predicted_sales) FROM second_forecast GROUP BY brand),
ranked AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY m DESC, brand) AS rank FROM both_means)""",
                         body=f"SELECT model, CAST(rank AS INT) AS rank, brand, {r('m', 2, 'mean_forecast')} FROM ranked WHERE rank <= 5"),

    "forecast_overlay": sql(*MODELS, DAILY, body=f"""
SELECT brand, sale_date, 'actual' AS series, {r('total_sales', 4, 'sales')} FROM daily
WHERE sale_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
UNION ALL SELECT brand, sale_date, 'decomposable', {r('predicted_sales', 2, 'sales')} FROM first_forecast
UNION ALL SELECT brand, sale_date, 'weekday', {r('predicted_sales', 2, 'sales')} FROM second_forecast"""),

    "forecast_comparison": sql(*MODELS, body=f"""
SELECT brand, sale_date, 'decomposable' AS model, {r('predicted_sales', 2)} FROM first_forecast
UNION ALL SELECT brand, sale_date, 'weekday', {r('predicted_sales', 2)} FROM second_forecast
WHERE brand IN (SELECT brand FROM first_forecast)"""),

    "ensemble_scores": sql(*MODELS, COMBINED, body=f"SELECT brand, {r('combined_score', 2)} FROM combined"),

    "ensemble_best_brand": sql(*MODELS, COMBINED, body=f"""
SELECT brand, {r('combined_score', 2)} FROM combined WHERE combined_score IS NOT NULL
ORDER BY combined.combined_score DESC, brand LIMIT 1"""),

    "forecast_summary": sql(*PREPARED, SERIES, FIRST_MODEL, SECOND_MODEL, COMBINED, body="""
SELECT concat('Forecast Summary (whole history)', chr(10), chr(10),
  'Brand expected to perform best next month: ', (SELECT brand FROM combined ORDER BY combined_score DESC NULLS LAST, brand LIMIT 1), chr(10),
  'Average Forecasted Sales Score: ', printf('%.2f', (SELECT max(combined_score) FROM combined)), chr(10), chr(10),
  'Most Trending Brand Right Now (Social buzz): ',
  (SELECT brand FROM processed GROUP BY brand ORDER BY avg(online_popularity) DESC NULLS LAST, brand LIMIT 1)) AS summary"""),

    "rolling_origin_metrics": sql(SALES, SERIES, FOLDS, body=f"""
SELECT brand, CAST(fold AS INT) AS fold, count(*) AS test_rows, {r(SCORES[0], 4, 'rmse')}, {r(SCORES[1], 4, 'mape_pct')}
FROM fold_test GROUP BY brand, fold"""),

    "rolling_origin_bands": sql(SALES, SERIES, FOLDS, """steps AS (
SELECT brand, step, sum((actual - predicted) * (actual - predicted)) AS q, count(*) AS n FROM fold_test GROUP BY 1, 2),
widths AS (
SELECT brand, step, 1.2815515655446004 * sqrt(sum(q) OVER near / sum(n) OVER near) AS half FROM steps
WINDOW near AS (PARTITION BY brand ORDER BY step RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING))""", body=f"""
SELECT brand, CAST(step AS INT) AS step, {r('max(half) OVER (PARTITION BY brand ORDER BY step)', 4, 'half')} FROM widths"""),

    "rejected_rows": """
SELECT o_orderkey, unnest(c) AS column_name, unnest(t) AS text, unnest(w) AS reason FROM (
SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 3 THEN ['sale_date'] ELSE [] END || CASE WHEN o_orderkey % 5 IN (0, 2) THEN ['amount'] ELSE [] END AS c,
  CASE WHEN o_orderkey % 7 < 3 THEN [CASE o_orderkey % 7 WHEN 0 THEN 'not a date' WHEN 1 THEN '' ELSE strftime(o_orderdate, '%Y/%m/%d') END] ELSE [] END
    || CASE o_orderkey % 5 WHEN 0 THEN ['inf'] WHEN 2 THEN ['12,5'] ELSE [] END AS t,
  CASE WHEN o_orderkey % 7 < 3 THEN [CASE o_orderkey % 7 WHEN 1 THEN 'missing' ELSE 'not a date' END] ELSE [] END
    || CASE o_orderkey % 5 WHEN 0 THEN ['not finite'] WHEN 2 THEN ['not a number'] ELSE [] END AS w FROM orders)""",

    "hand_made_scores": sql(SALES, """latest AS (SELECT DISTINCT brand FROM sales WHERE sale_date = (SELECT max(sale_date) FROM sales))""", body=f"""
SELECT s.brand, count(*) AS sale_rows, {r("CASE WHEN any_value(l.brand) IS NOT NULL THEN CASE s.brand WHEN 'Brand#1' THEN 12.5 WHEN 'Brand#2' THEN 99.0 ELSE 55.0 END END", 6, 'online_popularity')}
FROM sales s LEFT JOIN latest l ON s.brand = l.brand GROUP BY s.brand"""),

    "top5_of_two_models": sql_recursive(SALES, SERIES, FIRST_MODEL, WINDOW_MEANS, WINDOW_FORECAST, """both_means AS (
SELECT 'decomposable' AS model, brand, avg(predicted_sales) AS m FROM first_forecast GROUP BY brand
UNION ALL SELECT 'sequence', brand, avg(predicted_sales) FROM second_forecast GROUP BY brand),
ranked AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY m DESC, brand) AS rank FROM both_means)""",
                                        body=f"SELECT model, CAST(rank AS INT) AS rank, brand, {r('m', 2, 'mean_forecast')} FROM ranked WHERE rank <= 5"),

    "lines_of_two_models": sql_recursive(SALES, SERIES, FIRST_MODEL, WINDOW_MEANS, WINDOW_FORECAST, body=f"""
SELECT brand, sale_date, 'decomposable' AS model, {r('predicted_sales', 2)} FROM first_forecast
UNION ALL SELECT brand, sale_date, 'sequence', {r('predicted_sales', 2)} FROM second_forecast
WHERE brand IN (SELECT brand FROM first_forecast)"""),

    "ensemble_of_two_models": sql_recursive(SALES, SERIES, FIRST_MODEL, WINDOW_MEANS, WINDOW_FORECAST, COMBINED,
                                            body=f"SELECT brand, {r('combined_score', 2)} FROM combined"),

    "summary_of_two_models": sql_recursive(SALES, SERIES, FIRST_MODEL, WINDOW_MEANS, WINDOW_FORECAST, COMBINED, body="""
SELECT concat('Forecast Summary (whole history)', chr(10), chr(10),
  'Brand expected to perform best next month: ', (SELECT brand FROM combined ORDER BY combined_score DESC NULLS LAST, brand LIMIT 1), chr(10),
  'Average Forecasted Sales Score: ', printf('%.2f', (SELECT max(combined_score) FROM combined)), chr(10), chr(10),
  'Most Trending Brand Right Now (Social buzz): ',
  (SELECT brand FROM sales GROUP BY brand ORDER BY avg(online_popularity) DESC NULLS LAST, brand LIMIT 1)) AS summary"""),

    "reread_forecast": sql(SALES, SERIES, FIRST_MODEL, body=f"""
SELECT brand, sale_date, 'decomposable' AS model, {r('predicted_sales', 2)} FROM first_forecast"""),

    "summary_of_few_columns": sql(*PREPARED, body=f"""
SELECT brand, sale_date, {', '.join(r(c, 4) for c in ('total_sales', 'quantity_sold', 'online_popularity', 'sales_lag_1', 'sales_ma_3'))},
  category_encoded, brand_encoded, region_encoded, category FROM processed"""),

    "whole_run": sql_recursive(SALES, SERIES, FIRST_MODEL, WINDOW_MEANS, f"""
bounds AS (SELECT brand, min(total_sales) AS low, max(total_sales) AS high FROM parts GROUP BY 1),
a AS (SELECT brand, {r(SCORES[0], 3, 'rmse_decomposable')}, {r(SCORES[1], 3, 'mape_pct_decomposable')}
      FROM fitted WHERE kind = 'test' GROUP BY brand),
b AS (SELECT w.brand, {r(f"{SCORES[0]} / any_value(CASE WHEN high = low THEN 1 ELSE high - low END)", 6, 'rmse_sequence')}
      FROM window_test w JOIN bounds USING (brand) GROUP BY w.brand)""", body="SELECT * FROM a JOIN b USING (brand)"),

    "kpi_overview": sql(SALES, SERIES, FIRST_MODEL, DAILY, GROWTH, KPIS, body=f"""
SELECT {r('this_month_revenue', 4)}, {r('projected_revenue', 2)}, fastest_brand, {r('fastest_growth', 2)},
  growing_brands FROM kpis"""),

    "kpi_cards": sql(SALES, SERIES, FIRST_MODEL, DAILY, GROWTH, KPIS, body="""
SELECT format('{:,}', CAST(round_even(this_month_revenue, 0) AS BIGINT)) AS this_month_revenue,
  format('{:,}', CAST(round_even(projected_revenue, 0) AS BIGINT)) AS projected_revenue, fastest_brand,
  format('{:,}', CAST(round_even(fastest_growth, 0) AS BIGINT)) AS fastest_growth, growing_brands FROM kpis"""),

    "category_leaders": sql(SALES, DAILY, """asked AS (
SELECT unnest(['ECONOMY', 'STANDARD', 'PROMO', 'MEDIUM', 'LARGE', 'SMALL', 'NOT SOLD']) AS category),
totals AS (
SELECT category, brand, sum(total_sales) AS s FROM daily
WHERE date_trunc('month', sale_date) = (SELECT date_trunc('month', max(sale_date)) FROM daily) GROUP BY 1, 2),
leaders AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY s DESC, brand) AS rank FROM totals)""", body=f"""
SELECT a.category, CAST(coalesce(rank, 1) AS INT) AS rank, coalesce(brand, 'No data') AS brand, {r('s', 4, 'total_sales')}
FROM asked a LEFT JOIN (SELECT * FROM leaders WHERE rank <= 3) l ON a.category = l.category"""),

    "growth_by_brand": sql(SALES, SERIES, FIRST_MODEL, DAILY, GROWTH, body=f"SELECT brand, {GROWTH_COLUMNS}, trend FROM growth"),

    "growth_ranking": sql(SALES, SERIES, FIRST_MODEL, DAILY, GROWTH, body=f"""
SELECT brand, {GROWTH_COLUMNS}, trend FROM (SELECT * FROM growth ORDER BY growth DESC NULLS LAST, brand LIMIT 10)"""),
}

# The same rows whatever the ranges and batches.
ORACLE["sales_lag_hot_days"] = ORACLE["sales_lag_fill"]
ORACLE["daily_summary_hot_days"] = ORACLE["daily_brand_summary"]
ORACLE["daily_summary_incremental"] = ORACLE["daily_brand_summary"]
ORACLE["trend_score_incremental"] = ORACLE["trend_score_7d"]
