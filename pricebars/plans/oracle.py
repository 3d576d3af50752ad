"""The SQL each query is checked against, written for DuckDB on the same tables.

The statements are built from a few shared WITH parts.  They compute bars straight from ticks per
timeframe, metrics from rows and the smoother by recursion, so they share no shape with the Spark plans.
"""

from pricebars.functions.reference_data import CANONICAL_NAMES

# Fixed values, written out here once more so that a wrong one in the engine shows.
INDICATORS = ["open_price", "high_price", "low_price", "close_price", "latest_price"]
TIMEFRAMES = ["day", "week", "month", "year"]
HORIZON, MIN_OBS = 3, 3
Z95, MIN_VARIANCE, MIN_RMSE = 1.96, 0.0001, 0.01
ALPHAS = [0.1, 0.3, 0.5, 0.7, 0.9]
BETAS = [0.05, 0.1, 0.2, 0.3]
PHIS = [0.8, 0.85, 0.9, 0.95, 0.98]
FALLBACK_CATEGORY, PROFILE_CATEGORY = "Other", "Equity"
BACKCAST = {
    "day": (90, 0.001, 0.99, 0.004, 1.008, 0.992),
    "week": (104, 0.005, 0.98, 0.008, 1.018, 0.982),
    "month": (36, 0.02, 0.97, 0.012, 1.03, 0.97),
    "year": (None, 0.06, 0.96, 0.016, 1.045, 0.955),
}
BACKCAST_FLOOR = 0.01
NOT_NULL = {
    "bronze": ["symbol", "indicator", "timeframe", "time_index"],
    "silver": ["symbol", "timeframe", "time_index"],
    "dim": ["id", "symbol"],
    "fact": ["id", "timeframe", "time_index"],
    "predictions": ["id", "timeframe", "indicator", "model_name", "predicted_time"],
}

P4 = "open_price, high_price, low_price, close_price"
P5 = ", ".join(INDICATORS)
KEY = "symbol, timeframe, time_index"
SKEY = "symbol, timeframe, indicator"
FEATURE_LIST = (
    "price_change, price_change_pct, price_trend, intraday_range, intraday_range_pct, volatility_level, "
    "category_avg_close, category_count"
)


def rnd(x: str, k: int) -> str:
    """Round half up on the decimal form of a double, as Spark does."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {k}) AS DOUBLE)"


def mean(x: str) -> str:
    return f"CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(28,8))) AS DOUBLE) / nullif(count({x}), 0)"


def direction(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN 'up' WHEN {x} < 0 THEN 'down' ELSE 'flat' END"


# --- ticks and bars ---------------------------------------------------------

PO = """po AS (
  SELECT n_name AS symbol, CAST(o_orderdate AS DATE) AS ts, o_orderkey AS seq, o_totalprice AS price
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
PE = "pe AS (SELECT CAST(user_id AS VARCHAR) AS symbol, ts, ts AS seq, value AS price FROM events)"
PL = """pl AS (
  SELECT CAST(l_partkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS ts,
         (l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity) AS seq,
         l_extendedprice / nullif(l_quantity, 0) AS price FROM lineitem)"""
NATIONS = """prof AS (
  SELECT n_name AS symbol, n_name AS name, r_name AS category
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def bar_select(ticks: str, timeframe: str, seq: str = "seq") -> str:
    start = f"CAST(date_trunc('{timeframe}', ts) AS DATE)"
    return f"""SELECT symbol, '{timeframe}' AS timeframe, {start} AS time_index,
    arg_min(price, (CAST(ts AS DATE), {seq})) AS open_price, max(price) AS high_price, min(price) AS low_price,
    arg_max(price, (CAST(ts AS DATE), {seq})) AS close_price, arg_max(price, (CAST(ts AS DATE), {seq})) AS latest_price
  FROM {ticks} WHERE price IS NOT NULL GROUP BY symbol, {start}"""


def bars(name: str, ticks: str, timeframes=TIMEFRAMES, seq: str = "seq") -> str:
    return f"{name} AS (" + " UNION ALL ".join(bar_select(ticks, t, seq) for t in timeframes) + ")"


PO_BARS = bars("bars", "po")
PE_DAYS = bars("days", "pe", ["day"])


def movement(source: str) -> str:
    change = rnd("close_price - previous_close", 4)
    pct = rnd("price_change / nullif(previous_close, 0) * 100", 4)
    return f"""moved AS (
  SELECT * EXCLUDE (previous_close), CASE WHEN price_change_pct >= 1 THEN 'up' WHEN price_change_pct <= -1 THEN 'down'
      WHEN price_change_pct IS NOT NULL THEN 'flat' ELSE 'new' END AS price_trend
  FROM (SELECT *, {pct} AS price_change_pct
        FROM (SELECT *, {change} AS price_change
              FROM (SELECT *, lag(close_price) OVER (PARTITION BY symbol, timeframe ORDER BY time_index) AS previous_close
                    FROM {source}))))"""


def ranged(source: str) -> str:
    pct = rnd("intraday_range / nullif(close_price, 0) * 100", 4)
    return f"""ranged AS (
  SELECT *, CASE WHEN intraday_range_pct >= 8 THEN 'high' WHEN intraday_range_pct >= 3 THEN 'medium'
      WHEN intraday_range_pct IS NOT NULL THEN 'low' END AS volatility_level
  FROM (SELECT *, {pct} AS intraday_range_pct
        FROM (SELECT *, {rnd("high_price - low_price", 4)} AS intraday_range FROM {source})))"""


CATEGORY_AVG = f"""cavg AS (
  SELECT category, timeframe, time_index, {rnd(mean("close_price"), 4)} AS category_avg_close,
         count(*) AS category_count
  FROM cbars GROUP BY category, timeframe, time_index)"""
CBARS = "cbars AS (SELECT bars.*, category FROM bars JOIN prof USING (symbol))"
SILVER = ", ".join(
    [PO, PO_BARS, NATIONS, CBARS, movement("cbars"), ranged("moved"), CATEGORY_AVG]
) + f""", silver AS (
  SELECT symbol, prof.name, r.category, timeframe, time_index, {P5}, {FEATURE_LIST}
  FROM ranged r JOIN cavg USING (category, timeframe, time_index) JOIN prof USING (symbol))"""
DIM = "dim AS (SELECT row_number() OVER (ORDER BY symbol) AS id, * FROM prof WHERE symbol IN (SELECT symbol FROM bars))"


def long(source: str, columns: str = KEY) -> str:
    return " UNION ALL ".join(
        f"SELECT {columns}, '{i}' AS indicator, {i} AS value FROM {source} WHERE {i} IS NOT NULL" for i in INDICATORS
    )


def q(*parts: str, select: str) -> str:
    return f"WITH {', '.join(parts)} {select}"


# --- series and models ------------------------------------------------------

POINTS = f"""points AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY {SKEY} ORDER BY time_index) - 1 AS BIGINT) AS t,
         count(*) OVER (PARTITION BY {SKEY}) AS n
  FROM ({long("bars")}))"""
SERIES = ", ".join([PO, PO_BARS, POINTS])


def train(test_size: int) -> str:
    return f"""train AS (
  SELECT {SKEY}, time_index, value, t, CASE WHEN n > {test_size} THEN n - {test_size} ELSE n END AS n
  FROM points WHERE n >= {MIN_OBS} AND (t < n - {test_size} OR n <= {test_size})),
held AS (SELECT {SKEY}, time_index AS predicted_time, value AS actual FROM points
  WHERE n >= {MIN_OBS} AND n > {test_size} AND t >= n - {test_size})"""


FULL = f"train AS (SELECT * FROM points WHERE n >= {MIN_OBS})"
ALL_POINTS = "train AS (SELECT * FROM points)"

OLS = f"""means AS (
  SELECT {SKEY}, any_value(n) AS n, max(time_index) AS last, (any_value(n) - 1) / 2.0 AS x_mean,
         any_value(n) * (any_value(n) * any_value(n) - 1) / 12.0 AS sxx, avg(value) AS y_mean
  FROM train GROUP BY {SKEY}),
slopes AS (
  SELECT m.*, coalesce(s.sxy / nullif(m.sxx, 0), 0) AS beta1,
         m.y_mean - coalesce(s.sxy / nullif(m.sxx, 0), 0) * m.x_mean AS beta0
  FROM means m JOIN (SELECT {SKEY}, sum((t - x_mean) * (value - y_mean)) AS sxy
                     FROM train JOIN means USING ({SKEY}) GROUP BY {SKEY}) s USING ({SKEY})),
ols AS (
  SELECT p.*, CASE WHEN p.n > 2 AND r.ssr / nullif(p.n - 2, 0) > 0 THEN r.ssr / (p.n - 2) ELSE {MIN_VARIANCE} END AS s2
  FROM slopes p JOIN (SELECT {SKEY}, sum((value - (beta0 + beta1 * t)) * (value - (beta0 + beta1 * t))) AS ssr
                      FROM train JOIN slopes USING ({SKEY}) GROUP BY {SKEY}) r USING ({SKEY}))"""


def unnest(values: list[float], name: str) -> str:
    return "(SELECT unnest([" + ", ".join(f"CAST({v} AS DOUBLE)" for v in values) + f"]) AS {name})"


HOLT = f"""ids AS (
  SELECT {SKEY}, any_value(n) AS n, max(time_index) AS last, row_number() OVER (ORDER BY {SKEY}) AS sid
  FROM train GROUP BY {SKEY}),
pts AS (SELECT sid, t, value FROM train JOIN ids USING ({SKEY})),
grid AS (
  SELECT *, row_number() OVER (ORDER BY alpha, beta, phi) AS g
  FROM {unnest(ALPHAS, "alpha")} CROSS JOIN {unnest(BETAS, "beta")} CROSS JOIN {unnest(PHIS, "phi")}),
state(sid, g, t, level, trend, sse) USING KEY (sid, g) AS (
  SELECT a.sid, g, CAST(0 AS BIGINT), a.value, b.value - a.value, CAST(0 AS DOUBLE)
  FROM pts a JOIN pts b ON a.sid = b.sid AND a.t = 0 AND b.t = 1 CROSS JOIN grid
  UNION
  SELECT sid, g, t, new_level, beta * (new_level - level) + (1.0 - beta) * damped, sse + error * error
  FROM (SELECT *, alpha * value + (1.0 - alpha) * expected AS new_level, value - expected AS error
        FROM (SELECT s.sid, s.g, p.t, s.level, s.sse, alpha, beta, p.value, phi * s.trend AS damped,
                     s.level + phi * s.trend AS expected
              FROM state s JOIN grid USING (g) JOIN pts p ON p.sid = s.sid AND p.t = s.t + 1))),
holt AS (
  SELECT {SKEY}, n, last, alpha, beta, phi, level, trend,
         CASE WHEN sqrt(sse / (n - 1)) > 0 THEN sqrt(sse / (n - 1)) ELSE {MIN_RMSE} END AS rmse
  FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY sse, g) AS place FROM state)
  JOIN ids USING (sid) JOIN grid USING (g) WHERE place = 1)"""

STEPS = f"(SELECT CAST(unnest(range(1, {HORIZON + 1})) AS INTEGER) AS k)"
PROJECTED = """CASE timeframe WHEN 'week' THEN last + 7 * k
    WHEN 'month' THEN CAST(date_trunc('month', last) + to_months(k) AS DATE)
    WHEN 'year' THEN CAST(date_trunc('year', last) + to_years(k) AS DATE) ELSE last + k END"""


def rows(name: str, model: str, fits: str, value: str, margin: str) -> str:
    return f"""{name} AS (
  SELECT {SKEY}, model_name, predicted_time, pv AS predicted_value, least(lo, pv) AS confidence_low,
         greatest(hi, pv) AS confidence_high
  FROM (SELECT {SKEY}, '{model}' AS model_name, predicted_time, {rnd("greatest(0, v)", 4)} AS pv,
               {rnd("greatest(0, v - m)", 4)} AS lo, {rnd("greatest(0, v + m)", 4)} AS hi
        FROM (SELECT *, CAST({PROJECTED} AS DATE) AS predicted_time, {value} AS v, {margin} AS m
              FROM {fits} CROSS JOIN {STEPS})))"""


LINEAR_ROWS = rows(
    "linear", "linear_trend", "ols", "beta0 + beta1 * (n - 1 + k)",
    f"{Z95} * sqrt(s2 * (1 + 1.0 / n + (n - 1 + k - x_mean) * (n - 1 + k - x_mean) "
    f"/ CASE WHEN sxx > 0 THEN sxx ELSE {MIN_VARIANCE} END))",
)
HOLT_ROWS = rows(
    "smooth", "holt_smoothing", "holt",
    "level + (CASE WHEN k = 1 THEN pow(phi, 1) WHEN k = 2 THEN pow(phi, 1) + pow(phi, 2) "
    "ELSE pow(phi, 1) + pow(phi, 2) + pow(phi, 3) END) * trend",
    f"{Z95} * rmse * sqrt(k)",
)
BOTH = "preds AS (SELECT * FROM linear UNION ALL SELECT * FROM smooth)"


def models(trained: str) -> str:
    return ", ".join([SERIES, trained, OLS, HOLT, LINEAR_ROWS, HOLT_ROWS, BOTH])


def recursive(*parts: str, select: str) -> str:
    return f"WITH RECURSIVE {', '.join(parts)} {select}"


def both_scopes(select: str, extra: str = "") -> str:
    """Forecasts of both scopes: the two fits in nested statements, joined to the dimension."""
    def fitted(trained: str) -> str:
        return f"({recursive(models(trained), select='SELECT * FROM preds')})"

    return f"""WITH {PO}, {PO_BARS}, {NATIONS}, {DIM},
scopes AS (SELECT *, 'full' AS fit_scope FROM {fitted(FULL)}
           UNION ALL SELECT *, 'holdout' AS fit_scope FROM {fitted(train(1))}),
predictions AS (SELECT symbol, name, category, timeframe, indicator, model_name, predicted_time,
                       predicted_value, confidence_low, confidence_high, fit_scope
                FROM scopes JOIN dim USING (symbol)){extra} {select}"""


def errors(a: str = "actual", p: str = "predicted") -> str:
    return f"""{rnd(f"avg(abs({a} - {p}))", 4)} AS mae, {rnd(f"sqrt(avg(({a} - {p}) * ({a} - {p})))", 4)} AS rmse,
    {rnd(f"avg(abs(({a} - {p}) / nullif({a}, 0))) * 100", 4)} AS mape,
    {rnd(f"1 - sum(({a} - {p}) * ({a} - {p})) / nullif(var_pop({a}) * count({a}), 0)", 4)} AS r2"""


SCORES = f"""scores AS (
  SELECT {SKEY}, model_name, predicted_time, actual, predicted_value,
         {rnd("abs(actual - predicted_value)", 4)} AS mae, {rnd("abs(actual - predicted_value)", 4)} AS rmse,
         {rnd("abs(actual - predicted_value) / nullif(abs(actual), 0) * 100", 4)} AS mape, CAST(NULL AS DOUBLE) AS r2
  FROM preds JOIN held USING ({SKEY}, predicted_time))"""
EVALUATION = f"""report AS (
  SELECT model_name, timeframe, indicator, {errors("actual", "CASE WHEN actual IS NOT NULL THEN predicted_value END")},
         count(DISTINCT symbol) AS n_series, count(actual) AS n_matched
  FROM preds LEFT JOIN (SELECT {SKEY}, time_index AS predicted_time, value AS actual FROM points)
    USING ({SKEY}, predicted_time)
  GROUP BY model_name, timeframe, indicator HAVING count(actual) > 0)"""
SUMMARY = f"""summary AS (
  SELECT model_name, timeframe, {rnd("avg(mae)", 6)} AS avg_mae, {rnd("avg(rmse)", 6)} AS avg_rmse,
         {rnd("avg(mape)", 6)} AS avg_mape, CAST(NULL AS DOUBLE) AS avg_r2, count(*) AS n_points
  FROM scores GROUP BY model_name, timeframe)"""

# --- events -----------------------------------------------------------------

BOARD = f"""board AS (
  SELECT symbol, time_index, live_price, previous_close, {rnd("change", 4)} AS day_change,
         {rnd("coalesce(change / nullif(previous_close, 0) * 100, 0)", 4)} AS day_change_pct,
         {direction("change")} AS direction
  FROM (SELECT *, coalesce(live_price - nullif(previous_close, 0), 0) AS change
        FROM (SELECT symbol, time_index, close_price AS live_price,
                     lag(close_price) OVER (PARTITION BY symbol ORDER BY time_index) AS previous_close,
                     row_number() OVER (PARTITION BY symbol ORDER BY time_index DESC) AS place
              FROM days) WHERE place = 1))"""
QUOTES = f"""quotes AS (
  SELECT b.symbol, c_name AS name, 'day' AS timeframe, DATE '2024-01-31' AS time_index, open_price, high_price,
         low_price, coalesce(nullif(previous_close, 0), close_price) AS close_price, close_price AS latest_price
  FROM board b JOIN days USING (symbol, time_index) LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = b.symbol
  WHERE close_price <> 0)"""
TICK_CHANGE = f"""changes AS (
  SELECT event_id, symbol, ts, price, {rnd("change", 4)} AS tick_change, {direction("change")} AS tick_status
  FROM (SELECT *, coalesce(price - before, 0) AS change
        FROM (SELECT event_id, CAST(user_id AS VARCHAR) AS symbol, ts, value AS price,
                     lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events)))"""


def backcast() -> str:
    parts = []
    starts = {
        "day": "DATE '2024-01-31' - k",
        "week": "CAST(date_trunc('week', DATE '2024-01-31' - 7 * k) AS DATE)",
        "month": "CAST(date_trunc('month', DATE '2024-01-31') - to_months(k) AS DATE)",
        "year": "CAST(date_trunc('year', DATE '2024-01-31') - to_years(k) AS DATE)",
    }
    for timeframe, (periods, step, a, b, high, low) in BACKCAST.items():
        parts.append(f"""
  SELECT symbol, name, '{timeframe}' AS timeframe, CAST({starts[timeframe]} AS DATE) AS time_index,
         {rnd("o", 4)} AS open_price, {rnd(f"greatest(o, c) * {high}", 4)} AS high_price,
         {rnd(f"least(o, c) * {low}", 4)} AS low_price, {rnd("c", 4)} AS close_price, {rnd("c", 4)} AS latest_price,
         'backcast {timeframe}' AS source
  FROM (SELECT *, c * ({a} + (seed % 5) * {b}) AS o
        FROM (SELECT *, greatest({BACKCAST_FLOOR}, base / pow(1 + (seed % 9 - 4) * {step}, k)) AS c
              FROM seeded CROSS JOIN (SELECT CAST(unnest(range(1, {(periods or 5) + 1})) AS INTEGER) AS k)))""")
    own = ", ".join(f"{rnd(i, 4)} AS {i}" for i in INDICATORS)
    return f"""seeded AS (
  SELECT symbol, name, coalesce(latest_price, close_price, open_price) AS base,
         list_sum([ascii(x) FOR x IN string_split(symbol, '')]) AS seed FROM quotes)
{" UNION ALL ".join(parts)}
UNION ALL SELECT symbol, name, timeframe, time_index, {own}, 'quote' AS source FROM quotes"""


TWO_SOURCES = f"""reversed AS (SELECT symbol, ts, -seq AS seq, price FROM po),
{bars("rbars", "reversed")}, {bars("ebars", "pe")},
two AS (
  SELECT l.*, name, 'orders' AS source FROM ({long("bars")}) l JOIN prof USING (symbol)
  UNION ALL SELECT l.*, name, 'orders reversed' AS source
  FROM ({long("rbars")}) l JOIN prof USING (symbol)
  UNION ALL SELECT l.*, c_name AS name, 'events' AS source
  FROM ({long("ebars")}) l JOIN customer ON CAST(c_custkey AS VARCHAR) = l.symbol)"""
TWO = [PO, PE, NATIONS, PO_BARS, TWO_SOURCES]
SUMMARY_COLUMNS = (
    "symbol, name, category, timeframe, time_index, close_price, price_change_pct, price_trend, volatility_level"
)
LATEST = """latest AS (SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time_index DESC) AS place FROM silver WHERE timeframe = 'week')
  WHERE place = 1)"""


def null_counts(layer: str, table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM {table}"
        for c in columns
    )


FACT = f"fact AS (SELECT id, timeframe, time_index, {P5}, {FEATURE_LIST} FROM silver JOIN dim USING (symbol))"


LAST_ORDERS = "SELECT * FROM lineitem WHERE l_orderkey >= (SELECT CAST(floor(quantile_cont(l_orderkey, 0.9)) AS BIGINT) FROM lineitem)"

STREAM_LATE = """
WITH landed AS (
    SELECT event_id, CAST(user_id AS VARCHAR) AS symbol, ts, value AS price, event_id % 4 AS batch FROM events
), latest AS (
    SELECT batch, max(ts) AS latest FROM landed GROUP BY batch
), marks AS (
    SELECT batch, max(latest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 DAY AS mark
    FROM latest
)
SELECT l.event_id, l.symbol, l.ts, l.price, l.batch FROM landed l JOIN marks m ON l.batch = m.batch
WHERE CAST(CAST(l.ts AS DATE) + 1 AS TIMESTAMP) <= m.mark
"""


def oracle_sql() -> dict[str, str]:
    names = ", ".join(f"({i}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')" for i, (k, v) in enumerate(CANONICAL_NAMES.items()))
    sql = {
        "candle_explode": q(
            PO, bars("days", "po", ["day"]),
            select="SELECT symbol, time_index AS ts, open_price AS open, high_price AS high, low_price AS low, close_price AS close FROM days",
        ),
        "quote_snapshot": q(PE, PE_DAYS, BOARD, QUOTES, select="SELECT * FROM quotes"),
        "profile_fallback": f"""WITH s AS (
  SELECT CAST(c_custkey AS VARCHAR) AS symbol FROM customer UNION SELECT 'S' || s_suppkey FROM supplier),
pay AS (SELECT CAST(c_custkey AS VARCHAR) AS symbol,
    CASE WHEN c_acctbal > 0 THEN c_name WHEN c_acctbal > -500 THEN 'T' || c_custkey END AS name,
    CASE WHEN c_acctbal > 0 THEN c_mktsegment WHEN c_acctbal > -500 THEN n_name END AS category
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT s.symbol, coalesce(pay.name, p_name, s.symbol) AS name,
       coalesce(pay.category, p_type, '{PROFILE_CATEGORY}') AS category
FROM s LEFT JOIN pay USING (symbol) LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = s.symbol""",
        "json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
        "conform_long": q(
            PO, PO_BARS, NATIONS,
            select=f"""SELECT symbol, CASE WHEN timeframe = 'year' THEN '' ELSE name END AS name, indicator, timeframe,
  time_index, CASE WHEN indicator <> 'latest_price' THEN value END AS value, 'orders' AS source
  FROM ({long("bars")}) JOIN prof USING (symbol)""",
        ),
        "history_window": q(
            PO, "recent AS (SELECT * FROM po WHERE ts BETWEEN DATE '1997-01-01' AND DATE '2001-08-01')",
            select=bar_select("recent", "day"),
        ),
        "gold_prices_scan": q(SILVER, select="SELECT * FROM silver"),
        "gold_predictions_scan": both_scopes("SELECT * FROM predictions"),
        "bronze_rows": q(
            PO, PO_BARS, NATIONS,
            select=f"SELECT l.*, name, 'orders' AS source FROM ({long('bars')}) l JOIN prof USING (symbol)",
        ),
        "silver_rows": q(SILVER, select="SELECT * FROM silver"),
        "gold_fact_rows": q(SILVER, DIM, FACT, select="SELECT * FROM fact"),
        "dim_symbol": q(
            PE, PE_DAYS,
            select="""SELECT row_number() OVER (ORDER BY symbol) AS id, * FROM (
  SELECT DISTINCT symbol, c_name AS name, c_mktsegment AS category
  FROM days JOIN customer ON CAST(c_custkey AS VARCHAR) = symbol)""",
        ),
        "ohlc_day": q(PE, select=bar_select("pe", "day")),
        "ohlc_week": q(PO, select=bar_select("po", "week")),
        "ohlc_month": q(PO, select=bar_select("po", "month")),
        "ohlc_year": q(PO, select=bar_select("po", "year")),
        "ohlc_all": q(PO, PO_BARS, select="SELECT * FROM bars"),
        "ohlc_month_parts": q(
            PL, bars("bars", "pl", ["month"]),
            select="SELECT symbol, timeframe, time_index, " + ", ".join(f"{rnd(i, 4)} AS {i}" for i in INDICATORS) + " FROM bars",
        ),
        "bars_unpivot": q(PO, PO_BARS, select=long("bars")),
        "union_sources": q(*TWO, select="SELECT * FROM two"),
        "bars_pivot": q(
            *TWO,
            select=f"""SELECT {KEY}, """ + ", ".join(
                f"arg_max(value, (CASE WHEN source = 'orders reversed' THEN 1 ELSE 0 END, source, value)) "
                f"FILTER (WHERE indicator = '{i}') AS {i}" for i in INDICATORS
            ) + f" FROM two GROUP BY {KEY}",
        ),
        "series_long": q(PO, PO_BARS, select=long("bars")),
        "drop_missing_price": q(
            PO, PE, PO_BARS, bars("ebars", "pe"),
            select=f"SELECT * FROM ebars WHERE close_price <> 0 UNION ALL SELECT * FROM bars",
        ),
        "canonical_names": q(
            PO, PO_BARS, f"names(i, code, canonical) AS (VALUES {names})",
            select="""SELECT CASE WHEN timeframe = 'day' THEN bars.symbol ELSE code END AS symbol,
  CASE WHEN timeframe = 'day' THEN bars.symbol ELSE canonical END AS name, timeframe, time_index, close_price
  FROM bars JOIN nation ON n_name = bars.symbol JOIN names ON i = n_nationkey""",
        ),
        "category_map": q(
            PO, PO_BARS, NATIONS,
            select=f"""SELECT {KEY}, close_price, CASE WHEN category = 'AFRICA' THEN '{FALLBACK_CATEGORY}' ELSE category END AS category
  FROM bars JOIN prof USING (symbol)""",
        ),
        "price_movement": q(PO, PO_BARS, movement("bars"), select="SELECT * FROM moved"),
        "volatility": q(PO, PO_BARS, ranged("bars"), select="SELECT * FROM ranged"),
        "category_avg": q(PO, PO_BARS, NATIONS, CBARS, CATEGORY_AVG, select="SELECT * FROM cavg"),
        "category_avg_join": q(
            PO, PO_BARS, NATIONS, CBARS, CATEGORY_AVG,
            select="SELECT * FROM cbars JOIN cavg USING (category, timeframe, time_index)",
        ),
        "category_avg_window": q(
            PL, bars("bars", "pl"),
            "prof AS (SELECT CAST(p_partkey AS VARCHAR) AS symbol, p_type AS category FROM part)",
            f"cbars AS (SELECT bars.*, coalesce(category, '{FALLBACK_CATEGORY}') AS category FROM bars LEFT JOIN prof USING (symbol))",
            select=f"""SELECT {KEY}, category, {rnd("CAST(total AS DOUBLE) / category_count", 4)} AS category_avg_close, category_count
  FROM (SELECT *, sum(CAST(CAST(close_price AS VARCHAR) AS DECIMAL(28,8))) OVER w AS total, count(*) OVER w AS category_count
        FROM cbars WINDOW w AS (PARTITION BY category, timeframe, time_index))""",
        ),
        "trend_distribution": q(
            PO, PO_BARS, movement("bars"), select="SELECT price_trend, count(*) AS n FROM moved GROUP BY price_trend"
        ),
        "enriched_bars": q(SILVER, select="SELECT * FROM silver"),
        "list_symbols": q(PO, PO_BARS, NATIONS, DIM, select="SELECT id, symbol, name, category FROM dim"),
        "categories": q(PO, PO_BARS, NATIONS, DIM, select="SELECT DISTINCT category FROM dim"),
        "prices_filtered": q(
            SILVER,
            select="SELECT * FROM silver WHERE category = 'ASIA' AND price_trend = 'up' AND volatility_level = 'high'",
        ),
        "prices_for_symbol": q(SILVER, select="SELECT * FROM silver WHERE symbol = 'NATION_7'"),
        "predictions_for_symbol": both_scopes(
            "SELECT * FROM predictions WHERE symbol = 'NATION_7' AND model_name = 'holt_smoothing'"
        ),
        "category_prices": q(SILVER, select=f"SELECT {SUMMARY_COLUMNS} FROM silver WHERE category = 'ASIA'"),
        "top_n": q(
            SILVER,
            select=f"""SELECT {SUMMARY_COLUMNS}, intraday_range_pct FROM silver WHERE intraday_range_pct IS NOT NULL
  ORDER BY intraday_range_pct DESC, symbol, timeframe, time_index LIMIT 25""",
        ),
        "compare_symbols": q(
            SILVER,
            select=f"SELECT {SUMMARY_COLUMNS} FROM silver WHERE symbol IN ('NATION_3', 'NATION_11', 'NATION_20')",
        ),
        "compare_many": q(
            SILVER,
            select=f"SELECT {SUMMARY_COLUMNS} FROM silver WHERE CAST(substr(symbol, 8) AS INTEGER) < 22",
        ),
        "dashboard_filter": q(
            SILVER,
            select="""SELECT * FROM silver WHERE timeframe = 'month' AND category IN ('ASIA', 'EUROPE')
  AND time_index >= DATE '1997-03-01' AND time_index <= DATE '1999-06-30' AND regexp_matches(symbol, 'nation_.?2', 'i')""",
        ),
        "default_compare": q(
            SILVER,
            select="SELECT * FROM silver WHERE timeframe = 'week' AND symbol IN (SELECT DISTINCT symbol FROM silver ORDER BY symbol LIMIT 4)",
        ),
        "search_symbols": q(
            SILVER,
            select=f"SELECT {KEY}, name, close_price FROM silver WHERE timeframe = 'week' AND (regexp_matches(symbol, 'nation_1.?$', 'i') OR regexp_matches(name, 'nation_1.?$', 'i'))",
        ),
        "search_count": q(
            SILVER,
            select="SELECT count(DISTINCT symbol) AS n_symbols FROM silver WHERE timeframe = 'week' AND (regexp_matches(symbol, 'nation_1.?$', 'i') OR regexp_matches(name, 'nation_1.?$', 'i'))",
        ),
        "date_range_filter": q(
            SILVER, select="SELECT * FROM silver WHERE timeframe = 'day' AND time_index BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"
        ),
        "date_domain": q(
            SILVER,
            select="""SELECT min_date, CASE WHEN min_date = max_date THEN max_date + 1 ELSE max_date END AS max_date
  FROM (SELECT min(time_index) AS min_date, max(time_index) AS max_date FROM silver WHERE timeframe = 'week')""",
        ),
        "latest_snapshot": q(SILVER, LATEST, select="SELECT * FROM latest"),
        "kpi_summary": q(
            SILVER, LATEST,
            select=f"""SELECT {rnd(mean("close_price"), 4)} AS avg_close, {rnd(mean("price_change_pct"), 4)} AS avg_change_pct,
  count(*) FILTER (WHERE price_change_pct > 0) AS n_rising, count(*) FILTER (WHERE price_change_pct < 0) AS n_falling,
  count(*) FILTER (WHERE volatility_level = 'high') AS n_high_volatility, count(*) AS n_symbols FROM latest""",
        ),
        "sector_breakdown": q(
            SILVER, LATEST, select="SELECT category, count(symbol) AS n_symbols FROM latest GROUP BY category"
        ),
        "forecast_spread": both_scopes(
            f"""SELECT {SKEY}, model_name, fit_scope, predicted_time,
  {rnd("(confidence_high - confidence_low) / nullif(predicted_value, 0) * 100", 4)} AS spread_pct FROM predictions"""
        ),
        "forecast_bridge": recursive(
            models(FULL),
            "hist AS (SELECT time_index AS time, close_price AS value FROM bars WHERE symbol = 'NATION_7' AND timeframe = 'month')",
            f"""ahead AS (SELECT * FROM smooth WHERE symbol = 'NATION_7' AND timeframe = 'month' AND indicator = 'close_price')""",
            f"""parts AS (
  SELECT 'history' AS part, time, value, NULL::DOUBLE AS confidence_low, NULL::DOUBLE AS confidence_high FROM hist
  UNION ALL (SELECT 'bridge', time, value, value, value FROM hist WHERE EXISTS (FROM ahead) ORDER BY time DESC LIMIT 1)
  UNION ALL SELECT 'forecast', predicted_time, predicted_value, confidence_low, confidence_high FROM ahead)""",
            select=f"SELECT *, {rnd('(confidence_high - confidence_low) / nullif(value, 0) * 100', 4)} AS spread_pct FROM parts",
        ),
        "tick_change": q(TICK_CHANGE, select="SELECT * EXCLUDE (event_id) FROM changes"),
        "recent_ticks": q(PE, select="SELECT symbol, ts, price FROM pe ORDER BY ts DESC, symbol DESC LIMIT 240"),
        "recent_ticks_per_symbol": q(
            PE,
            select="""SELECT symbol, ts, price FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS place FROM pe) WHERE place <= 5""",
        ),
        "quote_fallback": q(
            PE, PE_DAYS,
            select="""SELECT symbol, coalesce(nullif(nullif(latest_price, high_price), 0), nullif(close_price, 0), 0) AS live_price,
  open_price AS open, high_price AS high, low_price AS low, close_price AS previous_close FROM days""",
        ),
        "day_change": q(PE, PE_DAYS, BOARD, select="SELECT * FROM board"),
        "live_counts": q(
            PE, PE_DAYS, BOARD,
            select="""SELECT count(*) AS n_symbols, count(*) FILTER (WHERE direction = 'up') AS n_up,
  count(*) FILTER (WHERE direction = 'down') AS n_down, count(*) FILTER (WHERE direction = 'flat') AS n_flat FROM board""",
        ),
        "series_index": q(SERIES, select=f"SELECT {SKEY}, t, time_index, value FROM points"),
        "series_counts": q(
            SERIES,
            select=f"""SELECT timeframe, count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols,
  count(DISTINCT indicator) AS n_indicators, count(DISTINCT (symbol, indicator)) AS n_series FROM points GROUP BY timeframe""",
        ),
        "eligible_series": q(
            PE, bars("bars", "pe"), POINTS,
            select=f"SELECT {SKEY}, count(*) AS n FROM points GROUP BY {SKEY} HAVING count(*) >= {MIN_OBS}",
        ),
        "holdout_split": q(
            SERIES,
            select=f"SELECT {SKEY}, time_index, value, CASE WHEN n > 3 AND t >= n - 3 THEN 'test' ELSE 'train' END AS part FROM points",
        ),
        "ols_fit": q(
            SERIES, ALL_POINTS, OLS,
            select=f"SELECT {SKEY}, n, {rnd('beta0', 4)} AS beta0, {rnd('beta1', 4)} AS beta1, {rnd('sqrt(s2)', 4)} AS residual_sd FROM ols",
        ),
        "linear_trend_forecast": q(SERIES, ALL_POINTS, OLS, LINEAR_ROWS, select="SELECT * FROM linear"),
        "forecast_dates": q(
            SERIES, FULL, f"means AS (SELECT {SKEY}, max(time_index) AS last FROM train GROUP BY {SKEY})",
            select=f"SELECT {SKEY}, CAST({PROJECTED} AS DATE) AS predicted_time FROM means CROSS JOIN {STEPS}",
        ),
        "holt_fit": recursive(
            SERIES, ALL_POINTS, HOLT,
            select=f"SELECT {SKEY}, n, alpha, beta, phi, {rnd('level', 4)} AS level, {rnd('trend', 4)} AS trend, {rnd('rmse', 4)} AS rmse FROM holt",
        ),
        "holt_forecast": recursive(SERIES, ALL_POINTS, HOLT, HOLT_ROWS, select="SELECT * FROM smooth"),
        "forecast_all": recursive(models(FULL), select="SELECT * FROM preds"),
        "holdout_metrics": recursive(models(train(1)), SCORES, select="SELECT * FROM scores"),
        "backtest_summary": recursive(models(train(1)), SCORES, SUMMARY, select="SELECT * FROM summary"),
        "regression_metrics": recursive(
            models(train(3)), SCORES,
            select=f"SELECT model_name, timeframe, {errors('actual', 'predicted_value')} FROM scores GROUP BY model_name, timeframe",
        ),
        "evaluate_models": recursive(models(train(1)), EVALUATION, select="SELECT * FROM report"),
        "model_report": recursive(
            models(train(1)), EVALUATION,
            select=f"SELECT model_name, {rnd('avg(mae)', 4)} AS avg_mae, {rnd('avg(rmse)', 4)} AS avg_rmse, {rnd('avg(r2)', 4)} AS avg_r2 FROM report GROUP BY model_name",
        ),
        "run_metrics": recursive(
            models(train(1)), SCORES, SUMMARY,
            f"""fitted AS (SELECT model_name, timeframe, count(DISTINCT (symbol, indicator)) AS n_series_fitted,
  count(*) AS n_predictions FROM preds GROUP BY model_name, timeframe)""",
            f"""total AS (SELECT timeframe, count(DISTINCT (symbol, indicator)) AS n_series_total,
  count(DISTINCT symbol) AS n_symbols FROM points GROUP BY timeframe)""",
            select=f"""SELECT model_name, timeframe, CAST({HORIZON} AS BIGINT) AS horizon, CAST({MIN_OBS} AS BIGINT) AS min_obs,
  CAST(1 AS BIGINT) AS test_size, n_symbols, CAST({len(INDICATORS)} AS BIGINT) AS n_indicators, '{",".join(INDICATORS)}' AS indicators,
  n_series_total, n_series_fitted, n_predictions, avg_mae, avg_rmse, avg_mape, avg_r2
  FROM fitted JOIN total USING (timeframe) LEFT JOIN summary USING (model_name, timeframe)""",
        ),
        "symbols_without_history": """SELECT CAST(c_custkey AS VARCHAR) AS symbol, c_name AS name, c_mktsegment AS category
FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
        "backcast_history": f"WITH {PE}, {PE_DAYS}, {BOARD}, {QUOTES}, {backcast()}",
        "dq_dim_unique": "SELECT p_name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1",
        "dq_fact_unique": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
        "dq_fk_orphans": """SELECT l_partkey, count(*) AS n FROM lineitem
WHERE l_partkey NOT IN (SELECT c_custkey FROM customer) GROUP BY l_partkey""",
        "dq_nulls": "SELECT * FROM (" + q(
            SILVER, DIM, FACT, f"bronze AS (SELECT symbol, indicator, timeframe, time_index FROM ({long('bars')}))",
            select=" UNION ALL ".join(
                [null_counts(t, t, NOT_NULL[t]) for t in ("bronze", "silver", "dim", "fact")]
                + [null_counts("fact optional", "fact", ["price_change", "price_change_pct"])]
            ),
        ) + ") UNION ALL SELECT * FROM (" + both_scopes(
            null_counts("predictions", "keyed", NOT_NULL["predictions"]),
            ", keyed AS (SELECT id, predictions.* FROM predictions JOIN dim USING (symbol))",
        ) + ")",
        "dq_warehouse": both_scopes(
            """SELECT 'dim symbol' AS check_name, 'NATION_7' AS key, CAST(2 AS BIGINT) AS n
UNION ALL SELECT 'fact key', concat_ws('|', id, 'year', time_index), 2 FROM years WHERE id = 1
UNION ALL SELECT 'fact id', '-1', count(*) FROM years WHERE id = 2
UNION ALL SELECT 'prediction id', '-1', count(*) FROM predictions JOIN dim USING (symbol) WHERE id = 2 AND timeframe = 'year'""",
            ", years AS (SELECT id, time_index FROM bars JOIN dim USING (symbol) WHERE timeframe = 'year')",
        ),
        "cleaning_counts": q(
            PO, PO_BARS,
            select=f"""SELECT 'landed rows' AS step, count(*) AS rows FROM ({long("bars")})
UNION ALL SELECT unnest(['bars', 'bars with a price', 'enriched bars']), count(*) FROM bars""",
        ),
        "csv_export": both_scopes(
            f"""SELECT {SKEY}, model_name, predicted_time, predicted_value, confidence_low, confidence_high
FROM predictions WHERE fit_scope = 'holdout'"""
        ),
        "live_quote": q(PE, PE_DAYS, BOARD, QUOTES, select="SELECT * FROM quotes WHERE symbol = '7'"),
        "legacy_names": q(
            PO, PO_BARS, select="SELECT *, symbol AS name, 'Other' AS category FROM bars"
        ),
        "nan_prices": "SELECT CAST(user_id AS VARCHAR) AS symbol, ts, nullif(value, 0) AS price FROM events",
        "local_ticks": """SELECT CAST(user_id AS VARCHAR) AS symbol, ts - INTERVAL 5 HOUR AS ts, value AS price
FROM events""",
        "bars_without_prices": q(
            PO, PO_BARS,
            select=f"""SELECT {KEY}, open_price, CAST(NULL AS DOUBLE) AS price_change, CAST(NULL AS DOUBLE) AS price_change_pct,
  CAST(NULL AS VARCHAR) AS price_trend, CAST(NULL AS DOUBLE) AS intraday_range,
  CAST(NULL AS DOUBLE) AS intraday_range_pct, CAST(NULL AS VARCHAR) AS volatility_level FROM bars""",
        ),
        "stream_day_bars": q(PE, select=bar_select("pe", "day")),
        "stream_week_bars": q(PE, select=bar_select("pe", "week")),
        "stream_rollup": q(PE, bars("bars", "pe", ["month", "year"]), select="SELECT * FROM bars"),
        "stream_late": STREAM_LATE,
        "stream_closed": q(PE, select=f"""SELECT * FROM ({bar_select("pe", "day")}) WHERE CAST(time_index + 1 AS TIMESTAMP)
            <= (SELECT max(ts) - INTERVAL 1 DAY FROM events WHERE value IS NOT NULL AND NOT isnan(value))"""),
        "dq_lengths": """SELECT 'c_name' AS column_name, CAST(count(*) FILTER (WHERE length(c_name) > 10) AS BIGINT) AS n_too_long FROM customer
            UNION ALL SELECT 'c_mktsegment', CAST(count(*) FILTER (WHERE length(c_mktsegment) > 9) AS BIGINT) FROM customer""",
        "first_lines": """SELECT symbol, timeframe, time_index, line, "order", price, quantity FROM (
            SELECT *, row_number() OVER (PARTITION BY "order" ORDER BY price, symbol, time_index, line, quantity) AS place FROM (
                SELECT CAST(l_partkey AS VARCHAR) AS symbol, 'day' AS timeframe, CAST(l_shipdate AS DATE) AS time_index,
                    l_linenumber AS line, l_orderkey AS "order", l_extendedprice / nullif(l_quantity, 0) AS price,
                    l_quantity AS quantity FROM lineitem)) WHERE place = 1""",
        "model_lookup": both_scopes("SELECT * FROM predictions WHERE timeframe = 'week' AND model_name = 'holt_smoothing'"),
        "no_forecasts_yet": q(PO, PO_BARS, NATIONS, DIM, select="SELECT symbol, CAST(0 AS BIGINT) AS n FROM dim"),
        "dq_load_unique": f"""WITH last AS ({LAST_ORDERS}) SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem
            WHERE (l_partkey, l_suppkey) IN (SELECT (l_partkey, l_suppkey) FROM last) GROUP BY ALL HAVING count(*) > 1""",
        "dq_load_orphans": f"""WITH last AS ({LAST_ORDERS}) SELECT l_partkey, count(*) AS n FROM last
            WHERE l_partkey NOT IN (SELECT c_custkey FROM customer) GROUP BY l_partkey""",
        "ohlc_hour_ties": """SELECT event_type AS symbol, 'day' AS timeframe, CAST(ts AS DATE) AS time_index,
            first(value ORDER BY date_trunc('hour', ts), event_id) AS open_price, max(value) AS high_price,
            min(value) AS low_price, last(value ORDER BY date_trunc('hour', ts), event_id) AS close_price,
            last(value ORDER BY date_trunc('hour', ts), event_id) AS latest_price
            FROM events WHERE value IS NOT NULL GROUP BY event_type, CAST(ts AS DATE)""",
        "stream_board": q(PE, PE_DAYS, BOARD, select="SELECT * FROM board"),
        "stream_tick_change": q(TICK_CHANGE, select="SELECT * FROM changes"),
        "stream_distinct": "SELECT event_id, CAST(user_id AS VARCHAR) AS symbol, ts, value AS price FROM events",
    }
    return sql
