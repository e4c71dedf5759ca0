"""DuckDB statements equal to the registered queries, over the driver tables
registered as views. Used only as a correctness oracle; nothing here runs in
the Spark path.

Shared pieces are common table expressions; each query is ``WITH`` the
pieces it needs plus its final ``SELECT``.
"""

from __future__ import annotations

import math

from tidecast.models.selection import FAMILY_PRIORITY
from tidecast.plans import catalog as cat
from tidecast.plans import features as fe
from tidecast.sources.retail import DAY_ORIGIN, EVENTS_1, EVENTS_2, SNAP_DAYS

CUT = f"DATE '{cat.FORECAST_CUTOFF}'"
LAGS = fe.LAG_COLS


def _case(table: dict, slot: int) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v[slot]}'" for k, v in table.items())
    return f"CASE strftime(date, '%m-%d') {arms} END"


LINES = f"""lines AS (
  SELECT r.r_name AS store_id, p.p_type AS dept_id,
         CAST(date_diff('day', DATE '{DAY_ORIGIN}', CAST(l.l_shipdate AS DATE)) + 1 AS INTEGER) AS day,
         l.l_quantity * p.p_retailprice AS sales
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

DAILY0 = f"""daily0 AS (
  SELECT store_id, dept_id, day, CAST(DATE '{DAY_ORIGIN}' + (day - 1) AS DATE) AS date, sum(sales) AS sales
  FROM lines GROUP BY store_id, dept_id, day)"""

_snaps = ",\n         ".join(
    f"CAST(CASE WHEN dayofmonth(date) IN ({', '.join(map(str, days))}) THEN 1 ELSE 0 END AS INTEGER) AS {name}"
    for name, days in SNAP_DAYS.items())

DAILY = f"""daily AS (
  SELECT store_id, dept_id, day, date,
         'd_' || CAST(day AS VARCHAR) AS d,
         CAST(floor(day / 7) AS INTEGER) + 1 AS wm_yr_wk,
         dayname(date) AS weekday,
         CAST((dayofweek(date) + 1) % 7 + 1 AS INTEGER) AS wday,
         CAST(month(date) AS INTEGER) AS month,
         CAST(year(date) AS INTEGER) AS year,
         {_case(EVENTS_1, 0)} AS event_name_1,
         {_case(EVENTS_1, 1)} AS event_type_1,
         {_case(EVENTS_2, 0)} AS event_name_2,
         {_case(EVENTS_2, 1)} AS event_type_2,
         {_snaps},
         sales
  FROM daily0)"""

LOGGED = """logged AS (
  SELECT * EXCLUDE (sales, sales2), sales2 AS sales, CASE WHEN sales2 > 0 THEN ln(sales2) END AS LogSales
  FROM (SELECT *, CASE WHEN sales = 0 THEN 0.5 ELSE sales END AS sales2 FROM daily))"""

_lag_exprs = ",\n         ".join(f"lag(LogSales, {i}) OVER w AS {c}" for i, c in enumerate(LAGS, 1))
LAGGED = f"""lagged AS (
  SELECT *,
         {_lag_exprs}
  FROM logged WINDOW w AS (PARTITION BY dept_id, store_id ORDER BY day))"""

_fill = ",\n         ".join(f"coalesce({c}, avg({c}) OVER ()) AS {c}" for c in LAGS)
IMPUTED = f"""imputed AS (
  SELECT * EXCLUDE ({', '.join(LAGS)}),
         {_fill}
  FROM lagged)"""

RANKED = """ranked AS (SELECT *, percent_rank() OVER (ORDER BY day) AS rank FROM logged)"""


def _index_ctes() -> list[str]:
    """Label order of a string index: frequency descending, then label."""
    ctes = []
    for c in fe.STRING_COLS:
        ctes.append(f"""idx_{c} AS (
  SELECT v, CAST(row_number() OVER (ORDER BY cnt DESC, v) - 1 AS DOUBLE) AS i,
         CAST(count(*) OVER () AS DOUBLE) AS n
  FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS cnt FROM imputed WHERE {c} IS NOT NULL GROUP BY 1))""")
    joins = "\n  ".join(f"LEFT JOIN idx_{c} ON CAST(f.{c} AS VARCHAR) = idx_{c}.v" for c in fe.STRING_COLS)
    cols = ",\n         ".join(
        f"coalesce(idx_{c}.i, (SELECT count(*) FROM idx_{c})) AS {c}_indexed" for c in fe.STRING_COLS)
    ctes.append(f"""indexed AS (
  SELECT f.*,
         {cols}
  FROM imputed f
  {joins})""")
    return ctes


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


FEATURE_BASE = [LINES, DAILY0, DAILY]
LOG_BASE = FEATURE_BASE + [LOGGED]


def _r(expr: str, digits: int, alias: str | None = None) -> str:
    return f"round({expr}, {digits}) AS {alias or expr}"


def _keys(prefix: str = "") -> str:
    return ", ".join(f"{prefix}{k}" for k in cat.KEYS)


def _encoded_entries() -> str:
    n1 = "(SELECT count(*) FROM idx_event_name_1)"
    numeric = ["day", "wday", "month", "snap_CA", "snap_TX", "snap_WI", *LAGS,
               "dept_id_indexed", "store_id_indexed"]
    parts = [f"SELECT {_keys()}, {slot} AS slot, CAST({c} AS DOUBLE) AS value FROM indexed"
             for slot, c in enumerate(numeric)]
    base = len(numeric)
    parts.append(f"SELECT {_keys()}, CAST({base} + i AS INTEGER) AS slot, "
                 f"CAST(event_name_1_indexed = i AS DOUBLE) AS value FROM indexed, idx_event_name_1")
    parts.append(f"SELECT {_keys()}, CAST({base} + {n1} + i AS INTEGER) AS slot, "
                 f"CAST(event_type_1_indexed = i AS DOUBLE) AS value FROM indexed, idx_event_type_1")
    return "\nUNION ALL\n".join(parts)


FORECAST = [
    f"""fc_train AS (
  SELECT store_id, dept_id, CAST(day AS DOUBLE) AS t, LogSales AS y, dayofweek(date) AS dow
  FROM logged WHERE date <= {CUT} AND LogSales IS NOT NULL)""",
    """fc_trend AS (
  SELECT store_id, dept_id, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept
  FROM fc_train GROUP BY store_id, dept_id)""",
    """fc_week AS (
  SELECT tr.store_id, tr.dept_id, tr.dow, avg(tr.y - (c.intercept + c.slope * tr.t)) AS effect
  FROM fc_train tr JOIN fc_trend c ON tr.store_id = c.store_id AND tr.dept_id = c.dept_id
  GROUP BY tr.store_id, tr.dept_id, tr.dow)""",
    f"""fc AS (
  SELECT l.store_id, l.dept_id, l.day, l.LogSales,
         c.intercept + c.slope * CAST(l.day AS DOUBLE) + coalesce(w.effect, 0.0) AS yhat
  FROM logged l
  LEFT JOIN fc_trend c ON l.store_id = c.store_id AND l.dept_id = c.dept_id
  LEFT JOIN fc_week w ON l.store_id = w.store_id AND l.dept_id = w.dept_id AND w.dow = dayofweek(l.date)
  WHERE l.date > {CUT})""",
    f"""naive AS (
  SELECT a.store_id, a.dept_id, a.day, a.LogSales, p.LogSales AS yhat
  FROM logged a LEFT JOIN logged p
    ON p.store_id = a.store_id AND p.dept_id = a.dept_id AND p.day = a.day - 7
  WHERE a.date > {CUT})""",
    """common_rows AS (
  SELECT fc.store_id, fc.dept_id, fc.day, fc.LogSales, fc.yhat AS trend, naive.yhat AS naive
  FROM fc JOIN naive ON naive.store_id = fc.store_id AND naive.dept_id = fc.dept_id AND naive.day = fc.day
  WHERE fc.LogSales IS NOT NULL AND fc.yhat IS NOT NULL AND naive.yhat IS NOT NULL)""",
    """scored AS (
  SELECT 'trend_weekday' AS model, 'series' AS family, store_id, LogSales, trend AS yhat FROM common_rows
  UNION ALL
  SELECT 'seasonal_naive' AS model, 'baseline' AS family, store_id, LogSales, naive AS yhat FROM common_rows)""",
    """scores AS (
  SELECT model, family, store_id,
         sqrt(avg(CASE WHEN LogSales IS NOT NULL AND yhat IS NOT NULL THEN (LogSales - yhat) ^ 2 END)) AS rmse,
         count(yhat) AS n
  FROM scored GROUP BY model, family, store_id)""",
]

_PRIORITY = " ".join(f"WHEN '{k}' THEN {v}" for k, v in FAMILY_PRIORITY.items())

MEASURE_UNION = "\nUNION ALL\n".join(
    f"SELECT l_orderkey, l_linenumber, '{m}' AS variable, {m} AS value FROM lineitem" for m in cat.MEASURES)
TOTALS_UNION = "\nUNION ALL\n".join(
    f"SELECT o_orderkey, '{m}' AS measure, {m} AS order_total FROM totals" for m in cat.MEASURES)

LABELLED = """SELECT d.doc_id, lang, source, n_chars, quality, toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""

# The wide job summed directly: a price is known for every week (of seven days
# from the origin) in which a store sold an item, and holds for all its days.
WIDE_DAILY0 = f"""sold AS (
  SELECT r.r_name AS store_id, p.p_partkey AS item, replace(p.p_brand, '#', '_') AS dept_id, p.p_retailprice AS price,
         date_diff('day', DATE '{DAY_ORIGIN}', CAST(l_shipdate AS DATE)) + 1 AS day, l_quantity AS quantity
  FROM lineitem JOIN part p ON l_partkey = p.p_partkey JOIN supplier s ON l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
axis AS (SELECT unnest(range(min(day), max(day) + 1)) AS day FROM sold),
priced AS (SELECT DISTINCT store_id, item, dept_id, day // 7 + 1 AS week, price + (day // 7 + 1) % 3 AS price FROM sold),
cells AS (SELECT store_id, item, day, sum(quantity) AS quantity FROM sold GROUP BY ALL),
daily0 AS (
  SELECT p.store_id, p.dept_id, CAST(a.day AS INTEGER) AS day,
         CAST(DATE '{DAY_ORIGIN}' + CAST(a.day - 1 AS INTEGER) AS DATE) AS date, sum(coalesce(c.quantity, 0) * p.price) AS sales
  FROM priced p JOIN axis a ON a.day // 7 + 1 = p.week
  LEFT JOIN cells c ON c.store_id = p.store_id AND c.item = p.item AND c.day = a.day
  GROUP BY p.store_id, p.dept_id, a.day)"""

_daily_cols = ("store_id, dept_id, day, d, wm_yr_wk, weekday, wday, month, year, event_name_1, event_type_1, "
               "event_name_2, event_type_2, snap_CA, snap_TX, snap_WI, CAST(date AS VARCHAR) AS date, "
               "round(sales, 2) AS sales")

_FOLDS = ", ".join(f"({i}, DATE '{d}')" for i, d in enumerate(cat.ORIGINS, 1))
BACKTEST = [
    f"origin(fold, cut) AS (VALUES {_FOLDS})",
    """known AS (
  SELECT store_id, dept_id, CAST(day AS DOUBLE) AS t, LogSales AS y, dayofweek(date) AS dow, date,
         (SELECT count(*) FROM origin WHERE cut < date) AS fold
  FROM logged WHERE LogSales IS NOT NULL)""",
    "seen AS (SELECT k.store_id, k.dept_id, t, y, dow, o.fold FROM known k JOIN origin o ON k.date <= o.cut)",
    """line AS (
  SELECT store_id, dept_id, fold, avg(y) AS level, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept
  FROM seen GROUP BY ALL)""",
    """week AS (
  SELECT s.store_id, s.dept_id, s.fold, dow, avg(y - intercept - slope * t) AS effect
  FROM seen s JOIN line l ON l.store_id = s.store_id AND l.dept_id = s.dept_id AND l.fold = s.fold GROUP BY ALL)""",
    """told AS (
  SELECT k.fold, y, level, intercept + slope * t AS trend, intercept + slope * t + coalesce(effect, 0) AS trend_weekday
  FROM known k JOIN line l ON l.store_id = k.store_id AND l.dept_id = k.dept_id AND l.fold = k.fold
  LEFT JOIN week w ON w.store_id = k.store_id AND w.dept_id = k.dept_id AND w.fold = k.fold AND w.dow = k.dow)""",
    "backtest AS (" + " UNION ALL ".join(
        f"SELECT CAST(fold AS INTEGER) AS fold, '{m}' AS model, sqrt(avg((y - {m}) ^ 2)) AS rmse, count(*) AS n "
        f"FROM told WHERE {m} IS NOT NULL GROUP BY fold" for m in ("level", "trend", "trend_weekday")) + ")",
]

# Items and departments over the full axis of days, zeros where nothing sold.
ITEMS = [
    LINES.replace("lines AS (", "lines AS (", 1).replace("p.p_type AS dept_id,", "p.p_type AS dept_id, p.p_partkey AS item_id,"),
    f"cut AS (SELECT date_diff('day', DATE '{DAY_ORIGIN}', {CUT}) + 1 AS day)",
    "train AS (SELECT lines.* FROM lines, cut WHERE lines.day <= cut.day)",
    "axis AS (SELECT unnest(range((SELECT min(day) FROM train), (SELECT day + 1 FROM cut))) AS day)",
    f"ahead AS (SELECT unnest(range(day + 1, day + {cat.HORIZON + 1})) AS day FROM cut)",
    "consts AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(day) AS DOUBLE) AS st, CAST(sum(day * day) AS DOUBLE) AS stt FROM axis)",
    "sale AS (SELECT store_id, dept_id, item_id, day, sum(sales) AS y FROM train GROUP BY ALL)",
    """isum AS (SELECT store_id, dept_id, item_id, sum(y) AS sy, sum(day * y) AS sty, sum(y * y) AS syy FROM sale GROUP BY ALL)""",
    """iline AS (
  SELECT store_id, dept_id, item_id, sy, sty, syy, n, st, (n * sty - st * sy) / (n * stt - st * st) AS slope FROM isum, consts)""",
    """item AS (
  SELECT store_id, dept_id, item_id, ahead.day, (sy - slope * st) / n + slope * ahead.day AS yhat,
         greatest((syy - (sy - slope * st) / n * sy - slope * sty) / n, 0) AS w
  FROM iline, ahead)""",
    "dsale AS (SELECT store_id, dept_id, day, sum(y) AS y FROM sale GROUP BY ALL)",
    """dsum AS (SELECT store_id, dept_id, sum(y) AS sy, sum(day * y) AS sty, sum(y * y) AS syy FROM dsale GROUP BY ALL)""",
    """dline AS (
  SELECT store_id, dept_id, slope, (sy - slope * st) / n AS intercept, (syy - (sy - slope * st) / n * sy - slope * sty) / n AS sse
  FROM (SELECT *, (n * sty - st * sy) / (n * stt - st * st) AS slope FROM dsum, consts))""",
    """residual AS (
  SELECT d.store_id, d.dept_id, a.day % 7 AS dow, avg(coalesce(y, 0) - intercept - slope * a.day) AS effect, count(*) AS k
  FROM dline d JOIN axis a ON true
  LEFT JOIN dsale s ON s.store_id = d.store_id AND s.dept_id = d.dept_id AND s.day = a.day GROUP BY ALL)""",
    """dweight AS (
  SELECT r.store_id, r.dept_id, greatest(greatest(any_value(sse), 0) - sum(k * effect * effect) / any_value(n), 0) AS w0
  FROM residual r JOIN dline d ON d.store_id = r.store_id AND d.dept_id = r.dept_id, consts GROUP BY ALL)""",
    """dept AS (
  SELECT d.store_id, d.dept_id, ahead.day, intercept + slope * ahead.day + coalesce(effect, 0) AS yhat, w0
  FROM dline d JOIN ahead ON true JOIN dweight w ON w.store_id = d.store_id AND w.dept_id = d.dept_id
  LEFT JOIN residual r ON r.store_id = d.store_id AND r.dept_id = d.dept_id AND r.dow = ahead.day % 7)""",
    """whole AS (
  SELECT store_id, dept_id, day, sum(yhat) AS total, sum(w) AS tw, count(*) AS n_items FROM item GROUP BY ALL)""",
    """gap AS (
  SELECT d.store_id, d.dept_id, d.day, d.yhat, d.yhat - total AS e, w0, w0 + tw AS aw, n_items
  FROM dept d JOIN whole w ON w.store_id = d.store_id AND w.dept_id = d.dept_id AND w.day = d.day)""",
    """settled AS (
  SELECT i.store_id, i.dept_id, i.item_id, i.day, i.yhat,
         i.yhat + CASE WHEN aw > 0 THEN w / aw ELSE 1 / n_items END * e AS reconciled
  FROM item i JOIN gap g ON g.store_id = i.store_id AND g.dept_id = i.dept_id AND g.day = i.day)""",
]

# The terms of the Fourier fit, in order.
_TERMS = ["1.0", "(t - o) / 365.25"] + [
    f"{f}(t * {2.0 * math.pi * k / period!r})" for period, order in ((365.25, 10), (7.0, 3))
    for k in range(1, order + 1) for f in ("sin", "cos")]
NORMAL = [
    f"fit AS (SELECT store_id, dept_id, CAST(day AS DOUBLE) AS t, LogSales AS y FROM logged WHERE date <= {CUT} AND LogSales IS NOT NULL)",
    f"""terms AS (
  SELECT store_id, dept_id, y, [{", ".join(_TERMS)}] AS x FROM fit, (SELECT max(t) AS o FROM fit))""",
    f"places AS (SELECT i, j FROM (SELECT unnest(range({len(_TERMS)})) AS i), (SELECT unnest(range({len(_TERMS)})) AS j) WHERE i <= j)",
]


def _split_report() -> str:
    """First-level cuts: equal-width bins of the values that are not 0."""
    inputs = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS input, {i} AS feature, CAST({c} AS DOUBLE) AS x, l_extendedprice / 1000 AS y FROM lineitem"
        for i, c in enumerate(cat.SPLIT_INPUTS))
    return _with(
        f"cell0 AS ({inputs})",
        "mean AS (SELECT avg(l_extendedprice / 1000) AS m FROM lineitem)",
        "ends AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM cell0 WHERE x <> 0 GROUP BY feature)",
        """edge AS (SELECT DISTINCT feature, e FROM (SELECT feature, lo, hi, lo + (hi - lo) * unnest(range(1, 32)) / 32 AS e FROM ends)
  WHERE e < hi)""",
        """edges AS (SELECT feature, list(e ORDER BY e) AS es FROM edge GROUP BY feature)""",
        """cell AS (
  SELECT c.feature, input, y - m AS g, CASE WHEN x = 0 THEN 0 ELSE 1 + len(list_filter(es, lambda e: e < x)) END AS bin
  FROM cell0 c JOIN edges USING (feature), mean)""",
        "hist AS (SELECT feature, input, bin, sum(g) AS g, count(*) AS n FROM cell GROUP BY ALL)",
        """run AS (
  SELECT *, sum(g) OVER w AS gt, sum(n) OVER w AS nt,
         sum(CASE WHEN bin = 0 THEN g ELSE 0 END) OVER w AS gm, sum(CASE WHEN bin = 0 THEN n ELSE 0 END) OVER w AS nm,
         sum(CASE WHEN bin = 0 THEN 0 ELSE g END) OVER (PARTITION BY feature ORDER BY bin) AS gl,
         sum(CASE WHEN bin = 0 THEN 0 ELSE n END) OVER (PARTITION BY feature ORDER BY bin) AS nl
  FROM hist WINDOW w AS (PARTITION BY feature))""",
        """side AS (
  SELECT feature, input, bin, true AS missing_left, gl + gm AS a, nl + nm AS k, gt, nt FROM run WHERE bin > 0
  UNION ALL SELECT feature, input, bin, false, gl, nl, gt, nt FROM run WHERE bin > 0)""",
        """gains AS (
  SELECT *, a * a / (k + 1) + (gt - a) * (gt - a) / (nt - k + 1) - gt * gt / (nt + 1) AS gain
  FROM side WHERE k >= 1 AND nt - k >= 1)""",
        """best AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, bin, missing_left DESC) AS rn FROM gains)""",
    ) + """SELECT input, CAST(bin AS INTEGER) AS bin, missing_left, round(gain, 2) AS gain,
       row_number() OVER (ORDER BY gain DESC, feature) = 1 AS chosen
FROM best WHERE rn = 1"""


SQL: dict[str, str] = {
    "scan_csv": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem""",
    "sink_roundtrip": _with(*FEATURE_BASE)
    + f"SELECT {_keys()}, CAST(date AS VARCHAR) AS date, round(sales, 2) AS sales FROM daily",
    "series_key": "SELECT c_custkey, c_name || '_' || c_mktsegment || '_evaluation' AS id FROM customer",
    "melt": MEASURE_UNION,
    "day_index": "SELECT p_partkey, TRY_CAST(regexp_replace(p_brand, '^Brand#', '') AS INTEGER) AS brand_no FROM part",
    "dept_key": """SELECT p_partkey,
       CASE WHEN len(string_split(p_name, ' ')) >= 2
            THEN string_split(p_name, ' ')[1] || '_' || string_split(p_name, ' ')[2] END AS dept_id
FROM part""",
    "revenue": """SELECT l.l_orderkey, l.l_linenumber, round(l.l_quantity * p.p_retailprice, 2) AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "replace_zero": """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 0.5 ELSE l_discount END AS l_discount,
       l_tax FROM lineitem""",
    "wide_daily_sales": _with(WIDE_DAILY0, DAILY) + f"SELECT {_daily_cols} FROM daily",
    "wide_features": _with(WIDE_DAILY0, DAILY, LOGGED, LAGGED, IMPUTED)
    + f"SELECT {_keys()}, round(LogSales, 6) AS LogSales, " + ", ".join(_r(c, 6) for c in LAGS) + " FROM imputed",
    "scan_csv_by_name": """SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, count(*) AS n_lines,
       round(sum(l_quantity), 2) AS quantity FROM lineitem WHERE l_orderkey % 7 <> 0 GROUP BY 1
UNION ALL SELECT 'rejected', count(*), 0.0 FROM lineitem WHERE l_orderkey % 7 = 0""",
    "join_left_using": LABELLED,
    "null_profile": "SELECT " + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}"
        for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")) + f" FROM ({LABELLED})",
    "join_inner_multikey": _with(
        "totals AS (SELECT l_orderkey AS o_orderkey, "
        + ", ".join(f"sum({m}) AS {m}" for m in cat.MEASURES) + " FROM lineitem GROUP BY l_orderkey)",
        f"line_long AS ({MEASURE_UNION})",
        f"order_long AS ({TOTALS_UNION})",
    ) + """SELECT a.l_orderkey AS okey, a.l_linenumber, a.variable, a.value, round(b.order_total, 4) AS order_total
FROM line_long a JOIN order_long b ON a.l_orderkey = b.o_orderkey AND a.variable = b.measure""",
    "cutoff_split": f"""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
       CASE WHEN CAST(o_orderdate AS DATE) <= {CUT} THEN 'train'
            WHEN CAST(o_orderdate AS DATE) > {CUT} THEN 'test' END AS side
FROM orders""",
    "daily_sales": _with(*FEATURE_BASE) + f"SELECT {_daily_cols} FROM daily",
    "log_sales": _with(*LOG_BASE)
    + f"SELECT {_keys()}, round(sales, 2) AS sales, round(LogSales, 6) AS LogSales FROM logged",
    "lag_features": _with(*LOG_BASE, LAGGED)
    + f"SELECT {_keys()}, " + ", ".join(_r(c, 6) for c in LAGS) + " FROM lagged",
    "impute_mean": _with(*LOG_BASE, LAGGED, IMPUTED)
    + f"SELECT {_keys()}, " + ", ".join(_r(c, 6) for c in LAGS) + " FROM imputed",
    "time_percent_rank": _with(*LOG_BASE, RANKED) + f"SELECT {_keys()}, round(rank, 6) AS rank FROM ranked",
    "split_train": _with(*LOG_BASE, RANKED)
    + f"SELECT {_keys()}, round(LogSales, 6) AS LogSales FROM ranked WHERE rank <= {cat.SPLIT_RATIO}",
    "split_test": _with(*LOG_BASE, RANKED)
    + f"SELECT {_keys()}, round(LogSales, 6) AS LogSales FROM ranked WHERE rank > {cat.SPLIT_RATIO}",
    "string_index": _with(*LOG_BASE, LAGGED, IMPUTED, *_index_ctes())
    + f"SELECT {_keys()}, " + ", ".join(f"{c}_indexed" for c in fe.STRING_COLS) + " FROM indexed",
    "one_hot": _with(*LOG_BASE, LAGGED, IMPUTED, *_index_ctes()) + f"""SELECT {_keys()}, 'event_name_1_encoded' AS feature,
       CAST(i AS INTEGER) AS slot, CAST(event_name_1_indexed = i AS DOUBLE) AS value
FROM indexed, idx_event_name_1
UNION ALL
SELECT {_keys()}, 'event_type_1_encoded' AS feature, CAST(i AS INTEGER) AS slot, CAST(event_type_1_indexed = i AS DOUBLE) AS value
FROM indexed, idx_event_type_1""",
    "encoded_features": _with(*LOG_BASE, LAGGED, IMPUTED, *_index_ctes(), f"entries AS ({_encoded_entries()})")
    + f"SELECT {_keys()}, slot, round(value, 6) AS value FROM entries",
    "forecast_trend": _with(*LOG_BASE, *FORECAST) + f"SELECT {_keys()}, round(yhat, 4) AS yhat FROM fc",
    "join_pred_actual": _with(*LOG_BASE) + f"""SELECT {_keys('a.')}, round(a.LogSales, 6) AS actual, round(p.LogSales, 6) AS yhat
FROM logged a LEFT JOIN logged p ON p.store_id = a.store_id AND p.dept_id = a.dept_id AND p.day = a.day - 7""",
    "rmse_by_model": _with(*LOG_BASE, *FORECAST)
    + "SELECT model, store_id, round(rmse, 6) AS rmse, n FROM scores",
    "select_best_model": _with(*LOG_BASE, *FORECAST) + f"""SELECT store_id, model, family, round(rmse, 6) AS rmse
FROM (SELECT *, row_number() OVER (PARTITION BY store_id
        ORDER BY rmse, CASE family {_PRIORITY} ELSE 99 END, model) AS rn
      FROM scores WHERE rmse IS NOT NULL)
WHERE rn = 1""",
    "hist_gbt_splits": _split_report(),
    "backtest_rmse": _with(*LOG_BASE, *BACKTEST) + "SELECT fold, model, round(rmse, 6) AS rmse, n FROM backtest",
    "trial_choice": _with(*LOG_BASE, *BACKTEST) + """SELECT fold, model, round(rmse, 6) AS loss
FROM (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY rmse, model) AS rn FROM backtest) WHERE rn = 1""",
    "forecast_item": _with(*ITEMS) + """SELECT store_id, dept_id, item_id, CAST(day AS INTEGER) AS day,
       round(yhat, 1) + 0.0 AS yhat, round(reconciled, 1) + 0.0 AS reconciled FROM settled""",
    "forecast_reconciled": _with(*ITEMS) + """SELECT g.store_id, g.dept_id, CAST(g.day AS INTEGER) AS day, round(any_value(g.yhat), 2) + 0.0 AS yhat,
       round(any_value(g.yhat - CASE WHEN aw > 0 THEN w0 / aw ELSE 0 END * e), 2) + 0.0 AS reconciled,
       round(sum(reconciled), 2) + 0.0 AS item_sum, any_value(n_items) AS n_items
FROM gap g JOIN settled s ON s.store_id = g.store_id AND s.dept_id = g.dept_id AND s.day = g.day GROUP BY ALL""",
    "event_percent_rank": "SELECT event_id, round(percent_rank() OVER (ORDER BY ts), 9) AS rank FROM events",
    "label_index": """SELECT label, n, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS index
FROM (SELECT CAST(l_partkey AS VARCHAR) AS label, count(*) AS n FROM lineitem GROUP BY 1)""",
    "fourier_normal_equations": _with(*LOG_BASE, *NORMAL) + """SELECT store_id, dept_id, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
       round(sum(x[i + 1] * x[j + 1]), 4) + 0.0 AS value FROM terms, places GROUP BY ALL
UNION ALL
SELECT store_id, dept_id, CAST(i AS INTEGER), -1, round(sum(x[i + 1] * y), 4) + 0.0
FROM terms, places WHERE j = i GROUP BY ALL""",
}
