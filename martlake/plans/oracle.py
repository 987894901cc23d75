"""DuckDB SQL oracle for the named queries of ``martlake.plans.catalog``.

The SQL states the definitions of SURVEY section 2 over the raw-table mapping
(FIXTURES.md section 3) in another form than the Spark code, so that a match
checks the plans against the definitions.  Queries that begin k-means at random
centres or search the parameters of long series have no entry.
"""

from __future__ import annotations

from martlake.plans.catalog import (
    BATCH_1,
    BATCH_2,
    DECAY_N,
    DRILL_COHORT,
    DRILL_MONTH,
    DRILL_WINDOWED,
    HW_FIXED,
    RFM_START,
    TOP_N,
    W,
    W_ALL,
    W_QUARTERS,
    W_SHORT,
)
from martlake.functions.dates import window_split_day

TS1 = f"TIMESTAMP '{BATCH_1:%Y-%m-%d %H:%M:%S}'"
TS2 = f"TIMESTAMP '{BATCH_2:%Y-%m-%d %H:%M:%S}'"

MAPPING = """
raw_customers AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS name,
         'user' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS email,
         n.n_name AS city, c.c_mktsegment AS segment,
         CAST(DATE '1995-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS DATE) AS signup_date
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
raw_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents,
         CAST(round(p_retailprice * 100) AS BIGINT) * 6 // 10 AS cost_cents
  FROM part),
raw_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'placed' END AS status
  FROM orders),
raw_order_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_partkey AS product_id,
         CAST(round(l_quantity) AS BIGINT) AS quantity,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_cents
  FROM lineitem),
stg_orders AS (
  SELECT order_id, customer_id, status, CAST(order_date AS DATE) AS order_date FROM raw_orders),
sold AS (
  SELECT order_id, product_id, COUNT(product_id) AS pieces, SUM(amount_cents) AS cents
  FROM raw_order_items GROUP BY order_id, product_id),
item_totals AS (
  SELECT order_id, CAST(SUM(pieces) AS BIGINT) AS num_items, SUM(cents) AS total_revenue_cents FROM sold GROUP BY order_id),
fct_orders AS (
  SELECT order_id, customer_id, order_date, status, ifnull(num_items, 0) AS quantity,
         CAST(CAST(ifnull(total_revenue_cents, 0) AS DOUBLE) / 100.0 AS DECIMAL(18,2)) AS revenue_euro
  FROM stg_orders LEFT JOIN item_totals USING (order_id)),
dim_products AS (
  SELECT product_id, product_name, category,
         CAST(CAST(price_cents AS DOUBLE) / 100.0 AS DECIMAL(18,2)) AS price_euro,
         CAST(CAST(cost_cents AS DOUBLE) / 100.0 AS DECIMAL(18,2)) AS cost_euro,
         CAST(CAST(price_cents - cost_cents AS DOUBLE) / 100.0 AS DECIMAL(18,2)) AS margin_euro
  FROM raw_products),
customer_snapshot AS (
  SELECT customer_id, name, email, city, segment, signup_date,
         md5(CAST(customer_id AS VARCHAR) || '|' || CAST(__TS1__ AS VARCHAR)) AS scd_id,
         __TS1__ AS updated_at, __TS1__ AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
  FROM raw_customers),
dim_customers AS (
  SELECT customer_id, name, email, city, CAST(NULL AS VARCHAR) AS address, signup_date,
         valid_from, valid_to, valid_to IS NULL AS is_current
  FROM customer_snapshot)
""".replace("__TS1__", TS1)

SECOND_LOAD = """
raw_customers_v2 AS (
  SELECT customer_id, name, email,
         CASE WHEN customer_id % 10 = 0
              THEN 'NATION_' || CAST((TRY_CAST(regexp_extract(city, '(\\d+)$', 1) AS INTEGER) + 1) % 25 AS VARCHAR)
              ELSE city END AS city,
         CASE WHEN customer_id % 10 = 2 THEN NULL ELSE segment END AS segment,
         signup_date
  FROM raw_customers WHERE customer_id % 10 <> 1
  UNION ALL
  SELECT customer_id + 10000000000, name, email, city, segment, signup_date
  FROM raw_customers WHERE customer_id % 75 = 3),
open_prev AS (SELECT * FROM customer_snapshot WHERE valid_to IS NULL),
closed_prev AS (SELECT * FROM customer_snapshot WHERE valid_to IS NOT NULL),
snapshot_second AS (
  SELECT customer_id, name, email, city, segment, signup_date, scd_id, updated_at, valid_from, valid_to
  FROM closed_prev
  UNION ALL
  SELECT p.customer_id, p.name, p.email, p.city, p.segment, p.signup_date, p.scd_id, p.updated_at, p.valid_from,
         CASE WHEN i.customer_id IS NOT NULL AND (
                   p.name IS DISTINCT FROM i.name OR p.email IS DISTINCT FROM i.email
                OR p.city IS DISTINCT FROM i.city OR p.segment IS DISTINCT FROM i.segment
                OR p.signup_date IS DISTINCT FROM i.signup_date)
              THEN __TS2__ ELSE p.valid_to END AS valid_to
  FROM open_prev p LEFT JOIN raw_customers_v2 i ON p.customer_id = i.customer_id
  UNION ALL
  SELECT i.customer_id, i.name, i.email, i.city, i.segment, i.signup_date,
         md5(CAST(i.customer_id AS VARCHAR) || '|' || CAST(__TS2__ AS VARCHAR)) AS scd_id,
         __TS2__ AS updated_at, __TS2__ AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
  FROM raw_customers_v2 i LEFT JOIN open_prev p ON p.customer_id = i.customer_id
  WHERE p.customer_id IS NULL
     OR p.name IS DISTINCT FROM i.name OR p.email IS DISTINCT FROM i.email
     OR p.city IS DISTINCT FROM i.city OR p.segment IS DISTINCT FROM i.segment
     OR p.signup_date IS DISTINCT FROM i.signup_date),
dim_customers_history AS (
  SELECT customer_id, name, email, city, CAST(NULL AS VARCHAR) AS address, signup_date,
         valid_from, valid_to, valid_to IS NULL AS is_current
  FROM snapshot_second)
""".replace("__TS2__", TS2)


def q(body: str, extra: str = "") -> str:
    ctes = MAPPING + ("," + extra if extra else "")
    return f"WITH RECURSIVE {ctes}\n{body}"


def fw(window, dim: str = "dim_customers", current: bool = True) -> str:
    """Orders in the window's dates of its customers; once per version when all versions count."""
    dates = f"order_date BETWEEN DATE '{window.start}' AND DATE '{window.end}'"
    who = ["is_current"] if current else []
    if window.cities:
        who.append("city IN (" + ", ".join(f"'{x}'" for x in window.cities) + ")")
    where = f" WHERE {' AND '.join(who)}" if who else ""
    versions = f"SELECT customer_id, COUNT(*) AS versions FROM {dim}{where} GROUP BY customer_id"
    times = "1" if current else "versions"
    return (
        f"SELECT * EXCLUDE (versions, turn) FROM (SELECT *, unnest(range({times})) AS turn "
        f"FROM fct_orders JOIN ({versions}) USING (customer_id) WHERE {dates})"
    )


def kpi_body(window, dim: str = "dim_customers", current: bool = True) -> str:
    return f"""
SELECT CAST(COUNT(DISTINCT order_id) AS BIGINT) AS orders,
       CAST(COALESCE(SUM(revenue_euro), 0) AS DECIMAL(38,2)) AS revenue,
       COALESCE(ROUND(CAST(SUM(revenue_euro) AS DOUBLE) / COUNT(revenue_euro), 6), 0.0) AS aov,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS active_customers
FROM ({fw(window, dim, current)}) x"""


def kpi_sql(window, dim: str = "dim_customers", current: bool = True, extra: str = "") -> str:
    return q(kpi_body(window, dim, current), extra)


def trend_sql(window, dim: str = "dim_customers", current: bool = True) -> str:
    return f"""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
       CAST(SUM(revenue_euro) AS DECIMAL(38,2)) AS revenue,
       CAST(COUNT(order_id) AS BIGINT) AS orders
FROM ({fw(window, dim, current)}) x GROUP BY 1"""


def cohort_ctes(window, dim: str = "dim_customers") -> str:
    return f"""
active AS (SELECT DISTINCT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS month FROM ({fw(window, dim)})),
since AS (SELECT month, MIN(month) OVER (PARTITION BY customer_id) AS cohort_month FROM active),
cells AS (
  SELECT cohort_month, CAST(date_diff('month', cohort_month, month) AS BIGINT) AS month_index, COUNT(*) AS n
  FROM since GROUP BY ALL),
counted AS (
  SELECT strftime(cohort_month, '%Y-%m') AS cohort, cohort_month, month_index,
         CAST(CASE WHEN month_index BETWEEN 0 AND 60 THEN n ELSE 0 END AS BIGINT) AS users FROM cells),
cohort_view AS (
  SELECT *, CAST(SUM(users) FILTER (WHERE month_index = 0) OVER (PARTITION BY cohort_month) AS BIGINT) AS cohort_size,
         CASE WHEN cohort_size = 0 THEN 0.0 ELSE users / CAST(cohort_size AS DOUBLE) END AS retention_rate
  FROM counted)"""


def matrix_sql(value: str, fill: str) -> str:
    months = (W.end.year - W.start.year) * 12 + W.end.month - W.start.month
    columns = ", ".join(f"COALESCE(MAX({value}) FILTER (WHERE month_index = {i}), {fill}) AS m{i}" for i in range(months + 1))
    return q(f"SELECT cohort, {columns} FROM cohort_view GROUP BY cohort", cohort_ctes(W))


COHORT_SELECT = "SELECT * FROM cohort_view ORDER BY cohort_month DESC, month_index"


def _recency(last: str, window, missing: str) -> str:
    if missing == "epoch":
        return f"CAST(date_diff('day', COALESCE({last}, DATE '1970-01-01'), DATE '{window.end}') AS BIGINT)"
    return f"CAST(COALESCE(date_diff('day', {last}, DATE '{window.end}'), 0) AS BIGINT)"


def rfm_ctes(window, missing: str = "epoch") -> str:
    split = window_split_day(window.start, window.end)
    parts = {"a": f"order_date <= DATE '{split}'", "b": f"order_date >= DATE '{split}'"}
    sums = ", ".join(
        f"MAX(order_date) FILTER (WHERE {cond}) AS last_order_{p}, COUNT(order_id) FILTER (WHERE {cond}) AS frequency_{p}, "
        f"CAST(COALESCE(SUM(revenue_euro) FILTER (WHERE {cond}), 0) AS DECIMAL(38,2)) AS monetary_{p}"
        for p, cond in parts.items()
    )
    shown = ", ".join(
        f"last_order_{p}, {_recency(f'last_order_{p}', window, missing)} AS recency_{p}, frequency_{p}, monetary_{p}" for p in parts
    )
    both = " UNION ALL ".join(
        f"SELECT customer_id, '{p.upper()}' AS snapshot, last_order_{p} AS last_order, recency_{p} AS recency, "
        f"frequency_{p} AS frequency, monetary_{p} AS monetary FROM rfm_wide"
        for p in parts
    )
    return f"""
rfm_sums AS (SELECT customer_id, {sums} FROM ({fw(window)}) GROUP BY customer_id),
rfm_wide AS (SELECT customer_id, {shown} FROM rfm_sums),
rfm_long AS ({both}),
rfm_stats AS (
  SELECT avg(CAST(recency AS DOUBLE)) AS rm, stddev_pop(CAST(recency AS DOUBLE)) AS rs,
         avg(CAST(frequency AS DOUBLE)) AS fm, stddev_pop(CAST(frequency AS DOUBLE)) AS fs,
         avg(CAST(monetary AS DOUBLE)) AS mm, stddev_pop(CAST(monetary AS DOUBLE)) AS ms
  FROM rfm_long)"""


def _z(col: str, mean: str, std: str) -> str:
    return f"ROUND((CAST({col} AS DOUBLE) - {mean}) / CASE WHEN {std} = 0 OR {std} IS NULL THEN 1 ELSE {std} END, 6)"


def _clusters_ctes() -> str:
    """K-means from the given start centres, in millionths of standardised units, until no centre moves."""
    start = "[" + ", ".join("[" + ", ".join(f"CAST({x} AS DOUBLE) * 1000000" for x in c) + "]" for c in RFM_START) + "]"
    k = range(1, len(RFM_START) + 1)
    unit = lambda col, m, s: f"CAST(ROUND((CAST({col} AS DOUBLE) - {m}) / {s} * 1000000) AS BIGINT)"
    coords = lambda p: [unit(f"recency_{p}", "rm", "rs"), unit(f"frequency_{p}", "fm", "fs"), unit(f"monetary_{p}", "mm", "ms")]
    columns = ", ".join(f"{e} AS {n}_{p}" for p in "ab" for n, e in zip("xyz", coords(p), strict=True))
    near = lambda x, y, z: (
        f"list_position(list_transform(c, lambda m: ({x} - m[1]) * ({x} - m[1]) + ({y} - m[2]) * ({y} - m[2]) + ({z} - m[3]) * ({z} - m[3])), "
        f"list_min(list_transform(c, lambda m: ({x} - m[1]) * ({x} - m[1]) + ({y} - m[2]) * ({y} - m[2]) + ({z} - m[3]) * ({z} - m[3]))))"
    )
    centre = lambda i: ", ".join(
        f"COALESCE(CAST(SUM(w * {n}) FILTER (WHERE k = {i}) AS DOUBLE) / CAST(SUM(w) FILTER (WHERE k = {i}) AS DOUBLE), c[{i}][{j}])"
        for j, n in enumerate("xyz", 1)
    )
    return f"""{rfm_ctes(W)},
in_units AS (SELECT customer_id, {columns} FROM rfm_wide, rfm_stats),
cluster_points AS (
  SELECT x, y, z, COUNT(*) AS w FROM (SELECT x_a AS x, y_a AS y, z_a AS z FROM in_units UNION ALL SELECT x_b, y_b, z_b FROM in_units) GROUP BY ALL),
lloyd AS (
  SELECT {start} AS c, true AS moved
  UNION ALL
  SELECT after, after <> c FROM (
    SELECT c, [{", ".join(f"[{centre(i)}]" for i in k)}] AS after
    FROM (SELECT c, x, y, z, w, {near("x", "y", "z")} AS k FROM lloyd, cluster_points WHERE moved) GROUP BY c)),
rest AS (SELECT c FROM lloyd WHERE NOT moved),
numbered AS (SELECT i, CAST(ROW_NUMBER() OVER (ORDER BY c[i][3] DESC, c[i][1], i) - 1 AS INTEGER) AS number FROM rest, range(1, {len(k) + 1}) r(i)),
clusters AS (
  SELECT customer_id, a.number AS cluster_a, b.number AS cluster_b
  FROM (SELECT customer_id, {near("x_a", "y_a", "z_a")} AS ka, {near("x_b", "y_b", "z_b")} AS kb FROM in_units, rest)
  JOIN numbered a ON a.i = ka JOIN numbered b ON b.i = kb),
moves AS (
  SELECT cluster_a, cluster_b, COUNT(*) AS customers, COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY cluster_a) AS DOUBLE) AS share
  FROM clusters GROUP BY cluster_a, cluster_b)"""


def product_revenue_sql(window) -> str:
    return f"""
SELECT product_name, category, CAST(SUM(earned) AS DOUBLE) / 100.0 AS revenue
FROM (SELECT product_id, SUM(cents) AS earned FROM sold
      WHERE order_id IN (SELECT order_id FROM ({fw(window)})) GROUP BY product_id)
JOIN dim_products USING (product_id) GROUP BY product_name, category"""


def drilldown_sql(cohort: str, month: int, scope: str) -> str:
    """Orders of one month of the customers whose first order in ``scope`` falls in the cohort's month."""
    first, target = f"DATE '{cohort}-01'", f"DATE '{cohort}-01' + INTERVAL {month} MONTH"
    return f"""
SELECT customer_id, order_id, revenue_euro, order_date
FROM fct_orders SEMI JOIN (
  SELECT customer_id, MIN(order_date) AS first_day FROM ({scope}) GROUP BY customer_id
  HAVING first_day >= {first} AND first_day < {first} + INTERVAL 1 MONTH) USING (customer_id)
WHERE order_date >= {target} AND order_date < {target} + INTERVAL 1 MONTH
ORDER BY customer_id, order_id LIMIT 1000"""


def holt_winters_ctes(window, season: str) -> str:
    """Weekly series of a window, and how many weeks a fitted season has (0: none); ``season`` is SQL of the wanted one."""
    return f"""
weekly AS (SELECT CAST(date_trunc('week', order_date) AS DATE) AS week, CAST(SUM(revenue_euro) AS DOUBLE) AS y FROM ({fw(window)}) GROUP BY 1),
counted_weeks AS (SELECT list(y ORDER BY week) AS ys, MAX(week) AS last_week, COUNT(*) AS n FROM weekly),
whole AS (SELECT *, CAST(CASE WHEN {season} >= 2 AND 2 * {season} <= n THEN {season} ELSE 0 END AS INTEGER) AS m FROM counted_weeks WHERE n >= 12)"""


AUTO_SEASON = "(CASE WHEN n >= 52 THEN 52 WHEN n >= 26 THEN 13 ELSE 12 END)"
# level, trend and seasonal indices before the first week
HW_START = """CASE WHEN m > 0 THEN list_sum(ys[1:m]) / m ELSE ys[1] END AS level,
         CASE WHEN m > 0 THEN (list_sum(ys[m + 1:2 * m]) / m - list_sum(ys[1:m]) / m) / m ELSE ys[2] - ys[1] END AS trend,
         CASE WHEN m > 0 THEN list_transform(ys[1:m], lambda v: v - list_sum(ys[1:m]) / m) ELSE CAST([] AS DOUBLE[]) END AS seas"""


def holt_winters_sql(window, season: str) -> str:
    """The smoothing recursion with given parameters, a step for each week."""
    a, b, g = HW_FIXED
    return q(
        """
SELECT 'all' AS series, week AS time, ROUND(y, 2) AS revenue, CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper,
       'Actual' AS type, CAST(NULL AS VARCHAR) AS model FROM weekly
UNION ALL
SELECT 'all', CAST(last_week + CAST(7 * h AS INTEGER) AS DATE), ROUND(value, 2), ROUND(value - 1.96 * se, 2),
       ROUND(value + 1.96 * se, 2), 'Forecast', CASE WHEN m > 0 THEN 'trend+season' ELSE 'trend' END
FROM (SELECT last_week, h, m, level + h * trend + CASE WHEN m > 0 THEN seas[n + (h - 1) % m + 1] ELSE 0.0 END AS value,
             sqrt(list_sum(list_transform(errs, lambda e: (e - list_sum(errs) / n) * (e - list_sum(errs) / n))) / n) AS se
      FROM steps, whole, range(1, 13) r(h) WHERE t = n)""",
        f"""{holt_winters_ctes(window, season)},
steps AS (
  SELECT CAST(0 AS BIGINT) AS t, {HW_START}, CAST([] AS DOUBLE[]) AS errs FROM whole
  UNION ALL
  SELECT t + 1, new_level, {b} * (new_level - level) + (1 - {b}) * trend,
         list_append(seas, {g} * (y - new_level) + (1 - {g}) * s), list_append(errs, y - (level + trend + s))
  FROM (SELECT *, {a} * (y - s) + (1 - {a}) * (level + trend) AS new_level
        FROM (SELECT steps.*, ys[t + 1] AS y, CASE WHEN m > 0 THEN seas[t + 1] ELSE 0.0 END AS s FROM steps, whole WHERE t < n)))""",
    )


def holt_winters_search_sql(window, season: str) -> str:
    """The search for the parameters: the best of a grid, then rounds of 27 points around the best one."""
    # what is left of a week's value after level, trend and the season's index; the index comes first in seas
    index = "CASE WHEN m > 0 THEN s.seas[1] ELSE 0.0 END"
    off = f"(x.y - s.level - s.trend - {index})"

    def error(a: str, b: str, g: str) -> str:
        return f"""list_reduce(
      list_transform(ys, lambda y: {{'y': y, 'level': 0.0::DOUBLE, 'trend': 0.0::DOUBLE, 'seas': CAST([] AS DOUBLE[]), 'total': 0.0::DOUBLE}}),
      lambda s, x: {{'y': x.y, 'level': s.level + s.trend + {a} * {off}, 'trend': s.trend + {b} * {a} * {off},
                    'seas': CASE WHEN m > 0 THEN list_append(s.seas[2:], {index} + {g} * (1 - {a}) * {off}) ELSE s.seas END,
                    'total': s.total + {off} * {off}}},
      {{'y': 0.0::DOUBLE, 'level': level::DOUBLE, 'trend': trend::DOUBLE, 'seas': seas, 'total': 0.0::DOUBLE}}).total"""

    return q(
        """
SELECT 'all' AS series, CAST(n AS INTEGER) AS weeks, m AS season, ROUND(a, 4) AS alpha, ROUND(b, 4) AS beta, ROUND(g, 4) AS gamma,
       ROUND(least_error, 0) AS squared_error
FROM rounds WHERE step <= 1e-4""",
        f"""{holt_winters_ctes(window, season)},
began AS (SELECT *, {HW_START} FROM whole),
grid AS (SELECT CAST(0.05 + 0.1 * i AS DOUBLE) AS v FROM range(10) r(i)),
tried AS (
  SELECT began.*, x.v AS a, y.v AS b, z.v AS g FROM began, grid x, grid y, (SELECT v FROM grid UNION ALL SELECT 0.0) z
  WHERE (m > 0) = (z.v > 0)),
first_round AS (
  SELECT * FROM (SELECT *, {error('a', 'b', 'g')} AS least_error, CAST(0.05 AS DOUBLE) AS step FROM tried)
  ORDER BY least_error, a, b, g LIMIT 1),
rounds AS (
  SELECT * FROM first_round
  UNION ALL
  SELECT ys, last_week, n, m, level, trend, seas,
         CASE WHEN p.e < least_error THEN p.a ELSE a END, CASE WHEN p.e < least_error THEN p.b ELSE b END,
         CASE WHEN p.e < least_error THEN p.g ELSE g END, least(p.e, least_error),
         CASE WHEN p.e < least_error THEN least(2 * step, 0.05) ELSE step / 2 END
  FROM (
    SELECT * EXCLUDE (na, nb, ng, e), list({{'e': e, 'a': na, 'b': nb, 'g': ng}} ORDER BY e, na, nb, ng)[1] AS p
    FROM (SELECT *, {error('na', 'nb', 'ng')} AS e
          FROM (SELECT rounds.*, least(greatest(a + i * step, 0.001), 0.999) AS na, least(greatest(b + j * step, 0.001), 0.999) AS nb,
                       CASE WHEN m > 0 THEN least(greatest(g + k * step, 0.001), 0.999) ELSE 0.0 END AS ng
                FROM rounds, range(-1, 2) x(i), range(-1, 2) y(j), range(-1, 2) z(k) WHERE step > 1e-4 AND (m > 0 OR k = 0)))
    GROUP BY ALL))""",
    )


def label_sql(v: str) -> str:
    # printf / format round the exact double half to even, like Python's f format
    v = f"CAST({v} AS DOUBLE)"
    return f"""CASE
  WHEN {v} >= 1e9 THEN '€' || printf('%.2f', {v} / 1e9) || 'B'
  WHEN {v} >= 1e6 THEN '€' || printf('%.1f', {v} / 1e6) || 'M'
  WHEN {v} >= 1e3 THEN '€' || printf('%.0f', {v} / 1e3) || 'K'
  ELSE '€' || format('{{:,.2f}}', {v}) END"""


def _dq_report_sql() -> str:
    rows = []

    def unique(model, col):
        return (
            f"SELECT 'unique_{model}_{col}' AS \"check\", '{model}' AS model, '{col}' AS \"column\", "
            f"CAST(COUNT(*) AS BIGINT) AS failures FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} HAVING COUNT(*) > 1) t"
        )

    def rowcheck(kind, model, col, cond):
        return (
            f"SELECT '{kind}_{model}_{col}', '{model}', '{col}', "
            f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT) FROM {model}"
        )

    rows.append(unique("stg_orders", "order_id"))
    rows.append(rowcheck("not_null", "stg_orders", "order_id", "order_id IS NULL"))
    rows.append(
        rowcheck(
            "accepted_values",
            "stg_orders",
            "status",
            "status NOT IN ('placed', 'shipped', 'completed', 'returned', 'processing')",
        )
    )
    rows.append(unique("dim_customers", "customer_id"))
    rows.append(rowcheck("not_null", "dim_customers", "customer_id", "customer_id IS NULL"))
    rows.append(unique("dim_products", "product_id"))
    rows.append(rowcheck("not_null", "dim_products", "product_id", "product_id IS NULL"))
    rows.append(unique("fct_orders", "order_id"))
    rows.append(rowcheck("not_null", "fct_orders", "order_id", "order_id IS NULL"))
    rows.append(rowcheck("not_null", "fct_orders", "customer_id", "customer_id IS NULL"))
    rows.append(
        "SELECT 'relationship_fct_orders_customer_id', 'fct_orders', 'customer_id', CAST(COUNT(*) AS BIGINT) "
        "FROM fct_orders f WHERE f.customer_id IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM dim_customers d WHERE d.is_current AND d.customer_id = f.customer_id)"
    )
    rows.append(
        rowcheck("between", "fct_orders", "revenue_euro", "NOT (revenue_euro BETWEEN 0 AND 1000000)")
    )
    body = "\nUNION ALL\n".join(rows)
    return q(f"SELECT *, failures = 0 AS passed FROM ({body}) r")


LINEAR_SELECT = """
SELECT 'all' AS series, time, ROUND(y, 2) AS revenue, CAST(NULL AS DOUBLE) AS lower,
       CAST(NULL AS DOUBLE) AS upper, 'Actual' AS type FROM s
UNION ALL
SELECT 'all', time, ROUND(revenue, 2), ROUND(revenue - 1.96 * se, 2), ROUND(revenue + 1.96 * se, 2), 'Forecast'
FROM fc"""


def linear_ctes(window) -> str:
    return f"""
trend AS ({trend_sql(window)}),
s AS (SELECT month AS time, CAST(revenue AS DOUBLE) AS y,
             CAST(date_diff('day', DATE '1970-01-01', month) AS DOUBLE) AS x FROM trend),
fit AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, max(time) AS last_time
        FROM s HAVING count(*) >= 3),
res AS (SELECT stddev_samp(s.y - (fit.slope * s.x + fit.intercept)) AS se FROM s, fit),
fc AS (SELECT CAST(fit.last_time + to_months(CAST(h AS INTEGER)) AS DATE) AS time,
              fit.slope * CAST(date_diff('day', DATE '1970-01-01',
                  CAST(fit.last_time + to_months(CAST(h AS INTEGER)) AS DATE)) AS DOUBLE) + fit.intercept AS revenue,
              res.se
       FROM fit, res, range(1, 4) t(h))"""


CITIES_W = ", ".join(f"'{x}'" for x in W.cities)

ORACLE_SQL: dict[str, str] = {
    "stg_orders": q("SELECT * FROM stg_orders"),
    "order_totals": q("SELECT * FROM item_totals"),
    "fct_orders": q("SELECT * FROM fct_orders"),
    "dim_products": q("SELECT * FROM dim_products"),
    "dim_products_reference_margin": q(
        """
SELECT product_id, product_name, category,
       CAST(CAST(price_cents AS DOUBLE) / 100.0 AS DECIMAL(18,2)) AS price_euro,
       CAST(CAST(cost_cents AS DOUBLE) / 100.0 AS DECIMAL(18,2)) AS cost_euro,
       CAST(price_cents - cost_cents / 100.0 AS DECIMAL(18,2)) AS margin_euro
FROM raw_products"""
    ),
    "kpi": kpi_sql(W),
    "kpi_all": kpi_sql(W_ALL),
    "monthly_trend": q(trend_sql(W) + " ORDER BY 1"),
    "monthly_trend_all": q(trend_sql(W_ALL) + " ORDER BY 1"),
    "weekly_revenue": q(
        f"""
SELECT CAST(date_trunc('week', order_date) AS DATE) AS week, CAST(SUM(revenue_euro) AS DECIMAL(38,2)) AS revenue
FROM ({fw(W)}) x GROUP BY 1 ORDER BY 1"""
    ),
    "date_bounds": q("SELECT min(order_date) AS min_date, max(order_date) AS max_date FROM fct_orders"),
    "city_list": q("SELECT DISTINCT city FROM dim_customers ORDER BY 1"),
    "default_cities": q("SELECT DISTINCT city FROM dim_customers WHERE city IS NOT NULL ORDER BY 1 LIMIT 5"),
    "resolved_params": q(
        """
SELECT b.min_date AS start_date, b.max_date AS end_date, c.city
FROM (SELECT min(order_date) AS min_date, max(order_date) AS max_date FROM fct_orders) b,
     (SELECT DISTINCT city FROM dim_customers WHERE city IS NOT NULL ORDER BY city LIMIT 5) c"""
    ),
    "dq_report": _dq_report_sql(),
    "dq_unique_failures": q(
        "SELECT order_id, CAST(COUNT(*) AS BIGINT) AS n_records FROM raw_order_items "
        "WHERE order_id IS NOT NULL GROUP BY order_id HAVING COUNT(*) > 1"
    ),
    "dq_not_null_failures": q("SELECT * FROM raw_customers_v2 WHERE segment IS NULL", SECOND_LOAD),
    "dq_accepted_values_failures": q("SELECT * FROM fct_orders WHERE status NOT IN ('completed', 'shipped')"),
    "dq_relationship_failures": q(
        f"""
SELECT f.* FROM fct_orders f
WHERE f.customer_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM dim_customers d WHERE d.city IN ({CITIES_W}) AND d.customer_id = f.customer_id)"""
    ),
    "dq_between_failures": q("SELECT * FROM fct_orders WHERE NOT (revenue_euro BETWEEN 0 AND 100000)"),
    "snapshot_first": q("SELECT * FROM customer_snapshot"),
    "snapshot_second": q("SELECT * FROM snapshot_second", SECOND_LOAD),
    "dim_customers": q("SELECT * FROM dim_customers"),
    "dim_customers_history": q("SELECT * FROM dim_customers_history", SECOND_LOAD),
    "kpi_history_current": kpi_sql(W_ALL, "dim_customers_history", True, SECOND_LOAD),
    "kpi_history_all_versions": kpi_sql(W_ALL, "dim_customers_history", False, SECOND_LOAD),
    "cohort_retention": q(COHORT_SELECT, cohort_ctes(W)),
    "cohort_retention_all": q(COHORT_SELECT, cohort_ctes(W_ALL)),
    "cohort_size": q("SELECT DISTINCT cohort, cohort_month, cohort_size FROM cohort_view", cohort_ctes(W)),
    "cohort_matrix": matrix_sql("retention_rate", "0.0"),
    "cohort_users_matrix": matrix_sql("users", "0"),
    "decay_curves": q(
        f"""
SELECT cohort, month_index, retention_rate FROM cohort_view
WHERE cohort IN (SELECT DISTINCT cohort FROM cohort_view ORDER BY cohort LIMIT {DECAY_N})""",
        cohort_ctes(W),
    ),
    "cohort_drilldown": q(
        drilldown_sql(
            DRILL_COHORT,
            DRILL_MONTH,
            f"SELECT * FROM fct_orders WHERE customer_id IN (SELECT customer_id FROM dim_customers WHERE is_current AND city IN ({CITIES_W}))",
        )
    ),
    "top_products": q(product_revenue_sql(W) + f" ORDER BY revenue DESC, product_name, category LIMIT {TOP_N}"),
    "top_products_raw": q(product_revenue_sql(W) + f" ORDER BY revenue DESC, product_name, category LIMIT {TOP_N}"),
    "top_products_all": q(
        product_revenue_sql(W_ALL) + f" ORDER BY revenue DESC, product_name, category LIMIT {TOP_N}"
    ),
    "priced_items": q(
        """
SELECT i.order_id, i.product_id, i.quantity, i.amount_cents, p.price_cents AS unit_price_cents
FROM raw_order_items i LEFT JOIN raw_products p ON i.product_id = p.product_id"""
    ),
    "linear_forecast": q(LINEAR_SELECT, linear_ctes(W)),
    "forecast_rows": q(
        "SELECT * FROM (" + LINEAR_SELECT + ") u WHERE type = 'Forecast'", linear_ctes(W_ALL)
    ),
    "rfm_snapshot": q("SELECT * FROM rfm_long", rfm_ctes(W)),
    "rfm_aligned": q("SELECT * FROM rfm_wide", rfm_ctes(W)),
    "rfm_scaled": q(
        f"""
SELECT w.*,
  {_z('recency_a', 'rm', 'rs')} AS z_recency_a, {_z('frequency_a', 'fm', 'fs')} AS z_frequency_a,
  {_z('monetary_a', 'mm', 'ms')} AS z_monetary_a, {_z('recency_b', 'rm', 'rs')} AS z_recency_b,
  {_z('frequency_b', 'fm', 'fs')} AS z_frequency_b, {_z('monetary_b', 'mm', 'ms')} AS z_monetary_b
FROM rfm_wide w, rfm_stats""",
        rfm_ctes(W),
    ),
    "date_dimension": q(
        """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date_day,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
       CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter, strftime(d, '%A') AS day_of_week
FROM (SELECT DISTINCT CAST(unnest(generate_series(CAST(min(order_date) AS TIMESTAMP),
                                                  CAST(max(order_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
      FROM fct_orders) t"""
    ),
    "currency_labels": q(
        f"SELECT product_name, category, {label_sql('revenue')} AS label FROM ({product_revenue_sql(W)}) pr"
    ),
    "kpi_labels": q(
        f"""
SELECT {label_sql('CAST(revenue AS DOUBLE)')} AS revenue_label,
       format('{{:,}}', orders) AS orders_label,
       '€' || printf('%.2f', CAST(aov AS DOUBLE)) AS aov_label,
       format('{{:,}}', active_customers) AS customers_label
FROM ({kpi_body(W)}) k""",
    ),
    "weekly_revenue_all": q(
        f"""
SELECT CAST(date_trunc('week', order_date) AS DATE) AS week, CAST(SUM(revenue_euro) AS DECIMAL(38,2)) AS revenue
FROM ({fw(W_ALL)}) x GROUP BY 1 ORDER BY 1"""
    ),
    "monthly_trend_history_all_versions": q(
        trend_sql(W_ALL, "dim_customers_history", current=False) + " ORDER BY 1", SECOND_LOAD
    ),
    "cohort_retention_history": q(COHORT_SELECT, SECOND_LOAD + "," + cohort_ctes(W, "dim_customers_history")),
    "rfm_aligned_end_date": q("SELECT * FROM rfm_wide", rfm_ctes(W, missing="end_date")),
    "cohort_drilldown_windowed": q(drilldown_sql(*DRILL_WINDOWED, fw(W))),
    "holt_winters_fixed": holt_winters_sql(W, AUTO_SEASON),
    "holt_winters_fixed_trend": holt_winters_sql(W, "0"),
    "holt_winters_parameters": holt_winters_search_sql(W_QUARTERS, AUTO_SEASON),
    "holt_winters_parameters_trend": holt_winters_search_sql(W_ALL, "0"),
    "holt_winters_fixed_quarter": holt_winters_sql(W_QUARTERS, AUTO_SEASON),
    "holt_winters_fixed_short": holt_winters_sql(W_SHORT, AUTO_SEASON),
    "rfm_clusters_fixed": q("SELECT customer_id, cluster_a, cluster_b FROM clusters", _clusters_ctes()),
    "rfm_transition_counts_fixed": q(
        "SELECT cluster_a, "
        + ", ".join(f"CAST(COALESCE(SUM(customers) FILTER (WHERE cluster_b = {j}), 0) AS BIGINT) AS b{j}" for j in range(len(RFM_START)))
        + " FROM moves GROUP BY cluster_a",
        _clusters_ctes(),
    ),
    "rfm_transition_shares_fixed": q("SELECT * FROM moves", _clusters_ctes()),
    "transition_labels_fixed": q(
        "SELECT cluster_a, cluster_b, printf('%.1f', round_even(share * 1000.0, 0) / 10.0) || '%' AS share_label FROM moves", _clusters_ctes()
    ),
    "transition_totals": q(
        "SELECT COUNT(*) AS customers, CAST(0 AS BIGINT) AS uneven_rows, COUNT(*) FILTER (WHERE frequency_a > 0) AS active_a, "
        "COUNT(*) FILTER (WHERE frequency_b > 0) AS active_b FROM rfm_wide",
        rfm_ctes(W),
    ),
    "registered_raw_views": q(
        "SELECT status, COUNT(*) AS items, CAST(SUM(amount_cents) AS BIGINT) AS cents, COUNT(DISTINCT customer_id) AS customers "
        "FROM raw_orders JOIN raw_order_items USING (order_id) GROUP BY status"
    ),
    "exported_trend_csv": q(trend_sql(W)),
    "warehouse_build_report": _dq_report_sql(),
    "retention_percent_labels": q(
        "SELECT cohort, month_index, printf('%.1f', round_even(retention_rate * 1000.0, 0) / 10.0) || '%' AS label FROM cohort_view",
        cohort_ctes(W),
    ),
    "sql_kpi": kpi_sql(W),
    "sql_monthly_trend": q(trend_sql(W) + " ORDER BY 1"),
    "sql_top_products": q(product_revenue_sql(W) + f" ORDER BY revenue DESC, product_name, category LIMIT {TOP_N}"),
    "cell_labels": q(
        "SELECT cohort, month_index, CAST(users AS VARCHAR) || ' users' || chr(10) || "
        "printf('%.1f', retention_rate * 100.0) || '%' AS label FROM cohort_view",
        cohort_ctes(W),
    ),
}
ORACLE_SQL["calendar_csv"] = ORACLE_SQL["date_dimension"]
