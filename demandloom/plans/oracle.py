"""SQL with the same results as the registered queries, for an independent engine."""

from __future__ import annotations

from demandloom.operators.demand import INFLATION_RATES
from demandloom.operators.smoothing import LEVEL_WEIGHTS, SEASON_WEIGHTS, TREND_WEIGHTS
from demandloom.operators.validate import EMPTY_MESSAGE, POSITIVE_MESSAGE
from demandloom.plans.views import (
    SQL_DAILY,
    SQL_DAILY_TEXT,
    SQL_LINES,
    SQL_PARSED,
    SQL_PREDICTIONS,
    SQL_PRODUCT_SET,
    SQL_RAW,
    SQL_SPINE,
)

TIDY = r"""lower(regexp_replace("Product Name", '^\s+|\s+$', '', 'g'))"""
QTY = """CAST(round(CAST(quantity || quantity_suffix AS DOUBLE)) AS BIGINT)"""

EVENTS_PARSED = f"WITH {SQL_RAW}, {SQL_PARSED}"

TYPED = f"""{SQL_RAW}, {SQL_PARSED}, typed AS (
  SELECT "Date", price AS "Unit Price", {QTY} AS "Quantity", "Transaction ID",
         "Store Location", "Product Name", "Producer ID", source_file, row_seq
  FROM parsed)"""

ORDER = f"""{SQL_RAW}, {SQL_PARSED},
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY row_seq) AS pos FROM parsed),
known_days AS (
  SELECT source_file, CAST("Date" AS DATE) AS d,
         lag(CAST("Date" AS DATE)) OVER (PARTITION BY source_file ORDER BY pos) AS p
  FROM ordered WHERE "Date" IS NOT NULL),
file_order AS (
  SELECT source_file,
         CASE WHEN count(d) < 2 THEN 'Random'
              WHEN bool_and(coalesce(d >= p, true)) THEN 'Ascending'
              WHEN bool_and(coalesce(d <= p, true)) THEN 'Descending'
              ELSE 'Random' END AS date_order
  FROM (SELECT DISTINCT source_file FROM ordered) LEFT JOIN known_days USING (source_file)
  GROUP BY source_file)"""

FILLED = f"""{ORDER},
near AS (
  SELECT *,
    last_value("Date" IGNORE NULLS) OVER back AS prev,
    last_value(CASE WHEN "Date" IS NOT NULL THEN pos END IGNORE NULLS) OVER back AS prev_pos,
    first_value("Date" IGNORE NULLS) OVER ahead AS next,
    first_value(CASE WHEN "Date" IS NOT NULL THEN pos END IGNORE NULLS) OVER ahead AS next_pos
  FROM ordered
  WINDOW back AS (PARTITION BY source_file ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY source_file ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (
  SELECT n.* REPLACE (coalesce("Date", prev + to_microseconds(
           ((epoch_us(next) - epoch_us(prev)) * (pos - prev_pos)) // (next_pos - prev_pos))) AS "Date")
  FROM near n JOIN file_order USING (source_file)
  WHERE "Date" IS NOT NULL
     OR (CAST(prev AS DATE) = CAST(next AS DATE) AND date_order <> 'Random'))"""


def _mode(source: str, keys: str, value: str, alias: str) -> str:
    return f"""SELECT {keys}, {value} AS {alias} FROM (
      SELECT {keys}, {value}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {value}) AS rn
      FROM {source} WHERE {value} IS NOT NULL GROUP BY {keys}, {value}) WHERE rn = 1"""


FENCES = """CASE WHEN q3 = q1 THEN q1 WHEN smallest >= 0 THEN greatest(q1 - (q3 - q1) * 1.5, 0.0)
              ELSE q1 - (q3 - q1) * 1.5 END AS lower_bound,
         CASE WHEN q3 = q1 THEN q3 ELSE q3 + (q3 - q1) * 2.0 END AS upper_bound"""


def _bounds(source: str, keys: str, value: str) -> str:
    return f"""SELECT {keys}, n, {FENCES} FROM (
      SELECT {keys}, count({value}) AS n, CAST(min({value}) AS DOUBLE) AS smallest,
             quantile_cont(CAST({value} AS DOUBLE), 0.25) AS q1,
             quantile_cont(CAST({value} AS DOUBLE), 0.75) AS q3
      FROM {source} WHERE {value} IS NOT NULL GROUP BY {keys})"""


PIPELINE = f"""{FILLED},
known AS (
  SELECT source_file, row_seq, "Date", price, {QTY} AS quantity, lower("Transaction ID") AS tx,
         {TIDY} AS product, CAST(year("Date") AS INTEGER) AS y, CAST(month("Date") AS INTEGER) AS m, CAST(week("Date") AS INTEGER) AS w
  FROM filled WHERE {TIDY} IN {SQL_PRODUCT_SET}),
mode_week AS ({_mode("known", "source_file, product, y, m, w", "price", "pw")}),
mode_month AS ({_mode("known", "source_file, product, y, m", "price", "pm")}),
mode_year AS ({_mode("known", "source_file, product, y", "price", "py")}),
priced AS (
  SELECT known.* REPLACE (coalesce(price, pw, pm, py, 0) AS price)
  FROM known LEFT JOIN mode_week USING (source_file, product, y, m, w)
             LEFT JOIN mode_month USING (source_file, product, y, m)
             LEFT JOIN mode_year USING (source_file, product, y)),
rows AS (
  SELECT *, CAST("Date" AS DATE) AS day FROM priced
  WHERE quantity IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source_file, tx ORDER BY row_seq) = 1),
price_bounds AS ({_bounds("rows", "source_file, product, day", "price")}),
quantity_bounds AS ({_bounds("rows", "source_file, product, day", "quantity")}),
flagged AS (
  SELECT r.*,
    coalesce(pb.n >= 4 AND (price < pb.lower_bound OR price > pb.upper_bound), false) AS price_anomalies,
    coalesce(qb.n >= 4 AND (quantity < qb.lower_bound OR quantity > qb.upper_bound), false) AS quantity_anomalies,
    hour("Date") < 6 OR hour("Date") > 22 AS time_anomalies,
    quantity <= 0 AS format_anomalies
  FROM rows r LEFT JOIN price_bounds pb USING (source_file, product, day)
              LEFT JOIN quantity_bounds qb USING (source_file, product, day)),
result AS (
  SELECT source_file, day AS "Date", product AS "Product Name", CAST(sum(quantity) AS BIGINT) AS "Total Quantity"
  FROM flagged
  WHERE NOT (price_anomalies OR quantity_anomalies OR time_anomalies OR format_anomalies)
  GROUP BY ALL)"""

PIPELINE_DAILY = f'WITH {PIPELINE} SELECT source_file, "Date", "Product Name", "Total Quantity" FROM result'

FLAGGED_LINES = f"""{SQL_LINES},
dated AS (SELECT *, CAST("Date" AS DATE) AS day FROM lines),
price_bounds AS ({_bounds("dated", '"Product Name", day', '"Unit Price"')}),
quantity_bounds AS ({_bounds("dated", '"Product Name", day', '"Quantity"')}),
flagged AS (
  SELECT r.*,
    coalesce(pb.n >= 4 AND ("Unit Price" < pb.lower_bound OR "Unit Price" > pb.upper_bound), false) AS price_anomalies,
    coalesce(qb.n >= 4 AND ("Quantity" < qb.lower_bound OR "Quantity" > qb.upper_bound), false) AS quantity_anomalies,
    hour("Date") < 6 OR hour("Date") > 22 AS time_anomalies,
    coalesce("Quantity" <= 0, false) AS format_anomalies
  FROM dated r LEFT JOIN price_bounds pb USING ("Product Name", day)
               LEFT JOIN quantity_bounds qb USING ("Product Name", day))"""

TX_COLUMNS = '"Transaction ID", "Date", "Product Name", "Unit Price", "Quantity", "Store Location", "Producer ID"'

ANOMALY_UNION = " UNION ALL ".join(
    f"SELECT {TX_COLUMNS}, '{kind}' AS anomaly_type FROM flagged WHERE {kind}"
    for kind in ("price_anomalies", "quantity_anomalies", "time_anomalies", "format_anomalies")
)


def _stats(source: str, columns: list[str], per: str = "") -> str:
    parts = []
    for c in columns:
        v = f'CAST("{c}" AS DOUBLE)'
        parts.append(f"""SELECT {per} "Product Name", '{c}' AS "column",
          round(avg({v}), 6) AS mean, round(stddev_samp({v}), 6) AS std, min({v}) AS min, max({v}) AS max,
          round(quantile_cont({v}, 0.5), 6) AS median,
          round(quantile_cont({v}, 0.25), 6) AS "25th_percentile",
          round(quantile_cont({v}, 0.75), 6) AS "75th_percentile",
          round(CASE WHEN count({v}) >= 3 THEN coalesce(skewness({v}), 0) END, 6) AS skewness,
          round(CASE WHEN count({v}) >= 4 THEN coalesce(kurtosis({v}), 0) END, 6) AS kurtosis
        FROM {source} GROUP BY {per} "Product Name" """)
    return " UNION ALL ".join(parts)


def _window(oldest: int, newest: int) -> str:
    return f"""SELECT * FROM daily WHERE "Date" BETWEEN (SELECT max("Date") - {oldest} FROM daily)
                                        AND (SELECT max("Date") - {newest} FROM daily)"""


KS_WINDOWS = f"""{SQL_PREDICTIONS},
win_new AS ({_window(13, 7)}),
win_ref AS ({_window(6, 0)}),
err_new AS (SELECT "Product Name", "Total Quantity" - y_hat AS v FROM win_new JOIN predictions USING ("Product Name", "Date")),
err_ref AS (SELECT "Product Name", "Total Quantity" - y_hat AS v FROM win_ref JOIN predictions USING ("Product Name", "Date"))"""


def _ks(keys: str, ref: str, new: str, tag: str) -> str:
    """Common tables ks_<tag>(keys, n_ref, n_new, gap, ks_statistic, p_value)."""
    return f"""both_{tag} AS (SELECT {keys}, v, 1 AS r, 0 AS n FROM {ref} UNION ALL SELECT {keys}, v, 0, 1 FROM {new}),
count_{tag} AS (SELECT {keys}, v, sum(r) AS r, sum(n) AS n FROM both_{tag} WHERE v IS NOT NULL GROUP BY {keys}, v),
cum_{tag} AS (
  SELECT {keys}, sum(r) OVER upto AS cr, sum(n) OVER upto AS cn, sum(r) OVER grp AS nr, sum(n) OVER grp AS nn
  FROM count_{tag}
  WINDOW upto AS (PARTITION BY {keys} ORDER BY v ROWS UNBOUNDED PRECEDING), grp AS (PARTITION BY {keys})),
ks_{tag} AS (
  SELECT {keys}, CAST(max(nr) AS BIGINT) AS n_ref, CAST(max(nn) AS BIGINT) AS n_new,
         max(abs(cr * nn - cn * nr)) AS gap
  FROM cum_{tag} GROUP BY {keys})"""


def _exact_p(table: str, tag: str) -> str:
    """Common table p_<tag>: probability that a random merge of both samples gets as far
    apart as ``gap``, by walking all merges step by step."""
    return f"""walk_{tag} AS (
  SELECT "Product Name", n_ref AS a, n_new AS b, CAST(gap AS BIGINT) AS gap, CAST(0 AS BIGINT) AS i,
         CAST(0 AS BIGINT) AS j, CAST(1 AS DOUBLE) AS mass, gap = 0 AS away
  FROM {table} WHERE n_ref >= 2 AND n_new >= 2
  UNION ALL
  SELECT "Product Name", a, b, gap, i + di, j + dj,
         sum(mass * CASE WHEN di = 1 THEN a - i ELSE b - j END / (a + b - i - j)),
         abs((i + di) * b - (j + dj) * a) >= gap
  FROM walk_{tag}, (VALUES (1, 0), (0, 1)) step(di, dj)
  WHERE NOT away AND i + di <= a AND j + dj <= b
  GROUP BY "Product Name", a, b, gap, i + di, j + dj),
p_{tag} AS (
  SELECT "Product Name", coalesce(sum(mass) FILTER (WHERE away), 0) AS p_value
  FROM walk_{tag} GROUP BY "Product Name")"""


MONITOR = f"""{KS_WINDOWS},
val_new AS (SELECT "Product Name", CAST("Total Quantity" AS DOUBLE) AS v FROM win_new),
val_ref AS (SELECT "Product Name", CAST("Total Quantity" AS DOUBLE) AS v FROM win_ref),
{_ks('"Product Name"', "val_ref", "val_new", "data")},
{_ks('"Product Name"', "err_ref", "err_new", "error")},
{_exact_p("ks_data", "data")},
{_exact_p("ks_error", "error")},
errors AS (
  SELECT "Product Name", sqrt(avg(v * v)) AS rmse,
    100 * avg(CASE WHEN "Total Quantity" <> 0 THEN abs(v / "Total Quantity") END) AS mape
  FROM (SELECT "Product Name", "Total Quantity", "Total Quantity" - y_hat AS v
        FROM win_new JOIN predictions USING ("Product Name", "Date")) GROUP BY 1),
report AS (
  SELECT "Product Name", rmse, mape, coalesce(d.p_value < 0.05, false) AS data_drift,
         coalesce(e.p_value < 0.05, false) AS concept_drift
  FROM (SELECT DISTINCT "Product Name" FROM win_new)
       LEFT JOIN errors USING ("Product Name") LEFT JOIN p_data d USING ("Product Name")
       LEFT JOIN p_error e USING ("Product Name"))"""

HALVES = f"""{SQL_LINES},
cut AS (SELECT DATE '1998-06-01' AS c),
val_ref AS (SELECT "Product Name", 'Quantity' AS "column", CAST("Quantity" AS DOUBLE) AS v FROM lines, cut WHERE "Date" < c
            UNION ALL SELECT "Product Name", 'Unit Price', "Unit Price" FROM lines, cut WHERE "Date" < c),
val_new AS (SELECT "Product Name", 'Quantity' AS "column", CAST("Quantity" AS DOUBLE) AS v FROM lines, cut WHERE "Date" >= c
            UNION ALL SELECT "Product Name", 'Unit Price', "Unit Price" FROM lines, cut WHERE "Date" >= c),
{_ks('"Product Name", "column"', "val_ref", "val_new", "lines")}"""

BASELINE = f"""{SQL_SPINE},
positions AS (
  SELECT "Product Name", "Date", CAST("Total Quantity" AS DOUBLE) AS y,
         row_number() OVER (PARTITION BY "Product Name" ORDER BY "Date") AS from_start,
         row_number() OVER (PARTITION BY "Product Name" ORDER BY "Date" DESC) AS from_end
  FROM spine),
cases AS (
  SELECT a."Product Name", a."Date", a.y, a.from_start, a.from_end, p.period, b.y AS y_hat
  FROM positions a CROSS JOIN (VALUES (7), (14), (30)) p(period)
  LEFT JOIN positions b ON a."Product Name" = b."Product Name" AND b.from_start = a.from_start - p.period),
train AS (
  SELECT "Product Name", period, count(*) AS n_train, avg((y - y_hat) * (y - y_hat)) AS variance
  FROM cases WHERE from_end > 7 AND from_start > 30 GROUP BY 1, 2),
hold AS (
  SELECT "Product Name", period, avg(abs(y - y_hat)) AS mae, avg((y - y_hat) * (y - y_hat)) AS mse,
         sqrt(avg((y - y_hat) * (y - y_hat))) AS rmse,
         100 * avg(CASE WHEN y <> 0 THEN abs((y - y_hat) / y) END) AS mape
  FROM cases WHERE from_end <= 7 GROUP BY 1, 2),
best AS (
  SELECT * FROM (
    SELECT *, n_train * ln(greatest(variance, 1e-12)) + 2 * (period + 1) AS aic
    FROM train JOIN hold USING ("Product Name", period))
  QUALIFY row_number() OVER (PARTITION BY "Product Name" ORDER BY aic, period) = 1)"""

RATES = ", ".join(f"({y}, {r})" for y, r in INFLATION_RATES.items())

NOT_NULL_NUMBER = """CASE WHEN "Total Quantity" IN ('ten') THEN NULL ELSE TRY_CAST("Total Quantity" AS DOUBLE) END"""

CHECKED = f"""{SQL_DAILY_TEXT}, checked AS (
  SELECT *, list_filter([
      CASE WHEN "Product Name" IS NULL THEN 'Product Name must be a string' END,
      CASE WHEN {NOT_NULL_NUMBER} IS NULL THEN 'Total Quantity must be numeric' END,
      CASE WHEN {NOT_NULL_NUMBER} <= 0 THEN 'Total Quantity must be greater than 0' END,
      CASE WHEN "Date" IS NULL THEN 'Date cannot be null' END,
      CASE WHEN NOT (length("Date") >= 10 AND (
             (substr("Date", 5, 1) = '-' AND substr("Date", 8, 1) = '-')
          OR (substr("Date", 3, 1) = '-' AND substr("Date", 6, 1) = '-')
          OR (substr("Date", 3, 1) = '/' AND substr("Date", 6, 1) = '/')))
        THEN 'Date must be in a valid date format' END], lambda r: r IS NOT NULL) AS reasons
  FROM daily_text)"""


def _price_mode(parts: dict[str, str]) -> str:
    keys = ", ".join([*parts.values(), '"Product Name"'])
    shown = ", ".join([*(f'{v} AS "{k}"' for k, v in parts.items()), '"Product Name"'])
    return f"""WITH {SQL_LINES}, dated AS (
      SELECT "Product Name", "Unit Price", CAST(year("Date") AS INTEGER) AS y, CAST(month("Date") AS INTEGER) AS m, CAST(week("Date") AS INTEGER) AS w FROM lines),
    best AS ({_mode("dated", keys, '"Unit Price"', '"Most_Frequent_Cost"')})
    SELECT {shown}, "Most_Frequent_Cost" FROM best"""


def _defects() -> str:
    number = "TRY_CAST(quantity || quantity_suffix AS DOUBLE)"
    checks = {
        "null_date": '"Date" IS NULL',
        "null_price": "price IS NULL",
        "null_quantity": "quantity IS NULL",
        "null_producer": '"Producer ID" IS NULL',
        "null_store": '"Store Location" IS NULL',
        "null_product": '"Product Name" IS NULL',
        "non_iso_date": r"""NOT regexp_matches("Date", '^\d{4}-\d{2}-\d{2}')""",
        "negative_quantity": f"{number} < 0",
        "zero_quantity": f"{number} = 0",
        "numeric_store": r"""regexp_full_match("Store Location", '\d+')""",
        "unknown_product": f"{TIDY} NOT IN {SQL_PRODUCT_SET}",
        "free_item": f"price = 0 AND {number} > 0",
    }
    parts = [
        f"SELECT '{name}' AS defect, count(*) FILTER (WHERE {c}) AS defect_rows, count(*) AS n FROM raw"
        for name, c in checks.items()
    ]
    parts.append(
        """SELECT 'duplicate_id', count(*) - count(DISTINCT "Transaction ID"), count(*) FROM raw"""
    )
    union = " UNION ALL ".join(parts)
    return f"WITH {SQL_RAW} SELECT defect, defect_rows, round(defect_rows / n, 9) AS rate FROM ({union})"


ODD_STORES = f"""WITH {SQL_RAW}, n AS (SELECT *, CAST(regexp_extract("Transaction ID", '(\\d+)', 1) AS BIGINT) % 3 AS k FROM raw)
        SELECT "Date", "Transaction ID", CASE WHEN k = 0 THEN 'a "b" }}, {{' || "Store Location" || '],' || chr(92) ELSE "Store Location" END AS "Store Location",
               "Product Name", "Producer ID", CAST(price AS DOUBLE) AS "Unit Price", quantity || quantity_suffix AS "Quantity" FROM n"""

ORACLE: dict[str, str] = {
    "json_array_source": ODD_STORES,
    "json_columns_source": ODD_STORES,
    "folder_json": PIPELINE_DAILY,
    "redelivery": f"""WITH {TYPED}, named AS (
          SELECT *, {TIDY} AS product, CAST(replace(source_file, 'batch_', '') AS BIGINT) AS no FROM typed WHERE "Quantity" IS NOT NULL)
        SELECT CAST("Date" AS DATE) AS "Date", product AS "Product Name", CAST(sum("Quantity") AS BIGINT) AS "Total Quantity"
        FROM named WHERE product IN {SQL_PRODUCT_SET} AND (no % 3 <> 0 OR product < 'd') AND no % 7 <> 2 GROUP BY 1, 2""",
    "daily_demand": f"""WITH {TYPED}
        SELECT CAST("Date" AS DATE) AS "Date", {TIDY} AS "Product Name",
               CAST(sum("Quantity") AS BIGINT) AS "Total Quantity"
        FROM typed WHERE {TIDY} IN {SQL_PRODUCT_SET} AND "Quantity" IS NOT NULL GROUP BY 1, 2""",
    "clean_types": f"WITH {TYPED} SELECT * FROM typed",
    "lowercase_strings": f"""WITH {SQL_LINES}
        SELECT "Date", "Unit Price", "Quantity", lower("Transaction ID") AS "Transaction ID",
               lower("Store Location") AS "Store Location", lower("Product Name") AS "Product Name",
               lower("Producer ID") AS "Producer ID" FROM lines""",
    "product_names": f"""WITH {SQL_RAW}
        SELECT source_file, row_seq, "Product Name" AS raw_name, {TIDY} AS "Product Name" FROM raw""",
    "date_cascade": f"""{EVENTS_PARSED}
        SELECT parsed.source_file, parsed.row_seq, raw."Date" AS raw_date, parsed."Date" AS "Date"
        FROM parsed JOIN raw USING (source_file, row_seq)""",
    "calendar_features": """SELECT event_id, ts AS "Date", CAST(isodow(ts) AS INTEGER) AS day_of_week,
        CAST(isodow(ts) > 5 AS TINYINT) AS is_weekend, CAST(day(ts) AS INTEGER) AS day_of_month, CAST(dayofyear(ts) AS INTEGER) AS day_of_year,
        CAST(month(ts) AS INTEGER) AS month, CAST(week(ts) AS INTEGER) AS week_of_year FROM events""",
    "week_parts": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "Year", CAST(month(o_orderdate) AS INTEGER) AS "Month",
        CAST(week(o_orderdate) AS INTEGER) AS "Week_of_year" FROM orders""",
    "filter_products": f"""WITH {TYPED}
        SELECT source_file, row_seq, {TIDY} AS "Product Name", "Quantity" FROM typed
        WHERE {TIDY} IN {SQL_PRODUCT_SET}""",
    "drop_invalid": f"""WITH {TYPED}
        SELECT source_file, row_seq, "Product Name", "Quantity" FROM typed
        WHERE "Product Name" IS NOT NULL AND "Quantity" IS NOT NULL""",
    "price_mode_week": _price_mode({"Year": "y", "Month": "m", "Week_of_year": "w"}),
    "price_mode_month": _price_mode({"Year": "y", "Month": "m"}),
    "price_mode_year": _price_mode({"Year": "y"}),
    "price_ladder": f"""WITH {SQL_LINES},
        dated AS (SELECT *, CAST(year("Date") AS INTEGER) AS y, CAST(month("Date") AS INTEGER) AS m, CAST(week("Date") AS INTEGER) AS w FROM lines),
        mw AS ({_mode("dated", 'y, m, w, "Product Name"', '"Unit Price"', "pw")}),
        mm AS ({_mode("dated", 'y, m, "Product Name"', '"Unit Price"', "pm")}),
        my AS ({_mode("dated", 'y, "Product Name"', '"Unit Price"', "py")})
        SELECT "Transaction ID", "Date", "Product Name", "Quantity", "Producer ID", "Store Location",
               coalesce("Unit Price", pw, pm, py, 0) AS "Unit Price"
        FROM dated LEFT JOIN mw USING (y, m, w, "Product Name") LEFT JOIN mm USING (y, m, "Product Name")
                   LEFT JOIN my USING (y, "Product Name")""",
    "date_order": f"WITH {ORDER} SELECT source_file, date_order FROM file_order",
    "fill_dates": f"""WITH {FILLED} SELECT source_file, row_seq, "Transaction ID", "Date" FROM filled""",
    "dedup_transactions": f"""WITH {SQL_LINES} SELECT {TX_COLUMNS} FROM lines
        QUALIFY row_number() OVER (PARTITION BY "Transaction ID" ORDER BY "Date", "Unit Price" NULLS FIRST,
          "Quantity" NULLS FIRST, "Store Location", "Product Name", "Producer ID") = 1""",
    "duplicate_count": f"""WITH {SQL_LINES} SELECT count(*) AS rows_seen,
        count(*) - count(DISTINCT "Transaction ID") AS rows_removed FROM lines""",
    "iqr_bounds": f"""WITH {FLAGGED_LINES}, every AS (
          SELECT *, 'price' AS measure FROM price_bounds UNION ALL SELECT *, 'quantity' FROM quantity_bounds)
        SELECT "Product Name", day AS date_only, measure, n, round(lower_bound, 6) AS lower_bound,
               round(upper_bound, 6) AS upper_bound FROM every""",
    **{
        kind: f"""WITH {FLAGGED_LINES} SELECT {TX_COLUMNS}, day AS date_only, CAST(hour("Date") AS INTEGER) AS hour
            FROM flagged WHERE {kind}"""
        for kind in ("price_anomalies", "quantity_anomalies", "time_anomalies", "format_anomalies")
    },
    "anomaly_union": f"WITH {FLAGGED_LINES} {ANOMALY_UNION}",
    "clean_transactions": f"""WITH {FLAGGED_LINES} SELECT {TX_COLUMNS} FROM flagged
        WHERE "Transaction ID" NOT IN (SELECT "Transaction ID" FROM flagged
          WHERE price_anomalies OR quantity_anomalies OR time_anomalies OR format_anomalies)""",
    "zscore": f"""WITH {SQL_LINES} SELECT "Transaction ID", "Product Name", "Quantity", "Date",
        round(CASE WHEN coalesce(stddev_samp("Quantity") OVER g, 0) = 0 THEN 0
             ELSE ("Quantity" - avg("Quantity") OVER g) / stddev_samp("Quantity") OVER g END, 6) AS zscore
        FROM lines WINDOW g AS (PARTITION BY "Product Name")""",
    "post_validate_rows": f"""WITH {CHECKED}
        SELECT source_file, row_seq, "Product Name", "Total Quantity", "Date",
               array_to_string(reasons, '; ') AS anomaly_reason
        FROM checked WHERE len(reasons) > 0""",
    "post_validate_summary": f"""WITH {CHECKED}
        SELECT '' AS results, count(*) FILTER (WHERE len(reasons) > 0) > 0 AS has_errors, '' AS missing_columns,
               count(*) FILTER (WHERE len(reasons) > 0) AS error_count FROM checked""",
    "numeric_stats": f"WITH {SQL_LINES} {_stats('lines', ['Quantity', 'Unit Price'])}",
    "daily_stats": f"WITH {SQL_DAILY} {_stats('daily', ['Total Quantity'])}",
    "lag_rolling_features": f"""WITH {SQL_DAILY} SELECT "Product Name", "Date", "Total Quantity",
        CAST(isodow("Date") AS INTEGER) AS day_of_week, CAST(isodow("Date") > 5 AS TINYINT) AS is_weekend,
        CAST(day("Date") AS INTEGER) AS day_of_month, CAST(dayofyear("Date") AS INTEGER) AS day_of_year, CAST(month("Date") AS INTEGER) AS month,
        CAST(week("Date") AS INTEGER) AS week_of_year,
        CAST(lag("Total Quantity", 1) OVER s AS DOUBLE) AS lag_1,
        CAST(lag("Total Quantity", 7) OVER s AS DOUBLE) AS lag_7,
        round(CASE WHEN count("Total Quantity") OVER t = 7 THEN avg("Total Quantity") OVER t END, 6) AS rolling_mean_7
        FROM daily
        WINDOW s AS (PARTITION BY "Product Name" ORDER BY "Date"),
               t AS (PARTITION BY "Product Name" ORDER BY "Date" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "window_new": f"WITH {SQL_DAILY} {_window(13, 7)}",
    "window_ref": f"WITH {SQL_DAILY} {_window(6, 0)}",
    "forecast_metrics": f"""WITH {SQL_PREDICTIONS}, pairs AS (
          SELECT "Product Name", CAST("Total Quantity" AS DOUBLE) AS y, y_hat
          FROM daily JOIN predictions USING ("Product Name", "Date"))
        SELECT "Product Name", count(*) AS n, round(avg(abs(y - y_hat)), 6) AS mae,
               round(avg((y - y_hat) * (y - y_hat)), 6) AS mse, round(sqrt(avg((y - y_hat) * (y - y_hat))), 6) AS rmse,
               round(100 * avg(CASE WHEN y <> 0 THEN abs((y - y_hat) / y) END), 6) AS mape
        FROM pairs GROUP BY 1""",
    "ks_statistic": f"""WITH {HALVES} SELECT "Product Name", "column", n_ref, n_new,
        round(CAST(gap AS DOUBLE) / (CAST(n_ref AS DOUBLE) * n_new), 9) AS ks_statistic FROM ks_lines""",
    "data_drift": f"""WITH RECURSIVE {MONITOR} SELECT "Product Name", p_value < 0.05 AS data_drift,
        CASE WHEN p_value < 0.05 THEN 'Total Quantity' ELSE '' END AS drift_columns FROM p_data""",
    "concept_drift": f"""WITH RECURSIVE {MONITOR} SELECT "Product Name", p_value < 0.05 AS concept_drift FROM p_error""",
    "ks_p_value": f"""WITH RECURSIVE {MONITOR} SELECT "Product Name", n_ref, n_new,
        round(CAST(gap AS DOUBLE) / (n_ref * n_new), 9) AS ks_statistic, round(p_value, 9) AS p_value
        FROM ks_data JOIN p_data USING ("Product Name")""",
    "monitoring_report": f"""WITH RECURSIVE {MONITOR} SELECT "Product Name", round(rmse, 6) AS rmse, round(mape, 6) AS mape,
        data_drift, concept_drift FROM report""",
    "retrain_decision": f"""WITH RECURSIVE {MONITOR} SELECT round(avg(rmse), 6) AS mean_rmse,
        coalesce(bool_or(rmse > 20), false) AS rmse_exceeded, bool_or(data_drift) AS data_drift,
        bool_or(concept_drift) AS concept_drift,
        coalesce(bool_or(rmse > 20), false) OR bool_or(data_drift) OR bool_or(concept_drift) AS retrain
        FROM report""",
    "daily_spine": f'WITH {SQL_SPINE} SELECT "Product Name", "Date", "Total Quantity" FROM spine',
    "recent_series": f"""WITH {SQL_DAILY}, recent AS (
          SELECT * FROM daily WHERE "Date" >= (SELECT CAST(max("Date") - INTERVAL 3 YEAR AS DATE) FROM daily)),
        calendar AS (
          SELECT "Product Name", CAST(unnest(generate_series(min("Date"), max("Date"), INTERVAL 1 DAY)) AS DATE) AS "Date"
          FROM recent GROUP BY "Product Name")
        SELECT "Product Name", "Date", coalesce("Total Quantity", 0) AS "Total Quantity"
        FROM calendar LEFT JOIN recent USING ("Product Name", "Date")""",
    "forward_filled_series": f"""WITH {SQL_SPINE}
        SELECT "Product Name", "Date",
               last_value(d."Total Quantity" IGNORE NULLS) OVER (PARTITION BY "Product Name" ORDER BY "Date"
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "Total Quantity"
        FROM calendar LEFT JOIN daily d USING ("Product Name", "Date")""",
    "dickey_fuller": f"""WITH {SQL_SPINE}, steps AS (
          SELECT "Product Name", CAST(lag("Total Quantity") OVER s AS DOUBLE) AS x,
                 CAST("Total Quantity" - lag("Total Quantity") OVER s AS DOUBLE) AS y
          FROM spine WINDOW s AS (PARTITION BY "Product Name" ORDER BY "Date")),
        sums AS (SELECT "Product Name", count(*) AS n, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy,
                        regr_syy(y, x) AS syy FROM steps WHERE x IS NOT NULL GROUP BY 1)
        SELECT "Product Name", n,
               round((sxy / sxx) / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx), 6) AS df_statistic FROM sums""",
    "seasonal_baseline": f"""WITH {BASELINE} SELECT "Product Name", round(aic, 5) AS aic, period, n_train,
        round(mae, 6) AS mae, round(mse, 6) AS mse, round(rmse, 6) AS rmse, round(mape, 6) AS mape FROM best""",
    "seasonal_forecast": f"""WITH {BASELINE}
        SELECT "Product Name", CAST("Date" + CAST(b.period AS INTEGER) AS DATE) AS "Date", y AS y_hat
        FROM positions p JOIN best b USING ("Product Name")
        WHERE p.from_end BETWEEN b.period - 6 AND b.period""",
    "inflation_price": f"""WITH rates(y, r) AS (VALUES {RATES}),
        factors AS (
          SELECT s.y AS start_year, e.y AS year,
                 coalesce((SELECT product(1 + r / 100) FROM rates WHERE y > s.y AND y <= e.y), 1.0) AS factor
          FROM rates s, rates e)
        SELECT o_orderkey, CAST(year(o_orderdate) + 8 AS INTEGER) AS year, round(o_totalprice * factor, 2) AS price
        FROM orders JOIN factors ON start_year = 2005 AND factors.year = year(o_orderdate) + 8""",
    "unpivot_demand": f"""WITH {SQL_DAILY} SELECT "Date", "Product Name", "Total Quantity" AS demand
        FROM daily WHERE "Total Quantity" > 0""",
    "business_hours": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
        CAST(o_orderdate AS DATE) + INTERVAL 8 HOUR + to_microseconds(
          CASE WHEN count(*) OVER d > 1 THEN CAST(round(43200000000.0 * (row_number() OVER s - 1)
            / (count(*) OVER d - 1)) AS BIGINT) ELSE 0 END) AS "timestamp"
        FROM orders WINDOW d AS (PARTITION BY CAST(o_orderdate AS DATE)),
                           s AS (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey)""",
    "price_influence": f"""WITH {SQL_LINES} SELECT "Transaction ID", "Date", "Product Name", "Unit Price",
        round("Unit Price" / avg("Unit Price") OVER (PARTITION BY "Product Name") * 0.5, 6) AS influence
        FROM lines""",
    "demand_composition": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(round_even(greatest(l_quantity * (1 + l_discount)
          * (0.05::DOUBLE * (((date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 7) + 7) % 7) + 0.8::DOUBLE)
          * CASE WHEN isodow(l_shipdate) >= 6 AND l_orderkey % 5 = 0 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END
          + (l_linenumber - 4) * 2.5::DOUBLE, 0.0::DOUBLE), 0) AS BIGINT) AS demand FROM lineitem""",
    "quality_profile": _defects(),
    "version_diff": """WITH old AS (SELECT source || '/' || doc_id AS file_path, md5(text) AS m FROM documents),
        new AS (SELECT CASE WHEN doc_id % 10 = 3 THEN 'moved/' ELSE '' END || source || '/' || doc_id AS file_path,
                       md5(CASE WHEN doc_id % 7 = 0 THEN text || ' ' ELSE text END) AS m FROM documents)
        SELECT file_path, CASE WHEN o.m IS NULL THEN 'added' WHEN n.m IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM old o FULL OUTER JOIN new n USING (file_path)
        WHERE o.m IS NULL OR n.m IS NULL OR o.m <> n.m""",
    "csv_source": f"""WITH {SQL_RAW} SELECT "Date", "Transaction ID", "Store Location", "Product Name", "Producer ID",
        CAST(price AS DOUBLE) AS "Unit Price", quantity || quantity_suffix AS "Quantity" FROM raw""",
    "json_source": f"""WITH {SQL_RAW} SELECT "Date", "Transaction ID", "Store Location", "Product Name", "Producer ID",
        CAST(price AS DOUBLE) AS "Unit Price", quantity || quantity_suffix AS "Quantity" FROM raw""",
    "file_verdicts": f"""WITH {SQL_RAW}, files AS (
          SELECT source_file, CAST(replace(source_file, 'batch_', '') AS BIGINT) AS no, count(*) AS rows FROM raw GROUP BY 1)
        SELECT source_file, rows, CASE WHEN no % 2 = 1 THEN 'Missing columns: Unit Price, Producer ID' END AS error,
               no % 2 = 0 AS valid FROM files""",
    "batch_status": f"""WITH {SQL_RAW}, files AS (
          SELECT DISTINCT CAST(replace(source_file, 'batch_', '') AS BIGINT) AS no FROM raw)
        SELECT count(*) AS files, count(*) FILTER (WHERE no % 2 = 0) AS valid_files,
               CASE WHEN count(*) FILTER (WHERE no % 2 = 0) = count(*) THEN 0
                    WHEN count(*) FILTER (WHERE no % 2 = 0) > 0 THEN 1 ELSE 2 END AS status FROM files""",
    "pipeline_rows": f"""WITH {PIPELINE} SELECT source_file, row_seq, "Date", product AS "Product Name",
        price AS "Unit Price", quantity AS "Quantity", price_anomalies, quantity_anomalies, time_anomalies,
        format_anomalies FROM flagged""",
    "pipeline_anomalies": f"WITH {PIPELINE} "
    + " UNION ALL ".join(
        f"""SELECT source_file, row_seq, tx AS "Transaction ID", product AS "Product Name",
            '{kind}' AS anomaly_type FROM flagged WHERE {kind}"""
        for kind in ("price_anomalies", "quantity_anomalies", "time_anomalies", "format_anomalies")
    ),
    "pipeline_daily": PIPELINE_DAILY,
    "pipeline_stats": f"WITH {PIPELINE} {_stats('result', ['Total Quantity'], 'source_file,')}",
    "folder_pipeline": PIPELINE_DAILY,
    "stream_pipeline": PIPELINE_DAILY,
    "folder_quoted": PIPELINE_DAILY,
    "live_daily": f"""WITH {SQL_RAW}, {SQL_PARSED}, known AS (
          SELECT source_file, row_seq, "Date" AS moment, {TIDY} AS product, {QTY} AS quantity, "Transaction ID" AS tx
          FROM parsed WHERE "Date" IS NOT NULL AND {TIDY} IN {SQL_PRODUCT_SET}),
        firsts AS (SELECT * FROM known QUALIFY row_number() OVER (PARTITION BY tx ORDER BY moment, source_file, row_seq) = 1)
        SELECT CAST(moment AS DATE) AS "Date", product AS "Product Name", CAST(sum(quantity) AS BIGINT) AS "Total Quantity" FROM firsts GROUP BY 1, 2""",
    "quoted_csv": f"""WITH {SQL_RAW}, n AS (SELECT *, CAST(regexp_extract("Transaction ID", '(\\d+)', 1) AS BIGINT) % 3 AS k FROM raw)
        SELECT "Date", "Transaction ID", CASE WHEN k = 0 THEN 'Main "St", ' || "Store Location" || chr(10) || chr(10) || 'second, floor' || chr(10)
               WHEN k = 1 THEN "Store Location" || chr(10) || '"' ELSE "Store Location" END AS "Store Location",
               "Product Name", "Producer ID", CAST(price AS DOUBLE) AS "Unit Price", quantity || quantity_suffix AS "Quantity" FROM n""",
    "quoted_verdicts": f"""WITH {SQL_RAW} SELECT source_file, count(*) AS rows, CAST(NULL AS VARCHAR) AS error, true AS valid
        FROM raw GROUP BY 1""",
    "folder_bad_values": f"""SELECT * FROM ({PIPELINE_DAILY}) d
        WHERE CAST(replace(source_file, 'batch_', '') AS BIGINT) % 2 = 0""",
    "bad_value_verdicts": f"""WITH {SQL_RAW} SELECT DISTINCT source_file,
        CASE WHEN CAST(replace(source_file, 'batch_', '') AS BIGINT) % 2 = 1 THEN 'Bad value in Quantity' END AS error FROM raw""",
    "batch_report": f"""WITH {SQL_RAW}, files AS (
          SELECT DISTINCT source_file, CAST(replace(source_file, 'batch_', '') AS BIGINT) % 2 = 1 AS bad FROM raw)
        SELECT source_file, CASE WHEN bad THEN 1 ELSE 2 END AS section,
               CASE WHEN bad THEN 'Missing columns: Unit Price, Producer ID' END AS reason FROM files""",
    "sql_window": f"""WITH {SQL_DAILY} SELECT * FROM daily
        WHERE "Date" > (SELECT max("Date") FROM daily) - INTERVAL 7 DAY AND "Total Quantity" >= (SELECT avg("Total Quantity") FROM daily)""",
    "required_columns": f"""WITH {SQL_LINES} SELECT "Transaction ID", 'Missing columns: Total Quantity' AS reasons FROM lines""",
    "file_names": """SELECT DISTINCT 'processed_' || replace(source, ' ', '_') || '_' || (doc_id % 50) || '.v2.csv' AS output_name FROM documents""",
    "content_digest": f"""WITH {SQL_LINES}, h AS (
          SELECT "Product Name", md5(concat_ws(chr(31), coalesce(CAST("Quantity" AS VARCHAR), '∅'), coalesce("Transaction ID", '∅'),
                 coalesce("Store Location", '∅'), coalesce("Product Name", '∅'), coalesce("Producer ID", '∅'))) AS m FROM lines)
        SELECT "Product Name", count(*) AS rows,
               sum(CAST(('0x' || substr(m, 1, 15)) AS BIGINT)) || '-' || sum(CAST(('0x' || substr(m, 16, 15)) AS BIGINT)) AS digest
        FROM h GROUP BY 1""",
    "file_inventory": """WITH t AS (
          SELECT 'part' || (doc_id % 16) AS file, doc_id,
                 doc_id || ' ' || translate(coalesce(text, ''), chr(13) || chr(10), '  ') AS line FROM documents),
        n AS (SELECT file, line, row_number() OVER (PARTITION BY file ORDER BY doc_id) AS no FROM t),
        h AS (SELECT file, strlen(line) + 1 AS bytes, md5(no || ':' || line) AS m FROM n)
        SELECT file, CAST(sum(bytes) AS BIGINT) AS size, sum(bytes) || '-' || count(*) || '-' || sum(CAST(('0x' || substr(m, 1, 15)) AS BIGINT))
               || '-' || sum(CAST(('0x' || substr(m, 16, 15)) AS BIGINT)) AS digest
        FROM h GROUP BY 1""",
}


def _gram(lags: str, skip: str) -> str:
    """Cross products of constant, lagged steps, level and step over the rows from ``skip`` on."""
    return f"""list_transform(range(1, {lags} + 4), lambda i: list_transform(range(1, {lags} + 4), lambda j:
        list_sum(list_transform(range({skip}, n - 1), lambda a:
            (CASE WHEN i = 1 THEN 1.0 WHEN i = {{level}} THEN lv[a + 1] WHEN i = {lags} + 3 THEN st[a + 1] ELSE st[a + 1 - (i - {{back}})] END)
          * (CASE WHEN j = 1 THEN 1.0 WHEN j = {{level}} THEN lv[a + 1] WHEN j = {lags} + 3 THEN st[a + 1] ELSE st[a + 1 - (j - {{back}})] END)))))"""


_ELIMINATED = "list_transform(m, lambda r: list_transform(range(1, len(m) + 1), lambda j: r[j] - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1]))"

ORACLE["stationarity"] = f"""WITH RECURSIVE {SQL_SPINE}, s AS (
  SELECT "Product Name" AS p, CAST("Total Quantity" AS DOUBLE) AS y, row_number() OVER w AS rn,
         lag(CAST("Total Quantity" AS DOUBLE)) OVER w AS lv FROM spine WHERE "Total Quantity" IS NOT NULL
  WINDOW w AS (PARTITION BY "Product Name" ORDER BY "Date")),
g AS (SELECT p, count(*) AS n, list(lv ORDER BY rn) FILTER (WHERE rn > 1) AS lv, list(y - lv ORDER BY rn) FILTER (WHERE rn > 1) AS st,
         max(y) > min(y) AS varies, least(ceil(12 * pow(count(*) / 100.0, 0.25)), count(*) // 2 - 2)::BIGINT AS top FROM s GROUP BY p),
one AS (SELECT p, 0 AS k, {_gram("top", "top").format(level=2, back=2)} AS m, []::DOUBLE[] AS rest, n, top
        FROM g WHERE n >= 8 AND top >= 0 AND varies),
e AS (SELECT * FROM one UNION ALL
      SELECT p, k + 1, x, list_append(rest, x[top + 3][top + 3]), n, top
      FROM (SELECT p, k, {_ELIMINATED} AS x, rest, n, top FROM e WHERE k < top + 2)),
b AS (SELECT p, unnest(range(0, top + 1)) AS lags,
         unnest(list_transform(rest[2:], lambda r, k: (n - 1 - top) * ln(greatest(r, 1e-300) / (n - 1 - top)) + 2 * (k + 1))) AS aic
      FROM e WHERE k = top + 2),
best AS (SELECT p, lags FROM b QUALIFY row_number() OVER (PARTITION BY p ORDER BY aic, lags) = 1),
two AS (SELECT p, 0 AS k, {_gram("lags", "lags").format(level="lags + 2", back=1)} AS m, n, lags FROM g JOIN best USING (p)),
f AS (SELECT * FROM two UNION ALL SELECT p, k + 1, {_ELIMINATED}, n, lags FROM f WHERE k < lags + 1),
t AS (SELECT p, lags, n - 1 - lags AS used, m[lags + 2][lags + 2] AS sxx, m[lags + 2][lags + 3] AS sxy, m[lags + 3][lags + 3] AS syy
      FROM f WHERE k = lags + 1),
a AS (SELECT p, lags, used, sxy / sxx / sqrt((syy - sxy * sxy / sxx) / (used - lags - 2) / sxx) AS tau FROM t),
z AS (SELECT *, CASE WHEN tau <= -1.61 THEN 2.1659 + 1.4412 * tau + 0.038269 * tau * tau
             ELSE 1.7339 + 0.93202 * tau - 0.12745 * tau * tau - 0.010368 * tau * tau * tau END AS x FROM a),
q AS (SELECT *, CASE WHEN tau > 2.74 THEN 1.0 WHEN tau < -18.83 THEN 0.0 WHEN x < -7 THEN 0.0 WHEN x > 7 THEN 1.0 ELSE
        0.5 + exp(-x * x / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 150), lambda k:
          sign(x) * exp((2 * k + 1) * ln(greatest(abs(x), 1e-300)) - (k + 1) * ln(2) - lgamma(k + 1.5) + ln(pi()) / 2))) END AS pv FROM z)
SELECT g.p AS "Product Name", round(tau, 6) AS adf_statistic, CAST(lags AS INT) AS adf_lags, CAST(coalesce(used, g.n) AS INT) AS n_used,
       round(pv, 6) AS p_value, CASE WHEN pv < 0.05 THEN 'Yes' ELSE 'No' END AS stationary
FROM g LEFT JOIN q ON g.p = q.p"""


def _smoothed(name: str, upto: str, points: str) -> str:
    """Level, trend and seasons after every day: a recursion over the days, from the end of the first season."""
    keys = "s.p, s.period, s.alpha, s.beta, s.gamma, s.score_from"
    return f"""SELECT {keys}, v.n, v.last_date, s.period AS pos, v.f AS level, (v.l - v.f) / s.period AS trend,
           list_transform(v.head, lambda x: x - v.f) AS seasons, 0.0::DOUBLE AS sse
      FROM {points} s JOIN halves v ON v.p = s.p AND v.period = s.period
    UNION ALL
    SELECT {keys}, n, last_date, pos + 1, level_, beta * (level_ - level) + (1 - beta) * trend,
           list_append(seasons[2:], gamma * (y - level_) + (1 - gamma) * seasons[1]),
           sse + CASE WHEN pos >= score_from THEN miss * miss ELSE 0.0 END
      FROM (SELECT s.*, o.y, o.y - (s.level + s.trend + s.seasons[1]) AS miss,
                   s.alpha * (o.y - s.seasons[1]) + (1 - s.alpha) * (s.level + s.trend) AS level_
            FROM {name} s JOIN obs o ON o.p = s.p AND o.pos = s.pos WHERE s.pos < {upto}) s"""


_POINTS = ", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {g}::DOUBLE)" for a in LEVEL_WEIGHTS for b in TREND_WEIGHTS for g in SEASON_WEIGHTS)

SMOOTHED = f"""{SQL_SPINE},
obs AS (SELECT "Product Name" AS p, CAST("Total Quantity" AS DOUBLE) AS y,
               row_number() OVER (PARTITION BY "Product Name" ORDER BY "Date") - 1 AS pos FROM spine),
sizes AS (SELECT "Product Name" AS p, count(*) AS n, max("Date") AS last_date FROM spine GROUP BY 1),
usable AS (SELECT p, period FROM sizes, (VALUES (7), (14), (30)) t(period) WHERE n - 7 >= 2 * period),
starts AS (SELECT p, max(period) AS score_from FROM usable GROUP BY 1),
halves AS (SELECT u.p, u.period, any_value(s.n) AS n, any_value(s.last_date) AS last_date,
                  sum(o.y) FILTER (WHERE o.pos < period) / period AS f, sum(o.y) FILTER (WHERE o.pos >= period) / period AS l,
                  list(o.y ORDER BY o.pos) FILTER (WHERE o.pos < period) AS head
           FROM usable u JOIN sizes s USING (p) JOIN obs o ON o.p = u.p AND o.pos < 2 * period GROUP BY 1, 2),
grid AS (SELECT p, period, alpha, beta, gamma, score_from
         FROM usable JOIN starts USING (p), (VALUES {_POINTS}) t(alpha, beta, gamma)),
fold AS ({_smoothed("fold", "s.n - 7", "grid")}),
best AS (SELECT p, period, alpha, beta, gamma, score_from, n, n - 7 - score_from AS n_scored, level, trend, seasons,
                round((n - 7 - score_from) * ln(greatest(sse / (n - 7 - score_from), 1e-12)) + 2 * (period + 5), 6) AS aic
         FROM fold WHERE pos = n - 7
         QUALIFY row_number() OVER (PARTITION BY p ORDER BY aic, period, alpha, beta, gamma) = 1)"""

ORACLE["smoothed_baseline"] = f"""WITH RECURSIVE {SMOOTHED},
cases AS (SELECT b.*, o.y, level + (o.pos - n + 8) * trend + seasons[1 + (o.pos - n + 7) % period] AS y_hat
          FROM best b JOIN obs o ON o.p = b.p AND o.pos >= b.n - 7)
SELECT p AS "Product Name", round(aic, 4) AS aic, CAST(period AS INT) AS period, alpha, beta, gamma, CAST(n_scored AS INT) AS n_scored,
       round(avg(abs(y - y_hat)), 6) AS mae, round(avg((y - y_hat) * (y - y_hat)), 6) AS mse, round(sqrt(avg((y - y_hat) * (y - y_hat))), 6) AS rmse,
       round(100 * avg(CASE WHEN y <> 0 THEN abs((y - y_hat) / y) END), 6) AS mape
FROM cases GROUP BY ALL"""

ORACLE["smoothed_forecast"] = f"""WITH RECURSIVE {SMOOTHED},
chosen AS (SELECT p, period, alpha, beta, gamma, score_from FROM best),
whole AS ({_smoothed("whole", "s.n", "chosen")})
SELECT p AS "Product Name", CAST(last_date + CAST(h AS INTEGER) AS DATE) AS "Date", round(level + h * trend + seasons[1 + (h - 1) % period], 6) AS y_hat
FROM whole, range(1, 8) t(h) WHERE pos = n"""

ORACLE["stats_document"] = ORACLE["daily_stats"]

ORACLE["version_log"] = """WITH v AS (
  SELECT 1 AS day, source, doc_id, text FROM documents
  UNION ALL SELECT 2, source, doc_id, CASE WHEN doc_id % 7 = 0 THEN text || ' ' ELSE text END FROM documents WHERE doc_id % 10 <> 3),
f AS (SELECT day, source || '/' || doc_id AS file_path, text FROM v)
SELECT file_path, '{"timestamp":"2024-01-0' || day || 'T00:00:00","file":{"file_path":"' || file_path || '","size":' || strlen(text)
       || ',"digest":"' || md5(text) || '","updated":"1970-01-01T00:00:00.000Z"}}' AS document FROM f
UNION ALL SELECT NULL, '{"timestamp":"2024-01-03T00:00:00"}'"""

ORACLE["version_success"] = """SELECT 'long texts' AS "case", count(*) FILTER (WHERE length(text) > 1000) > 0 OR count(*) = 0 AS success FROM documents
UNION ALL SELECT 'nothing', count(*) = 0 FROM documents UNION ALL SELECT 'none found', true"""

ORACLE["empty_daily"] = f"""WITH {SQL_DAILY_TEXT}, none AS (SELECT * FROM daily_text WHERE length("Total Quantity") < 0)
SELECT CASE WHEN count(*) = 0 THEN '{EMPTY_MESSAGE}' ELSE '' END AS results, count(*) > 0 AS has_errors, '' AS missing_columns,
       count(*) AS error_count FROM none"""

ORACLE["post_validation"] = f"""WITH {SQL_DAILY}, taken AS (
  SELECT "Product Name", CASE WHEN dayofyear("Date") % 50 = 0 THEN -"Total Quantity" ELSE "Total Quantity" END AS q FROM daily)
SELECT "Product Name", round(avg(q), 6) AS mean, CAST(min(q) AS DOUBLE) AS min, CAST(max(q) AS DOUBLE) AS max,
       CASE WHEN count(*) FILTER (WHERE q <= 0) > 0 THEN '{POSITIVE_MESSAGE}' END AS anomaly_reason,
       nullif(count(*) FILTER (WHERE q <= 0), 0) AS failing,
       (SELECT count(*) FROM taken WHERE q <= 0) = 0 AS passed
FROM taken GROUP BY 1"""

ORACLE["base_price"] = """SELECT p_partkey, round(CASE WHEN p_partkey % 3 = 0 THEN CAST(p_retailprice AS DOUBLE) * 2 + 0.004
  ELSE CAST(p_retailprice AS DOUBLE) END, 2) AS price FROM part"""

ORACLE["forward_fill"] = f"""WITH {SQL_DAILY}
SELECT "Date", "Product Name", last_value(CASE WHEN day("Date") % 3 <> 0 THEN "Total Quantity" END IGNORE NULLS) OVER w AS "Total Quantity",
       last_value(CASE WHEN isodow("Date") = 1 THEN "Total Quantity" END IGNORE NULLS) OVER w AS weekly
FROM daily WINDOW w AS (PARTITION BY "Product Name" ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

ORACLE["range_diff"] = """WITH docs AS (
  SELECT doc_id, 'part' || (doc_id % 16) AS file_path, translate(coalesce(text, ''), chr(13) || chr(10), '  ') AS text FROM documents),
versions AS (
  SELECT 'old' AS v, file_path, doc_id, text FROM docs WHERE doc_id % 16 <> 3
  UNION ALL SELECT 'new', file_path, doc_id, CASE WHEN doc_id % 97 = 5 THEN translate(text, 'ae', 'ea') ELSE text END
  FROM docs WHERE doc_id % 16 <> 7 AND NOT (doc_id % 16 = 2 AND doc_id > 500)),
files AS (SELECT v, file_path, hex(encode(string_agg(doc_id || ' ' || text || chr(10), '' ORDER BY doc_id))) AS h FROM versions GROUP BY 1, 2),
blocks AS (SELECT v, file_path, unnest(range(0, (length(h) + 8191) // 8192)) AS node, h FROM files),
cut AS (SELECT v, file_path, node, substr(h, node * 8192 + 1, 8192) AS part FROM blocks),
differing AS (
  SELECT file_path, node, coalesce(length(o.part), 0) // 2 AS a, coalesce(length(n.part), 0) // 2 AS b
  FROM (SELECT * FROM cut WHERE v = 'old') o FULL JOIN (SELECT * FROM cut WHERE v = 'new') n USING (file_path, node)
  WHERE o.part IS DISTINCT FROM n.part),
spans AS (
  SELECT file_path, 'changed' AS change, node * 4096 AS s, node * 4096 + least(a, b) AS e FROM differing WHERE least(a, b) > 0
  UNION ALL SELECT file_path, CASE WHEN b > a THEN 'added' ELSE 'removed' END, node * 4096 + least(a, b), node * 4096 + greatest(a, b)
  FROM differing WHERE a <> b),
marked AS (SELECT *, CASE WHEN lag(e) OVER w IS NOT DISTINCT FROM s THEN 0 ELSE 1 END AS begins FROM spans
           WINDOW w AS (PARTITION BY file_path, change ORDER BY s)),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY file_path, change ORDER BY s) AS k FROM marked)
SELECT file_path, change, CAST(min(s) AS BIGINT) AS "start", CAST(max(e) AS BIGINT) AS "end" FROM numbered GROUP BY file_path, change, k"""
