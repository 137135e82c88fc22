"""DuckDB SQL that states each query's result independently of the Spark code."""

from __future__ import annotations

# Fixed values, equal to those in `inputs`.
ANCHOR = "DATE '2001-08-01'"
INGESTED = "'2001-08-02T00:00:00+00:00'"

LANDING_COLUMNS = (
    "row_id, order_id, order_date, ship_date, ship_mode, customer_id, customer_name, segment, "
    "country, city, _source_file"
)
SILVER_COLUMNS = [
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id",
    "customer_first_name", "customer_last_name", "segment", "country", "city",
    "year", "month", "day",
]


def _parsed(text: str) -> str:
    return (
        f"CAST(try_strptime(CASE WHEN regexp_full_match({text}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') "
        f"THEN {text} END, '%m/%d/%Y') AS DATE)"
    )


def _back(months: int) -> str:
    return f"CAST({ANCHOR} - INTERVAL {months} MONTH AS DATE)"


LANDING = f"""
landing AS (
  SELECT
    CASE WHEN l_orderkey % 501 = 0 THEN 'x'
         ELSE CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) END AS row_id,
    concat(' ORD-', CAST(l_orderkey AS VARCHAR), ' ') AS order_id,
    CASE WHEN l_orderkey % 97 = 0 THEN '1998-10-03' WHEN l_orderkey % 89 = 0 THEN NULL
         ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS order_date,
    strftime(shipped, '%-m/%-d/%Y') AS ship_date,
    concat(' ', CASE flag WHEN 'A' THEN 'First Class' WHEN 'N' THEN 'Second Class'
                          ELSE 'Standard Class' END) AS ship_mode,
    concat('CUST-', CAST(o_custkey AS VARCHAR)) AS customer_id,
    CASE o_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN replace(c_name, '#', ' ')
         WHEN 2 THEN concat(' ', replace(c_name, '#', ' van '), ' ')
         ELSE replace(c_name, '#', '  ') END AS customer_name,
    CASE WHEN l_orderkey % 5 = 0 THEN 'VIP ' ELSE c_mktsegment END AS segment,
    n_name AS country,
    concat('CITY_', CAST(supplier % 50 AS VARCHAR)) AS city,
    CASE WHEN o_orderdate < TIMESTAMP '2000-01-01 00:00:00' THEN 'landing/b1.csv'
         ELSE 'landing/b2.csv' END AS _source_file
  FROM (SELECT l_orderkey, l_linenumber, min(l_shipdate) AS shipped, min(l_returnflag) AS flag,
               min(l_suppkey) AS supplier
        FROM lineitem GROUP BY l_orderkey, l_linenumber) lines
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""

BRONZE = f"""
bronze AS (
  SELECT *, CAST(year(_order_date_parsed) AS INTEGER) AS year,
         CAST(month(_order_date_parsed) AS INTEGER) AS month,
         CAST(day(_order_date_parsed) AS INTEGER) AS day
  FROM (SELECT *, {_parsed('order_date')} AS _order_date_parsed FROM landing) parsed
)"""

SILVER = f"""
silver AS (
  SELECT TRY_CAST(row_id AS INTEGER) AS row_id, trim(order_id) AS order_id,
         {_parsed('order_date')} AS order_date, {_parsed('ship_date')} AS ship_date,
         trim(ship_mode) AS ship_mode, trim(customer_id) AS customer_id,
         split_part(trim(customer_name), ' ', 1) AS customer_first_name,
         CASE WHEN strpos(trim(customer_name), ' ') > 0
              THEN substr(trim(customer_name), strpos(trim(customer_name), ' ') + 1) END
           AS customer_last_name,
         trim(segment) AS segment, trim(country) AS country, trim(city) AS city,
         year, month, day
  FROM bronze
)"""


def _sales(name: str, rows: str) -> str:
    return f"""
{name} AS (
  SELECT order_id, order_date, ship_date AS shipment_date, ship_mode AS shipment_mode, city,
         year, month, day
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id
          ORDER BY row_id ASC NULLS LAST, ship_date ASC NULLS LAST, ship_mode ASC NULLS LAST,
                   city ASC NULLS LAST) AS rn FROM {rows}) ranked
  WHERE rn = 1
)"""


def _metrics(rows: str) -> str:
    def counted(months: int) -> str:
        return (
            f"count(DISTINCT CASE WHEN order_date > {_back(months)} AND order_date <= {ANCHOR} "
            "THEN order_id END)"
        )

    return f"""
    SELECT customer_id, {counted(1)} AS orders_last_month, {counted(6)} AS orders_last_6_months,
           count(DISTINCT order_id) AS orders_all_time
    FROM (SELECT customer_id, order_id, max(order_date) AS order_date
          FROM {rows} GROUP BY customer_id, order_id) orders_of
    GROUP BY customer_id"""


def _latest(rows: str) -> str:
    return f"""
    SELECT customer_id, customer_first_name, customer_last_name, segment, country
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
            ORDER BY order_date DESC NULLS LAST, row_id DESC NULLS LAST,
                     segment DESC NULLS LAST) AS rn FROM {rows}) ranked
    WHERE rn = 1"""


def _customers(name: str, rows: str) -> str:
    return f"""
{name} AS (
  SELECT l.customer_id, customer_first_name, customer_last_name, segment AS customer_segment,
         country, orders_last_month, orders_last_6_months, orders_all_time
  FROM ({_latest(rows)}) l JOIN ({_metrics(rows)}) m ON l.customer_id = m.customer_id
)"""


def _merged(columns: list[str], key: str) -> str:
    """The upsert of `source` into `target`."""
    picked = ", ".join(
        f"CASE WHEN s.{key} IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in columns
    )
    return f"""
SELECT {picked} FROM target t LEFT JOIN source s ON t.{key} = s.{key}
UNION ALL
SELECT {', '.join('s.' + c for c in columns)} FROM source s
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.{key} = s.{key})"""


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + then


_SILVER_PARTS = (LANDING, BRONZE, SILVER)
_SALES_PARTS = (*_SILVER_PARTS, _sales("gold_sales", "silver"))
_CUSTOMER_PARTS = (*_SILVER_PARTS, _customers("gold_customer", "silver"))
_KEYED = "keyed AS (SELECT * FROM silver WHERE row_id IS NOT NULL)"

_SILVER_TARGET = "target AS (SELECT * FROM silver WHERE row_id % 7 <> 0 OR row_id IS NULL)"
_SILVER_SOURCE = """
source AS (
  SELECT * REPLACE ('Same Day' AS ship_mode,
                    CASE WHEN row_id % 26 = 0 THEN NULL ELSE city END AS city,
                    2002 AS year, 1 AS month, 1 AS day)
  FROM silver WHERE row_id % 13 = 0 OR row_id IS NULL
)"""

_SALES_TARGET = _sales("target", "(SELECT * FROM silver WHERE order_date < DATE '2000-01-01' OR order_date IS NULL)")
_SALES_SOURCE = "source AS (SELECT * FROM gold_sales)"
_CUSTOMER_TARGET = _customers("target", "(SELECT * FROM silver WHERE order_date < DATE '1999-01-01')")
_CUSTOMER_SOURCE = "source AS (SELECT * FROM gold_customer)"

_SALES_COLUMNS = ["order_id", "order_date", "shipment_date", "shipment_mode", "city", "year", "month", "day"]
_CUSTOMER_COLUMNS = [
    "customer_id", "customer_first_name", "customer_last_name", "customer_segment", "country",
    "orders_last_month", "orders_last_6_months", "orders_all_time",
]

_KEYS = """
accepted AS (
  SELECT 'b' AS bucket, k AS key
  FROM (SELECT concat(CASE WHEN event_id % 3 = 0 THEN 'other/' ELSE 'landing/' END, 'f ',
                      CAST(event_id AS VARCHAR),
                      CASE event_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.CSV' WHEN 2 THEN '.txt'
                                        ELSE '.csv.gz' END) AS k
        FROM events) named
  WHERE starts_with(k, 'landing/') AND lower(k) LIKE '%.csv'
)"""

_ALL_SALES = "SELECT * FROM gold_sales"

_EARLY = "early AS (SELECT * FROM keyed WHERE row_id % 7 <> 0)"
_LATE = """
late AS (
  SELECT * EXCLUDE (june, moved)
           REPLACE (moved AS order_date, CASE WHEN row_id % 2 = 1 THEN city END AS city,
                    CAST(year(moved) AS INTEGER) AS year, CAST(month(moved) AS INTEGER) AS month,
                    CAST(day(moved) AS INTEGER) AS day)
  FROM (
    SELECT *, coalesce(year(order_date) = 1997 AND month(order_date) = 6, false) AS june,
           CASE WHEN june THEN CAST(order_date + INTERVAL 1 MONTH AS DATE)
                WHEN row_id % 5 = 0 THEN NULL
                WHEN row_id % 5 = 1 THEN CAST(order_date + INTERVAL 1 DAY AS DATE)
                ELSE order_date END AS moved
    FROM keyed
  ) WHERE row_id % 17 = 0 OR june OR row_id % 7 = 0
)"""


def _crowded(rows: str) -> str:
    """The rows in one partition per year, and every third one in that of the undated rows."""
    dated = "row_id % 3 <> 0 AND year IS NOT NULL"
    return (
        f"SELECT * REPLACE (CASE WHEN {dated} THEN year END AS year, CASE WHEN {dated} THEN 1 END AS month, "
        f"CASE WHEN {dated} THEN 1 END AS day) FROM {rows}"
    )


def _listed(columns: list[str], key: str) -> str:
    """The upsert, and that the manifest lists the file of every row."""
    return f"SELECT *, true AS listed FROM ({_merged(columns, key)})"


def oracles() -> dict[str, str]:
    return {
        "csv_scan": _with(LANDING, then=f"SELECT {LANDING_COLUMNS} FROM landing"),
        "bronze_rows": _with(
            LANDING, BRONZE, then=f"SELECT *, {INGESTED} AS _ingested_at FROM bronze"
        ),
        "bronze_partitions": _with(
            LANDING, BRONZE,
            then="SELECT year, month, day, count(*) AS n FROM bronze GROUP BY year, month, day",
        ),
        "bronze_append": _with(
            LANDING,
            then="SELECT * EXCLUDE (city) FROM landing WHERE _source_file = 'landing/b1.csv' "
            "UNION ALL BY NAME SELECT * FROM landing WHERE _source_file = 'landing/b2.csv'",
        ),
        "bronze_settled": _with(LANDING, BRONZE, then="SELECT * FROM bronze"),
        "bronze_slice": _with(
            LANDING, BRONZE, then="SELECT * FROM bronze WHERE _source_file = 'landing/b2.csv'"
        ),
        "silver_rows": _with(*_SILVER_PARTS, then="SELECT * FROM silver"),
        "upsert_silver": _with(
            *_SILVER_PARTS, _SILVER_TARGET, _SILVER_SOURCE, then=_merged(SILVER_COLUMNS, "row_id")
        ),
        "upsert_empty": _with(*_SILVER_PARTS, _SILVER_TARGET, then="SELECT * FROM target"),
        "gold_sales": _with(*_SALES_PARTS, then=_ALL_SALES),
        "upsert_sales": _with(
            *_SALES_PARTS, _SALES_TARGET, _SALES_SOURCE, then=_merged(_SALES_COLUMNS, "order_id")
        ),
        "gold_sales_pruned": _with(*_SALES_PARTS, then=f"{_ALL_SALES} WHERE year = 2000 AND month = 6"),
        "customer_metrics": _with(*_SILVER_PARTS, then=_metrics("silver")),
        "customer_latest": _with(*_SILVER_PARTS, then=_latest("silver")),
        "gold_customer": _with(*_CUSTOMER_PARTS, then="SELECT * FROM gold_customer"),
        "upsert_customer": _with(
            *_CUSTOMER_PARTS, _CUSTOMER_TARGET, _CUSTOMER_SOURCE,
            then=_merged(_CUSTOMER_COLUMNS, "customer_id"),
        ),
        "layer_counts": _with(
            *_CUSTOMER_PARTS, _sales("gold_sales", "silver"),
            then="SELECT 'bronze' AS layer, count(*) AS n FROM bronze "
            "UNION ALL SELECT 'silver', count(*) FROM silver "
            "UNION ALL SELECT 'gold_sales', count(*) FROM gold_sales "
            "UNION ALL SELECT 'gold_customer', count(*) FROM gold_customer",
        ),
        "catalog_gold": _with(*_SALES_PARTS, then=_ALL_SALES),
        "manifest_files": _with(
            *_SALES_PARTS, then="SELECT year, month, day, count(*) AS n FROM gold_sales GROUP BY year, month, day"
        ),
        "trigger_keys": _with(_KEYS, then="SELECT * FROM accepted"),
        "trigger_count": _with(_KEYS, then="SELECT count(*) AS started FROM accepted"),
        "trigger_malformed": "SELECT count(*) AS malformed FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0",
        "merge_silver_table": _with(
            *_SILVER_PARTS, _KEYED, _EARLY, _LATE,
            "target AS (SELECT * FROM early)", "source AS (SELECT * FROM late)",
            then=_listed(SILVER_COLUMNS, "row_id"),
        ),
        "merge_ranges_table": _with(
            *_SILVER_PARTS, _KEYED, _EARLY, _LATE,
            f"target AS ({_crowded('early')})", f"source AS ({_crowded('late')})",
            then=_listed(SILVER_COLUMNS, "row_id"),
        ),
        "merge_sales_table": _with(
            *_SILVER_PARTS, _KEYED, _EARLY, _LATE, _sales("target", "early"), _sales("source", "late"),
            then=_listed(_SALES_COLUMNS, "order_id"),
        ),
        "merge_customer_table": _with(
            *_CUSTOMER_PARTS, _CUSTOMER_TARGET,
            "source AS (SELECT * FROM gold_customer WHERE ends_with(customer_id, '7'))",
            then=_listed(_CUSTOMER_COLUMNS, "customer_id"),
        ),
        "run_counts": _with(
            *_SILVER_PARTS, _KEYED, _customers("gold_customer", "keyed"),
            then="SELECT 'bronze' AS layer, count(*) AS n FROM bronze "
            "UNION ALL SELECT 'rejected', count(*) FROM silver WHERE row_id IS NULL "
            "UNION ALL SELECT 'silver', count(*) FROM keyed "
            "UNION ALL SELECT 'sales', count(DISTINCT order_id) FROM keyed "
            "UNION ALL SELECT 'customers', count(*) FROM gold_customer",
        ),
        "event_run": _with(
            *_SILVER_PARTS, _KEYED, _customers("gold_customer", "keyed"),
            then="SELECT * FROM gold_customer",
        ),
        "layered_silver": _with(*_SILVER_PARTS, _KEYED, then="SELECT * FROM keyed"),
        "layered_sales": _with(*_SILVER_PARTS, _KEYED, _sales("gold_sales", "keyed"), then=_ALL_SALES),
        "stream_customers": _with(
            *_SILVER_PARTS, _KEYED, _customers("gold_customer", "keyed"),
            then="SELECT * FROM gold_customer",
        ),
        "stream_files": _with(
            LANDING, BRONZE,
            then="SELECT _source_file, count(*) AS n, count(_order_date_parsed) AS dated "
            "FROM bronze GROUP BY _source_file",
        ),
        "layered_run": _with(
            *_SILVER_PARTS, _KEYED, _customers("gold_customer", "keyed"),
            then="SELECT * FROM gold_customer",
        ),
    }
