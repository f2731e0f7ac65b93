"""DuckDB oracle SQL for every ``queries()`` entry of ``__spark_entry__``.

Each string runs on the driver's pre-registered views (``lineitem``,
``orders``, ``supplier``, ...).  The SQL is written independently of the
Spark code: it maps the test tables with plain joins, deduplicates with
``QUALIFY``, and uses the reference's naive query forms (for example the
join-then-aggregate form of the sensor view), so that agreement checks the
rewrites.  NULL order is spelled out everywhere (the dialect puts NULLs
first in descending order).
"""

from __future__ import annotations

from strata import schemas as sc

# Fixed values shared with strata.plans.mapping / catalog.
EPOCH = "DATE '1995-01-01'"
SPLIT = "TIMESTAMP '1998-06-01 00:00:00'"
IOT_END1 = "TIMESTAMP '2000-01-16 00:00:00'"
IOT_START2 = "TIMESTAMP '2000-01-10 00:00:00'"
LOAD_1 = "TIMESTAMP '2024-02-01 00:00:00'"
LOAD_2 = "TIMESTAMP '2024-02-02 00:00:00'"


def _tiebreak(cols, exclude) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in cols if c not in exclude)


POS_COLS = sc.names(sc.POS_COLUMNS)
ERP_COLS = sc.names(sc.ERP_COLUMNS)
IOT_COLS = sc.names(sc.IOT_COLUMNS)

SECS = (f"(((date_diff('day', {EPOCH}, CAST(l.l_shipdate AS DATE)) * 30) % 86400 + 86400)"
        " % 86400)")

POS_RAW = f"""
pos_raw AS (
  SELECT 'TXN_' || l.l_orderkey || '_' || l.l_linenumber AS transaction_id,
         CAST(l.l_suppkey AS VARCHAR) AS store_id,
         s.s_name AS store_name, n.n_name AS store_city, r.r_name AS store_region,
         'CSH_' || l.l_linestatus AS cashier_id,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         CAST(o.o_orderdate AS DATE) AS transaction_date,
         printf('%02d:%02d:%02d', {SECS} // 3600, ({SECS} // 60) % 60, {SECS} % 60)
           AS transaction_time,
         CAST(l.l_partkey AS VARCHAR) AS product_sku,
         p.p_name AS product_name, p.p_type AS category, p.p_brand AS subcategory,
         CAST(l.l_quantity AS DECIMAL(10,0)) AS quantity,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(CAST(l.l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(9,2)) AS discount_pct,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END
              * CAST(CAST(l.l_extendedprice AS DECIMAL(12,2))
                     * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2))
              AS DECIMAL(12,2)) AS total_amount,
         CASE WHEN l.l_linestatus = 'O' THEN 'CARD' ELSE 'CASH' END AS payment_method,
         CAST(l.l_linenumber AS DECIMAL(10,0)) AS loyalty_points,
         l.l_shipdate AS _shipdate
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

POS_ORDER = ("transaction_time DESC NULLS FIRST, "
             + _tiebreak(POS_COLS, set(sc.POS_KEYS)))


def pos_dedup(src: str) -> str:
    cols = ", ".join(POS_COLS)
    return (f"SELECT {cols} FROM {src} QUALIFY row_number() OVER "
            f"(PARTITION BY transaction_id, transaction_date ORDER BY {POS_ORDER}) = 1")


POS_SILVER = f"""{POS_RAW},
pos AS ({pos_dedup('pos_raw')})"""

ERP_RAW = f"""
erp_raw AS (
  SELECT 'ORD_' || l.l_orderkey || '_' || l.l_linenumber AS order_id,
         o.o_orderdate + to_seconds(CAST({SECS} AS BIGINT)) AS order_date,
         o.o_orderstatus AS order_status,
         CAST(o.o_orderdate AS DATE) + 30 AS expected_delivery,
         CAST(l.l_shipdate AS DATE) AS actual_delivery,
         CAST(l.l_shipdate AS DATE) > CAST(o.o_orderdate AS DATE) + 30 AS is_late,
         date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE))
           AS lead_time_days,
         p.p_type AS category, l.l_partkey AS product_sku,
         l.l_quantity AS quantity_ordered,
         CASE WHEN l.l_linestatus = 'F' THEN l.l_quantity * CAST(0.9 AS DOUBLE)
              ELSE CAST(0.0 AS DOUBLE) END AS quantity_received,
         CAST(p.p_retailprice AS DECIMAL(10,2)) * CAST(0.6 AS DECIMAL(1,1)) AS unit_cost,
         CAST(l.l_quantity AS DECIMAL(10,0)) * CAST(p.p_retailprice AS DECIMAL(10,2))
           * CAST(0.6 AS DECIMAL(1,1)) AS total_cost,
         l.l_suppkey AS store_id,
         CAST(NULL AS VARCHAR) AS store_city,
         p.p_brand AS supplier_id, p.p_brand || ' Supply' AS supplier_name,
         CAST(NULL AS VARCHAR) AS supplier_city,
         'WH_' || l.l_linestatus AS warehouse_id,
         CASE WHEN l.l_returnflag = 'R' THEN 'DELETE' ELSE 'INSERT' END AS _action,
         l.l_shipdate AS _shipdate
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def erp_typed(src: str, extra: str = "") -> str:
    return f"""SELECT CAST(order_id AS VARCHAR) AS order_id,
         CAST(order_date AS TIMESTAMP) AS order_date,
         CAST(order_status AS VARCHAR) AS order_status,
         CAST(expected_delivery AS DATE) AS expected_delivery,
         CAST(actual_delivery AS DATE) AS actual_delivery,
         CAST(is_late AS BOOLEAN) AS is_late,
         CAST(CAST(lead_time_days AS DECIMAL(38,0)) AS DECIMAL(5,0)) AS lead_time_days,
         CAST(category AS VARCHAR) AS category,
         CAST(product_sku AS VARCHAR) AS product_sku,
         CAST(CAST(quantity_ordered AS DECIMAL(38,0)) AS DECIMAL(10,0)) AS quantity_ordered,
         CAST(CAST(quantity_received AS DECIMAL(38,0)) AS DECIMAL(10,0)) AS quantity_received,
         CAST(unit_cost AS DECIMAL(10,2)) AS unit_cost,
         CAST(total_cost AS DECIMAL(12,2)) AS total_cost,
         CAST(store_id AS VARCHAR) AS store_id,
         CAST(store_city AS VARCHAR) AS store_city,
         CAST(supplier_id AS VARCHAR) AS supplier_id,
         CAST(supplier_name AS VARCHAR) AS supplier_name,
         CAST(supplier_city AS VARCHAR) AS supplier_city,
         CAST(warehouse_id AS VARCHAR) AS warehouse_id,
         _action{extra}
  FROM {src}"""


ERP_ORDER = ("CASE WHEN _action = 'INSERT' THEN 0 ELSE 1 END ASC, order_date DESC NULLS FIRST, "
             + _tiebreak(ERP_COLS + ["_action"], {"order_id"}))


def erp_dedup(src: str) -> str:
    return (f"SELECT * FROM ({erp_typed(src)}) QUALIFY row_number() OVER "
            f"(PARTITION BY order_id ORDER BY {ERP_ORDER}) = 1")


ERP_SILVER = f"""{ERP_RAW},
erp_src AS ({erp_dedup('erp_raw')}),
erp AS (SELECT {', '.join(ERP_COLS)} FROM erp_src WHERE _action = 'INSERT')"""

IOT_FLAT = """
ev AS (
  SELECT e.event_id AS eid, e.user_id, e.event_type, e.value, e.props,
         s.s_suppkey, s.s_name, e.ts - INTERVAL 24 YEAR AS ts2,
         CASE WHEN e.value > 40 THEN 'HIGH' ELSE 'LOW' END AS sev
  FROM events e
  JOIN supplier s
    ON s.s_suppkey = ((e.user_id % (SELECT count(*) FROM supplier))
                      + (SELECT count(*) FROM supplier)) % (SELECT count(*) FROM supplier)
),
rd AS (
  SELECT ev.*, event_type AS sensor_name, CAST(value AS DECIMAL(10,2)) AS sensor_value,
         'C' AS sensor_unit FROM ev
  UNION ALL
  SELECT ev.*, 'k', CAST(json_extract_string(props, '$.k') AS DECIMAL(10,2)), 'n'
  FROM ev WHERE event_type = 'click'
),
al AS (
  SELECT eid AS a_eid, 0 AS apos, 'TEMP_BREACH' AS alert_type, sev AS severity
  FROM ev WHERE event_type = 'error'
  UNION ALL SELECT eid, 0, 'LOW_BATTERY', 'LOW' FROM ev WHERE event_type = 'click'
  UNION ALL SELECT eid, 1, 'TEMP_BREACH', sev FROM ev WHERE event_type = 'click'
  UNION ALL SELECT eid, 0, 'DOOR_OPEN', sev FROM ev WHERE event_type = 'view'
),
iot_flat AS (
  SELECT al.alert_type, al.severity,
         CASE WHEN al.alert_type IS NOT NULL THEN rd.ts2 END AS triggere_at,
         CAST(rd.s_suppkey AS VARCHAR) AS store_id, rd.s_name AS store_name,
         'DEV_' || rd.user_id AS device_id, 'EVT_' || rd.eid AS event_id,
         rd.event_type, rd.ts2 AS event_timestamp,
         CAST(rd.user_id % 4 AS DECIMAL(3,0)) AS store_floor,
         CAST(100 - rd.eid % 100 AS DECIMAL(3,0)) AS battery_pct,
         CAST(-40 - rd.user_id % 50 AS DECIMAL(4,0)) AS signal_rssi,
         'fw-' || (rd.user_id % 3) AS firmware_version,
         rd.sensor_name, rd.sensor_value, rd.sensor_unit,
         al.apos AS _apos
  FROM rd LEFT JOIN al ON rd.eid = al.a_eid
)"""


def iot_dedup(src: str) -> str:
    cols = ", ".join(IOT_COLS)
    return (f"SELECT {cols} FROM {src} QUALIFY row_number() OVER "
            f"(PARTITION BY event_id, sensor_name ORDER BY event_timestamp DESC NULLS FIRST, "
            f"_apos ASC NULLS LAST, {_tiebreak(IOT_COLS, set(sc.IOT_DEDUP_KEYS))}) = 1")


IOT_SILVER = f"""{IOT_FLAT},
iot AS ({iot_dedup('iot_flat')})"""

MONEY = "DECIMAL(38,2)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


Q: dict[str, str] = {}

Q["daily_sales"] = _with(POS_SILVER) + f"""
SELECT transaction_date, store_region, store_city, store_id, store_name, category,
       CAST(sum(quantity) AS DECIMAL(38,0)) AS unit_sold,
       CAST(sum(total_amount) AS {MONEY}) AS total_revenue,
       count(DISTINCT customer_id) AS unique_customers
FROM pos
GROUP BY transaction_date, store_region, store_city, store_name, store_id, category
ORDER BY transaction_date"""

Q["running_total"] = _with(POS_SILVER) + f"""
SELECT store_id, store_name, trans_date,
       CAST(CASE WHEN total_amount IS NOT NULL THEN greatest(total_amount, 0) END
            AS DECIMAL(12,2)) AS total_amount,
       CAST(sum(total_amount) OVER (PARTITION BY store_id ORDER BY trans_date
            RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS {MONEY}) AS running_total
FROM (SELECT store_id, store_name, CAST(transaction_date AS DATE) AS trans_date, total_amount
      FROM pos) t"""

Q["rolling_30d_revenue"] = _with(POS_SILVER, """
d AS (SELECT store_id, CAST(transaction_date AS DATE) AS transaction_date,
             sum(CASE WHEN total_amount IS NOT NULL THEN greatest(total_amount, 0) END)
               AS daily_amount
      FROM pos GROUP BY store_id, transaction_date)""") + f"""
SELECT store_id, transaction_date,
       CAST(sum(daily_amount) OVER (PARTITION BY store_id ORDER BY transaction_date
            RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS {MONEY})
         AS total_revenue_30_days
FROM d"""

Q["pos_iot_sensor_data"] = _with(POS_SILVER, IOT_SILVER) + f"""
SELECT iot.store_id, iot.store_name, iot.sensor_name, pos.transaction_date,
       CAST(sum(pos.total_amount) AS {MONEY}) AS total_revenue,
       CAST(sum(iot.sensor_value) AS {MONEY}) AS sensor_value_total,
       CAST(sum(iot.sensor_value * 100) AS DOUBLE) / (100.0 * count(iot.sensor_value))
         AS average_sensor_value
FROM iot JOIN pos ON pos.store_id = iot.store_id
GROUP BY iot.store_id, iot.store_name, pos.transaction_date, iot.sensor_name
ORDER BY pos.transaction_date"""


_cents, _n = "CAST(sum(iot.sensor_value * 100) AS HUGEINT)", "count(iot.sensor_value)"
Q["pos_iot_sensor_data_exact"] = _with(POS_SILVER, IOT_SILVER) + f"""
SELECT iot.store_id, iot.store_name, iot.sensor_name, pos.transaction_date,
       CAST(sum(pos.total_amount) AS {MONEY}) AS total_revenue,
       CAST(sum(iot.sensor_value) AS {MONEY}) AS sensor_value_total,
       CAST(CAST(CASE WHEN {_cents} < 0 THEN -1 ELSE 1 END
                 * ((2 * 10000 * abs({_cents}) + {_n}) // (2 * {_n})) AS DECIMAL(20,0))
            * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(14,6)) AS average_sensor_value
FROM iot JOIN pos ON pos.store_id = iot.store_id
GROUP BY iot.store_id, iot.store_name, pos.transaction_date, iot.sensor_name"""


def _gross_margin(per_day: bool) -> str:
    grp = "store_id, product_sku, CAST(order_date AS DATE)" if per_day else \
        "store_id, product_sku, order_date"
    return _with(POS_SILVER, ERP_SILVER, f"""
ps AS (SELECT store_id, product_sku, transaction_date, sum(total_amount) AS total_revenue
       FROM pos GROUP BY store_id, product_sku, transaction_date)""", f"""
es AS (SELECT store_id, product_sku, CAST(order_date AS DATE) AS order_day,
              sum(total_cost) AS procurement_cost
       FROM erp GROUP BY {grp})""") + f"""
SELECT p.store_id, p.product_sku, p.transaction_date,
       CAST(p.total_revenue AS {MONEY}) AS total_revenue,
       CAST(coalesce(e.procurement_cost, 0) AS {MONEY}) AS total_procurement_cost,
       CAST(p.total_revenue - coalesce(e.procurement_cost, 0) AS {MONEY}) AS gross_margin
FROM ps p LEFT JOIN es e
  ON p.store_id = e.store_id AND p.product_sku = e.product_sku
 AND p.transaction_date = e.order_day
ORDER BY total_procurement_cost DESC"""


Q["gross_margin"] = _gross_margin(False)
Q["gross_margin_per_day"] = _gross_margin(True)

Q["sensor_affect_revenue"] = _with(POS_SILVER, IOT_SILVER, """
es AS (SELECT store_id, CAST(event_timestamp AS DATE) AS event_time, alert_type, event_type,
              max(sensor_value) AS max_temp, count(*) AS count_per_day
       FROM iot WHERE alert_type = 'TEMP_BREACH' OR severity = 'HIGH'
       GROUP BY store_id, CAST(event_timestamp AS DATE), alert_type, event_type)""", """
ps AS (SELECT store_id, transaction_date, sum(quantity) AS qty_sold,
              sum(total_amount) AS total_revenue
       FROM pos GROUP BY store_id, transaction_date)""") + f"""
SELECT p.store_id, p.transaction_date, e.alert_type, e.event_type,
       CAST(coalesce(e.max_temp, 0) AS DECIMAL(10,2)) AS max_temp_reached,
       coalesce(e.count_per_day, 0) AS total_count_per_day,
       CAST(p.qty_sold AS DECIMAL(38,0)) AS qty_sold,
       CAST(p.total_revenue AS {MONEY}) AS total_revenue
FROM ps p LEFT JOIN es e ON e.store_id = p.store_id AND e.event_time = p.transaction_date
ORDER BY p.transaction_date"""

Q["latest_pos"] = _with(POS_SILVER) + "\nSELECT * FROM pos"

Q["latest_erp_action"] = _with(ERP_SILVER) + "\nSELECT * FROM erp_src"

Q["latest_iot"] = _with(IOT_SILVER) + "\nSELECT * FROM iot"


def queries() -> dict[str, str]:
    return dict(Q)


# ---------------------------------------------------------------- merges
def _merge_sql(target: str, source: str, keys: list[str], cols: list[str], *,
               erp: bool = False) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    if erp:
        from_s = "s._s IS NOT NULL AND s._action = 'INSERT'"
        keep = ("NOT (t._t IS NOT NULL AND s._s IS NOT NULL AND s._action = 'DELETE') "
                "AND NOT (t._t IS NULL AND s._action IS DISTINCT FROM 'INSERT')")
    else:
        from_s = "s._s IS NOT NULL"
        keep = "TRUE"
    sel = ", ".join(f"CASE WHEN {from_s} THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)
    return f"""SELECT {sel},
       CASE WHEN t._t IS NULL THEN {LOAD_2} ELSE t.created_at END AS created_at,
       CASE WHEN {from_s} THEN {LOAD_2} ELSE t.updated_at END AS updated_at
FROM (SELECT *, 1 AS _t FROM {target}) t FULL OUTER JOIN (SELECT *, 1 AS _s FROM {source}) s
  ON {on}
WHERE {keep}"""


Q["merge_pos"] = _with(POS_RAW, f"""
t1 AS (SELECT *, {LOAD_1} AS created_at, {LOAD_1} AS updated_at
       FROM ({pos_dedup(f"(SELECT * FROM pos_raw WHERE _shipdate < {SPLIT})")}))""", f"""
s2 AS ({pos_dedup(f"(SELECT * FROM pos_raw WHERE _shipdate >= {SPLIT})")})""") + "\n" + \
    _merge_sql("t1", "s2", sc.POS_KEYS, POS_COLS)

Q["merge_erp"] = _with(ERP_RAW, f"""
t1 AS (SELECT {', '.join(ERP_COLS)}, {LOAD_1} AS created_at, {LOAD_1} AS updated_at
       FROM ({erp_dedup(f"(SELECT * FROM erp_raw WHERE _shipdate < {SPLIT})")})
       WHERE _action = 'INSERT')""", f"""
s2 AS ({erp_dedup(f"(SELECT * FROM erp_raw WHERE _shipdate >= {SPLIT})")})""") + "\n" + \
    _merge_sql("t1", "s2", sc.ERP_KEYS, ERP_COLS, erp=True)

Q["merge_iot"] = _with(IOT_FLAT, f"""
t1 AS (SELECT *, {LOAD_1} AS created_at, {LOAD_1} AS updated_at
       FROM ({iot_dedup(f"(SELECT * FROM iot_flat WHERE event_timestamp < {IOT_END1})")}))""", f"""
s2 AS ({iot_dedup(f"(SELECT * FROM iot_flat WHERE event_timestamp >= {IOT_START2})")})""") + \
    "\n" + _merge_sql("t1", "s2", sc.IOT_KEYS, IOT_COLS)

# ---------------------------------------------------------------- semi-structured
Q["variant_extract"] = """
SELECT event_id,
       CAST(CAST(json_extract(props, '$.k') AS DECIMAL(38,0)) AS DECIMAL(38,0)) AS k_int,
       CAST(json_extract(props, '$.k') AS DECIMAL(10,2)) AS k_number,
       json_extract_string(props, '$.k') AS k_text,
       json_extract_string(props, '$.missing') AS missing
FROM events"""

Q["nested_path"] = _with(IOT_FLAT) + """
SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name,
       'DEV_' || user_id AS device_id, 'EVT_' || eid AS event_id, event_type,
       ts2 AS event_timestamp,
       CAST(user_id % 4 AS DECIMAL(3,0)) AS store_floor,
       CAST(100 - eid % 100 AS DECIMAL(3,0)) AS battery_pct,
       CAST(-40 - user_id % 50 AS DECIMAL(4,0)) AS signal_rssi,
       'fw-' || (user_id % 3) AS firmware_version
FROM ev"""

Q["flatten_inner"] = _with(IOT_FLAT) + """
SELECT 'EVT_' || eid AS event_id, CASE WHEN sensor_name = 'k' THEN 1 ELSE 0 END AS reading_pos,
       sensor_name, sensor_value, sensor_unit
FROM rd"""

Q["flatten_outer"] = _with(IOT_FLAT) + """
SELECT 'EVT_' || ev.eid AS event_id, al.apos AS alert_pos, al.alert_type, al.severity,
       CASE WHEN al.alert_type IS NOT NULL THEN ev.ts2 END AS triggered_at
FROM ev LEFT JOIN al ON ev.eid = al.a_eid"""

Q["flatten_both"] = _with(IOT_FLAT) + f"""
SELECT {', '.join(IOT_COLS)}, _apos AS alert_pos FROM iot_flat"""

Q["flatten_missing"] = """
WITH d AS (SELECT CAST(event_id AS BIGINT) AS event_id,
                  CASE WHEN event_type IN ('signup', 'view', 'error') THEN [] ELSE [event_type, 'k'] END AS r FROM events),
i AS (SELECT event_id, unnest(range(len(r))) AS pos, unnest(r) AS sensor FROM d)
SELECT 'inner' AS kind, event_id, CAST(pos AS INTEGER) AS pos, sensor FROM i
UNION ALL
SELECT 'outer', d.event_id, CAST(pos AS INTEGER), sensor FROM d LEFT JOIN i USING (event_id)"""

Q["date_shift"] = """
SELECT o_orderkey, o_orderdate - INTERVAL 1 HOUR AS hour_minus_1, o_orderdate + INTERVAL 90 MINUTE AS minute_90,
       o_orderdate + INTERVAL 45 DAY AS day_45, o_orderdate + INTERVAL 1 MONTH AS month_1,
       o_orderdate - INTERVAL 13 MONTH AS month_minus_13, o_orderdate + INTERVAL 4 YEAR AS year_4
FROM orders"""

Q["inventory_extract"] = """
SELECT CAST(l.l_shipdate AS DATE) AS snapshot_date,
       CAST(l.l_suppkey AS VARCHAR) AS store_id,
       'WH_' || l.l_linestatus AS warehouse_id,
       p.p_type AS category,
       CAST(l.l_partkey AS VARCHAR) AS product_sku,
       CAST(CAST(l.l_quantity * CAST(2.7 AS DOUBLE) AS DECIMAL(38,0)) AS DECIMAL(10,0))
         AS quantity_on_hand,
       CAST(CAST(l.l_quantity * CAST(0.3 AS DOUBLE) AS DECIMAL(38,0)) AS DECIMAL(10,0))
         AS reorder_level,
       CAST(CAST(l.l_quantity * CAST(4.0 AS DOUBLE) AS DECIMAL(38,0)) AS DECIMAL(10,0))
         AS max_stock_level,
       CAST(l.l_shipdate AS DATE) - l.l_linenumber AS last_received_date
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""

Q["inventory_load"] = Q["inventory_extract"]

# ---------------------------------------------------------------- changes / DML
ORDER_STATES = """
b AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'),
a AS (SELECT o_orderkey, o_custkey,
             CASE WHEN o_orderpriority = '1-URGENT' THEN 'Changed' ELSE o_orderstatus END
               AS o_orderstatus,
             o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00')"""

Q["change_feed"] = _with(ORDER_STATES) + """
SELECT *, 'INSERT' AS _action FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) i
UNION ALL
SELECT *, 'DELETE' AS _action FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) d"""

_upd_cols = ", ".join("CASE WHEN order_id = 'ORD_2_6' THEN 'Changed' ELSE order_status END AS order_status"
                      if c == "order_status" else c for c in ERP_COLS)
Q["update_where"] = _with(ERP_SILVER) + f"""
SELECT {_upd_cols}, {LOAD_1} AS created_at, {LOAD_1} AS updated_at
FROM erp"""
Q["update_and_restore"] = _with(ERP_SILVER) + f"""
SELECT 'updated' AS step, {_upd_cols}, {LOAD_1} AS created_at, {LOAD_1} AS updated_at FROM erp
UNION ALL
SELECT 'before' AS step, {', '.join(ERP_COLS)}, {LOAD_1}, {LOAD_1} FROM erp
UNION ALL
SELECT 'restored' AS step, {', '.join(ERP_COLS)}, {LOAD_1}, {LOAD_1} FROM erp"""

Q["erp_from_change_feed"] = _with(ERP_RAW, f"""
b AS (SELECT * EXCLUDE (_action, _shipdate) FROM erp_raw WHERE _shipdate < {SPLIT}),
a AS (SELECT * EXCLUDE (_action, _shipdate)
             REPLACE (CASE WHEN is_late THEN 'Changed' ELSE order_status END AS order_status)
      FROM erp_raw WHERE NOT (warehouse_id = 'WH_O' AND _shipdate < {SPLIT})),
feed AS (SELECT *, 'INSERT' AS _action FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) i
         UNION ALL
         SELECT *, 'DELETE' AS _action FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) d),
t1 AS (SELECT {', '.join(ERP_COLS)}, {LOAD_1} AS created_at, {LOAD_1} AS updated_at
       FROM ({erp_dedup("(SELECT *, 'INSERT' AS _action FROM b)")})),
s2 AS ({erp_dedup('feed')})""") + "\n" + _merge_sql("t1", "s2", sc.ERP_KEYS, ERP_COLS, erp=True)

Q["late_data"] = _with(POS_RAW, f"""
t1 AS (SELECT *, {LOAD_1} AS created_at, {LOAD_1} AS updated_at
       FROM ({pos_dedup(f"(SELECT * FROM pos_raw WHERE _shipdate >= {SPLIT})")}))""", f"""
s2 AS ({pos_dedup(f"(SELECT * FROM pos_raw WHERE _shipdate < {SPLIT})")})""") + "\n" + \
    _merge_sql("t1", "s2", sc.POS_KEYS, POS_COLS)

# ---------------------------------------------------------------- history
HISTORY = f"""{ERP_RAW},
ch AS (SELECT t.*, 'C' || strftime(CAST(_shipdate AS DATE), '%Y%m') AS commit_id,
              CAST(year(_shipdate) * 12 + month(_shipdate) AS BIGINT) AS commit_seq,
              CAST(date_trunc('month', CAST(_shipdate AS DATE)) + INTERVAL 1 MONTH AS TIMESTAMP)
                AS committed_at
       FROM ({erp_typed('erp_raw', ', _shipdate')}) t),
chd AS (SELECT * FROM ch QUALIFY row_number() OVER
          (PARTITION BY order_id, commit_seq ORDER BY {ERP_ORDER}) = 1),
hx AS (SELECT *, coalesce(lag(_action) OVER (PARTITION BY order_id ORDER BY commit_seq)
                          = 'INSERT', FALSE) AS _existed,
              coalesce(sum(CASE WHEN _action = 'DELETE' THEN 1 ELSE 0 END) OVER
                (PARTITION BY order_id ORDER BY commit_seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _life,
              CASE WHEN _action = 'INSERT' THEN committed_at END AS _at FROM chd),
h AS (SELECT {', '.join(ERP_COLS)},
             min(_at) OVER o AS created_at, max(_at) OVER o AS updated_at,
             commit_id, commit_seq, committed_at, CAST(NULL AS BIGINT) AS _row,
             CASE WHEN _action = 'INSERT' AND _existed THEN 'UPDATE'
                  WHEN _action = 'INSERT' THEN 'INSERT'
                  WHEN _action = 'DELETE' AND _existed THEN 'DELETE' END AS _op
      FROM hx WINDOW o AS (PARTITION BY order_id, _life ORDER BY commit_seq
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

ERP_ALL = [*ERP_COLS, "created_at", "updated_at"]


def _state(where: str) -> str:
    return (f"SELECT {', '.join(ERP_ALL)} FROM (SELECT * FROM h WHERE _op IS NOT NULL AND "
            f"{where} QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY commit_seq DESC)"
            f" = 1) x WHERE _op <> 'DELETE'")


Q["erp_history"] = _with(HISTORY) + "\nSELECT * FROM h WHERE _op IS NOT NULL"
Q["as_of"] = _with(HISTORY) + "\n" + _state("committed_at <= TIMESTAMP '1998-01-01 00:00:00'")
Q["before_offset"] = _with(HISTORY) + "\n" + _state(
    "committed_at < TIMESTAMP '1998-01-01 01:00:00' - INTERVAL 3600 SECOND")
Q["before_commit"] = _with(HISTORY) + "\n" + _state(
    "commit_seq < (SELECT min(commit_seq) FROM h WHERE commit_id = 'C199801')")

_payload = [c for c in ERP_ALL if c != "order_id"]
_o_row = "row(" + ", ".join(f"o.{c}" for c in _payload) + ")"
_c_row = "row(" + ", ".join(f"c.{c}" for c in _payload) + ")"
Q["restore"] = _with(HISTORY, "old AS (" + _state(
    "commit_seq < (SELECT min(commit_seq) FROM h WHERE commit_id = 'C199801')") + ")",
    "cur AS (" + _state("TRUE") + ")", f"""
j AS (SELECT o.*, c.*, o.order_id AS _oid, c.order_id AS _cid,
             CASE WHEN c.order_id IS NULL THEN 'INSERT'
                  WHEN o.order_id IS NULL THEN 'DELETE'
                  WHEN {_o_row} IS DISTINCT FROM {_c_row} THEN 'UPDATE' END AS _op,
             {', '.join(f"CASE WHEN o.order_id IS NULL THEN c.{c} ELSE o.{c} END AS v_{c}" for c in _payload)}
      FROM (SELECT * FROM old) o FULL OUTER JOIN (SELECT * FROM cur) c
        ON o.order_id = c.order_id)""") + f"""
SELECT coalesce(_oid, _cid) AS order_id,
       {', '.join(f"v_{c} AS {c}" for c in _payload)},
       _op, 'R1' AS commit_id, (SELECT max(commit_seq) + 1 FROM h WHERE _op IS NOT NULL)
         AS commit_seq,
       {LOAD_2} AS committed_at, CAST(NULL AS BIGINT) AS _row
FROM j WHERE _op IS NOT NULL"""

Q["expire"] = _with(HISTORY, "hh AS (SELECT * FROM h WHERE _op IS NOT NULL)") + """
SELECT * FROM hh WHERE committed_at > TIMESTAMP '1998-01-10 00:00:00' - INTERVAL 14 DAY
UNION ALL
SELECT * REPLACE ('BASE' AS commit_id) FROM (SELECT * FROM hh WHERE committed_at <= TIMESTAMP '1998-01-10 00:00:00'
                 - INTERVAL 14 DAY
               QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY commit_seq DESC) = 1) x
WHERE _op <> 'DELETE'"""

# ---------------------------------------------------------------- sources / streams
Q["csv_load"] = _with(POS_RAW) + f"\nSELECT {', '.join(POS_COLS)} FROM pos_raw"
Q["stream_ingest"] = Q["csv_load"]
Q["json_array_load"] = _with(IOT_SILVER) + \
    f"\nSELECT *, {LOAD_1} AS created_at, {LOAD_1} AS updated_at FROM iot"
Q["parquet_load"] = _with(ERP_SILVER) + \
    f"\nSELECT *, {LOAD_1} AS created_at, {LOAD_1} AS updated_at FROM erp"
Q["stream_merge"] = _with(POS_SILVER) + \
    f"\nSELECT *, {LOAD_1} AS created_at, {LOAD_1} AS updated_at FROM pos"

Q["stream_latest"] = _with(POS_SILVER) + f"\nSELECT {', '.join(POS_COLS)} FROM pos"

Q["stream_erp"] = _with(ERP_RAW, f"""
yearly AS (SELECT * FROM ({erp_typed('erp_raw', ', year(_shipdate) AS _y')})
           QUALIFY row_number() OVER (PARTITION BY order_id, _y ORDER BY {ERP_ORDER}) = 1),
last AS (SELECT * FROM yearly
         QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _y DESC) = 1)""") + f"""
SELECT {', '.join(ERP_COLS)}, {LOAD_1} AS created_at, {LOAD_1} AS updated_at
FROM last WHERE _action = 'INSERT'"""
Q["stream_iot"] = Q["json_array_load"]
Q["ingest_audit"] = _with(POS_RAW) + """
SELECT CAST(year(_shipdate) AS INTEGER) AS ship_year, count(*) AS rows_loaded, TRUE AS has_bytes
FROM pos_raw GROUP BY 1"""
Q["stream_inventory"] = Q["inventory_extract"]

# ---------------------------------------------------------------- raw tables
Q["erp_stream_from_table"] = Q["erp_from_change_feed"]
Q["variant_change_feed"] = Q["change_feed"]

_bag = "store_region, payment_method, CAST(quantity AS INTEGER) AS quantity"
Q["raw_time_travel"] = _with(POS_RAW, f"""
e AS (SELECT {_bag} FROM pos_raw WHERE _shipdate < {SPLIT}),
l AS (SELECT {_bag} FROM pos_raw),
g AS (SELECT * FROM l WHERE NOT (payment_method = 'CASH' AND quantity > 40)),
u AS (SELECT CASE WHEN store_region = 'ASIA' THEN 'APAC' ELSE store_region END AS store_region, payment_method,
             CASE WHEN store_region = 'ASIA' THEN 0 ELSE quantity END AS quantity FROM g),
s AS (SELECT 'before_expiry' AS step, * FROM e UNION ALL SELECT 'as_of', * FROM l UNION ALL SELECT 'before_offset', * FROM g
      UNION ALL SELECT 'before', * FROM g UNION ALL SELECT 'updated', * FROM u UNION ALL SELECT 'restored', * FROM l)""") + """
SELECT step, store_region, payment_method, quantity, count(*) AS n FROM s GROUP BY ALL"""

_bag = "store_region, category, CAST(quantity AS INTEGER) AS quantity"
Q["raw_changes"] = _with(POS_RAW, f"""
b AS (SELECT {_bag} FROM pos_raw WHERE _shipdate < {SPLIT}),
a AS (SELECT * REPLACE (CAST(CASE WHEN quantity > 30 THEN quantity - 10 ELSE quantity END AS INTEGER) AS quantity)
      FROM (SELECT {_bag} FROM pos_raw) WHERE store_region <> 'EUROPE')""") + """
SELECT *, 'INSERT' AS _action FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) i
UNION ALL
SELECT *, 'DELETE' AS _action FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) d"""

Q["json_array_blocks"] = Q["json_array_load"]
Q["pipe_skip_file"] = _with(POS_RAW) + f"""
SELECT {', '.join(POS_COLS)} FROM pos_raw
WHERE year(_shipdate) <> 1998
  AND (year(_shipdate) <> 1996 OR NOT EXISTS (SELECT 1 FROM pos_raw WHERE year(_shipdate) = 1996 AND loyalty_points = 1))"""
Q["pipe_status"] = _with(POS_RAW, """
f AS (SELECT CAST(year(_shipdate) AS INTEGER) AS ship_year, count(*) AS n, count(*) FILTER (year(_shipdate) = 1996 AND loyalty_points = 1) AS bad
      FROM pos_raw GROUP BY 1)""") + """
SELECT ship_year, CASE WHEN ship_year = 1998 THEN 'PENDING' WHEN bad > 0 THEN 'LOAD_SKIPPED' ELSE 'LOADED' END AS status,
       CAST(CASE WHEN ship_year = 1998 OR bad > 0 THEN 0 ELSE n END AS BIGINT) AS rows_loaded, CAST(bad AS BIGINT) AS error_count,
       TRUE AS has_bytes, CAST(CASE WHEN bad > 0 THEN 1 ELSE 0 END AS BIGINT) AS files_with_errors FROM f
UNION ALL SELECT 0, 'EMPTY', 0, 0, FALSE, 0"""

# The named views, read by name.
Q["view_sensor_data"] = Q["pos_iot_sensor_data_exact"]
Q["view_gross_margin"] = Q["gross_margin"]
Q["view_sensor_affect"] = Q["sensor_affect_revenue"]
