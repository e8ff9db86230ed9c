"""The input shapes of `tallyloom.sources.views` as SQL, for the checking engine."""

from __future__ import annotations

_PROP_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_HEIGHT = "CAST(date_diff('day', DATE '1995-01-01', CAST({0} AS DATE)) AS BIGINT)"

VIEWS = {
    "ticks": f"""SELECT ts AS time, event_type AS symbol, value AS price,
        CAST({_PROP_K} AS DECIMAL(18,2)) AS day_volume FROM events""",
    "assets": "SELECT DISTINCT event_type AS symbol, upper(event_type) AS name FROM events",
    "sensor_data": f"""SELECT ts AS time, CAST(user_id AS INTEGER) AS sensor_id, value AS temperature,
        CAST({_PROP_K} AS DOUBLE) / 100 AS cpu FROM events""",
    "sensors": """SELECT CAST(c_custkey AS INTEGER) AS id, c_mktsegment AS type, n_name AS location
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "health_data": """SELECT ts AS time, CAST(user_id AS INTEGER) AS device_id,
        CAST(55 + (event_id * 7) % 75 AS INTEGER) AS heart_rate,
        CAST(105 + (event_id * 11) % 45 AS INTEGER) AS blood_pressure_systolic,
        CAST(65 + (event_id * 13) % 30 AS INTEGER) AS blood_pressure_diastolic,
        92 + CAST((event_id * 17) % 80 AS DOUBLE) / 10 AS spo2,
        CAST(36.1 AS DOUBLE) + CAST((event_id * 19) % 12 AS DOUBLE) / 10 AS body_temperature,
        CAST((event_id * 31) % 15000 AS INTEGER) AS steps_count,
        CASE WHEN event_id % 10 <> 0 THEN CAST((event_id * 37) % 1001 AS DOUBLE) / 10 END AS sleep_quality_score,
        CASE event_type WHEN 'view' THEN 'sedentary' WHEN 'click' THEN 'light'
            WHEN 'purchase' THEN 'moderate' ELSE 'vigorous' END AS activity_level FROM events""",
    "users": """SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name, CAST(20 + c_custkey % 60 AS INTEGER) AS age,
        CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
        CASE c_custkey % 3 WHEN 0 THEN 'None' WHEN 1 THEN 'Hypertension' ELSE 'Diabetes Type 2' END
            AS medical_conditions FROM customer""",
    "wearable_devices": """SELECT CAST(c_custkey AS INTEGER) AS id, CAST(c_custkey AS INTEGER) AS user_id,
        c_mktsegment AS device_type, c_mktsegment || ' v' || CAST(c_custkey % 9 AS VARCHAR) AS device_model
        FROM customer""",
    "blocks": f"""SELECT {_HEIGHT.format('o_orderdate')} AS height, o_orderdate AS timestamp,
        SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS value, CAST(COUNT(*) AS INTEGER) AS ntx
        FROM orders GROUP BY o_orderdate""",
    "transactions": f"""SELECT CAST(o_orderkey AS VARCHAR) AS txid, o_orderdate AS timestamp,
        {_HEIGHT.format('o_orderdate')} AS block_height, CAST(o_totalprice AS DECIMAL(18,2)) AS value,
        o_orderkey % 50 = 0 AS coinbase FROM orders""",
    "tx_vinout": f"""SELECT o_orderdate AS timestamp, CASE l_returnflag WHEN 'R' THEN 'vin' ELSE 'vout' END AS type,
        CAST(l_suppkey AS VARCHAR) AS address, CAST(l_extendedprice AS DECIMAL(18,2)) AS value,
        CAST(l_orderkey AS VARCHAR) AS txid, l_linenumber AS n, l_orderkey % 50 = 0 AS coinbase,
        {_HEIGHT.format('o_orderdate')} AS block_height, l_partkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "reports": """SELECT doc_id AS id, text AS description, DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER) AS date,
        'Station_' || CAST(1 + doc_id % 90 AS VARCHAR) AS station_code, CAST(embedding AS DOUBLE[]) AS embedding
        FROM documents JOIN embeddings ON doc_id = vec_id""",
    "stations": """SELECT c_custkey AS id, c_name AS station_name,
        'Station_' || CAST(1 + c_custkey AS VARCHAR) AS station_code,
        CAST(-73.79 AS DOUBLE) + CAST((c_custkey * 7919) % 2000 - 1000 AS DOUBLE) / 1000 AS longitude,
        CAST(40.641 AS DOUBLE) + CAST((c_custkey * 104729) % 2000 - 1000 AS DOUBLE) / 1000 AS latitude
        FROM customer""",
}


def with_views(names: tuple[str, ...], body: str) -> str:
    """`body` with the named shapes in front as common table expressions."""
    if not names:
        return body
    heads = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"
