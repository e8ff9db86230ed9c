"""The scalar functions for use in `spark.sql` text.

They are SQL functions, which Spark inlines into the query's plan. For the first
and last value by time SQL already has `min_by` and `max_by`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyloom.functions.geo import EARTH_RADIUS_M

DEFINITIONS = {
    "time_bucket(width INTERVAL DAY TO SECOND, t TIMESTAMP) RETURNS TIMESTAMP":
        """timestamp_micros(unix_micros(t) - pmod(unix_micros(t), unix_micros(timestamp_micros(0) + width)))""",
    "cosine_distance(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE":
        """CASE WHEN size(a) = size(b) THEN 1 - coalesce(try_divide(
            aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x),
            sqrt(aggregate(a, 0D, (s, x) -> s + x * x) * aggregate(b, 0D, (s, x) -> s + x * x))), double('NaN')) END""",
    "sphere_metres(lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE) RETURNS DOUBLE":
        f"""{2 * EARTH_RADIUS_M}D * asin(sqrt(least(1D, pow(sin(radians(lat2 - lat1) / 2), 2)
            + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))""",
    "rounded_int(x DOUBLE) RETURNS INT": "CAST(rint(x) AS INT)",
    "segment_key(t STRING, length INT) RETURNS STRING": "right(t, length)",
    "answer_text(response STRING) RETURNS STRING": "get_json_object(response, '$.choices[0].message.content')",
}


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to the session; returns their names."""
    for head, body in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in DEFINITIONS]
