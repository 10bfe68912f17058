"""The ``events`` table read as the three change streams.

``event_id`` is the arrival order and ``ts`` the processing clock; the event time
lags it by ``k`` hours, which makes events arrive out of order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return (
        events.selectExpr(
            "event_id AS seq",
            "CAST(ts AS timestamp) AS arrival_ts",
            "concat('product-', user_id) AS product_id",
            "event_type",
            "value",
            "CAST(get_json_object(props, '$.k') AS int) AS k",
        )
        .selectExpr(
            "*",
            """CASE WHEN event_type = 'signup' THEN 'P'
                    WHEN event_type = 'error' AND k < 5 THEN 'D'
                    WHEN event_type = 'error' THEN 'P'
                    WHEN event_type = 'purchase' THEN 'R'
                    ELSE 'S' END AS kind""",
        )
        .selectExpr(
            "seq",
            "arrival_ts",
            "product_id",
            "kind",
            "arrival_ts - make_dt_interval(0, k) AS updated_at",
            "CASE WHEN kind = 'P' THEN concat('Product ', k) END AS name",
            "CAST(NULL AS string) AS category",
            "CAST(NULL AS string) AS brand",
            "CAST(NULL AS string) AS description",
            "CASE WHEN kind = 'R' THEN CAST(CAST(value AS decimal(18,2)) AS decimal(38,18)) END AS price",
            "CASE WHEN kind = 'R' THEN element_at(array('USD', 'EUR', 'GBP'), k % 3 + 1) END AS currency",
            "CASE WHEN kind = 'S' THEN concat('warehouse-', k % 3) END AS warehouse_id",
            "CASE WHEN kind = 'S' THEN CAST(k div 3 % 3 AS int) END AS quantity",
        )
    )
