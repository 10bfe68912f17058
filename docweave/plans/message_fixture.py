"""Message texts made from the ``events`` rows, some with a defect.

The defect depends on ``event_id % 20``, so every class occurs at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.plans.event_fixture import EVENTS_SCHEMA


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("arrival_ts"),
        F.concat(F.lit("product-"), F.col("user_id").cast("string")).alias("pid"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("amount"),
        (F.col("event_id") % 20).alias("m"),
    )


def _iso(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _object(*fields: tuple[str, Column]) -> Column:
    """JSON text of the fields that are not null."""
    return F.concat(
        F.lit("{"),
        F.concat_ws(",", *(F.concat(F.lit(f'"{name}":'), value) for name, value in fields)),
        F.lit("}"),
    )


def _class(*numbers: int) -> Column:
    return F.col("m").isin(*numbers)


def _value(good: Column) -> Column:
    return F.when(_class(0), "{{not json}}").when(_class(1), "").otherwise(good)


def _time(future: int, near: int) -> Column:
    clock = F.col("arrival_ts")
    return (
        F.when(_class(future), clock + F.expr("INTERVAL 120 SECONDS"))
        .when(_class(near), clock + F.expr("INTERVAL 30 SECONDS"))
        .otherwise(clock - F.make_dt_interval(hours=F.col("k")))
    )


def catalogue_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = (
        F.when(_class(8), "0")
        .when(_class(9), _quoted(_iso(F.col("arrival_ts"))))
        .otherwise(F.unix_millis(_time(10, 11)).cast("string"))
    )
    name = F.when(_class(7), "null").otherwise(_quoted(F.concat(F.lit("Product "), F.col("k"))))
    row = _object(
        ("product_id", _quoted(F.when(_class(6), "  ").otherwise(F.col("pid")))),
        ("name", name),
        ("category", _quoted(F.concat(F.lit("category-"), F.col("k") % 6))),
        ("brand", F.lit("null")),
        ("updated_at", stamp),
        ("stray", F.lit("[1,2]")),
    )
    op = (
        F.when(_class(2), '" "')
        .when(_class(4, 5), '"d"')
        .when(_class(12), F.lit(None))
        .when(_class(13), '"r"')
        .otherwise('"u"')
    )
    message = _object(
        ("op", op),
        ("before", F.when(_class(4), row).otherwise("null")),
        ("after", F.when(_class(3, 4, 5), "null").otherwise(row)),
        ("ts_ms", F.lit("1")),
    )
    return _events(spark, sf_dir).select("seq", "arrival_ts", _value(message).alias("value"))


def price_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pid = F.when(_class(2), "   ").when(_class(6), "").otherwise(F.col("pid"))
    message = _object(
        ("productId", _quoted(pid)),
        ("price", F.when(~_class(3), F.col("amount"))),
        ("currency", _quoted(F.element_at(F.array(F.lit("USD"), F.lit("EUR"), F.lit("GBP")), F.col("k") % 3 + 1))),
        ("updatedAt", _quoted(_iso(_time(4, 5)))),
        ("source", F.lit('"feed"')),
    )
    return _events(spark, sf_dir).select("seq", "arrival_ts", _value(message).alias("value"))


def stock_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = F.when(_class(3), " ").otherwise(F.concat(F.lit("warehouse-"), F.col("k") % 3))
    message = _object(
        ("productId", _quoted(F.when(_class(2), "").otherwise(F.col("pid")))),
        ("warehouseId", _quoted(warehouse)),
        ("quantity", F.when(~_class(4), F.col("k").cast("string"))),
        ("updatedAt", _quoted(_iso(_time(5, 6)))),
    )
    return _events(spark, sf_dir).select("seq", "arrival_ts", _value(message).alias("value"))


def product_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = _object(
        ("productId", _quoted(F.when(_class(3), "").otherwise(F.col("pid")))),
        ("name", F.when(~_class(2), _quoted(F.concat(F.lit("Product "), F.col("k"))))),
        ("brand", _quoted(F.concat(F.lit("brand-"), F.col("k") % 5))),
        ("updatedAt", _quoted(_iso(_time(4, 5)))),
        ("operation", F.when(_class(6), '"d"').otherwise('"u"')),
    )
    return _events(spark, sf_dir).select("seq", "arrival_ts", _value(message).alias("value"))
