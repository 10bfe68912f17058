"""What the processor keeps, read back from a checkpoint with Spark's state data source.

For audits: without lifetimes the kept pairs and stock are those of ``snapshot.latest_documents`` over the
same changes, however often the query was restarted between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave import schemas as S


def _array(text: Column) -> Column:
    """The elements of a JSON array as text."""
    return F.from_json(text, "array<string>")


def _micros(text: Column) -> Column:
    return F.timestamp_micros(text.cast("bigint"))


def kept_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """One row per product with state after the last batch, or that of ``batch_id``.

    The pair handed to the second join, the stock, the document sent as a hash, and when each of the three is forgotten.
    """
    reader = spark.read.format("statestore").option("stateVarName", "head")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    head = reader.load(checkpoint).select(F.col("key.product_id").alias("product_id"), "value.*")
    head = head.withColumn("_handed", _array(F.col("handed")))
    product, price = _array(F.col("_handed")[0]), _array(F.col("_handed")[2])
    stock = F.from_json("stock", "map<string,int>")
    return head.select(
        "product_id",
        *(product[i].alias(f) for i, f in enumerate(S.PRODUCT_FIELDS)),
        _micros(F.col("_handed")[1]).alias("last_product_update"),
        price[0].cast("decimal(38,18)").alias("price"), price[1].alias("currency"),
        _micros(F.col("_handed")[3]).alias("last_price_update"),
        stock.alias("stock_by_warehouse"),
        F.aggregate(F.map_values(stock), F.lit(0).cast("bigint"), lambda a, q: a + q).alias("total_stock"),
        F.timestamp_micros("stock_at").alias("last_stock_update"),
        F.xxhash64("sent").alias("sent_hash"),
        *(F.timestamp_micros(f"{stage}_due").alias(f"{stage}_due") for stage in ("pair", "stock", "sent")),
    )
