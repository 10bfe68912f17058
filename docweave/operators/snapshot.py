"""Current state per key, without the changelog between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave import schemas as S
from docweave.functions.columns import completeness, whole_ms
from docweave.operators.running import checkpointed

#: Products with a delete that are sent to every task, some 50 bytes each.
MAX_BROADCAST_ROWS = 500_000
#: Parts of a product's rows where there are more.
PARTS = 32


def latest_stock(changes: DataFrame) -> DataFrame:
    """Last-arrived quantity per product and warehouse."""
    stock = changes.filter(F.col("kind") == S.STOCK)
    at = whole_ms(F.col("updated_at"))
    return stock.groupBy("product_id", "warehouse_id").agg(
        F.max_by("quantity", "seq").alias("quantity"),
        F.max(F.when(F.unix_millis(at) > 0, at)).alias("last_stock_update"),
        F.max("arrival_ts").alias("arrival_ts"),
    )


def stock_totals(changes: DataFrame) -> DataFrame:
    """Stock map, total and latest time per product.

    Reduced per warehouse first, so a product with very many stock events
    reaches its one task as one row per warehouse.
    """
    return (
        latest_stock(changes)
        .groupBy("product_id")
        .agg(
            F.sum(F.col("quantity").cast("bigint")).alias("total_stock"),
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct("warehouse_id", "quantity")))
            ).alias("stock_by_warehouse"),
            F.max("last_stock_update").alias("last_stock_update"),
            F.max("arrival_ts").alias("stock_arrival"),
        )
    )


def _last_rows(changes: DataFrame) -> DataFrame:
    """``last_delete`` and ``last_event`` of each product that was ever deleted; reads three columns."""
    is_delete = F.col("kind") == S.DELETE
    ends = changes.filter(F.col("kind") != S.STOCK).groupBy("product_id").agg(
        F.max(F.when(is_delete, F.col("seq"))).alias("last_delete"),
        F.max(F.when(~is_delete, F.col("seq"))).alias("last_event"),
    )
    return ends.filter("last_delete IS NOT NULL")


def _newest_after(changes: DataFrame, resets: DataFrame) -> DataFrame:
    """The newest product and price of each product among the rows after its ``reset``, if it has one.

    The newest is the first to arrive of those with the latest time, so partial results combine in any
    order and one row per product and task crosses the exchange. Deleted products go along to every
    task as long as they are few; else both sides are dealt by product and a part of the arrival order,
    so that a product with very many rows is no large group either.
    """
    sides = {S.UPSERT: S.PRODUCT_FIELDS, S.PRICE: S.PRICE_FIELDS}
    rows = changes.filter(F.col("kind").isin(*sides))
    resets = checkpointed(resets)
    if resets.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        rows, keys = rows.join(F.broadcast(resets), "product_id", "left"), ["product_id"]
    else:
        parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
        rows = rows.withColumn("_part", F.pmod(F.xxhash64("seq"), F.lit(PARTS)).cast("int"))
        keys = ["product_id", "_part"]
        rows = rows.join(resets.withColumn("_part", parts), keys, "left")
    rows = rows.filter(F.col("reset").isNull() | (F.col("seq") > F.col("reset")))
    newest = {
        kind: F.max(
            F.when(
                F.col("kind") == kind,
                F.struct(F.col("updated_at").alias("at"), (-F.col("seq")).alias("order"), "arrival_ts", *fields),
            )
        )
        for kind, fields in sides.items()
    }
    made = rows.groupBy(*keys).agg(newest[S.UPSERT].alias("product"), newest[S.PRICE].alias("price_row"))
    if len(keys) > 1:
        made = made.groupBy("product_id").agg(F.max("product").alias("product"), F.max("price_row").alias("price_row"))
    product_last = F.col("price_row.order").isNull() | (F.col("product.order") < F.col("price_row.order"))
    return made.select(
        "product_id",
        *(F.col(f"product.{f}") for f in S.PRODUCT_FIELDS), F.col("product.at").alias("last_product_update"),
        *(F.col(f"price_row.{f}") for f in S.PRICE_FIELDS), F.col("price_row.at").alias("last_price_update"),
        F.when(product_last, F.col("product.arrival_ts")).otherwise(F.col("price_row.arrival_ts")).alias("pair_arrival"),
    )


def latest_pairs(changes: DataFrame) -> DataFrame:
    """The pair last handed to the second join, per product; survives a delete.

    It is made of the rows between the last two deletes that have any between them or after them: deletes
    that no event follows change nothing.
    """
    last = _last_rows(changes).filter("last_event IS NOT NULL")
    followed = last.filter("last_event > last_delete").select("product_id", F.col("last_delete").alias("reset"))
    deletes = changes.filter(F.col("kind") == S.DELETE).select("product_id", "seq")
    earlier = (
        deletes.join(last.filter("last_event < last_delete"), "product_id").filter("seq < last_event")
        .groupBy("product_id").agg(F.max("seq").alias("reset"))
    )
    return _newest_after(changes, followed.unionByName(earlier))


def product_price_state(changes: DataFrame) -> DataFrame:
    """The first join's state after all events: nothing from before the last delete."""
    resets = _last_rows(changes).select("product_id", F.col("last_delete").alias("reset"))
    return _newest_after(changes, resets).drop("pair_arrival")


def latest_documents(changes: DataFrame) -> DataFrame:
    """One current document per product: product, price and stock joined in full."""
    pairs = latest_pairs(changes)
    joined = pairs.join(stock_totals(changes), "product_id", "full")
    empty = F.create_map().cast("map<string,int>")
    return joined.select(
        "product_id",
        *S.PRODUCT_FIELDS,
        *S.PRICE_FIELDS,
        "total_stock",
        F.coalesce("stock_by_warehouse", empty).alias("stock_by_warehouse"),
        "last_product_update",
        "last_price_update",
        "last_stock_update",
        completeness(F.col("name"), F.col("price"), F.col("total_stock")).alias("completeness"),
        F.greatest("pair_arrival", "stock_arrival").alias("indexed_at"),
    )
