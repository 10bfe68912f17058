"""Record layouts shared by the batch and the streaming form."""

from __future__ import annotations

from pyspark.sql import types as T

# Kinds of a tagged change row.
UPSERT, DELETE, PRICE, STOCK = "P", "D", "R", "S"

MONEY = T.DecimalType(38, 18)

PRODUCT_FIELDS = ("name", "category", "brand", "description")
PRICE_FIELDS = ("price", "currency")

#: One accepted input event of any of the three streams. ``seq`` is the arrival
#: order: unique within a product, and never decreasing against ``arrival_ts``.
CHANGE = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("arrival_ts", T.TimestampType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("price", MONEY),
        T.StructField("currency", T.StringType()),
        T.StructField("warehouse_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
    ]
)

#: The enriched document, in wire order.
DOCUMENT = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("price", MONEY),
        T.StructField("currency", T.StringType()),
        T.StructField("total_stock", T.LongType()),
        T.StructField("stock_by_warehouse", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField("last_product_update", T.TimestampType()),
        T.StructField("last_price_update", T.TimestampType()),
        T.StructField("last_stock_update", T.TimestampType()),
        T.StructField("completeness", T.DoubleType()),
        T.StructField("indexed_at", T.TimestampType()),
    ]
)

#: Names of the document's fields on the wire and in the index.
WIRE_NAMES = {
    "product_id": "productId",
    "name": "name",
    "category": "category",
    "brand": "brand",
    "description": "description",
    "price": "price",
    "currency": "currency",
    "total_stock": "totalStock",
    "stock_by_warehouse": "stockByWarehouse",
    "last_product_update": "lastProductUpdate",
    "last_price_update": "lastPriceUpdate",
    "last_stock_update": "lastStockUpdate",
    "completeness": "completeness",
    "indexed_at": "indexedAt",
}

#: Every field but the one that differs on each emission.
CONTENT_FIELDS = tuple(f for f in DOCUMENT.fieldNames() if f != "indexed_at")

#: Catalogue row inside a change envelope; ``updated_at`` is read as text since
#: it may be a number or an ISO time. Images are read as text first.
ENVELOPE_ROW = (
    "product_id string, name string, category string, brand string,"
    " description string, updated_at string"
)
ENVELOPE = "op string, before string, after string"

PRODUCT_MESSAGE = (
    "productId string, name string, category string, brand string,"
    " description string, updatedAt string, operation string"
)
PRICE_MESSAGE = "productId string, price string, currency string, updatedAt string"
STOCK_MESSAGE = "productId string, warehouseId string, quantity string, updatedAt string"
