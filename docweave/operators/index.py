"""Upserts into the keyed document table, its typed form, and reads from it.

An upsert replaces every scalar field, by null too, and merges the stock map by
warehouse: a warehouse the new document lacks stays as it was. The rule is
associative, so documents may be folded per batch, per partition or all at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docweave import schemas as S
from docweave.functions.columns import sorted_entries

SCALARS = tuple(f for f in S.DOCUMENT.fieldNames() if f not in ("product_id", "stock_by_warehouse"))


def fold_upserts(documents: DataFrame, order: list[str]) -> DataFrame:
    """All upserts of each product folded into one, which keeps the last ``order``.

    Reads its input once, so it also serves a micro-batch.
    """
    stock = F.map_entries("stock_by_warehouse")
    none = F.array(F.lit(None).cast(T.StructType([
        T.StructField("key", T.StringType()), T.StructField("value", T.IntegerType())
    ])))
    # one row per warehouse and, without a key, one for the scalar fields
    pieces = documents.select(
        "product_id",
        F.struct(*order).alias("version"),
        F.struct(*SCALARS).alias("doc"),
        F.explode(F.concat(none, F.coalesce(stock, none))).alias("entry"),
    )
    scalar = F.col("entry.key").isNull()
    last = F.struct("version", "entry.value", F.when(scalar, F.col("doc")).alias("doc"))
    newest = pieces.groupBy("product_id", F.col("entry.key").alias("key")).agg(
        F.max(last).alias("last")
    )
    entry = F.when(F.col("key").isNotNull(), F.struct("key", "last.value"))
    folded = newest.groupBy("product_id").agg(
        F.max(F.when(F.col("key").isNull(), F.struct("last.version", "last.doc"))).alias("last"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("stock_by_warehouse"),
    )
    return folded.select(
        "product_id", "last.doc.*", "stock_by_warehouse", "last.version.*"
    ).select(*S.DOCUMENT.fieldNames(), *order)


def last_documents(documents: DataFrame, maps: DataFrame | None = None) -> DataFrame:
    """The last document of each product, without its stock map or with that of ``maps`` (one row per product).

    That is ``fold_upserts`` where a product's documents never lose a warehouse,
    as without expiry, for one small row per product and task. A suppressed document changes no stock,
    so the map after all events is that of the last document sent.
    """
    fields = [f for f in S.DOCUMENT.fieldNames() if f in documents.columns and f != "stock_by_warehouse"]
    last = F.max_by(F.struct(*fields), "seq").alias("last")
    rows = documents.groupBy("product_id").agg(last).select("last.*")
    if maps is None:
        return rows
    stock = F.coalesce("stock_by_warehouse", F.create_map().cast("map<string,int>")).alias("stock_by_warehouse")
    joined = rows.join(maps.select("product_id", "stock_by_warehouse"), "product_id", "left")
    return joined.withColumn("stock_by_warehouse", stock).select(*S.DOCUMENT.fieldNames())


#: Documents as the index types them: cents, 32-bit counts and scores.
_INDEX_TYPES = {
    "price": T.DecimalType(18, 2),
    "total_stock": T.IntegerType(),
    "completeness": T.FloatType(),
}


def typed(documents: DataFrame) -> DataFrame:
    """The fields that ``documents`` have, as the index types them."""
    rounded = {"price": F.round("price", 2)}
    return documents.select(
        *(
            rounded.get(f, F.col(f)).cast(_INDEX_TYPES[f]).alias(f)
            if f in _INDEX_TYPES
            else F.col(f)
            for f in S.DOCUMENT.fieldNames()
            if f in documents.columns
        )
    )


def document_json(documents: DataFrame) -> DataFrame:
    """Documents as wire JSON: all fields in order, nulls written, ISO times in UTC.

    The price is written without exponent and without zeros that only fill up its scale.
    """
    plain = F.regexp_replace(F.col("price").cast("string"), r"\.?0+$", "")
    written = {"stock_by_warehouse": F.map_from_entries(sorted_entries(F.col("stock_by_warehouse"))), "price": plain}
    fields = [written.get(f, F.col(f)).alias(wire) for f, wire in S.WIRE_NAMES.items()]
    options = {
        "ignoreNullFields": "false",
        "timeZone": "UTC",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    }
    text = F.to_json(F.struct(*fields), options)
    # Quotes inside a text are escaped, so this is the field and nothing else.
    text = F.regexp_replace(text, r'"price":"([^"]*)"', '"price":$1')
    return documents.select("product_id", text.alias("json"))


def update_actions(documents: DataFrame) -> DataFrame:
    """The bulk action of each document: an update by id that creates what isn't there."""
    body = F.concat(F.lit('{"doc":'), F.col("json"), F.lit(',"doc_as_upsert":true}'))
    return document_json(documents).select("product_id", body.alias("action"))


def bulk_requests(documents: DataFrame, index_name: str, most: int, buckets: int = 64) -> DataFrame:
    """Bodies of bulk requests of at most ``most`` updates each: ``bucket``, ``request``, ``updates``, ``first_id``, ``last_id``, ``body``.

    Products are dealt to buckets by a hash, so requests are made side by side; within one they go by product.
    A body has two lines for each update: what to update, and the document.
    """
    head = F.to_json(F.struct(F.struct(F.lit(index_name).alias("_index"), F.col("product_id").alias("_id")).alias("update")))
    rows = update_actions(documents).select(
        "product_id", F.concat(head, F.lit("\n"), F.col("action"), F.lit("\n")).alias("lines"),
        F.pmod(F.crc32(F.col("product_id").cast("binary")), F.lit(buckets)).cast("int").alias("bucket"),
    )
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("product_id")) - 1
    rows = rows.withColumn("request", F.floor(place / most).cast("int"))
    sorted_lines = F.array_sort(F.collect_list(F.struct("product_id", "lines")))
    return rows.groupBy("bucket", "request").agg(
        F.count(F.lit(1)).alias("updates"), F.min("product_id").alias("first_id"), F.max("product_id").alias("last_id"),
        F.array_join(F.transform(sorted_lines, lambda x: x["lines"]), "").alias("body"),
    )


READ_FIELDS = (
    "product_id",
    "name",
    "price",
    "total_stock",
    "completeness",
    "indexed_at",
    "last_product_update",
    "last_price_update",
    "last_stock_update",
)


def lookup(index: DataFrame, product_id: str) -> DataFrame:
    """The document of one product, or no row."""
    return index.filter(F.col("product_id") == product_id).select(*READ_FIELDS)


def document_count(index: DataFrame) -> DataFrame:
    return index.agg(F.count(F.lit(1)).alias("documents"))


def product_count(changes: DataFrame) -> DataFrame:
    """How many documents these changes make: a product's first event that is no delete makes one."""
    products = changes.filter(F.col("kind") != S.DELETE).select("product_id").distinct()
    return products.agg(F.count(F.lit(1)).alias("documents"))


def at_least_complete(index: DataFrame, threshold: float) -> DataFrame:
    return index.filter(F.col("completeness") >= threshold).select(*READ_FIELDS)


def sample(index: DataFrame, n: int = 5) -> DataFrame:
    """The first n documents by product."""
    return index.orderBy("product_id").limit(n).select(*READ_FIELDS)
