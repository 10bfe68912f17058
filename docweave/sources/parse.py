"""Message text to typed events, as columns only.

Each parser keeps every input row and adds the event's fields plus
``reject_reason``, null for an accepted row. The clock is a column of the input,
so a replay gives the same result. The same functions serve batch and stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave import schemas as S
from docweave.functions.columns import NUMBER, WHOLE, epoch_ms, instant, is_blank, is_future

MALFORMED = "malformed"
NO_ROW = "no_row"
MISSING_FIELD = "missing_field"
BLANK_PRODUCT_ID = "blank_product_id"
BLANK_WAREHOUSE_ID = "blank_warehouse_id"
FUTURE_TIMESTAMP = "future_timestamp"

_CORRUPT = "_corrupt"
_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowSingleQuotes": "false",
}


def _once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Adds a column that later filters cannot be pushed below.

    They would take the expression along and evaluate it once per mention.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))


def _decoded(df: DataFrame, value: str, schema: str) -> tuple[DataFrame, Column]:
    """Adds ``_msg`` and gives the test for text that is no JSON object of the schema."""
    decoded = F.from_json(F.col(value), f"{schema}, {_CORRUPT} string", _JSON_OPTIONS)
    df = _once(df, "_msg", decoded)
    return df, F.col("_msg").isNull() | F.col(f"_msg.{_CORRUPT}").isNotNull()


def _is_container(text: Column, json: Column, *path: str) -> Column:
    """Whether a value read as text was an object or an array in the message.

    Only text that looks like one is looked up again.
    """
    value = F.try_variant_get(F.try_parse_json(json), "$." + ".".join(path), "variant")
    kind = F.schema_of_variant(value)
    # In a branch, so that no other message is parsed for it.
    return F.coalesce(F.when(text.rlike(r"^\s*[\[{]"), kind.rlike("^(OBJECT|ARRAY)")), F.lit(False))


def _number(text: Column, pattern: str, kind: str) -> Column:
    """A number or the text of one; null for anything else, grouping signs included."""
    plain = F.trim(text)
    return F.when(plain.rlike(pattern), plain.try_cast(kind))


def _first_reason(*tests: tuple[Column, str]) -> Column:
    """Reason of the first test that holds; a null test does not hold."""
    return F.coalesce(*(F.when(test, F.lit(reason)) for test, reason in tests))


def parse_catalogue(
    df: DataFrame, value: str = "value", clock: str = "arrival_ts", parse_iso: bool = False
) -> DataFrame:
    """Change envelopes of the catalogue table to product events.

    ``updated_at`` counts only as epoch milliseconds above zero; anything else
    takes the clock, unless ``parse_iso`` also admits ISO text.
    """
    df, malformed = _decoded(df, value, S.ENVELOPE)
    # Only the chosen image is read: what the other one holds makes no difference.
    image = F.when(F.col("_msg.op") == "d", F.col("_msg.before")).otherwise(F.col("_msg.after"))
    row = F.from_json(image, f"{S.ENVELOPE_ROW}, {_CORRUPT} string", _JSON_OPTIONS)
    df = _once(df.withColumns({"operation": F.col("_msg.op"), "_image": image}), "_row", row)
    unreadable = F.col(f"_row.{_CORRUPT}").isNotNull()
    now_ms = F.unix_millis(F.col(clock))
    stamp = epoch_ms(F.col("_row.updated_at"))
    iso = instant(F.col("_row.updated_at")) if parse_iso else F.lit(None).cast("timestamp")
    df = _once(df, "_ms", stamp).withColumn("_iso", iso)
    ahead = (F.col("_ms") > now_ms + 60_000) | is_future(F.col("_iso"), F.col(clock))
    no_row = F.col("operation").isNull() | is_blank(F.col("operation")) | F.col("_image").isNull()
    key = F.col("_row.product_id")
    no_key = key.isNull() | is_blank(key) | _is_container(key, F.col("_image"), "product_id")
    df = df.withColumn(
        "reject_reason",
        _first_reason(
            (malformed, MALFORMED),
            (no_row, NO_ROW),
            (unreadable, MALFORMED),
            (no_key, BLANK_PRODUCT_ID),
            (ahead, FUTURE_TIMESTAMP),
        ),
    )
    timed = F.when((F.col("_ms") > 0) & ~F.coalesce(ahead, F.lit(False)), F.timestamp_millis("_ms"))
    return df.withColumns(
        {
            "product_id": F.col("_row.product_id"),
            "name": F.coalesce(F.col("_row.name"), F.lit("")),
            "category": F.col("_row.category"),
            "brand": F.col("_row.brand"),
            "description": F.col("_row.description"),
            "updated_at": F.coalesce(timed, F.col("_iso"), F.col(clock)),
        }
    ).drop("_msg", "_image", "_row", "_ms", "_iso")


def parse_products(df: DataFrame, value: str = "value") -> DataFrame:
    """Plain product messages: only required fields are checked."""
    df, malformed = _decoded(df, value, S.PRODUCT_MESSAGE)
    df = _once(df, "updated_at", instant(F.col("_msg.updatedAt")))
    required = [F.col(f"_msg.{f}") for f in ("productId", "name", "updatedAt", "operation")]
    bad_time = F.col("_msg.updatedAt").isNotNull() & F.col("updated_at").isNull()
    return df.withColumns(
        {
            "reject_reason": _first_reason(
                (malformed | bad_time, MALFORMED), (_any_null(required), MISSING_FIELD)
            ),
            "product_id": F.col("_msg.productId"),
            "name": F.col("_msg.name"),
            "category": F.col("_msg.category"),
            "brand": F.col("_msg.brand"),
            "description": F.col("_msg.description"),
            "operation": F.col("_msg.operation"),
        }
    ).drop("_msg")


def parse_prices(df: DataFrame, value: str = "value", clock: str = "arrival_ts") -> DataFrame:
    """A price may be a number or its text; more than 20 digits before the point are malformed, after it 18 are kept."""
    df, malformed = _decoded(df, value, S.PRICE_MESSAGE)
    df = _once(df, "updated_at", instant(F.col("_msg.updatedAt")))
    required = [F.col(f"_msg.{f}") for f in ("productId", "price", "currency", "updatedAt")]
    price = _number(F.col("_msg.price"), NUMBER, "decimal(38,18)")
    bad_price = F.col("_msg.price").isNotNull() & price.isNull()
    bad_id = _is_container(F.col("_msg.productId"), F.col(value), "productId")
    bad_time = F.col("_msg.updatedAt").isNotNull() & F.col("updated_at").isNull()
    return df.withColumns(
        {
            "reject_reason": _first_reason(
                (malformed | bad_time | bad_price | bad_id, MALFORMED),
                (_any_null(required), MISSING_FIELD),
                (is_blank(F.col("_msg.productId")), BLANK_PRODUCT_ID),
                (is_future(F.col("updated_at"), F.col(clock)), FUTURE_TIMESTAMP),
            ),
            "product_id": F.col("_msg.productId"),
            "price": price,
            "currency": F.col("_msg.currency"),
        }
    ).drop("_msg")


def parse_stock(df: DataFrame, value: str = "value", clock: str = "arrival_ts") -> DataFrame:
    """A quantity may be a whole number or its text; a missing or fractional one is rejected."""
    df, malformed = _decoded(df, value, S.STOCK_MESSAGE)
    df = _once(df, "updated_at", instant(F.col("_msg.updatedAt")))
    required = [F.col(f"_msg.{f}") for f in ("productId", "warehouseId", "quantity", "updatedAt")]
    quantity = _number(F.col("_msg.quantity"), WHOLE, "int")
    bad_quantity = F.col("_msg.quantity").isNotNull() & quantity.isNull()
    bad_id = _is_container(F.col("_msg.productId"), F.col(value), "productId") | _is_container(
        F.col("_msg.warehouseId"), F.col(value), "warehouseId"
    )
    bad_time = F.col("_msg.updatedAt").isNotNull() & F.col("updated_at").isNull()
    return df.withColumns(
        {
            "reject_reason": _first_reason(
                (malformed | bad_time | bad_quantity | bad_id, MALFORMED),
                (_any_null(required), MISSING_FIELD),
                (is_blank(F.col("_msg.productId")), BLANK_PRODUCT_ID),
                (is_blank(F.col("_msg.warehouseId")), BLANK_WAREHOUSE_ID),
                (is_future(F.col("updated_at"), F.col(clock)), FUTURE_TIMESTAMP),
            ),
            "product_id": F.col("_msg.productId"),
            "warehouse_id": F.col("_msg.warehouseId"),
            "quantity": quantity,
        }
    ).drop("_msg")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Rows for a quarantine table: the raw text and why it was dropped."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(value, "reject_reason")


def reject_counts(parsed: DataFrame) -> DataFrame:
    return (
        parsed.filter(F.col("reject_reason").isNotNull())
        .groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _any_null(columns: list[Column]) -> Column:
    test = columns[0].isNull()
    for column in columns[1:]:
        test = test | column.isNull()
    return test
