"""Product x price x stock, joined incrementally along each product's history.

Every function keeps one row per input event and adds the state right after it,
so any report on the changelog is a projection or an aggregate of these rows.

* A product or price event is accepted only if strictly newer than the latest
  of its kind since the last delete. Such an event is the maximum of
  ``(epoch, updated_at, -seq)`` so far, where ``epoch`` counts deletes.
* A delete forgets product and price for the first join only. The second join
  goes on with the latest pair it was handed: the pair of the last epoch that
  has any product or price event.
* Stock is last-arrived-wins per warehouse and always accepted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave import schemas as S
from docweave.functions.columns import completeness, whole_ms
from docweave.operators.running import MAX_ROWS_PER_KEY, Layout, by_history_length, running


def _is(kind: str) -> Column:
    return F.col("kind") == kind


def _versioned(kind: str, fields: tuple[str, ...]) -> Column:
    """Ordered by epoch, then time, then first arrival; the rest is payload."""
    return F.when(
        _is(kind),
        F.struct(
            F.col("epoch"),
            F.col("updated_at").alias("at"),
            (-F.col("seq")).alias("order"),
            *(F.col(f) for f in fields),
        ),
    )


def _latest_of_each_kind(payload: bool = True) -> dict[str, Column]:
    return {
        "last_product": _versioned(S.UPSERT, S.PRODUCT_FIELDS if payload else ()),
        "last_price": _versioned(S.PRICE, S.PRICE_FIELDS if payload else ()),
    }


def with_epochs(changes: DataFrame, layout: Layout, extra_reset: Column | None = None) -> DataFrame:
    """Counts the deletes (and ``extra_reset`` rows) of the product so far."""
    reset = _is(S.DELETE)
    if extra_reset is not None:
        reset = reset | extra_reset
    return running(changes, layout, sums={"epoch": F.when(reset, 1).otherwise(0)})


def _judge(rows: DataFrame) -> DataFrame:
    """Acceptance and join hit of each event, from the running maxima."""
    first_product = F.col("last_product.order") == -F.col("seq")
    first_price = F.col("last_price.order") == -F.col("seq")
    product_live = F.coalesce(F.col("last_product.epoch") == F.col("epoch"), F.lit(False))
    price_live = F.coalesce(F.col("last_price.epoch") == F.col("epoch"), F.lit(False))
    return rows.withColumns(
        {
            "accepted": F.when(_is(S.UPSERT), first_product)
            .when(_is(S.PRICE), first_price)
            .otherwise(_is(S.STOCK)),
            "other_side": F.when(_is(S.UPSERT), price_live).when(_is(S.PRICE), product_live),
        }
    )


def _pair(product: str, price: str) -> dict[str, str]:
    """Product and price of the last epoch that has either, as SQL."""

    def of(side: str, field: str) -> str:
        last = f"greatest({product}.epoch, {price}.epoch)"
        return f"CASE WHEN {side}.epoch = {last} THEN {side}.{field} END"

    return {
        **{f: of(product, f) for f in S.PRODUCT_FIELDS},
        "last_product_update": of(product, "at"),
        **{f: of(price, f) for f in S.PRICE_FIELDS},
        "last_price_update": of(price, "at"),
    }


def _as_columns(fields: dict[str, str]) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in fields.items()}


PAIR_FIELDS = (*S.PRODUCT_FIELDS, "last_product_update", *S.PRICE_FIELDS, "last_price_update")


def pair_history(
    changes: DataFrame, layout: Layout, extra_reset: Column | None = None
) -> DataFrame:
    """First join: product and price rows with acceptance and the pair after each."""
    rows = with_epochs(layout.arrange(changes.filter(~_is(S.STOCK))), layout, extra_reset)
    rows = _judge(running(rows, layout, maxes=_latest_of_each_kind()))
    return rows.withColumns(_as_columns(_pair("last_product", "last_price"))).drop("last_product", "last_price")


def judged_history(changes: DataFrame, layout: Layout) -> DataFrame:
    """Product and price rows with acceptance and join hit only.

    Neither reads nor exchanges the fields that only documents need.
    """
    rows = with_epochs(layout.arrange(changes.filter(~_is(S.STOCK))), layout)
    rows = _judge(running(rows, layout, maxes=_latest_of_each_kind(payload=False)))
    return rows.select(
        "seq", "arrival_ts", "product_id", "kind", "updated_at", "epoch", "accepted", "other_side", *layout.group[1:]
    )


def counted_events(changes: DataFrame, max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Events the stage counters count: accepted products and prices, all stock.

    Stock is always accepted, so its rows need no exchange.
    """
    judged = by_history_length(changes, judged_history, max_rows=max_rows)
    columns = ["seq", "arrival_ts", "product_id", "kind"]
    return (
        judged.filter("accepted")
        .select(*columns, "other_side")
        .unionByName(changes.filter(_is(S.STOCK)).select(*columns), allowMissingColumns=True)
    )


def stock_history(changes: DataFrame, layout: Layout) -> DataFrame:
    """Stock rows with the quantity replaced, the running total and latest time."""
    rows = layout.arrange(changes.filter(_is(S.STOCK)))
    rows = with_replaced(rows, layout)
    sums, maxes = stock_columns()
    return running(rows, layout, sums=sums, maxes=maxes)


def with_replaced(rows: DataFrame, layout: Layout, within: tuple[str, ...] = ()) -> DataFrame:
    """Adds the quantity of the same warehouse before this row (within ``within``)."""
    quantity = F.when(_is(S.STOCK), F.struct("seq", "quantity"))
    rows = running(
        rows,
        layout,
        maxes={"_quantity": quantity},
        prior={"_replaced": "_quantity"},
        within=(*within, "warehouse_id"),
    )
    return rows.withColumn("replaced", F.col("_replaced.quantity")).drop("_replaced")


def stock_columns() -> tuple[dict[str, Column], dict[str, Column]]:
    delta = F.col("quantity").cast("bigint") - F.coalesce(F.col("replaced"), F.lit(0))
    stock_at = whole_ms(F.col("updated_at"))
    return (
        {"total_stock": F.when(_is(S.STOCK), delta)},
        # times up to the epoch leave the latest stock time as it is
        {"last_stock_update": F.when(_is(S.STOCK) & (F.unix_millis(stock_at) > 0), stock_at)},
    )


def without_payload(changes: DataFrame) -> DataFrame:
    """Changes with a 64-bit hash in place of the product's texts.

    For reports that ask whether a document changed and whether it has a name, not what it
    says: windows and the exchange then carry eight bytes. ``name`` stays null where it was.
    """
    digest = F.xxhash64(*S.PRODUCT_FIELDS, *(F.col(f).isNull() for f in S.PRODUCT_FIELDS))
    named, nothing = F.col("name").isNotNull(), F.lit(None).cast("bigint")
    return changes.withColumns(
        {
            "name": F.when(_is(S.UPSERT) & named, digest),
            "category": F.when(_is(S.UPSERT) & ~named, digest),
            "brand": nothing,
            "description": nothing,
        }
    )


def document_history(changes: DataFrame, layout: Layout) -> DataFrame:
    """Both joins and the change test in one pass: one row per event.

    Adds the document after the event (all fields but the stock map, see
    ``attach_stock_map``), ``accepted``, ``other_side`` and ``unchanged``.
    """
    rows = layout.arrange(changes)
    rows = with_replaced(rows, layout)
    rows = with_epochs(rows, layout)
    sums, maxes = stock_columns()
    rows = running(
        rows,
        layout,
        sums=sums,
        maxes={**_latest_of_each_kind(), **maxes},
        prior={
            "_prior_product": "last_product",
            "_prior_price": "last_price",
            "_prior_stock_update": "last_stock_update",
        },
    )
    rows = _judge(rows)
    after = _pair("last_product", "last_price")
    before = _pair("_prior_product", "_prior_price")
    same_pair = F.expr(f"struct({', '.join(after.values())}) <=> struct({', '.join(before.values())})")
    same_stock = F.col("replaced").eqNullSafe(F.col("quantity")) & F.col(
        "last_stock_update"
    ).eqNullSafe(F.col("_prior_stock_update"))
    rows = rows.withColumn(
        "unchanged",
        F.col("accepted") & F.when(_is(S.STOCK), same_stock).otherwise(same_pair),
    )
    return rows.withColumns(_as_columns(after)).drop(
        "last_product", "last_price", "_prior_product", "_prior_price", "_prior_stock_update"
    )


def documents(history: DataFrame) -> DataFrame:
    """Documents of the accepted events, stamped with the clock."""
    return history.filter(F.col("accepted")).withColumns(
        {
            "completeness": completeness(F.col("name"), F.col("price"), F.col("total_stock")),
            "indexed_at": F.col("arrival_ts"),
        }
    )


def emitted(history: DataFrame) -> DataFrame:
    """Documents that differ from the one before them."""
    return documents(history.filter(~F.col("unchanged")))
