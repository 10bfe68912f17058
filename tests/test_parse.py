import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docweave.sources import changes as C
from docweave.sources import parse

NOW = datetime(2024, 5, 1, 12, 0, 0)
NOW_MS = int((NOW - datetime(1970, 1, 1)).total_seconds() * 1000)


def iso(seconds=0.0):
    return (NOW + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def run(spark, parser, values, **options):
    rows = [(i, NOW, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "seq bigint, arrival_ts timestamp, value string")
    return [r.asDict() for r in parser(df, **options).orderBy("seq").collect()]


def price(**change):
    fields = {"productId": "p1", "price": 29.99, "currency": "USD", "updatedAt": iso(), **change}
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


PRICES = {
    "valid": (price(), None),
    "unknown field": (price(extra={"a": [1]}), None),
    "euro": (price(currency="EUR"), None),
    "zero": (price(price=0.00), None),
    "large": (price(price=1234567.89), None),
    "quoted": (price(price="19.99"), None),
    "grouped": (price(price="1,234.5"), "malformed"),
    "no number": (price(price=True), "malformed"),
    "id an object": (price(productId={"a": 1}), "malformed"),
    "id an array": (price(productId=["p1"]), "malformed"),
    "id like an object": (price(productId="{a}"), None),
    "price as text": (price(price="12.50"), None),
    "blank currency": (price(currency=""), None),
    "negative": (price(price=-1), None),
    "30 s ahead": (price(updatedAt=iso(30)), None),
    "60 s ahead": (price(updatedAt=iso(60)), None),
    "within the last millisecond": (price(updatedAt=iso(60.000999)), None),
    "60.001 s ahead": (price(updatedAt=iso(60.001)), "future_timestamp"),
    "120 s ahead": (price(updatedAt=iso(120)), "future_timestamp"),
    "seconds since the epoch": (price(updatedAt=NOW_MS / 1000), None),
    "with offset": (price(updatedAt="2024-05-01T14:00:00+02:00"), None),
    "no zone": (price(updatedAt="2024-05-01T12:00:00"), "malformed"),
    "date only": (price(updatedAt="2024-05-01"), "malformed"),
    "blank id": (price(productId=""), "blank_product_id"),
    "spaces": (price(productId="   "), "blank_product_id"),
    "other white space": (price(productId="\t  \n"), "blank_product_id"),
    "null id": (price(productId=None), "missing_field"),
    "missing price": (price(price=...), "missing_field"),
    "missing currency": (price(currency=...), "missing_field"),
    "missing time": (price(updatedAt=...), "missing_field"),
    "price no number": (price(price="abc"), "malformed"),
    "not json": ("{{not json}}", "malformed"),
    "not json either": ("not valid json {{{", "malformed"),
    "empty": ("", "malformed"),
    "null": (None, "malformed"),
    "array": ("[]", "malformed"),
    "number": ("17", "malformed"),
    "single quotes": ("{'productId':'p1'}", "malformed"),
}


@pytest.fixture(scope="module")
def prices(spark):
    return dict(zip(PRICES, run(spark, parse.parse_prices, [v for v, _ in PRICES.values()])))


@pytest.mark.parametrize("name", PRICES)
def test_price(prices, name):
    assert prices[name]["reject_reason"] == PRICES[name][1]


def test_price_values(prices):
    assert prices["large"]["price"] == Decimal("1234567.89")
    assert prices["zero"]["price"] == 0
    assert prices["valid"]["updated_at"] == NOW
    assert prices["with offset"]["updated_at"] == NOW
    assert prices["seconds since the epoch"]["updated_at"] == NOW


def stock(**change):
    fields = {"productId": "p1", "warehouseId": "w1", "quantity": 5, "updatedAt": iso(), **change}
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


STOCK = {
    "valid": (stock(), None),
    "negative": (stock(quantity=-4), None),
    "zero": (stock(quantity=0), None),
    "blank warehouse": (stock(warehouseId=" "), "blank_warehouse_id"),
    "blank id": (stock(productId=" ", warehouseId=""), "blank_product_id"),
    "missing quantity": (stock(quantity=...), "missing_field"),
    "fractional quantity": (stock(quantity=1.5), "malformed"),
    "quoted quantity": (stock(quantity="5"), None),
    "quantity no number": (stock(quantity="five"), "malformed"),
    "quantity too large": (stock(quantity=2**31), "malformed"),
    "warehouse an object": (stock(warehouseId={"a": 1}), "malformed"),
    "future": (stock(updatedAt=iso(61)), "future_timestamp"),
    "empty": ("", "malformed"),
}


def test_stock(spark):
    rows = run(spark, parse.parse_stock, [v for v, _ in STOCK.values()])
    assert {n: r["reject_reason"] for n, r in zip(STOCK, rows)} == {n: e for n, (_, e) in STOCK.items()}
    assert rows[1]["quantity"] == -4


def envelope(op="u", before=None, **change):
    row = {"product_id": "p1", "name": "Widget", "category": "c", "brand": None, "updated_at": NOW_MS - 5}
    row.update(change)
    row = {k: v for k, v in row.items() if v is not ...}
    message = {"op": op, "before": before, "after": None if op == "d" else row}
    return json.dumps({k: v for k, v in message.items() if v is not ...})


DELETED_ROW = {"product_id": "p1", "name": "Gone", "updated_at": NOW_MS - 9}
CATALOGUE = {
    "update": (envelope(), None),
    "snapshot read": (envelope(op="r"), None),
    "delete": (envelope(op="d", before=DELETED_ROW), None),
    "id an object": (envelope(product_id={"a": 1}), "blank_product_id"),
    "id an array": (envelope(product_id=["p1"]), "blank_product_id"),
    "id a number": (envelope(product_id=7), None),
    "unreadable row not chosen": (envelope(before="no row"), None),
    "unreadable row": (envelope(op="d", before="no row"), "malformed"),
    "delete without row": (envelope(op="d"), "no_row"),
    "no op": (envelope(op=...), "no_row"),
    "blank op": (envelope(op=" "), "no_row"),
    "heartbeat": ('{"ts_ms":1}', "no_row"),
    "no image": ('{"op":"u"}', "no_row"),
    "null image": ('{"op":"u","after":null}', "no_row"),
    "blank id": (envelope(product_id=" "), "blank_product_id"),
    "no id": (envelope(product_id=...), "blank_product_id"),
    "null name": (envelope(name=None), None),
    "no name": (envelope(name=...), None),
    "time 0": (envelope(updated_at=0), None),
    "time negative": (envelope(updated_at=-5), None),
    "no time": (envelope(updated_at=...), None),
    "time as text": (envelope(updated_at=str(NOW_MS - 5)), None),
    "iso time": (envelope(updated_at="2024-05-01T11:00:00Z"), None),
    "60 s ahead": (envelope(updated_at=NOW_MS + 60_000), None),
    "60.001 s ahead": (envelope(updated_at=NOW_MS + 60_001), "future_timestamp"),
    "far future": (envelope(updated_at=9_000_000_000_000_000_000), "future_timestamp"),
    "future delete": (envelope(op="d", before={**DELETED_ROW, "updated_at": NOW_MS + 99_999}), "future_timestamp"),
    "not json": ("{{not json}}", "malformed"),
    "empty": ("", "malformed"),
}


def test_catalogue(spark):
    rows = run(spark, parse.parse_catalogue, [v for v, _ in CATALOGUE.values()])
    got = dict(zip(CATALOGUE, rows))
    assert {n: r["reject_reason"] for n, r in got.items()} == {n: e for n, (_, e) in CATALOGUE.items()}
    assert got["update"]["updated_at"] == NOW - timedelta(milliseconds=5)
    assert got["time as text"]["updated_at"] == NOW - timedelta(milliseconds=5)
    for name in ("time 0", "time negative", "no time", "iso time"):
        assert got[name]["updated_at"] == NOW
    assert got["null name"]["name"] == got["no name"]["name"] == ""
    assert got["update"]["brand"] is None and got["update"]["description"] is None
    assert got["delete"]["name"] == "Gone" and got["delete"]["operation"] == "d"


def test_catalogue_iso_times_on_request(spark):
    rows = run(
        spark,
        parse.parse_catalogue,
        [envelope(updated_at="2024-05-01T11:00:00Z"), envelope(updated_at="2024-05-01T12:01:00.001Z")],
        parse_iso=True,
    )
    assert rows[0]["updated_at"] == NOW - timedelta(hours=1)
    assert [r["reject_reason"] for r in rows] == [None, "future_timestamp"]


def test_plain_products(spark):
    def message(**change):
        fields = {"productId": "p1", "name": "W", "updatedAt": iso(), "operation": "c", **change}
        return json.dumps({k: v for k, v in fields.items() if v is not ...})

    values = [message(), message(productId=""), message(updatedAt=iso(999)), message(name=...), "{{x"]
    rows = run(spark, parse.parse_products, values)
    assert [r["reject_reason"] for r in rows] == [None, None, None, "missing_field", "malformed"]


def test_rejects_keep_text_and_reason(spark):
    df = spark.createDataFrame([(0, NOW, "{{x"), (1, NOW, price())], "seq bigint, arrival_ts timestamp, value string")
    parsed = parse.parse_prices(df)
    assert parse.rejected(parsed).collect() == [("{{x", "malformed")]
    assert parse.reject_counts(parsed).collect() == [("malformed", 1)]
    assert parse.accepted(parsed).count() == 1


def test_filter_does_not_decode_twice(spark):
    df = spark.createDataFrame([(0, NOW, price())], "seq bigint, arrival_ts timestamp, value string")
    plan = parse.accepted(parse.parse_prices(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_merged_changes(spark):
    df = spark.createDataFrame([(0, NOW, "")], "seq bigint, arrival_ts timestamp, value string")
    catalogue = df.withColumn("value", F.lit(envelope(op="d", before=DELETED_ROW)))
    merged = C.merge_changes(
        parse.accepted(parse.parse_catalogue(catalogue)),
        parse.accepted(parse.parse_prices(df.withColumn("value", F.lit(price())))),
        parse.accepted(parse.parse_stock(df.withColumn("value", F.lit(stock())))),
    )
    assert sorted(r.kind for r in merged.collect()) == ["D", "R", "S"]
