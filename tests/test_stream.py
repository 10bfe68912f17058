"""The whole streaming job over files: parsing, restart, timers, the table."""

import json
import random
import re
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docweave import schemas as S
from docweave.functions.lifecycle import Lifetimes
from docweave.operators import index
from docweave.operators.expiry import lifecycle, lifecycle_documents
from docweave.operators.snapshot import latest_documents
from docweave.plans.event_fixture import change_events
from docweave.settings import DEFAULTS, Settings, load_settings
from docweave.sources import parse
from docweave.sources.changes import merge_by_arrival
from docweave.streaming import progress
from docweave.streaming.index_table import IndexTable
from docweave.streaming.job import parsed_changes, start, start_quarantine
from docweave.streaming.processor import ARRIVAL
from docweave.streaming.state import kept_state

NOW = datetime(2024, 5, 1)
MESSAGES = "seq bigint, arrival_ts timestamp, value string"


def write(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def read(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def run(query):
    query.awaitTermination()
    return query


def as_text(df):
    return sorted(map(str, df.select(*S.DOCUMENT.fieldNames()).collect()))


def test_replay_with_restart_equals_batch(spark, tmp_path):
    changes = change_events(spark, "/root/testdata/sf0.001")
    day = Lifetimes.hours(24, 24, 24)
    table = IndexTable(spark, str(tmp_path / "index"))
    source = str(tmp_path / "in")
    counters = {}
    for part in range(3):  # one run per part; each picks up where the last one ended
        low, high = part * 340, (part + 1) * 340
        rows = changes.filter((F.col("seq") >= low) & (F.col("seq") < high))
        rows.coalesce(1).write.mode("append").parquet(source)
        query = run(
            start(read(spark, source, S.CHANGE), table, str(tmp_path / "checkpoint"), day, ARRIVAL)
        )
        for name, n in progress.counter_report(query).items():
            counters[name] = counters.get(name, 0) + n
        assert progress.checkpoint_report(query)[-1]["checkpoint_ms"] >= 0
        assert progress.lag_report(query)[0]["rows"] == rows.count()

    history = lifecycle(changes, day)
    expected = index.fold_upserts(lifecycle_documents(history), ["seq"])
    assert as_text(table.documents()) == as_text(expected)
    assert counters["join_hits"] == history.filter("other_side").count()
    assert counters["dedup_filtered"] == history.filter("outcome = 'suppressed'").count()
    one = expected.first().product_id
    assert table.lookup(one).collect() == index.lookup(expected, one).collect()


def test_state_equals_the_latest_documents(spark, tmp_path):
    """Read back with the state data source after a replay in two runs; the progress of all batches is kept."""
    changes = change_events(spark, "/root/testdata/sf0.001")
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    kept = progress.ProgressHistory(spark, str(tmp_path / "progress"), every=2)
    spark.streams.addListener(kept)
    try:
        for first in (0, 510):
            for low in range(first, first + 510, 170):  # one file each, in the order of arrival
                rows = changes.filter((F.col("seq") >= low) & (F.col("seq") < low + 170))
                rows.coalesce(1).write.mode("append").parquet(source)
            table = IndexTable(spark, str(tmp_path / "index"), buckets=2)
            run(start(read(spark, source, S.CHANGE), table, checkpoint, Lifetimes(), ARRIVAL))
        limit = time.time() + 30
        while len(kept._rows) + kept.history().count() < 6 and time.time() < limit:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(kept)
        kept.flush()
    seen = spark.read.parquet(source)
    history = kept.history().collect()
    assert sum(r.rows for r in history) == seen.count() and len({r.batch_id for r in history}) >= 6
    assert all(r.checkpoint_ms >= 0 and r.sources[0].rows == r.rows for r in history)
    assert sum(r.counters.get("events_processed_stock", 0) for r in history) == seen.filter("kind = 'S'").count()
    fields = ["product_id", "name", "price", "currency", "last_product_update", "last_price_update", "total_stock", "last_stock_update"]

    def shown(df):
        return sorted(map(str, df.select(*fields, F.sort_array(F.map_entries(F.coalesce("stock_by_warehouse", F.create_map().cast("map<string,int>"))))).collect()))

    assert shown(kept_state(spark, checkpoint)) == shown(latest_documents(seen))


def test_messages_end_to_end(spark, tmp_path):
    """Bad messages are dropped and the rest of the stream goes on."""
    at = NOW.strftime("%Y-%m-%dT%H:%M:%SZ")

    def message(**fields):
        return json.dumps(fields)

    envelope = {"op": "c", "after": {"product_id": "p1", "name": "Widget", "updated_at": 1714521600000}}
    write(spark, tmp_path / "catalogue", [(0, NOW, json.dumps(envelope)), (1, NOW, "not json")], MESSAGES)
    write(
        spark,
        tmp_path / "prices",
        [
            (0, NOW, "{{not json}}"),
            (1, NOW, message(productId="p1", price=19.99, currency="USD", updatedAt=at)),
            (2, NOW, message(productId="p1", price=1.0, currency="USD", updatedAt="2020-01-01T00:00:00Z")),
        ],
        MESSAGES,
    )
    write(
        spark,
        tmp_path / "stock",
        [(i, NOW, message(productId="p1", warehouseId=f"w{i}", quantity=q, updatedAt=at)) for i, q in enumerate([100, 200, 50])],
        MESSAGES,
    )
    streams = [read(spark, tmp_path / n, MESSAGES) for n in ("catalogue", "prices", "stock")]
    table = IndexTable(spark, str(tmp_path / "index"))
    run(start(parsed_changes(*streams), table, str(tmp_path / "cp"), Lifetimes(), ARRIVAL, by_arrival=True))
    found = index.lookup(table.documents(), "p1").collect()
    assert len(found) == 1
    assert (found[0].name, float(found[0].price), found[0].total_stock) == ("Widget", 19.99, 350)
    assert found[0].completeness == pytest.approx(1.0)
    assert index.lookup(table.documents(), "p2").collect() == []


def unrelated_offsets(spark, tmp_path=None):
    """Two prices at offsets 3 and 4, days apart, and a catalogue row at offset 5000 that came an hour after the first."""
    at = lambda days, hours=0: NOW + timedelta(days=days, hours=hours)
    iso = lambda t: t.strftime("%Y-%m-%dT%H:%M:%SZ")
    price = lambda p, t: json.dumps({"productId": "p1", "price": p, "currency": "USD", "updatedAt": iso(t)})
    stock = json.dumps({"productId": "p1", "warehouseId": "w", "quantity": 5, "updatedAt": iso(at(0, 2))})
    row = {"op": "c", "after": {"product_id": "p1", "name": "Widget", "updated_at": 1714525200000}}
    made = {
        "catalogue": [(5000, at(0, 1), json.dumps(row))],
        "prices": [(3, at(0), price(1.0, at(0))), (4, at(3), price(2.0, at(3)))],
        "stock": [(90_000, at(0, 2), stock)],
    }
    if tmp_path is None:
        return [spark.createDataFrame(rows, MESSAGES) for rows in made.values()]
    for name, rows in made.items():
        write(spark, tmp_path / name, rows, MESSAGES)
    return [read(spark, tmp_path / name, MESSAGES) for name in made]


def test_arrival_orders_unrelated_inputs(spark, tmp_path):
    """The product has its own clock, and the document of day 0 is complete; in batch and in the stream."""
    day = Lifetimes.hours(24, 24, 24)
    changes = parsed_changes(*unrelated_offsets(spark))
    rows = lifecycle_documents(lifecycle(changes, day)).orderBy("seq").collect()
    seen = [(r.kind, r.arrival_ts - NOW, r.name, None if r.price is None else float(r.price), r.total_stock) for r in rows]
    hours = lambda h: timedelta(hours=h)
    assert seen == [
        ("R", hours(0), None, 1.0, None), ("P", hours(1), "Widget", 1.0, None), ("S", hours(2), "Widget", 1.0, 5), ("R", hours(72), None, 2.0, None),
    ]
    table = IndexTable(spark, str(tmp_path / "index"), buckets=2)
    streams = parsed_changes(*unrelated_offsets(spark, tmp_path))
    run(start(streams, table, str(tmp_path / "cp"), day, ARRIVAL, by_arrival=True))
    found = table.lookup("p1").first()
    assert (found.name, float(found.price), found.indexed_at) == (None, 2.0, NOW + hours(72))
    assert table.documents().first().stock_by_warehouse == {"w": 5}


@pytest.mark.parametrize("max_rows", [1000, 8], ids=["whole", "blocked"])
def test_an_input_keeps_its_own_order(spark, max_rows):
    """Also where its arrival times step back; partitions of a topic are apart."""
    rng = random.Random(2)
    tables, expected = [], []
    for i, kind in enumerate(("P", "R", "S")):
        rows = [(part, n, NOW + timedelta(minutes=3 * n + rng.randrange(-9, 9)), f"p{rng.randrange(3)}{part}") for part in range(2) for n in range(30)]
        schema = "partition int, seq long, arrival_ts timestamp, product_id string"
        tables.append(spark.createDataFrame(rows, schema).withColumn("operation", F.lit("u")))
        for part in range(2):
            clock = datetime.min
            for _, n, at, product in (r for r in rows if r[0] == part):
                clock = max(clock, at)
                expected.append((clock, i, part, n, kind, product))
    got = merge_by_arrival(*tables, max_rows=max_rows).orderBy("seq").collect()
    assert [(r.arrival_ts, r.kind, r.product_id) for r in got] == [(e[0], e[4], e[5]) for e in sorted(expected)]
    assert len({r.seq for r in got}) == len(got)


def change(seq, kind, product, **fields):
    row = dict.fromkeys(S.CHANGE.fieldNames())
    row.update(seq=seq, kind=kind, product_id=product, arrival_ts=NOW, **fields)
    return tuple(row.values())


def test_timers_of_the_real_clock(spark, tmp_path):
    """An idle product is forgotten without input; one kept busy is not."""
    source = tmp_path / "in"
    table = IndexTable(spark, str(tmp_path / "index"))
    short = Lifetimes(pair=8_000_000, stock=8_000_000, sent=8_000_000)
    seen = {"at": NOW}

    sent = {}

    def await_input():
        """Batches go on without input, so the rows taken in are counted."""
        limit = time.time() + 60
        taken = 0
        while taken < len(sent) and time.time() < limit:
            time.sleep(0.2)
            for p in query.recentProgress:
                batches[p["batchId"]] = p["numInputRows"]
            taken = sum(batches.values())
        assert taken == len(sent)

    batches = {}

    def send(*rows):
        sent.update({r[0]: r for r in rows})
        write(spark, source, list(rows), S.CHANGE)
        await_input()

    def product(seq, key):
        seen["at"] += timedelta(seconds=1)
        return change(seq, "P", key, name=f"name {seq}", updated_at=seen["at"])

    source.mkdir()
    query = start(read(spark, source, S.CHANGE), table, str(tmp_path / "cp"), short)
    try:
        send(product(0, "idle"), product(1, "busy"))
        for seq in (2, 3, 4):
            time.sleep(3.5)
            send(product(seq, "busy"))
        send(*(change(9 + i, "S", k, warehouse_id="w", quantity=1, updated_at=NOW) for i, k in enumerate(("idle", "busy"))))
    finally:
        query.stop()
    names = {r.product_id: r.name for r in table.documents().collect()}
    assert names == {"idle": None, "busy": "name 4"}


def test_quarantine(spark, tmp_path):
    write(spark, tmp_path / "in", [(0, NOW, "{{x"), (1, NOW, "{}"), (2, NOW, "")], MESSAGES)
    parsed = parse.parse_prices(read(spark, tmp_path / "in", MESSAGES))
    out = str(tmp_path / "rejects")
    run(start_quarantine(parsed, out, str(tmp_path / "cp"), {"availableNow": True}))
    found = {(r.value, r.reject_reason) for r in spark.read.parquet(out).collect()}
    assert found == {("{{x", "malformed"), ("", "malformed"), ("{}", "missing_field")}


def test_initial_rows_give_documents_too(spark, tmp_path):
    """Also those of products without a later change; a restart doesn't repeat them."""
    table_rows = [change(-1, "P", p, name=f"Table {p}", updated_at=NOW) for p in ("p1", "p2", "p3")]
    initial = spark.createDataFrame(table_rows, S.CHANGE)
    table = IndexTable(spark, str(tmp_path / "index"))

    def go():
        run(start(read(spark, tmp_path / "in", S.CHANGE), table, str(tmp_path / "cp"), Lifetimes(), ARRIVAL, initial))
        return sorted((r.product_id, r.name, r.total_stock) for r in table.documents().collect())

    write(spark, tmp_path / "in", [change(0, "S", "p1", warehouse_id="w", quantity=3, updated_at=NOW)], S.CHANGE)
    assert go() == [("p1", "Table p1", 3), ("p2", "Table p2", None), ("p3", "Table p3", None)]
    write(spark, tmp_path / "in", [change(1, "D", "p2", updated_at=NOW), change(2, "P", "p3", name="New", updated_at=NOW.replace(year=NOW.year + 1))], S.CHANGE)
    assert go() == [("p1", "Table p1", 3), ("p2", "Table p2", None), ("p3", "New", None)]


def test_upsert_rule(spark, tmp_path):
    """Nulls overwrite, maps merge, and a batch applied twice counts once."""

    def document(name, stock, position):
        row = dict.fromkeys(S.DOCUMENT.fieldNames())
        row.update(product_id="p", name=name, stock_by_warehouse=stock, completeness=0.0, indexed_at=NOW)
        return (*row.values(), position)

    schema = S.DOCUMENT.simpleString()[len("struct<") : -1] + ",position:bigint"
    table = IndexTable(spark, str(tmp_path / "index"))
    assert table.documents().count() == 0
    first = spark.createDataFrame([document("a", {"w1": 1}, 0), document("b", {"w1": 2, "w2": 5}, 1)], schema)
    second = spark.createDataFrame([document(None, {"w1": 9}, 0)], schema)
    table.apply(first, 0)
    for _ in range(2):
        table.apply(second, 1)
    row = table.documents().first()
    assert row.name is None
    assert row.stock_by_warehouse == {"w1": 9, "w2": 5}
    third = spark.createDataFrame([document("c", {}, 0)], schema)
    for _ in range(2):
        table.apply(third, 2)
    row = table.documents().first()
    assert (row.name, row.stock_by_warehouse) == ("c", {"w1": 9, "w2": 5})
    typed = index.typed(table.documents())
    assert dict(typed.dtypes)["completeness"] == "float" and dict(typed.dtypes)["price"] == "decimal(18,2)"


def test_table_stays_bounded(spark, tmp_path):
    """Many batches leave one folder per bucket; a batch rewrites the buckets it touches, applied twice it changes nothing."""
    rng = random.Random(4)
    schema = S.DOCUMENT.simpleString()[len("struct<") : -1] + ",position:bigint"
    empty = dict.fromkeys(S.DOCUMENT.fieldNames())
    path = tmp_path / "index"
    table = IndexTable(spark, str(path), buckets=4)
    expected = {}

    def files():
        return {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}

    for batch in range(25):
        rows = []
        for position in range(3):
            product, stock = f"p{rng.randrange(6)}", {f"w{rng.randrange(3)}": batch}
            old = expected.get(product, (None, {}))[1]
            expected[product] = (f"n{batch}-{position}", {**old, **stock})
            rows.append((*{**empty, "product_id": product, "name": f"n{batch}-{position}", "stock_by_warehouse": stock}.values(), position))
        documents = spark.createDataFrame(rows, schema)
        table.apply(documents, batch)
    assert {d.name for d in path.iterdir() if d.is_dir()} <= {f"bucket={b}" for b in range(4)}
    assert len(files()) <= 4
    shown = lambda: {r.product_id: (r.name, r.stock_by_warehouse) for r in table.documents().collect()}
    assert shown() == expected
    table.apply(documents, batch)
    assert shown() == expected
    before, product = files(), next(iter(expected))
    table.apply(spark.createDataFrame([(*{**empty, "product_id": product, "name": "new"}.values(), 0)], schema), 1000)
    gone = {f.parent.name for f in before.keys() - files().keys()}
    assert len(gone) == 1 and all(files().get(f) == t for f, t in before.items() if f.parent.name not in gone)
    assert table.lookup(product).first().name == "new" and table.lookup("none").collect() == []


def test_lookup_reads_one_bucket(spark, tmp_path):
    table = IndexTable(spark, str(tmp_path / "index"), buckets=8)
    rows = change_events(spark, "/root/testdata/sf0.001")
    table.apply(latest_documents(rows).withColumn("position", F.lit(0).cast("bigint")), 0)
    found = table.lookup("product-7")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(bucket.*bucket#\d+ = \d\)", text)
    assert "PushedFilters: [IsNotNull(product_id), EqualTo(product_id,product-7)]" in text and "Aggregate" not in text
    assert "stock_by_warehouse" not in re.search(r"ReadSchema: (.*)", text).group(1)
    assert len(found.inputFiles()) >= 1 and found.count() == 1


def test_settings(tmp_path):
    file = tmp_path / "job.properties"
    file.write_text("# comment\nstate.ttl.hours=12\nkafka.topic.prices = p\n")
    settings = load_settings(str(file), {"STATE_TTL_HOURS": "6", "PG_PORT": "15432"})
    assert settings.number("state.ttl.hours") == 6
    assert settings.ttl_ms == 6 * 3_600_000
    assert settings.text("kafka.topic.prices") == "p"
    assert "15432" in settings.jdbc_options()["url"]
    assert settings.kafka_options("kafka.topic.prices")["startingOffsets"] == "latest"
    assert load_settings(env={}).values == DEFAULTS
    # Every setting is read by something.
    read = set()

    class Watched(dict):
        def __getitem__(self, name):
            read.add(name)
            return super().__getitem__(name)

    watched = Settings(Watched(DEFAULTS))
    for topic in ("kafka.topic.prices", "kafka.topic.stock"):
        watched.kafka_options(topic)
    made = [watched.jdbc_options(), watched.rejects_options(), watched.index_options(), watched.state_options, watched.trigger, watched.ttl_ms]
    assert read == set(DEFAULTS)
    assert made[0]["url"].endswith("?currentSchema=public") and made[2]["es.batch.size.entries"] == "500"
    assert made[3]["spark.sql.streaming.stateStore.maintenanceInterval"] == "60000ms"


def test_wire_prices_have_no_exponent(spark):
    prices = ["0.00", "0.0000001", "19.90", "100", "-0.5", None]
    rows = [(f"p{i}", p) for i, p in enumerate(prices)]
    document = dict.fromkeys(S.DOCUMENT.fieldNames())
    frame = spark.createDataFrame(rows, "product_id string, price string").selectExpr(
        *(
            f"cast({f} as decimal(38,18)) as price" if f == "price" else f if f == "product_id" else f"cast(null as {S.DOCUMENT[f].dataType.simpleString()}) as {f}"
            for f in document
        )
    )
    written = [r.json.split('"price":')[1].split(",")[0] for r in index.document_json(frame).orderBy("product_id").collect()]
    assert written == ["0", "0.0000001", "19.9", "100", "-0.5", "null"]
    action = index.update_actions(frame).orderBy("product_id").first().action
    assert action.startswith('{"doc":{"productId":"p0"') and action.endswith('},"doc_as_upsert":true}')
