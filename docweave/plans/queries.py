"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions.columns import completeness, is_future, stock_text
from docweave.functions.lifecycle import EMITTED, SUPPRESSED, Lifetimes
from docweave.operators import index, reports, snapshot
from docweave.operators.enrich import (
    counted_events,
    document_history,
    documents,
    emitted,
    judged_history,
    pair_history,
    stock_history,
    without_payload,
)
from docweave.operators.expiry import lifecycle, lifecycle_documents
from docweave.operators.running import Layout, by_history_length, checkpointed, new_folder
from docweave.operators.stock_map import attach_stock_map
from docweave.plans import message_fixture as messages
from docweave.plans.event_fixture import change_events
from docweave.sources import changes as C
from docweave.sources import parse
from docweave.streaming.index_table import IndexTable
from docweave.streaming.job import parsed_changes
from docweave import schemas as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAIR = ["name", "price", "currency", "last_product_update", "last_price_update"]
DOC = [*PAIR, "total_stock", "last_stock_update", "completeness"]
DAY = Lifetimes.hours(24, 24, 24)


def query(make: Query) -> Query:
    """Registers ``make`` under its name."""

    @wraps(make)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _comparable(make(spark, sf_dir))

    QUERIES[make.__name__] = run
    return run


def _comparable(df: DataFrame) -> DataFrame:
    """Zone-less times, prices as doubles, rounded thirds, and the stock map as text."""
    shown: list[Column] = []
    for f in df.schema.fields:
        column = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif f.name == "price":
            column = column.cast("decimal(18,2)").cast("double")
        elif f.name == "completeness":
            column = F.round(column.cast("double"), 6)
        elif isinstance(f.dataType, T.MapType):
            column = stock_text(column)
        shown.append(column.alias("stock" if isinstance(f.dataType, T.MapType) else f.name))
    return df.select(*shown)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_history_length(change_events(spark, sf_dir), document_history)


def _light_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_history_length(without_payload(change_events(spark, sf_dir)), document_history)


def _history_with_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_history_length(change_events(spark, sf_dir), _mapped_history)


def _mapped_history(changes: DataFrame, layout: Layout) -> DataFrame:
    return attach_stock_map(document_history(changes, layout), layout)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_history_length(change_events(spark, sf_dir), pair_history)


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_history_length(change_events(spark, sf_dir), judged_history)


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted_events(change_events(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str, product_id: str | None = None, with_map: bool = False) -> DataFrame:
    """The last document sent of each product; the stock map comes from the stock events alone, as no state expires."""
    changes = change_events(spark, sf_dir)
    if product_id is not None:
        changes = changes.filter(F.col("product_id") == product_id)
    return _last_of(changes, with_map)


def _last_of(changes: DataFrame, with_map: bool) -> DataFrame:
    sent = emitted(by_history_length(changes, document_history))
    return index.last_documents(sent, snapshot.stock_totals(changes) if with_map else None)


def _stored_index(spark: SparkSession, sf_dir: str, batches: int) -> IndexTable:
    """The documents sent, upserted into a table in so many batches of the arrival order."""
    table = IndexTable(spark, new_folder(spark), buckets=8)
    sent = checkpointed(emitted(_history_with_map(spark, sf_dir)).withColumn("position", F.col("seq")))
    last = sent.agg(F.max("seq")).first()[0]
    for n in range(batches if last is not None else 0):
        table.apply(sent.filter((F.col("seq") * batches >= n * (last + 1)) & (F.col("seq") * batches < (n + 1) * (last + 1))), n)
    return table


# ------------------------------------------------------------------- sources


@query
def cdc_parse(spark, sf_dir):
    parsed = parse.accepted(parse.parse_catalogue(messages.catalogue_messages(spark, sf_dir)))
    return parsed.select(
        "seq", "product_id", "name", "category", "brand", "description", "updated_at", "operation"
    )


@query
def price_parse(spark, sf_dir):
    parsed = parse.accepted(parse.parse_prices(messages.price_messages(spark, sf_dir)))
    return parsed.select("seq", "product_id", "price", "currency", "updated_at")


@query
def stock_parse(spark, sf_dir):
    parsed = parse.accepted(parse.parse_stock(messages.stock_messages(spark, sf_dir)))
    return parsed.select("seq", "product_id", "warehouse_id", "quantity", "updated_at")


@query
def product_json_parse(spark, sf_dir):
    parsed = parse.accepted(parse.parse_products(messages.product_messages(spark, sf_dir)))
    return parsed.select("seq", "product_id", "name", "brand", "updated_at", "operation")


@query
def parse_rejects(spark, sf_dir):
    parsed = {
        "products": parse.parse_catalogue(messages.catalogue_messages(spark, sf_dir)),
        "prices": parse.parse_prices(messages.price_messages(spark, sf_dir)),
        "stock": parse.parse_stock(messages.stock_messages(spark, sf_dir)),
    }
    rejects = None
    for stream, rows in parsed.items():
        tagged = rows.select("seq", "value", "reject_reason", F.lit(stream).alias("stream"))
        rejects = tagged if rejects is None else rejects.unionByName(tagged)
    return (
        rejects.filter(F.col("reject_reason").isNotNull())
        .groupBy("stream", "reject_reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def future_guard(spark, sf_dir):
    """Event times around the limit: 60 s ahead of the clock passes, 1 ms more does not."""
    events = change_events(spark, sf_dir).withColumn("ahead_ms", 59_998 + F.col("seq") % 5)
    ahead = F.col("arrival_ts") + F.make_dt_interval(secs=F.col("ahead_ms") / F.lit(1000))
    return events.select(
        "seq", "product_id", "ahead_ms", is_future(ahead, F.col("arrival_ts")).alias("rejected")
    )


@query
def snapshot_bootstrap(spark, sf_dir):
    """Rows of the table precede its changes."""
    table = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.concat(F.lit("product-"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.to_timestamp(F.lit("2000-01-01 00:00:00")).alias("updated_at"),
        F.to_timestamp(F.lit("2000-01-01 00:00:00")).alias("arrival_ts"),
    )
    changes = C.table_snapshot(table).unionByName(change_events(spark, sf_dir))
    return snapshot.latest_documents(changes).select(
        "product_id", *PAIR, "category", "brand", "total_stock", "completeness", "indexed_at"
    )


# --------------------------------------------------------------------- joins


@query
def stale_filter(spark, sf_dir):
    rows = _judged(spark, sf_dir).filter(F.col("kind") != S.DELETE)
    return rows.select("seq", "product_id", "kind", "updated_at", "accepted")


@query
def delete_epochs(spark, sf_dir):
    return _judged(spark, sf_dir).select("seq", "product_id", "kind", "epoch", "accepted")


@query
def product_price_changelog(spark, sf_dir):
    made = _pairs(spark, sf_dir).filter("accepted")
    part = completeness(F.col("name"), F.col("price"), F.lit(None))
    return made.select(
        "seq", "product_id", *PAIR, part.alias("completeness"), F.col("other_side").alias("hit")
    )


@query
def product_price_latest(spark, sf_dir):
    return snapshot.product_price_state(change_events(spark, sf_dir)).select("product_id", *PAIR)


@query
def enriched_changelog(spark, sf_dir):
    made = documents(_history_with_map(spark, sf_dir))
    return made.select("seq", "product_id", *DOC, "stock_by_warehouse", "indexed_at")


@query
def enriched_latest(spark, sf_dir):
    made = snapshot.latest_documents(change_events(spark, sf_dir))
    return made.select("product_id", *DOC, "stock_by_warehouse", "indexed_at")


@query
def join_completeness(spark, sf_dir):
    return reports.join_completeness(_counted(spark, sf_dir))


# --------------------------------------------------------------------- stock


@query
def stock_latest(spark, sf_dir):
    rows = snapshot.latest_stock(change_events(spark, sf_dir))
    return rows.select("product_id", "warehouse_id", "quantity")


@query
def stock_map(spark, sf_dir):
    return snapshot.stock_totals(change_events(spark, sf_dir)).select(
        "product_id", "stock_by_warehouse"
    )


@query
def stock_totals(spark, sf_dir):
    return snapshot.stock_totals(change_events(spark, sf_dir)).select(
        "product_id", "total_stock", "last_stock_update"
    )


@query
def stock_running(spark, sf_dir):
    rows = by_history_length(change_events(spark, sf_dir), stock_history)
    return rows.select(
        "seq", "product_id", "warehouse_id", "quantity", "replaced", "total_stock", "last_stock_update"
    )


# ---------------------------------------------------------- change detection


@query
def dedup_changelog(spark, sf_dir):
    made = emitted(_history(spark, sf_dir))
    return made.select("seq", "product_id", *DOC, "indexed_at")


@query
def dedup_stats(spark, sf_dir):
    return reports.dedup_stats(_light_history(spark, sf_dir))


@query
def doc_hash_groups(spark, sf_dir):
    """How many contents of a product were sent how often."""
    sent = emitted(_history_with_map(spark, sf_dir))
    groups = sent.groupBy("product_id", reports.content_hash().alias("h")).agg(
        F.count(F.lit(1)).alias("times_sent")
    )
    return groups.groupBy("times_sent").agg(F.count(F.lit(1)).alias("contents"))


# ------------------------------------------------------------ expiring state


@query
def ttl_stage1(spark, sf_dir):
    """The first join alone forgets idle products."""
    rows = lifecycle(change_events(spark, sf_dir), Lifetimes.hours(pair=24))
    joined = rows.filter(F.col("other_side").isNotNull())
    return joined.select("seq", "product_id", *PAIR, F.col("other_side").alias("hit"))


@query
def ttl_stage2(spark, sf_dir):
    """The second join alone forgets idle products."""
    rows = lifecycle(change_events(spark, sf_dir), Lifetimes.hours(stock=24))
    return rows.filter(F.col("outcome").isin(EMITTED, SUPPRESSED)).select(
        "seq", "product_id", *PAIR, "total_stock", "last_stock_update", "stock_by_warehouse"
    )


@query
def ttl_dedup(spark, sf_dir):
    """Suppression alone forgets what it let through."""
    rows = lifecycle(change_events(spark, sf_dir), Lifetimes.hours(sent=24))
    return rows.filter(F.col("outcome").isin(EMITTED, SUPPRESSED)).select(
        "seq", "product_id", "kind", "outcome"
    )


@query
def ttl_full_pipeline(spark, sf_dir):
    made = lifecycle_documents(lifecycle(change_events(spark, sf_dir), DAY))
    return made.select("seq", "product_id", *DOC, "stock_by_warehouse", "indexed_at")


@query
def ttl_outcomes(spark, sf_dir):
    rows = lifecycle(change_events(spark, sf_dir), DAY)
    return rows.groupBy("kind", "outcome").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("other_side").alias("hits")
    )


# --------------------------------------------------------------------- index


@query
def index_upsert(spark, sf_dir):
    return _index(spark, sf_dir, with_map=True).select("product_id", *DOC, "stock_by_warehouse", "indexed_at")


@query
def index_table(spark, sf_dir):
    """The stored table after three batches of upserts, each folded into the buckets it touches."""
    rows = _stored_index(spark, sf_dir, 3).documents()
    return rows.select("product_id", *DOC, "stock_by_warehouse", "indexed_at")


@query
def index_table_lookup(spark, sf_dir):
    """A document by its key, from the one bucket that can hold it."""
    return _stored_index(spark, sf_dir, 1).lookup("product-7")


@query
def index_requests(spark, sf_dir):
    """Bulk requests of at most 20 updates."""
    made = index.bulk_requests(_index(spark, sf_dir, with_map=True), "products", 20, buckets=4)
    lines = F.size(F.split("body", "\n")) - 1
    return made.select("bucket", "request", "updates", "first_id", "last_id", lines.alias("lines"))


@query
def pipeline_from_messages(spark, sf_dir):
    """From message text to the index: parsing, one order over three inputs, joins, suppression, upserts."""
    # Offsets of topics are unrelated: only the times of arrival tell what came first. Each message is parsed once.
    changes = parsed_changes(
        messages.catalogue_messages(spark, sf_dir).withColumn("seq", F.col("seq") + 7_000_000),
        messages.price_messages(spark, sf_dir),
        messages.stock_messages(spark, sf_dir).withColumn("seq", F.col("seq") * 2 - 50_000),
    )
    documents = _last_of(changes, with_map=True)
    return documents.select("product_id", "category", "brand", *DOC, "stock_by_warehouse", "indexed_at")


@query
def index_upsert_ttl(spark, sf_dir):
    """After an expiry the index still holds warehouses the total no longer counts."""
    made = lifecycle_documents(lifecycle(change_events(spark, sf_dir), DAY))
    folded = index.fold_upserts(made, ["seq"])
    return folded.select("product_id", *DOC, "stock_by_warehouse", "indexed_at")


@query
def index_typed(spark, sf_dir):
    return index.typed(_index(spark, sf_dir)).select(
        "product_id", "name", "price", "currency", "total_stock", "completeness", "indexed_at"
    )


@query
def doc_json(spark, sf_dir):
    return index.document_json(_index(spark, sf_dir, with_map=True))


@query
def doc_lookup(spark, sf_dir):
    return index.lookup(_index(spark, sf_dir, "product-7"), "product-7")


@query
def doc_count(spark, sf_dir):
    return index.product_count(change_events(spark, sf_dir))


@query
def docs_complete(spark, sf_dir):
    return index.at_least_complete(_index(spark, sf_dir), 1.0)


@query
def doc_sample(spark, sf_dir):
    return index.sample(_index(spark, sf_dir), 5)


# ------------------------------------------------------------------- reports


@query
def event_counts(spark, sf_dir):
    return reports.event_counts(_counted(spark, sf_dir))


@query
def events_rate(spark, sf_dir):
    return reports.rates(_counted(spark, sf_dir), by_stream=True)


@query
def events_rate_total(spark, sf_dir):
    return reports.rates(_counted(spark, sf_dir))


@query
def events_rate_sliding(spark, sf_dir):
    return reports.rates(_counted(spark, sf_dir), by_stream=True, slide="10 seconds")


@query
def dedup_rate(spark, sf_dir):
    return reports.rates(_light_history(spark, sf_dir).filter("unchanged"))


@query
def completeness_dist(spark, sf_dir):
    return reports.completeness_distribution(emitted(_light_history(spark, sf_dir)))


@query
def latency_gauge(spark, sf_dir):
    return reports.latency_gauge(emitted(_light_history(spark, sf_dir)))


@query
def latency_stats(spark, sf_dir):
    return reports.latency_stats(emitted(_light_history(spark, sf_dir)))


@query
def latency_oldest(spark, sf_dir):
    return reports.latency_oldest(_index(spark, sf_dir))


@query
def latency_newest(spark, sf_dir):
    return reports.latency_newest(_index(spark, sf_dir))
