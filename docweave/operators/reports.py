"""Counters, rates, join completeness and latencies.

Input is the counted events, a document history (one row per event) or documents;
all are plain aggregates with partial aggregation before the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave import schemas as S
from docweave.functions.columns import elapsed_ms

# Dashboard bands and latency limits.
BANDS = ((0.95, "green"), (0.9, "yellow"))
LOWEST_BAND = "red"
OLDEST_LIMIT_MS = 30_000
NEWEST_LIMIT_MS = 10_000

_STREAMS = {S.UPSERT: "products", S.PRICE: "prices", S.STOCK: "stock"}


def stream_name() -> Column:
    name = F.when(F.col("kind") == S.UPSERT, _STREAMS[S.UPSERT])
    for kind in (S.PRICE, S.STOCK):
        name = name.when(F.col("kind") == kind, _STREAMS[kind])
    return name


def event_counts(counted: DataFrame) -> DataFrame:
    return counted.groupBy(stream_name().alias("stream")).agg(F.count(F.lit(1)).alias("events"))


def rates(events: DataFrame, by_stream: bool = False, slide: str | None = None) -> DataFrame:
    """Events per second in one-minute windows of the arrival clock.

    Sliding windows are sums of buckets as long as the slide, which divides a minute: so
    events are counted once, and only buckets are spread over the windows.
    """
    by = ["stream"] if by_stream else []
    bucket = F.window("arrival_ts", slide or "1 minute")
    counts = (
        events.withColumn("stream", stream_name())
        .groupBy(bucket.alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("minute"), *by, "events")
    )
    if slide:
        counts = (
            counts.groupBy(F.window("minute", "1 minute", slide).alias("w"), *by)
            .agg(F.sum("events").alias("events"))
            .select(F.col("w.start").alias("minute"), *by, "events")
        )
    return counts.withColumn("per_second", F.round(F.col("events") / F.lit(60.0), 6))


def join_completeness(counted: DataFrame) -> DataFrame:
    """Share of accepted product and price events that met the other side."""
    totals = counted.agg(
        F.count_if("other_side").alias("hits"), F.count_if(~F.col("other_side")).alias("misses")
    )
    ratio = F.col("hits") / F.nullif(F.col("hits") + F.col("misses"), F.lit(0))
    band = F.when(ratio >= BANDS[0][0], BANDS[0][1])
    for floor, name in BANDS[1:]:
        band = band.when(ratio >= floor, name)
    return totals.select(
        "hits", "misses", F.round(ratio, 6).alias("ratio"), band.otherwise(LOWEST_BAND).alias("band")
    )


def dedup_stats(history: DataFrame) -> DataFrame:
    return (
        history.filter("accepted")
        .groupBy(stream_name().alias("stream"))
        .agg(
            F.count_if("unchanged").alias("suppressed"),
            F.count_if(~F.col("unchanged")).alias("emitted"),
        )
    )


def completeness_distribution(documents: DataFrame) -> DataFrame:
    return documents.groupBy(F.round("completeness", 6).alias("completeness")).agg(
        F.count(F.lit(1)).alias("documents")
    )


def content_hash() -> Column:
    """Hash of all document fields but the index time, as text with nulls written."""
    return F.xxhash64(
        F.to_json(F.struct(*S.CONTENT_FIELDS), {"ignoreNullFields": "false"})
    )


def gauge_latency() -> Column:
    """Milliseconds since the latest price or stock event; product times do not count."""
    latest = F.greatest("last_price_update", "last_stock_update")
    return F.greatest(F.lit(0).cast("bigint"), elapsed_ms(F.col("indexed_at"), latest))


def gauge_samples(documents: DataFrame) -> DataFrame:
    has_time = F.coalesce("last_price_update", "last_stock_update").isNotNull()
    return documents.filter(has_time).withColumn("latency_ms", gauge_latency())


def latency_gauge(documents: DataFrame) -> DataFrame:
    """The value each product's gauge was last set to."""
    return (
        gauge_samples(documents)
        .groupBy("product_id")
        .agg(F.max_by("latency_ms", "seq").alias("latency_ms"))
    )


def latency_stats(documents: DataFrame) -> DataFrame:
    """Average and largest gauge value per minute."""
    return (
        gauge_samples(documents)
        .groupBy(F.window("indexed_at", "1 minute").alias("w"))
        .agg(
            F.round(F.avg("latency_ms"), 3).alias("avg_latency_ms"),
            F.max("latency_ms").alias("max_latency_ms"),
        )
        .select(F.col("w.start").alias("minute"), "avg_latency_ms", "max_latency_ms")
    )


_UPDATES = ("last_product_update", "last_price_update", "last_stock_update")


def latency_oldest(index: DataFrame) -> DataFrame:
    """Index time minus the oldest update in the document; null without any."""
    latency = elapsed_ms(F.col("indexed_at"), F.least(*_UPDATES))
    return index.select(
        "product_id",
        latency.alias("latency_ms"),
        (latency <= OLDEST_LIMIT_MS).alias("within_limit"),
    )


def latency_newest(index: DataFrame) -> DataFrame:
    """Index time minus the newest update in the document."""
    latency = elapsed_ms(F.col("indexed_at"), F.greatest(*_UPDATES))
    return index.select(
        "product_id",
        latency.alias("latency_ms"),
        (latency < NEWEST_LIMIT_MS).alias("within_limit"),
    )
