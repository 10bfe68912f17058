"""The pipeline: three message streams to the document table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docweave import schemas as S
from docweave.functions.lifecycle import EMITTED, SUPPRESSED, Lifetimes
from docweave.operators.expiry import lifecycle_documents
from docweave.settings import Settings
from docweave.sources import changes as C
from docweave.sources import parse
from docweave.streaming.index_table import IndexTable
from docweave.streaming.processor import ARRIVAL, PROCESSING, enrich

COUNTERS = "counters"
_TRIGGERS = {PROCESSING: {"processingTime": "1 second"}, ARRIVAL: {"availableNow": True}}


def parsed_changes(
    catalogue: DataFrame, prices: DataFrame, stock: DataFrame, plain_products: bool = False
) -> DataFrame:
    """Messages (``seq``, ``arrival_ts``, ``value``) to accepted change rows in one order of arrival.

    Of streams, the processor brings each product's rows of a micro-batch into that order.
    """
    parse_product = parse.parse_products if plain_products else parse.parse_catalogue
    merge = C.merge_changes if catalogue.isStreaming else C.merge_by_arrival
    return merge(
        parse.accepted(parse_product(catalogue)),
        parse.accepted(parse.parse_prices(prices)),
        parse.accepted(parse.parse_stock(stock)),
    )


def start_quarantine(parsed: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Keeps rejected messages of one parsed stream, in a folder per reason."""
    return (
        parse.rejected(parsed)
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("reject_reason")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def kafka_changes(spark: SparkSession, settings: Settings, catalogue: DataFrame) -> DataFrame:
    """Production sources: the given envelope stream and the two topics, from the latest."""
    return parsed_changes(
        catalogue,
        C.kafka_stream(spark, settings, "kafka.topic.prices"),
        C.kafka_stream(spark, settings, "kafka.topic.stock"),
    )


def with_counters(events: DataFrame) -> DataFrame:
    """Stage counters as observed metrics of each micro-batch."""
    made = F.col("outcome").isin(EMITTED, SUPPRESSED)
    return events.observe(
        COUNTERS,
        F.count_if(made & (F.col("kind") == "P")).alias("events_processed_products"),
        F.count_if(made & (F.col("kind") == "R")).alias("events_processed_prices"),
        F.count_if(made & (F.col("kind") == "S")).alias("events_processed_stock"),
        F.count_if("other_side").alias("join_hits"),
        F.count_if(~F.col("other_side")).alias("join_misses"),
        F.count_if(F.col("outcome") == SUPPRESSED).alias("dedup_filtered"),
    )


def _as_stream(rows: DataFrame, folder: str) -> DataFrame:
    """Rows kept in a folder of the query, so that a restart goes on with the same."""
    spark = rows.sparkSession
    try:
        spark.read.schema(S.CHANGE).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows.select(*S.CHANGE.fieldNames()).write.parquet(folder)
    return spark.readStream.schema(S.CHANGE).parquet(folder)


def start(
    changes: DataFrame,
    table: IndexTable,
    checkpoint: str,
    lifetimes: Lifetimes,
    clock: str = PROCESSING,
    initial: DataFrame | None = None,
    trigger: dict | None = None,
    by_arrival: bool = False,
) -> StreamingQuery:
    """Starts the query; ``checkpoint`` is a folder all executors share.

    ``by_arrival``: the changes come from inputs whose ``seq`` are unrelated, as those of ``parsed_changes`` do.

    A replay stops after the input at hand. With the processing clock the query
    runs on, since timers fall due without input. ``initial`` are the rows of the catalogue
    table: they come first and give documents like any other change.
    """
    if initial is not None:
        changes = changes.unionByName(_as_stream(initial, f"{checkpoint.rstrip('/')}-initial"))
    events = with_counters(enrich(changes, lifetimes, clock, by_arrival))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # held, so the stateful plan runs once although the rows are read twice
        documents = lifecycle_documents(batch).persist()
        try:
            if documents.count():  # timers also make batches without input
                table.apply(documents, batch_id)
        finally:
            documents.unpersist()

    return (
        events.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(upsert)
        .trigger(**(trigger or _TRIGGERS[clock]))
        .start()
    )


def start_with_settings(
    changes: DataFrame, table: IndexTable, checkpoint: str, settings: Settings
) -> StreamingQuery:
    """Starts the query with the settings' lifetimes, trigger and state options, which the session keeps."""
    for name, value in settings.state_options.items():
        changes.sparkSession.conf.set(name, value)
    hours = settings.number("state.ttl.hours")
    lifetimes = Lifetimes.hours(hours, hours, hours)
    return start(changes, table, checkpoint, lifetimes, trigger=settings.trigger, by_arrival=True)


def start_rejects_topic(parsed: DataFrame, checkpoint: str, settings: Settings) -> StreamingQuery:
    """Sends rejected messages to their topic, the reason as a header; needs the Kafka package."""
    reason = F.struct(F.lit("reject_reason").alias("key"), F.col("reject_reason").cast("binary").alias("value"))
    return (
        parse.rejected(parsed).select("value", F.array(reason).alias("headers"))
        .writeStream.format("kafka").options(**settings.rejects_options())
        .option("checkpointLocation", checkpoint).trigger(**settings.trigger).start()
    )
