"""The three event streams as one stream of tagged change rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave import schemas as S
from docweave.operators.running import ROWS_PER_TASK, by_history_length, checkpointed, running, tasks_for
from docweave.settings import Settings


def _conform(df: DataFrame, *more: str) -> DataFrame:
    """All columns of a change row in order, those the stream lacks null, and ``more`` columns."""
    have = set(df.columns)
    return df.select(
        *more,
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in S.CHANGE.fields
        )
    )


def product_changes(events: DataFrame, *more: str) -> DataFrame:
    kind = F.when(F.col("operation") == "d", F.lit(S.DELETE)).otherwise(F.lit(S.UPSERT))
    return _conform(events.withColumn("kind", kind), *more)


def price_changes(events: DataFrame, *more: str) -> DataFrame:
    return _conform(events.withColumn("kind", F.lit(S.PRICE)), *more)


def stock_changes(events: DataFrame, *more: str) -> DataFrame:
    return _conform(events.withColumn("kind", F.lit(S.STOCK)), *more)


def merge_changes(products: DataFrame, prices: DataFrame, stock: DataFrame) -> DataFrame:
    """All three inputs in one order: each keeps its own, and at the same place they follow in this order.

    ``seq`` need only be unique per product within an input; it is unique over all of them afterwards.
    """
    inputs = (product_changes(products), price_changes(prices), stock_changes(stock))
    placed = [rows.withColumn("seq", F.col("seq") * len(inputs) + i) for i, rows in enumerate(inputs)]
    return placed[0].unionByName(placed[1]).unionByName(placed[2])


def merge_by_arrival(
    products: DataFrame, prices: DataFrame, stock: DataFrame, max_rows: int = ROWS_PER_TASK
) -> DataFrame:
    """All three inputs in one order of arrival, though their offsets have nothing to do with each other.

    Each input, and each ``partition`` of it if there is such a column, keeps its own order: a row whose ``arrival_ts`` lies
    before that of one ahead of it takes the latest so far. Then earlier arrivals come first, and of equal ones
    products before prices before stock. ``seq`` becomes the place in that order, ``arrival_ts`` the time it is by. The rows
    are stored, sorted over all tasks; an input of more than ``max_rows`` rows is worked on in blocks.
    """
    parts = []
    for i, (rows, tagged) in enumerate(((products, product_changes), (prices, price_changes), (stock, stock_changes))):
        part = F.col("partition").cast("string") if "partition" in rows.columns else F.lit("")
        changes = tagged(rows.withColumn("_part", part), "_part")
        parts.append(changes.withColumns({"_input": F.lit(i), "_source": F.concat(F.lit(f"{i}-"), "_part")}).drop("_part"))
    rows = checkpointed(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    number = rows.count()
    rows = by_history_length(
        rows,
        lambda r, layout: running(layout.arrange(r), layout, maxes={"arrival_ts": F.col("arrival_ts")}),
        key="_source", max_rows=max_rows,
    )
    order = ["arrival_ts", "_input", "_source", "seq"]
    dealt = [tasks_for(rows.sparkSession, number)] if number > max_rows else []
    placed = rows.repartitionByRange(*dealt, *order).sortWithinPartitions(*order).withColumn("seq", F.monotonically_increasing_id())
    return checkpointed(placed.select(*S.CHANGE.fieldNames()))


def table_snapshot(rows: DataFrame, seq: int = -1) -> DataFrame:
    """Rows of the catalogue table as upserts that precede all changes."""
    return _conform(
        rows.withColumns(
            {
                "seq": F.lit(seq),
                "kind": F.lit(S.UPSERT),
                "name": F.coalesce(F.col("name"), F.lit("")),
            }
        )
    )


def text_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Message files as a stream of ``value``; always starts at the earliest file."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def kafka_stream(
    spark: SparkSession,
    settings: Settings,
    topic_setting: str,
    starting: str = "latest",
    max_offsets_per_trigger: int = 5_000_000,
) -> DataFrame:
    """A topic as ``value``, ``partition``, ``seq`` and ``arrival_ts``; needs the Kafka package.

    Messages are keyed by product, so one product's rows share a partition and
    their offsets give its arrival order within the topic. The limit per batch
    bounds what a batch may hold for any one product.
    """
    reader = (
        spark.readStream.format("kafka")
        .options(**settings.kafka_options(topic_setting, starting))
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    )
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("partition"),
        F.col("offset").alias("seq"),
        F.col("timestamp").alias("arrival_ts"),
    )


def catalogue_table(spark: SparkSession, settings: Settings, connections: int = 32) -> DataFrame:
    """The catalogue table over JDBC, in parts by key; needs the database driver."""
    options = settings.jdbc_options()
    url, table = options.pop("url"), options.pop("dbtable")
    parts = [
        f"abs(mod(hashtext(product_id)::bigint, {connections})) = {i}" for i in range(connections)
    ]
    return spark.read.jdbc(url, table, predicates=parts, properties=options)
