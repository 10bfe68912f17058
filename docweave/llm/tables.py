"""Steps that several operators share: row identity, tables in the shared folder, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators.running import checkpointed, set_checkpoint_folder


#: Stands for a null id inside the operators; it sorts after all ids.
NO_ID = 2**63 - 1


def identity() -> list[Column]:
    """``id`` and ``twin``, never null, which tell documents apart.

    ``twin`` is a 64-bit hash of the text: rows of one ``doc_id`` with other texts are other
    documents, rows alike in both are one document that occurs more than once.
    """
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("twin")]


def doc_id(name: str = "id") -> Column:
    """The id with null for ``NO_ID``, under the name ``doc_id``."""
    return F.when(F.col(name) != NO_ID, F.col(name)).alias("doc_id")


#: Bytes of rows that travel between Spark and Python at once, about.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Lowers the session's Arrow batches to BATCH_BYTES: rows of long texts else make very large ones."""
    now = spark.conf.get(_BATCH)
    if not now.rstrip("bB").isdigit() or int(now.rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which all executors see."""
    set_checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: done once, and safe from lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Keys that hold more than one row in so many are broadcast: there are at most so many of them.
HOT_SHARE = 1000


def join_by_size(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """The rows with the columns of their group; ``groups`` has one row per key and the number of rows in ``size``.

    Both should be stored tables. Groups of more than a thousandth of all rows, at most a thousand, are
    broadcast, so no task gets all rows of a large one; the others are joined by shuffles. Keys are not null.
    """
    total = groups.agg(F.sum(F.col(size).cast("double"))).first()[0] or 0.0
    large = F.col(size) > total / HOT_SHARE
    hot = F.broadcast(groups.filter(large))
    cold = rows.join(F.broadcast(groups.filter(large).select(*keys)), keys, "left_anti").join(groups.filter(~large), keys)
    return rows.join(hot, keys).unionByName(cold)


def components(links: DataFrame) -> DataFrame:
    """Connected components of links ``a``, ``b`` between long ids: ``node``, ``root`` (the smallest id).

    Alternates large-star and small-star steps (Kiveris and others, 2014). Each node's
    smallest neighbour is an aggregate with partial results, joined back, so that no
    node's neighbours meet in one group; the number of rounds grows with the logarithm
    of the longest chain. Only a count and a checksum reach the driver.
    """
    edges = checkpointed(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter(F.col("u") != F.col("v")).distinct()
    )
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        # A link (u, v), u > v, is seen from v: u is hung on v's smallest neighbour.
        large = (
            edges.join(smallest.withColumnRenamed("u", "v"), "v")
            .select("u", F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = checkpointed(
            small.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.withColumnRenamed("m", "v")).distinct()
        )
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
