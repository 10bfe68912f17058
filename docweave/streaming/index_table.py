"""The document table a stream upserts into.

Documents lie in a fixed number of buckets by a hash of the product, one folder each. A micro-batch is
folded with what the buckets it touches hold, and Spark's dynamic partition overwrite replaces those
folders and no others, so the table never has more folders than buckets and a read folds nothing.
The versions of the stored rows make a batch that is run again change nothing.

A bucket is rewritten by one task: take so many that one is a few hundred MB at most, and a trigger
interval that lets a batch gather many changes. While a batch commits, a reader may miss a bucket that
is being replaced; where a table format with MERGE is at hand, use that.
"""

from __future__ import annotations

import zlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave import schemas as S
from docweave.operators import index

#: Buckets of a table; a table keeps the number it was begun with.
BUCKETS = 64
BUCKET = "bucket"
_ORDER = ["batch_id", "position"]
_STORED = T.StructType(
    [
        *S.DOCUMENT.fields,
        T.StructField("batch_id", T.LongType()),
        T.StructField("position", T.LongType()),
        T.StructField(BUCKET, T.IntegerType()),
    ]
)
_WRITER = {
    "partitionOverwriteMode": "dynamic",
    # A lookup skips the row groups of its bucket that do not hold the product.
    "parquet.bloom.filter.enabled#product_id": "true",
}


def bucket_of(product_id: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(product_id.cast("binary")), F.lit(buckets)).cast("int")


class IndexTable:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self._spark = spark
        self._path = path
        self._buckets = buckets

    def apply(self, documents: DataFrame, batch_id: int) -> None:
        """Upserts the documents of one batch; ``position`` orders those of a product."""
        batch = index.fold_upserts(documents, ["position"]).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        batch = batch.withColumn(BUCKET, bucket_of(F.col("product_id"), self._buckets))
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # numbers below the buckets
        if not touched:
            return
        before = self._stored().filter(F.col(BUCKET).isin(touched))
        merged = index.fold_upserts(before.unionByName(batch.select(*before.columns)), _ORDER)
        merged = merged.withColumn(BUCKET, bucket_of(F.col("product_id"), self._buckets))
        dealt = merged.repartition(len(touched), BUCKET).sortWithinPartitions(BUCKET, "product_id")
        dealt.write.mode("overwrite").options(**_WRITER).partitionBy(BUCKET).parquet(self._path)

    def documents(self) -> DataFrame:
        """The table's current documents."""
        return self._stored().select(*S.DOCUMENT.fieldNames())

    def lookup(self, product_id: str) -> DataFrame:
        """The document of one product, or no row; reads the one bucket it can be in."""
        bucket = zlib.crc32(product_id.encode()) % self._buckets
        return index.lookup(self._stored().filter(F.col(BUCKET) == bucket), product_id)

    def _stored(self) -> DataFrame:
        try:
            return self._spark.read.schema(_STORED).parquet(self._path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._spark.createDataFrame([], _STORED)
