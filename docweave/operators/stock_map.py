"""The stock map after each event.

No built-in window aggregate keeps a map, and rebuilding it from a list at each
row costs the square of the history. So the rows, already sorted for the windows
before this step, are streamed through a dictionary per product in Arrow batches.
"""

from __future__ import annotations

import json
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docweave import schemas as S
from docweave.functions.arrow import STOCK_MAP as ARROW_MAP
from docweave.functions.arrow import changes, longs, texts
from docweave.operators.running import _CARRY, BLOCK, Layout, checkpointed

STOCK_MAP = "stock_by_warehouse"
_MAP_TYPE = T.MapType(T.StringType(), T.IntegerType())
_INPUTS = ("_warehouse", "_quantity", "_carried")


def _stream(group: list[str]):
    """Maps sorted batches: the map of the group so far, anew for each segment.

    Only rows that may change the map are visited. A carry row has no warehouse
    but a map as JSON, which the group starts from.
    """

    def fold(batches):
        place, stock, entries = None, {}, ()
        for batch in batches:
            data = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            located = [data[g] for g in (*group, "_segment")]
            visit = data["_warehouse"].is_valid().to_numpy(zero_copy_only=False).copy()
            for column in located:
                visit |= changes(column)
            carried = data.get("_carried")
            if carried is not None:
                visit |= carried.is_valid().to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(visit)
            seen = pa.array(rows)
            places = zip(*(c.take(seen).to_pylist() for c in located))
            warehouses = texts(data["_warehouse"].take(seen))
            quantities = longs(data["_quantity"].take(seen))
            starts = repeat(None) if carried is None else texts(carried.take(seen))
            found = []
            for here, warehouse, quantity, start in zip(places, warehouses, quantities, starts):
                if here != place:
                    place, stock, entries = here, {}, ()
                if start is not None:
                    stock = json.loads(start)
                    entries = tuple(sorted(stock.items()))
                elif warehouse is not None and stock.get(warehouse) != quantity:
                    stock[warehouse] = quantity
                    entries = tuple(sorted(stock.items()))
                found.append(entries)
            repeats = np.repeat(np.arange(len(rows)), np.diff(np.append(rows, batch.num_rows)))
            column = pa.array(found, ARROW_MAP).take(pa.array(repeats))
            kept = [n for n in data if n not in _INPUTS]
            yield pa.RecordBatch.from_arrays(
                [*(data[n] for n in kept), column], [*kept, STOCK_MAP]
            )

    return fold


def _fold(rows: DataFrame, group: list[str]) -> DataFrame:
    kept = [f for f in rows.schema.fields if f.name not in _INPUTS]
    schema = T.StructType([*kept, T.StructField(STOCK_MAP, _MAP_TYPE)])
    return rows.mapInArrow(_stream(group), schema)


def attach_stock_map(rows: DataFrame, layout: Layout, segment: Column | None = None) -> DataFrame:
    """Adds ``stock_by_warehouse`` to rows of a history laid out by ``layout``."""
    is_stock = F.col("kind") == S.STOCK
    rows = rows.withColumns(
        {
            "_segment": (F.lit(0) if segment is None else segment).cast("bigint"),
            "_warehouse": F.when(is_stock, F.col("warehouse_id")),
            "_quantity": F.when(is_stock, F.col("quantity")),
        }
    )
    if layout.blocked:
        rows = checkpointed(rows)
        rows = rows.withColumn(_CARRY, F.lit(False)).unionByName(
            _carries(rows, layout), allowMissingColumns=True
        )
        rows = layout.dealt(rows)
    folded = _fold(rows.sortWithinPartitions(*layout.group, layout.order), layout.group)
    if layout.blocked:
        folded = folded.filter(~F.col(_CARRY)).drop(_CARRY)
    return folded.drop("_segment")


def _carries(rows: DataFrame, layout: Layout) -> DataFrame:
    """For each block one row with the map (and its segment) left by earlier blocks."""
    key, order = layout.key, layout.order
    last = (
        rows.filter(F.col("_warehouse").isNotNull())
        .groupBy(key, BLOCK, "_segment", "_warehouse")
        .agg(F.max(F.struct(order, "_quantity")).alias("last"))
        .select(key, BLOCK, "_segment", "_warehouse", "last.*")
    )
    folded = _fold(last.repartition(key).sortWithinPartitions(key, order), [key])
    ends = folded.groupBy(key, BLOCK).agg(
        F.max_by(F.struct("_segment", STOCK_MAP), order).alias("end")
    )
    before = Window.partitionBy(key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.select(key, BLOCK).distinct()
    return (
        blocks.join(ends, [key, BLOCK], "left")
        .withColumn("end", F.last("end", ignorenulls=True).over(before))
        .filter(F.col("end").isNotNull())
        .select(
            key,
            BLOCK,
            F.col("end._segment").alias("_segment"),
            F.to_json(f"end.{STOCK_MAP}").alias("_carried"),
            (F.col(BLOCK) - 1).alias(order),
            F.lit(True).alias(_CARRY),
        )
    )
