"""Running sums and maxima along each key's history.

A window over one key puts that key's rows into one task. That is what we want
for ordinary keys, but one key may hold a large share of all rows. So histories
are split by size: keys above a row limit are cut into blocks of the arrival
order, each block is reduced to its sums and maxima, the blocks before it give
it one carry row, and the same window then runs per block. ``seq`` is unique
within a key, so a block never holds more rows than its width.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of one key that one task may hold.
MAX_ROWS_PER_KEY = 4_000_000
#: Rows of a large table that a task gets, about.
ROWS_PER_TASK = 500_000
BLOCK = "_block"
_CARRY = "_carry"


@dataclass(frozen=True)
class Layout:
    """How the histories of a DataFrame are laid out over tasks, ``parts`` of them if that is given."""

    key: str = "product_id"
    order: str = "seq"
    width: int | None = None
    parts: int | None = None

    @property
    def blocked(self) -> bool:
        return self.width is not None

    @property
    def group(self) -> list[str]:
        return [self.key, BLOCK] if self.blocked else [self.key]

    def arrange(self, df: DataFrame) -> DataFrame:
        """One exchange for all windows of whole histories; block numbers for long ones."""
        if not self.blocked:
            return self.dealt(df)
        start = F.col(self.order) - F.pmod(F.col(self.order), F.lit(self.width))
        return df.withColumn(BLOCK, start.cast("bigint"))

    def dealt(self, df: DataFrame) -> DataFrame:
        """One exchange by history or block."""
        return df.repartition(*([self.parts] if self.parts else []), *self.group)


def long_keys(df: DataFrame, key: str = "product_id", max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame | None:
    """Keys with more rows than one task should hold; None if there are none.

    The limit is fixed, so the list grows with the table, at most to one key per
    ``max_rows`` rows; it stays a table. A table no larger than the limit needs no
    count by key, and its row count reads no column.
    """
    return None if df.count() <= max_rows else _longer_than(df, key, max_rows)


def _longer_than(df: DataFrame, key: str, max_rows: int) -> DataFrame | None:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    keys = checkpointed(counts.filter(F.col("n") > max_rows).select(key))
    return None if keys.isEmpty() else keys


def tasks_for(spark: SparkSession, rows: int) -> int:
    """The number of tasks for so many rows, so that none gets more as the table grows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def by_history_length(
    df: DataFrame,
    compute: Callable[[DataFrame, Layout], DataFrame],
    key: str = "product_id",
    max_rows: int = MAX_ROWS_PER_KEY,
    compute_long: Callable[[DataFrame, Layout], DataFrame] | None = None,
) -> DataFrame:
    """``compute`` on whole histories, and on blocks of those that are too long.

    Give it all rows and let ``compute`` filter: an unfiltered count of a columnar
    table reads no data. More than ``max_rows`` rows are dealt to tasks by their number. The
    long keys go to every task, at most one in ``max_rows`` rows: dealt by key, all rows of one would meet.
    """
    rows = df.count()
    if rows <= max_rows:
        return compute(df, Layout(key))
    parts = tasks_for(df.sparkSession, rows)
    keys = _longer_than(df, key, max_rows)
    if keys is None:
        return compute(df, Layout(key, parts=parts))
    blocked = Layout(key, width=max_rows, parts=parts)
    keys = F.broadcast(keys)
    short = compute(df.join(keys, key, "left_anti"), Layout(key, parts=parts))
    long = (compute_long or compute)(df.join(keys, key, "left_semi"), blocked)
    return short.unionByName(long.drop(BLOCK))


def running(
    df: DataFrame,
    layout: Layout,
    sums: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None,
    prior: dict[str, str] | None = None,
    within: tuple[str, ...] = (),
) -> DataFrame:
    """Adds running aggregates along ``layout.order`` for each key (and ``within``).

    ``sums`` and ``maxes`` include the current row. ``prior`` maps a new column
    to one of them and gives its value before the current row; an aggregate
    named only there, with a leading underscore, is not kept.
    """
    values = {**(sums or {}), **(maxes or {})}
    aggregate = {name: F.sum if name in (sums or {}) else F.max for name in values}
    prior = prior or {}
    keys = [layout.key, *within]

    if not layout.blocked:
        rows, inputs, part = df, values, keys
    else:
        rows = checkpointed(df.withColumns({f"_v_{n}": c for n, c in values.items()}))
        inputs = {n: F.col(f"_v_{n}") for n in values}
        part = [*keys, BLOCK]
        earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        carries = (
            rows.groupBy(*part)
            .agg(*(aggregate[n](c).alias(f"_v_{n}") for n, c in inputs.items()))
            .select(
                *part,
                *(aggregate[n](f"_v_{n}").over(earlier).alias(f"_v_{n}") for n in values),
                (F.col(BLOCK) - 1).alias(layout.order),
                F.lit(True).alias(_CARRY),
            )
        )
        rows = layout.dealt(rows.withColumn(_CARRY, F.lit(False)).unionByName(carries, allowMissingColumns=True))

    along = Window.partitionBy(*part).orderBy(layout.order)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({n: aggregate[n](c).over(upto) for n, c in inputs.items()})
    if prior:
        rows = rows.withColumns({new: F.lag(n).over(along) for new, n in prior.items()})
    rows = rows.drop(*(n for n in values if n.startswith("_")))
    if layout.blocked:
        rows = rows.filter(~F.col(_CARRY)).drop(_CARRY, *(f"_v_{n}" for n in values))
    return rows


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the folder of the session."""
    set_checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession) -> str:
    """The name of a new folder beside the checkpoints, which all executors see."""
    set_checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def set_checkpoint_folder(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    context.setCheckpointDir(folder)
