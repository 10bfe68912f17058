"""Joins and change suppression with state that expires when a product is idle.

Ordinary histories: one exchange, then the rows of each sorted partition stream
through ``advance`` in Arrow batches; memory holds one product's state.

Histories too long for one task: an expiry is a row that finds its state gone,
and there is at most one per idle period. ``expired_rows`` finds those rows from
blocks written down as functions of the state carried in; once known they are mere
resets, and the joins are running maxima again, computed by blocks. Each of the three stages is that one operator
with another notion of "newer": the event time for the first join, the arrival
itself for the second, the count of changes so far for suppression.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docweave import schemas as S
from docweave.functions.arrow import STAMP, RepeatedMaps, longs, micros, texts
from docweave.functions.columns import completeness, stock_text
from docweave.functions.lifecycle import (
    DELETED,
    EMITTED,
    STALE,
    SUPPRESSED,
    Event,
    Lifetimes,
    ProductState,
    advance,
)
from docweave.operators.enrich import PAIR_FIELDS, pair_history, stock_columns, with_replaced
from docweave.operators.running import (
    BLOCK,
    MAX_ROWS_PER_KEY,
    Layout,
    by_history_length,
    checkpointed,
    running,
)
from docweave.operators.stock_map import STOCK_MAP, attach_stock_map

_NO_PAIR, _NO_STOCK = (None,) * 8, (None,) * 2
_STATE_FIELDS = [f for f in S.DOCUMENT.fields if f.name not in ("product_id", "completeness", "indexed_at")]

#: One row per event: what became of it and the document it made, if any.
LIFECYCLE = T.StructType(
    [
        *(f for f in S.CHANGE.fields if f.name in ("seq", "arrival_ts", "product_id", "kind")),
        T.StructField("outcome", T.StringType()),
        T.StructField("other_side", T.BooleanType()),
        *_STATE_FIELDS,
    ]
)


def lifecycle(
    changes: DataFrame, lifetimes: Lifetimes, max_rows: int = MAX_ROWS_PER_KEY
) -> DataFrame:
    """All three stages with their idle times, one row per event (``LIFECYCLE``).

    The clock of a product never runs back: an event that arrives with an earlier
    ``arrival_ts`` than one before it takes the latest so far, in either form and in the stream.
    """
    # Where only the second stage forgets, every row renews the timer and windows do.
    by_windows = lifetimes.pair is None and lifetimes.sent is None
    whole = _by_windows if by_windows else _streamed
    return by_history_length(
        changes,
        lambda rows, layout: whole(rows, layout, lifetimes),
        max_rows=max_rows,
        compute_long=lambda rows, layout: _by_windows(rows, layout, lifetimes),
    )


def lifecycle_documents(history: DataFrame) -> DataFrame:
    """Documents let through, stamped with the clock."""
    return history.filter(F.col("outcome") == EMITTED).withColumns(
        {
            "completeness": completeness(F.col("name"), F.col("price"), F.col("total_stock")),
            "indexed_at": F.col("arrival_ts"),
        }
    )


def _with_steady_clock(changes: DataFrame, layout: Layout) -> DataFrame:
    return running(changes, layout, maxes={"arrival_ts": F.col("arrival_ts")})


# ---------------------------------------------------------------- whole histories


_PASSED = ("seq", "arrival_ts", "product_id", "kind")


def _streamed(changes: DataFrame, layout: Layout, lifetimes: Lifetimes) -> DataFrame:
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, ProductState()
        for batch in batches:
            data = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            events = map(
                Event,
                texts(data["kind"]),
                micros(data["arrival_ts"]),
                micros(data["updated_at"]),
                zip(*(texts(data[f]) for f in S.PRODUCT_FIELDS)),
                zip(*(texts(data[f]) for f in S.PRICE_FIELDS)),
                texts(data["warehouse_id"]),
                longs(data["quantity"]),
            )
            outcomes, sides, pairs, stock, maps = [], [], [], [], RepeatedMaps()
            for key, event in zip(texts(data["product_id"]), events):
                if key != current:
                    current, state = key, ProductState()
                outcome, other_side, d = advance(state, event, lifetimes)
                outcomes.append(outcome)
                sides.append(other_side)
                if d is None:
                    pairs.append(_NO_PAIR)
                    stock.append(_NO_STOCK)
                    maps.append(None)
                else:
                    pairs.append((*d.product, *d.price, d.product_at, d.price_at))
                    stock.append((d.total, d.stock_at))
                    maps.append(d.stock)
            name, category, brand, description, price, currency, product_at, price_at = (
                zip(*pairs) if pairs else [()] * 8
            )
            total, stock_at = zip(*stock) if stock else [()] * 2
            made = {
                "outcome": pa.array(outcomes, pa.string()),
                "other_side": pa.array(sides, pa.bool_()),
                "name": pa.array(name, pa.string()),
                "category": pa.array(category, pa.string()),
                "brand": pa.array(brand, pa.string()),
                "description": pa.array(description, pa.string()),
                "price": pa.array(price, pa.string()).cast(pa.decimal128(38, 18)),
                "currency": pa.array(currency, pa.string()),
                "total_stock": pa.array(total, pa.int64()),
                STOCK_MAP: maps.array(),
                "last_product_update": pa.array(product_at, pa.int64()).cast(STAMP),
                "last_price_update": pa.array(price_at, pa.int64()).cast(STAMP),
                "last_stock_update": pa.array(stock_at, pa.int64()).cast(STAMP),
            }
            yield pa.RecordBatch.from_arrays(
                [*(data[n] for n in _PASSED), *made.values()], [*_PASSED, *made]
            )

    rows = _with_steady_clock(layout.arrange(changes), layout).sortWithinPartitions(*layout.group, layout.order)
    return rows.mapInArrow(fold, LIFECYCLE)


# ------------------------------------------------------- long histories, and windows


def _by_windows(changes: DataFrame, layout: Layout, lifetimes: Lifetimes) -> DataFrame:
    changes = _with_steady_clock(layout.arrange(changes), layout)
    pairs = _expiring_pairs(changes, layout, lifetimes)
    inputs = pairs.filter("accepted").unionByName(
        changes.filter(F.col("kind") == S.STOCK).select(
            "seq", "arrival_ts", "product_id", "kind", "updated_at", *layout.group[1:], "warehouse_id", "quantity"
        ),
        allowMissingColumns=True,
    )
    documents = _expiring_documents(inputs, layout, lifetimes)
    dropped = pairs.filter("NOT accepted").select(
        "seq",
        "arrival_ts",
        "product_id",
        "kind",
        F.when(F.col("kind") == S.DELETE, DELETED).otherwise(STALE).alias("outcome"),
    )
    return documents.unionByName(dropped, allowMissingColumns=True).select(*LIFECYCLE.fieldNames())


def _expiring_pairs(changes: DataFrame, layout: Layout, lifetimes: Lifetimes) -> DataFrame:
    """First join: epochs end with a delete or with an expiry."""
    rows = changes.filter(F.col("kind") != S.STOCK)
    rows = _mark_expired(
        rows,
        layout,
        lifetimes.pair,
        version=F.when(F.col("kind") != S.DELETE, F.unix_micros("updated_at")),
        channel=F.when(F.col("kind") == S.PRICE, 1).otherwise(0),
    )
    rows = pair_history(rows, layout, extra_reset=F.col("_expired"))
    rows = rows.drop("_expired", "epoch")
    return checkpointed(rows) if layout.blocked else rows


def _expiring_documents(inputs: DataFrame, layout: Layout, lifetimes: Lifetimes) -> DataFrame:
    """Second join by segments between expiries, then suppression."""
    rows = _mark_idle(inputs, layout, lifetimes.stock)
    rows = running(rows, layout, sums={"segment": F.col("_expired").cast("int")}).drop("_expired")
    rows = with_replaced(rows, layout, within=("segment",))
    sums, maxes = stock_columns()
    handed = F.when(F.col("kind") != S.STOCK, F.struct("seq", *PAIR_FIELDS))
    rows = running(rows, layout, sums, {"handed": handed, **maxes}, within=("segment",))
    rows = rows.withColumns({f: F.col(f"handed.{f}") for f in PAIR_FIELDS}).drop("handed")
    rows = attach_stock_map(rows, layout, F.col("segment"))

    content = F.struct(
        *PAIR_FIELDS, "total_stock", "last_stock_update", stock_text(F.col(STOCK_MAP)).alias("stock")
    )
    rows = rows.withColumn("_content", content)
    rows = running(
        rows,
        layout,
        maxes={"_sent": F.struct("seq", F.col("_content").alias("content"))},
        prior={"_before": "_sent"},
    )
    rows = rows.withColumn("_changed", ~F.col("_content").eqNullSafe(F.col("_before.content")))
    rows = running(rows, layout, sums={"changes": F.col("_changed").cast("int")})
    rows = _mark_expired(rows, layout, lifetimes.sent, version=F.col("changes"))
    passed = F.col("_changed") | F.col("_expired")
    return rows.withColumn("outcome", F.when(passed, EMITTED).otherwise(SUPPRESSED))


def _mark_idle(rows: DataFrame, layout: Layout, lifetime: int | None) -> DataFrame:
    """``_expired`` where every row renews the timer: one window, however often it falls due."""
    if lifetime is None:
        return rows.withColumn("_expired", F.lit(False))
    rows = running(rows, layout, maxes={"_now": F.col("arrival_ts")}, prior={"_before": "_now"})
    due = F.unix_micros("_before") + lifetime
    return rows.withColumn("_expired", F.coalesce(F.unix_micros("arrival_ts") >= due, F.lit(False))).drop("_before")


def _mark_expired(
    rows: DataFrame,
    layout: Layout,
    lifetime: int | None,
    version: Column,
    channel: Column | None = None,
) -> DataFrame:
    if lifetime is None:
        return rows.withColumn("_expired", F.lit(False))
    rows = checkpointed(rows)
    found = expired_rows(
        rows.select(
            layout.key,
            layout.order,
            BLOCK,
            F.unix_micros("arrival_ts").alias("now"),
            version.cast("bigint").alias("version"),
            (F.lit(0) if channel is None else channel).alias("channel"),
        ),
        layout,
        lifetime,
    )
    found = found.withColumn("_expired", F.lit(True))
    return rows.join(found, [layout.key, layout.order], "left").withColumn(
        "_expired", F.coalesce("_expired", F.lit(False))
    )


_CHANNELS = (0, 1)
_FOUND = "product_id string, slot bigint, _block bigint, row bigint, due bigint"


def expired_rows(rows: DataFrame, layout: Layout, lifetime: int) -> DataFrame:
    """The rows that find the state of their key expired.

    ``rows``: key, order, block, ``now`` (never running back), ``version`` (null: the row clears the
    state) and ``channel``. A row is accepted if its version is above the stored
    one of its channel; only accepted rows renew the timer.

    Blocks are also cut at multiples of the lifetime, so within one block no timer set there can
    fall due: only the one carried in can, and only once. So a block is a function of the state
    carried in, and ``_summaries`` writes it down in a few pieces per channel. The functions are
    applied in order, in segments that end where what a block hands on does not depend on what it
    is handed: segments are worked off side by side. The number of jobs does not depend on the history.
    """
    key, order = layout.key, layout.order
    part = [key, "slot", BLOCK]
    rows = checkpointed(rows.withColumn("slot", F.col("now") - F.pmod(F.col("now"), F.lit(lifetime))))
    blocks = _segments(_summaries(rows, layout, part), key, lifetime)
    dealt = blocks.repartition(key, "segment").sortWithinPartitions(key, "segment", "slot", BLOCK)
    columns = [key, "segment", "slot", BLOCK, "seed", "first_row", "first_now", "last_now", "clears", "sure_now"]
    columns += [f"{name}{c}" for c in _CHANNELS for name in ("newest", "rest", "prefix", "suffix")]
    found = checkpointed(dealt.select(*columns).mapInArrow(_apply_blocks(lifetime), _FOUND).withColumnRenamed("product_id", key))
    inside = rows.join(found.filter("due IS NOT NULL").drop("row"), part).filter(F.col("now") >= F.col("due"))
    at_start = found.filter("due IS NULL").select(key, F.col("row").alias(order))
    return at_start.unionByName(inside.groupBy(*part).agg(F.min(order).alias(order)).select(key, order))


def _summaries(rows: DataFrame, layout: Layout, part: list[str]) -> DataFrame:
    """What each block does to the state carried in.

    A row that clears or has the highest version of its channel so far is accepted whatever the state: it is *sure*. Up to
    the first sure row of a block the timer may fall due, so of these rows those are kept where the highest version of
    the channel so far rises (``prefix``: when is a given version first exceeded?) and those that no later one exceeds
    (``suffix``: what is stored if all starts anew at a given time?). ``rest`` is the first newest row after them,
    ``newest`` that of the block after its last clear. The pieces are no more than the block's rows and mostly very few.
    """
    order = layout.order
    versioned = F.col("version").isNotNull()
    own = {c: F.when(F.col("channel") == c, F.col("version")) for c in _CHANNELS}
    tops = {f"_top{c}": own[c] for c in _CHANNELS}
    rows = running(rows, layout, maxes=tops, prior={f"_before{c}": f"_top{c}" for c in _CHANNELS})
    higher = [own[c] > F.coalesce(F.col(f"_before{c}"), F.lit(-(2**63))) for c in _CHANNELS]
    rows = rows.withColumns(
        {
            "sure": ~versioned | F.coalesce(higher[0], F.lit(False)) | F.coalesce(higher[1], F.lit(False)),
            # No version of the channel so far: nothing is stored of it.
            **{f"none{c}": F.col(f"_before{c}").isNull() & own[c].isNull() for c in _CHANNELS},
        }
    )
    along = Window.partitionBy(*part).orderBy(order)
    same = Window.partitionBy(*part, "channel").orderBy(order)
    start, end = Window.unboundedPreceding, Window.unboundedFollowing
    rows = rows.withColumns(
        {
            "clears": F.sum(F.when(versioned, 0).otherwise(1)).over(along.rowsBetween(start, 0)),
            "_sure": F.coalesce(F.sum(F.col("sure").cast("int")).over(along.rowsBetween(start, -1)), F.lit(0)),
            "_earlier": F.max("version").over(same.rowsBetween(start, -1)),
            "_later": F.max("version").over(same.rowsBetween(1, end)),
        }
    )
    opened = F.col("_sure") == 0
    rising = opened & versioned & (F.col("_earlier").isNull() | (F.col("version") > F.col("_earlier")))
    lasting = opened & versioned & (F.col("_later").isNull() | (F.col("version") >= F.col("_later")))
    first_of = F.struct("version", (-F.col(order)).alias("order"), "now")
    piece = F.struct(F.col(order).alias("order"), "now", "version")

    def pieces(where: Column, c: int) -> Column:
        return F.array_sort(F.collect_list(F.when(where & (F.col("channel") == c), piece)))

    per_channel = []
    for c in _CHANNELS:
        mine = versioned & (F.col("channel") == c)
        per_channel += [
            F.max(F.when(mine, F.struct("clears", "version", (-F.col(order)).alias("order"), "now"))).alias(f"newest{c}"),
            F.max(F.when(mine & ~opened, first_of)).alias(f"rest{c}"),
            pieces(rising, c).alias(f"prefix{c}"),
            pieces(lasting, c).alias(f"suffix{c}"),
            (F.max(F.col("sure") & mine) | F.min(f"none{c}")).alias(f"known{c}"),
        ]
    return rows.groupBy(*part).agg(
        F.min(order).alias("first_row"), F.min("now").alias("first_now"), F.max("now").alias("last_now"),
        F.max("clears").alias("clears"), F.min(F.when(F.col("sure"), F.col("now"))).alias("sure_now"), *per_channel,
    )


def _segments(blocks: DataFrame, key: str, lifetime: int) -> DataFrame:
    """Adds ``segment`` and ``seed``, the state at the start of each segment but the first.

    A block hands on the same whatever it is handed if it clears, if both channels reach a new height in it (or have
    no version yet), or if the next block begins a lifetime or more after its last row.
    """
    along = Window.partitionBy(key).orderBy("slot", BLOCK)
    dead = F.lead("first_now").over(along) - F.col("last_now") >= lifetime
    newest = [F.when(F.col(f"newest{c}.clears") == F.col("clears"), F.col(f"newest{c}")) for c in _CHANNELS]
    state = F.struct(
        *(n["version"].alias(f"v{c}") for c, n in zip(_CHANNELS, newest)),
        F.greatest(*(n["now"] for n in newest)).alias("renewed"),
    )
    nothing = F.lit(None).cast("bigint")
    idle = F.struct(nothing.alias("v0"), nothing.alias("v1"), F.col("last_now").alias("renewed"))
    settled = (F.col("clears") > 0) | (F.col("known0") & F.col("known1"))
    # A block without a clear has stored something, which is gone when the next one begins.
    blocks = blocks.withColumn("_idle", F.coalesce(dead, F.lit(False)) & (F.col("clears") == 0))
    blocks = blocks.withColumn("_ends", settled | F.col("_idle"))
    blocks = blocks.withColumn("_state", F.when(F.col("_idle"), idle).when(settled, state))
    return blocks.withColumns(
        {
            "segment": F.coalesce(F.sum(F.col("_ends").cast("bigint")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "seed": F.lag("_state").over(along),
        }
    )


def _apply_blocks(lifetime: int):
    """Streams blocks through the state of their segment; gives expired rows, or the block and time from which one is."""

    def fresh(block: dict) -> tuple[list, int | None]:
        newest = [block[f"newest{c}"] for c in _CHANNELS]
        newest = [n if n is not None and n["clears"] == block["clears"] else None for n in newest]
        return _state_of(newest)

    def merged(state: tuple[list, int | None], block: dict) -> tuple[list, int | None]:
        if block["clears"]:
            return fresh(block)
        versions, renewed = list(state[0]), state[1]
        for c in _CHANNELS:
            n = block[f"newest{c}"]
            if n is not None and (versions[c] is None or n["version"] > versions[c]):
                versions[c] = n["version"]
                renewed = n["now"] if renewed is None else max(renewed, n["now"])
        return versions, renewed

    def anew(block: dict, due: int) -> tuple[list, int | None]:
        if block["clears"]:
            return fresh(block)
        return _state_of(
            [next((p for p in block[f"suffix{c}"] if p["now"] >= due), block[f"rest{c}"]) for c in _CHANNELS]
        )

    def first_accepted(state: tuple[list, int | None], block: dict) -> int | None:
        times = [block["sure_now"]]
        for c in _CHANNELS:
            stored = state[0][c]
            times.append(next((p["now"] for p in block[f"prefix{c}"] if stored is None or p["version"] > stored), None))
        return min((t for t in times if t is not None), default=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, ([None, None], None)
        for batch in batches:
            out = []
            names = batch.schema.names
            for key, *values in zip(*(c.to_pylist() for c in batch.columns)):
                b = dict(zip(names[1:], values))
                if (key, b["segment"]) != current:
                    current, seed = (key, b["segment"]), b["seed"]
                    state = ([None, None], None) if seed is None else ([seed["v0"], seed["v1"]], seed["renewed"])
                due = None if state[1] is None else state[1] + lifetime
                place = (key, b["slot"], b[BLOCK])
                if due is None or due > b["last_now"]:
                    state = merged(state, b)
                elif due <= b["first_now"]:
                    out.append((*place, b["first_row"], None))
                    state = fresh(b)
                else:
                    accepted = first_accepted(state, b)
                    if accepted is not None and accepted < due:
                        state = merged(state, b)
                    else:
                        out.append((*place, None, due))
                        state = anew(b, due)
            made = list(zip(*out)) if out else [()] * 5
            types = [pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(made, types)], ["product_id", "slot", BLOCK, "row", "due"]
            )

    def _state_of(newest: list) -> tuple[list, int | None]:
        return (
            [None if n is None else n["version"] for n in newest],
            max((n["now"] for n in newest if n is not None), default=None),
        )

    return run
