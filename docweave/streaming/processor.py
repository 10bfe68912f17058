"""Both joins and change suppression as one stateful operator.

The three steps share the key, so one exchange feeds one processor that runs
``advance`` per row. Three due times per product are kept with the state; timers
only make sure that idle state is dropped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docweave import schemas as S
from docweave.functions.lifecycle import (
    Document,
    Event,
    Lifetimes,
    ProductState,
    advance,
)
from docweave.operators.expiry import LIFECYCLE

PROCESSING, ARRIVAL = "processing", "arrival"

#: ``position`` orders the rows of one product within a micro-batch.
OUTPUT = T.StructType([*LIFECYCLE.fields, T.StructField("position", T.LongType())])
_TIMES = [f.name for f in OUTPUT.fields if isinstance(f.dataType, T.TimestampType)]
# times cross to Python and back as microseconds, which no time zone touches
_RAW_OUTPUT = T.StructType(
    [T.StructField(f.name, T.LongType()) if f.name in _TIMES else f for f in OUTPUT.fields]
)

_HEAD = T.StructType(
    [
        T.StructField("pair", T.StringType()),
        T.StructField("pair_due", T.LongType()),
        T.StructField("handed", T.StringType()),
        T.StructField("stock", T.StringType()),
        T.StructField("stock_at", T.LongType()),
        T.StructField("stock_due", T.LongType()),
        T.StructField("sent", T.StringType()),
        T.StructField("sent_due", T.LongType()),
        # a replay's clock: the latest arrival so far
        T.StructField("clock", T.LongType()),
    ]
)


#: The input that a kind of change comes from, in the order of equal arrivals.
_INPUT = {S.UPSERT: 0, S.DELETE: 0, S.PRICE: 1, S.STOCK: 2}


def _tuples(value: Any) -> Any:
    return tuple(_tuples(v) for v in value) if isinstance(value, list) else value


class Enricher(StatefulProcessor):
    def __init__(self, lifetimes: Lifetimes, clock: str = PROCESSING, by_arrival: bool = False):
        """``clock``: processing time, or the arrival time of the rows for a replay.

        ``by_arrival``: ``seq`` orders the rows of one input only, arrival times those of different ones.

        A replay sets no timers: its clock stands still between rows, and what
        is due is dropped when the next row of the product arrives.
        """
        self._lifetimes = lifetimes
        self._clock = clock
        self._by_arrival = by_arrival

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._head = handle.getValueState("head", _HEAD)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        state = self._load()
        now = self._now(timerValues)
        for position, row in enumerate(self._in_order(rows)):
            if now is None:
                state.clock = max(state.clock or row.arrival_ts, row.arrival_ts)
            event = self._event(row, state.clock if now is None else now)
            outcome, other_side, document = advance(state, event, self._lifetimes)
            yield self._row(row, event.now, outcome, other_side, document, position)
        self._save(state)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        state = self._load()
        state.expire(expiredTimerInfo.getExpiryTimeInMs() * 1000)
        self._save(state)
        return iter(())

    def close(self) -> None:
        pass

    # ------------------------------------------------------------------ rows

    def _in_order(self, rows: Iterator[Row]) -> list[Row]:
        """By ``seq``; or by arrival, where no input's time runs back and equal times go by input."""
        rows = sorted(rows, key=lambda r: r.seq)
        if not self._by_arrival:
            return rows
        latest: dict[int, int] = {}
        placed = []
        for row in rows:
            of = _INPUT[row.kind]
            latest[of] = max(latest.get(of, row.arrival_ts), row.arrival_ts)
            placed.append((latest[of], of, row.seq, row))
        return [p[-1] for p in sorted(placed, key=lambda p: p[:3])]

    def _now(self, timerValues: Any) -> int | None:
        if self._clock == ARRIVAL:
            return None
        return timerValues.getCurrentProcessingTimeInMs() * 1000

    def _event(self, row: Row, now: int) -> Event:
        price = None if row.price is None else format(row.price, "f")
        return Event(
            row.kind,
            now,
            row.updated_at,
            tuple(row[f] for f in S.PRODUCT_FIELDS),
            (price, row.currency),
            row.warehouse_id,
            row.quantity,
        )

    def _row(self, row, now, outcome, other_side, d: Document | None, position) -> Row:
        head = {
            "seq": row.seq,
            "arrival_ts": now,
            "product_id": row.product_id,
            "kind": row.kind,
            "outcome": outcome,
            "other_side": other_side,
            "position": position,
        }
        if d is not None:
            price, currency = d.price
            head.update(zip(S.PRODUCT_FIELDS, d.product))
            head.update(
                price=None if price is None else Decimal(price),
                currency=currency,
                total_stock=d.total,
                stock_by_warehouse=dict(d.stock),
                last_product_update=d.product_at,
                last_price_update=d.price_at,
                last_stock_update=d.stock_at,
            )
        return Row(**{name: head.get(name) for name in _RAW_OUTPUT.fieldNames()})

    # ----------------------------------------------------------------- state

    def _load(self) -> ProductState:
        """One read per product and batch; the stock map is small beside the sent document."""
        state = ProductState()
        head = self._head.get()
        if head is not None:
            pair, state.pair_due, handed, stock, state.stock_at, state.stock_due, sent, state.sent_due, state.clock = head
            if pair is not None:
                state.product, state.product_at, state.price, state.price_at = _tuples(json.loads(pair))
            if handed is not None:
                state.handed = _tuples(json.loads(handed))
            if stock is not None:
                state.stock = json.loads(stock)
            if sent is not None:
                state.sent = Document(*_tuples(json.loads(sent)))
        return state

    def _save(self, state: ProductState) -> None:
        pair = (state.product, state.product_at, state.price, state.price_at)
        has_pair = state.product_at is not None or state.price_at is not None
        has_handed = state.handed[1] is not None or state.handed[3] is not None
        if not (has_pair or has_handed or state.stock or state.sent is not None or state.clock is not None):
            self._head.clear()
        else:
            self._head.update(
                (
                    json.dumps(pair) if has_pair else None,
                    state.pair_due,
                    json.dumps(state.handed) if has_handed else None,
                    json.dumps(state.stock) if state.stock else None,
                    state.stock_at,
                    state.stock_due,
                    None if state.sent is None else json.dumps(state.sent),
                    state.sent_due,
                    state.clock,
                )
            )
        if self._clock == PROCESSING:
            self._set_timers(state)

    def _set_timers(self, state: ProductState) -> None:
        """One timer per distinct due time; stages that share one are dropped together."""
        due = (state.pair_due, state.stock_due, state.sent_due)
        wanted = {-(-d // 1000) for d in due if d is not None}
        present = set(self._handle.listTimers())
        for at in present - wanted:
            self._handle.deleteTimer(at)
        for at in wanted - present:
            self._handle.registerTimer(at)


def enrich(
    changes: DataFrame,
    lifetimes: Lifetimes,
    clock: str = PROCESSING,
    by_arrival: bool = False,
) -> DataFrame:
    """Change rows to one row per event (``OUTPUT``); needs the RocksDB state store."""
    raw = _in_micros(changes).groupBy("product_id").transformWithState(
        statefulProcessor=Enricher(lifetimes, clock, by_arrival),
        outputStructType=_RAW_OUTPUT,
        outputMode="Update",
        timeMode="ProcessingTime" if clock == PROCESSING else "None",
    )
    return raw.withColumns({t: F.timestamp_micros(t) for t in _TIMES})


def _in_micros(changes: DataFrame) -> DataFrame:
    return changes.withColumns({t: F.unix_micros(t) for t in ("arrival_ts", "updated_at")})
