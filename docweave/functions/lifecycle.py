"""One product's state and how one event changes it.

This is the rule set for state that expires: whether an event renews a timer
depends on whether it was accepted, which depends on earlier expiry, so the rows
of a product are taken one after another. Times are microseconds since the
epoch. The batch fold and the streaming operator share it.
"""

from __future__ import annotations

from typing import NamedTuple

DELETED, STALE, SUPPRESSED, EMITTED = "deleted", "stale", "suppressed", "emitted"


class Lifetimes(NamedTuple):
    """Idle time in microseconds after which a stage forgets a product; None: never."""

    pair: int | None = None
    stock: int | None = None
    sent: int | None = None

    @classmethod
    def hours(cls, pair=None, stock=None, sent=None) -> Lifetimes:
        return cls(*(None if h is None else int(h * 3_600_000_000) for h in (pair, stock, sent)))


class Event(NamedTuple):
    kind: str
    now: int
    at: int
    product: tuple = ()
    price: tuple = ()
    warehouse: str | None = None
    quantity: int | None = None


class Document(NamedTuple):
    """Content of a document; ``stock`` is a tuple of (warehouse, quantity) by warehouse."""

    product: tuple
    product_at: int | None
    price: tuple
    price_at: int | None
    total: int | None
    stock: tuple
    stock_at: int | None


NO_PRODUCT = (None, None, None, None)
NO_PRICE = (None, None)


class ProductState:
    """First join: product, price. Second join: handed pair, stock. Last: document sent."""

    __slots__ = (
        "product", "product_at", "price", "price_at", "pair_due",
        "handed", "stock", "stock_at", "stock_due",
        "sent", "sent_due", "clock", "_entries",
    )

    def __init__(self):
        self.clock = None
        self.forget_pair()
        self.forget_stock()
        self.forget_sent()

    def forget_pair(self):
        self.product, self.product_at = NO_PRODUCT, None
        self.price, self.price_at = NO_PRICE, None
        self.pair_due = None

    def forget_stock(self):
        self.handed = (NO_PRODUCT, None, NO_PRICE, None)
        self.stock, self.stock_at = {}, None
        self.stock_due = None
        self._entries = None

    def forget_sent(self):
        self.sent = None
        self.sent_due = None

    def expire(self, now: int) -> None:
        if self.pair_due is not None and now >= self.pair_due:
            self.forget_pair()
        if self.stock_due is not None and now >= self.stock_due:
            self.forget_stock()
        if self.sent_due is not None and now >= self.sent_due:
            self.forget_sent()

    def put_stock(self, warehouse: str, quantity: int) -> None:
        if self.stock.get(warehouse) != quantity:
            self.stock[warehouse] = quantity
            self._entries = None

    def entries(self) -> tuple:
        if self._entries is None:
            self._entries = tuple(sorted(self.stock.items()))
        return self._entries

    def document(self) -> Document:
        total = sum(self.stock.values()) if self.stock else None
        return Document(*self.handed, total, self.entries(), self.stock_at)


def _due(now: int, lifetime: int | None) -> int | None:
    return None if lifetime is None else now + lifetime


def advance(state: ProductState, event: Event, lifetimes: Lifetimes):
    """Applies one event; gives outcome, presence of the join's other side, document."""
    state.expire(event.now)
    other_side = None
    if event.kind == "D":
        state.forget_pair()
        return DELETED, None, None
    if event.kind == "S":
        state.put_stock(event.warehouse, event.quantity)
        at = event.at // 1000 * 1000
        if at > (state.stock_at or 0):
            state.stock_at = at
    else:
        if event.kind == "P":
            if state.product_at is not None and event.at <= state.product_at:
                return STALE, None, None
            state.product, state.product_at = event.product, event.at
            other_side = state.price_at is not None
        else:
            if state.price_at is not None and event.at <= state.price_at:
                return STALE, None, None
            state.price, state.price_at = event.price, event.at
            other_side = state.product_at is not None
        state.pair_due = _due(event.now, lifetimes.pair)
        state.handed = (state.product, state.product_at, state.price, state.price_at)
    state.stock_due = _due(event.now, lifetimes.stock)
    document = state.document()
    if document == state.sent:
        return SUPPRESSED, other_side, document
    state.sent = document
    state.sent_due = _due(event.now, lifetimes.sent)
    return EMITTED, other_side, document
