"""Small event sequences with what must become of each event.

Each case is its own product. Times are minutes; ``now`` is the arrival, ``at``
the event time. Expected rows name only the columns the case is about.
"""

from datetime import datetime, timedelta
from decimal import Decimal

from docweave import schemas as S

START = datetime(2024, 3, 1)
HOUR = 60


def minutes(m):
    return START + timedelta(minutes=m)


class Case:
    def __init__(self, name):
        self.name = name
        self.rows = []
        self.expected = []
        self.idles = False

    def _add(self, kind, now, at, expect, **fields):
        row = dict.fromkeys(S.CHANGE.fieldNames())
        row.update(product_id=self.name, kind=kind, seq=len(self.rows), arrival_ts=minutes(now))
        row.update(updated_at=minutes(at if at is not None else now), **fields)
        self.rows.append(row)
        self.expected.append(expect)
        return self

    def product(self, now, title="Widget", /, at=None, **expect):
        return self._add("P", now, at, expect, name=title)

    def price(self, now, amount="9.99", currency="USD", /, at=None, **expect):
        return self._add("R", now, at, expect, price=Decimal(amount), currency=currency)

    def stock(self, now, warehouse="wh1", quantity=100, /, at=None, **expect):
        return self._add("S", now, at, expect, warehouse_id=warehouse, quantity=quantity)

    def delete(self, now, at=None, **expect):
        return self._add("D", now, at, expect)


def _case(build):
    case = Case(build.__name__)
    build(case)
    CASES[case.name] = case
    return build


CASES = {}
ONE_THIRD, TWO_THIRDS = 1 / 3, 2 / 3


@_case
def product_only(c):
    c.product(0, outcome="emitted", name="Widget", price=None, completeness=ONE_THIRD, other_side=False)


@_case
def price_only(c):
    c.price(0, outcome="emitted", name=None, price=Decimal("9.99"), completeness=ONE_THIRD)


@_case
def product_then_price(c):
    c.product(0, completeness=ONE_THIRD, other_side=False)
    c.price(1, completeness=TWO_THIRDS, other_side=True, name="Widget")


@_case
def older_or_equal_product_is_stale(c):
    c.product(0, "New", at=10)
    c.product(1, "Old", at=9, outcome="stale")
    c.product(2, "Same", at=10, outcome="stale")
    c.price(3, name="New")


@_case
def older_price_is_stale(c):
    c.price(0, "99.99", at=10)
    c.product(1, at=5)
    c.price(2, "1.00", at=-10, outcome="stale")
    c.stock(3, price=Decimal("99.99"), name="Widget", completeness=1.0)


@_case
def delete_clears_the_first_join(c):
    c.product(0).price(1, "1.00")
    c.delete(2, outcome="deleted")
    c.price(3, "2.00", outcome="emitted", name=None, price=Decimal("2.00"), other_side=False)


@_case
def old_delete_still_clears(c):
    c.product(10, at=10)
    c.delete(11, at=0, outcome="deleted")
    c.product(12, "Again", at=5, outcome="emitted", name="Again")


@_case
def delete_does_not_reach_the_second_join(c):
    c.product(0).price(1, "3.00")
    c.delete(2, outcome="deleted")
    c.stock(3, "wh1", 5, outcome="emitted", name="Widget", price=Decimal("3.00"), completeness=1.0)


@_case
def same_content_after_delete_is_suppressed(c):
    c.product(0, "Same", at=0, outcome="emitted")
    c.delete(1)
    c.product(2, "Same", at=0, outcome="suppressed")


@_case
def stock_only_even_none_left(c):
    c.stock(0, "wh1", 0, outcome="emitted", name=None, total_stock=0, completeness=ONE_THIRD)


@_case
def three_warehouses(c):
    c.stock(0, "wh1", 100, total_stock=100, stock_by_warehouse={"wh1": 100})
    c.stock(1, "wh2", 50, total_stock=150)
    c.stock(2, "wh3", 200, total_stock=350, stock_by_warehouse={"wh1": 100, "wh2": 50, "wh3": 200})


@_case
def same_warehouse_again_even_if_older(c):
    c.stock(10, "wh1", 100, at=10, total_stock=100, last_stock_update=minutes(10))
    c.stock(11, "wh1", 75, at=11, total_stock=75, last_stock_update=minutes(11))
    c.stock(12, "wh1", 50, at=1, total_stock=50, last_stock_update=minutes(11))


@_case
def pair_after_stock(c):
    c.stock(0, "wh1", 7)
    c.product(1, total_stock=7, completeness=TWO_THIRDS)
    c.price(2, total_stock=7, completeness=1.0)


@_case
def stock_time_up_to_the_epoch_is_none(c):
    before = int((datetime(1969, 12, 31) - START).total_seconds() // 60)
    c.stock(0, "wh1", 1, at=before, last_stock_update=None, total_stock=1)
    c.stock(1, "wh1", 2, at=1, last_stock_update=minutes(1))


@_case
def identical_stock_is_suppressed(c):
    c.stock(0, "wh1", 5, at=0, outcome="emitted")
    c.stock(1, "wh1", 5, at=0, outcome="suppressed")
    c.stock(2, "wh1", 5, at=-3, outcome="suppressed")
    c.stock(3, "wh1", 6, at=0, outcome="emitted")
    c.stock(4, "wh1", 5, at=0, outcome="emitted")
    c.stock(5, "wh1", 5, at=5, outcome="emitted")


@_case
def later_null_price_after_delete(c):
    c.price(0, "1.00", at=0, outcome="emitted")
    c.delete(1)
    c.product(2, at=2, outcome="emitted", price=None)


@_case
def whole_price_digits(c):
    c.price(0, "1234567.89", "EUR", price=Decimal("1234567.89"), currency="EUR")
    c.price(1, "0.00", price=Decimal("0.00"))


# ----------------------------------------------------- idle products, 24 hours


def _idle_case(build):
    _case(build)
    CASES[build.__name__].idles = True
    return build


@_idle_case
def pair_forgotten_after_a_day(c):
    c.product(0)
    c.price(25 * HOUR, outcome="emitted", name=None, other_side=False)


@_idle_case
def due_time_itself_is_too_late(c):
    c.product(0)
    c.price(24 * HOUR, name=None)


@_idle_case
def just_before_the_due_time(c):
    c.product(0)
    c.price(24 * HOUR - 1, name="Widget", other_side=True)


@_idle_case
def stale_event_does_not_renew(c):
    c.product(0, at=0)
    c.product(23 * HOUR, "Old", at=-5, outcome="stale")
    c.price(25 * HOUR, name=None)


@_idle_case
def suppressed_document_does_not_renew(c):
    c.stock(0, "wh1", 5, at=0, outcome="emitted")
    c.stock(23 * HOUR, "wh1", 5, at=0, outcome="suppressed")
    c.stock(25 * HOUR, "wh1", 5, at=0, outcome="emitted")
    c.stock(26 * HOUR, "wh1", 5, at=0, outcome="suppressed")


@_idle_case
def stock_keeps_the_second_join_alive(c):
    c.product(0)
    c.stock(12 * HOUR, "wh1", 4, name="Widget")
    c.stock(24 * HOUR, "wh2", 5, name="Widget", total_stock=9)
    c.price(25 * HOUR, outcome="emitted", name=None, total_stock=9, other_side=False)


@_idle_case
def stock_forgotten_after_a_day(c):
    c.stock(0, "wh1", 4)
    c.product(25 * HOUR, total_stock=None, stock_by_warehouse={}, last_stock_update=None)


@_idle_case
def delete_cancels_the_timer(c):
    c.product(0, at=0)
    c.delete(1)
    c.price(23 * HOUR, "2.00", name=None)
    c.product(25 * HOUR, "Later", at=1, outcome="emitted", price=Decimal("2.00"), other_side=True)


@_idle_case
def copies_pass_once_a_day(c):
    for hour in range(0, 100, 5):
        c.price(hour * HOUR, "5.00", at=0, outcome="emitted" if hour % 25 == 0 else "stale")


def all_rows(idle):
    return [r for c in CASES.values() if idle or not c.idles for r in c.rows]
