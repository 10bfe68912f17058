"""Random histories against a plain simulation, whole and cut into blocks.

A third of the rows belong to one product, and in one mix nearly all events are
copies of each other, so timers fall due in the middle of long runs of stale rows.
"""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docweave import schemas as S
from docweave.functions.columns import stock_text
from docweave.functions.lifecycle import Lifetimes
from docweave.operators import expiry, reports, snapshot
from docweave.operators.enrich import counted_events, document_history, without_payload
from docweave.operators.expiry import expired_rows, lifecycle
from docweave.operators.running import BLOCK, Layout, by_history_length, long_keys
from docweave.operators.stock_map import attach_stock_map

START = datetime(2024, 1, 1)
TTL = timedelta(hours=24)


def make_rows(seed, n, copies):
    rng = random.Random(seed)
    now, rows = START, []
    for seq in range(n):
        now += timedelta(minutes=rng.choice([1, 7, 20, 45]))
        if rng.random() < 0.004:
            now += timedelta(hours=rng.choice([13, 24, 30]))
        product = "hot" if rng.random() < 0.34 else f"p{rng.randrange(12)}"
        kind = rng.choices("PDRS", [30, 1, 30, 40])[0]
        if copies and rng.random() < 0.97:
            at = START
        else:
            at = now - timedelta(minutes=rng.randrange(4000))
        rows.append(
            {
                "seq": seq,
                "arrival_ts": now,
                "product_id": product,
                "kind": kind,
                "updated_at": at,
                "name": f"n{rng.randrange(3)}" if kind == "P" else None,
                "currency": rng.choice(["USD", "EUR"]) if kind == "R" else None,
                "warehouse_id": f"w{rng.randrange(3)}" if kind == "S" else None,
                "quantity": rng.randrange(2) if kind == "S" else None,
            }
        )
    return rows


def simulate(rows, ttl):
    """Outcome, join hit, name, currency, total and stock text per seq."""
    out, states = {}, {}
    never = datetime.max
    for r in rows:
        s = states.setdefault(
            r["product_id"],
            {"P": None, "R": None, "d1": never, "pair": (None, None), "w": {}, "st": None,
             "d2": never, "last": None, "d3": never},
        )
        now, kind = r["arrival_ts"], r["kind"]
        due = now + ttl if ttl else never
        if now >= s["d1"]:
            s.update(P=None, R=None, d1=never)
        if now >= s["d2"]:
            s.update(pair=(None, None), w={}, st=None, d2=never)
        if now >= s["d3"]:
            s.update(last=None, d3=never)
        hit = None
        if kind == "D":
            s.update(P=None, R=None, d1=never)
            out[r["seq"]] = ("deleted", None, None, None, None, None)
            continue
        if kind == "S":
            s["w"] = {**s["w"], r["warehouse_id"]: r["quantity"]}
            s["st"] = r["updated_at"] if s["st"] is None else max(s["st"], r["updated_at"])
        else:
            if s[kind] is not None and r["updated_at"] <= s[kind][0]:
                out[r["seq"]] = ("stale", None, None, None, None, None)
                continue
            s[kind] = (r["updated_at"], r["name"] or r["currency"])
            hit = s["R" if kind == "P" else "P"] is not None
            s["d1"] = due
            s["pair"] = (s["P"], s["R"])
        s["d2"] = due
        stock = ",".join(f"{w}={q}" for w, q in sorted(s["w"].items()))
        total = sum(s["w"].values()) if s["w"] else None
        document = (s["pair"], stock, s["st"])
        outcome = "suppressed" if document == s["last"] else "emitted"
        if outcome == "emitted":
            s.update(last=document, d3=due)
        name, currency = (None if side is None else side[1] for side in s["pair"])
        out[r["seq"]] = (outcome, hit, name, currency, total, stock)
    return out


def frame(spark, rows):
    data = [tuple(r.get(f) for f in S.CHANGE.fieldNames()) for r in rows]
    return spark.createDataFrame(data, S.CHANGE)


def shown(df):
    columns = ["outcome", "other_side", "name", "currency", "total_stock"]
    made = df.select("seq", *columns, stock_text(F.col("stock_by_warehouse")).alias("stock"))
    return {r[0]: tuple(r[1:]) for r in made.collect()}


def windows(changes, layout):
    rows = attach_stock_map(document_history(changes, layout), layout)
    made = F.col("accepted")
    outcome = (
        F.when(F.col("kind") == "D", "deleted")
        .when(~made, "stale")
        .when(F.col("unchanged"), "suppressed")
        .otherwise("emitted")
    )
    kept = {c: F.when(made, F.col(c)) for c in ("other_side", "name", "currency", "total_stock", "stock_by_warehouse")}
    return rows.withColumns({"outcome": outcome, **kept})


@pytest.mark.parametrize("max_rows", [10_000, 16], ids=["whole", "blocked"])
@pytest.mark.parametrize("copies", [False, True])
def test_windows(spark, copies, max_rows):
    rows = make_rows(1, 1500, copies)
    got = by_history_length(frame(spark, rows), windows, max_rows=max_rows)
    assert shown(got) == simulate(rows, None)


@pytest.mark.parametrize("max_rows", [10_000, 16], ids=["whole", "blocked"])
@pytest.mark.parametrize("copies", [False, True])
def test_lifecycle(spark, copies, max_rows):
    rows = make_rows(2, 1500, copies)
    got = lifecycle(frame(spark, rows), Lifetimes.hours(24, 24, 24), max_rows=max_rows)
    assert shown(got) == simulate(rows, TTL)


@pytest.mark.parametrize("max_rows", [10_000, 40], ids=["whole", "blocked"])
def test_a_clock_that_steps_back_stands_still(spark, max_rows):
    rng = random.Random(7)
    rows = make_rows(8, 700, False)
    for r in rows:
        if rng.random() < 0.2:
            r["arrival_ts"] -= timedelta(minutes=rng.randrange(300))
    latest, steady = {}, []
    for r in rows:
        latest[r["product_id"]] = max(latest.get(r["product_id"], r["arrival_ts"]), r["arrival_ts"])
        steady.append({**r, "arrival_ts": latest[r["product_id"]]})
    got = lifecycle(frame(spark, rows), Lifetimes.hours(24, 24, 24), max_rows=max_rows)
    assert shown(got) == simulate(steady, TTL)


def test_unlike_lifetimes_agree(spark):
    """Blocks and whole histories, when each stage has its own idle time."""
    changes = frame(spark, make_rows(3, 1200, True))
    lifetimes = Lifetimes.hours(pair=20, stock=9, sent=31)
    whole = lifecycle(changes, lifetimes, max_rows=10_000)
    assert shown(lifecycle(changes, lifetimes, max_rows=64)) == shown(whole)


def test_second_stage_by_windows(spark):
    """Where only stock and handed pairs are forgotten: windows, blocks and the fold agree."""
    changes, lifetimes = frame(spark, make_rows(12, 700, True)), Lifetimes.hours(stock=9)
    folded = shown(expiry._streamed(changes, Layout(), lifetimes))
    for max_rows in (10_000, 64):
        assert shown(lifecycle(changes, lifetimes, max_rows=max_rows)) == folded


def timer_rows(seed, n, lifetime):
    """(key, seq, now, version, channel) of three keys; versions rise, fall, repeat or clear, in one channel or two."""
    rng = random.Random(seed)
    rows = []
    for key in ("a", "b", "c"):
        now, level, channels = 0, 50, rng.choice([1, 2])
        drift, step = rng.choice([-0.4, 0.0, 0.4]), rng.choice([lifetime // 9, lifetime // 3, 2 * lifetime])
        for seq in range(n):
            now += rng.choice([0, 0, rng.randint(0, step)])
            level += drift
            version = None if rng.random() < 0.01 else int(level + rng.randrange(12))
            rows.append((key, seq, now, version, rng.randrange(channels)))
    return rows


def plain_expired(rows, lifetime):
    found, states = [], {}
    for key, seq, now, version, channel in rows:
        versions, renewed = states.get(key, ({}, None))
        if renewed is not None and now >= renewed + lifetime:
            found.append((key, seq))
            versions, renewed = {}, None
        if version is None:
            versions, renewed = {}, None
        elif channel not in versions or version > versions[channel]:
            versions, renewed = {**versions, channel: version}, now
        states[key] = (versions, renewed)
    return found


@pytest.mark.parametrize("seed", range(6))
def test_expired_rows(spark, seed):
    lifetime, width = 90, random.Random(seed).choice([4, 17, 200])
    rows = timer_rows(seed, 400, lifetime)
    df = spark.createDataFrame(rows, "product_id string, seq long, now long, version long, channel int")
    df = df.withColumn(BLOCK, F.col("seq") - F.col("seq") % width)
    found = expired_rows(df, Layout(width=width), lifetime).collect()
    assert sorted((r.product_id, r.seq) for r in found) == sorted(plain_expired(rows, lifetime))
    assert found


def test_jobs_do_not_grow_with_a_history(spark):
    """With hundreds of expiries in the longer history, each of which may fall due inside a block."""
    tracker, jobs, expired = spark.sparkContext.statusTracker(), [], []
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for n in (300, 3000):
            rows = timer_rows(1, n, 90)
            df = spark.createDataFrame(rows, "product_id string, seq long, now long, version long, channel int")
            df = df.withColumn(BLOCK, F.col("seq") - F.col("seq") % 50)
            spark.sparkContext.setJobGroup(f"expiry-{n}", "")
            expired.append(expired_rows(df, Layout(width=50), 90).count())
            jobs.append(len(tracker.getJobIdsForGroup(f"expiry-{n}")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] and expired[1] > 5 * expired[0] > 0


def test_reports_do_not_depend_on_blocks(spark):
    changes = frame(spark, make_rows(4, 900, False))

    def both(made):
        return [sorted(map(str, made(n).collect())) for n in (20, 10_000)]

    for report in (reports.event_counts, reports.join_completeness, reports.rates):
        cut, whole = both(lambda n: report(counted_events(changes, n)))
        assert cut == whole
    cut, whole = both(
        lambda n: reports.dedup_stats(by_history_length(changes, document_history, max_rows=n))
    )
    assert cut == whole


def test_reports_without_texts(spark):
    rng = random.Random(11)
    rows = [{**r, "category": rng.choice([None, "c"]), "name": rng.choice([None, r["name"]])} if r["kind"] == "P" else r for r in make_rows(9, 900, True)]
    changes = frame(spark, rows)
    full, light = (by_history_length(c, document_history, max_rows=10_000) for c in (changes, without_payload(changes)))

    def seen(history):
        return sorted(map(str, history.select("seq", "accepted", "unchanged", F.col("name").isNull(), "price", "total_stock", "last_product_update").collect()))

    assert seen(full) == seen(light)


@pytest.mark.parametrize("few", [True, False], ids=["broadcast", "dealt"])
def test_latest_state_equals_the_end_of_the_history(spark, monkeypatch, few):
    """Of products that are deleted once, often, last of all or never, however many are deleted."""
    if not few:
        monkeypatch.setattr(snapshot, "MAX_BROADCAST_ROWS", 0)
    rows = make_rows(5, 900, False)
    rng = random.Random(8)
    for r in rows:
        if r["product_id"] in ("p1", "p2", "p3", "hot") and rng.random() < 0.2:
            r.update(kind="D", name=None, currency=None, warehouse_id=None, quantity=None)
    changes = frame(spark, rows + [{**rows[-1], "seq": 900 + i, "kind": "D", "product_id": f"p{i % 5}"} for i in range(10)])
    history = by_history_length(changes, document_history, max_rows=10_000)
    shape = ["product_id", "name", "currency", "last_product_update", "last_price_update"]

    def seen(df):
        return sorted(map(str, df.select(*shape).collect()))

    pairs = history.filter("kind IN ('P', 'R') AND accepted").groupBy("product_id").agg(F.max(F.struct("seq", *shape[1:])).alias("l"))
    assert seen(snapshot.latest_pairs(changes)) == seen(pairs.select("product_id", "l.*"))
    ends = history.filter("kind != 'S'").groupBy("product_id").agg(F.max("epoch").alias("end"))
    last = history.filter("kind IN ('P', 'R') AND accepted").join(ends, "product_id").filter("epoch = end")
    last = last.groupBy("product_id").agg(F.max(F.struct("seq", *shape[1:])).alias("l"))
    assert seen(snapshot.product_price_state(changes)) == seen(last.select("product_id", "l.*"))


def test_long_keys(spark):
    changes = frame(spark, make_rows(6, 600, False))
    assert long_keys(changes, max_rows=600) is None
    assert [r[0] for r in long_keys(changes, max_rows=100).collect()] == ["hot"]
