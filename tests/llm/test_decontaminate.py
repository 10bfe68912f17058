import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import decontaminate
from docweave.llm.decontaminate import decontaminated, leaks


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(pairs, items):
    out = []
    for d, text in pairs:
        s = shingle_set(text)
        for i, item in items:
            q = shingle_set(item)
            if q and 10 * len(q & s) >= 8 * len(q):
                out.append((d, i, len(q & s), len(q)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def cases(prose):
    rng = random.Random(8)
    items = [(i, prose(rng, rng.randint(1, 90))) for i in range(60)]
    items += [(100, None), (101, ""), (102, "five words make one shingle"), (103, items[0][1]), (None, prose(rng, 20)), (104, prose(rng, 700))]
    pairs = [(i, prose(rng, rng.randint(0, 300))) for i in range(80)]
    for k, (_, item) in enumerate(items):
        words = (item or "").split()
        for edits in (0, 1, 3, 9):
            some = list(words)
            for _ in range(edits):
                if some:
                    some[rng.randrange(len(some))] = prose(rng, 1)
            text = prose(rng, rng.randint(0, 900)) + "\n" + " ".join(some).upper().replace(" ", ", ") + " " + prose(rng, rng.randint(0, 900))
            pairs.append((1000 + 10 * k + edits, text))
    pairs += [(9000, None), (9001, ""), (9002, "x " * 9000), (None, items[3][1]), (9003, items[3][1]), (9003, items[3][1])]
    return pairs, items


def test_against_brute_force(spark, documents, cases):
    pairs, items = cases
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = sorted(((r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in leaks(documents(pairs), table).collect()), key=str)
    assert got == brute(pairs, items)
    assert got


def test_blocks_of_items_give_the_same(spark, documents, cases, monkeypatch):
    pairs, items = cases
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 900)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in leaks(documents(pairs), table).collect()), key=str)
    assert got == brute(pairs, items)


def test_stage_drops_those_and_keeps_the_others(spark, documents, cases):
    pairs, items = cases
    table = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminated(documents(pairs), table)
    assert kept.columns == documents([]).columns
    leaky = {d for d, *_ in brute(pairs, items)}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((p for p in pairs if p[0] not in leaky), key=str)


def test_windows_stay_in_proportion_to_items_of_any_size():
    for size in range(1, 3000):
        unit, largest = decontaminate.partition_from(size)
        assert largest >= size and (unit == 8 or size < 10)
        for u in range(size, largest + 1):
            window = 2 * unit * -(-int(1.25 * u) // unit)
            shared = -(-4 * size // 5)
            similarity = shared / (window + size - shared)
            assert window >= 2 * u and (1 - similarity) ** decontaminate.PERMUTATIONS < 1e-5


def test_small_items_are_found_in_long_documents():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 4, 5, 8, 9):
        values = rng.integers(1, 2**63, 4000 * 120, dtype=np.uint64)
        bounds = np.arange(4001) * 120
        rows = range(4000)
        at = [row * 120 + int(rng.integers(0, 120 - size)) for row in rows]
        index = decontaminate.Index([(row, np.sort(values[p : p + size])) for row, p in zip(rows, at, strict=True)])
        assert {(row, row) for row in rows} <= index.candidates(values, bounds)


def test_copies_of_items_go_as_one(spark, documents, prose, monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 400)
    copied = prose(rng, 40)
    items = [(i, copied) for i in range(60)] + [(i % 60, copied) for i in range(90)] + [(None, copied)] * 3 + [(100 + i, prose(rng, 30)) for i in range(60)]
    pairs = [(1, prose(rng, 50) + " " + copied), (2, prose(rng, 90)), (3, items[-1][1])]
    table = spark.createDataFrame(items, "item_id long, text string").repartition(5)
    got = sorted(((r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in leaks(documents(pairs), table).collect()), key=str)
    assert got == brute(pairs, list(dict.fromkeys(items)))
    assert [r.doc_id for r in decontaminated(documents(pairs), table).collect()] == [2]
    sets, _ = decontaminate._sets(table, 5)
    weights = [sum(len(s) for _, s in block) for block in decontaminate._blocks(sets)]
    assert sum(weights) == 36 + 60 * 26 and max(weights) <= 400


def test_no_rows(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks(documents([(1, "a b c d e f")]), none).count() == 0
    assert decontaminated(documents([(1, "a b c d e f")]), none).count() == 1
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert leaks(documents([]), some).count() == 0
