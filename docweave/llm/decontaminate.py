"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Test items are partitioned by the size of their shingle sets, each partition reaching up to
``RATIO`` times its smallest size. For a partition whose largest item has u shingles, a
document is searched as windows of two strides, a stride being 1.25 u shingles, so that a
passage of an item's length lies whole in some window and window and item sizes are in a
known proportion. A containment of ``t`` in a window then means a Jaccard similarity of at
least ``t l / (w + (1 - t) l)``, l being the smallest item and w the window: at least 0.21 for
t = 0.8. Window and item are a candidate pair if any of ``PERMUTATIONS`` MinHash values
agree, which misses such a pair with a chance of at most about one in 100 000, whatever the
item's size. Each candidate is verified by counting the item's shingles in the document's whole set.

Strides are multiples of a unit of 1, 2, 4 or 8 shingles, whose minima are shared by partitions.
Rounding never takes a window beyond ``2.5 RATIO`` times the smallest item: a partition ends where
it would, and if that leaves out its smallest size, the unit is a smaller one. By that bound (1 less the
similarity, to the power ``PERMUTATIONS``), with the widest window that a size can meet, a whole copy of an item
of 1 or 2 shingles is missed with a chance of 4e-15, of 3 2e-10, of 4 4e-9, of 5 2e-8;
one with 0.8 of its shingles left, of 5 or more, with one of 1e-5 at most.

Only items travel, items of equal shingles as one: in blocks of a bounded number of shingles, one
pass over the documents per block. Documents are never shuffled; what was found is joined with the items' ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.tables import bounded_batches, doc_id, identity, stored
from docweave.llm.words import all_shingles, distinct, letters_and_digits, randoms, words

#: Largest item over smallest in a partition.
RATIO = math.sqrt(2)
PERMUTATIONS = 48
#: Shingles of items that are broadcast at once; more items are taken in more passes.
BLOCK_SHINGLES = 1 << 20
#: Shingles whose minima are computed once for all partitions: as many as the sizes of a partition allow.
_UNITS = (8, 4, 2, 1)


def _item_sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = []
            for part in words(batch.column("text"), letters_and_digits()):
                values, bounds = all_shingles(part, size)
                members += [distinct(values[bounds[i] : bounds[i + 1]]).view(np.int64) for i in range(len(bounds) - 1)]
            yield pa.record_batch([batch.column("item_id"), pa.array(members, pa.list_(pa.int64()))], names=["item_id", "members"])

    return sets


def _sets(items: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The distinct sets of items with at least one shingle (``set_id``, ``members``), and which items have them (``item_id``, ``set_id``)."""
    bounded_batches(items.sparkSession)
    rows = stored(
        items.select("item_id", "text").mapInArrow(_item_sets(size), "item_id long, members array<long>")
        .filter(F.size("members") > 0).dropDuplicates()
    )
    sets = stored(rows.select("members").distinct().select(F.monotonically_increasing_id().alias("set_id"), "members"))
    return sets, rows.join(sets, "members").select("item_id", "set_id")


def _blocks(sets: DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The sets, a bounded number of shingles at a time."""
    total = sets.agg(F.coalesce(F.sum(F.size("members")), F.lit(0))).first()[0]
    # Consecutive classes of a hash make a block until it is full.
    count = -(-total // BLOCK_SHINGLES)
    part = F.pmod(F.xxhash64("set_id"), F.lit(count * 16 if count > 1 else 1))
    ends, room = [], 0
    for r in sets.groupBy(part.alias("part")).agg(F.sum(F.size("members")).alias("n")).orderBy("part").collect():
        if not ends or r["n"] > room:
            ends.append([r["part"], r["part"]])
            room = BLOCK_SHINGLES
        ends[-1][1] = r["part"]
        room -= r["n"]
    for low, high in ends:
        rows = sets.filter(part.between(low, high)).collect()
        yield [(r.set_id, np.array(r.members, np.int64).view(np.uint64)) for r in rows]


def partition_from(least: int) -> tuple[int, int]:
    """The unit of strides and the largest size of the partition whose smallest items have ``least`` shingles."""
    for unit in _UNITS:
        stride = int(1.25 * RATIO * least) // unit * unit  # the longest that is allowed
        largest = min(-(-4 * (stride + 1) // 5) - 1, int(RATIO * least))  # int(1.25 largest) <= stride
        if largest >= least:
            return unit, largest
    raise ValueError("an item without shingles")


class Index:
    """MinHash values of items by size partition."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.ids = [i for i, _ in items]
        self.sets = [s for _, s in items]
        self.factors = randoms(PERMUTATIONS, seed=9)
        self.partitions = []
        sizes = np.array([len(s) for s in self.sets])
        order = np.argsort(sizes, kind="stable")
        while len(order):
            unit, largest = partition_from(int(sizes[order[0]]))
            here = order[sizes[order] <= largest]
            order = order[len(here) :]
            stride = -(-int(1.25 * sizes[here].max()) // unit)
            least = np.array([[(self.sets[i] * f).min() for i in here] for f in self.factors])
            by = np.argsort(least, axis=1)
            self.partitions.append((unit, stride, here[by], np.take_along_axis(least, by, axis=1)))

    def candidates(self, values: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) pairs of which some window agrees with the item in some MinHash value."""
        counts = np.diff(bounds)
        if not counts.any():
            return set()
        cuts = []
        for unit in _UNITS:
            steps = -(-counts // unit)
            total = int(steps.sum())
            first = np.cumsum(steps) - steps
            begin = np.repeat(bounds[:-1] - first * unit, steps) + np.arange(total) * unit
            # Where the strides of each partition begin among the steps, their rows, and which have another of the row after them.
            strides = []
            for own, stride, items, least in self.partitions:
                if own != unit:
                    continue
                runs = -(-steps // stride)
                start = np.cumsum(runs) - runs
                at = np.repeat(first - start * stride, runs) + np.arange(int(runs.sum())) * stride
                row = np.repeat(np.arange(len(runs)), runs)
                strides.append((items, least, at, row, np.append(row[1:] == row[:-1], False)))
            if strides:
                cuts.append((begin, strides))
        found: set[tuple[int, int]] = set()
        for k, factor in enumerate(self.factors):
            hashes = values * factor
            for begin, strides in cuts:
                minima = np.minimum.reduceat(hashes, begin)
                for items, least, at, row, follows in strides:
                    run = np.minimum.reduceat(minima, at)
                    window = np.where(follows, np.minimum(run, np.append(run[1:], run[-1:])), run)
                    left = np.searchsorted(least[k], window)
                    hit = np.flatnonzero(least[k][np.minimum(left, len(items[k]) - 1)] == window)
                    for w in hit:
                        j = left[w]
                        while j < len(items[k]) and least[k][j] == window[w]:
                            found.add((int(row[w]), int(items[k][j])))
                            j += 1
        return found

    def matches(self, column: pa.Array, size: int, t: Fraction) -> Iterator[tuple[int, int, int, int]]:
        """(row, item id, shared shingles, item's shingles) of each item contained in a row's text."""
        for part in words(column, letters_and_digits()):
            values, bounds = all_shingles(part, size)
            for row, item in sorted(self.candidates(values, bounds)):
                members = self.sets[item]
                shared = int(np.isin(members, values[bounds[row] : bounds[row + 1]]).sum())
                if shared * t.denominator >= len(members) * t.numerator:
                    yield part.first + row, self.ids[item], shared, len(members)


def leaks(docs: DataFrame, items: DataFrame, size: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shared``, ``n_shingles``, ``containment``: items that documents contain.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``; other columns are not read. Words are
    runs of letters, digits and non-ASCII characters, A-Z taken as a-z. An item is contained if at
    least ``threshold`` of its distinct shingles are in the document. Null and empty texts and those
    of fewer than ``size`` words have no shingles: such an item is found nowhere, such a
    document holds none. A pair is returned once per document row; repeated rows of an item count once;
    null ids stay null.
    """
    spark = docs.sparkSession
    texts = docs.select(*identity(), "text")
    found = None
    sets, owners = _sets(items, size)
    for block in _blocks(sets):
        shared = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for batch in batches:
                hits = list(index.matches(batch.column("text"), size, threshold))
                yield pa.record_batch(
                    [
                        batch.column("id").take(pa.array([h[0] for h in hits], pa.int64())),
                        *(pa.array([h[k] for h in hits], pa.int64()) for k in (1, 2, 3)),
                    ],
                    names=["id", "set_id", "n_shared", "n_shingles"],
                )

        part = texts.select("id", "text").mapInArrow(search, "id long, set_id long, n_shared long, n_shingles long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "id long, set_id long, n_shared long, n_shingles long")
    return found.join(owners, "set_id").select(
        doc_id(), "item_id", "n_shared", "n_shingles", (F.col("n_shared") / F.col("n_shingles")).alias("containment")
    )


def decontaminated(docs: DataFrame, items: DataFrame, size: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """``docs`` without the documents that contain an item; all columns, no shuffle."""
    spark = docs.sparkSession
    schema = docs.schema
    for block in _blocks(_sets(items, size)[0]):
        shared = spark.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                text = batch.column(batch.schema.get_field_index("text"))
                keep[[h[0] for h in index.matches(text, size, threshold)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, schema)
    return docs


#: Words as DuckDB sees them: lower-case ASCII letters, digits, and characters beyond ASCII.
SQL = """
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\\x{80}-\\x{10FFFF}]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\\x{80}-\\x{10FFFF}]+') FROM benchmark
), spots AS (SELECT side, id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5),
s AS (SELECT DISTINCT side, id, array_to_string(w[i:i + 4], ' ') AS g FROM spots),
n AS (SELECT id, count(*) AS n_shingles FROM s WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*)::BIGINT AS n_shared, n.n_shingles::BIGINT AS n_shingles,
       count(*) / n.n_shingles AS containment
FROM s d JOIN s i ON d.g = i.g JOIN n ON n.id = i.id
WHERE d.side = 'd' AND i.side = 'i'
GROUP BY d.id, i.id, n.n_shingles HAVING 10 * count(*) >= 8 * n.n_shingles
"""
