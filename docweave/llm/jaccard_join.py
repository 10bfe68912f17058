"""N-gram Jaccard join: a blocked sparse product of the document by shingle incidence matrix.

Documents with the same shingle set are one *class*. The product of the incidence
matrix with its transpose would hold every overlap; size-derived bounds leave only a
small part of it to compute. Under a fixed order of shingles, classes x and y with
``|x| <= |y|`` and similarity ``t`` share one of the first
``|x| - ceil(2t/(1+t) |x|) + 1`` shingles of x and ``|y| - ceil(t |y|) + 1`` of y, so
only those *prefix* cells enter, blocked by shingle. Shingles that are frequent in
some block of the corpus come last in the order, so prefixes hold rare ones.

Cells are multiplied in blocks of shingles and the products summed per pair. All common
cells of two prefixes being counted, what lies beyond the shorter-reaching prefix bounds
the rest of the overlap, and a pair that cannot reach the bound on its sizes is discarded.
Only the overlap of what remains is counted in full, on the whole sets.

A shingle with many classes would give the square of their number, so its cells are not
multiplied outright; their number per class only widens the bound. Instead

1. every class of such a group is paired with the group's *pivot*, the class with the fewest
   rarer shingles, that is, the least edited one;
2. what is not in the pivot's component then is paired with the rest of the group.

So a group of near copies gives rows in proportion to its size. Links inside one
component that neither step looks at cannot change the components.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.filters import bitmap, let_through
from docweave.llm.tables import bounded_batches, components, doc_id, identity, stored
from docweave.llm.words import distinct, mixed, shingles, space_separated, words
from docweave.operators.running import checkpointed

#: Shingles of the corpus counted together when looking for frequent ones.
BLOCK_SHINGLES = 1 << 21
#: Frequent shingles that are put last, at most; a bound on the broadcast (16 bytes each), not on the result.
FREQUENT = 1 << 19
#: Tasks over which the cells of a frequent shingle are dealt.
SALTS = 32
#: Documents with a shingle in their prefix from which on it is put behind rarer ones.
COMMON = 8
#: Classes of a shingle that are paired outright; larger groups go by way of their pivot.
PAIRED = 16


def class_key(members: np.ndarray) -> np.uint64:
    """One number for a sorted set; sets are told apart by it."""
    place = np.arange(len(members), dtype=np.uint64)
    return mixed(np.array([np.add.reduce(mixed(members ^ mixed(place)))]) + np.uint64(len(members)))[0]


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    for part in words(column, space_separated()):
        for row, hashes in part.rows():
            yield row, distinct(shingles(hashes, size))


def _scan(size: int):
    """A row per document (class, set size), and rows of shingles that are frequent in a block."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, known = [], 0, set()

        def frequent():
            nonlocal block, held, known
            values = np.sort(np.concatenate(block))
            first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
            counts = np.diff(np.append(first, len(values)))
            often = counts >= max(2, held * 3 // BLOCK_SHINGLES)
            n = int(often.sum())
            block, held, known = [], 0, set()
            none = pa.nulls(n, pa.int64())
            return pa.record_batch(
                [none, none, pa.array(values[first[often]].view(np.int64)), pa.array(counts[often]), pa.array(np.ones(n, bool))],
                names=["id", "twin", "key", "n", "is_shingle"],
            )

        for batch in batches:
            keys = np.zeros(batch.num_rows, np.uint64)
            sizes = np.zeros(batch.num_rows, np.int64)
            for row, members in _sets(batch.column("text"), size):
                sizes[row] = len(members)
                if not len(members):
                    continue
                keys[row] = class_key(members)
                if keys[row] not in known:
                    known.add(keys[row])
                    block.append(members)
                    held += len(members)
                if held >= BLOCK_SHINGLES:
                    yield frequent()
            yield pa.record_batch(
                [batch.column("id"), batch.column("twin"), pa.array(keys.view(np.int64)), pa.array(sizes), pa.array(np.zeros(len(keys), bool))],
                names=["id", "twin", "key", "n", "is_shingle"],
            )
        if block:
            yield frequent()

    return scan


def _prefixes(size: int, t: Fraction, shared, common=None):
    """The prefix cells of each class: shingle, class, set size, place, whether the shingle is frequent, and how many are.

    Without the filter of ``common`` shingles, only the shingles, to find these.
    """

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, rank = (np.frombuffer(x, np.int64) for x in shared.value)
        listed = listed.view(np.uint64)
        bits = None if common is None else np.frombuffer(common.value, np.uint8)
        known: set[int] = set()
        for batch in batches:
            out = [[], [], [], [], [], []]
            for _, members in _sets(batch.column("text"), size):
                n = len(members)
                key = class_key(members) if n else 0
                if not n or key in known:
                    continue
                known.add(key)
                if len(listed):
                    at = np.minimum(np.searchsorted(listed, members), len(listed) - 1)
                    often = listed[at] == members
                    last = members[often][np.argsort(rank[at[often]])]
                    members = members[~often]
                else:
                    last = members[:0]
                if bits is not None:
                    behind = let_through(bits, members.view(np.int64))
                    members = np.concatenate([members[~behind], members[behind]])
                members = np.concatenate([members, last])
                rare = n - len(last)
                p = n + (-n * t.numerator // t.denominator) + 1  # n - ceil(t n) + 1
                if bits is None:
                    out[0].append(members[: p + p // 2])  # what comes into the prefixes once common ones are put behind counts too
                    continue
                out[0].append(members[:p])
                out[1].append(np.full(p, key, np.uint64))
                out[2].append(np.full(p, n, np.int32))
                out[3].append(np.arange(p, dtype=np.int32))
                out[4].append(np.arange(p) >= rare)
                out[5].append(np.full(p, max(p - rare, 0), np.int32))
            if out[0] and bits is None:
                yield pa.record_batch([pa.array(np.concatenate(out[0]).view(np.int64))], names=["shingle"])
            elif out[0]:
                columns = [np.concatenate(x) for x in out]
                yield pa.record_batch(
                    [pa.array(columns[0].view(np.int64)), pa.array(columns[1].view(np.int64)), *map(pa.array, columns[2:])],
                    names=["shingle", "key", "n", "place", "often", "wide"],
                )

    return prefixes


def _least_overlap(n_a, n_b, t: Fraction):
    """The smallest overlap of similar sets of these sizes."""
    return -(-(n_a + n_b) * t.numerator // (t.numerator + t.denominator))


_PRODUCTS = (
    "shingle long, a long, b long, n_a int, n_b int, wide_a int, wide_b int, place_a int, place_b int, often boolean"
)
_PRODUCT_COLUMNS = [c.split()[0] for c in _PRODUCTS.split(", ")]


def _products(t: Fraction):
    """Of cells sorted by shingle and class: the pairs of small groups, and the cells of large ones (``b`` null).

    Each cell counts once. A pair is left out where sizes or places alone rule it out.
    """

    def out(cells: pa.Table, pairs: bool) -> Iterator[pa.RecordBatch]:
        column = {c: cells[c].to_numpy() for c in cells.column_names}
        shingle = column["shingle"]
        if not pairs:
            none, nothing = pa.nulls(len(shingle), pa.int64()), pa.nulls(len(shingle), pa.int32())
            yield pa.record_batch(
                [cells["shingle"].combine_chunks(), cells["key"].combine_chunks(), none, cells["n"].combine_chunks(), nothing,
                 cells["wide"].combine_chunks(), nothing, cells["place"].combine_chunks(), nothing, cells["often"].combine_chunks()],
                names=_PRODUCT_COLUMNS,
            )
            return
        for d in range(1, PAIRED):
            x = np.flatnonzero(shingle[d:] == shingle[:-d])
            if not len(x):
                return
            y = x + d
            n_x, n_y = column["n"][x].astype(np.int64), column["n"][y].astype(np.int64)
            at_x, at_y = column["place"][x], column["place"][y]
            most = np.minimum(at_x, at_y) + np.minimum(n_x - at_x, n_y - at_y)
            fit = (np.minimum(n_x, n_y) * t.denominator >= np.maximum(n_x, n_y) * t.numerator) & (most >= _least_overlap(n_x, n_y, t))
            x, y = x[fit], y[fit]
            none = pa.nulls(len(x), pa.int64())
            yield pa.record_batch(
                [none, *(pa.array(column[c][i]) for c in ("key", "n", "wide", "place") for i in (x, y)), pa.nulls(len(x), pa.bool_())],
                names=_PRODUCT_COLUMNS,
            )

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, large = None, False  # cells of the last group, and whether cells of it have gone out as a large one's
        for batch in itertools.chain(batches, [None]):
            rows = held if batch is None else pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            if rows is None or not rows.num_rows:
                continue
            shingle, key = rows["shingle"].to_numpy(), rows["key"].to_numpy()
            rows = rows.filter(pa.array(np.append(True, (shingle[1:] != shingle[:-1]) | (key[1:] != key[:-1]))))
            shingle, often = rows["shingle"].to_numpy(), rows["often"].to_numpy()
            first = np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1]))
            size = np.diff(np.append(first, len(shingle)))
            big = (size > PAIRED) | often[first]
            big[0] |= large
            # The last group may go on: it is held, but for cells of a large one, of which the last cell stays.
            keep = np.repeat(big, size)
            small = np.repeat(~big & (size > 1), size)
            hold = 0
            if batch is not None:
                hold = 1 if big[-1] else int(size[-1])
                keep[len(keep) - hold :] = small[len(small) - hold :] = False
            if keep.any():
                yield from out(rows.filter(pa.array(keep)), pairs=False)
            if small.any():
                yield from out(rows.filter(pa.array(small)), pairs=True)
            held, large = rows.slice(len(shingle) - hold).combine_chunks(), bool(big[-1])

    return products


def _members(size: int, shared):
    """The whole set of each class that the bitmap lets through."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        known: set[int] = set()
        for batch in batches:
            sets, keys = [], []
            for _, s in _sets(batch.column("text"), size):
                key = class_key(s).view(np.int64) if len(s) else 0
                if len(s) and key not in known and let_through(bits, key):
                    known.add(key)
                    sets.append(s)
                    keys.append(int(key))
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.record_batch(
                [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(values))],
                names=["key", "members"],
            )

    return members


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The full overlap of each pair of sets."""
    for batch in batches:
        counts = np.zeros(batch.num_rows, np.int64)
        left, right = batch.column("members_a"), batch.column("members_b")
        for i in range(batch.num_rows):
            a, b = left[i].values.to_numpy(), right[i].values.to_numpy()
            a, b = (a, b) if len(a) < len(b) else (b, a)
            a, b = a.view(np.uint64), b.view(np.uint64)
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            counts[i] = int((b[at] == a).sum())
        yield pa.record_batch([batch.column("a"), batch.column("b"), batch.column("n_a"), batch.column("n_b"), pa.array(counts)], names=["a", "b", "n_a", "n_b", "overlap"])


def jaccard_classes(docs: DataFrame, size: int = 5, threshold: Fraction = Fraction(4, 5)) -> tuple[DataFrame, DataFrame]:
    """Shingle classes of the documents, and links that connect similar classes.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Words are runs of bytes
    other than space and 0x09 to 0x0D, A-Z taken as a-z. A text of fewer than ``size``
    words has one shingle, all its words; a null text or one without words has none.

    Returns (``id``, ``twin``, ``key``, ``n``), a row per document, key 0 for an empty set, and
    (``a``, ``b``, ``overlap``): pairs of keys whose similarity reaches ``threshold``, enough
    of them that their components are those of all such pairs.
    """
    spark = bounded_batches(docs.sparkSession)
    t = threshold
    texts = docs.select(*identity(), "text")
    scanned = stored(texts.mapInArrow(_scan(size), "id long, twin long, key long, n long, is_shingle boolean"))
    rows = scanned.filter(~F.col("is_shingle")).drop("is_shingle")

    frequent = (
        scanned.filter("is_shingle").groupBy("key").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "key").limit(FREQUENT).select("key").toArrow()
    )  # at most FREQUENT rows
    listed = frequent["key"].to_numpy().view(np.uint64)
    order = np.argsort(listed)
    # Rarer ones come first; rank 0 is the rarest of the list.
    rank = (len(listed) - 1 - np.arange(len(listed)))[order]
    shared = spark.sparkContext.broadcast((listed[order].tobytes(), rank.astype(np.int64).tobytes()))

    counted = texts.select("text").mapInArrow(_prefixes(size, t, shared), "shingle long").groupBy(F.col("shingle").alias("key"))
    common = spark.sparkContext.broadcast(bitmap(counted.count().filter(F.col("count") > COMMON)).tobytes())
    cells = texts.select("text").mapInArrow(
        _prefixes(size, t, shared, common), "shingle long, key long, n int, place int, often boolean, wide int"
    )
    # One pass and one shuffle; the cells of frequent shingles, which are kept as they are, are dealt out.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.col("often"), F.pmod("key", F.lit(SALTS))).otherwise(F.lit(0))
    multiplied = stored(
        cells.repartition(parts, "shingle", salt).sortWithinPartitions("shingle", "key").mapInArrow(_products(t), _PRODUCTS)
    )
    # Classes with cells in large groups of shingles that are not listed as frequent.
    wider = multiplied.filter("b IS NULL AND NOT often").groupBy(F.col("a").alias("key")).agg(F.count(F.lit(1)).cast("int").alias("wider"))
    cells = multiplied.filter("b IS NULL").select(
        "shingle", F.col("a").alias("key"), F.col("n_a").alias("n"), F.col("place_a").alias("place"), F.col("wide_a").alias("wide")
    )
    cells = cells.join(wider, "key", "left").withColumn("wide", F.col("wide") + F.coalesce("wider", F.lit(0))).drop("wider")
    pivots = cells.groupBy("shingle").agg(
        F.min(F.struct((F.col("place") / F.col("n")).alias("part"), "key", "n", "wide")).alias("pivot")
    )
    starred = cells.join(pivots, "shingle").filter(F.col("key") != F.col("pivot.key")).select(
        F.col("pivot.key").alias("a"), F.col("key").alias("b"), F.col("pivot.n").alias("n_a"), F.col("n").alias("n_b"),
        F.col("pivot.wide").alias("wide_a"), F.col("wide").alias("wide_b"),
    ).filter(_can_reach(F.lit(0), t))

    both = ("n_a", "n_b", "wide_a", "wide_b")
    summed = multiplied.filter("b IS NOT NULL").groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("overlap"), *(F.first(c).alias(c) for c in both),
        *(f(f"place_{x}").alias(f"{name}_{x}") for f, name in ((F.min, "first"), (F.max, "last")) for x in "ab"),
    )
    for side in "ab":
        more = wider.select(F.col("key").alias(side), F.col("wider").alias(f"wider_{side}"))
        summed = summed.join(more, side, "left").fillna(0, [f"wider_{side}"]).withColumn(f"wide_{side}", F.col(f"wide_{side}") + F.col(f"wider_{side}"))
    # What is not counted before the last common cell lies in those large groups; after it, the shorter remainder is left.
    unseen = F.least("wider_a", "wider_b")
    after = F.least(F.col("n_a") - F.col("last_a"), F.col("n_b") - F.col("last_b")) - 1
    summed = summed.filter(
        _can_reach(F.col("overlap"), t)
        & (F.col("overlap") + unseen + after >= _needed(t))
        & ((unseen > 0) | _may_be_first(F.col("first_a"), F.col("first_b"), t))
    )
    pairs = stored(_ordered(summed).unionByName(_ordered(starred)).distinct())

    wanted = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).unionByName(cells.select("key"))
    filtering = spark.sparkContext.broadcast(bitmap(wanted).tobytes())
    sets = stored(
        texts.select("text").mapInArrow(_members(size, filtering), "key long, members array<long>").dropDuplicates(["key"])
    )
    first = _verified(pairs, sets, t)

    roots = components(first)
    labelled = cells.join(roots, cells["key"] == roots["node"], "left").withColumn("root", F.coalesce("root", "key")).drop("node")
    heads = roots.select(F.col("node").alias("pivot_key"), F.col("root").alias("pivot_root"))
    heads = (
        pivots.select("shingle", F.col("pivot.key").alias("pivot_key")).join(heads, "pivot_key", "left")
        .select("shingle", F.coalesce("pivot_root", "pivot_key").alias("pivot_root"))
    )
    names = ("key", "n", "wide", "place", "root")
    rest = (
        labelled.join(heads, "shingle").filter(F.col("root") != F.col("pivot_root"))
        .select("shingle", "pivot_root", *(F.col(c).alias(f"{c}_a") for c in names))
    )
    other = labelled.select("shingle", *(F.col(c).alias(f"{c}_b") for c in names))
    crossed = rest.join(other, "shingle").filter(
        (F.col("root_a") != F.col("root_b"))
        # Two classes outside the pivot's component meet once only.
        & ((F.col("root_b") == F.col("pivot_root")) | (F.col("key_a") < F.col("key_b")))
        # Pairs with a common cell in a small group were judged above: here the first common one is in a large group.
        & _can_reach(F.lit(0), t) & _may_be_first(F.col("place_a"), F.col("place_b"), t)
    ).withColumnsRenamed({"key_a": "a", "key_b": "b"})
    second = _verified(_ordered(crossed).distinct(), sets, t)
    return rows, first.unionByName(second)


def _needed(t: Fraction) -> Column:
    """The smallest overlap of similar sets of sizes ``n_a`` and ``n_b``."""
    return F.ceil((F.col("n_a") + F.col("n_b")) * t.numerator / (t.numerator + t.denominator))


def _may_be_first(place_a: Column, place_b: Column, t: Fraction) -> Column:
    """Whether the first common shingle of similar sets can be at these places: enough must follow."""
    return F.least(F.col("n_a") - place_a, F.col("n_b") - place_b) >= _needed(t)


def _can_reach(overlap: Column, t: Fraction) -> Column:
    """Whether sets of sizes ``n_a`` and ``n_b`` can be similar.

    ``overlap`` counts what their prefixes have in common, but for frequent shingles, of which they have
    ``wide_a`` and ``wide_b`` there. Beyond the prefix that reaches less far, ``ceil(t n) - 1`` are left.
    """
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    left = F.ceil(large * t.numerator / t.denominator) - 1
    most = overlap + F.least("wide_a", "wide_b") + left
    return (small * t.denominator >= large * t.numerator) & (
        most * (t.numerator + t.denominator) >= (F.col("n_a") + F.col("n_b")) * t.numerator
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    swap = F.col("a") > F.col("b")
    return pairs.select(
        *(F.when(swap, F.col(f"{c}b")).otherwise(F.col(f"{c}a")).alias(f"{c}a") for c in ("", "n_")),
        *(F.when(swap, F.col(f"{c}a")).otherwise(F.col(f"{c}b")).alias(f"{c}b") for c in ("", "n_")),
    )


def _verified(pairs: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """The pairs whose whole sets are similar."""
    left = sets.select(F.col("key").alias("a"), F.col("members").alias("members_a"))
    right = sets.select(F.col("key").alias("b"), F.col("members").alias("members_b"))
    counted = pairs.join(left, "a").join(right, "b").mapInArrow(_overlaps, "a long, b long, n_a int, n_b int, overlap long")
    similar = F.col("overlap") * t.denominator >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * t.numerator
    return checkpointed(counted.filter(similar).select("a", "b", "overlap"))


def _judged(docs: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """``id``, ``twin``, ``key``, ``n``, and for sets that are not empty ``root`` and ``smallest`` of the component."""
    rows, links = jaccard_classes(docs, size, threshold)
    roots = components(links)
    classes = rows.filter("n > 0").groupBy("key").agg(F.min("id").alias("smallest"))
    rooted = classes.join(roots, classes["key"] == roots["node"], "left").select(
        "key", "smallest", F.coalesce("root", "key").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("smallest").alias("smallest"))
    named = rooted.select("key", "root").join(smallest, "root")
    return rows.filter("n > 0").join(named, "key").unionByName(rows.filter("n = 0"), allowMissingColumns=True)


def jaccard_join(docs: DataFrame, size: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` and ``class_key``.

    ``component_id`` is the smallest ``doc_id`` that is reachable by links, the document's own
    included; an empty set links with nothing. Rows that repeat an id and text share their
    result; rows of one id with other texts are judged apart; a null id takes part and
    is the component's id only if it has no other. No rows give no rows.
    """
    return _judged(docs, size, threshold).select(
        doc_id(), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, doc_id("smallest")).otherwise(doc_id()).alias("component_id"),
        F.col("key").alias("class_key"),
    )


def one_of_each(docs: DataFrame, size: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """Keeps one document of each component, that with the smallest id; documents without words all stay.

    All columns of ``docs`` come back. Of rows that repeat an id and text one stays, of texts
    under one id that with the smallest hash; a null id stays only where a component has no other.
    """
    judged = _judged(docs, size, threshold)
    first = judged.filter("n > 0").groupBy("root").agg(F.min(F.struct("id", "twin")).alias("doc")).select("doc.*")
    stay = first.unionByName(judged.filter("n = 0").select("id", "twin").distinct())
    stay = stay.select(F.col("id").alias("__id"), F.col("twin").alias("__twin"))
    number, text_hash = identity()
    return (
        docs.withColumns({"__id": number, "__twin": text_hash})
        .join(stay, ["__id", "__twin"], "left_semi")
        .dropDuplicates(["__id", "__twin"])
        .drop("__id", "__twin")
    )
