"""Approximate nearest neighbours by cosine: stable projections indexed by kd-trees.

Vectors are scaled to length one, where the largest cosine is the smallest distance, and projected
with independent standard normal numbers to ``DIMENSIONS`` dimensions. The square of a projected
distance is then the true one's square times a chi-square variable of so many degrees of freedom.
A search takes projected neighbours in order of distance and verifies each on the whole
vectors. It stops at projected distance r if ``chi2(r^2 / d^2) >= CONFIDENCE``, d being the distance of the
worst of the k best so far: a vector as near as that would have come before r with that
chance.

A coarse kd-tree, fitted on a bounded sample, deals all vectors to cells, and cells of many rows are
dealt on to blocks; each block has a kd-tree of its own. A query first searches its own
cell. The distance found there tells which other cells the stopping test leaves to visit.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.llm.tables import stored

DIMENSIONS = 8
CONFIDENCE = 0.98
#: Vectors that the coarse tree is fitted on, at most about; all vectors are indexed.
SAMPLE = 1 << 14
#: Rows of a cell, about, and cells at most; the cells' boxes are broadcast.
CELL_ROWS, MAX_CELLS = 512, 4096
#: Rows of a block, about: what a task holds at once.
BLOCK_ROWS = 1024
LEAF_ROWS = 128
#: Rounding of projected distances.
_NEAR = 1e-9


def chi_square_quantile(p: float, degrees: int) -> float:
    """Where the chi-square distribution function reaches ``p``; ``degrees`` is even."""

    def reached(x: float) -> float:
        term, total = 1.0, 1.0
        for j in range(1, degrees // 2):
            term *= x / 2 / j
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if reached(middle) < p else (low, middle)
    return high


class Tree:
    """A kd-tree over points: leaves of few rows, each node with the box around its points."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.points = points
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        self.nodes: list[tuple[int, int] | np.ndarray] = []
        self.splits: list[tuple[int, float] | None] = []
        if len(points):
            self._build(np.arange(len(points)), leaf_rows)
            self.low, self.high = (np.array(side) for side in zip(*self.boxes, strict=True))

    def _build(self, rows: np.ndarray, leaf_rows: int) -> int:
        here = len(self.nodes)
        points = self.points[rows]
        low, high = points.min(axis=0), points.max(axis=0)
        self.boxes.append((low, high))
        self.nodes.append(rows)
        self.splits.append(None)
        axis = int(np.argmax(high - low))
        if len(rows) <= leaf_rows or high[axis] <= low[axis]:
            return here
        values = points[:, axis]
        cut = float(np.partition(values, len(rows) // 2)[len(rows) // 2])
        left = values < cut
        if not left.any():  # many points at the smallest value
            cut = float(values[values > low[axis]].min())
            left = values < cut
        self.splits[here] = (axis, cut)
        self.nodes[here] = (self._build(rows[left], leaf_rows), self._build(rows[~left], leaf_rows))
        return here

    def distances(self, point: np.ndarray) -> list[float]:
        """Squared distances of a point to the boxes of all nodes."""
        away = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (away * away).sum(axis=1).tolist()

    def incremental(self, point: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """Leaves in order of their boxes' squared distance: (distance, rows)."""
        if not self.nodes:
            return
        away = self.distances(point)
        heap = [(away[0], 0)]
        while heap:
            distance, node = heapq.heappop(heap)
            found = self.nodes[node]
            if isinstance(found, tuple):
                for child in found:
                    heapq.heappush(heap, (away[child], child))
            else:
                yield distance, found

    def cells(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point falls to, numbered from 0."""
        leaves = {node: k for k, node in enumerate(i for i, s in enumerate(self.splits) if s is None)}
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            split = self.splits[node]
            if split is None:
                out[rows] = leaves[node]
                continue
            left = points[rows, split[0]] < split[1]
            todo += [(self.nodes[node][0], rows[left]), (self.nodes[node][1], rows[~left])]
        return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(len(column), width)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Of each vector, after scaling by its largest component, which this returns too."""
    return np.sqrt((vectors * vectors).sum(axis=1))


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Very large or small components are brought near one first, so that squares stay finite.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / _lengths(vectors)[:, None]


class Search:
    """The k best vectors of a block for one query after another."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projection: np.ndarray, k: int):
        self.ids, self.unit, self.k = ids, _unit(vectors), k
        self.points = self.unit @ projection
        self.tree = Tree(self.points)
        self.reach = chi_square_quantile(CONFIDENCE, projection.shape[1])

    def best(self, own: int, unit: np.ndarray, point: np.ndarray, worst: float) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and cosines of the best, the query's own id left out; ``worst``: the cosine to beat so far."""
        rows, scores = np.zeros(0, np.int64), np.zeros(0)
        limit = self._limit(worst)
        for away, leaf in self.tree.incremental(point):
            if away > limit:  # the stopping test holds for all that is left
                break
            apart = self.points[leaf] - point
            leaf = leaf[((apart * apart).sum(axis=1) <= limit) & (self.ids[leaf] != own)]
            found = (self.unit[leaf] * unit).sum(axis=1)
            # What is behind the k best so far cannot be among them; equal ones may be, by their ids.
            good = found >= worst
            if not good.any():
                continue
            rows, scores = np.append(rows, leaf[good]), np.append(scores, found[good])
            if len(rows) >= self.k:
                order = np.lexsort((self.ids[rows], -scores))[: self.k]
                rows, scores = rows[order], scores[order]
                worst = max(worst, float(scores[-1]))
                limit = min(limit, self._limit(worst))
        return rows, scores

    def _limit(self, cosine: float) -> float:
        return self.reach * max(0.0, 2 - 2 * cosine) + _NEAR if cosine > -2 else math.inf


def usable(vectors: DataFrame) -> DataFrame:
    """``id`` and ``vec`` of the rows that take part: an id, and finite components that aren't all zero."""
    whole = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.filter(F.col("id").isNotNull() & (F.size("vec") > 0) & whole & F.exists("vec", lambda x: x != 0))
        .groupBy("id").agg(F.min("vec").alias("vec"))
    )


def nearest(vectors: DataFrame, is_query, k: int = 5, seed: int = 7) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k nearest found of each query, nearest first.

    ``vectors`` has ``id`` and ``vec``; ``is_query`` is a condition on ``id``. Candidates of a query are all other ids;
    with fewer than k of them all are returned. ``score`` is the cosine in double precision, ties
    go to the smaller id. Null ids, and vectors that are null, empty, zero or hold null or non-finite
    components, take no part, nor do those whose length isn't the most frequent one (the
    smaller on ties). An id that occurs more than once has the smallest of its vectors. No rows give no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    all_rows = usable(vectors)
    sizes = all_rows.groupBy(F.size("vec").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "width").first()
    if most is None:
        return spark.createDataFrame([], schema)
    width, total = most["width"], most["n"]
    all_rows = all_rows.filter(F.size("vec") == width)
    projection = np.random.default_rng(seed).standard_normal((width, DIMENSIONS))

    part = int(min(1.0, SAMPLE / total) * (1 << 32))
    sample = all_rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) <= part).select("vec").toArrow()["vec"].combine_chunks()
    points = _unit(_matrix(sample, width)) @ projection
    cells = min(MAX_CELLS, -(-total // CELL_ROWS))
    coarse = Tree(points, max(1, -(-len(points) // cells)))
    shared = spark.sparkContext.broadcast((coarse.nodes, coarse.splits, projection))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, splits, projection = shared.value
        tree = Tree(np.zeros((0, 1)))
        tree.nodes, tree.splits = nodes, splits
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _unit(_matrix(batch.column("vec"), width)) @ projection
            cell = tree.cells(points) if nodes else np.zeros(len(points), np.int32)
            yield pa.record_batch(
                [*batch.columns, pa.array(list(points), pa.list_(pa.float64())), pa.array(cell)], names=["id", "vec", "point", "cell"]
            )

    dealt = stored(
        all_rows.select("id", F.col("vec").cast("array<double>").alias("vec"))
        .mapInArrow(deal, "id long, vec array<double>, point array<double>, cell int")
    )
    boxes = dealt.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"),
        *(f(F.col("point")[i]).alias(f"{name}{i}") for i in range(DIMENSIONS) for f, name in ((F.min, "low"), (F.max, "high"))),
    ).collect()  # at most MAX_CELLS rows
    number = np.array([b["cell"] for b in boxes], np.int32)
    blocks = np.array([-(-b["n"] // BLOCK_ROWS) for b in boxes], np.int64)
    low, high = (np.array([[b[f"{name}{i}"] for i in range(DIMENSIONS)] for b in boxes]) for name in ("low", "high"))
    table = spark.sparkContext.broadcast((number, blocks, low, high))
    reach = chi_square_quantile(CONFIDENCE, DIMENSIONS)

    def visits(home: bool):
        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, blocks, low, high = table.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                own = batch.column("cell").to_numpy()
                points = _matrix(batch.column("point"), DIMENSIONS)
                worst = batch.column("worst").to_numpy(zero_copy_only=False)
                for at in range(0, batch.num_rows, 256):
                    # Distances of some queries to all cells, one dimension after the other.
                    some = slice(at, at + 256)
                    if home:
                        go = own[some, None] == number
                    else:
                        away = np.zeros((len(own[some]), len(number)))
                        for i in range(DIMENSIONS):
                            x = points[some, i, None]
                            away += np.maximum(np.maximum(low[:, i] - x, x - high[:, i]), 0) ** 2
                        limit = np.where(worst[some] > -2, reach * np.maximum(0, 2 - 2 * worst[some]) + _NEAR, np.inf)
                        go = (away <= limit[:, None]) & (own[some, None] != number)
                    query, cell = np.nonzero(go)
                    times = blocks[cell]
                    query, cell = np.repeat(query, times), np.repeat(cell, times)
                    salt = np.arange(len(cell)) - np.repeat(np.cumsum(times) - times, times)
                    rows = batch.slice(at, 256).take(pa.array(query))
                    yield pa.record_batch(
                        [pa.array(number[cell]), pa.array(salt.astype(np.int32)), pa.array(np.ones(len(cell), np.int32)),
                         rows.column("id"), rows.column("vec"), rows.column("worst")],
                        names=["cell", "salt", "is_query", "id", "vec", "worst"],
                    )

        return choose

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection = shared.value[2]
        now, held, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(batch.column("cell").to_pylist(), batch.column("salt").to_pylist(), strict=True))
            asks = batch.column("is_query").to_numpy()
            ids, vecs = batch.column("id").to_numpy(), _matrix(batch.column("vec"), width)
            worst = batch.column("worst").to_numpy(zero_copy_only=False)
            found = []
            for i, key in enumerate(keys):
                if key != now:
                    now, held, block = key, [], None
                if not asks[i]:
                    held.append((ids[i], vecs[i]))
                    continue
                if block is None:
                    block = Search(
                        np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held]).reshape(len(held), width), projection, k
                    ) if held else None
                    held = [(0, None)] if held else []
                if block is None:
                    continue
                unit = _unit(vecs[i : i + 1])[0]
                rows, scores = block.best(int(ids[i]), unit, unit @ projection, float(worst[i]))
                found += [(int(ids[i]), int(block.ids[r]), float(s)) for r, s in zip(rows, scores, strict=True)]
            yield pa.record_batch(
                [pa.array([f[j] for f in found], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                names=["query_id", "vec_id", "score"],
            )

    count = F.create_map(*(F.lit(int(x)) for b in zip(number, blocks, strict=True) if b[1] > 1 for x in b)) if (blocks > 1).any() else None
    split = F.coalesce(count[F.col("cell")], F.lit(1)) if count is not None else F.lit(1)
    base = dealt.select(
        "cell", F.pmod(F.xxhash64("id"), split).cast("int").alias("salt"), F.lit(0).alias("is_query"), "id", "vec", F.lit(None).cast("double").alias("worst")
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = dealt.filter(is_query)

    def round_of(queries: DataFrame, home: bool) -> DataFrame:
        going = queries.select("id", "vec", "point", "cell", "worst").mapInArrow(
            visits(home), "cell int, salt int, is_query int, id long, vec array<double>, worst double"
        )
        both = base.unionByName(going).repartition(tasks, "cell", "salt").sortWithinPartitions("cell", "salt", "is_query", "id")
        return both.mapInArrow(search, "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    first = stored(ranked(round_of(asked.withColumn("worst", F.lit(-3.0)), home=True)).drop("rank"))
    worst = first.groupBy("query_id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    again = asked.join(worst, F.col("id") == F.col("query_id"), "left").withColumn(
        "worst", F.when(F.col("n") == k, F.col("kth")).otherwise(F.lit(-3.0))
    )
    second = round_of(again, home=False)
    return ranked(first.unionByName(second)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
