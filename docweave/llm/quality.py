"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text's features are which words and which runs of punctuation it has, the latter also with
the power of two that their number reaches, and how often a word follows itself, likewise; all are
hashed to ``BUCKETS`` numbers. Common features count less, those of a few rated texts not at all. One weight per bucket, shared by all grades, gives a text its score s; ordered thresholds
cut the line of scores into grades: P(grade > j) = sigmoid(s - threshold j). Their sum is the
expected grade, and the chance of reaching a target grade decides on selection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.tables import bounded_batches
from docweave.llm.words import letters_and_digits, mixed, words

BUCKETS = 1 << 18
#: Rated documents that the model is fitted on, about: more are sampled by a hash of the id.
FIT_DOCUMENTS = 20_000
#: Rated texts that must have a feature for it to count.
LEAST_TEXTS = 3
#: A feature counts in full if at most a part of exp(-COMMON) of the rated texts have it.
COMMON = 4.0
STEPS = 120
RATE = 0.1
#: Weight of the squared weights against the mean loss.
RIDGE = 2e-4


def _punctuation() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[0x21:0x7F] = True
    return table & ~letters_and_digits()


def features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For some rows at a time: the first row, the buckets of all of them, and each row's bounds therein."""
    streams = [words(column, letters_and_digits()), words(column, _punctuation())]
    many = np.uint64(BUCKETS)
    for text, marks in zip(*streams, strict=True):
        n = text.last - text.first
        rows = np.arange(n, dtype=np.uint64) * many
        keys = [np.repeat(rows, np.diff(text.bounds)) + text.hashes % many]
        mark = np.sort(np.repeat(rows, np.diff(marks.bounds)) + (marks.hashes + np.uint64(1)) % many)
        first = np.flatnonzero(np.append(True, mark[1:] != mark[:-1]))[: len(mark)]
        reached = np.floor(np.log2(np.diff(np.append(first, len(mark))))).astype(np.uint64)
        keys += [mark[first], (mark[first] // many) * many + mixed(mark[first] % many * np.uint64(64) + reached) % many]
        same = np.append(text.hashes[1:] == text.hashes[:-1], False)[: len(text.hashes)]
        times = np.append(0, np.cumsum(same))[text.bounds]
        times = times[1:] - times[:-1]
        row = np.flatnonzero(times > 0)
        keys.append(rows[row] + mixed(np.floor(np.log2(times[row])).astype(np.uint64)) % many)
        found = np.sort(np.concatenate(keys))
        found = found[np.append(True, found[1:] != found[:-1])] if len(found) else found
        bounds = np.searchsorted(found, np.arange(n + 1, dtype=np.uint64) * many)
        yield text.first, (found % many).astype(np.int32), bounds


def _sums(weights: np.ndarray, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.append(0.0, np.cumsum(weights[buckets]))
    return total[bounds[1:]] - total[bounds[:-1]]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def exceed(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > j) by text and j."""
        return _sigmoid(scores[:, None] - self.thresholds)


def fit(buckets: np.ndarray, bounds: np.ndarray, grades: np.ndarray, levels: int) -> Model:
    """The most likely model of grades 0 to ``levels`` - 1, by Adam steps over all rows."""
    texts = np.bincount(buckets, minlength=BUCKETS)
    scale = np.clip(np.log(max(len(grades), 1) / np.maximum(texts, 1)) / COMMON, 0, 1)
    scale[texts < LEAST_TEXTS] = 0
    counts = scale[buckets] > 0
    bounds = np.append(0, np.cumsum(counts))[bounds]
    buckets = buckets[counts]
    weights = np.zeros(BUCKETS)
    share = np.array([np.mean(grades > j) for j in range(levels - 1)])
    start = -np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    # Thresholds are the first one plus positive gaps, so they stay in order.
    cuts = np.append(start[:1], np.log(np.maximum(np.diff(start), 1e-2)))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, cuts)]
    row = np.repeat(np.arange(len(grades)), np.diff(bounds))
    n = max(len(grades), 1)
    for step in range(1, STEPS + 1):
        gaps = np.exp(cuts[1:])
        thresholds = np.cumsum(np.append(cuts[:1], gaps))
        score = _sums(weights * scale, buckets, bounds)
        # The likelihood of grade g is F(threshold g - s) - F(threshold g-1 - s), F rising from 0 to 1.
        upto = np.hstack([np.zeros((n, 1)), _sigmoid(thresholds - score[:, None]), np.ones((n, 1))])
        slope = upto * (1 - upto)
        at = np.arange(n)
        chance = np.maximum(upto[at, grades + 1] - upto[at, grades], 1e-12)
        by_score = (slope[at, grades + 1] - slope[at, grades]) / chance / n
        by_cut = np.zeros(levels + 1)
        np.add.at(by_cut, grades + 1, -slope[at, grades + 1] / chance / n)
        np.add.at(by_cut, grades, slope[at, grades] / chance / n)
        by_cut = by_cut[1:-1]
        by_cut = np.append(by_cut.sum(), [by_cut[j:].sum() * gaps[j - 1] for j in range(1, len(by_cut))])
        by_weight = np.bincount(buckets, by_score[row], BUCKETS) * scale + RIDGE * weights
        for p, g, (m, v) in zip((weights, cuts), (by_weight, by_cut), state, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(weights * scale, np.cumsum(np.append(cuts[:1], np.exp(cuts[1:]))))


def learn(docs: DataFrame, ratings: DataFrame, documents: int = FIT_DOCUMENTS) -> Model | None:
    """Fits on documents with a rating: ``docs`` has ``doc_id``, ``text``; ``ratings`` has ``doc_id``, ``grade`` from 0.

    About ``documents`` of the rated ids are used, chosen by hash. A null id, grade or text is left out; of
    several ratings of an id the lowest counts, of several texts that with the smallest hash. None if nothing is rated or all alike.
    """
    bounded_batches(docs.sparkSession)
    rated = ratings.filter(F.col("doc_id").isNotNull() & F.col("grade").isNotNull()).groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    counts = {r["grade"]: r["n"] for r in rated.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).orderBy("grade").limit(100).collect()}
    if len(counts) < 2:
        return None
    part = int(min(1.0, documents / sum(counts.values())) * (1 << 32))

    def some(df: DataFrame) -> DataFrame:
        return df.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) <= part)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, buckets, bounds in features(batch.column("text")):
                lists = pa.ListArray.from_arrays(bounds.astype(np.int32), buckets)
                yield pa.record_batch([batch.column("doc_id").slice(first, len(bounds) - 1), lists], names=["doc_id", "buckets"])

    texts = some(docs.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL"))
    texts = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    table = texts.mapInArrow(hashed, "doc_id long, buckets array<int>").join(some(rated), "doc_id").select("buckets", "grade").toArrow()
    grades = table["grade"].to_numpy()
    if len(set(grades.tolist())) < 2:
        return None
    lists = table["buckets"].combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.array(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    return fit(lists.flatten().to_numpy(), np.append(0, np.cumsum(lengths)), grades.astype(np.int64), max(counts) + 1)


def rate(docs: DataFrame, model: Model | None, target: int | None = None, least: float = 0.5) -> DataFrame:
    """``docs`` with ``expected_grade``, ``tail_prob`` and ``keep`` in place of any such columns, one row per row.

    ``tail_prob`` is the chance of grade ``target`` (the highest, if not given) or better, and ``keep`` whether it reaches
    ``least``. A null text counts as empty, an empty one has no features and so the
    grade of a score of 0. Without a model both numbers are null and every row is kept. Only the text
    counts, so ids, ties and repeated rows make no difference; no rows give no rows.
    """
    names = ("expected_grade", "tail_prob", "keep")
    kept = [c for c in docs.columns if c.lower() not in names]
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select(*kept, none.alias("expected_grade"), none.alias("tail_prob"), F.lit(True).alias("keep"))
    shared = bounded_batches(docs.sparkSession).sparkContext.broadcast(model)
    level = (len(model.thresholds) if target is None else target) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            exceed = np.zeros((batch.num_rows, len(model.thresholds)))
            for first, buckets, bounds in features(batch.column(batch.num_columns - 1)):
                exceed[first : first + len(bounds) - 1] = model.exceed(_sums(model.weights, buckets, bounds))
            tail = exceed[:, level] if level >= 0 else np.ones(batch.num_rows)
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(exceed.sum(axis=1)), pa.array(tail), pa.array(tail >= least)], names=[*kept, *names]
            )

    schema = docs.select(*kept).schema.add("expected_grade", "double").add("tail_prob", "double").add("keep", "boolean")
    return docs.select(*kept, docs["text"].alias("__text")).mapInArrow(run, schema)
