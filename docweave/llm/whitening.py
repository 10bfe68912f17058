"""Whitening of vectors by eigenvectors of their covariance, refined in mixed precision.

Vectors become whole numbers, so every sum over them is exact, whatever the order of the tasks. The
covariance of the distinct vectors is centred first and summed in tasks as float64 products of
16-bit pieces, which lose nothing. Its eigenvectors are found in float32 and corrected by the
iterations of Ogita and Aishima (2018, 2019), which are matrix products in extended precision;
groups of eigenvalues too close for them are solved anew on their own subspace, shifted to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from docweave.llm.tables import bounded_batches, stored

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
#: Scaled entries beyond this count as this, so that the offset cannot leave a long.
LARGEST = 2**62

#: Rows whose products are summed in float64 at once: 2^16 * 2^16 * 2^14 is below 2^53.
ROWS = 1 << 14
_HIGH = np.longdouble


# --- Whole numbers and exact sums ---


def is_finite(vec: str) -> Column:
    """Whether a vector is not null and holds no null and no non-finite entry."""
    return F.coalesce(F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))), F.lit(False))


def whole_numbers(vec: str) -> Column:
    """``floor(64 c) + 1000000`` of each entry of a finite vector."""
    scaled = lambda c: F.least(F.greatest(F.floor(c.cast("double") * SCALE), F.lit(-LARGEST)), F.lit(LARGEST))
    return F.transform(vec, lambda c: scaled(c) + OFFSET)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _by_width(batch_column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Width, row numbers and matrix of each width in a batch; empty vectors have no components."""
    widths = np.diff(batch_column.offsets.to_numpy())
    for width in np.unique(widths[widths > 0]):
        at = np.flatnonzero(widths == width)
        yield int(width), at, _matrix(batch_column.take(pa.array(at)), int(width))


def pieces(x: np.ndarray) -> list[np.ndarray]:
    """float64 arrays of absolute values up to 2^16 of which ``x`` is the sum, the k-th times 2^(16 k)."""
    out = []
    while len(x) and max(int(x.max()), -int(x.min())) > 1 << 16:
        out.append((x & 0xFFFF).astype(np.float64))
        x = x >> 16
    return [*out, x.astype(np.float64)]


def _add_products(total: dict[int, np.ndarray], left: np.ndarray, right: np.ndarray) -> None:
    """Adds leftᵀ right to ``total``, whose k-th matrix counts 2^(16 k)-fold; exact."""
    for start in range(0, len(left), ROWS):
        for a, p in enumerate(pieces(left[start : start + ROWS])):
            for b, q in enumerate(pieces(right[start : start + ROWS])):
                product = (p.T @ q).astype(np.int64)
                total[a + b] = total[a + b] + product if a + b in total else product


def _sums(fit: DataFrame, centres: dict[int, list[int]] | None) -> dict[int, list[list[int]]]:
    """By width, exact sums over the rows: of ``(1, x)`` if there are no centres, else of (1, x - centre)ᵀ (1, x - centre).

    Only these sums, some width² numbers, reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, dict[int, np.ndarray]] = {}
        for batch in batches:
            for width, _, x in _by_width(batch.column(0)):
                ones = np.ones((len(x), 1), np.int64)
                if centres is None:
                    _add_products(totals.setdefault(width, {}), ones, np.hstack([ones, x]))
                else:
                    y = np.hstack([ones, x - np.array(centres[width], np.int64)])
                    _add_products(totals.setdefault(width, {}), y, y)
        for width, total in totals.items():
            for k, m in total.items():
                i, j = np.indices(m.shape).reshape(2, -1)
                columns = [np.full(m.size, width), i, j, np.full(m.size, k), m.ravel()]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["width", "i", "j", "k", "part"])

    parts = fit.select("x").mapInArrow(run, "width long, i long, j long, k long, part long")
    summed = parts.groupBy("width", "i", "j", "k").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    out: dict[int, list[list[int]]] = {}
    for width, i, j, k, part in summed.collect():
        rows = 1 if centres is None else width + 1
        m = out.setdefault(width, [[0] * (width + 1) for _ in range(rows)])
        m[i][j] += int(part) << 16 * k
    return out


# --- Eigenvectors ---


def _clusters(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Index groups of two or more values, each within ``apart`` of the next one."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def _small_solve(a: np.ndarray) -> np.ndarray:
    """Eigenvectors in float32 of a symmetric matrix scaled to one."""
    scale = np.abs(a).max()
    return np.linalg.eigh(((a + a.T) / (2 * scale)).astype(np.float32))[1] if scale else np.eye(len(a), dtype=np.float32)


def _orthogonal(q: np.ndarray) -> np.ndarray:
    """The orthogonal matrix next to one that is orthogonal in float32."""
    q = q.astype(_HIGH)
    for _ in range(3):
        q = q @ (3 * np.eye(len(q), dtype=_HIGH) - q.T @ q) / 2
    return q


def refined_eigenvectors(a: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns of a symmetric matrix in extended precision.

    Each sweep is ``X + X E`` with ``E`` from XᵀX and XᵀAX, and at least halves the exponent of the error of all pairs
    of eigenvalues that the present error can tell apart; others only stay orthogonal, and their group is
    then solved on its own subspace, less its mean eigenvalue, where float32 sees their differences.
    Vectors of equal eigenvalues are any basis of their space.
    """
    a = np.asarray(a, _HIGH)
    norm = np.abs(a).sum(axis=0).max()
    one = np.eye(len(a), dtype=_HIGH)
    if not norm:
        return np.zeros(len(a), _HIGH), one
    noise = np.finfo(_HIGH).eps * len(a) * norm
    x, least, stalled = _small_solve(a).astype(_HIGH), np.inf, 0
    for _ in range(sweeps):
        r = one - x.T @ x
        s = x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        apart = 2 * (np.abs(s - np.diag(values)).sum(axis=0).max() + norm * np.abs(r).sum(axis=0).max())
        gaps = values[None, :] - values[:, None]
        far = np.abs(gaps) > apart
        e = np.where(far, (s + values[None, :] * r) / np.where(far, gaps, 1), r / 2)
        x = x + x @ e
        solved = False
        for group in _clusters(values, apart):
            part = x[:, group]
            # Differences of the group's eigenvalues are whole in this matrix, as their mean is taken off before the product.
            inner = part.T @ (a @ part - part * values[group].mean())
            if np.abs(inner - np.diag(np.diag(inner))).max() > noise:
                x[:, group], solved = part @ _orthogonal(_small_solve(inner)), True
        change = np.abs(e).max()
        stalled = stalled + 1 if change > least / 2 and not solved else 0
        least = min(least, change)
        if stalled == 2 or change <= 2.0**-60 and not solved:
            break
    s = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-s, kind="stable")
    return s[order], x[:, order] / np.sqrt(np.einsum("ij,ij->j", x, x))[order]


# --- The operator ---


@dataclass(frozen=True)
class Whitening:
    """A fit to the vectors of one width: entries less ``centre`` and ``rest / n`` are centred."""

    n: int
    centre: list[int]
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.centre, np.int64)) - np.array([s / self.n for s in self.rest])

    def project(self, x: np.ndarray) -> np.ndarray:
        """The whitened components of whole-number rows; NaN where a component has no variance."""
        flat = self.values <= self.trace * 1e-15
        scale = np.sqrt(np.where(flat, np.nan, self.values))
        return self.centred(x) @ self.vectors / scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sums of (n x - S)² of rows, exact; None where they are no long."""
        y = x - np.array(self.centre, np.int64)
        rough = ((y.astype(np.float64) * self.n - np.array(self.rest, np.float64)) ** 2).sum(axis=1)
        if not len(y) or rough.max() < 2**62:
            z = y * self.n - np.array(self.rest, np.int64)
            return (z * z).sum(axis=1).tolist()
        out: list[int | None] = [None] * len(y)
        for i in np.flatnonzero(rough < 2**64):
            exact = sum((int(v) * self.n - s) ** 2 for v, s in zip(y[i], self.rest))
            out[i] = exact if exact < 2**63 else None
        return out


def _covariance(n: int, sums: list[int], products: list[list[int]]) -> np.ndarray:
    """(n G - s sᵀ) / n² of whole numbers, rounded once to extended precision."""
    out = np.empty((len(sums), len(sums)), _HIGH)
    for i, a in enumerate(sums):
        for j, b in enumerate(sums):
            exact = n * products[i][j] - a * b
            high = float(exact)
            out[i, j] = _HIGH(high) + _HIGH(float(exact - int(high)))
    return out / _HIGH(n) / _HIGH(n)


def learn(vectors: DataFrame, vec: str = "vec", components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each width of vectors, fitted to all distinct whole-number vectors.

    ``identity_error`` is measured on them: the largest entry of the whitened covariance minus the identity, over components that have variance.
    """
    bounded_batches(vectors.sparkSession)
    fit = stored(vectors.filter(is_finite(vec)).select(whole_numbers(vec).alias("x")).distinct())
    models, centres = {}, {}
    for width, (row,) in _sums(fit, None).items():
        n = row[0]
        centres[width] = [(2 * s + n) // (2 * n) for s in row[1:]]
    for width, m in _sums(fit, centres).items():
        n, rest = m[0][0], m[0][1:]
        covariance = _covariance(n, rest, [row[1:] for row in m[1:]])
        values, basis = refined_eigenvectors(covariance)
        first = slice(None, components)
        models[width] = Whitening(
            n, centres[width], rest, values[first].astype(np.float64), basis[:, first].astype(np.float64), float(np.trace(covariance)),
        )
    errors = _identity_errors(fit, models)
    return {w: Whitening(**{**vars(m), "identity_error": errors[w]}) for w, m in models.items()}


def _models(fields: dict[int, dict]) -> dict[int, Whitening]:
    """Models from what was broadcast: plain values, as executors need not have this package."""
    return {width: Whitening(**f) for width, f in fields.items()}


def _identity_errors(fit: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    shared = fit.sparkSession.sparkContext.broadcast({w: vars(m) for w, m in models.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _models(shared.value), {}
        for batch in batches:
            for width, _, x in _by_width(batch.column(0)):
                w = np.nan_to_num(known[width].project(x))
                total[width] = total.get(width, 0) + w.T @ w
        for width, m in total.items():
            i, j = np.indices(m.shape).reshape(2, -1)
            yield pa.record_batch([pa.array(np.full(m.size, width)), pa.array(i), pa.array(j), pa.array(m.ravel())], names=["width", "i", "j", "part"])

    # Rows are centred by the exact mean, so the mean of what they are projected to is rounding only.
    parts = fit.select("x").mapInArrow(run, "width long, i long, j long, part double")
    out = dict.fromkeys(models, 0.0)
    for width, i, j, part in parts.groupBy("width", "i", "j").agg(F.sum("part")).collect():
        flat = models[width].values <= models[width].trace * 1e-15
        if not (flat[i] or flat[j]):
            out[width] = max(out[width], abs(part / models[width].n - (i == j)))
    return out


def whiten(vectors: DataFrame, models: dict[int, Whitening], vec: str = "vec") -> DataFrame:
    """The rows of ``vectors`` whose ``vec`` is whole and of a learnt width, with the columns of their model.

    ``n`` (distinct vectors fitted to), ``deviation`` (sum over the dimensions of (n x - S)², null beyond a long), ``whitened``
    and ``explained`` (arrays, by component; whitened is null where a component has no variance, explained then 0) and
    ``identity_error``, in place of any such columns. Vectors that are null, empty or hold null or non-finite
    entries take no part, nor do those of widths that were not learnt: each width has its own fit. Equal vectors are
    fitted once and all returned. No rows give no rows.
    """
    made = ["n", "deviation", "whitened", "explained", "identity_error"]
    kept = [c for c in vectors.columns if c.lower() not in made]
    shared = bounded_batches(vectors.sparkSession).sparkContext.broadcast({w: vars(m) for w, m in models.items()})
    schema = StructType(
        [
            *vectors.select(*kept).schema, StructField("n", LongType()), StructField("deviation", LongType()),
            StructField("whitened", ArrayType(DoubleType())), StructField("explained", ArrayType(DoubleType())),
            StructField("identity_error", DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _models(shared.value)
        for batch in batches:
            for width, at, x in _by_width(batch.column(batch.num_columns - 1)):
                model = known.get(width)
                if model is None:
                    continue
                rows, w = batch.take(pa.array(at)), model.project(x)
                k, m = len(x), w.shape[1]
                ends = pa.array(np.arange(k + 1, dtype=np.int32) * m)
                explained = model.values / model.trace if model.trace else np.zeros(m)
                yield pa.record_batch(
                    [
                        *rows.columns[:-1], pa.array(np.full(k, model.n)), pa.array(model.deviations(x), pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(w.ravel(), from_pandas=True)),
                        pa.ListArray.from_arrays(ends, pa.array(np.tile(np.maximum(explained, 0), k))),
                        pa.array(np.full(k, model.identity_error)),
                    ],
                    names=[*kept, *made],
                )

    rows = vectors.filter(is_finite(vec)).select(*kept, whole_numbers(vec).alias("x"))
    return rows.toDF(*(f"c{i}" for i in range(len(kept) + 1))).mapInArrow(run, schema)


def by_component(whitened: DataFrame, columns: list[str]) -> DataFrame:
    """One row per row and component, numbered from 1: the ``columns`` and what ``whiten`` adds."""
    zipped = F.posexplode(F.arrays_zip("whitened", "explained"))
    long = whitened.select(*columns, "n", "deviation", "identity_error", zipped.alias("at", "value"))
    return long.select(
        *columns, (F.col("at") + 1).alias("component"), "n", "deviation",
        F.col("value.whitened").alias("whitened"), F.col("value.explained").alias("explained"), "identity_error",
    )
