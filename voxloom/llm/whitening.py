"""Whitening of embeddings by the leading eigenvectors of their covariance, found by the Jacobi-Davidson method.

The covariance is never built. A step multiplies it with a few vectors: every task centres its rows, multiplies them
with the vectors and back, and returns a sum of the size of those vectors, which are added up in two levels. On the
driver there are only bases of ``width`` x ``room * count`` numbers, whatever the number of rows.

A round takes the Ritz pairs of the search space, locks the leading ones whose residual has reached double precision,
and widens the space by the solutions of the correction equation

    (I - QQ') (A - theta I) (I - QQ') t = -r

for each of the others, where Q holds the locked vectors and those being corrected. A few steps of MINRES solve
it, all right sides in the same pass over the rows. Spaces that grow too wide start again from their best
vectors. In the end the locked pairs are held against a fresh product.

The rows of the fit are distinct, centred on whole numbers near their mean, and written to the shared folder, so that a
lost executor costs its tasks alone. Partial sums are added in the order of their tasks: reruns agree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .common import settle
from .vectors import common_width, floors, matrix, sound

Product = Callable[[np.ndarray], np.ndarray]

# Rows of one step of a sum; longer sums are made of such.
_STEP = 1024
# Partial sums that one task, or the driver, adds up.
_FAN = 64


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` learned: n distinct vectors, sums of dimensions, eigenvectors as columns, eigenvalues and their checks."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    residual: float
    passes: int


def _added(df: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of the ``part`` binaries, doubles of ``shape``, in the order of ``task``; at most ``_FAN`` reach the driver."""
    parts = df.rdd.getNumPartitions()
    if parts > _FAN:
        groups = int(np.ceil(parts**0.5))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = [(t, p) for b in batches for t, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            if rows:
                rows.sort()
                total = np.sum([np.frombuffer(p) for _, p in rows], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([rows[0][0]], pa.int32()), pa.array([total.tobytes()])], ["task", "part"])

        df = df.repartition(groups, F.pmod("task", F.lit(groups))).mapInArrow(add, "task int, part binary")
    rows = sorted((r["task"], bytes(r["part"])) for r in df.collect())
    total = np.zeros(int(np.prod(shape)))
    for _, part in rows:
        total += np.frombuffer(part)
    return total.reshape(shape)


class _Rows:
    """The distinct vectors of a fit, centred on whole numbers, and sums over them."""

    def __init__(self, df: DataFrame, n: int, centre: np.ndarray, rest: np.ndarray):
        self.df, self.n, self.centre, self.rest, self.passes = df, n, centre, rest, 0

    def sum(self, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """The sum of ``of(centred rows)`` over all rows, a matrix of ``shape``."""
        centre, rest = self.centre, self.rest
        self.passes += 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            total = np.zeros(shape)
            for batch in batches:
                for at in range(0, batch.num_rows, _STEP):
                    # Whole numbers first, which are exact, then what is left of the mean.
                    total += of(matrix(batch.column(0).slice(at, _STEP)) - centre - rest)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()])], ["task", "part"])

        return _added(self.df.mapInArrow(run, "task int, part binary"), shape)

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``block``."""
        return self.sum(lambda z: z.T @ (z @ block), block.shape) / self.n


def _orthonormal(block: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of ``block`` add to the bases ``others``; empty columns go."""
    kept: list[np.ndarray] = []
    for column in block.T:
        size = np.linalg.norm(column)
        if not size > 0 or not np.isfinite(size):
            continue
        column = column / size
        for _ in range(3):
            for other in others:
                column = column - other @ (other.T @ column)
            for one in kept:
                column = column - one * (one @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
            if left > 0.7:
                break
        if left >= 1e-10:
            kept.append(column)
    return np.stack(kept, 1) if kept else np.zeros((len(block), 0))


def minres(product: Product, basis: np.ndarray, theta: np.ndarray, right: np.ndarray, steps: int) -> np.ndarray:
    """About ``steps`` MINRES steps for (I - BB')(A - theta_i I)(I - BB') t_i = right_i, all i in the same products."""

    def inside(x: np.ndarray) -> np.ndarray:
        return x - basis @ (basis.T @ x)

    def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.linalg.norm(x, axis=0)
        return np.divide(x, size, out=np.zeros_like(x), where=size > 0), size

    new, beta = unit(inside(right))
    old, w0, w1, t = (np.zeros_like(right) for _ in range(4))
    eta = beta.copy()
    c0, c1 = np.ones((2, right.shape[1]))
    s0, s1 = np.zeros((2, right.shape[1]))
    for _ in range(steps):
        if not (eta != 0).any():
            break
        image = inside(product(new) - new * theta)
        alpha = (new * image).sum(0)
        following, size = unit(inside(image - new * alpha - old * beta))
        delta = c1 * alpha - c0 * s1 * beta
        first = np.hypot(delta, size)
        second, third = s1 * alpha + c0 * c1 * beta, s0 * beta
        live = first > 0
        safe = np.where(live, first, 1.0)
        w0, w1 = w1, np.where(live, (new - w0 * third - w1 * second) / safe, 0.0)
        c0, c1, s0, s1 = c1, np.where(live, delta / safe, 0.0), s1, np.where(live, size / safe, 0.0)
        t += w1 * (c1 * eta)
        eta = np.where(live, -s1 * eta, 0.0)
        old, new, beta = new, following, size
    return inside(t)


def leading_pairs(product: Product, width: int, count: int, steps: int = 6, room: int = 4, seed: int = 11, rounds: int = 500) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvectors (columns), falling eigenvalues, and the largest residual, of the ``count`` leading pairs of a
    symmetric positive matrix that is known by ``product`` alone.

    A residual has reached double precision at 16 machine epsilons, times the root of ``width``, of the largest eigenvalue.
    """
    count = min(count, width)
    draw = np.random.Generator(np.random.PCG64(seed))
    space = _orthonormal(draw.standard_normal((width, count)))
    image = product(space)
    locked, values = np.zeros((width, 0)), np.zeros(0)
    precision = 16 * np.finfo(float).eps * width**0.5
    for _ in range(rounds):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        residual = image - space * theta
        limit = precision * max([*values[:1], theta[0]])
        good = np.linalg.norm(residual, axis=0) <= limit
        done = min(len(good) if good.all() else int(np.argmin(good)), count - len(values))
        if done:
            locked, values = np.concatenate([locked, space[:, :done]], 1), np.concatenate([values, theta[:done]])
            space, image, residual, theta = space[:, done:], image[:, done:], residual[:, done:], theta[done:]
        if len(values) == count:
            # Against a fresh product, and turned to the axes of the whole locked space.
            fresh = product(locked)
            small = locked.T @ fresh
            values, turn = np.linalg.eigh((small + small.T) / 2)
            values, turn = values[::-1], turn[:, ::-1]
            locked, fresh = locked @ turn, fresh @ turn
            worst = float(np.linalg.norm(fresh - locked * values, axis=0).max(initial=0))
            outside = locked.shape[1] < width
            if worst <= 2 * precision * values[0] or not outside:
                return locked, values, worst
            space, image = np.concatenate([locked, space], 1), np.concatenate([fresh, image], 1)
            locked, values = np.zeros((width, 0)), np.zeros(0)
            space = _orthonormal(space)
            image = product(space)
            continue
        wanted = min(count - len(values), space.shape[1])
        if wanted:
            fixed = np.concatenate([locked, space[:, :wanted]], 1)
            wider = minres(product, fixed, theta[:wanted], -residual[:, :wanted], steps)
        else:
            wider = draw.standard_normal((width, count - len(values)))
        if space.shape[1] + wider.shape[1] > max(room * count, 2):
            # A new start from the best vectors, whose products are known.
            space, image = space[:, : 2 * wanted], image[:, : 2 * wanted]
        wider = _orthonormal(wider, locked, space)
        if not wider.shape[1] and locked.shape[1] + space.shape[1] < width:
            wider = _orthonormal(draw.standard_normal((width, 1)), locked, space)
        if wider.shape[1]:
            space, image = np.concatenate([space, wider], 1), np.concatenate([image, product(wider)], 1)
        else:
            # The whole space: its products once more, against what rounding left in them.
            space = _orthonormal(space, locked)
            image = product(space)
    raise ArithmeticError(f"{count - len(values)} eigenpairs have not reached double precision in {rounds} rounds")


def usable(df: DataFrame, keep: Sequence[str], vector: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """``keep`` and ``_x``, floor(scale * c) + shift of each entry, of the rows with a sound vector of the commonest length.

    Entries are doubles that hold whole numbers; those beyond 52 bits stay at 52 bits.
    """
    good = df.filter(sound(F.col(vector)))
    return good.filter(F.size(vector) == common_width(good, vector)).select(*keep, floors(F.col(vector), scale, shift).alias("_x"))


def fit(df: DataFrame, components: int = 16, steps: int = 6, room: int = 4) -> Whitening:
    """The whitening of the distinct vectors ``_x``, all whole numbers and of one length.

    Components whose eigenvalue is zero, up to rounding, have no scale and are left out; so a table with fewer
    distinct vectors than components has fewer, and one with a single vector, or none, has none.
    """
    rows = settle(spread(df.select(F.col("_x").alias("x")).distinct()))
    first = rows.agg(F.count(F.lit(1)).alias("n"), F.first("x").alias("x")).first()
    n, width = first["n"], len(first["x"] or [])
    empty = Whitening(n, (), np.zeros((width, 0)), np.zeros(0), 0.0, 0.0, 0.0, 0)
    if not n:
        return empty
    # Sums in decimals are exact for every table that fits a decimal of 38 digits.
    at = rows.select(F.posexplode("x").alias("d", "c")).groupBy("d").agg(F.sum(F.col("c").cast("decimal(20,0)")).alias("s"))
    sums = [int(r["s"]) for r in at.orderBy("d").collect()]
    centre = [round(Fraction(s, n)) for s in sums]
    rest = np.array([float(Fraction(s, n) - c) for s, c in zip(sums, centre)])
    data = _Rows(rows, n, np.array(centre, float), rest)
    trace = float(data.sum(lambda z: (z * z).sum(0), (width,)).sum()) / n
    if not trace > 0:
        return Whitening(n, tuple(sums), empty.vectors, empty.values, 0.0, 0.0, 0.0, data.passes)
    vectors, values, residual = leading_pairs(data.product, width, components, steps, room)
    live = values > 64 * np.finfo(float).eps * width * values[0]
    vectors, values = vectors[:, live], values[live]
    project = vectors / np.sqrt(values)
    count = project.shape[1]
    mean = data.sum(lambda z: (z @ project).sum(0), (count,)) / n

    def spread_of(z: np.ndarray) -> np.ndarray:
        w = z @ project - mean
        return w.T @ w

    error = float(np.abs(data.sum(spread_of, (count, count)) / n - np.eye(count)).max(initial=0))
    return Whitening(n, tuple(sums), vectors, values, trace, error, residual, data.passes)


def apply(df: DataFrame, model: Whitening, keep: Sequence[str]) -> DataFrame:
    """``keep`` and the results of ``whiten`` for rows with ``_x``."""
    n, sums = model.n, model.sums
    centre = np.array([round(Fraction(s, n)) for s in sums], float)
    rest = np.array([float(Fraction(s, n) - round(Fraction(s, n))) for s in sums])
    # n * x - S = n * (x - centre) - left, all whole numbers.
    left = [s - n * round(Fraction(s, n)) for s in sums]
    project = model.vectors / np.sqrt(model.values) if len(sums) else np.zeros((0, 0))
    explained = model.values / model.trace if model.trace else model.values
    count, error = project.shape[1], model.identity_error

    def exact(z: np.ndarray) -> list[int | None]:
        """Sums of squares of n * z - left: by 64-bit numbers where none can overflow, else by Python's."""
        most = n * float(np.abs(z).max(initial=0)) + max(map(abs, left), default=0)
        if most * most * max(1, z.shape[1]) < 2.0**62:
            return ((n * z.astype(np.int64) - np.array(left, np.int64)) ** 2).sum(1).tolist()
        big = [sum((n * int(c) - m) ** 2 for c, m in zip(row, left)) for row in z]
        return [b if b < 1 << 63 else None for b in big]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows if count else 0, _STEP):
                part = batch.slice(at, _STEP)
                z = matrix(part.column(len(keep))) - centre
                # A sum per row, in one order for all, so equal rows have equal results.
                white = np.stack([((z - rest) * project[:, c]).sum(1) for c in range(count)], 1)
                rows = np.repeat(np.arange(len(z)), count)
                again = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(k).take(again) for k in range(len(keep))],
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(z))),
                        pa.array(np.full(len(rows), n)),
                        pa.array(exact(z), pa.int64()).take(again),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, len(z))),
                        pa.array(np.full(len(rows), error)),
                    ],
                    names,
                )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    added = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [*keep, *(c.split()[0] for c in added.split(", "))]
    return df.select(*keep, "_x").mapInArrow(run, f"{kept}, {added}" if keep else added)


def whiten(df: DataFrame, keep: Sequence[str] = ("vec_id",), vector: str = "embedding", components: int = 16, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """``keep``, component (from 1), n, deviation, whitened, explained and identity_error, a row per row and component.

    Rows whose vector is null, empty, of another length than the commonest, or holds null or non-finite entries take no
    part. The others do, whatever their key: repeated rows are fitted once and returned each. ``whitened`` is the centred
    vector on the component over the root of its eigenvalue, ``explained`` its share of the trace, ``deviation`` the sum of
    (n * x - S)^2 over the dimensions, exact, and null where it does not fit into 64 bits. Components without variance are
    left out, so a table of equal vectors, or none, has no result. ``keep`` must not hold names of results.
    """
    rows = usable(df, keep, vector, scale, shift)
    return apply(rows, fit(rows, components), keep)
