"""Embedding whitening: leading components of a covariance by spectrum slicing, certified by inertia counts."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from stocktally.llm.common import Shared, without
from stocktally.session import cut_lineage

_ALPHA = (1 + 17**0.5) / 8  # bounds the growth of pivots of one and two rows
_LARGEST = 2.0**48  # of a scaled entry: the sums of a batch stay within 64 bits


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above the shift: the positive pivots of an LDL' factorization.

    Pivots are single entries or blocks of two rows, chosen for stability; by Sylvester's law their signs are those
    of the eigenvalues of matrix - shift I.
    """
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        n = len(a)
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        q = int(off.argmax())
        largest = off.flat[q]
        if max(diagonal[p], largest) == 0:
            break  # what is left is zero: no eigenvalue above
        if diagonal[p] >= _ALPHA * largest:
            pick = [p]
            above += bool(a[p, p] > 0)
        else:  # a block with a negative determinant: one eigenvalue on either side
            pick = [q // n, q % n]
            above += 1
        rest = np.setdiff1d(np.arange(n), pick)
        side = a[np.ix_(rest, pick)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(pick, pick)], side.T)
        a = (a + a.T) / 2
    return above


def leading(matrix: np.ndarray, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of the k largest eigenvalues of a symmetric matrix, falling.

    Counts at shifted matrices halve an interval until it holds the wanted eigenvalue alone; Rayleigh quotient
    iteration, kept orthogonal to the vectors found before, starts there. A result counts as the i-th only if the
    counts on both sides of it say so; else the interval is halved further. Eigenvalues that double precision cannot
    tell apart share an interval, and their vectors are an orthonormal basis of their space.
    """
    n = len(matrix)
    k = min(k, n)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if scale == 0:
        return np.zeros(k), np.eye(n)[:, :k]
    matrix = matrix / scale  # eigenvalues between -1 and 1
    tiny = 8 * n * np.finfo(float).eps
    rng = np.random.default_rng(seed)
    counts: dict[float, int] = {-1 - tiny: n, 1 + tiny: 0}

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = inertia(matrix, shift)
        return counts[shift]

    values, vectors = [], np.zeros((n, 0))
    for i in range(1, k + 1):
        low = max(s for s, c in counts.items() if c >= i)
        high = min(s for s, c in counts.items() if c < i)
        while True:
            alone = counts[low] - counts[high] == 1
            if alone or high - low <= tiny:
                value, vector = _rayleigh(matrix, (low + high) / 2, vectors, rng)
                near = max(tiny, 4 * float(np.linalg.norm(matrix @ vector - value * vector)))
                if low - tiny <= value <= high + tiny and count(value + near) < i <= count(value - near):
                    break
                if high - low <= tiny / 64:
                    raise ArithmeticError(f"eigenvalue {i} could not be certified")
            middle = (low + high) / 2
            if count(middle) >= i:
                low = middle
            else:
                high = middle
        values.append(value)
        vectors = np.column_stack([vectors, vector])
    return np.array(values) * scale, vectors


def _rayleigh(matrix: np.ndarray, shift: float, found: np.ndarray, rng) -> tuple[float, np.ndarray]:
    """An eigenpair near the shift, orthogonal to the found vectors: two steps with the shift, then Rayleigh quotients."""
    n = len(matrix)

    def clean(x):
        for _ in range(2):
            x = x - found @ (found.T @ x)
        return x / np.linalg.norm(x)

    def step(s, x):
        for away in (0.0, np.finfo(float).eps, -4 * np.finfo(float).eps):
            try:
                y = np.linalg.solve(matrix - (s + away) * np.eye(n), x)
            except np.linalg.LinAlgError:  # the shift is an eigenvalue
                continue
            if np.isfinite(y).all():
                return clean(y / np.abs(y).max())
        raise ArithmeticError("no solution near the shift")

    x = clean(rng.normal(size=n))
    for _ in range(2):
        x = step(shift, x)
    value, best = float(x @ matrix @ x), np.inf
    for _ in range(30):
        y = step(value, x)
        v = float(y @ matrix @ y)
        off = float(np.linalg.norm(matrix @ y - v * y))
        if off >= best:  # no better: converged
            break
        value, x, best = v, y, off
    return value, x


@dataclass
class Whitening:
    """Rows times basis, after the mean is taken off: covariance one."""

    rows: int
    sums: np.ndarray  # of whole-number vectors, exact
    basis: np.ndarray  # dims x components, each over the root of its eigenvalue
    explained: np.ndarray


def usable(vector: Column, dims: int | None = None) -> Column:
    """Whether a vector is not null and all entries are numbers small enough for exact sums."""
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) * 1024 < _LARGEST, F.lit(False)) & ~F.isnan(c))
    return vector.isNotNull() & fits & (F.size(vector) == dims if dims is not None else F.size(vector) > 0)


def whole_numbers(values: pa.Array, dims: int) -> np.ndarray:
    """floor(1024 c) + 100000 for each entry, rows x dims."""
    flat = np.asarray(values.flatten()).astype(np.float64).reshape(-1, dims)
    return np.floor(flat * 1024).astype(np.int64) + 100_000


def _vectors(df: DataFrame, column: str, dims: int) -> DataFrame:
    return df.filter(usable(F.col(column), dims)).select(F.col(column).cast("array<double>").alias("__v"))


def fit(df: DataFrame, column: str, dims: int, components: int) -> Whitening:
    """Exact sums, then the centred covariance, both added up by Spark; dims x dims numbers reach the driver."""
    vectors = _vectors(df, column, dims)

    def sums(batches):
        for batch in batches:
            x = whole_numbers(batch.column(0), dims)
            for a in range(0, len(x), 1 << 13):
                part = x[a : a + (1 << 13)]
                yield pa.RecordBatch.from_arrays([pa.array([-1, *range(dims)], pa.int32()), pa.array([len(part), *part.sum(axis=0).tolist()], pa.int64())], ["i", "s"])

    # Sums of sums may leave 64 bits on very large tables; decimals hold them.
    got = {r["i"]: int(r["s"]) for r in vectors.mapInArrow(sums, "i int, s long").groupBy("i").agg(F.sum(F.col("s").cast("decimal(28,0)")).alias("s")).collect()}
    n, total = got.get(-1, 0), [got.get(i, 0) for i in range(dims)]
    if n == 0:
        return Whitening(0, np.zeros(dims, np.int64), np.zeros((dims, 0)), np.zeros(0))
    base = np.array([s // n for s in total], np.int64)
    rest = np.array([(s % n) / n for s in total])

    def squares(batches):
        out = np.zeros((dims, dims))
        for batch in batches:
            centred = (whole_numbers(batch.column(0), dims) - base) - rest
            out += centred.T @ centred
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(out.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    partial = vectors.mapInArrow(squares, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    cov = np.zeros((dims, dims))
    for r in partial.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        cov[r["i"], r["j"]] = r["v"] / n
    cov = (cov + cov.T) / 2
    values, basis = leading(cov, components)
    # A direction without spread cannot be made one; it and all after it are left out.
    some = int((values > 64 * dims * np.finfo(float).eps * max(float(np.trace(cov)), 0.0)).sum())
    trace = float(np.trace(cov))
    return Whitening(n, np.array(total, dtype=object), basis[:, :some] / np.sqrt(values[:some]), values[:some] / trace if trace else values[:0])


def whiten(embeddings: DataFrame, *, components: int = 8, vector: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """Rows with n, deviation, whitened and explained (arrays over the components), identity_error.

    A usable row's entries c become whole numbers x = floor(1024 c) + 100000. n rows are usable, S their sums. The
    components are the leading eigenvectors of x's covariance (divisor n), numbered by falling eigenvalue e, the same
    for all rows; whitened is x - S / n on each, over sqrt(e); explained is e over the trace; deviation is the sum of
    (n x - S)^2 over the dimensions, exact, and null where it does not fit a long. identity_error is the largest entry
    of the covariance of whitened, measured on the rows written, less the identity.

    Rows go whose vector is null, empty, or holds a null, a NaN, an infinity or an entry of 2^38 or more; also those
    not of the most frequent length (of equally frequent ones the largest). Components without spread - in a table of
    equal vectors, or of fewer rows than components - are left out, so arrays may be shorter or empty. Repeated rows and
    rows without an id count one by one. Sums and products are added up by Spark; the driver gets the covariance only,
    dims x dims numbers. An empty table gives an empty result. Input columns of the new names are replaced.
    """
    new = ["n", "deviation", "whitened", "explained", "identity_error"]
    embeddings = embeddings.withColumn("__vector", F.col(f"`{vector}`"))
    kept = without(embeddings, ["__vector", *new])
    kept = kept if keep is None else kept.select(*keep)
    names = kept.columns
    sizes = embeddings.filter(usable(F.col("__vector"))).groupBy(F.size("__vector").alias("d")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    dims = top["d"] if top else 1
    model = fit(embeddings, "__vector", dims, components)
    shared = Shared(embeddings.sparkSession, model)
    source = embeddings.filter(usable(F.col("__vector"), dims)).select(*[F.col(f"`{c}`") for c in names], F.col("__vector").cast("array<double>").alias("__vector"))

    def run(batches):
        m = shared.value
        widest = max((abs(s) for s in m.sums), default=0)
        for batch in batches:
            x = whole_numbers(batch.column(len(names)), dims)
            off = None
            if max(float(np.abs(x).max(initial=0)) * m.rows, widest) < 2.0**61:
                off = x * m.rows - m.sums.astype(np.int64)
            if off is None or float(np.abs(off).max(initial=0)) ** 2 * dims >= 2.0**62:
                off = x.astype(object) * m.rows - m.sums  # whole numbers of any size
            deviation = (off * off).sum(axis=1).tolist()
            white = off.astype(np.float64) / m.rows @ m.basis
            arrays = [pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64()), pa.array(list(white), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(names))], *arrays], [*names, "deviation", "whitened"])

    out = source.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]))
    out = cut_lineage(out, "whitened")
    size = model.basis.shape[1]
    entry = [F.col("whitened")[i] for i in range(size)]
    pairs = list(itertools.combinations_with_replacement(range(size), 2))
    error = 0.0
    if pairs and model.rows:
        spread = out.agg(*[F.covar_pop(entry[i], entry[j]) for i, j in pairs]).first()  # centred while it adds up
        error = max(abs(s - (i == j)) for s, (i, j) in zip(spread, pairs, strict=True))
    return out.withColumns({
        "n": F.lit(model.rows).cast("long"), "explained": F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>"),
        "identity_error": F.lit(float(error)),
    }).select(*names, *new)


def by_component(white: DataFrame, keep: list[str]) -> DataFrame:
    """One row per kept row and component, counted from 1."""
    each = F.inline(F.transform(F.col("whitened"), lambda w, i: F.struct((i + 1).alias("component"), w.alias("whitened"), F.get("explained", i).alias("explained"))))
    return white.select(*keep, "n", "deviation", "identity_error", each).select(*keep, "component", "n", "deviation", "whitened", "explained", "identity_error")
