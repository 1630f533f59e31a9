"""PCA whitening of embeddings, with eigenvectors by QDWH spectral
divide-and-conquer.

Entries become whole numbers x = floor(64 * c) + 1000000, so sums and deviations
are exact.  Tasks sum x, then the products of centred x; both partial results are
arrays of the dimension's size, added up by Spark.  The covariance, d x d numbers
whatever the number of rows, is split on the driver: the polar factor of A - sI,
found by dynamically weighted Halley steps in their inverse-free QR form, has the
eigenvalues 1 and -1, so (U + I) / 2 projects on the eigenvectors above s; bases of
its range and of the rest split A into two smaller symmetric matrices, and so on
down to single components.  A last correction step takes out what rounding left
in the vectors.  The d x k whitening matrix is sent to the tasks.

Scale: three scans of the table, no shuffle of rows; partial results of a task
are d, d * d and k * k numbers.  The bound of what is collected and broadcast is
d * d numbers (d up to 4096 or so).

Defined results: rows whose vector is null or holds null, NaN or infinite entries
are dropped, and so are those with an entry whose x doesn't fit a long.  The
dimension is that of most remaining rows (ties: the larger); rows of another
dimension, empty vectors included, can't be projected and are dropped.  Repeated
rows count each time and are returned each; null ids are returned as null.  A
component without variance (eigenvalue not above d * 2^-52 of the largest) has null
``whitened``; without any variance ``explained`` is null.  A deviation beyond a long
is null.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import written

__all__ = ["polar", "spectrum", "moments", "covariance", "whiten"]

_EPS = np.finfo(float).eps


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH."""
    m = len(a)
    x = a / np.linalg.norm(a)  # Frobenius, not below the spectral norm
    low = _EPS  # lower bound of the singular values; smaller ones take more steps
    for _ in range(30):
        d = np.cbrt(4 * max(1 - low * low, 0.0) / low**4)
        root = np.sqrt(1 + d)
        p = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low * low) / (low * low * root), 0.0))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        low = min(1.0, low * (p + q * low * low) / (1 + r * low * low))
        both = np.linalg.qr(np.vstack([np.sqrt(r) * x, np.eye(m)]))[0]
        new = (q / r) * x + (p - q / r) / np.sqrt(r) * both[:m] @ both[m:].T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        if abs(low - 1) < 10 * _EPS and moved < np.cbrt(_EPS):
            break
    return x


def _halves(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift;
    None where it doesn't part the spectrum cleanly."""
    m = len(a)
    shifted = a - shift * np.eye(m)
    if not np.any(shifted):
        return None
    projector = (polar(shifted) + np.eye(m)) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < m:
        return None
    start = np.random.default_rng(m).standard_normal((m, k))
    basis = np.linalg.qr(projector @ start)[0]
    whole = np.linalg.qr(projector @ basis, mode="complete")[0]
    upper, lower = whole[:, :k], whole[:, k:]
    if np.linalg.norm(lower.T @ a @ upper) > 1e3 * _EPS * m * np.linalg.norm(a):
        return None
    return upper, lower


def _components(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    m = len(a)
    a = (a + a.T) / 2
    mean = np.trace(a) / m
    spread = np.linalg.norm(a - mean * np.eye(m))
    if m == 1 or spread <= 4 * _EPS * scale:  # nothing left to part at this precision
        return np.diag(a).copy(), np.eye(m)
    step = spread / np.sqrt(m)
    for shift in (float(np.median(np.diag(a))), mean, *(mean + f * step for f in (0.1, -0.1, 0.37, -0.37, 0.71, -0.71))):
        if (halves := _halves(a, shift)) is not None:
            break
    else:  # eigenvalues too close to be told apart by any of the shifts: a plane rotation of the largest entry
        off = np.abs(a - np.diag(np.diag(a)))
        i, j = np.unravel_index(np.argmax(off), off.shape)
        if off[i, j] <= _EPS * scale:
            return np.diag(a).copy(), np.eye(m)
        angle = 0.5 * np.arctan2(2 * a[i, j], a[j, j] - a[i, i])
        turn = np.eye(m)
        turn[i, i] = turn[j, j] = np.cos(angle)
        turn[i, j], turn[j, i] = np.sin(angle), -np.sin(angle)
        values, vectors = _components(turn.T @ a @ turn, scale)
        return values, turn @ vectors
    found = [(v, basis @ own) for basis in halves for v, own in [_components(basis.T @ a @ basis, scale)]]
    return np.concatenate([v for v, _ in found]), np.hstack([w for _, w in found])


def _corrected(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """One step of iterative refinement of approximate eigenvectors: first-order
    corrections between components that are apart, orthogonality between close ones."""
    rest = np.eye(len(a)) - x.T @ x
    s = x.T @ a @ x
    values = np.diag(s) / (1 - np.diag(rest))
    close = 2 * (np.linalg.norm(s - np.diag(values)) + np.linalg.norm(a) * np.linalg.norm(rest))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > close
    change = np.where(apart, (s + values[None, :] * rest) / np.where(apart, gap, 1), rest / 2)
    return x + x @ change


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric
    matrix; the largest entry of each vector is positive."""
    scale = float(np.linalg.norm(a))
    if not len(a) or scale == 0:
        return np.zeros(len(a)), np.eye(len(a))
    _, x = _components(a, scale)
    for _ in range(2):
        x = _corrected(a, x)
    values = np.einsum("ij,ij->j", x, a @ x)
    x = np.linalg.qr(x[:, np.argsort(-values, kind="stable")])[0]  # orthogonal to rounding; larger components keep their direction
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    values, x = values[order], x[:, order]
    return values, x * np.where(x[np.argmax(np.abs(x), axis=0), np.arange(len(a))] < 0, -1.0, 1.0)


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows remain, their dimensions, and x of all their entries."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    there = ~column.is_null().to_numpy(zero_copy_only=False)
    size = np.where(there, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
    flat = column.flatten()  # without what null rows may hide
    c = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(64 * c)
    bad = ~(np.abs(scaled) < 2.0**62)
    row = np.repeat(np.arange(n), size)
    there &= np.bincount(row[bad], minlength=n) == 0
    return there, size, np.where(bad, 0, scaled).astype(np.int64)[there[row]] + 1_000_000


def _rows(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and x (rows x dim) of the rows of this dimension."""
    there, size, x = _vectors(column)
    own = there & (size == dim)
    return np.flatnonzero(own), x[np.repeat(own[there], size[there])].reshape(-1, dim)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, rounded once: n * x - S is exact."""
    if n * float(np.abs(x).max(initial=0)) + float(np.abs(sums).max(initial=0)) < 2.0**62:
        return (n * x - sums) / n
    return ((n * x.astype(object) - sums.astype(object)) / n).astype(float)


def moments(vectors: DataFrame, column: str) -> tuple[int, int, np.ndarray]:
    """Dimension, number and exact sums of the remaining vectors."""
    def sums(batches):
        held: dict[int, list] = {}
        for batch in batches:
            there, size, x = _vectors(batch.column(0))
            for dim in np.unique(size[there]).tolist():
                part = x[np.repeat(size[there] == dim, size[there])].reshape(-1, dim) if dim else np.zeros((int((size[there] == 0).sum()), 0), np.int64)
                own = held.setdefault(dim, [0, [0] * dim])
                own[0] += len(part)
                own[1] = [a + b for a, b in zip(own[1], (part.sum(axis=0) if np.abs(part).max(initial=0) < 2**40 else part.astype(object).sum(axis=0)).tolist())]
        for dim, (n, total) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int64()), pa.array([n], pa.int64()), pa.array([[str(t) for t in total]], pa.list_(pa.string()))], ["dim", "n", "sums"])

    parts = written(vectors.select(column).mapInArrow(sums, "dim long, n long, sums array<string>"), "sums")
    best = parts.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if best is None:
        return 0, 0, np.zeros(0, np.int64)
    each = parts.where(F.col("dim") == best["dim"]).select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    total = {r["i"]: int(r["s"]) for r in each.collect()}  # a row for each dimension
    values = [total[i] for i in range(best["dim"])]
    return best["dim"], best["n"], np.array(values, np.int64 if max(map(abs, values), default=0) < 2**63 else object)


def _gram(df: DataFrame, width: int, of) -> np.ndarray:
    """Sum over all rows of z z^T; ``of`` gives the rows z of a batch."""
    def products(batches):
        total = np.zeros((width, width))
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                z = of(batch.slice(i, 4096))
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.ListArray.from_arrays(np.arange(0, width * width + 1, width, dtype=np.int32), total.ravel())], ["i", "v"])

    parts = df.mapInArrow(products, "i long, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    cells = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()  # width * width rows
    out = np.zeros((width, width))
    out[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
    return out


def covariance(vectors: DataFrame, column: str, dim: int, n: int, sums: np.ndarray) -> np.ndarray:
    """Covariance of the x-vectors, divisor n."""
    return _gram(vectors.select(column), dim, lambda batch: _centred(_rows(batch.column(0), dim)[1], n, sums)) / n


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each remaining vector and component: its id, ``component`` (from
    1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    source = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    kind = source.schema["id"].dataType.simpleString()
    dim, n, sums = moments(source, "vector")
    k = min(components, dim)
    cov = covariance(source, "vector", dim, n, sums) if dim else np.zeros((0, 0))
    values, basis = spectrum(cov)
    trace = float(np.trace(cov))
    live = values[:k] > dim * _EPS * max(float(values[0]) if dim else 0.0, 0.0)
    scale = np.where(live, 1 / np.sqrt(np.where(live, values[:k], 1)), 0.0)
    sent = source.sparkSession.sparkContext.broadcast((basis[:, :k] * scale, sums))

    def deviations(x: np.ndarray, sums: np.ndarray) -> list:
        most = n * float(np.abs(x).max(initial=0)) + float(np.abs(sums).max(initial=0))
        off = n * x - sums if most < 2.0**62 else n * x.astype(object) - sums.astype(object)
        if dim * float(np.abs(off).max(initial=0)) ** 2 < 2.0**62:
            return (off.astype(np.int64) ** 2).sum(axis=1).tolist()
        exact = (off.astype(object) ** 2).sum(axis=1).tolist()
        return [d if d < 2**63 else None for d in exact]

    def project(batches):
        matrix, sums = sent.value
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                at, x = _rows(part.column(1), dim)
                w = _centred(x, n, sums) @ matrix
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), pa.array(deviations(x, sums), pa.int64()), pa.ListArray.from_arrays(np.arange(0, len(at) * k + 1, max(k, 1), dtype=np.int32)[: len(at) + 1] if k else np.zeros(len(at) + 1, np.int32), w.ravel())], ["id", "deviation", "w"])

    rows = written(source.mapInArrow(project, f"id {kind}, deviation long, w array<double>"), "whitened")
    error = None
    if live.any():
        sums_of = rows.select(F.posexplode("w").alias("i", "w")).groupBy("i").agg(F.sum("w").alias("w")).collect()  # a row for each component
        mean = np.zeros(k)
        for r in sums_of:
            mean[r["i"]] = r["w"] / n
        gram = _gram(rows.select("w"), k, lambda batch: batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k) - mean) / n
        error = float(np.abs(gram[np.ix_(live, live)] - np.eye(int(live.sum()))).max())
    share = F.array(*[F.lit(float(v / trace) if trace > 0 else None).cast("double") for v in values[:k]]) if k else F.array().cast("array<double>")
    alive = F.array(*[F.lit(bool(v)) for v in live]) if k else F.array().cast("array<boolean>")
    long = rows.select(F.col("id").alias(id_col), "deviation", F.posexplode("w").alias("i", "w"))
    return long.select(id_col, (F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                       F.when(F.get(alive, F.col("i")), F.col("w")).alias("whitened"), F.get(share, F.col("i")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
