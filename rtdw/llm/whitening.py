"""Embedding whitening by the Jacobi-Davidson method.

The covariance of the vectors is never formed. It is known by its products with a few
vectors at a time: each task centres its own vectors, multiplies, and Spark adds up what the
tasks give, a number for each dimension and vector. The driver holds vectors of the
dimension only.

The greatest eigenvalues come out of a growing subspace. The covariance, projected on it,
gives Ritz vectors; what each lacks is found from its correction equation, projected away
from all of them and solved by a few steps of MINRES, whose products are taken for all
wanted vectors at once. A vector whose residual has reached double precision is locked and
kept out of the subspace.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.tables import extended, stored, table

COMPONENTS = 4
#: Ritz vectors kept beside the wanted ones, and the largest subspace before a restart.
GUARDS = 8
SUBSPACE = 40
#: Steps of MINRES for one correction, what part of a residual is small enough to end them, and
#: corrections before the search is taken to fail.
INNER = 4
INNER_LEAST = 1e-3
OUTER = 300
#: Numbers of this size or more cannot be squared and summed as long whole numbers.
LARGEST = float(1 << 30)
#: Rows multiplied at once in a task.
ROWS = 16_384

Apply = Callable[[np.ndarray], np.ndarray]


def fixed_point(vector: Column) -> Column:
    """Entries c as the whole numbers floor(256 c)."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * 256.0).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and has only finite entries, all below ``LARGEST``."""
    return vector.isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST)
    )


def matrices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    """The vectors ``x`` of the batches as matrices of at most ``ROWS`` rows."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            part = batch.column("x").slice(at, ROWS)
            yield part.flatten().to_numpy().reshape(len(part), size)


def totals(fit: DataFrame, size: int, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum over all vectors of what ``part`` gives for some of them, as one row of numbers."""
    dtype = np.float64 if kind == "double" else np.int64

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for matrix in matrices(batches, size):
            more = part(matrix)
            own = more if own is None else own + more
        if own is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(own))), pa.array(own.astype(dtype))], ["at", "value"]
            )

    rows = fit.select("x").mapInArrow(add, f"at long, value {kind}").groupBy("at").agg(F.sum("value").alias("value"))
    found = rows.toArrow()
    out = np.zeros(len(found), dtype)
    out[found.column("at").to_numpy()] = found.column("value").to_numpy()
    return out


class Covariance:
    """Covariance of a table of vectors (column ``x``, whole numbers, equally long), divisor n."""

    def __init__(self, fit: DataFrame, size: int):
        self.fit, self.size = fit, size
        sums = totals(fit, size, lambda m: np.append(m.sum(0), len(m)), "long")
        self.n, self.sums = int(sums[-1]), sums[:-1]
        self.mean = self.sums / self.n
        self.trace = float(totals(fit, size, self._centred(lambda m: np.array([(m * m).sum()])))[0]) / self.n

    def _centred(self, part: Callable[[np.ndarray], np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
        mean = self.mean
        return lambda matrix: part(matrix - mean)

    def times(self, vectors: np.ndarray) -> np.ndarray:
        """The products with the columns of a matrix, in one pass over the table."""
        product = totals(self.fit, self.size, self._centred(lambda m: (m.T @ (m @ vectors)).ravel()))
        return product.reshape(vectors.shape) / self.n

    def between(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance of the vectors' projections on the columns of a matrix."""

        def gram(m: np.ndarray) -> np.ndarray:
            own = m @ vectors
            return (own.T @ own).ravel()

        return totals(self.fit, self.size, self._centred(gram)).reshape(vectors.shape[1], -1) / self.n


def away(vectors: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The vectors without their parts along an orthonormal basis."""
    for _ in range(2):
        vectors = vectors - basis @ (basis.T @ vectors)
    return vectors


def added(vectors: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the vectors add to a basis."""
    out = np.empty((len(vectors), 0))
    for column in vectors.T:
        norm = np.linalg.norm(column)
        if not norm:
            continue
        column = away((column / norm)[:, None], np.hstack([basis, out]))
        norm = np.linalg.norm(column)
        if norm > 1e-10:
            out = np.hstack([out, away(column / norm, np.hstack([basis, out]))])
            out[:, -1] /= np.linalg.norm(out[:, -1])
    return out


def corrections(apply: Apply, values: np.ndarray, basis: np.ndarray, right: np.ndarray,
                steps: int, least: float) -> np.ndarray:
    """MINRES for (A - value) t = right, both sides projected away from the basis.

    Each column is a system with a value of its own; their steps are taken together.
    """
    old_v, v = np.zeros_like(right), away(right, basis)
    beta = first = np.linalg.norm(v, axis=0)
    live = first > 0
    v = v / np.where(live, first, 1)
    out, old_w, w = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    old_c = c = np.ones(len(values))
    old_s = s = np.zeros(len(values))
    rest = first.copy()
    for _ in range(steps):
        if not live.any():
            break
        own = np.zeros_like(v)
        own[:, live] = apply(v[:, live])
        own = away(own - v * values, basis)
        alpha = (v * own).sum(0)
        own = own - alpha * v - beta * old_v
        beta_next = np.linalg.norm(own, axis=0)
        delta = c * alpha - old_c * s * beta
        rho1 = np.hypot(delta, beta_next)
        rho2, rho3 = s * alpha + old_c * c * beta, old_s * beta
        live = live & (rho1 > 0)
        rho1 = np.where(rho1 > 0, rho1, 1)
        old_c, c, old_s, s = c, delta / rho1, s, beta_next / rho1
        old_w, w = w, (v - rho3 * old_w - rho2 * w) / rho1
        out[:, live] += (c * rest * w)[:, live]
        rest = -s * rest
        live = live & (np.abs(rest) > least * first) & (beta_next > 0)
        old_v, v, beta = v, own / np.where(beta_next > 0, beta_next, 1), beta_next
    return away(out, basis)


def greatest_eigenpairs(apply: Apply, size: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, and their unit eigenvectors as columns.

    ``apply`` multiplies a symmetric matrix with the columns of a matrix. All residuals are
    at most 32 roundings of the greatest value, times the root of the dimension; vectors
    that do not get there are an error.
    """
    wanted = min(wanted, size)
    locked, values = np.empty((size, 0)), np.empty(0)
    start = np.random.default_rng(0).standard_normal((size, min(size, wanted + GUARDS)))
    basis = np.linalg.qr(start)[0]
    image, scale = apply(basis), 0.0
    for turn in range(OUTER):
        ritz, turned = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        ritz, turned = ritz[::-1], turned[:, ::-1]
        basis, image = basis @ turned, image @ turned
        scale = max([scale, *np.abs(ritz)])
        exact = 32 * np.sqrt(size) * np.finfo(float).eps * scale
        left = wanted - len(values)
        rest = away(image[:, :left] - basis[:, :left] * ritz[:left], locked)
        norms = np.linalg.norm(rest, axis=0)
        done = int(np.argmax(np.append(norms > exact, True)))  # the greatest ones, one after another
        locked = np.hstack([locked, basis[:, :done]])
        values = np.append(values, ritz[:done])
        if len(values) == wanted:
            break
        basis, image, ritz, left = basis[:, done:], image[:, done:], ritz[done:], left - done
        if basis.shape[1] > SUBSPACE - left - GUARDS:
            basis, image = basis[:, : left + GUARDS], image[:, : left + GUARDS]
        # Guards are corrected too: a pass over the table costs the same for more vectors.
        near = basis[:, : left + GUARDS]
        rest = away(image[:, : near.shape[1]] - near * ritz[: near.shape[1]], locked)
        open_ = np.linalg.norm(rest, axis=0) > exact
        found = corrections(
            apply, ritz[: len(open_)][open_], np.hstack([locked, near]), -rest[:, open_], INNER, INNER_LEAST
        )
        new = added(found, np.hstack([locked, basis]))
        if not new.shape[1]:
            new = added(np.random.default_rng(turn + 1).standard_normal((size, left)), np.hstack([locked, basis]))
        if new.shape[1]:
            basis, image = np.hstack([basis, new]), np.hstack([image, apply(new)])
    else:
        raise ArithmeticError(f"{wanted - len(values)} eigenvectors have not reached double precision")
    # Once more with fresh products of the locked vectors.
    locked = np.linalg.qr(locked)[0]
    image = apply(locked)
    values, turned = np.linalg.eigh((locked.T @ image + image.T @ locked) / 2)
    return values[::-1], (locked @ turned)[:, ::-1]


def whitened(vectors: DataFrame, keep: list[str], vector: str = "embedding",
             components: int = COMPONENTS) -> DataFrame:
    """Kept columns, component (from 1), n, deviation, whitened, explained and identity_error.

    Rows whose vector is null or has null or non-finite entries are left out, and so are those
    with entries of ``LARGEST`` or more. Vectors of fewer entries than the longest count
    as if zeros followed. The covariance is that of the different vectors; components without
    variance (fewer different vectors than components, or none) give no rows. ``deviation``
    is null where it is too large for a long.
    """
    names = [f"keep_{c}" for c in keep]
    rows = vectors.filter(usable(vectors[vector])).select(
        *(vectors[c].alias(name) for c, name in zip(keep, names, strict=True)), fixed_point(vectors[vector]).alias("x")
    )
    rows = stored(rows, "fixed-point")
    size = rows.agg(F.max(F.size("x"))).first()[0] or 0
    missing = F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("x"))
    rows = rows.withColumn("x", F.concat("x", missing))
    more = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = extended(rows.select(*names).schema, more)
    kinds = [F.col(name).alias(c) for c, name in zip(keep, names, strict=True)]
    if not size:
        return vectors.sparkSession.createDataFrame([], schema).select(*kinds, *schema.names[len(names) :])
    own = Covariance(stored(rows.select("x").distinct(), "different-vectors"), size)
    values, directions = greatest_eigenpairs(own.times, size, components)
    there = values > 32 * size * np.finfo(float).eps * max(values[0], 0)
    if not (own.trace > 0 and there.any()):
        return vectors.sparkSession.createDataFrame([], schema).select(*kinds, *schema.names[len(names) :])
    values, directions = values[there], directions[:, there]
    scaled = directions / np.sqrt(values)
    error = float(np.abs(own.between(scaled) - np.eye(len(values))).max())
    explained, mean, n = values / own.trace, own.mean, own.n
    sums = F.array(*(F.lit(int(s)).cast("long") for s in own.sums))
    gap = F.zip_with("x", sums, lambda x, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), x), s))
    deviation = F.aggregate(gap, F.lit(0).cast("long"), lambda total, g: F.try_add(total, F.try_multiply(g, g)))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                (matrix,) = matrices(iter([part]), size)
                count = len(values)
                each = pa.array(np.repeat(np.arange(len(part)), count))
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c).take(each) for c in names),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(part))),
                    pa.array(np.full(len(each), n)), part.column("deviation").take(each),
                    pa.array(((matrix - mean) @ scaled).ravel()), pa.array(np.tile(explained, len(part))),
                    pa.array(np.full(len(each), error)),
                ], schema.names)

    out = rows.withColumn("deviation", deviation).mapInArrow(project, schema)
    return out.select(*kinds, *schema.names[len(names) :])


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    """The embeddings on their four greatest principal components, each with variance 1.

    Repeated rows give rows each and count once for the covariance, as do rows without an
    id; an empty table gives no rows.
    """
    return whitened(table(spark, sf_dir, "embeddings"), ["vec_id"])
