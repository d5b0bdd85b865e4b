"""Whitening of embeddings: centred, projected on the leading components, each scaled to variance 1."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.columns import quoted
from ledgerloom.llm.storage import checkpointed
from ledgerloom.llm.symmetric_eigen import EPS, leading

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**33  # so that scaled entries, and sums of them over a batch, stay exact
LONGEST = 4096
BATCH = 8192


@dataclass(frozen=True)
class Whitening:
    """What the fit found; its size depends on the number of dimensions alone."""

    n: int
    sums: list[int]
    components: np.ndarray  # dimensions x components
    values: np.ndarray  # variance along each component
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([(s // self.n) + (s % self.n) / self.n for s in self.sums])


def usable(vectors: DataFrame, carry: Sequence[str], vector: str) -> DataFrame:
    """``row`` (the carried columns) and ``vector`` as doubles, of all rows that take part."""
    as_doubles = quoted(vector).cast("array<double>")
    sound = as_doubles.isNotNull() & ~F.exists(as_doubles, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    rows = vectors.select(F.struct(*[quoted(c) for c in carry]).alias("row"), as_doubles.alias("vector")).where(F.coalesce(sound, F.lit(False)))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if most is not None and most.length > LONGEST:
        raise ValueError(f"vectors of {most.length} entries; {LONGEST} at most, as the covariance is held as a whole")
    return rows.where(F.size("vector") == (most.length if most else 0))


def scaled(column: pa.Array, dimensions: int) -> np.ndarray:
    """The entries as whole numbers, a row for each vector."""
    entries = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimensions)
    return np.floor(SCALE * entries).astype(np.int64) + SHIFT


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), BATCH):
            yield batch.slice(at, BATCH)


def fit(rows: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """Sums, then the covariance of the centred vectors, both added up over all rows; None if there is no variance.

    Each task adds up its own rows and hands on one matrix, so what is shuffled depends on the number of tasks. The
    driver gets the finished matrix: as many numbers as a pair of dimensions has values.
    """
    first = rows.select(F.size("vector").alias("d")).first()
    if first is None or first.d == 0:
        return None
    d = first.d
    schema = pa.schema([("place", pa.int32()), ("value", pa.int64())])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            x = scaled(batch.column("vector"), d)
            yield pa.record_batch([pa.array(np.arange(d + 1, dtype=np.int32)), pa.array(np.append(x.sum(axis=0), len(x)))], schema)

    totals = rows.select("vector").mapInArrow(summed, "place int, value long")
    exact = totals.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    found = {r.place: int(r.value) for r in exact}
    n, sums = found.pop(d), [found[i] for i in range(d)]
    mean = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0).mean
    upper = np.triu_indices(d)
    cells = pa.schema([("cell", pa.int32()), ("value", pa.float64())])

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((d, d))
        for batch in chunks(batches):
            centred = scaled(batch.column("vector"), d) - mean
            products += centred.T @ centred
        yield pa.record_batch([pa.array(np.arange(len(upper[0]), dtype=np.int32)), pa.array(products[upper])], cells)

    products = rows.select("vector").mapInArrow(multiplied, "cell int, value double")
    table = products.groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    covariance = np.zeros((d, d))
    cell = table["cell"].to_numpy()
    covariance[upper[0][cell], upper[1][cell]] = table["value"].to_numpy() / n
    covariance += np.triu(covariance, 1).T
    values, components = leading(covariance, k)
    real = values > 1e4 * d * EPS * values[0]  # below that, rounding decides about the variance
    if not real.any():
        return None
    return Whitening(n, sums, components[:, real], values[real], float(np.trace(covariance)))


def whiten(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """``row``, ``deviation`` and ``whitened`` (a number for each component) of every row."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)
    d = len(fitted.sums)
    row_type = rows.schema["row"].dataType

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        mean, directions, exact_sums = fit.mean, fit.components / np.sqrt(fit.values), np.array(fit.sums, object)
        for batch in chunks(batches):
            x = scaled(batch.column("vector"), d)
            centred = x - mean
            white = centred @ directions
            if len(x) and fit.n**2 * float((centred**2).sum(axis=1).max()) < 2.0**61 and max(map(abs, fit.sums)) < 2**62:
                deviation = ((fit.n * x - np.array(fit.sums, np.int64)) ** 2).sum(axis=1).tolist()
            else:
                exact = ((fit.n * x.astype(object) - exact_sums) ** 2).sum(axis=1).tolist()
                deviation = [v if v < 1 << 63 else None for v in exact]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(deviation, pa.int64()), lists], ["row", "deviation", "whitened"])

    return rows.mapInArrow(projected, f"row {row_type.simpleString()}, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, k: int) -> float:
    """Largest difference between the covariance of the whitened rows and the identity."""
    at = [F.col("whitened")[i] for i in range(k)]
    entries = [F.abs(F.covar_pop(at[i], at[j]) - F.lit(float(i == j))) for i in range(k) for j in range(i, k)]
    return float(max(whitened.agg(*[e.alias(f"e{i}") for i, e in enumerate(entries)]).first()))


def whiten_embeddings(vectors: DataFrame, k: int = COMPONENTS, carry: Sequence[str] | None = None, vector: str = "embedding") -> DataFrame:
    """One row per vector and component: ``row`` (the carried columns, all by default), ``component`` (from 1), ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    An entry c counts as floor(1024 c) + 100000. Vectors that are null or hold a null, NaN, infinite or larger entry
    than 2**33 take no part, nor do vectors of another length than most have (ties: the longer). Repeated rows count
    as often as they are there, and each is returned. Components without variance (to double precision) cannot be
    scaled and are left out; so an empty table, a single vector or equal vectors give no rows. A ``deviation`` beyond
    a long is null. A vector of over 4096 entries is an error: the covariance is held as a whole.
    """
    rows = usable(vectors, list(carry if carry is not None else vectors.columns), vector)
    fitted = fit(rows, k)
    if fitted is None:
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("component", "int"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"))]
        return rows.select("row", *nothing).limit(0)
    k = len(fitted.values)
    white = checkpointed(whiten(rows, fitted))
    error = identity_error(white, k)
    explained = F.array(*[F.lit(float(v / fitted.trace)) for v in fitted.values])
    each = white.select("row", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "row",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
