"""Embedding whitening by a covariance over distinct vectors.

Equal vectors are one: ``distinct`` groups them and counts their copies, partial counts before the shuffle.  The fit
runs over the distinct vectors, each with a weight: its number of copies, or one.

1. ``quantized``: every entry c becomes the integer floor(256 c); a vector is stored in the fewest bytes that hold its
   entries.  Rows whose vector is null or has a null, infinite or NaN entry are dropped, and no others.
2. ``sums``: exact weighted sums per dimension (high and low halves apart, so that no sum overflows).
3. ``covariance``: the entries less the mean, then a weighted matrix product per task; tasks send rows of their matrix,
   which are added up by row, so that no task or driver holds the matrices of many tasks.
4. The driver, which holds one matrix of dimension x dimension, takes its eigenvectors.
5. ``projected``: each distinct vector is whitened once, and written; the covariance of the whitened values is put
   together from centred products of the tasks.
6. The rows take up their vector's values by a join on its SHA-256.  A vector with more than 1/HOT of all rows has its
   values repeated under as many salts as it has such shares, so that its rows are dealt over as many tasks; there are
   fewer than HOT such vectors.

Edge cases: an empty table, and one with no vector left, gives no rows; vectors of several lengths are each a fit of
their own; a vector of no entries has no component and no row; a component without variance (as with a single distinct
vector) has null ``whitened`` and is left out of ``identity_error``, which is null if no component has variance, as is
``explained`` without any variance; entries beyond the range of a long are cut to it; repeated ids and null ids
each get their rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, ship, stored

SCALE = 256
#: A vector with more than one HOT-th of the rows is dealt over several tasks.
HOT = 64
#: Vectors of one matrix product.
BLOCK = 8192
_KINDS = {k: np.dtype(f"<i{k}") for k in (1, 2, 4, 8)}


def pack(x: np.ndarray) -> list[bytes]:
    """Each row in the fewest bytes an entry: 1, 2, 4 or 8, named by the first byte.  Equal rows are packed alike."""
    low, high = x.min(axis=1), x.max(axis=1)
    width = np.full(len(x), 8)
    for k in (4, 2, 1):
        info = np.iinfo(_KINDS[k])
        width[(low >= info.min) & (high <= info.max)] = k
    out = np.empty(len(x), object)
    for k, kind in _KINDS.items():
        rows = np.flatnonzero(width == k)
        if len(rows):
            head = np.full((len(rows), 1), k, np.uint8)
            body = np.ascontiguousarray(x[rows].astype(kind)).view(np.uint8)
            out[rows] = [r.tobytes() for r in np.hstack([head, body])]
    return out.tolist()


def unpack(packed: list[bytes], dims: int) -> np.ndarray:
    """The rows again, as 64-bit integers."""
    out = np.empty((len(packed), dims), np.int64)
    width = np.array([b[0] for b in packed])
    for k, kind in _KINDS.items():
        rows = np.flatnonzero(width == k)
        if len(rows):
            joined = np.frombuffer(b"".join([packed[i] for i in rows]), np.uint8).reshape(len(rows), 1 + k * dims)
            out[rows] = np.ascontiguousarray(joined[:, 1:]).view(kind)
    return out


def quantized(src: DataFrame) -> DataFrame:
    """id, ``dims`` and ``x`` (packed) of every row whose vector is whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            entries = vectors.flatten().cast(pa.float64())
            values = entries.fill_null(np.nan).to_numpy(zero_copy_only=False)
            lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(lengths)])
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            whole = (lengths > 0) & (bad[starts[1:]] == bad[starts[:-1]])
            for dims in np.unique(lengths[whole]).tolist():
                rows = np.flatnonzero(whole & (lengths == dims))
                c = np.floor(SCALE * values[starts[rows][:, None] + np.arange(dims)])
                x = np.clip(c, -(2.0**63), np.nextafter(2.0**63, 0)).astype(np.int64)
                x[c >= 2.0**63] = np.iinfo(np.int64).max
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), dims, np.int32)), pa.array(pack(x), pa.binary())],
                    names=["id", "dims", "x"],
                )

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, dims int, x binary")


def distinct(rows: DataFrame) -> DataFrame:
    """dims, x, ``copies`` and ``key`` of every distinct vector."""
    return rows.groupBy("dims", "x").agg(F.count(F.lit(1)).alias("copies")).withColumn("key", F.unhex(F.sha2("x", 256)))


def _blocks(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[int, list]]:
    """(dims, columns) of runs of up to BLOCK vectors of one length; the first column holds the lengths."""
    held: dict[int, list[list]] = {}
    for batch in batches:
        lengths = batch.column(0).to_numpy()
        for dims in np.unique(lengths).tolist():
            part = batch.take(pa.array(np.flatnonzero(lengths == dims)))
            lists = held.setdefault(dims, [[] for _ in range(columns)])
            for have, more in zip(lists, part.columns[1:], strict=True):
                have += more.to_pylist()
            if len(lists[0]) >= BLOCK:
                yield dims, held.pop(dims)
    yield from held.items()


def sums(vectors: DataFrame, weight: str) -> dict[int, tuple[int, int, list[int]]]:
    """By length: number of distinct vectors, total weight, and the exact weighted sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, (packed, copies) in _blocks(batches, 2):
            x = unpack(packed, dims)
            w = np.array(copies, np.int64)
            # weights below 2^31 a vector: larger ones are split, so that each half's product stays exact
            halves = [(w & 0x7FFFFFFF, 0), (w >> 31, 31)]
            rows = []
            for part, shift in halves:
                if part.any():
                    for piece, at in ((x & 0xFFFF, 0), (x >> 16 & 0xFFFF, 16), (x >> 32 & 0xFFFF, 32), (x >> 48, 48)):
                        if piece.any():
                            rows += [(dims, i, shift + at, int(v)) for i, v in enumerate(part @ piece)]
            rows.append((dims, -1, 0, len(w)))
            rows.append((dims, -2, 0, int(w.sum())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
                names=["dims", "at", "shift", "value"],
            )

    parts = vectors.select("dims", "x", F.col(weight).alias("w")).mapInArrow(run, "dims int, at int, shift int, value long")
    # at most 8 rows for each dimension of each length
    totals = parts.groupBy("dims", "at", "shift").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    out = {}
    for dims in {r.dims for r in totals}:
        mine = [r for r in totals if r.dims == dims]
        one = [0] * dims
        for r in mine:
            if r["at"] >= 0:
                one[r["at"]] += int(r.value) << r["shift"]
        out[dims] = (next(int(r.value) for r in mine if r["at"] == -1), next(int(r.value) for r in mine if r["at"] == -2), one)
    return out


def covariance(vectors: DataFrame, weight: str, means: dict[int, np.ndarray], totals: dict[int, int]) -> dict[int, np.ndarray]:
    """By length: the weighted covariance, centred before multiplying, divided by the total weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for dims, (packed, copies) in _blocks(batches, 2):
            c = unpack(packed, dims) - means[dims]
            product = c.T @ (c * np.array(copies, np.float64)[:, None])
            held[dims] = held[dims] + product if dims in held else product
        for dims, m in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dims, dims, np.int32)), pa.array(np.arange(dims, dtype=np.int32)), pa.array([r.tobytes() for r in m], pa.binary())],
                names=["dims", "at", "entries"],
            )

    def added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            for r in batch.column("entries"):
                total = total + np.frombuffer(r.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([k.as_py()], pa.int32()) for k in key] + [pa.array([total.tobytes()], pa.binary())], names=["dims", "at", "entries"])

    schema = "dims int, at int, entries binary"
    parts = vectors.select("dims", "x", F.col(weight).alias("w")).mapInArrow(run, schema)
    rows = parts.groupBy("dims", "at").applyInArrow(added, schema).collect()  # dimension x dimension numbers
    out = {}
    for dims in totals:
        m = np.stack([np.frombuffer(r.entries) for r in sorted((r for r in rows if r.dims == dims), key=lambda r: r["at"])])
        out[dims] = (m + m.T) / 2 / totals[dims]
    return out


class Fit:
    """What whitening needs of one length: n, sums, mean, the leading eigenvalues and eigenvectors."""

    def __init__(self, n: int, weight: int, total: list[int], v: np.ndarray, components: int):
        self.n, self.weight, self.total = n, weight, total
        self.mean = np.array([t / weight for t in total])
        values, vectors = np.linalg.eigh(v)
        self.count = min(components, len(total))
        self.values = values[::-1][: self.count]
        self.vectors = vectors[:, ::-1][:, : self.count]
        self.trace = float(np.trace(v))
        # below this an eigenvalue is rounding
        self.varies = self.values > max(self.trace, 0.0) * len(total) * np.finfo(float).eps

    def explained(self) -> list[float | None]:
        return [float(e / self.trace) if self.trace > 0 else None for e in self.values]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """One column per component that has variance."""
        return ((x - self.mean) @ self.vectors[:, self.varies]) / np.sqrt(self.values[self.varies])

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (weight * x - sum)^2, exact."""
        bound = self.weight * int(max(abs(int(x.min())), abs(int(x.max())))) + max(abs(t) for t in self.total)
        if bound * bound * len(self.total) < 1 << 63:
            d = self.weight * x - np.array(self.total, np.int64)
            return np.einsum("ij,ij->i", d, d).tolist()
        d = self.weight * x.astype(object) - np.array(self.total, object)
        return (d * d).sum(axis=1).tolist()


def projected(vectors: DataFrame, weight: str, fits: dict[int, Fit]) -> DataFrame:
    """key, copies, dims, n, deviation and whitened of every distinct vector; and rows without a key that hold, for
    each block of vectors, weight, weighted mean and centred product of the whitened values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, (packed, keys, copies, weights) in _blocks(batches, 4):
            fit, x = fits[dims], unpack(packed, dims)
            white = fit.whiten(x)
            w = np.array(weights, np.float64)
            mean = w @ white / w.sum()
            centred = white - mean
            moments = np.concatenate([[w.sum()], mean, (centred.T @ (centred * w[:, None])).ravel()])
            full = np.full((len(x), fit.count), np.nan)
            full[:, fit.varies] = white
            values = [[None if np.isnan(v) else v for v in r] for r in full.tolist()]
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*keys, None], pa.binary()), pa.array([*copies, None], pa.int64()), pa.array([dims] * (m + 1), pa.int32()),
                    pa.array([*[Decimal(d) for d in fit.deviations(x)], None], pa.decimal128(38, 0)),
                    pa.array([*values, moments.tolist()], pa.list_(pa.float64())),
                ],
                names=["key", "copies", "dims", "deviation", "whitened"],
            )

    schema = "key binary, copies long, dims int, deviation decimal(38,0), whitened array<double>"
    return vectors.select("dims", "x", "key", "copies", F.col(weight).alias("w")).mapInArrow(run, schema)


def identity_error(moments: DataFrame, dims: int, components: int) -> float | None:
    """Largest absolute entry of the whitened values' covariance less the identity, from the tasks' centred moments."""
    if not components:
        return None

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for row in batch.column(0):
                state = _merged(state, np.array(row.as_py()), components)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([state.tolist()], pa.list_(pa.float64()))], names=["m"])

    mine = moments.where(F.col("dims") == dims).select(F.col("whitened").alias("m"))
    state = None
    for row in mine.mapInArrow(merge, "m array<double>").collect():  # one small row a task
        state = _merged(state, np.array(row.m), components)
    cov = state[1 + components :].reshape(components, components) / state[0]
    return float(np.abs(cov - np.eye(components)).max())


def _merged(a: np.ndarray | None, b: np.ndarray, k: int) -> np.ndarray:
    """Weight, mean and centred product of two sets together."""
    if a is None:
        return b
    w, gap = a[0] + b[0], b[1 : 1 + k] - a[1 : 1 + k]
    mean = a[1 : 1 + k] + gap * (b[0] / w)
    return np.concatenate([[w], mean, a[1 + k :] + b[1 + k :] + np.outer(gap, gap).ravel() * (a[0] * b[0] / w)])


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, weights: str = "one") -> DataFrame:
    """id, ``component``, ``n`` (total weight of the fit), ``deviation`` (decimal(38,0)), ``whitened``, ``explained``
    and ``identity_error`` for every row with a whole vector and every component.  ``weights``: ``one`` (every distinct
    vector counts once) or ``copies``."""
    src = only(df, id_col, vector_col).toDF("id", "v")
    spark = src.sparkSession
    ship(spark)
    rows = quantized(src)
    vectors = stored(distinct(rows).withColumn("one", F.lit(1).cast("long")), "distinct-vectors")
    totals = sums(vectors, weights)
    means = {d: np.array([t / w for t in total]) for d, (_, w, total) in totals.items()}
    cov = covariance(vectors, weights, means, {d: w for d, (_, w, _) in totals.items()}) if totals else {}
    fits = {d: Fit(n, w, total, cov[d], components) for d, (n, w, total) in totals.items()}
    white = stored(projected(vectors, weights, fits), "whitened-vectors")
    moments, values = white.where("key IS NULL"), white.where("key IS NOT NULL").drop("dims")
    facts = [
        (d, f.weight, k + 1, e, error)
        for d, f in fits.items()
        for error in [identity_error(moments, d, int(f.varies.sum()))]
        for k, e in enumerate(f.explained())
    ]
    named = spark.createDataFrame(facts, "dims int, n long, component int, explained double, identity_error double")

    # fewer than HOT vectors have more than a HOT-th of the rows
    total = values.agg(F.sum("copies")).first()[0] or 0
    salts = F.least(F.lit(HOT), F.ceil(F.col("copies") * HOT / max(total, 1))).cast("int")
    hot = values.where(F.col("copies") * HOT > total).select("key", salts.alias("salts"))
    salt = F.pmod(F.xxhash64("id"), F.coalesce("salts", F.lit(1))).cast("int")
    told = rows.select("id", "dims", F.unhex(F.sha2("x", 256)).alias("key"))
    told = told.join(F.broadcast(hot), "key", "left").select("id", "dims", "key", salt.alias("salt"))
    dealt = values.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(F.col("copies") * HOT > total, salts).otherwise(1) - 1)))
    out = told.join(dealt.drop("copies"), ["key", "salt"]).join(F.broadcast(named), "dims")
    return out.select(
        F.col("id").alias(id_col), "component", "n", "deviation",
        F.get("whitened", F.col("component") - 1).alias("whitened"), "explained", "identity_error",
    )
