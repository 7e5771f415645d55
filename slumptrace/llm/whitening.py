"""Operator 12: whitening of vectors by exact covariances from bit-sliced cross-products."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slumptrace.llm.common import Staging

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
# Whole numbers beyond this, about the offset, count as this: sums of products then fit 38 decimal digits.
LARGEST = 2**44
# Rows that are packed into words at once.
BLOCK = 1 << 16


def whole_numbers(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """The usable vectors of a column by length: ``(rows, floor(64 c) as a matrix)``.

    A vector is usable if neither it nor an entry is null and all entries are finite.
    """
    lists = column.cast(pa.list_(pa.float64()))
    offsets, flat = lists.offsets.to_numpy(), lists.values
    sound = np.isfinite(flat.to_numpy(zero_copy_only=False)) if len(flat) else np.zeros(0, bool)
    sums = np.append(0, np.cumsum(~sound))
    lengths = np.diff(offsets)
    usable = lists.is_valid().to_numpy(zero_copy_only=False) & (sums[offsets[1:]] == sums[offsets[:-1]]) & (lengths > 0)
    values = flat.to_numpy(zero_copy_only=False)
    found = []
    for length in np.unique(lengths[usable]):
        rows = np.flatnonzero(usable & (lengths == length))
        matrix = values[offsets[rows][:, None] + np.arange(length)]
        found.append((rows, np.clip(np.floor(SCALE * matrix), -LARGEST, LARGEST).astype(np.int64)))
    return found


def pack_vectors(matrix: np.ndarray) -> list[bytes]:
    """Each row in the narrowest integers that hold it; equal rows, and no others, give equal bytes."""
    out: list[bytes] = [b""] * len(matrix)
    low, high = matrix.min(1), matrix.max(1)
    left = np.ones(len(matrix), bool)
    for code, kind in enumerate((np.int8, np.int16, np.int32, np.int64)):
        info = np.iinfo(kind)
        rows = np.flatnonzero(left & (low >= info.min) & (high <= info.max))
        left[rows] = False
        blob, width = matrix[rows].astype(kind).tobytes(), matrix.shape[1] * info.bits // 8
        for k, row in enumerate(rows.tolist()):
            out[row] = bytes([code]) + blob[k * width:(k + 1) * width]
    return out


def unpack_vectors(blobs: list[bytes]) -> dict[int, np.ndarray]:
    """The rows behind such bytes by length, in one matrix per length."""
    groups: dict[tuple[int, int], list[bytes]] = {}
    for blob in blobs:
        groups.setdefault((blob[0], len(blob) - 1), []).append(blob[1:])
    parts: dict[int, list[np.ndarray]] = {}
    for (code, size), rows in groups.items():
        kind = (np.int8, np.int16, np.int32, np.int64)[code]
        length = size // np.dtype(kind).itemsize
        parts.setdefault(length, []).append(np.frombuffer(b"".join(rows), kind).reshape(-1, length).astype(np.int64))
    return {length: np.concatenate(p) for length, p in parts.items()}


def scatter(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products of the columns of a matrix of whole numbers, as Python integers.

    Each column is shifted to begin at 0. Bit ``a`` of all its rows is one plane, 64 rows to a word; a plane that is
    empty is left out. Two planes have as many ones in common as the popcount of their AND, which counts
    ``2 ** (a + b)`` times. The shift is then taken back.
    """
    n, d = matrix.shape
    shift = matrix.min(0)
    moved = (matrix - shift).astype(np.uint64)
    planes, owner, weight = [], [], []
    for bit in range(int(moved.max()).bit_length()):
        ones = ((moved >> np.uint64(bit)) & np.uint64(1)).astype(bool)
        filled = np.flatnonzero(ones.any(0))
        packed = np.packbits(np.pad(ones[:, filled], ((0, -n % 64), (0, 0))), axis=0).T
        planes.append(np.ascontiguousarray(packed).view(np.uint64))
        owner.append(filled)
        weight.append(np.full(len(filled), bit))
    sums, products = np.zeros(d, object), np.zeros((d, d), object)
    if planes:
        words, of, bits = np.concatenate(planes), np.concatenate(owner), np.concatenate(weight)
        order = np.argsort(of, kind="stable")
        words, of, bits = words[order], of[order], bits[order]
        common = np.zeros((len(words), len(words)), np.int64)
        for k in range(len(words)):
            common[k, k:] = common[k:, k] = np.bitwise_count(words[k] & words[k:]).sum(1, dtype=np.int64)
        ones = np.diagonal(common).copy()
        # Beyond 63 bits Python's integers go on.
        kind = np.int64 if 2 * int(bits.max()) + n.bit_length() + 3 < 63 else object
        weights = np.array([1 << int(b) for b in bits], kind)
        starts = np.flatnonzero(np.append(True, np.diff(of) != 0))
        spread = of[starts]
        added = np.add.reduceat(np.add.reduceat(np.outer(weights, weights) * common, starts, 0), starts, 1)
        sums[spread] = np.add.reduceat(weights * ones, starts)
        products[np.ix_(spread, spread)] = added
    s = shift.astype(object)
    return sums + n * s, products + np.outer(s, sums) + np.outer(sums, s) + n * np.outer(s, s)


@dataclass(frozen=True)
class Whitening:
    """Fitted to ``n`` distinct vectors of one length: their sums (about the offset), axes as rows, and eigenvalues."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def scales(self) -> np.ndarray:
        """The root of each eigenvalue; nan where there is no spread but that of rounding."""
        floor = max(float(self.values.max(initial=0.0)), self.trace) * len(self.sums) * 2.0**-50
        return np.sqrt(np.where(self.values > floor, self.values, np.nan))

    def project(self, matrix: np.ndarray) -> np.ndarray:
        centred = centre(matrix, self.n, self.sums)
        return (centred.astype(np.float64) / self.n) @ self.axes.T / self.scales


def centre(matrix: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exactly: as 64-bit integers where these and the sum of their squares fit, else as Python's."""
    most = int(np.abs(matrix).max(initial=0)) * n + max(map(abs, sums))
    if most * most * matrix.shape[1] < 2**63:
        return matrix * np.int64(n) - np.array(sums, np.int64)
    return matrix.astype(object) * n - np.array(sums, object)


def solve(n: int, sums: list[int], products: np.ndarray, components: int = COMPONENTS) -> Whitening:
    """Axes and eigenvalues from exact sums and cross-products, which are centred before any rounding."""
    s = np.array(sums, object)
    covariance = ((n * products - np.outer(s, s)) / (n * n)).astype(np.float64)
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    axes = axes[:, order].T
    # Either sign will do; the largest entry is made positive.
    axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(1)[:, None], 1) < 0, -1.0, 1.0)
    return Whitening(n, [int(x) for x in sums], axes, values[order], float(np.trace(covariance)))


def distinct_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Each distinct vector of whole numbers once, as bytes. A vector with many copies is one row per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = {blob for _, matrix in whole_numbers(batch.column(0)) for blob in pack_vectors(matrix)}
            yield pa.RecordBatch.from_arrays([pa.array(list(blobs), pa.binary())], ["packed"])

    return vectors.select(column).mapInArrow(run, "packed binary").distinct()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Matrices of up to about ``BLOCK`` rows and ``64 * BLOCK`` numbers, of one length each."""
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for length, matrix in unpack_vectors(batch.column("packed").to_pylist()).items():
            held.setdefault(length, []).append(matrix)
            rows = sum(map(len, held[length]))
            if rows >= BLOCK or rows * length >= 64 * BLOCK:
                yield length, np.concatenate(held.pop(length))
    for length, parts in held.items():
        yield length, np.concatenate(parts)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """One whitening per length of vector.

    Tasks add up sums and cross-products; the driver gets one number for each pair of dimensions, however many rows
    there are. All sums are exact.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for length, matrix in _blocks(batches):
            sums, products = scatter(matrix)
            held = totals.setdefault(length, [0, np.zeros(length, object), np.zeros((length, length), object)])
            held[0], held[1], held[2] = held[0] + len(matrix), held[1] + sums, held[2] + products
        for length, (n, sums, products) in totals.items():
            upper = products[np.triu_indices(length)]
            values = [n, *sums.tolist(), *upper.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * len(values), pa.int32()), pa.array(range(len(values)), pa.int64()),
                 pa.array([str(v) for v in values])], ["length", "at", "value"])

    parts = distinct.mapInArrow(run, "length int, at long, value string")
    added = parts.groupBy("length", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    by_length: dict[int, dict[int, int]] = {}
    for row in added.toLocalIterator():
        by_length.setdefault(row.length, {})[row.at] = int(row.value)
    models = {}
    for length, found in by_length.items():
        products = np.zeros((length, length), object)
        upper = np.triu_indices(length)
        products[upper] = [found[1 + length + k] for k in range(len(upper[0]))]
        products = np.triu(products) + np.triu(products, 1).T
        models[length] = solve(found[0], [found[1 + k] for k in range(length)], products, components)
    return models


def identity_errors(distinct: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """Per length: how far the covariance of the whitened fit list, as computed, is from the identity at most.

    Components without spread have no scale and are left out; without any other the error is 0.
    """
    shared = distinct.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for length, matrix in _blocks(batches):
            white = shared.value[length].project(matrix)
            row = np.append(white.sum(0), (white.T @ white).ravel())
            totals[length] = totals.get(length, 0.0) + row
        for length, row in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * len(row), pa.int32()), pa.array(range(len(row)), pa.int64()), pa.array(row)],
                ["length", "at", "value"])

    parts = distinct.mapInArrow(run, "length int, at long, value double")
    sums = parts.groupBy("length", "at").agg(F.sum("value").alias("value")).collect()
    errors = {}
    for length, model in models.items():
        k = len(model.values)
        row = np.zeros(k + k * k)
        for r in sums:
            if r.length == length:
                row[r.at] = r.value
        means = row[:k] / model.n
        kept = np.isfinite(model.scales)
        apart = row[k:].reshape(k, k) / model.n - np.outer(means, means) - np.eye(k)
        errors[length] = float(np.abs(apart[np.ix_(kept, kept)]).max(initial=0.0))
    return errors


def whiten(
    vectors: DataFrame, staging: Staging | None = None, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row for each usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Null vectors, empty ones, and those with null or non-finite entries give no rows. Vectors of different lengths are
    fitted apart from each other, each length on its own distinct vectors. Repeated rows are fitted once and returned
    each; null or repeated ids are ids like others. A component without spread has a null ``whitened``; where nothing
    spreads ``explained`` is null. ``deviation`` is null where it does not fit a long. Entries beyond 2^38 count as
    that. An empty table gives no rows; other columns are not looked at. Components are as many as a vector is long,
    up to ``components``.
    """
    staging = staging or Staging(vectors.sparkSession, "whitening")
    distinct = staging.keep(distinct_vectors(vectors, column), "distinct")
    models = fit(distinct, components)
    errors = identity_errors(distinct, models)
    staging.drop("distinct")
    shared = vectors.sparkSession.sparkContext.broadcast((models, errors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, off = shared.value
        for batch in batches:
            for rows, matrix in whole_numbers(batch.column(1)):
                model = fitted[matrix.shape[1]]
                k = len(model.values)
                centred = centre(matrix, model.n, model.sums)
                squares = (centred * centred).sum(1)
                deviation = pa.array([s if s < 2**63 else None for s in squares.tolist()], pa.int64())
                white = model.project(matrix).ravel()
                shares = model.values / model.trace if model.trace > 0 else np.full(k, math.nan)
                each = np.repeat(np.arange(len(rows)), k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                     pa.array(np.full(len(each), model.n, np.int64)), deviation.take(pa.array(each)),
                     pa.array(white, mask=~np.isfinite(white)), pa.array(np.tile(shares, len(rows)), mask=np.tile(~np.isfinite(shares), len(rows))),
                     pa.array(np.full(len(each), off[matrix.shape[1]]))],
                    [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(key, column).mapInArrow(
        run, f"{key} {dict(vectors.dtypes)[key]}, component int, n long, deviation long, whitened double, explained double, "
             "identity_error double")
