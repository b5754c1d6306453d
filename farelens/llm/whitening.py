"""Whitening of embeddings from an exact integer covariance.

An entry c becomes the integer floor(scale * c) + shift. Sums and cross-products
of these integers are gathered bit-sliced: in each block of rows a dimension is
lowered by its smallest value there, and each bit of what is left, over all rows
of the block, is packed into 64-bit words (a bit plane). The cross-product of
two dimensions is then the sum over pairs of their planes of 2 ** (a + b) times
the number of ones the planes have in common. Lowering is undone exactly, blocks
add up exactly (Spark sums them as limbs of 30 bits), and the covariance is
centred as integers, n * sum(x * y) - sum(x) * sum(y), before the eigenvalues
are taken. A row costs bits * dimensions words of a 64th; what leaves a task is
one row per pair of dimensions, whatever its input.

The driver holds matrices of dimensions by dimensions, which do not grow with
the rows. Covariances of results are Spark aggregates.

Edge cases: a null vector and one that holds null or non-finite entries are
dropped; the dimension is the commonest length of what remains (of equally
common ones the longer), and vectors of other lengths are dropped too; integers
beyond 2 ** 62 stand at 2 ** 62, and a deviation of over 38 digits is null; null
ids and repeated rows count each by itself; components whose eigenvalue is zero
up to rounding (constant or dependent dimensions) cannot be whitened and are
left out, so that an empty table, a single vector or equal vectors give no rows;
further columns, whatever their names, pass through ``whiten``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.llm.common import fresh, stored

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Rows of a block, a multiple of 64; bits and number of the limbs that carry
#: integers between tasks.
BLOCK, LIMB, LIMBS = 4096, 30, 6
_LARGEST, _DECIMAL = 1 << 62, 10**38


def usable(vector: Column, length: int) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & (F.size(vector) == length) & ~F.coalesce(bad, F.lit(True))


def commonest_length(vectors: DataFrame, column: str) -> int:
    v = F.col(f"`{column}`")
    sizes = vectors.select(F.size(v).alias("fl_size"), usable(v, F.size(v)).alias("fl_ok")).filter("fl_ok")
    row = sizes.groupBy("fl_size").agg(F.count("*").alias("fl_n")).orderBy(F.desc("fl_n"), F.desc("fl_size")).first()
    return row["fl_size"] if row else 0


def integers(values: np.ndarray, scale: int, shift: int) -> np.ndarray:
    x = np.floor(values.astype("f8") * scale)
    return np.clip(x, -float(_LARGEST), float(_LARGEST)).astype("i8").clip(-_LARGEST, _LARGEST - abs(shift)) + shift


def planes(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Of non-negative integers (rows, dimensions): the bit planes (plane,
    words), the weight of each as a power of two, and the first plane of each
    dimension (with the end)."""
    rows, dimensions = block.shape
    words = np.zeros((-(-rows // 64) * 64, dimensions), "u8")
    words[:rows] = block
    bits = [int(m).bit_length() for m in block.max(axis=0)]
    made, weights, first = [], [], [0]
    for d, n in enumerate(bits):
        for b in range(n):
            made.append(np.packbits((words[:, d] >> np.uint64(b)).astype("u1") & 1).view("u8"))
        weights += range(n)
        first.append(len(weights))
    return (np.array(made, "u8") if made else np.zeros((0, len(words) // 64), "u8")), np.array(weights, "i8"), first


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums (dimensions) and cross-products (dimensions, dimensions) of
    the integers ``x`` (rows, dimensions), as Python integers."""
    rows, dimensions = x.shape
    low = x.min(axis=0)
    plane, weight, first = planes((x - low).astype("u8"))
    starts = np.array(first[:-1])
    full = np.zeros((dimensions, dimensions), object)
    for d in range(dimensions):
        for p in range(first[d], first[d + 1]):
            # Common ones of this plane and of every plane of d and later.
            ones = np.bitwise_count(plane[p] & plane[first[d]:]).sum(axis=1, dtype="i8")
            if weight[-1:].size and int(weight.max()) * 2 + rows.bit_length() < 61:
                summed = np.add.reduceat(np.append(ones << (weight[first[d]:] + weight[p]), 0), starts[d:] - first[d])
                # reduceat gives a lone element where a dimension has no plane.
                summed[np.diff(first[d:]) == 0] = 0
                full[d, d:] += summed
            else:
                for e in range(d, dimensions):
                    for q in range(first[e], first[e + 1]):
                        full[d, e] += int(ones[q - first[d]]) << int(weight[q] + weight[p])
    lowered = np.array([sum(int(np.bitwise_count(plane[p]).sum()) << int(weight[p]) for p in range(first[d], first[d + 1]))
                        for d in range(dimensions)] or [0] * dimensions, object)
    low = low.astype(object)
    full = np.triu(full, 1).T + full
    outer = np.outer(lowered, low)
    return lowered + rows * low, full + outer + outer.T + rows * np.outer(low, low)


def _limbs(value: int) -> list[int]:
    """``value`` as limbs; the last one has its sign."""
    low = [(value >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(LIMBS - 1)]
    return [*low, value >> (LIMB * (LIMBS - 1))]


@dataclass(frozen=True)
class Scatter:
    n: int
    sums: tuple[int, ...]
    products: np.ndarray  # Python integers

    def centred(self) -> np.ndarray:
        """n * n times the covariance, Python integers."""
        s = np.array(self.sums, object)
        return self.n * self.products - np.outer(s, s)


def blocks(batches: Iterator[pa.RecordBatch], column: str, scale: int, shift: int) -> Iterator[np.ndarray]:
    for b in batches:
        for i in range(0, b.num_rows, BLOCK):
            part = b.slice(i, BLOCK).column(column)
            if len(part):
                yield integers(part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1), scale, shift)


def scatter(vectors: DataFrame, column: str, length: int, scale: int = SCALE, shift: int = SHIFT) -> Scatter:
    """Exact n, sums and cross-products over all rows of ``vectors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(length, object), np.zeros((length, length), object)
        held: list[np.ndarray] = []

        def take() -> None:
            nonlocal n, sums, products
            x = np.concatenate(held)
            s, p = cross_products(x)
            n, sums, products = n + len(x), sums + s, products + p
            held.clear()

        for x in blocks(batches, column, scale, shift):
            held.append(x)
            if sum(map(len, held)) >= BLOCK:
                take()
        if held:
            take()
        if n:
            rows = [(-1, -1, n), *((i, -1, sums[i]) for i in range(length))]
            rows += [(i, j, products[i, j]) for i in range(length) for j in range(i, length)]
            limbs = list(zip(*(_limbs(int(v)) for _, _, v in rows), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), *(pa.array(c, pa.int64()) for c in limbs)],
                names=["i", "j", *(f"l{k}" for k in range(LIMBS))])

    only = vectors.select(F.col(f"`{column}`").cast("array<double>").alias(column))
    parts = only.mapInArrow(run, "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS)))
    total = parts.groupBy("i", "j").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS))).collect()  # dimensions squared rows
    value = {(r["i"], r["j"]): sum(r[f"l{k}"] << (LIMB * k) for k in range(LIMBS)) for r in total}
    products = np.zeros((length, length), object)
    for (i, j), v in value.items():
        if j >= 0:
            products[i, j] = products[j, i] = v
    return Scatter(value.get((-1, -1), 0), tuple(value.get((i, -1), 0) for i in range(length)), products)


@dataclass(frozen=True)
class Whitening:
    scatter: Scatter
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # (dimensions, components)
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace


def fit(vectors: DataFrame, column: str, length: int, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening:
    """``vectors``: usable ones of ``length`` only."""
    found = scatter(vectors, column, length, scale, shift)
    if not found.n or not length:
        return Whitening(found, np.zeros(0), np.zeros((length, 0)), 0.0)
    exact = found.centred()
    square = found.n * found.n
    covariance = np.array([[float(Fraction(int(v), square)) for v in row] for row in exact])
    trace = float(Fraction(sum(int(exact[i, i]) for i in range(length)), square))
    values, directions = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = [k for k in order if values[k] > max(1, length) * np.finfo("f8").eps * max(values.max(), 0)]
    return Whitening(found, values[order], directions[:, order], trace)


def apply(vectors: DataFrame, column: str, model: Whitening, whitened: str = "whitened", deviation: str = "deviation",
          scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vectors`` without ``column``, plus ``deviation`` (exact sum of the
    squares of n * x - S, decimal(38, 0)) and ``whitened`` (array<double>)."""
    rest = [f for f in vectors.schema.fields if f.name != column]
    n, sums = model.scatter.n, model.scatter.sums
    exact = np.array(sums, object)
    project = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, BLOCK):
                part = b.slice(i, BLOCK)
                x = next(blocks(iter([part]), column, scale, shift))
                # Int64 where it surely holds the squares' sum.
                reach = n * int(np.abs(x).max()) + max(map(abs, sums))
                far = n * x - np.array(sums, "i8") if reach < 1 << 62 else n * x.astype(object) - exact
                most = int(np.abs(far).max())
                squares = ((far if most * most * len(sums) < 1 << 62 else far.astype(object)) ** 2).sum(axis=1)
                out = (far.astype("f8") / n) @ project
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in rest), pa.array([Decimal(int(s)) if s < _DECIMAL else None for s in squares], pa.decimal128(38, 0)),
                     pa.array(list(out), pa.list_(pa.float64()))], names=[*(f.name for f in rest), deviation, whitened])

    return vectors.mapInArrow(run, T.StructType([*rest, T.StructField(deviation, T.DecimalType(38, 0)), T.StructField(whitened, T.ArrayType(T.DoubleType()))]))


def identity_error(whitened: DataFrame, column: str, components: int) -> float:
    """Largest absolute entry of the covariance of ``column`` minus the
    identity. Spark's covariances are centred before they multiply."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    row = whitened.agg(*(F.covar_pop(F.get(column, F.lit(i)), F.get(column, F.lit(j))).alias(f"c{k}") for k, (i, j) in enumerate(pairs))).first()
    return max((abs(row[k] - (i == j)) for k, (i, j) in enumerate(pairs)), default=0.0)


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """A row for each usable vector and component: the other columns of
    ``vectors``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``; a clashing column of ``vectors`` keeps
    its name and the made one gets an underscore."""
    length = commonest_length(vectors, column)
    kept = vectors.filter(usable(F.col(f"`{column}`"), length)).withColumn(column, F.col(f"`{column}`").cast("array<double>"))
    model = fit(kept, column, length, components, scale, shift)
    names = {k: fresh(vectors, k) for k in ("component", "n", "deviation", "whitened", "explained", "identity_error")}
    found = len(model.values)
    rest = [F.col(f"`{c}`") for c in vectors.columns if c != column]
    shape = ("int", "long", "decimal(38,0)", "double", "double", "double")
    if not found:
        return kept.filter("false").select(*rest, *(F.lit(None).cast(t).alias(c) for c, t in zip(names.values(), shape, strict=True)))
    held = stored(apply(kept, column, model, names["whitened"], names["deviation"], scale, shift), "whitened")
    error = identity_error(held, names["whitened"], found)
    at, value = fresh(held, "fl_at"), fresh(held, "fl_value")
    rows = held.select("*", F.posexplode(F.col(f"`{names['whitened']}`")).alias(at, value))
    return rows.select(
        *rest, (F.col(at) + 1).alias(names["component"]), F.lit(model.scatter.n).cast("long").alias(names["n"]), F.col(f"`{names['deviation']}`"),
        F.col(value).alias(names["whitened"]), F.get(F.array(*(F.lit(float(e)) for e in model.explained)), F.col(at)).alias(names["explained"]),
        F.lit(error).alias(names["identity_error"]))
