"""Leading components of wide vectors by randomised subspace iteration.

The covariance of ``width`` slots has their square of cells; its product with a few columns has ``width`` times a few. A round
multiplies it with a basis in one pass over the rows: each task sums x (x . basis) over its rows, the tasks' sums are
added up in a tree, and the result, made orthonormal, is the next basis. The variances along the basis rise to
those of the leading components, and the rounds end when they stand still.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casewise.sources.readers import literal_table
from casewise.sources.storage import staged

EXTRA = 10  # columns of the basis beyond the components asked for
ROUNDS = 60
STILL = 1e-9  # relative change of the variances at which the rounds end
_FAN = 32


@dataclass(frozen=True)
class Components:
    """``basis`` has a column per component, ``variances`` fall, ``total`` is the variance of all slots together."""

    basis: np.ndarray
    variances: np.ndarray
    total: float
    rows: int

    def shares(self, spark) -> DataFrame:
        """(component, variance): the explained share of every component, from 1."""
        parts = [(i, float(v) / self.total if self.total else 0.0) for i, v in enumerate(self.variances, 1)]
        return literal_table(spark, parts, "component int, variance double")


def sparse_rows(df: DataFrame, vector: str) -> DataFrame:
    """(indices, values) of a vector column of either kind; null vectors are left out."""
    parts = F.unwrap_udt(vector)
    dense = F.transform(parts["values"], lambda _, i: i)
    found = df.where(F.col(vector).isNotNull()).select(F.coalesce(parts["indices"], dense).alias("indices"), parts["values"].alias("values"))
    return found


def _rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots, values, and the row of each."""
    indices, values = batch.column("indices"), batch.column("values")
    of = np.repeat(np.arange(len(batch)), np.diff(indices.offsets.to_numpy()))
    return indices.flatten().to_numpy(zero_copy_only=False).astype(np.int64), values.flatten().to_numpy(zero_copy_only=False), of


def _block(array: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([array.astype(np.float64).tobytes()], pa.binary())], ["block"])


def _moments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, squares, rows = np.zeros(width), np.zeros(width), 0
        for batch in batches:
            slots, values, _ = _rows_of(batch)
            sums += np.bincount(slots, values, width)
            squares += np.bincount(slots, values * values, width)
            rows += len(batch)
        yield _block(np.concatenate([sums, squares, [rows]]))

    return run


def _products(basis: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(basis.shape)
        for batch in batches:
            slots, values, of = _rows_of(batch)
            for column in range(basis.shape[1]):
                along = np.bincount(of, values * basis[slots, column], len(batch))
                total[:, column] += np.bincount(slots, values * along[of], len(basis))
        yield _block(total)

    return run


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(block, np.float64) for block in table.column("block").to_pylist())
    return pa.Table.from_batches([_block(total)])


def tree_sum(blocks: DataFrame, parts: int) -> np.ndarray:
    """The sum of as many blocks of numbers as there are ``parts``, added up ``_FAN`` at a time on the executors."""
    while parts > _FAN:
        parts = math.ceil(parts / _FAN)
        numbered = blocks.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(parts)))
        blocks = numbered.groupBy("part").applyInArrow(lambda t: _added(t.select(["block"])), "block binary")
    return sum(np.frombuffer(row["block"], np.float64) for row in blocks.collect())


def leading_components(rows: DataFrame, width: int, k: int, extra: int = EXTRA, rounds: int = ROUNDS, seed: int = 42) -> Components:
    """The ``k`` components of the largest variance of rows (indices, values) with ``width`` slots.

    The driver holds ``width`` times ``k + extra`` numbers, never a square of ``width``; slots are bounded by the caller's
    vocabulary. Fewer rows or slots than ``k`` give variances of 0 at the end. Rows are written once and read once a round.
    """
    rows = staged(rows.select("indices", "values"), "vectors")
    parts = rows.rdd.getNumPartitions()
    found = tree_sum(rows.mapInArrow(_moments(width), "block binary"), parts) if parts else np.zeros(2 * width + 1)
    n = int(found[-1])
    mean, squares = found[:width] / max(1, n), found[width : 2 * width]
    free = max(1, n - 1)
    total = float((squares - n * mean * mean).sum() / free)
    size = min(width, k + extra)
    basis, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, size)))
    before = None
    for _ in range(rounds):
        product = tree_sum(rows.mapInArrow(_products(basis), "block binary"), parts).reshape(width, size) if parts else np.zeros((width, size))
        product = (product - n * np.outer(mean, mean @ basis)) / free
        inner = basis.T @ product
        variances, turned = np.linalg.eigh((inner + inner.T) / 2)
        variances, turned = variances[::-1], turned[:, ::-1]
        if size == width or (before is not None and np.abs(variances - before)[:k].max() <= STILL * max(variances[0], 1e-300)):
            break
        before = variances
        basis, _ = np.linalg.qr(product)
    columns = (basis @ turned)[:, :k]
    signs = np.sign(columns[np.abs(columns).argmax(axis=0), np.arange(columns.shape[1])])
    return Components(columns * np.where(signs == 0, 1, signs), np.maximum(variances[:k], 0.0), total, n)


def projected(df: DataFrame, vector: str, found: Components, output: str = "components") -> DataFrame:
    """``df`` with its vector's coordinates along the components, as an array; null for a null vector."""
    basis = found.basis

    @F.pandas_udf("array<double>")
    def along(indices: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([None if i is None else (basis[i] * v[:, None]).sum(axis=0) for i, v in zip(indices, values, strict=True)])

    parts = F.unwrap_udt(vector)
    dense = F.transform(parts["values"], lambda _, i: i)
    return df.withColumn(output, along(F.coalesce(parts["indices"], dense), parts["values"]))
