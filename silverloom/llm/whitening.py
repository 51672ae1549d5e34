"""Embedding whitening by distributed block matrices.

Vectors become whole numbers x = floor(1024 c) + 100000. Their count n and sums S per dimension are exact; the centred rows
x - S/n are indexed and put into blocks of ``ROWS`` rows of an MLlib ``BlockMatrix`` X. X'X, multiplied over splits of the
long side so that no task meets all blocks, is the scatter; its d x d entries are decomposed on the driver (eigh). X times
the matrix W of unit eigenvectors over the roots of their eigenvalues projects every row onto the leading components.

What the driver holds: d sums, the d x d scatter, a number for each input partition, and MLlib's list of block indices (one
for each ``ROWS`` rows).

Cases: a row whose vector is null, empty or holds a null or non-finite entry takes no part. If vectors of several lengths
remain, those of the most frequent length (of several, the longest) are the table's and the others take no part. Null and
repeated ids are rows like others. A component without variance (an eigenvalue of at most 1e-12 of the largest) has null
``whitened``, and the identity is checked on the others. A deviation beyond a signed 64-bit number is an error. An empty
table gives an empty result. Further columns, of any name, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import materialize

SCALE, SHIFT = 1024, 100_000
#: Rows of a block, and blocks that one task of a product over the long side multiplies.
ROWS, SPLIT = 512, 16
#: Eigenvalues up to this share of the largest count as none.
NO_VARIANCE = 1e-12
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """The model: count and sums of the fit list, eigenvalues by falling size, and unit eigenvectors as columns."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray

    def matrix(self, components: int) -> np.ndarray:
        """d x components: eigenvectors over the roots of their eigenvalues; zero for a component without variance."""
        roots = np.where(self.varies(components), np.sqrt(np.maximum(self.values[:components], 0)), np.inf)
        return self.vectors[:, :components] / roots

    def varies(self, components: int) -> np.ndarray:
        return self.values[:components] > NO_VARIANCE * max(self.values[0], 0)

    def explained(self, components: int) -> np.ndarray:
        trace = self.values.sum()
        return self.values[:components] / trace if trace > 0 else np.zeros(len(self.values[:components]))


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, x (array of longs), at (place: the partition's number above bit 33), written: places stay as they are."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    usable = vectors.where(v.isNotNull() & (F.size(v) > 0) & ~bad)
    x = F.transform(v, lambda c: (F.floor(c.cast("double") * SCALE) + SHIFT).cast("bigint"))
    found = materialize(usable.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"), F.monotonically_increasing_id().alias("at")), "whole-vectors")
    lengths = found.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return found.where(F.size("x") == lengths[0].d) if lengths else found


def indexed(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with ``index``, gapless but where lengths were dropped: rows of the partitions before, plus the place within.

    And the number of indices.
    """
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    ends = {r.part: r.n for r in rows.groupBy(part.alias("part")).agg((F.max(place) + 1).alias("n")).collect()}
    before, starts = 0, []
    for p in sorted(ends):
        starts.append((int(p), before))
        before += ends[p]
    offsets = rows.sparkSession.createDataFrame(starts, "part long, offset long")
    placed = rows.withColumn("part", part.cast("long")).join(F.broadcast(offsets), "part")
    return placed.withColumn("index", F.col("offset") + place).drop("part", "offset"), before


def _numbers(values: tuple | list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def block_matrix(rows: DataFrame, row: Column, places: int, columns: int) -> BlockMatrix:
    """``row`` (array of doubles) at ``index`` as a BlockMatrix in one column of blocks; an index without a row is zero.

    The blocks are read by several products, so they are kept in memory and on disk; a lost one is made again.
    """
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(row).alias("vector")), "vector")
    return IndexedRowMatrix(vectors, places, columns).toBlockMatrix(ROWS, columns).persist(StorageLevel.MEMORY_AND_DISK)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """X'X. The long side is multiplied in splits of ``SPLIT`` blocks, each in a task of its own, and their sums are added."""
    side, blocks = matrix.numCols(), -(-matrix.numRows() // ROWS)
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, -(-blocks // SPLIT))
    return BlockMatrix(product, side, side).toLocalMatrix().toArray()


def project(matrix: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """index, y (array of doubles): the rows of ``matrix`` times ``weights``."""
    d, k = weights.shape
    sc = matrix._java_matrix_wrapper._sc
    by = BlockMatrix(sc.parallelize([((0, 0), DenseMatrix(d, k, weights.ravel(order="F")))], 1), d, k)
    product = matrix.multiply(by).toIndexedRowMatrix()
    rows = MLUtils.convertVectorColumnsToML(callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model), "vector")
    return rows.select(F.col("index"), vector_to_array("vector").alias("y"))


def fit(rows: DataFrame, places: int) -> tuple[Whitening, BlockMatrix] | None:
    """The model of all rows (vec_id, x, index below ``places``), and the matrix of the centred ones; None if there are none."""
    summed = rows.select(F.posexplode("x").alias("dim", "x")).groupBy("dim").agg(F.sum("x").alias("s"), F.count("*").alias("n")).orderBy("dim").collect()
    if not summed:
        return None
    n, sums = summed[0].n, tuple(r.s for r in summed)
    centred = block_matrix(rows, F.zip_with("x", _numbers([s / n for s in sums]), lambda x, mean: x.cast("double") - mean), places, len(sums))
    values, vectors = np.linalg.eigh(scatter(centred) / n)
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(sums))] < 0, -1.0, 1.0)
    return Whitening(n, sums, values[order], vectors), centred


def identity_error(model: Whitening, white: DataFrame, places: int, components: int) -> float:
    """Largest absolute entry of the covariance of ``y``, centred first, less the identity, over components that vary."""
    means = white.select(F.posexplode("y").alias("k", "y")).groupBy("k").agg(F.sum("y").alias("s")).orderBy("k").collect()
    centred = F.zip_with("y", _numbers([r.s / model.n for r in means]), lambda y, mean: y - mean)
    cov = scatter(block_matrix(white, centred, places, components)) / model.n
    varies = model.varies(components)
    return float(np.abs((cov - np.eye(components))[np.ix_(varies, varies)]).max(initial=0.0))


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows, places = indexed(whole_numbers(vectors, id_col, vector_col))
    fitted = fit(rows, places)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    model, centred = fitted
    k = min(components, len(model.sums))
    off = F.zip_with("x", _numbers(model.sums), lambda x, s: x * F.lit(model.n).cast("bigint") - s)
    deviation = F.aggregate(off, F.lit(0).cast("bigint"), lambda total, o: total + o * o)
    white = materialize(rows.select("index", "vec_id", deviation.alias("deviation")).join(project(centred, model.matrix(k)), "index"), "whitened")
    error = identity_error(model, white, places, k)
    each = white.select("vec_id", "deviation", F.posexplode("y").alias("at", "y"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        F.when(F.get(_numbers(model.varies(k).tolist()), F.col("at")), F.col("y")).alias("whitened"),
        F.get(_numbers(model.explained(k).tolist()), F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
