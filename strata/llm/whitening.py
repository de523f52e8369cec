"""Embedding whitening with MLlib's distributed block matrices.

1. *Rows.* Every entry becomes a whole number (``SCALE`` to one, rounded down), so that equal vectors, counts and sums are
   exact. Rows get consecutive indices and are written to the shared folder.
2. *Fit list.* Each different vector once; equal ones are combined in the tasks that read them, so a vector that
   a third of all rows share is no hot key.
3. *Scatter.* The centred fit rows are indexed into a BlockMatrix; its transpose times itself is the scatter
   matrix. The long middle dimension is cut into splits of a few blocks, which are multiplied apart and added up.
4. *Eigenvectors.* The scatter matrix has one row and column per dimension, whatever the number of rows; its
   eigenvectors are found on the driver.
5. *Projection.* All rows, centred, as a BlockMatrix times the whitening matrix (eigenvectors over the square roots of
   eigenvalues). A row finds its projection by its own index, which is unique.

All of it runs in the JVM; what reaches the driver is d x d numbers and the indices of blocks of ``BLOCK`` rows.

Odd rows: a vector that is null, empty or holds a null, NaN or infinity takes no part, nor does one
of another length than most (of equally frequent lengths, the longest counts). Repeated rows and null ids are
projected like any other. Directions without spread (eigenvalue 0 up to rounding) are no components, so fewer than
``components`` may come back, and none for an empty table or one with a single different vector.
Other columns do not matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import keep

#: Steps per unit to which entries are rounded down.
SCALE = 256
COMPONENTS = 4
#: Rows of one block: 2 MB of doubles at 64 dimensions.
BLOCK = 4_096
#: Blocks that one split of the middle dimension multiplies.
SPLIT = 8
#: Columns of one block; longer vectors take several.
COLUMNS = 1_024
_EXACT = "decimal(38,0)"


def whole(vector: Column) -> Column:
    """The vector in whole steps, or null where it takes no part."""
    sound = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return F.when(sound & (F.size(vector) > 0), F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE)))


def _indexed(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written, with ``index`` counting from 0 without gaps."""
    placed = rows.withColumn("part", F.spark_partition_id()).withColumn("local", F.monotonically_increasing_id())
    placed = keep(placed.withColumn("local", F.col("local") - F.shiftleft(F.col("part").cast("long"), 33)), label)
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row per task of the step before.
    offsets = sizes.select(
        "part", F.expr("coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("offset")
    )
    return placed.join(offsets, "part").withColumn("index", F.col("local") + F.col("offset")).drop("part", "local", "offset")


def _blocks(centred: DataFrame, rows: int, columns: int, block: int) -> BlockMatrix:
    """(index, centred array of doubles) as a BlockMatrix."""
    vectors = centred.select("index", array_to_vector("centred").alias("vector"))
    vectors = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    return IndexedRowMatrix(vectors, rows, columns).toBlockMatrix(block, min(COLUMNS, columns))


def _scatter(matrix: BlockMatrix, splits: int) -> np.ndarray:
    """The transpose times the matrix; the rows are the middle dimension and are cut into splits."""
    across = matrix.transpose()._java_matrix_wrapper
    product = across.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def _projected(spark: SparkSession, matrix: BlockMatrix, whitener: np.ndarray) -> DataFrame:
    """(index, w): the matrix times a small one."""
    d, k = whitener.shape
    tall = matrix.colsPerBlock
    pieces = [
        ((i, 0), Matrices.dense(len(part), k, part.ravel(order="F")))
        for i, part in enumerate(whitener[a : a + tall] for a in range(0, d, tall))
    ]
    right = BlockMatrix(spark.sparkContext.parallelize(pieces, 1), tall, k, d, k)
    rows = matrix.multiply(right).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)
    return found.select("index", vector_to_array("vector").alias("w"))


def fit(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The whitening matrix, and the share of the trace of each component."""
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    spread = values > max(1e-12 * np.trace(covariance), 0.0)
    values, vectors = values[spread], vectors[:, spread]
    return vectors / np.sqrt(values), values / np.trace(covariance)


def _schema(vectors: DataFrame) -> T.StructType:
    ident = vectors.schema["vec_id"].dataType.simpleString()
    return T._parse_datatype_string(
        f"vec_id {ident}, component int, n long, deviation {_EXACT}, whitened double, explained double, identity_error double"
    )


def whiten(vectors: DataFrame, components: int = COMPONENTS, block: int = BLOCK) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of the rows of (vec_id, embedding)."""
    spark, empty = vectors.sparkSession, _schema(vectors)
    taken = vectors.select("vec_id", whole(F.col("embedding")).alias("x")).where("x IS NOT NULL")
    lengths = taken.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], empty)
    d = lengths[0].d
    rows = _indexed(taken.where(F.size("x") == d), "whiten")
    total = rows.count()
    different = _indexed(rows.groupBy("x").agg(F.min("index").alias("one")), "whiten")
    sums = different.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[j].cast(_EXACT)).alias(f"s{j}") for j in range(d)]
    ).first()
    n, sums = sums[0], [int(s) for s in sums[1:]]
    means = F.array(*[F.lit(s / n) for s in sums])
    centre = F.zip_with("x", means, lambda x, m: x.cast("double") - m).alias("centred")

    matrix = _blocks(different.select("index", centre), n, d, block)
    whitener, explained = fit(_scatter(matrix, max(1, -(-n // (block * SPLIT)))), n, components)
    k = whitener.shape[1]
    if not k:
        return spark.createDataFrame([], empty)

    projected = keep(_projected(spark, _blocks(rows.select("index", centre), total, d, block), whitener), "whiten")
    error = _identity_error(projected.join(different.select(F.col("one").alias("index")), "index"), n, k)
    exact = F.array(*[F.lit(str(s)).cast(_EXACT) for s in sums])
    deviation = F.aggregate(
        F.zip_with("x", exact, lambda x, s: x.cast(_EXACT) * F.lit(n).cast("decimal(19,0)") - s),
        F.lit(0).cast(_EXACT),
        lambda sum_, v: (sum_ + (v * v).cast(_EXACT)).cast(_EXACT),
    )
    shares = F.array(*[F.lit(float(e)) for e in explained])
    joined = rows.select("index", "vec_id", deviation.alias("deviation")).join(projected, "index")
    out = joined.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """The largest entry of the whitened fit rows' covariance minus the identity."""
    w = [F.col("w")[i] for i in range(k)]
    means = whitened.agg(*[(F.sum(c) / n) for c in w]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    moments = whitened.agg(*[(F.sum((w[i] - means[i]) * (w[j] - means[j])) / n) for i, j in pairs]).first()
    return max(abs(m - (i == j)) for (i, j), m in zip(pairs, moments))
