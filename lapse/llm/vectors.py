"""Vectors of a table as checked, numbered rows, and the dealing of searches into bounded cells.

A search of some rows (queries) against all rows (candidates) is cut into a grid: the candidates of a key
into cells, the queries into blocks, and one task group meets one cell with one block. Both have a fixed size, so
no group grows with the table, however many rows a key has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData

from lapse.llm.common import staged

#: Candidates of a cell and queries of a block, about.
CELL_ROWS, BLOCK_ROWS = 16_384, 2_048


def _finite(x: Column) -> Column:
    x = x.cast("double")
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def numbered(rows: DataFrame, id_col: str, vector_col: str, label_col: str | None = None, name: str = "vectors") -> tuple[DataFrame, int]:
    """((rid, id, label, vec) written once, components of a vector).

    Rows whose vector is null, empty, or holds a null or non-finite component are left out. So are vectors of another
    length than most vectors have (of two such lengths the greater): they can't be compared. ``rid`` numbers the
    rows, so that rows that repeat an id, or have none, are still told apart.
    """
    vec = F.col(vector_col)
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    whole = rows.select(F.col(id_col).alias("id"), label.alias("label"), vec.alias("vec")).where(
        F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", _finite))
    lengths = whole.groupBy(F.size("vec").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("w")).first()
    width = most["w"] if most else 0
    return staged(whole.where(F.size("vec") == width).select(F.monotonically_increasing_id().alias("rid"), "id", "label", "vec"), name), width


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """An Arrow column of lists without nulls as a (rows, width) matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        return np.zeros((0, width))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def parts_of(count: int | Column, size: int) -> Column:
    count = count if isinstance(count, Column) else F.lit(count)
    return F.greatest(F.lit(1), F.ceil(count / F.lit(size))).cast("int")


def grid(candidates: DataFrame, queries: DataFrame, keys: list[str]) -> tuple[GroupedData, GroupedData]:
    """The groups (keys, cell, block) of both sides, to be joined by ``cogroup``.

    Both sides have ``rid`` and, the same for all rows of a key, ``cells`` and ``blocks``: the parts that its
    candidates and its queries are cut into. Every query meets every candidate of its key once.
    """
    def part(n: str) -> Column:
        return F.pmod(F.xxhash64("rid"), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = candidates.withColumn("cell", part("cells")).withColumn("block", every("blocks")).drop("cells", "blocks")
    right = queries.withColumn("block", part("blocks")).withColumn("cell", every("cells")).drop("cells", "blocks")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # both sides may come from one table: columns of its own
    return left.groupBy(*keys, "cell", "block"), right.groupBy(*keys, "cell", "block")


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
