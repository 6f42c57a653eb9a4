"""Products of matrices in long form, block by block.

Rows, inner indices and columns are any values; a hash deals each of them out over blocks. A tile
of ``a`` (a block of rows and of inner indices) goes to every block of columns, a tile
of ``b`` to every block of rows, and where two tiles meet one task multiplies them and sums
over their inner indices. What meets under one key is a pair of tiles, however many cells an index has.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.durable import materialize_measured

#: rows and columns of a block of the result, and cells of a tile
SIDE = 512
TILE_CELLS = 100_000
# products that are written out at a time
_AT_ONCE = 1 << 22


def _cells(df: DataFrame, outer: str) -> tuple[DataFrame, dict]:
    """One row per cell, and how many cells and (roughly) values of the ``outer`` index there are."""
    held = df.where("k IS NOT NULL").groupBy(outer, "k").agg(F.sum(F.col("v").cast("double")).alias("v")).where("v IS NOT NULL")
    return materialize_measured(held, "cells", {"cells": F.count(F.lit(1)), outer: F.approx_count_distinct(outer)})


def _block(value: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(blocks)).cast("int")


def _most_in_a_block(df: DataFrame, value: str, blocks: int, cells: int) -> int:
    if blocks == 1:
        return cells
    counts = df.groupBy(_block(value, blocks).alias("block")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def _codes(*columns: pa.ChunkedArray) -> tuple[list[np.ndarray], pa.Array]:
    """Each column's values as places in the list of all distinct values, null and NaN being values."""
    joined = pa.chunked_array([c for column in columns for c in column.chunks], columns[0].type).combine_chunks()
    coded = joined.dictionary_encode(null_encoding="encode")
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(codes, np.cumsum([len(c) for c in columns])[:-1]), coded.dictionary


def multiply_tiles(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Rows, columns and values of the cells that have a product, and what rows and columns stand for.

    A dense product costs all of the two tiles' sides, products written out one by one cost their
    number; the cheaper is taken. The dense one is left out where a value is not finite, as it would
    multiply it with cells that are not there.
    """
    [row], rows = _codes(a.column("i"))
    [column], columns = _codes(b.column("j"))
    (left, right), inner = _codes(a.column("k"), b.column("k"))
    x, y = a.column("v").to_numpy(), b.column("v").to_numpy()
    per_left, per_right = (np.bincount(k, minlength=len(inner)) for k in (left, right))
    products = int((per_left * per_right).sum())
    shape = (len(rows), len(columns))
    if products > shape[0] * shape[1] * len(inner) / 16 and np.isfinite(x).all() and np.isfinite(y).all():
        dense = [np.zeros((n, len(inner))) for n in shape]
        there = [np.zeros((n, len(inner)), np.float32) for n in shape]
        for d, t, at, k, v in zip(dense, there, (row, column), (left, right), (x, y)):
            d[at, k], t[at, k] = v, 1
        i, j = np.nonzero(there[0] @ there[1].T)
        return i, j, (dense[0] @ dense[1].T)[i, j], rows, columns
    # cells of b by inner index; each cell of a meets those of its own
    order = np.argsort(right, kind="stable")
    begins = np.cumsum(per_right) - per_right
    meets = per_right[left]
    upto = np.concatenate([[0], np.cumsum(meets)])
    total, seen = np.zeros(shape[0] * shape[1]), np.zeros(shape[0] * shape[1], bool)
    first = 0
    while first < len(left):
        after = max(first + 1, int(np.searchsorted(upto, upto[first] + _AT_ONCE, "right")) - 1)
        n = meets[first:after]
        of = np.repeat(np.arange(first, after), n)
        other = order[np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + begins[left[of]]]
        at = row[of] * shape[1] + column[other]
        total += np.bincount(at, x[of] * y[other], minlength=len(total))
        seen[at] = True
        first = after
    at = np.flatnonzero(seen)
    return at // shape[1], at % shape[1], total[at], rows, columns


def matrix_product(a: DataFrame, b: DataFrame, side: int = SIDE, tile_cells: int = TILE_CELLS) -> DataFrame:
    """Product of long-form matrices ``a(i, k, v)`` and ``b(k, j, v)`` as ``(i, j, v)``, ``v`` as double.

    Cells given several times are summed first. Cells without a value, or without an inner index, are
    not there; a null row or column is one of its own. The result has the cells that meet under some
    inner index. Blocks of rows and columns have about ``side`` of them; there are as many blocks of
    inner indices as keep the fullest row or column of blocks at about ``tile_cells`` a tile, so one index with a
    third of all cells is dealt out like the others. Each cell of ``a`` is sent once per block of
    columns, each of ``b`` once per block of rows; the result is shuffled once per block of inner indices at most.
    """
    (left, a_seen), (right, b_seen) = _cells(a, "i"), _cells(b, "j")
    row_blocks, column_blocks = max(1, ceil(a_seen["i"] / side)), max(1, ceil(b_seen["j"] / side))
    fullest = max(_most_in_a_block(left, "i", row_blocks, a_seen["cells"]), _most_in_a_block(right, "j", column_blocks, b_seen["cells"]))
    inner_blocks = max(1, ceil(fullest / tile_cells))
    grid = ["__rows", "__columns", "__inner"]

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    tiles_a = left.select("i", "k", "v", _block("i", row_blocks).alias(grid[0]), _block("k", inner_blocks).alias(grid[2])).withColumn(grid[1], every(column_blocks))
    tiles_b = right.select("k", "j", "v", _block("j", column_blocks).alias(grid[1]), _block("k", inner_blocks).alias(grid[2])).withColumn(grid[0], every(row_blocks))

    def multiply(x: pa.Table, y: pa.Table) -> pa.Table:
        i, j, v, rows, columns = multiply_tiles(x, y)
        return pa.table({"i": rows.take(pa.array(i)), "j": columns.take(pa.array(j)), "v": pa.array(v)})

    kinds = f"i {left.schema['i'].dataType.simpleString()}, j {right.schema['j'].dataType.simpleString()}, v double"
    partial = tiles_a.groupBy(*grid).cogroup(tiles_b.groupBy(*grid)).applyInArrow(multiply, kinds)
    return partial.groupBy("i", "j").agg(F.sum("v").alias("v"))
