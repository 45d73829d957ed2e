"""Items that appear together: a blocked Gram matrix of baskets and items.

Baskets and items form a binary sparse matrix X. Items are dealt into item blocks and baskets into
record blocks; for each record block and each pair of item blocks one task forms the product of the
transposed left block with the right one, and the products are summed over the record blocks. A row is
sent to the pairs of its block with those that its basket has an item in, and to no others. Pairs exist
only as cells of a bounded block, never as rows expanded from a basket, so a basket or an item that holds a
third of all rows is spread over blocks as well.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import Scratch

#: Products held at once while a block pair is summed.
SLAB = 1 << 22


def gram(baskets: np.ndarray, left: np.ndarray, right: np.ndarray, n_left: int, n_right: int) -> np.ndarray:
    """Counts of common baskets, as n_left x n_right.

    baskets: for each entry its basket; left, right: the entry's item in the left and right block, or -1.
    """
    l_at, r_at = np.flatnonzero(left >= 0), np.flatnonzero(right >= 0)
    r_at = r_at[np.argsort(baskets[r_at], kind="stable")]
    r_items, size = right[r_at], np.bincount(baskets[r_at], minlength=baskets.max(initial=-1) + 1)
    first = np.cumsum(size) - size
    reps, out = size[baskets[l_at]], np.zeros(n_left * n_right, np.int64)
    upto = np.cumsum(reps)
    begin = 0
    while begin < len(l_at):
        end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + SLAB, "right")))
        rep, at = reps[begin:end], l_at[begin:end]
        inside = np.arange(rep.sum()) - np.repeat(np.cumsum(rep) - rep, rep)
        cells = np.repeat(left[at].astype(np.int64) * n_right, rep) + r_items[np.repeat(first[baskets[at]], rep) + inside]
        out += np.bincount(cells, minlength=len(out))
        begin = end
    return out.reshape(n_left, n_right)


def _block_pair(table: pa.Table) -> pa.Table:
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    code = lambda name: table.column(name).combine_chunks().dictionary_encode()
    items, baskets, block = code("item"), code("basket").indices.to_numpy().astype(np.int64), table.column("block").to_numpy()
    item = items.indices.to_numpy()

    def side(b: int) -> tuple[np.ndarray, np.ndarray]:
        known, local = np.unique(item[block == b], return_inverse=True)
        out = np.full(len(item), -1, np.int64)
        out[block == b] = local
        return known, out

    (l_items, left), (r_items, right) = side(i), side(j)
    counts = gram(baskets, left, right, len(l_items), len(r_items))
    if i == j:
        counts = np.triu(counts, 1)
    a, b = np.nonzero(counts)
    return pa.table({"a": items.dictionary.take(pa.array(l_items[a])), "b": items.dictionary.take(pa.array(r_items[b])), "n_ab": counts[a, b]})


def met_blocks(kept: DataFrame, blocks: int) -> DataFrame:
    """Rows (basket, item, block, r) once for each item block that the basket has an item in, as (.., i, j), i <= j.

    A basket's blocks, at most ``blocks`` numbers, are one row of a written table; with the rows they form
    a join that adaptive execution can split where a basket is hot, since nothing behind it needs its
    partitioning. With a single block there is nothing to meet.
    """
    if blocks == 1:
        return kept.withColumn("i", F.col("block")).withColumn("j", F.col("block"))
    there, _ = Scratch(kept.sparkSession).put(kept.groupBy("basket").agg(F.collect_set("block").alias("others")))
    met = kept.join(there, "basket").withColumn("other", F.explode("others")).drop("others")
    return met.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


def item_pairs(
    df: DataFrame,
    basket: str | Column,
    item: str | Column,
    min_count: int = 1,
    min_share: tuple[int, int] = (0, 1),
    item_block: int = 512,
    cell_rows: int = 500_000,
) -> DataFrame:
    """(item_a, item_b, n_ab, n_a, n_b, n, lift), item_a < item_b by bytes; lift is n_ab over its expected value.

    n, n_a, n_b and n_ab count distinct baskets: with any item, item a, item b, both. Kept are pairs with
    n_ab >= min_count and n_ab >= min_share (a fraction) of n; items too rare for that are left out before
    any pair is formed, which changes no result. Null baskets and null items take no part, repeated rows
    count once, other columns are ignored, an empty table gives no rows. item_block bounds a block's items
    on average, cell_rows the rows one task multiplies.
    """
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    cells = df.select(as_column(basket).cast("string").alias("basket"), as_column(item).cast("string").alias("item")).where("basket is not null and item is not null").distinct()
    n = cells.select("basket").distinct().count()
    least = max(min_count, math.ceil(n * min_share[0] / min_share[1]))
    marginals = cells.groupBy("item").agg(F.count(F.lit(1)).alias("n_item")).where(F.col("n_item") >= least)
    found = marginals.agg(F.count(F.lit(1)), F.sum("n_item"), F.max("n_item")).first()
    blocks = max(1, math.ceil(found[0] / item_block))
    # So many record blocks that a cell holds cell_rows rows on average, and no more of one item.
    records = max(1, math.ceil(2 * (found[1] or 0) / (blocks * cell_rows)), math.ceil((found[2] or 0) / cell_rows))

    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")
    kept = cells.join(marginals, "item", "left_semi").withColumn("block", block).withColumn("r", F.pmod(F.xxhash64("basket"), F.lit(records)).cast("int"))
    kept = met_blocks(kept, blocks)
    products = kept.groupBy("r", "i", "j").applyInArrow(_block_pair, "a string, b string, n_ab long")
    summed = products.groupBy(F.least("a", "b").alias("item_a"), F.greatest("a", "b").alias("item_b")).agg(F.sum("n_ab").alias("n_ab")).where(F.col("n_ab") >= least)
    for side in ("a", "b"):
        summed = summed.join(marginals.select(F.col("item").alias(f"item_{side}"), F.col("n_item").alias(f"n_{side}")), f"item_{side}")
    expected = F.col("n_a").cast("double") * F.col("n_b") / n if n else F.lit(None)
    return summed.select("item_a", "item_b", "n_ab", "n_a", "n_b", F.lit(n).cast("long").alias("n"), (F.col("n_ab") / expected).alias("lift"))
