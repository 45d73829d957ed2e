"""Filling of fixed-capacity containers: sum-of-squares online packing.

Each shard of items keeps an array with the number of open containers at every fill level. An item goes to
the level (or a new container) after which the sum of the squares of these numbers is least; this keeps the
levels evenly used, so that for later items a level that they fill exactly is at hand. Shards are drawn by
hash and hold a bounded number of items, so that each is one small task whatever the corpus.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import Scratch
from . import bpe


#: Copies unrolled from one row.
CHUNK = 4096


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container of each item, in the order given; sizes are between 1 and capacity."""
    open_at = np.zeros(capacity + 1, np.int64)  # the last stays 0: full containers don't count
    waiting: list[list[int]] = [[] for _ in range(capacity)]
    out = np.empty(len(sizes), np.int64)
    used = 0
    for k, s in enumerate(sizes.tolist()):
        best, cost = 0, 2 * int(open_at[s]) + 1 if s < capacity else 0
        if s < capacity:
            source = open_at[1 : capacity - s + 1]
            level = np.flatnonzero(source)
            if len(level):
                delta = 2 * (open_at[level + 1 + s] - source[level]) + 2
                if level[-1] == capacity - s - 1:
                    delta[-1] -= 1
                least = len(delta) - 1 - int(np.argmin(delta[::-1]))  # of equal ones the fullest
                if delta[least] <= cost:
                    best, cost = int(level[least]) + 1, int(delta[least])
        if best:
            at = waiting[best].pop()
            open_at[best] -= 1
        else:
            at, used = used, used + 1
        if best + s < capacity:
            waiting[best + s].append(at)
            open_at[best + s] += 1
        out[k] = at
    return out


def _packer(capacity: int, held_back: float):
    """Items of one shard -> the same with a local container number and whether that is filled well.

    held_back: the share of the smallest items that come last, largest first; 1 for all items.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("mixed", "doc_id", "piece", "total", "copy")])
        sizes = table.column("tokens").to_numpy().astype(np.int64)
        last = sizes <= np.quantile(sizes, held_back)
        late = np.flatnonzero(last)
        order = np.concatenate([np.flatnonzero(~last), late[np.argsort(-sizes[late], kind="stable")]])
        at = np.empty(len(sizes), np.int64)
        at[order] = sum_of_squares(sizes[order], capacity)
        fill = np.bincount(at, weights=sizes)
        return table.append_column("at", pa.array(at)).append_column("fill", pa.array(fill[at].astype(np.int64)))

    return run


def pack(
    df: DataFrame,
    doc_id: str,
    text: str | Column,
    capacity: int = 2048,
    shard_items: int = 65_536,
    held_back: float = 0.1,
    well_filled: float = 0.97,
    fan_in: int = 16,
    path: str | None = None,
) -> DataFrame:
    """(container string, doc_id, piece int from 0, tokens int): each text's tokens in containers of ``capacity``.

    Only a text of more than ``capacity`` tokens is split, into full pieces, which fill containers of their
    own, and a rest. Texts and rests are packed shard by shard; containers filled to less than
    ``well_filled`` are then opened again and their items packed anew, the shards of ``fan_in`` shards
    together. Null and empty texts are left out; repeated rows and null ids are packed like any other row:
    rows of equal id and size are counted and numbered as copies, and id, size and copy draw the shard, so
    that no shard is larger than others whatever ids repeat. Other columns are ignored; an empty table gives
    no rows. The same rows give the same containers.
    """
    scratch = Scratch(df.sparkSession)
    counted = bpe.token_counts(df, doc_id, text, path).withColumnRenamed(doc_id, "doc_id").where("tokens > 0")
    counted, _ = scratch.put(counted.groupBy("doc_id", F.col("tokens").alias("total")).agg(F.count(F.lit(1)).alias("copies")))
    shards = max(1, math.ceil((counted.agg(F.sum("copies")).first()[0] or 0) / shard_items))
    cap = F.lit(capacity)
    # Copies of one id and size are unrolled some thousand at a time, wherever those come to lie.
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK))).alias("chunk")
    chunks = counted.select("doc_id", "total", "copies", chunk).repartition("doc_id", "total", "chunk")
    last = F.least(F.col("copies"), (F.col("chunk") + 1) * CHUNK) - 1
    rows = chunks.select("doc_id", "total", F.explode(F.sequence(F.col("chunk") * CHUNK, last)).alias("copy"))
    whole = F.floor(F.col("total") / cap)
    full = rows.where(F.col("total") >= cap).select("doc_id", "total", "copy", F.explode(F.sequence(F.lit(0).cast("long"), whole - 1)).alias("piece"), cap.cast("long").alias("tokens"))
    rest = rows.select("doc_id", whole.alias("piece"), (F.col("total") % cap).alias("tokens"), "total", "copy").where("tokens > 0")
    rest = rest.withColumn("mixed", F.xxhash64("doc_id", "total", "copy")).withColumn("shard", F.pmod(F.xxhash64("mixed"), F.lit(shards)))

    kinds = "doc_id long, piece long, tokens long, total long, copy long, mixed long, shard long, at long, fill long"
    first, _ = scratch.put(rest.groupBy("shard").applyInArrow(_packer(capacity, held_back), kinds))
    good = F.col("fill") >= well_filled * capacity
    loose = first.where(~good).drop("at", "fill").withColumn("shard", F.floor(F.col("shard") / fan_in))
    second = loose.groupBy("shard").applyInArrow(_packer(capacity, 1.0), kinds)

    def named(x: DataFrame, kind: str, *parts: str | Column) -> DataFrame:
        return x.select(F.concat_ws("-", F.lit(kind), *parts).alias("container"), F.col("doc_id"), F.col("piece").cast("int").alias("piece"), F.col("tokens").cast("int").alias("tokens"))

    out = named(full, "full", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "total", "copy", "piece").unionByName(named(first.where(good), "first", "shard", "at")).unionByName(named(second, "second", "shard", "at"))
    return out.withColumnRenamed("doc_id", doc_id)
