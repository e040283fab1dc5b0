"""Distributed list ranking: how far each element of a linked list is from its first.

Elements are numbered, and a list is usually laid out so that many links stay near.  First, blocks of
neighbouring numbers are contracted: a task follows the links inside its block and keeps one element of each
chain, with the chain's length.  While more than ``LAST`` elements are left, random mates halve the list's
links: an element whose coin shows tails and whose predecessor's shows heads is taken out and remembered with
its distance, about a quarter of the elements a round, whatever the layout.  One task ranks the few that are
left, and the contractions are undone in reverse.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.tables import written

#: Numbers in a block that one task follows, and elements that are ranked in one task at the end.
BLOCK = 1 << 13
LAST = 1 << 13


def heads_and_offsets(item: np.ndarray, after: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item the index of its chain's first item among ``item`` and the weights between them, by
    pointer doubling; ``after`` is the next item, -1 for none."""
    order = np.argsort(item)
    at = np.searchsorted(item, after, sorter=order)
    at = order[np.minimum(at, len(item) - 1)]
    inside = item[at] == after
    before = np.arange(len(item))
    before[at[inside]] = np.flatnonzero(inside)
    offset = np.zeros(len(item), np.int64)
    offset[at[inside]] = weight[inside]
    while (before[before] != before).any():
        offset = offset + offset[before]
        before = before[before]
    return before, offset


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    after = table.column("after").fill_null(-1).to_numpy()
    return table.column("item").to_numpy(), after, table.column("weight").to_numpy()


def _chains(table: pa.Table) -> pa.Table:
    """Each item's chain in the block and offset; a chain's first item also gets what follows the chain."""
    item, after, weight = _columns(table)
    head, offset = heads_and_offsets(item, after, weight)
    length = offset + weight
    last = np.full(len(item), -1)
    # the last item of a chain is the one with the largest offset
    by = np.lexsort((offset, head))
    last[head[by]] = by
    first = last >= 0
    tail = last[first]
    following = np.full(len(item), -1)
    following[first] = after[tail]
    whole = np.zeros(len(item), np.int64)
    whole[first] = length[tail]
    return pa.table(
        {
            "item": item,
            "head": item[head],
            "offset": offset,
            "after": pa.array(following, pa.int64(), mask=following < 0),
            "weight": pa.array(whole, pa.int64()),
        }
    )


def _last_ranks(table: pa.Table) -> pa.Table:
    item, after, weight = _columns(table)
    _, offset = heads_and_offsets(item, after, weight)
    return pa.table({"item": item, "rank": offset})


def _by_blocks(links: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Links between the chains of blocks, and every item's chain with its offset."""
    chains = written(
        links.groupBy(F.expr(f"item div {block}").alias("_block")).applyInArrow(
            _chains, "item long, head long, offset long, after long, weight long"
        ),
        "chains",
    )
    return chains.where("item = head").select("item", "after", "weight"), chains.select("item", "head", "offset")


def _by_mates(links: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Links without the items that random mates take out, and every item's keeper with its offset."""

    def tails(name: str):
        return F.pmod(F.xxhash64(F.col(name), F.lit(turn)), F.lit(2)) == 1

    pairing = ~tails("item") & F.col("after").isNotNull() & tails("after")
    before = links.where(pairing).select(
        F.col("item").alias("mate"), F.col("after").alias("item"), F.col("weight").alias("mate_weight")
    )
    pairs = written(links.where(tails("item")).join(before, "item", "left"), "mates")
    out = pairs.where("mate IS NOT NULL")
    joined = out.select(F.col("mate").alias("item"), "after", (F.col("weight") + F.col("mate_weight")).alias("weight"))
    stay = pairs.where("mate IS NULL").select("item", "after", "weight")
    others = links.where(~tails("item") & ~pairing)
    left = written(others.unionByName(joined).unionByName(stay), "links")
    taken = out.select("item", F.col("mate").alias("head"), F.col("mate_weight").alias("offset"))
    same = left.select("item", F.col("item").alias("head"), F.lit(0).cast("long").alias("offset"))
    return left, taken.unionByName(same)


def ranks(links: DataFrame, block: int = BLOCK, last: int = LAST) -> DataFrame:
    """``item`` and its ``rank``, 0 for the first, of a list given as ``item`` and ``after`` (null at the end).

    ``links`` is read more than once and should be a written table.  Items are not negative.
    """
    left, undo = links.select("item", "after", F.lit(1).cast("long").alias("weight")), []
    left, step = _by_blocks(left, block)
    undo.append(step)
    turn = 0
    while left.count() > last:
        left, step = _by_mates(left, turn)
        undo.append(step)
        turn += 1
    found = left.groupBy(F.lit(0).alias("_all")).applyInArrow(_last_ranks, "item long, rank long")
    for step in reversed(undo):
        known = written(found, "ranks").select(F.col("item").alias("head"), F.col("rank").alias("first"))
        found = step.join(known, "head").select("item", (F.col("first") + F.col("offset")).alias("rank"))
    return found
