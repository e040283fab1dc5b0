"""Places in a global order and running values, without a task that holds a whole group.

``ordered`` sorts by ranges and numbers what it has written; ``running`` adds up within blocks of bounded
size and carries the blocks' totals.  Neither gathers a key's rows, however many share it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.tables import written

#: Places in a block of a running value.
BLOCK = 1 << 16
_INSIDE = 33  # bits of a monotonically increasing id that count inside a partition


def ordered(df: DataFrame, *order: str | Column, name: str) -> DataFrame:
    """``df``, written, with each row's place 0, 1, ... under ``order`` in the column ``name``.

    Range partitions are sorted and written with their own row numbers; the sizes of the partitions
    (one row for each) say where each begins.  Equal rows are in the order in which they were read.
    """
    ids = "_id"
    rows = written(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(ids, F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftrightunsigned(ids, _INSIDE)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    begins = sizes.select(
        "_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_begin")
    )
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(begins), "_part")  # one row a partition
        .withColumn(name, F.col("_begin") + F.col(ids).bitwiseAND(F.lit((1 << _INSIDE) - 1)))
        .drop("_part", "_begin", ids)
    )


def running(
    df: DataFrame,
    place: str,
    values: dict[str, str],
    total: Callable[[str], Column] = F.sum,
    add: Callable[[Column, Column], Column] = lambda a, b: a + b,
    within: tuple[str, ...] = (),
    block: int = BLOCK,
) -> DataFrame:
    """``df`` with running totals by ``place`` (unique) up to and with each row, for each of ``within``.

    ``values`` names the new columns and the column that each adds up.  ``total`` and ``add`` are an
    aggregate and its combination of two; the neutral value is 0.  A window holds the rows of a block of
    ``block`` places at most, a second one the blocks' totals.
    """
    cut = df.withColumn("_block", F.expr(f"`{place}` div {block}"))
    groups = [*within, "_block"]
    blocks = cut.groupBy(*groups).agg(*(total(column).alias(f"_{name}") for name, column in values.items()))
    earlier = Window.partitionBy(*within).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(
        *groups, *(F.coalesce(total(f"_{name}").over(earlier), F.lit(0)).alias(f"_{name}") for name in values)
    )
    upto = Window.partitionBy(*groups).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    inner = cut.withColumns({name: total(column).over(upto) for name, column in values.items()})
    joined = inner.join(carried, groups)
    return joined.withColumns({name: add(F.col(name), F.col(f"_{name}")) for name in values}).drop(
        "_block", *(f"_{name}" for name in values)
    )
