"""Joins from many child rows to a parent that is unique by key.

The child is on the outer side of a left or anti join.  Spark broadcasts the parent when it is under
``spark.sql.autoBroadcastJoinThreshold`` (by statistics when planning, by real size at run time).
Beyond that the join sorts and merges, and AQE splits hot child partitions: a parent key shared by
a third of all child rows, or a third without any key, is spread over many tasks while only the
matching parent partition is repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a side of a join up to which Spark may broadcast it by the size of its files.  A row of keys takes a few
#: bytes there, as codecs shrink keys that lie in order, and about a hundred in a broadcast, which the driver builds.
MOST_BROADCAST = 500_000


def bounded(side: DataFrame, rows: int) -> DataFrame:
    """``side`` of a join, read from files of at most ``rows`` rows; never broadcast when these are many."""
    return side.hint("merge") if rows > MOST_BROADCAST else side


def splittable_left_join(child: DataFrame, parent: DataFrame, column: str, key: str) -> DataFrame:
    """Left join of ``child.column`` with ``parent.key`` (unique) that AQE can always split.

    A parent that was just grouped or deduplicated by its key is already partitioned by it, and
    AQE only splits join sides that come straight from a shuffle.  Joining on a hash of the key as
    well makes Spark shuffle both sides for this join; the parent is the small side of the two.
    """
    types = child.schema[column].dataType, parent.schema[key].dataType
    if types[0] != types[1]:
        raise TypeError(f"{column} and {key} have different types: {types}")
    left = child.withColumn("_hash", F.hash(column))
    right = parent.withColumnRenamed(key, "_key").withColumn("_key_hash", F.hash("_key"))
    matched = (left["_hash"] == right["_key_hash"]) & (left[column] == right["_key"])
    return left.join(right, matched, "left").drop("_hash", "_key_hash", "_key")


def attach(child: DataFrame, parent: DataFrame, on: str, **columns: str) -> DataFrame:
    """Left join columns of ``parent`` (unique by ``on``): ``attach(c, p, "id", new_name="col")``."""
    picked = parent.select(on, *(F.col(source).alias(name) for name, source in columns.items()))
    return splittable_left_join(child, picked, on, on)


def known_keys(wanted: DataFrame, *parents: DataFrame) -> DataFrame:
    """Distinct keys of ``wanted`` that occur in any parent; all frames have one column.

    The parents, which may hold all history, are filtered by the wanted keys before they are
    unioned, so the work after the scan follows the size of the batch.
    """
    name = wanted.columns[0]
    needed = wanted.where(F.col(name).isNotNull()).distinct()
    found = None
    for parent in parents:
        hits = parent.toDF(name).join(needed, name, "left_semi")
        found = hits if found is None else found.unionByName(hits)
    return found.distinct()


def flag_unknown(child: DataFrame, column: str, known: DataFrame, flag: str) -> DataFrame:
    """Add ``flag``: TRUE where ``column`` is NULL or not among ``known`` (one distinct column)."""
    right = known.toDF("_known_key").withColumn("_known", F.lit(True))
    joined = splittable_left_join(child, right, column, "_known_key")
    return joined.withColumn(flag, F.col("_known").isNull()).drop("_known")


def unknown_keys(child: DataFrame, column: str, batch: DataFrame, *history: DataFrame) -> DataFrame:
    """Distinct keys of ``child.column`` that occur in no parent, as ``_unknown_key``.

    The keys are looked up in the batch's own parents as they are.  Only those that are left narrow the parents
    of earlier batches.
    """
    wanted = child.select(F.col(column).alias("_unknown_key"))
    given = wanted.where(F.col("_unknown_key").isNotNull()).distinct()
    left = lacking(given, "_unknown_key", batch)
    if not history:
        return left
    return lacking(left, "_unknown_key", known_keys(left, *history))


def lacking(keyed: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``keyed``, which has a row for each value of ``column``, whose value is not among ``keys`` (one column).

    ``keyed`` comes from an aggregate and is spread by its keys, so only ``keys`` are shuffled, and nothing would be
    gained by a broadcast of them.  An anti join would be the same, but Spark may move one below the aggregate.
    """
    right = keys.toDF("_key_there").hint("merge")
    joined = keyed.join(right, keyed[column] == right["_key_there"], "left")
    return joined.where("_key_there IS NULL").drop("_key_there")


def flag_unknown_written(
    child: DataFrame,
    column: str,
    known: DataFrame,
    flag: str,
    write: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """:func:`flag_unknown` by the distinct keys that are not known, which ``write`` writes first.

    Distinct keys meet the known ones; the rows of ``child`` meet the written rest only, and are shuffled
    only where that is too large to be broadcast.
    """
    unknown = write(unknown_keys(child, column, known))
    joined, listed = with_unknown(child, column, unknown, flag)
    return joined.withColumn(flag, F.col(column).isNull() | listed)


def with_unknown(
    child: DataFrame, column: str, unknown: DataFrame, name: str
) -> tuple[DataFrame, Column]:
    """``child`` with a column ``name``, and the condition on it that ``column`` is among ``unknown``, written
    :func:`unknown_keys`.  Written keys are shuffled for the join, so AQE can split it as it is."""
    right = unknown.withColumn(name, F.lit(True))
    joined = child.join(right, F.col(column) == F.col("_unknown_key"), "left").drop("_unknown_key")
    return joined, F.col(name).isNotNull()


def with_known(
    child: DataFrame, column: str, known: DataFrame, name: str
) -> tuple[DataFrame, Column]:
    """:func:`with_unknown` by the distinct keys that are known, as ``_known_key``, where these are fewer."""
    right = known.withColumn(name, F.lit(True))
    joined = child.join(right, F.col(column) == F.col("_known_key"), "left").drop("_known_key")
    return joined, F.col(column).isNotNull() & F.col(name).isNull()


def first_positions(
    child: DataFrame, column: str, position: str, shown: str | None = None
) -> DataFrame:
    """The first position ``_first`` of every non-null key, or the column ``shown`` of the row there, and the number of
    copies, combined before the shuffle, so a hot key is never gathered.  Positions are unique."""
    first = F.min(position) if shown in (None, position) else F.min_by(shown, position)
    return (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_repeated"))
        .agg(first.alias("_first"), F.count(F.lit(1)).alias("_copies"))
    )


def repeated_keys(child: DataFrame, column: str, position: str) -> DataFrame:
    """Keys of ``child.column`` with several copies, as ``_repeated``, and their ``_first`` positions."""
    return first_positions(child, column, position).where("_copies > 1").drop("_copies")


def flag_repeats(
    child: DataFrame,
    column: str,
    position: str,
    flag: str,
    write: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add ``flag``: TRUE for every row whose non-null ``column`` occurred at an earlier position.

    Only keys that do repeat are joined back, one row each (combined before the shuffle), so clean
    data meets an almost empty side and a hot key is never gathered into one window.  ``write`` may
    write those keys first; the rows of ``child`` are then shuffled only where they are too many to be
    broadcast.
    """
    firsts = repeated_keys(child, column, position)
    if write is not None:
        joined, later = with_firsts(child, column, position, write(firsts), "_first_copy")
        return joined.withColumn(flag, later).drop("_first_copy")
    joined = splittable_left_join(child, firsts, column, "_repeated")
    later = F.coalesce(F.col(position) > F.col("_first"), F.lit(False))
    return joined.withColumn(flag, later).drop("_first")


def with_firsts(
    child: DataFrame, column: str, position: str, firsts: DataFrame, name: str
) -> tuple[DataFrame, Column]:
    """``child`` with a column ``name``, and the condition on it that ``column`` occurred at an earlier
    position, by ``firsts``, written :func:`repeated_keys`."""
    right = firsts.withColumnRenamed("_first", name)
    joined = child.join(right, F.col(column) == F.col("_repeated"), "left").drop("_repeated")
    return joined, F.coalesce(F.col(position) > F.col(name), F.lit(False))


def orphans(child: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """Keys of ``child`` without a parent and how many rows carry each (NULL counts as one key).

    Child rows are counted per key before the shuffle, so a hot key is one row in the join.
    """
    counted = child.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("records"))
    return lacking(counted, "key", parents)


def orphan_total() -> Column:
    """Aggregate over :func:`orphans`: number of orphaned records."""
    return F.coalesce(F.sum("records"), F.lit(0)).alias("orphan_records")
