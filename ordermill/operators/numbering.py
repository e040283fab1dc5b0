"""Dense numbers without a global sort: positions of rows in files, and indexes over new keys."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 4096
#: Slots of a day's keys, and rows of a part from which on its slots are dealt to several groups, a task each.
DAY_SLOTS, GROUP_ROWS = 32, 500_000
_FILE_SETTINGS = (
    "spark.sql.files.maxPartitionBytes",
    "spark.sql.files.openCostInBytes",
    "spark.sql.shuffle.partitions",
    "spark.sql.session.timeZone",
)


def dense_index(df: DataFrame, key: str, name: str, after: int = 0, slots: int = SLOTS) -> DataFrame:
    """Number the rows of ``df`` (unique ``key``) ``after + 1, after + 2, ...`` into ``name``.

    Keys are hashed into ``slots`` slots; a row's number is the count of rows in earlier slots
    plus its rank inside its slot.  Slots are even because keys are unique, nothing is sampled,
    so a recomputed task yields the same numbers, and only ``slots`` counts are ever broadcast.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(slots))
    sizes = df.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_slot")) - F.col("_rows")
    starts = sizes.select("_slot", (before + F.lit(after)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_slot").orderBy(key))
    return (
        df.withColumn("_slot", slot)
        .withColumn("_rank", rank)
        .join(F.broadcast(starts), "_slot")  # at most ``slots`` rows
        .withColumn(name, (F.col("_start") + F.col("_rank")).cast("long"))
        .drop("_slot", "_rank", "_start")
    )


def day_slot(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(DAY_SLOTS)).cast("int")


def day_starts(
    counts: list[tuple[int, int, int, int]], period: int, after: int
) -> list[tuple[int, int, int, int]]:
    """Day, slot, group of the slot and numbers given before it, from the day (as a date key), slot, number of rows and
    number of new ones of each slot.  There are ``DAY_SLOTS`` entries a day at most.

    A part has the days of a ``period``; large parts have several groups.  The numbers depend on days and keys only.
    """
    sizes = defaultdict(int)
    for day, _, rows, _ in counts:
        sizes[day // period] += rows
    starts, given = [], after
    for day, slot, _, new in sorted(counts):
        groups = min(DAY_SLOTS, -(-sizes[day // period] // GROUP_ROWS))
        starts.append((day, slot, slot * groups // DAY_SLOTS, given))
        given += new
    return starts


def dense_by_day(
    df: DataFrame, starts: DataFrame, part: str, day: str, key: str, name: str
) -> DataFrame:
    """Number the rows of ``df`` (unique ``key``) whose ``name`` is NULL without gaps, by :func:`day_starts` (columns
    ``day``, ``_slot``, ``_group``, ``_start``).

    One shuffle serves the numbers and the files: rows lie together by part, large parts in several groups, in the order
    of days, slots and keys, by which new ones are counted.  A recomputed task yields the same numbers.
    """
    so_far = Window.partitionBy(part, "_group", day, "_slot").orderBy(key)
    so_far = so_far.rowsBetween(Window.unboundedPreceding, 0)
    number = F.col("_start") + F.count_if(F.col(name).isNull()).over(so_far)
    groups, given = starts.drop("_start"), starts.drop("_group")
    return (
        df.withColumn("_slot", day_slot(key))
        .join(F.broadcast(groups), [day, "_slot"], "left")
        .withColumn("_group", F.coalesce("_group", "_slot"))
        .select(*df.columns, "_group")  # what can be made again is not shuffled
        .repartition(part, "_group")
        .withColumn("_slot", day_slot(key))
        .join(F.broadcast(given), [day, "_slot"], "left")
        .withColumn(name, F.coalesce(name, number))
        .select(*df.columns)
    )


def located(scan: DataFrame) -> DataFrame:
    """A file scan with each row's file, the block of the file it was read in, and an id that runs
    through the rows of a block without gaps."""
    return scan.withColumns(
        {
            "_file": F.col("_metadata.file_name"),
            "_block": F.col("_metadata.file_block_start"),
            "_id": F.monotonically_increasing_id(),
        }
    )


def block_starts(rows: DataFrame) -> DataFrame:
    """For each block of :func:`located` rows its first id, its number of rows and the number of rows
    before it (files by name, blocks by position).

    Only counts are gathered.  Two steps keep the running sums small: inside each file, then over one
    row per file.
    """
    blocks = rows.groupBy("_file", "_block").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    in_file = F.sum("_rows").over(Window.partitionBy("_file").orderBy("_block")) - F.col("_rows")
    files = blocks.groupBy("_file").agg(F.sum("_rows").alias("_file_rows"))
    before = F.sum("_file_rows").over(Window.orderBy("_file")) - F.col("_file_rows")
    return (
        blocks.withColumn("_in_file", in_file)
        .join(files.select("_file", before.alias("_before")), "_file")
        .select(
            "_file", "_block", "_first", "_rows", (F.col("_before") + F.col("_in_file")).alias("_start")
        )
    )


def number_rows(
    rows: DataFrame, starts: DataFrame, name: str = "_source_row_number"
) -> DataFrame:
    """Number :func:`located` rows 1, 2, ... in file order by the written :func:`block_starts` of the
    same scan.

    Rows are neither shuffled nor sorted where ``starts``, one row a block, is under Spark's broadcast
    threshold.  Both scans must cut the files alike (see :func:`steady_session`); :func:`gapless`
    tells whether they did.
    """
    return (
        rows.join(starts.drop("_rows"), ["_file", "_block"], "left")
        .withColumn(name, F.col("_id") - F.col("_first") + F.col("_start") + F.lit(1))
        .drop("_file", "_block", "_id", "_first", "_start")
    )


def steady_session(spark: SparkSession) -> SparkSession:
    """A session whose file scans are cut in the same way however many executors there are."""
    steady = spark.newSession()
    for name in _FILE_SETTINGS:
        steady.conf.set(name, spark.conf.get(name))
    steady.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)
    return steady


def number_facts(name: str = "_source_row_number") -> list[Column]:
    """Aggregates over numbered rows that :func:`gapless` judges."""
    number = F.col(name)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count(number).alias("numbered"),
        F.coalesce(F.max(number), F.lit(0)).alias("highest"),
        F.coalesce(F.sum(number.cast("decimal(38,0)")), F.lit(0)).alias("total"),
    ]


def gapless(facts: dict) -> bool:
    """Whether the numbers can only be 1, 2, ... up to the number of rows."""
    rows = facts["rows"]
    return facts["numbered"] == facts["highest"] == rows and int(facts["total"]) == rows * (rows + 1) // 2
