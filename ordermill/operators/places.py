"""Marks on the records of written files, by place and not by key.

A place is the number of a record's file and of its row there, so the marks of 32,768 records lying side by side fit into
512 words of 64 bits.  These are joined to the records as they lie, which are not shuffled for it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE = "_place"
FILE_BITS, BLOCK_BITS, WORD_BITS = 40, 15, 6  # of a place: below the file's number, of a block, of a word
WORDS = 1 << (BLOCK_BITS - WORD_BITS)
#: Blocks that are broadcast whatever Spark's threshold: 32 MB for each kind of mark, 268 million records.
MAX_BLOCKS = 8192


def placed(records: DataFrame) -> DataFrame | None:
    """``records`` read from files as they are, with their places; None where they come from elsewhere, or from a
    step that may leave out or repeat rows."""
    if not records._jdf.queryExecution().analyzed().children().isEmpty():
        return None
    try:
        found = records.select("*", "_metadata.file_name", F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return None
    names = sorted(path.rsplit("/", 1)[-1] for path in records.inputFiles())
    if not names or len(set(names)) < len(names):
        return None
    numbers = records.sparkSession.range(1).select(
        F.posexplode(F.array(*map(F.lit, names))).alias("_number", "file_name")
    )
    lost = F.raise_error(F.concat(F.lit("a file without a number: "), "file_name")).cast("long")
    number = F.coalesce(F.col("_number").cast("long"), lost)
    place = F.shiftleft(number, FILE_BITS).bitwiseOR(F.col("_row"))
    return (
        found.join(F.broadcast(numbers), "file_name", "left")
        .withColumn(PLACE, place)
        .select(*records.columns, PLACE)
    )


def blocks_of(lists: list[DataFrame]) -> DataFrame:
    """``_block`` and for each of ``lists`` of places a column ``_0``, ``_1``, ... of the block's words in order.

    Words are plain numbers, 8 bytes each in a broadcast; as fields of a record each would take 24 bytes more.
    """
    names = [f"_{n}" for n in range(len(lists))]
    listed = (rows.select(PLACE, F.lit(n).alias("_list")) for n, rows in enumerate(lists))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _bit())
    words = (
        reduce(DataFrame.unionByName, listed)
        .groupBy(F.shiftright(PLACE, WORD_BITS).alias("_word"))
        .agg(*(F.bit_or(F.when(F.col("_list") == n, bit)).alias(names[n]) for n in range(len(lists))))
    )
    # Words without a mark are there too, so that a word is found by its number.
    block = F.shiftright("_word", BLOCK_BITS - WORD_BITS)
    first = F.shiftleft("_block", BLOCK_BITS - WORD_BITS)
    every = words.select(block.alias("_block")).distinct().select(
        F.explode(F.sequence(first, first + F.lit(WORDS - 1))).alias("_word"),
        *(F.lit(0).cast("long").alias(name) for name in names),
    )
    whole = words.unionByName(every).groupBy("_word").agg(*(F.bit_or(n).alias(n) for n in names))
    in_order = F.sort_array(F.collect_list(F.struct("_word", *names)))
    blocks = whole.groupBy(block.alias("_block")).agg(in_order.alias("_words"))
    return blocks.select("_block", *(F.col("_words")[name].alias(name) for name in names))


def _bit() -> Column:
    """A place's bit in its word."""
    return F.col(PLACE).bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")


def with_marks(records: DataFrame, blocks: DataFrame, lists: int) -> tuple[DataFrame, list[Column]]:
    """:func:`placed` records joined with written :func:`blocks_of` lists, and whether a record's place is in each."""
    side = F.broadcast(blocks) if blocks.count() <= MAX_BLOCKS else blocks
    joined = records.join(side, F.shiftright(PLACE, BLOCK_BITS) == F.col("_block"), "left")
    number = F.shiftright(PLACE, WORD_BITS).bitwiseAND(F.lit(WORDS - 1)).cast("int")
    words = (F.get(f"_{n}", number) for n in range(lists))
    return joined, [F.coalesce(F.getbit(word, _bit()), F.lit(0)) != 0 for word in words]
