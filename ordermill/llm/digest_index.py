"""Exact duplicates by a persistent digest index.

The index is a table of SHA-256 digests at a place of its own, bucketed by the digest and sorted within
buckets.  New rows are reduced to the first of each digest, joined with the index by a sort-merge anti-join
that reads the index as it lies, bucket by bucket, and what is left is appended in the same buckets.  Only
digests and ids are shuffled, never texts, and the first of each digest is found by an aggregate that combines
before the shuffle, so a digest that a third of all rows share costs one row a task.

Defined results: a null text counts as empty.  Of equal texts of one batch the row with the smallest id
stays, null ids last and the row read first among equal ids; a text that the index already holds stays where
it came from, whatever ids come later, so batches are added in the order in which they are to be preferred.
Adding a batch again after a failure changes nothing: what was appended is found and not appended twice.  One
writer at a time.  Texts of any length are hashed whole.  An empty batch adds nothing.  Other columns of a
batch play no part, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.tables import written
from ordermill.operators.lookup import splittable_left_join

#: Runs of these are one space when texts are compared.
SPACE = r"[\x20\x09-\x0D]+"
_ENTRY = "digest binary, keep_id bigint, keep_row bigint"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``row`` (a number of its own for every row) and ``digest`` of each document, written once:
    later steps read these forty-odd bytes in place of the text, and row numbers cannot change any more."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256)).alias("digest"),
    )
    return written(rows, "digests")


class DigestIndex:
    """The index at ``path``; opened again with the buckets it was made with.

    ``buckets`` is chosen for the size the index is to reach, some hundred MB a bucket: a digest and
    its row take about 50 bytes.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        self.table = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:24]
        made = spark.createDataFrame([(buckets,)], "buckets int")
        notes = f"{path}/_notes"
        try:
            self.buckets = spark.read.schema("buckets int").json(notes).first()["buckets"]
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            made.coalesce(1).write.json(notes)
            self.buckets = buckets
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({_ENTRY}) USING parquet LOCATION '{path}/entries' "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
        )

    def entries(self) -> DataFrame:
        """``digest``, ``keep_id`` and ``keep_row`` of every text seen; one row a digest."""
        return self.spark.table(self.table)

    def unseen(self, rows: DataFrame) -> DataFrame:
        """First row of each digest of ``rows`` that the index does not hold, by sort-merge anti-join."""
        order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
        firsts = rows.groupBy("digest").agg(F.min(order).alias("first"))
        new = firsts.select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"))
        return new.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, rows: DataFrame) -> None:
        """Append what is new in ``rows``, as :func:`digests` gives them: one sorted file a bucket."""
        (
            self.unseen(rows)
            .repartition(self.buckets, "digest")
            .write.bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .format("parquet")
            .mode("append")
            .saveAsTable(self.table)
        )

    def decisions(self, rows: DataFrame) -> DataFrame:
        """Every one of ``rows`` (already added) with the row that stays for its text.

        ``keep_id`` and ``kept`` come from the index, ``group_size`` counts ``rows``.  The join back
        lets Spark split a digest that many rows share.
        """
        sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
        groups = self.entries().join(sizes, "digest")
        joined = splittable_left_join(rows, groups, "digest", "digest")
        return joined.withColumn("kept", F.col("row") == F.col("keep_row"))


def in_two_deliveries(rows: DataFrame) -> list[DataFrame]:
    """``rows`` up to the middle id, and those after it or without one: an archive and a new delivery."""
    middle = rows.agg(F.percentile_approx("doc_id", 0.5, 1000)).first()[0]
    early = F.coalesce(F.col("doc_id") <= F.lit(middle).cast("long"), F.lit(False))
    return [rows.where(early), rows.where(~early)]


def kept_documents(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Documents whose text the index has not seen, one of each text, with all their columns; the index then
    holds them.  ``docs`` is written once under row numbers, since texts have to be found again by them."""
    number, digest = _free(docs, "row"), _free(docs, "digest")
    held = written(
        docs.select(
            "*",
            F.monotonically_increasing_id().alias(number),
            F.unhex(F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256)).alias(digest),
        ),
        "batch",
    )
    rows = held.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(number).alias("row"), F.col(digest).alias("digest")
    )
    stay = written(index.unseen(rows), "new-digests")
    index.add(rows)
    return held.join(stay.select(F.col("keep_row").alias(number)), number, "left_semi").select(*docs.columns)


def _free(docs: DataFrame, stem: str) -> str:
    """A column name that the table does not have."""
    taken = {name.lower() for name in docs.columns}
    return next(name for name in (f"{stem}_{n}" for n in range(len(taken) + 1)) if name not in taken)


def report(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """:meth:`DigestIndex.decisions` with the digest in hexadecimal."""
    return index.decisions(rows).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def comparison_sql() -> str:
    """The same over the table ``documents`` in SQL."""
    return f"""
        WITH texts AS (
            SELECT doc_id, sha256(regexp_replace(COALESCE(text, ''), '{SPACE}', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, MIN(doc_id) OVER same AS keep_id, COUNT(*) OVER same AS group_size,
               ROW_NUMBER() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
        FROM texts WINDOW same AS (PARTITION BY text_sha256)"""
