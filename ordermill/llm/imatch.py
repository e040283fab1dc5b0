"""I-Match document fingerprints, of SQL functions only.

A document's terms are its distinct lower-case runs of letters and digits, as 64-bit hashes.  The lexicon holds
the terms whose share of all documents lies within a band, so their inverse document frequency is neither that
of everyday words nor that of rare ones.  A fingerprint has a hash for the whole lexicon and one for each of
several random subsets, which hold from an eighth to a thousandth of it: the document's terms in that
subset, distinct and sorted, are hashed in order.  The likeness of two fingerprints is the share of equal
hashes, so that small subsets tell texts that have little in common from those that have nothing.  Where a
document has no term of a subset, the hash of all its terms stands in its place.

Document frequencies come from all documents.  Documents are first counted by the low ``SLOT_BITS`` bits of
their terms' hashes; a term is at most as frequent as its slot, so only terms of frequent slots are then counted
one by one, and the multitude of rare terms is never shuffled.  The terms within the band are marked in a bitmap
of one size for every corpus (2 MB), each by ``MARKS`` bits, and a document's lexicon terms are those that find
all of theirs, where the text is read.  There are at most 1 / ``BAND[0]`` times as many terms in the band as
distinct terms in a document on average; with 100,000 of them one in 180,000 other terms is taken for one of
them, with a million one in 230, and the same ones in every text.  Subsets go by bits of the hash; those of one
size have no term in common.

``neighbours`` finds each document's successor without gathering the table: ids are sorted by range, each
partition looks ahead on its own, and only the partitions' first rows meet in one place.

Defined results: null is the empty text; documents without an id come first; rows with one id stand in the
order of a hash of their text; rows that repeat id and text have the same results, each in a row of its own,
with ``n_rows`` saying how many there are, and their successor is the next document that differs from them;
the successor of the last document is the first, also where that is itself; an empty table gives no
rows; long texts are read whole.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordermill.llm.tables import written

#: Least and largest share of documents of a lexicon term.
BAND = (0.002, 0.04)
#: Random subsets of the lexicon, beside the whole: one in so many terms is in each, and how many there are.
#: A text that lost half its terms still agrees in some subsets of which it has only a few terms, so sizes
#: for short, usual and long texts are needed.
SUBSETS = ((8, 2), (32, 12), (128, 16), (1024, 8))
PARTS = 1 + sum(number for _, number in SUBSETS)
#: Bits of a place in the bitmaps, and how far apart in a term's hash the places of its marks begin.
SLOT_BITS, MARKS = 24, (0, 20, 40)
#: Rows of a repeated document that are written from one array.
REPEATED = 4096
#: What names a document: whether its id is null, the id (0 for null), a hash of its text.
KEY = ("absent", "id", "same")


def keyed(docs: DataFrame) -> DataFrame:
    """The columns of ``KEY``, none of them null, and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.col("doc_id").cast("long")
    return docs.select(
        own.isNull().alias("absent"), F.coalesce(own, F.lit(0)).alias("id"), F.xxhash64(text).alias("same"), text.alias("text")
    )


def terms(text: Column) -> Column:
    """Distinct terms of a text, as sorted 64-bit hashes."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.sort_array(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def slot(term: Column, low: int = 0) -> Column:
    return F.shiftright(term, low).bitwiseAND(F.lit((1 << SLOT_BITS) - 1))


def bitmap(slots: DataFrame) -> DataFrame:
    """One row, ``bits``: an array of longs with a bit set for each ``slot``."""
    bit = F.expr("shiftleft(1L, cast(slot & 63 AS int))")
    some = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = slots.sparkSession.range(1 << (SLOT_BITS - 6)).withColumnRenamed("id", "word").join(some, "word", "left")
    # as many rows as the bitmap has words, whatever the table
    ordered = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits"))))
    return written(every.agg(ordered.alias("words")).select(F.col("words.bits").alias("bits")), "lexicon")


def is_set(bits: str, at: Column) -> Column:
    return F.getbit(F.get(bits, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1


def band_terms(texts: DataFrame, band: tuple[float, float]) -> DataFrame:
    """The terms whose share of the rows of ``texts`` lies within the band."""
    total = texts.agg(F.count(F.lit(1)).alias("total"))
    # one row with the number of documents
    share = F.col("documents") / total.scalar()
    listed = texts.select(terms(F.col("text")).alias("terms"))
    slots = F.array_distinct(F.transform("terms", lambda t: slot(t)))
    used = listed.select(F.explode(slots).alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("documents"))
    frequent = bitmap(used.where(share >= band[0]).select("slot"))
    asked = listed.select("terms", frequent.scalar().alias("__bits"))
    asked = asked.select(F.explode(F.filter("terms", lambda t: is_set("__bits", slot(t)))).alias("term"))
    counted = asked.groupBy("term").agg(F.count(F.lit(1)).alias("documents"))
    return counted.where((share >= band[0]) & (share <= band[1])).select("term")


def lexicon(texts: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """One row with the bitmap of the marks of the band's terms, as ``bits``."""
    marks = F.array(*[slot(F.col("term"), low) for low in MARKS])
    return bitmap(band_terms(texts, band).select(F.explode(marks).alias("slot")))


def with_fingerprint(texts: DataFrame, column: str, words: DataFrame, name: str) -> DataFrame:
    """``texts`` with ``name`` (a hash for the lexicon and each subset) in place of the text in ``column``."""
    others = [c for c in texts.columns if c != column]

    def in_lexicon(term: Column) -> Column:
        inside = is_set("__bits", slot(term, MARKS[0]))
        for low in MARKS[1:]:
            inside = inside & is_set("__bits", slot(term, low))
        return inside

    def member(bits: Column, value: Column) -> Callable[[Column], Column]:
        return lambda term: term.bitwiseAND(bits) == value

    # the optimizer puts the one-row query where its only use is, so the bitmap is not copied into rows
    listed = texts.select(*others, terms(F.col(column)).alias("__terms"))
    listed = listed.select("*", words.scalar().alias("__bits"))
    listed = listed.select(*others, "__terms", F.filter("__terms", in_lexicon).alias("__kept"))
    subsets, low = [F.col("__kept")], SLOT_BITS
    for one_in, number in SUBSETS:
        bits = F.lit((one_in - 1) << low)
        for k in range(number):
            subsets.append(F.filter("__kept", member(bits, F.lit(k << low))))
        low += one_in.bit_length() - 1
    listed = listed.select(*others, F.xxhash64(F.lit("all"), "__terms").alias("__all"), F.array(*subsets).alias("__subsets"))
    parts = F.transform("__subsets", lambda own, k: F.when(F.size(own) == 0, F.col("__all")).otherwise(F.xxhash64(k, own)))
    return listed.select(*others, parts.alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes at equal places."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(PARTS))


def shown(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "-")


def neighbours(texts: DataFrame) -> DataFrame:
    """The columns of ``KEY``, n_chars, n_rows, and next_ with each of ``KEY``: each document and its successor."""
    ids = texts.groupBy(*KEY).agg(F.max(F.length("text")).cast("long").alias("n_chars"), F.count(F.lit(1)).alias("n_rows"))
    order = (F.col("absent").desc(), F.col("id"), F.col("same"))
    at = F.monotonically_increasing_id()
    ordered = written(
        ids.repartitionByRange(*order).sortWithinPartitions(*order).select("*", at.alias("at")), "ids"
    ).withColumn("block", F.shiftright("at", 33))
    me = F.struct(*KEY)
    # one row for each partition of the sorted ids
    blocks = ordered.groupBy("block").agg(F.min_by(me, "at").alias("first"))
    by_block = Window.orderBy("block")
    whole = by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = blocks.select(
        "block", F.coalesce(F.lead("first").over(by_block), F.first("first").over(whole)).alias("after")
    )
    inside = F.lead(me).over(Window.partitionBy("block").orderBy("at"))
    joined = ordered.withColumn("inside", inside).join(after, "block").withColumn("next", F.coalesce("inside", "after"))
    following = [F.col(f"next.{k}").alias(f"next_{k}") for k in KEY]
    return written(joined.select(*KEY, "n_chars", "n_rows", *following), "neighbours")


def edited_texts(texts: DataFrame, near: DataFrame) -> DataFrame:
    """The columns of ``KEY``, text, edited: the last half of each text gives way to the beginning of its successor's.

    Texts are shuffled once, by ``KEY``; only the beginnings move again, to the documents they are for.
    """
    once = texts.groupBy(*KEY).agg(F.any_value("text").alias("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int").alias("half")
    wanted = near.select(*[F.col(k).alias(f"for_{k}") for k in KEY], half, *[F.col(f"next_{k}").alias(k) for k in KEY])
    beginnings = once.join(wanted, list(KEY)).select(
        *[F.col(f"for_{k}").alias(k) for k in KEY], F.substring("text", F.lit(1), F.col("half")).alias("beginning")
    )
    n = F.length("text")
    kept = F.substring("text", F.lit(1), (n - F.floor(n / 2)).cast("int"))
    return once.join(beginnings, list(KEY)).select(*KEY, "text", F.concat(kept, "beginning").alias("edited"))


def near_report(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of its successor."""
    texts = keyed(docs)
    words = lexicon(texts, band)
    near = neighbours(texts)
    both = edited_texts(texts, near).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    both = with_fingerprint(with_fingerprint(both, "text", words, "parts"), "edited", words, "edited_parts")
    both = written(both, "fingerprints")
    following = both.select(*[F.col(k).alias(f"next_{k}") for k in KEY], F.col("parts").alias("next_parts"))
    out = near.join(both, list(KEY)).join(following, [f"next_{k}" for k in KEY])
    # a row for each row that was read, in two steps so that arrays stay short
    several, last = F.floor((F.col("n_rows") - 1) / REPEATED), (F.col("n_rows") - 1) % REPEATED
    out = out.withColumn("some", F.explode(F.sequence(F.lit(0), several)))
    upto = F.when(F.col("some") < several, REPEATED - 1).otherwise(last)
    out = out.withColumn("one", F.explode(F.sequence(F.lit(0).cast("long"), upto.cast("long"))))
    return out.select(
        F.when(~F.col("absent"), F.col("id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        shown(F.col("parts")).alias("fingerprint"),
        shown(F.col("edited_parts")).alias("edited_fingerprint"),
        likeness(F.col("parts"), F.col("edited_parts")).alias("near_edited"),
        likeness(F.col("parts"), F.col("next_parts")).alias("near_next"),
        "n_rows",
    )
