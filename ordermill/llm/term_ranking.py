"""Ranked lexical search, term at a time with limited accumulators.

Terms, lengths and frequencies of a block of query items are counted in one pass over whole texts, which
leaves a forward table: for each document its length and those terms of the block that it holds.  Document
frequencies and totals are Spark aggregates over that table.  Scoring then works on documents in batches, so
every batch is an inverted index of its own.  An item's terms are taken rarest first.  Each adds to the
partial scores (accumulators) of the documents that hold it; once the largest contributions that the terms
to come can make together stay below the kth partial score, no document without an accumulator can be among
the k best any more, and from then on only documents that have one are updated, to their exact scores.  The kth
score of the batches before is carried along within a task.  Each task gives its k best of each item, and a
window with a group limit ranks those of all tasks.  Nothing is shuffled but them and the counts.

Items are worked on in blocks of at most ``BLOCK_TERMS`` different terms (an item with more is a block by
itself); a block's terms are what tasks are sent.

Defined results: a null or empty text has no terms; rows of one ``item_id`` (null too) count as one item; an
item without terms, and one whose terms no document holds, get no row.  Repeated rows of documents are ranked
each for itself, equal scores by ascending ``doc_id``, null ids last.  Texts are read whole, in pieces cut
between terms.  An empty table on either side gives no rows.  Other columns play no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm.tables import written

#: Runs of UTF-8 bytes that are a letter or digit of ASCII or part of a sign beyond it.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: The same in signs, for SQL functions.
TERM_TEXT = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_TERMS = 100_000
#: Texts are read in pieces of about this many bytes.
PIECE = 1 << 20
_LAST = np.iinfo(np.int64).max


def pieces(data: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``data`` in pieces that end where a term ends."""
    low = 0
    while low < len(data):
        high = low + size
        if high < len(data) and (over := TERM.match(data, high - 1)):
            high = over.end()
        yield data[low:high]
        low = high


def counted(data: bytes) -> Counter:
    """Occurrences of each term of a text in UTF-8; only A to Z are lower-cased."""
    found: Counter = Counter()
    for piece in pieces(data):
        found.update(TERM.findall(piece.lower()))
    return found


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id`` and its distinct terms, as text."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (
        items.select("item_id", F.explode(F.regexp_extract_all(lower, F.lit(TERM_TEXT), F.lit(0))).alias("term"))
        .distinct()
    )


def blocks(terms: DataFrame) -> list[DataFrame]:
    """``terms`` cut into blocks of whole items with at most ``BLOCK_TERMS`` rows, or one item."""
    sizes = terms.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    wanted = -(-total // BLOCK_TERMS)
    if wanted <= 1:
        return [terms] if total else []
    # twice as many parts as needed on average keep a part under the bound; a part over it is cut again
    parts = 2 * wanted
    part = F.pmod(F.xxhash64("item_id", F.lit(parts)), F.lit(parts))
    out: list[DataFrame] = []
    found = sizes.groupBy(part.alias("part")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items")).collect()
    for row in sorted(found, key=lambda r: r["part"]):
        chosen = terms.where(part == row["part"])
        out += blocks(chosen) if row["n"] > BLOCK_TERMS and row["items"] > 1 else [chosen]
    return out


def forward(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id``, number of terms ``n`` and, of the sorted ``vocabulary``, the terms the document holds with
    how often; documents without any term are left out."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vocabulary)

    def read(batches):
        place = {term: i for i, term in enumerate(sent.value)}
        known = frozenset(place)
        for batch in batches:
            ids, lengths, starts, terms, times = [], [], [0], [], []
            texts = batch.column(1).cast(pa.large_binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                data = text.as_py()
                found = counted(data) if data else None
                if not found:
                    continue
                held = known.intersection(found)
                ids.append(doc_id)
                lengths.append(found.total())
                terms += [place[term] for term in held]
                times += [found[term] for term in held]
                starts.append(len(terms))
            offsets = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
                ],
                ["doc_id", "n", "terms", "times"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(read, "doc_id long, n long, terms array<int>, times array<long>")


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


class Accumulators:
    """Partial scores of one batch of documents, an item after the other.

    ``queries`` holds each item's terms, rarest first; ``weights`` a weight for each term; ``kth`` the kth
    best score of each item so far, 0 where there are fewer.
    """

    def __init__(self, queries: list[np.ndarray], weights: np.ndarray, k: int):
        self.queries, self.weights, self.k = queries, weights, k
        self.kth = np.zeros(len(queries), np.int64)
        self.created = self.updated = 0

    def index(self, scale: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray) -> None:
        """The batch's postings by term, as contributions; ``scale`` is each document's m."""
        order = np.argsort(term, kind="stable")
        self.doc, term, times = doc[order], term[order], times[order]
        self.points = self.weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * scale[self.doc]))
        self.start = np.searchsorted(term, np.arange(len(self.weights) + 1))
        self.most = np.zeros(len(self.weights), np.int64)
        held = np.flatnonzero(np.diff(self.start))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.points, self.start[held])
        self.sums = np.zeros(len(scale), np.int64)

    def best(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the batch that have an accumulator which may still be among the k best, and their scores."""
        terms = self.queries[item]
        terms = terms[self.most[terms] > 0]
        to_come = np.append(np.cumsum(self.most[terms][::-1])[::-1], 0)
        sums, kth, creating = self.sums, int(self.kth[item]), True
        for i, term in enumerate(terms):
            rows = slice(self.start[term], self.start[term + 1])
            docs, points = self.doc[rows], self.points[rows]
            if creating and to_come[i] < kth:
                creating = False
            if creating:
                sums[docs] += points
                self.created += len(docs)
                # the kth partial score is worth looking up when it could stop the creation
                if i + 1 < len(terms) and np.count_nonzero(sums) >= self.k:
                    partial = np.partition(sums, len(sums) - self.k)[len(sums) - self.k]
                    kth = max(kth, int(partial))
            else:
                old = sums[docs] > 0
                sums[docs[old]] += points[old]
                self.updated += int(old.sum())
        alive = np.flatnonzero(sums)
        scores = sums[alive]
        sums[alive] = 0
        kept = scores >= kth
        return alive[kept], scores[kept]


def _ranked(scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score first, then ascending id, null ids last."""
    return np.lexsort((ids, nulls, -scores))[:k]


def scored(table: DataFrame, queries: list[np.ndarray], weights: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    """Each task's ``k`` best documents of each item (by its place in ``queries``)."""
    sent = table.sparkSession.sparkContext.broadcast((queries, weights))

    def score(batches):
        queries, weights = sent.value
        work = Accumulators(queries, weights, k)
        top = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in queries]
        for batch in batches:
            lists = batch.column(2)
            if not len(lists.flatten()):
                continue
            nulls = np.asarray(batch.column(0).is_null())
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy(zero_copy_only=False))
            scale = 10 + (90 * n * documents) // length
            work.index(scale, doc, lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy())
            for item in range(len(queries)):
                found, points = work.best(item)
                if not len(found):
                    continue
                scores = np.concatenate([top[item][0], points])
                both = np.concatenate([top[item][1], ids[found]])
                empty = np.concatenate([top[item][2], nulls[found]])
                chosen = _ranked(scores, both, empty, k)
                top[item] = scores[chosen], both[chosen], empty[chosen]
                if len(chosen) == k:
                    work.kth[item] = max(work.kth[item], scores[chosen[-1]])
        sizes = [len(scores) for scores, _, _ in top]
        if sum(sizes):
            scores, ids, nulls = (np.concatenate(parts) for parts in zip(*top, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(queries)), sizes), pa.int64()),
                    pa.array(ids, pa.int64(), mask=nulls),
                    pa.array(scores, pa.int64()),
                ],
                ["item", "doc_id", "score"],
            )

    return table.mapInArrow(score, "item long, doc_id long, score long")


def ranking(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id``, ``rank`` from 1, ``doc_id`` and ``score`` of each item's ``k`` best documents."""
    spark = docs.sparkSession
    parts = [_block(docs, block, k) for block in blocks(written(item_terms(items), "item-terms"))]
    if not parts:
        kind = items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _block(docs: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    pairs = [(row["item_id"], row["term"].encode()) for row in terms.collect()]  # bounded by the block
    vocabulary = sorted({term for _, term in pairs})
    table = written(forward(docs, vocabulary), "forward")
    totals = table.agg(F.count(F.lit(1)), F.sum("n")).first()
    frequency = np.zeros(len(vocabulary), np.int64)
    held = table.select(F.explode("terms").alias("term")).groupBy("term").count()
    for term, count in held.collect():  # at most one row a term of the block
        frequency[term] = count
    weights = np.array([weight(totals[0], int(count)) for count in frequency], np.int64)
    place = {term: i for i, term in enumerate(vocabulary)}
    by_item: dict = {}
    for item_id, term in pairs:
        by_item.setdefault(item_id, []).append(place[term])
    names = list(by_item)
    queries = []
    for name in names:
        own = np.array(sorted(by_item[name]), np.int64)
        own = own[(frequency[own] > 0) & (weights[own] > 0)]
        queries.append(own[np.argsort(frequency[own], kind="stable")])
    found = scored(table, queries, weights, totals[0], totals[1] or 1, k)
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    kind = terms.schema["item_id"].dataType.simpleString()
    named = spark.createDataFrame(list(enumerate(names)), f"item long, item_id {kind}")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .join(named, "item")
        .select("item_id", "rank", "doc_id", "score")
    )


def comparison_sql(k: int = 10) -> str:
    """The same over ``documents`` and ``benchmark`` in SQL."""
    words = f"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '{TERM_TEXT}')"""
    return f"""
        WITH docs AS (SELECT ROW_NUMBER() OVER () AS row, doc_id, {words} AS terms FROM documents),
        sizes AS (SELECT row, doc_id, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0),
        asked AS (SELECT DISTINCT item_id, unnest({words}) AS term FROM benchmark),
        held AS (SELECT row, term, COUNT(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs)
                 WHERE term IN (SELECT term FROM asked) GROUP BY row, term),
        totals AS (SELECT COUNT(*) AS documents, CAST(SUM(n) AS BIGINT) AS length FROM sizes),
        weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
                           AS w
                    FROM (SELECT term, COUNT(*) AS df FROM held GROUP BY term), totals),
        scores AS (SELECT item_id, row, doc_id,
                          CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // length))))
                               AS BIGINT) AS score
                   FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (row), totals
                   GROUP BY item_id, row, doc_id)
        SELECT item_id, CAST(ROW_NUMBER() OVER best AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
        WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)
        QUALIFY rank <= {k}"""
