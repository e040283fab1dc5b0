"""Language identification with Bloom filters of n-grams, one bit per language.

Learning counts the n-grams of every training text by language.  A language holds the n-grams that make up
at least ``LEAST_SHARE`` of its own n-grams, so it holds at most ``1 / LEAST_SHARE`` of them, whatever the
size of the corpus.  The filter is bit-sliced: a slot is a mask with a bit for each language, and an n-gram
sets its languages' bits in several slots.  One lookup, the conjunction of an n-gram's slots, gives all
languages that hold it.  A text's n-grams are looked up and counted for each language; from the share of a
language's bits that are set follows how many of its hits are false, and the counts are corrected for that.
The count is divided by the share of its training n-grams that the language's filter holds, so that a filter
that had to leave out more, in a larger corpus or a script of many letters, is no less likely to be chosen.  The
language with the largest count is the prediction, its share of the text's n-grams, 1 at most, the score.

N-grams are runs of ``N`` signs of the lower-case text in which every sign that is no letter counts as the
same one and stands only at either end.

Defined results: a text that is null or has no letter is ``und`` with score 0; a text with letters but
without n-grams gets the language with most training texts, score 0, as does every text if that language
alone was learned from; ties go to the language first by name; without training texts all are ``und``;
training texts without a language are not learned from; rows that repeat are counted as often; long texts
are read whole; an empty table gives no rows.  Only ``doc_id``, ``text`` and, for learning, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import segments
from ordermill.llm.tables import written

#: Signs of an n-gram; a language's n-grams have this share of its own n-grams at least.
N, LEAST_SHARE = 4, 2e-5
#: Slots of the filter and slots that an n-gram sets.
SLOTS, HASHES = 1 << 20, 3
#: N-gram counts that a task holds before it passes them on.
HELD = 500_000

_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each n-gram, its row, and whether each row has a letter."""
    lowered = [(t or "").lower() for t in texts]
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    distinct, back = np.unique(points, return_inverse=True) if points.max(initial=0) > 0x2FFF else (np.arange(0x3000), points)
    letter = np.fromiter((chr(p).isalpha() for p in distinct.tolist()), bool, len(distinct))
    is_letter = letter[back]
    rows = np.repeat(np.arange(len(lowered)), lengths)
    has_letter = np.zeros(len(lowered), bool)
    has_letter[rows[is_letter]] = True
    sign = np.concatenate([[0], np.where(is_letter, points, 0)]).astype(np.uint64)
    inner = np.concatenate([[False], is_letter])
    count = len(sign) - N + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has_letter
    valid = np.ones(count, bool)
    for k in range(1, N - 1):
        valid &= inner[k : count + k]
    at = np.flatnonzero(valid)
    mixed = np.zeros(len(at), np.uint64)
    for k in range(N):
        mixed = (mixed ^ sign[at + k]) * _P[k % 4]
        mixed ^= mixed >> np.uint64(29)
    return mixed, rows[at], has_letter  # sign i + 1 is point i, the n-gram's first inner sign


def _row_slices(column: pa.Array) -> Iterator[tuple[int, int, list]]:
    for low, high, some in segments.row_slices(column, 500_000):
        yield low, high, some.to_pylist()


def gram_counts(training: DataFrame) -> DataFrame:
    """lang, gram, n over all rows of (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def passed_on() -> pa.RecordBatch:
            langs = [lang for lang, (keys, _) in held.items() for _ in range(len(keys))]
            keys = np.concatenate([k for k, _ in held.values()] or [np.zeros(0, np.uint64)])
            sums = np.concatenate([n for _, n in held.values()] or [np.zeros(0, np.int64)])
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(keys.view(np.int64)), pa.array(sums, pa.int64())],
                names=["lang", "gram", "n"],
            )

        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for low, high, texts in _row_slices(batch.column("text")):
                found, rows, _ = grams(texts)
                own = langs[low:high]
                for lang in set(own.tolist()):
                    keys, n = np.unique(found[(own == lang)[rows]], return_counts=True)
                    if lang in held:
                        both = np.concatenate([held[lang][0], keys])
                        keys, back = np.unique(both, return_inverse=True)
                        n = np.bincount(back, np.concatenate([held[lang][1], n]), len(keys)).astype(np.int64)
                    held[lang] = keys, n
                if sum(len(k) for k, _ in held.values()) > HELD:
                    yield passed_on()
        yield passed_on()

    parts = training.select("lang", "text").mapInArrow(segments.thrifty(count), "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """The learned filters, of fixed size."""

    def __init__(self, langs: list[str], usual: str | None, entries: pa.Table | None, covered: list[float]):
        """``entries``: slot and masks of up to 63 languages each; ``covered``: the share of each language's
        n-grams, counted with repeats, that its filter holds."""
        self.langs, self.usual, self.covered = langs, usual, np.array(covered)
        words = -(-max(len(langs), 1) // 63)
        self.slots = np.zeros((words, SLOTS), np.int64)
        for w in range(words if entries is not None else 0):
            self.slots[w, entries.column("slot").to_numpy()] = entries.column(f"w{w}").to_numpy()
        if len(langs) <= 7:
            self.slots = self.slots.astype(np.int8)
        self.false = np.array([(self._bit(i, slice(None)) != 0).mean() ** HASHES for i in range(len(langs))])

    def _bit(self, i: int, at) -> np.ndarray:
        return self.slots[i // 63][at] >> (i % 63) & 1

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[int]]:
        """Language, score and number of n-grams of each text."""
        found, rows, has_letter = grams(texts)
        number = np.bincount(rows, minlength=len(texts))
        masks = None
        for at in gram_slots(found):
            masks = self.slots[:, at] if masks is None else masks & self.slots[:, at]
        best = np.full(len(texts), -1)
        most = np.zeros(len(texts))
        for i in range(len(self.langs)):
            hits = np.bincount(rows, masks[i // 63] >> (i % 63) & 1, len(texts))
            true = (hits - self.false[i] * number) / (1 - self.false[i]) if self.false[i] < 1 else hits * 0
            true = true / self.covered[i]
            better = true > most + 1e-9
            best[better], most[better] = i, true[better]
        names = [
            "und" if not has or self.usual is None else self.langs[b] if b >= 0 else self.usual
            for has, b in zip(has_letter.tolist(), best.tolist(), strict=True)
        ]
        return names, np.clip(most / np.maximum(number, 1), 0, 1).tolist(), number.tolist()


def gram_slots(found: np.ndarray) -> Iterator[np.ndarray]:
    for k in range(HASHES):
        yield ((found * _P[k + 1]) >> np.uint64(44)).astype(np.int64) & (SLOTS - 1)


def learn(training: DataFrame) -> Filters:
    """Filters from rows of (lang, text).  What comes to the driver is the filter itself, of ``SLOTS`` rows
    at most, and the names of the languages."""
    known = training.where(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text")
    totals = {row["lang"]: row["texts"] for row in known.groupBy("lang").agg(F.count(F.lit(1)).alias("texts")).collect()}
    langs = sorted(totals)
    if not langs:
        return Filters([], None, None, [])
    counts = gram_counts(known)
    counts = written(counts, "grams")
    sums = counts.groupBy("lang").agg(F.sum("n").alias("total"))  # one row a language
    held = counts.join(F.broadcast(sums), "lang").where(F.col("n") >= F.col("total") * LEAST_SHARE)
    shares = held.groupBy("lang").agg((F.sum("n") / F.max("total")).alias("share")).collect()
    covered = {row["lang"]: row["share"] for row in shares}
    number = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1
    held = held.withColumn("number", number.cast("int"))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("gram").to_numpy(zero_copy_only=False).view(np.uint64)
            numbers = batch.column("number").to_numpy(zero_copy_only=False)
            for at in gram_slots(found):
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(numbers)], names=["slot", "number"])

    words = -(-len(langs) // 63)
    masks = [
        F.bit_or(F.when(F.floor(F.col("number") / 63) == w, F.expr("shiftleft(1L, number % 63)")).otherwise(F.lit(0).cast("long"))).alias(f"w{w}")
        for w in range(words)
    ]
    entries = held.select("gram", "number").mapInArrow(slots, "slot long, number int").groupBy("slot").agg(*masks)
    usual = max(langs, key=lambda x: totals[x])
    return Filters(langs, usual, entries.toArrow(), [covered.get(lang, 1.0) for lang in langs])


def predicted(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred, score; one row for every row, in place."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for _, _, texts in _row_slices(batch.column("text")):
                some, their, _ = shared.value.predict(texts)
                names += some
                scores += their
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        segments.thrifty(predict), "doc_id long, lang_pred string, score double"
    )


def accepted(docs: DataFrame, filters: Filters, least: float) -> DataFrame:
    """The rows of ``docs``, all columns as they are, but texts that are ``und`` or score below ``least``.  A text
    with letters that is too short for n-grams gives no reason to reject it."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in _row_slices(batch.column("text")):
                found = zip(*shared.value.predict(texts), strict=True)
                keep = [name != "und" and (score >= least or not number) for name, score, number in found]
                yield batch.slice(low, high - low).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(segments.thrifty(choose), docs.schema)


def held_out(doc_id: Column) -> Column:
    """Every fifth document, by a checksum of its id; those without an id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
