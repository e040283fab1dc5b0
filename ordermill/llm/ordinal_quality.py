"""Quality by ordinal cumulative-link regression on graded ratings.

Grades are 0 (poor), 1 (sound text, but toxic) and 2 (sound).  The model has one weight for each hashed
feature, shared by all grades, and ordered thresholds: ``P(grade <= k) = logistic(threshold_k - score)``.
From these follow the expected grade and the probability of the top grade, by which documents are kept.

Features of a text, hashed into ``FEATURES`` places: its distinct lower-case words and
their beginnings; the distinct shapes of
its words (runs of capitals, small letters, digits and each other sign) with the logarithm of their
number; and shares of kinds of signs, of distinct words and of words equal to the one before, in steps.

The model is fitted on the ``SAMPLE`` labelled texts that come first by a hash of their id (all, if
fewer), of which those features come to the driver that recur; that bound does not depend on the corpus.  Every
document is scored, where it is read.

Defined results: a text that is null or has no word has expected grade 0, probability 0 and is not kept;
labels that are null in either column are not learned from; several labels of one id are all learned from;
without labels every text with words is kept; repeated rows get equal results; long texts are read whole;
an empty table gives no rows.  Only ``doc_id``, ``text``, ``quality`` and ``toxic`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import segments
from ordermill.llm.tables import written

#: Labelled documents that the model is fitted on, and places of hashed features.
SAMPLE, FEATURES = 20_000, 1 << 22
EPOCHS, RATE, DECAY = 8, 0.3, 2e-3
#: Documents of the sample that a feature must occur in to get a weight; rarer ones would be learned by heart.
OCCURS = 10
#: Bytes at the beginning of a longer word that are a feature of their own.
STEMS = (4, 5)
#: A document is kept if the top grade has this probability at least.
LEAST = 0.5

_ROOT = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
# classes of bytes for shapes: capitals, small letters (all of non-ASCII), digits, white space, each other sign
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = 65, 97, 97, 48
_CLASS[[9, 10, 11, 12, 13, 32]] = 32
_KINDS = {"upper": [65], "digit": [48], "space": [32], "mark": [ord(x) for x in "!*#%&$|@~^<>=+_/\\"]}


def features(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and place of each feature, distinct in a row, and the number of words of each row."""
    rows = len(offsets) - 1
    if len(flat) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(rows, np.int64)
    lower = np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8)
    starts, ends = segments.runs(_WORD[flat], offsets)
    words = segments.run_hashes(lower, starts, ends)
    number = np.diff(np.searchsorted(starts, offsets))
    row = np.repeat(np.arange(rows), number)
    pair = np.unique(row.astype(np.uint64) << np.uint64(40) | words >> np.uint64(24))
    parts = [(pair >> np.uint64(40), pair & np.uint64((1 << 40) - 1))]
    for size in STEMS:
        long = ends - starts > size
        stems = segments.run_hashes(lower, starts[long], starts[long] + size) + np.uint64(size)
        pair = np.unique(row[long].astype(np.uint64) << np.uint64(40) | stems >> np.uint64(24))
        parts.append((pair >> np.uint64(40), pair & np.uint64((1 << 40) - 1)))

    kinds = _CLASS[flat]
    first = np.ones(len(flat), bool)
    first[1:] = kinds[1:] != kinds[:-1]
    first[offsets[:-1][offsets[:-1] < len(flat)]] = True
    at = np.flatnonzero(first)
    short = kinds[at]
    short_offsets = np.searchsorted(at, offsets)
    s, e = segments.runs(short != 32, short_offsets)
    shapes = segments.run_hashes(short, s, e)
    shape_row = np.repeat(np.arange(rows), np.diff(np.searchsorted(s, short_offsets)))
    pair, times = np.unique(shape_row.astype(np.uint64) << np.uint64(40) | shapes >> np.uint64(24), return_counts=True)
    for step in range(int(np.log2(times.max(initial=1))) + 1):  # one feature for each power of two reached
        some = times >= 1 << step
        hashed = ((pair[some] & np.uint64((1 << 40) - 1)) + np.uint64(step * 7919 + 1)) * _ROOT >> np.uint64(24)
        parts.append((pair[some] >> np.uint64(40), hashed))

    size = np.maximum(np.diff(offsets), 1)
    sums = {name: np.add.reduceat(np.append(np.isin(kinds, ids), False).astype(np.int64), offsets[:-1]) * (np.diff(offsets) > 0) for name, ids in _KINDS.items()}
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    distinct = np.bincount(parts[0][0].astype(np.int64), minlength=rows)
    shares = [v / size for v in sums.values()] + [distinct / np.maximum(number, 1), np.bincount(row, same, rows) / np.maximum(number, 1)]
    for k, share in enumerate(shares):
        step = np.minimum((np.clip(share, 0, 1) * 20).astype(np.int64), 20)
        hashed = (np.uint64(1_000_003 * (k + 1)) + step.astype(np.uint64)) * _ROOT >> np.uint64(24)
        parts.append((np.arange(rows, dtype=np.uint64), hashed))
    all_rows = np.concatenate([r for r, _ in parts]).astype(np.int64)
    places = (np.concatenate([h for _, h in parts]) % np.uint64(FEATURES)).astype(np.int64)
    return all_rows, places, number


class Model:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -50, 50)))


def fit(rows: list[np.ndarray], grades: np.ndarray, places: np.ndarray) -> Model:
    """Stochastic gradient steps with a rate of its own for each weight, on shuffled batches; ``DECAY`` draws
    the weights of features that tell nothing to zero, so that long texts score like short ones.

    ``rows`` hold numbers of the features that get a weight, ``places`` where each of those is hashed to.
    """
    levels = 2
    fitted = np.zeros(FEATURES, np.float32)
    if not len(rows):
        return Model(fitted, np.full(levels, -50.0))
    weights, squares = np.zeros(len(places), np.float32), np.full(len(places), 1e-8, np.float32)
    share = np.array([(np.sum(grades <= k) + 1) / (len(grades) + levels + 1) for k in range(levels)])
    thresholds = np.log(share / (1 - share))
    rng = np.random.default_rng(20)
    step_squares = np.full(levels, 1e-8)
    for epoch in range(EPOCHS):
        rate = RATE / (1 + 0.3 * epoch)
        order = rng.permutation(len(rows))
        for low in range(0, len(order), 64):
            part = order[low : low + 64]
            used = np.concatenate([rows[i] for i in part])
            row = np.repeat(np.arange(len(part)), [len(rows[i]) for i in part])
            scores = np.bincount(row, weights[used], len(part))
            y = grades[part]
            below = 1 / (1 + np.exp(np.clip(scores[:, None] - thresholds[None, :], -50, 50)))
            ones, zeros = np.ones((len(part), 1)), np.zeros((len(part), 1))
            cumulative = np.hstack([zeros, below, ones])
            slope = cumulative * (1 - cumulative)
            own = np.arange(len(part))
            chance = np.maximum(cumulative[own, y + 1] - cumulative[own, y], 1e-9)
            by_score = (slope[own, y + 1] - slope[own, y]) / chance  # of the loss
            touched, back = np.unique(used, return_inverse=True)
            g = np.bincount(back, by_score[row], len(touched))
            g = g / len(part)
            squares[touched] += g * g
            step = rate / np.sqrt(squares[touched])
            moved = weights[touched] - step * g
            weights[touched] = np.sign(moved) * np.maximum(np.abs(moved) - step * DECAY, 0)
            by_threshold = np.zeros(levels)
            for k in range(levels):
                at = slope[:, k + 1] / chance
                by_threshold[k] = (np.where(y == k, -at, 0) + np.where(y == k + 1, at, 0)).sum() / len(part)
            step_squares += by_threshold**2
            thresholds -= rate * by_threshold / np.sqrt(step_squares)
            thresholds = np.maximum.accumulate(thresholds)
    fitted[places] = weights
    return Model(fitted, thresholds)


def _extracted(texts: DataFrame) -> DataFrame:
    """doc_id, grade, same (a hash of the text) and the places of the text's features."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, some in segments.row_slices(batch.column("text"), 500_000):
                row, place, _ = features(*segments.utf8(some))
                order = np.argsort(row, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=high - low))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place[order], pa.int32()))
                own = [batch.column(name).slice(low, high - low) for name in ("doc_id", "grade", "same")]
                yield pa.RecordBatch.from_arrays([*own, lists], names=["doc_id", "grade", "same", "places"])

    return texts.mapInArrow(segments.thrifty(extract), "doc_id long, grade int, same long, places array<int>")


def _numbered(found: DataFrame, places: np.ndarray) -> DataFrame:
    """Features as numbers in ``places`` (ascending), others left out."""
    sent = found.sparkSession.sparkContext.broadcast(places)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            lists = batch.column("places")
            value = lists.flatten().to_numpy()
            at = np.minimum(np.searchsorted(known, value), max(len(known) - 1, 0))
            held = known[at] == value if len(known) else np.zeros(len(value), bool)
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())[held]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lists)))])
            kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at[held], pa.int32()))
            own = [batch.column(name) for name in ("doc_id", "grade", "same")]
            yield pa.RecordBatch.from_arrays([*own, kept], names=["doc_id", "grade", "same", "places"])

    return found.mapInArrow(number, "doc_id long, grade int, same long, places array<int>")


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the first ``SAMPLE`` labels by a hash of the id, and as many different labelled texts.

    Spark counts in how many texts a feature occurs; what comes to the driver are the features that occur in
    ``OCCURS`` and, of each text, its numbers of those.
    """
    quality, toxic = F.col("quality"), F.col("toxic")
    graded = labels.where(quality.isNotNull() & toxic.isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.when(quality == 0, 0).when(toxic == 1, 1).otherwise(2)).alias("grade")
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("grade")]
    sample = graded.orderBy(*order).limit(SAMPLE)
    same = F.xxhash64("text").alias("same")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    # rows of one id may be many: as many different texts are learned from as labels at most
    chosen = texts.select("doc_id", "grade", same).distinct().orderBy(*order, "same").limit(SAMPLE)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", same)
    rows = rows.join(F.broadcast(written(chosen, "labelled")), ["doc_id", "same"]).select("doc_id", "grade", "same", "text")
    found = written(_extracted(rows).dropDuplicates(["doc_id", "grade", "same"]), "features")
    times = found.select(F.explode(F.array_distinct("places")).alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    places = np.sort(times.where(F.col("n") >= OCCURS).select("place").toArrow().column("place").to_numpy())
    table = _numbered(found, places).toArrow().sort_by([("doc_id", "ascending"), ("grade", "ascending"), ("same", "ascending")])
    lists = table.column("places").combine_chunks()
    starts = np.cumsum(lists.value_lengths().to_numpy())[:-1] if len(lists) else np.zeros(0, np.int64)
    numbers = np.split(lists.flatten().to_numpy(), starts) if len(lists) else []
    return fit(numbers, table.column("grade").to_numpy().astype(np.int64), places)


def rated(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_grade (0 to 2), top_probability, keep; one row for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            expected, top, keep = [], [], []
            for low, high, some in segments.row_slices(batch.column("text"), 500_000):
                row, place, words = features(*segments.utf8(some))
                tails = fitted.tails(np.bincount(row, fitted.weights[place], high - low)) * (words > 0)[:, None]
                expected.append(tails.sum(axis=1))
                top.append(tails[:, -1])
                keep.append(tails[:, -1] >= LEAST)
            join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), join(expected, pa.float64()), join(top, pa.float64()), join(keep, pa.bool_())],
                names=["doc_id", "expected_grade", "top_probability", "keep"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        segments.thrifty(rate), "doc_id long, expected_grade double, top_probability double, keep boolean"
    )


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose top grade is likely enough."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for low, high, some in segments.row_slices(batch.column("text"), 500_000):
                row, place, words = features(*segments.utf8(some))
                top = fitted.tails(np.bincount(row, fitted.weights[place], high - low))[:, -1]
                yield batch.slice(low, high - low).filter(pa.array((top >= LEAST) & (words > 0)))

    return docs.mapInArrow(segments.thrifty(choose), docs.schema)
