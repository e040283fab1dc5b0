"""Best-fit packing of token sequences by bin completion.

Documents are encoded and cut into pieces where they are read; from there on only a piece's document, place,
length and checksum are moved.  Full pieces are sequences of their own.  The others are dealt by a hash into
groups of about ``ROUND``, so that every group has the same mix of lengths however the table is sorted or
split, and each group is packed by one task.  Pieces of sequences that were left with more than ``ROOM`` are
dealt anew into fewer groups and packed again, until they are one group or less than a tenth of them finds
a better sequence.

A group is a search by branch and bound.  Lengths are kept as counts, since pieces of one length are
alike.  Each step takes the largest length left and enumerates ways to fill the rest of its sequence; a
filling is dominated, and left out, if a longer unused piece would fit in the place of one of its own.
Fillings are tried from the least waste on.  A branch is cut when its waste so far leaves no room for a
solution better than the incumbent, which at first is the best-fit-decreasing one; reaching a lower bound
ends the search, and so does a documented number of steps (``STEPS_PER_BIN``).

Defined results: a null or empty text is a document of the end id alone; documents without an id, repeated
ids and repeated rows are packed like any others; only documents longer than the capacity are cut, the
first piece taking the remainder and the others being full; an empty table gives no rows.  Columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import segments
from ordermill.llm.tables import written
from ordermill.llm.token_records import encoded

#: Pieces packed together; bounds a task's memory.
ROUND = 20_000
#: Bytes of text that are encoded at once.
SLICE = 1_000_000
#: Share of a sequence that may stay empty without its pieces being dealt anew.
ROOM = 1 / 16
#: Fillings considered at a step, and steps allowed for each sequence of the incumbent.
FILLINGS, STEPS_PER_BIN = 4, 3
_PIECE = ["doc_id", "piece", "start", "length", "ids_crc32"]


def best_fit(counts: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each length goes where it leaves least room."""
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []
    for length in range(capacity, 0, -1):
        for _ in range(int(counts[length])):
            at = bisect_left(rooms, (length, -1))
            if at < len(rooms):
                room, i = rooms.pop(at)
                bins[i].append(length)
            else:
                room, i = capacity, len(bins)
                bins.append([length])
            if room > length:
                insort(rooms, (room - length, i))
    return bins


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: for each size ``a``, pieces over ``capacity - a`` stand alone,
    other pieces over half fill one each, and pieces from ``a`` to half go into what those leave."""
    sizes = np.arange(capacity + 1)
    number = np.concatenate([[0], np.cumsum(counts)])
    length = np.concatenate([[0], np.cumsum(counts * sizes)])
    half = capacity // 2
    a = np.arange(half + 1)
    alone = number[-1] - number[capacity - a + 1]
    middle = number[capacity - a + 1] - number[half + 1]
    room = middle * capacity - (length[capacity - a + 1] - length[half + 1])
    small = length[half + 1] - length[a]
    return int((alone + middle + np.maximum(0, -((room - small) // capacity))).max())


def _undominated(filling: list[int], counts: np.ndarray, room: int) -> bool:
    """No length of the filling can give way to a longer one that is left and fits as well."""
    slack = room - sum(filling)
    if slack == 0:
        return True
    for length in set(filling):
        for longer in range(length + 1, length + slack + 1):
            if counts[longer] > filling.count(longer):
                return False
    return True


def fillings(counts: np.ndarray, room: int, most: int = FILLINGS) -> list[list[int]]:
    """Undominated ways to fill ``room``, least waste first: exact ones of one, two and three pieces, and
    the one that takes the longest piece again and again."""
    found: list[list[int]] = []
    if room and counts[room]:
        return [[room]]  # it dominates every other filling
    half = room // 2
    if half:
        low = np.flatnonzero(counts[1 : half + 1]) + 1
        pairs = low[counts[room - low] > (room - low == low)]
        found = [[room - int(x), int(x)] for x in pairs[:most]]
    if not found and room > 2:
        for first in (np.flatnonzero(counts[1 : room - 1]) + 1)[::-1][: 2 * most].tolist():
            counts[first] -= 1
            rest = room - first
            low = np.flatnonzero(counts[1 : rest // 2 + 1]) + 1
            pairs = low[counts[rest - low] > (rest - low == low)]
            counts[first] += 1
            found += [[first, rest - int(x), int(x)] for x in pairs[:1]]
            if len(found) >= most:
                break
    if len(found) < most:
        taken, left = [], room
        while left:
            fits = np.flatnonzero(counts[1 : left + 1])
            if not len(fits):
                break
            length = int(fits[-1]) + 1
            times = min(int(counts[length]), left // length)
            taken += [length] * times
            left -= length * times
            counts[length] -= times
        for length in taken:
            counts[length] += 1
        if _undominated(taken, counts, room):
            found.append(taken)
    unique = {tuple(sorted(x, reverse=True)): None for x in found}
    return sorted(map(list, unique), key=lambda x: room - sum(x)) or [[]]


def pack(counts: np.ndarray, capacity: int) -> list[list[int]]:
    """Lengths of each sequence for a round.  ``counts[l]``: pieces of length ``l``."""
    counts = counts.astype(np.int64).copy()
    best = best_fit(counts, capacity)
    total = int((counts * np.arange(len(counts))).sum())
    bound = lower_bound(counts, capacity)
    left, steps = int(counts.sum()), STEPS_PER_BIN * len(best) + 1000
    # every frame: the largest length, fillings still to try, the filling in use, waste before it
    frames: list[list] = []
    waste, largest = 0, capacity
    while len(best) > bound and steps:
        steps -= 1
        allowed = (len(best) - 1) * capacity - total
        if waste > allowed or left == 0:
            if left == 0 and len(frames) < len(best):
                best = [[f[0], *f[2]] for f in frames]
            while frames:  # back to a step with another filling
                largest, others, used, waste = frames[-1]
                counts[used] += 1 if len(set(used)) == len(used) else 0
                if len(set(used)) != len(used):
                    np.add.at(counts, used, 1)
                left += len(used)
                if others:
                    break
                frames.pop()
                counts[largest] += 1
                left += 1
            else:
                break
            frame = frames[-1]
            frame[2] = frame[1].pop(0)
        else:
            while counts[largest] == 0:
                largest -= 1
            counts[largest] -= 1
            left -= 1
            ways = fillings(counts, capacity - largest)
            frame = [largest, ways[1:], ways[0], waste]
            frames.append(frame)
        np.subtract.at(counts, frame[2], 1)
        left -= len(frame[2])
        waste = frame[3] + capacity - frame[0] - sum(frame[2])
        largest = frame[0]
    return best


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Every piece of every document, without a sequence yet, and ``row``, a number of its own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            done: list[tuple] = []
            for row, ids in encoded(batch, tokenizer, end_id, SLICE):
                data, start, piece = ids.astype("<u4"), 0, 0
                while start < len(data):
                    size = (len(data) - start - 1) % capacity + 1 if not piece else capacity
                    crc = zlib.crc32(data[start : start + size].tobytes())
                    done.append((doc_ids[row], piece, start, size, crc))
                    start, piece = start + size, piece + 1
            columns = zip(*done, strict=True) if done else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_PIECE
            )

    columns = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    found = columns.mapInArrow(segments.thrifty(cut), "doc_id long, piece int, start long, length long, ids_crc32 long")
    return written(found.withColumn("row", F.monotonically_increasing_id()), "pieces")


def _packed_group(table: pa.Table, capacity: int) -> pa.Table:
    """Sequence number in the group and offset of each piece, and whether its sequence is full."""
    rows, lengths = table.column("row").to_numpy(), table.column("length").to_numpy()
    order = np.argsort(lengths, kind="stable")
    ends = np.searchsorted(lengths[order], np.arange(capacity + 2))
    counts = np.diff(ends)
    following = ends[:-1].copy()
    sequence, offset, full = (np.zeros(len(rows), np.int64) for _ in range(3))
    for number, filling in enumerate(pack(counts, capacity)):
        at = 0
        for length in filling:
            i = order[following[length]]
            following[length] += 1
            sequence[i], offset[i], full[i] = number, at, capacity - sum(filling) <= capacity * ROOM
            at += length
    group = table.column("group")[0].as_py()
    return pa.table(
        {"row": rows, "sequence_id": (group << 32) + sequence, "offset": offset, "full": full.astype(bool)}
    )


def packed(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """One row per piece: its document, number, start in the document, length and checksum, and its
    sequence and place there.  Sequence numbers are unique and otherwise arbitrary."""
    every = pieces(docs, tokenizer, end_id, capacity)
    whole = every.where(F.col("length") == capacity)
    # numbers of full pieces are those of their rows, below the numbers that rounds give
    placed = [whole.select("row", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    left = every.where(F.col("length") < capacity).select("row", "length")
    waiting, used = left.count(), 0
    while waiting:
        groups = -(-waiting // ROUND)
        group = F.pmod(F.xxhash64("row", F.lit(used)), F.lit(groups)) + used
        found = written(
            left.withColumn("group", group)
            .repartition(groups, "group")  # a task for a group or few: there is little to read and much to do
            .groupBy("group")
            .applyInArrow(lambda table: _packed_group(table, capacity), "row long, sequence_id long, offset long, full boolean"),
            "packed",
        )
        used += groups
        again = found.where("NOT full").select("row").join(left, "row")
        open_ = again.count() if groups > 1 else 0
        last = open_ > 0.9 * waiting or not open_
        placed.append((found if last else found.where("full")).select("row", "sequence_id", "offset"))
        if last:
            break
        left, waiting = written(again, "open"), open_
    places = placed[0]
    for some in placed[1:]:
        places = places.unionByName(some)
    return every.join(places, "row").select(*_PIECE, "sequence_id", "offset")
