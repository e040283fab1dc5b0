"""Exact Jaccard join of word-shingle sets, by regions of a metric space.

The Jaccard distance is a metric, so a pivot's distances to two sets differ by no more than the sets'
distance.  Almost all pairs of documents share nothing, and all pivots are equally far from both.  Therefore
the space is first parted into families.  Of shingles in the order of their hashes, let ``first(n)`` be
the number of which a set of n must share one with every set within the radius.  The first ``first(n) + k``
shingles then share ``k + 1`` with those of a close set, for the smaller k of both.  Sets that share too few
shingles for a close set of any size are apart from all others; pairs that share enough are of one family, and so are sets that meet
in a shingle of more than ``SHORT`` sets, whose pairs are not listed.  Families are thus found exactly: what
is in different ones is not linked.

Families are regions.  A region whose comparison is bounded (``WHOLE``) is joined by one task.  A larger
region takes up to ``PIVOTS`` sets as pivots and compares them with all its
members, in blocks of ``BLOCK``; a pivot's pairs are then all known.  Members
linked with the pivot that has most links, or with one that a block's links connect with it, are settled:
they are in one component, so pairs among them add nothing.  The others are open, and all pairs with an open set are
still to be found.  Settled sets are parted into Voronoi cells by their nearest pivot, and an open set goes
to each cell in which, by the triangle inequality, a member can be close to it: its
distance to every pivot is within the radius of those of the cell's members.  What is left are pairs of open
sets.  Where much was settled, the open sets are a region of their own and are joined in the same way; where
the pivots settled little, the open sets are parted into cells and meet by the same windows, which ends the
region.  A settled set is never sent twice but for visitors that one task cannot hold.  The links found connect the
same sets as all links do: a block passes on one link of each member, and
for its pivots the number of links and the smallest pivot they connect it with, which is as much.

Equal sets are one from the beginning, so a text with very many copies costs as much as one.  A large region
is cut into blocks, and all else is grouped aggregates and two-table joins.  Shingles are 48-bit hashes and
sets are named by a 64-bit hash; pairs are compared by their whole sets of shingle hashes.  What comes to
the driver are filters of fixed size (``FILTER_BITS``) that leave out sets without links before a shuffle; a
full one would cost speed, not links.

Defined results: a text that is null or has no word has an empty set and is linked with nothing; rows
without an id are linked with nothing and have no component; rows that repeat an id each have a row;
ties do not matter, as components do not depend on them; an empty table gives no rows; texts are read
whole.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordermill.llm import segments
from ordermill.llm.tables import written

#: Sets that share a shingle are listed as pairs up to this number.
SHORT = 32
#: Shingles that a set lists at least, if it has as many.
LEAST_LISTED = 64
#: Pivots of a region in a round, members compared in one task's block, bits of a filter.
PIVOTS, BLOCK, FILTER_BITS = 64, 256, 24
#: Sets, shingles of all of them, and look-ups of shingles for 64 sets at a time, with which one task joins a
#: region whole.
WHOLE, WHOLE_SHINGLES, WHOLE_WORK = 512, 2_000_000, 100_000_000
#: Shingles that are looked up at once.
LOOKED_UP = 200_000
#: Members of a cell, and visitors of it, that meet in one task.
PART, VISITORS = 1024, 4096
#: Share of a region that pivots have to settle for the rest to be joined as a region of its own.
SETTLES = 1 / 8
#: Shingles that a task holds before it passes them on.
HELD = 400_000

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_sets(flat: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """All rows' distinct shingles, ascending in each row, and each row's first (one more at the end)."""
    rows = len(offsets) - 1
    if len(flat) == 0:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    lower = np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8)
    starts, ends = segments.runs(~_SEPARATOR[flat], offsets)
    word = segments.run_hashes(lower, starts, ends)
    first = np.searchsorted(starts, offsets)
    count = np.diff(first)
    row = np.repeat(np.arange(rows), count)
    size = np.minimum(count, words)  # words of each row's shingles
    at = np.flatnonzero(np.arange(len(word)) + size[row] <= first[1:][row])
    mixed = word * _M1
    combined = size[row[at]].astype(np.uint64) + mixed[at]
    for k in range(1, words):
        following = mixed[np.minimum(at + k, len(word) - 1)]
        if (size < words).any():
            following = np.where(k < size[row[at]], following, np.uint64(0))
        combined = (combined ^ (combined >> np.uint64(29))) * _M2 + following
    combined = _mixed(combined)
    # rows of a slice fit in 16 bits
    keys = np.unique(row[at].astype(np.uint64) << np.uint64(48) | combined >> np.uint64(16))
    of = (keys >> np.uint64(48)).astype(np.int64)
    return keys & np.uint64((1 << 48) - 1), np.searchsorted(of, np.arange(rows + 1))


def sets_of(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a batch: first row, row after the last, shingles, places."""
    for low, high, some in segments.row_slices(batch.column("text"), 500_000):
        flat, offsets = segments.utf8(some)
        for begin in range(low, high, 1 << 16):
            end = min(high, begin + (1 << 16))
            places = offsets[begin - low : end - low + 1]
            yield begin, end, *shingle_sets(flat[places[0] : places[-1]], places - places[0], words)


def names_of(shingles: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; 0 for an empty one."""
    sums = np.add.reduceat(np.append(_mixed(shingles + _M2), np.uint64(0)), places[:-1]) if len(places) > 1 else np.zeros(0, np.uint64)
    return np.where(np.diff(places) > 0, _mixed(sums ^ np.diff(places).astype(np.uint64)) | np.uint64(1), 0)


def packed_shingles(shingles: np.ndarray) -> bytes:
    """Six bytes for each shingle."""
    return shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked_shingles(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8")[:, 0]


def first_size(n: np.ndarray, per_cent: int) -> np.ndarray:
    """Shingles of which a set must share one with any set within the radius."""
    return np.where(n > 0, n - -(-n * per_cent // 100) + 1, 0)


def listed_size(n: np.ndarray, per_cent: int) -> np.ndarray:
    """Shingles that a set lists: half as many more, ``LEAST_LISTED`` at least, all at most."""
    first = first_size(n, per_cent)
    return np.minimum(n, np.maximum(LEAST_LISTED, first + first // 2))


def shared_least(n: np.ndarray, per_cent: int) -> np.ndarray:
    """Two close sets share as many listed shingles as the smaller of their two numbers says.  It rises with
    n, falls from ``LEAST_LISTED`` on, and rises again where more than ``LEAST_LISTED`` are listed."""
    return listed_size(n, per_cent) - first_size(n, per_cent) + 1


def shared_fewest(n: Column, per_cent: int) -> Column:
    """The smallest ``shared_least`` of all sizes that a set close to one of n can have, n among them.

    ``shared_least`` is the smaller of ``ceil(n * per_cent / 100)`` and of ``rest(first_size(n))``.  Both of
    what they are taken of grow with n, the second in steps of one, and ``rest`` falls up to its lowest place
    and does not fall after it.  So the first is smallest at the least size, the second nearest to that place.
    """
    rest = lambda first: max(LEAST_LISTED - first, first // 2) + 1
    lowest = min(range(1, LEAST_LISTED + 1), key=rest)
    whole = lambda m: F.ceil(m * per_cent / 100)
    first = lambda m: m - whole(m) + 1
    low, high = whole(n), F.floor(n * 100 / per_cent)
    place = F.least(F.greatest(F.lit(lowest), first(low)), first(high))
    return F.least(whole(low), F.greatest(F.lit(LEAST_LISTED) - place, F.floor(place / 2)) + 1)


class Filter:
    """Membership in a set of 64-bit numbers, with false positives but no false negatives."""

    def __init__(self, words: pa.Table):
        self.bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
        self.bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)

    def holds(self, numbers: np.ndarray) -> np.ndarray:
        at = numbers & np.uint64((1 << FILTER_BITS) - 1)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def filter_of(numbers: DataFrame, name: str) -> Broadcast:
    """A broadcast filter of the low bits of a column of longs."""
    low = F.col(name).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.expr(f"shiftleft(1L, cast({name} & 63 AS int))")
    words = numbers.select(F.shiftright(low, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = Filter(words.toArrow())
    return numbers.sparkSession.sparkContext.broadcast(found)


def _listed(docs: DataFrame, words: int, per_cent: int, buckets: int) -> DataFrame:
    """Rows of two kinds: doc_id, n, name for each document; and packed (shingle, name) pairs by bucket,
    in which equal sets of a task come once.  A listed shingle is its bucket and 32 bits more; shingles that
    these do not tell apart make families larger, never smaller."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, seen = [], 0, set()

        def rows(ids: list, n: list, names: list, bucket: list, tokens: list, of: list) -> pa.RecordBatch:
            columns = (ids, n, names, bucket, tokens, of)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["doc_id", "n", "name", "bucket", "tokens", "names"],
            )

        def passed_on() -> pa.RecordBatch:
            token = np.concatenate([t for t, _ in held] or [np.zeros(0, np.uint64)])
            name = np.concatenate([n for _, n in held] or [np.zeros(0, np.uint64)])
            held.clear()
            mixed = _mixed(token)
            bucket, token = (mixed % np.uint64(buckets)).astype(np.int64), (mixed >> np.uint64(32)).astype(np.uint32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            some = np.flatnonzero(np.diff(cuts)).tolist()
            pack = lambda x, b: x[order[cuts[b] : cuts[b + 1]]].tobytes()
            nothing = [None] * len(some)
            return rows(nothing, nothing, nothing, some, [pack(token, b) for b in some], [pack(name, b) for b in some])

        for batch in batches:
            ids = batch.column("doc_id")
            for low, high, shingles, places in sets_of(batch, words):
                n, names = np.diff(places), names_of(shingles, places)
                own = ids.slice(low, high - low).to_pylist()
                linked = [k if k and i is not None else None for i, k in zip(own, names.view(np.int64).tolist(), strict=True)]
                fresh = np.zeros(len(n), bool)
                for i, name in enumerate(linked):
                    if name is not None and name not in seen:
                        seen.add(name)
                        fresh[i] = True
                if len(seen) > HELD:
                    seen.clear()
                size = np.where(fresh, listed_size(n, per_cent), 0)
                chosen = shingles[np.arange(len(shingles)) - np.repeat(places[:-1], n) < np.repeat(size, n)]
                held.append((chosen, np.repeat(names, size)))
                waiting += len(chosen)
                nothing = [None] * len(own)
                yield rows(own, n.tolist(), linked, nothing, nothing, nothing)
                if waiting > HELD:
                    waiting = 0
                    yield passed_on()
        yield passed_on()

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return columns.mapInArrow(segments.thrifty(emit), "doc_id long, n long, name long, bucket int, tokens binary, names binary")


_BUCKET = "bucket int, tokens binary, names binary, many binary"


def _shared(table: pa.Table) -> pa.Table:
    """A bucket's distinct (shingle, name) pairs whose shingle several sets list, by shingle, in one packed row;
    ``many`` marks shingles of more than ``SHORT`` sets."""
    token = np.frombuffer(b"".join(table.column("tokens").to_pylist()), np.uint32)
    name = np.frombuffer(b"".join(table.column("names").to_pylist()), np.int64)
    order = np.lexsort((name, token))
    token, name = token[order], name[order]
    kept = np.ones(len(token), bool)
    kept[1:] = (token[1:] != token[:-1]) | (name[1:] != name[:-1])
    token, name = token[kept], name[kept]
    _, back, times = np.unique(token, return_inverse=True, return_counts=True)
    several = times[back] > 1
    packed = [x[several].tobytes() for x in (token, name, times[back] > SHORT)]
    columns = [pa.array([table.column("bucket")[0].as_py()], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)]
    return pa.table(columns, names=["bucket", "tokens", "names", "many"])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for tokens, names, many in zip(*(batch.column(c).to_pylist() for c in ("tokens", "names", "many")), strict=True):
            yield np.frombuffer(tokens, np.uint32), np.frombuffer(names, np.int64), np.frombuffer(many, bool)


_COUNTS = "part int, names binary, met binary, common binary"


def _met(parts: int):
    """How many listed shingles of each set others list too, and how many of those are common, added up over
    some buckets of a task and packed by parts of the names."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def passed_on() -> pa.RecordBatch:
            names, back = np.unique(np.concatenate([n for n, _ in held] or [np.zeros(0, np.int64)]), return_inverse=True)
            many = np.concatenate([m for _, m in held] or [np.zeros(0, bool)])
            held.clear()
            counts = np.bincount(back, minlength=len(names)), np.bincount(back, many, len(names))
            part = (_mixed(names.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            some = np.flatnonzero(np.diff(cuts)).tolist()
            pack = lambda x: pa.array([x[order[cuts[p] : cuts[p + 1]]].tobytes() for p in some], pa.binary())
            columns = [pa.array(some, pa.int32()), pack(names), *(pack(c.astype(np.int32)) for c in counts)]
            return pa.RecordBatch.from_arrays(columns, names=["part", "names", "met", "common"])

        for _, names, many in _buckets(batches):
            held.append((names, many))
            waiting += len(names)
            if waiting > HELD:
                waiting = 0
                yield passed_on()
        yield passed_on()

    return count


def _met_sums(table: pa.Table) -> pa.Table:
    """The counts of a part's names, one row each."""
    whole = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
    names, back = np.unique(whole("names", np.int64), return_inverse=True)
    sums = [np.bincount(back, whole(c, np.int32), len(names)).astype(np.int64) for c in ("met", "common")]
    return pa.table([pa.array(names), *map(pa.array, sums)], names=["name", "met", "common"])


def _pairs(token: np.ndarray, name: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
    """Pairs (a, b) of sets of a bucket and how many uncommon shingles they meet in.  For a common shingle come
    the pairs of its smallest name with each other one, as ``star``, which need no number."""
    start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(token)))
    single = ~many[start]
    parts = [np.zeros((0, 3), np.int64)]
    for n in range(2, SHORT + 1):
        rows = start[(size == n) & single][:, None] + np.arange(n)[None, :]
        i, j = np.triu_indices(n, 1)
        left, right = name[rows[:, i].ravel()], name[rows[:, j].ravel()]
        parts.append(np.stack([left, right, np.zeros(len(left), np.int64)], axis=1))
    centre = np.repeat(name[start], size)
    star = many & (centre != name)
    parts.append(np.stack([centre[star], name[star], np.ones(star.sum(), np.int64)], axis=1))
    pairs, times = np.unique(np.concatenate(parts), axis=0, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(pairs[:, 2]), pa.array(times.astype(np.int64))],
        names=["a", "b", "star", "times"],
    )


def family_links(listed: DataFrame, named: DataFrame, per_cent: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect the sets of each family; and (name, share) of sets that can have links.

    Buckets stay packed: a task reads its bucket's shingles twice, to count and then to pair them, and only
    counts and pairs are shuffled.
    """
    shared = written(listed.groupBy("bucket").applyInArrow(_shared, _BUCKET), "shared")
    # in whole numbers, as in shared_least
    first = lambda n: n - F.ceil(n * per_cent / 100) + 1
    listed_of = lambda n: F.least(n, F.greatest(F.lit(LEAST_LISTED), first(n) + F.floor(first(n) / 2)))
    least = lambda n: listed_of(n) - first(n) + 1
    sizes = named.where(F.col("name").isNotNull()).groupBy("name").agg(F.max("n").alias("n"))
    counts = shared.mapInArrow(segments.thrifty(_met(buckets)), _COUNTS)
    met = counts.groupBy("part").applyInArrow(_met_sums, "name long, met long, common long")
    fewest = shared_fewest(F.col("n"), per_cent)  # with any set that is close enough
    enough = met.join(sizes, "name").where(F.col("met") >= fewest)
    share = F.col("met") / listed_of(F.col("n"))
    enough = written(enough.select("name", least(F.col("n")).alias("least"), fewest.alias("fewest"), "common", share.alias("share")), "enough")
    able = filter_of(enough.select("name"), "name")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, name, many in _buckets(batches):
            some = able.value.holds(name.view(np.uint64))
            yield _pairs(token[some], name[some], many[some])

    pairs = shared.select("tokens", "names", "many").mapInArrow(segments.thrifty(pair), "a long, b long, star long, times long")
    uncommon = F.sum(F.when(F.col("star") == 0, F.col("times")).otherwise(0))
    met_in = pairs.groupBy("a", "b").agg(uncommon.alias("times"), F.max("star").alias("star"))
    one = enough.select(F.col("name").alias("a"), F.col("least").alias("least_a"), F.col("common").alias("common_a"))
    other = enough.select(F.col("name").alias("b"), F.col("least").alias("least_b"), F.col("common").alias("common_b"), "fewest")
    both = met_in.join(other, "b").join(one, "a", "left")
    needed = F.least("least_a", "least_b") - F.least("common_a", "common_b")
    met_often = F.col("least_a").isNotNull() & (F.col("times") > 0) & (F.col("times") >= needed)
    # a set whose common shingles are enough for a link is of the family of their smallest set, whichever that is
    by_star = (F.col("star") == 1) & (F.col("common_b") >= F.col("fewest"))
    return both.where(met_often | by_star).select("a", "b"), enough.select("name", "share")


def components(links: DataFrame) -> DataFrame:
    """node, root for all nodes of links (a, b): the connected components, named by their smallest node.

    Every round points each node to its smallest neighbour, follows the pointers once more and contracts
    the links, until none is left between different nodes.
    """
    both = lambda df: df.union(df.select("b", "a")).distinct()
    edges = written(both(links.select("a", "b").where(F.col("a") != F.col("b"))), "edges")
    roots = None
    while roots is None or not edges.isEmpty():
        up = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("up"))
        further = up.select(F.col("node").alias("up"), F.col("up").alias("further"))
        up = written(up.join(further, "up").select("node", F.col("further").alias("up")), "up")
        moved = edges.join(up.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
        moved = moved.join(up.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
        edges = written(moved.where(F.col("x") != F.col("y")).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        if roots is None:
            roots = up.select("node", F.col("up").alias("root"))
        else:
            new = up.select(F.col("node").alias("root"), "up")
            roots = written(roots.join(new, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
    return roots


def _unpacked(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the rows with different nodes (rows of documents may repeat) and all rows' shingles."""
    data = [unpacked_shingles(x) for x in table.column("shingles").to_pylist()]
    _, first = np.unique(table.column("node").to_numpy(), return_index=True)
    return first, data


def _closeness(pivots: list[np.ndarray], members: list[np.ndarray], per_cent: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each member is within the radius of each of up to 64 pivots, and the distances."""
    held = np.concatenate(pivots)
    bit = np.repeat(np.uint64(1) << np.arange(len(pivots), dtype=np.uint64), [len(x) for x in pivots])
    order = np.argsort(held, kind="stable")
    distinct, first = np.unique(held[order], return_index=True)
    masks = np.bitwise_or.reduceat(bit[order], first)
    sizes = np.array([len(x) for x in members])
    shared = np.zeros((len(members), len(pivots)), np.int64)
    low = 0
    while low < len(members):  # a part of the members at a time, so that arrays stay short
        high = max(low + 1, int(np.searchsorted(np.cumsum(sizes[low:]), LOOKED_UP, side="right")) + low)
        values = np.concatenate(members[low:high])
        at = np.minimum(np.searchsorted(distinct, values), len(distinct) - 1)
        mask = np.where(distinct[at] == values, masks[at], np.uint64(0))
        starts = np.cumsum(sizes[low:high]) - sizes[low:high]
        for r in range(len(pivots)):
            shared[low:high, r] = np.add.reduceat((mask >> np.uint64(r) & np.uint64(1)).astype(np.int32), starts)
        low = high
    union = sizes[:, None] + np.array([len(x) for x in pivots])[None, :] - shared
    return 100 * shared >= per_cent * union, 1 - shared / union


def _connected(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest of n places that links (a, b) connect each place with."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _links(names: np.ndarray, members: list[np.ndarray], asked: np.ndarray, others: np.ndarray, per_cent: int) -> pa.Table:
    """Links (a, b) that connect what all links between ``asked`` and ``others``, places of members, connect."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low in range(0, len(asked) if len(others) else 0, 64):
        part = asked[low : low + 64]
        other, pivot = np.nonzero(_closeness([members[i] for i in part], [members[i] for i in others], per_cent)[0])
        left.append(others[other])
        right.append(part[pivot])
    label = _connected(np.concatenate(left), np.concatenate(right), len(names))
    moved = np.flatnonzero(label != np.arange(len(names)))
    return pa.table([pa.array(names[moved]), pa.array(names[label[moved]])], names=["a", "b"])


def _join_whole(table: pa.Table, per_cent: int) -> pa.Table:
    """Links (a, b) that connect what all links of a region connect."""
    some, data = _unpacked(table)
    every = np.arange(len(some))
    return _links(table.column("node").to_numpy()[some], [data[i] for i in some], every, every, per_cent)


def _join_sides(table: pa.Table, per_cent: int) -> pa.Table:
    """Links (a, b) that connect what all links between a cell's members and its visitors connect."""
    data = [unpacked_shingles(x) for x in table.column("shingles").to_pylist()]
    visiting = table.column("visiting").to_numpy(zero_copy_only=False).astype(bool)
    names, back = np.unique(table.column("node").to_numpy(), return_inverse=True)
    members = [np.zeros(0, np.uint64)] * len(names)
    for i, place in enumerate(back.tolist()):
        members[place] = data[i]
    asked, others = np.unique(back[visiting]), np.unique(back[~visiting])
    if len(others) < len(asked):
        asked, others = others, asked
    return _links(names, members, asked, others, per_cent)


_COMPARED = (
    "region long, node long, links array<long>, cell int, distances array<float>,"
    " met array<struct<pivot:long,times:long,least:long>>"
)


def _compare(table: pa.Table, per_cent: int) -> pa.Table:
    """Distances of a block's members, without pivots, to their region's pivots.  The first row also has, for
    each pivot, its number of links here and the smallest pivot it is connected with by links of this block."""
    rank = table.column("rank").to_numpy()
    some, data = _unpacked(table)
    names = table.column("node").to_numpy()
    pivots = sorted((i for i in some.tolist() if rank[i] > 0), key=lambda i: rank[i])
    members = [i for i in some.tolist() if rank[i] == 0]
    region = table.column("region")[0].as_py()
    pivot_names = names[pivots]
    # pivots are compared with each other in every block, so that none of their links is missed
    close, distance = _closeness([data[i] for i in pivots], [data[i] for i in members + pivots], per_cent)
    among = close.astype(np.int64).T @ close.astype(np.int64) > 0  # pivots that a row is close to both of
    for _ in range(len(pivots).bit_length()):
        among = among.astype(np.int64) @ among.astype(np.int64) > 0
    close, distance = close[: len(members)], distance[: len(members)]
    times = close.sum(axis=0)
    met = [
        {"pivot": int(pivot_names[p]), "times": int(times[p]), "least": int(pivot_names[among[p]].min())}
        for p in range(len(pivots))
    ]
    n = len(members)
    columns = (
        [region] * max(n, 1),
        names[members].tolist() or [None],
        [pivot_names[row].tolist() for row in close] or [[]],
        np.argmin(distance, axis=1).tolist() or [0],
        list(distance.astype(np.float32)) or [[]],
        [met] + [None] * max(n - 1, 0),
    )
    kinds = (
        pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.float32()),
        pa.list_(pa.struct([("pivot", pa.int64()), ("times", pa.int64()), ("least", pa.int64())])),
    )
    return pa.table(
        [pa.array(v, t) for v, t in zip(columns, kinds, strict=True)],
        names=["region", "node", "links", "cell", "distances", "met"],
    )


_SIDES = "region long, cell int, low array<float>, high array<float>"


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least ``low`` and the greatest ``high`` for each pivot, of each cell's rows in a batch.  Rows of a
    region have as many of them as it has pivots."""
    for batch in batches:
        regions = batch.column("region").to_numpy()
        for region in np.unique(regions).tolist():
            some = batch.filter(pa.array(regions == region))
            cells, back = np.unique(some.column("cell").to_numpy(), return_inverse=True)
            order = np.argsort(back, kind="stable")
            starts = np.searchsorted(back[order], np.arange(len(cells)))
            sides = []
            for name, least in (("low", np.minimum), ("high", np.maximum)):
                values = some.column(name).flatten().to_numpy().reshape(len(order), -1)
                sides.append(pa.array(list(least.reduceat(values[order], starts)), pa.list_(pa.float32())))
            columns = [pa.array([region] * len(cells), pa.int64()), pa.array(cells, pa.int32()), *sides]
            yield pa.RecordBatch.from_arrays(columns, names=["region", "cell", "low", "high"])


def _sides_of_cell(table: pa.Table) -> pa.Table:
    """:func:`_sides` of all rows of a cell."""
    return pa.Table.from_batches(_sides(iter(table.combine_chunks().to_batches())))


def _large(regions: DataFrame) -> DataFrame:
    """Regions that one task does not join whole, with their number of members."""
    sizes = regions.groupBy("region").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    work = F.col("members") * F.col("shingles") / 64
    bounded = (F.col("members") <= WHOLE) & (F.col("shingles") <= WHOLE_SHINGLES) & (work <= WHOLE_WORK)
    return sizes.where(~bounded).select("region", "members")


def _meet(members: DataFrame, visits: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Links between the members of cells (region, cell, node) and their visitors (region, cell, node).

    Both sides are cut into parts, and a task compares one part of each; the members of a cell in their own
    parts meet each other there when they visit it.
    """
    cell = ["region", "cell"]
    sizes = members.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    numbers = visits.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / VISITORS).cast("int").alias("rounds"))
    cells = sizes.join(numbers, cell)
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    turn = F.pmod(F.xxhash64("node"), F.col("rounds")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    here = members.join(cells, cell).select(*cell, part.alias("part"), every("rounds").alias("turn"), "node", F.lit(False).alias("visiting"))
    there = visits.join(cells, cell).select(*cell, every("parts").alias("part"), turn.alias("turn"), "node", F.lit(True).alias("visiting"))
    both = here.union(there).join(sets, "node")
    return both.groupBy(*cell, "part", "turn").applyInArrow(lambda table: _join_sides(table, per_cent), "a long, b long")


def _round(regions: DataFrame, large: DataFrame, sets: DataFrame, per_cent: int) -> tuple[list[DataFrame], DataFrame]:
    """One round over the large regions: the links it finds, and the regions that are left to join."""
    radius = 1 - per_cent / 100 + 1e-6
    held = regions.join(large, "region")
    by_hash = Window.partitionBy("region").orderBy(F.desc("share"), F.xxhash64("node"), "node")
    pivots = held.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= PIVOTS)
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block")
    rest = held.join(pivots.select("region", "node"), ["region", "node"], "left_anti")
    members = rest.select("region", own, "node", F.lit(0).alias("rank"))
    spread = pivots.select("region", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "node", "rank")
    compared = written(
        members.union(spread)
        .join(sets, "node")
        .groupBy("region", "block")
        .applyInArrow(lambda table: _compare(table, per_cent), _COMPARED),
        "compared",
    )
    # one link of each member, and those among pivots that the others stand for
    met = compared.select("region", F.explode("met").alias("m")).select("region", "m.*")
    links = [
        compared.where(F.size("links") > 0).select(F.col("node").alias("a"), F.col("links")[0].alias("b")),
        met.select(F.col("pivot").alias("a"), F.col("least").alias("b")),
    ]
    # the pivot with most links, and pivots that a block's links connect with it; they and theirs are one component
    totals = met.groupBy("region", "pivot").agg(F.sum("times").alias("times"))
    main = totals.groupBy("region").agg(F.max_by("pivot", F.struct("times", "pivot")).alias("main"))
    first = met.join(main, "region").where(F.col("pivot") == F.col("main")).select("region", "least").distinct()
    hub = met.join(first, ["region", "least"]).groupBy("region").agg(F.collect_set("pivot").alias("hub"))
    marked = compared.where(F.col("node").isNotNull()).join(hub, "region", "left")
    settled = F.coalesce(F.arrays_overlap("links", "hub"), F.lit(False)).alias("settled")
    marked = written(marked.select("region", "node", settled, "cell", "distances"), "marked")
    # a row for each region, which five steps read
    counted = written(marked.groupBy("region").agg((F.avg(F.col("settled").cast("int")) >= SETTLES).alias("again")), "counted")
    opened = marked.where("NOT settled").join(counted, "region").withColumnRenamed("cell", "home")

    near = F.forall(
        F.arrays_zip("distances", "low", "high"),
        lambda x: (x["distances"] >= x["low"] - radius) & (x["distances"] <= x["high"] + radius),
    )

    def visited(rows: DataFrame, cells_of: DataFrame, which: Column) -> DataFrame:
        distance = F.col("distances")
        parts = cells_of.select("region", "cell", distance.alias("low"), distance.alias("high")).mapInArrow(_sides, _SIDES)
        boxes = parts.groupBy("region", "cell").applyInArrow(_sides_of_cell, _SIDES)
        # written, as the meeting reads them twice
        return written(rows.join(boxes, "region").where(near & which).select("region", "cell", "node"), "visits")

    # open sets with settled ones
    settled_ones = marked.where("settled")
    meetings = [(settled_ones, visited(opened, settled_ones, F.lit(True)))]
    # open sets with each other, where little was settled: each goes to its own cell and to those before it
    if not counted.where("NOT again").isEmpty():
        last = opened.where("NOT again")
        homes = last.withColumnRenamed("home", "cell")
        meetings.append((homes, visited(last, homes, F.col("cell") <= F.col("home"))))
    for members, visits in meetings:
        if not visits.isEmpty():
            links.append(_meet(members.select("region", "cell", "node"), visits, sets, per_cent))
    left = opened.where("again").select(F.xxhash64("region", F.lit("open")).alias("region"), "node")
    return links, left.withColumn("share", F.lit(0.0))


def region_links(regions: DataFrame, sets: DataFrame, per_cent: int) -> list[DataFrame]:
    """Links (a, b) that connect what all links connect, from ``regions`` (region, node, n, share), in which share is
    the part of a set's listed shingles that others list too, and ``sets`` (region, node, shingles).

    The first pivots are those with the largest share, as they lie in the middle of their family; later
    ones are taken by a hash.
    """
    found, first, held = [], True, None
    sizes = regions.select("node", "n")
    while True:
        large = written(_large(regions), "large")
        # the sets of the first regions know their region, so that they are sent to it and nowhere else before
        whole = sets if first else regions.select("region", "node").join(held, "node")
        small = whole.select("region", "node", "shingles").join(large.select("region"), "region", "left_anti")
        direct = small.groupBy("region").applyInArrow(lambda table: _join_whole(table, per_cent), "a long, b long")
        found.append(written(direct, "links"))
        if large.isEmpty():
            return found
        if first:  # rounds move the sets of large regions only
            held = written(sets.join(large.select("region"), "region", "left_semi").select("node", "shingles"), "held")
        some, left = _round(regions, large, held, per_cent)
        found += [written(links, "links") for links in some]
        regions, first = written(left.join(sizes, "node"), "regions"), False


def classes(docs: DataFrame, words: int = 5, per_cent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest id that links of at least ``per_cent`` reach."""
    spark = docs.sparkSession
    buckets = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = written(_listed(docs, words, per_cent, buckets), "shingles")
    named = rows.where(F.col("bucket").isNull()).select("doc_id", "n", "name")
    listed = rows.where(F.col("bucket").isNotNull()).select("bucket", "tokens", "names")
    links, shares = family_links(listed, named, per_cent, buckets)
    families = components(links)

    smallest = named.where(F.col("name").isNotNull()).groupBy(F.col("name").alias("node")).agg(
        F.min("doc_id").alias("doc_id"), F.max("n").alias("n")
    )
    known = smallest.join(families, "node").join(shares.withColumnRenamed("name", "node"), "node")
    firsts = written(known.select("node", "doc_id", "n", F.col("root").alias("region"), "share"), "firsts")
    wanted = filter_of(firsts.select(F.xxhash64("doc_id").alias("key")), "key")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            keep = wanted.value.holds(keys)
            some = batch.filter(pa.array(keep))
            for low, high, shingles, places in sets_of(some, words):
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id").slice(low, high - low),
                        pa.array(names_of(shingles, places).view(np.int64)),
                        pa.array([packed_shingles(shingles[a:b]) for a, b in zip(places[:-1], places[1:], strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "node", "shingles"],
                )

    id_column = F.col("doc_id").cast("long")
    texts = docs.where(F.col("doc_id").isNotNull()).select(id_column.alias("doc_id"), F.xxhash64(id_column).alias("key"), "text")
    picked = texts.mapInArrow(segments.thrifty(pick), "doc_id long, node long, shingles binary")
    # the side without shingles grows with the corpus too and is not broadcast
    regions_of = firsts.select("doc_id", "node", "region").hint("merge")
    sets = written(picked.join(regions_of, ["doc_id", "node"]).drop("doc_id"), "sets")

    links = None
    for some in region_links(firsts.select("region", "node", "n", "share"), sets, per_cent):
        links = some if links is None else links.union(some)
    groups = components(links)
    by_node = smallest.drop("n").join(groups, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    by_node = written(by_node, "nodes")
    least = by_node.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    to_group = by_node.join(least, "root").select("node", "component_id")
    of_set: Column = F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return named.join(to_group, named["name"] == to_group["node"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), of_set.alias("component_id")
    )


def one_of_each(docs: DataFrame, words: int = 5, per_cent: int = 80) -> DataFrame:
    """``docs``, all columns as they are, with one document of each class: the one with the smallest id.

    Rows without an id stay.  Of rows that share id and text one stays; rows that share an id and differ in
    text are one document here and stay or go together.
    """
    found = classes(docs, words, per_cent)
    gone = written(found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct(), "gone")
    same = F.xxhash64("text")
    again = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id", same.alias("same")).agg(F.count(F.lit(1)).alias("rows"))
    again = written(again.where(F.col("rows") > 1).select("doc_id").distinct(), "again")
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    number = next(name for name in (f"row_{n}" for n in range(len(docs.columns) + 1)) if name not in docs.columns)
    once = Window.partitionBy("doc_id", same).orderBy(same)
    repeated = left.join(again, "doc_id", "left_semi").withColumn(number, F.row_number().over(once)).where(F.col(number) == 1)
    return left.join(again, "doc_id", "left_anti").select(docs.columns).union(repeated.select(docs.columns))
