"""Approximate nearest neighbours by randomly rotated one-bit codes.

Vectors are brought to unit length, so the largest cosine is the largest inner product.  Coarse centroids
are fitted on a bounded sample; every vector belongs to the list of its nearest centroid.  A vector's code
is the sign of each component of its residual from the centroid after a random rotation, packed into bits,
with two scalars: the residual's length and the inner product of the code with the residual it stands for.
A query is rotated once.  Its inner product with a vector is estimated from the packed bits and the scalars,
with an error bound that holds with high probability; vectors whose upper bound does not reach the
k-th best lower bound of the block are left out, and the rest is compared exactly, in double precision, on
the original vectors.  A query looks into so many of its nearest lists that, within the sample, they hold
the share ``COVER`` of its queries' true neighbours: few lists where vectors cluster, most where they hardly
do.  Neighbours among all vectors are closer than those within a sample, so the share is a careful one.

Where those lists hold fewer than k other vectors, the query looks into more until they do.

Lists are cut into blocks of about ``BLOCK`` vectors by a hash of the id, so a list that holds a third of
all vectors, or very many equal ones, is spread over tasks; a query is sent to all blocks of its lists, of
which each task compares ``ASKING`` queries, and its best of each block meet in a grouped top-k.

Defined results: vectors that are null, empty, zero, of another length than most, or hold a null or
non-finite component take no part; queries without an id neither; rows that repeat an id are all
candidates, and a query row finds all but those with its own id; queries that repeat an id are one; ties
go to the smaller id; with fewer than k candidates all that are found are returned; an empty table gives no
rows.  Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordermill.llm.tables import written

#: Vectors that centroids are fitted on, vectors for each list, and lists at most.
SAMPLE, PER_LIST, MOST_LISTS = 20_000, 1000, 4096
#: Share of true neighbours that the lists a query looks into shall hold, sample vectors that are asked for
#: it, and vectors of a block.
COVER, ASKED, BLOCK = 0.97, 500, 4096
#: Queries that one task compares with a block.
ASKING = 2048
#: Width of the error bound in its standard deviations.
BOUND = 3.0


class Codes:
    """Centroids and rotation, fitted on a sample."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 4):
        rng = np.random.default_rng(seed)
        size = sample.shape[1]
        self.rotation = np.linalg.qr(rng.standard_normal((size, size)))[0]
        lists = max(1, min(lists, len(sample)))
        centroids = sample[rng.choice(len(sample), lists, replace=False)]
        for _ in range(8):
            own = np.argmax(sample @ centroids.T, axis=1)
            sums = np.zeros_like(centroids)
            np.add.at(sums, own, sample)
            length = np.linalg.norm(sums, axis=1, keepdims=True)
            centroids = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centroids)
        self.centroids = centroids
        self.probes = self._probes(sample)

    def _probes(self, sample: np.ndarray, k: int = 5) -> int:
        asked = np.arange(min(ASKED, len(sample)))
        close = sample[asked] @ sample.T
        close[asked, asked] = -np.inf
        k = min(k, len(sample) - 1)
        if k < 1:
            return len(self.centroids)
        best = np.argpartition(-close, k - 1, axis=1)[:, :k]
        lists = self.nearest(sample, 1)[:, 0]
        place = np.argsort(self.nearest(sample[asked], len(self.centroids)), axis=1)
        needed = np.sort(np.take_along_axis(place, lists[best], axis=1).ravel())
        return int(needed[min(len(needed) - 1, int(np.ceil(COVER * len(needed))))]) + 1

    def nearest(self, vectors: np.ndarray, count: int) -> np.ndarray:
        close = vectors @ self.centroids.T
        count = min(count, close.shape[1])
        return np.argsort(-close, axis=1, kind="stable")[:, :count]

    def encode(self, vectors: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed bits, residual lengths, and inner products of code and unit residual."""
        residual = (vectors - self.centroids[own]) @ self.rotation
        length = np.linalg.norm(residual, axis=1)
        bits = residual > 0
        size = residual.shape[1]
        agree = np.abs(residual).sum(axis=1) / (np.maximum(length, 1e-12) * np.sqrt(size))
        return np.packbits(bits, axis=1), length, np.maximum(agree, 1e-6)

    def bounds(self, query: np.ndarray, own: int, code: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products with the coded vectors, and how far off they may be."""
        bits, length, agree = code
        size = len(query)
        rotated = query @ self.rotation
        signs = np.unpackbits(bits, axis=1, count=size).astype(np.float32) * 2 - 1
        estimate = (signs @ rotated.astype(np.float32)) / np.sqrt(size) / agree
        off = BOUND * np.sqrt(np.maximum(1 - agree**2, 0)) / agree * np.linalg.norm(query) / np.sqrt(max(size - 1, 1))
        return query @ self.centroids[own] + length * estimate, length * off + 1e-5


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array of double) of the vectors that take part."""
    as_doubles = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), as_doubles.alias("embedding"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    sound = F.col("embedding").isNotNull() & ~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0)
    rows = rows.where(sound)
    lengths = rows.groupBy(F.size("embedding").alias("size")).count()
    usual = lengths.orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("embedding") == (usual["size"] if usual else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.maximum(np.abs(matrix).max(axis=1, keepdims=True, initial=0), 1e-300)
    return scaled / np.maximum(np.linalg.norm(scaled, axis=1, keepdims=True), 1e-300)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with ``b``, in double precision.  Where squares would leave the range of
    doubles, both are first divided by their largest component, which does not change the cosine."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        rows, one = (a * a).sum(axis=1), (b * b).sum()
        out = (a @ b) / (np.sqrt(rows) * np.sqrt(one))
        sound = (rows > 1e-280) & (rows < 1e280) & (1e-280 < one < 1e280)
    if not sound.all():
        x, y = (v / np.abs(v).max(axis=-1, keepdims=True) for v in (a[~sound], b))
        out[~sound] = (x @ y) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum()))
    return out


def search_block(codes: Codes, own: int, ids: np.ndarray, vectors: np.ndarray, queries: list, k: int) -> list[tuple]:
    """The k best of a block for each (query id, vector): (query_id, vec_id, score)."""
    unit = _unit(vectors)
    code = codes.encode(unit, own)
    out = []
    for query_id, query in queries:
        middle, off = codes.bounds(_unit(query[None, :])[0], own, code)
        other = ids != query_id
        low = np.where(other, middle - off, -np.inf)
        least = np.partition(low, len(low) - k)[len(low) - k] if len(low) > k else -np.inf
        at = np.flatnonzero(other & (middle + off >= least))
        score = cosine(vectors[at], query)
        for i in np.lexsort((ids[at], -score))[:k].tolist():
            out.append((query_id, int(ids[at[i]]), float(score[i])))
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score for the rows that ``is_query`` picks."""
    spark = vectors.sparkSession
    rows = written(usable(vectors), "vectors")
    total = rows.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(1))).limit(SAMPLE).select("embedding").collect()
    fitted = _unit(np.array([r["embedding"] for r in sample]))
    codes = spark.sparkContext.broadcast(Codes(fitted, min(MOST_LISTS, max(1, total // PER_LIST))))

    def listed(df: DataFrame, sizes: np.ndarray | None = None) -> DataFrame:
        """Each vector's nearest list; with ``sizes``, of all lists, the lists that a query looks into: the
        usual number, and more until they hold k vectors besides its own rows."""

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                unit = _unit(_matrix(batch.column("embedding")))
                if sizes is None:
                    near = codes.value.nearest(unit, 1).tolist()
                else:
                    order = codes.value.nearest(unit, len(sizes))
                    copies = batch.column("copies").to_numpy()
                    enough = (np.cumsum(sizes[order], axis=1) < k + copies[:, None]).sum(axis=1) + 1
                    near = [row[: max(codes.value.probes, n)] for row, n in zip(order.tolist(), enough.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("embedding"), pa.array(near, pa.list_(pa.int32()))],
                    names=["vec_id", "embedding", "lists"],
                )

        return df.mapInArrow(assign, "vec_id long, embedding array<double>, lists array<int>")

    members = written(listed(rows).select("vec_id", "embedding", F.col("lists")[0].alias("list")), "lists")
    counted = members.groupBy("list").count().collect()  # one row for each list
    sizes = np.zeros(len(codes.value.centroids), np.int64)
    for number, count in counted:
        sizes[number] = count
    chosen = rows.where(is_query & F.col("vec_id").isNotNull()).groupBy("vec_id").agg(
        F.min("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies")
    )
    asking = written(listed(chosen, sizes).select("vec_id", "embedding", F.explode("lists").alias("list")), "asking")
    parts = lambda per: F.ceil(F.count(F.lit(1)) / per).cast("int")
    # one row for each list
    blocks = members.groupBy("list").agg(parts(BLOCK).alias("blocks")).join(
        asking.groupBy("list").agg(parts(ASKING).alias("rounds")), "list"
    )
    block = F.pmod(F.xxhash64("vec_id", "embedding"), F.col("blocks")).cast("int").alias("block")
    turn = F.pmod(F.xxhash64("vec_id"), F.col("rounds")).cast("int").alias("round")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = members.join(F.broadcast(blocks), "list").select(
        "list", block, every("rounds").alias("round"), "vec_id", "embedding", F.lit(False).alias("asks")
    )
    asking = asking.join(F.broadcast(blocks), "list").select(
        "list", every("blocks").alias("block"), turn, "vec_id", "embedding", F.lit(True).alias("asks")
    )

    def search(key: tuple, table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids = table.column("vec_id").combine_chunks()
        matrix = _matrix(table.column("embedding").combine_chunks())
        numbers = ids.fill_null(-(2**63)).to_numpy()
        queries = list(zip(numbers[asks].tolist(), matrix[asks], strict=True))
        found = []
        if queries and not asks.all():
            found = search_block(codes.value, key[0].as_py(), numbers[~asks], matrix[~asks], queries, k)
        columns = zip(*found, strict=True) if found else ([], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

    found = members.unionByName(asking).groupBy("list", "block", "round").applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.when(F.col("vec_id") != -(2**63), F.col("vec_id")).alias("vec_id"), "score")
