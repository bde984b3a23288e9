"""Exact k-means rounds over vectors filed in blocks along a Hilbert curve.

Vectors with exactly `DIMS` components, none null, NaN or infinite, are kept, and
each component x becomes the integer floor(64 x). A Hilbert curve through the
cells of all components (two bits each, cut at the mean and two thirds of a
deviation to either side) orders the vectors; runs of `BLOCK` of them are a
block, stored with the least and the greatest value of every component: its box.

To assign a block, the least and the greatest possible distance from its box to
each centroid are computed. A centroid whose least distance exceeds the smallest
greatest distance is nearest to no vector of the block; nor is one that is
farther than the centroid nearest to the middle of the box at every corner,
which the greatest difference of the two distances over the box tells. The others
are its candidates and are compared exactly with all its vectors in one matrix
product.
Products are taken in doubles as long as every sum is below 2^53, else in longs,
so that distances are exact integers; ties go to the smaller number.

Centroids are the kept vectors with the smallest hashes of their ids. A round
sends per task one row of sums a centroid, and the new centroids are the exact
floors of the means; the driver holds k times `DIMS` numbers and nothing else.
Where blocks are cut decides how many comparisons are made and never a result.

Components beyond 2^27 in size count as 2^27 there, since distances of larger
ones are no longs. A sum of distances beyond the longs is null. Rows with equal
ids are vectors of their own; a null id comes last among the first centroids.
With fewer kept vectors than centroids every vector is one. A table without a
kept vector gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.tables import stored

DIMS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
BITS = 2
BLOCK = 256
LIMIT = 1 << 27
# Rows that one task files into blocks.
ROWS_PER_TASK = 1 << 18

RESULT = "key bigint, cluster int, distance bigint, block_rows int, compared int"
BLOCKS = "keys array<bigint>, vectors binary, low binary, high binary"


def quantised(part: pa.RecordBatch, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the kept vectors, and their components as integers."""
    column = part.column("vector").cast(pa.large_list(pa.float64()))
    sizes = np.diff(column.offsets.to_numpy())
    values = column.values.slice(column.offsets[0].as_py(), int(sizes.sum()))
    flat = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    first = np.cumsum(sizes) - sizes
    whole = np.flatnonzero((sizes == dims) & column.is_valid().to_numpy(zero_copy_only=False))
    matrix = flat[first[whole, None] + np.arange(dims)] if len(whole) else np.zeros((0, dims))
    good = np.isfinite(matrix).all(axis=1)
    scaled = np.clip(np.floor(matrix[good] * SCALE), -LIMIT, LIMIT)
    return whole[good], scaled.astype(np.int32)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with `bits` bits a component, as rows of bytes."""
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    # From coordinates to the transposed index: undo the reflections and rotations, bit by bit.
    bit = np.uint32(1 << (bits - 1))
    while bit > 1:
        below = bit - np.uint32(1)
        for i in range(n):
            turned = (x[i] & bit) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & below).astype(np.uint32)
            x[0] ^= np.where(turned, below, swap).astype(np.uint32)
            x[i] ^= swap
        bit >>= np.uint32(1)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    parity = np.zeros_like(x[0])
    bit = np.uint32(1 << (bits - 1))
    while bit > 1:
        parity ^= np.where((x[n - 1] & bit) > 0, bit - np.uint32(1), 0).astype(np.uint32)
        bit >>= np.uint32(1)
    x ^= parity
    planes = np.concatenate([(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)])
    return np.packbits(planes.T.astype(np.uint8), axis=1)


def bounds(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of any point of the box to each centroid."""
    below, above = low.astype(np.int64) - centroids, centroids - high.astype(np.int64)
    near = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(below), np.abs(above))
    return (near * near).sum(axis=1), (far * far).sum(axis=1)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some point of the box."""
    near, far = bounds(low, high, centroids)
    middle = (low.astype(np.int64) + high) // 2
    best = int(((centroids - middle) ** 2).sum(axis=1).argmin())
    # d(x, best) - d(x, c) is linear in x, so that its greatest value is at a corner.
    slope = 2 * (centroids - centroids[best])
    squares = (centroids * centroids).sum(axis=1)
    worst = np.maximum(slope * low, slope * high).sum(axis=1) + squares[best] - squares
    return np.flatnonzero((near <= far.min()) & (worst >= 0))


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest centroid of each vector and the exact squared distance."""
    top = max(int(np.abs(vectors).max()), int(np.abs(centroids).max()), 1)
    kind = np.float64 if top * top * vectors.shape[1] * 4 < 1 << 53 else np.int64
    v, c = vectors.astype(kind), centroids.astype(kind)
    apart = (v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)
    place = apart.argmin(axis=1)
    return place, apart[np.arange(len(v)), place].astype(np.int64)


def assigned(blocks: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, int]]:
    """For each block: keys, vectors, cluster and distance of each vector, number of candidates."""
    dims = centroids.shape[1]
    keys = blocks.column("keys")
    for i in range(blocks.num_rows):
        vectors, low, high = (
            np.frombuffer(blocks.column(c)[i].as_buffer(), np.int32) for c in ("vectors", "low", "high"))
        vectors = vectors.reshape(-1, dims)
        some = candidates(low, high, centroids)
        place, distance = nearest(vectors, centroids[some])
        yield keys[i].values, vectors, some[place], distance, len(some)


def _vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    return table.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"))


def first_centroids(rows: DataFrame, k: int, dims: int) -> np.ndarray:
    """The kept vectors with the `k` smallest hashes of "1:" and the id, in that order; equal ids by their vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, x = quantised(batch, dims)
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key").take(pa.array(kept)),
                "x": pa.array(list(x), pa.list_(pa.int32())),
            })

    hashed = F.sha2(F.concat(F.lit("1:"), F.col("key").cast("string")), 256)
    found = rows.mapInArrow(run, "key bigint, x array<int>").withColumn("hash", hashed)
    least = found.orderBy(F.col("hash").asc_nulls_last(), "x").limit(k).collect()  # k rows
    return np.array([r.x for r in least], np.int64).reshape(-1, dims)


def moments(rows: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of kept vectors, and mean and deviation of every component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(dims), np.zeros(dims)
        for batch in batches:
            x = quantised(batch, dims)[1].astype(np.float64)
            n, sums, squares = n + len(x), sums + x.sum(axis=0), squares + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_pydict({
            "dim": pa.array(np.arange(dims, dtype=np.int32)), "n": pa.array(np.full(dims, n)),
            "sums": pa.array(sums), "squares": pa.array(squares)})

    parts = rows.mapInArrow(run, "dim int, n bigint, sums double, squares double")
    totals = parts.groupBy("dim").agg(F.sum("n"), F.sum("sums"), F.sum("squares")).orderBy("dim").collect()  # `dims` rows
    n = totals[0][1] if totals else 0
    if not n:
        return 0, np.zeros(dims), np.ones(dims)
    mean = np.array([r[2] for r in totals]) / n
    spread = np.sqrt(np.maximum(np.array([r[3] for r in totals]) / n - mean * mean, 0.0))
    return n, mean, spread


def filed(rows: DataFrame, n: int, mean: np.ndarray, spread: np.ndarray, block: int, dims: int) -> DataFrame:
    """The kept vectors in blocks along the curve, with their boxes."""
    steps = np.linspace(-1, 1, (1 << BITS) - 1) * 0.67
    cuts = mean[:, None] + spread[:, None] * steps

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, x = quantised(batch, dims)
            cells = (x[:, :, None] >= cuts).sum(axis=2)
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key").take(pa.array(kept)),
                "curve": pa.array([r.tobytes() for r in hilbert(cells, BITS)], pa.binary()),
                "x": pa.array([r.tobytes() for r in x], pa.binary()),
            })

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            whole = pa.Table.from_batches(held).combine_chunks()
            end = size if last else size - size % block
            out = {name: [] for name in ("keys", "vectors", "low", "high")}
            for low in range(0, end, block):
                part = whole.slice(low, min(block, end - low))
                x = np.frombuffer(b"".join(part.column("x").to_pylist()), np.int32).reshape(-1, dims)
                out["keys"].append(part.column("key").to_pylist())
                out["vectors"].append(x.tobytes())
                out["low"].append(x.min(axis=0).tobytes())
                out["high"].append(x.max(axis=0).tobytes())
            yield pa.RecordBatch.from_pydict({
                "keys": pa.array(out["keys"], pa.list_(pa.int64())),
                **{c: pa.array(out[c], pa.binary()) for c in ("vectors", "low", "high")}})
            held, size = whole.slice(end).to_batches(), size - end

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= block * 32:
                yield from cut(False)
        if size:
            yield from cut(True)

    parts = max(1, -(-n // ROWS_PER_TASK))
    ordered = (
        rows.mapInArrow(placed, "key bigint, curve binary, x binary")
        .repartitionByRange(parts, "curve", "key").sortWithinPartitions("curve", "key")
    )
    return ordered.select("key", "x").mapInArrow(blocks, BLOCKS)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round over all blocks."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, vectors, cluster, _, _ in assigned(batch, centroids):
                count += np.bincount(cluster, minlength=k)
                for c in np.unique(cluster):
                    sums[c] += vectors[cluster == c].sum(axis=0, dtype=np.int64)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({
            "cell": pa.array(np.repeat(some, dims) * dims + np.tile(np.arange(dims), len(some))),
            "n": pa.array(np.repeat(count[some], dims)), "total": pa.array(sums[some].ravel())})

    cells = blocks.mapInArrow(run, "cell bigint, n bigint, total bigint").groupBy("cell").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = centroids.copy()
    for cell, n, total in cells.collect():  # k * dims rows at most
        out[cell // dims, cell % dims] = int(total) // n
    return out


def clustered(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS,
    rounds: int = ROUNDS, block: int = BLOCK, dims: int = DIMS,
) -> DataFrame:
    """Per kept vector `key`, `cluster`, `distance`, `cluster_inertia`, `inertia`, `centroid_sha256`.

    `block_rows` and `compared` say how large its block is and with how many
    centroids it was compared in the last assignment.
    """
    rows = _vectors(table, key, vector)
    spark = table.sparkSession
    n, mean, spread = moments(rows, dims)
    blocks = stored(filed(rows, n, mean, spread, block, dims), "curve-blocks")
    centroids = first_centroids(rows, k, dims)
    for _ in range(rounds if n else 0):
        centroids = moved(blocks, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, _, cluster, distance, compared in assigned(batch, centroids):
                yield pa.RecordBatch.from_pydict({
                    "key": keys, "cluster": pa.array(cluster.astype(np.int32)), "distance": pa.array(distance),
                    "block_rows": pa.array(np.full(len(cluster), len(cluster), np.int32)),
                    "compared": pa.array(np.full(len(cluster), compared, np.int32))})

    last = stored(blocks.mapInArrow(run, RESULT), "curve-assigned")
    sums = last.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    names = [
        (c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    named = spark.createDataFrame(names, "cluster int, centroid_sha256 string")
    whole = sums.agg(F.try_sum("cluster_inertia").alias("inertia"))
    info = sums.join(named, "cluster").withColumn("inertia", whole.scalar())
    # One row per centroid.
    return last.join(F.broadcast(info), "cluster").select(
        "key", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "block_rows", "compared")
