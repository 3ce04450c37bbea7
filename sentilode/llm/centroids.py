"""Centroid clustering over a VA-file: few-bit cells decide on a centroid, full vectors are fetched where they cannot."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sentilode.llm.common import slices
from sentilode.operators.scale import BROADCAST_BYTES, measured_bytes
from sentilode.session import materialize

DIMS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
# Bits of a cell. All cells of a dimension are equally wide but for the outer ones, which is what narrows the intervals most.
BITS = 6
# The equally wide cells lie between quantiles of about so many vectors; the outer ones reach to the least and largest values of all.
SAMPLE_VECTORS = 65_536
TAIL = 0.001
# A vector with a component this far from 0 after scaling has no squared distance that a long holds.
LARGEST = 1 << 27
BLOCK = 8_192
NO_MOVE = -1

Batches = Iterator[pa.RecordBatch]


def integers(column: pa.Array, dims: int = DIMS, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(which rows are kept, their components as floor(scale * x)); others have a wrong length, a null or no finite number."""
    right = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
    kept = right.to_numpy(zero_copy_only=False).copy()
    flat = pc.list_flatten(column.filter(right)).cast(pa.float64()).to_numpy(zero_copy_only=False)
    scaled = np.floor(scale * flat.reshape(-1, dims))
    with np.errstate(invalid="ignore"):
        usable = (np.abs(scaled) < LARGEST).all(axis=1)  # false for NaN
    kept[np.flatnonzero(kept)[~usable]] = False
    return kept, scaled[usable].astype(np.int64)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def encode(vectors: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """The approximation of each vector: the cell numbers of all dimensions, BITS each, packed into bytes."""
    cells = np.empty(vectors.shape, np.uint8)
    for d in range(vectors.shape[1]):
        cells[:, d] = np.searchsorted(inner[d], vectors[:, d], side="right")
    bits = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - BITS:]
    return np.packbits(bits.reshape(len(cells), -1), axis=1)


def decode(packed: np.ndarray, dims: int) -> np.ndarray:
    """The cell numbers of `encode`."""
    bits = np.unpackbits(packed, axis=1, count=dims * BITS).reshape(len(packed), dims, BITS)
    padded = np.concatenate([np.zeros((len(packed), dims, 8 - BITS), np.uint8), bits], axis=2)
    return np.packbits(padded, axis=2)[:, :, 0]


def lookup_tables(centroids: np.ndarray, inner: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Per dimension and cell the least and the largest squared distance to each centroid."""
    k, dims = centroids.shape
    bounds = np.zeros((dims, 1 << BITS, 2 * k), np.int64)
    for d in range(dims):
        least = np.concatenate([[low[d]], inner[d]])[:, None]
        most = np.concatenate([inner[d] - 1, [high[d]]])[:, None]
        c = centroids[:, d][None, :]
        inside = (least <= c) & (c <= most)
        ends = (least - c) ** 2, (most - c) ** 2
        bounds[d, :, :k] = np.where(inside, 0, np.minimum(*ends))
        bounds[d, :, k:] = np.maximum(*ends)
    return bounds


def candidates(packed: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Per row and centroid whether it can be the nearest: its interval begins no later than any other ends."""
    k = tables.shape[2] // 2
    out = np.empty((len(packed), k), bool)
    for at in range(0, len(packed), BLOCK):
        block = decode(packed[at:at + BLOCK], len(tables))
        interval = np.zeros((len(block), 2 * k), np.int64)
        for d, table in enumerate(tables):
            interval += table[block[:, d]]
        out[at:at + BLOCK] = interval[:, :k] <= interval[:, k:].min(axis=1)[:, None]
    return out


def nearest(vectors: np.ndarray, possible: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest possible centroid; the smaller number of equally near ones."""
    distance = np.full(possible.shape, np.iinfo(np.int64).max)
    for c in range(len(centroids)):
        rows = np.flatnonzero(possible[:, c])
        distance[rows, c] = ((vectors[rows] - centroids[c]) ** 2).sum(axis=1)
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(best)), best]


class Sums:
    """Components and numbers of vectors that have come to each centroid, less those that have left it."""

    def __init__(self, k: int, dims: int) -> None:
        self.total = np.zeros((k, dims + 1), np.int64)

    def move(self, vectors: np.ndarray, old: np.ndarray, new: np.ndarray) -> None:
        for c in range(len(self.total)):
            for which, sign in ((new == c, 1), (old == c, -1)):
                which = which & (old != new)
                self.total[c, :-1] += sign * vectors[which].sum(axis=0)
                self.total[c, -1] += sign * int(which.sum())

    def row(self, schema: pa.Schema) -> pa.RecordBatch:
        """The last row of a task: it has no place, and all sums."""
        values = {"sums": [self.total.ravel().tolist()]}
        return pa.RecordBatch.from_arrays(
            [pa.array(values.get(field.name, [None]), field.type) for field in schema], schema=schema
        )


STATE = "place bigint, cells binary, cluster int, sums array<bigint>"
_STATE = pa.schema(
    [("place", pa.int64()), ("cells", pa.binary()), ("cluster", pa.int32()), ("sums", pa.list_(pa.int64()))]
)
BOUNDED = "place bigint, cells binary, old int, cluster int, possible array<int>"


def _bytes(cells: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(c, np.uint8) for c in cells.to_pylist()])


def _state_rows(place: pa.Array, cells: pa.Array, cluster: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(place), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([place, cells.cast(pa.binary()), pa.array(cluster, pa.int32()), none], schema=_STATE)


class VaFile:
    """Bounds of the cells: what is needed to encode vectors and to measure cells against centroids."""

    def __init__(self, inner: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.inner, self.low, self.high = inner, low, high

    def tables(self, centroids: np.ndarray) -> np.ndarray:
        return lookup_tables(centroids, self.inner, self.low, self.high)


def _ranges(vector_col: str, dims: int, scale: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        low = high = None
        for batch in slices(batches):
            _, rows = integers(batch.column(vector_col), dims, scale)
            if len(rows):
                low = rows.min(axis=0) if low is None else np.minimum(low, rows.min(axis=0))
                high = rows.max(axis=0) if high is None else np.maximum(high, rows.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(low), pa.array(high)], ["dim", "low", "high"])

    return run


def _quantiles(vector_col: str, dims: int, scale: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        found = [integers(batch.column(vector_col), dims, scale)[1] for batch in batches]
        rows = np.concatenate(found) if found else np.zeros((0, dims), np.int64)
        if len(rows):
            low, high = np.quantile(rows, (TAIL, 1 - TAIL), axis=0)
            steps = np.arange((1 << BITS) - 1) / ((1 << BITS) - 2)
            inner = np.floor(low[:, None] + (high + 1 - low)[:, None] * steps[None]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(inner.tolist(), pa.list_(pa.int64()))], ["inner"])

    return run


def fit_cells(
    vectors: DataFrame, vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE, sample: int = SAMPLE_VECTORS
) -> VaFile | None:
    """The bounds of cells for all rows of `vectors`; None if no vector is kept.

    Outer bounds are exact, from one aggregate of a row per task and dimension. Inner ones only decide how many vectors
    are fetched, never the result: they are equal steps between two quantiles of about `sample` rows drawn by a hash of the row's place, in one task.
    """
    only = vectors.select(vector_col)
    found = only.mapInArrow(_ranges(vector_col, dims, scale), "dim int, low bigint, high bigint")
    outer = found.groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").toArrow()
    if outer.num_rows == 0:
        return None
    total = only.count()
    draw = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1_000_000))
    drawn = only.filter(draw < int(min(1.0, sample / max(total, 1)) * 1_000_000)) if total > sample else only
    row = drawn.repartition(1).mapInArrow(_quantiles(vector_col, dims, scale), "inner array<bigint>").collect()
    low, high = (outer.column(c).to_numpy() for c in ("low", "high"))
    # A drawn part without a kept vector leaves all of them in one cell.
    inner = np.array([r["inner"] for r in row], np.int64) if row else np.repeat(low[:, None], (1 << BITS) - 1, axis=1)
    return VaFile(inner, low, high)


def _build(va: VaFile, id_col: str, vector_col: str, dims: int, scale: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in slices(batches):
            kept, rows = integers(batch.column(vector_col), dims, scale)
            cells = encode(rows, va.inner)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * dims
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col).filter(pa.array(kept)),
                    pa.array([c.tobytes() for c in cells], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), pa.int32())),
                ],
                ["vec_id", "cells", "vector"],
            )

    return run


def _first_round(va: VaFile, centroids: np.ndarray) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        tables, sums = va.tables(centroids), Sums(*centroids.shape)
        for batch in slices(batches):
            if batch.num_rows:
                rows = matrix(batch.column("vector"), centroids.shape[1])
                cluster = decide(batch.column("cells"), rows, tables, centroids)
                sums.move(rows, np.full(len(rows), NO_MOVE), cluster)
                yield _state_rows(batch.column("place"), batch.column("cells"), cluster)
        yield sums.row(_STATE)

    return run


def decide(cells: pa.Array, rows: np.ndarray, tables: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row: by its cells alone where one interval is below all others, else by its vector."""
    possible = candidates(_bytes(cells), tables)
    cluster = possible.argmax(axis=1)
    open_rows = np.flatnonzero(possible.sum(axis=1) > 1)
    cluster[open_rows] = nearest(rows[open_rows], possible[open_rows], centroids)[0]
    return cluster


def _bound(va: VaFile, centroids: np.ndarray) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        tables = va.tables(centroids)
        for batch in slices(batches):
            if batch.num_rows == 0:
                continue
            possible = candidates(_bytes(batch.column("cells")), tables)
            one = possible.sum(axis=1) == 1
            cluster = pa.array(possible.argmax(axis=1), pa.int32(), mask=~one)
            several = [None if sole else np.flatnonzero(row).tolist() for sole, row in zip(one, possible)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("place"), batch.column("cells"), batch.column("cluster"), cluster,
                    pa.array(several, pa.list_(pa.int32())),
                ],
                ["place", "cells", "old", "cluster", "possible"],
            )

    return run


def _resolve(centroids: np.ndarray) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        k, dims = centroids.shape
        sums = Sums(k, dims)
        for batch in slices(batches):
            if batch.num_rows == 0:
                continue
            rows = matrix(batch.column("vector"), dims)
            cluster = pc.fill_null(batch.column("cluster"), NO_MOVE).to_numpy(zero_copy_only=False).astype(np.int64)
            possible = np.zeros((len(rows), k), bool)
            several = batch.column("possible")
            at = np.repeat(np.arange(len(rows)), pc.fill_null(pc.list_value_length(several), 0).to_numpy(zero_copy_only=False))
            possible[at, pc.list_flatten(several).to_numpy(zero_copy_only=False)] = True
            open_rows = np.flatnonzero(cluster == NO_MOVE)
            cluster[open_rows] = nearest(rows[open_rows], possible[open_rows], centroids)[0]
            sums.move(rows, batch.column("old").to_numpy(zero_copy_only=False).astype(np.int64), cluster)
            yield _state_rows(batch.column("place"), batch.column("cells"), cluster)
        yield sums.row(_STATE)

    return run


def _last(va: VaFile, centroids: np.ndarray) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        tables = va.tables(centroids)
        for batch in slices(batches):
            if batch.num_rows == 0:
                continue
            rows = matrix(batch.column("vector"), centroids.shape[1])
            cluster = decide(batch.column("cells"), rows, tables, centroids)
            distance = ((rows - centroids[cluster]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    return run


def added_up(states: DataFrame, k: int, dims: int) -> np.ndarray:
    """The sums of all tasks, exactly: k rows of dims components and a number of vectors."""
    parts = states.filter(F.col("sums").isNotNull()).select(F.posexplode("sums"))
    rows = parts.groupBy("pos").agg(F.sum(F.col("col").cast("decimal(20,0)")).alias("s")).collect()
    total = np.zeros(k * (dims + 1), object)
    for row in rows:
        total[row["pos"]] = int(row["s"])
    return total.reshape(k, dims + 1)


def fetch(wanted: DataFrame, vectors: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of `wanted` with their vectors: these are filtered in place while `wanted` is small, else both sides are shuffled."""
    small = measured_bytes(wanted) <= most_bytes
    return vectors.join(F.broadcast(wanted) if small else wanted, "place")


def next_round(
    state: DataFrame, vectors: DataFrame, va: VaFile, centroids: np.ndarray, most_bytes: int = BROADCAST_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(state after one more assignment, its rows that were fetched). Only cells are read of all vectors.

    A vector is fetched if several intervals overlap, or if it moves, since it then changes two sums.
    """
    rows = state.filter(F.col("place").isNotNull()).select("place", "cells", "cluster")
    bounded = materialize(rows.mapInArrow(_bound(va, centroids), BOUNDED), "clusters-bounded")
    quiet = F.col("cluster").isNotNull() & (F.col("cluster") == F.col("old"))
    wanted = bounded.filter(F.coalesce(~quiet, F.lit(True)))
    found = fetch(wanted, vectors.select("place", "vector"), most_bytes)
    resolved = materialize(found.mapInArrow(_resolve(centroids), STATE), "clusters-fetched")
    still = bounded.filter(F.coalesce(quiet, F.lit(False)))
    return still.select("place", "cells", "cluster", F.lit(None).cast("array<bigint>").alias("sums")).unionByName(resolved), resolved


def start_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `1:<id>`, in this order; repeated ids by their components."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(key.alias("key"), "vector").orderBy("key", "vector").limit(k).collect()
    return np.array([r["vector"] for r in rows], np.int64)


def moved_centroids(centroids: np.ndarray, total: np.ndarray) -> np.ndarray:
    """floor(sum / number) of every centroid that has vectors."""
    out = centroids.copy()
    for c, row in enumerate(total):
        if row[-1]:
            out[c] = [int(s) // int(row[-1]) for s in row[:-1]]
    return out


def cluster(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    most_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector that is kept.

    The VA-file is a table of cell numbers, 6 bits a dimension, beside the table of vectors. Lookup tables per dimension
    give an interval for the distance to each centroid. In the first round and in the last assignment, which need every vector
    for a sum or a distance, the intervals only save comparisons. The rounds between read the cells alone, keep the
    sums of components and change them by the vectors that move; a vector is fetched if its intervals overlap or
    if it moves. All arithmetic is in integers, so reruns and any split into tasks agree.

    Left out are vectors of another length, with a null or a number that is not finite, null ones, and those
    with a component of 2**27 or more after scaling. A null id is hashed as an empty one; repeated ids and rows are vectors of their
    own; with fewer than k vectors each begins as a centroid; an empty table gives an empty one; other columns are
    ignored. Equally near centroids: the smaller number. Sums of distances beyond a long are null.
    """
    spark = vectors.sparkSession
    result = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    source = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    va = fit_cells(source, "embedding", dims, scale)
    if va is None:
        return spark.createDataFrame([], result)
    built = source.mapInArrow(
        _build(va, "vec_id", "embedding", dims, scale), "vec_id bigint, cells binary, vector array<int>"
    )
    table = materialize(built.withColumn("place", F.monotonically_increasing_id()), "clusters-vectors")
    centroids = start_centroids(table, k)
    k = len(centroids)
    state = None
    total = np.zeros((k, dims + 1), object)
    for _ in range(rounds):
        if state is None:
            first = table.select("place", "cells", "vector").mapInArrow(_first_round(va, centroids), STATE)
            state = changed = materialize(first, "clusters-first")
        else:
            state, changed = next_round(state, table, va, centroids, most_bytes)
        total = total + added_up(changed, k, dims)
        centroids = moved_centroids(centroids, total)
    last = table.select("vec_id", "cells", "vector").mapInArrow(_last(va, centroids), "vec_id bigint, cluster int, distance bigint")
    last = materialize(last, "clusters")
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    # One row per centroid.
    inertia = dict(last.groupBy("cluster").agg(F.try_sum("distance")).collect())
    whole = None if None in inertia.values() else sum(inertia.values())
    rows = [(c, s, whole if whole is not None and whole < 1 << 63 else None, digests[c]) for c, s in inertia.items()]
    names = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return last.join(F.broadcast(names), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
