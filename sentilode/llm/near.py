"""Near-duplicate texts: SetSketch registers, banding, joint estimates, verification on full sets.

Texts with equal sets of word shingles are one class, and only its smallest id takes part in the search. A SetSketch (Ertl
2021) of a set has m registers; each holds the minimum of exponentially distributed hashes on a scale of powers of a base,
cut off at both ends, so sketches of parts merge by maximum. Bands of registers that agree give candidates, and
candidates that hang together form groups. In a group, the similarity of two sets is estimated from all registers at
once by maximum likelihood, with the known sizes of the sets; where that is not far too low, the full sets decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sentilode.llm.chunks import Corpus, mixed
from sentilode.llm.common import slices, spread_texts
from sentilode.llm.graph import components
from sentilode.llm.windows import segments, word_hashes
from sentilode.operators.scale import lookup_join
from sentilode.session import materialize

SHINGLE = 5
# Two sets are linked if 100 * shared >= PERCENT * all.
PERCENT = 75
# 64 bands of 5 registers miss a pair of similarity 0.75 with probability (1 - 0.75**5)**64, below 4e-8.
BANDS, ROWS = 64, 5
REGISTERS = BANDS * ROWS
# Parameters of the sketch: base and rate, 16 bits a register.
BASE, RATE, TOP = 1.001, 20.0, 65_535
# An estimate has a standard deviation of 0.025 at most; pairs are given up only 8 of these below the threshold.
SLACK = 0.2
# A group larger than one of these is verified in blocks.
BLOCK_SETS, BLOCK_SHINGLES = 4_096, 4_000_000
# Of a unit of blocks, parts that hold a share of 1 / PARTS of it meet those of other units first, with about SPINE sets each.
PARTS, SPINE = 16, 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SHINGLE_BASE = 0x8CB92BA72F3D8DD7
_MULTIPLIERS = mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct hashes of the word shingles of each text; a shorter text is one shingle, an empty one none."""
    corpus = Corpus(column)
    corpus.data = _LOWER[corpus.data]
    hashes, bounds = word_hashes(corpus)
    counts = np.diff(bounds)
    take = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    ends = np.cumsum(take)
    first = np.arange(ends[-1] if len(ends) else 0) + np.repeat(bounds[:-1] - (ends - take), take)
    width = np.repeat(np.minimum(counts, size), take)
    # Sequences of different lengths never meet: the length is part of the hash.
    found = mixed(segments(hashes, first, first + width, _SHINGLE_BASE) + width.astype(np.uint64))
    return [np.unique(x) for x in np.split(found, ends[:-1])] if len(ends) else []


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers per set; an empty set has zeros."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    every = np.concatenate([sets[k] for k in full])
    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    for i in range(REGISTERS):
        low = np.minimum.reduceat(every * _MULTIPLIERS[i], starts)
        value = -np.log1p(-(low.astype(np.float64) + 1) / 2.0**64.001) / RATE
        out[full, i] = np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, TOP).astype(np.uint16)
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def _likelihood(own: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray) -> tuple[Callable[[np.ndarray], np.ndarray], np.ndarray]:
    """(derivative of the joint likelihood of all registers by the Jaccard similarity, largest similarity that the sizes allow).

    Given the sizes, a register of the first is larger, or smaller, with a probability that depends on the similarity
    alone; the likelihood is concave.
    """
    m = own.shape[-1]
    more = (others < own).sum(axis=1).astype(np.float64)
    less = (others > own).sum(axis=1).astype(np.float64)
    u = size / (size + sizes)
    v = 1 - u
    step = (BASE - 1) / BASE
    scale = 1 / np.log(BASE)

    def slope(j: np.ndarray) -> np.ndarray:
        a, b = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        pa_, pb = -np.log1p(-a * step) * scale, -np.log1p(-b * step) * scale
        da, db = -v * step * scale / (1 - a * step), -u * step * scale / (1 - b * step)
        same = np.maximum(1 - pa_ - pb, 1e-12)
        return more * da / pa_ + less * db / pb - (m - more - less) * (da + db) / same

    return slope, np.minimum(u / v, v / u)


def estimate(own: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The Jaccard similarity of one set with others of the largest likelihood, by bisection of its derivative."""
    slope, high = _likelihood(own, size, others, sizes)
    low = np.zeros(len(sizes))
    for _ in range(20):
        middle = (low + high) / 2
        up = slope(middle) > 0
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    return (low + high) / 2


def likely(own: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray, least: float) -> np.ndarray:
    """Whether the estimates are `least` or more: then the likelihood still grows there. One step instead of twenty."""
    slope, high = _likelihood(own, size, others, sizes)
    return (high >= least) & (slope(np.full(len(sizes), least)) >= 0)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two full sets are similar enough."""
    if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def link_group(
    ids: list[int], sets: list[np.ndarray], registers: np.ndarray, labels: np.ndarray, percent: int, ask: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links that join all sets of a group that hang together, given what `labels` has joined already.

    One set at a time is compared with all that are not in its component yet. That ends when all but the largest
    component have been asked: a link between two components has an end outside the largest. So a group of copies of one
    text costs one pass, and no pair within a component is looked at. With `ask` only these sets are compared, and only
    with those that do not ask.
    """
    labels = labels.copy()
    sizes = np.array([len(s) for s in sets], np.float64)
    asked = np.zeros(len(sets), bool)
    edges = []
    while True:
        if ask is not None:
            rest = np.flatnonzero(ask & ~asked)
        else:
            values, counts = np.unique(labels, return_counts=True)
            rest = np.flatnonzero(~asked & (labels != values[counts.argmax()])) if len(values) > 1 else []
        if not len(rest):
            return edges
        x = int(rest[0])
        asked[x] = True
        others = np.flatnonzero(labels != labels[x] if ask is None else (labels != labels[x]) & ~ask)
        near = np.minimum(sizes[others], sizes[x]) * 100 >= percent * np.maximum(sizes[others], sizes[x])
        others = others[near]
        others = others[likely(registers[x], len(sets[x]), registers[others], sizes[others], percent / 100 - SLACK)]
        guess = estimate(registers[x], len(sets[x]), registers[others], sizes[others])
        # The likeliest first: most links are found at once, and their components need no further look.
        for y in others[np.argsort(-guess, kind="stable")].tolist():
            if labels[y] != labels[x] and linked(sets[x], sets[y], percent):
                edges.append((ids[x], ids[y]))
                labels[labels == labels[y]] = labels[x]


SKETCHES = "doc_id bigint, n_shingles bigint, digest binary, registers binary"
EDGES = "a bigint, b bigint"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2 << 20):
        sets = shingle_sets(batch.column("text"))
        rows = sketch(sets)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([r.tobytes() for r in rows], pa.binary()),
            ],
            ["doc_id", "n_shingles", "digest", "registers"],
        )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        ids = batch.column("doc_id").to_numpy()
        rows = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
        for r in range(ROWS):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.reshape(-1).view(np.int64)), pa.array(np.repeat(ids, BANDS))], ["band", "doc_id"]
        )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2 << 20):
        sets = shingle_sets(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("component"), pa.array([s.tobytes() for s in sets], pa.binary()),
                pa.array([r.tobytes() for r in sketch(sets)], pa.binary()),
            ],
            ["doc_id", "component", "shingles", "registers"],
        )


def _read_group(table: pa.Table) -> tuple[list[int], list[np.ndarray], np.ndarray]:
    sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
    registers = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    return table.column("doc_id").to_pylist(), sets, registers


def _edge_table(edges: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})


def _link(percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids, sets, registers = _read_group(table)
        _, labels = np.unique(table.column("found" if "found" in table.column_names else "doc_id"), return_inverse=True)
        return _edge_table(link_group(ids, sets, registers, labels, percent))

    return run


def _ask(percent: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, tile, other = (k.as_py() for k in key)
        ids, sets, registers = _read_group(table)
        labels = table.column("found").to_numpy()
        # A tile of askers meets itself, or a block of others.
        ask = None if other == -1 - tile else table.column("asks").to_numpy(zero_copy_only=False)
        return _edge_table(link_group(ids, sets, registers, labels, percent, ask))

    return run


def candidate_groups(classes: DataFrame) -> DataFrame:
    """(node, component) of the ids of (doc_id, registers) that share a band with another, over any number of steps."""
    banded = classes.mapInArrow(_bands, "band bigint, doc_id bigint")
    # A band is named by its smallest id. Minima are formed in each task first, so a hot band is no hot key there.
    heads = banded.groupBy("band").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("_max"))
    heads = materialize(heads.filter(F.col("b") < F.col("_max")).select("band", "b"), "near-heads")
    edges = banded.join(heads, "band").select(F.col("doc_id").alias("a"), "b").filter(F.col("a") != F.col("b"))
    return components(edges, "near-candidates")


def _blocks(n_sets: Column, n_shingles: Column) -> Column:
    """Blocks that so many sets take."""
    return F.greatest(F.ceil(n_sets / BLOCK_SETS), F.ceil(n_shingles / BLOCK_SHINGLES)).cast("int")


def verified_links(docs: DataFrame, groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): links that join all texts of a group that hang together, checked on the full sets.

    A group goes to one task if it is within BLOCK_SETS and BLOCK_SHINGLES. A larger one is linked in blocks. Then its
    blocks are merged in rounds, a few at a time, by some sets of their largest parts, which joins what hangs together
    closely. Last, the sets outside the largest component so far ask: they are dealt into tiles of a block's size,
    and each tile meets itself, each later tile and each block of the others. So every pair that may still count is
    compared, and no task holds more than two blocks.
    """
    rows = lookup_join(docs, groups.withColumnRenamed("node", "doc_id"), "doc_id", "inner")
    schema = "doc_id bigint, component bigint, shingles binary, registers binary"
    sets = materialize(rows.select("doc_id", "text", "component").mapInArrow(_set_rows, schema), "near-sets")
    size = F.octet_length("shingles") / 8
    sizes = sets.groupBy("component").agg(_blocks(F.count("*"), F.sum(size)).alias("blocks"))
    large = materialize(sizes.filter(F.col("blocks") > 1), "near-large")
    block = F.pmod(F.xxhash64("doc_id"), F.coalesce("blocks", F.lit(1))).cast("int")
    blocked = sets.join(large, "component", "left").withColumn("block", block)
    within = blocked.groupBy("component", "block").applyInArrow(_link(percent), EDGES)
    links = materialize(within, "near-links")
    if large.isEmpty():
        return links
    places = lookup_join(sets.select("doc_id", "component", size.alias("_m")), large, "component", "inner").withColumn("block", block)
    places = places.groupBy("component", "doc_id", "block", "blocks").agg(F.count("*").alias("_n"), F.sum("_m").alias("_m"))
    places = materialize(places, "near-places")

    def labelled(links: DataFrame) -> DataFrame:
        joined = components(links, "near-found").toDF("node", "joined")
        found = places.join(joined, F.col("doc_id") == F.col("node"), "left").withColumn("found", F.coalesce("joined", "doc_id"))
        return materialize(found.drop("node", "joined"), "near-placed")

    def full(chosen: DataFrame) -> DataFrame:
        return lookup_join(sets.drop("component"), chosen, "doc_id", "inner")

    placed, span, most = labelled(links), 1, large.agg(F.max("blocks")).first()[0]
    totals = [F.sum("_n").alias("_sets"), F.sum("_m").alias("_shingles")]
    share = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) / 1_000_000
    fan = max(2, BLOCK_SETS // (PARTS * SPINE))
    while span < most:
        units = placed.withColumn("unit", F.floor(F.col("block") / span))
        parts = units.groupBy("component", "unit", "found").agg(*totals, F.min_by("doc_id", F.hash("doc_id")).alias("_one"))
        whole = units.groupBy("component", "unit").agg(F.sum("_n").alias("_all"))
        parts = parts.join(whole, ["component", "unit"]).filter(F.col("_sets") * PARTS >= F.col("_all"))
        few = (share * F.col("_sets") < SPINE) & (share * F.col("_shingles") < SPINE * BLOCK_SHINGLES / BLOCK_SETS)
        drawn = units.join(parts, ["component", "unit", "found"]).filter(few | (F.col("doc_id") == F.col("_one")))
        span *= fan
        drawn = drawn.select("doc_id", "component", "found", F.floor(F.col("block") / span).alias("unit"))
        merged = full(drawn).groupBy("component", "unit").applyInArrow(_link(percent), EDGES)
        links = materialize(links.unionByName(merged), "near-links")
        placed = labelled(links)
    counts = placed.groupBy("component", "found").agg(F.sum("_n").alias("_sets"))
    first = counts.groupBy("component").agg(F.max_by("found", F.struct("_sets", "found")).alias("first"))
    placed = placed.join(first, "component").withColumn("asks", F.col("found") != F.col("first"))
    tiles = placed.filter("asks").groupBy("component").agg(_blocks(F.sum("_n"), F.sum("_m")).alias("tiles"))
    tiles = materialize(tiles, "near-tiles")
    if tiles.isEmpty():
        return links

    def meet(tile: Column, other: Column, asks: bool) -> Column:
        return F.struct(tile.cast("int").alias("tile"), other.cast("int").alias("other"), F.lit(asks).alias("asks"))

    # Blocks of those that do not ask are numbered from 0 on, tiles as the other side from -1 downwards.
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    own = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("tiles"))
    answers = F.transform(every, lambda t: meet(t, F.col("block"), False))
    asked = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: meet(F.col("own"), b, True)),
        F.transform(F.filter(every, lambda t: t >= F.col("own")), lambda t: meet(F.col("own"), -1 - t, True)),
        F.transform(F.filter(every, lambda t: t < F.col("own")), lambda t: meet(t, -1 - F.col("own"), False)),
    )
    met = placed.join(tiles, "component").withColumn("own", own).withColumn("meets", F.when(F.col("asks"), asked).otherwise(answers))
    last = full(met.select("doc_id", "component", "found", "meets")).withColumn("meets", F.explode("meets")).select("*", "meets.*").drop("meets")
    return links.unionByName(last.groupBy("component", "tile", "other").applyInArrow(_ask(percent), EDGES))


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per input row.

    Texts are linked if `100 * shared >= percent * all` holds for their sets of five-word shingles (A-Z in lower case); the
    component is the smallest id that links lead to, and that text is kept. `percent` above 50 fits the bands.

    A null or empty text has an empty set and links with nothing. Rows that share an id are one document: a link of one is
    a link of all, and they stay or go together. A null id links with nothing, has no component and is kept. An
    empty table gives an empty one. Columns other than the two named are ignored.
    """
    rows = spread_texts(docs, id_col, text_col)
    sketches = materialize(rows.mapInArrow(_sketches, SKETCHES), "near-sketches")
    usable = sketches.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # One row per class, the smallest id first; equal sets have equal registers.
    classes = usable.groupBy("digest").agg(F.min(F.struct("doc_id", "registers")).alias("_first"))
    classes = materialize(classes.select("digest", "_first.*"), "near-classes")
    # Few ids have rows in several classes; these join the classes.
    several = usable.groupBy("doc_id").agg(F.count_distinct("digest").alias("_n")).filter(F.col("_n") > 1).select("doc_id")
    several = materialize(several, "near-several")
    same = usable.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), "digest")
    same = same.join(classes.select("digest", F.col("doc_id").alias("b")), "digest").select("a", "b")
    links = verified_links(rows, candidate_groups(classes.select("doc_id", "registers")), percent)
    found = components(links.unionByName(same), "near-components")
    named = classes.select("digest", "doc_id").join(found, F.col("doc_id") == F.col("node"), "left")
    named = materialize(named.select("digest", F.coalesce("component", "doc_id").alias("_component")), "near-named")
    small = sketches.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return lookup_join(small, named, "digest", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
