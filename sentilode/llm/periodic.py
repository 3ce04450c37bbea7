"""Periodic runs of words: maximal pairs at a bounded distance, from the tree of common-prefix intervals of a text."""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sentilode.llm.common import slices, spread_texts

# A run has at least this many words and this many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
# A pair of equal stretches d words apart makes a run if they have 3 * d words, and 5 if d is 1: shorter prefixes never count.
SEED = LEAST_WORDS - 1
NEAR = LEAST_PERIODS - 1
BATCH_BYTES = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)

SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def altered(n: int, doc_id: int | None) -> np.ndarray | None:
    """For one id in ten, the number of the original word that stands at each place of a text of n words; else None."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def repeats_seed(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Numbers of the texts in which some SEED words in a row occur twice, or seem to by a hash."""
    if len(codes) < SEED:
        return np.zeros(0, np.int64)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(31)
    rolling = mixed[:len(codes) - SEED + 1].copy()
    for k in range(1, SEED):
        rolling *= _BASE
        rolling += mixed[k:len(codes) - SEED + 1 + k]
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(rolling)]
    inside = np.arange(len(rolling)) + SEED <= bounds[1:][owner]
    rolling, owner = rolling[inside], owner[inside]
    rolling ^= owner.astype(np.uint64) * _BASE
    order = np.argsort(rolling)
    same = rolling[order[1:]] == rolling[order[:-1]]
    return np.unique(owner[order[1:][same]])


def _packed(columns: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The columns, the most telling one first, as few integers: as many of `width` bits in each as 63 bits hold."""
    per = max(1, 63 // width)
    out = []
    for at in range(0, len(columns), per):
        key = columns[at].astype(np.int64)
        for column in columns[at + 1:at + per]:
            key = key << width | column
        out.append(key)
    return out


class SuffixArray:
    """The suffixes, text by text, whose first SEED words occur again in their text, in the order of their words.

    `order` has their places, `shared[k]` the number of words that the k-th has in common with the one before it, 0 if fewer than SEED.
    Places count in `words`: the codes of each text, from 1, with SEED zeros after it.
    """

    def __init__(self, texts: list[np.ndarray]) -> None:
        gap = np.zeros(SEED, np.int64)
        self.words = np.concatenate([part for text in texts for part in (text + 1, gap)])
        sizes = np.array([len(t) for t in texts])
        self.starts = np.concatenate([[0], np.cumsum(sizes + SEED)[:-1]])
        # Suffixes begin at each word, and an empty one at the end of each text.
        owner = np.repeat(np.arange(len(texts)), sizes + 1)
        places = np.arange(len(owner)) - np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1) + self.starts[owner]
        width = int(max(self.words.max(), len(texts))).bit_length()
        keys = _packed([owner, *[self.words[places + k] for k in range(SEED)]], width)
        by_words = np.lexsort(keys[::-1])
        places, keys = places[by_words], [k[by_words] for k in keys]
        new = np.ones(len(places), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        # The rank of a suffix is the place of its group's first in the order.
        rank = np.zeros(len(self.words), np.int32)
        first = np.flatnonzero(new)
        group = np.repeat(first, np.diff(np.append(first, len(places))))
        rank[places] = group
        self.ranks = [rank]
        self.reach = [SEED]
        tied = places[np.repeat(np.diff(np.append(first, len(places))) > 1, np.diff(np.append(first, len(places))))]
        self.order = tied
        self._refine(tied)
        self.order = tied[np.argsort(self.ranks[-1][tied], kind="stable")]
        self.shared = self._shared()

    def _refine(self, tied: np.ndarray) -> None:
        """Ranks by twice as many words each, until all differ."""
        while len(tied):
            rank, reach = self.ranks[-1], self.reach[-1]
            key = rank[tied].astype(np.int64) << 32 | rank[tied + reach]
            order = np.argsort(key, kind="stable")
            tied, key = tied[order], key[order]
            at = np.arange(len(tied))
            old = key >> 32
            begins = np.r_[True, old[1:] != old[:-1]]
            splits = np.r_[True, key[1:] != key[:-1]]
            own = at[splits][np.cumsum(splits) - 1] - at[begins][np.cumsum(begins) - 1]
            finer = rank.copy()
            finer[tied] = old + own
            self.ranks.append(finer)
            self.reach.append(2 * reach)
            sizes = np.diff(np.append(np.flatnonzero(splits), len(tied)))
            tied = tied[np.repeat(sizes > 1, sizes)]

    def _shared(self) -> np.ndarray:
        a, b = self.order[:-1].astype(np.int64), self.order[1:].astype(np.int64)
        out = np.zeros(len(a), np.int64)
        for rank, reach in zip(self.ranks[::-1], self.reach[::-1]):
            # A rank stands for this many words only where the text goes on as far; equal ones do.
            out += np.where(rank[a + out] == rank[b + out], reach, 0)
        alike = np.ones(len(a), bool)
        for _ in range(SEED - 1):
            alike &= (self.words[a + out] == self.words[b + out]) & (self.words[a + out] > 0)
            out += alike
        return np.concatenate([[0], np.where(out >= SEED, out, 0)])

    def left(self) -> np.ndarray:
        """The word before each place; a text's first word has a zero before it."""
        return np.concatenate([[0], self.words[:-1]])


def _block(every: list[int], own: list[int], at: int, step: int) -> int:
    """How many entries of `every` from `at` on, going by `step`, are all in its sorted part `own`; every[at] is."""
    first = bisect_left(own, every[at])
    room = min(at, first) if step < 0 else min(len(every) - 1 - at, len(own) - 1 - first)
    low, far = 0, 1
    while far <= room and every[at + step * far] == own[first + step * far]:
        low, far = far, 2 * far
    high = min(far, room + 1)
    while high - low > 1:
        middle = (low + high) // 2
        if every[at + step * middle] == own[first + step * middle]:
            low = middle
        else:
            high = middle
    return low + 1


class Node:
    """An interval of suffixes that share `shared` words: its places in order, and a list of them per word on their left."""

    __slots__ = ("shared", "every", "classes")

    def __init__(self, shared: int, every: list[int], classes: dict[int, list[int]]) -> None:
        self.shared, self.every, self.classes = shared, every, classes


def _leaf(place: int, left: np.ndarray) -> Node:
    return Node(0, [place], {left[place]: [place]})


def _join(node: Node, child: Node, left: list[int], runs: dict[tuple[int, int], int]) -> None:
    """Adds a child to a node and the runs of the pairs between them.

    Both places of a pair share exactly the node's words, so the stretches cannot go on to the right; with different words on
    their left they are maximal. Places of the same left word come in blocks of their list, which are leapt over.
    The smaller side is looked up in the larger one and added to it.
    """
    small, large = (child, node) if len(child.every) <= len(node.every) else (node, child)
    shared = node.shared
    reach = shared // NEAR
    every, classes = large.every, large.classes
    for place in small.every:
        word = left[place]
        own = classes.get(word)
        at = bisect_left(every, place)
        for step, k in ((-1, at - 1), (1, at)):
            while 0 <= k < len(every) and abs(every[k] - place) <= reach:
                other = every[k]
                if own is not None and left[other] == word:
                    k += step * _block(every, own, k, step)
                    continue
                first, second = (other, place) if other < place else (place, other)
                span = (first, second + shared)
                period = second - first
                if runs.get(span, period) >= period:
                    runs[span] = period
                k += step
    for place in small.every:
        insort(every, place)
    for word, places in small.classes.items():
        own = classes.get(word)
        if own is None:
            classes[word] = places
        else:
            for place in places:
                insort(own, place)
    node.every, node.classes = every, classes


def maximal_pairs(order: list[int], shared: list[int], left: list[int], runs: dict[tuple[int, int], int]) -> None:
    """One pass over the suffixes of a group, bottom-up through the intervals that they share words in.

    Adds (start, end) -> period for every run. A run's pairs at twice its period and more have the same ends; the shortest stays.
    """
    stack: list[Node] = []
    for k in range(1, len(order) + 1):
        length = shared[k] if k < len(order) else 0
        last = _leaf(order[k - 1], left)
        while stack and stack[-1].shared > length:
            node = stack.pop()
            _join(node, last, left, runs)
            last = node
        if not length:
            continue
        if stack and stack[-1].shared == length:
            _join(stack[-1], last, left, runs)
        else:
            stack.append(Node(length, last.every, last.classes))


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text of word codes, by start and then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not texts or not sum(map(len, texts)):
        return out
    array = SuffixArray(texts)
    if not len(array.order):
        return out
    begins = np.flatnonzero(array.shared == 0)
    group = np.cumsum(array.shared == 0) - 1
    # A group whose nearest places are too far apart for its longest stretch has no run.
    by_place = np.lexsort((array.order, group))
    gap = np.diff(array.order[by_place])
    gap = np.where(np.diff(group[by_place]) == 0, gap, np.iinfo(np.int64).max)
    nearest = np.minimum.reduceat(np.append(gap, np.iinfo(np.int64).max), begins)
    longest = np.maximum.reduceat(array.shared, begins)
    left = array.left().tolist()
    order, shared = array.order.tolist(), array.shared.tolist()
    ends = np.append(begins[1:], len(order))
    runs: dict[tuple[int, int], int] = {}
    for k in np.flatnonzero(nearest <= longest // NEAR):
        a, b = begins[k], ends[k]
        maximal_pairs(order[a:b], shared[a:b], left, runs)
    if runs:
        owner = np.searchsorted(array.starts, [start for start, _ in runs], side="right") - 1
        for text, ((start, end), period) in zip(owner.tolist(), runs.items()):
            base = int(array.starts[text])
            out[text].append((start - base, end - start, period))
    return [sorted(own, key=lambda r: (r[0], r[2])) for own in out]


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: all but those that some run has after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _row(doc_id: int | None, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    if runs:
        words = [w for w, stays in zip(words, collapsed(len(words), runs).tolist()) if stays]
    return (
        doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest(),
    )


def _batch(ids: list[int | None], texts: list[bytes], alter: bool) -> Iterator[tuple]:
    split = [text.split() for text in texts]  # bytes are split at 0x20 and 0x09 to 0x0D
    if alter:
        for k, (doc_id, words) in enumerate(zip(ids, split)):
            places = altered(len(words), doc_id)
            if places is not None:
                split[k] = [words[i] for i in places.tolist()]
    bounds = np.cumsum([0, *map(len, split)])
    flat = pa.array([w for words in split for w in words], pa.large_binary())
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    busy = repeats_seed(codes, bounds).tolist()
    found = dict(zip(busy, find_runs([codes[bounds[k]:bounds[k + 1]] for k in busy])))
    for k, (doc_id, words) in enumerate(zip(ids, split)):
        yield _row(doc_id, words, found.get(k, []))


def _run(alter: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [field.split()[0] for field in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH_BYTES):
            rows = list(_batch(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), alter))
            types = [pa.string() if name.endswith("sha256") else pa.int64() for name in names]
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


def periodic_runs(docs: DataFrame, alter: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) per input row.

    A run is a stretch of words with smallest period q, of at least 6 words and 4 periods, that no neighbouring word prolongs. The
    longest one (then the first, then that of the shortest period) is told; `runs_sha256` covers all. `collapsed_sha256`
    is that of the words without those that a run has after its first period. `alter` first makes one text in ten periodic, by its id.

    Texts without a repeat of 5 words have no run. Of the others the suffixes that begin with such a repeat are
    sorted by doubling, text by text; their intervals of shared words are passed bottom-up. A node looks for places
    at most a third of its shared words apart with different words on their left: these maximal pairs are
    the runs, and nothing is extended afterwards. Lists of the same left word are leapt over, and the smaller part is
    put into the larger, so a text of one word repeated is no worse than others.

    Every row is one text and is handled alone, so nothing is shuffled. A null text is empty, which has no run;
    a null id is kept and its text not altered; repeated rows get the same result each; a long text is handled
    in a batch of its own; other columns are ignored; an empty table gives an empty one.
    """
    return spread_texts(docs, id_col, text_col).mapInArrow(_run(alter), SCHEMA)
