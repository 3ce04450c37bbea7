"""Substring dedup on words: Rabin-Karp hashes of every window of fixed length, counted in Spark."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sentilode.llm import chunks
from sentilode.llm.chunks import Corpus, mixed

# Words of a window.
WINDOW = 35
SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"

_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE_BASE = 0x5851F42D4C957F2D
_WORD_BASES = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(base**k, base**-k) modulo 2**64 for k below n at least; kept for the next call unless it is large."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        if size > 1 << 22:
            return both[0], both[1]
        _powers[base] = (both[0], both[1])
    return _powers[base]


def segments(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """The polynomial hash of values[start:end] for all segments, from one running sum."""
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def word_hashes(corpus: Corpus, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hash per word, first word of each text and the number of words), over all texts of a batch."""
    data, bounds = corpus.data, corpus.bounds
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    finishes = word.copy()
    finishes[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    hashes = np.zeros(len(starts), np.uint64)
    # A piece of the array at a time, cut between words, so that the sums stay small.
    cut = 0
    while cut < len(starts):
        stop = max(cut + 1, int(np.searchsorted(ends, starts[cut] + (1 << 20), side="right")))
        a = starts[cut]
        part = _BYTE[data[a:ends[stop - 1]]]
        hashes[cut:stop] = segments(part, starts[cut:stop] - a, ends[cut:stop] - a, _BYTE_BASE)
        cut = stop
    lengths = (ends - starts).astype(np.uint64)
    return mixed(hashes + lengths * np.uint64(_WORD_BASES[0])), np.searchsorted(starts, bounds)


def window_hashes(corpus: Corpus, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word of each window, hash, other hash, bounds of the texts in words)."""
    hashes, bounds = word_hashes(corpus)
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), none, none, bounds
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.flatnonzero(owner[:n] == owner[window - 1:])
    both = [mixed(segments(hashes, first, first + window, base)) for base in _WORD_BASES]
    return first, both[0], both[1], bounds


def _remove(window: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        repeated = chunks.gathered(right)
        ids, words, removed, shas = [], [], [], []
        for _, part in chunks.pieces(left):
            corpus = Corpus(part.column("text"))
            first, h, _, bounds = window_hashes(corpus, window)
            first = first[chunks.members(h, repeated)]
            # Windows that overlap or touch make one interval.
            change = np.zeros(bounds[-1] + 1, np.int64)
            np.add.at(change, first, 1)
            np.add.at(change, first + window, -1)
            gone = np.cumsum(change)[:-1] > 0
            ids += part.column("doc_id").to_pylist()
            for row in range(part.num_rows):
                own = corpus.text(row).split()
                cut = gone[bounds[row]:bounds[row + 1]]
                kept = [w for w, g in zip(own, cut.tolist()) if not g] if cut.any() else own
                words.append(len(own))
                removed.append(len(own) - len(kept))
                shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(words, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(shas, pa.string()),
            }
        )

    return run


def remove_repeated_windows(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per input row.

    Every window of `window` consecutive words of one text is hashed; all hashes are counted across the corpus in
    buckets. A word goes if it is in a window whose words also start anywhere else, in the same text or
    another; overlapping windows merge into maximal intervals. Windows are judged on the input. All occurrences go, the
    first included.

    A null or empty text has no words; a text shorter than the window loses nothing. Rows that share an
    id are texts of their own, so exact repeats of a row lose their windows; a null id is kept. An
    empty table gives an empty one. Columns other than the two named are ignored. No task holds more than a chunk of
    texts or a bucket of hashes.
    """
    rows, size = chunks.chunked(docs, id_col, text_col)

    def hashes(column: pa.Array):
        _, h, other, _ = window_hashes(Corpus(column), window)
        return h, other

    sent = chunks.send_hashes(rows, chunks.buckets_for(size * 8 // 6), hashes)
    answers = chunks.repeated_hashes(sent)
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_remove(window), SCHEMA)
