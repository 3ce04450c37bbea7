"""Repeated byte strings by the common-prefix interval tree of an enhanced suffix array.

A suffix array of all bytes of a corpus is too large to sort. It is enough to sort the suffixes that begin at
anchors: of the 32-byte grams in a window of `min_bytes` bytes, the one with the smallest hash (the first of equal ones) is the
window's anchor, which depends on the window's content alone. So two equal windows have equal anchors at equal
places, and an anchor whose gram occurs once in the corpus belongs to no repeat.

1. Each chunk sends the hashes of its anchors; those that occur once in the corpus drop out.
2. Each chunk sends the rest with their context, the bytes of all windows that the anchor stands for, to a bucket by gram.
3. A bucket sorts the suffixes that begin at its anchors, takes the common prefixes of neighbours, and scans them with a
   stack: that gives every interval of suffixes with a common prefix. In each interval the bytes before the anchors are
   sorted backwards and scanned in the same way: an interval of these whose occurrences differ in the next byte to the left, and
   in the next to the right, is a maximal repeat with all its occurrences.
4. Each chunk gets what was found in its texts.

A gram that occurs more than HOT times has too many contexts for a bucket. Its windows are judged one by one instead: each
chunk sends the first place of every window, keyed by two independent hashes of all its bytes, and a bucket of windows
finds those that start earlier elsewhere. Equal windows have equal anchors, so both sides of a repeat go the same way.

The reach of an anchor is its context. A repeat longer than that is found as a chain of overlapping ones, so
what they cover is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sentilode.llm import chunks
from sentilode.llm.chunks import Corpus, mixed
from sentilode.llm.common import slices

MIN_BYTES = 100
# Bytes of a gram: a power of two below the shortest repeat.
GRAM = 32
# The windows of a gram that occurs more often are judged by themselves, in buckets of their own.
HOT = 32_768
SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
GROUPS = "repeat_id bigint, n_bytes int, doc_id bigint, start bigint"
CONTEXTS = "bucket int, chunk int, entries binary, size int, contexts binary, known binary"

# An anchor: its text in the order of all texts, its place in it, and the bytes of its context on both sides.
ENTRY = np.dtype([("null", "?"), ("doc", "<i8"), ("row", "<i4"), ("at", "<i8"), ("left", "<u4"), ("right", "<u4")])
# A gram and how often a batch has it; a repeated gram and whether it is hot; the first place of a window in a chunk.
COUNT = np.dtype([("hash", "<u8"), ("n", "<u2")])
ANSWER = np.dtype([("hash", "<u8"), ("hot", "?")])
WINDOW = np.dtype([("key", "<u8"), ("other", "<u8"), ("null", "?"), ("doc", "<i8"), ("row", "<i4"), ("at", "<i8")])
SPAN = np.dtype([("row", "<i4"), ("start", "<i8"), ("end", "<i8")])

_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_BASES = [np.uint64(b) for b in (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165)]
_OTHER_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))
_OTHER_BASES = [np.uint64(b) for b in (0xA24BAED4963EE407, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9, 0xF1357AEA2E62A9C5)]


def gram_hashes(data: np.ndarray, byte: np.ndarray = _BYTE, bases: list[np.uint64] = _BASES) -> np.ndarray:
    """The hash of the GRAM bytes at every place, by doubling."""
    h, width = byte[data], 1
    for base in bases:
        h = h[:-width] * base + h[width:] if len(h) > width else h[:0]
        width *= 2
    return mixed(h)


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of `width` neighbours from every place, by doubling."""
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:len(h) - (width - size)], h[width - size:]) if size < width else h


def anchors(corpus: Corpus, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor, its hash) of each run of windows that share an anchor."""
    none = np.zeros(0, np.int64)
    data, bounds = corpus.data, corpus.bounds
    n = len(data) - min_bytes + 1
    if n <= 0:
        return none, none, none, none.astype(np.uint64)
    width = min_bytes - GRAM + 1
    h = gram_hashes(data)
    low = window_minima(h, width)
    ends = np.repeat(bounds[1:], np.diff(bounds))[:n]
    valid = ends - np.arange(n) >= min_bytes
    first = np.zeros(n, bool)
    begins = bounds[:-1][np.diff(bounds) >= min_bytes]
    first[begins] = True
    change = first.copy()
    change[1:] |= (low[1:] != low[:-1]) | (h[:n - 1] == low[:-1])
    change &= valid
    start = np.flatnonzero(change)
    if not len(start):
        return none, none, none, none.astype(np.uint64)
    entered = ~first[start]
    entered &= low[start] < low[np.maximum(start - 1, 0)]
    owner = start + width - 1
    search = np.flatnonzero(~entered)
    view = np.lib.stride_tricks.sliding_window_view(h, width)
    for k in range(0, len(search), 10_000):
        block = search[k:k + 10_000]
        owner[block] = start[block] + view[start[block]].argmin(axis=1)
    last = np.minimum(np.append(start[1:], n) - 1, ends[start] - min_bytes)
    return start, last, owner, h[owner]


def window_hashes(grams: np.ndarray, at: np.ndarray, min_bytes: int) -> np.ndarray:
    """The hashes of the windows at some places, from those of grams that cover them."""
    h = np.zeros(len(at), np.uint64)
    for k in [*range(0, min_bytes - GRAM, GRAM), min_bytes - GRAM]:
        h = mixed(h * np.uint64(0xD6E8FEB86659FD93) + grams[at + k])
    return h


def bucket_hash(key: np.ndarray) -> np.ndarray:
    return mixed(key ^ np.uint64(0x5DEECE66D1234567))


def shared(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7 >> 3)


def intervals(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of every interval of sorted strings with a common prefix of `least` or more.

    `common[k]` is the common prefix of strings k and k + 1. The stack holds the intervals that are open, by length;
    inner intervals come before outer ones. Only maximal intervals are given: those next to them share less.
    """
    stack: list[tuple[int, int]] = []
    for k in range(len(common) + 1):
        now = common[k] if k < len(common) else -1
        left = k
        while stack and stack[-1][0] > now:
            length, left = stack.pop()
            yield length, left, k
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append((now, left))


class Bucket:
    """The suffixes of one bucket in order, with what they have in common."""

    def __init__(self, order: list[int], left: list[bytes], right: list[bytes], min_bytes: int) -> None:
        # order: place of each anchor in the order of texts and places; left: bytes before it, backwards.
        self.min_bytes = min_bytes
        sa = sorted(range(len(right)), key=right.__getitem__)
        self.order = [order[k] for k in sa]
        self.left = [left[k] for k in sa]
        self.sa = sa
        self.common = [shared(right[a], right[b]) for a, b in zip(sa, sa[1:])]

    def repeats(self, diverse: bool) -> Iterator[tuple[int, int, list[int]]]:
        """(bytes before, bytes from the anchor on, places in the array) of repeats of min_bytes or more.

        With `diverse` only maximal ones; without it also those whose occurrences all go on alike to the right, which are
        parts of others.
        """
        for right, first, last in intervals(self.common, GRAM):
            need = max(0, self.min_bytes - right)
            found = [k for k in range(first, last + 1) if len(self.left[k]) >= need]
            if len(found) < 2:
                continue
            found.sort(key=self.left.__getitem__)
            common = [shared(self.left[a], self.left[b]) for a, b in zip(found, found[1:])]
            for before, a, b in intervals(common, need):
                own = found[a:b + 1]
                if not diverse or min(self.common[min(own):max(own)]) == right:
                    yield before, right, own


def _unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes], list[bytes]]:
    """(entries, chunk of each, bytes before it backwards, bytes from it on) of all chunks."""
    entries, owner, left, right = [], [], [], []
    columns = [table.column(c).to_pylist() for c in ("chunk", "entries", "size", "contexts")]
    for chunk, own, size, packed in zip(*columns):
        own = np.frombuffer(own, ENTRY)
        data = pa.decompress(packed, size, codec="zstd", asbytes=True) if size else b""
        at = 0
        for a, b in zip(own["left"].tolist(), own["right"].tolist()):
            left.append(data[at:at + a][::-1])
            right.append(data[at + a:at + a + b])
            at += a + b
        entries.append(own)
        owner.append(np.full(len(own), chunk, np.int32))
    return np.concatenate(entries), np.concatenate(owner), left, right


def _text_order(entries: np.ndarray) -> np.ndarray:
    """The rank of each entry by text and place; texts are in order of id, null last, then of row."""
    rank = np.empty(len(entries), np.int64)
    rank[np.lexsort((entries["at"], entries["row"], entries["doc"], entries["null"]))] = np.arange(len(entries))
    return rank


def _send_grams(min_bytes: int, n_buckets: int):
    """Every gram of an anchor with its count, once per batch and chunk, to a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2 << 20):
            chunk = batch.column("chunk").to_numpy()
            order = np.argsort(chunk, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1):
                key, n = np.unique(anchors(Corpus(batch.column("text").take(pa.array(own))), min_bytes)[3], return_counts=True)
                if not len(key):
                    continue
                sent = np.zeros(len(key), COUNT)
                sent["hash"], sent["n"] = key, np.minimum(n, 65_535)
                bucket = (bucket_hash(key) % np.uint64(n_buckets)).astype(np.int32)
                order_ = np.argsort(bucket, kind="stable")
                sent, bucket = sent[order_], bucket[order_]
                firsts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[firsts]), pa.array(np.full(len(firsts), chunk[own[0]], np.int32)),
                        pa.array([p.tobytes() for p in np.split(sent, firsts[1:])], pa.binary()),
                    ],
                    ["bucket", "chunk", "payload"],
                )

    return run


def _answer_grams(hot: int):
    """For every chunk those of its grams that occur twice or more in all chunks, and which occur more than `hot` times."""

    def run(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(p, COUNT) for p in table.column("payload").to_pylist()]
        every = np.concatenate(sent)
        _, code = np.unique(every["hash"], return_inverse=True)
        total = np.bincount(code, weights=every["n"])[code]
        answers = np.zeros(len(every), ANSWER)
        answers["hash"], answers["hot"] = every["hash"], total > hot
        bounds = np.cumsum([len(x) for x in sent])[:-1]
        payload = [a[t > 1].tobytes() for a, t in zip(np.split(answers, bounds), np.split(total, bounds))]
        return pa.table({"chunk": table.column("chunk"), "payload": pa.array(payload, pa.binary())})

    return run


def _to_chunks(table: pa.Table, spans: np.ndarray, whose: np.ndarray) -> pa.Table:
    """Rows of (chunk, spans): those found in a bucket, and those that chunks knew."""
    chunk = table.column("chunk").to_pylist()
    payload = table.column("known").to_pylist()
    order = np.argsort(whose, kind="stable")
    spans, whose = spans[order], whose[order]
    for a in np.split(np.arange(len(spans)), np.flatnonzero(np.diff(whose)) + 1):
        if len(a):
            chunk.append(int(whose[a[0]]))
            payload.append(spans[a].tobytes())
    keep = [k for k, p in enumerate(payload) if p]
    return pa.table(
        {
            "chunk": pa.array([chunk[k] for k in keep], pa.int32()),
            "payload": pa.array([payload[k] for k in keep], pa.binary()),
        }
    )


def _later_windows(table: pa.Table, min_bytes: int) -> pa.Table:
    """For a bucket of windows those that start earlier in another chunk."""
    parts = []
    for size, packed in zip(table.column("size").to_pylist(), table.column("contexts").to_pylist()):
        data, n, offset = pa.decompress(packed, size, codec="zstd", asbytes=True), size // WINDOW.itemsize, 0
        own = np.empty(n, WINDOW)
        for name in WINDOW.names:
            own[name] = np.frombuffer(data, WINDOW[name], n, offset)
            offset += WINDOW[name].itemsize * n
        parts.append(own)
    owner = np.repeat(table.column("chunk").to_numpy(), [len(x) for x in parts])
    every = np.concatenate(parts)
    order = np.lexsort([every[c] for c in ("at", "row", "doc", "null", "other", "key")])
    key, other = every["key"][order], every["other"][order]
    later = order[1:][(key[1:] == key[:-1]) & (other[1:] == other[:-1])]
    out = np.zeros(len(later), SPAN)
    out["row"], out["start"], out["end"] = every["row"][later], every["at"][later], every["at"][later] + min_bytes
    return _to_chunks(table, out, owner[later])


def _find_later(min_bytes: int, n_buckets: int):
    """For every bucket the spans that also start earlier, as rows of (chunk, spans); windows follow the `n_buckets` of grams."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if key[0].as_py() >= n_buckets:
            return _later_windows(table, min_bytes)
        entries, owner, left, right = _unpack(table)
        rank = _text_order(entries)
        spans: list[tuple[int, int, int]] = []  # entry, bytes before, bytes from the anchor on
        seen: dict[tuple[bytes, bytes], int] = {}
        distinct: list[int] = []
        for k in np.argsort(rank).tolist():
            # Equal contexts: all but the first are repeats from end to end.
            if seen.setdefault((left[k], right[k]), k) != k:
                spans.append((k, len(left[k]), len(right[k])))
            else:
                distinct.append(k)
        bucket = Bucket(
            [int(rank[k]) for k in distinct], [left[k] for k in distinct], [right[k] for k in distinct], min_bytes
        )
        for before, after, own in bucket.repeats(diverse=False):
            first = min(own, key=bucket.order.__getitem__)
            spans += [(distinct[bucket.sa[k]], before, after) for k in own if k != first]
        out = np.zeros(len(spans), SPAN)
        if spans:
            k, before, after = (np.array(x) for x in zip(*spans))
            out["row"] = entries["row"][k]
            out["start"] = entries["at"][k] - before
            out["end"] = entries["at"][k] + after
            whose = owner[k]
        else:
            whose = np.zeros(0, np.int32)
        return _to_chunks(table, out, whose)

    return run


def _find_groups(min_bytes: int):
    """For every bucket its maximal repeats with all occurrences."""

    def run(table: pa.Table) -> pa.Table:
        entries, _, left, right = _unpack(table)
        bucket = Bucket(_text_order(entries).tolist(), left, right, min_bytes)
        ids, sizes, docs, starts = [], [], [], []
        for before, after, own in bucket.repeats(diverse=True):
            k = bucket.sa[own[0]]
            text = left[k][:before][::-1] + right[k][:after]
            name = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)
            for k in sorted(own, key=bucket.order.__getitem__):
                e = entries[bucket.sa[k]]
                ids.append(name)
                sizes.append(before + after)
                docs.append(None if e["null"] else int(e["doc"]))
                starts.append(int(e["at"]) - before)
        return pa.table(
            {
                "repeat_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(sizes, pa.int32()),
                "doc_id": pa.array(docs, pa.int64()), "start": pa.array(starts, pa.int64()),
            }
        )

    return run


def _hot_windows(corpus: Corpus, start: np.ndarray, last: np.ndarray, min_bytes: int) -> tuple[np.ndarray, ...]:
    """(key, other key, row, place in the text) of every window of some runs."""
    n = last - start + 1
    at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
    row = np.searchsorted(corpus.bounds, at, side="right") - 1
    key = window_hashes(gram_hashes(corpus.data), at, min_bytes)
    other = window_hashes(gram_hashes(corpus.data, _OTHER_BYTE, _OTHER_BASES), at, min_bytes)
    return key, other, row, at - corpus.bounds[row]


def _pack_windows(found: list[tuple[np.ndarray, ...]], ids: pa.ChunkedArray, min_bytes: int, n_windows: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(bucket of windows, size, packed windows, known spans): the first place of each window of a chunk; the others are known."""
    key, other, row, at = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((at, row, other, key))
    key, other, row, at = key[order], other[order], row[order], at[order]
    again = np.concatenate([[False], (key[1:] == key[:-1]) & (other[1:] == other[:-1])])
    place = np.lexsort((at[again], row[again]))
    r, a = row[again][place], at[again][place]
    # Known windows that follow each other are one span.
    begins = np.concatenate([[True], (r[1:] != r[:-1]) | (a[1:] != a[:-1] + 1)]) if len(r) else np.zeros(0, bool)
    known = np.zeros(int(begins.sum()), SPAN)
    if len(r):
        known["row"], known["start"] = r[begins], a[begins]
        known["end"] = a[np.append(np.flatnonzero(begins)[1:], len(a)) - 1] + min_bytes
    sent = np.zeros(int((~again).sum()), WINDOW)
    sent["key"], sent["other"], sent["row"], sent["at"] = key[~again], other[~again], row[~again], at[~again]
    own = ids.combine_chunks()
    sent["null"] = own.is_null().to_numpy(zero_copy_only=False)[sent["row"]]
    sent["doc"] = own.fill_null(0).to_numpy(zero_copy_only=False)[sent["row"]]
    bucket = (sent["other"] % np.uint64(n_windows)).astype(np.int64)
    order = np.lexsort((sent["at"], sent["row"], bucket))
    sent, bucket = sent[order], bucket[order]
    spans = known.tobytes()
    for part in np.split(np.arange(len(sent)), np.flatnonzero(np.diff(bucket)) + 1):
        data = b"".join(sent[name][part].tobytes() for name in WINDOW.names)
        yield int(bucket[part[0]]), len(data), pa.compress(data, codec="zstd", asbytes=True), spans
        spans = b""


def _send_contexts(min_bytes: int, n_buckets: int, n_windows: int, collapse: bool):
    """The contexts of the repeated anchors of a chunk, packed per bucket, and the windows of hot ones.

    With `collapse`, equal contexts of a chunk are sent once, the first; the others are repeats from end to end and
    travel as known spans.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: dict[str, list] = {c: [] for c in ("bucket", "chunk", "entries", "size", "contexts", "known")}
        answers = np.concatenate([np.zeros(0, ANSWER), *(np.frombuffer(p, ANSWER) for p in right.column("payload").to_pylist())])
        repeated, hot = np.unique(answers["hash"]), np.unique(answers["hash"][answers["hot"]])
        if left.num_rows and len(repeated):
            left = chunks.in_order(left)
            chunk = left.column("chunk")[0].as_py()
            packed: dict[int, tuple[list, list, list]] = {}
            seen: set[tuple[int, bytes]] = set()
            windows: list[tuple[np.ndarray, ...]] = []
            for base, part in chunks.pieces(left):
                corpus = Corpus(part.column("text"))
                ids = part.column("doc_id").to_pylist()
                start, last, owner, key = anchors(corpus, min_bytes)
                keep = chunks.members(key, repeated)
                start, last, owner, key = start[keep], last[keep], owner[keep], key[keep]
                often = chunks.members(key, hot)
                if often.any():
                    k1, k2, r, at = _hot_windows(corpus, start[often], last[often], min_bytes)
                    windows.append((k1, k2, r + base, at))
                    start, last, owner, key = start[~often], last[~often], owner[~often], key[~often]
                row = np.searchsorted(corpus.bounds, start, side="right") - 1
                data = corpus.data.tobytes()
                bucket = bucket_hash(key) % np.uint64(n_buckets)
                offset = corpus.bounds[row]
                columns = (bucket, row, start, last + min_bytes, owner, offset)
                for b, r, s, e, a, o in zip(*(x.tolist() for x in columns)):
                    entries, contexts, known = packed.setdefault(b, ([], [], []))
                    context = data[s:e]
                    if collapse and (a - s, context) in seen:
                        known.append((base + r, s - o, e - o))
                        continue
                    seen.add((a - s, context))
                    entries.append((ids[r] is None, ids[r] or 0, base + r, a - o, a - s, e - a))
                    contexts.append(context)
            for b, (entries, contexts, known) in packed.items():
                data = b"".join(contexts)
                rows["bucket"].append(b)
                rows["chunk"].append(chunk)
                rows["entries"].append(np.array(entries, ENTRY).tobytes())
                rows["size"].append(len(data))
                rows["contexts"].append(pa.compress(data, codec="zstd", asbytes=True) if data else b"")
                rows["known"].append(np.array(known, SPAN).tobytes())
            for b, size, data, known in _pack_windows(windows, left.column("doc_id"), min_bytes, n_windows) if windows else ():
                for c, v in zip(rows, (n_buckets + b, chunk, b"", size, data, known)):
                    rows[c].append(v)
        types = (pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(rows.items(), types)})

    return run


def _cut(left: pa.Table, right: pa.Table) -> pa.Table:
    """What is left of the texts of a chunk without the spans found in them."""
    left = chunks.in_order(left)
    found = [np.frombuffer(p, SPAN) for p in right.column("payload").to_pylist()]
    spans = np.concatenate(found) if found else np.zeros(0, SPAN)
    spans = spans[np.lexsort((spans["start"], spans["row"]))]
    at = np.searchsorted(spans["row"], np.arange(left.num_rows + 1))
    sizes, removed, counts, shas = [], [], [], []
    for base, part in chunks.pieces(left):
        corpus = Corpus(part.column("text"))
        for r in range(part.num_rows):
            data, digest, upto, gone, n = corpus.text(r), hashlib.sha256(), 0, 0, 0
            own = spans[at[base + r]:at[base + r + 1]]
            end = -1
            for s, e in zip(own["start"].tolist(), own["end"].tolist()):
                if s > end:
                    n += 1
                    digest.update(data[upto:s])
                    gone += e - s
                    upto = end = e
                elif e > end:
                    gone += e - end
                    upto = end = e
            digest.update(data[upto:])
            sizes.append(len(data))
            removed.append(gone)
            counts.append(n)
            shas.append(digest.hexdigest())
    return pa.table(
        {
            "doc_id": left.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(counts, pa.int64()),
            "kept_sha256": pa.array(shas, pa.string()),
        }
    )


def _contexts(docs: DataFrame, min_bytes: int, collapse: bool, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int]:
    """(chunked texts, contexts and hot windows, number of buckets of contexts). Without `collapse` no gram counts as hot."""
    if min_bytes <= GRAM:
        raise ValueError(f"repeats must be longer than {GRAM} bytes")
    rows, size = chunks.chunked(docs, id_col, text_col)
    per_anchor = 2 * 8 / (min_bytes - GRAM + 2)
    sent = rows.mapInArrow(_send_grams(min_bytes, chunks.buckets_for(int(size * per_anchor))), chunks.BLOBS)
    answers = sent.groupBy("bucket").applyInArrow(_answer_grams(HOT if collapse else 1 << 62), "chunk int, payload binary")
    n_buckets = chunks.buckets_for(size)
    send = _send_contexts(min_bytes, n_buckets, chunks.buckets_for(4 * size), collapse)
    return rows, rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(send, CONTEXTS), n_buckets


def remove_repeats(
    docs: DataFrame, min_bytes: int = MIN_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per input row, of the text as UTF-8.

    A byte goes if it is in a string of `min_bytes` bytes that also starts earlier: in a text with a smaller
    id, or earlier in the same text, overlapping or not. Strings do not cross texts and are judged on the input.

    A null text is empty; texts shorter than `min_bytes` lose nothing. A null id comes after all others. Rows that share
    an id are ordered by text; equal rows follow each other, so all but one lose what they share. An empty
    table gives an empty one. Other columns are ignored. A task holds a chunk of texts or one bucket.
    """
    rows, contexts, n_buckets = _contexts(docs, min_bytes, True, id_col, text_col)
    found = contexts.groupBy("bucket").applyInArrow(_find_later(min_bytes, n_buckets), "chunk int, payload binary")
    return rows.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_cut, SCHEMA)


def maximal_repeats(
    docs: DataFrame, min_bytes: int = MIN_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(repeat_id, n_bytes, doc_id, start): every maximal repeat within an anchor's reach, with all its occurrences.

    `repeat_id` is a hash of the repeated bytes and `start` a place in bytes. Edge cases as in `remove_repeats`.
    """
    _, contexts, _ = _contexts(docs, min_bytes, False, id_col, text_col)
    return contexts.groupBy("bucket").applyInArrow(_find_groups(min_bytes), GROUPS)
