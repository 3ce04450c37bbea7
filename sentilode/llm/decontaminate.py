"""Benchmark decontamination by pigeonhole edit matching.

A test item that occurs in a text with at most k edits, cut into k + 1 pieces, has a piece that occurs exactly. So all
pieces of all items are looked for in one pass over a text, and around each hit Myers' bit-parallel
algorithm finds the smallest number of edits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sentilode.llm.common import let_go, slices, spread_texts

# Edits allowed per character of an item.
ERROR_RATE = 0.08
# Shorter items, after normalisation, must occur exactly and on word bounds.
MIN_CHARS = 20
# Items are sent to the executors in blocks of so many bytes; each block takes one pass over the texts.
BLOCK_BYTES = 32 << 20
SCHEMA = "doc_id bigint, item_id bigint, distance int, start int, end int"

Item = tuple[int, str]


def normal(text: str | None) -> str:
    """Lower case, white space as one space."""
    return " ".join((text or "").lower().split())


def budget(length: int, rate: float) -> int:
    return int(length * rate)


def pieces(text: str, errors: int) -> list[tuple[int, str]]:
    """(place, piece): the text cut into errors + 1 pieces of nearly equal length."""
    bounds = [len(text) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, text[a:b]) for a, b in zip(bounds, bounds[1:])]


def masks(pattern: str) -> dict[str, int]:
    """For every character the places it has in the pattern, as bits."""
    found: dict[str, int] = {}
    for k, c in enumerate(pattern):
        found[c] = found.get(c, 0) | 1 << k
    return found


def myers(places: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """(edits, end): the fewest edits between a pattern and any substring of the text, and its first end."""
    every, top = (1 << length) - 1, 1 << length - 1
    up, down, score = every, 0, length
    best, end = length, 0
    for k, c in enumerate(text):
        same = places.get(c, 0)
        vertical = same | down
        horizontal = ((same & up) + up ^ up) | same
        more = (down | ~(horizontal | up)) & every
        less = up & horizontal
        score += bool(more & top) - bool(less & top)
        more, less = more << 1 & every, less << 1 & every
        up = (less | ~(vertical | more)) & every
        down = more & vertical
        if score < best:
            best, end = score, k + 1
    return best, end


def on_bounds(text: str, start: int, end: int) -> bool:
    """Whether no word of the text goes on across either end of a place in it."""
    before = start > 0 and text[start - 1].isalnum() and text[start].isalnum()
    after = end < len(text) and text[end - 1].isalnum() and text[end].isalnum()
    return not (before or after)


class Matcher:
    """The pieces of a block of items as one automaton."""

    def __init__(self, items: list[Item], rate: float, min_chars: int) -> None:
        import ahocorasick

        self.min_chars = min_chars
        self.items: list[tuple[int, str, int]] = []
        where: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normal(text)
            if not text:
                continue
            errors = budget(len(text), rate) if len(text) >= min_chars else 0
            for place, piece in pieces(text, errors):
                where.setdefault(piece, []).append((len(self.items), place))
            self.items.append((item_id, text, errors))
        self.masks: dict[int, tuple[dict[str, int], dict[str, int]]] = {}
        self.machine = ahocorasick.Automaton()
        for piece, found in where.items():
            self.machine.add_word(piece, (len(piece), found))
        if where:
            self.machine.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, edits, start, end) of the best place of every item that occurs; places in the normal text."""
        text = normal(text)
        if not self.items or not text:
            return []
        starts: dict[int, set[int]] = {}
        for last, (length, found) in self.machine.iter(text):
            for item, place in found:
                starts.setdefault(item, set()).add(last - length + 1 - place)
        out = []
        for item, guesses in starts.items():
            best = self.best(text, item, sorted(guesses))
            if best:
                out.append((self.items[item][0], *best))
        return out

    def best(self, text: str, item: int, guesses: list[int]) -> tuple[int, int, int] | None:
        """(edits, start, end) with the fewest edits, then the first end."""
        _, pattern, errors = self.items[item]
        length = len(pattern)
        for start in guesses:
            if start >= 0 and text.startswith(pattern, start) and (length >= self.min_chars or on_bounds(text, start, start + length)):
                return 0, start, start + length
        if not errors:
            return None
        if item not in self.masks:
            self.masks[item] = masks(pattern), masks(pattern[::-1])
        forth, back = self.masks[item]
        found = None
        done = 0
        for k, start in enumerate(guesses):
            # Windows of neighbouring hits that overlap are searched as one.
            if k + 1 < len(guesses) and guesses[k + 1] - start <= 2 * errors:
                continue
            low = max(0, guesses[done] - errors)
            done = k + 1
            window = text[low:max(0, start + length + errors)]
            edits, end = myers(forth, length, window)
            if edits <= errors and (found is None or edits < found[0]):
                _, size = myers(back, length, window[max(0, end - length - edits):end][::-1])
                found = edits, low + end - size, low + end
        return found


def blocks(benchmark: DataFrame, id_col: str, text_col: str, most_bytes: int = BLOCK_BYTES) -> Iterator[list[Item]]:
    """The items in blocks of bounded size; the driver holds one partition of them at a time."""
    rows = benchmark.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).filter(F.col(text_col).isNotNull())
    block, size = [], 0
    for item_id, text in rows.toLocalIterator():
        block.append((item_id, text))
        size += 4 * len(text)
        if size >= most_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = ERROR_RATE,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, distance, start, end): per text and item that occurs in it, the place with the fewest edits.

    Texts and items are compared in lower case with white space as one space; start and end are places in that form. An
    item may occur with up to `rate` edits per character; its whole text must occur. Items shorter than `min_chars` must
    occur exactly and on word bounds. Null and empty items match nothing, as do null and empty texts. A null id is kept; repeated rows match each; an empty table on
    either side gives an empty result; other columns are ignored. Items are broadcast in blocks of bounded
    size; texts are read whole, once per block, and not shuffled.
    """
    rows = spread_texts(docs, id_col, text_col)
    found = []
    for block in blocks(benchmark, item_id_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        found.append(rows.mapInArrow(_find(shared, rate, min_chars), SCHEMA))
    if not found:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionByName, found)


def _find(shared, rate: float, min_chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, rate, min_chars)
        for batch in slices(batches):
            rows = [
                (doc_id, *match)
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                for match in matcher.find(text)
            ]
            columns = list(zip(*rows)) if rows else [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "item_id", "distance", "start", "end"]
            )

    return run


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = ERROR_RATE,
    min_chars: int = MIN_CHARS,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of `docs`, with all their columns, in which no item occurs; edge cases as in `find_items`."""
    left = docs
    for block in blocks(benchmark, item_id_col, item_text_col):
        left = left.mapInArrow(_drop(docs.sparkSession.sparkContext.broadcast(block), rate, min_chars, text_col), docs.schema)
    return left


def _drop(shared, rate: float, min_chars: int, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, rate, min_chars)
        for batch in slices(batches):
            yield batch.filter(pa.array([not matcher.find(t) for t in batch.column(text_col).to_pylist()], pa.bool_()))
        del matcher
        let_go()

    return run
