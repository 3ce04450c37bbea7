"""Token ids in ORC files: run-length coded stripes, row indexes, Bloom filters on document ids."""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sentilode.llm.common import joined, let_go, slices, text_parts, texts
from sentilode.session import materialize, scratch_path

# Fixed value: the id that ends a document.
END_ID = 2
# A worker forgets the words it has seen when it knows this many.
CACHE_WORDS = 500_000
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
# White space as the tokenizer's own pattern has it.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Latin letters, and pieces for which no shorter way is safe.
_LETTER = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_ODD = f"^[{_SPACE}]|[{_SPACE}]$|^$|[^\\x00-\u024f]"
_PARTS = f"^(?P<head> ?[{_LETTER}]+|)(?P<tail>(?s:.*))$"
# Fixed value: the pattern of words in public byte-level vocabularies of this kind.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts, found once per distinct word.

    Byte-level BPE works within the words that the tokenizer's pattern cuts a text into, and such a word never
    crosses a space that has no white space beside it: the space begins a new word. So a text is cut before each such
    space; of each distinct piece the letters that it begins with are a word of their own, and what follows is cut by the same
    pattern. Each distinct word is encoded once. Texts with a piece that is empty, has white space at an end, or has characters
    beyond Latin, for which two libraries may know different letters, go to the tokenizer as they are, and so do texts with the
    literal of an added token such as `<|endoftext|>`, which then gets that token's id as the library has it.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task per core already
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.word_tokenizer = Tokenizer.from_file(path)
        self.word_tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = regex.compile(WORD_PATTERN).findall
        self.known: dict[str, bytes] = {}

    def words(self, found: list[str]) -> list[bytes]:
        """The ids of each word, as bytes of 32-bit integers."""
        known = self.known
        new = [w for w in found if w not in known]
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = found
        for k in range(0, len(new), 20_000):
            block = new[k:k + 20_000]
            encoded = self.word_tokenizer.encode_batch(block, add_special_tokens=False)
            known.update((w, array("i", e.ids).tobytes()) for w, e in zip(block, encoded))
        return [known[w] for w in found]

    def tails(self, found: list[str]) -> list[bytes]:
        """The ids of each string that begins a word but with no letter."""
        cut = [self.cut(x) for x in found]
        ids = dict(zip(every := list({w for own in cut for w in own}), self.words(every)))
        return [b"".join([ids[w] for w in own]) for own in cut]

    def parts(self, pieces: pa.Array) -> tuple[np.ndarray, list[bytes]]:
        """(codes of the two parts of each piece, ids of each code)."""
        split = pc.extract_regex(pieces, _PARTS)
        heads, tails = (split.field(k).dictionary_encode() for k in (0, 1))
        ids = self.words(heads.dictionary.to_pylist())
        n = len(ids)
        ids += self.tails(tails.dictionary.to_pylist())
        codes = np.stack([heads.indices.to_numpy(), tails.indices.to_numpy() + n], axis=1).astype(np.int32)
        return codes, ids

    def encode(self, column: pa.Array) -> pa.ListArray:
        """One list of ids per text, END_ID last; a null counts as empty."""
        column = pc.fill_null(column, "").cast(pa.large_string())
        split = pc.split_pattern(column, " ")
        offsets = split.offsets.to_numpy()
        offsets = offsets - offsets[0]
        n_texts = len(column)
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        odd = pc.match_substring_regex(coded.dictionary, _ODD).to_numpy(zero_copy_only=False)
        odd_before = np.concatenate([[0], np.cumsum(odd[codes])])
        odd_text = odd_before[offsets[1:]] > odd_before[offsets[:-1]]
        for literal in self.added:
            odd_text |= pc.match_substring(column, literal).to_numpy(zero_copy_only=False)
        # Code 0 to n-1: a piece after a space; n to 2n-1: the same piece at the start of a text.
        n = len(odd)
        codes[offsets[:-1]] += n
        in_odd = np.repeat(odd_text, np.diff(offsets))
        codes = codes[~in_odd]
        used = np.zeros(2 * n, bool)
        used[codes] = True
        wanted = np.flatnonzero(used)
        place = np.zeros(2 * n, np.int32)
        place[wanted] = np.arange(len(wanted))
        none, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        later = pc.binary_join_element_wise(none, coded.dictionary.take(pa.array(wanted[wanted < n])), space)
        parts, ids = self.parts(pa.concat_arrays([later, coded.dictionary.take(pa.array(wanted[wanted >= n] - n))]))
        # The last code is the end of a text.
        sizes = np.array([len(x) >> 2 for x in ids] + [1], np.int64)
        flat = np.frombuffer(b"".join([*ids, np.int32(END_ID).tobytes()]), np.int32)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        owner = np.repeat(np.arange(n_texts), np.diff(offsets))[~in_odd]
        both = np.concatenate([parts[place[codes]].reshape(-1), np.full(n_texts, len(ids), np.int32)])
        whose = np.concatenate([np.repeat(owner, 2), np.arange(n_texts)])
        some = sizes[both] > 0
        some[-n_texts:] = ~odd_text
        both, whose = both[some], whose[some]
        order = np.argsort(whose, kind="stable")
        both, whose = both[order], whose[order]
        lengths = sizes[both]
        take = np.arange(int(lengths.sum())) + np.repeat(starts[both] - (np.cumsum(lengths) - lengths), lengths)
        values = flat[take]
        per_text = np.bincount(whose, weights=lengths, minlength=n_texts).astype(np.int64)
        if odd_text.any():
            at = np.flatnonzero(odd_text)
            whole = [e.ids for e in self.tokenizer.encode_batch([column[int(i)].as_py() for i in at], add_special_tokens=False)]
            per_text[at] = [len(x) + 1 for x in whole]
            bounds = np.concatenate([[0], np.cumsum(per_text)])
            out = np.empty(bounds[-1], np.int32)
            out[np.repeat(~odd_text, per_text)] = values
            for i, x in zip(at, whole):
                out[bounds[i]:bounds[i + 1]] = [*x, END_ID]
            values = out
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))


def encoder(path: str) -> Encoder:
    """The encoder of one vocabulary file; loaded once per worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _encode(path: str, keep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(joined(batches), 6 << 20):
            ids = encoder(path).encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])
        if not keep:
            _encoders.clear()
            let_go()

    return run


def in_order(rows: DataFrame, parts: int) -> DataFrame:
    """(doc_id, text) in ranges of ids; the rows of an id are in order of a digest and can be in several ranges."""
    order = ("doc_id", "digest")
    placed = rows.withColumn("digest", F.xxhash64("text"))
    return placed.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text").drop("digest")


def write_tokens(
    docs: DataFrame, tokenizer_path: str, out: str, id_col: str = "doc_id", text_col: str = "text", keep: bool = True
) -> None:
    """Encode every whole text and write (doc_id, ids) as ORC in ascending id order.

    The texts are dealt out by ranges of ids and a digest of the text, which splits an id with many rows, encoded, and written one
    file per range, in order of the numbers in file names. Integers are run-length coded, each stripe has row indexes and a Bloom filter on doc_id.
    A null text is empty and has the end id alone; null ids come first; repeated rows are written
    each, in order of the digest; an empty table gives files without rows. Other columns are ignored.
    `keep` leaves the vocabulary and the words met so far in the workers for their next tasks; without it each task loads them, and
    gives the memory back for what the workers do next.
    `tokenizer_path` must be readable by all executors. What lies at `out` is replaced.
    """
    rows = texts(docs, id_col, text_col)
    encoded = in_order(rows, text_parts(rows, 16 << 20)).mapInArrow(_encode(tokenizer_path, keep), "doc_id bigint, ids array<int>")
    encoded.write.mode("overwrite").options(**ORC_OPTIONS).orc(out)


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """(doc_id, ids); `where` on doc_id is pushed down to stripe statistics and Bloom filters."""
    rows = spark.read.schema("doc_id bigint, ids array<int>").orc(path)
    return rows if where is None else rows.filter(where)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[tuple[str, int], int] = {}
    for batch in slices(batches):
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy()
        values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4"))
        crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets, offsets[1:])]
        places = []
        for split in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()):
            seen[split] = seen.get(split, -1) + 1
            places.append(seen[split])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("file"), batch.column("block"), pa.array(places, pa.int64()), batch.column("doc_id"),
                pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64()),
            ],
            ["file", "block", "place", "doc_id", "n_tokens", "ids_crc32"],
        )


def index_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files alone.

    `start` counts the ids of all documents before it. A file is read in stripes by many tasks; the rows
    of a split come in file order, so a document's place is file, split and place in the split. Totals are
    first summed per split (one row each), and then within a split, so no window holds more than one. Files are in order of
    their part number, since names of more than 100 000 parts do not sort by it.
    """
    rows = read_tokens(spark, path).select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "doc_id",
        "ids",
    )
    schema = "file string, block bigint, place bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
    measured = materialize(rows.mapInArrow(_measure, schema), "token-index")
    number = F.regexp_extract("_f", r"^part-(\d+)", 1).cast("bigint")
    earlier = Window.orderBy(number, "_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        measured.groupBy(F.col("file").alias("_f"), F.col("block").alias("_b"))
        .agg(F.sum("n_tokens").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    )
    inside = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    same = (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b"))
    return (
        measured.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(splits, same)
        .select("doc_id", (F.col("_before") + F.col("_inside")).alias("start"), "n_tokens", "ids_crc32")
    )


def round_trip(docs: DataFrame, tokenizer_path: str, out: str | None = None, keep: bool = True) -> DataFrame:
    """Write the documents' ids to `out` (by default a new folder in the shared one) and index what the files hold."""
    spark = docs.sparkSession
    out = out or scratch_path(spark, "token-files")
    write_tokens(docs, tokenizer_path, out, keep=keep)
    return index_documents(spark, out)
