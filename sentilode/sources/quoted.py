"""CSV records with line breaks inside quotes, cut out of a file's byte ranges by all cores.

A byte range does not know whether it begins inside quotes. So each range is first read for both cases: what state does it
end in if it begins outside, and if it begins inside? These small functions are put together in the order of the
ranges, which gives the state at the begin of each, and a second pass cuts the records. Parts of a record that crosses
ranges are few and are put together by a group-by.
"""

from __future__ import annotations

import codecs
import csv
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sentilode.operators.scale import BROADCAST_BYTES, measured_bytes
from sentilode.session import materialize

# Parts of a range: what goes on from the range before, a record, what the next range goes on with.
HEAD, WHOLE, OPEN, MIDDLE = 0, 1, 2, 3
BATCH_BYTES = 4 << 20

Batches = Iterator[pa.RecordBatch]
Range = tuple[str, int]


class Quotes:
    """How a line changes the state: is the end of the line inside quotes?

    Quotes are quotes at the begin of a field only; inside, two of them stand for one. Elsewhere they are characters.
    """

    def __init__(self, separator: str, quote: str) -> None:
        self.quote = quote.encode()
        q, s = re.escape(self.quote), re.escape(separator.encode())
        inside = rb"(?:[^%b]|%b%b)*+%b" % (q, q, q, q)
        rest = rb"[^%b]*+" % s
        field = rb"(?:%b%b%b|[^%b%b]%b|)" % (q, inside, rest, q, s, rest)
        self.closed = re.compile(rb"%b(?:%b%b)*" % (field, s, field), re.DOTALL).fullmatch
        self.closes = re.compile(rb"%b%b(?:%b%b)*" % (inside, rest, s, field), re.DOTALL).fullmatch

    def after(self, line: bytes, inside: bool) -> bool:
        if self.quote not in line:
            return inside
        return not (self.closes if inside else self.closed)(line)


def _ranges(batches: Batches) -> Iterator[tuple[Range, list[bytes], dict]]:
    """(range, its lines in a row, the other values of its first line) per batch and range."""
    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        lines = batch.column("line").to_pylist()
        begin = 0
        for k in range(1, len(lines) + 1):
            if k == len(lines) or (files[k], blocks[k]) != (files[begin], blocks[begin]):
                more = {name: batch.column(name)[begin].as_py() for name in batch.schema.names if name not in ("file", "block", "line")}
                yield (files[begin], blocks[begin]), lines[begin:k], more
                begin = k


def _ends(separator: str, quote: str) -> Callable[[Batches], Batches]:
    """(file, block, from_outside, from_inside): the state at the end of a range for both states at its begin."""

    def run(batches: Batches) -> Batches:
        quotes = Quotes(separator, quote)
        state: dict[Range, tuple[bool, bool]] = {}
        for at, lines, _ in _ranges(batches):
            outside, inside = state.get(at, (False, True))
            for line in lines:
                if outside == inside:
                    outside = inside = quotes.after(line, outside)
                else:
                    outside, inside = quotes.after(line, outside), quotes.after(line, inside)
            state[at] = outside, inside
        rows = [(*at, *ends) for at, ends in state.items()]
        columns = zip(*rows) if rows else [[]] * 4
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], ["file", "block", "from_outside", "from_inside"]
        )

    return run


def begin_states(ends: DataFrame) -> DataFrame:
    """(file, block, inside): is the begin of each range inside quotes?

    A range either fixes the state at its end, keeps it or turns it round. So the state is that of the last range that fixed it,
    turned round as often as ranges since then do. The windows hold one row per range of a file.
    """
    fixes = F.col("from_outside") == F.col("from_inside")
    turns = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = ends.withColumn("turned", F.sum(turns).over(upto)).withColumn(
        "fixed", F.when(fixes, F.struct(F.col("from_outside").cast("int").alias("state"), "turned"))
    )
    last = F.last("fixed", ignorenulls=True).over(earlier)
    turned = F.coalesce(F.lag("turned").over(Window.partitionBy("file").orderBy("block")), F.lit(0))
    state = F.coalesce(last["state"], F.lit(0)) + turned - F.coalesce(last["turned"], F.lit(0))
    return rows.select("file", "block", (state % 2 == 1).alias("inside"))


def _cut(separator: str, quote: str) -> Callable[[Batches], Batches]:
    """(file, block, place, kind, record): records of a range in order, and its parts of records that cross its ends."""

    def run(batches: Batches) -> Batches:
        quotes = Quotes(separator, quote)
        at = None
        held: list[bytes] = []
        inside = entered = False
        place = 0
        out: list[tuple] = []

        def part(ends: bool) -> tuple:
            kind = (HEAD if entered else WHOLE) if ends else (MIDDLE if entered else OPEN)
            return (*at, place, kind, b"\n".join(held))

        def rows() -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            columns = zip(*out) if out else [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["file", "block", "place", "kind", "record"]
            )

        size = 0
        for here, lines, more in _ranges(batches):
            if here != at:
                if held:
                    out.append(part(False))
                at, held, place = here, [], 0
                inside = entered = more["inside"]
            for line in lines:
                held.append(line)
                inside = quotes.after(line, inside)
                if not inside:
                    out.append(part(True))
                    size += sum(map(len, held))
                    held, entered, place = [], False, place + 1
                    if size > BATCH_BYTES:
                        yield rows()
                        out.clear()
                        size = 0
        if held:
            out.append(part(False))
        yield rows()

    return run


def _whole(parts: DataFrame) -> DataFrame:
    """Records from their parts: each OPEN one and what follows up to the HEAD that ends it."""
    order = Window.partitionBy("file").orderBy("block", "place")
    # Two rows per range at most.
    numbered = parts.withColumn("number", F.sum((F.col("kind") == OPEN).cast("int")).over(order))
    pieces = F.array_sort(F.collect_list(F.struct("block", "place", "record")))
    joined = numbered.groupBy("file", "number").agg(pieces.alias("pieces"))
    first = F.get("pieces", F.lit(0))
    text = F.aggregate(
        F.slice(F.col("pieces"), F.lit(2), F.size("pieces")), first["record"],
        lambda text, piece: F.concat(text, F.lit(b"\n"), piece["record"]),
    )
    return joined.select("file", first["block"].alias("block"), first["place"].alias("place"), text.alias("record"))


def read_records(
    spark: SparkSession, path: str, encoding: str = "UTF-8", separator: str = ",", quote: str = '"'
) -> DataFrame:
    """(file, block, place, record): the records of CSV files in byte ranges of spark.sql.files.maxPartitionBytes.

    (block, place) is the order of a file's records. Empty lines between records are no records; the line break that ends a
    record is not in it, and one inside quotes stays as it is. A quote that is never closed makes the
    rest of its file one record. Lines are read twice and never shuffled. The encoding must have the separator, quotes and line breaks as single bytes, as
    ASCII has them.
    """
    if any(c.encode(encoding) != c.encode("ascii") for c in (separator, quote, "\n")) or "16" in codecs.lookup(encoding).name:
        raise ValueError(f"records cannot be cut from bytes in {encoding}: read the files with multi_line")
    lines = (
        spark.read.option("lineSep", "\n").text(path)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("line"),
        )
    )
    ends = lines.mapInArrow(_ends(separator, quote), "file string, block bigint, from_outside boolean, from_inside boolean")
    states = materialize(begin_states(materialize(ends, "csv-ranges")), "csv-states")
    # One row per range, so far below the bound for any file that fits into a file system; measured all the same.
    small = measured_bytes(states) <= BROADCAST_BYTES
    if not small:
        raise ValueError("the files have more ranges than can be looked up; raise spark.sql.files.maxPartitionBytes")
    known = lines.join(F.broadcast(states), ["file", "block"])
    cut = known.mapInArrow(_cut(separator, quote), "file string, block bigint, place bigint, kind int, record binary")
    whole = F.col("kind") == WHOLE
    parts = materialize(cut.filter(~whole), "csv-parts")
    records = cut.filter(whole).drop("kind").unionByName(_whole(parts))
    ended = F.when(F.endswith("record", F.lit(b"\r")), F.expr("substring(record, 1, length(record) - 1)")).otherwise(F.col("record"))
    utf8 = codecs.lookup(encoding).name == "utf-8"
    text = ended.cast("string") if utf8 else F.decode(ended, encoding)
    return records.select("file", "block", "place", text.alias("record")).filter(F.length("record") > 0)


def parsed(record: Column, schema: str, separator: str = ",", quote: str = '"') -> Column:
    """The fields of a record as a struct."""
    options = {"sep": separator, "quote": quote, "escape": quote, "multiLine": "true"}
    return F.from_csv(record, F.lit(schema), options)


def read_csv(
    spark: SparkSession, path: str, schema: str | None = None, encoding: str = "UTF-8", separator: str = ",", quote: str = '"'
) -> DataFrame:
    """The rows of CSV files. Without a schema each file's first record is a header, and the columns are text with the names of the first file's."""
    records = read_records(spark, path, encoding, separator, quote)
    if schema is None:
        # One row per file.
        first = records.groupBy("file").agg(F.min(F.struct("block", "place")).alias("first"))
        first = materialize(first, "csv-headers")
        name = records.join(first, "file").filter(F.struct("block", "place") == F.col("first")).orderBy("file").select("record").first()
        if name is None:
            raise ValueError(f"no header in {path}")
        columns = next(csv.reader(name[0].splitlines(keepends=True), delimiter=separator, quotechar=quote))
        quoted = ["`" + c.replace("`", "``") + "`" for c in columns]
        schema = ", ".join(f"{c} string" for c in quoted)
        records = records.join(first, "file").filter(F.struct("block", "place") != F.col("first"))
    return records.select(parsed(F.col("record"), schema, separator, quote).alias("row")).select("row.*")
