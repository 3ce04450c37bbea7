"""Records cut from byte ranges are those of a reader that takes the file whole."""

from __future__ import annotations

import csv
import io
import random

import duckdb
import pytest
from hypothesis import given, settings, strategies as st

from sentilode.sources import corpus, quoted

SCHEMA = "a string, b string, c string"


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of a few dozen bytes."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64b")
    yield spark
    spark.conf.set(key, before)


def field(rng):
    kinds = ["plain", "with, comma", "line\nbreak", 'a "quoted" word', "\n\n", 'ends with "', "", "é ñ", "crlf\r\ninside", '"', ",\n,"]
    return "".join(rng.choice(kinds) for _ in range(rng.randrange(3)))


def write(path, rows, end="\n", quoting=csv.QUOTE_ALL, encoding="utf-8", header=None):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=quoting)
    if header:
        writer.writerow(header)
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode(encoding))


def rows_of(df):
    return sorted(map(lambda r: tuple(x or "" for x in r), df.collect()))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("quoting", [csv.QUOTE_ALL, csv.QUOTE_MINIMAL])
def test_same_as_the_file_read_whole(small_ranges, tmp_path, end, quoting):
    rng = random.Random(7)
    rows = [(f"k{k}", field(rng), field(rng)) for k in range(90)]
    for part in range(3):
        write(tmp_path / f"{part}.csv", rows[part::3], end, quoting)
    found = quoted.read_csv(small_ranges, str(tmp_path), SCHEMA)
    assert small_ranges.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert rows_of(found) == sorted(rows)
    whole = small_ranges.read.schema(SCHEMA).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
    # Of mixed line breaks Spark's own reader takes one kind for all.
    plain = lambda rows: [tuple(x.replace("\r\n", "\n") for x in r) for r in rows]
    if end == "\n":
        assert plain(rows_of(found)) == plain(rows_of(whole))


def test_same_as_duckdb(small_ranges, tmp_path):
    rng = random.Random(8)
    rows = [(f"k{k}", field(rng).replace("\r", ""), "x") for k in range(60)]
    write(tmp_path / "t.csv", rows)
    want = duckdb.sql(f"SELECT * FROM read_csv('{tmp_path}/t.csv', header=false, quote='\"', escape='\"', all_varchar=true)")
    assert rows_of(quoted.read_csv(small_ranges, str(tmp_path), SCHEMA)) == sorted(tuple(x or "" for x in r) for r in want.fetchall())


def test_quotes_inside_plain_fields_are_characters(small_ranges, tmp_path):
    text = 'k1,5" disk,x\nk2,say "hi, there\nk3,"a ""b""\nc",y"\nk4,"tail" end,z\n\nk5,,\n'
    (tmp_path / "t.csv").write_text(text)
    found = quoted.read_records(small_ranges, str(tmp_path)).orderBy("block", "place")
    assert [r["record"] for r in found.collect()] == [
        'k1,5" disk,x', 'k2,say "hi, there', 'k3,"a ""b""\nc",y"', 'k4,"tail" end,z', "k5,,"
    ]


def test_quote_never_closed(small_ranges, tmp_path):
    (tmp_path / "t.csv").write_text('a,b,c\nd,"open,' + "\nmore lines here" * 20)
    found = [r["record"] for r in quoted.read_records(small_ranges, str(tmp_path)).orderBy("block").collect()]
    assert found == ["a,b,c", 'd,"open,' + "\nmore lines here" * 20]


def test_record_over_many_ranges(small_ranges, tmp_path):
    long = "\n".join(f"line {k}, and \"more\"" for k in range(60))
    rows = [("a", long, "b"), ("c", "d", long), ("e", "", "")]
    write(tmp_path / "t.csv", rows)
    assert rows_of(quoted.read_csv(small_ranges, str(tmp_path), SCHEMA)) == sorted(rows)


def test_corpus_in_latin_1(small_ranges, tmp_path):
    rows = [(4 * (k % 2), k, "day", "NO", "me", f"première\nligne \"{k}\", é") for k in range(60)]
    write(tmp_path / "c.csv", rows, encoding="latin-1")
    found = corpus.read_corpus_latin1(small_ranges, str(tmp_path), multi_line=True)
    assert found.dtypes[0] == ("target", "int") and found.dtypes[1] == ("ids", "bigint")
    assert sorted(map(tuple, found.collect())) == sorted(rows)


def test_messages_with_header(small_ranges, tmp_path):
    for part in range(2):
        rows = [(k, f"text\n{k}", "z") for k in range(part, 50, 2)]
        write(tmp_path / f"{part}.csv", rows, header=["id", "the\ntext", "other"])
    found = corpus.read_messages_csv(small_ranges, str(tmp_path), column="the\ntext", multi_line=True)
    assert sorted(r[0] for r in found.collect()) == sorted(f"text\n{k}" for k in range(50))


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "t.csv").write_text("\n\n")
    assert quoted.read_csv(spark, str(tmp_path), SCHEMA).count() == 0
    with pytest.raises(ValueError):
        quoted.read_csv(spark, str(tmp_path))
    with pytest.raises(ValueError):
        quoted.read_records(spark, str(tmp_path), encoding="UTF-16LE")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text('a,"\n', max_size=12), max_size=6), st.integers(1, 5))
def test_lines_in_any_parts(fields, step):
    """The state after a record's lines is outside, and inside before its last line."""
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL).writerow(fields or ["x"])
    lines = out.getvalue()[:-1].encode().split(b"\n")
    quotes, inside, states = quoted.Quotes(",", '"'), False, []
    for line in lines:
        inside = quotes.after(line, inside)
        states.append(inside)
    assert states == [True] * (len(lines) - 1) + [False]


def test_states_at_begins(spark):
    """Ranges that keep, turn round or fix the state, in all orders of four."""
    kinds = {"keep": (False, True), "turn": (True, False), "out": (False, False), "in": (True, True)}
    rows, want = [], {}
    for n, names in enumerate([(a, b, c, d) for a in kinds for b in kinds for c in kinds for d in kinds]):
        state = False
        for block, name in enumerate(names):
            want[str(n), block] = state
            rows.append((str(n), block, *kinds[name]))
            state = kinds[name][state]
    ends = spark.createDataFrame(rows, "file string, block bigint, from_outside boolean, from_inside boolean")
    assert {(r["file"], r["block"]): r["inside"] for r in quoted.begin_states(ends).collect()} == want
