"""The results table: each row once before, during and after a compaction; pages and the latest rows read only their files."""

from __future__ import annotations

from pathlib import Path

import pytest

from sentilode.sources.results import RESULT_SCHEMA, snapshot
from sentilode.streaming import table


def put(spark, path, batch, keys):
    rows = [(k, f"text {k}", "positive") for k in keys]
    spark.createDataFrame(rows, RESULT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch}")


def plain(df):
    return [(r["batch_id"], r["key"]) for r in df.select("batch_id", "key").collect()]


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("table"))
    for b in range(12):
        put(spark, where, b, [str(10 * b + k) for k in range(10)])
    put(spark, where, 12, [])
    put(spark, where, 13, ["9", "10", "x", None, "7", "7"])
    return where


def test_each_row_once_before_during_and_after(spark, path):
    want = sorted(map(repr, plain(table.read_table(spark, path))))
    assert len(want) == 126
    during = table.read_table(spark, path)  # planned before, read after
    live = table.compact(spark, path, keep=4, file_rows=40)
    assert [(m.first, m.last, m.rows) for m in live] == [(0, 9, 100)]
    for df in (during, table.read_table(spark, path)):
        assert sorted(map(repr, plain(df))) == want
    assert table.vacuum(spark, path) == 10
    assert sorted(map(repr, plain(table.read_table(spark, path)))) == want
    # The next one takes what came since; a draft that was left behind and an unfinished batch change nothing.
    (Path(path) / "_manifest" / "_draft-old").mkdir()
    (Path(path) / "batch_id=14").mkdir()
    live = table.compact(spark, path, keep=2, file_rows=40)
    assert [(m.first, m.last, m.rows) for m in live] == [(0, 9, 100), (10, 11, 20)]
    assert table.compact(spark, path, keep=2) == live  # nothing new
    table.vacuum(spark, path)
    assert sorted(map(repr, plain(table.read_table(spark, path)))) == want
    assert sorted(p.name for p in Path(path).iterdir() if p.name.startswith("batch_id")) == ["batch_id=12", "batch_id=13", "batch_id=14"]


def test_pages_join_to_the_whole_and_read_their_files(spark, path):
    table.compact(spark, path, keep=2, file_rows=40)
    whole = plain(snapshot(table.read_table(spark, path)))
    assert whole[-6:] == [(13, None), (13, "x"), (13, "7"), (13, "7"), (13, "9"), (13, "10")]
    got, after = [], None
    while rows := plain(table.page(table.read_table(spark, path).dropDuplicates(["batch_id", "key"]), 50, after)):
        got, after = got + rows, rows[-1]
    assert got == list(dict.fromkeys(whole))
    plan = table.page(table.read_table(spark, path), 5, (11, "115"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(batch_id,11)" in plan


def test_latest_reads_the_last_folders(spark, path):
    table.compact(spark, path, keep=2, file_rows=40)
    want = plain(snapshot(table.read_table(spark, path)))[::-1]
    for n in (3, 6, 7, 30, 500):
        assert plain(table.latest(spark, path, n)) == want[:n]
    few = table.latest(spark, path, 8).inputFiles()
    assert few and not any("/0-9-" in f for f in few)


def test_nothing_yet_and_two_writers(spark, tmp_path):
    where = str(tmp_path)
    assert table.read_table(spark, where).count() == table.latest(spark, where, 3).count() == 0
    assert table.compact(spark, where) == [] and table.vacuum(spark, where) == 0
    for b in range(3):
        put(spark, where, b, ["1"])
    table._publish(spark, where, 1, [])
    with pytest.raises(RuntimeError, match="another compaction"):
        table._publish(spark, where, 1, [])
    with pytest.raises(ValueError, match="keep"):
        table.compact(spark, where, keep=0)
