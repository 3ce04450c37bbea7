"""The offset ledger: stretches against a count per offset, restarts, lost progress, and blocks."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sentilode.sources import messages as msg
from sentilode.streaming import ledger
from sentilode.streaming.score import write_results

PLACED = "topic string, partition int, offset bigint"


def stretches(times: dict[int, int]) -> list[tuple[int, int, int]]:
    """Maximal (first, last, times) of equal counts, one offset after the other."""
    out: list[tuple[int, int, int]] = []
    for at in sorted(times):
        if out and out[-1][1] == at - 1 and out[-1][2] == times[at]:
            out[-1] = (out[-1][0], at, times[at])
        else:
            out.append((at, at, times[at]))
    return out


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("bits", [1, 3, 20])
def test_like_a_count_per_offset(spark, tmp_path, monkeypatch, bits):
    """Two batches with gaps, repeats within a batch and across; blocks of 2, 8 and a million offsets give the same."""
    monkeypatch.setattr(ledger, "BLOCK_BITS", bits)
    rng = random.Random(7)
    reads = [("a", p, rng.randrange(60)) for p in (0, 1) for _ in range(70)] + [("b", 0, n) for n in range(40)]
    cut = len(reads) // 2
    for batch, part in enumerate((reads[:cut], reads[cut:])):
        ledger.record(spark.createDataFrame(part, PLACED), str(tmp_path / "ledger"), batch)
    expected = [("a", 0, 5, 70), ("a", 1, 0, 59), ("b", 0, 0, 39), ("b", 1, 3, 9), ("c", 0, 0, -1)]
    want = []
    for topic, partition, first, last in expected:
        seen = Counter(n for t, p, n in reads if (t, p) == (topic, partition))
        owed = set(range(first, last + 1))
        for inside in (True, False):
            where = {n: seen[n] for n in owed | set(seen) if (n in owed) is inside}
            for a, b, times in stretches(where):
                finding = "unexpected" if not inside else {0: "gap", 1: "once"}.get(times, "repeated")
                want.append((topic, partition, a, b, times, finding))
    found = ledger.audit(
        ledger.read_ledger(spark, str(tmp_path / "ledger")),
        spark.createDataFrame(expected, "topic string, partition int, first bigint, last bigint"),
    )
    assert rows(found) == sorted(want)


def test_without_expected_offsets_and_rows_without_a_place(spark):
    reads = [("a", 0, 3), ("a", 0, 4), ("a", 0, 9), (None, 0, 5), ("a", None, 6), ("a", 0, None)]
    found = ledger.intervals(spark.createDataFrame(reads, PLACED))
    assert rows(found) == [("a", 0, 3, 4, 1), ("a", 0, 9, 9, 1)]
    assert [(r[2], r[3], r[5]) for r in rows(ledger.audit(found))] == [(3, 4, "once"), (5, 8, "gap"), (9, 9, "once")]
    assert ledger.audit(ledger.intervals(spark.createDataFrame([], PLACED))).count() == 0


def run(spark, where, progress, files):
    log = msg.subscribe(spark, path=f"{where}/log", files_per_trigger=files, schema=msg.PLACED_SCHEMA)
    results = log.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
    write_results(
        results, f"{where}/results", f"{where}/{progress}", available_now=True, ledger=f"{where}/ledger"
    ).awaitTermination()


def publish(spark, where, keys):
    keyed = spark.createDataFrame([(str(k).encode(), b"text") for k in keys], msg.MESSAGE_SCHEMA)
    ledger.with_offsets(keyed, "t", 2).coalesce(1).write.mode("append").parquet(f"{where}/log")


def test_restart_reads_once_and_lost_progress_is_found(spark, tmp_path):
    where = str(tmp_path)
    for start in range(0, 40, 10):
        publish(spark, where, range(start, start + 10))
    run(spark, where, "progress", 1)
    publish(spark, where, range(40, 50))
    run(spark, where, "progress", 1)  # goes on where it ended
    once = [("t", p, 0, 24, 1, "once") for p in (0, 1)]
    assert rows(ledger.audit(ledger.read_ledger(spark, f"{where}/ledger"))) == once
    # Without its progress the stream begins anew with other batches: batch 0 has all rows, batches 1 to 4 are still there.
    run(spark, where, "progress-2", 100)
    found = rows(ledger.audit(ledger.read_ledger(spark, f"{where}/ledger")))
    assert {f[5] for f in found} == {"once", "repeated"}
    assert sum((last - first + 1) * times for _, _, first, last, times, _ in found) == spark.read.parquet(f"{where}/results").count() == 90
