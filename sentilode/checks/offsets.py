"""Whether every message of a log is in the results once."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentilode.checks.registry import query
from sentilode.checks.tables import load
from sentilode.session import materialize, scratch_path
from sentilode.sources import messages as msg
from sentilode.streaming import ledger
from sentilode.streaming.score import write_results

PARTITIONS = 8


@query(
    "replay_audit",
    "WITH sent AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS i FROM conversations) "
    f"SELECT 'conversations' AS topic, CAST(i % {PARTITIONS} AS INTEGER) AS partition, min(i // {PARTITIONS}) AS first, "
    f"max(i // {PARTITIONS}) AS last, CAST(1 AS BIGINT) AS times, 'once' AS finding FROM sent GROUP BY i % {PARTITIONS}",
)
def replay_audit(spark, sf_dir):
    """All conversations as a stream that ends half-way and is started again when the log has grown: the ledger tells what arrived."""
    where = scratch_path(spark, "replay-audit")
    keyed = msg.messages(load(spark, sf_dir, "conversations"), ["conv_id", "turn"], null_text="")
    sent = materialize(ledger.with_offsets(keyed, "conversations", PARTITIONS), "sent")
    expected = sent.groupBy("topic", "partition").agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    half = sent.agg(F.max("offset")).first()[0] // 2
    for grown, files in ((F.col("offset") <= half, 4), (F.col("offset") > half, 16)):
        sent.filter(grown).write.mode("append").parquet(f"{where}/log")
        log = msg.subscribe(spark, path=f"{where}/log", files_per_trigger=files, schema=msg.PLACED_SCHEMA)
        results = log.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
        write_results(
            results, f"{where}/results", f"{where}/progress", available_now=True, ledger=f"{where}/ledger"
        ).awaitTermination()
    return ledger.audit(ledger.read_ledger(spark, f"{where}/ledger"), expected)


@query(
    "offset_audit",
    f"""WITH reads AS (
      SELECT CAST(event_id % {PARTITIONS} AS INTEGER) AS partition, event_id // {PARTITIONS} AS place,
        CAST(coalesce(event_type <> 'error', false) AS BIGINT) + CAST(coalesce(value > 20, false) AS BIGINT) AS times FROM events),
    islands AS (SELECT *, place - row_number() OVER (PARTITION BY partition, times ORDER BY place) AS island FROM reads)
    SELECT 'events' AS topic, partition, min(place) AS first, max(place) AS last, times,
      CASE times WHEN 0 THEN 'gap' WHEN 1 THEN 'once' ELSE 'repeated' END AS finding
    FROM islands GROUP BY partition, times, island""",
)
def offset_audit(spark, sf_dir):
    """Two batches over the events, of which the first passes over errors and the second reads those of high value again."""
    at = F.col("event_id")
    placed = load(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        F.pmod(at, F.lit(PARTITIONS)).cast("int").alias("partition"),
        F.expr(f"event_id div {PARTITIONS}").alias("offset"),
        "event_type",
        "value",
    )
    where = scratch_path(spark, "offset-audit")
    ledger.record(placed.filter(F.col("event_type") != "error"), where, 0)
    ledger.record(placed.filter(F.col("value") > 20), where, 1)
    expected = placed.groupBy("topic", "partition").agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    return ledger.audit(ledger.read_ledger(spark, where), expected)
