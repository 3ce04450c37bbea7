"""Messages, results, samples, splits and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sentilode.checks import sql as S
from sentilode.checks.registry import query
from sentilode.checks.tables import documents, load
from sentilode.functions import text as tx
from sentilode.functions.labels import recode_label, replace_label, sentiment_name
from sentilode.operators import sampling
from sentilode.operators.scale import ranked
from sentilode.session import scratch_path
from sentilode.sources import corpus, messages as msg, results as res
from sentilode.streaming import table
from sentilode.streaming.score import write_results

TEXT_KEY = "CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)"
SENTIMENT = "CASE WHEN role = 'user' THEN 'positive' ELSE 'negative' END"


def _scored_messages(spark, sf_dir) -> DataFrame:
    """Every conversation turn with a key and a prediction by its role."""
    prediction = F.when(F.col("role") == "user", 1.0).otherwise(0.0)
    return load(spark, sf_dir, "conversations").select(
        F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("key"),
        F.col("text").alias("value"),
        sentiment_name(prediction).alias("sentiment"),
    )


def _target(spark, sf_dir) -> DataFrame:
    """(doc_id, target, text): raw codes 0 and 4, null for documents without a label."""
    labels = load(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * 4).cast("int").alias("target"))
    return load(spark, sf_dir, "documents").join(labels, "doc_id", "left").select("doc_id", "target", "text")


TARGETS = (
    "targets AS (SELECT doc_id, CAST(quality * 4 AS INTEGER) AS target, text "
    "FROM documents LEFT JOIN labels USING (doc_id))"
)


@query(
    "publish_messages",
    "SELECT CAST(row_number() OVER (ORDER BY conv_id, turn) - 1 AS VARCHAR) AS key, text AS value FROM conversations",
)
def publish_messages(spark, sf_dir):
    sent = msg.messages(load(spark, sf_dir, "conversations"), ["conv_id", "turn"])
    return msg.decode(sent)


@query("decode_messages", f"SELECT {TEXT_KEY} AS key, text AS value FROM conversations")
def decode_messages(spark, sf_dir):
    scored = _scored_messages(spark, sf_dir)
    return msg.decode(scored.select(F.col("key").cast("binary"), F.col("value").cast("binary")))


@query(
    "emit_result_json",
    f"SELECT {TEXT_KEY} AS key, CAST(to_json({{'key': {TEXT_KEY}, 'value': text, "
    f"'sentiment': {SENTIMENT}}}) AS VARCHAR) AS event FROM conversations",
)
def emit_result_json(spark, sf_dir):
    return res.to_event(_scored_messages(spark, sf_dir))


@query(
    "ingest_result_json",
    f"SELECT {TEXT_KEY} AS key, text AS value, {SENTIMENT} AS sentiment FROM conversations",
)
def ingest_result_json(spark, sf_dir):
    events = res.to_event(_scored_messages(spark, sf_dir))
    return res.from_event(events.select(res.double_encode(F.col("event")).alias("event")))


@query(
    "result_snapshot",
    f"SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS num, {TEXT_KEY} AS key, text AS value, "
    f"{SENTIMENT} AS sentiment FROM conversations",
)
def result_snapshot(spark, sf_dir):
    """A conversation stands for a micro-batch, its turns for the keys in it."""
    turns = F.split("key", ":")
    arrived = _scored_messages(spark, sf_dir).select(
        "*",
        F.get(turns, F.lit(0)).cast("bigint").alias("batch_id"),
        F.get(turns, F.lit(1)).cast("bigint").alias("turn"),
    )
    return ranked(arrived, ["batch_id", "turn"], name="num").select("num", "key", "value", "sentiment")


@query(
    "result_latest",
    f"SELECT conv_id AS batch_id, {TEXT_KEY} AS key, text AS value, {SENTIMENT} AS sentiment FROM conversations "
    "ORDER BY conv_id DESC, key DESC LIMIT 100",
)
def result_latest(spark, sf_dir):
    """The latest results of the table, as the page shows them."""
    batch = F.get(F.split("key", ":"), F.lit(0)).cast("bigint")
    arrived = _scored_messages(spark, sf_dir).withColumn("batch_id", batch)
    return res.snapshot(arrived, latest=100).select("batch_id", "key", "value", "sentiment")


@query(
    "result_page",
    f"SELECT conv_id AS batch_id, {TEXT_KEY} AS key, text AS value, {SENTIMENT} AS sentiment FROM conversations "
    f"WHERE conv_id > 7 OR (conv_id = 7 AND {TEXT_KEY} > '7:0') ORDER BY conv_id, key LIMIT 100",
)
def result_page(spark, sf_dir):
    """The page of 100 results that follows a given one in order of arrival."""
    batch = F.get(F.split("key", ":"), F.lit(0)).cast("bigint")
    arrived = _scored_messages(spark, sf_dir).withColumn("batch_id", batch)
    return table.page(arrived, 100, (7, "7:0")).select("batch_id", "key", "value", "sentiment")


@query(
    "stream_table",
    "SELECT CAST(row_number() OVER (ORDER BY conv_id, turn) - 1 AS VARCHAR) AS key, text AS value, "
    "CASE WHEN contains(text, 'th') THEN 'positive' ELSE 'negative' END AS sentiment FROM conversations",
)
def stream_table(spark, sf_dir):
    """All conversations as a stream of small batches, whose folders are then merged: every result is there once."""
    where = scratch_path(spark, "stream-table")
    msg.publish(msg.messages(load(spark, sf_dir, "conversations"), ["conv_id", "turn"]), path=f"{where}/log")
    decoded = msg.decode(msg.subscribe(spark, path=f"{where}/log", files_per_trigger=4))
    scored = decoded.withColumn("sentiment", sentiment_name(F.contains("value", F.lit("th")).cast("double")))
    write_results(scored, f"{where}/results", f"{where}/progress", available_now=True).awaitTermination()
    table.compact(spark, f"{where}/results")
    table.vacuum(spark, f"{where}/results")
    return table.read_table(spark, f"{where}/results").select("key", "value", "sentiment")


@query(
    "project_labelled",
    f"WITH {TARGETS} SELECT CASE WHEN target = 4 THEN 1 ELSE 0 END AS label, text AS tweet FROM targets",
)
def project_labelled(spark, sf_dir):
    return corpus.project_labelled(_target(spark, sf_dir))


@query("filter_not_null", f"WITH {TARGETS} SELECT doc_id, target FROM targets WHERE target IS NOT NULL")
def filter_not_null(spark, sf_dir):
    return corpus.drop_missing(_target(spark, sf_dir), "target").select("doc_id", "target")


@query(
    "corpus_count",
    f"SELECT count(*) AS n FROM documents WHERE {S.clean('text')} IS NOT NULL",
)
def corpus_count(spark, sf_dir):
    docs = documents(spark, sf_dir).select(tx.clean(F.col("text")).alias("tweet"))
    return corpus.drop_missing(docs, "tweet").agg(F.count("*").alias("n"))


@query(
    "sample_fraction",
    f"SELECT event_id, event_type FROM events WHERE {S.in_fraction('event_id', 0.05)}",
)
def sample_fraction(spark, sf_dir):
    return sampling.sample_fraction(
        load(spark, sf_dir, "events").select("event_id", "event_type"), 0.05, "event_id"
    )


@query(
    "sample_n",
    "SELECT event_id, event_type FROM events ORDER BY md5(CAST(event_id AS VARCHAR)), event_id LIMIT 5000",
)
def sample_n(spark, sf_dir):
    return sampling.sample_n(load(spark, sf_dir, "events").select("event_id", "event_type"), 5000, "event_id")


def _split_sql(fraction: float) -> str:
    return (
        f"SELECT doc_id, CASE WHEN {S.in_fraction('doc_id', fraction)} THEN 'train' ELSE 'test' END AS part "
        "FROM documents"
    )


def _split(spark, sf_dir, fraction):
    train, test = sampling.split(load(spark, sf_dir, "documents").select("doc_id"), fraction, "doc_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("split_80_20", _split_sql(0.8))
def split_80_20(spark, sf_dir):
    return _split(spark, sf_dir, 0.8)


@query("split_70_30", _split_sql(0.7))
def split_70_30(spark, sf_dir):
    return _split(spark, sf_dir, 0.7)


@query(
    "sequence_key",
    "SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS VARCHAR) AS key FROM events",
)
def sequence_key(spark, sf_dir):
    return msg.sequence_key(load(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"]).drop("ts")


@query(
    "recode_label",
    f"WITH {TARGETS} SELECT doc_id, CASE WHEN target = 4 THEN 1 ELSE 0 END AS label FROM targets",
)
def recode(spark, sf_dir):
    return _target(spark, sf_dir).select("doc_id", recode_label(F.col("target")).alias("label"))


@query(
    "replace_label",
    f"WITH {TARGETS} SELECT doc_id, CASE WHEN target = 4 THEN 1 ELSE target END AS label FROM targets",
)
def replace(spark, sf_dir):
    return _target(spark, sf_dir).select("doc_id", replace_label(F.col("target")).alias("label"))


@query("encode_label", "SELECT doc_id, lang, dense_rank() OVER (ORDER BY lang) - 1 AS code FROM documents")
def encode_label(spark, sf_dir):
    return sampling.encode_labels(load(spark, sf_dir, "documents").select("doc_id", "lang"), "lang")


@query(
    "sentiment_name",
    "SELECT doc_id, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment FROM labels",
)
def sentiment(spark, sf_dir):
    prediction = F.col("quality").cast("double")
    return load(spark, sf_dir, "labels").select("doc_id", sentiment_name(prediction).alias("sentiment"))


@query(
    "fold_assign",
    f"WITH {S.LABELLED} SELECT doc_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY doc_id) - 1) % 5 "
    "AS INTEGER) AS fold FROM labelled",
)
def fold_assign(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id")
    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    return sampling.assign_folds(labels.join(docs, "doc_id"), 5, "doc_id")
