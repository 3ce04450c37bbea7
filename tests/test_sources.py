"""Readers, the message log and the result table."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sentilode.sources import corpus, messages as msg, results as res


def test_corpus_without_header(spark, tmp_path):
    lines = ['4,1,"Mon Apr 06",NO_QUERY,ann,"good, ""really"" good"', "0,2,x,y,bob,bad", "2,3,x,y,eve,"]
    (tmp_path / "c.csv").write_text("\n".join(lines))
    read = corpus.read_corpus(spark, str(tmp_path / "c.csv"))
    assert read.columns == ["target", "ids", "date", "flag", "user", "text"]
    got = [tuple(r) for r in corpus.project_labelled(read).collect()]
    assert got == [(1, 'good, "really" good'), (0, "bad"), (0, None)]
    assert corpus.drop_missing(corpus.project_labelled(read), "tweet").count() == 2


def test_corpus_in_latin1(spark, tmp_path):
    (tmp_path / "c.csv").write_bytes("4,1,d,f,u,café\n".encode("latin-1"))
    assert corpus.read_corpus_latin1(spark, str(tmp_path / "c.csv")).first()["text"] == "café"


def test_only_the_text_column_is_read(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,text,n\n1,"a, b",2\n2,,3\n3,c,4\n')
    read = corpus.read_messages_csv(spark, str(tmp_path / "t.csv"))
    assert [r["text"] for r in read.collect()] == ["a, b", None, "c"]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan


def test_messages_in_file_order(spark, tmp_path):
    spark.range(5000, numPartitions=4).selectExpr(
        "CASE WHEN id % 100 = 7 THEN NULL ELSE concat('m', id) END AS text"
    ).write.parquet(str(tmp_path / "in"))
    files = sorted(f.name for f in (tmp_path / "in").glob("part-*"))
    want, index = {}, 0
    for name in files:
        for row in spark.read.parquet(str(tmp_path / "in" / name)).coalesce(1).collect():
            if row["text"] is not None:
                want[str(index)] = row["text"]
            index += 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = spark.read.parquet(str(tmp_path / "in"))
        got = {r["key"]: r["value"] for r in msg.decode(msg.messages(read)).collect()}
        assert got == want
        filled = msg.decode(msg.messages(read, null_text="nan"))
        assert filled.count() == 5000 and filled.filter("value = 'nan'").count() == 50
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_messages_in_file_order(spark, tmp_path):
    (tmp_path / "t.csv").write_text("text\n" + "\n".join(f"row {i}" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        read = corpus.read_messages_csv(spark, str(tmp_path / "t.csv"))
        assert read.rdd.getNumPartitions() > 1
        got = {r["key"]: r["value"] for r in msg.decode(msg.messages(read)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(i): f"row {i}" for i in range(3000)}


def test_ordered_messages_and_nulls(spark):
    rows = spark.createDataFrame([(2, "b"), (0, "a"), (1, None)], "at int, text string")
    sent = msg.messages(rows, ["at"])
    assert dict(sent.dtypes) == {"key": "binary", "value": "binary"}
    assert {tuple(r) for r in msg.decode(sent).collect()} == {("0", "a"), ("2", "b")}
    assert msg.messages(rows, ["at"], null_text="nan").count() == 3
    null_key = spark.createDataFrame([(None, bytearray(b"x"))], msg.MESSAGE_SCHEMA)
    assert tuple(msg.decode(null_key).first()) == (None, "x")


def test_kafka_is_reached_through_the_same_functions(spark):
    """The connector is not installed here; the call must get as far as looking for it."""
    with pytest.raises(Exception, match="(?i)kafka"):
        msg.subscribe(spark, topic="t", servers="localhost:9092")
    with pytest.raises(Exception, match="(?i)kafka"):
        msg.publish(
            spark.createDataFrame([], msg.MESSAGE_SCHEMA), topic="t", servers="localhost:9092"
        )


def test_events_encoded_once_or_twice(spark):
    value = 'quote " slash \\ tab \t é 😀 \n{"e":1}'
    rows = spark.createDataFrame([("1", value, "positive")], res.RESULT_SCHEMA)
    event = res.to_event(rows)
    assert json.loads(event.first()["event"]) == {"key": "1", "value": value, "sentiment": "positive"}
    twice = event.select(res.double_encode(F.col("event")).alias("event"))
    assert json.loads(json.loads(twice.first()["event"]))["value"] == value
    for sent in (event, twice):
        assert res.from_event(sent).collect() == rows.collect()


def test_events_with_numbers(spark):
    posted = [{"key": 7, "value": 0.5, "sentiment": -1}, {"key": 1000, "value": 2, "sentiment": 9}]
    rows = spark.createDataFrame([(json.dumps(json.dumps(p)),) for p in posted], "event string")
    assert [tuple(r) for r in res.from_event(rows).collect()] == [("7", "0.5", "-1"), ("1000", "2", "9")]


def test_snapshot(spark):
    rows = [(b, str(k), "v", "positive") for b in (1, 0) for k in (10, 9, 2)]
    table = spark.createDataFrame(rows, "batch_id bigint, key string, value string, sentiment string")
    assert [(r["batch_id"], r["key"]) for r in res.snapshot(table).collect()] == [
        (0, "2"), (0, "9"), (0, "10"), (1, "2"), (1, "9"), (1, "10")
    ]
    assert [r["key"] for r in res.snapshot(table, latest=2).collect()] == ["10", "9"]


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "messages.csv").write_text('id,text\n1,"two\nlines"\n2,"a ""b"", c"\n3,\n')
    read = corpus.read_messages_csv(spark, str(tmp_path / "messages.csv"), multi_line=True)
    assert [r["text"] for r in read.collect()] == ["two\nlines", 'a "b", c', None]
    numbered = sorted((r["key"], r["value"]) for r in msg.decode(msg.messages(read.withColumn("id", F.monotonically_increasing_id()), ["id"])).collect())
    assert numbered[0] == ("0", "two\nlines") and numbered[1] == ("1", 'a "b", c')
    (tmp_path / "corpus.csv").write_text('4,1,d,f,u,"caf\u00e9\nnoir"\n0,2,d,f,u,plain\n', encoding="latin-1")
    rows = corpus.project_labelled(corpus.read_corpus_latin1(spark, str(tmp_path / "corpus.csv"), multi_line=True))
    assert [tuple(r) for r in rows.collect()] == [(1, "caf\u00e9\nnoir"), (0, "plain")]
