"""Score a message stream with the pipeline that training saved."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from sentilode.functions.labels import sentiment_name
from sentilode.session import passing_tables
from sentilode.sources.messages import decode
from sentilode.streaming.ledger import record


def score(model: PipelineModel, messages: DataFrame, text_column: str = "text") -> DataFrame:
    """(key, value, sentiment) for a batch or a stream of messages, as one plan.

    The original text goes to the output; the model works on a copy. A message
    without text has no sentiment.
    """
    decoded = decode(messages).withColumn(text_column, F.coalesce("value", F.lit("")))
    sentiment = F.when(F.col("value").isNotNull(), sentiment_name(F.col("prediction")))
    return model.transform(decoded).select("key", "value", sentiment.alias("sentiment"))


def write_scored(
    model: PipelineModel,
    messages: DataFrame,
    path: str,
    checkpoint: str,
    text_column: str = "text",
    available_now: bool = False,
    every: str = "5 seconds",
) -> StreamingQuery:
    """Score a stream batch by batch into a table; the stages may join a batch with tables of any size.

    What the stages write for a batch is removed when the batch is done.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with passing_tables(batch.sparkSession):
            score(model, batch, text_column).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _started(writer, available_now, every)


def _started(writer, available_now: bool, every: str) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def write_results(
    results: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    every: str = "5 seconds",
    ledger: str | None = None,
) -> StreamingQuery:
    """Keep results in a table by micro-batch.

    A batch owns the folder of its id and overwrites it, so a batch that is
    run again after a failure leaves no duplicates. With a `ledger` the results must
    keep topic, partition and offset; what a batch has written is read back and noted there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        if ledger is not None:
            record(batch.sparkSession.read.schema(batch.schema).parquet(folder), ledger, batch_id)

    writer = results.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _started(writer, available_now, every)


def append_files(
    rows: DataFrame, path: str, checkpoint: str, available_now: bool = False, every: str = "5 seconds"
) -> StreamingQuery:
    """Append to Parquet files through Spark's own exactly-once file sink."""
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return _started(writer, available_now, every)


def to_console(messages: DataFrame, available_now: bool = False, every: str = "5 seconds") -> StreamingQuery:
    """Print the decoded messages."""
    writer = decode(messages).writeStream.format("console").outputMode("append")
    return _started(writer, available_now, every)
