"""Files that are written from the tables and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentilode.checks.registry import query
from sentilode.checks.tables import load
from sentilode.session import scratch_path
from sentilode.sources import corpus


@query(
    "csv_line_breaks",
    "SELECT CAST(quality * 4 AS INTEGER) AS target, doc_id AS ids, lang AS date, source AS flag, "
    "'say \"' || lang || '\", ' || chr(10) || source AS user, text FROM documents LEFT JOIN labels USING (doc_id)",
)
def csv_line_breaks(spark, sf_dir):
    """All documents as a labelled CSV corpus, with line breaks, quotes and commas in its fields, read in byte ranges."""
    labels = load(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * 4).cast("int").alias("target"))
    user = F.concat(F.lit('say "'), "lang", F.lit('", \n'), "source")
    rows = load(spark, sf_dir, "documents").join(labels, "doc_id", "left").select(
        "target", F.col("doc_id").alias("ids"), F.col("lang").alias("date"), F.col("source").alias("flag"),
        user.alias("user"), "text",
    )
    path = scratch_path(spark, "corpus-csv")
    plain = {"escape": '"', "quoteAll": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.write.options(**plain).csv(path)
    return corpus.read_corpus(spark, path, multi_line=True)
