"""Token files against the tokenizer itself, and the edge cases."""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sentilode.llm import tokens
from sentilode.llm.queries import public_vocabulary
from tokenizers import Tokenizer


@cache
def tokenizer():
    return Tokenizer.from_file(public_vocabulary())


@pytest.fixture(scope="module")
def plain():
    return lambda text: [*tokenizer().encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab.'s 1\n\té\xa0　<|endoftext|>😀", max_size=25), min_size=1, max_size=6))
def test_same_ids(texts):
    want = [[*tokenizer().encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert tokens.encoder(public_vocabulary()).encode(pa.array(texts)).to_pylist() == want


def test_round_trip(spark, make_docs, plain, tmp_path):
    rows = [(7, "The end."), (3, None), (3, ""), (None, "no id"), (9, "a  b \n c"), (1, "word " * 50_000), (7, "The end."), (8, "<|endoftext|>")]
    out = str(tmp_path / "ids")
    found = tokens.round_trip(make_docs(rows), public_vocabulary(), out).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for doc_id, text in ordered:
        ids = plain(text)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in found), key=key) == want
    one = tokens.read_tokens(spark, out, F.col("doc_id") == 9)
    assert one.first()["ids"] == plain("a  b \n c")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,9)]" in one._jdf.queryExecution().toString()


def test_literal_of_an_added_token(plain):
    ids = tokens.encoder(public_vocabulary()).encode(pa.array(["a<|endoftext|>b", "a<|endoftext|", "plain"])).to_pylist()
    assert ids == [plain(t) for t in ("a<|endoftext|>b", "a<|endoftext|", "plain")]
    assert 50256 in ids[0] and 50256 not in ids[1]


def test_forgotten_words_change_nothing(plain, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    encode = tokens.Encoder(public_vocabulary()).encode
    for texts in (["one two, three"], ["four one five!", "two two"], ["three\none"]):
        assert encode(pa.array(texts)).to_pylist() == [plain(t) for t in texts]


def test_files_above_five_digits(spark, tmp_path):
    """Parts are in order of their number; names of more digits sort before."""
    for k, part in enumerate(["part-99999", "part-100000", "part-100001"]):
        rows = spark.createDataFrame([(k, [k] * (k + 1))], "doc_id bigint, ids array<int>").coalesce(1)
        rows.write.mode("append").orc(str(tmp_path / "x" / part))
        (file,) = (tmp_path / "x" / part).glob("part-*.orc")
        (tmp_path / "out").mkdir(exist_ok=True)
        (tmp_path / "out" / f"{part}-x.orc").write_bytes(file.read_bytes())
    found = tokens.index_documents(spark, str(tmp_path / "out")).orderBy("doc_id").collect()
    assert [r["start"] for r in found] == [0, 1, 3]


def test_lookup_reads_one_row_group(spark, tmp_path):
    docs = spark.range(5000).selectExpr("id as doc_id", "concat('text ', id) as text").coalesce(1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1g")
    out = str(tmp_path / "ids")
    tokens.write_tokens(docs, public_vocabulary(), out)
    one = tokens.read_tokens(spark, out, F.col("doc_id") == 4321)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert one.count() == 1
    plan = one.groupBy().count()
    plan.collect()
    leaves = plan._jdf.queryExecution().executedPlan().collectLeaves()
    read = sum(
        leaf.metrics().apply("numOutputRows").value()
        for leaf in [leaves.apply(k) for k in range(leaves.size())] if leaf.metrics().contains("numOutputRows")
    )
    assert read <= 1000


def test_hot_id_is_split(spark):
    """A third of the rows under one id, and another under none, do not go to one part."""
    rows = spark.range(3000).selectExpr("case id % 3 when 0 then null when 1 then 7 else id end as doc_id", "concat('t', id) as text")
    placed = tokens.in_order(rows, 8)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 700


def test_empty_table(spark, make_docs, tmp_path):
    assert tokens.round_trip(make_docs([(1, "x")]).limit(0), public_vocabulary(), str(tmp_path / "none")).collect() == []


def test_query(spark, plain):
    from sentilode.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {r.doc_id: r for r in QUERIES["op7_token_files"](spark, sf).collect()}
    start = 0
    for doc_id in sorted(texts):
        ids = plain(texts[doc_id])
        row = found.pop(doc_id)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not found
