"""Each stage against plain Python on what the stage before it has kept."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as pipeline
from sentilode.llm import decontaminate, near, toxicity
from sentilode.llm.queries import public_vocabulary
from sentilode.session import materialize
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_columns(kept):
    assert all(df.columns == COLUMNS for df in kept[:-1])
    assert kept[-1].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_toxic_texts_go(spark, kept):
    scorer = toxicity.Scorer(toxicity.train(kept[0], spark.read.parquet(f"{SF}/labels.parquet")))
    rows = kept[0].collect()
    scores = scorer([r.text for r in rows])
    assert ids(kept[1]) == Counter(r.doc_id for r, s in zip(rows, scores) if s < 0.7)
    assert sum(ids(kept[1]).values()) < len(rows)


def test_one_of_each_group_stays(kept):
    found = near.near_duplicates(kept[1]).collect()
    assert ids(kept[2]) == Counter(r.doc_id for r in found if r.component_id == r.doc_id)


def test_benchmark_texts_go(spark, kept):
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = ids(kept[2]) - ids(kept[3])
    exact = {r.doc_id for r in kept[2].collect() if any(p in decontaminate.normal(r.text) for p in items)}
    assert exact and exact <= set(gone)


def test_mix_is_near_its_targets(kept):
    size = lambda r: len((r.text or "").split())
    before, after = Counter(), Counter()
    for r in kept[3].collect():
        before[r.source] += size(r)
    for r in kept[4].collect():
        after[r.source] += size(r)
    assert max(ids(kept[4]).values()) <= 3
    total = sum(before.values())
    assert abs(sum(after.values()) - total) < 0.05 * total


def test_files_hold_every_copy(kept):
    tokenizer = Tokenizer.from_file(public_vocabulary())
    rows = sorted(kept[4].collect(), key=lambda r: (r.doc_id, r.text))
    found = sorted(kept[5].collect(), key=lambda r: (r.start))
    assert len(rows) == len(found)
    start = 0
    for want, got in zip(rows, found):
        own = [*tokenizer.encode(want.text, add_special_tokens=False).ids, 2]
        assert (got.doc_id, got.start, got.n_tokens) == (want.doc_id, start, len(own))
        assert got.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        start += len(own)


def test_registered(spark):
    import __spark_entry__ as contract

    assert "pipeline" in contract.queries()
