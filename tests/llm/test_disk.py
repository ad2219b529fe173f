"""What the operators leave on disk and move between machines."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from cardwarden.llm import common, packing, suffix_dedup
from cardwarden.llm.common import written


@pytest.fixture()
def shared(tmp_path, monkeypatch):
    """The folder that intermediate tables are written to."""

    def scratch(spark, purpose):
        return str(tmp_path / f"{purpose}-{uuid.uuid4().hex}")

    for module in (common, suffix_dedup):
        monkeypatch.setattr(module, "scratch", scratch, raising=False)
    return tmp_path


def _docs(spark):
    passage = " ".join(f"p{n}" for n in range(70))
    rows = [(n, " ".join(f"w{n}x{m}" for m in range(30 + n)) + " " + passage) for n in range(12)]
    return spark.createDataFrame([*rows, (20, None), (21, "")], "doc_id long, text string")


def test_repeats_leave_no_intermediate_tables(spark, shared):
    found = suffix_dedup.with_spans(written(_docs(spark), "docs"))
    assert sorted(name.rsplit("-", 1)[0] for name in os.listdir(shared)) == [
        "llm-docs", "llm-numbered", "llm-spans",
    ]
    assert sum(bool(row.spans) for row in found.collect()) == 11


def test_repeats_write_no_texts_nobody_asks_for(spark, shared):
    docs = written(_docs(spark), "docs")
    found = suffix_dedup.with_spans(docs, without=("text",))
    assert found.columns == ["doc_id", "n_words", "spans"]
    numbered = next(name for name in os.listdir(shared) if name.startswith("llm-numbered"))
    kept = spark.read.parquet(str(shared / numbered)).schema["_row"].dataType.names
    assert kept == ["doc_id"]
    whole = suffix_dedup.with_spans(docs).drop("text")
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))


def test_packing_moves_no_ids_between_tasks(spark, shared):
    docs = _docs(spark).unionByName(_docs(spark)).repartition(5)
    packed = packing.pack(packing.pieces(docs, with_ids=True))
    plan = packed._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan and "BroadcastHashJoin" in plan
    rows = packed.collect()
    assert len(rows) == 28
    ends = {}
    for row in sorted(rows, key=lambda row: (row.sequence_id, row.offset)):
        assert ends.get(row.sequence_id, 0) == row.offset
        assert len(row.ids) == 4 * row.length
        ends[row.sequence_id] = row.offset + row.length
    assert max(ends.values()) <= packing.LIMIT
    assert len(ends) == -(-sum(row.length for row in rows) // packing.LIMIT)
    assert not packed.where(F.col("sequence_id").isNull()).count()
