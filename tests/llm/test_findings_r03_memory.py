"""The pipeline's check in round 3: workers kept the size of whole batches as Python objects."""

import pyarrow as pa
import pytest
from lumenframe.llm import common, langid, packing, quality


@pytest.fixture
def runs(spark, monkeypatch):
    """Sizes of the batches that an operator's function gives for one batch of 1,200 rows."""
    caught = []
    kind = type(spark.range(1))
    apply = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, *a, **k: caught.append(f) or apply(self, f, *a, **k))

    def sizes(make) -> list[int]:
        docs = spark.createDataFrame([(1, "der Hund")], "doc_id long, text string")
        make(docs)
        batch = pa.RecordBatch.from_arrays([pa.array(range(1200), pa.int64()), pa.array([f"der Hund und die Katze {i}" for i in range(1200)]), pa.array([f"der Hund {i}" for i in range(1200)])], names=["doc_id", "text", "_text"])
        return [b.num_rows for b in caught[-1](iter([batch, batch.slice(0, 0)]))]

    return sizes


def test_parts_hold_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1201))], names=["i"])
    found = list(common.in_parts(iter([batch, batch.slice(0, 0), batch.slice(7, 2)])))
    assert [x for b in found for x in b.column("i").to_pylist()] == [*range(1201), 7, 8]
    assert max(b.num_rows for b in found) == common.PART


def test_texts_are_read_in_parts(runs):
    model = langid.Model([("de", "hund", 3), ("en", "dog", 3)])
    for make in (packing.tokenized, lambda docs: langid.identify(docs, model), lambda docs: langid.accepted(docs, model), lambda docs: quality._patterns(docs, "pattern int", False)):
        found = runs(make)
        assert len(found) == 3 and max(found) <= common.PART
