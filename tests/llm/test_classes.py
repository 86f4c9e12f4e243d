"""The registered fingerprint query finds the near-copy class of every row."""

import __spark_entry__
import pyarrow as pa
from marquetry.llm import packed
from test_near import corpus, groups


def test_query_has_the_classes(spark, tmp_path):
    texts = corpus(5, 80)
    rows = [(7 * i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (7, texts[1])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = __spark_entry__.queries()["op1_fingerprints"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want = {7 * i: 7 * g for i, g in enumerate(groups(texts, 5)[0])}
    assert len(set(want.values())) < len(want)
    assert all(r.class_id == want.get(r.doc_id) for r in got)


def test_packed_texts():
    texts = pa.array(["", None, "é" * 50, "one text"])
    assert packed.unpack(packed.pack(texts)).to_pylist() == ["", "", "é" * 50, "one text"]
    batch = pa.RecordBatch.from_arrays([packed.pack(pa.array(["ab" * 100] * 5))], names=["text"])
    assert [b.num_rows for b in packed.opened(iter([batch]), ["text"], 400)] == [2, 2, 1]
