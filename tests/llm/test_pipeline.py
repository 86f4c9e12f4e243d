"""The pipeline's stages against a brute-force version on a small table."""

import re

import corpus_pipeline
import numpy as np
from marquetry.llm import language_id, packing
from marquetry.llm.chunks import byte_bpe
from marquetry.llm.registry import vocabulary

ROWS = [
    (1, "the cat sat on the mat and looked at the dog that was there", "en"),
    (2, "the cat sat on the mat and looked at the dog that was there", "fr"),
    (3, "le chat est sur la table et il regarde le chien qui est dans la rue", "fr"),
    (4, "password=abcdef123 is what the man wrote on the wall of the house today", "en"),
    (5, "12345 67890", "en"),
    (6, None, None),
    (7, "la maison est dans la rue et les enfants sont dans le jardin avec le chien", None),
]


def test_stages(spark, tmp_path):
    full = [(i, t, lang, "s", len(t or "")) for i, t, lang in ROWS]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id: r for r in docs.collect()}
    assert kept["language"].keys() == {1, 2, 3, 4, 7} and language_id.NONE not in {r.lang for r in kept["language"].values()}
    assert kept["near_duplicates"].keys() == {1, 3, 4, 7}
    masked = re.sub(r"password=\w+", "[SECRET]", ROWS[3][1])
    assert kept["secrets"].keys() == {1, 3, 4, 7} and kept["secrets"][4].text == masked and kept["secrets"][4].n_chars == len(masked)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    bpe = byte_bpe(vocabulary("byte_bpe_50k.json"))
    want = {i: len(bpe.encode_one(r.text)) + 1 for i, r in kept["secrets"].items()}
    assert {r.doc_id: r.doc_tokens for r in pieces} == want and sum(r.length for r in pieces) == sum(want.values())
    assert np.all([r.offset + r.length <= packing.LENGTH for r in pieces])
