"""The pipeline's stages on tables without labels and with repeated ids."""

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], SCHEMA)


def test_language_of_unlabelled_tables(spark):
    rows = [(1, "the cat sat on the mat", None), (2, "été", None), (3, "123 456 -", None), (4, None, None), (5, "", None)]
    got = corpus_pipeline.language(spark, docs_of(spark, rows), "")
    assert sorted((r.doc_id, r.lang) for r in got.collect()) == [(1, None), (2, None)] and got.columns[0] == "doc_id"


def test_rows_of_one_doc_id_are_judged_apart(spark):
    copied, clean = "one two three four five six seven eight", "quite other words stand in this text of its own"
    rows = [(1, copied, "en"), (5, copied, "en"), (5, clean, "en"), (7, "rows that are the same twice over", "en"), (7, "rows that are the same twice over", "en"), (None, clean, "en"), (8, None, "en"), (8, None, "en")]
    got = corpus_pipeline.near_duplicates(spark, docs_of(spark, rows), "").collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == sorted(map(str, [(1, copied), (5, clean), (7, rows[3][1]), (None, clean), (8, None), (8, None)]))


def test_empty_tables_and_null_ids(spark, tmp_path):
    for name, rows in (("empty", []), ("nulls", [(None, "the cat sat on the mat and looked at the dog", "en"), (None, None, None), (3, "le chien est dans la rue avec le chat", "fr")])):
        docs_of(spark, rows).write.parquet(str(tmp_path / name / "documents.parquet"))
        pieces = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert {r.doc_id for r in pieces} == {i for i, t, _ in rows if t}
