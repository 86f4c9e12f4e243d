"""Language identification: exact code lengths, held-out accuracy and odd rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from marquetry.llm.language_id import Model, identified, predict, train, words_of

COUNTS = {"aa": {"aba ": 3, "abé ": 1, "b ": 2}, "bb": {"xyz ": 2, "aab ": 1}}


def bits(word, counts, order):
    """A plain tree walk."""
    tree = defaultdict(Counter)
    for w, n in counts.items():
        s = b" " + w.encode()
        for i in range(1, len(s)):
            for k in range(min(order, i) + 1):
                tree[s[i - k : i]][s[i]] += n
    s, total = b" " + word.encode(), 0.0
    for i in range(1, len(s)):
        for k in range(min(order, i), -1, -1):
            seen = tree.get(s[i - k : i])
            if seen is None:
                continue
            base = sum(seen.values()) + len(seen)
            if s[i] in seen:
                total += math.log(seen[s[i]] / base)
                break
            total += math.log(len(seen) / base)
        else:
            total -= math.log(256)
    return total


def test_code_lengths_are_exact():
    model = Model(COUNTS, 4)
    words = ["aba ", "abé ", "xyzzy ", "q ", "aabé ", "b ", "ababababab "]
    got = model.word_scores(pa.array(words, pa.large_string()))
    want = [[bits(w, COUNTS[lang], 4) for lang in ("aa", "bb")] for w in words]
    assert np.allclose(got, want)


def test_words():
    words, sizes, letters = words_of(pa.array(["Ab, c-D1é", None, "", "ÉÀ×", "12 3"]))
    assert words.to_pylist() == ["ab ", "c ", "d ", "é ", "éà× "] and sizes.tolist() == [4, 0, 0, 1, 0] and letters.tolist() == [4, 0, 0, 0, 0]


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog", "en", "x") for i in range(20)] + [(i, "le chat et les chiens", "fr", "x") for i in range(20, 40)]
    rows += [(40, None, "en", "x"), (41, "", "fr", "x"), (42, "12 — ☃ 3", "fr", "x"), (43, "日本", None, "x"), (None, "the", "en", "x"), (44, "THE CAT " * 9000, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, word string")
    got = [(r.doc_id, r.lang_pred) for r in identified(df).collect()]
    assert len(got) == len(rows)
    by_id = dict(got)
    assert all(by_id[i] == ("en" if i < 20 else "fr") for i in range(40))
    assert [by_id[i] for i in (40, 41, 42, 44, None)] == ["und", "und", "und", "en", "en"] and by_id[43] in ("en", "fr")
    kept = predict(df, train(df)).collect()
    assert {r.word for r in kept} == {"x"}
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in identified(unlabelled).collect()] == ["und"]
    assert identified(df.limit(0)).collect() == []


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identified(df).filter("held_out").join(df, "doc_id").select("lang", "lang_pred").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_a_language_of_almost_all_rows(spark):
    rows = [(k, "the cat and the dog sat on the mat", "en") for k in range(3000)] + [(5000 + k, "le chat et le chien sont sur la table", "fr") for k in range(30)]
    got = identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {(r.doc_id >= 5000, r.lang_pred) for r in got} == {(False, "en"), (True, "fr")}
