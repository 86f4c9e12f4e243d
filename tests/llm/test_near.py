"""Fingerprints and near-duplicate groups against brute force."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from marquetry.llm import fingerprints, near_dedup
from marquetry.llm.components import components

LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def set_of(text, k):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def groups(texts, k):
    sets = [set_of(t, k) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


def corpus(seed, n=90):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [None, "", "  \n ", "One", "one", "one two", "ONE\ttwo", "x " * 5000, "x " * 6000, "é É"]
    while len(texts) < n:
        base = rng.choices(vocabulary, k=rng.randint(3, 150))
        for _ in range(rng.choice([1, 1, 2, 12])):
            edited = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            texts.append(" ".join(edited))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "k"), [(1, 2), (2, 5)])
def test_groups_match_brute_force(spark, seed, k):
    texts = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, key string, v int")
    want, sizes = groups(texts, k)
    got = {r.doc_id: r for r in near_dedup.near_groups(df, words=k).collect()}
    assert {i: (r.component_id, r.n_shingles) for i, r in got.items()} == dict(enumerate(zip(want, sizes)))
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_odd_tables(spark):
    schema = "doc_id long, text string"
    assert near_dedup.near_groups(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "A b c d e f")]
    got = sorted(near_dedup.near_groups(spark.createDataFrame(rows, schema)).collect(), key=str)
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [("3", "3", True)] * 2 + [("4", "3", False), ("None", "None", True)]


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.u: r.v for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 103: 100}


def test_fingerprints_and_edits(spark):
    texts = corpus(3, 60)
    df = spark.createDataFrame([(10 * i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fingerprint string").repartition(5)
    got = {r.doc_id: r for r in fingerprints.neighbours(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        own, following = t or "", texts[(i + 1) % len(texts)] or ""
        r, half = got[10 * i], len(t or "") // 2
        edited = own[: len(own) - half] + following[:half]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        for text, near in ((edited, r.near_edited), (following, r.near_next)):
            a, b = set_of(own, 5), set_of(text, 5)
            assert abs(near - (len(a & b) / len(a | b) if a | b else 1)) < 0.2
        assert bytes(r.fingerprint) == fingerprints.fingerprint(pa.array([own]))[0].tobytes()
    classes = {r.doc_id: r.class_id for r in fingerprints.near_classes(fingerprints.neighbours(df), df).collect()}
    assert classes == {10 * i: 10 * g for i, g in enumerate(groups(texts, 5)[0])}


def test_fingerprints_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert fingerprints.neighbours(spark.createDataFrame([], schema)).collect() == []
    (one,) = fingerprints.neighbours(spark.createDataFrame([(1, "a b c d")], schema)).collect()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"a b a b"[:4] + b"a b").hexdigest()
    rows = [(None, None), (5, "same words here"), (5, "same words here"), (6, "")]
    assert len(fingerprints.neighbours(spark.createDataFrame(rows, schema)).collect()) == 4


@pytest.mark.parametrize(("name", "value"), [("WIDE", 0), ("GROUP", 2), ("SENT_IDS", 0), ("ALIKE", 99)])
def test_bounds_change_no_link(spark, monkeypatch, name, value):
    """Wide postings, split hubs, shuffled ids and classes without hubs give the same groups."""
    monkeypatch.setattr(near_dedup, name, value)
    texts = corpus(11, 120)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want, _ = groups(texts, 2)
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(df, words=2, **({"alike": value} if name == "ALIKE" else {})).collect()}
    assert got == dict(enumerate(want))


def test_repeated_ids_are_nodes_of_their_own(spark):
    texts = corpus(13, 80)
    ids = [i // 2 for i in range(len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    want, sizes = groups(texts, 2)
    least = {}
    for i, g in zip(ids, want, strict=True):
        least[g] = min(least.get(g, i), i)
    # equal texts without words are alone, each under its own number
    expected = sorted((i, n, least[g] if n else i) for i, g, n in zip(ids, want, sizes, strict=True))
    got = near_dedup.near_groups(df, words=2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected
    assert all(r.kept == (r.component_id == r.doc_id) for r in got)
    prints = fingerprints.neighbours(df)
    classes = fingerprints.near_classes(prints, df).collect()
    want5, sizes5 = groups(texts, 5)
    least = {}
    for i, g in zip(ids, want5, strict=True):
        least[g] = min(least.get(g, i), i)
    assert sorted((r.doc_id, r.class_id) for r in classes) == sorted((i, least[g] if n else i) for i, g, n in zip(ids, want5, sizes5, strict=True))
