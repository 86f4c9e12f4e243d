"""Media search: recall of edited copies of each kind, groups of copies and odd rows, against comparing every pair."""

import numpy as np
import pytest
from marquetry.llm import media_search as M

PER_KIND = 10


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").filter("vec_id < 60 or vec_id % 50 = 0 and vec_id < 250")


def rows_of(spark, pictures):
    return spark.createDataFrame([(i, M.write_image(g)) for i, g in pictures], "image_id long, media binary")


def test_every_edit_is_found(spark, vectors):
    """Each kind of edit on PER_KIND pictures; brute force compares every query with every picture."""
    held = {r.image_id: M.read_image(r.media) for r in M.pictures(vectors).collect()}
    asked = {}
    for k, kind in enumerate(M.EDITS):
        for j in range(PER_KIND):
            source = (k * PER_KIND + j) % 60
            asked[1000 * k + j] = (kind, source, M.read_image(M.write_image(M.edited(held[source], kind, j))))
    found, _, _ = M.search(rows_of(spark, [(q, g) for q, (_, _, g) in asked.items()]), M.pictures(vectors))
    got = {(r.query_id, r.image_id): r for r in found.collect()}
    points = {i: M.keypoints_of(g[None])[0] for i, g in held.items()}
    own = {q: M.keypoints_of(g[None], M.COMPARED, M.ENLARGED)[0] for q, (_, _, g) in asked.items()}
    want = {(q, i) for q, p in own.items() for i, x in points.items() if M.agree(p, x)[0] >= M.INLIERS}
    assert set(got) <= want and len(got) >= 0.95 * len(want)
    for k, kind in enumerate(M.EDITS):
        pairs = {(q, s) for q, (name, s, _) in asked.items() if name == kind}
        assert len(pairs & want) >= 0.9 * len(pairs), kind
        assert len(pairs & set(got)) >= 0.9 * len(pairs & want), kind
        scale = {"shrink": 1, "enlarge": 1}.get(kind.split()[0])
        for pair in pairs & set(got):
            height = asked[pair[0]][2].shape[0]
            assert abs(got[pair].scale - (96 / height if scale else 1)) < 0.06, kind
            turn = float(kind.split()[1]) if kind.startswith("turn") else 0
            assert abs(abs(got[pair].angle) - np.deg2rad(turn)) < 0.06, kind


def test_registered_rows(spark, vectors):
    rows = M.copies(vectors).collect()
    images = {r.id: r.class_id for r in rows if r.kind == "image"}
    assert images == {r.vec_id: r.vec_id for r in vectors.collect()} and len(rows) == len({(r.kind, r.id, r.class_id) for r in rows})
    queries = {r.id: r.edit for r in rows if r.kind == "query"}
    assert set(queries) == {i for i in images if i % 50 == 0} and all(queries[i] == M.EDITS[i // 50 % len(M.EDITS)] for i in queries)
    assert {(q, q) for q in queries} <= {(r.id, r.class_id) for r in rows if r.kind == "match"}


def test_groups_of_copies(spark, vectors, monkeypatch):
    """Equal pictures are one class; near copies are bundled, and every one of them is found; bounds change nothing."""
    base = M.read_image(M.pictures(vectors.filter("vec_id = 3")).first().media)
    rng = np.random.default_rng(4)
    near = [(100 + k, base + rng.normal(0, 2, base.shape)) for k in range(40)]
    equal = [(200 + k, base) for k in range(30)]
    other = [(300 + k, M.read_image(r.media)) for k, r in enumerate(M.pictures(vectors.filter("vec_id between 10 and 20")).collect())]
    images = rows_of(spark, near + equal + other)
    queries = rows_of(spark, [(1, M.edited(base, "crop")), (2, M.edited(base, "crop")), (3, M.edited(base, "shrink 0.75"))])
    results = []
    for sent in (M.SENT_ROWS, 0):
        monkeypatch.setattr(M, "SENT_ROWS", sent)
        monkeypatch.setattr(M, "GROUP", 8 if not sent else M.GROUP)
        found, query_classes, image_classes = M.search(queries, images)
        assert {r.image_id: r.class_id for r in query_classes.collect()} == {1: 1, 2: 1, 3: 3}
        assert {r.image_id: r.class_id for r in image_classes.collect()} == {i: min(i, 200) if 200 <= i < 300 else i for i, _ in near + equal + other}
        results.append({(r.query_id, r.image_id) for r in found.collect()})
    assert results[0] == results[1] == {(q, i) for q in (1, 3) for i in [200, *range(100, 140)]}


def test_odd_rows(spark):
    flat = M.write_image(np.full((40, 40), 9))
    noise = M.write_image(np.random.default_rng(1).integers(0, 255, (60, 50)))
    colour = b"P6 2 1 255\n" + bytes(range(6))
    rows = [(1, None), (2, b""), (3, b"P5 9 9 255\nshort"), (4, flat), (5, noise), (5, noise), (None, noise), (6, colour), (7, b"GIF89a")]
    df = spark.createDataFrame([(i, m, "x") for i, m in rows], "image_id long, media binary, keys string")
    found, query_classes, image_classes = M.search(df.filter("image_id = 5"), df)
    assert {(r.query_id, r.image_id) for r in found.collect()} == {(5, 5)}
    assert {(r.image_id, r.class_id) for r in image_classes.collect()} == {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7)}
    assert [(r.image_id, r.class_id) for r in query_classes.collect()] == [(5, 5)]
    assert M.search(df.limit(0), df)[0].collect() == [] and M.search(df, df.limit(0))[0].collect() == []
    assert M.read_image(colour).tolist() == [[1.0, 4.0]]
    large = rows_of(spark, [(9, np.tile(M.read_image(noise), (4, 3)))])
    assert [r.image_id for r in M.search(large, large)[0].collect()] == [9]
    odd = spark.createDataFrame([(0, None), (50, []), (100, [None, 1.0])], "vec_id long, embedding array<float>")
    assert {r.image_id for r in M.pictures(odd, True).collect()} == {0, 50, 100}
    assert {r.id for r in M.copies(odd).collect()} == {0, 50, 100}
