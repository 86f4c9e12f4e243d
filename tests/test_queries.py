"""Every registered query against its DuckDB counterpart, on the smallest tables."""

import math
from collections import Counter

import __spark_entry__
import duckdb
import numpy as np
import pytest
from marquetry.functions import masks as K
from marquetry.operators.splits import parse_episodes
from marquetry.plans import registry
from marquetry.sources import files as IO

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{DIR}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, DIR)
    columns = sorted(got.columns)
    found = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = Counter(tuple(plain(dict(zip(names, row))[c]) for c in columns) for row in found.fetchall())
    assert Counter(tuple(plain(r[c]) for c in columns) for r in got.collect()) == want


def test_every_query_has_its_sql():
    assert registry.QUERIES.keys() == registry.ORACLES.keys()


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_morphology():
    rng = np.random.default_rng(0)
    mask = (rng.random((20, 30)) > 0.8).astype(np.uint8)
    assert (K.removal_mask([mask], 1, 0) == mask).all()
    closed = K.close(mask, 5)
    assert (closed >= mask).all() and (K.close(closed, 5) == closed).all() and (K.dilate(mask, 3) >= mask).all()
    rectangle = np.zeros((64, 96), np.uint8)
    rectangle[16:48, 34:62] = 1
    assert K.tight_box(rectangle) == (34, 16, 62, 48) and K.tight_box(mask * 0) is None
    source, generated = np.zeros((64, 96, 3), np.uint8), np.full((64, 96, 3), 240, np.uint8)
    scene = K.composite(source, generated, rectangle)
    assert (scene[rectangle == 0] == 0).all() and K.changed_fraction(source, scene, rectangle) == 1


def test_selections():
    assert parse_episodes("0,2, 5-9,,") == [(0, 0), (2, 2), (5, 9)] and parse_episodes(None) is None
    for bad in ("a", "5-", "9-5", "-1", " , "):
        with pytest.raises(ValueError, match="episode|range|selection"):
            parse_episodes(bad)


def test_files(tmp_path):
    IO.atomic_write(tmp_path / "a/b.json", b"{}")
    assert IO.read_object(tmp_path / "a/b.json") == {} and [p.name for p in (tmp_path / "a").iterdir()] == ["b.json"]
    assert IO.canonical_line({"b": 1, "a": "é"}) == '{"a":"é","b":1}\n'.encode()
    assert IO.resolve_inside(tmp_path, "a/b.json").name == "b.json"
    for bad in ("../x", "/etc/passwd", "a/../../x"):
        with pytest.raises(ValueError, match="leads out"):
            IO.resolve_inside(tmp_path, bad)


def test_new_rows_only(spark, tmp_path):
    from marquetry.streaming.incremental import new_rows

    seen = []
    data, state = str(tmp_path / "data"), str(tmp_path / "state")
    work = lambda batch, number: seen.append(batch.count())
    spark.range(5).write.parquet(data)
    assert new_rows(spark, data, "id long", state, work) == 1
    spark.range(3).write.mode("append").parquet(data)
    assert new_rows(spark, data, "id long", state, work) == 1 and sum(seen) == 8
