"""A run's report leads to every failure."""

import json
import sys

from marquetry.api import Engine
from pyspark import cloudpickle
from test_engine import Painter, config, write


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't have this module


def silent():
    raise RuntimeError("no answer")


def test_all_failures_are_kept(spark, tmp_path):
    write(tmp_path / "data", episodes=103)
    report = Engine(spark, config(tmp_path), silent, Painter).run(audit=False)
    assert len(report["errors"]) == 100 and report["error_count"] == 103 and report["status"] == "partial"
    rows = spark.read.json(report["failures"]).collect()
    assert len({r.sample_id for r in rows}) == 103 and {r.stage for r in rows} == {"prompt"}
    assert json.loads((tmp_path / "out/run_report.json").read_text())["failures"] == report["failures"]
