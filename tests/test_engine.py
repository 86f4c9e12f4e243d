"""The engine from metadata to audit, with fake adapters over raw videos."""

import json
import sys
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest
from marquetry.api import Engine
from marquetry.config import Config, Dataset, Output, Prompt, Reference, Runtime, load_config
from marquetry.operators.branches import Transient, Truncated
from marquetry.operators.discover import DiscoveryError, discover
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't have this module

H, W = 12, 16


class Talker:
    """Says one sentence; episode 1's first attempts fail, then are cut off."""

    def __init__(self):
        self.calls = {}

    def generate(self, request, max_tokens):
        n = self.calls[request["sample_id"]] = self.calls.get(request["sample_id"], 0) + 1
        assert len(request["images"]) == 8
        if request["sample_id"].endswith(":1") and n == 1:
            raise Transient("busy")
        if request["sample_id"].endswith(":1") and max_tokens < 1024:
            raise Truncated("cut off")
        words = " ".join(["word"] * 70) if request["task"] == "talk on" else f"The arm will {request['task']}"
        return {"prompt": words, "model": "fake", "input_tokens": 100, "output_tokens": 10}


class Painter:
    """Takes a fixed rectangle for the robot; frames whose first pixel is 13 break it, 14 has no robot."""

    def segment(self, frames):
        if any(f[0, 0, 0] == 13 for f in frames):
            raise RuntimeError("broken")
        mask = np.zeros((H, W), np.uint8)
        mask[4:8, 5:10] = 1
        return [[] if f[0, 0, 0] == 14 else [mask] for f in frames]

    def inpaint(self, frames, masks):
        return [np.full_like(f, 240) for f in frames]

    def residual(self, frames):
        return [[] for _ in frames]


def write(root: Path, name="one", source="demo", domain="kitchen", episodes=3, first=None, **info):
    top = root / name
    (top / "meta").mkdir(parents=True)
    shape = {"dtype": "video", "shape": [H, W, 3]}
    base = {"source_id": source, "domain": domain, "fps": 10, "splits": {"train": f"0:{episodes}"}, "features": {"observation.images.camera_head": shape, "observation.images.camera_head_sim": shape}}
    (top / "meta/info.json").write_text(json.dumps(base | info))
    rows = [{"episode_index": k, "length": 81, "tasks": [f"  task {k} "]} for k in range(episodes)]
    (top / "meta/episodes.jsonl").write_text("\n".join(json.dumps(r) for r in rows) + "\n\n")
    for k in range(episodes):
        video = top / f"videos/chunk-000/observation.images.camera_head/episode_{k:06d}.mp4"
        video.parent.mkdir(parents=True, exist_ok=True)
        frames = np.full((81, H, W, 3), (first or {}).get(k, 50), np.uint8)
        video.write_bytes(f"81 {H} {W}\n".encode() + frames.tobytes())
    return top


def config(tmp_path):
    small = Reference(batch_size=4, mask_close_kernel=1, mask_dilation_pixels=0, min_mask_area_fraction=0.01, max_mask_area_fraction=0.8)
    return Config(Dataset(root=str(tmp_path / "data")), Prompt(max_tokens=256), small, Runtime(api_retry_count=3, backoff_initial_seconds=0.0, input_cost_per_million=1.0, output_cost_per_million=2.0), Output(str(tmp_path / "out")))


def test_run_resume_and_audit(spark, tmp_path):
    top = write(tmp_path / "data")
    engine = Engine(spark, config(tmp_path), Talker, Painter)
    assert engine.inspect()["splits"] == {"train": 3, "validation": 0}
    report = engine.run()
    assert report["status"] == "complete" and report["published"] == 3 and report["audit"]["complete_episodes"] == 3, report
    assert report["branches"]["prompt"]["attempts"] == 5 and report["estimated_cost"] == 0.00036
    rows = [json.loads(x) for x in (top / "meta/episodes_prompt.jsonl").read_text().splitlines()]
    assert [r["episode_index"] for r in rows] == [0, 1, 2] and rows[0]["prompt"] == "The arm will task 0."
    again = Engine(spark, config(tmp_path), None, None).run()
    assert again["status"] == "complete" and (again["prompt_cache_hits"], again["reference_cache_hits"]) == (3, 3)
    image = top / "Reference/episode_000001/reference_00.raw"
    image.write_bytes(b"\0" * (H * W * 3))
    (image.parent / "reference_07.raw").write_bytes(b"old")
    (top / "meta/.publishing.json").write_text('{"version": 1, "sample_ids": []}')
    found = engine.audit()
    assert found["status"] == "incomplete" and found["error_count"] == 3 and found["complete_episodes"] == 2, found


def test_failures_stay_alone_and_retract(spark, tmp_path):
    top = write(tmp_path / "data", episodes=5)
    assert Engine(spark, config(tmp_path), Talker, Painter).run()["status"] == "complete"
    for k, value in ((2, 13), (3, 14)):
        video = top / f"videos/chunk-000/observation.images.camera_head/episode_{k:06d}.mp4"
        video.write_bytes(f"81 {H} {W}\n".encode() + np.full((81, H, W, 3), value, np.uint8).tobytes() + b"")
    import os

    for k in (2, 3):
        os.utime(top / f"videos/chunk-000/observation.images.camera_head/episode_{k:06d}.mp4", (1, 1))
    report = Engine(spark, config(tmp_path), Talker, Painter).run()
    assert report["status"] == "partial" and report["published"] == 3 and report["failed_samples"] == 2
    assert {(e["sample_id"][-1], e["error_type"]) for e in report["errors"]} == {("2", "RuntimeError"), ("3", "Unusable")}
    left = [json.loads(x)["episode_index"] for x in (top / "meta/reference_images.jsonl").read_text().splitlines()]
    assert left == [0, 1, 4] and not (top / "Reference/episode_000002/reference_00.raw").exists()


def bad(spark, tmp_path, match, **info):
    write(tmp_path / "data", **info)
    with pytest.raises((DiscoveryError, ValueError), match=match):
        discover(spark, config(tmp_path)).records.count()


@pytest.mark.parametrize(
    ("info", "match"),
    [
        ({"source": " demo"}, "source_id"),
        ({"features": {"x.camera_head": {"dtype": "video", "shape": [1, 1, 3]}}}, "paired"),
        ({"features": {}}, "unavailable"),
        ({"splits": {"train": "0-2"}}, "malformed"),
        ({"splits": {"train": "2:0"}}, "malformed"),
        ({"splits": {"train": ["0"]}}, "info.splits"),
        ({"splits": {"train": "0:2", "validation": "1:3"}}, "not one"),
        ({"splits": {"train": "0:1", "validation": "1:3"}}, "mixes"),
        ({"splits": {}}, "not one"),
        ({"video_path": "../{video_key}.mp4"}, "leaves"),
        ({"fps": 0}, "fps"),
    ],
)
def test_bad_metadata(spark, tmp_path, info, match):
    bad(spark, tmp_path, match, **info)


def test_limits_and_manifests(spark, tmp_path):
    write(tmp_path / "data")
    metadata, splits = tmp_path / "m.json", tmp_path / "s.jsonl"
    metadata.write_text(json.dumps({"samples": [{"sample_id": "4:demo:1", "note": "x"}]}))
    base = config(tmp_path)
    with_manifest = replace(base, dataset=replace(base.dataset, metadata_manifest=str(metadata)))
    rows = discover(spark, with_manifest, "1-2", 1).records.collect()
    assert [(r.episode_index, r.metadata) for r in rows] == [(1, '{"note":"x"}')]
    splits.write_text('{"domain": "garden", "split": "train"}\n')
    with pytest.raises(DiscoveryError, match="without data set"):
        discover(spark, replace(base, dataset=replace(base.dataset, split_manifest=str(splits))))


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("dataset: {root: data}\nreference: {mask_close_kernel: 3}\n")
    assert load_config(path).dataset.root == str(tmp_path / "data")
    for text, match in (("dataset: {rot: x}", "unknown"), ("reference: {mask_close_kernel: 4}", "odd"), ("runtime: {backoff_initial_seconds: 40}", "exceed")):
        path.write_text(text)
        with pytest.raises(ValueError, match=match):
            load_config(path)
