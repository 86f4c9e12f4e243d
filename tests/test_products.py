"""Decoding, caching, gates, adapters and published pictures of the engine, on small raw videos."""

import hashlib
import json
import sys
from dataclasses import replace

import numpy as np
import pytest
from marquetry.api import Engine, RunFailed
from marquetry.config import Reference, load_config, overridden
from marquetry.functions import images as G
from marquetry.functions import requests as Q
from marquetry.operators import adapters as A
from marquetry.operators import branches as B
from marquetry.operators.discover import DiscoveryError
from marquetry.sources import video as V
from pyspark import cloudpickle
from test_engine import H, W, Painter, Talker, config, write

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't have this module


class Counted(V.RawVideo):
    """Notes every opening and every frame beside the video."""

    def __init__(self, path):
        super().__init__(path)
        self.log = path + ".log"
        self.note("open")

    def note(self, what):
        with open(self.log, "a") as file:
            file.write(f"{what}\n")

    def read(self, index):
        self.note(index)
        return super().read(index)


def notes(top):
    found = sorted(top.rglob("*.log"))
    lines = [f.read_text().split() for f in found]
    for f in found:
        f.unlink()
    return lines


def jpeg(tmp_path):
    base = config(tmp_path)
    return replace(base, reference=replace(base.reference, image_format="jpeg"))


def test_one_opening_for_both_branches(spark, tmp_path):
    top = write(tmp_path / "data")
    run = lambda generator, scener, settings: Engine(spark, settings, generator, scener, decode=Counted).run()
    assert run(Talker, Painter, config(tmp_path))["status"] == "complete"
    assert notes(top) == [["open", "0", "11", "23", "34", "46", "57", "69", "80"]] * 3
    base = config(tmp_path)
    other = replace(base, reference=replace(base.reference, mask_dilation_pixels=1))
    report = run(None, Painter, other)
    assert report["status"] == "complete" and (report["prompt_cache_hits"], report["reference_cache_hits"]) == (3, 0)
    assert notes(top) == [["open", "0"]] * 3
    report = run(None, None, other)
    assert report["status"] == "complete" and notes(top) == [] and not list((tmp_path / "out").glob("decoded-*"))


def test_videos_that_differ_from_their_metadata(spark, tmp_path):
    top = write(tmp_path / "data")
    folder = top / "videos/chunk-000/observation.images.camera_head"
    (folder / "episode_000000.mp4").write_bytes(f"80 {H} {W}\n".encode() + bytes(80 * H * W * 3))
    (folder / "episode_000001.mp4").write_bytes(f"81 {H} {W} 9.5\n".encode() + bytes(81 * H * W * 3))
    (folder / "episode_000002.mp4").write_bytes(f"81 {H + 1} {W}\n".encode() + bytes(81 * (H + 1) * W * 3))
    report = Engine(spark, config(tmp_path), Talker, Painter).run(audit=False)
    told = {(e["sample_id"][-1], e["step"]): e["message"] for e in report["errors"]}
    assert "80 frames" in told["0", "decode-prompt"] and "9.5 frames" in told["1", "decode-prompt"] and "pixels" in told["2", "decode-prompt"]
    # Frame 0 alone is right for the first two.
    assert set(told) == {("0", "decode-prompt"), ("1", "decode-prompt"), ("2", "decode-prompt"), ("2", "decode-reference-frame0")}
    (folder / "episode_000002.mp4").unlink()
    with pytest.raises(DiscoveryError, match="not there"):
        Engine(spark, config(tmp_path), Talker, Painter).run()


def test_older_keys_are_moved(spark, tmp_path):
    write(tmp_path / "data")
    engine = Engine(spark, config(tmp_path), Talker, Painter)
    engine.run()
    held = tmp_path / "out/prompts"
    rows = spark.read.parquet(str(held)).collect()
    from marquetry.operators.discover import discover

    before = {r.sample_id: r.prompt_keys_before for r in engine._keyed(discover(spark, engine.config).records).collect()}
    assert all(len(k) == 2 for k in before.values())
    moved = [r.asDict() | {"cache_key": before[r.sample_id][r.sample_id.endswith(":1")]} for r in rows]
    schema = spark.read.parquet(str(held)).schema
    import shutil

    shutil.rmtree(held)
    spark.createDataFrame([tuple(m[f] for f in schema.names) for m in moved], schema).write.parquet(str(held))
    report = Engine(spark, config(tmp_path), None, None).run()
    assert report["status"] == "complete" and report["prompt_cache_hits"] == 3
    assert {r.cache_key for r in rows} <= {r.cache_key for r in spark.read.parquet(str(held)).collect()}


class NotReady(Talker):
    def ensure_ready(self):
        raise OSError("no key")


def test_preflight_and_fail_fast(spark, tmp_path):
    write(tmp_path / "data")
    report = Engine(spark, config(tmp_path), NotReady, Painter).run(audit=False)
    assert {(e["stage"], e["step"], e["error_type"]) for e in report["errors"]} == {("prompt", "prompt-preflight", "OSError")} and report["failed_samples"] == 3
    assert Engine(spark, config(tmp_path), Talker, None).run()["status"] == "complete"  # nothing of it was final, the scenes were kept
    base = config(tmp_path)
    fast = replace(base, runtime=replace(base.runtime, fail_fast=True), prompt=replace(base.prompt, temperature=0.5))
    with pytest.raises(RunFailed, match="prompt-preflight: OSError"):
        Engine(spark, fast, NotReady, Painter).run()


class Picky(Painter):
    """Frames that begin with 15 have a mask of the wrong size, with 16 the inpainting gives values that are not finite."""

    def segment(self, frames):
        return [[np.ones((2, 2), np.uint8)] if f[0, 0, 0] == 15 else m for f, m in zip(frames, super().segment(frames), strict=True)]

    def inpaint(self, frames, masks):
        return [np.full(f.shape, np.nan) if f[0, 0, 0] == 16 else np.full_like(f, 240) for f in frames]


def test_broken_answers_are_no_final_failures(spark, tmp_path):
    write(tmp_path / "data", episodes=4, first={0: 14, 1: 15, 2: 16})
    report = Engine(spark, config(tmp_path), Talker, Picky).run(audit=False)
    assert {(e["sample_id"][-1], e["error_type"]) for e in report["errors"]} == {("0", "Unusable"), ("1", "RuntimeError"), ("2", "RuntimeError")}
    rows = {r.sample_id[-1]: r.status for r in spark.read.parquet(str(tmp_path / "out/references")).collect()}
    assert rows == {"0": "rejected", "1": "failed", "2": "failed", "3": "ok"}


def test_jpeg_pictures_and_their_audit(spark, tmp_path):
    top = write(tmp_path / "data", episodes=6)
    engine = Engine(spark, jpeg(tmp_path), Talker, Painter)
    assert engine.run()["status"] == "complete"
    files = sorted(top.rglob("reference_00.jpg"))
    assert len(files) == 6
    read = spark.read.format("image").load(str(top / "Reference/*")).select("image.height", "image.width", "image.data").collect()  # another decoder
    own = G.decode(files[0].read_bytes())
    assert {(r.height, r.width) for r in read} == {(H, W)} and np.abs(np.frombuffer(read[0].data, np.uint8).reshape(H, W, 3).astype(int) - own).max() <= 2
    manifest = top / "meta/reference_images.jsonl"
    rows = [json.loads(x) for x in manifest.read_text().splitlines()]
    assert rows[0]["schema_version"] == 3 and sorted(rows[0]["references"][0]) == sorted(["reference_id", "reference_path", "source_view", "source_frame_index", "scope", "reference_kind", "width", "height", "source_frame_sha256", "mask_sha256", "mask_area_fraction", "sha256", "provenance"])
    rows[0]["references"][0]["scope"] = "object"
    del rows[1]["references"][0]["provenance"]["residual_qa"]["threshold"]
    rows[2]["references"][0]["provenance"]["residual_qa"]["area_fraction"] = 0.5
    rows[5]["references"].append(rows[5]["references"][0])
    manifest.write_text("".join(json.dumps(r) + "\n" for r in rows))
    files[3].write_bytes(b"\x89PNG")
    prompts = top / "meta/episodes_prompt.jsonl"
    lines = [json.loads(x) for x in prompts.read_text().splitlines()]
    lines[4]["prompt"] = "two  words"
    prompts.write_text("".join(json.dumps(r) + "\n" for r in lines) + "not json\n")
    found = engine.audit(show=50)
    told = {e.split(": ", 1)[0].rsplit(":", 1)[1] + " " + e.split(": ", 1)[1] for e in found["errors"]}
    assert told == {
        "0 scope", "1 residual fields", "2 residual failed", "2 residual differs", "3 image digest", "3 not a JPEG", "3 not decodable", "4 prompt not normal", "5 exactly one reference", "None prompt: malformed row",
    }
    assert found["complete_episodes"] == 0 and found["incomplete_episodes"] == 6


def test_codecs():
    rng = np.random.default_rng(0)
    y, x = np.mgrid[:37, :52]
    smooth = np.stack([x * 4, y * 6, x + y], axis=2).astype(np.uint8)
    assert np.abs(G.decode(G.encode_jpeg(smooth, 95)).astype(int) - smooth).mean() < 1
    assert len(G.encode_jpeg(smooth, 30)) < len(G.encode_jpeg(smooth, 95))
    for raster in (smooth, rng.integers(0, 256, (9, 5, 3), np.uint8), rng.integers(0, 2, (7, 8), np.uint8)):
        assert (G.decode_png(G.encode_png(raster)) == raster).all()
    data = G.encode_jpeg(smooth)
    for bad in (b"", b"\xff\xd8", data[:200], data[: len(data) // 2], b"text", b"\x89PNG\r\n\x1a\n", G.encode_png(smooth)[:60]):
        with pytest.raises(ValueError):
            G.decode(bad)
    with pytest.raises(ValueError):
        G.encode_jpeg(np.zeros((0, 3, 3), np.uint8))
    assert G.shrink(np.zeros((480, 640, 3), np.uint8), 512).shape == (384, 512, 3) and G.shrink(smooth, 512) is smooth


def test_rasters():
    square = G.polygon_mask(np.array([[2, 2], [8, 2], [8, 6], [2, 6]]), 10, 12)
    assert square.sum() == 35 and square[2:7, 2:9].all()
    assert G.polygon_mask(np.array([[1, 1], [2, 2]]), 4, 4).sum() == 0 and G.polygon_mask(np.array([[-5, -5], [50, -5], [50, 50], [-5, 50]]), 4, 6).all()
    scores = np.array([[-1.0, 3.0], [-1.0, 3.0]])
    assert G.thresholded(scores, 4, 4, 0).tolist() == [[0, 0, 1, 1]] * 4
    picture, mask = np.arange(3 * 5 * 3, dtype=np.uint8).reshape(3, 5, 3), np.eye(3, 5, dtype=np.uint8)
    tensor, padded = G.to_model(picture, mask, 8)
    assert tensor.shape == (3, 8, 8) and padded.shape == (1, 8, 8) and padded.sum() == 3 and (G.from_model(tensor, 3, 5) == picture).all()
    assert (tensor[:, 3] == tensor[:, 1]).all()
    for bad, error in ((np.full((3, 8, 8), np.inf), RuntimeError), (np.zeros((1, 8, 8)), RuntimeError)):
        with pytest.raises(error):
            G.from_model(bad, 3, 5)
    assert G.mask_reason(np.zeros((3, 5), np.uint8), 3, 5) == "empty" and G.mask_reason(np.ones((3, 4), bool), 3, 5) == "shape" and G.mask_reason(np.ones((3, 5)), 3, 5) == "type"
    assert G.confidence(np.array([-1.0, 0.0])) is None and abs(G.confidence(np.array([100.0, 0.0])) - 1) < 1e-8
    found, sure = A.from_logits(scores, 4, 4)
    assert found.sum() == 8 and sure > 0.8 and A.from_logits(-np.ones((2, 2)), 4, 4) is None


class Model:
    def __init__(self):
        self.embedded, self.set, self.batches = [], [], []

    def embed(self, classes):
        self.embedded.append(classes)
        return len(self.embedded)

    def set_classes(self, classes, embedding):
        self.set.append((classes, embedding))

    def detect(self, frames):
        self.batches.append(len(frames))
        return [{"confidence": [0.5, 0.4], "classes": [0, 0], "masks": [np.eye(2), np.zeros((2, 2))]} for _ in frames]


def test_detector():
    model, frame = Model(), np.zeros((8, 6, 3), np.uint8)
    detector = A.Detector(model, held=1)
    got = detector.predict_requests([(frame, ["Robot", " robot,"]), (frame, ["arm"]), (frame, ["ROBOT"])])
    assert model.batches == [2, 1] and [c for c, _ in model.set] == [["Robot"], ["arm"]] and [d[0].query for d in got] == ["Robot", "arm", "Robot"]
    assert all(len(d) == 1 and d[0].mask.shape == (8, 6) and d[0].box == A.K.tight_box(d[0].mask) for d in got)
    detector.predict([frame], ["robot"])
    assert len(model.embedded) == 3  # one vocabulary is held, so that the first one was made again
    for bad in ({"confidence": [1], "classes": []}, {"confidence": [1], "classes": [0]}, {"confidence": [1], "classes": [3], "polygons": [[[0, 0], [3, 0], [3, 3]]]}, {"confidence": [1], "classes": [0], "masks": []}):
        with pytest.raises(RuntimeError):
            A.detections(bad, frame, ["robot"])
    assert A.detections({"confidence": [1], "classes": [0], "polygons": [[[0, 0], [3, 0], [3, 3]]]}, frame, ["robot"])[0].box == (0, 0, 4, 4)
    with pytest.raises(ValueError):
        A.clean_queries([" , "])


def test_inpainting_batches():
    shapes, sizes = [(5, 7), (6, 8), (20, 20)], []

    def model(pictures, masks):
        sizes.append((pictures.shape, masks.shape))
        return {"output": np.clip(pictures + masks, 0, 1)}

    pictures = [np.full((*s, 3), 51, np.uint8) for s in shapes]
    masks = [np.eye(*s, dtype=np.uint8) for s in shapes]
    out = A.inpainted(pictures, masks, model)
    assert [o.shape for o in out] == [(*s, 3) for s in shapes] and sizes == [((2, 3, 8, 8), (2, 1, 8, 8)), ((1, 3, 24, 24), (1, 1, 24, 24))]
    assert all((o[m > 0] == 255).all() and (o[m == 0] == 51).all() for o, m in zip(out, masks, strict=True))
    for bad in (lambda p, m: p[:0], lambda p, m: {"x": p}, lambda p, m: p * np.nan):
        with pytest.raises(RuntimeError):
            A.inpainted(pictures, masks, bad)
    assert B.process(np.full((H, W, 3), 50, np.uint8), Painter(), config_of())["status"] == "ok"


def config_of():
    from pathlib import Path

    return config(Path("/nowhere"))


def test_assets_and_devices(tmp_path, monkeypatch):
    path = tmp_path / "m.bin"
    path.write_bytes(b"weights")
    digest = hashlib.sha256(b"weights").hexdigest()
    assert A.asset(path, digest)["sha256"] == digest
    monkeypatch.setattr(A.hashlib, "sha256", None)  # the second time nothing is hashed
    assert A.asset(path)["size"] == 7
    for bad in (lambda: A.asset(path, "0" * 64), lambda: A.asset(tmp_path / "none"), lambda: A.asset(tmp_path), lambda: A.device("cuda:2", lambda: 2), lambda: A.device("cuda", lambda: 0), lambda: A.device("cuda:x", lambda: 1), lambda: A.environment("MARQUETRY_NO_SUCH")):
        with pytest.raises(A.Unavailable):
            bad()
    assert A.device("cpu") == "cpu" and A.device("cuda:1", lambda: 2) == "cuda:1"


def test_requests():
    frames = [(10 * k, k / 3, b"j%d" % k) for k in range(8)]
    parts = Q.parts(" wipe ", {"robot_type": "arm"}, frames)
    assert len(parts) == 17 and parts[1]["text"] == "FRAME 1/8: index=0, time=0.000s" and parts[2]["image_url"]["url"] == "data:image/jpeg;base64,ajA="
    assert '{"robot_metadata":{"robot_type":"arm"},"task_description":"wipe"}' in parts[0]["text"]
    for bad in (frames[:7], frames[::-1], [(i + 1, s, j) for i, s, j in frames]):
        with pytest.raises(ValueError, match="frames"):
            Q.parts("wipe", {}, bad)
    with pytest.raises(ValueError, match="task"):
        Q.parts(" ", {}, frames)
    assert Q.frame_list_reason([0, 1, 2, 3, 4, 5, 6, 7], 7) == "last"
    assert Q.payload('```JSON\n{"prompt": " a "}\n```') == "a"
    for raw, reason, cut in (('{"prompt": "a', None, True), ("{}", None, False), ('{"prompt": "a", "b": 1}', None, False), ("no", "length", True), ('{"prompt": 3}', None, False), ('{"prompt": "' + "x" * 801 + '"}', None, False)):
        with pytest.raises(Q.Unparsable) as error:
            Q.payload(raw, reason)
        assert error.value.truncated == cut and B.retryable(error.value)
    assert Q.response_format("a stage!", True)["json_schema"]["name"] == "a_stage_" and Q.response_format("x", False) == {"type": "json_object"}
    assert [B.retryable(B.StatusError(c)) for c in (400, 404, 408, 409, 429, 500, 503)] == [False, False, True, True, True, True, True]


def test_settings(tmp_path):
    assert Reference(robot_queries=(" Robot, ", "robot", "arm  one")).robot_queries == ("Robot", "arm one")
    for bad in ({"image_format": "gif"}, {"robot_queries": ()}, {"device": " "}, {"jpeg_quality": 5}):
        with pytest.raises(ValueError):
            Reference(**bad)
    path = tmp_path / "c.yaml"
    path.write_text("dataset: {root: data}\n")
    changed = overridden(load_config(path), dataset_root=str(tmp_path / "x"), dataset_glob="a*", output_root=None, reference_batch_size=3, api_concurrency=2, decode_workers=5, reference_device="cpu")
    assert (changed.dataset.root, changed.dataset.dataset_glob, changed.reference.batch_size, changed.runtime.decode_workers) == (str(tmp_path / "x"), "a*", 3, 5)
    with pytest.raises(ValueError, match="unknown"):
        overridden(changed, other=1)


def test_structuring_elements():
    from marquetry.functions import masks as K

    assert K.ellipse(1).tolist() == [[True]] and K.ellipse(3).astype(int).tolist() == [[0, 1, 0], [1, 1, 1], [0, 1, 0]]
    assert K.ellipse(5).astype(int).tolist() == [[0, 0, 1, 0, 0], [1, 1, 1, 1, 1], [1, 1, 1, 1, 1], [1, 1, 1, 1, 1], [0, 0, 1, 0, 0]]
    assert K.ellipse(9).sum(axis=1).tolist() == [1, 7, 7, 9, 9, 9, 7, 7, 1]  # half widths 0, 2.65, 3.46, 3.87 and 4, rounded


def test_endpoint(monkeypatch):
    """A busy server, then a cut-off answer, then a whole one: three requests, a larger budget for the last."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from marquetry.operators.client import HttpGenerator

    seen = []

    class Server(BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))) | {"auth": self.headers["Authorization"], "path": self.path})
            text = '{"prompt": "Wi' if len(seen) == 2 else '```json\n{"prompt": "Wipe."}\n```'
            body = json.dumps({"id": "r1", "model": "m2", "choices": [{"message": {"content": text}, "finish_reason": "length" if len(seen) == 2 else "stop"}], "usage": {"prompt_tokens": 7, "completion_tokens": 2}}).encode()
            self.send_response(503 if len(seen) == 1 else 200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    client = HttpGenerator("m", f"http://127.0.0.1:{server.server_port}/v1/", api_key_env="MARQUETRY_TEST_KEY")
    with pytest.raises(A.Unavailable):
        client.ensure_ready()
    monkeypatch.setenv("MARQUETRY_TEST_KEY", "k")
    client.ensure_ready()
    frames = [(k, k / 10, b"j") for k in range(8)]
    request = {"parts": Q.parts("wipe", {}, frames), "response_format": Q.response_format("prompt", True), "system_prompt": "s", "temperature": 0.1}
    got = B._attempted(client, request, config_of(), lambda _: None)
    assert got == {"status": "ok", "attempts": 3, "prompt": "Wipe.", "model": "m2", "request_id": "r1", "input_tokens": 7, "output_tokens": 2}
    assert [s["max_completion_tokens"] for s in seen] == [256, 256, 1024] and seen[0]["auth"] == "Bearer k" and seen[0]["path"] == "/v1/chat/completions" and len(seen[0]["messages"][1]["content"]) == 17
    server.shutdown()
    server.server_close()
    with pytest.raises(ConnectionError):
        client.generate(request, 1)
    with pytest.raises(ValueError, match="base_url"):
        HttpGenerator("m", base_url_env="MARQUETRY_NO_SUCH")._url()


def test_the_last_outcome_holds(spark, tmp_path):
    engine = Engine(spark, config(tmp_path), None, None)
    keyed = spark.createDataFrame([("a", "k"), ("b", "k"), ("c", "new")], "sample_id string, reference_key string")
    image = b"picture"
    sound = {"image": image, "sha256": hashlib.sha256(image).hexdigest(), "provenance": "{}", "status": "ok", "cache_key": "k"}
    rounds = [
        [{"sample_id": "a", "cache_key": "k", "status": "rejected"}, {"sample_id": "b"} | sound, {"sample_id": "c"} | sound],
        [{"sample_id": "a"} | sound, {"sample_id": "b", "cache_key": "k", "status": "failed"}, {"sample_id": "c"} | sound | {"cache_key": "new", "sha256": "0" * 64}],
    ]
    names = [c.split()[0] for c in B.SCENED.split(", ")]
    for rows in rounds:
        engine._append("references", spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], B.SCENED), B.SCENED)
    got = {r.sample_id: r.status for r in engine._done("references", B.SCENED, keyed, None, False).collect()}
    assert got == {"a": "ok", "b": "ok"} and engine._done("references", B.SCENED, keyed, None, True).collect() == []


def test_odd_paths_and_several_data_sets(spark, tmp_path):
    from marquetry.sources import files as IO

    names = ["a b", "c+d", "e%20f", "é", "plain"]
    for k, name in enumerate(names):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.jsonl").write_text(f'{{"v": {k}}}\n\n{{"v": true}}\n')
    got = IO.json_lines(spark, {n: str(tmp_path / n / "x.jsonl") for n in [*names, "none"]}, "v bigint", strict=False).collect()
    assert {(r.key, r.line, r.v, r.valid) for r in got} == {(n, 1, k, True) for k, n in enumerate(names)} | {(n, 3, None, False) for n in names}
    with pytest.raises(ValueError, match="x.jsonl:3"):
        IO.json_lines(spark, {"plain": str(tmp_path / "plain/x.jsonl")}, "v bigint")
    data = tmp_path / "data sets"
    write(data, "one + x", "s1", episodes=1)
    write(data, "two", "s2", "garden", episodes=1)
    (data / "two/labels").mkdir()
    (data / "two/labels/labels.json").write_text(json.dumps({"labels": [{"episode_index": 0, "subtasks": [{"n": 1}]}, {"episode_index": True, "subtasks": []}, {"episode_index": 0, "subtasks": [{"n": 2}]}]}))
    base = config(tmp_path)
    engine = Engine(spark, replace(base, dataset=replace(base.dataset, root=str(data))), Talker, Painter)
    report = engine.run()
    assert report["status"] == "complete" and report["datasets"] == 2 and report["audit"]["complete_episodes"] == 2, report
