"""The two branches behind injected adapters: sentences from frames, and scenes without the robot.

Videos are decoded once for both. Adapters are made inside the Python worker, once for each. Every row has its own
outcome: a failure is a value, never a lost neighbour. What an adapter made is written before it is used twice, so
that no request is sent again by a later action.

Outcomes: `ok`; `rejected`, a deterministic failure that stays until its key changes (an Unusable or any other
ValueError); `failed`, which the next run tries again.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.config import Config
from marquetry.functions import images as G
from marquetry.functions import masks as K
from marquetry.functions import requests as Q
from marquetry.functions import rules as R
from marquetry.sources import video as V

PROMPTED = "sample_id string, cache_key string, status string, prompt string, model string, request_id string, input_tokens long, output_tokens long, input_fingerprint string, attempts int, step string, error_type string, message string"
SCENED = "sample_id string, cache_key string, status string, image binary, sha256 string, source_sha256 string, mask_sha256 string, mask_area double, residual_area double, masks int, mask_png binary, provenance string, input_fingerprint string, width int, height int, attempts int, step string, error_type string, message string"
DECODED = "sample_id string, first binary, frames array<struct<index: int, seconds: double, jpeg: binary>>, prompt_error string, prompt_message string, reference_error string, reference_message string"


class Truncated(Exception):
    """An answer cut off by its budget."""


class Transient(Exception):
    """Worth another attempt."""


class StatusError(Exception):
    """An answer with an HTTP status."""

    def __init__(self, status_code: int, message: str = ""):
        super().__init__(message or f"status {status_code}")
        self.status_code = status_code


class Unusable(ValueError):
    """The input gives no valid product, however often it is tried."""


class Generator(Protocol):
    """generate's request has sample_id, task, metadata, images, frames and the assembled parts and response_format. ensure_ready() is asked first, if it is there."""

    def generate(self, request: dict[str, Any], max_tokens: int) -> dict[str, Any]: ...


class Scener(Protocol):
    """identity() gives what names segmenter, inpainter and detector, if it is there."""

    def segment(self, frames: list[np.ndarray]) -> list[list[np.ndarray]]: ...

    def inpaint(self, frames: list[np.ndarray], masks: list[np.ndarray]) -> list[np.ndarray]: ...

    def residual(self, frames: list[np.ndarray]) -> list[list[np.ndarray]]: ...


def waits(config: Config) -> list[float]:
    """Seconds before each retry."""
    run = config.runtime
    return [min(run.backoff_max_seconds, run.backoff_initial_seconds * 2**k) for k in range(run.api_retry_count)]


def retryable(error: Exception) -> bool:
    """Cut-off or unparsable answers, lost connections, and the statuses 408, 409, 429 and 500 or more."""
    if isinstance(error, (Truncated, Transient, ConnectionError, TimeoutError, json.JSONDecodeError, Q.Unparsable)):
        return True
    status = getattr(error, "status_code", None)
    return isinstance(status, int) and (status in (408, 409, 429) or status >= 500)


def _failure(error: Exception, step: str, attempts: int) -> dict[str, Any]:
    final = isinstance(error, ValueError) and not isinstance(error, (Q.Unparsable, json.JSONDecodeError))
    return {"status": "rejected" if final else "failed", "attempts": attempts, "step": step, "error_type": type(error).__name__, "message": str(error)}


def _attempted(client: Generator, request: dict, config: Config, sleep: Callable[[float], None]) -> dict:
    budget, attempts = config.prompt.max_tokens, 0
    for wait in [*waits(config), None]:
        attempts += 1
        try:
            told = client.generate(request, budget)
            if "prompt" not in told:
                told = told | {"prompt": Q.payload(told["raw"], told.get("finish_reason"))}
            return {"status": "ok", "attempts": attempts, **{k: v for k, v in told.items() if k not in ("raw", "finish_reason")}}
        except Exception as error:
            if isinstance(error, Truncated) or getattr(error, "truncated", False):
                budget = min(4096, max(2 * budget, 1024))
            if wait is None or not retryable(error):
                return _failure(error, "prompt", attempts) | {"status": "failed"}
            sleep(wait)
    raise AssertionError


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
_FRAMES = pa.list_(pa.struct([("index", pa.int32()), ("seconds", pa.float64()), ("jpeg", pa.binary())]))


def _batch(columns: str, rows: list[dict]) -> pa.RecordBatch:
    """Rows as Arrow; fields that a row lacks are null."""
    fields = [("frames", _FRAMES) if c.startswith("frames ") else (c.split()[0], _ARROW[c.split()[1]]) for c in columns.replace(", seconds", " seconds").replace(", jpeg", " jpeg").split(", ")]
    return pa.RecordBatch.from_pylist(rows, pa.schema(fields))


def preflight(spark, make: Callable[[], Any] | None) -> Exception | None:
    """What keeps an adapter from being made ready in a worker; None if nothing does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            try:
                if make is None:
                    raise RuntimeError("no adapter is given")
                ready = getattr(make(), "ensure_ready", None)
                if ready is not None:
                    ready()
                yield pa.RecordBatch.from_pylist([{"kind": None, "message": None}], pa.schema([("kind", pa.string()), ("message", pa.string())]))
            except Exception as error:
                yield pa.RecordBatch.from_pylist([{"kind": type(error).__name__, "message": str(error)}], pa.schema([("kind", pa.string()), ("message", pa.string())]))

    told = spark.range(1).repartition(1).mapInArrow(run, "kind string, message string").first()
    if told["kind"] is None:
        return None
    return type(told["kind"], (RuntimeError,), {})(told["message"])


def refused(jobs: DataFrame, error: Exception, step: str, columns: str) -> DataFrame:
    """The same failure for every job; nothing of it is final."""
    known = {"sample_id": F.col("sample_id"), "cache_key": F.col("cache_key"), "status": F.lit("failed"), "attempts": F.lit(0), "step": F.lit(step), "error_type": F.lit(type(error).__name__), "message": F.lit(str(error))}
    return jobs.select(*(known.get(c.split()[0], F.lit(None)).cast(c.split()[1]).alias(c.split()[0]) for c in columns.split(", ")))


def decoded(jobs: DataFrame, open_: V.Opener, config: Config) -> DataFrame:
    """jobs (sample_id, real_video, episode_length, fps, geometry, frames, for_prompt, for_reference) -> DECODED.

    A video that the sentence needs is opened once for everything; frame 0 alone is read where only the scene
    needs it, or where the sampled frames could not be read.
    """
    long_edge, quality = config.prompt.resize_long_edge, config.prompt.jpeg_quality

    def one(job: dict) -> dict:
        out: dict[str, Any] = {"sample_id": job["sample_id"]}
        if job["for_prompt"]:
            try:
                found = V.bundle(open_, job, long_edge, quality)
                frames = [{"index": i, "seconds": s, "jpeg": j} for i, s, j in found.frames]
                return out | {"frames": frames, "first": found.first.tobytes() if job["for_reference"] else None}
            except Exception as error:
                out |= {"prompt_error": type(error).__name__, "prompt_message": str(error)}
        if job["for_reference"]:
            try:
                out["first"] = V.first_frame(open_, job).tobytes()
            except Exception as error:
                out |= {"reference_error": type(error).__name__, "reference_message": str(error)}
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for job in batch.to_pylist():  # full frames are large: a row a batch
                yield _batch(DECODED, [one(job)])

    wanted = ["sample_id", "real_video", "episode_length", "fps", "real_frame_height", "real_frame_width", "frames", "for_prompt", "for_reference"]
    return jobs.select(*wanted).repartition(config.runtime.decode_workers).mapInArrow(run, DECODED)


def _told(job: dict, branch: str) -> dict | None:
    """The outcome of a job whose frames could not be decoded."""
    if job[f"{branch}_error"] is None:
        return None
    return {"status": "failed", "attempts": 0, "step": f"decode-{'prompt' if branch == 'prompt' else 'reference-frame0'}", "error_type": job[f"{branch}_error"], "message": job[f"{branch}_message"]}


def prompts(jobs: DataFrame, make: Callable[[], Generator], config: Config, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """jobs (sample_id, cache_key, task, metadata, prompt_metadata, input_fingerprint and DECODED's) -> PROMPTED. At most api_concurrency tasks ask at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = None
        for batch in batches:
            out = []
            for job in batch.to_pylist():
                base = {"sample_id": job["sample_id"], "cache_key": job["cache_key"], "input_fingerprint": job["input_fingerprint"]}
                if (failed := _told(job, "prompt")) is not None:
                    out.append(base | failed)
                    continue
                try:
                    client = client or make()
                    frames = [(f["index"], f["seconds"], f["jpeg"]) for f in job["frames"]]
                    request = {
                        "sample_id": job["sample_id"], "task": job["task"], "metadata": job["metadata"], "images": [j for _, _, j in frames], "frames": frames,
                        "parts": Q.parts(job["task"], json.loads(job["prompt_metadata"] or "{}"), frames), "response_format": Q.response_format("prompt", config.prompt.strict_schema),
                        "system_prompt": config.prompt.system_prompt, "temperature": config.prompt.temperature,
                    }
                except Exception as error:
                    out.append(base | _failure(error, "prompt", 0) | {"status": "failed"})
                    continue
                out.append(base | _attempted(client, request, config, sleep))
            yield _batch(PROMPTED, out)

    wanted = ["sample_id", "cache_key", "task", "metadata", "prompt_metadata", "input_fingerprint", "frames", "prompt_error", "prompt_message"]
    return jobs.select(*wanted).repartition(config.runtime.api_concurrency).mapInArrow(run, PROMPTED)


def _identity(scener: Scener) -> dict[str, Any]:
    found = getattr(scener, "identity", None)
    own = found() if found is not None else {}
    return {part: own.get(part) or {"backend": type(scener).__qualname__} for part in ("segmenter", "inpainter", "detector")}


def _scene(frame: np.ndarray, masks: list, config: Config) -> tuple[np.ndarray, dict]:
    """The removal mask of one frame, inside its bounds."""
    if not masks:
        raise Unusable("no mask")
    for mask in masks:
        if reason := G.mask_reason(np.asarray(mask), *frame.shape[:2]):
            raise RuntimeError(f"the segmenter gave an invalid mask: {reason}")
    mask = K.removal_mask(masks, config.reference.mask_close_kernel, config.reference.mask_dilation_pixels)
    area = float((mask > 0).mean())
    if not config.reference.min_mask_area_fraction <= area <= config.reference.max_mask_area_fraction:
        raise Unusable(f"the mask covers {area:.6f}")
    return mask, {"mask_sha256": hashlib.sha256(mask.tobytes()).hexdigest(), "mask_area": area, "masks": len(masks), "mask_png": G.encode_png(mask)}


def _finished(frame: np.ndarray, mask: np.ndarray, told: dict, scene: np.ndarray, left: list, identity: dict, config: Config) -> dict:
    """The gates behind the inpainting, the encoded scene and how it came about."""
    reference = config.reference
    if K.changed_fraction(frame, scene, mask) < reference.min_inpaint_change_fraction:
        raise Unusable("the inpainting changed too little")
    outside = mask == 0
    if not np.array_equal(scene[outside], frame[outside]):
        raise RuntimeError("pixels outside the mask changed")
    rest = float((np.bitwise_or.reduce([(m > 0) for m in left]) if left else np.zeros(mask.shape, bool)).mean())
    if rest > reference.max_residual_area_fraction:
        raise Unusable(f"robot left on {rest:.6f}")
    image = G.encode_jpeg(scene, reference.jpeg_quality) if reference.image_format == "jpeg" else scene.astype(np.uint8).tobytes()
    provenance = {
        "operation": R.OPERATION, "segmenter": identity["segmenter"], "inpainter": identity["inpainter"], "final_mask": {"sha256": told["mask_sha256"], "area_fraction": told["mask_area"]},
        "quality_control": {"outside_mask_unchanged": True, "residual_check_enabled": reference.residual_check, "residual_mask_area_fraction": rest, "max_residual_area_fraction": reference.max_residual_area_fraction},
        "residual_qa": {
            "enabled": reference.residual_check, "detector": identity["detector"] if reference.residual_check else None, "queries": list(reference.robot_queries),
            "area_fraction": rest, "threshold": reference.max_residual_area_fraction, "pass": True,
        },
    }
    return {
        "status": "ok", "image": image, "sha256": hashlib.sha256(image).hexdigest(), "source_sha256": hashlib.sha256(frame.tobytes()).hexdigest(), "residual_area": rest,
        "provenance": Q.compact(provenance), "height": frame.shape[0], "width": frame.shape[1],
    }


def _processed(frames: list[np.ndarray], scener: Scener, config: Config, attempt: int = 1) -> list[dict]:
    """Outcomes of a batch. If an adapter breaks, the batch is halved until the broken item stands alone."""
    out: list[dict] = [{} for _ in frames]
    try:
        identity, ready = _identity(scener), []
        found = scener.segment(frames)
        if len(found) != len(frames):
            raise RuntimeError("the segmenter gave an incomplete batch")
        for k, masks in enumerate(found):
            try:
                ready.append((k, *_scene(frames[k], masks, config)))
            except ValueError as error:
                out[k] = _failure(error, "segmentation", attempt)
        generated = scener.inpaint([frames[k] for k, _, _ in ready], [m for _, m, _ in ready]) if ready else []
        if len(generated) != len(ready) or any(g.shape != frames[k].shape or not np.isfinite(g).all() for (k, _, _), g in zip(ready, generated, strict=False)):
            raise RuntimeError("the inpainting gave an incomplete or invalid batch")
        scenes = [K.composite(frames[k], g, m).astype(np.uint8) for (k, m, _), g in zip(ready, generated, strict=True)]
        left = scener.residual(scenes) if config.reference.residual_check and ready else [[] for _ in ready]
        if len(left) != len(ready):
            raise RuntimeError("the residual detector gave an incomplete batch")
        for (k, mask, told), scene, rest in zip(ready, scenes, left, strict=True):
            try:
                out[k] = told | _finished(frames[k], mask, told, scene, rest, identity, config)
            except ValueError as error:
                out[k] = _failure(error, "gates", attempt)
        return [o | {"attempts": attempt} for o in out]
    except Exception as error:
        if len(frames) == 1:
            return [_failure(error, "reference", attempt)]
        half = len(frames) // 2
        return [*_processed(frames[:half], scener, config, attempt + 1), *_processed(frames[half:], scener, config, attempt + 1)]


def process(frame: np.ndarray, scener: Scener, config: Config) -> dict:
    """The outcome of one frame alone."""
    return _processed([frame], scener, config)[0]


def references(jobs: DataFrame, make: Callable[[], Scener], config: Config) -> DataFrame:
    """jobs (sample_id, cache_key, input_fingerprint, geometry and DECODED's) -> SCENED, in batches of batch_size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scener = None
        for whole in batches:
            for at in range(0, whole.num_rows, config.reference.batch_size):
                good, frames, out = [], [], []
                for job in whole.slice(at, config.reference.batch_size).to_pylist():
                    base = {"sample_id": job["sample_id"], "cache_key": job["cache_key"], "input_fingerprint": job["input_fingerprint"]}
                    if (failed := _told(job, "reference")) is not None:
                        out.append(base | failed)
                        continue
                    try:
                        scener = scener or make()
                        frames.append(np.frombuffer(job["first"], np.uint8).reshape(job["real_frame_height"], job["real_frame_width"], 3))
                        good.append(base)
                    except Exception as error:
                        out.append(base | _failure(error, "reference", 0) | {"status": "failed"})
                done = _processed(frames, scener, config) if good else []
                out += [base | o for base, o in zip(good, done, strict=True)]
                yield _batch(SCENED, out)

    wanted = ["sample_id", "cache_key", "input_fingerprint", "real_frame_height", "real_frame_width", "first", "reference_error", "reference_message"]
    return jobs.select(*wanted).mapInArrow(run, SCENED)


def mismatch(asked: DataFrame, outcomes: DataFrame) -> DataFrame:
    """sample_id, problem of outcomes that answer another request than asked: its view, geometry, source digest or path.

    asked: sample_id, view, height, width, source_sha256, path. outcomes: the same, as told. An unknown sample is a problem, too.
    """
    keys = ["view", "height", "width", "source_sha256", "path"]
    told = outcomes.select("sample_id", *(F.col(k).alias(f"told_{k}") for k in keys))
    met = told.join(asked.withColumn("_known", F.lit(True)), "sample_id", "left")
    same = lambda *names: F.forall(F.array(*(F.col(f"told_{n}").cast("string").eqNullSafe(F.col(n).cast("string")) for n in names)), lambda x: x)
    problem = F.when(F.col("_known").isNull(), "sample").when(~same("view"), "view").when(~same("height", "width"), "geometry").when(~same("source_sha256"), "source").when(~same("path"), "path")
    return met.select("sample_id", problem.alias("problem")).filter("problem is not null")


def accounts(prompted: DataFrame, scened: DataFrame) -> DataFrame:
    """The run's counters over both outcome tables."""
    both = prompted.select(F.lit("prompt").alias("branch"), "sample_id", "status", "attempts", F.coalesce("input_tokens", F.lit(0)).alias("i"), F.coalesce("output_tokens", F.lit(0)).alias("o"))
    both = both.unionAll(scened.select(F.lit("reference"), "sample_id", "status", "attempts", F.lit(0), F.lit(0)))
    return both.groupBy("branch").agg(F.count("*").alias("samples"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") != "ok").alias("failed"), F.sum("attempts").alias("attempts"), F.sum("i").alias("input_tokens"), F.sum("o").alias("output_tokens"))


def raw_video(path: str) -> np.ndarray:
    """All frames of a raw blob."""
    container = V.RawVideo(path)
    try:
        return np.stack([container.read(k) for k in range(container.frame_count)])
    finally:
        container.close()
