"""Identities: sample ids, artifact places, content hashes and cache keys."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_id(source_id: Column, index: Column) -> Column:
    """Injective: the source's length in code points stands first."""
    return F.concat_ws(":", F.length(source_id).cast("string"), source_id, index.cast("string"))


def valid_source(source_id: Column) -> Column:
    """Neither empty nor with space at its ends."""
    return (F.trim(source_id) == source_id) & (source_id != "")


def artifact_stem(sample: Column) -> Column:
    return F.sha2(sample, 256)


def artifact_shard(sample: Column) -> Column:
    return F.substring(artifact_stem(sample), 1, 2)


def is_digest(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\A[0-9a-f]{64}\z"), F.lit(False))


def fingerprint(*fields: Column) -> Column:
    """Hash of a struct as JSON with nulls kept; name fields in alphabetical order so that keys stay the same."""
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def canonical(value: Any) -> str:
    """JSON with sorted keys and no spaces, for identities made on the driver."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def identity(value: Any) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


#: What keys were made for; the older one's keys are still looked up (fixed values).
PROMPT_SCHEMA, PROMPT_SCHEMA_BEFORE = "prompt", "prompt-1"


def prompt_key(generator: str, settings: str, schema: str = PROMPT_SCHEMA) -> Column:
    """Everything that a sentence depends on; nothing of the reference branch."""
    named = {
        "branch": F.lit(schema),
        "episode_length": F.col("episode_length"),
        "fps": F.col("fps"),
        "generator": F.lit(generator),
        "metadata": F.col("metadata"),
        "robot_type": F.col("robot_type"),
        "sample_id": F.col("sample_id"),
        "settings": F.lit(settings),
        "subtasks": F.col("subtasks"),
        "task": F.col("task"),
        "video": F.col("video_identity"),
        "view": F.col("real_view"),
    }
    return fingerprint(*(named[k].alias(k) for k in sorted(named)))


def reference_key(extractor: str) -> Column:
    """Everything that a scene picture depends on; nothing of task or sentence."""
    named = {
        "branch": F.lit("reference"),
        "extractor": F.lit(extractor),
        "height": F.col("real_frame_height"),
        "sample_id": F.col("sample_id"),
        "source_frame_index": F.lit(0),
        "video": F.col("video_identity"),
        "view": F.col("real_view"),
        "width": F.col("real_frame_width"),
    }
    return fingerprint(*(named[k].alias(k) for k in sorted(named)))


def prompt_fingerprint(generator: str, task: Column, metadata: Column, frames: Column) -> Column:
    """What one request held: task, metadata, the generator's identity, and every frame's number, time and digest."""
    shown = F.transform(frames, lambda f: F.struct(f["index"].alias("index"), F.sha2(f["jpeg"], 256).alias("jpeg_sha256"), f["seconds"].alias("seconds")))
    named = {"frames": shown, "generator": F.lit(generator), "metadata": metadata, "schema": F.lit("prompt-input"), "task": task}
    return F.concat(F.lit("sha256:"), fingerprint(*(named[k].alias(k) for k in sorted(named))))


def scene_fingerprint(extractor: str, sample: Column, view: Column, height: Column, width: Column, pixels: Column) -> Column:
    """What one scene was made of: the raster's shape and bytes, and every setting."""
    settings = F.to_json(F.struct(F.lit(extractor).alias("extractor"), sample.alias("sample_id"), F.lit(0).alias("source_frame_index"), view.alias("view")))
    shape = F.concat(F.lit("uint8("), height.cast("string"), F.lit(","), width.cast("string"), F.lit(",3)"))
    return F.concat(F.lit("sha256:"), F.sha2(F.concat(shape.cast("binary"), pixels, settings.cast("binary")), 256))
